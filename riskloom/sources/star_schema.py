"""Adapters from the given star-schema tables to transactions and events.

`transactions` reads only the tables that the asked-for columns need: every join
here is a left join to a unique key, so leaving one out changes no row. A daily
total therefore scans lineitem alone and shuffles nothing but its own groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.ids import padded_id
from riskloom.operators.clean import dedup_latest

# Currency per region key, fixed values.
REGION_CURRENCY = {0: "USD", 1: "CAD", 2: "GBP", 3: "INR", 4: "EUR"}

# Amount from which a line counts as high value in these tables.
TABLE_THRESHOLD = 90000.0
EVENT_THRESHOLD = 200.0
EVENT_TYPES = ["click", "view", "purchase", "signup"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _currency() -> Column:
    """CASE over the five region keys."""
    currency = F.lit(None).cast("string")
    for key, code in REGION_CURRENCY.items():
        currency = F.when(F.col("n_regionkey") == key, code).otherwise(currency)
    return currency


def _time_of_day() -> Column:
    return F.make_dt_interval(
        secs=((F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729) % 86400).cast("decimal(18,6)")
    )


# column -> (tables it needs besides lineitem, expression)
_COLUMNS: dict[str, tuple[tuple[str, ...], callable]] = {
    "transaction_id": ((), lambda: F.concat_ws("-", "l_orderkey", "l_linenumber")),
    "event_timestamp": (
        (),
        lambda: F.col("l_shipdate").cast("timestamp") + _time_of_day(),
    ),
    "event_date": ((), lambda: F.col("l_shipdate").cast("date")),
    "event_hour": (
        (),
        lambda: F.floor(((F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729) % 86400) / 3600).cast("int"),
    ),
    "customer_id": (("orders",), lambda: padded_id("CUST", F.col("o_custkey"))),
    "merchant_id": ((), lambda: padded_id("MERCH", F.col("l_suppkey"))),
    "amount": ((), lambda: F.col("l_extendedprice")),
    "currency": (("orders", "customer", "nation"), _currency),
    "country": (("orders", "customer", "nation"), lambda: F.col("n_name")),
    "merchant_category": (("part",), lambda: F.col("p_type")),
    "payment_method": (("orders",), lambda: F.col("o_orderpriority")),
    "device_id": ((), lambda: padded_id("DEV", F.col("l_partkey") % 750 + 1)),
    "is_fraud": ((), lambda: (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40)),
    # Position in the source; breaks ties between copies of one transaction id.
    "source_offset": ((), lambda: F.col("l_partkey") * F.lit(4294967296).cast("long") + F.col("l_suppkey")),
}
_JOINS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "customer": ("o_custkey", "c_custkey"),
    "part": ("l_partkey", "p_partkey"),
    "nation": ("c_nationkey", "n_nationkey"),
}
TRANSACTION_COLUMNS = list(_COLUMNS)
RAW_COLUMNS = [
    "transaction_id", "event_timestamp", "customer_id", "merchant_id", "amount", "currency", "country",
    "merchant_category", "payment_method", "device_id", "is_fraud", "source_offset",
]
# Computed before lines are shuffled, as they take less room than what they are made of; texts are made last.
_SMALL = ("event_timestamp", "event_date", "amount", "is_fraud")
MADE = ("amount", "is_fraud")
_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def transactions(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Typed transactions, one row per lineitem, copies of an id included."""
    names = list(columns or TRANSACTION_COLUMNS)
    small = [name for name in _SMALL if name in names]
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.select(*_LINE_KEYS, *[_COLUMNS[name][1]().alias(name) for name in small])
    return describe(spark, sf_dir, lines, names, small)


def latest_transactions(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The newest copy of every transaction; copies go before anything is joined to them."""
    names = list(columns or TRANSACTION_COLUMNS)
    return describe(spark, sf_dir, newest_lines(spark, sf_dir, names), names, MADE)


def newest_lines(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> DataFrame:
    """The line of every newest copy, with what `describe` needs for the named columns; those `MADE` are there already.

    An id joins the two keys that are known, so the first known one and the second say the same as its text. Part, supplier
    and ship date are not shuffled beside the order of copies, but made of it again; only those it does not tell go along.
    """
    small = [name for name in MADE if name in names]
    order = ["event_timestamp", "source_offset"]
    lines = table(spark, sf_dir, "lineitem")
    kind = {name: lines.schema[name].dataType for name in ("l_linenumber", "l_partkey", "l_suppkey")}
    known, low = F.col("l_orderkey").isNotNull(), F.lit(0xFFFFFFFF)
    told = F.coalesce(F.col("l_partkey").isNotNull() & F.col("l_suppkey").between(F.lit(0), low), F.lit(False))
    lines = lines.select(
        F.when(~told, F.col("l_partkey")).alias("_part"), F.when(~told, F.col("l_suppkey")).alias("_supp"),
        F.when(_COLUMNS["event_timestamp"][1]().isNull(), F.col("l_shipdate").cast("timestamp")).alias("_ship"),
        known.alias("_known"),
        F.coalesce("l_orderkey", "l_linenumber").alias("_first"),
        F.when(known, F.col("l_linenumber")).alias("_second"),
        *[_COLUMNS[name][1]().alias(name) for name in [*order, *small]],
    )
    newest = dedup_latest(lines, ["_first", "_second"], order).select(
        F.when(F.col("_known"), F.col("_first")).alias("l_orderkey"),
        F.when(F.col("_known"), F.col("_second")).otherwise(F.col("_first").cast(kind["l_linenumber"])).alias("l_linenumber"),
        F.coalesce("_part", F.shiftright("source_offset", 32)).cast(kind["l_partkey"]).alias("l_partkey"),
        F.coalesce("_supp", F.col("source_offset").bitwiseAND(low)).cast(kind["l_suppkey"]).alias("l_suppkey"),
        "_ship", "event_timestamp", *small,
    )
    shipped = F.coalesce("_ship", F.col("event_timestamp") - _time_of_day()).alias("l_shipdate")
    return newest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shipped, *small)


def describe(
    spark: SparkSession, sf_dir: str, rows: DataFrame, names: Iterable[str], made: Iterable[str] = (), once: bool = False,
    only: Callable[[str], Column] | None = None,
) -> DataFrame:
    """Columns of lines, with the tables joined that a named column needs; those `made` are there already.

    Customers are joined to orders, so that the many lines are shuffled for orders and parts only. `once` joins
    one row per key, for rows that must not become more where a key repeats. `only` tells the orders that lines can
    refer to, where these are some of the lines.
    """
    names, made = list(names), set(made)
    needed = {other for name in names if name not in made for other in _COLUMNS[name][0]}

    def joined(left_rows: DataFrame, other: str) -> DataFrame:
        left, right = _JOINS[other]
        found = table(spark, sf_dir, other)
        if other == "orders" and only is not None:
            found = found.where(only(right))
        if other == "orders" and "customer" in needed:
            found = joined(found.dropDuplicates([right]) if once else found, "customer")
        elif once:
            found = found.dropDuplicates([right])
        return left_rows.join(found, F.col(left) == F.col(right), "left")

    for other in ("orders", "part", "nation"):
        if other in needed:
            rows = joined(rows, other)
    return rows.select(*[name if name in made else _COLUMNS[name][1]().alias(name) for name in names])


def raw_transactions(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The same rows as raw text-timestamp input, with faults the tables lack.

    Line keys divisible by 97, 89, 83 and 79 lose the id, the amount, the sign of
    the amount and the timestamp.
    """
    return describe(spark, sf_dir, raw_lines(spark, sf_dir), list(columns or RAW_COLUMNS), RAW_LINE_COLUMNS)


RAW_LINE_COLUMNS = ["transaction_id", "event_timestamp", "amount", "is_fraud", "source_offset"]


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lines alone say of raw rows, faults included, beside the keys by which `describe` adds the rest."""
    rows = table(spark, sf_dir, "lineitem")
    rows = rows.select(*_LINE_KEYS, *[_COLUMNS[name][1]().alias(name) for name in RAW_LINE_COLUMNS])
    part = F.shiftright("source_offset", 32)
    iso = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return rows.select(
        *_LINE_KEYS,
        F.when(part % 97 != 0, F.col("transaction_id")).alias("transaction_id"),
        F.when(part % 79 == 0, "not-a-timestamp").otherwise(iso).alias("event_timestamp"),
        F.when(part % 89 == 0, F.lit(None)).when(part % 83 == 0, -F.col("amount"))
        .otherwise(F.col("amount")).alias("amount"),
        "is_fraud", "source_offset",
    )


def _json_text(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}": "'), value, F.lit('"'))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker records whose values are JSON events, with contract violations mixed in.

    Every 25th event repeats the id before it and every 30th arrives two days late.
    Event ids divisible by 101 ... 151 carry one fault each (see the branches).
    """
    e = table(spark, sf_dir, "events")
    n = F.col("event_id")
    happened = F.col("ts").cast("timestamp")
    arrived = happened + F.make_dt_interval(
        days=F.when(n % 30 == 0, 2).otherwise(0),
        secs=(n % 120).cast("decimal(18,6)"),
    )
    happened = F.when(n % 139 == 0, arrived + F.make_dt_interval(hours=F.lit(1))).otherwise(happened)

    def iso(value: Column, offset: str = "'+00:00'") -> Column:
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" + offset)

    amount = F.when(n % 109 == 0, "-1.00").when(n % 149 == 0, "1000001.00").otherwise(
        F.col("value").cast("decimal(18,2)").cast("string")
    )
    customer = F.when(n % 107 == 0, F.concat(F.lit('"customer_id": '), n.cast("string"))).otherwise(
        _json_text("customer_id", padded_id("CUST", F.col("user_id")))
    )
    fields = [
        _json_text("transaction_id", F.concat(F.lit("EVT_"), F.when((n % 25 == 0) & (n > 0), n - 1).otherwise(n).cast("string"))),
        _json_text("event_timestamp", F.when(n % 113 == 0, iso(happened, "")).otherwise(iso(happened))),
        customer,
        _json_text("merchant_id", F.when(n % 137 == 0, "").otherwise(padded_id("MERCH", n % 100 + 1))),
        F.concat(F.lit('"amount": '), amount),
        _json_text("currency", F.when(F.col("user_id") % 2 == 0, "USD").otherwise("CAD")),
        _json_text("country", F.when(F.col("user_id") % 2 == 0, "US").otherwise("CA")),
        _json_text("merchant_category", F.element_at(F.array(*map(F.lit, ["fuel", "grocery", "restaurant", "travel"])), (n % 4 + 1).cast("int"))),
        _json_text("payment_method", F.element_at(F.array(*map(F.lit, ["bank_transfer", "credit_card", "debit_card"])), (n % 3 + 1).cast("int"))),
        F.when(n % 131 != 0, _json_text("device_id", padded_id("DEV", n % 1000 + 1))),
        _json_text("event_type", F.col("event_type")),
        _json_text("ingestion_timestamp", iso(arrived)),
        F.when(n % 103 == 0, F.lit('"promo_code": "X1"')),
    ]
    # concat_ws leaves the null (absent) fields out.
    body = F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
    raw = F.when(n % 101 == 0, F.concat(F.lit("{not-json "), n.cast("string"))).when(
        n % 127 == 0, F.concat(F.lit("["), n.cast("string"), F.lit("]"))
    ).otherwise(body)
    return e.select(
        F.encode(raw, "UTF-8").alias("value"),
        F.lit("transaction-events").alias("topic"),
        (n % 3).cast("int").alias("partition"),
        n.alias("offset"),
        arrived.alias("timestamp"),
    )
