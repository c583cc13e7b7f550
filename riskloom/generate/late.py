"""Fixture for late data: one corrected and one late row for a date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.times import iso_date
from riskloom.operators.clean import first_id
from riskloom.operators.compare import first_source_row, union_all
from riskloom.schemas import RAW_TRANSACTION

# Fixed values of the late row.
LATE_AMOUNT = 123.45


def late_id(event_date: str) -> str:
    return f"LATE_{iso_date(event_date).replace('-', '')}_000001"


def late_fixture(
    raw: DataFrame, canonical: DataFrame, event_date: str, newest: tuple[str, ...] = ("event_timestamp",)
) -> DataFrame:
    """Two raw rows made from the source row of the date's first id.

    The corrected row keeps the id, adds 1 to the amount and happens at noon; the late
    row has its own id, happens in the last second of the date and is no fraud.
    """
    found = first_source_row(raw, first_id(canonical, event_date))
    source = found.orderBy(*[F.desc(c) for c in newest]).limit(1).select(*RAW_TRANSACTION.fieldNames())
    corrected = source.withColumns(
        {
            "event_timestamp": F.lit(f"{event_date}T12:00:00+00:00"),
            "amount": F.round(F.col("amount") + 1.0, 2),
        }
    )
    late = source.withColumns(
        {
            "transaction_id": F.lit(late_id(event_date)),
            "event_timestamp": F.lit(f"{event_date}T23:59:59+00:00"),
            "amount": F.lit(LATE_AMOUNT),
            "is_fraud": F.lit(False),
        }
    )
    return union_all(corrected, late)
