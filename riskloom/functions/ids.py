"""Identifier expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(prefix: str, number: Column, width: int = 6) -> Column:
    """For instance CUST_000042; null for a null number."""
    return F.when(number.isNotNull(), F.format_string(f"{prefix}_%0{width}d", number.cast("long")))


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """Version-5 UUID: SHA-1 of namespace bytes and name, with version and variant set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.lower(F.hex(variant)), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
