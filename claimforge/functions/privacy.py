"""One-way digests for identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def digest(value: Column | str) -> Column:
    """SHA-256 hex of any column read as text; NULL stays NULL."""
    col = F.col(value) if isinstance(value, str) else value
    return F.sha2(col.cast("string"), 256)


def packed(value: Column | str) -> Column:
    """Bytes that stand for one text each: a digest takes 33 of them, other text one more than it has."""
    col = F.col(value) if isinstance(value, str) else value
    other = F.concat(F.lit(b"\0"), F.encode(col, "UTF-8"))
    return F.when(col.rlike(r"^[0-9a-f]{64}\z"), F.concat(F.lit(b"\1"), F.unhex(col))).otherwise(other)


def packed_text(text: str | None) -> bytes | None:
    """What ``packed`` makes of one text, for the few keys that a plan names."""
    if text is None:
        return None
    return b"\1" + bytes.fromhex(text) if re.fullmatch("[0-9a-f]{64}", text) else b"\0" + text.encode()


def unpacked(value: Column | str) -> Column:
    """The text that ``packed`` made bytes of."""
    col = F.col(value) if isinstance(value, str) else value
    rest = F.substring(col, 2, 2**31 - 1)
    return F.when(F.substring(col, 1, 1) == F.lit(b"\1"), F.lower(F.hex(rest))).otherwise(F.decode(rest, "UTF-8"))


def register_mask(spark: SparkSession, name: str = "pii_mask") -> None:
    """The digest as a SQL function for users of SQL text."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING "
        "RETURN sha2(value, 256)"
    )


def keyed_digest(value: Column | str, key: str) -> Column:
    """Deterministic token: the digest of a caller-held key followed by the value."""
    col = F.col(value) if isinstance(value, str) else value
    return digest(F.concat(F.lit(key), col.cast("string")))
