"""Row identifiers and key hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions.parse import as_col

# fixed values: separator of a row id, stand-in of a null part
SEPARATOR = "||"
NULL_PART = "∅"


def row_id(*cols: str | Column, null_safe: bool = False) -> Column:
    """SHA-256 over the joined parts. Nulls are skipped, so (1, null, 7) and (1, 7) share an id;
    ``null_safe`` puts a marker in their place."""
    parts = [as_col(c).cast("string") for c in cols]
    if null_safe:
        parts = [F.coalesce(part, F.lit(NULL_PART)) for part in parts]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def key_hash(*cols: str | Column, seed: int | None = None) -> Column:
    """32 bits of an MD5 over the key, as a bigint. The same on every engine and partitioning."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(NULL_PART)) for c in cols]
    text = parts[0] if len(parts) == 1 else F.concat_ws(SEPARATOR, *parts)
    if seed is not None:
        text = F.concat(F.lit(f"{seed}:"), text)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
