"""How large a table is, for deciding whether it can be broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StringType, StructType

# A side of a join is broadcast only up to this size.
BROADCAST_BYTES = 64 << 20
# What a number takes, and any value besides its own bytes.
VALUE_BYTES = 16


def value_bytes(value: Column, kind: DataType) -> Column:
    """Bytes of a value: texts and binaries by their length, a struct by its fields."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + VALUE_BYTES
    if isinstance(kind, StructType):
        parts = [value_bytes(value.getField(f.name), f.dataType) for f in kind]
        return sum(parts, F.lit(VALUE_BYTES).cast("long"))
    return F.lit(VALUE_BYTES).cast("long")


def fits_broadcast(df: DataFrame, most_rows: int, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most so many rows and bytes. It is read once for that."""
    size = sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(0).cast("long"))
    rows, taken = df.agg(F.count("*"), F.sum(size)).first()
    return rows <= most_rows and (taken or 0) <= most_bytes
