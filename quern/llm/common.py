"""Helpers shared by the corpus operators: column access, checked broadcasts and bounded batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import settled as settle

#: Prefix of internal columns, so that extra columns of the input cannot clash with them.
P = "__q_"
#: Most bytes, as JSON text, of a table that is broadcast.
BROADCAST_BYTES = 64 << 20


def checked_broadcast(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if the settled table df is of max_rows rows and max_bytes bytes at most; otherwise the join shuffles (AQE splits skew)."""
    size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()
    return F.broadcast(df) if size[0] <= max_rows and (size[1] or 0) <= max_bytes else df


def key_of(column: Column) -> Column:
    """A string that tells null from every value, for joins in which nulls form a group of their own."""
    return F.coalesce(F.concat(F.lit("v"), column.cast("string")), F.lit("n"))


def small_batches(spark: SparkSession) -> None:
    """Bound what an Arrow batch holds, as texts may be long: 512 rows and 8 MB.

    Spark reads these settings of the session when a plan runs, so all operators set the same values, whenever that is;
    operators that gain from larger batches gather them themselves.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 512)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


__all__ = ["BROADCAST_BYTES", "P", "checked_broadcast", "key_of", "settle", "small_batches"]
