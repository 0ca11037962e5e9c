"""Static tables laid out by a key, read by the few keys a micro-batch asks for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 256
_BUCKET = "_bucket"


@dataclass(frozen=True)
class LookupTable:
    """A Parquet table partitioned by the hash bucket of ``key``.

    A reader passes the buckets of its own keys as partition filters, so a small
    batch opens a few folders whatever the size of the table. ``buckets`` belongs to
    the layout: a reader has to name the number the table was written with.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    buckets: int = BUCKETS

    def write(self, rows: DataFrame, files: int = 1) -> LookupTable:
        """Replace the table; ``files`` spreads the bucket of a hot key over several tasks."""
        rest = [c for c in self.schema.fieldNames() if c != self.key]
        spread = [F.pmod(F.xxhash64(*rest), F.lit(files))] if rest and files > 1 else []
        (
            rows.select(*self.schema.fieldNames())
            .withColumn(_BUCKET, self._bucket(self.key))
            .repartition(_BUCKET, *spread)
            .write.mode("overwrite")
            .partitionBy(_BUCKET)
            .parquet(self.path)
        )
        return self

    def _bucket(self, column: str):
        return F.pmod(F.xxhash64(F.col(column).cast(self.schema[self.key].dataType)), F.lit(self.buckets)).cast("int")

    def rows_for(self, wanted: DataFrame, column: str) -> DataFrame:
        """Rows of the buckets that hold the keys in ``wanted``'s ``column``; a superset of their rows.

        At most ``buckets`` numbers reach the driver. ``wanted`` is evaluated for them, so keep it stored.
        """
        touched = [r[_BUCKET] for r in wanted.select(self._bucket(column).alias(_BUCKET)).distinct().collect()]
        stored = T.StructType([*self.schema.fields, T.StructField(_BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(stored).parquet(self.path)
        return rows.where(F.col(_BUCKET).isin(touched)).drop(_BUCKET)
