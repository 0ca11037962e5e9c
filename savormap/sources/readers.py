"""Scans. Every reader takes a declared schema; none infers one from the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = T.StructType | str

CSV_NULL = "\\N"  # what stands for null, so that a quoted empty string stays one; an empty field is null too

# Quotes are doubled inside quoted fields, and fields may span lines.
CSV_OPTIONS = {
    "header": True,
    "multiLine": True,
    "quote": '"',
    "escape": '"',
    "nullValue": CSV_NULL,
    "emptyValue": "",
}


def read_csv(spark: SparkSession, path: str, schema: Schema, **options) -> DataFrame:
    """CSV with header and multi-line quoted fields.

    Such files cannot be split, so parallelism is the number of files;
    ``read_csv_ranges`` reads one file in several tasks.
    """
    return spark.read.schema(schema).options(**{**CSV_OPTIONS, **options}).csv(path)


def read_csv_ranges(spark: SparkSession, path: str, schema: Schema, **options) -> DataFrame:
    """CSV as ``read_csv`` reads it, every file by byte ranges, quoted line breaks included.

    A line starts a record if an even number of quotes stands before it in its file. Each range
    counts its quotes, the counts of the ranges before it are added up (one row per range), and so
    every range knows where its records start. Lines are joined to records inside their range;
    only records that cross its ends meet the rest of themselves elsewhere. Quotes have to be
    doubled inside quoted fields and to stand in no unquoted field; lines end in ``\\n`` or ``\\r\\n``.
    Fields stay as they are; ``read_csv`` makes ``\\r\\n`` in a field ``\\n`` where lines end that way.
    """
    settings = {**CSV_OPTIONS, **options}
    quote = settings["quote"]
    if settings["escape"] != quote:
        raise ValueError("byte ranges need quotes that are escaped by doubling")
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))).cast("long").alias("quotes"),
    )
    piece = ["file", "block"]
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        lines.groupBy(*piece)
        .agg(F.sum("quotes").alias("quotes"))
        .select(*piece, F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("carried"))
    )
    inside = Window.partitionBy(*piece).orderBy("line")
    before = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ((F.col("carried") + before) % 2 == 0).cast("long")
    numbered = (
        lines.join(carried, piece)
        .withColumn("starts", starts)
        .withColumn("record", F.sum("starts").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    )
    joined = lambda part: F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda x: x["value"]), "\n")
    # Record 0 of a range is the rest of one that an earlier range began.
    parts = (
        numbered.groupBy(*piece, "record")
        .agg(joined(F.struct("line", "value")).alias("value"))
        .withColumn("last", F.max("record").over(Window.partitionBy(*piece)))
    )
    whole = parts.where("record > 0 AND record < last").select(*piece, "record", "value")
    ends = parts.where("record = 0 OR record = last")
    began = Window.partitionBy("file").orderBy("block", "record").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("record") > 0, F.struct("block", "record")), ignorenulls=True).over(began)
    # At most two rows of a range get here.
    crossing = (
        ends.withColumn("owner", owner)
        .groupBy("file", "owner")
        .agg(joined(F.struct("block", "record", "value")).alias("value"))
        .select("file", "owner.block", "owner.record", "value")
    )
    records = whole.unionByName(crossing).withColumn("value", F.regexp_replace("value", r"\r$", "")).where("value != ''")
    if str(settings["header"]).lower() == "true":
        records = records.where("NOT (block = 0 AND record = 1)")
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    kept = {k: str(v) for k, v in settings.items() if k != "header"}
    return records.select(F.from_csv("value", ddl, kept).alias("row")).select("row.*")


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet, which carries its own schema."""
    return spark.read.parquet(*paths)


def read_json(spark: SparkSession, path: str, schema: Schema, pretty: bool = False) -> DataFrame:
    """JSON, one document per line or (``pretty``) one per file."""
    return spark.read.schema(schema).option("multiLine", pretty).json(path)


def read_collection(
    spark: SparkSession, fmt: str, schema: Schema | None = None, **options
) -> DataFrame:
    """A document collection through whatever data source ``fmt`` names."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A JDBC table. With a numeric ``column`` and its bounds the scan runs in parallel slices."""
    if column is None:
        return spark.read.jdbc(url, table, properties=properties or {})
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )


def parse_json(df: DataFrame, column: str | Column, schema: Schema, *carry: str) -> DataFrame:
    """JSON strings to typed columns; a missing or unreadable field is null."""
    value = F.col(column) if isinstance(column, str) else column
    return df.select(*carry, F.from_json(value, schema).alias("_doc")).select(*carry, "_doc.*")


def documents(spark: SparkSession, lines: Sequence[str], schema: Schema) -> DataFrame:
    """A few inline JSON documents as rows."""
    return parse_json(spark.createDataFrame([(x,) for x in lines], "value string"), "value", schema)


def topic_options(servers: str, topic: str, group: str | None = None) -> dict[str, str]:
    """Options of a topic subscription; the group defaults to the topic."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "kafka.group.id": group or topic,
    }


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    messages_per_batch: int | None = None,
) -> DataFrame:
    """A topic as a stream of string keys and values; a batch limit keeps a backlog from arriving at once."""
    reader = spark.readStream.format("kafka").options(**topic_options(servers, topic, group))
    if messages_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", messages_per_batch)
    return reader.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def read_message_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    """A folder of message files, one value per line, as a stream with the same value column.

    A batch takes so many files, or files of so many bytes and one at least; else all there are.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.text(path)
