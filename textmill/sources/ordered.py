"""Files whose rows are known by their place: written in an order, and numbered when read.

A table in an order is dealt into ranges, sorted there and written range by range, so the
files' names, taken in order, hold the rows in order; no task sees more than a range.

Reading goes the other way. A scan cuts files into blocks and reads each from front to back
in one task; so a row's place is its place in the block, after all blocks before it in its
file, after all files before that by name. Only counts per block and per file are added up.
The numbers do not depend on how a scan cuts the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.session import materialize


def in_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """The rows in the order of the keys, by ranges of about equal size."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)


def read_ordered(spark: SparkSession, path: str, schema: str = "text string") -> DataFrame:
    """JSON records of a folder, or of a folder per partition value, with ``ordinal``: the
    place of a record from 0 on, in the order of file names (within its partition folder,
    if there are some) and lines. Blank lines are no records; a malformed one fails the job."""
    scanned = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    placed = scanned.select(
        F.struct(*scanned.columns).alias("record"),
        F.regexp_extract("_metadata.file_path", r"^(.*)/", 1).alias("folder"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Stored, as counting and numbering must see the same rows in the same tasks.
    stored = materialize(placed, "ordered-rows")
    blocks = stored.groupBy("folder", "file", "block").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier_blocks = Window.partitionBy("folder", "file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before_block", F.coalesce(F.sum("n").over(earlier_blocks), F.lit(0)))
    sizes = blocks.groupBy("folder", "file").agg(F.sum("n").alias("n"))
    earlier_files = Window.partitionBy("folder").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = sizes.select("folder", "file", F.coalesce(F.sum("n").over(earlier_files), F.lit(0)).alias("before_file"))
    starts = blocks.join(files, ["folder", "file"]).select(
        "folder", "file", "block", (F.col("before_file") + F.col("before_block") - F.col("first")).alias("shift")
    )
    numbered = stored.join(materialize(starts, "ordered-blocks"), ["folder", "file", "block"])
    return numbered.select("record.*", (F.col("row") + F.col("shift")).alias("ordinal"))
