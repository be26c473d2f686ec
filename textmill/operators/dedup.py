"""Exact duplicates, by MD5 of the raw text; the row with the lowest id stays.

One text may account for a large share of all rows, so no operator here lets the
copies of a text meet before they were thinned out on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.text import content_key

SALTS = 256


def drop_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, content_key, text)`` of the first row of every text.

    Grouping by the text next to its key keeps this a hash aggregate: a map task sends
    at most one row per text, and no text is sorted.
    """
    keyed = df.select(F.col(id_col), content_key(F.col(text)).alias("content_key"), F.col(text))
    return keyed.groupBy("content_key", text).agg(F.min(id_col).alias(id_col)).select(id_col, "content_key", text)


def flag_duplicates(
    df: DataFrame, key: str = "content_key", id_col: str = "doc_id", flag: str = "is_duplicate", salts: int = SALTS
) -> DataFrame:
    """Flag all rows but the first of each key, keeping every row.

    Two rounds: the first row per (key, salt) goes on to the second round, where
    the winners of a key meet (at most ``salts`` of them) while the losers stay
    spread out over their salts.
    """
    salt = F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int")
    local = Window.partitionBy(key, "salt").orderBy(id_col)
    final = Window.partitionBy(key, "lane").orderBy(id_col)
    return (
        df.withColumn("salt", salt)
        .withColumn("local_rank", F.row_number().over(local))
        .withColumn("lane", F.when(F.col("local_rank") == 1, -1).otherwise(F.col("salt")))
        .withColumn("final_rank", F.row_number().over(final))
        .withColumn(flag, ~((F.col("lane") == -1) & (F.col("final_rank") == 1)))
        .drop("salt", "local_rank", "lane", "final_rank")
    )
