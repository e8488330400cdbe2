"""Helpers shared by the training-text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.sources.tables import settled

#: Unicode white space, for Java regular expressions.
SPACE = r"\p{IsWhite_Space}"
#: Most rows of keys that are broadcast (some 16 to 64 MB of them); beyond it a join shuffles. The rows are the same.
BROADCAST_ROWS = 2_000_000


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One table of the library; only the named columns are read."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A settled side of a join, marked for broadcast if it has at most ``most`` rows."""
    return F.broadcast(df) if df.count() <= most else df


def latest(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """One row per key, the one with the greatest ``order`` (null orders last; ties: the greatest row).

    ``max`` over a struct combines on the map side, so a key delivered very often never meets in one task.
    """
    best = F.max(F.struct(F.col(order).alias("__o"), *[F.col(c) for c in columns])).alias("__r")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("__r")[c].alias(c) for c in columns])


def once(df: DataFrame, keys: list[str], order: str, columns: list[str], most: int = BROADCAST_ROWS) -> DataFrame:
    """As ``latest`` for rows with whole keys, without shuffling the texts of rows that were delivered once.

    The keys of several rows are counted first; while they are few they are broadcast, and only their rows are shuffled.
    More of them are met by ``latest`` over all rows. Rows with a null in their key are kept as they are.
    """
    known = df
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    several = settled(known.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(*keys))
    if several.count() > most:
        odd = df.filter(~F.coalesce(*[F.when(F.col(k).isNull(), False) for k in keys], F.lit(True)))
        return latest(known, keys, order, columns).unionByName(odd.select(*keys, *columns))
    several = F.broadcast(several)
    return df.join(several, keys, "left_anti").select(*keys, *columns).unionByName(latest(df.join(several, keys, "left_semi"), keys, order, columns))


def scanned_files(spark: SparkSession, sf_dir: str, used: bool, most: int = BROADCAST_ROWS) -> DataFrame:
    """Ids of the files with the given ``ocr_used``, each once, to filter other tables by (``of_files``). Broadcast if the
    table of files, counted from its footers, has at most ``most`` rows, so that no text is shuffled for a filter."""
    files = read(spark, sf_dir, "source_files", "file_id", "ocr_used")
    ids = files.filter(F.col("ocr_used") == F.lit(used)).select("file_id").distinct()
    return F.broadcast(ids) if files.count() <= most else ids


def of_files(df: DataFrame, files: DataFrame, key: str = "file_id") -> DataFrame:
    """Rows of the given files."""
    return df.join(files, key, "left_semi")


def words_of(text: Column) -> Column:
    """The distinct words of a text, in small letters."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{M}]+"))
