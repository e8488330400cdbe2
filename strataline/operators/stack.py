"""Ancestor stacks as windows: heading paths without a loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEP = " > "


def with_stack_path(df: DataFrame, doc: str, order: list[Column], header: Column, level: Column, text: Column, levels: int | None = 6, out: str = "path", reset: Column | None = None) -> DataFrame:
    """``out``: texts of the headings above each row, by level, joined with " > ".

    A heading at level l pops all at l and deeper; one with empty text pops and isn't pushed. ``reset`` marks rows
    that clear the stack. One window for all levels, partitioned by document. ``levels``: the deepest that the source can
    have (deeper ones count as it); None where it states no bound: the levels are then asked of the data, one column each.
    """
    ranks = list(range(1, levels + 1)) if levels is not None else sorted(r[0] for r in df.filter(header).select(F.coalesce(level, F.lit(1)).alias("l")).distinct().toLocalIterator()) or [1]
    level = F.coalesce(level, F.lit(1))
    w = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    place = F.row_number().over(Window.partitionBy(doc).orderBy(*order))
    df = df.withColumn("__n", place).withColumn("__l", F.when(header, F.least(level, F.lit(ranks[-1]))))
    at = [F.max(F.when(F.col("__l") == i, F.struct(F.col("__n").alias("n"), F.trim(F.coalesce(text, F.lit(""))).alias("t")))).over(w).alias(f"__p{k}") for k, i in enumerate(ranks)]
    cleared = (F.max(F.when(reset, F.col("__n"))).over(w) if reset is not None else F.lit(None).cast("int")).alias("__reset")
    df = df.select("*", *at, cleared)
    parts = []
    for k in range(len(ranks)):
        p = F.col(f"__p{k}")
        above = [F.col(f"__p{j}")["n"] for j in range(k)]
        top = F.coalesce(F.greatest(*above) if len(above) > 1 else above[0], F.lit(-1)) if above else F.lit(-1)
        parts.append(F.when((p["n"] > top) & (p["t"] != "") & (p["n"] >= F.coalesce(F.col("__reset"), F.lit(-1))), p["t"]))
    return df.withColumn(out, F.concat_ws(SEP, *parts)).drop("__n", "__l", "__reset", *[f"__p{k}" for k in range(len(ranks))])


def parent_path(path: Column) -> Column:
    """The path without its last part; null for a root."""
    return F.when(path.contains(SEP), F.regexp_replace(path, r" > (?:(?! > ).)*$", ""))


def flatten_ids(df: DataFrame, doc: str, order: list[Column], out: str = "segment_id") -> DataFrame:
    """Ids seg_0001 ... in reading order of each document."""
    n = F.row_number().over(Window.partitionBy(doc).orderBy(*order))
    return df.withColumn(out, F.format_string("seg_%04d", n))


def real_levels(df: DataFrame, doc: str, order: list[Column], header: Column, inferred: Column, out: str = "real_level") -> DataFrame:
    """Levels of headings: the inferred one; for an unmarked one 2 below a chapter or another unmarked one, else 1."""
    w = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.max(F.when(header & inferred.isin(0, 1), F.lit(1))).over(w)
    return df.withColumn(out, F.when(header & (inferred >= 1), inferred).when(header & (inferred == 0), F.when(seen == 1, 2).otherwise(1)))
