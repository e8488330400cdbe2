"""Vector operators: similarity, breakpoints, prototypes, coherence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector has no length; null where one is null."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(F.when(a.isNotNull() & b.isNotNull(), 0.0))


def breakpoints(df: DataFrame, doc: str, order: str, vector: str, threshold: float = 0.5, ratio: float = 0.7, window: int = 3) -> DataFrame:
    """Rows whose similarity to the row before is under ``threshold`` and under ``ratio`` of the mean of the up to
    ``window`` similarities before it (the first is compared with itself; a mean of 0 or less counts as no drop)."""
    w = Window.partitionBy(doc).orderBy(order)
    rows = df.withColumn("similarity", cosine(F.lag(vector).over(w), F.col(vector))).filter("similarity is not null")
    before = F.avg("similarity").over(w.rowsBetween(-window, -1))
    rows = rows.withColumn("avg_similarity", F.coalesce(before, F.col("similarity")))
    rows = rows.withColumn("drop_ratio", F.when(F.col("avg_similarity") > 0, F.col("similarity") / F.col("avg_similarity")).otherwise(1.0))
    return rows.filter((F.col("similarity") < threshold) & (F.col("drop_ratio") < ratio))


#: Prototypes in one broadcast row (some MB at some hundred dimensions).
LIBRARY_BLOCK = 2_000
#: Roles that a prototype may better.
REFINED = ("explanation", "irrelevant")


def refine_by_prototypes(df: DataFrame, key: str, vector: str, prototypes: DataFrame, threshold: float = 0.75, least: float = 0.0, role: str | None = None, block: int = LIBRARY_BLOCK) -> DataFrame:
    """(key, role, score): the role of the most similar prototype, null under the threshold; ties by role. With ``role``, a
    column of roles, only explanations and irrelevant ones are bettered; others keep theirs, with a null score.

    ``prototypes``: role, proto (vector), a library that is counted. It is broadcast as one row, so that a row meets all of
    it without a join key or shuffle; a larger one in rows of ``block``, of which a key's best is then taken.
    """
    parts = -(-max(1, prototypes.count()) // block)
    if parts == 1:
        lib = prototypes.groupBy()
    else:
        lib = prototypes.groupBy(F.pmod(F.xxhash64("role", "proto"), F.lit(parts)).alias("__b"))
    lib = lib.agg(F.array_sort(F.collect_list(F.struct(F.col("role").cast("string").alias("role"), F.transform("proto", lambda x: x.cast("double")).alias("v")))).alias("__lib")).select("__lib")
    each = lambda v: F.transform("__lib", lambda p: F.struct(cosine(v, p["v"]).alias("s"), p["role"].alias("role")))
    best = lambda v: F.aggregate(each(v), F.struct(F.lit(least).alias("s"), F.lit(None).cast("string").alias("role")), lambda a, x: F.when(x["s"] > a["s"], x).otherwise(a))
    own = F.col(role) if role else F.lit(None).cast("string")
    may = own.isin(*REFINED) if role else F.lit(True)
    rows = df.select(key, own.alias("__own"), F.coalesce(may, F.lit(False)).alias("__may"), F.when(F.coalesce(may, F.lit(False)), F.col(vector)).alias("__v"))
    rows = rows.join(F.broadcast(lib), how="cross").withColumn("b", best(F.col("__v")))
    if parts > 1:
        # the greatest similarity; of equal ones the first role
        rows = rows.groupBy(key, "__own", "__may").agg(F.max("b.s").alias("s"), F.collect_list("b").alias("bs"))
        rows = rows.withColumn("b", F.struct("s", F.array_min(F.transform(F.filter("bs", lambda x: x["s"] == F.col("s")), lambda x: x["role"])).alias("role")))
    return rows.select(key, F.when(F.col("__may") & (F.col("b.s") >= threshold), F.col("b.role")).otherwise(F.col("__own")).alias("role"), F.when(F.col("__may"), F.round("b.s", 3)).alias("score"))


def cross_page_similarity(before: Column, after: Column) -> Column:
    """How well a text goes on after a page break: the cosine of the vectors of its ends, 0 at least; 0.5 where there is no
    encoder (a null vector)."""
    return F.coalesce(F.greatest(cosine(before, after), F.lit(0.0)), F.lit(0.5))


def coherence(df: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, n, coherence): the mean similarity of all pairs of a group, 1 for fewer than two vectors.

    In linear time and without pairs: from the length of the sum of the unit vectors. The sums are taken by dimension
    and combine on the map side. A vector without length has similarity 0 with all.
    """
    size = norm(F.col(vector))
    rows = df.select(group, F.posexplode(vector).alias("dim", "x"), F.when(size > 0, size).alias("len")).withColumn("x", F.coalesce(F.col("x").cast("double") / F.col("len"), F.lit(0.0)))
    sums = rows.groupBy(group, "dim").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("n"), F.count("len").alias("m"))
    total = sums.groupBy(group).agg(F.sum(F.col("s") * F.col("s")).alias("q"), F.max("n").alias("n"), F.max("m").alias("m"))
    return total.select(group, "n", F.when(F.col("n") < 2, 1.0).otherwise((F.col("q") - F.col("m")) / (F.col("n") * (F.col("n") - 1))).alias("coherence"))
