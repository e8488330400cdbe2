"""Lines repeated across the documents of one source.

Documents with the same lines collapse into clusters first. A line then counts over distinct clusters (each
standing for one document, or for as many as it holds) and over publication dates, and a line found in a large
share of its source's documents is boilerplate.

Distinct (source, document, line hash) rows are made once, in one shuffle of hashes, and kept; all counts come from
them. The lines that count are few (``mark_repeated``), so they are broadcast once counted and no line is shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.llm.common import BROADCAST_ROWS, SPACE, settled


def line_form(line: Column) -> Column:
    """A line without letter case, white space and digits."""
    return F.regexp_replace(F.lower(line), rf"[{SPACE}\p{{Nd}}]+", "")


def worded(line: Column, words: int) -> Column:
    """Whether a line has at least so many white-space separated words that contain a letter."""
    return F.regexp_count(line, F.lit(rf"[^{SPACE}]*\p{{L}}[^{SPACE}]*")) >= words


def explode_lines(df: DataFrame, text: str) -> DataFrame:
    """One row for each line (split at \\n) with ``line_no`` from 0 and ``line``; null texts have none."""
    return df.select("*", F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))


def with_line_hash(lines: DataFrame, min_words: int) -> DataFrame:
    """Lines long enough to judge, with ``line_hash`` of their form. 64 bits of the form and, against
    chance meetings, its length: two forms meet with a probability below 1e-9 for a source of 1e5 lines."""
    form = line_form(F.col("line"))
    return lines.filter(worded(F.col("line"), min_words)).withColumn("line_hash", F.xxhash64(form, F.length(form)))


def document_clusters(each: DataFrame, source: str, doc: str) -> DataFrame:
    """(source, doc, cluster): documents of a source with the same set of line hashes share a cluster id.

    ``each``: distinct (source, doc, line_hash). The fingerprint is a commutative sum over the hashes, so it combines on
    the map side.
    """
    a = F.sum(F.col("line_hash").cast("decimal(38,0)"))
    b = F.bit_xor(F.xxhash64(F.col("line_hash"), F.lit(7)))
    return each.groupBy(source, doc).agg(F.xxhash64(a.cast("string"), b, F.count(F.lit(1))).alias("cluster"))


def repeated_lines(
    lines: DataFrame,
    totals: DataFrame,
    source: str = "site",
    doc: str = "file_id",
    dates: DataFrame | None = None,
    share: float = 0.2,
    least: int = 3,
    least_dates: int = 1,
    weigh: str = "documents",
) -> DataFrame:
    """Boilerplate of each source: (source, line_hash, n_docs, n_clusters, n_dates), settled.

    ``lines``: source, doc, line_hash; ``totals``: source, n_all (its documents). With ``weigh="documents"`` a cluster
    counts as the documents in it, with ``"clusters"`` as one, among the source's clusters, so that republished documents
    don't make a line boilerplate. ``dates``: source, doc, date; a cluster has the date of its first publication, and
    ``n_dates`` of a line are the distinct dates of its clusters (0 without ``dates``). Rows without a source never count.
    Every shuffle is of distinct hashes, pre-aggregated; no text is moved, and a line that one source repeats in all its
    documents is counted by partial sums.
    """
    each = settled(lines.filter(F.col(source).isNotNull()).select(source, doc, "line_hash").distinct())
    clusters = document_clusters(each, source, doc)
    day = F.lit(None).cast("date")
    if dates is not None:
        first = dates.groupBy(source, doc).agg(F.min("date").alias("date"))
        clusters, day = clusters.join(first, [source, doc], "left"), F.min("date")
    members = clusters.groupBy(source, "cluster").agg(F.min(doc).alias(doc), F.count(F.lit(1)).alias("members"), day.alias("date"))
    counted = each.join(members.select(source, doc, "members", "date"), [source, doc])  # one document stands for its cluster
    by_line = counted.groupBy(source, "line_hash").agg(F.sum("members").alias("n_docs"), F.count(F.lit(1)).alias("n_clusters"))
    if dates is None:
        by_line = by_line.withColumn("n_dates", F.lit(0).cast("bigint"))
    else:
        days = counted.filter("date is not null").groupBy(source, "line_hash", "date").agg(F.lit(1).alias("one"))
        days = days.groupBy(source, "line_hash").agg(F.count(F.lit(1)).alias("n_dates"))
        by_line = by_line.join(days, [source, "line_hash"], "left").na.fill(0, ["n_dates"])
    n = F.col("n_docs" if weigh == "documents" else "n_clusters")
    if weigh != "documents":
        totals = members.groupBy(source).agg(F.count(F.lit(1)).alias("n_all"))
    kept = n >= least if dates is None else (n >= least) & (F.col("n_dates") >= least_dates)
    return settled(by_line.filter(kept).join(totals, source).filter(n >= F.lit(share) * F.col("n_all")).drop("n_all"))


def mark_repeated(lines: DataFrame, repeated: DataFrame, source: str = "site", most: int = BROADCAST_ROWS, parts: int = 64) -> DataFrame:
    """Lines that are boilerplate of their source.

    ``repeated`` (settled) has at most 1/share times the mean number of lines of a document for each source, whatever the
    corpus size. Up to ``most`` rows it is broadcast. Beyond that both sides are split by ``parts``, so that a line which
    a giant source repeats in all its documents meets in that many tasks.
    """
    keys = repeated.select(source, "line_hash")
    if repeated.count() <= most:
        return lines.join(F.broadcast(keys), [source, "line_hash"], "left_semi")
    keys = keys.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    split = lines.withColumn("__part", F.pmod(F.xxhash64(*[c for c in lines.columns if c not in (source, "line_hash")]), F.lit(parts)).cast("int"))
    return split.join(keys, [source, "line_hash", "__part"], "left_semi").drop("__part")


def without_lines(df: DataFrame, found: DataFrame, keys: list[str], text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the text without its found lines (keys, line_no). Null stays null."""
    numbers = found.groupBy(*keys).agg(F.collect_set("line_no").alias("__drop"))
    kept = F.filter(
        F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
        lambda s: ~F.coalesce(F.array_contains(F.col("__drop"), s["i"]), F.lit(False)),
    )
    return (
        df.join(numbers, keys, "left")
        .withColumn(out, F.when(F.col(text).isNull(), None).otherwise(F.array_join(F.transform(kept, lambda s: s["x"]), "\n")))
        .drop("__drop")
    )
