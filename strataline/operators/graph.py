"""The property graph of chunks, and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataline.functions import text as tx
from strataline.operators.stack import parent_path


def edges(chunks: DataFrame, references: DataFrame | None = None, doc: str = "file_id", id: str = "chunk_id", order: str = "chunk_no") -> DataFrame:
    """(doc, src, dst, edge_type): the next chunk, the heading chunk a chunk is part of, the chunk a reference leads to.

    ``references``: doc, src, target_segment_id. Each edge once, none from a chunk to itself.
    """
    w = Window.partitionBy(doc).orderBy(order)
    following = chunks.select(doc, F.col(id).alias("src"), F.lead(id).over(w).alias("dst"), F.lit("next").alias("edge_type")).filter("dst is not null")
    heads = chunks.filter("chunk_type = 'header'").groupBy(doc, F.col("heading_path").alias("__p")).agg(F.max_by(id, order).alias("dst"))
    up = F.when(F.col("chunk_type") == "header", parent_path(F.col("heading_path"))).otherwise(F.col("heading_path"))
    part = chunks.select(doc, F.col(id).alias("src"), up.alias("__p")).join(heads, [doc, "__p"]).filter("src <> dst").select(doc, "src", "dst", F.lit("part_of").alias("edge_type"))
    out = following.unionByName(part)
    if references is not None:
        owner = chunks.select(doc, F.explode("source_segments").alias("target_segment_id"), F.col(id).alias("dst"), F.col(order).alias("__o"))
        owner = owner.groupBy(doc, "target_segment_id").agg(F.max_by("dst", "__o").alias("dst"))
        refs = references.join(owner, [doc, "target_segment_id"]).filter("src <> dst").select(doc, "src", "dst", F.lit("references").alias("edge_type")).distinct()
        out = out.unionByName(refs)
    return out


def metrics(chunks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts and averages of chunks, over all or by columns."""
    g = chunks.groupBy(*by) if by else chunks.groupBy()
    return g.agg(
        F.count(F.lit(1)).alias("chunks"), F.round(F.avg("word_count"), 6).alias("avg_words"), F.min("word_count").alias("min_words"), F.max("word_count").alias("max_words"),
        F.count_if(F.coalesce(F.col("context_prefix"), F.lit("")) != "").alias("with_overlap"), F.count_if(F.col("is_cross_page")).alias("cross_page"),
        F.count_if(F.col("continuation_type") == "full").alias("full_continuations"), F.count_if(F.col("continuation_type") == "partial").alias("partial_continuations"),
        F.count_if(F.col("needs_review")).alias("needs_review"),
    )


def tag_counts(chunks: DataFrame, tags: str = "tags") -> DataFrame:
    return chunks.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def sentence_roles(chunks: DataFrame, key: str, text: str = "content") -> DataFrame:
    """(key, sentence_no, sentence, role): sentences with the embedding profile's roles."""
    rows = chunks.select(key, F.posexplode(tx.sentences(F.coalesce(F.col(text), F.lit("")))).alias("sentence_no", "sentence"))
    return rows.withColumn("role", tx.role_by_keywords(F.col("sentence")))


def role_flow(roles: DataFrame, key: str, first: int = 5) -> DataFrame:
    """(key, sentences, flow, main_role): roles without repeats in a row, and the commonest (ties: the first seen)."""
    w = Window.partitionBy(key).orderBy("sentence_no")
    rows = roles.withColumn("new", ~F.lag("role").over(w).eqNullSafe(F.col("role")))
    flow = rows.groupBy(key).agg(F.count(F.lit(1)).alias("sentences"), F.array_sort(F.collect_list(F.when(F.col("new"), F.struct("sentence_no", "role")))).alias("f"))
    counts = roles.groupBy(key, "role").agg(F.count(F.lit(1)).alias("n"), F.min("sentence_no").alias("at"))
    main = counts.groupBy(key).agg(F.max_by("role", F.struct("n", -F.col("at"))).alias("main_role"))
    return flow.join(main, key).select(key, "sentences", F.array_join(F.slice(F.transform("f", lambda s: s["role"]), 1, first), " -> ").alias("flow"), "main_role")


def merge_fragments(roles: DataFrame, key: str) -> DataFrame:
    """(key, sentence_no, sentence, role): explanations under five words join the sentence before, unless it is irrelevant."""
    w = Window.partitionBy(key).orderBy("sentence_no")
    before = F.lag("role").over(w)
    absorbed = before.isNotNull() & (F.col("role") == "explanation") & (tx.word_count(F.col("sentence")) < 5) & (before != "irrelevant")
    rows = roles.withColumn("__g", F.sum(F.when(absorbed, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sentence_no", "sentence"))), lambda s: s["sentence"]), " ")
    return rows.groupBy(key, "__g").agg(F.min("sentence_no").alias("sentence_no"), text.alias("sentence"), F.min_by("role", "sentence_no").alias("role")).drop("__g")
