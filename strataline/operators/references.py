"""Captions, block catalogs and references to blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.functions import lexicon as lx
from strataline.functions import text as tx
from strataline.functions.patterns import java, needed


def block_catalog(segments: DataFrame, doc: str = "file_id") -> DataFrame:
    """(doc, caption_id, segment_id, type, page): the last block of each caption id."""
    rows = segments.filter(F.col("type").isin(*lx.CATALOG_TYPES)).withColumn("caption_id", tx.block_id(F.coalesce("text", F.lit("")), F.col("type")))
    best = F.max(F.struct("pos", "segment_id", "type", "page")).alias("b")
    return rows.filter("caption_id is not null").groupBy(doc, "caption_id").agg(best).select(doc, "caption_id", "b.segment_id", "b.type", "b.page")


def page_blocks(segments: DataFrame, doc: str = "file_id") -> DataFrame:
    """(doc, page, kind, first_id, last_id): the first and last block of each kind on a page."""
    kind = F.when(F.col("type").isin("Figure", "Picture"), "Figure").when(F.col("type") == "Table", "Table").when(F.col("type").isin("Formula", "Equation"), "Equation")
    rows = segments.withColumn("kind", kind).filter("kind is not null")
    return rows.groupBy(doc, F.coalesce("page", F.lit(0)).alias("page"), "kind").agg(F.min_by("segment_id", "pos").alias("first_id"), F.max_by("segment_id", "pos").alias("last_id"))


def mentions(chunks: DataFrame, key: str, text: str, keep: list[str]) -> DataFrame:
    """Each mention of a block in a text: key, kept columns, ref_kind, direction, target_type, ref_text, ref_id,
    start_offset, end_offset (characters from 0, the end exclusive).

    All patterns run over a text in one pass; a row is made for each match.
    """
    c = F.col(text)
    return chunks.filter(c.isNotNull()).select(key, *keep, F.explode(mentioned(c)).alias("m")).select(key, *keep, "m.*")


def mentioned(c: Column) -> Column:
    """The mentions of a text as an array, explicit ones first; null for a null text."""
    return tx.bound(tx.small(c), lambda low: _mentioned(c, low))


def _mentioned(c: Column, low: Column) -> Column:
    found = []
    for kind, p in lx.EXPLICIT_REFERENCES:
        ids = F.transform(F.regexp_extract_all(c, F.lit("(?iu)" + java(p)), 1), lambda i: F.trim(i))
        found.append(_placed(c, low, p, lambda w, n, kind=kind, ids=ids: ("explicit", "", F.lit(kind), F.get(ids, n))))
    for direction, p in lx.IMPLICIT_REFERENCES:
        found.append(_placed(c, low, p, lambda w, n, direction=direction: ("implicit", direction, _kind(w), F.lit(""))))
    return F.concat(*found)


def _placed(c: Column, low: Column, pattern: str, fields) -> Column:
    """The matches of a pattern with their places, which are the lengths of what stands before them."""
    p = F.lit("(?iu)" + java(pattern))
    # texts without a string that the pattern needs have no match
    has = F.lit(False)
    for x in sorted(needed(pattern) or {""}):
        has = has | low.contains(x)
    found = F.when(has, F.regexp_extract_all(c, p, 0)).otherwise(F.array().cast("array<string>"))
    length = lambda xs: F.aggregate(xs, F.lit(0), lambda s, x: s + F.length(x))

    def all_of(whole: Column) -> Column:
        return F.transform(whole, lambda w, n: one(whole, w, n))

    def one(whole: Column, w: Column, n: Column) -> Column:
        kind, direction, target, number = fields(w, n)
        start = length(F.slice(F.split(c, "(?iu)" + java(pattern), -1), 1, n + 1)) + length(F.slice(whole, 1, n))
        return F.struct(F.lit(kind).alias("ref_kind"), F.lit(direction).alias("direction"), target.alias("target_type"), w.alias("ref_text"), number.alias("ref_id"), start.alias("start_offset"), (start + F.length(w)).alias("end_offset"))

    return tx.bound(found, all_of)


def _kind(w: Column) -> Column:
    low = F.lower(w)
    return F.when(low.rlike("figure|chart|graph|diagram"), "Figure").when(low.contains("table"), "Table").when(low.rlike("equation|formula"), "Equation").otherwise("Figure")


def plain_mentions(chunks: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ref_text): figures, tables and equations by number, as the embedding profile finds them; they aren't resolved."""
    return chunks.select(key, F.explode(F.regexp_extract_all(text, F.lit(r"(?iu)(?:Figure|Table|Equation)\s+[0-9]+[\.0-9]*"), 0)).alias("ref_text"))


def nearby_captions(segments: DataFrame, doc: str = "file_id", reach: int = 3) -> DataFrame:
    """Blocks with ``caption_segment_id``: the nearest caption on their page of the ``reach`` rows before them, else of those
    after them; blocks without one are left out."""
    w = Window.partitionBy(doc).orderBy("pos")
    rows = segments.withColumn("__c", F.struct("segment_id", "page", tx.caption(F.coalesce("text", F.lit(""))).isNotNull().alias("is_caption")))
    near = F.array(*[F.lag("__c", k).over(w) for k in range(1, reach + 1)], *[F.lead("__c", k).over(w) for k in range(1, reach + 1)])
    hit = F.filter(near, lambda c: F.coalesce(c["is_caption"] & (c["page"] == F.col("page")), F.lit(False)))
    rows = rows.withColumn("caption_segment_id", F.try_element_at(hit, F.lit(1))["segment_id"]).drop("__c")
    return rows.filter(F.col("type").isin("Table", "Picture", "Formula") & F.col("caption_segment_id").isNotNull())


def resolve(found: DataFrame, catalog: DataFrame, pages: DataFrame, doc: str = "file_id") -> DataFrame:
    """Mentions with target_segment_id and confidence. ``found`` has doc and page of the mention's chunk.

    Explicit ones meet the catalog by caption id, implicit ones the first (below: the last) block of their kind on
    the page.
    """
    rows = found.withColumn("caption_id", F.when(F.col("ref_kind") == "explicit", F.concat_ws(" ", "target_type", "ref_id")))
    rows = rows.join(catalog.select(doc, "caption_id", F.col("segment_id").alias("__e")), [doc, "caption_id"], "left")
    rows = rows.join(pages.withColumnRenamed("kind", "target_type"), [doc, "page", "target_type"], "left")
    place = F.when(F.col("ref_kind") == "implicit", F.when(F.col("direction") == "below", F.col("last_id")).otherwise(F.col("first_id")))
    rows = rows.withColumn("target_segment_id", F.coalesce("__e", place))
    hit = F.col("target_segment_id").isNotNull()
    sure = F.when(F.col("ref_kind") == "explicit", F.when(hit, 0.95).otherwise(0.5)).otherwise(F.when(hit, 0.7).otherwise(0.3))
    return rows.withColumn("confidence", sure).drop("__e", "first_id", "last_id", "caption_id")


def bond_records(pairs: DataFrame) -> DataFrame:
    """One record for a caption, its block and the notes between them. ``pairs``: caption and block (structs of segment_id,
    type, text, page, bbox, heading_path) and notes (an array of such, or null).

    type, text (caption and notes, in lines), segment_id (the block's), bonded_segment_ids, page (the first), page_range,
    bbox (the block's), heading_path (the caption's), caption_text.
    """
    notes = F.coalesce(F.col("notes"), F.filter(F.array(F.col("block")), lambda x: F.lit(False)))
    clean = lambda c: F.trim(F.coalesce(c, F.lit("")))
    lines = F.filter(F.transform(notes, lambda x: clean(x["text"])), lambda t: t != "")
    pages = F.array_sort(F.array_distinct(F.transform(F.concat(F.array(F.col("caption"), F.col("block")), notes), lambda x: F.coalesce(x["page"], F.lit(0)))))
    ids = F.concat(F.array("caption.segment_id", "block.segment_id"), F.transform(notes, lambda x: x["segment_id"]))
    return pairs.withColumns({
        "type": F.col("block.type"), "text": F.array_join(F.concat(F.array(clean(F.col("caption.text"))), lines), "\n"), "segment_id": F.col("block.segment_id"), "bonded_segment_ids": F.filter(ids, lambda x: F.coalesce(x != "", F.lit(False))),
        "page": F.array_min(pages), "page_range": pages, "bbox": F.col("block.bbox"), "heading_path": F.col("caption.heading_path"), "caption_text": clean(F.col("caption.text")),
    })
