"""End-to-end plans: parsed segments to chunks, edges and metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataline.config import CANONICAL, EMBEDDING, Profile
from strataline.functions import lexicon as lx
from strataline.functions import plugins
from strataline.functions import text as tx
from strataline.operators import chunking, continuation, graph, layout, references, toc, vectors
from strataline.operators.stack import with_stack_path
from strataline.sources.tables import settled


def corrected_segments(segments: DataFrame, entries: DataFrame | None = None, doc: str = "file_id", p: Profile = CANONICAL, headings: DataFrame | None = None) -> DataFrame:
    """Segments after header authority, continuation, furniture, reading order, heading paths, backfill, the paths of
    the contents (T6) and those of the markdown (T13).

    Continuation is judged on the raw order, before reordering; the rest on the corrected one, as ``pos``.
    ``headings``: doc, pos, level, title of the markdown's headings, where there is markdown.
    """
    # furniture first: its counts read the segments themselves, not what the later steps make of them
    rows = layout.mark_furniture(segments, doc, p)
    if entries is not None:
        rows = toc.enforce_headers(rows, entries, doc).drop("type").withColumnRenamed("new_type", "type")
    rows = continuation.annotate(rows, doc, p).withColumn("prev_id", F.col("prev.segment_id")).drop("prev", "skipped")
    rows = rows.withColumn("priority", F.col("is_continuation") != "none")
    rows = layout.reading_order(rows, doc, p).drop("pos", "column_index", "priority").withColumnRenamed("new_pos", "pos").withColumnRenamed("new_column", "column_index")
    header = (F.col("type") == "Header") & ~F.col("is_furniture")
    rows = with_stack_path(rows, doc, [F.col("pos")], header, F.col("level"), F.col("text"))
    rows = layout.backfill(rows.drop("heading_path").withColumnRenamed("path", "heading_path"), doc)
    rows = rows.drop("heading_path").withColumnRenamed("backfilled_path", "heading_path")
    if entries is not None:
        seeded = toc.seed_path(F.col("gold_path"), F.col("heading_path"))
        rows = toc.gold_paths(rows, entries, doc).withColumn("heading_path", seeded).drop("gold_path")
    return rows if headings is None else toc.align(rows, toc.logic_book(headings, doc), doc)


def zoned(out: DataFrame, sections: DataFrame, doc: str = "file_id") -> DataFrame:
    """Chunks with ``doc_zone`` by their first page, and the types of the zones (T14): front matter but for headings,
    all of the back matter."""
    rows = out.drop("doc_zone").join(sections, doc, "left")
    zone = F.coalesce(toc.zone(F.col("first_page"), F.col("body_start"), F.col("back_start")), F.lit("body"))
    rows = rows.withColumn("doc_zone", zone)
    glossary = F.coalesce(F.col("first_page").between(F.col("glossary_start"), F.col("glossary_end")), F.lit(False))
    kind = F.when((F.col("doc_zone") == "front") & (F.col("chunk_type") != "header"), "front_matter").when(F.col("doc_zone") == "back", F.when(glossary, "glossary").otherwise("back_matter"))
    return rows.withColumn("chunk_type", kind.otherwise(F.col("chunk_type"))).select(*out.columns)


def with_glossary(out: DataFrame, items_of: DataFrame, doc: str = "file_id") -> DataFrame:
    """Chunks, and after them one definition for each item of the glossary's pages (K9), numbered on. ``items_of``: the
    segments of these pages.

    Its content is "term: definition"; the rule that this follows leaves it empty. Lines are read by page and height.
    """
    rows = items_of.withColumn("__at", F.struct(F.col("page"), F.coalesce(F.col("bbox")[1], F.lit(0.0)).alias("y"), F.col("pos")))
    items = toc.glossary_entries(rows, doc, "__at").withColumn("content", F.concat_ws(": ", "term", "definition"))
    n = F.row_number().over(Window.partitionBy(doc).orderBy("at"))
    tags = tx.tags(F.col("content"))
    given = {
        "__n": n, "heading_path": F.lit("Glossary"), "chunk_type": F.lit("definition"), "__kind": F.lit("definition"), "content": F.col("content"), "source_segments": F.col("segment_ids"), "first_page": F.col("at.page"), "last_page": F.col("at.page"),
        "tags": F.when(tx.is_imperative(F.col("content")) & ~F.array_contains(tags, "procedure"), F.concat(tags, F.array(F.lit("procedure")))).otherwise(tags),
        "depth": F.lit(0), "word_count": tx.word_count(F.col("content")), "is_cross_page": F.lit(False), "continuation_type": F.lit("none"), "needs_review": F.lit(False), "bonded": F.lit(False), "doc_zone": F.lit("body"),
    }
    items = items.select(doc, *[c.alias(k) for k, c in given.items()])
    both = out.withColumn("__n", F.lit(0)).unionByName(items, allowMissingColumns=True).repartition(doc)
    last = F.coalesce(F.max("chunk_no").over(Window.partitionBy(doc)), F.lit(0))
    return both.withColumn("chunk_no", F.coalesce(F.col("chunk_no"), (last + F.col("__n")).cast("int"))).drop("__n")


def chunks(segments: DataFrame, entries: DataFrame | None = None, doc: str = "file_id", p: Profile = CANONICAL, headings: DataFrame | None = None) -> DataFrame:
    """Enriched chunks of parsed segments: the canonical plan.

    ``segments``: doc, segment_id, pos, type, text, page, bbox, depth, level, column_index, at_page_top,
    at_page_bottom, heading_path. Chunk ids restart in every document. With ``entries`` paths begin with those of the
    contents, chunks have the types of their zones, and the glossary's pages become definitions.
    """
    rows = corrected_segments(segments, entries, doc, p, headings)
    inside = F.lit(False)
    sections = None if entries is None else toc.section_map(entries, doc)
    if sections is not None:
        rows = rows.join(sections, doc, "left")
        inside = F.coalesce(F.coalesce("page", F.lit(0)).between(F.col("glossary_start"), F.col("glossary_end")), F.lit(False))
    # kept once, in the partitions of their documents, for the fold and for the glossary, whose rows aren't folded
    rows = settled(rows.withColumn("__glossary", inside))
    placed = chunking.place_rows(chunking.fold_columns(rows.filter(~F.col("__glossary"))), doc, p)
    out = chunking.assemble_rows(placed.drop(*chunking.FOLDED).repartition(doc), doc).withColumn("doc_zone", F.lit("body")).withColumn("__kind", F.col("chunk_type"))
    if sections is not None:
        out = with_glossary(zoned(out, sections, doc), rows.filter("__glossary"), doc)
    # roles go by the type that a chunk has before its zone's
    out = chunking.with_roles(out, "__kind").drop("__kind").withColumn("mentions", references.mentioned(F.coalesce("content", F.lit(""))))
    out = chunking.join_objectives(chunking.bond_captions(out, doc), doc)
    out = chunking.merged_chunks(chunking.context_overlap(out, doc, p), doc, p)
    return out.withColumn("chunk_id", F.format_string("chunk_%04d", "chunk_no"))


def chunk_references(out: DataFrame, segments: DataFrame, doc: str = "file_id") -> DataFrame:
    """References in chunks, resolved: doc, src, ref_kind, direction, target_type, ref_text, ref_id, start_offset, end_offset,
    target_segment_id, confidence. From ``mentions`` where the chunks have them, else from their contents."""
    rows = out.withColumn("page", F.coalesce("first_page", F.lit(0)))
    if "mentions" in out.columns:
        found = rows.select(doc, "chunk_id", "page", F.explode("mentions").alias("m")).select(doc, "chunk_id", "page", "m.*")
    else:
        found = references.mentions(rows, "chunk_id", "content", [doc, "page"])
    rows = references.resolve(found, references.block_catalog(segments, doc), references.page_blocks(segments, doc), doc)
    return rows.withColumnRenamed("chunk_id", "src")


def enriched_chunks(segments: DataFrame, entries: DataFrame | None = None, doc: str = "file_id", p: Profile = CANONICAL, headings: DataFrame | None = None) -> DataFrame:
    """The chunks with all fields of an enriched chunk: those of ``chunks`` and page_range, references (in the order of their
    places) and edges (dst, edge_type)."""
    out = settled(chunks(segments, entries, doc, p, headings))
    refs = settled(chunk_references(out.select(doc, "chunk_id", "first_page", "mentions"), segments, doc))
    links = graph.edges(out.select(doc, "chunk_id", "chunk_no", "chunk_type", "heading_path", "source_segments"), refs.filter("target_segment_id is not null").select(doc, "src", "target_segment_id"), doc)
    one = F.struct("start_offset", "end_offset", "ref_text", "target_segment_id", "target_type", "ref_kind", "confidence")
    refs = refs.groupBy(doc, "src").agg(F.array_sort(F.collect_list(one)).alias("references"))
    links = links.groupBy(doc, "src").agg(F.array_sort(F.collect_list(F.struct("edge_type", "dst"))).alias("edges"))
    side = refs.join(links, [doc, "src"], "full").withColumnRenamed("src", "chunk_id")
    pages = F.when(F.col("first_page").isNotNull(), F.array("first_page", "last_page"))
    return out.drop("mentions", "bonded").join(side, [doc, "chunk_id"], "left").withColumn("page_range", pages)


def chunk_graph(out: DataFrame, segments: DataFrame, doc: str = "file_id") -> DataFrame:
    refs = chunk_references(out, segments, doc).filter("target_segment_id is not null").select(doc, "src", "target_segment_id")
    return graph.edges(out, refs, doc)


def embedding_chunks(segments: DataFrame, doc: str = "file_id", p: Profile = EMBEDDING, encoder: Callable | None = None, prototypes: DataFrame | None = None) -> DataFrame:
    """Chunks of the embedding profile. ``encoder`` makes an encoder (``functions.plugins``); without one every similarity is
    0.5 and nothing breaks by it, and a chunk's coherence is 1. ``prototypes`` (role, proto) better the roles of sentences."""
    rows = layout.mark_furniture(segments, doc, p).filter(~F.col("is_furniture"))
    rows = layout.reading_order(layout.sidebars(rows, doc, p), doc, p).drop("pos", "priority", "new_column").withColumnRenamed("new_pos", "pos")
    rows = with_stack_path(rows, doc, [F.col("pos")], F.col("type") == "Header", F.col("depth"), F.col("text"), levels=None)
    rows = layout.backfill_empty(rows.drop("heading_path").withColumnRenamed("path", "heading_path"), doc)
    similarity = None
    if encoder is not None:
        w = Window.partitionBy(doc).orderBy("pos")
        ends = plugins.page_ends(F.col("text"), F.col("text"))
        rows = rows.withColumn("__head", plugins.vectors(ends[1], encoder)).withColumn("__tail", plugins.vectors(ends[0], encoder))
        rows = rows.withColumn("__similar", F.when(F.lag("__tail").over(w).isNotNull() & F.col("__head").isNotNull(), vectors.cross_page_similarity(F.lag("__tail").over(w), F.col("__head")))).drop("__head", "__tail")
        similarity = F.col("__similar")
    rows = continuation.join_words(continuation.annotate_adjacent(rows, doc, "pos", similarity=None if similarity is None else F.coalesce(similarity, F.lit(0.5)), p=p), doc)
    rows = chunking.group_adjacent(rows, doc, "pos", similarity=similarity, cap=p.max_buffer)
    t = F.concat(F.when(F.coalesce(F.col("is_continuation"), F.lit("none")) != "none", "[PAGE_JOIN] ").otherwise(""), F.coalesce("text", F.lit("")))
    g = rows.repartition(doc).groupBy(doc, "chunk_no").agg(
        F.array_sort(F.collect_list(F.struct("pos", t.alias("t")))).alias("parts"), F.min_by("heading_path", "pos").alias("heading_path"), F.bool_or("is_sidebar").alias("__side"), F.min_by("is_sidebar", "pos").alias("is_sidebar"),
        F.min_by("sidebar_type", "pos").alias("sidebar_type"), F.min_by("split_reason", "pos").alias("begin_reason"), F.min("page").alias("first_page"), F.max("page").alias("last_page"),
        F.collect_set("type").alias("types"),
    )
    # a chunk's reason is why it ends
    g = g.withColumn("split_reason", F.coalesce(F.lead("begin_reason").over(Window.partitionBy(doc).orderBy("chunk_no")), F.lit("none")))
    content = F.trim(F.regexp_replace(F.array_join(F.transform("parts", lambda s: s["t"]), " "), " +", " "))
    g = g.withColumn("content", F.regexp_replace(content, r"^\[PAGE_JOIN\] ", "")).withColumn("tags", tx.tags(F.col("content"), lx.TAGS_EMBEDDING, lines=False))
    g = g.withColumn("sentences", F.transform(tx.sentences(F.col("content")), lambda s: F.struct(s.alias("text"), tx.role_by_keywords(s).alias("role"))))
    g = g.withColumn("semantic_coherence", F.lit(1.0))
    if encoder is not None:
        g = refined(g, doc, encoder, prototypes)
    roles = F.transform("sentences", lambda s: s["role"])
    kind = F.when(F.col("__side"), F.when(F.col("sidebar_type") == "learning_objective", "learning_objective").otherwise("sidebar"))
    for name, k in (("Table", "table"), ("Picture", "picture"), ("Formula", "formula"), ("ListItem", "list")):
        kind = kind.when(F.array_contains("types", name), k)
    kind = kind.when(F.array_contains("tags", "definition"), "definition").when(F.array_contains("tags", "procedure"), "procedure")
    counts = F.map_from_entries(F.transform(F.array_distinct(roles), lambda r: F.struct(r, F.size(F.filter(roles, lambda x: x == r)))))
    return g.select(
        doc, "chunk_no", "heading_path", kind.otherwise(chunking.type_by_roles(roles)).alias("chunk_type"), "content", "sentences", "tags", "first_page", "last_page", "begin_reason", "split_reason",
        tx.word_count(F.col("content")).alias("word_count"), "semantic_coherence", "is_sidebar", "sidebar_type", counts.alias("role_distribution"),
    )


def refined(chunks: DataFrame, doc: str, encoder: Callable, prototypes: DataFrame | None = None) -> DataFrame:
    """Chunks whose sentences have roles bettered by prototypes, and the coherence of their sentences."""
    each = chunks.select(doc, "chunk_no", F.posexplode("sentences").alias("n", "s")).select(doc, "chunk_no", "n", "s.text", "s.role", plugins.vectors(F.col("s.text"), encoder).alias("v"))
    each = settled(each.withColumn("id", F.concat_ws(":", doc, "chunk_no", "n")).withColumn("chunk", F.concat_ws(":", doc, "chunk_no")))
    close = vectors.coherence(each, "chunk", "v").select("chunk", F.round("coherence", 3).alias("c"))
    if prototypes is not None:
        each = each.drop("role").join(vectors.refine_by_prototypes(each, "id", "v", prototypes, role="role").select("id", "role"), "id")
    told = each.groupBy("chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "text", "role"))), lambda s: F.struct(s["text"].alias("text"), s["role"].alias("role"))).alias("told"))
    rows = chunks.withColumn("chunk", F.concat_ws(":", doc, "chunk_no")).join(told, "chunk", "left").join(close, "chunk", "left")
    return rows.withColumn("sentences", F.coalesce("told", "sentences")).withColumn("semantic_coherence", F.coalesce("c", F.lit(1.0))).drop("chunk", "told", "c")
