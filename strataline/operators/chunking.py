"""Segments to chunks: the ordered fold, chunk assembly, and the passes after it.

Everything that a rule asks of a row or its neighbours is a column first (``fold_columns``). What is left is a fold
over each document in reading order. It streams: rows are sorted within partitions by document, and the fold keeps
the open buffer and three rows of look-ahead, so memory doesn't grow with a document's length.
"""

from __future__ import annotations

from collections import deque, namedtuple
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.config import CANONICAL, Profile
from strataline.functions import text as tx
from strataline.operators.continuation import merge_hyphenated, noise_header

BLOCKS = ("Table", "Picture", "Formula")
FITS = {"Table": BLOCKS, "Figure": BLOCKS, "Exhibit": BLOCKS, "Equation": ("Formula", "Picture")}
#: What the fold reads of a row.
NEEDED = ["pos", "type", "heading_path", "page", "column_index", "bbox", "is_continuation", "noise", "objective", "caption_type", "open_end", "small", "theorem", "number"]


#: Columns that only the fold reads.
FOLDED = ("noise", "objective", "caption_type", "open_end", "small", "theorem", "number")
Row = namedtuple("Row", ["row", *NEEDED])


def fold_columns(df: DataFrame) -> DataFrame:
    """The columns that the fold reads. Needs ``is_continuation``."""
    t = F.coalesce(F.col("text"), F.lit(""))
    return df.select(
        "*", noise_header(t, F.col("type")).alias("noise"), tx.is_objective(t).alias("objective"), tx.caption(t)["target_type"].alias("caption_type"),
        ((t != "") & ~tx.has_terminal_mark(t)).alias("open_end"), (tx.word_count(t) < 50).alias("small"), t.rlike("(?i)^(?:Theorem|Lemma|Proposition|Corollary|Proof)").alias("theorem"),
        F.regexp_extract("segment_id", r"(\d+)", 1).cast("int").alias("number"),
    )


class Fold:
    """The rules over one document. ``feed`` takes rows in order; ``close`` ends it; both give placed rows:
    (row, chunk_no, path, kind, cross_page, continuation, bonded)."""

    def __init__(self, p: Profile = CANONICAL):
        self.p = p
        self.buffer: list = []
        self.no = 0
        self.path = self.title_path = ""
        self.cross, self.kind = False, "none"
        self.last: tuple[str | None, str] = (None, "")
        self.out: list[tuple] = []

    def emit(self, rows: list, path: str, kind: str | None = None, bonded: bool = False, state: bool = False) -> None:
        if not rows:
            return
        if not (kind == "formula" and self.last == ("formula", path)):
            self.no += 1
        self.last = (kind, path)
        cross, cont = (self.cross, self.kind) if state else (False, "none")
        self.out += [(r.row, self.no, path, kind, cross, cont, bonded) for r in rows]

    def flush(self, kind: str | None = None) -> None:
        self.emit(self.buffer, self.path, kind, state=True)
        self.buffer, self.cross, self.kind = [], False, "none"

    def row(self, r, ahead: list) -> None:
        p, kind, path = self.p, r.type, r.heading_path or ""
        tail = self.buffer[-1] if self.buffer else None
        if tail is not None and p.merge_guard and not (p.rich_rules and tail.open_end):
            columns = r.column_index != -1 and tail.column_index != -1 and r.column_index != tail.column_index
            far = r.number is not None and tail.number is not None and abs(r.number - tail.number) > p.id_gap
            if (columns and (r.page == tail.page or not p.rich_rules)) or far:
                self.flush()
                tail = None
        inferred = r.objective and kind == "Paragraph" and p.rich_rules
        if inferred:
            kind = "LearningObjective"
        if r.is_continuation in ("full", "partial"):
            self.cross = True
            self.kind = "partial" if r.is_continuation == "partial" or self.kind == "partial" else "full"
            self.buffer.append(r)
            if len(self.buffer) >= 2 * p.max_buffer:
                self.flush()
            return
        if kind == "Header":
            self.heading(r, path, ahead)
            return
        if kind in ("Formula", "Equation") and p.rich_rules:
            self.flush()
            self.emit([r], path, "formula")
            return
        if kind == "ListItem":
            adsorbs = tail is not None and (tail.type in ("LearningObjective", "Header") or (tail.objective and tail.type == "Paragraph"))
            if not (p.rich_rules and adsorbs and path == self.path) and tail is not None and tail.type != "ListItem":
                self.flush()
            self.buffer.append(r)
            return
        if tail is not None and tail.type == "ListItem":
            self.flush("list")
            tail = None
        if kind in BLOCKS:
            self.block(r, kind, path)
            return
        if kind == "LearningObjective":
            if tail is not None and (tail.type != "LearningObjective" or (tail.heading_path or "") != path):
                self.flush()
            if not self.buffer:
                self.path = path
            self.buffer.append(r)
            return
        if tail is not None and tail.type == "LearningObjective":
            if p.rich_rules and kind == "Paragraph" and r.small and path == self.path:
                self.buffer.append(r)
                return
            self.flush("learning_objective")
        if r.theorem:
            self.flush()
            self.buffer.append(r)
            return
        self.buffer.append(r)
        if kind in ("Paragraph", "Text") and isinstance(r.caption_type, str):
            return
        if len(self.buffer) >= p.max_buffer and not (p.rich_rules and r.open_end):
            following = next((x for x in ahead if not x.noise), None)
            if following is None or following.is_continuation not in ("full", "partial"):
                self.flush()

    def heading(self, r, path: str, ahead: list) -> None:
        if r.noise or isinstance(r.caption_type, str):
            self.buffer.append(r)
            return
        if self.buffer:
            if self.p.rich_rules and ahead and ahead[0].is_continuation in ("full", "partial"):
                self.buffer.append(r)
                return
            self.flush()
        self.path = self.title_path = path
        self.emit([r], path, "header")

    def block(self, r, kind: str, path: str) -> None:
        captions = [x for x in self.buffer if isinstance(x.caption_type, str)]
        caption = captions[-1] if captions else None
        notes = [x for x in self.buffer if x not in captions and x.type in ("Header", "Paragraph", "Text")]
        others = [x for x in self.buffer if x not in captions and x not in notes]
        own = kind.lower()
        if others:
            self.emit(others, self.path, state=True)
        if caption is None:
            self.emit(notes, self.path)
            self.emit([r], path, own)
        else:
            fits = kind == caption.caption_type or kind in FITS.get(caption.caption_type, ())
            if fits and (not self.p.rich_rules or self.close_by(caption.bbox, r.bbox)):
                self.emit([*captions, *notes, r], self.title_path or self.path, own, bonded=True)
            else:
                self.emit([*captions, *notes], self.path)
                self.emit([r], path, own)
        self.buffer, self.cross, self.kind = [], False, "none"

    def close_by(self, a, b) -> bool:
        if a is None or b is None or len(a) < 4 or len(b) < 4:
            return True
        gap = b[1] - a[3] if a[3] <= b[1] else a[1] - b[3] if b[3] <= a[1] else 0.0
        scale = self.p.page_height if max(*a, *b) > 1.0 else 1.0
        shared, narrow = max(0.0, min(a[2], b[2]) - max(a[0], b[0])), min(a[2] - a[0], b[2] - b[0])
        return gap / scale <= self.p.caption_distance and shared > 0 and (shared / narrow if narrow > 0 else 0.0) >= self.p.caption_overlap

    def taken(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


PLACED = "chunk_no int, chunk_path string, forced_type string, is_cross_page boolean, continuation_type string, bonded boolean"


def place(df: DataFrame, doc: str = "file_id", p: Profile = CANONICAL) -> DataFrame:
    """(doc, pos, chunk_no, chunk_path, forced_type, is_cross_page, continuation_type, bonded) of every segment.

    One shuffle, by document, of the columns that the rules read; no text.
    """
    return place_rows(df.select(doc, *NEEDED).repartition(doc), doc, p).select(doc, "pos", *[x.split()[0] for x in PLACED.split(", ")])


def place_rows(df: DataFrame, doc: str = "file_id", p: Profile = CANONICAL) -> DataFrame:
    """``df`` (with ``fold_columns``, in the partitions of its documents) and the columns of PLACED.

    Rows pass through in order as Arrow batches; the fold looks at the columns that the rules read. A batch goes on when
    its last row is placed, which is a buffer and three rows later at most, so few are held.
    """
    at = df.sortWithinPartitions(doc, "pos")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", " + PLACED
    added = [x.split() for x in PLACED.split(", ")]
    kinds = {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, doc_now, begun, ahead = Fold(p), None, False, deque()
        held: deque[tuple[pa.RecordBatch, int]] = deque()
        placed: dict[int, tuple] = {}
        seen = 0

        def drain(all_of_it: bool) -> None:
            while ahead and (all_of_it or len(ahead) > 3):
                r = ahead.popleft()
                fold.row(r, list(ahead)[:3])
            if all_of_it:
                fold.flush()
            for row, *values in fold.taken():
                placed[row] = tuple(values)

        def ready() -> Iterator[pa.RecordBatch]:
            while held and all(held[0][1] + i in placed for i in range(held[0][0].num_rows - 1, -1, -1)):
                batch, first = held.popleft()
                rows = [placed.pop(first + i) for i in range(batch.num_rows)]
                arrays = [pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(added)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *[n for n, _ in added]])

        for batch in batches:
            held.append((batch, seen))
            columns = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (doc, *NEEDED)}
            for i in range(batch.num_rows):
                key = columns[doc][i]
                if not begun or key != doc_now:
                    if begun:
                        drain(True)
                    fold, doc_now, begun = Fold(p), key, True
                ahead.append(Row(seen + i, *[columns[c][i] for c in NEEDED]))
                if len(ahead) > 3:
                    drain(False)
            seen += batch.num_rows
            yield from ready()
        drain(True)
        yield from ready()

    return at.mapInArrow(run, schema)


def infer_type(forced: Column, all_list: Column, all_objective: Column, tags: Column) -> Column:
    out = F.when(forced.isNotNull(), forced).when(all_list, "list").when(all_objective, "learning_objective")
    for t in ("theorem", "proof", "definition", "procedure", "example", "exercise", "formula", "summary"):
        out = out.when(F.array_contains(tags, t), t)
    return out.otherwise("explanation")


def infer_type_legacy(all_list: Column, all_objective: Column, tags: Column, imperative_share: Column, objectives: bool = True) -> Column:
    """The older profiles' type of a chunk: where half of the sentences or more tell to do something it is a procedure, after
    theorems and proofs. ``objectives``: whether a chunk of objectives alone is one."""
    out = F.when(all_list, "list")
    if objectives:
        out = out.when(all_objective, "learning_objective")
    out = out.when(F.array_contains(tags, "theorem"), "theorem").when(F.array_contains(tags, "proof"), "proof").when(F.coalesce(imperative_share >= 0.5, F.lit(False)), "procedure")
    for t in ("definition", "procedure", "example", "exercise", "formula", "summary"):
        out = out.when(F.array_contains(tags, t), t)
    return out.otherwise("explanation")


def type_by_roles(roles: Column) -> Column:
    """The embedding profile's type from the roles of a chunk's sentences: example, question or definition if any is one,
    else the commonest (ties: the first seen); without sentences an explanation."""
    counted = F.transform(F.array_distinct(roles), lambda r: F.struct(F.size(F.filter(roles, lambda x: x == r)).alias("n"), (-F.array_position(roles, r)).alias("at"), r.alias("r")))
    most = F.array_max(counted)["r"]
    out = F.when(F.size(roles) == 0, "explanation")
    for r in ("example", "question", "definition"):
        out = out.when(F.array_contains(roles, r), r)
    return out.otherwise(most)


def join_parts(parts: Column) -> Column:
    """Texts joined by spaces, words broken between them put together."""

    def step(done: Column, x: Column) -> Column:
        m = merge_hyphenated(F.element_at(done, -1), x)
        head = F.slice(done, 1, F.size(done) - 1)
        return F.when(m["right"] == "", F.concat(head, F.array(m["left"]))).otherwise(F.concat(head, F.array(m["left"], m["right"])))

    folded = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), F.slice(parts, 1, 1), step)
    return F.trim(F.array_join(F.when(F.exists(parts, lambda x: x.rlike(r"[-‐‑–—]\s*$")), folded).otherwise(parts), " "))


def assemble(segments: DataFrame, placed: DataFrame, doc: str = "file_id") -> DataFrame:
    """Chunks of segments and their places (``place``)."""
    return assemble_rows(placed.join(segments, [doc, "pos"]), doc)


def assemble_rows(rows: DataFrame, doc: str = "file_id") -> DataFrame:
    """Chunks: content, type, tags, segments, pages, words, boxes, and why rows were merged. A chunk has at most some dozen
    segments, so its lists are bounded. ``rows``: segments with the columns of PLACED (and is_furniture, score, rules,
    prev_id, if known)."""
    known = lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    furniture = F.coalesce(known("is_furniture", "boolean"), F.lit(False))
    t = F.trim(F.coalesce("text", F.lit("")))
    parts = F.collect_list(F.when((t != "") & ~furniture, F.struct("pos", t.alias("t"))))
    boxed = ~furniture & (F.size("bbox") >= 4)
    box = F.collect_list(F.when(boxed, F.struct(F.coalesce("page", F.lit(0)).alias("page"), F.col("bbox").alias("b"))))
    joins = F.col("is_continuation").isin("full", "partial") if "is_continuation" in rows.columns else F.lit(False)
    detail = F.struct("pos", known("prev_id", "string").alias("from"), F.col("segment_id").alias("to"), F.round(known("score", "double"), 3).alias("score"), known("is_continuation", "string").alias("decision"), known("rules", "array<string>").alias("contributing_factors"))
    g = rows.groupBy(doc, "chunk_no").agg(
        parts.alias("parts"), F.collect_list(F.struct("pos", "segment_id")).alias("ids"), F.min("page").alias("first_page"), F.max("page").alias("last_page"),
        F.min_by("depth", "pos").alias("depth"), F.first("chunk_path").alias("heading_path"), F.first("forced_type").alias("forced"), F.first("is_cross_page").alias("is_cross_page"),
        F.first("continuation_type").alias("continuation_type"), F.first("bonded").alias("bonded"), F.bool_and(F.col("type") == "ListItem").alias("all_list"),
        F.bool_and(F.col("type") == "LearningObjective").alias("all_objective"), box.alias("boxes"), F.array_sort(F.collect_list(F.when(joins, detail))).alias("joins"),
    )
    content = F.when(F.col("forced") == "formula", F.lit("[FORMULA PLACEHOLDER]")).otherwise(join_parts(F.transform(F.array_sort("parts"), lambda s: s["t"])))
    g = g.withColumn("content", content).withColumn("tags", tx.tags(F.col("content")))
    g = g.withColumn("tags", F.when(tx.is_imperative(F.col("content")) & ~F.array_contains("tags", "procedure"), F.concat("tags", F.array(F.lit("procedure")))).otherwise(F.col("tags")))
    by_page = boxes_by_page(F.filter("boxes", lambda x: x["page"] > 0))
    return g.select(
        doc, "chunk_no", "heading_path", infer_type(F.col("forced"), F.col("all_list"), F.col("all_objective"), F.col("tags")).alias("chunk_type"), "content", "tags",
        F.transform(F.array_sort("ids"), lambda s: s["segment_id"]).alias("source_segments"), "first_page", "last_page", "depth", tx.word_count(F.col("content")).alias("word_count"),
        "is_cross_page", "continuation_type", (F.col("continuation_type") == "partial").alias("needs_review"), evidence_of(F.col("joins")).alias("merge_evidence"), "bonded",
        F.when(F.size("boxes") > 0, box_round(F.transform("boxes", lambda x: x["b"]))).alias("bbox"), by_page.alias("page_bboxes"),
    )


def box_round(boxes: Column) -> Column:
    """The box round an array of boxes."""
    edge = lambda k: F.transform(boxes, lambda b: b[k])
    return F.array(F.array_min(edge(0)), F.array_min(edge(1)), F.array_max(edge(2)), F.array_max(edge(3)))


def boxes_by_page(boxes: Column) -> Column:
    """The box round an array's boxes of each page, as a map; ``boxes``: (page, b)."""
    pages = F.array_sort(F.array_distinct(F.transform(boxes, lambda x: x["page"])))
    return F.map_from_entries(F.transform(pages, lambda n: F.struct(n, box_round(F.transform(F.filter(boxes, lambda x: x["page"] == n), lambda x: x["b"])))))


def evidence_of(joins: Column, top: int = 5) -> Column:
    """Why the rows of a chunk were merged: how many joins, their mean score, the commonest rules (ties by name) and each
    join; null where there are none."""
    every = F.flatten(F.transform(joins, lambda x: x["contributing_factors"]))
    counted = F.transform(F.array_distinct(every), lambda r: F.struct((-F.size(F.filter(every, lambda x: x == r))).alias("n"), r.alias("rule")))
    named = F.transform(F.slice(F.array_sort(counted), 1, top), lambda x: F.concat(x["rule"], F.lit(": "), (-x["n"]).cast("string"), F.lit("x")))
    mean = F.round(F.aggregate(joins, F.lit(0.0), lambda s, x: s + x["score"]) / F.size(joins), 3)
    return F.when(F.size(joins) > 0, F.struct(F.size(joins).alias("merge_count"), mean.alias("avg_confidence"), named.alias("key_indicators"), F.transform(joins, lambda x: x.dropFields("pos")).alias("details")))


def bond_captions(chunks: DataFrame, doc: str = "file_id", reach: int = 3) -> DataFrame:
    """Captions left alone join the nearest block without one: of the three before, else of the three after, on the same
    or a neighbouring page. One block takes one caption, the earliest. The caption's text stands before the block's.

    Two passes over the order of a document, no join: each caption finds its block, then each block the captions
    within reach that found it. Captions of one block lie within twice the reach of each other.
    """
    w = Window.partitionBy(doc).orderBy("chunk_no")
    block = F.col("chunk_type").isin("table", "picture", "formula") & ~F.coalesce(F.col("bonded"), F.lit(False))
    orphan = F.col("chunk_type").isin("explanation", "header") & tx.caption(F.split(F.col("content"), "\n")[0]).isNotNull()
    rows = chunks.withColumn("__i", F.struct("chunk_no", "first_page", "last_page", block.alias("block"))).withColumn("__orphan", F.coalesce(orphan, F.lit(False)))
    around = [F.lag("__i", k).over(w) for k in range(1, reach + 1)] + [F.lead("__i", k).over(w) for k in range(1, reach + 1)]
    rows = rows.withColumn("__near", F.array(*around))
    fits = lambda c: F.coalesce(c["block"] & (c["first_page"] <= F.col("last_page") + 1) & (c["last_page"] >= F.col("first_page") - 1), F.lit(False))
    target = F.try_element_at(F.transform(F.filter("__near", fits), lambda c: c["chunk_no"]), F.lit(1))
    rows = rows.withColumn("__target", F.when(F.col("__orphan"), target)).drop("__i", "__near", "__orphan")
    earlier = [F.lag("__target", k).over(w) for k in range(1, 2 * reach + 1)]
    offer = F.when(F.col("__target").isNotNull(), F.struct("__target", "chunk_no", "content", "source_segments"))
    rows = rows.withColumn("__offer", offer).withColumn("__taken", F.array_contains(F.array_compact(F.array(*earlier)), F.col("__target")))
    offers = [F.lag("__offer", k).over(w) for k in range(reach, 0, -1)] + [F.lead("__offer", k).over(w) for k in range(1, reach + 1)]
    rows = rows.withColumn("__offers", F.array(*offers))
    mine = F.try_element_at(F.filter("__offers", lambda o: F.coalesce(o["__target"] == F.col("chunk_no"), F.lit(False))), F.lit(1))
    rows = rows.withColumn("c", mine).filter(F.col("__target").isNull() | F.col("__taken"))
    has = F.col("c").isNotNull()
    text = F.when(has, F.concat_ws("\n", F.col("c.content"), F.when(F.col("content") != "", F.col("content")))).otherwise(F.col("content"))
    return (
        rows.withColumn("source_segments", F.when(has, F.concat("source_segments", "c.source_segments")).otherwise(F.col("source_segments")))
        .withColumn("content", text).withColumn("bonded", F.coalesce(F.col("bonded"), F.lit(False)) | has).drop("c", "__target", "__offer", "__offers", "__taken")
    )


def context_overlap(chunks: DataFrame, doc: str = "file_id", p: Profile = CANONICAL) -> DataFrame:
    """``context_prefix``: the last sentences of the chunk before, where neither is a heading, picture or table."""
    w = Window.partitionBy(doc).orderBy("chunk_no")
    barred = ["header", "picture", "table"]
    rows = chunks.withColumn("__p", F.lag(F.when(~F.col("chunk_type").isin(*barred) & (F.col("content") != ""), tx.last_sentences(F.col("content"), p.overlap))).over(w))
    give = ~F.col("chunk_type").isin(*barred) & (tx.word_count(F.col("__p")) > 5)
    return rows.withColumn("context_prefix", F.when(give, F.concat(F.lit("[Previous context: "), F.col("__p"), F.lit("]")))).drop("__p")


def merge_short(chunks: DataFrame, doc: str = "file_id", p: Profile = CANONICAL) -> DataFrame:
    """Short chunks join the next one under the same heading, in pairs from the left: in a run of chunks that could each
    join the next, the odd ones do. Adds ``merged_no`` (the pair's first number) and ``is_head``."""
    w = Window.partitionBy(doc).orderBy("chunk_no")
    kind, path, size = (F.lead(c).over(w) for c in ("chunk_type", "heading_path", "word_count"))
    can = ~F.col("chunk_type").isin("header", "picture", "table", "list", "formula") & (F.col("word_count") < p.short_words) & path.eqNullSafe(F.col("heading_path")) & kind.isin("explanation", "example") & (F.col("word_count") + size < p.max_words)
    rows = chunks.withColumn("__i", F.row_number().over(w)).withColumn("__can", F.coalesce(can, F.lit(False)))
    rows = rows.withColumn("__run", F.when(F.col("__can"), F.col("__i") - F.row_number().over(Window.partitionBy(doc, "__can").orderBy("chunk_no"))))
    odd = F.row_number().over(Window.partitionBy(doc, "__can", "__run").orderBy("chunk_no")) % 2 == 1
    rows = rows.withColumn("starts_pair", F.col("__can") & odd)
    second = F.coalesce(F.lag("starts_pair").over(w), F.lit(False))
    rows = rows.withColumn("is_head", ~second).withColumn("merged_no", F.when(second, F.lag("chunk_no").over(w)).otherwise(F.col("chunk_no")))
    return rows.drop("__i", "__can", "__run")


def merged_chunks(chunks: DataFrame, doc: str = "file_id", p: Profile = CANONICAL) -> DataFrame:
    """The chunks after ``merge_short``. A pair loses continuation flags, as a new chunk does."""
    rows = merge_short(chunks, doc, p)
    w = Window.partitionBy(doc).orderBy("chunk_no")
    extra = [c for c in ("sentences", "doc_zone") if c in chunks.columns]
    nxt = F.lead(F.struct("content", "tags", "source_segments", "last_page", *extra)).over(w)
    rows = rows.withColumn("__n", nxt).filter("is_head")
    pair = F.col("starts_pair")
    tags = F.array_sort(F.array_distinct(F.concat("tags", "__n.tags")))
    kind = infer_type(F.lit(None).cast("string"), F.lit(False), F.lit(False), tags)
    content = F.concat_ws(" ", "content", "__n.content")
    out = rows.withColumn("chunk_type", F.when(pair, kind).otherwise(F.col("chunk_type"))).withColumn("word_count", F.when(pair, tx.word_count(content)).otherwise(F.col("word_count")))
    out = out.withColumn("source_segments", F.when(pair, F.concat("source_segments", "__n.source_segments")).otherwise(F.col("source_segments")))
    out = out.withColumn("last_page", F.when(pair, F.greatest("last_page", "__n.last_page")).otherwise(F.col("last_page")))
    if "sentences" in extra:
        out = out.withColumn("sentences", F.when(pair, F.concat("sentences", "__n.sentences")).otherwise(F.col("sentences")))
    if "doc_zone" in extra:
        out = out.withColumn("doc_zone", F.when(pair, "body").otherwise(F.col("doc_zone")))
    lost = [("is_cross_page", F.lit(False)), ("continuation_type", F.lit("none")), ("needs_review", F.lit(False))]
    lost += [(c, F.lit(None).cast(chunks.schema[c].dataType)) for c in ("merge_evidence", "page_bboxes", "bbox") if c in chunks.columns]
    if "mentions" in chunks.columns:
        lost.append(("mentions", F.filter("mentions", lambda m: F.lit(False))))
    for c, empty in lost:
        out = out.withColumn(c, F.when(pair, empty).otherwise(F.col(c)))
    out = out.withColumn("tags", F.when(pair, tags).otherwise(F.col("tags"))).withColumn("content", F.when(pair, content).otherwise(F.col("content")))
    return out.drop("__n", "starts_pair", "is_head", "merged_no")


def regroup_objectives(chunks: DataFrame, doc: str = "file_id") -> DataFrame:
    """``objective_no``: the objective chunk that a list or a short explanation after it (within two) joins, under the
    same heading; its own number for all others.

    From the left: one that has joined takes none itself, even if it reads like an objective, as lists of them do.
    After two chunks that are none nobody is waiting to take, so only stretches of closer ones are folded, by their flags.
    """
    w = Window.partitionBy(doc).orderBy("chunk_no")
    lead = F.coalesce((F.col("chunk_type") == "learning_objective") | tx.is_objective(F.split(F.col("content"), "\n")[0]), F.lit(False))
    joins = (F.col("chunk_type") == "list") | ((F.col("chunk_type") == "explanation") & (F.col("word_count") < 100))
    after = F.coalesce(joins, F.lit(False)) & F.lag("heading_path").over(w).eqNullSafe(F.col("heading_path")) & F.lag("chunk_no").over(w).isNotNull()
    rows = chunks.withColumn("__lead", lead).withColumn("__after", after)
    near = F.coalesce(F.lag("__lead", 1).over(w), F.lit(False)) | F.coalesce(F.lag("__lead", 2).over(w), F.lit(False))
    rows = rows.withColumn("__on", F.col("__after") & near).withColumn("__run", F.sum(F.when(F.col("__on"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    flags = F.collect_list("__lead").over(Window.partitionBy(doc, "__run").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, 0))

    def step(s: Column, x: Column) -> Column:
        taken = s["left"] > 0
        return F.struct(F.when(taken, s["left"] - 1).when(x, 2).otherwise(0).alias("left"), F.when(taken, s["back"] + 1).otherwise(0).alias("back"))

    back = F.aggregate(flags, F.struct(F.lit(0).alias("left"), F.lit(0).alias("back")), step)["back"]
    rows = rows.withColumn("__back", back)
    no = F.when(F.col("__back") == 1, F.lag("chunk_no", 1).over(w)).when(F.col("__back") == 2, F.lag("chunk_no", 2).over(w)).otherwise(F.col("chunk_no"))
    return rows.withColumn("objective_no", no).drop("__lead", "__after", "__on", "__run", "__back")


def join_objectives(chunks: DataFrame, doc: str = "file_id") -> DataFrame:
    """The chunks after ``regroup_objectives``: an objective and the up to two that join it are one, of its pages."""
    w = Window.partitionBy(doc).orderBy("chunk_no")
    rows = regroup_objectives(chunks, doc)
    paged = ["__pages"] if "page_bboxes" in chunks.columns else []
    if paged:  # as entries, since maps can't be compared
        rows = rows.withColumn("__pages", F.transform(F.map_entries("page_bboxes"), lambda e: F.struct(e["key"].alias("page"), e["value"].alias("b"))))
    part = F.struct("objective_no", "content", "tags", "source_segments", "sentences", "bbox", *paged)
    rows = rows.withColumn("__n", F.array(F.lead(part, 1).over(w), F.lead(part, 2).over(w))).filter("objective_no = chunk_no")
    rows = rows.withColumn("__n", F.filter("__n", lambda x: F.coalesce(x["objective_no"] == F.col("chunk_no"), F.lit(False))))
    has, every = F.size("__n") > 0, lambda c: F.flatten(F.transform("__n", lambda x: x[c]))
    content = F.array_join(F.concat(F.array("content"), F.transform("__n", lambda x: x["content"])), "\n")
    boxes = F.array_compact(F.concat(F.array("bbox"), F.transform("__n", lambda x: x["bbox"])))
    box = box_round(boxes)
    new = {
        "content": content, "tags": F.array_sort(F.array_distinct(F.concat("tags", every("tags")))), "source_segments": F.concat("source_segments", every("source_segments")),
        "sentences": F.concat("sentences", every("sentences")), "chunk_type": F.lit("learning_objective"), "word_count": tx.word_count(content), "bbox": F.when(F.size(boxes) > 0, box),
    }
    if paged:
        new["page_bboxes"] = boxes_by_page(F.flatten(F.array_compact(F.concat(F.array("__pages"), F.transform("__n", lambda x: x["__pages"])))))
    return rows.withColumns({k: F.when(has, c).otherwise(F.col(k)) for k, c in new.items()}).drop("__n", "__pages", "objective_no")


def known_sentences(content: Column) -> Column:
    """Sentences of a text with what their roles go by: text, tags, imp."""
    return F.transform(tx.sentences(F.coalesce(content, F.lit(""))), lambda s: F.struct(s.alias("text"), tx.tags(s).alias("tags"), tx.is_imperative(s).alias("imp")))


def roles_of(known: Column, path: Column, kind: Column) -> Column:
    """Sentences with their roles, in order; a heading's are topics. Explanations under five words join the sentence before,
    unless it is irrelevant."""
    given = lambda x: tx.role(x["text"], path, x["tags"], tx.sentence_form(x["text"], x["imp"]), x["imp"], kind)
    all_of_it = F.transform(known, lambda x: F.struct(x["text"].alias("text"), F.coalesce(tx.forced_role(kind, F.lit(False)), given(x)).alias("role")))

    def step(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joins = F.coalesce((x["role"] == "explanation") & (tx.word_count(x["text"]) < 5) & (last["role"] != "irrelevant"), F.lit(False))
        both = F.struct(F.concat_ws(" ", last["text"], x["text"]).alias("text"), last["role"].alias("role"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(both))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(all_of_it, F.array().cast("array<struct<text:string,role:string>>"), step)


def tag_union(content: Column) -> Column:
    """The tags of a text and of its sentences, each once, by name."""
    each = F.flatten(F.transform(tx.sentences(F.coalesce(content, F.lit(""))), lambda s: tx.tags(s)))
    return F.array_sort(F.array_distinct(F.concat(tx.tags(F.coalesce(content, F.lit(""))), each)))


def with_roles(chunks: DataFrame, kind: str = "chunk_type") -> DataFrame:
    """``sentences``: (text, role) of each sentence of a chunk; ``kind`` is the type that the roles go by. The tags of the
    sentences join the chunk's."""
    rows = chunks.withColumn("__known", known_sentences(F.col("content")))
    tags = F.array_sort(F.array_union("tags", F.flatten(F.transform("__known", lambda x: x["tags"]))))
    return rows.withColumns({"sentences": roles_of(F.col("__known"), F.col("heading_path"), F.col(kind)), "tags": tags}).drop("__known")


def group_adjacent(df: DataFrame, doc: str = "file_id", order: str = "pos", similarity: Column | None = None, threshold: float = 0.5, cap: int | None = 5) -> DataFrame:
    """The embedding profile's grouping: ``chunk_no`` and ``split_reason`` (why the chunk ends before this row; "none" inside).

    Breaks at changes of path (unless the row continues) and of sidebar or its type, at blocks, and where similarity is low.
    A row that doesn't continue begins a new chunk when the open one has ``cap`` rows, those that continue among them.
    Without continuations that is arithmetic inside each island; with them a fold over flags (``capped``).
    """
    w = Window.partitionBy(doc).orderBy(order)
    lag = lambda c: F.lag(c).over(w)
    cont = F.coalesce(F.col("is_continuation").isin("full", "partial"), F.lit(False)) if "is_continuation" in df.columns else F.lit(False)
    blocks = F.col("type").isin(*BLOCKS)
    rows = df.withColumn("__path", lag("heading_path")).withColumn("__kind", lag("type")).withColumn("__i", F.row_number().over(w)).withColumn("__cont", cont)
    reason = F.when((F.col("__i") > 1) & ~F.col("__cont") & ~F.col("heading_path").eqNullSafe(F.col("__path")), "heading_change")
    if "is_sidebar" in df.columns:
        rows = rows.withColumn("__side", lag("is_sidebar"))
        reason = reason.when((F.col("__i") > 1) & ~F.col("is_sidebar").eqNullSafe(F.col("__side")), "sidebar_isolation")
    if "sidebar_type" in df.columns:
        rows = rows.withColumn("__side_type", lag("sidebar_type"))
        reason = reason.when((F.col("__i") > 1) & F.col("is_sidebar") & ~F.col("sidebar_type").eqNullSafe(F.col("__side_type")), "sidebar_type_change")
    reason = reason.when((F.col("__i") > 1) & ~F.col("__cont") & blocks, F.concat(F.lit("structure_"), F.lower("type"), F.lit("_start")))
    reason = reason.when((F.col("__i") > 1) & ~F.col("__cont") & F.col("__kind").isin(*BLOCKS), F.concat(F.lit("structure_"), F.lower("__kind"), F.lit("_end")))
    if similarity is not None:
        reason = reason.when((F.col("__i") > 1) & ~F.col("__cont") & (similarity < threshold), "semantic_break")
    rows = rows.withColumn("split_reason", reason)
    rows = rows.withColumn("__island", F.sum(F.when(F.col("split_reason").isNotNull(), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    if cap and "is_continuation" in df.columns:
        rows = rows.join(capped(rows, doc, order, cap), [doc, order], "left")
        rows = rows.withColumn("split_reason", F.coalesce("split_reason", F.when(F.col("__capped"), "max_buffer"))).drop("__capped")
    elif cap:
        inside = Window.partitionBy(doc, "__island").orderBy(order)
        rows = rows.withColumn("__n", F.row_number().over(inside) - 1)
        rows = rows.withColumn("split_reason", F.coalesce("split_reason", F.when((F.col("__n") > 0) & (F.col("__n") % cap == 0), "max_buffer"))).drop("__n")
    cut = F.when(F.col("split_reason").isNotNull(), 1).otherwise(0)
    rows = rows.withColumn("chunk_no", F.sum(cut).over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1)
    return rows.withColumn("split_reason", F.coalesce("split_reason", F.lit("none"))).drop("__path", "__kind", "__i", "__cont", "__side", "__side_type", "__island")


def capped(rows: DataFrame, doc: str, order: str, cap: int) -> DataFrame:
    """(doc, order, __capped): rows at which the cap ends a chunk. ``rows``: split_reason (not null: a break before the row)
    and __cont. One shuffle of flags by document; the fold streams and keeps one number."""
    flags = rows.select(doc, order, F.col("split_reason").isNotNull().alias("hard"), "__cont").repartition(doc).sortWithinPartitions(doc, order)
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, size, begun = None, 0, False
        for pdf in batches:
            out = []
            for d, hard, cont in zip(pdf[doc].tolist(), pdf["hard"].tolist(), pdf["__cont"].tolist()):
                if not begun or d != at:
                    at, size, begun = d, 0, True
                    cut = False
                else:
                    cut = not hard and not cont and size >= cap
                    size = 0 if hard or cut else size
                size += 1
                out.append(cut)
            found = pdf[out]
            if len(found):
                yield found[[doc, order]].assign(__capped=True)

    return flags.mapInPandas(run, f"`{doc}` {kinds[doc]}, `{order}` {kinds[order]}, __capped boolean")


def page_boxes(segments: DataFrame, placed: DataFrame, doc: str = "file_id") -> DataFrame:
    """(doc, chunk_no, page, x0, y0, x1, y1): the box round a chunk's segments on each page."""
    rows = placed.join(segments.select(doc, "pos", "page", "bbox"), [doc, "pos"]).filter((F.size("bbox") >= 4) & F.col("page").isNotNull())
    b = F.col("bbox")
    return rows.groupBy(doc, "chunk_no", "page").agg(F.min(b[0]).alias("x0"), F.min(b[1]).alias("y0"), F.max(b[2]).alias("x1"), F.max(b[3]).alias("y1"))


def dominant_zone(rows: DataFrame, keys: list[str], zone: str = "doc_zone", order: str = "pos") -> DataFrame:
    """(keys, doc_zone): the commonest zone (ties: the one seen first); body where none is stated."""
    z = F.coalesce(zone, F.lit("body"))
    counts = rows.groupBy(*keys, z.alias("z")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("at"))
    return counts.groupBy(*keys).agg(F.max_by("z", F.struct("n", -F.col("at"))).alias("doc_zone"))


def without_front_matter(chunks: DataFrame) -> DataFrame:
    """Chunks but those of the front matter; one without a zone is body."""
    return chunks.filter(F.coalesce("doc_zone", F.lit("body")) != "front")


def order_stats(after: DataFrame, doc: str = "file_id") -> DataFrame:
    """(doc, moved, pages_reordered): segments that a reordering moved, and on how many pages. ``after`` has ``new_pos``."""
    page = F.coalesce("page", F.lit(1))
    rank = F.row_number().over(Window.partitionBy(doc, page).orderBy("pos"))
    new = F.row_number().over(Window.partitionBy(doc, page).orderBy("new_pos"))
    rows = after.withColumn("a", rank).withColumn("b", new).withColumn("p", page)
    return rows.groupBy(doc).agg(F.count_if(F.col("a") != F.col("b")).alias("moved"), F.count_distinct(F.when(F.col("a") != F.col("b"), F.col("p"))).alias("pages_reordered"))
