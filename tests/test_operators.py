"""Operators against plain loops and hand-made cases."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from strataline.config import CANONICAL
from strataline.functions import text as tx
from strataline.operators import chunking, continuation, graph, layout, toc, vectors
from strataline.operators.stack import parent_path, with_stack_path
from strataline.sources import tables as src
from strataline.streaming.files import stream_chunks

SCHEMA = "file_id long, segment_id string, pos int, type string, text string, page int, bbox array<double>, depth int, level int, column_index int, at_page_top boolean, at_page_bottom boolean, heading_path string"


def seg(pos, kind, text, page=1, path="A", level=None, bbox=None, col=-1, top=False, bottom=False, doc=1):
    return (doc, f"seg_{pos + 1:04d}", pos, kind, text, page, bbox, 1, level, col, top, bottom, path)


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first().x


def test_stack_equals_a_loop(spark):
    rnd = random.Random(3)
    rows, want = [], {}
    for doc in range(60):
        stack = []
        for pos in range(rnd.randint(1, 25)):
            header = rnd.random() < 0.5
            level, text = rnd.randint(1, 5), rnd.choice(["a", "b", "c", "", None])
            if header:
                while stack and stack[-1][0] >= level:
                    stack.pop()
                if text:
                    stack.append((level, text))
            rows.append((doc, pos, header, level, text))
            want[doc, pos] = " > ".join(t for _, t in stack)
    df = spark.createDataFrame(rows, "doc int, pos int, header boolean, level int, text string")
    got = with_stack_path(df, "doc", [F.col("pos")], F.col("header"), F.col("level"), F.col("text")).collect()
    assert {(r.doc, r.pos): r.path for r in got} == want


def test_parent_path(spark):
    assert one(spark, "a > b > c", parent_path) == "a > b" and one(spark, "a", parent_path) is None


@pytest.mark.parametrize("text,want", [("The value of", True), ("The result is 5.", False), ("it is, of:", True), ("", False), (None, False)])
def test_open_clause(spark, text, want):
    assert one(spark, text, tx.ends_with_open_clause) is want


@pytest.mark.parametrize("text,want", [("measure-", False), ("measur-", True), ("self-", True), ("a-", True), ("word", False), (None, False), ("", False)])
def test_hyphen(spark, text, want):
    assert one(spark, text, tx.ends_with_hyphen) is want


@pytest.mark.parametrize("text,want", [("Figure 3.7 The lakes", "Figure 3.7"), ("Figure 3.7 shows the lakes", None), ("Table 1.1 Depth", "Table 1.1"), ("Tbl. 4", "Table 4"), ("Equation (5)", "Equation 5"), ("plain", None), (None, None), ("Table 2 " + "x " * 41, None)])
def test_caption(spark, text, want):
    c = one(spark, text, tx.caption)
    assert (c.full_caption_id if c else None) == want


def test_scalars_of_null_and_long_texts(spark):
    df = spark.createDataFrame([(None,), ("",), ("word " * 200_000,)], "t string")
    out = df.select(tx.style_hints(F.col("t"), F.lit("Text")).alias("h"), tx.word_count(F.col("t")).alias("n"), tx.tags(F.col("t")).alias("g"), tx.sentences(F.col("t")).alias("s")).collect()
    assert sorted(r.n for r in out) == [0, 0, 200_000] and out[0].h.word_count == 0


def test_roles(spark):
    cases = {"For example, a lake.": "example", "Thus it holds here.": "conclusion", "Is it deep enough here?": "question", "See Figure 3 for more of it.": "reference", "Ok.": "irrelevant", "The depth is defined as the distance down.": "definition", "The lake lies still there.": "explanation"}
    df = spark.createDataFrame([(k,) for k in cases], "t string").withColumn("g", tx.tags(F.col("t")))
    imp = tx.is_imperative(F.col("t"))
    got = {r.t: r.r for r in df.select("t", tx.role(F.col("t"), F.lit("A"), F.col("g"), tx.sentence_form(F.col("t"), imp), imp, F.lit("explanation")).alias("r")).collect()}
    assert got == cases


def test_continuation_over_a_page(spark):
    rows = [seg(0, "Paragraph", "the volume of", 1, bottom=True), seg(1, "Header", "(continued)", 2), seg(2, "Paragraph", "water that flows.", 2, top=True), seg(3, "Paragraph", "Next one.", 4), seg(4, "Table", "x", 5), seg(5, "Text", None, None)]
    got = {r.pos: (r.is_continuation, round(r.score, 3)) for r in continuation.annotate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[2][0] == "full" and got[3][0] == "none" and got[4][0] == "none" and got[5][0] == "none"


@pytest.mark.parametrize("a,b,left,right", [("a measure-", "ment, and more", "a measurement", "and more"), ("a measure-", "ment.", "a measurement.", ""), ("end", "of it", "end", "of it"), ("a -", "b", "a -", "b"), ("x-", "9 y", "x-", "9 y")])
def test_merge_hyphenated(spark, a, b, left, right):
    r = spark.createDataFrame([(a, b)], "a string, b string").select(continuation.merge_hyphenated(F.col("a"), F.col("b")).alias("m")).first().m
    assert (r.left, r.right) == (left, right)


def deck():
    rows = [
        seg(0, "Header", "Chapter 1 Rivers", level=1), seg(1, "Paragraph", "Explain how rivers form in hills"), seg(2, "ListItem", "one"), seg(3, "ListItem", "two"), seg(4, "Paragraph", "A body of text that ends."),
        seg(5, "Paragraph", "Table 1.1 Depth", bbox=[0.0, 100.0, 200.0, 120.0]), seg(6, "Table", "1 2 3", bbox=[0.0, 130.0, 200.0, 200.0]), seg(7, "Formula", "x = y"), seg(8, "Formula", "y = z"), seg(9, "Paragraph", "Theorem 1 It holds."), seg(10, "Paragraph", "So it does."),
    ]
    return rows


def test_fold_places_every_segment_once(spark):
    df = continuation.annotate(spark.createDataFrame(deck(), SCHEMA)).drop("prev", "skipped", "rules")
    placed = chunking.place(chunking.fold_columns(df)).orderBy("pos").collect()
    assert [r.pos for r in placed] == list(range(11))
    numbers = [r.chunk_no for r in placed]
    assert numbers == sorted(numbers)
    by = {}
    for r in placed:
        by.setdefault(r.chunk_no, []).append(r.pos)
    groups = list(by.values())
    assert [0] in groups and [4, 5, 6] in groups and [7, 8] in groups and [9, 10] in groups
    out = {r.chunk_no: r for r in chunking.assemble(df, chunking.place(chunking.fold_columns(df))).collect()}
    kinds = {tuple(r.source_segments): r.chunk_type for r in out.values()}
    assert kinds["seg_0005", "seg_0006", "seg_0007"] == "table" and kinds["seg_0008", "seg_0009"] == "formula" and kinds["seg_0001",] == "header"


def test_fold_state_is_per_document_and_caps_buffers(spark):
    rows = [seg(i, "Paragraph", f"Sentence {i}.", doc=d) for d in (1, 2) for i in range(40)]
    df = continuation.annotate(spark.createDataFrame(rows, SCHEMA)).drop("prev", "skipped", "rules")
    placed = chunking.place(chunking.fold_columns(df)).collect()
    sizes = {}
    for r in placed:
        sizes[r.file_id, r.chunk_no] = sizes.get((r.file_id, r.chunk_no), 0) + 1
    assert sorted(sizes.values()) == [10, 10, 15, 15, 15, 15] and min(k[1] for k in sizes) == 1


def test_merge_short_takes_pairs_from_the_left(spark):
    rows = [(1, i, "explanation", "A", 10, "w " * 10, [], ["s"], 1, False, "none", False) for i in range(1, 6)] + [(1, 6, "header", "A", 1, "h", [], ["s"], 1, False, "none", False)]
    df = spark.createDataFrame(rows, "file_id int, chunk_no int, chunk_type string, heading_path string, word_count int, content string, tags array<string>, source_segments array<string>, last_page int, is_cross_page boolean, continuation_type string, needs_review boolean")
    out = chunking.merged_chunks(df).orderBy("chunk_no").collect()
    assert [(r.chunk_no, r.word_count) for r in out] == [(1, 20), (3, 20), (5, 10), (6, 1)]


def test_reading_order_and_furniture(spark):
    rows = [seg(0, "Paragraph", "right", bbox=[400.0, 700.0, 590.0, 720.0]), seg(1, "Paragraph", "left low", bbox=[20.0, 300.0, 250.0, 320.0]), seg(2, "Paragraph", "left high", bbox=[20.0, 600.0, 250.0, 620.0]), seg(3, "Paragraph", "no box")]
    got = [r.text for r in layout.reading_order(spark.createDataFrame(rows, SCHEMA)).orderBy("new_pos").collect()]
    assert got == ["no box", "left high", "left low", "right"]
    rows = [seg(i, "Paragraph", "River notes", page=i + 1, bbox=[100.0, 780.0, 300.0, 790.0]) for i in range(12)] + [seg(20, "Paragraph", "Page 7", page=3), seg(21, "Paragraph", "Body text here.", page=3), seg(22, "Paragraph", "River notes", page=3, bbox=[100.0, 400.0, 300.0, 420.0])]
    marked = {r.pos for r in layout.mark_furniture(spark.createDataFrame(rows, SCHEMA)).filter("is_furniture").collect()}
    assert marked == {*range(12), 20, 22}


def test_section_map_and_gold_path(spark):
    entries = [(1, "toc_0001", 1, "Preface", "ii"), (1, "toc_0002", 1, "Chapter 1 Rivers", "5"), (1, "toc_0003", 2, "1.1 Sources", "7"), (1, "toc_0004", 1, "Glossary", "120"), (1, "toc_0005", 1, "Index", "130")]
    t = spark.createDataFrame(entries, "file_id long, entry_id string, level int, title string, page string").withColumn("ord", F.substring("entry_id", 5, 4).cast("int")).withColumn("page_no", F.expr("try_cast(page as int)"))
    m = toc.section_map(t).first()
    assert (m.body_start, m.back_start, m.glossary_start, m.glossary_end) == (5, 120, 120, 129)
    s = spark.createDataFrame([seg(0, "Text", "x", page=p) for p in (1, 6, 8, 125)], SCHEMA)
    got = sorted((r.page, r.gold_path) for r in toc.gold_paths(s, t).collect())
    assert got == [(1, ""), (6, "Chapter 1 Rivers"), (8, "Chapter 1 Rivers > 1.1 Sources"), (125, "Glossary")]


def test_glossary_items(spark):
    rows = [seg(0, "Text", "Glossary"), seg(1, "Text", "Delta: a landform"), seg(2, "Text", "Meander"), seg(3, "Text", "A bend of a river that grows."), seg(4, "Text", "Weir")]
    got = sorted((r.term, r.definition) for r in toc.glossary_items(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("Delta", "a landform"), ("Meander", "A bend of a river that grows.")]


def test_edges(spark):
    rows = [(1, "c1", 1, "header", "A"), (1, "c2", 2, "explanation", "A"), (1, "c3", 3, "header", "A > B"), (1, "c4", 4, "list", "A > B")]
    df = spark.createDataFrame(rows, "file_id int, chunk_id string, chunk_no int, chunk_type string, heading_path string")
    got = {(r.src, r.dst, r.edge_type) for r in graph.edges(df).collect()}
    assert got == {("c1", "c2", "next"), ("c2", "c3", "next"), ("c3", "c4", "next"), ("c2", "c1", "part_of"), ("c3", "c1", "part_of"), ("c4", "c3", "part_of")}


def test_coherence_of_null_vectors_and_single_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [3.0, 4.0]), (3, [0.0, 0.0]), (3, [1.0, 1.0])]
    got = {r.g: round(r.coherence, 6) for r in vectors.coherence(spark.createDataFrame(rows, "g int, v array<double>"), "g", "v").collect()}
    assert got == {1: 0.0, 2: 1.0, 3: 0.0}


def test_empty_tables(spark):
    e = spark.createDataFrame([], SCHEMA)
    a = continuation.annotate(e).drop("prev", "skipped", "rules")
    assert chunking.place(chunking.fold_columns(a)).count() == 0
    assert layout.mark_furniture(e).count() == 0 and layout.reading_order(e).count() == 0


def test_stream_of_documents(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    doc = Row(metadata={"source_file": "a.pdf"}, full_markdown="", flat_segments=[])
    import json

    segs = [{"segment_id": f"seg_{i + 1:04d}", "type": "Header" if i == 0 else "Paragraph", "text": f"Text {i}.", "page": 1, "depth": 1, "level": 1 if i == 0 else None, "heading_path": "A", "column_index": -1} for i in range(3)]
    (inbox / "a.json").write_text(json.dumps({"metadata": dict(doc.metadata), "full_markdown": "", "flat_segments": segs}))
    assert src.parsed_documents(spark, str(inbox)).count() == 3
    stream_chunks(spark, str(inbox), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).orderBy("chunk_no").collect()
    assert [r.chunk_type for r in out] == ["header", "explanation"] and CANONICAL.max_buffer == 15


def test_latest_takes_the_last_delivery(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, None, 1), (2, None, 1)], "k int, v string, ingested_at int")
    assert sorted((r.k, r.v) for r in src.latest(df, ["k"]).collect()) == [(1, "b"), (2, None)]
