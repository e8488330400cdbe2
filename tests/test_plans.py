"""Whole plans over small hand-made documents."""

import random
import re

from pyspark.sql import functions as F

from strataline.operators import chunking, continuation
from strataline.plans import pipeline
from strataline.plans.queries import QUERIES
from test_operators import SCHEMA, seg

TOC = "file_id long, ord int, level int, title string, page string, page_no int"


def contents(spark, *rows):
    return spark.createDataFrame([(1, i, level, title, str(page), page) for i, (level, title, page) in enumerate(rows, 1)], TOC)


def test_chunks_by_their_contents(spark):
    rows = [
        seg(0, "Paragraph", "A word of thanks to all who helped us with it.", page=1), seg(1, "Header", "Chapter 1 Rivers", page=3, level=1), seg(2, "Paragraph", "The river is defined as a stream of water. For example, the Weir.", page=3),
        seg(3, "Header", "Appendix", page=120, level=1), seg(4, "Paragraph", "A table of measures that we used.", page=120), seg(5, "Header", "Glossary", page=130, level=1), seg(6, "Paragraph", "Delta: a landform", page=130), seg(7, "Paragraph", "Weir: a low dam", page=131),
    ]
    toc = contents(spark, (1, "Chapter 1 Rivers", 3), (2, "1.1 Sources", 3), (1, "Appendix", 120), (1, "Glossary", 130))
    out = pipeline.chunks(spark.createDataFrame(rows, SCHEMA), toc).orderBy("chunk_no").collect()
    got = [(r.chunk_type, r.doc_zone, r.heading_path, r.content) for r in out]
    assert got == [
        ("front_matter", "front", "", "A word of thanks to all who helped us with it."), ("header", "body", "Chapter 1 Rivers > 1.1 Sources", "Chapter 1 Rivers"),
        ("definition", "body", "Chapter 1 Rivers > 1.1 Sources", "The river is defined as a stream of water. For example, the Weir."), ("back_matter", "back", "Appendix", "Appendix"),
        ("back_matter", "back", "Appendix", "A table of measures that we used."), ("definition", "body", "Glossary", "Delta: a landform"), ("definition", "body", "Glossary", "Weir: a low dam"),
    ]
    assert [s.role for s in out[1].sentences] == ["topic"] and [s.role for s in out[2].sentences] == ["definition", "example"]
    assert [r.source_segments for r in out[5:]] == [["seg_0007"], ["seg_0008"]] and [r.chunk_id for r in out[-2:]] == ["chunk_0006", "chunk_0007"]


def test_chunks_without_contents_keep_types(spark):
    out = pipeline.chunks(spark.createDataFrame([seg(0, "Header", "Rivers", level=1), seg(1, "Paragraph", "A body of text that ends.")], SCHEMA)).orderBy("chunk_no").collect()
    assert [(r.chunk_type, r.doc_zone, r.heading_path) for r in out] == [("header", "body", "Rivers"), ("explanation", "body", "Rivers")]


def test_paths_of_the_markdown(spark):
    rows = [seg(0, "Header", "Printed by the press, page 1", level=1), seg(1, "Header", "Sources of rivers", level=2), seg(2, "Paragraph", "Water rises there.")]
    headings = spark.createDataFrame([(1, 0, 1, "All about the rivers"), (1, 4, 2, "Sources of rivers")], "file_id long, pos int, level int, title string")
    got = {r.text: r.heading_path for r in pipeline.corrected_segments(spark.createDataFrame(rows, SCHEMA), headings=headings).collect()}
    assert got["Sources of rivers"] == "Printed by the press, page 1 > Sources of rivers"
    headings = headings.union(headings.sparkSession.createDataFrame([(1, 2, 1, "All about the rivers of the whole wide land")], headings.schema))
    got = {r.text: r.heading_path for r in pipeline.corrected_segments(spark.createDataFrame(rows, SCHEMA), headings=headings).collect()}
    assert got["Sources of rivers"] == "All about the rivers of the whole wide land > Sources of rivers"


def test_objectives_take_their_lists(spark):
    kinds = [("learning_objective", "After studying this you will know it.", "A"), ("list", "Explain how rivers form there", "A"), ("list", "Describe what a weir does", "A"), ("list", "Compare a lake and a river", "A"), ("explanation", "Short text.", "A"), ("explanation", "Another text.", "B")]
    rows = [(1, i, k, t, p, len(t.split()), [], [f"s{i}"], [(t, "x")], [float(i), 0.0, 9.0, 9.0]) for i, (k, t, p) in enumerate(kinds, 1)]
    df = spark.createDataFrame(rows, "file_id long, chunk_no int, chunk_type string, content string, heading_path string, word_count int, tags array<string>, source_segments array<string>, sentences array<struct<text:string,role:string>>, bbox array<double>")
    out = chunking.join_objectives(df).orderBy("chunk_no").collect()
    assert [(r.chunk_no, r.chunk_type, r.source_segments) for r in out] == [(1, "learning_objective", ["s1", "s2", "s3"]), (4, "learning_objective", ["s4", "s5"]), (6, "explanation", ["s6"])]
    assert out[0].content == "\n".join(t for _, t, _ in kinds[:3]) and out[0].word_count == 17 and len(out[0].sentences) == 3 and out[0].bbox[0] == 1.0
    assert df.sparkSession is spark and out[2].content == "Another text." and chunking.join_objectives(df.filter(F.lit(False))).count() == 0


def test_graph_has_references(spark, tmp_path):
    at = "timestamp'2025-01-01'"
    spark.sql(f"""select * from values (1L, 'c1', 1, 'explanation', 'A', 'As Table 1.1 and again Table 1.1 says.', array('s1'), array(1, 1), {at}), (1L, 'c2', 2, 'table', 'A', 'Table 1.1 Depth', array('s2', 's3'), array(2, 2), {at}),
      (1L, 'c3', 3, 'explanation', 'A', 'Table 9.9 is nowhere.', array('s4'), array(2, 2), {at}), (2L, 'd1', 1, 'explanation', 'A', 'See Table 1.1 of another file.', array('s1'), array(1, 1), {at})
      as t(file_id, chunk_id, chunk_no, chunk_type, heading_path, content, source_segments, page_range, ingested_at)""").write.parquet(str(tmp_path / "chunks.parquet"))
    spark.sql(f"select * from values (1L, 's1', 0, 'Text', 'As Table 1.1 and again Table 1.1 says.', 1, {at}), (1L, 's2', 1, 'Text', 'Table 1.1 Depth', 2, {at}), (1L, 's3', 2, 'Table', '1 2', 2, {at}), (1L, 's4', 3, 'Text', 'Table 9.9 is nowhere.', 2, {at}), (2L, 's1', 0, 'Text', 'x', 1, {at}) as t(file_id, segment_id, pos, type, text, page, ingested_at)").write.parquet(str(tmp_path / "flat_segments.parquet"))
    got = sorted((r.file_id, r.src, r.dst, r.edge_type) for r in QUERIES["graph_k10_with_references"](spark, str(tmp_path)).filter("file_id > 0").collect())
    assert got == [(1, "c1", "c2", "next"), (1, "c1", "c2", "references"), (1, "c2", "c3", "next")]


def test_embedding_plan_joins_words_and_fills_paths(spark):
    rows = [seg(0, "Paragraph", "before any heading.", bbox=[50.0, 700.0, 500.0, 710.0]), seg(1, "Header", "Rivers", bbox=[50.0, 600.0, 500.0, 610.0]), seg(2, "Paragraph", "The thin mem-", bbox=[50.0, 500.0, 500.0, 510.0]), seg(3, "Paragraph", "brane holds.", page=2, bbox=[50.0, 600.0, 500.0, 610.0])]
    out = pipeline.embedding_chunks(spark.createDataFrame(rows, SCHEMA)).orderBy("chunk_no").collect()
    assert {r.heading_path for r in out} == {"Rivers"}
    assert "The thin membrane [PAGE_JOIN] holds." in out[-1].content


def test_join_words_equals_a_loop(spark):
    r = random.Random(5)
    rows, want = [], {}
    for doc in range(80):
        texts = [r.choice(["mem-", "bra- ", "ne", "a-", "one two-", "three four", "", None, " six\u2013", "x\u2012", "\u2014", "-", "foo-bar-", "end."]) for _ in range(12)]
        marks = [None] + [r.choice(["full", "partial", "none"]) for _ in texts[1:]]
        rows += [(doc, i, t, m) for i, (t, m) in enumerate(zip(texts, marks))]
        texts = list(texts)
        for i in range(1, 12):
            a, b = texts[i - 1], texts[i]
            if marks[i] not in ("full", "partial") or not a or not b or not a.rstrip() or a.rstrip()[-1] not in "-\u2010\u2011\u2012\u2013\u2014":
                continue
            one, two = re.search(r"(\w+)[-\u2010\u2011\u2212\u2013\u2014]\s*$", a), re.match(r"\w+", b.lstrip())
            if one and two and len(one[1] + two[0]) >= 3:
                texts[i - 1], texts[i] = a[: one.start()] + one[1] + two[0], b.lstrip()[two.end() :].lstrip()
        want.update({(doc, i): t for i, t in enumerate(texts)})
    df = spark.createDataFrame(rows, "file_id int, pos int, text string, is_continuation string")
    got = {(x.file_id, x.pos): x.text for x in continuation.join_words(df).collect()}
    assert got == want
