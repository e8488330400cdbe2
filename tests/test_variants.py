"""Operators of the older profiles, plug-ins, and cases beyond the deck."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from strataline.functions import lexicon as lx
from strataline.functions import plugins
from strataline.functions import text as tx
from strataline.functions.patterns import needed
from strataline.operators import chunking, layout, toc, vectors
from strataline.operators.stack import with_stack_path
from strataline.plans import pipeline
from test_operators import SCHEMA, seg


def toy():
    """What makes a toy encoder: counts of the letters of a text."""
    return lambda: lambda texts: [[float(t.lower().count(c)) + 0.01 for c in "abcdefghijklmnopqrstuvwxyz"] for t in texts]


def test_plugins(spark):
    df = spark.createDataFrame([(1, "Aab"), (2, None), (3, " "), (4, "b")], "n int, t string")
    got = {r.n: r.v for r in df.select("n", plugins.vectors(F.col("t"), toy()).alias("v")).collect()}
    assert got[2] is None and got[3] is None and round(got[1][0]) == 2 and round(got[4][1]) == 1
    tagger = lambda: lambda texts: [[(w, "VERB", "VB", "ROOT") if i == 0 else (w, "NOUN", "NN", "obj") for i, w in enumerate(t.split())] for t in texts]
    rows = df.select("n", "t", plugins.tagged(F.col("t"), tagger).alias("w")).select("n", plugins.is_imperative(F.col("t"), F.col("w")).alias("x"), plugins.is_imperative(F.col("t")).alias("y"))
    assert [(r.n, r.x, r.y) for r in rows.orderBy("n").collect()] == [(1, True, False), (2, False, False), (3, False, False), (4, True, False)]
    found = df.select(plugins.has_entity(plugins.labels(F.col("t"), lambda: lambda texts: [["ORG"] if "b" in t else ["DATE"] for t in texts])).alias("e"), "n").orderBy("n").collect()
    assert [r.e for r in found] == [True, False, False, True]


def test_embedding_plan_with_an_encoder(spark):
    rows = [seg(0, "Paragraph", "aaaa aaa aaaa."), seg(1, "Paragraph", "aaa aa aaaa."), seg(2, "Paragraph", "Zzz zzzz zzzz?"), seg(3, "Paragraph", "Zzzz zzz zz.")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = pipeline.embedding_chunks(df, encoder=toy()).orderBy("chunk_no").collect()
    assert [(r.content.count("a") > 0, r.split_reason) for r in out] == [(True, "semantic_break"), (False, "none")]
    assert out[1].chunk_type == "question" and out[1].role_distribution == {"question": 1, "explanation": 1} and out[0].semantic_coherence > 0.9
    plain = pipeline.embedding_chunks(df).collect()
    assert len(plain) == 1 and plain[0].semantic_coherence == 1.0
    proto = spark.createDataFrame([("evidence", toy()()(["zzzz"])[0])], "role string, proto array<double>")
    roles = [s.role for r in pipeline.embedding_chunks(df, encoder=toy(), prototypes=proto).orderBy("chunk_no").collect() for s in r.sentences]
    assert roles == ["explanation", "explanation", "question", "evidence"]


def test_prototypes_in_blocks(spark):
    r = np.random.default_rng(5)
    protos = [(f"r{i % 7}", [float(x) for x in r.normal(size=4)]) for i in range(50)]
    rows = [(i, [float(x) for x in r.normal(size=4)]) for i in range(40)] + [(90, [0.0] * 4), (91, None)]
    df, lib = spark.createDataFrame(rows, "id int, v array<double>"), spark.createDataFrame(protos, "role string, proto array<double>")
    cos = lambda a, b: float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b))
    for block in (1000, 9):
        got = {x.id: (x.role, x.score) for x in vectors.refine_by_prototypes(df, "id", "v", lib, threshold=0.5, block=block).collect()}
        for i, v in rows[:40]:
            best, role = max((cos(v, p), k) for k, p in protos)
            assert got[i][1] == round(best, 3) and got[i][0] == (role if best >= 0.5 else None)
        assert got[90] == (None, 0.0) and got[91][0] is None


def test_levels_without_a_bound(spark):
    r = random.Random(4)
    rows = [(1, i, r.choice([1, 2, 5, 9, 30, None]), r.choice(["", "a", "b", "c"]) + str(i)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc int, pos int, level int, text string")
    got = {x.pos: x.path for x in with_stack_path(df, "doc", [F.col("pos")], F.col("level").isNotNull(), F.col("level"), F.col("text"), levels=None).collect()}
    stack = []
    for _, pos, level, text in rows:
        if level is not None:
            stack = [s for s in stack if s[0] < level] + [(level, text)]
        assert got[pos] == " > ".join(t for _, t in stack)


def test_cap_counts_rows_that_continue(spark):
    kinds = [None] * 4 + ["full"] * 3 + [None] * 6
    df = spark.createDataFrame([(1, i, "Paragraph", "A", k) for i, k in enumerate(kinds)] + [(None, 0, "Text", "B", None)], "file_id long, pos int, type string, heading_path string, is_continuation string")
    out = {(r.file_id, r.pos): r.chunk_no for r in chunking.group_adjacent(df).collect()}
    assert [out[1, i] for i in range(13)] == [1] * 7 + [2] * 5 + [3] and out[None, 0] == 1


def test_contents_keyword_on_a_late_page(spark):
    page = ["Contents", "Rivers .... 7", "Lakes .... 20", "Weirs .... 33"]
    rows = [seg(i, "Paragraph", f"line {'abcdefghijklmnopqrstu'[i]} of the preface.", page=1) for i in range(20)] + [seg(20 + i, "Paragraph", t, page=3) for i, t in enumerate(page)]
    got = toc.heuristic_entries(spark.createDataFrame(rows, SCHEMA)).orderBy("pos").collect()
    assert [(r.title, r.page) for r in got] == [("Rivers", "7"), ("Lakes", "20"), ("Weirs", "33")]
    far = [seg(0, "Paragraph", "x" * 1200, page=3)] + [seg(1 + i, "Paragraph", t, page=3) for i, t in enumerate(page)]
    assert toc.heuristic_entries(spark.createDataFrame(far, SCHEMA)).count() == 0


def test_look_up_against_a_loop(spark):
    r = random.Random(9)
    titles = ["the river weir of stones", "the river weir", "the river", "looms", "a very long heading of looms", "土"]
    book = [(d, "".join(c for c in t if c.isalnum() and c.isascii()), f"p{d}{i}", i) for d in (1, 2) for i, t in enumerate(r.sample(titles, 4))]
    texts = [(d, n, r.choice([*titles, "the", "", "the river weir of stones and more", "a very", "none of it", None])) for d in (1, 2) for n in range(40)]
    got = {(x.doc, x.pos): x.logic_path for x in toc.look_up(spark.createDataFrame(texts, "doc int, pos int, text string"), spark.createDataFrame(book, "doc int, norm string, path string, ord int"), "doc").collect()}
    for d, n, t in texts:
        norm = "".join(c for c in (t or "").lower() if c.isalnum() and c.isascii())
        mine = [b for b in book if b[0] == d]
        want = next((b[2] for b in mine if b[1] == norm), None)
        want = want or next((b[2] for b in sorted(mine, key=lambda b: b[3]) if len(b[1]) > 10 and (norm.startswith(b[1]) or b[1].startswith(norm))), None)
        assert got[d, n] == want, (d, t)


def test_required_strings_never_hide_a_match(spark):
    """Texts made of the patterns' own words: the pre-test and the bare pattern agree."""
    words = sorted({w for ps in lx.TAGS.values() for p in ps for w in (needed(p) or ())} | {"TABLE", "ſummary", "İn", "3", "%", "4.5", "FIGURE", "the", "of", "that"})
    r = random.Random(2)
    df = spark.createDataFrame([(i, " ".join(r.choice(words) + r.choice(["", "s", " 1", "."]) for _ in range(9))) for i in range(150)] + [(900, None)], "n int, t string")
    from strataline.functions.patterns import any_java

    bare = F.array_compact(F.array(*[F.when(F.col("t").rlike(any_java(p, "iumd")), F.lit(k)) for k, p in lx.TAGS.items()]))
    assert df.filter(~tx.tags(F.col("t")).eqNullSafe(bare)).count() == 0


def test_pages_of_furniture_count_once(spark):
    rows = [seg(i, "Text", "Rivers and Lakes", page=i // 2, bbox=[200.0, 760.0, 400.0, 780.0] if i < 6 else [50.0, 400.0, 560.0, 450.0]) for i in range(24)]
    got = layout.mark_furniture(spark.createDataFrame(rows, SCHEMA)).orderBy("pos").collect()
    assert [r.is_furniture for r in got] == [True] * 24
    few = layout.mark_furniture(spark.createDataFrame(rows[2:], SCHEMA)).collect()
    assert sum(r.is_furniture for r in few) == 4


def test_enriched_chunks_have_all_fields(spark):
    rows = [
        seg(0, "Header", "Rivers", level=1), seg(1, "Paragraph", "As Table 1.1 shows, the depth of the river is great and it depends on the volume of", bottom=True),
        seg(2, "Paragraph", "water that flows.", page=2, top=True), seg(3, "Header", "Depths", page=2, level=1), seg(4, "Table", "Table 1.1 Depth", page=2),
    ]
    out = {r.chunk_no: r for r in pipeline.enriched_chunks(spark.createDataFrame(rows, SCHEMA)).collect()}
    text = next(r for r in out.values() if r.content.startswith("As Table"))
    assert (text.references[0].ref_text, text.references[0].start_offset, text.references[0].end_offset, text.references[0].target_segment_id) == ("Table 1.1", 3, 12, "seg_0005")
    assert text.is_cross_page and text.merge_evidence.merge_count == 1 and text.merge_evidence.details[0]["to"] == "seg_0003" and text.page_range == [1, 2]
    assert {(e.edge_type, e.dst) for e in text.edges} == {("next", "chunk_0003"), ("part_of", "chunk_0001"), ("references", "chunk_0004")}
    assert isinstance(pd.DataFrame([text.asDict()]), pd.DataFrame) and out[1].references is None


def test_prototype_library_and_pdf_folder(spark, tmp_path):
    from strataline.sources import tables as src

    (tmp_path / "lib.json").write_text('{"version": "1", "prototypes": {"example": {"description": "d", "examples": ["For example, a loom.", "Such as felt."]}, "question": {"description": "q", "examples": []}}}')
    assert sorted(tuple(r) for r in src.role_prototypes(spark, str(tmp_path / "lib.json")).collect()) == [("example", "For example, a loom."), ("example", "Such as felt.")]
    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    (tmp_path / "b.txt").write_text("no")
    assert [r.path.split("/")[-1] for r in src.pdf_files(spark, str(tmp_path)).collect()] == ["a.pdf"]


def test_zones_and_glossary_of_late_contents(spark):
    assert toc.index_terms(spark.createDataFrame([seg(0, "Text", "Delta, 40")], SCHEMA)).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert toc.page_scores(empty).count() == 0 and toc.page_heads(empty).count() == 0
