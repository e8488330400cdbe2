"""A small hand-made library beside the tables, in which every rule has something to do; the same rows for SQL.

Natural text seldom holds what the rules ask for. The deck's documents have negative ids and are read together with the
tables, so each query covers both.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.sources import tables as src

LEFT, RIGHT, WIDE, TOP, FOOT, NARROW = [60.0, 300.0, 280.0, 340.0], [330.0, 300.0, 560.0, 340.0], [50.0, 400.0, 560.0, 450.0], [200.0, 760.0, 400.0, 780.0], [280.0, 20.0, 330.0, 40.0], [470.0, 300.0, 590.0, 340.0]
S = "file_id bigint, segment_id string, pos int, type string, text string, page int, bbox array<double>, depth int, heading_path string, tags array<string>, at_page_top boolean, at_page_bottom boolean, column_index int, level int, site string"
T = "file_id bigint, entry_id string, level int, title string, page string, source_page int"
C = "chunk_id string, file_id bigint, chunk_no int, heading_path string, chunk_type string, content string, context_prefix string, tags array<string>, source_segments array<string>, page_range array<int>, depth int, word_count int, is_cross_page boolean, continuation_type string, needs_review boolean, doc_zone string"


def _h(level: int, page: int, text: str, path: str | None = None, **k) -> dict:
    return dict(type="Header", level=level, page=page, text=text, path=text if path is None else path, **k)


def _p(page: int | None, text: str | None, kind: str = "Paragraph", path: str | None = "Chapter 1 Rivers", **k) -> dict:
    return dict(type=kind, page=page, text=text, path=path, **k)


def _documents() -> dict[int, list[dict]]:
    return {
        # headings in and out of the contents, an empty one, seven levels
        -1: [
            _h(1, 1, "Chapter 1 Rivers"), _p(1, "Rivers carry water."), _h(2, 1, "1.1 Sources", "Chapter 1 Rivers > 1.1 Sources"), _p(2, "Springs feed them.", path="Chapter 1 Rivers > 1.1 Sources"),
            _h(2, 2, "1.2 Mouths", "Chapter 1 Rivers > 1.2 Mouths"), _p(3, "Deltas build up.", path="Concept Check > 1.2 Mouths"), _h(1, 160, "Chapter 2 Lakes"), _h(1, 160, ""), _p(161, "Lakes hold water.", path="Local notes on lakes"),
            _h(3, 161, "Fishing"), _h(5, 161, "Nets", depth=9), _p(162, "Nets are knotted.", path=None), _h(1, 300, "Glossary"), _p(301, "The last word", path="Glossary"), _p(None, "No page here"),
        ],
        # furniture on twelve pages
        -2: [
            x for n in range(1, 13) for x in (
                _p(n, "Rivers and Lakes", "Text", box=TOP, top=True), _p(n, "Rivers and Lakes", "Text", box=WIDE) if n % 4 == 0 else _p(n, f"Page {n}" if n % 2 else f"{n} / 12", "Text", box=FOOT), _p(n, f"The water of lake {'abcdefghijkl'[n - 1]} is deep.", box=WIDE),
                *([_p(n, "(continued)", "Header", box=WIDE, level=2), _p(n, "Table 2 Flow", "Text", box=TOP), _p(n, "– 4 –", "Text", box=WIDE), _p(n, "xi", "Text", box=FOOT)] if n == 5 else []),
            )
        ],
        # columns, a spanning box, one without, a narrower page, a chapter heading below text
        -3: [
            _p(1, "left one", box=LEFT), _p(1, "right one", box=RIGHT), _p(1, "left two", box=[60.0, 200.0, 280.0, 240.0]), _p(1, "right two", box=[330.0, 200.0, 560.0, 240.0]), _p(1, "over both", box=WIDE), _p(1, "no box", box=None),
            _p(2, "narrow page", box=[20.0, 100.0, 90.0, 120.0]), _p(3, "before the chapter", path="Old > Part", box=WIDE), _p(3, "before, without path", path=None, box=WIDE), _h(1, 3, "Chapter 3 Looms", box=[50.0, 300.0, 560.0, 320.0]), _p(3, "after it", path="Chapter 3 Looms", box=WIDE),
        ],
        # texts that run on
        -4: [
            _p(1, "It depends on the volume of", bottom=True), _p(2, "water that flows, measure-", top=True, bottom=True), _p(3, "ment, and more of it.", top=True), _p(3, "items: one, two", "ListItem", bottom=True), _p(4, "and three", "ListItem", top=True),
            _h(2, 4, "(continued)"), _p(4, "self-", bottom=True), _p(5, "evident to all.", top=True), _p(7, "a gap of pages", top=True), _p(7, "x = y +", col=0, bottom=True), _p(8, "z in the other column", col=1, top=True), _p(8, "broken ham-", bottom=True),
            _p(9, "merers-", top=True, bottom=True), _p(10, "mith works.", top=True), _p(10, "brrrrr-", bottom=True), _p(11, "kkkkk tail", top=True), _p(11, None), _p(11, ""),
        ],
        # captions before, after, near, far, of the wrong kind, and sentences about a block
        -5: [
            _p(1, "Table 1.1 Depth of the lakes", "Caption", box=[50.0, 400.0, 560.0, 420.0]), _p(1, "10 20 30", "Table", box=[50.0, 430.0, 560.0, 600.0]), _p(1, "Figure 2 shows a lake in spring", box=WIDE), _p(2, "Figure 2.3 (a) A loom", box=[50.0, 20.0, 560.0, 40.0]),
            _p(2, None, "Picture", box=[50.0, 500.0, 560.0, 700.0]), _p(3, "5 6 7", "Table", box=WIDE), _p(3, "Table 3 Wages", box=WIDE), _p(4, "Equation (5) The flow", box=WIDE), _p(4, "Q = v A", "Formula", box=WIDE), _p(5, "Exhibit 7 A ledger page", box=WIDE), _p(5, "It was copied.", box=WIDE),
            _p(5, None, "Picture", box=None), _p(6, "Table 9 " + "very " * 41 + "long", box=WIDE), _p(6, "8 9", "Table", box=WIDE), _p(7, "Chart 4 is a picture of it", box=WIDE), _p(8, "Tbl. 12 Soils", box=[0.1, 0.2, 0.4, 0.25]), _p(8, "1 2", "Table", box=[0.1, 0.3, 0.4, 0.5]),
        ],
        # what references lead to
        -6: [_p(1, "Table 1.1 Depths", "Table"), _p(1, "Figure 1.1 A lake", "Picture"), _p(1, "Equation (5)", "Formula"), _p(2, "Figure 9 A weir"), _p(2, "1 2 3", "Table"), _p(2, "4 5 6", "Table"), _p(2, None, "Picture"), _p(3, "Formula without id", "Formula"), _p(3, "Table 1.1 Depths again", "Table")],
        # lists and objectives
        -7: [
            _h(1, 1, "Learning objectives"), _p(1, "Explain how rivers form in hills", path="Learning objectives"), _p(1, "the rain", "ListItem", path="Learning objectives"), _p(1, "the snow", "ListItem", path="Learning objectives"), _p(1, "A short paragraph.", path="Learning objectives"),
            _p(2, "After studying this part you know looms.", "LearningObjective"), _p(2, "Describe the warp and the weft", "LearningObjective"), _p(2, "Few words here."), _p(2, "alone", "ListItem"), _p(3, "Theorem 1 Water flows down."), _p(3, "Proof. It falls. ∎"), _p(3, "E = m", "Formula"), _p(3, "F = n", "Formula"),
            *[_p(4, f"Sentence {w} stands here and goes on" + ("." if n % 3 else " and"), path="Chapter 4 Sound") for n, w in enumerate("one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen".split())],
        ],
        # contents pages, the first of them late in the document; where the body and the back matter start
        -8: [
            *[_p(1, f"Preface line {'abcdefghijklmnopqrst'[n]}.", path=None) for n in range(20)], _p(3, "Detailed contents", path=None), _p(3, "Rivers ........ 7\nLakes ........ 20\nWeirs ........ 33", path=None), _p(3, "Preface   ix", path=None),
            _p(4, "1 Looms ..... 40\n2 Warps ..... 41\n3 Wefts ..... 42\n4 Yarns ..... 43\n5 Dyes ..... 44\n6 Felts ..... 45", path=None), _p(30, "a table of contents is far behind", path=None), _h(1, 4, "Chapter 1 Rivers"), _h(1, 6, "1. Rivers"), _p(7, "Body text."), _h(2, 8, "Sources"),
            _h(1, 200, "Bibliography"), _p(201, "Old books."), _p(44, "A line of 12345678901234567890", path=None),
        ],
        # a glossary and an index
        -9: [
            _p(39, "the page before", path=None), _p(40, "Glossary", path=None), _p(40, "Delta: a landform", path=None), _p(40, "A", path=None), _p(40, "Estuary", path=None), _p(40, "A mouth of a river that the tide enters.", path=None), _p(41, "It is wide.", path=None), _p(41, "Felt", path=None), _p(41, "Weir: a low dam: in a river", path=None), _p(41, "Weft", path=None), _p(42, "Threads across the warp.", path=None),
            _p(43, "Subject index", path=None), _p(43, "Delta, 40", path=None), _p(44, "last page", path=None),
        ],
        # metadata
        -10: [_p(2, "ISBN 978-1-111-11111-1", path=None), _p(2, "ISBN: 0-222-33333-4 (paper)", path=None), _p(31, "ISBN 978-9-999-99999-9 too late", path=None), _p(2, "R I V E R   B O O K", path=None), _p(2, "A B C D E", path=None), _p(2, "a plain line", path=None), _p(3, "I S B N", path=None)],
        # other scripts
        -11: [_h(1, 1, "第一章"), _p(1, "éa for example", path="第一章"), _p(1, "À la fin", path="第一章"), _p(1, "no break here", path="第一章"), _p(2, "en dash –", path="第一章"), _p(3, "next word", path="第一章"), _h(1, 9, "索引"), _p(9, "Ünder the İ and ſummary", path="索引")],
        # sidebars: narrow boxes beside the main column, headings and paths that tell them
        -12: [
            _p(1, "The main column is wide and long.", box=[60.0, 500.0, 400.0, 560.0]), _p(1, "Key terms", box=NARROW), _p(1, "weir, weft", box=[480.0, 260.0, 590.0, 290.0]), _p(1, "Explain the tide", box=[470.0, 200.0, 590.0, 230.0]), _p(1, "Back in the main column.", box=[60.0, 300.0, 400.0, 360.0]),
            _p(2, "Under objectives", path="Chapter Objectives", box=WIDE), _p(2, "Identify three soils", path="Chapter Objectives", box=WIDE), _p(2, "A line of the summary", path="Summary", box=WIDE), _p(3, "Describe a loom", box=[100.0, 300.0, 250.0, 320.0]), _p(3, "Other text", box=WIDE), _p(4, "no box at all"), _p(4, "Terms", path="Key Terms", box=WIDE),
        ],
    }


_TOC = {
    -1: [(1, "Preface", "iv"), (1, "Chapter 1 Rivers", "1"), (2, "1.1 Sources", "1"), (2, "1.2 Mouths", "2"), (1, "Chapter 2 Lakes", "160"), (7, "Fishing", "161"), (1, "Appendix Tables", "280"), (1, "Glossary", "300"), (1, "Index", None)],
    -7: [(1, "Part I", "1"), (1, "Glossary of terms", "3"), (2, "Sound", "4")],
    -8: [(0, "Part I", "7"), (1, "Rivers", "7"), (2, "Springs", "7"), (1, "Lakes", "20"), (2, "Shores", "20"), (1, "Early", "8"), (1, "Index", "190"), *[(2, f"Section {n}", str(21 + n)) for n in range(5)]],
}

_PAD = " and the water of the river runs on below the weir"
_CHUNKS = {
    -1: [
        ("header", "Chapter 1", "Chapter 1"), ("explanation", "Chapter 1", "Water is defined as a liquid. It refers to rain. Ok. We assume that it flows." + _PAD + "."), ("explanation", "Chapter 1", "5%"), ("explanation", "Chapter 1", "For instance the Elm weir fell. Thus it is closed."),
        ("example", "Chapter 1", "Consider the loom. Is it deep? See Figure 1.1? Calculate the yield of both looms for the whole season now."), ("explanation", "Chapter 1 > 1.1", "In practice it is used for wool. In contrast, felt is not."), ("header", "Chapter 1 > 1.1", "1.1"), ("explanation", "Chapter 1 > 1.1", "Next step 2 is done." + _PAD * 9), ("table", "Chapter 1 > 1.1", "1 2"), ("explanation", "Chapter 1 > 1.1", "Yields rose by 4.5 percent in 1999. This means that prices drive demand. However, it fell."),
    ],
    -6: [
        ("explanation", "Chapter 6", "As Table 1.1 and Figure 9 show, see Figure 9 (a) and the table below. This figure is old. Equation (5) and Formula (5) hold."), ("explanation", "Chapter 6", "The figure above, the following chart and Exhibit 3 differ; see the table above."), ("picture", "Chapter 6", None), ("explanation", "Chapter 6", "Tbl. 1.1, Fig. 1.1 and Table 77; refer to the figure."),
    ],
    -7: [
        ("learning_objective", "O", "Describe the warp and the weft"), ("list", "O", "one\ntwo"), ("explanation", "O", "A short one."), ("explanation", "O", "Another short one."), ("explanation", "P", "Explain how rivers form in hills\nin short."), ("explanation", "P", "Taken. " + "word " * 120), ("list", "P", "taken too"), ("list", "Q", "not taken"), ("learning_objective", "Q", "You will be able to weave"), ("learning_objective", "Q", "After studying this you know"), ("list", "Q", "joins the nearest"),
    ],
}
_CHUNK_PLACES = {-6: [([1, 1], ["seg_0004"]), ([2, 2], ["seg_0005", "seg_0006"]), ([2, 2], ["seg_0007"]), ([1, 1], ["seg_0001", "seg_0002"])]}


@lru_cache(maxsize=1)
def rows() -> tuple[list[tuple], list[tuple], list[tuple]]:
    """Rows of segments, entries and chunks."""
    seg, toc, chk = [], [], []
    for doc, parts in _documents().items():
        for n, x in enumerate(parts):
            seg.append((doc, f"seg_{n + 1:04d}", n, x["type"], x["text"], x["page"], x.get("box", [50.0, 300.0, 560.0, 340.0]), x.get("depth", 1 if x["type"] == "Header" else 2), x["path"], None, x.get("top", False), x.get("bottom", False), x.get("col", -1), x.get("level"), None))
    for doc, entries in _TOC.items():
        toc += [(doc, f"toc_{n + 1:04d}", level, title, page, None) for n, (level, title, page) in enumerate(entries)]
    for doc, chunks in _CHUNKS.items():
        for n, (kind, path, text) in enumerate(chunks):
            pages, segments = _CHUNK_PLACES[doc][n] if doc in _CHUNK_PLACES else ([1, 1], [f"seg_{n + 1:04d}"])
            chk.append((f"deck{-doc}_{n:04d}", doc, n, path, kind, text, None, None, segments, pages, 1, len((text or "").split()), False, "none", False, "body" if n % 3 else "front"))
    return seg, toc, chk


def _literal(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, str):
        return "'" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    return "[" + ", ".join(map(_literal, v)) + "]" if isinstance(v, list) else repr(v)


_DUCK = {"string": "varchar", "array<double>": "double[]", "array<string>": "varchar[]", "array<int>": "int[]"}


def sql(which: int) -> str:
    """The deck's segments (0), entries (1) or chunks (2) as a SELECT."""
    schema = [x.split(" ", 1) for x in (S, T, C)[which].split(", ")]
    values = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows()[which])
    return "select " + ", ".join(f"{n}::{_DUCK.get(k, k)} as {n}" for n, k in schema) + f" from (values {values}) v({', '.join(n for n, _ in schema)})"


def _with(spark: SparkSession, df: DataFrame, which: int) -> DataFrame:
    """A table and the deck's rows, with the table's columns."""
    own = spark.createDataFrame(rows()[which], (S, T, C)[which])
    return df.unionByName(own.select(*[c for c in own.columns if c in df.columns]), allowMissingColumns=True)


def segments(spark: SparkSession, folder: str, *columns: str, by_document: bool = False) -> DataFrame:
    if not by_document:
        return _with(spark, src.segments(spark, folder, *columns), 0)
    raw = src.table(spark, folder, "flat_segments").select(*dict.fromkeys(("file_id", "segment_id", *columns, "ingested_at")))
    return src.latest(_with(spark, raw, 0).repartition("file_id"), ["file_id", "segment_id"])


def toc(spark: SparkSession, folder: str) -> DataFrame:
    df = _with(spark, src.latest(src.table(spark, folder, "toc_entries"), ["file_id", "entry_id"]), 1)
    return src.numbered(df)


def chunks(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return _with(spark, src.latest(src.table(spark, folder, "chunks").select("chunk_id", *columns, "ingested_at"), ["chunk_id"]), 2).select("chunk_id", *columns, F.col("ingested_at"))
