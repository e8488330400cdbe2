"""Scan noise."""

import random

import pytest

from strataline.llm import scans as s

WORDS = "the river bank holds water under a loom thread sound horizon well-kept well kept low microphone feeds of and soil modern running notes which every weft line северо-восток северо восток дорога".split()
SCHEMA = "file_id long, segment_id string, pos int, type string, level int, page int, heading_path string, text string, ingested_at int"


def vocabulary(spark, words=WORDS):
    return spark.createDataFrame([(w, 9, s.strokes(w)) for w in words], "word string, n long, strokes string")


def mend(spark, rows, head=s.HEAD, path="Book > River Notes", skip=None):
    full = [(1, f"seg_{i + 1:04d}", i, k, lv, p, path, t, 1) for i, (k, lv, p, t) in enumerate(rows)]
    out = s.mend_segments(spark.createDataFrame(full, SCHEMA), skip, vocabulary(spark), head)
    return {r.segment_id: (list(r.reasons), r.repaired) for r in out.collect()}


NOISY = [
    ("Header", 1, 1, "River Notes"), ("Paragraph", None, 1, "the soil hori-\nzon holds well-\nkept soil"), ("Paragraph", None, 1, "– 12 –"),
    ("Header", None, 2, "River Notes"), ("Paragraph", None, 2, "tlie w@ter of tlie ri·ver and mic-"), ("Paragraph", None, 2, "– 13 –"),
    ("Text", None, 3, "Rivcr Notes | 14\nrophone feeds the soil"), ("Paragraph", None, 3, "– l4 –"), ("Paragraph", None, 4, "the bank\nholds water"), ("Picture", None, 4, None),
]


@pytest.mark.parametrize("head", [s.HEAD, 3, 0])
def test_kinds_of_noise(spark, head):
    """The rows don't depend on how many words are broadcast."""
    got = mend(spark, NOISY, head)
    why = [got[f"seg_{i:04d}"][0] for i in range(1, 11)]
    assert why == [[], ["broken"], ["number"], ["header"], ["half", "misread"], ["number"], ["half", "header"], ["number"], [], []]
    assert got["seg_0002"][1] == "the soil horizon holds well-kept soil" and got["seg_0005"][1].startswith("the water of the river and microphone")
    assert got["seg_0010"][1] is None and got["seg_0003"][1] == ""


def test_misread_copies_far_apart_are_headers(spark):
    rows = []
    for page, top in ((1, "The modern sound line of wefts"), (90, "The modem sound line of wefts"), (180, "The rnodern sound l1ne of wefts")):
        rows.append(("Paragraph", None, page, top))
        rows += [("Paragraph", None, page, f"the river bank holds water {chr(97 + i % 26)}{chr(97 + page % 26)}.") for i in range(150)]
    got = mend(spark, rows, path=None)
    assert [k for k, v in got.items() if "header" in v[0]] == ["seg_0001", "seg_0152", "seg_0303"]


def test_numbers_in_step_over_a_long_file(spark):
    rows = []
    for page in (3, 200):
        rows += [("Paragraph", None, page, f"{page + 11}\nthe river bank holds water")] + [("Paragraph", None, page, "the soil.")] * 200
    got = mend(spark, rows)
    assert [k for k, v in got.items() if v[0]] == ["seg_0001", "seg_0202"]


def test_hyphens_of_words_in_other_scripts(spark):
    assert mend(spark, [("Paragraph", None, 1, "северо-\nвосток и до-\nрога")])["seg_0001"][1] == "северо-восток и дорога"


def test_clean_text_stays(spark):
    for t in ("It costs 28.4 at 1e step, see www.a.example/x.php?id=1 and v2.3.csv in 1984.", "A. B. C. D.", "x² = y", ""):
        assert mend(spark, [("Paragraph", None, 1, t)])["seg_0001"][0] == []


def test_page_values():
    assert [s.page_value(x) for x in ("12", "– 7 –", "Page 4S", "xiv", "[30]", "p. ll3", "l8l", "12 / 40", "Chapter 1", "", "The 12")] == [12, 7, 45, 14, 30, 113, 181, 12, None, None, None]


def test_confusions_against_plain_ways():
    """The walk over a word against all ways of making one or two confusions."""
    r = random.Random(3)

    def once(w, pairs):
        return {w[:i] + true + w[i + len(read) :] for read, true in pairs for i in range(len(w)) if w.startswith(read, i)}

    for _ in range(400):
        low = "".join(r.choice("rnmcldihvwusfetba") for _ in range(r.randint(3, 7)))
        want = once(low, s.SHAPES) | {low.replace(a, b) for a, b in s.SHAPES if a in low}
        want |= {x for w in once(low, s.SHAPES) for x in once(w, s.SHAPES[: s.SECOND]) if s.confused(w, x) and s.strokes(x) == s.strokes(low)} & {x for x in want}
        for w in want - {low}:
            assert s.confused(low, w), (low, w)
            assert s.strokes(low) == s.strokes(w)
        other = "".join(r.sample(low, len(low)))
        if s.strokes(other) != s.strokes(low):
            assert not s.confused(low, other)


def test_many_signs():
    words = s.Lexicon(frozenset(["illlillliilliilll"]))
    assert words.misread("1l|l!11li1|!i1|l1") == "illlillliilliilll"


def test_vocabulary(spark):
    rows = [(1, "a", "The weir well-kept"), (1, "a", "The weir well-kept"), (2, "a", "the loom well-kept"), (3, None, None), (4, "b", "")]
    got = {r.word: r.n for r in s.vocabulary(spark.createDataFrame(rows, "file_id long, segment_id string, text string"), ["file_id", "segment_id"]).collect()}
    assert set(got) == {"the", "well", "kept", "well-kept"}


def test_blocks_give_each_segment_once(spark):
    rows = [(1, f"seg_{i:04d}", i, "Paragraph", None, i // 5, "A", f"the river {i}", i % 3) for i in range(400)] + [(1, "seg_0001", 1, "Paragraph", None, 0, "A", "the river 1", 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    skip = spark.createDataFrame([(1, "seg_0003", 0)], "file_id long, segment_id string, line_no int")
    words = vocabulary(spark)
    assert s.mend_segments(df, skip, words).count() == 400
    odd = spark.createDataFrame([(None, None, None, None, None, None, None, None, None)], df.schema)
    assert s.mend_segments(odd, None, words).count() == 1 and s.mend_segments(df.filter("pos < 0"), None, words).count() == 0
    assert s.mend_segments(df.filter("pos < 9"), None, words.filter("n > 99"), 0).count() == 9


def test_chunks(spark):
    chunks = spark.createDataFrame([("c1", 1, "tlie bank\n\n– 3 –\n\nhori-\nzon", ["a", "b", "c"]), ("c2", 1, "other", ["a"]), ("c3", 1, None, ["a"]), ("c4", 1, "x", None)], "chunk_id string, file_id long, content string, source_segments array<string>")
    mended = spark.createDataFrame([(1, "a", "tlie bank", ["misread"], "the bank"), (1, "b", " – 3 –", ["number"], ""), (1, "c", "hori-\nzon", ["broken"], "horizon")], "file_id long, segment_id string, text string, reasons array<string>, repaired string")
    got = {r.chunk_id: (list(r.reasons), r.repaired) for r in s.mend_chunks(chunks, mended).collect()}
    assert got == {"c1": (["broken", "misread", "number"], "the bank\n\nhorizon"), "c2": ([], "other"), "c3": ([], None), "c4": ([], "x")}


def marked(got, reason="header"):
    return [k for k, v in got.items() if reason in v[0]]


def pages(*edges):
    """A page for each (lines at the top, lines at the bottom), with lines of its own between them."""
    body = ["the river bank holds water", "every weft line of the loom", "feeds soil and modern sound", "a thread sound holds the horizon"]
    rows = []
    for n, (above, below) in enumerate(edges, 1):
        rows += [("Paragraph", None, n, x) for x in (*above, f"{body[n % 4]} {chr(96 + n) * 3}.", *below)]
    return rows


def test_footers_are_found_at_the_bottom(spark):
    """Also over a page number and as the last line of a text; once isn't enough, nor are two edges of one page."""
    foot, misread = "Notes of the loom and the well", "Notcs of tbe loorn and the well"
    got = mend(spark, pages(((), (foot, "– 12 –")), ((), (f"the thread\n{misread}\n13",)), (("Weft lines of soil",), ("Weft lines of soil",))), path=None)
    assert marked(got) == ["seg_0002", "seg_0005"] and got["seg_0002"][1] == "" and got["seg_0005"][1] == "the thread"
    assert marked(mend(spark, pages(((), (foot,)), ((), ("and",))), path=None)) == []


def test_headers_below_page_numbers_short_ones_and_questions(spark):
    for head in ("Weft lines of soil", "Weft", "What holds the water?"):
        assert marked(mend(spark, pages((("12",), ()), (("13", head), ()), ((f"14\n{head}",), ())), path=None)) == ["seg_0004", "seg_0006"], head


def test_copies_that_share_no_part_of_their_strokes(spark):
    """Misread at both ends and in the middle, and unlike the commonest copy."""
    a, b, c = "Tbeory of the looms and of the wells in soil", "Tneory of tne looms and ot the wells in soit", "Tneory ot tne locms and ot tbe wells ir soit"
    assert not s.near(s.skeleton(a), s.skeleton(c), 0.12) and s.near(s.skeleton(b), s.skeleton(c))
    assert marked(mend(spark, pages(((a,), ()), ((b,), ()), ((c,), ())), path=None)) == ["seg_0001", "seg_0003", "seg_0005"]
    first, second = "abcdefghijklmnopqrstuvwx", "xbcdefghijkxmnopqrstuvwz"
    assert marked(mend(spark, pages(((first,), ()), ((second,), ())), path=None)) == ["seg_0001", "seg_0003"]


def test_shapes_against_all_pairs():
    r = random.Random(7)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    def misread(shape):
        for _ in range(r.randint(0, len(shape) // 4 + 1)):
            at = r.randrange(len(shape))
            shape = shape[:at] + r.choice(["", "a", "bc"]) + shape[at + 1 :] or "a"
        return shape

    for _ in range(150):
        shapes = {misread("".join(r.choice("abcde") for _ in range(r.randint(1, 30)))) for _ in range(3)}
        shapes = sorted({misread(x) for x in shapes for _ in range(4)})
        rows = [(x, n := r.randint(1, 3), n + (r.random() < 0.1), True, True, False) for x in shapes]
        want = {x[0] for x in rows if x[1] < x[2]}
        for x in rows:
            for y in rows:
                close = plain(x[0], y[0]) <= int(max(len(x[0]), len(y[0])) * 0.2)
                assert s.near(x[0], y[0]) == close
                if close and x != y and min(x[1], y[1]) < max(x[2], y[2]):
                    want.add(x[0])
        assert {k for k, known in s.header_shapes(rows).items() if known} == want
