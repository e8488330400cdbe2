"""One form."""

import sys

from hypothesis import given, settings
from hypothesis import strategies as st

from strataline.llm.unify import look_alike_pairs, mapping, unify


def test_same_looks_one_form():
    for a, b in [("Ｃｈａｐ １", "Chap 1"), ("é", "é"), ("a​b­", "ab"), ("a b", "a b"), ("Сhаpter", "Chapter"), ("ﬁne", "fine"), ("ﾊﾟｲﾌﾟ", "パイプ"), ("⽔", "水"), ("Το", "To"), ("นํา", "นำ"), ("е́", "é"), ("ё", "ë"), ("𝐀bc", "Abc"), ("e\U000e0100", "e"), ("a\U000e0061", "a"), ("ﷺ", "ﷺ"), ("сор", "cop"), ("Å", "Å")]:
        assert unify(a) == unify(b), (a, b)


def test_words_keep_their_script():
    for t in ("дорога ведёт к реке", "Σοφος λόγος", "бе́лый", "GIS в системе"):
        assert unify(t) == t
    assert unify("cистема и дoрога") == "система и дорога" and unify("wаter") == "water"


def test_differences_stay():
    for a, b in [("x²", "x2"), ("é", "e"), ("A", "a"), ("l", "1"), ("O", "0"), ("-", "–"), ("ñ", "n")]:
        assert unify(a) != unify(b)


def test_mapping_is_checked():
    table = mapping()
    assert all(x not in table or table[x] == x for v in table.values() for x in v)
    for c in range(sys.maxunicode + 1):
        if not 0xD800 <= c < 0xE000 and c < 0x20000:
            u = unify(chr(c))
            assert unify(u) == u


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_idempotent(t):
    assert unify(unify(t)) == unify(t)


def test_pairs(spark):
    rows = [(1, "a", "Chapter"), (1, "b", "Сhapter"), (1, "b", "Сhapter"), (1, "c", "Chapter"), (1, "d", None), (1, "e", ""), (2, "x", "Chapter"), (None, "y", "Сh"), (None, "z", "Ch"), (1, "l", "é" * 50_000)]
    df = spark.createDataFrame(rows, "file_id long, rec_key string, text string")
    got = {(r.file_id, r.key_a, r.key_b) for r in look_alike_pairs(df, "file_id", "rec_key", "text").collect()}
    assert got == {(1, "a", "b"), (1, "b", "c")}
    assert look_alike_pairs(df.filter("file_id = 9"), "file_id", "rec_key", "text").count() == 0
