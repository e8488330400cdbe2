"""Literal results for the deck: what the rules say of its rows, so that a word list or a pattern typed wrongly doesn't pass
because both sides of a comparison share it."""

import pytest

from strataline.plans import variants

WANT = {
    "toc_t1_funnel": {(-1, "fallback", 0), (-7, "fallback", 0), (-8, "metadata", 12)},
    "toc_t2_heuristic_entries": {
        (-8, 3, 21, "Rivers", "7"), (-8, 3, 21, "Lakes", "20"), (-8, 3, 21, "Weirs", "33"), (-8, 3, 22, "Preface", "ix"), (-8, 4, 23, "1 Looms", "40"), (-8, 4, 23, "2 Warps", "41"),
        (-8, 4, 23, "3 Wefts", "42"), (-8, 4, 23, "4 Yarns", "43"), (-8, 4, 23, "5 Dyes", "44"), (-8, 4, 23, "6 Felts", "45"),
    },
    "toc_t3_section_map": {(-1, 1, 280, 300, 315, 4), (-7, 1, 9999, 3, 18, 2), (-8, 7, 190, None, None, 4)},
    "toc_t10_gate": {(-1, "seg_0001", None), (-11, "seg_0001", "seg_0007"), (-8, "seg_0026", "seg_0030")},
    "toc_t16_glossary": {(-9, "Delta", "a landform"), (-9, "Estuary", "A mouth of a river that the tide enters. It is wide."), (-9, "Weft", "Threads across the warp."), (-9, "Weir", "a low dam: in a river")},
    "toc_t18_isbn": {(-10, "1111111111")},
    "toc_t19_spaced_text": {(-10, "seg_0004", "RIVER BOOK"), (-10, "seg_0005", "ABCDE"), (-10, "seg_0007", "ISBN")},
    "layout_l11_narrow_sidebars": {(-12, "seg_0003")},
    "ref_b1_captions": {
        (-2, "seg_0017", "2", "Table"), (-5, "seg_0001", "1.1", "Table"), (-5, "seg_0004", "2.3 (a)", "Figure"), (-5, "seg_0007", "3", "Table"), (-5, "seg_0008", "5", "Equation"), (-5, "seg_0010", "7", "Exhibit"),
        (-5, "seg_0016", "12", "Table"), (-6, "seg_0001", "1.1", "Table"), (-6, "seg_0002", "1.1", "Figure"), (-6, "seg_0003", "5", "Equation"), (-6, "seg_0004", "9", "Figure"), (-6, "seg_0009", "1.1", "Table"),
    },
    "cont_d1_merge_hyphenated": {
        (-11, "seg_0006", "en dash –", "next word"), (-2, "seg_0019", "– 4 –", "xi"), (-4, "seg_0003", "water that flows, measurement", "and more of it."), (-4, "seg_0008", "selfevident", "to all."),
        (-4, "seg_0013", "broken hammerers-", ""), (-4, "seg_0014", "merersmith", "works."), (-4, "seg_0016", "brrrrr-", "kkkkk tail"),
    },
    "chunk_k6_objectives": {(-7, 1, 0), (-7, 2, 0), (-7, 10, 9)},
    "chunk_b7_bonded": {(-6, 2, "picture", "seg_0007,seg_0001,seg_0002")},
    "chunk_k9_glossary": {
        (-9, 1, "Delta: a landform", "seg_0003"), (-9, 2, "Estuary: A mouth of a river that the tide enters. It is wide.", "seg_0005,seg_0006,seg_0007"), (-9, 3, "Weir: a low dam: in a river", "seg_0009"),
        (-9, 4, "Weft: Threads across the warp.", "seg_0010,seg_0011"),
    },
}
ROLES = {
    ("deck1_0001", 0): "definition", ("deck1_0001", 2): "irrelevant", ("deck1_0001", 3): "assumption", ("deck1_0002", 0): "explanation", ("deck1_0003", 0): "example", ("deck1_0003", 1): "conclusion", ("deck1_0004", 1): "question",
    ("deck1_0005", 0): "application", ("deck1_0005", 1): "comparison", ("deck1_0007", 0): "procedure", ("deck1_0009", 0): "evidence", ("deck1_0009", 2): "contrast", ("deck6_0000", 0): "reference", ("deck1_0008", 0): "irrelevant",
}


@pytest.mark.parametrize("name", sorted(WANT))
def test_deck(spark, data, name):
    rows = variants.QUERIES[name](spark, data).filter("file_id < 0").collect()
    assert len(rows) == len(WANT[name]) and {tuple(r) for r in rows} == WANT[name]


def test_roles_of_the_deck(spark, data):
    got = {(r.chunk_id, r.sentence_no): r.role for r in variants.QUERIES["tag_g7_roles"](spark, data).filter("chunk_id like 'deck%'").collect()}
    assert {k: got[k] for k in ROLES} == ROLES


def test_references_of_the_deck(spark, data):
    rows = variants.QUERIES["ref_r3_r4_references"](spark, data).filter("chunk_id = 'deck6_0000'").collect()
    got = {(r.ref_text, r.start_offset, r.target_segment_id, r.confidence) for r in rows}
    assert got == {
        ("Table 1.1", 3, "seg_0009", 0.95), ("Figure 9", 17, "seg_0004", 0.95), ("see Figure", 32, "seg_0002", 0.7), ("Figure 9 (a)", 36, None, 0.5), ("the table below", 53, "seg_0001", 0.7),
        ("This figure", 70, "seg_0002", 0.7), ("Equation (5)", 90, None, 0.5), ("Formula (5)", 107, None, 0.5),
    }


def test_rich_sidebars_of_the_deck(spark, data):
    rows = variants.QUERIES["layout_l11_rich_sidebars"](spark, data).filter("file_id = -12").collect()
    got = {(r.segment_id, r.sidebar_zone, r.sidebar_type) for r in rows}
    assert got == {
        ("seg_0002", "right", "heading"), ("seg_0003", "right", "sidebar_content"), ("seg_0004", "right", "learning_objective"), ("seg_0006", "sidebar", "sidebar_content"),
        ("seg_0007", "sidebar", "learning_objective"), ("seg_0008", "sidebar", "summary"), ("seg_0009", "sidebar", "learning_objective"), ("seg_0012", "sidebar", "key_term"),
    }
