"""Passages with two edits in their middle."""

import random

from strataline.llm import leakage as k


def test_two_edits_in_sixteen_words():
    item = "loom weir soil bank dune fern reed pond silt clay moss peat lake tarn rill glen".split()
    index = k.build_index([(1, " ".join(item))])
    for a, b in ((4, 10), (5, 10), (5, 11)):
        doc = list(item)
        doc[a] = doc[b] = "zzzz"
        assert k.find(index, ["start words " + " ".join(doc) + " end words"]) == [(0, 1)], (a, b)
    doc = list(item)
    doc[3] = doc[6] = doc[10] = "zzzz"
    assert k.find(index, [" ".join(doc)]) == []


def test_no_case_is_lost_before_alignment():
    """Random stretches of 12 to 24 words with changed, dropped and added words: what the aligner takes, the bands keep."""
    r = random.Random(11)
    short, long = ["".join(r.choice("abcdefgh") for _ in range(n)) for n in (1, 2, 3, 3, 3, 4) * 12], ["x" * 60, "y" * 45]
    for n in range(10_000):
        item = [r.choice(short) for _ in range(r.randint(12, 24))]
        doc = list(item)
        for _ in range(r.randint(0, 3)):
            at, how = r.randrange(len(doc)), r.randrange(3)
            doc[at : at + 1] = [[r.choice(long + short)], [], [doc[at], r.choice(long + short)]][how]
        index = k.build_index([(1, " ".join(item))])
        if k.aligned(item, [True] * len(item), doc):
            assert k.candidates(index, [" ".join(doc)]), (item, doc)


def test_shared_wording_is_counted_over_all_blocks(spark):
    head = "of the five answers below mark the one that fits the picture best and give reasons"
    rows = [(i, f"{head} loom{i} weir{i} soil{i}") for i in range(6)] + [(9, " ".join(f"own{i}" for i in range(14)))]
    items = spark.createDataFrame(rows, "item_id long, text string")
    docs = spark.createDataFrame([(1, head), (2, rows[6][1])], "doc_id long, text string")
    for size in (20_000, 3, 1):
        assert [tuple(r) for r in k.find_leaks(docs, items, item_block=size).collect()] == [(2, 9)]
