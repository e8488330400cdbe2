"""Leaked passages against a plain alignment."""

import random

from strataline.llm import leakage as k

VOCAB = [a + b for a in "river weir loom ledger soil water sound orchard thread bank slope stone".split() for b in ("", "s", "like", "ward", "most")]


def words(n, seed):
    r = random.Random(seed)
    return [r.choice(VOCAB) for _ in range(n)]


def brute(item, doc):
    """Least edits from each stretch of 12 to 24 words of the item to any stretch of the document."""
    for size in range(12, 25):
        for i in range(len(item) - size + 1):
            part = item[i : i + size]
            prev = [0] * (len(doc) + 1)
            for a, x in enumerate(part, 1):
                row = [a] + [0] * len(doc)
                for j, y in enumerate(doc, 1):
                    row[j] = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
                prev = row
            if min(prev) * 8 <= size:
                return True
    return False


def test_against_brute_force():
    r = random.Random(7)
    items = [(i, " ".join(words(40, i))) for i in range(6)]
    index = k.build_index(items)
    for n in range(60):
        i = r.randrange(6)
        w = items[i][1].split()
        a, size = r.randrange(0, 20), r.randint(8, 20)
        part = w[a : a + size]
        for _ in range(r.randint(0, 3)):
            at, how = r.randrange(len(part)), r.randrange(3)
            part[at : at + 1] = [[r.choice(VOCAB)], [], [part[at], r.choice(VOCAB)]][how]
        doc = words(30, 100 + n) + part + words(30, 200 + n)
        got = {x for _, x in k.find(index, [" ".join(doc)])}
        for j, t in items:
            want = brute(t.split(), doc)
            # the plain count also takes stretches whose ends are edits; those have at least 11 words in common
            if want and j not in got:
                assert size <= 13, (n, j)
            assert want or j not in got


def test_shared_wording_does_not_count():
    head = " ".join(words(16, 1))
    items = [(i, head + " " + " ".join(words(30, 50 + i))) for i in range(8)]
    index = k.build_index(items)
    assert k.find(index, [head + " and nothing else of it"]) == []
    own = " ".join(items[3][1].split()[16:34])
    assert k.find(index, ["x " + own + " y"]) == [(0, 3)]


def test_rows(spark):
    passage = " ".join(words(20, 9))
    items = spark.createDataFrame([(1, passage.title() + "!"), (2, None), (3, ""), (4, "Why?"), (5, passage)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Intro. " + passage.replace(" ", ", ") + " end", 0), (2, None, 0), (3, "", 0), (4, "other " * 5000, 0), (1, "Intro. " + passage, 0)], "doc_id long, text string, item_id int")
    got = {(r.doc_id, r.item_id) for r in k.find_leaks(docs, items).collect()}
    assert got == {(1, 1), (1, 5)}
    assert k.find_leaks(docs.filter("doc_id = 9"), items).count() == 0 and k.find_leaks(docs, items.filter("item_id = 9")).count() == 0
