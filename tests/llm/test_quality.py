"""Quality: held-out accuracy, and texts that are odd."""

import random
import re

from pyspark.sql import functions as F

from strataline.llm import quality as q

RND = random.Random(5)
WORDS = "river weir loom ledger soil water sound orchard thread bank".split()


def prose():
    return " ".join(f"The {RND.choice(WORDS)} of the {RND.choice(WORDS)} is under the {RND.choice(WORDS)}, and it was not by the {RND.choice(WORDS)}." for _ in range(6))


def listing():
    return "\n".join(f"• {RND.choice(WORDS)} {RND.choice(WORDS)}" for _ in range(9))


def table():
    return "\n".join(f"| {RND.choice(WORDS)} | {RND.random() * 99:.2f} | {RND.randint(1, 999)} |" for _ in range(9))


def junk():
    return " ".join("".join(RND.choice("qxzvkjw#@%") for _ in range(RND.randint(3, 12))) for _ in range(30))


def sample(n):
    return [(f(), k) for _ in range(n) for f, k in ((prose, "prose"), (listing, "list"), (table, "table"), (junk, "junk"))]


KNOWN = frozenset(WORDS + "the of is under and it was not by".split())


def alone(t):
    return frozenset(re.findall(r"[a-z]+", t.lower())) - KNOWN


def model():
    return q.fit([([q.line_stats(p, alone(t)) for p in q.pieces(t)], k) for t, k in sample(40)])


def test_held_out():
    m = model()
    held = sample(40)
    right = sum(q.score(m, alone(t), t)[-1] == k for t, k in held)
    assert right >= 0.95 * len(held)


def test_odd_texts():
    m = model()
    for t in (None, "", " \n "):
        assert q.score(m, frozenset(), t)[0] == 0 and q.score(m, frozenset(), t)[-1] is None
    out = q.score(m, frozenset(), prose() * 500)
    assert out[-1] == "prose" and abs(sum(out[5:9]) - 1) < 1e-4
    assert q.score(q.fit([]), frozenset(), "anything at all")[-1] == "prose"


def test_query_shape(spark):
    docs = spark.createDataFrame([("a", prose(), 1), ("b", listing(), 2), ("c", None, 3), ("c", None, 3), ("d", "", None)], "chunk_id string, content string, kind int")
    labels = spark.createDataFrame([("a", "prose", 1), ("a", "prose", 1), ("b", "list", 1), ("x", None, 2), ("b", None, 3)], "chunk_id string, kind string, labelled_at int")
    docs = docs.withColumn("alone", F.lit(None).cast("array<string>"))
    m = q.train(docs, labels)
    rows = {r.chunk_id: r for r in q.with_quality(docs, m).collect()}
    assert rows["a"].kind == "prose" and rows["b"].kind == "list" and rows["c"].word_count == 0 and rows["d"].kind is None
    empty = docs.filter("chunk_id = 'z'")
    assert q.lone_words(empty).count() == 0 and q.with_quality(empty, m).count() == 0


def test_lone_words(spark):
    texts = {"a": "The weir of the river", "b": "the loom; LOOM and weir", "c": None, "d": "", "e": "river river 12"}
    docs = spark.createDataFrame([*texts.items(), ("a", texts["a"])], "chunk_id string, content string")
    held = {}
    for k, t in texts.items():
        for w in re.findall(r"[a-z]+", (t or "").lower()):
            held.setdefault(w, set()).add(k)
    want = {k: sorted(w for w, ks in held.items() if ks == {k}) for k in texts}
    got = {r.chunk_id: sorted(r.alone or []) for r in q.with_alone(docs, q.lone_words(docs)).distinct().collect()}
    assert got == want
