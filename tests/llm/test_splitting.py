"""Splitting."""

import random

from strataline.llm.splitting import _WORD, cut, split_items


def text(n, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        out.append(" ".join(r.choice("the river bank holds water loom thread soil of deep".split()) + str(r.randint(0, 99)) for _ in range(r.randint(5, 20))).capitalize() + ".")
        if r.random() < 0.2:
            out.append("\n\n")
    return " ".join(out)


def check(t, most=500):
    out = cut(t, most)
    assert all(0 < n <= most and n == len(_WORD.findall(t[a:b])) for a, b, _, _, n in out)
    assert "".join("".join(t[a:b] for a, b, *_ in out).split()) == "".join(t.split())
    assert all(p <= a for a, _, p, _, _ in out)
    return out


def test_limits_and_cover():
    for t in (text(200), "x " * 3000, "土" * 1200, "w" * 9000, "one two", "a\nb\n" * 900, text(60).replace(".", ",")):
        check(t)
    assert cut("") == [] and cut("  ") == []
    out = check(text(300))
    assert {o[3] for o in out} <= {"paragraph", "sentence"} and len(out) > 3


def test_an_edit_moves_only_near_cuts():
    t = text(900, 4)
    a = {t[x:y] for x, y, *_ in cut(t)}
    u = "New words stand here. " + t
    b = {u[x:y] for x, y, *_ in cut(u)}
    assert len(a & b) >= len(a) // 2


def test_prefix_is_the_last_two_sentences():
    t = text(200)
    out = cut(t)
    before, now = out[0], out[1]
    assert t[now[2] : now[0]].strip() and t[before[0] : before[1]].endswith(t[now[2] : now[0]].rstrip()) and t[now[2] : now[0]].count(".") == 2


def test_column(spark):
    rows = [("a", text(120), "x"), ("b", "short text", "y"), ("c", None, None), ("d", "", "z"), ("b", "short text", "y")]
    df = spark.createDataFrame(rows, "chunk_id string, content string, split_reason string")
    got = split_items(df).collect()
    by = {}
    for r in got:
        by.setdefault(r.chunk_id, []).append(r)
    assert len(by["a"]) > 1 and by["a"][1].context_prefix and len(by["b"]) == 2 and by["c"][0].word_count == 0 and by["d"][0].split_reason == "none"
    assert split_items(df.filter("chunk_id = 'q'")).count() == 0
