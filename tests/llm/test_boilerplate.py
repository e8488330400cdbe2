"""Repeated lines against a plain count."""

import random
import re

from pyspark.sql import functions as F

from strataline.llm import boilerplate as b


def brute(rows, files):
    form = lambda x: re.sub(r"[\s\d]+", "", x.lower())
    lines = {(s, f, g, i, x) for s, f, g, t in rows if t is not None for i, x in enumerate(t.split("\n")) if sum(bool(re.search(r"[^\W\d_]", w)) for w in x.split()) >= 4}
    n = {}
    for f, s in files:
        n.setdefault(s, set()).add(f)
    seen = {}
    for s, f, _, _, x in lines:
        seen.setdefault((s, form(x)), set()).add(f)
    return {(f, g, i) for s, f, g, i, x in lines if s is not None and len(seen[s, form(x)]) >= max(3, 0.2 * len(n.get(s, ())))}


def run(spark, rows, files, **k):
    df = spark.createDataFrame(rows, "site string, file_id long, segment_id string, text string")
    lines = b.with_line_hash(b.explode_lines(df, "text"), 4).drop("text", "line")
    totals = spark.createDataFrame(files, "file_id long, site string").filter("site is not null").groupBy("site").agg({"file_id": "count"}).withColumnRenamed("count(file_id)", "n_all")
    rep = b.repeated_lines(lines, totals, **k)
    return df, b.mark_repeated(lines, rep), rep


def test_against_a_plain_count(spark):
    rnd = random.Random(2)
    files = [(i, rnd.choice(["a", "a", "b", None])) for i in range(40)]
    pool = ["All rights are kept here", "ALL  rights are kept here 5", "Told by desk number 7 of ours", "one two three", "never the same line at all"]
    rows = []
    for f, s in files:
        for g in range(3):
            rows.append((s, f, f"seg_{g}", rnd.choice([None, "", "\n".join(rnd.choice(pool) if rnd.random() < 0.3 else f"own words {f} {'x' * g} {rnd.choice('pqr')} are here {chr(97 + f % 26)}" for _ in range(3))])))
    rows += rows[:5]
    _, found, _ = run(spark, rows, files)
    assert {(r.file_id, r.segment_id, r.line_no) for r in found.collect()} == brute(rows, files)


def test_republished_documents_count_once_as_clusters(spark):
    rows = [("a", i, "s", "the very same republished text line") for i in range(5)] + [("a", 9, "s", "another text of four words")]
    files = [(i, "a") for i in (0, 1, 2, 3, 4, 9)]
    assert run(spark, rows, files)[2].count() == 1
    assert run(spark, rows, files, weigh="clusters")[2].count() == 0


def test_clusters_and_dates(spark):
    """Against a plain count over clusters of equal documents and their first dates."""
    rnd = random.Random(4)
    pool = ["all rights are kept here", "told by desk number of ours", "share this page with your friends", "the river weir holds water back"]
    docs = {("ab"[i % 2], i): (frozenset(rnd.sample(pool, rnd.randint(1, 3))), rnd.randint(1, 4)) for i in range(24)}
    rows = [(s, f, "s", "\n".join(sorted(x))) for (s, f), (x, _) in docs.items()]
    dates = spark.createDataFrame([(s, f, f"2024-01-0{day}") for (s, f), (_, day) in docs.items()], "site string, file_id long, date string").withColumn("date", F.col("date").cast("date"))
    want = {}
    for s in "ab":
        clusters = {}
        for (t, _), (x, day) in docs.items():
            if s == t:
                clusters[x] = min(clusters.get(x, 9), day)
        for line in pool:
            n, days = sum(line in x for x in clusters), len({day for x, day in clusters.items() if line in x})
            if n >= 3 and days >= 2 and n >= 0.2 * len(clusters):
                want[s, line] = (sum(line in x for (t, _), (x, _) in docs.items() if s == t), n, days)
    df, _, rep = run(spark, rows, [(f, s) for s, f in docs], weigh="clusters", dates=dates, least_dates=2)
    lines = b.with_line_hash(b.explode_lines(df, "text"), 4).select("site", "line_hash", "line").distinct()
    assert {(r.site, r.line): (r.n_docs, r.n_clusters, r.n_dates) for r in rep.join(lines, ["site", "line_hash"]).collect()} == want and want


def test_many_repeated_lines_are_split(spark):
    rows = [("a", i, "s", "All rights are kept here\nown words of this file " + "pqr"[i]) for i in range(3)]
    df, found, rep = run(spark, rows, [(0, "a"), (1, "a"), (2, "a")])
    lines = b.with_line_hash(b.explode_lines(df, "text"), 4).drop("text", "line")
    assert sorted(map(tuple, b.mark_repeated(lines, rep, most=0).select(*found.columns).collect())) == sorted(map(tuple, found.collect()))


def test_removal_and_empty_tables(spark):
    rows = [("a", i, "s", f"Keep this line {'abc'[i]}\nAll rights are kept here\n") for i in range(3)] + [("a", 7, "s", None)]
    df, found, _ = run(spark, rows, [(0, "a"), (1, "a"), (2, "a"), (7, "a")])
    out = {r.file_id: r.clean for r in b.without_lines(df, found, ["file_id", "segment_id"], "text", "clean").collect()}
    assert out[0] == "Keep this line a\n" and out[7] is None
    assert run(spark, [], [(0, "a")])[1].count() == 0
