"""Rows once per key."""

from strataline.llm.common import latest, once


def test_once_is_latest(spark):
    rows = [("a", 1, "x", 1), ("a", 1, "x", 2), ("b", 1, "y", None), ("b", 1, "z", 3), ("c", 2, None, 1), ("c", 2, None, 1), ("d", 1, "q" * 9000, 1)]
    df = spark.createDataFrame(rows, "k string, n int, text string, ts int")
    want = sorted(map(tuple, latest(df, ["k", "n"], "ts", ["text"]).collect()), key=str)
    for most in (100, 0):
        assert sorted(map(tuple, once(df, ["k", "n"], "ts", ["text"], most).collect()), key=str) == want
    null = spark.createDataFrame([(None, 1, "x", 1)], df.schema)
    assert once(null, ["k", "n"], "ts", ["text"]).count() == 1 and once(null, ["k", "n"], "ts", ["text"], 0).count() == 1
    assert once(df.filter("n > 9"), ["k", "n"], "ts", ["text"]).count() == 0
