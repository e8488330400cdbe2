"""Splitting oversized items at natural boundaries, content-defined.

A rolling hash over a window of words marks landmarks. Within the least and greatest size of a piece, a cut
snaps from the first landmark to the nearest natural boundary (paragraph or sentence end). As landmarks depend
on the words around them alone, an edit moves only the cuts near it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.llm.sentences import spans

MAX_WORDS = 500
MIN_WORDS = 200
OVERLAP = 2
#: Words in the rolling hash's window, and the mean distance of landmarks in words.
WINDOW, SPACING = 12, 64

_ALONE = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}"
_WORD = regex.compile(rf"[{_ALONE}]|[^{_ALONE}\p{{White_Space}}]+")
_JAVA_ALONE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}"
_PARAGRAPH = regex.compile(r"\n\s*\n")

PIECES = T.ArrayType(
    T.StructType(
        [
            T.StructField("piece_no", T.IntegerType()),
            T.StructField("start_char", T.IntegerType()),
            T.StructField("end_char", T.IntegerType()),
            T.StructField("prefix_start", T.IntegerType()),
            T.StructField("split_reason", T.StringType()),
            T.StructField("word_count", T.IntegerType()),
        ]
    )
)


def count_words(text: Column) -> Column:
    """Words of a text, where each Han, Hiragana, Katakana or Thai character is one. Null counts 0. In the JVM."""
    n = F.regexp_count(text, F.lit(rf"[{_JAVA_ALONE}]|[^{_JAVA_ALONE}\p{{IsWhite_Space}}]+"))
    return F.coalesce(n, F.lit(0))


def landmarks(words: list[str], window: int = WINDOW, spacing: int = SPACING) -> np.ndarray:
    """Numbers of words before which a landmark stands: those whose window hash is 0 modulo ``spacing``."""
    if len(words) < window:
        return np.zeros(0, dtype=np.int64)
    h = np.fromiter((xxhash.xxh32_intdigest(w) for w in words), dtype=np.uint64, count=len(words))
    total = np.cumsum(h * np.uint64(0x9E3779B97F4A7C15), dtype=np.uint64)
    rolled = total[window - 1 :].copy()
    rolled[1:] -= total[: -window]
    mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.flatnonzero((mixed >> np.uint64(33)) % np.uint64(spacing) == 0) + window


def cut(text: str, most: int = MAX_WORDS, least: int = MIN_WORDS, overlap: int = OVERLAP) -> list[tuple[int, int, int, str, int]]:
    """Pieces of a text: (start, end, start of the context prefix, split_reason, words).

    The spans follow each other and hold all but white space. A piece has at most ``most`` words. Where any
    natural boundary lies within reach the cut is at one; else it is at a line end (``line``) or between two words
    (``word_limit``). The
    context prefix of a piece, empty for the first, is its predecessor's last ``overlap`` sentences.
    """
    found = [m.span() for m in _WORD.finditer(text)]
    if len(found) <= most:
        if not found:
            return []
        return [(found[0][0], found[-1][1], found[0][0], "none", len(found))]
    starts = [a for a, _ in found]
    sentences = spans(text)
    # natural boundaries, as numbers of words before them
    ends = sorted({bisect_left(starts, b) for _, b in sentences})
    paragraphs = {bisect_left(starts, m.end()) for m in _PARAGRAPH.finditer(text)}
    lines = sorted({bisect_left(starts, i + 1) for i, c in enumerate(text) if c == "\n"})
    marks = landmarks([text[a:b] for a, b in found])
    begins = [s for s, _ in sentences]
    out, at, prefix = [], 0, None
    while at < len(found):
        to, why = len(found), "none"
        if len(found) - at > most:
            to, why = _next(at, most, least, ends, lines, paragraphs, marks)
        a, b = found[at][0], found[to - 1][1]
        out.append((a, b, a if prefix is None else prefix, why, to - at))
        i, j = bisect_right(begins, a) - 1, bisect_left(begins, b)
        last = sentences[max(i, j - overlap)][0] if j > 0 else a
        prefix, at = max(last, a), to
    if len(out) > 1:  # the last piece's cut is its predecessor's
        out[-1] = (*out[-1][:3], out[-2][3], out[-1][4])
    return out


def _next(at: int, most: int, least: int, ends: list[int], lines: list[int], paragraphs: set[int], marks: np.ndarray) -> tuple[int, str]:
    lo, hi = at + least, at + most
    natural = ends[bisect_left(ends, lo) : bisect_right(ends, hi)]
    if not natural:
        last = bisect_left(ends, lo) - 1
        if last < 0 or ends[last] <= at:
            row = bisect_right(lines, hi) - 1
            return (lines[row], "line") if row >= 0 and lines[row] >= lo else (hi, "word_limit")
        to = ends[last]
    else:
        first = int(np.searchsorted(marks, lo))
        if first < len(marks) and marks[first] <= hi:
            m = int(marks[first])
            # the nearest boundary; paragraph ends count as nearer by a quarter of the mean distance
            to = min(natural, key=lambda x: (abs(x - m) - (SPACING // 4 if x in paragraphs else 0), x))
        else:
            to = natural[-1]
    return to, "paragraph" if to in paragraphs else "sentence"


def _udf(most: int, least: int, overlap: int):
    @F.pandas_udf(PIECES)
    def pieces(text: pd.Series) -> pd.Series:
        names = [f.name for f in PIECES.elementType]
        return pd.Series(
            [None if not isinstance(t, str) else [dict(zip(names, (n, a, b, p, why, w))) for n, (a, b, p, why, w) in enumerate(cut(t, most, least, overlap))] for t in text],
            dtype=object,
        )

    return pieces


def split_items(df: DataFrame, key: str = "chunk_id", text: str = "content", most: int = MAX_WORDS, least: int = MIN_WORDS, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of every item of ``df``, one row each: its columns (without clashing ones), piece_no, content,
    context_prefix, split_reason, word_count, start_char, end_char.

    Items within the limit are one piece, as they are, with reason ``none``; only larger ones go through Python.
    Items of null or blank text are one piece with 0 words. Nothing is shuffled.
    """
    own = ["piece_no", "content", "context_prefix", "split_reason", "word_count", "start_char", "end_char"]
    keep = [c for c in df.columns if c not in own or c == key]
    t = F.col(text).alias("__text")
    sized = df.select(*keep, t).withColumn("__words", count_words(F.col("__text")))
    whole = F.array(
        F.struct(
            F.lit(0).alias("piece_no"), F.lit(0).alias("start_char"), F.coalesce(F.length("__text"), F.lit(0)).alias("end_char"), F.lit(0).alias("prefix_start"),
            F.lit("none").alias("split_reason"), F.col("__words").alias("word_count"),
        )
    )
    large = _udf(most, least, overlap)(F.when(F.col("__words") > most, F.col("__text")))
    rows = sized.withColumn("__large", large).withColumn("__p", F.explode(F.when(F.col("__words") > most, F.col("__large")).otherwise(whole)))
    p = F.col("__p")
    piece = F.substring(F.col("__text"), p["start_char"] + 1, p["end_char"] - p["start_char"])
    before = p["prefix_start"]
    prefix = F.when((p["piece_no"] > 0) & (before < p["start_char"]), F.rtrim(F.substring(F.col("__text"), before + 1, p["start_char"] - before)))
    return rows.select(
        *keep, p["piece_no"].alias("piece_no"), piece.alias("content"), prefix.alias("context_prefix"), p["split_reason"].alias("split_reason"),
        p["word_count"].alias("word_count"), p["start_char"].alias("start_char"), p["end_char"].alias("end_char"),
    )
