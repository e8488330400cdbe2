"""Per-document text quality: line statistics, and a hidden Markov model that labels lines.

The states are prose, list, table and junk. What a state emits is judged by a classifier of line statistics (its
posteriors over the share of the state are scaled likelihoods); starts and transitions are counted on the labelled
sample. The posterior shares of the labels, weighed by words, are the document's.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.common import words_of

KINDS = ("prose", "list", "table", "junk")
#: Most labelled rows that the model is fitted on, taken by hash order.
SAMPLE = 6_000
#: Words of a line beyond which it is judged in pieces of this many.
LINE_WORDS = 30

# The commonest function words of the languages.
FUNCTION_WORDS = {
    "en": "the of and a an in to is are was by for with on at from that this which as be it or not each every one when under over into up but also its these those has have",
    "de": "der die das den dem des und ein eine einen bei mit nach von zu im am ist sind auf für an als auch nicht wird über unter vor seit ohne gemäß",
    "fr": "le la les l d de des du et un une en dans à au aux que qui est sont par pour sur pas sans avec après pendant mais plus où depuis entre près",
    "es": "el la los las de del y un una en con por para que es son al se no sin sobre después durante según bajo más desde también",
    "pt": "o a os as de do da dos das e um uma em no na com por para que é são ao se não sem sobre depois durante segundo sob mais até também",
    "ru": "и в во на не что с со по к из за от для при под у о а но же как это его до без между после около где над",
    "hi": "है में को का की के से और पर यह एक नहीं हैं ने था भी तक कि जो तो क्या",
}
_FUNCTION = frozenset(w for ws in FUNCTION_WORDS.values() for w in ws.split())
#: Function characters of scripts without spaces.
_FUNCTION_CHARS = frozenset("的了在是而与和着过之下这后前于为はをがにのでともるすたいへ")
_ENUM = regex.compile(r"\s*(?:[•●▪◦○■□◆*\-–—·‣»>]|\(?(?:\d{1,3}|[ivxlc]{1,5}|[IVXLC]{1,5}|\p{L})[.)\]:]|\d+(?:\.\d+)+|\[[ x]\]|step\b)\s", regex.I)
_LEADER = regex.compile(r"\.{4,}|(?:\. ){3,}|·{3,}|_{4,}|…{2,}")
_STOP = regex.compile(r"[.!?…。！？।][\"'”’»)\]」』）]*(?=\s|$|[^\s\p{N}\p{Latin}])")
_END = regex.compile(r"[.!?…。！？।:：;；][\"'”’»)\]」』）]*\s*$")
_NUMERIC = regex.compile(r"[-+(]?[\d.,:/]*\d[\d.,:/%)]*|n/a|-|–", regex.I)
_SPACELESS = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]")
_WIDE = regex.compile(r"\t| {3,}|\|")
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_SYMBOL = regex.compile(r"[^\p{L}\p{M}\p{N}\s.,;:'\"!?()\-–—’‘“”«»„。、，…：；！？（）「」《》।]")
FEATURES = 22


def pieces(text: str) -> list[str]:
    """Lines that aren't blank; a long line in pieces of LINE_WORDS words (or of 120 characters without spaces)."""
    out = []
    for line in text.split("\n"):
        if not line.strip():
            continue
        if len(line) <= 160:
            out.append(line)
            continue
        words = line.split(" ")
        if len(words) * 40 < len(line):
            out += [line[i : i + 120] for i in range(0, len(line), 120)]
        elif len(words) <= LINE_WORDS + LINE_WORDS // 2:
            out.append(line)
        else:
            n = max(1, round(len(words) / LINE_WORDS))
            step = -(-len(words) // n)
            out += [x for i in range(0, len(words), step) if (x := " ".join(words[i : i + step])).strip()]
    return out


def line_stats(line: str, alone: frozenset[str] | set[str]) -> list[float]:
    """The statistics of one line. ``alone``: words that no other document of the corpus has."""
    tokens = line.split()
    n, size = max(1, len(tokens)), max(1, len(line.strip()))
    words = _WORD.findall(line.lower())
    spaceless = 0 if line.isascii() else len(_SPACELESS.findall(line))
    k = max(1, len(words))
    function = sum(w in _FUNCTION for w in words) / k
    if spaceless * 2 > size:
        function = sum(c in _FUNCTION_CHARS for c in line) / size * 4
        seen = 1.0
    else:
        seen = sum(w not in alone for w in words) / k if words else 0.0
    numeric = sum(1 for t in tokens if _NUMERIC.fullmatch(t)) / n
    digits = sum(map(str.isdigit, line))
    capital = sum(t[0].isupper() for t in tokens) / n if tokens else 0.0
    letters = sum(map(len, words))
    top = Counter(words).most_common(1)[0][1] if words else 0
    return [
        np.log1p(n), min(30.0, size / n), len(_SYMBOL.findall(line)) / size, digits / size, float(bool(_END.search(line))), min(1.0, function),
        float(bool(_ENUM.match(line))), capital, min(3.0, len(_WIDE.findall(line)) / 2), (line.count(",") + line.count("、") + line.count("，")) / n,
        float(bool(_LEADER.search(line))), numeric, len(set(words)) / k, seen, (line.count("/") + line.count("·") + line.count("»") + line.count(";")) / n, spaceless / size,
        np.log1p(max(map(len, tokens), default=0)), letters / size, np.log1p(len(_STOP.findall(line)) * 10 / n), top / k if len(words) > 3 else 0.0,
        float(line.strip()[:1].islower()), (line.count("=") + line.count("{") + line.count("<") + line.count("_")) / n,
    ]


@dataclass
class Model:
    """Bins of the features, weights of the classifier, and the chain."""

    edges: np.ndarray
    weights: np.ndarray
    share: np.ndarray
    start: np.ndarray
    move: np.ndarray

    def design(self, x: np.ndarray) -> np.ndarray:
        hot = x[:, :, None] > self.edges[None]
        return np.hstack([np.ones((len(x), 1)), hot.reshape(len(x), -1)])

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        return _softmax(self.design(x) @ self.weights)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(documents: list[tuple[list[list[float]], str]], steps: int = 250) -> Model:
    """Model of (line statistics, label) of labelled documents; a line has the label of its document.

    A kind that no document has is never given. Without documents all is prose.
    """
    docs = [(np.array(x, dtype=float).reshape(-1, FEATURES), KINDS.index(k)) for x, k in documents if x]
    c = len(KINDS)
    if not docs:
        w = np.zeros((1 + FEATURES * 8, c))
        w[0, 0] = 50.0
        return Model(np.zeros((FEATURES, 8)), w, np.ones(c) / c, np.ones(c) / c, np.ones((c, c)) / c)
    x = np.vstack([d for d, _ in docs])
    y = np.concatenate([np.full(len(d), k) for d, k in docs])
    # each document weighs as the root of its lines
    weight = np.concatenate([np.full(len(d), len(d) ** -0.5) for d, _ in docs])
    weight /= weight.mean()
    quantiles = np.quantile(x, [0.05, 0.15, 0.3, 0.45, 0.6, 0.75, 0.9, 0.97], axis=0).T
    model = Model(quantiles, np.zeros((1 + FEATURES * 8, c)), np.zeros(c), np.zeros(c), np.zeros((c, c)))
    d, t = model.design(x), np.eye(c)[y]
    w, m, v = model.weights, np.zeros_like(model.weights), np.zeros_like(model.weights)
    for step in range(1, steps + 1):
        g = d.T @ ((_softmax(d @ w) - t) * weight[:, None]) / len(d) + 5e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    absent = np.array([k not in {k for _, k in docs} for k in range(c)])
    w[0, absent] -= 50.0
    start, move = np.ones(c), np.full((c, c), 0.5)
    for part, k in docs:
        start[k] += 1
        move[k, k] += len(part) - 1
    move = 0.9 * move / move.sum(axis=1, keepdims=True) + 0.1 / c
    return Model(quantiles, w, (t * weight[:, None]).sum(axis=0) / weight.sum() + 1e-3, start / start.sum(), move)


def label_shares(model: Model, x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Shares of the kinds in one document, by forward and backward passes over its lines."""
    emit = np.clip(model.posteriors(x), 1e-6, 1) / model.share
    n = len(emit)
    ahead, back = np.empty_like(emit), np.ones_like(emit)
    now = model.start * emit[0]
    ahead[0] = now / now.sum()
    for i in range(1, n):
        now = (ahead[i - 1] @ model.move) * emit[i]
        ahead[i] = now / now.sum()
    for i in range(n - 2, -1, -1):
        now = model.move @ (emit[i + 1] * back[i + 1])
        back[i] = now / now.sum()
    post = ahead * back
    post /= post.sum(axis=1, keepdims=True)
    return (post * weights[:, None]).sum(axis=0) / weights.sum()


def lone_words(docs: DataFrame, key: str = "chunk_id", text: str = "content") -> DataFrame:
    """(doc, alone): the words of a document, by the hash of its key, that no other document has.

    Counted over all documents: a word's first and last holder tell whether there are two, and combine on the map side, so
    the commonest words meet nowhere. What is left of a document is no more than its own words.
    """
    doc = F.xxhash64(F.col(key))
    rows = docs.filter(F.col(text).isNotNull()).select(doc.alias("doc"), F.explode(words_of(F.col(text))).alias("word")).filter("word <> ''")
    ends = rows.groupBy("word").agg(F.min("doc").alias("doc"), F.max("doc").alias("last")).filter("doc = last")
    return ends.groupBy("doc").agg(F.collect_list("word").alias("alone"))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, sample: int = SAMPLE) -> list[tuple[str, str, list[str]]]:
    """(text, kind, alone) of at most ``sample`` labelled documents, by hash order of the key; null kinds are left out."""
    kinds = labels.filter(F.col("kind").isin(*KINDS)).groupBy(key).agg(F.max_by("kind", "labelled_at").alias("kind"))
    kinds = kinds.orderBy(F.xxhash64(key), key).limit(sample)
    texts = docs.filter(F.col(text).isNotNull()).select(key, text, "alone")
    rows = texts.join(F.broadcast(kinds), key).groupBy(key).agg(F.max(F.struct(text, "alone")).alias("t"), F.max("kind").alias("kind"))
    return [(r["t"][text], r["kind"], r["t"]["alone"] or []) for r in rows.toLocalIterator()]


def train(docs: DataFrame, labels: DataFrame, key: str = "chunk_id", text: str = "content", sample: int = SAMPLE) -> Model:
    """Model of the labelled ones of ``docs`` (key, text, alone)."""
    rows = labelled_sample(docs, labels, key, text, sample)
    return fit([([line_stats(p, frozenset(alone)) for p in pieces(t)], k) for t, k, alone in sorted(rows)])


def score(model: Model, alone: frozenset[str], text: str | None) -> tuple:
    """The statistics of one document: words, mean word length, symbol ratio, shares of stopped lines, common words,
    and of the kinds; ``kind`` is the largest share (ties: the first). Null and blank texts have 0 words and no kind."""
    parts = pieces(text) if isinstance(text, str) else []
    if not parts:
        return (0, None, None, None, None, None, None, None, None, None)
    x = np.array([line_stats(p, alone) for p in parts])
    n = np.array([len(p.split()) for p in parts], dtype=float)
    size = np.array([len(p.strip()) for p in parts], dtype=float)
    weights = np.maximum(n, size / 6)
    shares = label_shares(model, x, weights)
    return (
        int(n.sum()), float(size.sum() / n.sum()), float((x[:, 2] * size).sum() / size.sum()), float(x[:, 4].mean()), float((x[:, 5] * n).sum() / n.sum()),
        *[round(float(s), 6) for s in shares], KINDS[int(shares.argmax())],
    )


def with_alone(docs: DataFrame, lone: DataFrame, key: str = "chunk_id") -> DataFrame:
    """``docs`` with ``alone``, null where a document has no such word."""
    return docs.withColumn("__doc", F.xxhash64(F.col(key))).join(lone.withColumnRenamed("doc", "__doc"), "__doc", "left").drop("__doc")


def with_quality(docs: DataFrame, model: Model, key: str = "chunk_id", text: str = "content") -> DataFrame:
    """(key, word_count, mean_word_length, symbol_ratio, stopped_lines, common_words, prose, list, table, junk, kind),
    one row for each of ``docs`` (key, text, alone). No shuffle; the model is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["word_count", "mean_word_length", "symbol_ratio", "stopped_lines", "common_words", *KINDS, "kind"]
    kinds = f"`{key}` {dict(docs.dtypes)[key]}, word_count int, " + ", ".join(f"`{c}` double" for c in names[1:-1]) + ", kind string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for pdf in batches:
            out = pd.DataFrame([score(model, frozenset(a) if a is not None else frozenset(), t) for t, a in zip(pdf[text], pdf["alone"])], columns=names)
            out.insert(0, key, pdf[key].to_numpy())
            yield out

    return docs.select(key, text, "alone").mapInPandas(run, kinds)
