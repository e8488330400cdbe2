"""Passages of evaluation items inside a corpus.

Filter and verify: shared character q-grams of a document and an item are counted in overlapping diagonal bands.
A stretch within the edit budget keeps a run of five words whole, which lies on one diagonal whatever was put in or
left out before it; its q-grams are the least number that a band must hold. Bands that reach it are kept, and a banded
alignment of words decides. Only the items' q-grams are broadcast; documents are never shuffled.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A case: so many words of an item in order, at most one in EDIT_SHARE changed, dropped or added.
LEAST_WORDS, EDIT_SHARE = 12, 8
#: Wording that more items share doesn't count; it is found by word n-grams of this length.
SHARED_BY, SHARED_NGRAM = 5, 5
#: Lengths of the q-grams: an item goes by the longest that fits into each five of its words. Five words with the
#: spaces inside and around them have eleven characters, so the last fits into all.
TIERS = (22, 16, 11)
#: Width of a band of diagonals (bands overlap by half).
BAND = 64
#: Items, and bytes of their texts, in one broadcast; more are taken in blocks of this many. The rows are the same.
ITEM_BLOCK, ITEM_BYTES = 20_000, 64 << 20


def plain(text: Column) -> Column:
    """Letters, marks and digits of a text in small letters, words set apart by one space. Null stays null."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\p{M}]+", " "))


def _nfc(text: str) -> str:
    return text if text.isascii() else unicodedata.normalize("NFC", text)


@dataclass
class Tier:
    """The q-grams of the items that go by one length: sorted hashes, and where each occurs."""

    q: int
    hashes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    pos: np.ndarray
    bitmap: np.ndarray


@dataclass
class ItemIndex:
    ids: list[int]
    words: list[list[str]]
    counts: list[list[bool]]
    need: np.ndarray
    tiers: list[Tier]
    seeds: list[dict[tuple[str, ...], list[int]]]
    longest: int


_M = np.uint64(0x9E3779B97F4A7C15)


def qgram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each stretch of ``q`` codes, by doubling: a few vector passes whatever q."""
    have: dict[int, np.ndarray] = {1: (codes.astype(np.uint64) + np.uint64(1)) * _M}
    size = 1
    while size * 2 <= q:
        h = have[size]
        have[size * 2] = (h[: len(h) - size] * np.uint64(31 + 2 * size)) ^ (h[size:] * _M)
        size *= 2
    out, done = have[size], size
    for part in sorted((k for k in have if k < size), reverse=True):
        if done + part <= q:
            n = len(codes) - done - part + 1
            if n <= 0:
                return np.zeros(0, dtype=np.uint64)
            out = (out[:n] * np.uint64(127)) ^ (have[part][done : done + n] * _M)
            done += part
    return out ^ (out >> np.uint64(31))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def shared_grams(words: list[list[str]]) -> set[tuple[str, ...]]:
    """The word n-grams that more than SHARED_BY of the given items hold."""
    held = Counter(g for w in words for g in {tuple(w[k : k + SHARED_NGRAM]) for k in range(len(w) - SHARED_NGRAM + 1)})
    return {g for g, n in held.items() if n > SHARED_BY}


def build_index(items: list[tuple[int, str]], shared: list[list[int]] | None = None) -> ItemIndex:
    """Index of (id, plain text) rows. ``shared``: of each the numbers of the words at which wording begins that more than
    SHARED_BY of all items hold; without it that is judged among the given ones. Shared wording is left out."""
    items = [(i, _nfc(t)) for i, t in items]
    words = [t.split(" ") if t else [] for _, t in items]
    if shared is None:
        held = shared_grams(words)
        shared = [[k for k in range(len(w) - SHARED_NGRAM + 1) if tuple(w[k : k + SHARED_NGRAM]) in held] for w in words]
    counts, need, grams = [], [], {q: ([], [], []) for q in TIERS}
    for n, ((_, text), w) in enumerate(zip(items, words)):
        ok = [True] * len(w)
        for k in shared[n]:
            ok[k : k + SHARED_NGRAM] = [False] * SHARED_NGRAM
        counts.append(ok)
        run = least_run(w, ok)
        q = next((x for x in TIERS if x <= run), TIERS[-1])
        need.append(max(1, run - q + 1))
        if not w:
            continue
        # a space before and after each word; that before a word is its own
        h = qgram_hashes(codes(f" {text} "), q)
        begins = np.cumsum([0, *[len(x) + 1 for x in w]])[:-1]
        first = np.searchsorted(begins, np.arange(len(h)), side="right") - 1
        last = np.searchsorted(begins + 1, np.arange(len(h)) + q - 1, side="right") - 1
        bad = np.concatenate([[0], np.cumsum([not x for x in ok])])
        keep = np.flatnonzero(bad[last + 1] - bad[first] == 0) if len(h) else np.zeros(0, dtype=np.int64)
        for into, x in zip(grams[q], (h[keep], np.full(len(keep), n), keep)):
            into.append(x)
    tiers = [_tier(q, *(np.concatenate(x) for x in g)) for q, g in grams.items() if g[0]]
    return ItemIndex([i for i, _ in items], words, counts, np.array(need, dtype=np.int64), tiers, [seeds(w, ok) for w, ok in zip(words, counts)], max((len(t) for _, t in items), default=0))


def _tier(q: int, h: np.ndarray, item: np.ndarray, pos: np.ndarray) -> Tier:
    order = np.argsort(h, kind="stable")
    hashes, first = np.unique(h[order], return_index=True)
    bitmap = np.zeros(1 << 22, dtype=bool)
    bitmap[(hashes >> np.uint64(42)).astype(np.int64)] = True
    return Tier(q, hashes, np.append(first, len(h)), item[order].astype(np.int64), pos[order].astype(np.int64), bitmap)


def least_run(words: list[str], ok: list[bool]) -> int:
    """Characters of the shortest SEED counted words in a row, with the spaces inside and around them. Every case keeps
    such a run whole: n words with e edits leave n - e in e + 1 runs, and n is 8 e and 12 at least."""
    return min((sum(map(len, words[k : k + SEED])) + SEED + 1 for k in range(len(words) - SEED + 1) if all(ok[k : k + SEED])), default=TIERS[0])


def candidates(index: ItemIndex, texts: list[str]) -> dict[tuple[int, int], tuple[int, int]]:
    """(text number, item number) to the span of positions in the text whose bands reach the item's need."""
    if not index.tiers or not texts:
        return {}
    padded = [f" {t} " for t in texts]
    gap = "\x00" * TIERS[0]
    all_codes = codes(gap.join(padded))
    begins = np.cumsum([0, *[len(t) + len(gap) for t in padded]])[:-1]
    out: dict[tuple[int, int], tuple[int, int]] = {}
    for tier in index.tiers:
        if len(tier.hashes) and len(all_codes) >= tier.q:
            _bands(index, tier, all_codes, begins, out)
    return out


def _bands(index: ItemIndex, tier: Tier, all_codes: np.ndarray, begins: np.ndarray, out: dict[tuple[int, int], tuple[int, int]]) -> None:
    h = qgram_hashes(all_codes, tier.q)
    at = np.flatnonzero(tier.bitmap[(h >> np.uint64(42)).astype(np.int64)])
    where = np.searchsorted(tier.hashes, h[at])
    where[where == len(tier.hashes)] = 0
    hit = tier.hashes[where] == h[at]
    at, where = at[hit], where[hit]
    if not len(at):
        return
    many = tier.first[where + 1] - tier.first[where]
    pos = np.repeat(at, many)
    entry = np.repeat(tier.first[where] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
    item, item_pos = tier.item[entry], tier.pos[entry]
    doc = np.searchsorted(begins, pos, side="right") - 1
    diagonal = (pos - begins[doc] - item_pos) + (1 << 30)
    band = diagonal // (BAND // 2)
    wide = np.int64(1 << 31)
    key = (doc * len(index.ids) + item) * wide
    # each hit belongs to the band that starts in its half and to the one before
    every = np.concatenate([key + band, key + band - 1])
    spot = np.concatenate([pos, pos])
    order = np.argsort(every, kind="stable")
    every, spot = every[order], spot[order]
    edges = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    size = np.diff(np.append(edges, len(every)))
    pair = every[edges] // wide
    reach = size >= index.need[pair % len(index.ids)]
    low, high = np.minimum.reduceat(spot, edges), np.maximum.reduceat(spot, edges)
    for p, lo, hi in zip(pair[reach].tolist(), low[reach].tolist(), high[reach].tolist()):
        k = (p // len(index.ids), p % len(index.ids))
        b = int(begins[k[0]])
        a = out.get(k, (lo - b, hi - b))
        out[k] = (min(a[0], lo - b), max(a[1], hi - b))


#: Exact words in a row that every case has: e edits leave n - e of n >= 8 e (and >= 12) words in e + 1 runs.
SEED = 5
#: A case holds a case of at most so many words: the longer half of a longer one is one itself. With its edits.
CASE_WORDS, CASE_EDITS = 2 * LEAST_WORDS + 4, 3


def seeds(item: list[str], ok: list[bool]) -> dict[tuple[str, ...], list[int]]:
    """Where each run of SEED counted words stands in an item."""
    out: dict[tuple[str, ...], list[int]] = defaultdict(list)
    for i in range(len(item) - SEED + 1):
        if all(ok[i : i + SEED]):
            out[tuple(item[i : i + SEED])].append(i)
    return out


def aligned(item: list[str], ok: list[bool], doc: list[str], known: dict[tuple[str, ...], list[int]] | None = None, begin: int = 0, end: int | None = None) -> bool:
    """Whether an alignment of the words holds a stretch that is a case, with an exact run that starts from ``begin`` to ``end``.

    Each exact run is aligned with its surroundings in a band round its diagonal, wide enough for the edits of a
    shortest case. A word that doesn't count (shared wording) ends a stretch.
    """
    known = seeds(item, ok) if known is None else known
    done: set[tuple[int, int]] = set()
    last = len(doc) - SEED + 1
    for j in range(begin, last if end is None else min(end, last)):
        for i in known.get(tuple(doc[j : j + SEED]), ()):
            if (i, j) in done:
                continue
            stop, at = i, j
            while stop < len(item) and at < len(doc) and item[stop] == doc[at] and ok[stop]:
                stop, at = stop + 1, at + 1
            done.update((i + k, j + k) for k in range(stop - i))
            if stop - i >= LEAST_WORDS:
                return True
            a, c = max(0, i - CASE_WORDS), max(0, j - CASE_WORDS - CASE_EDITS)
            if _banded(item[a : stop + CASE_WORDS], ok[a : stop + CASE_WORDS], doc[c : at + CASE_WORDS + CASE_EDITS], (j - c) - (i - a)):
                return True
    return False


def _banded(item: list[str], ok: list[bool], doc: list[str], shift: int) -> bool:
    """Local alignment (match 4, edit -3) on the diagonals within CASE_EDITS of ``shift``; moves: 1 both, 2 drop, 3 add."""
    width, low = 2 * CASE_EDITS + 1, float("-inf")
    n, m = len(item), len(doc)
    prev: list[float] = [0.0] * (width + 2)
    rows, moves = [], []
    for i in range(n):
        row: list[float] = [low] * (width + 2)
        move = [0] * (width + 2)
        for k in range(1, width + 1):
            j = i + shift + k - 1 - CASE_EDITS
            if not 0 <= j < m:
                continue
            best, how = 0.0, 0
            if (v := (prev[k] if prev[k] > 0 else 0.0) + (4 if item[i] == doc[j] else -3)) > best:
                best, how = v, 1
            if (v := prev[k + 1] - 3) > best:
                best, how = v, 2
            if (v := row[k - 1] - 3) > best:
                best, how = v, 3
            row[k], move[k] = best, how
        rows.append(row)
        moves.append(move)
        prev = row
    spots = sorted(((v, i, k) for i, row in enumerate(rows) for k, v in enumerate(row) if v >= 4 * (LEAST_WORDS - 1) - 3), reverse=True)
    seen: set[tuple[int, int]] = set()
    for _, i, k in spots:
        ops: list[tuple[bool, bool, int]] = []
        while i >= 0 and (i, k) not in seen and (how := moves[i][k]):
            seen.add((i, k))
            j = i + shift + k - 1 - CASE_EDITS
            if how == 1:
                ops.append((ok[i], item[i] == doc[j], 1))
                i -= 1
            elif how == 2:
                ops.append((ok[i], False, 1))
                i, k = i - 1, k + 1
            else:
                ops.append((True, False, 0))
                k -= 1
        if _holds(ops):
            return True
    return False


def _holds(ops: list[tuple[bool, bool, int]]) -> bool:
    for a in range(len(ops)):
        length = edits = 0
        if not ops[a][1]:
            continue
        for counted, same, words in ops[a:]:
            if not counted:
                break
            length += words
            edits += not same
            if length >= LEAST_WORDS and same and edits * EDIT_SHARE <= length:
                return True
    return False


def find(index: ItemIndex, texts: list[str]) -> list[tuple[int, int]]:
    """(text number, item id) of every case among some plain texts."""
    texts = [_nfc(t) for t in texts]
    out = []
    reach = index.longest + BAND + TIERS[0]
    for (d, n), (lo, hi) in candidates(index, texts).items():
        text = texts[d]
        a = text.rfind(" ", 0, max(0, lo - reach)) + 1
        b = text.find(" ", hi + reach)
        # the whole run of a case lies in a band that reached, so its words start between the first and the last of these
        first, last = text.count(" ", a, max(a, lo - 1)), text.count(" ", a, hi) + 1
        if aligned(index.words[n], index.counts[n], text[a : b if b >= 0 else len(text)].split(" "), index.seeds[n], first, last):
            out.append((d, index.ids[n]))
    return out


@F.pandas_udf(T.StringType())
def _nfc_series(text: pd.Series) -> pd.Series:
    return text.map(_nfc, na_action="ignore")


def judged_items(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(key, t, shared): plain texts, and the numbers of the words at which wording begins that more than SHARED_BY of all
    items hold. The holders are counted over all items, before these are taken in blocks."""
    rows = items.select(F.col(key), _nfc_series(plain(F.col(text))).alias("t")).filter("t <> ''").distinct()
    w = F.split("t", " ")
    many = F.size(w) >= SHARED_NGRAM
    starts = F.when(many, F.sequence(F.lit(0), F.size(w) - SHARED_NGRAM)).otherwise(F.array().cast("array<int>"))
    grams = rows.select(F.col(key), "t", F.explode(starts).alias("k")).withColumn("gram", F.array_join(F.slice(w, F.col("k") + 1, SHARED_NGRAM), " "))
    held = grams.select(key, "gram").distinct().groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHARED_BY).select("gram")
    marks = grams.join(held, "gram", "left_semi").groupBy(key, "t").agg(F.array_sort(F.collect_set("k")).alias("shared"))
    return rows.join(marks, [key, "t"], "left")


def blocks(rows: Iterator[tuple], most: int = ITEM_BLOCK, size: int = ITEM_BYTES) -> Iterator[list[tuple]]:
    """Rows (id, text, ...) in lists of at most ``most`` and about ``size`` characters of text, as they come."""
    block, held = [], 0
    for row in rows:
        if block and (len(block) >= most or held + len(row[1]) > size):
            yield block
            block, held = [], 0
        block.append(row)
        held += len(row[1])
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", item_block: int = ITEM_BLOCK) -> DataFrame:
    """(key, item_key): documents that hold a passage of an item, all pairs, each once.

    The items are a stated query set against all rows. They come to the driver a block at a time, never all; each block
    is a pass over the corpus. Null and blank texts, and items under LEAST_WORDS counted words, have no case. Of an id
    with several texts each counts.
    """
    judged = judged_items(items, item_key, item_text).orderBy(item_key, "t")
    kinds, item_kinds = dict(docs.dtypes), dict(items.dtypes)
    schema = f"`{key}` {kinds[key]}, `{item_key}` {item_kinds[item_key]}"
    corpus = docs.select(F.col(key), plain(F.col(text)).alias("__plain")).filter(F.length("__plain") >= LEAST_WORDS)
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks((tuple(r) for r in judged.toLocalIterator()), item_block):
        shared = docs.sparkSession.sparkContext.broadcast(build_index([r[:2] for r in block], [r[2] or [] for r in block]))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = shared.value
            for pdf in batches:
                keys = pdf[key].tolist()
                for i in range(0, len(pdf), 500):
                    found = find(index, pdf["__plain"].iloc[i : i + 500].tolist())
                    if found:
                        yield pd.DataFrame({key: [keys[i + d] for d, _ in found], item_key: [n for _, n in found]})

        out = out.unionByName(corpus.mapInPandas(run, schema))
    return out.distinct()
