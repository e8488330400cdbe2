"""Noise in text from scanned pages, and its repair.

Running headers are found by fuzzy repetition of lines at page edges, page numbers by their sequence over the
pages; both are removed. Lines are then joined, words broken at line ends or between segments by rules that ask the
corpus vocabulary, and misread words are corrected where a confusion of shapes leads to a word of the vocabulary.

Evidence is counted over whole files, as rows: shapes of lines by file, offsets of numbers by file. What is left for
Python are blocks of BLOCK segments with CONTEXT segments beside them, in which words are put together and looked up;
the context is for words broken between neighbours, not for evidence.

The vocabulary is every word of two clean records. Its HEAD commonest words are broadcast; of the others a block gets
those that it asks for, by a join on their shape (``strokes``), so nothing that is sent grows with the corpus.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.llm.common import latest, settled
from strataline.llm.unify import unify

BLOCK, CONTEXT = 128, 64
#: Words that are broadcast (some MB); the rows don't depend on it.
HEAD = 100_000

# Signs that scans put for letters, and pairs of letters that scans take for each other (read, true).
SIGNS = {"0": "o", "1": "li", "5": "s", "6": "bg", "9": "gq", "8": "b", "3": "e", "4": "a", "|": "li", "!": "il", "@": "a", "€": "e", "$": "s", "†": "t", "‡": "t", "§": "s", "ſ": "fs", "£": "e", "¢": "c", "7": "t", "2": "z"}
SHAPES = [("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("li", "h"), ("h", "li"), ("vv", "w"), ("ii", "u"), ("ri", "n"), ("n", "ri"), ("s", "f"), ("f", "s"), ("l", "i"), ("i", "l"), ("c", "e"), ("e", "c"), ("iii", "m"), ("in", "m"), ("ni", "m"), ("tl", "d"), ("u", "ii"), ("b", "h"), ("nn", "rm"), ("ß", "b")]
#: A second confusion in one word is one of the first so many.
SECOND = 10
NOISE = "·¦^~*¬"
HYPHENS = "-¬\xad‐‑"
# What letters are drawn with, so that letters which scans confuse are drawn alike.
STROKES = {"1": "ilr", "11": "nhbßugq", "111": "m", "c": "cet", "c1": "d", "s": "sf", "vv": "w"}

_BROKEN = regex.compile(rf"([\p{{L}}\p{{M}}’'-]*\p{{L}})([{HYPHENS}])[^\S\n]?\n\s*(\p{{Ll}}[\p{{L}}\p{{M}}]*)")
_BROKEN_HINT = regex.compile(rf"[{HYPHENS}][^\S\n]?\n")
_TAIL = regex.compile(rf"([\p{{L}}\p{{M}}’'-]*\p{{L}})([{HYPHENS}])\s*$")
_HEAD = regex.compile(r"\s*(\p{Ll}[\p{L}\p{M}]*)")
_SPACED = regex.compile(rf"(?<![\p{{L}}\p{{N}}])[\p{{L}}0156|!@€†](?:[ {regex.escape(NOISE)}]{{1,5}}(?:\p{{L}}{{1,2}}|[0156|!@€†])){{3,}}(?![\p{{L}}\p{{N}}])")
_SPACED_HINT = regex.compile(rf"(?:(?<![\p{{L}}\p{{N}}])[\p{{L}}0156|!@€†][ {regex.escape(NOISE)}]{{1,5}}){{3}}")
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_TRIM = regex.compile(r"^[\"'“”„«»‘’(\[{¿¡<]+|[\"'“”„«»‘’)\]}.,;:?…>]+$")
_PATH = regex.compile(r"www\.|//|\.\p{L}{2,4}(?:/|$)|[=_\\]|\S@\S+\.\S|\.\p{L}+[/?]")
_ORDINAL = regex.compile(r"\d+(?:e|er|re|ère|ème|º|ª|o|a|st|nd|rd|th|s|m|g|l|h|kg|km|cm|mm|ml|ha|°)?", regex.I)
_PARTS = regex.compile(r"([-–—/’'])")
_NO_MARKS = regex.compile(r"[^\p{L}\p{M}]")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Devanagari}]")
_SENTENCE_END = regex.compile(r"[.!?…。！？][\"”»’)]*\s*$")
_LATIN = regex.compile(r"\p{Latin}")
_NOISE = regex.compile(rf"[{regex.escape(NOISE)}]")
_JOINED = regex.compile(r"[^\S\n]*\n(?!\s*\n)(?!\s*(?:[•●▪*-]|\d+[.)]))")
_TOKEN = regex.compile(r"\S+")
_STRONG = regex.compile(rf"(?<=\p{{L}})[|!@€†‡{regex.escape(NOISE[:5])}]+(?=\p{{L}})|^[|†€@!](?=\p{{Ll}}{{2}})")
_PAGE = regex.compile(
    r"\s*[-–—\[(·~]*\s*(?:(?:page|seite|página|pagina|pág|pag|стр|с|p|s)[.:]?\s*)?([0-9lISOBoi|!Z]{1,5}|[ivxlcdmIVXLCDM]{1,8})\s*(?:(?:/|von|of|de|sur|из)\s*([0-9lISOBoi|!Z]{1,5}))?\s*[-–—\])·~]*\s*", regex.I
)
_NUMBER = str.maketrans("lISOBoi|!Z", "1150801112")
_ROMAN = regex.compile(r"m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})")


_DRAWN = {ord(x): k for k, xs in STROKES.items() for x in xs}
_DRAWN |= {ord(sign): _DRAWN.get(ord(to[0]), to[0]) for sign, to in SIGNS.items()}


def strokes(word: str) -> str:
    """What a word is drawn with: the same for all words that confusions of shapes and signs lead to one another."""
    return word.lower().translate(_DRAWN)


if any(strokes(a) != strokes(b) for a, b in SHAPES) or any(strokes(a) != strokes(x) for a, xs in SIGNS.items() for x in xs):
    raise ValueError("a confusion changes the strokes")


def vocabulary(texts: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(word, n, strokes), settled: words, also with inner hyphens, of two texts at least; n is the number of rows.

    ``key`` tells texts apart: a text delivered twice is one. First and last holder combine on the map side.
    """
    t = F.lower(F.col(text))
    words = F.array_distinct(F.concat(F.split(t, r"[^\p{L}\p{M}]+"), F.regexp_extract_all(t, F.lit(r"(\p{L}+(?:-\p{L}+)+)"), 1)))
    rows = texts.filter(F.col(text).isNotNull()).select(F.xxhash64(*key).alias("h"), F.explode(words).alias("word")).filter("word <> ''")
    held = rows.groupBy("word").agg(F.min("h").alias("a"), F.max("h").alias("b"), F.count(F.lit(1)).alias("n")).filter("a <> b")
    return settled(held.select("word", "n", _strokes_series(F.col("word")).alias("strokes")))


@F.pandas_udf(T.StringType())
def _strokes_series(word: pd.Series) -> pd.Series:
    return word.map(strokes, na_action="ignore")


class Words:
    """Words by their strokes; a memo of what tokens are."""

    def __init__(self, words: Iterable[str]):
        self.words = frozenset(words)
        self.drawn: dict[str, list[str]] = defaultdict(list)
        for w in sorted(self.words):
            self.drawn[strokes(w)].append(w)


class Lexicon:
    """Vocabulary tests over the broadcast words and those of a block."""

    def __init__(self, head: Words | frozenset[str], more: Iterable[str] = ()):
        self.head, self.more = head if isinstance(head, Words) else Words(head), Words(more)
        self.memo: dict[str, str | None] = {}

    def has(self, word: str) -> bool:
        return word in self.head.words or word in self.more.words

    def drawn_as(self, word: str) -> list[str]:
        k = strokes(word)
        return sorted({*self.head.drawn.get(k, ()), *self.more.drawn.get(k, ())})

    def knows(self, word: str) -> bool:
        """Whether a word is in the vocabulary, as it is or in its one form."""
        low = word.lower()
        return self.has(low) or not low.isascii() and self.has(unify(low))

    def joins(self, a: str, sign: str, b: str) -> str | None:
        """The word of two halves at a line end; None where the hyphen belongs to it and it isn't broken."""
        a_last = regex.split(r"[’']", a)[-1]
        if self.knows(a_last + b) or sign in "¬\xad":
            return a + b
        if "-" in a_last and self.knows(a_last.rsplit("-", 1)[1] + b):
            return a + b
        if self.knows(f"{a_last}-{b}") or self.knows(a_last) and self.knows(b):
            return None
        return a + b

    def misread(self, token: str) -> str | None:
        """What a token of a scan should be; the token itself where it can't be told; None where it is fine."""
        if token not in self.memo:
            self.memo[token] = self._misread(token)
        return self.memo[token]

    def _misread(self, token: str) -> str | None:
        core = _TRIM.sub("", unify(token) or "")
        if _PATH.search(core) or not _WORD.search(core) or _UNSPACED.search(core):
            return None
        if _ORDINAL.fullmatch(core):
            return None
        bad = False
        fixed = []
        for part in _PARTS.split(core):
            to = self._part(part)
            bad |= to is not None
            fixed.append(part if to is None else to)
        return "".join(fixed) if bad else None

    def _part(self, part: str) -> str | None:
        low = part.lower()
        letters = _NO_MARKS.sub("", low)
        if low == letters:
            if len(low) < 3 or self.knows(low) or not _LATIN.search(low):
                return None
            return self.likeliest(low, lambda w: len(w) > 2 and confused(low, w))
        if len(letters) < 1:
            return None
        if part.endswith("!") and (self.knows(low[:-1]) or low[:-1].isalpha()) and not regex.search(r"[0-9|@€†]", part):
            bare = regex.sub(r"!+$", "", low)
            if self.knows(bare) or regex.sub(r"[^\p{L}]", "", bare) == bare:
                return None
        low = _NOISE.sub("", low)
        if low != part.lower() and self.knows(low):
            return low
        if any(c in SIGNS for c in low):
            to = self.likeliest(low, lambda w: len(w) > 1 and len(letters) * 2 >= len(w) and signed(low, w))
            to = to or self.likeliest(low, lambda w: len(low) > 3 and confused(low, w))
            if to is not None:
                return to
        if _STRONG.search(part) and len(letters) >= 3:
            return part
        # digits inside a word of small letters, not a unit, version or code
        if regex.fullmatch(r"\p{Lu}?\p{Ll}*(?:\p{Ll}[0156]\p{Ll}|\p{Ll}{2}[01]|[016]\p{Ll}{3})\p{Ll}*", part) and len(letters) >= 4:
            return part
        return None

    def likeliest(self, low: str, fits) -> str | None:
        """The first word, in alphabetical order, that is drawn alike and fits."""
        return next((w for w in self.drawn_as(low) if fits(w)), None)


class Asking(Lexicon):
    """A lexicon that knows the broadcast words alone and notes the strokes of all others that it is asked for."""

    def __init__(self, head: Words | frozenset[str]):
        super().__init__(head)
        self.asked: set[str] = set()

    def has(self, word: str) -> bool:
        found = word in self.head.words
        if not found:
            self.asked.add(strokes(word))
        return found

    def likeliest(self, low: str, fits) -> str | None:
        self.asked.add(strokes(low))
        return super().likeliest(low, fits)


def signed(low: str, word: str) -> bool:
    """Whether signs put back to letters give the word."""
    return len(low) == len(word) and all(w in SIGNS.get(c, c) for c, w in zip(low, word))


def confused(low: str, word: str) -> bool:
    """Whether confusions of shapes lead from what was read to a word: one, made once or throughout, or one and another of
    the first SECOND. Signs stand for their letters. It walks along both, so the number of ways doesn't matter."""
    if low == word:
        return False
    if any(_throughout(low, word, read, true) for read, true in SHAPES if read in low or true in word):
        return True
    states = {(0, 0, False, False)}
    seen = set(states)
    while states:
        i, j, one, two = states.pop()
        if i == len(low) and j == len(word):
            return True
        after = []
        if i < len(low) and j < len(word) and (low[i] == word[j] or word[j] in SIGNS.get(low[i], "")):
            after.append((i + 1, j + 1, one, two))
        if not one or not two:
            for n, (read, true) in enumerate(SHAPES):
                if word.startswith(true, j) and _reads(low, i, read):
                    if not one:
                        after.append((i + len(read), j + len(true), True, two))
                    if not two and n < SECOND:
                        after.append((i + len(read), j + len(true), one, True))
        for x in after:
            if x not in seen:
                seen.add(x)
                states.add(x)
    return False


def _reads(low: str, i: int, read: str) -> bool:
    return i + len(read) <= len(low) and all(low[i + k] == c or c in SIGNS.get(low[i + k], "") for k, c in enumerate(read))


def _throughout(low: str, word: str, read: str, true: str) -> bool:
    i = j = 0
    while i < len(low):
        if _reads(low, i, read) and word.startswith(true, j):
            i, j = i + len(read), j + len(true)
        elif j < len(word) and (low[i] == word[j] or word[j] in SIGNS.get(low[i], "")):
            i, j = i + 1, j + 1
        else:
            return False
    return j == len(word)


_PAGE_ENDS = regex.compile(r"^\s*\d+\s{2,}|\s*[|•·/–-]?\s*(?:\b\d{1,4}|\b[ivxlc]+)\s*$")
_DIGIT_LETTER = regex.compile(r"(?<=\p{L})[0156](?=\p{L})|(?<=\p{L})[0156](?=\s|$)")
_NO_LETTERS = regex.compile(r"[^\p{L}]+")
_SIGN_TABLE = {ord(c): v[0] for c, v in SIGNS.items() if not c.isdigit()}


@lru_cache(maxsize=50_000)
def skeleton(line: str) -> str:
    """A line's letters in small form, signs put back, without the page number at either end."""
    t = _PAGE_ENDS.sub("", unify(line) or "").lower().translate(_SIGN_TABLE)
    return _NO_LETTERS.sub("", _DIGIT_LETTER.sub(lambda m: {"0": "o", "1": "l", "5": "s", "6": "b"}[m[0]], t))


#: Shares of letters in which copies of a line, and a header and its heading, differ at most.
NEAR, TITLE = 0.2, 0.12


def near(a: str, b: str, share: float = NEAR) -> bool:
    """Whether two skeletons differ in at most ``share`` of their letters (edit distance; a column of it is two numbers,
    whose bits are the steps up and down)."""
    if a == b:
        return True
    most = int(max(len(a), len(b)) * share)
    if abs(len(a) - len(b)) > most:
        return False
    at = _bits(a)
    last, every = 1 << len(a) - 1, (1 << len(a)) - 1
    up, down, edits = every, 0, len(a)
    for rest, x in zip(range(len(b) - 1, -1, -1), b):
        same = at.get(x, 0)
        level = (((same & up) + up) ^ up) | same
        more, less = down | ~(level | up) & every, up & level
        edits += (more & last > 0) - (less & last > 0)
        if edits - rest > most:
            return False
        more, less = more << 1 | 1, less << 1
        up, down = (less | ~(same | down | more)) & every, more & (same | down) & every
    return edits <= most


@lru_cache(maxsize=10_000)
def _bits(shape: str) -> dict[str, int]:
    """The places of each letter, as bits."""
    out: dict[str, int] = defaultdict(int)
    for i, x in enumerate(shape):
        out[x] |= 1 << i
    return dict(out)


def page_value(line: str) -> int | None:
    """The number that a line of nothing but a page number stands for."""
    m = _PAGE.fullmatch(unify(line) or "")
    if not m:
        return None
    s = m[1]
    if s.isdigit():
        return int(s)
    if _ROMAN.fullmatch(s.lower()):
        value = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
        ns = [value[c] for c in s.lower()]
        return sum(-a if b > a else a for a, b in zip(ns, ns[1:] + [0]))
    to = s.translate(_NUMBER)
    return int(to) if to.isdigit() else None


COLUMNS = ["file_id", "segment_id", "reasons", "repaired"]


def mend_block(rows: pd.DataFrame, lexicon: Lexicon) -> list[tuple]:
    """(file_id, segment_id, reasons, repaired text) of a block's own segments.

    ``rows``: file_id, segment_id, pos, type, level, text, skip (numbers of lines of the source's boilerplate), headers and
    numbers (numbers of lines that are page furniture), own (whether the segment is of the block or its context).
    Reasons, sorted: broken, half, header, misread, number. Null text stays null; a text of furniture alone becomes empty.
    """
    rows = rows.sort_values(["pos", "segment_id"], kind="stable")
    texts = [t if isinstance(t, str) else "" for t in rows["text"]]
    levels = [pd.notna(x) and k == "Header" for x, k in zip(rows["level"], rows["type"])]
    given = {c: [set(s) if s is not None and not isinstance(s, float) else set() for s in rows[c]] for c in ("skip", "headers", "numbers")}
    reasons: dict[int, set[str]] = defaultdict(set)
    for n in range(len(texts)):
        reasons[n] |= {name for c, name in (("headers", "header"), ("numbers", "number")) if given[c][n]}
    drop = [a | b for a, b in zip(given["headers"], given["numbers"])]
    body = [(n, i, x) for n, t in enumerate(texts) for i, x in enumerate(t.split("\n")) if x.strip() and i not in given["skip"][n] and i not in drop[n]]
    halves = _halves(body, levels, reasons, lexicon)
    out = []
    for n, (file_id, segment_id, own, t, kind) in enumerate(zip(rows["file_id"], rows["segment_id"], rows["own"], rows["text"], rows["type"])):
        if not own:
            continue
        kept = "\n".join(x for i, x in enumerate(texts[n].split("\n")) if i not in drop[n])
        if kind not in ("Table", "Picture", "Formula", "Equation"):
            kept = _words(kept, n, reasons, lexicon, halves)
        out.append((file_id, segment_id, sorted(reasons[n]), kept if isinstance(t, str) else None))
    return out


def _halves(body, levels, reasons, lexicon: Lexicon) -> dict[int, tuple[str, str]]:
    """Words broken between segments: segment to (the half at its end, the half that follows)."""
    out = {}
    ends = {n: k for k, (n, _, _) in enumerate(body)}
    for k in ends.values():
        n, _, x = body[k]
        m = _TAIL.search(x)
        if not m or levels[n]:
            continue
        best = None
        for j in range(k + 1, min(len(body), k + 5)):
            if body[j][0] == n or levels[body[j][0]]:
                continue
            if (h := _HEAD.match(body[j][2])) is None:
                continue
            if lexicon.knows(regex.split(r"[’']", m[1])[-1] + h[1]):
                best = (j, h[1])
                break
            if best is None and not lexicon.knows(f"{m[1]}-{h[1]}") and not (lexicon.knows(m[1].split("-")[-1]) and lexicon.knows(h[1])):
                best = (j, h[1])
        if best is not None:
            whole = m[1] + best[1]
            reasons[n].add("half")
            reasons[body[best[0]][0]].add("half")
            out[n] = (m[1], whole)
        elif m[2] in "¬\xad" or not lexicon.knows(m[1].split("-")[-1]):
            reasons[n].add("half")
    return out


def _words(text: str, n: int, reasons, lexicon: Lexicon, halves: dict[int, tuple[str, str]]) -> str:
    def join(m: regex.Match) -> str:
        whole = lexicon.joins(m[1], m[2], m[3])
        if whole is None:
            return f"{m[1]}-{m[3]}"
        reasons[n].add("broken")
        return m[1] + m[3]

    if _BROKEN_HINT.search(text):
        text = _BROKEN.sub(join, text)

    def unspace(m: regex.Match) -> str:
        singles = sum(len(x) == 1 for x in regex.split(rf"[ {regex.escape(NOISE)}]+", m[0]))
        word = regex.sub(rf"[ {regex.escape(NOISE)}]", "", m[0])
        to = lexicon.misread(word) or word
        if singles >= 4 and (lexicon.knows(to) or singles >= 5 and len(word) > 5):
            reasons[n].add("misread")
            return to
        return m[0]

    if _SPACED_HINT.search(text):
        text = _SPACED.sub(unspace, text)

    mended = {t: to for t in set(text.split()) if t.lower() not in lexicon.head.words and (to := lexicon.misread(t)) is not None}
    if mended:
        reasons[n].add("misread")

        def mend(m: regex.Match) -> str:
            to = mended.get(m[0])
            if to is None:
                return m[0]
            lead = regex.match(r"[\"'“”„«»‘’(\[{¿¡<]*", m[0])[0]
            trail = regex.search(r"[\"'“”„«»‘’)\]}.,;:?…>]*$", m[0])[0]
            return lead + (to.capitalize() if m[0][len(lead) : len(lead) + 1].isupper() else to) + trail

        text = _TOKEN.sub(mend, text)
    # a half at the end or the start is left to the reader of the whole; its word is completed here
    if n in halves:
        half, whole = halves[n]
        text = regex.sub(rf"{regex.escape(half)}[{HYPHENS}]\s*$", whole, text)
    return _JOINED.sub(" ", text).strip()


# rows ----------------------------------------------------------------------------------------------------------------


@F.pandas_udf(T.StringType())
def _skeletons(line: pd.Series) -> pd.Series:
    return line.map(skeleton, na_action="ignore")


@F.pandas_udf(T.LongType())
def _page_values(line: pd.Series) -> pd.Series:
    return line.map(page_value, na_action="ignore").astype("Int64")


def page_lines(rows: DataFrame) -> DataFrame:
    """(file_id, segment_id, line_no, page, line, value, opens, top, low, edge, single, heading): lines not blank or ``skip``.

    ``opens``: the first of its segment; ``top``: the first of its page; ``low``: how many follow on the page, itself
    counted; ``edge``: no line but page numbers stands above it on its page, or none below it; ``value``: of a line that is
    nothing but a page number; ``single``: the only one of its segment. A segment without page is on that of the one
    before. The lines that can be neither header nor number carry no text.
    """
    order = [F.col("pos"), F.col("segment_id")]
    before = Window.partitionBy("file_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    page = F.coalesce(F.last("page", ignorenulls=True).over(before), F.lit(0))
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("x"), (x.rlike(_MAY_BE_NUMBER) | ~x.rlike(r"\p{L}")).alias("number")))
    kept = F.filter(lines, lambda s: (F.trim(s["x"]) != "") & s["x"].rlike(r"\S") & ~F.coalesce(F.array_contains(F.col("skip"), s["i"]), F.lit(False)))
    heading = F.coalesce((F.col("type") == "Header") & F.col("level").isNotNull(), F.lit(False))
    rows = rows.select("file_id", "segment_id", "pos", page.alias("page"), heading.alias("heading"), kept.alias("kept")).filter(F.size("kept") > 0)
    words = F.transform("kept", lambda s, i: F.when(~s["number"], i))  # before the first and after the last all may be numbers
    rows = rows.select("file_id", "segment_id", "pos", "page", "heading", (F.size("kept") == 1).alias("single"), F.array_min(words).alias("begins"), F.array_max(words).alias("ends"), F.posexplode("kept").alias("nth", "s"))
    text = F.when((F.col("nth") == 0) | F.col("s.number") | F.col("nth").isin(F.col("begins"), F.col("ends")), F.col("s.x"))
    rows = rows.select("file_id", "segment_id", "pos", "page", "heading", "single", F.col("s.i").alias("line_no"), (F.col("nth") == 0).alias("opens"), text.alias("line"))
    rows = rows.withColumn("value", _page_values(F.col("line"))).withColumn("is_text", F.when(F.col("value").isNull(), 1).otherwise(0))
    on_page = Window.partitionBy("file_id", "page").orderBy("pos", "segment_id", "line_no")
    so_far, all_of_it = (on_page.rowsBetween(Window.unboundedPreceding, x) for x in (0, Window.unboundedFollowing))
    rows = rows.withColumns({"nth": F.row_number().over(on_page), "n": F.count(F.lit(1)).over(all_of_it), "texts": F.sum("is_text").over(so_far), "all_texts": F.sum("is_text").over(all_of_it)})
    edge = (F.col("texts") == F.col("is_text")) | (F.col("texts") == F.col("all_texts"))
    rows = rows.withColumns({"top": F.col("nth") == 1, "low": F.col("n") - F.col("nth") + 1, "edge": edge})
    return rows.drop("nth", "n", "is_text", "texts", "all_texts")


#: A line that might be a page number, for the JVM: few letters besides a word for page.
_MAY_BE_NUMBER = r"^[^\p{L}\p{N}]*(?:\p{L}{1,6}[.:]?\s*)?[0-9lISOBoi|!ZivxlcdmVXLCDM]{1,8}(?:\P{L}|von|of|de|sur|из|[lISOBoi|!Z]){0,40}$"


def running_headers(lines: DataFrame, paths: DataFrame) -> DataFrame:
    """(file_id, segment_id, line_no) of the lines that are running headers, or footers.

    ``lines``: those of ``page_lines``; ``paths``: file_id, heading_path. A shape at the top or bottom of a page is a
    header's where another page has it, or one like it, at its top or bottom. At a top a heading of the file counts as a
    copy, too. Other lines at the starts of segments are headers if they are like one of these. All shapes of a file are
    compared (``header_shapes``); its distinct ones pass through Python as rows, file by file. A line that ends a sentence
    is no header, unless it begins one at a page's edge.
    """
    first = lines.filter("(opens or edge) and line is not null and value is null")
    first = first.filter(~F.col("line").rlike(_ENDS_SENTENCE) | F.col("edge") & F.col("line").rlike(r"^[^\p{L}]*[\p{L}&&[^\p{Ll}]]"))
    first = first.withColumn("shape", _skeletons(F.col("line"))).filter(F.length("shape") > 0)
    numbered = F.col("line").rlike(r"^\s*\d+\s{2,}|\|\s*\S+\s*$").alias("numbered")
    first = settled(first.select("file_id", "segment_id", "line_no", "page", "top", "edge", "heading", "single", numbered, "shape"))
    alone = ~F.col("heading") & (F.col("edge") | F.col("single") | F.col("numbered"))
    place = F.when(F.col("edge"), F.col("page"))
    shapes = first.groupBy("file_id", "shape").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.max("top").alias("top"), F.max(alone).alias("alone")).filter("file_id is not null and (lo is not null or alone)")
    parts = paths.filter("file_id is not null and heading_path is not null").select("file_id", F.explode(F.array_distinct(F.split("heading_path", " > "))).alias("part")).distinct()
    parts = parts.select("file_id", _skeletons(F.col("part")).alias("shape")).filter(F.length("shape") > 5).distinct().withColumn("part", F.lit(True))
    rows = shapes.withColumn("part", F.lit(False)).unionByName(parts, allowMissingColumns=True)
    kind = dict(rows.dtypes)["file_id"]
    found = rows.repartition("file_id").sortWithinPartitions("file_id").mapInPandas(_header_shapes, f"file_id {kind}, shape string, known boolean")
    out = first.filter(~F.col("heading")).join(found, ["file_id", "shape"])
    return out.filter(F.col("known") | alone).select("file_id", "segment_id", "line_no")


def _header_shapes(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
    """``header_shapes`` of each file, whose rows follow one another."""
    at, rows, out = None, [], []

    def take() -> pd.DataFrame:
        done = pd.DataFrame(out, columns=["file_id", "shape", "known"])
        out.clear()
        return done

    for pdf in batches:
        columns = [pdf[c].astype(object).where(pdf[c].notna(), None).tolist() for c in ("file_id", "shape", "lo", "hi", "top", "alone", "part")]
        for file_id, *row in zip(*columns):
            if rows and file_id != at:
                out += [(at, shape, known) for shape, known in header_shapes(rows).items()]
                rows = []
            at = file_id
            rows.append(row)
        if out:
            yield take()
    out += [(at, shape, known) for shape, known in header_shapes(rows).items()]
    if out:
        yield take()


def header_shapes(rows: Iterable[tuple]) -> dict[str, bool]:
    """The shapes of a file's running headers: True for one that is repeated, False for one that is like a repeated one.

    ``rows``: shape, first and last page that has it at its top or bottom (None: none), whether it is at a top, whether it
    may be like a header elsewhere, whether it is a heading of the file instead.
    """
    rows = list(rows)
    edges = {shape: (lo, hi, top) for shape, lo, hi, top, _, part in rows if not part and lo is not None}
    known = {shape for shape, (lo, hi, _) in edges.items() if lo < hi}
    repeated, lone = Shapes(), Shapes()

    def copies(a: str, b: str) -> bool:
        return min(edges[a][0], edges[b][0]) < max(edges[a][1], edges[b][1]) and near(a, b)

    # a lone shape is compared with all; one that is known needs no more copies, but others may need it
    for shape in edges:
        if shape not in known and any(copies(shape, x) for x in repeated.meeting(shape)):
            known.add(shape)
        for other in [x for x in lone.meeting(shape) if copies(shape, x)]:
            known |= {shape, other}
            lone.drop(other)
            repeated.add(other)
        (repeated if shape in known else lone).add(shape)
    for part in (row[0] for row in rows if row[5]):
        known.update([x for x in lone.meeting(part) if edges[x][2] and near(x, part, TITLE)])
    long = Shapes(shape for shape in sorted(known) if len(shape) > 7)
    others = {shape for shape, _, _, _, alone, part in rows if alone and not part} - known
    like = {shape for shape in others if any(near(shape, x) for x in long.meeting(shape))}
    return dict.fromkeys(known, True) | dict.fromkeys(like, False)


class Shapes:
    """Shapes by their parts, cut so that one that is ``near`` another has some of its parts whole, at a place as far off as
    letters may be dropped or added. What doesn't meet isn't near, so not all pairs are compared."""

    def __init__(self, shapes: Iterable[str] = ()):
        self.parts: dict[str, list[tuple[str, int]]] = defaultdict(list)
        self.lengths: set[int] = set()
        for shape in shapes:
            self.add(shape)

    def add(self, shape: str) -> None:
        for a, b in _cuts(len(shape)):
            self.parts[shape[a:b]].append((shape, a))
            self.lengths.add(b - a)

    def drop(self, shape: str) -> None:
        for a, b in _cuts(len(shape)):
            self.parts[shape[a:b]].remove((shape, a))

    def meeting(self, shape: str) -> Iterable[str]:
        """Those that may be near a shape, by its rarest parts first."""
        places = [(at, at + n) for n in self.lengths for at in range(len(shape) - n + 1) if shape[at : at + n] in self.parts]
        shared: dict[str, set[int]] = defaultdict(set)
        for at, end in sorted(places, key=lambda x: len(self.parts[shape[x[0] : x[1]]])):
            for other, a in self.parts[shape[at:end]]:
                most = int(max(len(other), len(shape)) * NEAR)
                if abs(len(other) - len(shape)) <= most and abs(a - at) <= most and a not in shared[other]:
                    shared[other].add(a)
                    if len(shared[other]) == len(_cuts(len(other))) - most:
                        yield other


@lru_cache(maxsize=None)
def _cuts(length: int) -> list[tuple[int, int]]:
    """The places of the parts of a shape: one more than edits may lead from it to the longest that is near."""
    longest = max(n for n in range(length, 2 * length + 1) if n - int(n * NEAR) <= length)
    parts = int(longest * NEAR) + 1
    return [(i * length // parts, (i + 1) * length // parts) for i in range(parts)]


_ENDS_SENTENCE = r"[.!?…。！？][\"”»’)]*\s*$"


def page_numbers(lines: DataFrame) -> DataFrame:
    """(file_id, segment_id, line_no) of the lines that are page numbers: nothing but a number, at a page's edge, alone in
    its segment or decorated, or in step with the numbers of other pages of the file."""
    rows = lines.filter("value is not null")
    decorated = F.col("line").rlike(r"[–\-\[/(]|\p{L}{3,}|p\.")
    rows = settled(rows.select("file_id", "segment_id", "line_no", "page", "single", (F.col("top") | (F.col("low") <= 3)).alias("edge"), decorated.alias("decorated"), (F.col("value") - F.col("page")).alias("offset")))
    steps = rows.groupBy("file_id", "offset").agg(F.count_distinct("page").alias("pages")).filter("pages > 1")
    near_by = steps.select("file_id", F.explode(F.array(*[F.col("offset") + d for d in (-1, 0, 1)])).alias("offset")).distinct().withColumn("in_step", F.lit(True))
    rows = rows.join(near_by, ["file_id", "offset"], "left")
    ok = (F.col("in_step").isNotNull() & (F.col("single") | F.col("edge"))) | (F.col("edge") & (F.col("single") | F.col("decorated")))
    return rows.filter(ok).select("file_id", "segment_id", "line_no")


def mend_segments(segments: DataFrame, boilerplate: DataFrame | None, words: DataFrame, head: int = HEAD) -> DataFrame:
    """(file_id, segment_id, reasons, repaired) of each segment of scanned files.

    ``segments``: file_id, segment_id, pos, type, level, page, heading_path, text, ingested_at; of repeated rows the
    latest counts. ``boilerplate``: (file_id, segment_id, line_no) of the source's lines, which are no furniture.
    ``words``: the corpus vocabulary (``vocabulary``). A group has at most 2 * BLOCK segments.
    """
    own = ["pos", "type", "level", "page", "heading_path", "text"]
    rows = latest(segments, ["file_id", "segment_id"], "ingested_at", own).withColumn("pos", F.coalesce("pos", F.lit(0)))
    numbers = lambda df, c: df.groupBy("file_id", "segment_id").agg(F.collect_set(F.col("line_no").cast("int")).alias(c))
    if boilerplate is None:
        rows = rows.withColumn("skip", F.lit(None).cast("array<int>"))
    else:
        rows = rows.join(numbers(boilerplate, "skip"), ["file_id", "segment_id"], "left")
    rows = settled(rows)
    lines = settled(page_lines(rows).filter("line is not null"))
    headers, counted = running_headers(lines, rows.select("file_id", "heading_path").distinct()), page_numbers(lines)
    marks = headers.withColumn("kind", F.lit("headers")).unionByName(counted.withColumn("kind", F.lit("numbers")))
    marks = marks.groupBy("file_id", "segment_id").agg(*[F.collect_set(F.when(F.col("kind") == c, F.col("line_no"))).alias(c) for c in ("headers", "numbers")])
    rows = rows.drop("page", "heading_path").join(marks, ["file_id", "segment_id"], "left")
    home = F.floor(F.col("pos") / BLOCK).cast("int")
    blocks = F.array_distinct(F.array(home, F.floor((F.col("pos") - CONTEXT) / BLOCK).cast("int"), F.floor((F.col("pos") + CONTEXT) / BLOCK).cast("int")))
    rows = rows.withColumn("block", F.explode(blocks)).withColumn("own", F.col("block") == home)
    kind = dict(segments.dtypes)["file_id"]
    common = [r[0] for r in words.orderBy(F.desc("n"), "word").limit(head).select("word").toLocalIterator()]
    shared = segments.sparkSession.sparkContext.broadcast(frozenset(common))
    schema = f"file_id {kind}, segment_id string, reasons array<string>, repaired string"

    def mend(pdf: pd.DataFrame, known: Iterable[str] = ()) -> pd.DataFrame:
        if not pdf["own"].any():
            return pd.DataFrame(columns=COLUMNS)
        return pd.DataFrame(mend_block(pdf, _lexicon(shared, known)), columns=COLUMNS)

    if len(common) < head:  # all words are broadcast, so nothing is left to ask for
        return rows.groupBy("file_id", "block").applyInPandas(lambda pdf: mend(pdf), schema)
    rows = settled(rows)

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        lexicon = Asking(_head(shared))
        mend_block(pdf, lexicon)
        out = pd.DataFrame({"strokes": sorted(lexicon.asked)}, dtype=object)
        return out.assign(file_id=pdf["file_id"].iloc[0], block=pdf["block"].iloc[0])[["file_id", "block", "strokes"]]

    asked = rows.groupBy("file_id", "block").applyInPandas(ask, f"file_id {kind}, block int, strokes string")
    # a question that every block asks meets a handful of words; adaptive execution splits it where it is large
    known = asked.join(words.select("word", "strokes"), "strokes").select("file_id", "block", "word")
    both = rows.groupBy("file_id", "block").cogroup(known.groupBy("file_id", "block"))
    return both.applyInPandas(lambda pdf, more: mend(pdf, more["word"]) if len(pdf) else pd.DataFrame(columns=COLUMNS), schema)


_heads: dict[int, Words] = {}
_lexicons: dict[int, Lexicon] = {}


def _head(shared) -> Words:
    """The broadcast words, indexed once for each worker."""
    words = shared.value
    if id(words) not in _heads:
        _heads.clear()
        _lexicons.clear()
        _heads[id(words)] = Words(words)
    return _heads[id(words)]


def _lexicon(shared, known: Iterable[str]) -> Lexicon:
    head, known = _head(shared), list(known)
    if known:
        return Lexicon(head, known)
    if id(head) not in _lexicons or len(_lexicons[id(head)].memo) > 500_000:
        _lexicons[id(head)] = Lexicon(head)
    return _lexicons[id(head)]


def mend_chunks(chunks: DataFrame, mended: DataFrame) -> DataFrame:
    """(chunk_id, reasons, repaired) of chunks of scanned files: the content with each of its segments' texts repaired.

    ``chunks``: chunk_id, file_id, content, source_segments; ``mended``: file_id, segment_id, text, reasons, repaired. A
    segment counts where its text stands in the content, after those before it; what is no segment's text stays. Null
    contents have no row's reasons and stay null.
    """
    parts = chunks.select("chunk_id", "file_id", F.posexplode("source_segments").alias("nth", "segment_id"))
    told = mended.filter((F.size("reasons") > 0) | (F.trim("text") != F.col("repaired"))).select("file_id", "segment_id", F.trim("text").alias("t"), "reasons", F.coalesce("repaired", F.lit("")).alias("r"))
    found = parts.join(told, ["file_id", "segment_id"]).groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("nth", "t", "r", "reasons"))).alias("parts"))
    start = F.struct(F.lit("").alias("done"), F.col("content").alias("rest"), F.array().cast("array<string>").alias("reasons"))

    def step(s: Column, x: Column) -> Column:
        at = F.instr(s["rest"], x["t"])
        hit = F.coalesce((x["t"] != "") & (at > 0), F.lit(False))
        done = F.concat(s["done"], F.substr(s["rest"], F.lit(1), at - 1), x["r"])
        rest = F.substr(s["rest"], at + F.length(x["t"]))
        new = F.struct(done.alias("done"), rest.alias("rest"), F.array_sort(F.array_union(s["reasons"], x["reasons"])).alias("reasons"))
        return F.when(hit, new).otherwise(s)

    out = chunks.select("chunk_id", "content").join(found, "chunk_id", "left")
    empty = F.array().cast("array<struct<nth:int,t:string,r:string,reasons:array<string>>>")
    out = out.withColumn("m", F.aggregate(F.coalesce("parts", empty), start, step))
    text = F.trim(F.regexp_replace(F.concat("m.done", "m.rest"), r"\s*\n\s*\n\s*", "\n\n"))
    return out.select("chunk_id", F.col("m.reasons").alias("reasons"), text.alias("repaired"))
