"""One consistent form for texts that look the same.

A longest-match transducer over grapheme clusters applies a mapping for widths, accents, spaces, invisible
characters, compatibility shapes and look-alike letters in one pass. The mapping is built from Unicode's own
decompositions, over all planes, and a table of look-alikes, and checked for conflicts when it is built: no key may map
to two forms, and no form may itself be a key, so that the transducer is idempotent.

A look-alike letter takes the script of its word: that of the word's letters which look like no other script's; a word
without such letters takes the script that most of the text's have, else Latin. What a reader sees decides alone, so
texts that look the same get the same form, and ordinary words of any script stay in it.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.llm.common import settled, small

# Letters of other scripts that look like Latin ones in common fonts.
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "Ү": "Y",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "ϳ": "j", "ɑ": "a", "ɡ": "g", "У": "Y", "օ": "o", "ս": "u", "հ": "h", "ց": "g",
}
#: Scripts whose words keep their own letters.
SCRIPTS = ("CYRILLIC", "GREEK", "ARMENIAN")
#: Decomposition kinds by which a character looks the same but for width, position in a word, ligature or space.
SAME_SHAPE = ("wide", "narrow", "noBreak", "compat", "initial", "medial", "final", "isolated", "vertical", "font")


@lru_cache(maxsize=1)
def invisible() -> list[str]:
    """Characters without a shape of their own, by their Unicode property; Hangul fillers are as wide as a letter."""
    planes = [0, 1, 2, 3, 14]
    every = "".join(chr(c) for p in planes for c in range(p << 16, (p + 1) << 16) if not 0xD800 <= c < 0xE000)
    return regex.findall(r"(?![\u115f\u1160\u3164\uffa0])\p{Default_Ignorable_Code_Point}", every)


def _shape(ch: str) -> str | None:
    """What a single character turns into by Unicode's decomposition, or None."""
    spec = unicodedata.decomposition(ch)
    if not spec.startswith("<"):
        to = unicodedata.normalize("NFC", ch)  # one that stands for another whole character
        return to if spec and to != ch and len(to) == 1 else None
    kind, *codes = spec.split()
    if kind[1:-1] not in SAME_SHAPE:
        return None
    to = "".join(chr(int(c, 16)) for c in codes)
    if kind == "<compat>" and (not to.isalpha() or len(to) > 3) and not to.startswith(" "):
        return None  # enclosed numbers, dotted leaders, fractions look different
    return to


@lru_cache(maxsize=1)
def mapping() -> dict[str, str]:
    """The checked mapping of single characters and of half-width kana with sound marks."""
    table: dict[str, str] = {c: "" for c in invisible()}
    for c in range(0x80, sys.maxunicode + 1):
        ch = chr(c)
        if 0xD800 <= c < 0xE000 or ch in table:
            continue
        if unicodedata.category(ch) == "Zs":
            table[ch] = " "
        elif (to := _shape(ch)) is not None and not unicodedata.combining(to[0]) and to.strip():
            table[ch] = to
    table |= {"µ": "μ", "ﾞ": "゙", "ﾟ": "゚"}
    for a, b in LOOK_ALIKES.items():
        if table.get(a, b) != b:
            raise ValueError(f"two forms for {a!r}")
        table[a] = b
    # a Cyrillic letter with a mark on a look-alike looks like the Latin one with it
    for c in range(0x400, 0x530):
        parts = unicodedata.normalize("NFD", chr(c))
        if len(parts) > 1 and parts[0] in LOOK_ALIKES and len(to := unicodedata.normalize("NFC", LOOK_ALIKES[parts[0]] + parts[1:])) == 1:
            table[chr(c)] = to
    # chains are followed to their end once, so that one pass is enough
    for a in table:
        to, seen = table[a], set()
        while (step := "".join(table.get(x, x) for x in unicodedata.normalize("NFC", to))) != to:
            if step in seen:
                raise ValueError(f"the forms of {a!r} go round")
            seen.add(step)
            to = step
        table[a] = to
    if bad := [a for a, b in table.items() if any(x in table and table[x] != x for x in b)]:
        raise ValueError(f"forms that are keys: {bad[:5]}")
    return table


@lru_cache(maxsize=1)
def _own_letters() -> tuple[dict[str, dict[int, str]], dict[str, regex.Pattern]]:
    """For each script the letters that Latin look-alikes stand for in it, and a test for letters that are its alone."""
    back: dict[str, dict[int, str]] = {s: {} for s in SCRIPTS}
    for a, b in LOOK_ALIKES.items():
        script = unicodedata.name(a).split()[0]
        if script in back and (b not in map(chr, back[script]) or a == "У"):
            back[script][ord(b)] = a
    latin = "".join(sorted({b for b in LOOK_ALIKES.values()}))
    own = {s: regex.compile(rf"\p{{{s.title()}}}") for s in SCRIPTS}
    own["LATIN"] = regex.compile(rf"(?![{latin}])\p{{Latin}}")
    return back, own


_WORD = regex.compile(r"[\p{L}\p{M}]+")
_OTHER = regex.compile(r"[\p{Cyrillic}\p{Greek}\p{Armenian}]")


def _in_script(form: str) -> str:
    """A form of Latin look-alikes with each word in its own script."""
    back, own = _own_letters()
    bare = unicodedata.normalize("NFD", form)
    seen = {s: len(p.findall(bare)) for s, p in own.items()}
    # ties: Latin, then the order of SCRIPTS
    most = max(("LATIN", *SCRIPTS), key=lambda s: seen[s])

    def word(m: regex.Match) -> str:
        w = unicodedata.normalize("NFD", m[0])
        if own["LATIN"].search(w):
            return m[0]
        script = next((s for s in SCRIPTS if own[s].search(w)), most)
        return unicodedata.normalize("NFC", w.translate(back[script])) if script in back else m[0]

    return _WORD.sub(word, form)


# Sequences of Thai vowel signs that look like another one.
SEQUENCES = {"\u0e4d\u0e32": "\u0e33", "\u0e40\u0e40": "\u0e41"}


@lru_cache(maxsize=1)
def _transducer() -> tuple[dict[int, str], regex.Pattern, regex.Pattern, dict[str, str]]:
    """Compiled forms: the table for clusters of one character; a test for any longer cluster that has a form of
    its own; the transducer for texts with such clusters, the longest alternative first; its memo."""
    keys = "".join(regex.escape(k) for k in mapping())
    composing = {unicodedata.normalize("NFD", chr(c))[-1] for c in range(0xC0, 0x3100) if len(unicodedata.normalize("NFD", chr(c))) > 1}
    marks = "".join(regex.escape(x) for x in sorted({x for x in composing if unicodedata.category(x) == "Mn"} | {"゙", "゚", "ﾞ", "ﾟ"}))
    hidden = "".join(map(regex.escape, invisible()))
    longer = "|".join(map(regex.escape, SEQUENCES))
    return (
        {ord(k): v for k, v in mapping().items()},
        regex.compile(rf"[{marks}]|{longer}"),
        regex.compile(rf"[^\s\p{{M}}](?:[{hidden}]*[{marks}])+|{longer}|[{keys}]"),
        {},
    )


def _cluster(c: str, known: dict[str, str]) -> str:
    form = SEQUENCES.get(c) or unicodedata.normalize("NFC", "".join(mapping().get(x, x) for x in c))
    out = "".join(mapping().get(x, x) for x in form)
    if len(known) < 100_000:  # a memo, not a limit on what is mapped
        known[c] = out
    return out


def unify(text: str | None) -> str | None:
    """The one form of a text. Null stays null; ASCII texts are their own form; unify(unify(x)) == unify(x)."""
    if text is None or text.isascii():
        return text
    single, longer, pattern, known = _transducer()
    if not longer.search(text):
        form = text.translate(single)
    else:
        form = pattern.sub(lambda m: known[m[0]] if m[0] in known else _cluster(m[0], known), text)
    return _in_script(form) if _OTHER.search(form) else form


@F.pandas_udf(T.StringType())
def _unify_series(text: pd.Series) -> pd.Series:
    return text.map(unify, na_action="ignore")


def unified(c: Column) -> Column:
    """Column of the one form; texts of ASCII alone don't leave the JVM."""
    odd = c.rlike(r"[^\x00-\x7F]")
    return F.when(odd, _unify_series(F.when(odd, c))).otherwise(c)


def look_alike_pairs(records: DataFrame, group: str, key: str, text: str) -> DataFrame:
    """Pairs (group, key_a, key_b) of records of one group whose texts have one form but differ in code points.

    Null and empty texts make no pair; repeated rows count once; rows without a group make none. Only keys and hashes are
    shuffled. One pass makes the forms of all records; forms of a single spelling are left out by their first and last
    spelling, which combine on the map side. What is left are the records that do make pairs: each meets only those of
    its form with another spelling, split by its own spelling, so that a wording which a file prints again and again meets
    in as many tasks as it has spellings.
    """
    form = F.col("__form")
    rows = (
        records.filter((F.length(F.col(text)) > 0) & F.col(group).isNotNull() & F.col(key).isNotNull())
        .withColumn("__form", unified(F.col(text)))
        .select(group, key, F.xxhash64(form, F.length(form)).alias("form"), F.xxhash64(F.col(text), F.lit(3)).alias("spelling"))
    )
    rows = settled(rows.distinct())
    spellings = rows.select(group, "form", "spelling").distinct()
    ends = spellings.groupBy(group, "form").agg(F.min("spelling").alias("lo"), F.max("spelling").alias("hi")).filter("lo <> hi").select(group, "form")
    kept = settled(rows.join(small(settled(ends)), [group, "form"], "left_semi"))
    several = kept.select(group, "form", "spelling").distinct()
    # each record goes to the other spellings of its form
    a = kept.select(group, "form", F.col(key).alias("key_a"), F.col("spelling").alias("sa"))
    meets = a.join(several.withColumnRenamed("spelling", "sb"), [group, "form"]).filter("sa <> sb")
    b = kept.select(group, "form", F.col(key).alias("key_b"), F.col("spelling").alias("sb"))
    return meets.join(b, [group, "form", "sb"]).filter("key_a < key_b").select(group, "key_a", "key_b").distinct()
