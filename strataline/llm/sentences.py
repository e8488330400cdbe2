"""Sentence boundaries by cascading segmentation rules.

A *rule* says break or no break at a position whose left context ends with ``before`` and whose right
context starts with ``after``. A language has an ordered cascade of tables; at each candidate position the
first rule that matches decides. Candidates are the ends of stop marks (with the closing marks, quotes and
brackets that belong to them) and, in Thai, spaces.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPANS = T.ArrayType(T.StructType([T.StructField("start_char", T.IntegerType()), T.StructField("end_char", T.IntegerType())]))


@dataclass(frozen=True)
class Rule:
    """``brk`` at a position between ``before`` (matched up to it) and ``after`` (matched from it)."""

    brk: bool
    before: str
    after: str


# Abbreviations. "never" ones never end a sentence; the others may, before a capital.
NEVER = {
    "en": "Dr Prof Mr Mrs Ms Rev Gen Col Capt Lt Sgt Sen Rep Hon St Mt Ft Messrs cf vs viz approx ca i.e e.g Fig Figs Eq Eqs Sec Secs Ch Chap Vol Vols No Nos pp p ed eds al ibid resp incl esp est dept cap",
    "de": "Dr Prof Hr Fr Frl Hrn Fa St Abb Nr Nrn Kap Bd Bde Tab S Hrsg hrsg ca bzw vgl Vgl z d u v i a b o bspw ggf inkl exkl evtl sog zzgl Art Abs Anm geb gest Mio Mrd Tel Str mind max zz allg",
    "fr": "M MM Mme Mmes Mlle Dr Pr Prof Me St Ste fig Fig chap Chap p pp vol n art env cf Cf éd coll av apr c ex tél",
    "es": "Sr Sra Sres Srta Dr Dra Prof Profa Lic Ing D Dña Ud Uds Vd fig Fig figs cap Cap pág págs p pp vol núm Núm art EE p.ej ej aprox tel Av Avda",
    "pt": "Sr Sra Srs Dr Dra Prof Profa Eng Exmo Exma D fig Fig figs cap Cap pág págs p pp vol n nº art ex aprox tel Av",
    "ru": "т е д п г. проф Проф акад доц д-р Д-р им рис Рис табл Табл гл Гл с С стр см См ср Ср л ст п пп ул просп тыс млн млрд напр ок св",
    "hi": "डॉ श्री प्रो सुश्री",
}
MAY = {
    "en": "etc a.m p.m Jan Feb Mar Apr Jun Jul Aug Sept Sep Oct Nov Dec Ltd Co Inc Corp Jr Sr Bros",
    "de": "usw etc Jan Feb Aug Sept Okt Nov Dez Co dgl",
    "fr": "etc janv févr juill sept oct nov déc",
    "es": "etc ene feb abr ago sept oct nov dic UU Cía",
    "pt": "etc jan fev abr ago set out nov dez Cia",
    "ru": "г гг в вв др м см км кг руб коп",
    "hi": "",
}
# Function words by which a text in Latin letters tells its language.
MARKS = {
    "en": "the of and each every this that when by to in is",
    "de": "der die das und den dem des ein eine bei mit nach laut ist von",
    "fr": "le la les et des du une dans que sur est après pendant l d",
    "es": "el los las y del una según durante después que por en",
    "pt": "o os as e do da dos uma durante em que não depois ao",
}
# Closing and opening marks.
CLOSE = "”’\"'»)\\]}›」』）】］〉》"
OPEN = "“‘„‚\"'«(\\[{‹「『（【［〈《¿¡—–-"
STOP = ".!?…"
WIDE = "。！？｡．।॥"

_SPEECH_ZH = r"[^。！？“”\s]{1,15}?(?:[道说問问答]|指出|表示|回答)(?=[。，：；,.]|$)"
_SPEECH_JA = r"(?:と(?!き|し)|って|との|という|などと)"
_MIXED = r"\s+\p{Ll}{1,4}\p{Lu}"


def _any(words: str) -> str:
    return "|".join(regex.escape(w) for w in sorted(words.split(), key=len, reverse=True))


def common_rules() -> list[Rule]:
    """Rules that hold in every language that uses spaces; the language's own come before them."""
    return [
        # bracketed year or reference after a name, an ordinal or a list number
        Rule(False, r"(?:^|\n)\s*(?:\(?\d{1,3}|\(?\p{L})[.)]", r"\s"),
        # quoted speech with its own stop, carried on by a lower-case word or a dash
        Rule(False, rf"[.!?…]\s?[{CLOSE}]+", r"\s*[\p{Ll}—–,;:]"),
        Rule(False, rf"[.!?…]+", r"\s*[,;:)]"),
        Rule(True, rf"[.!?…]+[{CLOSE}]*", _MIXED),
        # dots of an interrupted sentence
        Rule(False, r"(?:\.\.+|…)", r"\s+[\p{Ll}—–]"),
        Rule(False, rf"[.!?][{CLOSE}]*", r"\s+\p{Ll}"),
        # initials and letters with stops
        Rule(False, r"(?<![\p{L}\p{N}])\p{Lu}\.", r"[  \n]?\p{Lu}"),
        Rule(False, r"(?:\p{L}\.){2,}", r"[  ]\p{Ll}"),
        Rule(True, rf"[.!?…][{CLOSE}\s]*", r"\s+\S"),
        # a stop without space, between a small letter and a capitalised word
        Rule(True, rf"(?:[\p{{Ll}}\p{{N}}]{{2}}|[{CLOSE}])[.!?…]+[{CLOSE}]*", r"[“„«(]?\p{Lu}\p{Ll}*[\s,’']"),
        Rule(True, rf"\p{{Ll}}[.!?…]+[”»)]+", r"[“„«(]"),
        Rule(True, rf"[.!?…][{CLOSE}\s]*", r"\s*$"),
    ]


def language_rules(lang: str) -> list[Rule]:
    """The cascade of one language, in order."""
    if lang in ("zh", "ja"):
        return [
            Rule(False, r"[。！？｡!?．][”」』）)》]+", _SPEECH_JA if lang == "ja" else _SPEECH_ZH),
            Rule(False, r"[」』”]", r"[、，,]"),
            Rule(False, r"…+", r"."),
            Rule(True, rf"[。！？｡][{CLOSE}]*", ""),
            Rule(True, rf"[!?．][{CLOSE}]*", r"(?!\p{N})"),
            Rule(True, rf"\.[{CLOSE}]*", r"\s+[\p{Han}\p{Hiragana}\p{Katakana}“「（]|\s*$"),
            Rule(False, r".", r""),
        ]
    if lang == "th":
        return [
            Rule(False, r"(?:ดร|ศ|รศ|ผศ|น|พ\.ศ|ค\.ศ|จ|อ|ต|ถ|เช่น|คือ|ๆ|ฯลฯ)\.?", r"\s+\S"),
            Rule(False, r"[\p{N}\p{Latin}]", r"\s+"),
            Rule(False, r"\S", r"\s+[\p{N}\p{Latin}ๆ]"),
            Rule(True, r"[\p{Thai}”\")!?.]", r"[  　\t]+[\p{Thai}“\"(]"),
            Rule(False, r".", r""),
        ]
    own: list[Rule] = []
    if lang == "ru":
        own += [Rule(True, r"\bт\. [дп]\.", r"\s+\p{Lu}"), Rule(False, r"\bт\.", r"\s?[едпк]\.")]
    if never := NEVER.get(lang):
        own.append(Rule(False, rf"(?<![\p{{L}}\p{{N}}])(?:{_any(never)})\.", r"\s*\S"))
    if lang == "de":
        own += [
            Rule(False, r"\b(?:[Dd]e[rmns]|[Dd]ie|[Dd]as|[Ii]m|[Aa]m|[Vv]om|[Zz]um|[Zz]ur|[Bb]is|seit|und)\s+\d{1,2}\.", r"\s+\p{Lu}"),
            Rule(False, r"\b\d{1,2}\.", r"\s+(?:Quartal|Jahrhundert|Kapitel|Auflage|Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)\b"),
            Rule(False, r"\bv\. H\.", r"\s+\p{Ll}"),
        ]
    if lang == "ru":
        own.append(Rule(False, r"\b(?:г|д|с|пос)\.", r"[  ]\p{Lu}\p{Ll}+(?:е|а|у|ом)?\b(?=[^.!?]{0,12}[,.)])"))
    if lang == "es":
        own.append(Rule(False, r"\bp\. ?ej\.", r"\s*\S"))
    if may := MAY.get(lang):
        own += [
            Rule(False, rf"(?<![\p{{L}}\p{{N}}])(?:{_any(may)})\.", r"\s*(?:\p{Ll}(?!\p{Lu})(?!\p{Ll}{0,3}\p{Lu})|[,;:&(–-])"),
            Rule(False, r"(?<!\p{L})(?:\p{Lu}\p{Ll}{2,4})\.", r"\s+\d{1,2}(?:,|\s*[-–]\s*\d|\s+\d{4}\b)"),
            Rule(False, r"\bCo\.", r"\s+(?:Ltd|KG|Inc)\b"),
        ]
    own.append(Rule(False, r"\bal\.", r"\s*[(\[]"))
    if lang == "hi":
        own.append(Rule(True, rf"[।॥!?][{CLOSE}]*", r"\s*\S"))
        own.append(Rule(False, r"[\p{Devanagari}]\.", r"\s*\S"))
    return own + common_rules()


@dataclass(frozen=True)
class Cascade:
    """A compiled table: one alternation of (look-behind, look-ahead) pairs; the group that matched is the deciding rule."""

    candidates: regex.Pattern
    decide: regex.Pattern
    breaks: tuple[bool, ...]


@lru_cache(maxsize=None)
def cascade(lang: str) -> Cascade:
    rules = language_rules(lang)
    decide = "|".join(f"(?<={r.before})(?={r.after})()" for r in rules)
    stop = rf"(?:[{STOP}]+|[{WIDE}]+)(?:[{CLOSE}]+|[   ]»|“(?=\s|$|[,;.]))*"
    return Cascade(regex.compile(rf"{stop}|(?<=\S)(?=[  　\t])" if lang == "th" else stop), regex.compile(decide), tuple(r.brk for r in rules))


_STOPPED = regex.compile(rf"[{STOP}{WIDE}]\s?[{CLOSE}]+$")
_PARA = regex.compile(r"\n[^\S\n]*\n\s*")
# Pairs of quotes and brackets, and what may stand between them.
PAIRS = [r"“[^“”]*”", r"„[^„“”]*[“”]", r"«[^«»]*»", r"(?<![\p{L}\p{N}])\"[^\"]*\"", r"\([^()]*\)", r"（[^（）]*）", r"「[^「」]*」", r"『[^『』]*』", r"\[[^\[\]]*\]"]
#: The first rule of every cascade: no break between the marks of a pair. It gives way to the rest of the cascade where
#: the pair holds whole sentences, that is, where it opens a sentence and its end is a break by the other rules.
INSIDE = regex.compile("|".join(PAIRS))
_SCRIPTS = {"ja": r"[\p{Hiragana}\p{Katakana}]", "zh": r"\p{Han}", "th": r"\p{Thai}", "hi": r"\p{Devanagari}", "ru": r"\p{Cyrillic}"}
_SCRIPT_PATTERNS = {k: regex.compile(v + "+") for k, v in _SCRIPTS.items()}
_ODD = regex.compile(r"[^\x00-\u02ff\u2000-\u206f]")
_TELLS: dict[str, list[str]] = {}
for _lang, _words in MARKS.items():
    for _word in _words.split():
        _TELLS.setdefault(_word, []).append(_lang)
_TOKEN = regex.compile(r"\p{L}+")


def language(text: str) -> str:
    """The rule table for a text: by script; among Latin ones by function words (ties: the first of MARKS)."""
    if not text.isascii() and _ODD.search(text):
        seen = {k: sum(map(len, p.findall(text))) for k, p in _SCRIPT_PATTERNS.items()}
        if 8 * seen["ja"] >= seen["ja"] + seen["zh"] > 0:
            seen["ja"] += seen.pop("zh")
        best = max(seen, key=lambda k: seen[k])
        if seen[best] * (6 if best in ("zh", "ja") else 2) > sum(map(str.isalpha, text)):
            return best
    counts = dict.fromkeys(MARKS, 0)
    for w in _TOKEN.findall(text.lower()):
        for k in _TELLS.get(w, ()):
            counts[k] += 1
    return max(counts, key=lambda k: counts[k])


def spans(text: str | None, lang: str | None = None) -> list[tuple[int, int]]:
    """Sentence spans of a text: (start, end) in code points, in order, trimmed of white space.

    Null, empty and blank texts have none. Together the spans hold every character that isn't white space.
    """
    if not text or text.isspace():
        return []
    table = cascade(lang or language(text))
    out: list[tuple[int, int]] = []
    start = 0
    for m in [*_PARA.finditer(text), None]:
        end = m.start() if m else len(text)
        _paragraph(text[start:end], start, table, out)
        start = m.end() if m else end
    return out


def _paragraph(text: str, offset: int, table: Cascade, out: list[tuple[int, int]]) -> None:
    pairs = [(m.start(), m.end()) for m in INSIDE.finditer(text)]
    g, begin, whole = 0, 0, -1
    for m in table.candidates.finditer(text):
        at = m.end()
        while g < len(pairs) and pairs[g][1] < at:
            g += 1
        if g < len(pairs) and pairs[g][0] < at < pairs[g][1] and g != whole:
            a, b = pairs[g]
            if text[begin:a].strip() or not _ends(text, b, table):
                continue
            whole = g
        if at < len(text) and not _breaks(text, at, table):
            continue
        _add(text, begin, at, offset, out)
        begin = at
    _add(text, begin, len(text), offset, out)


def _ends(text: str, at: int, table: Cascade) -> bool:
    """Whether a sentence ends with the pair that ends here."""
    return bool(_STOPPED.search(text, max(0, at - 8), at)) and (at >= len(text) or _breaks(text, at, table))


def _breaks(text: str, at: int, table: Cascade) -> bool:
    m = table.decide.match(text, at)
    return bool(m) and table.breaks[m.lastindex - 1]


def _add(text: str, a: int, b: int, offset: int, out: list[tuple[int, int]]) -> None:
    piece = text[a:b]
    left = len(piece) - len(piece.lstrip())
    right = len(piece.rstrip())
    if right > left:
        out.append((offset + a + left, offset + a + right))


@F.pandas_udf(SPANS)
def sentence_spans(text: pd.Series) -> pd.Series:
    """Column of the sentence spans of a text column."""
    return pd.Series([[{"start_char": a, "end_char": b} for a, b in spans(t)] for t in text], dtype=object)


def with_sentences(df: DataFrame, text: str = "content", out: str = "sentences") -> DataFrame:
    """``df`` with ``out``: array of (text, start_char, end_char), one for each sentence of ``text``.

    A column named ``out`` is replaced. Null and blank texts get an empty array; rows are never dropped.
    """
    span = F.transform(
        F.col("__spans"),
        lambda s: F.struct(
            F.substring(F.col(text), s["start_char"] + 1, s["end_char"] - s["start_char"]).alias("text"),
            s["start_char"].alias("start_char"),
            s["end_char"].alias("end_char"),
        ),
    )
    return df.withColumn("__spans", sentence_spans(F.col(text))).withColumn(out, span).drop("__spans")
