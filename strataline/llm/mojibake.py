"""Text garbled by a wrong decoding, and its repair.

Round-trip repair: a stretch of text is encoded again with the legacy encoding that it may have been read in and
strictly decoded with the one it was written in. That is accepted when a garbling cost drops, and repeated for
nested layers.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Single-byte encodings that UTF-8 is wrongly read in.
READ_AS = ["cp1252", "latin-1", "cp1250", "cp1254", "cp1251", "mac_roman", "cp437", "cp850", "cp866", "koi8-r"]
#: (written in, read in) of legacy encodings that are taken for another one.
SWAPPED = [
    ("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1251", "cp1252"), ("koi8-r", "cp1252"), ("cp866", "cp1252"), ("mac_cyrillic", "cp1252"),
    ("cp874", "cp1252"), ("cp932", "cp1252"), ("gbk", "cp1252"), ("euc_jp", "cp1252"), ("big5", "cp1252"), ("euc_kr", "cp1252"), ("koi8-r", "cp1251"), ("cp866", "cp1251"),
    ("cp1251", "koi8-r"), ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "cp1251"), ("cp1251", "mac_roman"), ("cp1250", "cp1252"),
]
#: Multi-byte encodings that UTF-8 is wrongly read in; often not without loss.
WIDE_AS = ["gbk", "cp932", "big5", "euc_kr"]


@lru_cache(maxsize=None)
def _chars(encoding: str) -> list[str]:
    """The character of each byte; undefined bytes stand for themselves, as lenient readers do."""
    return [bytes([b]).decode(encoding, "ignore") or chr(b) for b in range(256)]


@lru_cache(maxsize=None)
def _bytes(encoding: str) -> dict[int, int]:
    table = {ord(c): b for b, c in enumerate(_chars(encoding))}
    if encoding in ("cp1252", "cp1250", "cp1254"):
        table |= {b: b for b in range(0x80, 0xA0)}
    return table


def _encode(text: str, encoding: str) -> bytes | None:
    table = _bytes(encoding)
    try:
        return bytes([table[ord(c)] for c in text])
    except KeyError:
        return None


def _class(chars: set[str]) -> str:
    return "[" + "".join(f"\\u{ord(c):04x}" for c in sorted(chars)) + "]"


@lru_cache(maxsize=None)
def _sequences(encoding: str) -> regex.Pattern:
    """Runs of characters that UTF-8 sequences turn into when read in the encoding."""
    table = _bytes(encoding)
    of = lambda lo, hi: _class({chr(c) for c, b in table.items() if lo <= b < hi})
    rest = of(0x80, 0xC0)
    return regex.compile(rf"(?:{of(0xC2, 0xE0)}{rest}|{of(0xE0, 0xF0)}{rest}{{2}}|{of(0xF0, 0xF5)}{rest}{{3}})+")


# Characters that ordinary text of the usual scripts is made of.
_EXTENDED = "ŒœŠšŽžŸĂăĄąĆćČčĎďĐđĘęĚěĞğİıŁłŃńŇňŐőŘřŚśŞşŢţŤťŮůŰűŹźŻżĀāĒēĪīŌōŪū"
_UNUSUAL = regex.compile(
    r"[^\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Devanagari}\p{Hangul}\p{M}\p{Zs}\p{So}\p{Sm}\p{Cf}\x00-\x9f\xa0-\xff"
    r"।॥Α-Ωά-ώЁА-яё‐-‧‰-⁞€　-ヿ＀-￯�①-⯿"
    + _EXTENDED
    + "]|[Ђ-Џђ-џҐґ]"
)
_BAD = regex.compile(r"[\x80-\x9f�\p{Co}\p{Cn}]")
_SIGN = r"\x80-\x9f\xa1-\xaa\xac\xae-\xb6\xb8-\xba\xbc-\xbf€‚ƒ„†‡ˆ‰‹˜™›"
_HIGH_LETTER = r"\xc0-\xd6\xd8-\xf6\xf8-\xffŠšŽžŒœŸĂ-ąĐđŁ-ńŇňŘřŢţ"
_SMALL, _BIG = r"a-z\xdf-\xff", r"\xc0-\xd6\xd8-\xdeŠŽŸŒ"
#: Neighbours that Latin text doesn't have: a sign after an accented letter or inside a word, an accented capital inside
#: a small word, the starts of quotes and dashes read in five encodings ...
_PAIRS = regex.compile(
    rf"(?<=[{_HIGH_LETTER}])[{_SIGN}]|(?<=[{_SMALL}])[{_SIGN}](?=[{_SMALL}])|(?<=[\xc0-\xde])[‘’“”•–—…»·«](?=\p{{L}})|(?<=[ÃÂÄÅÐÑâàРС])\xa0"
    rf"|(?<=[{_SMALL}])[{_BIG}](?=[{_SMALL}’]|\b)|(?<=[\p{{L}}])[{_SIGN}]+[{_BIG}]|‚[ÄâÑÇ].|‚óè|ΓÇ.|Γé.|Γùï|вЂ.|â€.|Ã¢"
    rf"|(?<=[a-z]{{2}})[‚¢ˆ¤£](?=\s|$|[.,;])|(?<![^\s(])[¤¨¬¯´¶¸ˆ˜†‡‰ƒ](?=\p{{L}})|(?<=[a-z])[–—”“](?=[a-z])|^[ÐÑ]$|^ˆ$|\b[cCdDjJlLmMnNsStT]Õ[A-Za-zŽŠ]|Â[«»©®°±·¿¡\xa0£§´]"
)
_SCRIPTS_MIXED = regex.compile(r"(?<=\p{Latin})[\p{Cyrillic}\p{Han}\p{Hangul}ｦ-ﾟ]|(?<=[\p{Cyrillic}\p{Han}\p{Hangul}ｦ-ﾟ])\p{Latin}")
_HIGH_RUN = regex.compile(rf"[{_HIGH_LETTER}ƒ]{{3,}}")
_MIXED_CYRILLIC = regex.compile(r"(?<=[а-яё])[А-ЯЁ]|(?<=[РСÐÑГв])[^А-ЯЁа-яёA-Za-z\s.,;:!?»)\-–—…]")
_BOXES = regex.compile(r"[─-▟∩≡≈⌠⌡⌐⌂ⁿ]|[√∂∆≈◊∫≠∏](?=[^\s\d.,;)])|¬[^\s\w]")
_HAN = regex.compile(r"\p{Han}")
_HIGH = regex.compile(r"[^\x00-\x7f]")
_SPACE = regex.compile(r"[ \t\r\n]+")
_TOKEN = regex.compile(r"[^ \t\r\n]+")


@lru_cache(maxsize=20_000)
def _han_cost(c: str) -> float:
    """0 for a Chinese or Japanese character of the first level of a national set, else more."""
    for encoding, lo, hi in (("gb2312", 0xB0, 0xD8), ("euc_jp", 0xB0, 0xD0), ("big5", 0xA4, 0xC7)):
        try:
            b = c.encode(encoding)
            if len(b) == 2 and lo <= b[0] < hi:
                return 0.0 if encoding != "big5" else 0.15
        except UnicodeEncodeError:
            continue
    try:
        c.encode("gb2312")
        return 0.6
    except UnicodeEncodeError:
        return 1.0


def cost(text: str) -> float:
    """How garbled a text looks; 0 for ordinary text of the usual scripts."""
    if text.isascii():
        return 0.0
    total = 4.0 * len(_BAD.findall(text)) + 2.0 * len(_UNUSUAL.findall(text)) + 1.5 * len(_PAIRS.findall(text))
    total += 1.2 * len(_SCRIPTS_MIXED.findall(text))
    total += sum(0.6 * len(m) for m in _HIGH_RUN.findall(text)) + 1.2 * len(_MIXED_CYRILLIC.findall(text)) + 1.5 * len(_BOXES.findall(text))
    return total + sum(map(_han_cost, _HAN.findall(text)))


def _utf8_as(token: str, encoding: str) -> str:
    """The token with the stretches decoded that are UTF-8 read in the encoding, where the cost drops."""

    def back(m: regex.Match) -> str:
        raw = _encode(m[0], encoding)
        try:
            to = raw.decode("utf-8") if raw is not None else m[0]
        except UnicodeDecodeError:
            return m[0]
        left, right = token[max(0, m.start() - 2) : m.start()], token[m.end() : m.end() + 1]
        return to if cost(left + to + right) < cost(left + m[0] + right) else m[0]

    return _sequences(encoding).sub(back, token)


def _plain_cyrillic(s: str) -> bool:
    letters = [c for c in s if c.isalpha() and not c.isascii()]
    if not letters or any(not ("А" <= c <= "я" or c in "Ёё") for c in letters):
        return False
    low = "".join(letters).lower()
    if not regex.search("[аеёиоуыэюя]", low) or not regex.search("[^аеёиоуыэюяйьъ]", low):
        return False
    return all(w.islower() or w.istitle() or w.isupper() for w in regex.findall(r"\p{L}+", s))


def _swapped(token: str, written: str, read: str) -> str | None:
    raw = _encode(token, read)
    high = _HIGH.findall(token)
    if raw is None or len(high) > 3 and len(set(high)) == 1:  # one letter again and again is no text
        return None
    try:
        to = raw.decode(written)
    except UnicodeDecodeError:
        return None
    if written in ("cp1251", "koi8-r", "cp866", "mac_cyrillic"):
        return to if _plain_cyrillic(to) else None
    if written in ("cp932", "gbk", "big5", "euc_jp", "euc_kr"):
        wide = regex.findall(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]", to)
        return to if len(wide) >= 2 and 2 * len(wide) >= len(_HIGH.findall(to)) and 5 * len(wide) >= 4 * sum(map(str.isalpha, to)) else None
    if written == "cp874":
        return to if len(regex.findall(r"\p{Thai}", to)) * 5 >= len(to) * 4 else None
    odd = _HIGH.findall(to)
    return to if all(c.isalpha() and c not in "µªº" or c in "’‘“”«»–—…¿¡°" for c in odd) and regex.search(r"[A-Za-z]", to) else None


def _wide(token: str) -> str | None:
    """A token of UTF-8 read in a multi-byte encoding, as far as it can be had; what is lost stays U+FFFD."""
    for encoding in WIDE_AS:
        raw = b"".join(c.encode(encoding, "ignore") if c != "�" else b"?" for c in token)
        to = raw.decode("utf-8", "replace")
        good = regex.findall(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Devanagari}\p{Cyrillic}\xc0-\xff“”‘’–—…，。、：「」（）]", to)
        lost = to.count("�")
        if len(good) >= 2 and lost * 2 <= len(good) and cost(regex.sub("[�?]", "", to)) * 3 < cost(token):
            return to
    return None


def _token(token: str) -> str:
    """A token after one layer of repair; itself where nothing lowers the cost by one at least."""
    was = cost(token)
    if was == 0:
        return token
    found: dict[str, float] = {}
    for encoding in READ_AS:
        to = _utf8_as(token, encoding)
        if to != token and to not in found and (c := cost(to)) < was - LEAST_DROP:
            found[to] = c
    best = _likeliest(token, found) if found else token
    best_cost = found.get(best, was - LEAST_DROP)
    # a strict decoding of most of it as UTF-8 is no accident; else other pairs may do better
    if best_cost > 0 and 5 * len(_HIGH.findall(best)) > 3 * len(_HIGH.findall(token)):
        for written, read in SWAPPED:
            to = _swapped(token, written, read)
            if to is not None and (c := cost(to)) < min(best_cost, was * 0.5):
                best, best_cost = to, c
    if best == token and was > 0.3 * len(token) and (to := _wide(token)) is not None:
        best = to
    return best


#: What a step must lower the cost by at least.
LEAST_DROP = 0.9


def _likeliest(token: str, found: dict[str, float]) -> str:
    """Of several decodings of one token the one of least cost. Where it isn't without cost and others
    undo a whole layer, which leaves half of the characters beyond ASCII or few more, further layers decide between them."""
    best = min(found, key=found.__getitem__)
    if found[best] == 0:
        return best
    whole = [to for to in found if 5 * len(_HIGH.findall(to)) <= 3 * len(_HIGH.findall(token))]
    if not whole or whole == [best]:
        return best
    return min([best, *whole], key=lambda to: cost(_end(to)))


def _end(token: str) -> str:
    """A token after all layers."""
    seen = {token}
    while (to := _remembered(token)) not in seen:
        seen.add(to)
        token = to
    return token


def _lost(line: str) -> bool:
    """Whether a line of words holds a character that a wrong decoding lost, other than symbol junk."""
    if "�" not in line:
        return False
    signs = regex.findall(r"[^\p{L}\p{M}\p{N}\s�.,;:!?'\"()\-–—]", line)
    letters = regex.findall(r"\p{L}", line)
    return len(letters) >= 3 * (len(signs) + line.count("�") // 2) and len(letters) >= 4


#: Entries of a worker's memo of tokens; beyond it tokens are judged anew. The results are the same.
MEMO = 300_000
_memo: dict[str, str] = {}


def _remembered(token: str) -> str:
    to = _memo.get(token)
    if to is None:
        to = _token(token)
        if len(_memo) > MEMO:
            _memo.clear()
        _memo[token] = to
    return to


def repair(text: str | None) -> tuple[str | None, bool, int]:
    """(text as far as it can be restored, whether any of it was garbled, layers undone).

    Layers are undone until nothing changes. That ends: no step makes a text longer, and none leads back to one that was.
    """
    if text is None or text.isascii():
        return text, False, 0
    garbled, layers, now = False, 0, text
    seen = {text}
    while True:
        changed = {t: to for t in set(_SPACE.split(now)) if not t.isascii() and (to := _remembered(t)) != t}
        if not changed:
            break
        now = _TOKEN.sub(lambda m: changed.get(m[0], m[0]), now)  # noqa: B023
        if now in seen:
            break
        seen.add(now)
        garbled, layers = True, layers + 1
    if "�" in text and any(map(_lost, text.split("\n"))):
        garbled = True
    return now, garbled, layers


REPAIR = T.StructType([T.StructField("text", T.StringType()), T.StructField("garbled", T.BooleanType()), T.StructField("layers", T.IntegerType())])


@F.pandas_udf(REPAIR)
def _repair_series(text: pd.Series) -> pd.DataFrame:
    rows = [repair(t if isinstance(t, str) else None) for t in text]
    return pd.DataFrame(rows, columns=["text", "garbled", "layers"])


def suspect(c: Column) -> Column:
    """The part of the test that runs in the JVM: whether a text holds anything beyond ASCII."""
    return F.coalesce(c.rlike("[^\\x00-\\x7F]"), F.lit(False))


def repair_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``repaired``, ``garbled`` and ``layers``. Null texts stay null and aren't garbled.

    Only texts with characters beyond ASCII go through Python; nothing is shuffled.
    """
    t = F.col(text)
    rows = df.withColumn("__r", _repair_series(F.when(suspect(t), t)))
    return (
        rows.withColumn("repaired", F.when(suspect(t), F.col("__r")["text"]).otherwise(t))
        .withColumn("garbled", F.coalesce(F.col("__r")["garbled"], F.lit(False)))
        .withColumn("layers", F.coalesce(F.col("__r")["layers"], F.lit(0)))
        .drop("__r")
    )
