"""Models as plug-ins: sentence encoders, taggers and entity finders, brought in as functions.

A plug-in is a function without arguments that gives the model, called once in each Python worker; a model takes a list of
texts. Columns come from it by Arrow batches, and only texts that aren't null or blank are given to it. Without a plug-in the
operators fall back as their docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.functions import lexicon as lx
from strataline.functions import text as tx


class Encoder(Protocol):
    """Vectors of texts."""

    def __call__(self, texts: list[str]) -> list[list[float]]: ...


class Tagger(Protocol):
    """Of each text its words: (text, pos, tag, dep)."""

    def __call__(self, texts: list[str]) -> list[list[tuple[str, str, str, str]]]: ...


class Entities(Protocol):
    """Of each text the labels of its named entities."""

    def __call__(self, texts: list[str]) -> list[list[str]]: ...


WORDS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("text", "pos", "tag", "dep")]))


def _column(c: Column, make: Callable[[], Callable[[list[str]], list]], kind: T.DataType, shape=lambda x: x) -> Column:
    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for texts in batches:
            out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            given = texts[texts.map(lambda t: isinstance(t, str) and bool(t.strip()))]
            if len(given):
                out[given.index] = pd.Series([shape(x) for x in model(given.tolist())], index=given.index, dtype=object)
            yield out

    return run(c)


def vectors(c: Column, make: Callable[[], Encoder]) -> Column:
    """Vectors of a text column; null for null and blank texts."""
    return _column(c, make, T.ArrayType(T.FloatType()), lambda x: [float(v) for v in x])


def tagged(c: Column, make: Callable[[], Tagger]) -> Column:
    """Words with their tags."""
    return _column(c, make, WORDS, lambda ws: [dict(zip(("text", "pos", "tag", "dep"), w)) for w in ws])


def labels(c: Column, make: Callable[[], Entities]) -> Column:
    """Labels of named entities."""
    return _column(c, make, T.ArrayType(T.StringType()), list)


def has_entity(found: Column) -> Column:
    """Whether a label is one that saves a short sentence (for ``text.role``)."""
    return F.coalesce(F.arrays_overlap(found, F.array(*map(F.lit, lx.ENTITY_LABELS))), F.lit(False))


def is_imperative(c: Column, words: Column | None = None, strict: bool = True) -> Column:
    """Whether a sentence tells to do something: its first word is a verb and the root, in its base form if ``strict``; or it
    is one of the known verbs. Without tags the known verbs alone decide."""
    listed = tx.is_imperative(c)
    if words is None:
        return listed
    first = F.try_element_at(words, F.lit(1))
    root = (first["pos"] == "VERB") & (first["dep"] == "ROOT")
    return F.coalesce(root & first["tag"].isin("VB", "VBP") if strict else root, F.lit(False)) | listed


def page_ends(before: Column, after: Column, chars: int = 200) -> tuple[Column, Column]:
    """The end of a text and the beginning of the next, to be encoded."""
    return F.when(F.length(before) > chars, F.substring(before, -chars, chars)).otherwise(before), F.substring(after, 1, chars)
