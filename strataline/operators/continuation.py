"""Texts that run on across a page break: previous content, score, decision, evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.config import CANONICAL, Profile
from strataline.functions import lexicon as lx
from strataline.functions import text as tx

SLACK = 1e-9


def noise_header(text: Column, kind: Column) -> Column:
    return F.coalesce((kind == "Header") & tx.matches(F.coalesce(text, F.lit("")), lx.NOISE_HEADERS), F.lit(False))


def with_previous(df: DataFrame, doc: str = "file_id", order: str = "pos") -> DataFrame:
    """``prev``: the last row before each that is neither heading nor noise, as a struct; ``skipped``: how many rows lie
    between. One pass over the document's order; only the fields that the score asks for are carried."""
    w = Window.partitionBy(doc).orderBy(order)
    fields = F.struct("segment_id", "type", "text", "page", "column_index", "heading_path", "at_page_bottom", F.row_number().over(w).alias("n"))
    rows = df.withColumn("__n", F.row_number().over(w)).withColumn("__f", fields)
    prev = F.last(F.when(F.coalesce(F.col("type") != "Header", F.lit(True)), F.col("__f")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("prev", prev)
    return rows.withColumn("skipped", F.col("__n") - 1 - F.col("prev.n")).drop("__f", "__n")


def factors(p: Profile = CANONICAL) -> dict[str, Column]:
    """The parts of the score as columns, in the order in which they are added. Needs ``prev``."""
    w = p.weights
    prev, a, b = F.col("prev"), F.coalesce(F.col("prev.text"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    columns = (F.coalesce(prev["column_index"], F.lit(0)), F.coalesce(F.col("column_index"), F.lit(0)))
    same_column = (columns[0] < 0) | (columns[1] < 0) | (columns[0] == columns[1])
    open_end = (a != "") & ~tx.has_terminal_mark(a)
    give = lambda on, key: F.when(F.coalesce(on, F.lit(False)), F.lit(w[key])).otherwise(F.lit(0.0))
    start = F.when(tx.starts_like_continuation(b), F.lit(w["start"])).when(tx.starts_lowercase(b), F.lit(w["start_lowercase"])).otherwise(F.lit(0.0))
    split = (prev["type"] == "ListItem") & (F.col("type") == "ListItem") & F.trim(a).rlike(r"[^.!?]$")
    return {
        "position": give(prev["at_page_bottom"] & F.col("at_page_top"), "position"), "column": give(same_column, "column"), "hyphen": give(tx.ends_with_hyphen(a), "hyphen"),
        "open_clause": give(tx.ends_with_open_clause(a), "open_clause"), "fragment": give(tx.has_fragment_pattern(a), "fragment"), "start": start,
        "same_path": give(prev["heading_path"].eqNullSafe(F.col("heading_path")), "same_path"), "same_type": give(prev["type"].eqNullSafe(F.col("type")), "same_type"),
        "incomplete": give(open_end, "incomplete"), "incomplete_lowercase": give(open_end & tx.starts_lowercase(b), "incomplete_lowercase"), "list_split": give(split, "list_split"),
    }


def annotate(df: DataFrame, doc: str = "file_id", p: Profile = CANONICAL) -> DataFrame:
    """``score``, ``is_continuation`` (full, partial, none) and ``rules`` (names of the parts that counted).

    Headings, blocks and noise never continue, nor does a text whose previous content isn't on the page before.
    """
    rows = with_previous(df, doc)
    barred = F.col("type").isin(*lx.BREAK_TYPES) | F.col("prev.type").isin(*lx.BREAK_TYPES) | noise_header(F.col("text"), F.col("type"))
    apart = F.coalesce(F.col("page"), F.lit(0)) != F.coalesce(F.col("prev.page"), F.lit(0)) + 1
    out = F.coalesce(barred | apart, F.lit(False)) | F.col("prev").isNull()
    parts = factors(p)
    total = F.lit(0.0)
    for c in parts.values():
        total = total + c
    rows = rows.withColumn("score", F.when(out, F.lit(0.0)).otherwise(total))
    decision = F.when(F.col("score") >= p.full - SLACK, "full").when(F.col("score") >= p.partial - SLACK, "partial").otherwise("none")
    rules = F.array_compact(F.array(*[F.when(c > 0, F.lit(k)) for k, c in parts.items()]))
    return rows.withColumn("is_continuation", decision).withColumn("rules", F.when(out, F.array().cast("array<string>")).otherwise(rules))


def annotate_adjacent(df: DataFrame, doc: str = "file_id", order: str = "pos", similarity: Column | None = None, p: Profile | None = None) -> DataFrame:
    """The embedding profile: neighbours only, style 60 % and similarity 40 % (0.5 where there is no encoder)."""
    full, partial = (p.full, p.partial) if p else (0.70, 0.45)
    w = Window.partitionBy(doc).orderBy(order)
    kind, text, page, col = (F.lag(c).over(w) for c in ("type", "text", "page", "column_index"))
    rows = df.withColumn("__k", kind).withColumn("__t", F.trim(F.coalesce(text, F.lit("")))).withColumn("__pg", page).withColumn("__c", col).withColumn("__i", F.row_number().over(w))
    a, b = F.col("__t"), F.trim(F.coalesce(F.col("text"), F.lit("")))
    same_page = F.coalesce(F.col("__pg"), F.lit(0)) == F.coalesce(F.col("page"), F.lit(0))
    near = same_page | (F.abs(F.coalesce(F.col("__pg"), F.lit(0)) - F.coalesce(F.col("page"), F.lit(0))) <= 1)
    same_column = F.coalesce(F.col("__c"), F.lit(0)) == F.coalesce(F.col("column_index"), F.lit(0))
    column = F.when(same_page, ~same_column).otherwise(same_column)
    give = lambda on, v: F.when(F.coalesce(on, F.lit(False)), F.lit(v)).otherwise(F.lit(0.0))
    style = (
        give((a != "") & ~a.rlike("[.!?:]$"), 0.4) + give(b.rlike(r"^\p{Ll}"), 0.3) + give(a.rlike("[-‐-—]$"), 0.3)
        + give(F.col("__k") == "Formula", 0.5) + give(near, 0.1) + give(column, 0.1)
    )
    final = style * 0.6 + (F.lit(0.5) if similarity is None else F.greatest(similarity, F.lit(0.0))) * 0.4
    rows = rows.withColumn("score", F.when(F.col("__i") > 1, final))
    decision = F.when(F.col("score") >= full - SLACK, "full").when(F.col("score") >= partial - SLACK, "partial").when(F.col("__i") > 1, "none")
    return rows.withColumn("is_continuation", decision).drop("__k", "__t", "__pg", "__c", "__i")


def evidence_summary(annotated: DataFrame, doc: str = "file_id", top: int = 5) -> DataFrame:
    """(doc, continuations, avg_score, top_rules): counts of a document's joins and its commonest rules (ties by name)."""
    joins = annotated.filter(F.col("is_continuation") != "none")
    base = joins.groupBy(doc).agg(F.count(F.lit(1)).alias("continuations"), F.round(F.avg("score"), 3).alias("avg_score"))
    each = joins.select(doc, F.explode("rules").alias("rule")).groupBy(doc, "rule").agg(F.count(F.lit(1)).alias("n"))
    best = each.groupBy(doc).agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "rule"))), 1, top).alias("r"))
    return base.join(best, doc, "left").select(doc, "continuations", "avg_score", F.concat_ws(",", F.transform("r", lambda s: s["rule"])).alias("top_rules"))


def merge_hyphenated(a: Column, b: Column) -> Column:
    """(left, right) of two texts with a word broken between them put together in the left one.

    Where the halves make no plausible word both stay as they are. As in the rule that this follows, marks at the
    end of the second half are lost when more words follow.
    """
    head = F.regexp_extract(a, r"(\S*)[-‐‑–—]\s*$", 1)
    sure = F.coalesce(a.rlike(r"[\p{L}\p{N}][-‐‑–—]\s*$"), F.lit(False))
    first = tx.first_word(b)
    word = F.concat(head, F.regexp_replace(first, "[.,;:!?]+$", ""))
    ok = sure & F.coalesce(first.rlike(r"^\p{L}"), F.lit(False)) & (F.length(word) >= 3) & tx.plausible_word(word)
    rest = F.array_join(F.slice(tx.words(b), 2, F.greatest(F.size(tx.words(b)) - 1, F.lit(1))), " ")
    mark = F.when(rest == "", F.regexp_extract(first, r"^[a-zA-Z]+([.,;:!?]+)", 1)).otherwise("")
    whole = tx.words(F.regexp_replace(a, r"[-‐‑–—]\s*$", ""))
    before = F.array_join(F.slice(whole, 1, F.greatest(F.size(whole) - 1, F.lit(0))), " ")
    left = F.concat(before, F.when(before != "", " ").otherwise(""), word, mark)
    return F.when(ok, F.struct(left.alias("left"), rest.alias("right"))).otherwise(F.struct(a.alias("left"), b.alias("right")))


def join_at_word(a: Column, b: Column) -> Column:
    """The embedding profile's repair: (left, right) with the whole word in the left text."""
    one = F.regexp_extract(a, r"([\p{L}\p{N}_]+)[-‐‑−–—]\s*$", 1)
    two = F.regexp_extract(F.ltrim(b), r"^([\p{L}\p{N}_]+)", 1)
    ok = F.coalesce(F.rtrim(a).rlike("[-‐‑‒–—]$"), F.lit(False)) & (one != "") & (two != "") & (F.length(F.concat(one, two)) >= 3)
    left = F.concat(F.regexp_replace(a, r"[\p{L}\p{N}_]+[-‐‑−–—]\s*$", ""), one, two)
    right = F.ltrim(F.regexp_replace(F.ltrim(b), r"^[\p{L}\p{N}_]+", ""))
    return F.when(ok, F.struct(left.alias("left"), right.alias("right"))).otherwise(F.struct(a.alias("left"), b.alias("right")))


def join_words(df: DataFrame, doc: str = "file_id", order: str = "pos") -> DataFrame:
    """``text`` with words broken before a row that continues whole in the row before, as ``join_at_word`` from the first
    row on would leave it. Needs ``is_continuation``.

    A row that is one broken word and gives it up has none left for the next, so in a chain of such rows every second
    one joins.
    """
    w = Window.partitionBy(doc).orderBy(order)
    a, b = F.lag("text").over(w), F.col("text")
    can = F.col("is_continuation").isin("full", "partial") & (join_at_word(a, b)["left"] != a)
    rows = df.withColumn("__can", F.coalesce(can, F.lit(False)))
    alone = F.coalesce(a.rlike(r"^\s*[\p{L}\p{N}_]+[-‐‑−–—]\s*$"), F.lit(False)) & F.coalesce(F.lag("__can").over(w), F.lit(False))
    rows = rows.withColumn("__run", F.sum(F.when(F.col("__can") & alone, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    nth = F.row_number().over(Window.partitionBy(doc, "__run").orderBy(order))
    rows = rows.withColumn("__join", F.col("__can") & (nth % 2 == 1))
    rows = rows.withColumn("__prev", F.lag("text").over(w)).withColumn("__next", F.lead("text").over(w)).withColumn("__follows", F.coalesce(F.lead("__join").over(w), F.lit(False)))
    rows = rows.withColumn("text", F.when(F.col("__join"), join_at_word(F.col("__prev"), F.col("text"))["right"]).otherwise(F.col("text")))
    rows = rows.withColumn("text", F.when(F.col("__follows"), join_at_word(F.col("text"), F.col("__next"))["left"]).otherwise(F.col("text")))
    return rows.drop("__can", "__run", "__join", "__prev", "__next", "__follows")


def pairwise(df: DataFrame, doc: str = "file_id", order: str = "pos", similarity: Column | None = None, full: float = 0.70, partial: float = 0.45) -> DataFrame:
    """``pair_score`` and ``pair_decision`` of each row and the one before by the embedding profile's single test: style
    alone, or 70 % of it and 30 % similarity where there is an encoder. Blocks never continue; a document's first row has
    no decision."""
    w = Window.partitionBy(doc).orderBy(order)
    rows = df.withColumn("__b", F.lag(F.struct("type", F.trim(F.coalesce("text", F.lit(""))).alias("t"), "page", "column_index")).over(w))
    b, t = F.col("__b"), F.trim(F.coalesce("text", F.lit("")))
    same_page = b["page"].eqNullSafe(F.col("page"))
    near = same_page | (F.abs(F.coalesce("page", F.lit(0)) - F.coalesce(b["page"], F.lit(0))) <= 1)
    same_column = F.coalesce(b["column_index"], F.lit(0)) == F.coalesce("column_index", F.lit(0))
    give = lambda on, v: F.when(F.coalesce(on, F.lit(False)), F.lit(v)).otherwise(F.lit(0.0))
    style = give(b["t"].rlike("[-‐‑‒–—]$"), 0.3) + give(t.rlike(r"^\p{Ll}"), 0.3) + give(~b["t"].rlike("[.!?]$"), 0.2) + give(near, 0.1) + give(F.when(same_page, ~same_column).otherwise(same_column), 0.1)
    score = style if similarity is None else style * 0.7 + similarity * 0.3
    barred = F.coalesce(F.col("type").isin(*lx.BREAK_TYPES[1:]) | b["type"].isin(*lx.BREAK_TYPES[1:]), F.lit(False))
    score = F.when(b.isNotNull(), F.when(barred, 0.0).otherwise(score))
    decision = F.when(b.isNotNull(), F.when(barred, "none").when(score >= full - SLACK, "full").when(score >= partial - SLACK, "partial").otherwise("none"))
    return rows.withColumn("pair_score", score).withColumn("pair_decision", decision).drop("__b")
