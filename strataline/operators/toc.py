"""Tables of contents, sections, heading authority, glossaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.functions import lexicon as lx
from strataline.functions import text as tx
from strataline.functions.patterns import any_java
from strataline.operators.stack import SEP, with_stack_path


def section_map(toc: DataFrame, doc: str = "file_id", last_page: int = 2000) -> DataFrame:
    """One row per document: ``body_start``, ``back_start``, ``glossary_start``, ``glossary_end``, ``chapters``.

    ``toc``: doc, ord, level, title, page_no. Entries without a page number are passed over.
    """
    t = F.trim(F.lower("title"))
    rows = toc.filter(F.col("page_no").isNotNull()).withColumn("t", t)
    start = F.min(F.when(F.col("t").rlike(any_java(lx.BODY_START_TITLES)) & (F.col("page_no") < 150), F.struct("ord", "page_no")))
    found = rows.groupBy(doc).agg(start.alias("s"))
    rows = rows.join(found, doc)
    later = (F.col("ord") >= F.col("s.ord")) & (F.col("page_no") > F.col("s.page_no") + 100)
    back = F.min(F.when(later & F.col("t").rlike(any_java(lx.BACK_TITLES)) & (F.coalesce("level", F.lit(1)) == 1), F.col("page_no")))
    following = Window.partitionBy(doc).orderBy("ord").rowsBetween(1, Window.unboundedFollowing)
    chapter_page = F.first(F.when(F.coalesce("level", F.lit(1)) == 1, F.col("page_no")), ignorenulls=True).over(following)
    rows = rows.withColumn("next_chapter", chapter_page)
    glossary = F.max(F.when(F.col("t").contains("glossary"), F.struct("ord", F.col("page_no").alias("a"), F.coalesce(F.col("next_chapter") - 1, F.col("page_no") + 15).alias("b"))))
    out = rows.groupBy(doc).agg(F.first("s").alias("s"), back.alias("back"), glossary.alias("g"), F.count_if(F.col("level") == 1).alias("chapters"))
    return out.select(
        doc, F.coalesce("s.page_no", F.lit(1)).alias("body_start"), F.coalesce(F.when(F.col("s").isNotNull(), F.col("back")), F.lit(9999)).alias("back_start"),
        F.col("g.a").alias("glossary_start"), F.col("g.b").alias("glossary_end"), "chapters",
    )


def chapters(toc: DataFrame, doc: str = "file_id", last_page: int = 2000) -> DataFrame:
    """Top-level chapters with first and last page."""
    w = Window.partitionBy(doc).orderBy("ord")
    rows = toc.filter((F.col("level") == 1) & F.col("page_no").isNotNull())
    return rows.select(doc, "ord", "title", F.col("page_no").alias("start_page"), F.coalesce(F.lead("page_no").over(w) - 1, F.lit(last_page)).alias("end_page"))


def gold_paths(segments: DataFrame, toc: DataFrame, doc: str = "file_id") -> DataFrame:
    """``gold_path`` of each segment: the stack of the entries up to its page, in their order, before the first entry
    of a later page.

    An as-of look-up: a document's paths, each with the page from which it holds, are one row that its segments meet by
    the document alone. Segments in the partitions of their documents aren't shuffled for it; a table of contents is no
    longer than its document.
    """
    w = Window.partitionBy(doc).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    entries = toc.filter(F.col("page_no").isNotNull()).withColumn("reach", F.max("page_no").over(w))
    entries = with_stack_path(entries, doc, [F.col("ord")], F.lit(True), F.col("level"), F.col("title"), levels=None, out="entry_path")
    at = entries.groupBy(doc, F.col("reach").alias("p")).agg(F.max_by("entry_path", "ord").alias("path"))
    book = at.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("p", "path"))).alias("__book"))
    page = F.coalesce("page", F.lit(1))
    path = F.aggregate("__book", F.lit(""), lambda s, x: F.when(x["p"] <= page, x["path"]).otherwise(s))
    return segments.join(book, doc, "left").withColumn("gold_path", F.coalesce(path, F.lit(""))).drop("__book")


def enforce_headers(segments: DataFrame, toc: DataFrame, doc: str = "file_id") -> DataFrame:
    """``new_type``: headings whose title isn't in the document's table become paragraphs; without a table none do. Titles
    meet by their document alone, as hashes, in one row for each."""
    titles = toc.groupBy(doc).agg(F.collect_set(F.xxhash64(tx.plain_title(F.col("title")))).alias("__titles"))
    rows = segments.join(titles, doc, "left")
    text = F.coalesce("text", F.lit(""))
    heading = F.coalesce(F.col("type") == "Header", F.lit(False)) & (F.trim(text) != "") & F.col("__titles").isNotNull()
    down = F.when(heading, ~F.array_contains("__titles", F.xxhash64(tx.plain_title(text)))).otherwise(F.lit(False))
    return rows.withColumn("new_type", F.when(down, "Paragraph").otherwise(F.col("type"))).drop("__titles")


def seed_path(gold: Column, path: Column) -> Column:
    """The gold path, with the last local heading that is neither noise nor part of it, short and without a stop."""
    golds = F.transform(F.split(gold, SEP), tx.plain_title)
    noise = any_java(lx.PATH_NOISE, "iu")
    kept = F.filter(F.transform(F.split(F.coalesce(path, F.lit("")), SEP), lambda x: F.trim(x)), lambda p: ~p.rlike(noise) & ~F.array_contains(golds, tx.plain_title(p)) & (F.length(tx.plain_title(p)) >= 3))
    local = F.when(F.size(kept) > 0, F.element_at(kept, -1))
    fits = (F.length(local) < 60) & ~F.trim(local).endswith(".")
    return F.when(gold == "", path).when(F.coalesce(fits, F.lit(False)), F.concat(gold, F.lit(SEP), local)).otherwise(gold)


def toc_pages(segments: DataFrame, doc: str = "file_id") -> DataFrame:
    """(doc, page) of pages that look like a table of contents: a keyword before page 60, or three dotted lines before 45."""
    low = F.lower(F.coalesce("text", F.lit("")))
    word = low.rlike("|".join(lx.TOC_KEYWORDS))
    dotted = low.rlike(r"[\.·-]{5,}\s*\d+$")
    page = F.coalesce("page", F.lit(0)).alias("page")
    pages = segments.groupBy(doc, page).agg(F.max(word).alias("word"), F.count_if(dotted).alias("dotted"))
    return pages.filter((F.col("word") & (F.col("page") < 60)) | ((F.col("page") < 45) & (F.col("dotted") >= 3))).select(doc, "page")


def toc_line(c: Column, x: Column) -> Column:
    """(title, page_no, level) of a line of a table of contents; null for other lines."""
    t = F.trim(c)
    pattern = r"^(.*?)(?:[\.·\-_]{3,}|[\s]{2,})(\d+)$"
    title, page = F.trim(F.regexp_extract(t, pattern, 1)), F.regexp_extract(t, pattern, 2)
    level = F.when(F.upper(title).rlike("^(?:PART|MODULE)"), 0).when(F.upper(title).startswith("CHAPTER") | title.rlike(r"^\d+\.?\s+[A-Z]"), 1).when(x < 60, 0).when(x < 90, 1).otherwise(2)
    return F.when((F.length(t) >= 3) & (page != ""), F.struct(title.alias("title"), page.try_cast("bigint").alias("page_no"), level.alias("level")))


def skeleton(segments: DataFrame, toc: DataFrame, doc: str = "file_id") -> DataFrame:
    """``skeleton_path``: the title of the last entry of level 1 or less whose page range holds the segment, before its
    path unless it is in it. An entry reaches to the page before the next one's, but its own page at least.

    An as-of join by document: a page meets the entries of the last page not after it. Of its own page the last of level 1
    or less counts; beyond it only the last entry at all, which alone reaches further.
    """
    e = toc.filter(F.col("page_no").isNotNull())
    chief = F.coalesce(F.col("level") <= 1, F.lit(False))
    groups = e.groupBy(doc, F.col("page_no").alias("p")).agg(F.max(F.when(chief, F.struct("ord", "title"))).alias("here"), F.max(F.struct("ord", chief.alias("chief"), "title")).alias("last"))
    after = F.when(F.col("last.chief"), F.col("last.title"))
    groups = groups.select(doc, "p", F.lit(0).alias("k"), F.struct("p", F.col("here.title").alias("here"), after.alias("after")).alias("e"))
    pages = segments.select(doc, F.coalesce("page", F.lit(0)).alias("p")).distinct().select(doc, "p", F.lit(1).alias("k"), F.lit(None).cast(groups.schema["e"].dataType).alias("e"))
    w = Window.partitionBy(doc).orderBy("p", "k").rowsBetween(Window.unboundedPreceding, 0)
    best = groups.unionByName(pages).withColumn("e", F.last("e", ignorenulls=True).over(w)).filter("k = 1")
    best = best.select(doc, F.col("p").alias("__p"), F.when(F.col("e.p") == F.col("p"), F.col("e.here")).otherwise(F.col("e.after")).alias("__title"))
    rows = segments.withColumn("__p", F.coalesce("page", F.lit(0))).join(best, [doc, "__p"], "left")
    path = F.coalesce("heading_path", F.lit(""))
    new = F.when(F.col("__title").isNull() | path.contains(F.col("__title")), path).when(path == "", F.col("__title")).otherwise(F.concat_ws(SEP, "__title", path))
    return rows.withColumn("skeleton_path", new).drop("__p", "__title")


def gate(segments: DataFrame, pages: DataFrame, doc: str = "file_id", scan: int = 100) -> DataFrame:
    """(doc, start_id, end_id): where the main body starts and the back matter, by chapter headings after the first
    run of contents pages (a gap over 8 pages ends a run)."""
    w = Window.partitionBy(doc).orderBy("page")
    run = pages.filter(F.col("page") < scan).withColumn("gap", F.coalesce(F.col("page") - F.lag("page").over(w), F.lit(0)) > 8)
    run = run.withColumn("cut", F.max(F.col("gap").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ends = run.filter("cut = 0").groupBy(doc).agg(F.max("page").alias("__end"))
    heads = segments.filter((F.col("type") == "Header") & (F.col("level") == 1)).withColumn("page", F.coalesce("page", F.lit(0)))
    heads = heads.join(ends, doc, "left").join(pages.withColumn("__on", F.lit(True)), [doc, "page"], "left")
    t = F.trim(F.coalesce("text", F.lit("")))
    ok = F.col("__on").isNull() & (F.col("page") > F.coalesce("__end", F.lit(0))) & (F.col("page") <= scan) & t.rlike(any_java(lx.GATE_START))
    first = heads.groupBy(doc).agg(F.min(F.when(ok, F.struct("pos", "segment_id"))).alias("s"))
    back = heads.join(first, doc).filter((F.col("pos") > F.col("s.pos")) & t.rlike(any_java(lx.GATE_END)))
    back = back.groupBy(doc).agg(F.min_by("segment_id", "pos").alias("end_id"))
    return first.join(back, doc, "left").select(doc, F.col("s.segment_id").alias("start_id"), "end_id")


def logic_book(headings: DataFrame, doc: str) -> DataFrame:
    """(doc, norm, path, ord): paths of markdown headings by plain title; noise is left out; a later heading of level 3
    and deeper doesn't overwrite. ``headings``: doc, pos, level, title."""
    clean = F.regexp_replace(F.regexp_replace("title", r"\[(.*?)\]\(.*?\)", "$1"), r"\*\*|__", "")
    rows = headings.filter(~tx.matches(F.col("title"), lx.LOGIC_NOISE) & (F.length("title") >= 2)).withColumn("title", clean)
    rows = with_stack_path(rows, doc, [F.col("pos")], F.lit(True), F.col("level"), F.col("title"), levels=None).withColumn("norm", tx.plain_title(F.col("title")))
    # the last of level 1 and 2 wins, else the first
    pick = F.max(F.struct(F.when(F.col("level") < 3, F.col("pos")).otherwise(-1 - F.col("pos")).alias("k"), "path"))
    return rows.groupBy(doc, "norm").agg(pick.alias("b"), F.min("pos").alias("ord")).select(doc, "norm", F.col("b.path").alias("path"), "ord")


def look_up(rows: DataFrame, book: DataFrame, doc: str, text: str = "text") -> DataFrame:
    """``logic_path``: the book's path of a text: its own title's, else that of the first long title of which one is the
    other's beginning.

    Each distinct title of a document is looked up once. Long ones meet by their first eleven letters, shorter ones (and
    the empty one, which begins every title) by the beginnings of the long titles, so no text meets all titles.
    """
    r = rows.withColumn("norm", tx.plain_title(F.coalesce(F.col(text), F.lit(""))))
    exact = book.select(doc, "norm", F.col("path").alias("__exact"))
    long = book.filter(F.length("norm") > 10).select(F.col(doc), F.col("norm").alias("__b"), F.col("path").alias("__p"), "ord")
    own = r.select(doc, "norm").distinct().join(exact, [doc, "norm"], "left_anti")
    full = own.filter(F.length("norm") > 10).withColumn("__h", F.substring("norm", 1, 11)).join(long.withColumn("__h", F.substring("__b", 1, 11)), [doc, "__h"])
    full = full.filter(F.col("norm").startswith(F.col("__b")) | F.col("__b").startswith(F.col("norm"))).select(doc, "norm", "__p", "ord")
    begun = long.select(doc, "__p", "ord", F.explode(F.transform(F.sequence(F.lit(0), F.lit(10)), lambda k: F.substr(F.col("__b"), F.lit(1), k))).alias("norm"))
    begun = begun.groupBy(doc, "norm").agg(F.min_by("__p", "ord").alias("__p"), F.min("ord").alias("ord"))
    part = own.filter(F.length("norm") <= 10).join(begun, [doc, "norm"]).select(doc, "norm", "__p", "ord")
    near = full.unionByName(part).groupBy(doc, "norm").agg(F.min_by("__p", "ord").alias("__near"))
    out = r.join(exact, [doc, "norm"], "left").join(near, [doc, "norm"], "left")
    return out.withColumn("logic_path", F.coalesce("__exact", "__near")).drop("norm", "__exact", "__near")


def align(segments: DataFrame, book: DataFrame, doc: str = "file_id") -> DataFrame:
    """Segments by the markdown's headings: one that reads like noise is no heading, and a path of the book that is
    longer than a segment's takes its place."""
    t = F.coalesce(F.col("text"), F.lit(""))
    noise = (t == "") | tx.matches(t, lx.LOGIC_NOISE)
    rows = look_up(segments.withColumn("type", F.when((F.col("type") == "Header") & noise, "Paragraph").otherwise(F.col("type"))), book, doc)
    old = F.coalesce(F.col("heading_path"), F.lit(""))
    longer = F.coalesce((F.col("logic_path") != "") & (F.length("logic_path") > F.length(old)), F.lit(False))
    return rows.withColumn("heading_path", F.when(longer, F.col("logic_path")).otherwise(F.col("heading_path"))).drop("logic_path")


def pruned(entries: DataFrame, doc: str = "file_id", least: int = 5) -> DataFrame:
    """Entries of a table made from headings, with ``has_children``; short titles without entries below them are left out."""
    below = F.lead("level").over(Window.partitionBy(doc).orderBy("ord"))
    rows = entries.filter("level is not null").withColumn("has_children", F.coalesce(below > F.col("level"), F.lit(False)))
    return rows.filter(F.col("has_children") | (F.length("title") >= least))


def scanned_isbn(segments: DataFrame, doc: str = "file_id", last_page: int = 30) -> DataFrame:
    """(doc, isbn): the first ISBN that a document's first pages state."""
    rows = segments.filter(F.coalesce("page", F.lit(0)) <= last_page).select(doc, "pos", tx.isbn(F.col("text")).alias("isbn"))
    return rows.filter("isbn is not null").groupBy(doc).agg(F.min_by("isbn", "pos").alias("isbn"))


def fill_empty(base: DataFrame, more: DataFrame, columns: list[str], doc: str = "file_id") -> DataFrame:
    """(doc, columns): the first record of a document, with what it lacks (null or empty) from the second; all documents of
    either. Both have one row for each document."""
    both = base.select(doc, *columns).join(more.select(doc, *[F.col(c).alias(f"__{c}") for c in columns]), doc, "full")
    return both.select(doc, *[F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"__{c}")).alias(c) for c in columns])


def index_terms(segments: DataFrame, doc: str = "file_id") -> DataFrame:
    """(doc, term): none, as the rule for back-of-book indexes that this follows gives nothing for any page."""
    return segments.select(doc, F.lit(None).cast("string").alias("term")).filter(F.lit(False))


def zone(page: Column, body_start: Column, back_start: Column) -> Column:
    return F.when(page <= body_start - 1, "front").when(page >= back_start, "back").otherwise("body")


def glossary_items(segments: DataFrame, doc: str = "file_id", order: str = "pos") -> DataFrame:
    """(doc, term, definition) of glossary rows in order: "term: definition" at once, or a short line without a stop
    and the lines after it. A term without a definition is left out."""
    return glossary_entries(segments, doc, order).select(doc, "term", "definition")


def glossary_entries(segments: DataFrame, doc: str = "file_id", order: str = "pos") -> DataFrame:
    """(doc, at, segment_ids, term, definition): ``glossary_items`` with the place where each begins and its segments."""
    t = F.trim(F.coalesce("text", F.lit("")))
    rows = segments.filter((F.length(t) >= 2) & (F.lower(t) != "glossary")).withColumn("t", t)
    pair = F.col("t").contains(": ")
    term = ~pair & (F.length("t") < 60) & ~F.col("t").endswith(".")
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("g", F.sum((pair | term).cast("int")).over(w))
    group = rows.groupBy(doc, "g").agg(
        F.min(order).alias("at"), F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("segment_id").alias("s")))), lambda x: x["s"]).alias("segment_ids"), F.min_by("t", order).alias("head"), F.min_by(pair, order).alias("pair"), F.min_by(term, order).alias("is_term"),
        F.array_sort(F.collect_list(F.when(~pair & ~term, F.struct(F.col(order).alias("o"), F.col("t"))))).alias("rest"),
    )
    parts = F.split("head", ": ", 2)
    body = F.array_join(F.transform("rest", lambda s: s["t"]), " ")
    name = F.when(F.col("pair"), F.trim(parts[0])).when(F.col("is_term"), F.col("head"))
    text = F.when(F.col("pair"), F.trim(parts[1])).when(F.col("is_term") & (body != ""), body)
    return group.select(doc, "at", "segment_ids", name.alias("term"), text.alias("definition")).filter("term is not null and definition is not null")


def page_heads(segments: DataFrame, doc: str = "file_id", most_pages: int = 35, chars: int = 1000) -> DataFrame:
    """(doc, page, head): the first characters of each of the first pages in small letters, its texts in order at lines of
    their own. Only texts that begin within them are put together."""
    t, page = F.coalesce("text", F.lit("")), F.coalesce("page", F.lit(1))
    rows = segments.filter(page <= most_pages).select(doc, "pos", page.alias("page"), t.alias("t"))
    before = F.sum(F.length("t") + 1).over(Window.partitionBy(doc, "page").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < chars)
    parts = rows.groupBy(doc, "page").agg(F.array_sort(F.collect_list(F.struct("pos", "t"))).alias("parts"))
    return parts.select(doc, "page", F.lower(F.substring(F.array_join(F.transform("parts", lambda x: x["t"]), "\n"), 1, chars)).alias("head"))


def page_scores(segments: DataFrame, doc: str = "file_id", most_pages: int = 40) -> DataFrame:
    """(doc, page, score): how much each of the first pages looks like a table of contents: 5 for a keyword in its first 1000
    characters and 5 for more than three runs of leaders or digits. A page of 5 or more is one to be looked at."""
    page = F.coalesce("page", F.lit(1))
    runs = segments.filter(page <= most_pages).groupBy(doc, page.alias("page")).agg(F.sum(F.coalesce(F.regexp_count("text", F.lit(r"[\.·\d]{5,}")), F.lit(0))).alias("runs"))
    rows = runs.join(page_heads(segments, doc, most_pages), [doc, "page"])
    score = F.when(F.col("head").rlike("|".join(lx.TOC_CANDIDATE_WORDS)), 5).otherwise(0) + F.when(F.col("runs") > 3, 5).otherwise(0)
    return rows.select(doc, "page", score.alias("score"))


def heuristic_entries(segments: DataFrame, doc: str = "file_id", most_pages: int = 35) -> DataFrame:
    """(doc, source_page, pos, line_no, title, page): lines of the first pages that end in a page number, on pages with
    more than five of them, or more than two and a keyword in the first 1000 characters."""
    t = F.coalesce("text", F.lit(""))
    rows = segments.filter(F.coalesce("page", F.lit(1)) <= most_pages).select(doc, F.coalesce("page", F.lit(1)).alias("source_page"), "pos", F.posexplode(F.split(t, "\n")).alias("line_no", "line"))
    pattern = r"^(.*?)(?:[\s\.·\u00a0\u2001\u2003]{3,})?\s*([ivxIVX\d]+)$"
    rows = rows.withColumn("page", F.regexp_extract("line", pattern, 2)).withColumn("title", F.trim(F.regexp_extract("line", pattern, 1)))
    head = page_heads(segments, doc, most_pages).select(doc, F.col("page").alias("source_page"), F.col("head").rlike("|".join(lx.TOC_PAGE_WORDS)).alias("word"))
    counts = rows.groupBy(doc, "source_page").agg(F.count_if(F.col("page") != "").alias("n")).join(head, [doc, "source_page"], "left")
    pages = counts.filter((F.col("n") > 5) | (F.coalesce("word", F.lit(False)) & (F.col("n") > 2))).select(doc, "source_page")
    return rows.filter((F.col("page") != "") & (F.length("title") >= 2)).join(pages, [doc, "source_page"], "left_semi")


def funnel(bookmarks: DataFrame, heuristic: DataFrame, doc: str = "file_id", least: int = 10, least_heuristic: int = 5) -> DataFrame:
    """(doc, source, entries): which table a document goes by: its bookmarks if there are more than ten, else the lines
    found in its text if more than five, else none."""
    a = bookmarks.groupBy(doc).agg(F.count(F.lit(1)).alias("a"))
    b = heuristic.groupBy(doc).agg(F.count(F.lit(1)).alias("b"))
    rows = a.join(b, doc, "full").select(doc, F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    source = F.when(F.col("a") > least, "metadata").when(F.col("b") > least_heuristic, "heuristic_text").otherwise("fallback")
    return rows.select(doc, source.alias("source"), F.when(source == "metadata", F.col("a")).when(source == "heuristic_text", F.col("b")).otherwise(0).alias("entries"))


def gated_paths(segments: DataFrame, gates: DataFrame, doc: str = "file_id") -> DataFrame:
    """``gated_path`` and ``doc_zone``: the ancestor stack with a reset where the body and the back matter start, and virtual
    roots outside the body. Without a start all is body."""
    rows = segments.join(gates, doc, "left")
    at = (F.col("segment_id") == F.col("start_id")) | (F.col("segment_id") == F.col("end_id"))
    rows = with_stack_path(rows, doc, [F.col("pos")], F.col("type") == "Header", F.col("level"), F.col("text"), reset=F.coalesce(at, F.lit(False)))
    w = Window.partitionBy(doc).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    state = F.last(F.when(F.col("segment_id") == F.col("end_id"), "back").when(F.col("segment_id") == F.col("start_id"), "body"), ignorenulls=True).over(w)
    rows = rows.withColumn("doc_zone", F.when(F.col("start_id").isNull(), "body").otherwise(F.coalesce(state, F.lit("front"))))
    root = F.when(F.col("doc_zone") == "back", "Back Matter").when(F.col("doc_zone") == "front", "Front Matter")
    return rows.withColumn("gated_path", F.concat_ws(SEP, root, F.when(F.col("path") != "", F.col("path")))).drop("path", "start_id", "end_id")


def glossary_pages(segments: DataFrame, doc: str = "file_id") -> DataFrame:
    """(doc, page): the page of a glossary title and those after it, up to one whose first 100 characters hold "index"
    and short of the last page."""
    page = F.coalesce("page", F.lit(0))
    t = F.lower(F.trim(F.coalesce("text", F.lit(""))))
    pages = segments.groupBy(doc, page.alias("page")).agg(F.max(t.isin("glossary", "glossary of terms")).alias("title"), F.min_by(F.substring(t, 1, 100), "pos").alias("top"))
    first = pages.groupBy(doc).agg(F.min(F.when(F.col("title"), F.col("page"))).alias("a"), F.max("page").alias("z"))
    rows = pages.join(first.filter("a is not null"), doc)
    stop = rows.filter((F.col("page") > F.col("a")) & F.col("top").contains("index")).groupBy(doc).agg(F.min("page").alias("s"))
    rows = rows.join(stop, doc, "left")
    keep = (F.col("page") == F.col("a")) | ((F.col("page") > F.col("a")) & (F.col("page") < F.coalesce("s", F.col("z"))))
    return rows.filter(keep).select(doc, "page")
