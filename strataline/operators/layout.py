"""Page layout: bands, furniture, columns, reading order, sidebars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.config import CANONICAL, Profile
from strataline.functions import lexicon as lx
from strataline.functions import text as tx


def has_box(b: Column) -> Column:
    return b.isNotNull() & (F.size(b) >= 4)


def in_band(b: Column, p: Profile = CANONICAL) -> Column:
    """Whether a box lies in an edge band of the page (y grows upwards here)."""
    hit = (b[1] > p.page_height * (1 - p.top_band)) | (b[3] < p.page_height * p.bottom_band)
    if p.side_band:
        hit = hit | (b[2] < p.page_width * p.side_band) | (b[0] > p.page_width * (1 - p.side_band))
    return F.coalesce(F.when(has_box(b), hit), F.lit(False))


def page_top(b: Column, height: float = 842.0) -> Column:
    """In the upper 15 % of a page whose y grows downwards (the parser's axis)."""
    return F.coalesce(F.when(has_box(b), b[1] < 0.15 * height), F.lit(False))


def page_bottom(b: Column, height: float = 842.0) -> Column:
    return F.coalesce(F.when(has_box(b), b[3] > 0.85 * height), F.lit(False))


def column_of(b: Column, width: float = 595.0) -> Column:
    """-1 for wide or middle boxes, 0 left, 1 right; 0 without a box."""
    middle = (b[0] + b[2]) / 2
    return F.when(~F.coalesce(has_box(b), F.lit(False)), 0).when((b[2] - b[0]) > 0.6 * width, -1).when(middle < 0.45 * width, 0).when(middle > 0.55 * width, 1).otherwise(-1)


def furniture_scan(df: DataFrame, doc: str = "file_id", p: Profile = CANONICAL) -> DataFrame:
    """(doc, form, pages, total_pages) of short texts in edge bands. Counts combine on the map side."""
    page = F.coalesce(F.col("page"), F.lit(0))
    total = df.groupBy(doc).agg(F.count_distinct(page).alias("total_pages"))
    t = F.trim("text")
    short = df.filter((t != "") & (tx.word_count(t) <= p.furniture_words) & in_band(F.col("bbox"), p))
    counts = short.groupBy(doc, tx.furniture_form(t).alias("form")).agg(F.count_distinct(page).alias("pages"))
    return counts.join(total, doc)


def mark_furniture(df: DataFrame, doc: str = "file_id", p: Profile = CANONICAL, out: str = "is_furniture") -> DataFrame:
    """``out``: page decoration by band, wording and repetition over the pages.

    The counts of ``furniture_scan`` as windows of a document's partition (a rank of pages within a wording, and its
    greatest), so that texts that are in the partitions of their documents aren't shuffled again.
    """
    t, b = F.trim(F.coalesce(F.col("text"), F.lit(""))), F.col("bbox")
    page = F.coalesce(F.col("page"), F.lit(0))
    rows = df.withColumn("__form", tx.furniture_form(t)).withColumn("__page", page)
    rows = rows.withColumn("__short", (t != "") & (tx.word_count(t) <= p.furniture_words) & in_band(b, p))
    total = F.max("__rank").over(Window.partitionBy(doc))
    rows = rows.withColumn("__rank", F.dense_rank().over(Window.partitionBy(doc).orderBy("__page"))).withColumn("__total", total)
    rows = rows.withColumn("__rank", F.when(F.col("__short"), F.dense_rank().over(Window.partitionBy(doc, "__form", "__short").orderBy("__page"))))
    pages = F.max("__rank").over(Window.partitionBy(doc, "__form"))
    often = F.coalesce((F.col("__total") >= p.furniture_pages) & (pages / F.col("__total") >= p.furniture_share), F.lit(False))
    rows = rows.withColumn("__often", often)
    worded, often = tx.matches(t, lx.FURNITURE), F.col("__often")
    if p.hard_band:
        decision = F.when(in_band(b, p), worded | ~t.rlike("(?i)" + lx.CAPTION_LIKE)).otherwise(worded | often)
    else:
        small = (tx.word_count(t) <= p.furniture_words) & in_band(b, p)
        decision = worded | (often & small) | ((tx.word_count(t) <= 2) & in_band(b, p) & tx.is_trivial(t))
    kinds = F.coalesce(F.col("type").isin(*p.furniture_types), F.lit(False))
    return rows.withColumn(out, kinds & (t != "") & decision).drop("__form", "__page", "__short", "__rank", "__total", "__often")


def reading_order(df: DataFrame, doc: str = "file_id", p: Profile = CANONICAL) -> DataFrame:
    """``new_pos`` and ``new_column``: continuations, spanning boxes, left column, right column of each page, each by
    falling y; or all by falling y when columns aren't isolated.

    ``priority`` (boolean) marks continuations; without the column there are none. A page's width is its widest box
    and a tenth; a page without boxes takes the width of the last page that has some.
    """
    page = F.coalesce(F.col("page"), F.lit(1))
    if "priority" not in df.columns:
        df = df.withColumn("priority", F.lit(False))
    b = F.col("bbox")
    rows = df.withColumn("__page", page).withColumn("__x", F.max(F.when(has_box(b), b[2])).over(Window.partitionBy(doc, "__page")))
    own = F.when(F.coalesce(F.col("__x"), F.lit(p.page_width)) > 100, F.coalesce(F.col("__x"), F.lit(p.page_width)) * 1.1)
    carried = F.last(own, ignorenulls=True).over(Window.partitionBy(doc).orderBy("__page").rangeBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__width", F.coalesce(carried, F.lit(p.page_width)))
    w, boxed = F.col("__width"), F.coalesce(has_box(b), F.lit(False))
    side = F.when(~boxed, -1).when((b[0] < w * p.column_share) & (b[2] > w * 0.55), -1).when(b[0] < w * p.column_share, 0).otherwise(1)
    rows = rows.withColumn("new_column", F.when(F.col("priority"), F.col("column_index")).otherwise(side))
    up = -F.coalesce(F.when(boxed, b[1]), F.lit(0.0))
    bucket = F.when(F.col("priority"), 0).when(F.col("new_column") == -1, 1).when(F.col("new_column") == 0, 2).otherwise(3)
    if p.isolate_columns:
        keys = [F.col("__page"), bucket, up, F.col("pos")]
    else:
        keys = [F.col("__page"), F.when(F.col("priority"), 0).otherwise(1), up, F.when(F.col("new_column") <= 0, 0).otherwise(1), F.col("pos")]
    return rows.withColumn("new_pos", F.row_number().over(Window.partitionBy(doc).orderBy(*keys)) - 1).drop("__page", "__width", "__x")


def backfill(df: DataFrame, doc: str = "file_id", order: str = "pos", path: str = "heading_path", out: str = "backfilled_path") -> DataFrame:
    """``out``: rows before a page's chapter heading take its text as root of their path."""
    page = F.coalesce(F.col("page"), F.lit(1))
    w = Window.partitionBy(doc, page)
    level = F.coalesce(F.col("level"), F.lit(99))
    top = F.min(F.when(F.col("type") == "Header", F.struct(level.alias("level"), F.col(order).alias("at"), F.trim("text").alias("t")))).over(w)
    rows = df.withColumn("__top", top)
    old, t = F.coalesce(F.col(path), F.lit("")), F.col("__top")
    parts = F.split(old, " > ")
    replaced = F.when(parts[0] == t["t"], old).otherwise(F.array_join(F.concat(F.array(t["t"]), F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1)))), " > "))
    new = F.when(old == "", t["t"]).otherwise(replaced)
    hit = (t["level"] <= 1) & (F.col(order) < t["at"]) & (t["t"] != "")
    return rows.withColumn(out, F.when(hit, new).otherwise(old)).drop("__top")


def backfill_empty(df: DataFrame, doc: str = "file_id", order: str = "pos") -> DataFrame:
    """The embedding profile's backfill: rows before a page's top heading (least depth, then the first) take its path
    where theirs is empty."""
    w = Window.partitionBy(doc, F.coalesce(F.col("page"), F.lit(1)))
    depth = F.coalesce(F.col("depth"), F.lit(10))
    top = F.min(F.when(F.col("type") == "Header", F.struct(depth.alias("depth"), F.col(order).alias("at"), F.col("heading_path").alias("path")))).over(w)
    hit = (F.coalesce("heading_path", F.lit("")) == "") & (F.col(order) < F.col("__top.at"))
    return df.withColumn("__top", top).withColumn("heading_path", F.when(hit, F.col("__top.path")).otherwise(F.col("heading_path"))).drop("__top")


def sidebars(df: DataFrame, doc: str = "file_id", p: Profile = CANONICAL) -> DataFrame:
    """``is_sidebar`` and ``sidebar_type``: headings and objectives by wording, and boxes inside the left zone of a
    page that has boxes on both sides of the column line."""
    t, b = F.coalesce(F.col("text"), F.lit("")), F.col("bbox")
    line = p.page_width * p.column_share
    w = Window.partitionBy(doc, F.coalesce(F.col("page"), F.lit(0)))
    both = F.max(F.when(b[0] < line, 1)).over(w) + F.max(F.when(b[0] >= line, 1)).over(w)
    heading, objective = tx.matches(t, lx.SIDEBAR_HEADINGS), tx.matches(t, lx.SIDEBAR_OBJECTIVES)
    inside = F.coalesce((both == 2) & (b[0] >= 0) & (b[2] <= line), F.lit(False))
    rows = df.withColumn("is_sidebar", heading | objective | inside)
    return rows.withColumn("sidebar_type", F.when(objective, "learning_objective").when(heading, "sidebar_heading"))


def sidebars_by_width(df: DataFrame, doc: str = "file_id", ratio: float = 0.35, gap: float = 30.0) -> DataFrame:
    """``narrow_sidebar``: boxes of at most ``ratio`` of the page's widest, more than ``gap`` points beside the main column
    (the boxes wider than half of the widest)."""
    b = F.col("bbox")
    w = Window.partitionBy(doc, F.coalesce(F.col("page"), F.lit(0)))
    width = F.when(has_box(b), b[2] - b[0])
    widest = F.max(width).over(w)
    rows = df.withColumn("__w", width).withColumn("__most", widest)
    main = F.col("__w") > 0.5 * F.col("__most")
    left, right = F.min(F.when(main, b[0])).over(w), F.max(F.when(main, b[2])).over(w)
    rows = rows.withColumn("__left", left).withColumn("__right", right)
    apart = (b[2] < F.col("__left") - gap) | (b[0] > F.col("__right") + gap)
    return rows.withColumn("narrow_sidebar", F.coalesce((F.col("__w") <= ratio * F.col("__most")) & apart, F.lit(False))).drop("__w", "__most", "__left", "__right")


def sidebars_rich(df: DataFrame, doc: str = "file_id", p: Profile = CANONICAL, ratio: float = 0.35, gap: float = 30.0) -> DataFrame:
    """``is_sidebar``, ``sidebar_zone`` (left, right, sidebar), ``sidebar_type`` (heading, learning_objective, key_term, summary,
    sidebar_content) and ``forbid_merge``: the older profile's sidebars.

    By wording, by the heading path, by zones (narrow boxes beside the main column, and from a narrow heading at the right
    edge to the edge), and objectives in narrow boxes. A zone holds what has its middle in it; the first of a page counts.
    """
    t, b = F.trim(F.coalesce("text", F.lit(""))), F.col("bbox")
    page, boxed = F.coalesce("page", F.lit(1)), F.coalesce(has_box(b), F.lit(False))
    w = Window.partitionBy(doc, page)
    ordered = w.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heading, objective = tx.matches(t, lx.SIDEBAR_HEADINGS), tx.matches(t, lx.SIDEBAR_OBJECTIVES)
    rows = df.withColumn("__w", F.when(boxed, b[2] - b[0])).withColumn("__most", F.max(F.when(boxed, b[2] - b[0])).over(w)).withColumn("__x", F.max(F.when(boxed, b[2])).over(w))
    main = F.col("__w") > 0.5 * F.col("__most")
    rows = rows.withColumn("__left", F.min(F.when(main, b[0])).over(w)).withColumn("__right", F.max(F.when(main, b[2])).over(w))
    rows = rows.withColumn("__width", F.when(F.col("__x") > 0.9 * p.page_width, F.greatest(F.lit(p.page_width), F.col("__x") * 1.05)).otherwise(F.lit(p.page_width))).withColumn("__h", heading).withColumn("__o", objective)
    narrow = F.col("__w") <= ratio * F.col("__most")
    side = F.when(narrow & (b[2] < F.col("__left") - gap), "left").when(narrow & (b[0] > F.col("__right") + gap), "right")
    zone = F.when(side.isNotNull(), F.struct(b[0].alias("a"), b[2].alias("z"), side.alias("side")))
    edge = F.col("__h") & (b[0] > 0.65 * F.col("__width")) & (F.col("__w") / F.col("__width") < ratio)
    rows = rows.withColumn("__zones", F.collect_list(zone).over(ordered)).withColumn("__edge", F.first(F.when(edge, F.struct(b[0].alias("a"), F.col("__width").alias("z"), F.lit("right").alias("side"))), ignorenulls=True).over(ordered))
    zones = F.when(F.exists("__zones", lambda z: z["side"] == "right") | F.col("__edge").isNull(), F.col("__zones")).otherwise(F.concat("__zones", F.array("__edge")))
    middle = (b[0] + b[2]) / 2
    rows = rows.withColumn("__all", zones).withColumn("__in", F.when(boxed, F.try_element_at(F.filter(zones, lambda z: (z["a"] <= middle) & (middle <= z["z"])), F.lit(1))["side"]))
    path = F.upper(F.coalesce("heading_path", F.lit("")))
    under = path.rlike("|".join(lx.SIDEBAR_PATHS))
    inside = under | F.col("__in").isNotNull() | F.coalesce((F.col("__w") / F.col("__width") < ratio) & F.col("__o"), F.lit(False))
    kind = (
        F.when(F.col("__o") | (path.rlike("OBJECTIVES|OUTCOMES") & (tx.word_count(t) > 3)), "learning_objective").when(path.contains("KEY"), "key_term")
        .when(path.contains("SUMMARY"), "summary").otherwise("sidebar_content")
    )
    is_one = F.col("__h") | inside
    rows = rows.withColumn("is_sidebar", is_one).withColumn("sidebar_zone", F.when(is_one, F.coalesce("__in", F.lit("sidebar"))))
    rows = rows.withColumn("sidebar_type", F.when(F.col("__h"), "heading").when(inside, kind)).withColumn("forbid_merge", is_one)
    return rows.drop(*[f"__{c}" for c in ("w", "most", "x", "left", "right", "width", "h", "o", "zones", "edge", "all", "in")])
