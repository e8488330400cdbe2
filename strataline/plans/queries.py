"""One query for each operator over the library's tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataline.config import CANONICAL, EMBEDDING
from strataline.functions import lexicon as lx
from strataline.functions import text as tx
from strataline.functions.patterns import any_re2, re2, sql
from strataline.operators import chunking, continuation, graph, layout, references, toc, vectors
from strataline.operators.stack import flatten_ids, real_levels, with_stack_path
from strataline.plans import deck, pipeline
from strataline.sources import tables as src
from strataline.streaming.files import session_windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SEG = f"seg as (select * exclude (rn) from (select *, row_number() over (partition by file_id, segment_id order by ingested_at desc) as rn from flat_segments) where rn = 1 union all by name {deck.sql(0)})"
TOC = f"toc as (select *, regexp_extract(entry_id, '(\\d+)', 1)::int as ord, try_cast(page as int) as page_no from (select * exclude (rn) from (select *, row_number() over (partition by file_id, entry_id order by ingested_at desc) as rn from toc_entries) where rn = 1 union all by name {deck.sql(1)}))"
CHK = f"chk as (select * exclude (rn) from (select *, row_number() over (partition by chunk_id order by ingested_at desc) as rn from chunks) where rn = 1 union all by name {deck.sql(2)})"
OPEN = ", ".join(sql(w) for w in lx.OPEN_CLAUSE_WORDS)
STARTERS = ", ".join(sql(w) for w in lx.CONTINUATION_STARTERS)


def query(sql_text: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql_text:
            ORACLES[f.__name__] = sql_text
        return f

    return add


def s_words(t: str) -> str:
    return f"len(list_filter(string_split_regex({t}, '\\s+'), lambda w: w <> ''))"


def s_first(t: str) -> str:
    return f"regexp_extract({t}, '^\\s*(\\S+)', 1)"


def s_last(t: str) -> str:
    return f"regexp_extract({t}, '(\\S+)\\s*$', 1)"


def s_match(t: str, patterns: list[str], flags: str = "i") -> str:
    return f"regexp_matches({t}, {sql(any_re2(patterns, flags))})"


def s_hyphen(t: str) -> str:
    w = s_last(t)
    stem = f"lower(regexp_replace({w}, '-+$', ''))"
    return f"(ends_with(rtrim({t}), '-') and (length({w}) <= 2 or {stem} in ({', '.join(sql(x) for x in lx.COMPOUND_PREFIXES)}) or ({stem} <> '' and not regexp_matches({stem}, '[aeiou]$'))))"


def s_open(t: str) -> str:
    return f"(lower({s_last(f'regexp_replace({t}, {sql(chr(91) + ".,;:!?" + chr(93) + chr(43) + chr(92) + "s*$")}, {sql("")})')}) in ({OPEN}))"


def s_fragment(t: str) -> str:
    return f"regexp_matches({t}, '(?:,|[=<>≤≥±]|\\.\\.\\.|…)\\s*$')"


def s_lower(t: str) -> str:
    return f"regexp_matches({t}, '^\\p{{Ll}}')"


def s_starts(t: str) -> str:
    return f"(regexp_matches(trim({t}), '^\\p{{Ll}}') or lower(regexp_replace({s_first(t)}, '[.,;:]+$', '')) in ({STARTERS}))"


def s_terminal(t: str) -> str:
    return f"regexp_matches(rtrim({t}), '[.?!:;]$')"


def s_band(p=CANONICAL) -> str:
    hit = f"bbox[2] > {p.page_height * (1 - p.top_band)!r} or bbox[4] < {p.page_height * p.bottom_band!r}"
    if p.side_band:
        hit += f" or bbox[3] < {p.page_width * p.side_band!r} or bbox[1] > {p.page_width * (1 - p.side_band)!r}"
    return f"coalesce(len(bbox) >= 4 and ({hit}), false)"


def s_form(t: str) -> str:
    squeezed, number = f"regexp_replace(lower(trim({t})), '\\s+', ' ', 'g')", "'(^|[^\\p{L}\\p{N}_])(?:page\\s*)?[0-9]+($|[^\\p{L}\\p{N}_])', '\\1\\2', 'g'"
    return f"trim(regexp_replace(regexp_replace({squeezed}, {number}), {number}))"


def s_sentences(t: str) -> str:
    return f"list_filter(list_transform(string_split(regexp_replace(trim({t}), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')"


def s_tags(t: str, rules: dict[str, list[str]], flags: str) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"case when {s_match(t, p, flags)} then {sql(k)} end" for k, p in rules.items()) + "], lambda x: x is not null), ',')"


def s_plain(t: str) -> str:
    return f"regexp_replace(lower(trim({t})), '[^a-z0-9]', '', 'g')"


def s_stack(level: str, text: str, part: str, order: str, source: str, header: str = "true", levels: int = 6, first: int = 1, reset: str = "false") -> str:
    """The ancestor stack in SQL: the last heading of each level, kept where it is below all last ones of smaller levels."""
    at = lambda i: f"({header}) and least(coalesce({level}, 1), {levels}) = {i}"
    ranks = range(first, levels + 1)
    cols = ", ".join(f"max(case when {at(i)} then n end) over w as p{i}, arg_max(case when {at(i)} then coalesce(trim({text}), '') end, case when {at(i)} then n end) over w as t{i}" for i in ranks)
    keep = []
    for i in ranks:
        above = ", ".join(["-1", *[f"coalesce(p{k}, -1)" for k in range(first, i)]])
        keep.append(f"case when p{i} > greatest({above}) and t{i} <> '' and p{i} >= coalesce(rs, -1) then t{i} end")
    return (
        f"stacked as (select *, concat_ws(' > ', {', '.join(keep)}) as path from (select *, max(case when {reset} then n end) over w as rs, {cols} from (select *, row_number() over (partition by {part} order by {order}) as n from {source}) "
        f"window w as (partition by {part} order by n rows between unbounded preceding and current row)))"
    )


# sources ---------------------------------------------------------------------------------------------------------------


@query("select doc_id, (i - 1)::int as pos, string_split(text, chr(10))[i] as line from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents where text is not null)")
def src_s12_lines(spark, d):
    return src.lines(src.table(spark, d, "documents"), "doc_id").withColumnRenamed("text", "line")


@query("select distinct source_file from source_files where file_id not in (select file_id from documents where file_id is not null)")
def src_s5_unprocessed(spark, d):
    files = src.table(spark, d, "source_files")
    done = files.join(src.table(spark, d, "documents").filter("file_id is not null").select("file_id").distinct(), "file_id", "left_semi")
    return src.unprocessed(files.select("source_file").distinct(), done)


@query("with seg as (select *, row_number() over (partition by file_id, segment_id order by ingested_at desc) as rn from flat_segments) select file_id, segment_id, type, page, style_hints.word_count as words from seg where rn = 1")
def src_s6_json_round_trip(spark, d):
    """Written as JSON documents into the session's warehouse folder, and read again."""
    out = spark.conf.get("spark.sql.warehouse.dir") + "/_documents"
    src.write_documents(src.segments(spark, d, "type", "page", "style_hints").drop("ingested_at"), out)
    back = spark.read.schema("file_id bigint, segment_id string, type string, page int, style_hints struct<word_count:int>").json(out)
    return back.select("file_id", "segment_id", "type", "page", F.col("style_hints.word_count").alias("words"))


# parser ----------------------------------------------------------------------------------------------------------------


@query(f"""with {SEG} select file_id, segment_id, (case when length(t) <= 4 and (regexp_matches(t, '^[0-9]+$') or regexp_matches(t, '^[IVXLC]+$')) then -1
  when regexp_matches(t, '(?i)^(Chapter|Part|Unit|Section|Appendix)\\s+([0-9]+|[IVXLC]+)') then 1 when upper(t) = t and lower(t) <> t and length(t) > 15 then 1
  when regexp_matches(t, '^[0-9]+\\.[0-9]+\\s') then 2 else 0 end)::int as inferred from (select *, trim(coalesce(text, '')) as t from seg where type = 'Header')""")
def parse_p2_heading_level(spark, d):
    s = deck.segments(spark, d, "type", "text").filter("type = 'Header'")
    return s.select("file_id", "segment_id", tx.heading_level(F.coalesce("text", F.lit(""))).alias("inferred"))


@query(f"""with {SEG}, h as (select file_id, pos, segment_id, case when regexp_matches(trim(coalesce(text,'')), '(?i)^(Chapter|Part|Unit|Section|Appendix)\\s+([0-9]+|[IVXLC]+)') then 1
   when regexp_matches(trim(coalesce(text,'')), '^[0-9]+\\.[0-9]+\\s') then 2 else 0 end as inf from seg where type = 'Header')
 select file_id, segment_id, (case when inf >= 1 then inf when max(case when inf in (0, 1) then 1 end) over (partition by file_id order by pos rows between unbounded preceding and 1 preceding) = 1 then 2 else 1 end)::int as real_level from h""")
def parse_p3_real_level(spark, d):
    t = F.trim(F.coalesce("text", F.lit("")))
    s = deck.segments(spark, d, "type", "text", "pos").filter("type = 'Header'")
    s = s.withColumn("inf", F.when(t.rlike(r"(?i)^(Chapter|Part|Unit|Section|Appendix)\s+([0-9]+|[IVXLC]+)"), 1).when(t.rlike(r"^[0-9]+\.[0-9]+\s"), 2).otherwise(0))
    return real_levels(s, "file_id", [F.col("pos")], F.lit(True), F.col("inf")).select("file_id", "segment_id", F.col("real_level").cast("int").alias("real_level"))


@query(f"""with {SEG} select file_id, segment_id, {s_lower('t')} as starts_lowercase, (t <> '' and not {s_terminal('t')}) as ends_incomplete, {s_words('t')} < 10 as is_short,
  regexp_matches(trim(t), '^[0-9\\-•●○▪]') as has_list_marker, {s_hyphen('t')} as ends_with_hyphen, {s_open('t')} as ends_with_open_clause, {s_fragment('t')} as has_fragment_pattern,
  {s_starts('t')} as starts_like_continuation, {s_terminal('t')} as has_terminal_punctuation, {s_words('t')}::int as word_count from (select *, coalesce(text, '') as t from seg)""")
def parse_p13_style_hints(spark, d):
    s = deck.segments(spark, d, "type", "text")
    return s.select("file_id", "segment_id", tx.style_hints(F.col("text"), F.col("type")).alias("h")).select("file_id", "segment_id", "h.*").drop("segment_type")


@query(f"""with {SEG} select file_id, segment_id, coalesce(len(bbox) >= 4 and bbox[2] < 0.15 * 842, false) as is_top, coalesce(len(bbox) >= 4 and bbox[4] > 0.85 * 842, false) as is_bottom,
  (case when not coalesce(len(bbox) >= 4, false) then 0 when bbox[3] - bbox[1] > 0.6 * 595 then -1 when (bbox[1] + bbox[3]) / 2 < 0.45 * 595 then 0 when (bbox[1] + bbox[3]) / 2 > 0.55 * 595 then 1 else -1 end)::int as col from seg""")
def parse_p7_p8_position(spark, d):
    b = F.col("bbox")
    return deck.segments(spark, d, "bbox").select("file_id", "segment_id", layout.page_top(b).alias("is_top"), layout.page_bottom(b).alias("is_bottom"), layout.column_of(b).cast("int").alias("col"))


@query(f"""with {SEG} select file_id, segment_id, concat_ws(' ', case when heading_path <> '' then '[Path: ' || heading_path || ']' end, case when len(tags) > 0 then '[Tags: ' || array_to_string(tags, ', ') || ']' end, text) as context from seg""")
def parse_p5_context(spark, d):
    s = deck.segments(spark, d, "heading_path", "tags", "text")
    return s.select("file_id", "segment_id", tx.context_text(F.col("heading_path"), F.col("tags"), F.col("text")).alias("context"))


@query(f"with {SEG} select file_id, pos, 'seg_' || lpad((row_number() over (partition by file_id order by pos))::varchar, 4, '0') as new_id from seg")
def parse_p14_ids(spark, d):
    return flatten_ids(deck.segments(spark, d, "pos"), "file_id", [F.col("pos")], "new_id").select("file_id", "pos", "new_id")


@query(f"""with {TOC} select file_id, entry_id, level, coalesce(lead(level) over (partition by file_id order by ord) > level, false) as has_children from toc where level is not null
  qualify has_children or length(title) >= 5""")
def parse_p6_toc_pruning(spark, d):
    return toc.pruned(deck.toc(spark, d)).select("file_id", "entry_id", "level", "has_children")


_ENTRY = "'^(.*?)(?:[\\s\\.·\\x{00a0}\\x{2001}\\x{2003}]{3,})?\\s*([ivxIVX0-9]+)$'"
_HEURISTIC = f"""l as (select file_id, coalesce(page, 1)::int as source_page, pos, i - 1 as line_no, string_split(t, chr(10))[i] as line from (select *, unnest(range(1, len(string_split(t, chr(10))) + 1)) as i from (select *, coalesce(text, '') as t from seg where coalesce(page, 1) <= 35))),
 m as (select *, regexp_extract(line, {_ENTRY}, 2) as page, trim(regexp_extract(line, {_ENTRY}, 1)) as title from l),
 hd as (select file_id, coalesce(page, 1)::int as source_page, regexp_matches(lower(substring(string_agg(coalesce(text, ''), chr(10) order by pos), 1, 1000)), '{"|".join(lx.TOC_PAGE_WORDS)}') as word from seg group by all),
 ok as (select file_id, source_page from m join hd using (file_id, source_page) group by all having count(*) filter (page <> '') > 5 or (bool_or(word) and count(*) filter (page <> '') > 2)),
 found as (select m.* from m semi join ok using (file_id, source_page) where page <> '' and length(title) >= 2)"""


@query(f"""with {SEG}, {TOC}, {_HEURISTIC}, n as (select file_id, coalesce(a, 0) as a, coalesce(b, 0) as b from (select file_id, count(*) as a from toc group by 1) full join (select file_id, count(*) as b from found group by 1) using (file_id))
 select file_id, case when a > 10 then 'metadata' when b > 5 then 'heuristic_text' else 'fallback' end as source, case when a > 10 then a when b > 5 then b else 0 end as entries from n""")
def toc_t1_funnel(spark, d):
    return toc.funnel(deck.toc(spark, d), toc.heuristic_entries(deck.segments(spark, d, "pos", "page", "text"))).withColumn("entries", F.col("entries").cast("bigint"))


@query(f"with {SEG}, {_HEURISTIC} select file_id, source_page, pos, title, page from found")
def toc_t2_heuristic_entries(spark, d):
    return toc.heuristic_entries(deck.segments(spark, d, "pos", "page", "text")).select("file_id", "source_page", "pos", "title", "page")


_PAGES = f"""pages as (select file_id, coalesce(page, 0)::int as page from seg group by all having (bool_or(regexp_matches(lower(coalesce(text, '')), '{"|".join(lx.TOC_KEYWORDS)}')) and coalesce(page, 0) < 60)
 or (coalesce(page, 0) < 45 and count(*) filter (regexp_matches(lower(coalesce(text, '')), '[\\.·-]{{5,}}\\s*[0-9]+$')) >= 3))"""
_GATE = f"""{_PAGES}, gap as (select *, coalesce(page - lag(page) over (partition by file_id order by page), 0) > 8 as gap from pages where page < 100),
 run as (select *, max(gap::int) over (partition by file_id order by page) as cut from gap), ends as (select file_id, max(page) as e from run where cut = 0 group by 1),
 heads as (select file_id, segment_id, pos, coalesce(page, 0) as page, trim(coalesce(text, '')) as t, (file_id, coalesce(page, 0)) in (select (file_id, page) from pages) as listed from seg where type = 'Header' and level = 1),
 st as (select file_id, min(struct_pack(p := pos, s := segment_id)) as s from heads left join ends using (file_id) where not listed and page > coalesce(e, 0) and page <= 100 and {s_match('t', lx.GATE_START, 'i')} group by 1),
 gate as (select st.file_id, any_value(st.s.s) as start_id, arg_min(case when h.pos > st.s.p and {s_match('h.t', lx.GATE_END, 'i')} then h.segment_id end, case when h.pos > st.s.p and {s_match('h.t', lx.GATE_END, 'i')} then h.pos end) as end_id from st join heads h using (file_id) group by st.file_id)"""


@query(f"""with {SEG}, {_GATE}, g as (select seg.*, start_id, end_id from seg left join gate using (file_id)), {s_stack('level', 'text', 'file_id', 'pos', 'g', header=chr(39).join(['type = ', 'Header', '']), reset='coalesce(segment_id in (start_id, end_id), false)')},
 z as (select *, last_value(case when segment_id = end_id then 'back' when segment_id = start_id then 'body' end ignore nulls) over (partition by file_id order by pos rows between unbounded preceding and current row) as state from stacked),
 y as (select *, case when start_id is null then 'body' else coalesce(state, 'front') end as doc_zone from z)
 select file_id, segment_id, concat_ws(' > ', case doc_zone when 'back' then 'Back Matter' when 'front' then 'Front Matter' end, nullif(path, '')) as gated_path, doc_zone from y""")
def layout_l8_gated_paths(spark, d):
    s = deck.segments(spark, d, "pos", "page", "type", "level", "text")
    return toc.gated_paths(s, toc.gate(s, toc.toc_pages(s))).select("file_id", "segment_id", "gated_path", "doc_zone")


def toc_t15_glossary_pages(spark, d):
    return toc.glossary_pages(deck.segments(spark, d, "pos", "page", "text"))


@query(f"""with {SEG} select file_id, segment_id, case when regexp_matches(upper(coalesce(heading_path, '')), 'OBJECTIVES|LEARNING OBJECTIVE') and contains(lower(type), 'list') then 'LearningObjective'
  when regexp_matches(lower(type), '{"|".join(lx.HEADING_LABELS)}') and not regexp_matches(lower(type), '{"|".join(lx.NOISE_LABELS)}') then 'Header' when contains(lower(type), 'caption') then 'Caption' when contains(lower(type), 'table') then 'Table' when contains(lower(type), 'list') then 'ListItem'
  when regexp_matches(lower(type), 'formula|equation') then 'Formula' when regexp_matches(lower(type), 'picture|image') then 'Picture' else 'Paragraph' end as kind from seg where type is not null""")
def parse_p1_segment_type(spark, d):
    s = deck.segments(spark, d, "type", "heading_path").filter("type is not null")
    return s.select("file_id", "segment_id", tx.segment_type(F.col("type"), F.col("type"), F.col("heading_path")).alias("kind"))


# layout ----------------------------------------------------------------------------------------------------------------


@query(f"""with {SEG}, total as (select file_id, count(distinct coalesce(page, 0)) as total_pages from seg group by 1)
 select file_id, {s_form('text')} as form, count(distinct coalesce(page, 0)) as pages, total_pages from seg join total using (file_id)
 where trim(text) <> '' and {s_words('trim(text)')} <= 8 and {s_band()} group by all""")
def layout_l2_furniture_scan(spark, d):
    return layout.furniture_scan(deck.segments(spark, d, "page", "text", "bbox")).select("file_id", "form", "pages", "total_pages")


def _furniture_sql(p, decision: str) -> str:
    types = ", ".join(sql(t) for t in p.furniture_types)
    return f"""with {SEG}, total as (select file_id, count(distinct coalesce(page, 0)) as total_pages from seg group by 1),
 often as (select file_id, {s_form('text')} as form from seg join total using (file_id) where trim(text) <> '' and {s_words('trim(text)')} <= {p.furniture_words} and {s_band(p)} and total_pages >= {p.furniture_pages}
   group by file_id, form, total_pages having count(distinct coalesce(page, 0)) / total_pages >= {p.furniture_share}),
 x as (select s.file_id, segment_id, type, bbox, trim(coalesce(text, '')) as t, o.form is not null as often from seg s left join often o on s.file_id = o.file_id and {s_form("coalesce(text, '')")} = o.form)
 select file_id, segment_id from x where type in ({types}) and t <> '' and ({decision})"""


@query(_furniture_sql(CANONICAL, f"case when {s_band()} then {s_match('t', lx.FURNITURE)} or not regexp_matches(t, {sql('(?i)' + lx.CAPTION_LIKE)}) else {s_match('t', lx.FURNITURE)} or often end"))
def layout_l3_furniture(spark, d):
    s = deck.segments(spark, d, "type", "page", "text", "bbox")
    return layout.mark_furniture(s).filter("is_furniture").select("file_id", "segment_id")


@query(_furniture_sql(EMBEDDING, f"{s_match('t', lx.FURNITURE)} or (often and {s_words('t')} <= 5 and {s_band(EMBEDDING)}) or ({s_words('t')} <= 2 and {s_band(EMBEDDING)} and (regexp_matches(t, '^[0-9\\s.,-]+$') or length(t) <= 2 or regexp_matches(t, '^[ivxlcdmIVXLCDM]+$')))"))
def layout_l5_furniture_embedding(spark, d):
    s = deck.segments(spark, d, "type", "page", "text", "bbox")
    return layout.mark_furniture(s, p=EMBEDDING).filter("is_furniture").select("file_id", "segment_id")


def _order_sql(keys: str) -> str:
    return f"""with {SEG}, wid as (select file_id, coalesce(page, 1) as pg, max(case when len(bbox) >= 4 then bbox[3] end) as x from seg group by all),
 carried as (select file_id, pg, coalesce(last_value(case when coalesce(x, 612.0) > 100 then coalesce(x, 612.0) * 1.1 end ignore nulls) over (partition by file_id order by pg rows between unbounded preceding and current row), 612.0) as w from wid),
 y as (select s.file_id, segment_id, pos, pg, -coalesce(case when len(bbox) >= 4 then bbox[2] end, 0.0) as up,
   case when not coalesce(len(bbox) >= 4, false) then -1 when bbox[1] < w * 0.45 and bbox[3] > w * 0.55 then -1 when bbox[1] < w * 0.45 then 0 else 1 end as col
   from seg s join carried c on s.file_id = c.file_id and coalesce(s.page, 1) = c.pg)
 select file_id, segment_id, (row_number() over (partition by file_id order by {keys}) - 1)::int as new_pos, col::int as new_column from y"""


@query(_order_sql("pg, case col when -1 then 1 when 0 then 2 else 3 end, up, pos"))
def layout_l6_reading_order(spark, d):
    s = deck.segments(spark, d, "pos", "page", "bbox", "column_index")
    return layout.reading_order(s).select("file_id", "segment_id", "new_pos", F.col("new_column").cast("int").alias("new_column"))


@query(_order_sql("pg, up, case when col <= 0 then 0 else 1 end, pos"))
def layout_l7_interleaved_order(spark, d):
    s = deck.segments(spark, d, "pos", "page", "bbox", "column_index")
    return layout.reading_order(s, p=EMBEDDING).select("file_id", "segment_id", "new_pos", F.col("new_column").cast("int").alias("new_column"))


@query(f"with {SEG}, {s_stack('level', 'text', 'file_id', 'pos', 'seg', header=chr(39).join(['type = ', 'Header', '']))} select file_id, segment_id, path from stacked")
def layout_l8_heading_stack(spark, d):
    s = deck.segments(spark, d, "pos", "type", "level", "text")
    return with_stack_path(s, "file_id", [F.col("pos")], F.col("type") == "Header", F.col("level"), F.col("text")).select("file_id", "segment_id", "path")


@query(f"""with {SEG}, top as (select file_id, coalesce(page, 1) as pg, min(struct_pack(l := coalesce(level, 99), p := pos, t := trim(text))) as h from seg where type = 'Header' group by all)
 select s.file_id, segment_id, case when h.l <= 1 and pos < h.p and h.t <> '' then case when coalesce(heading_path, '') = '' then h.t when string_split(heading_path, ' > ')[1] = h.t then heading_path
   else array_to_string([h.t] || string_split(heading_path, ' > ')[2:], ' > ') end else coalesce(heading_path, '') end as backfilled_path from seg s left join top on s.file_id = top.file_id and coalesce(s.page, 1) = top.pg""")
def layout_l9_backfill(spark, d):
    return layout.backfill(deck.segments(spark, d, "pos", "page", "type", "level", "text", "heading_path")).select("file_id", "segment_id", "backfilled_path")


@query(f"""with {SEG}, z as (select *, max(case when bbox[1] < 275.4 then 1 end) over w + max(case when bbox[1] >= 275.4 then 1 end) over w as both_sides from seg window w as (partition by file_id, coalesce(page, 0)))
 select file_id, segment_id, case when {s_match("coalesce(text, '')", lx.SIDEBAR_OBJECTIVES)} then 'learning_objective' when {s_match("coalesce(text, '')", lx.SIDEBAR_HEADINGS)} then 'sidebar_heading' end as sidebar_type from z
 where {s_match("coalesce(text, '')", lx.SIDEBAR_OBJECTIVES)} or {s_match("coalesce(text, '')", lx.SIDEBAR_HEADINGS)} or coalesce(both_sides = 2 and bbox[1] >= 0 and bbox[3] <= 275.4, false)""")
def layout_l10_sidebars(spark, d):
    return layout.sidebars(deck.segments(spark, d, "page", "text", "bbox")).filter("is_sidebar").select("file_id", "segment_id", "sidebar_type")


@query(f"""with {SEG}, a as (select *, case when len(bbox) >= 4 then bbox[3] - bbox[1] end as wd, max(case when len(bbox) >= 4 then bbox[3] - bbox[1] end) over (partition by file_id, coalesce(page, 0)) as mx from seg),
 b as (select *, min(case when wd > 0.5 * mx then bbox[1] end) over w as lf, max(case when wd > 0.5 * mx then bbox[3] end) over w as rg from a window w as (partition by file_id, coalesce(page, 0)))
 select file_id, segment_id from b where wd <= 0.35 * mx and (bbox[3] < lf - 30.0 or bbox[1] > rg + 30.0)""")
def layout_l11_narrow_sidebars(spark, d):
    return layout.sidebars_by_width(deck.segments(spark, d, "page", "bbox")).filter("narrow_sidebar").select("file_id", "segment_id")


# contents and structure ------------------------------------------------------------------------------------------------


@query(f"""with {TOC}, r as (select *, trim(lower(title)) as t from toc where page_no is not null), s as (select file_id, min(struct_pack(o := ord, p := page_no)) as s from r where {s_match('t', lx.BODY_START_TITLES)} and page_no < 150 group by 1),
 g as (select r.*, s.s, (select min(struct_pack(o := n.ord, p := n.page_no)) from r n where n.file_id = r.file_id and n.ord > r.ord and coalesce(n.level, 1) = 1).p as nxt from r left join s using (file_id))
 select file_id, coalesce(any_value(s.p), 1)::int as body_start, coalesce(case when any_value(s) is not null then min(case when ord >= s.o and page_no > s.p + 100 and {s_match('t', lx.BACK_TITLES)} and coalesce(level, 1) = 1 then page_no end) end, 9999)::int as back_start,
  (arg_max(page_no, ord) filter (contains(t, 'glossary')))::int as glossary_start, (arg_max(coalesce(nxt - 1, page_no + 15), ord) filter (contains(t, 'glossary')))::int as glossary_end, count(*) filter (level = 1) as chapters from g group by file_id""")
def toc_t3_section_map(spark, d):
    return toc.section_map(deck.toc(spark, d))


@query(f"with {TOC} select file_id, ord, title, page_no as start_page, coalesce(lead(page_no) over (partition by file_id order by ord) - 1, 2000)::int as end_page from toc where level = 1 and page_no is not null")
def toc_t3_chapters(spark, d):
    return toc.chapters(deck.toc(spark, d))


_GOLD = f"""e as (select *, max(page_no) over (partition by file_id order by ord rows between unbounded preceding and current row) as reach from toc where page_no is not null), {s_stack('level', 'title', 'file_id', 'ord', 'e', levels=9, first=0)},
 gold as (select s.file_id, s.segment_id, any_value(s.heading_path) as heading_path, coalesce(arg_max(st.path, st.ord), '') as gold_path from seg s left join stacked st on st.file_id = s.file_id and st.reach <= coalesce(s.page, 1) group by s.file_id, s.segment_id)"""


@query(f"with {SEG}, {TOC}, {_GOLD} select file_id, segment_id, gold_path from gold")
def toc_t4_gold_path(spark, d):
    return toc.gold_paths(deck.segments(spark, d, "page"), deck.toc(spark, d)).select("file_id", "segment_id", "gold_path")


@query(f"""with {SEG}, {TOC} select file_id, segment_id from seg where type = 'Header' and trim(coalesce(text, '')) <> '' and file_id in (select file_id from toc)
 and not exists (select 1 from toc where toc.file_id = seg.file_id and {s_plain('toc.title')} = {s_plain("coalesce(seg.text, '')")})""")
def toc_t5_downgraded_headers(spark, d):
    rows = toc.enforce_headers(deck.segments(spark, d, "type", "text"), deck.toc(spark, d))
    return rows.filter("type = 'Header' and new_type = 'Paragraph'").select("file_id", "segment_id")


@query(f"""with {SEG}, {TOC}, {_GOLD}, k as (select *, list_filter(list_transform(string_split(coalesce(heading_path, ''), ' > '), lambda x: trim(x)), lambda p: not {s_match('p', lx.PATH_NOISE)}
   and not list_contains(list_transform(string_split(gold_path, ' > '), lambda g: {s_plain('g')}), {s_plain('p')}) and length({s_plain('p')}) >= 3)[-1] as own from gold)
 select file_id, segment_id, case when gold_path = '' then heading_path when coalesce(length(own) < 60 and not ends_with(trim(own), '.'), false) then gold_path || ' > ' || own else gold_path end as path from k""")
def toc_t6_seeded_path(spark, d):
    rows = toc.gold_paths(deck.segments(spark, d, "page", "heading_path"), deck.toc(spark, d))
    return rows.select("file_id", "segment_id", toc.seed_path(F.col("gold_path"), F.col("heading_path")).alias("path"))


@query(f"with {SEG}, {_PAGES} select * from pages")
def toc_t7_pages(spark, d):
    return toc.toc_pages(deck.segments(spark, d, "page", "text"))


@query(r"""with l as (select doc_id, i - 1 as pos, trim(string_split(text, chr(10))[i]) as t from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents where text is not null)),
 m as (select doc_id, pos, t, trim(regexp_extract(t, '^(.*?)(?:[\.·\-_]{3,}|[\s]{2,})([0-9]+)$', 1)) as title, regexp_extract(t, '^(.*?)(?:[\.·\-_]{3,}|[\s]{2,})([0-9]+)$', 2) as pg from l)
 select doc_id, pos::int as pos, title, try_cast(pg as bigint) as page_no, (case when regexp_matches(upper(title), '^(?:PART|MODULE)') then 0 when starts_with(upper(title), 'CHAPTER') or regexp_matches(title, '^[0-9]+\.?\s+[A-Z]') then 1 else 0 end)::int as level from m where length(t) >= 3 and pg <> ''""")
def toc_t8_lines(spark, d):
    rows = src.lines(src.table(spark, d, "documents"), "doc_id")
    m = toc.toc_line(F.col("text"), F.lit(0))
    return rows.withColumn("m", m).filter("m is not null").select("doc_id", "pos", "m.title", "m.page_no", "m.level")


@query(r"""with m as (select file_id, segment_id, trim(coalesce(text, '')) as t, coalesce(bbox[1], 0.0) as x, trim(regexp_extract(trim(coalesce(text, '')), '^(.*?)(?:[\.·\-_]{3,}|[\s]{2,})([0-9]+)$', 1)) as title, regexp_extract(trim(coalesce(text, '')), '^(.*?)(?:[\.·\-_]{3,}|[\s]{2,})([0-9]+)$', 2) as pg from seg)
 select file_id, segment_id, title, try_cast(pg as bigint) as page_no, (case when regexp_matches(upper(title), '^(?:PART|MODULE)') then 0 when starts_with(upper(title), 'CHAPTER') or regexp_matches(title, '^[0-9]+\.?\s+[A-Z]') then 1 when x < 60 then 0 when x < 90 then 1 else 2 end)::int as level from m where length(t) >= 3 and pg <> ''""".replace("with m", f"with {SEG}, m", 1))
def toc_t8_placed_lines(spark, d):
    """Contents lines of segments, whose place on the page tells the level."""
    s = deck.segments(spark, d, "text", "bbox").withColumn("m", toc.toc_line(F.coalesce("text", F.lit("")), F.coalesce(F.try_element_at("bbox", F.lit(1)), F.lit(0.0))))
    return s.filter("m is not null").select("file_id", "segment_id", "m.title", "m.page_no", "m.level")


@query(f"""with {SEG}, {TOC}, e as (select *, row_number() over w as n, greatest(coalesce(lead(page_no) over w - 1, 99999), page_no) as b from toc where page_no is not null window w as (partition by file_id order by page_no, ord)),
 best as (select s.file_id, s.pg, arg_max(e.title, e.n) as title from (select distinct file_id, coalesce(page, 0) as pg from seg) s join e on e.file_id = s.file_id and s.pg between e.page_no and e.b where e.level <= 1 group by all)
 select s.file_id, segment_id, case when title is null or contains(coalesce(heading_path, ''), title) then coalesce(heading_path, '') when coalesce(heading_path, '') = '' then title else title || ' > ' || heading_path end as skeleton_path
 from seg s left join best b on s.file_id = b.file_id and coalesce(s.page, 0) = b.pg""")
def toc_t9_skeleton(spark, d):
    return toc.skeleton(deck.segments(spark, d, "page", "heading_path"), deck.toc(spark, d)).select("file_id", "segment_id", "skeleton_path")


@query(f"with {SEG}, {_GATE} select file_id, start_id, end_id from gate where start_id is not null")
def toc_t10_gate(spark, d):
    s = deck.segments(spark, d, "pos", "page", "type", "level", "text")
    return toc.gate(s, toc.toc_pages(s)).filter("start_id is not null")


_MD = f"h as (select doc_id, i - 1 as pos, length(regexp_extract(l, '^(#+)\\s+(.*)$', 1)) as level, trim(regexp_extract(l, '^(#+)\\s+(.*)$', 2)) as title from (select doc_id, i, string_split(text, chr(10))[i] as l from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents where text is not null)) where regexp_matches(l, '^#+\\s'))"


@query(f"""with {_MD}, c as (select doc_id, pos, level, regexp_replace(regexp_replace(title, '\\[(.*?)\\]\\(.*?\\)', '\\1', 'g'), '\\*\\*|__', '', 'g') as title from h where not {s_match('title', lx.LOGIC_NOISE)} and length(title) >= 2),
 {s_stack('level', 'title', 'doc_id', 'pos', 'c', levels=9)} select doc_id, {s_plain('title')} as norm, arg_max(path, case when level < 3 then pos else -1 - pos end) as path, min(pos)::int as ord from stacked group by doc_id, norm""")
def toc_t11_logic_book(spark, d):
    return toc.logic_book(src.markdown_headings(src.table(spark, d, "documents"), "doc_id", "text"), "doc_id")


@query(f"""with {_MD}, c as (select doc_id, pos, level, regexp_replace(regexp_replace(title, '\\[(.*?)\\]\\(.*?\\)', '\\1', 'g'), '\\*\\*|__', '', 'g') as title from h where not {s_match('title', lx.LOGIC_NOISE)} and length(title) >= 2),
 {s_stack('level', 'title', 'doc_id', 'pos', 'c', levels=9)}, book as (select doc_id, {s_plain('title')} as norm, arg_max(path, case when level < 3 then pos else -1 - pos end) as path, min(pos)::int as ord from stacked group by doc_id, norm),
 li as (select doc_id, (i - 1)::int as pos, {s_plain('string_split(text, chr(10))[i]')} as norm from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents where text is not null)),
 own as (select distinct doc_id, norm from li), near as (select own.doc_id, own.norm, arg_min(b.path, b.ord) as path from own join book b on b.doc_id = own.doc_id and length(b.norm) > 10 and (starts_with(own.norm, b.norm) or starts_with(b.norm, own.norm)) group by all)
 select li.doc_id, li.pos, coalesce(b.path, n.path) as logic_path from li left join book b on b.doc_id = li.doc_id and b.norm = li.norm left join near n on n.doc_id = li.doc_id and n.norm = li.norm where coalesce(b.path, n.path) is not null""")
def toc_t12_logic_paths(spark, d):
    docs = src.table(spark, d, "documents")
    book = toc.logic_book(src.markdown_headings(docs, "doc_id", "text"), "doc_id")
    rows = src.lines(docs, "doc_id")
    return toc.look_up(rows, book, "doc_id").filter("logic_path is not null").select("doc_id", "pos", "logic_path")


@query(f"""with {SEG}, {TOC}, r as (select *, trim(lower(title)) as t from toc where page_no is not null), s as (select file_id, min(struct_pack(o := ord, p := page_no)) as s from r where {s_match('t', lx.BODY_START_TITLES)} and page_no < 150 group by 1),
 b as (select r.file_id, coalesce(any_value(s.p), 1) as bs, coalesce(min(case when ord >= s.o and page_no > s.p + 100 and {s_match('t', lx.BACK_TITLES)} and coalesce(level, 1) = 1 then page_no end), 9999) as bk from r left join s using (file_id) group by 1)
 select file_id, segment_id, case when page <= bs - 1 then 'front' when page >= bk then 'back' else 'body' end as zone from seg join b using (file_id)""")
def toc_t14_zones(spark, d):
    rows = deck.segments(spark, d, "page").join(toc.section_map(deck.toc(spark, d)), "file_id")
    return rows.select("file_id", "segment_id", toc.zone(F.col("page"), F.col("body_start"), F.col("back_start")).alias("zone"))


_GLOSSARY_PAGES = f"""pg as (select file_id, coalesce(page, 0) as page, bool_or(lower(trim(coalesce(text, ''))) in ('glossary', 'glossary of terms')) as title, arg_min(substring(lower(trim(coalesce(text, ''))), 1, 100), pos) as top from seg group by all),
 f as (select file_id, min(page) filter (title) as a, max(page) as z from pg group by 1 having a is not null), st as (select pg.file_id, min(page) as s from pg join f using (file_id) where page > a and contains(top, 'index') group by 1),
 gp as (select pg.file_id, page::int as page from pg join f using (file_id) left join st using (file_id) where page = a or (page > a and page < coalesce(s, z)))"""


query(f"with {SEG}, {_GLOSSARY_PAGES} select * from gp")(toc_t15_glossary_pages)


@query(f"""with {SEG}, {_GLOSSARY_PAGES}, r as (select *, trim(coalesce(text, '')) as t from seg where (file_id, coalesce(page, 0)) in (select (file_id, page) from gp)), k as (select *, contains(t, ': ') as pair, not contains(t, ': ') and length(t) < 60 and not ends_with(t, '.') as term from r where length(t) >= 2 and lower(t) <> 'glossary'),
 g as (select *, sum((pair or term)::int) over (partition by file_id order by pos) as g from k), h as (select file_id, g, arg_min(t, pos) as head, arg_min(pair, pos) as pair, arg_min(term, pos) as term, string_agg(case when not pair and not term then t end, ' ' order by pos) as body from g group by 1, 2)
 select file_id, case when pair then trim(substring(head, 1, strpos(head, ': ') - 1)) else head end as term, case when pair then trim(substring(head, strpos(head, ': ') + 2)) else body end as definition from h where pair or (term and coalesce(body, '') <> '')""")
def toc_t16_glossary(spark, d):
    s = deck.segments(spark, d, "pos", "page", "text").withColumn("page", F.coalesce("page", F.lit(0)))
    return toc.glossary_items(s.join(toc.glossary_pages(s), ["file_id", "page"], "left_semi"))


_ISBN = "(?i)ISBN(?:-13|-10)?[:\\s]+(?:[0-9]{1,5}[-\\s]?)?([0-9]+[-\\s]?[0-9]+[-\\s]?[0-9]+[-\\s]?[0-9]+[-\\s]?[0-9]+)"
_SCANNED = f"""isbns as (select file_id, arg_min(regexp_replace(n, '[- ]', '', 'g'), pos) as isbn from (select file_id, pos, case when regexp_extract(text, '{_ISBN}', 1) <> '' then regexp_extract(text, '{_ISBN}', 1) else nullif(regexp_extract(text, '(?i)ISBN\\s+([0-9-]{{10,25}})', 1), '') end as n from seg where coalesce(page, 0) <= 30) where n is not null group by 1)"""


@query(f"with {SEG}, {_SCANNED} select * from isbns")
def toc_t18_isbn(spark, d):
    return toc.scanned_isbn(deck.segments(spark, d, "pos", "page", "text"))


@query(f"""with {SEG}, w as (select *, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') as ws, string_split_regex(text, '\\s{{3,}}') as ps from seg where text is not null),
 j as (select file_id, segment_id, text, case when length(text) >= 5 and regexp_matches(text, '[A-Za-z]\\s[A-Za-z]\\s[A-Za-z]') and len(ws) >= 3 and len(list_filter(ws, lambda x: length(x) = 1)) / len(ws) > 0.6
   then case when len(ps) > 1 then array_to_string(list_transform(ps, lambda p: regexp_replace(p, '\\s+', '', 'g')), ' ') else array_to_string(ws, '') end else text end as joined from w)
 select file_id, segment_id, joined from j where joined <> text""")
def toc_t19_spaced_text(spark, d):
    s = deck.segments(spark, d, "text").filter("text is not null").withColumn("joined", tx.spaced_text(F.col("text")))
    return s.filter("joined <> text").select("file_id", "segment_id", "joined")


@query(f"""with {SEG}, {_SCANNED}, a as (select file_id, max(title) as title, max(isbn) as isbn from source_files group by 1), b as (select coalesce(t.file_id, i.file_id) as file_id, t.title, i.isbn from (select file_id, max(doc_title) as title from documents where file_id is not null group by 1) t full join isbns i using (file_id))
 select coalesce(a.file_id, b.file_id) as file_id, coalesce(nullif(a.title, ''), b.title) as title, coalesce(nullif(a.isbn, ''), b.isbn) as isbn from a full join b using (file_id)""")
def toc_t20_metadata_merge(spark, d):
    base = src.table(spark, d, "source_files").groupBy("file_id").agg(F.max("title").alias("title"), F.max("isbn").alias("isbn"))
    titles = src.table(spark, d, "documents").filter("file_id is not null").groupBy("file_id").agg(F.max("doc_title").alias("title"))
    return toc.fill_empty(base, titles.join(toc.scanned_isbn(deck.segments(spark, d, "pos", "page", "text")), "file_id", "full"), ["title", "isbn"])


# continuation ----------------------------------------------------------------------------------------------------------


@query(f"""with {SEG}, n as (select file_id, segment_id, pos, type, row_number() over (partition by file_id order by pos) as n from seg),
 p as (select *, last_value(case when coalesce(type <> 'Header', true) then n end ignore nulls) over (partition by file_id order by pos rows between unbounded preceding and 1 preceding) as pn from n)
 select p.file_id, p.segment_id, q.segment_id as prev_segment_id, (p.n - 1 - p.pn)::int as skipped from p left join n q on q.file_id = p.file_id and q.n = p.pn""")
def cont_c2_previous_content(spark, d):
    s = deck.segments(spark, d, "pos", "type", "text", "page", "column_index", "heading_path", "at_page_bottom")
    return continuation.with_previous(s).select("file_id", "segment_id", F.col("prev.segment_id").alias("prev_segment_id"), "skipped")


_W = lx.CONTINUATION_WEIGHTS
_PREV = f"""n as (select *, row_number() over (partition by file_id order by pos) as n, coalesce(text, '') as t from seg),
 pn as (select *, last_value(case when coalesce(type <> 'Header', true) then n end ignore nulls) over (partition by file_id order by pos rows between unbounded preceding and 1 preceding) as pn from n),
 j as (select c.file_id, c.segment_id, c.type as ct, p.type as pt, c.t as b, p.t as a, c.page as cp, p.page as pp, c.column_index as cc, p.column_index as pc, c.heading_path as ch, p.heading_path as ph, c.at_page_top as ctop, p.at_page_bottom as pbot, p.n is not null as has_prev
   from pn c left join n p on p.file_id = c.file_id and p.n = c.pn)"""
_SCORE = f"""0.0::double + (case when pbot and ctop then {_W['position']} else 0 end)::double + (case when coalesce(pc, 0) < 0 or coalesce(cc, 0) < 0 or coalesce(pc, 0) = coalesce(cc, 0) then {_W['column']} else 0 end)::double
 + (case when {s_hyphen('a')} then {_W['hyphen']} else 0 end)::double + (case when {s_open('a')} then {_W['open_clause']} else 0 end)::double + (case when {s_fragment('a')} then {_W['fragment']} else 0 end)::double
 + (case when {s_starts('b')} then {_W['start']} when {s_lower('b')} then {_W['start_lowercase']} else 0 end)::double + (case when ph is not distinct from ch then {_W['same_path']} else 0 end)::double
 + (case when pt is not distinct from ct then {_W['same_type']} else 0 end)::double + (case when a <> '' and not {s_terminal('a')} then {_W['incomplete']} else 0 end)::double
 + (case when a <> '' and not {s_terminal('a')} and {s_lower('b')} then {_W['incomplete_lowercase']} else 0 end)::double + (case when pt = 'ListItem' and ct = 'ListItem' and regexp_matches(trim(a), '[^.!?]$') then {_W['list_split']} else 0 end)::double"""
_BREAKS = ", ".join(sql(t) for t in lx.BREAK_TYPES)
_OUT = f"(coalesce(ct in ({_BREAKS}) or pt in ({_BREAKS}) or coalesce(cp, 0) <> coalesce(pp, 0) + 1, false) or not has_prev)"


_RULES = {
    "position": "pbot and ctop", "column": "coalesce(pc, 0) < 0 or coalesce(cc, 0) < 0 or coalesce(pc, 0) = coalesce(cc, 0)", "hyphen": s_hyphen("a"), "open_clause": s_open("a"), "fragment": s_fragment("a"), "start": f"{s_starts('b')} or {s_lower('b')}",
    "same_path": "ph is not distinct from ch", "same_type": "pt is not distinct from ct", "incomplete": f"a <> '' and not {s_terminal('a')}", "incomplete_lowercase": f"a <> '' and not {s_terminal('a')} and {s_lower('b')}", "list_split": "pt = 'ListItem' and ct = 'ListItem' and regexp_matches(trim(a), '[^.!?]$')",
}
_RULE_LIST = "list_filter([" + ", ".join(f"case when {c} then '{k}' end" for k, c in _RULES.items()) + "], lambda x: x is not null)"


@query(f"with {SEG}, {_PREV}, sc as (select *, case when {_OUT} then 0.0 else {_SCORE} end as score from j) select file_id, segment_id, round(score, 6) as score, case when score >= 0.7 - 1e-9 then 'full' when score >= 0.4 - 1e-9 then 'partial' else 'none' end as is_continuation from sc")
def cont_c5_c7_score(spark, d):
    s = deck.segments(spark, d, "pos", "type", "text", "page", "column_index", "heading_path", "at_page_bottom", "at_page_top")
    return continuation.annotate(s).select("file_id", "segment_id", F.round("score", 6).alias("score"), "is_continuation")


@query(f"""with {SEG}, n as (select *, trim(coalesce(text, '')) as b, lag(type) over w as k, trim(coalesce(lag(text) over w, '')) as a, coalesce(lag(page) over w, 0) as pg, coalesce(lag(column_index) over w, 0) as pc, row_number() over w as i from seg window w as (partition by file_id order by pos)),
 sc as (select file_id, segment_id, i, (case when a <> '' and not regexp_matches(a, '[.!?:]$') then 0.4::double else 0 end + case when {s_lower('b')} then 0.3::double else 0 end + case when regexp_matches(a, '[-‐-—]$') then 0.3::double else 0 end
  + case when k = 'Formula' then 0.5::double else 0 end + case when abs(pg - coalesce(page, 0)) <= 1 then 0.1::double else 0 end + case when (pg = coalesce(page, 0)) <> (pc = coalesce(column_index, 0)) then 0.1::double else 0 end) * 0.6::double + 0.5::double * 0.4::double as score from n)
 select file_id, segment_id, case when i > 1 then round(score, 6) end as score, case when i > 1 then case when score >= 0.7 - 1e-9 then 'full' when score >= 0.45 - 1e-9 then 'partial' else 'none' end end as is_continuation from sc""")
def cont_c8_adjacent_score(spark, d):
    s = deck.segments(spark, d, "pos", "type", "text", "page", "column_index")
    return continuation.annotate_adjacent(s).select("file_id", "segment_id", F.round("score", 6).alias("score"), "is_continuation")


@query(f"""with {SEG}, {_PREV}, sc as (select *, case when {_OUT} then 0.0 else {_SCORE} end as score, {_RULE_LIST} as rules from j), on_ as (select * from sc where score >= 0.4 - 1e-9), e as (select file_id, unnest(rules) as rule from on_), c as (select file_id, rule, count(*) as n from e group by 1, 2),
 t as (select file_id, string_agg(rule, ',' order by n desc, rule) as top_rules from (select *, row_number() over (partition by file_id order by n desc, rule) as k from c) where k <= 5 group by 1)
 select file_id, count(*) as continuations, round(avg(score), 3) as avg_score, any_value(top_rules) as top_rules from on_ join t using (file_id) group by 1""")
def cont_c10_evidence(spark, d):
    s = deck.segments(spark, d, "pos", "type", "text", "page", "column_index", "heading_path", "at_page_bottom", "at_page_top")
    return continuation.evidence_summary(continuation.annotate(s))


@query(f"""with w as (select distinct unnest(regexp_extract_all(text, '\\p{{L}}+')) as word from documents)
 select word, (regexp_matches(regexp_replace(word, '-', '', 'g'), '^\\p{{L}}+$') and not regexp_matches(word, '(?i)[^aeiou]{{6,}}') and not regexp_matches(word, '(?i)[aeiou]{{5,}}')) as plausible from w""")
def cont_d2_plausible_words(spark, d):
    w = src.table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), 0)).alias("word")).distinct()
    return w.select("word", tx.plausible_word(F.col("word")).alias("plausible"))


def _neighbours(spark, d):
    w = Window.partitionBy("file_id").orderBy("pos")
    s = deck.segments(spark, d, "pos", "text").withColumn("before", F.lag("text").over(w))
    return s.filter(F.col("before").rlike(r"[-‐‑–—]\s*$") & F.col("text").isNotNull())


_SPLIT = f"""nb as (select *, lag(text) over (partition by file_id order by pos) as a from seg), x as (select file_id, segment_id, a, text as b, regexp_extract(a, '(\\S*)[-‐‑–—]\\s*$', 1) || regexp_replace({s_first('text')}, '[.,;:!?]+$', '') as word, {s_first('text')} as first,
   array_to_string(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')[2:], ' ') as rest, list_filter(string_split_regex(regexp_replace(a, '[-‐‑–—]\\s*$', ''), '\\s+'), lambda w: w <> '') as ws from nb where regexp_matches(a, '[-‐‑–—]\\s*$') and text is not null),
 y as (select *, array_to_string(ws[:greatest(len(ws) - 1, 0)], ' ') as before, regexp_matches(a, '[\\p{{L}}\\p{{N}}][-‐‑–—]\\s*$') and regexp_matches(first, '^\\p{{L}}') and length(word) >= 3 and regexp_matches(replace(word, '-', ''), '^\\p{{L}}+$') and not regexp_matches(replace(word, '-', ''), '(?i)[^aeiou]{{6,}}') and not regexp_matches(replace(word, '-', ''), '(?i)[aeiou]{{5,}}') as ok from x)"""


@query(f"""with {SEG}, {_SPLIT} select file_id, segment_id, case when ok then before || case when before <> '' then ' ' else '' end || word || case when rest = '' then regexp_extract(first, '^[a-zA-Z]+([.,;:!?]+)', 1) else '' end else a end as "left", case when ok then rest else b end as "right" from y""")
def cont_d1_merge_hyphenated(spark, d):
    return _neighbours(spark, d).withColumn("m", continuation.merge_hyphenated(F.col("before"), F.col("text"))).select("file_id", "segment_id", "m.left", "m.right")


@query(f"""with {SEG}, n as (select *, lag(text) over (partition by file_id order by pos) as a from seg), x as (select file_id, segment_id, a, text as b, regexp_extract(a, '([\\p{{L}}\\p{{N}}_]+)[-‐‑−–—]\\s*$', 1) as one, regexp_extract(regexp_replace(text, '^ +', ''), '^([\\p{{L}}\\p{{N}}_]+)', 1) as two from n where regexp_matches(a, '[-‐‑–—]\\s*$') and text is not null)
 select file_id, segment_id, case when regexp_matches(rtrim(a), '[-‐‑‒–—]$') and one <> '' and two <> '' and length(one || two) >= 3 then regexp_replace(a, '[\\p{{L}}\\p{{N}}_]+[-‐‑−–—]\\s*$', '') || one || two else a end as "left",
  case when regexp_matches(rtrim(a), '[-‐‑‒–—]$') and one <> '' and two <> '' and length(one || two) >= 3 then regexp_replace(regexp_replace(regexp_replace(b, '^ +', ''), '^[\\p{{L}}\\p{{N}}_]+', ''), '^ +', '') else b end as "right" from x""")
def cont_d3_join_at_word(spark, d):
    return _neighbours(spark, d).withColumn("m", continuation.join_at_word(F.col("before"), F.col("text"))).select("file_id", "segment_id", "m.left", "m.right")


# captions and references -----------------------------------------------------------------------------------------------

_CAPS = " ".join(f"when regexp_extract(t, {sql('(?i)' + p)}, 1) <> '' and not regexp_matches(substring(lower(trim(regexp_replace(t, {sql('(?i)' + p)}, ''))), 1, 100), {sql(re2(chr(92) + 'b(?:' + '|'.join(lx.CAPTION_VERBS) + ')' + chr(92) + 'b'))}) then regexp_extract(t, {sql('(?i)' + p)}, 1)" for p in lx.CAPTION_PATTERNS)


@query(f"""with {SEG}, x as (select file_id, segment_id, trim(text) as t from seg where text is not null), c as (select *, case {_CAPS} end as caption_id from x where {s_words('t')} <= 40)
 select file_id, segment_id, caption_id, case when regexp_matches(lower(t), '^(?:table|tbl)') then 'Table' when regexp_matches(lower(t), '^(?:figure|fig|chart|graph|diagram)') then 'Figure' when starts_with(lower(t), 'exhibit') then 'Exhibit' when regexp_matches(lower(t), '^(?:equation|eq|formula)') then 'Equation' else 'Figure' end as target_type from c where caption_id is not null""")
def ref_b1_captions(spark, d):
    s = deck.segments(spark, d, "text").filter("text is not null").withColumn("c", tx.caption(F.col("text")))
    return s.filter("c is not null").select("file_id", "segment_id", "c.caption_id", "c.target_type")


@query(f"""with {SEG}, n as (select *, lead(bbox) over (partition by file_id order by pos) as b from seg), g as (select file_id, segment_id, bbox as a, b,
  case when bbox[4] <= b[2] then b[2] - bbox[4] when b[4] <= bbox[2] then bbox[2] - b[4] else 0.0 end as gap, case when greatest(list_max(bbox), list_max(b)) > 1.0 then 792.0 else 1.0 end as sc, greatest(0.0, least(bbox[3], b[3]) - greatest(bbox[1], b[1])) as sh, least(bbox[3] - bbox[1], b[3] - b[1]) as nr from n)
 select file_id, segment_id, case when a is null or b is null or len(a) < 4 or len(b) < 4 then true else gap / sc <= 0.25 and sh > 0 and (case when nr > 0 then sh / nr else 0.0 end) >= 0.3 end as near from g""")
def ref_b5_near_blocks(spark, d):
    w = Window.partitionBy("file_id").orderBy("pos")
    s = deck.segments(spark, d, "pos", "bbox").withColumn("b", F.lead("bbox").over(w))
    return s.select("file_id", "segment_id", tx.near_block(F.col("bbox"), F.col("b"), 792.0, 0.25, 0.3).alias("near"))


_BID = "case when type in ('Header', 'Title', 'Paragraph', 'Text') then coalesce(" + ", ".join(f"case when regexp_extract(t, {sql('(?i)' + p)}, 1) <> '' then '{'Figure' if k == 'Picture' else k} ' || regexp_extract(t, {sql('(?i)' + p)}, 1) end" for k, p in lx.CATALOG_PATTERNS) + ") " + " ".join(f"when type = '{k}' and regexp_extract(t, {sql('(?i)' + p)}, 1) <> '' then '{'Figure' if k == 'Picture' else k} ' || regexp_extract(t, {sql('(?i)' + p)}, 1)" for k, p in lx.CATALOG_PATTERNS) + " end"


@query(f"""with {SEG}, x as (select *, trim(coalesce(text, '')) as t from seg where type in ({', '.join(sql(t) for t in lx.CATALOG_TYPES)})), c as (select *, {_BID} as caption_id from x)
 select file_id, caption_id, arg_max(segment_id, pos) as segment_id, arg_max(type, pos) as type from c where caption_id is not null group by 1, 2""")
def ref_r1_block_catalog(spark, d):
    return references.block_catalog(deck.segments(spark, d, "pos", "type", "text", "page")).select("file_id", "caption_id", "segment_id", "type")


_chunks = deck.chunks


_BLOCKS = f"""x as (select *, trim(coalesce(text, '')) as t from seg where type in ({', '.join(sql(t) for t in lx.CATALOG_TYPES)})), cid as (select *, {_BID} as caption_id from x), cat as (select file_id, caption_id, arg_max(segment_id, pos) as sid from cid where caption_id is not null group by 1, 2),
 blk as (select file_id, coalesce(page, 0) as page, case when type in ('Figure', 'Picture') then 'Figure' when type = 'Table' then 'Table' when type in ('Formula', 'Equation') then 'Equation' end as kind, arg_min(segment_id, pos) as a, arg_max(segment_id, pos) as z from seg where type in ('Figure', 'Picture', 'Table', 'Formula', 'Equation') group by all)"""


def _mention_sql(kind: str, direction: str, pattern: str) -> str:
    lead = "(?:^|[^\\p{L}\\p{N}_])"
    whole = sql(f"(?i){lead}({re2(pattern[2:])})")
    number = f"regexp_extract_all(content, {whole}, 2)" if kind == "explicit" else "[]"
    target = sql(direction) if kind == "explicit" else "null"
    return f"select chunk_id, file_id, page, '{kind}' as ref_kind, {sql('' if kind == 'explicit' else direction)} as direction, {target} as tt, string_split_regex(content, {whole}) as parts, regexp_extract_all(content, {whole}, 0) as full_, regexp_extract_all(content, {whole}, 1) as refs, {number}::varchar[] as ids from c"


_MENTIONS = f"""c as (select chunk_id, file_id, coalesce(page_range[1], 0) as page, content from chk where content is not null), raw as ({' union all '.join([_mention_sql('explicit', k, p) for k, p in lx.EXPLICIT_REFERENCES] + [_mention_sql('implicit', k, p) for k, p in lx.IMPLICIT_REFERENCES])}),
 one as (select *, unnest(range(1, len(refs) + 1)) as i from raw), men as (select chunk_id, file_id, page, ref_kind, direction, refs[i] as ref_text, trim(coalesce(ids[i], '')) as ref_id,
   (list_sum(list_transform(parts[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(full_[1:i - 1], lambda p: length(p))), 0) + length(full_[i]) - length(refs[i]))::int as start_offset,
   coalesce(tt, case when regexp_matches(lower(refs[i]), 'figure|chart|graph|diagram') then 'Figure' when contains(lower(refs[i]), 'table') then 'Table' when regexp_matches(lower(refs[i]), 'equation|formula') then 'Equation' else 'Figure' end) as target_type from one),
 res as (select m.*, start_offset + length(ref_text) as end_offset, case when ref_kind = 'explicit' then cat.sid when direction = 'below' then blk.z else blk.a end as target_segment_id from men m left join cat on m.ref_kind = 'explicit' and cat.file_id = m.file_id and cat.caption_id = m.target_type || ' ' || m.ref_id left join blk on m.ref_kind = 'implicit' and blk.file_id = m.file_id and blk.page = m.page and blk.kind = m.target_type)"""


@query(f"""with {SEG}, {CHK}, {_BLOCKS}, {_MENTIONS} select chunk_id, ref_kind, direction, target_type, ref_text, start_offset, end_offset::int as end_offset, target_segment_id, case when ref_kind = 'explicit' then case when target_segment_id is not null then 0.95 else 0.5 end else case when target_segment_id is not null then 0.7 else 0.3 end end::double as confidence from res""")
def ref_r3_r4_references(spark, d):
    s = deck.segments(spark, d, "pos", "type", "text", "page")
    c = _chunks(spark, d, "file_id", "content", "page_range").withColumn("page", F.coalesce(F.try_element_at("page_range", F.lit(1)), F.lit(0)))
    found = references.mentions(c, "chunk_id", "content", ["file_id", "page"])
    rows = references.resolve(found, references.block_catalog(s), references.page_blocks(s))
    return rows.select("chunk_id", "ref_kind", "direction", "target_type", "ref_text", "start_offset", "end_offset", "target_segment_id", "confidence")


@query(f"with {CHK} select chunk_id, unnest(regexp_extract_all(content, '(?i)(?:Figure|Table|Equation)\\s+[0-9]+[\\.0-9]*')) as ref_text from chk where content is not null")
def ref_r5_plain_references(spark, d):
    return references.plain_mentions(_chunks(spark, d, "content"), "chunk_id", "content")


@query(f"""with {SEG}, x as (select file_id, segment_id, type, trim(coalesce(text, '')) as t from seg), c as (select *, case when {s_words('t')} <= 40 then case {_CAPS} end end as caption_id from x)
 select file_id, segment_id from c where t <> '' and caption_id is null and ({s_match('t', lx.STRUCTURAL_HEADERS)} or type = 'Header')""")
def ref_b2_structural_headers(spark, d):
    return deck.segments(spark, d, "text", "type").filter(tx.is_structural_header(F.col("text"), F.col("type"))).select("file_id", "segment_id")


@query(f"""with {SEG}, c as (select *, {s_words('t')} <= 40 and case {_CAPS} end is not null as cap from (select *, trim(coalesce(text, '')) as t from seg)), n as (select *, row_number() over (partition by file_id order by pos) as n from c),
 j as (select b.file_id, b.segment_id, arg_min(k.segment_id, case when k.n < b.n then b.n - k.n else 3 + k.n - b.n end) as caption_segment_id from n b join n k on k.file_id = b.file_id and k.page = b.page and k.n between b.n - 3 and b.n + 3 and k.n <> b.n and k.cap where b.type in ('Table', 'Picture', 'Formula') group by 1, 2) select * from j""")
def ref_b3_nearby_captions(spark, d):
    return references.nearby_captions(deck.segments(spark, d, "pos", "type", "page", "text")).select("file_id", "segment_id", "caption_segment_id")


# tags, sentences, roles ------------------------------------------------------------------------------------------------


@query(f"with {CHK} select chunk_id, {s_tags('content', lx.TAGS, 'im')} as tags from chk where content is not null")
def tag_g1_tags(spark, d):
    return _chunks(spark, d, "content").filter("content is not null").select("chunk_id", F.array_join(tx.tags(F.col("content")), ",").alias("tags"))


@query(f"with {CHK} select chunk_id, {s_tags('content', lx.TAGS_EMBEDDING, 'i')} as tags from chk where content is not null")
def tag_g1_tags_embedding(spark, d):
    return _chunks(spark, d, "content").filter("content is not null").select("chunk_id", F.array_join(tx.tags(F.col("content"), lx.TAGS_EMBEDDING, lines=False), ",").alias("tags"))


@query(f"with {CHK} select chunk_id, {s_tags('content', lx.TAGS_LEGACY, 'im')} as tags from chk where content is not null")
def tag_g1_tags_legacy(spark, d):
    return _chunks(spark, d, "content").filter("content is not null").select("chunk_id", F.array_join(tx.tags(F.col("content"), lx.TAGS_LEGACY), ",").alias("tags"))


@query(f"with {CHK} select chunk_id, {s_tags('content', lx.TAGS_LEGACY_EMBEDDING, 'im')} as tags from chk where content is not null")
def tag_g1_tags_legacy_embedding(spark, d):
    return _chunks(spark, d, "content").filter("content is not null").select("chunk_id", F.array_join(tx.tags(F.col("content"), lx.TAGS_LEGACY_EMBEDDING), ",").alias("tags"))


_SENT = f"s as (select chunk_id, heading_path, chunk_type, i - 1 as sentence_no, s[i] as sentence from (select *, unnest(range(1, len(s) + 1)) as i from (select chunk_id, heading_path, chunk_type, {s_sentences('content')} as s from chk where content is not null)))"


def _sentences(spark, d):
    c = _chunks(spark, d, "heading_path", "chunk_type", "content").filter("content is not null")
    return c.select("chunk_id", "heading_path", "chunk_type", F.posexplode(tx.sentences(F.col("content"))).alias("sentence_no", "sentence"))


@query(f"with {CHK}, {_SENT} select chunk_id, sentence_no::int as sentence_no, sentence from s")
def tag_g3_sentences(spark, d):
    return _sentences(spark, d).select("chunk_id", "sentence_no", "sentence")


_IMP = f"coalesce(lower(regexp_replace({s_first('sentence')}, '[.,;:]+$', '')) in ({', '.join(sql(v) for v in lx.IMPERATIVE_VERBS)}), false)"
_FORM = f"case when ends_with(trim(sentence), '?') then 'interrogative' when {_IMP} then 'imperative' when regexp_matches(sentence, '[=+\\-*/^]{{2,}}') or regexp_matches(sentence, '[\\p{{L}}\\p{{N}}_]+\\s*=\\s*[\\p{{L}}\\p{{N}}_]+') then 'formula' when length(trim(sentence)) < 10 then 'fragment' else 'declarative' end"


@query(f"with {CHK}, {_SENT} select chunk_id, sentence_no::int as sentence_no, {_IMP} as imperative, {_FORM} as form from s")
def tag_g2_g4_form(spark, d):
    imp = tx.is_imperative(F.col("sentence"))
    return _sentences(spark, d).select("chunk_id", "sentence_no", imp.alias("imperative"), tx.sentence_form(F.col("sentence"), imp).alias("form"))


_HINT = "coalesce(" + ", ".join(f"case when contains(lower(heading_path), {sql(k)}) then {sql(r)} end" for k, r in lx.HEADING_ROLES.items()) + ")"


@query(f"with {CHK} select chunk_id, {_HINT} as hint from chk")
def tag_g6_heading_hint(spark, d):
    return _chunks(spark, d, "heading_path").select("chunk_id", tx.heading_hint(F.col("heading_path")).alias("hint"))


def _has(tag: str) -> str:
    return s_match("sentence", lx.TAGS[tag], "im")


_ALLOW = {
    "mechanism": f"not regexp_matches(coalesce(heading_path, ''), '(?i)front\\s*matter') and not regexp_matches(lower(sentence), {sql(re2(chr(92) + 'b(?:chapter|author|text|preface|acknowledgment)' + chr(92) + 'b'))}) and chunk_type in ('explanation', 'example', 'paragraph')",
    "assumption": f"(regexp_matches(sentence, {sql(re2('^' + chr(92) + 's*(?:Suppose|Assume|Imagine)' + chr(92) + 'b'))}) or chunk_type in ('exercise', 'question', 'example') or regexp_matches(coalesce(heading_path, ''), '(?i)exercise|problem|case') or {s_words('sentence')} <= 40)",
    "procedure": f"({_IMP} or regexp_matches(lower(sentence), {sql(re2('^(?:first|second|next|then|finally)' + chr(92) + 'b'))}))",
}
_ROLE = (
    f"case when {s_match('sentence', ['^(?:For example|For instance|e' + chr(92) + '.g' + chr(92) + '.|eg' + chr(92) + '.?)' + chr(92) + 'b'])} then 'example' when {s_match('sentence', ['^(?:In summary|Therefore|Thus|To summarize|Consequently)' + chr(92) + 'b'])} then 'conclusion' "
    f"when {_FORM} = 'interrogative' then 'question' when {_has('reference')} then 'reference' when (length(trim(sentence)) < 15 and not {s_match('sentence', lx.SHORT_EXCEPTIONS)}) or {s_match('lower(sentence)', lx.BOILERPLATE)} then 'irrelevant' "
    + " ".join(f"when {_has(r)}{' and ' + _ALLOW[r] if r in _ALLOW else ''} then '{r}'" for r in lx.ROLE_PRIORITY if r in lx.TAGS)
    + f" else coalesce({_HINT}, 'explanation') end"
)


@query(f"with {CHK}, {_SENT} select chunk_id, sentence_no::int as sentence_no, {_ROLE} as role from s")
def tag_g7_roles(spark, d):
    s, imp = F.col("sentence"), tx.is_imperative(F.col("sentence"))
    rows = _sentences(spark, d).withColumn("tags", tx.tags(s))
    return rows.select("chunk_id", "sentence_no", tx.role(s, F.col("heading_path"), F.col("tags"), tx.sentence_form(s, imp), imp, F.col("chunk_type")).alias("role"))


_KEYROLE = "case when contains(sentence, '?') then 'question' when contains(lower(sentence), 'for example') or contains(lower(sentence), 'e.g.') or regexp_matches(lower(sentence), '^example\\s+[0-9]+') then 'example' " + " ".join(f"when regexp_matches(lower(sentence), '{'|'.join(k)}') then '{r}'" for r, k in lx.EMBEDDING_ROLES) + " when regexp_matches(lower(sentence), '%|table|figure|exhibit') and length(sentence) > 20 then 'evidence' else 'explanation' end"


def _had(tag: str) -> str:
    return s_match("sentence", lx.TAGS_LEGACY[tag], "im")


_ALLOW_LEGACY = {"mechanism": f"not regexp_matches(coalesce(heading_path, ''), '(?i)front\\s*matter') and not {s_match('sentence', [chr(92) + 'bNote:', chr(92) + 'bMcGraw' + chr(92) + 's*Hill' + chr(92) + 'b'], 's')} and chunk_type in ('explanation', 'example', 'paragraph')", "procedure": _ALLOW["procedure"]}
_ROLE_LEGACY = (
    f"case when {_FORM} = 'interrogative' then 'question' when {_had('reference')} then 'reference' when (length(trim(sentence)) < 15 and not {s_match('sentence', lx.SHORT_EXCEPTIONS)}) or {s_match('lower(sentence)', lx.BOILERPLATE)} then 'irrelevant' "
    + " ".join(f"when {_had(r)}{' and ' + _ALLOW_LEGACY[r] if r in _ALLOW_LEGACY else ''} then '{r}'" for r in lx.ROLE_PRIORITY if r in lx.TAGS)
    + f" else coalesce({_HINT}, 'explanation') end"
)


@query(f"with {CHK}, {_SENT} select chunk_id, sentence_no::int as sentence_no, {_ROLE_LEGACY} as role from s")
def tag_g7_roles_legacy(spark, d):
    s, imp = F.col("sentence"), tx.is_imperative(F.col("sentence"))
    rows = _sentences(spark, d).withColumn("tags", tx.tags(s, lx.TAGS_LEGACY))
    return rows.select("chunk_id", "sentence_no", tx.role_legacy(s, F.col("heading_path"), F.col("tags"), tx.sentence_form(s, imp), imp, F.col("chunk_type")).alias("role"))


def _stage_sql() -> str:
    low = "lower(sentence)"
    m = lambda t, ps: s_match(t, ps, "s")
    hit = {r: " or ".join([m(low, a)] * bool(a) + [m("sentence", b)] * bool(b)) or "false" for r, a, b in lx.ROLE_STAGES}
    hit["evidence"] = s_match("sentence", lx.EVIDENCE)
    hit["conclusion"] += f" or (last and {m(low, [chr(92) + 'b(overall|ultimately|finally)' + chr(92) + 'b'])})"
    hit["procedure"] += f" or ({_IMP} and {s_words('sentence')} >= 8 and {m(low, [chr(92) + 'b(calculate|compute|determine|solve|find|use|apply|enter|click|select)' + chr(92) + 'b'])})"
    cases = f"when regexp_matches(sentence, {sql('|'.join(f'(?:{p})' for p in lx.STAGE_REFERENCES))}) then 'reference' when length(trim(sentence)) < 10 and not {s_match('sentence', lx.SHORT_EXCEPTIONS)} then 'irrelevant' "
    for r, _, _ in lx.ROLE_STAGES:
        cases += f"when ({hit['evidence']}) then case when ({hit['formula']}) then 'formula' else 'evidence' end " if r == "evidence" else f"when ({hit[r]}) then '{r}' "
    barred = " or ".join(f"(stage = '{r}' and {m(low, p)})" for r, p in lx.NOT_IN_CONTEXT.items())
    return f"""w as (select *, lead(sentence_no) over (partition by chunk_id order by sentence_no) is null as last from s), st as (select *, case {cases} else 'explanation' end as stage from w),
 fl as (select *, case when {barred} then 'explanation' else stage end as kept from st), fi as (select *, case when ends_with(trim(sentence), '?') then 'question' when {m(low, lx.STAGE_BOILERPLATE)} then 'irrelevant' else kept end as final from fl),
 ro as (select *, case when final = 'explanation' then coalesce({_HINT}, final) else final end as r from fi)"""


@query(f"""with {CHK}, {_SENT}, {_stage_sql()} select chunk_id, sentence_no::int as sentence_no, case when r = 'explanation' and {_IMP} and {s_words('sentence')} >= 10 and lag(r) over (partition by chunk_id order by sentence_no) = 'example' then 'procedure' else r end as role from ro""")
def tag_g7_roles_by_stages(spark, d):
    s, imp = F.col("sentence"), tx.is_imperative(F.col("sentence"))
    w = Window.partitionBy("chunk_id").orderBy("sentence_no")
    rows = _sentences(spark, d).withColumn("last", F.lead("sentence_no").over(w).isNull())
    rows = rows.withColumn("role", tx.role_by_stages(s, F.col("heading_path"), imp, F.col("last")))
    after = (F.col("role") == "explanation") & (F.lag("role").over(w) == "example") & imp & (tx.word_count(s) >= 10)
    return rows.select("chunk_id", "sentence_no", F.when(F.coalesce(after, F.lit(False)), "procedure").otherwise(F.col("role")).alias("role"))


@query(f"""with {CHK}, {_SENT}, r as (select *, {_ROLE} as role, {_has('reference')} as about from s where ends_with(sentence, '?')) select chunk_id, sentence_no::int as sentence_no, regexp_extract(sentence, '(?i)((?:figure|fig\\.?|table|exhibit|equation|eq\\.?)\\s+[0-9.]+)', 1) as target from r where role = 'question' and about""")
def tag_g10_question_targets(spark, d):
    s, imp = F.col("sentence"), tx.is_imperative(F.col("sentence"))
    rows = _sentences(spark, d).filter(F.col("sentence").endswith("?")).withColumn("tags", tx.tags(s))
    rows = rows.withColumn("role", tx.role(s, F.col("heading_path"), F.col("tags"), tx.sentence_form(s, imp), imp, F.col("chunk_type")))
    return rows.withColumn("target", tx.question_target(s, F.col("role"), F.col("tags"))).filter("target is not null").select("chunk_id", "sentence_no", "target")


@query(f"with {CHK}, {_SENT} select chunk_id, sentence_no::int as sentence_no, {_KEYROLE} as role from s")
def tag_g7_roles_embedding(spark, d):
    return _sentences(spark, d).select("chunk_id", "sentence_no", tx.role_by_keywords(F.col("sentence")).alias("role"))


@query(f"""with {CHK}, {_SENT}, r as (select *, {_KEYROLE} as role from s), l as (select *, lag(role) over (partition by chunk_id order by sentence_no) as before from r),
 g as (select *, sum(case when before is not null and role = 'explanation' and {s_words('sentence')} < 5 and before <> 'irrelevant' then 0 else 1 end) over (partition by chunk_id order by sentence_no) as g from l)
 select chunk_id, min(sentence_no)::int as sentence_no, string_agg(sentence, ' ' order by sentence_no) as sentence, arg_min(role, sentence_no) as role from g group by chunk_id, g""")
def tag_g11_fragments(spark, d):
    return graph.merge_fragments(graph.sentence_roles(_chunks(spark, d, "content"), "chunk_id"), "chunk_id")


@query(f"""with {SEG} select file_id, segment_id from seg where text is not null and length(trim(text)) >= 5 and ({s_match('lower(trim(text))', lx.OBJECTIVE_PATTERNS)} or
 (list_filter(string_split_regex(lower(trim(text)), '\\s+'), lambda w: w <> '')[1] in ({', '.join(sql(v) for v in lx.OBJECTIVE_VERBS)}) and {s_words('lower(trim(text))')} > 3))""")
def tag_g12_objectives(spark, d):
    return deck.segments(spark, d, "text").filter(tx.is_objective(F.col("text"))).select("file_id", "segment_id")


@query(f"with {CHK} select chunk_id, case when len({s_sentences('content')}) <= 2 then content else array_to_string({s_sentences('content')}[-2:], ' ') end as tail from chk where content is not null")
def tag_g13_last_sentences(spark, d):
    return _chunks(spark, d, "content").filter("content is not null").select("chunk_id", tx.last_sentences(F.col("content"), 2).alias("tail"))


# vectors ---------------------------------------------------------------------------------------------------------------


@query("with v as (select vec_id, embedding::double[] as e, vec_id // 25 as doc from embeddings) select vec_id, round(list_cosine_similarity(lag(e) over (partition by doc order by vec_id), e), 6) as similarity from v qualify similarity is not null")
def vec_e2_adjacent_cosine(spark, d):
    v = src.table(spark, d, "embeddings").withColumn("doc", F.expr("vec_id div 25"))
    rows = v.withColumn("similarity", F.round(vectors.cosine(F.lag("embedding").over(Window.partitionBy("doc").orderBy("vec_id")), F.col("embedding")), 6))
    return rows.filter("similarity is not null").select("vec_id", "similarity")


@query("""with v as (select vec_id, embedding::double[] as e, vec_id // 25 as doc from embeddings), s as (select *, list_cosine_similarity(lag(e) over (partition by doc order by vec_id), e) as sim from v qualify sim is not null),
 a as (select *, coalesce(avg(sim) over (partition by doc order by vec_id rows between 3 preceding and 1 preceding), sim) as av from s) select vec_id, round(sim, 6) as similarity, round(av, 6) as avg_similarity from a where sim < 0.5 and (case when av > 0 then sim / av else 1.0 end) < 0.7""")
def vec_e3_breakpoints(spark, d):
    v = src.table(spark, d, "embeddings").withColumn("doc", F.expr("vec_id div 25"))
    return vectors.breakpoints(v, "doc", "vec_id", "embedding").select("vec_id", F.round("similarity", 6).alias("similarity"), F.round("avg_similarity", 6).alias("avg_similarity"))


@query("""with v as (select vec_id, label, embedding::double[] as e from embeddings), p as (select label::varchar as role, e from v qualify row_number() over (partition by label order by vec_id) <= 3),
 s as (select vec_id, role, max(list_cosine_similarity(v.e, p.e)) as s from v cross join p group by all), b as (select vec_id, max(s) as s, min(role) filter (s = m) as role from (select *, max(s) over (partition by vec_id) as m from s) group by 1)
 select vec_id, case when s >= 0.25 then role end as role, round(s, 3) as score from b""")
def vec_e4_prototypes(spark, d):
    v = src.table(spark, d, "embeddings")
    first = F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))
    protos = v.withColumn("n", first).filter("n <= 3").select(F.col("label").cast("string").alias("role"), F.col("embedding").alias("proto"))
    return vectors.refine_by_prototypes(v, "vec_id", "embedding", protos, threshold=0.25)


@query("""with v as (select vec_id, embedding::double[] as e, label from embeddings) select a.label, any_value(n) as n, round(avg(list_cosine_similarity(a.e, b.e)), 6) as coherence from v a join v b on a.label = b.label and a.vec_id < b.vec_id
 join (select label, count(*) as n from v group by 1) c on c.label = a.label group by a.label""")
def vec_e5_coherence(spark, d):
    return vectors.coherence(src.table(spark, d, "embeddings"), "label", "embedding").select("label", "n", F.round("coherence", 6).alias("coherence"))


# chunks ----------------------------------------------------------------------------------------------------------------

_SEGMENT = ("pos", "type", "text", "page", "bbox", "depth", "level", "column_index", "at_page_top", "at_page_bottom", "heading_path")


@query(None)
def chunk_k1_fold(spark, d):
    rows = continuation.annotate(deck.segments(spark, d, *_SEGMENT)).drop("prev", "skipped", "rules")
    return chunking.place(chunking.fold_columns(rows))


@query(f"""with {SEG}, b as (select file_id, segment_id, pos, row_number() over w as i, case when row_number() over w > 1 then case when heading_path is distinct from lag(heading_path) over w then 'heading_change'
   when type in ('Table', 'Picture', 'Formula') then 'structure_' || lower(type) || '_start' when lag(type) over w in ('Table', 'Picture', 'Formula') then 'structure_' || lower(lag(type) over w) || '_end' end end as r from seg window w as (partition by file_id order by pos)),
 g as (select *, sum((r is not null)::int) over (partition by file_id order by pos) as island from b), c as (select *, (row_number() over (partition by file_id, island order by pos) - 1) // 5 as part, row_number() over (partition by file_id, island order by pos) as k from g),
 x as (select *, coalesce(r, case when k > 1 and (k - 1) % 5 = 0 then 'max_buffer' end) as split from c)
 select file_id, segment_id, (sum((split is not null)::int) over (partition by file_id order by pos) + 1)::bigint as chunk_no, coalesce(split, 'none') as split_reason from x""")
def chunk_k2_grouping(spark, d):
    rows = chunking.group_adjacent(deck.segments(spark, d, "pos", "type", "heading_path"))
    return rows.select("file_id", "segment_id", F.col("chunk_no").cast("bigint").alias("chunk_no"), "split_reason")


_ADJACENT = f"""an as (select *, trim(coalesce(text, '')) as b, lag(type) over w as k, trim(coalesce(lag(text) over w, '')) as a, coalesce(lag(page) over w, 0) as pg, coalesce(lag(column_index) over w, 0) as pc, row_number() over w as i, lag(heading_path) over w as pp from seg window w as (partition by file_id order by pos)),
 asc_ as (select *, (case when a <> '' and not regexp_matches(a, '[.!?:]$') then 0.4::double else 0 end + case when {s_lower('b')} then 0.3::double else 0 end + case when regexp_matches(a, '[-‐-—]$') then 0.3::double else 0 end
  + case when k = 'Formula' then 0.5::double else 0 end + case when abs(pg - coalesce(page, 0)) <= 1 then 0.1::double else 0 end + case when (pg = coalesce(page, 0)) <> (pc = coalesce(column_index, 0)) then 0.1::double else 0 end) * 0.6::double + 0.5::double * 0.4::double as score from an),
 fl as (select file_id, segment_id, i, i > 1 and score >= 0.45 - 1e-9 as cont, heading_path is distinct from pp as moved, type, k from asc_),
 br as (select *, case when i > 1 and not cont then case when moved then 'heading_change' when type in ('Table', 'Picture', 'Formula') then 'structure_' || lower(type) || '_start' when k in ('Table', 'Picture', 'Formula') then 'structure_' || lower(k) || '_end' end end as hard from fl)"""


@query(f"""with recursive {SEG}, {_ADJACENT}, walk as (select file_id, segment_id, i, 1 as size, 1 as chunk_no, 'none' as split_reason from br where i = 1 union all
 select b.file_id, b.segment_id, b.i, case when b.hard is not null or (not b.cont and w.size >= 5) then 1 else w.size + 1 end, case when b.hard is not null or (not b.cont and w.size >= 5) then w.chunk_no + 1 else w.chunk_no end, coalesce(b.hard, case when not b.cont and w.size >= 5 then 'max_buffer' else 'none' end)
 from walk w join br b on b.file_id = w.file_id and b.i = w.i + 1) select file_id, segment_id, chunk_no::bigint as chunk_no, split_reason from walk""")
def chunk_k2_with_continuations(spark, d):
    s = deck.segments(spark, d, "pos", "type", "text", "page", "column_index", "heading_path")
    rows = chunking.group_adjacent(continuation.annotate_adjacent(s))
    return rows.select("file_id", "segment_id", F.col("chunk_no").cast("bigint").alias("chunk_no"), "split_reason")


@query(None)
def chunk_k3_k5_assembled(spark, d):
    s = deck.segments(spark, d, *_SEGMENT)
    rows = continuation.annotate(s).drop("prev", "skipped", "rules")
    return chunking.assemble_rows(chunking.place_rows(chunking.fold_columns(rows.repartition("file_id")))).drop("bbox", "page_bboxes", "merge_evidence")


_FIRST_LINE = "string_split(coalesce(content, ''), chr(10))[1]"
_OBJECTIVE = f"(length(trim({_FIRST_LINE})) >= 5 and ({s_match(f'lower(trim({_FIRST_LINE}))', lx.OBJECTIVE_PATTERNS)} or coalesce(list_filter(string_split_regex(lower(trim({_FIRST_LINE})), '\\s+'), lambda w: w <> '')[1] in ({', '.join(sql(v) for v in lx.OBJECTIVE_VERBS)}) and {s_words(f'lower(trim({_FIRST_LINE}))')} > 3, false)))"


@query(f"""with recursive {CHK}, o as (select file_id, chunk_no, row_number() over w as n, coalesce(chunk_type = 'learning_objective', false) or coalesce({_OBJECTIVE}, false) as lead_, coalesce(chunk_type = 'list' or (chunk_type = 'explanation' and word_count < 100), false) and row_number() over w > 1 and lag(heading_path) over w is not distinct from heading_path as after_ from chk window w as (partition by file_id order by chunk_no)),
 walk as (select file_id, chunk_no, n, case when lead_ then 2 else 0 end as room, chunk_no as owner from o where n = 1 union all select o.file_id, o.chunk_no, o.n, case when o.after_ and w.room > 0 then w.room - 1 when o.lead_ then 2 else 0 end, case when o.after_ and w.room > 0 then w.owner else o.chunk_no end from walk w join o on o.file_id = w.file_id and o.n = w.n + 1)
 select file_id, chunk_no, owner as objective_no from walk where owner <> chunk_no""")
def chunk_k6_objectives(spark, d):
    c = _chunks(spark, d, "file_id", "chunk_no", "chunk_type", "content", "word_count", "heading_path").withColumn("content", F.coalesce("content", F.lit("")))
    return chunking.regroup_objectives(c).filter("objective_no <> chunk_no").select("file_id", "chunk_no", "objective_no")


@query(f"""with {CHK}, t as (select *, case when len({s_sentences("coalesce(content, '')")}) <= 2 then coalesce(content, '') else array_to_string({s_sentences("coalesce(content, '')")}[-2:], ' ') end as tail from chk),
 p as (select *, lag(case when chunk_type not in ('header', 'picture', 'table') and content <> '' then tail end) over (partition by file_id order by chunk_no) as pv from t)
 select file_id, chunk_no, case when chunk_type not in ('header', 'picture', 'table') and {s_words('pv')} > 5 then '[Previous context: ' || pv || ']' end as context_prefix from p""")
def chunk_k7_overlap(spark, d):
    c = _chunks(spark, d, "file_id", "chunk_no", "chunk_type", "content").withColumn("content", F.coalesce("content", F.lit("")))
    return chunking.context_overlap(c).select("file_id", "chunk_no", "context_prefix")


@query(f"""with {CHK}, c as (select file_id, chunk_no, chunk_type, heading_path, {s_words("coalesce(content, '')")} as wc from chk), m as (select *, row_number() over w as i, coalesce(chunk_type not in ('header', 'picture', 'table', 'list', 'formula') and wc < 50 and lead(heading_path) over w is not distinct from heading_path
   and lead(chunk_type) over w in ('explanation', 'example') and wc + lead(wc) over w < 500, false) as can from c window w as (partition by file_id order by chunk_no)),
 r as (select *, i - row_number() over (partition by file_id, can order by chunk_no) as run from m), o as (select *, can and row_number() over (partition by file_id, can, run order by chunk_no) % 2 = 1 as starts from r)
 select file_id, chunk_no, starts as starts_pair, (case when coalesce(lag(starts) over w, false) then lag(chunk_no) over w else chunk_no end)::int as merged_no from o window w as (partition by file_id order by chunk_no)""")
def chunk_k8_merge_short(spark, d):
    c = _chunks(spark, d, "file_id", "chunk_no", "chunk_type", "heading_path", "content").withColumn("word_count", tx.word_count(F.coalesce("content", F.lit(""))))
    return chunking.merge_short(c).select("file_id", "chunk_no", "starts_pair", F.col("merged_no").cast("int").alias("merged_no"))


@query(f"""with {CHK}, x as (select file_id, chunk_no, coalesce(chunk_type, '') as chunk_type, coalesce(content, '') as content, source_segments, page_range[1] as a, page_range[2] as z, trim(string_split(coalesce(content, ''), chr(10))[1]) as t, row_number() over (partition by file_id order by chunk_no) as n from chk),
 k as (select *, chunk_type in ('table', 'picture', 'formula') as block, chunk_type in ('explanation', 'header') and {s_words('t')} <= 40 and case {_CAPS} end is not null as orphan from x),
 near as (select o.file_id, o.n as cn, arg_min(b.n, case when b.n < o.n then o.n - b.n else 3 + b.n - o.n end) as bn from k o join k b on b.file_id = o.file_id and b.n between o.n - 3 and o.n + 3 and b.n <> o.n and b.block and b.a <= o.z + 1 and b.z >= o.a - 1 where o.orphan group by 1, 2),
 won as (select file_id, bn, min(cn) as cn from near group by 1, 2)
 select b.file_id, b.chunk_no, b.chunk_type, array_to_string(b.source_segments || c.source_segments, ',') as segments from won join k b on b.file_id = won.file_id and b.n = won.bn join k c on c.file_id = won.file_id and c.n = won.cn""")
def chunk_b7_bonded(spark, d):
    c = _chunks(spark, d, "file_id", "chunk_no", "chunk_type", "content", "source_segments", "page_range")
    c = c.select("file_id", "chunk_no", F.coalesce("chunk_type", F.lit("")).alias("chunk_type"), F.coalesce("content", F.lit("")).alias("content"), "source_segments", F.try_element_at("page_range", F.lit(1)).alias("first_page"), F.try_element_at("page_range", F.lit(2)).alias("last_page"), F.lit(False).alias("bonded"))
    return chunking.bond_captions(c).filter("bonded").select("file_id", "chunk_no", "chunk_type", F.array_join("source_segments", ",").alias("segments"))


@query(None)
def flagship_chunks(spark, d):
    """The canonical plan from parsed segments to enriched chunks, with all their fields."""
    out = pipeline.enriched_chunks(deck.segments(spark, d, *_SEGMENT, by_document=True), deck.toc(spark, d))
    return out.select(
        "file_id", "chunk_id", "heading_path", "chunk_type", "content", "context_prefix", "sentences", F.array_join("tags", ",").alias("tags"), F.array_join("source_segments", ",").alias("source_segments"), "page_range", "depth", "word_count",
        "is_cross_page", "continuation_type", "needs_review", F.to_json("merge_evidence").alias("merge_evidence"), "bbox", F.to_json("page_bboxes").alias("page_bboxes"), F.to_json("references").alias("references"), "doc_zone", F.to_json("edges").alias("edges"),
    )


@query(None)
def embedding_plan_chunks(spark, d):
    out = pipeline.embedding_chunks(deck.segments(spark, d, *_SEGMENT, by_document=True))
    return out.withColumn("tags", F.array_join("tags", ",")).withColumn("role_distribution", F.to_json("role_distribution"))


@query(f"""with {SEG}, {CHK}, p as (select file_id, chunk_no, unnest(source_segments) as segment_id from chk) select file_id, chunk_no, page, min(bbox[1]) as x0, min(bbox[2]) as y0, max(bbox[3]) as x1, max(bbox[4]) as y1 from p join seg using (file_id, segment_id) where len(bbox) >= 4 and page is not null group by 1, 2, 3""")
def chunk_k13_page_boxes(spark, d):
    s = deck.segments(spark, d, "pos", "page", "bbox")
    parts = _chunks(spark, d, "file_id", "chunk_no", "source_segments").select("file_id", "chunk_no", F.explode("source_segments").alias("segment_id"))
    return chunking.page_boxes(s, parts.join(s.select("file_id", "segment_id", "pos"), ["file_id", "segment_id"]).select("file_id", "chunk_no", "pos"))


@query(f"""with {CHK}, c as (select file_id, coalesce(doc_zone, 'body') as z, count(*) as n, min(chunk_no) as a from chk group by 1, 2) select file_id, z as doc_zone from c qualify row_number() over (partition by file_id order by n desc, a) = 1""")
def chunk_k14_dominant_zone(spark, d):
    return chunking.dominant_zone(_chunks(spark, d, "file_id", "chunk_no", "doc_zone"), ["file_id"], order="chunk_no")


@query(_order_sql("pg, case col when -1 then 1 when 0 then 2 else 3 end, up, pos").replace(" select file_id, segment_id, (row_number()", " , o as (select file_id, segment_id, pg, pos, (row_number()") + """),
 r as (select *, row_number() over (partition by file_id, pg order by pos) as a, row_number() over (partition by file_id, pg order by new_pos) as b from o) select file_id, count(*) filter (a <> b) as moved, count(distinct case when a <> b then pg end) as pages_reordered from r group by 1""")
def metrics_k15_order_stats(spark, d):
    return chunking.order_stats(layout.reading_order(deck.segments(spark, d, "pos", "page", "bbox", "column_index")))


@query(f"with {CHK} select file_id, chunk_no, chunk_type from chk where coalesce(doc_zone, 'body') <> 'front'")
def chunk_k16_front_matter_stripped(spark, d):
    return chunking.without_front_matter(_chunks(spark, d, "file_id", "chunk_no", "chunk_type", "doc_zone")).select("file_id", "chunk_no", "chunk_type")


# graph and metrics -----------------------------------------------------------------------------------------------------


@query(f"""with {CHK}, nx as (select file_id, chunk_id as src, lead(chunk_id) over (partition by file_id order by chunk_no) as dst, 'next' as edge_type from chk qualify dst is not null),
 hd as (select file_id, heading_path, arg_max(chunk_id, chunk_no) as dst from chk where chunk_type = 'header' group by 1, 2),
 up as (select file_id, chunk_id as src, case when chunk_type = 'header' then case when contains(heading_path, ' > ') then array_to_string(string_split(heading_path, ' > ')[:-2], ' > ') end else heading_path end as p from chk)
 select file_id, src, dst, edge_type from nx union all select up.file_id, src, dst, 'part_of' from up join hd on hd.file_id = up.file_id and hd.heading_path = up.p where src <> dst""")
def graph_k10_edges(spark, d):
    return graph.edges(_chunks(spark, d, "file_id", "chunk_no", "chunk_type", "heading_path"))


_EDGES = """nx as (select file_id, chunk_id as src, lead(chunk_id) over (partition by file_id order by chunk_no) as dst, 'next' as edge_type from chk qualify dst is not null),
 hd as (select file_id, heading_path, arg_max(chunk_id, chunk_no) as dst from chk where chunk_type = 'header' group by 1, 2),
 up as (select file_id, chunk_id as src, case when chunk_type = 'header' then case when contains(heading_path, ' > ') then array_to_string(string_split(heading_path, ' > ')[:-2], ' > ') end else heading_path end as p from chk)"""


@query(f"""with {SEG}, {CHK}, {_BLOCKS}, {_MENTIONS}, {_EDGES}, ow as (select file_id, segment_id, arg_max(chunk_id, chunk_no) as dst from (select file_id, chunk_id, chunk_no, unnest(source_segments) as segment_id from chk) group by 1, 2)
 select file_id, src, dst, edge_type from nx union all select up.file_id, src, dst, 'part_of' from up join hd on hd.file_id = up.file_id and hd.heading_path = up.p where src <> dst
 union all select distinct res.file_id, chunk_id, dst, 'references' from res join ow on ow.file_id = res.file_id and ow.segment_id = res.target_segment_id where chunk_id <> dst""")
def graph_k10_with_references(spark, d):
    """The edges of ``graph_k10_edges`` and those from chunks to the chunks of the blocks that they mention."""
    c = _chunks(spark, d, "file_id", "chunk_no", "chunk_type", "heading_path", "content", "source_segments", "page_range")
    c = c.withColumn("first_page", F.try_element_at("page_range", F.lit(1)))
    return pipeline.chunk_graph(c, deck.segments(spark, d, "pos", "type", "text", "page"))


@query(f"""with {CHK} select doc_zone, chunk_type, count(*) as chunks, round(avg(word_count), 6) as avg_words, min(word_count)::int as min_words, max(word_count)::int as max_words, count(*) filter (coalesce(context_prefix, '') <> '') as with_overlap,
 count(*) filter (is_cross_page) as cross_page, count(*) filter (continuation_type = 'full') as full_continuations, count(*) filter (continuation_type = 'partial') as partial_continuations, count(*) filter (needs_review) as needs_review from chk group by 1, 2""")
def metrics_k11_by_type(spark, d):
    c = _chunks(spark, d, "doc_zone", "chunk_type", "word_count", "context_prefix", "is_cross_page", "continuation_type", "needs_review")
    return graph.metrics(c, ["doc_zone", "chunk_type"])


@query(f"with {CHK} select doc_zone, chunk_type, grouping(doc_zone)::int as g1, grouping(chunk_type)::int as g2, count(*) as chunks, sum(word_count)::bigint as words from chk group by rollup (doc_zone, chunk_type)")
def metrics_k11_rollup(spark, d):
    c = _chunks(spark, d, "doc_zone", "chunk_type", "word_count")
    return c.rollup("doc_zone", "chunk_type").agg(F.grouping("doc_zone").cast("int").alias("g1"), F.grouping("chunk_type").cast("int").alias("g2"), F.count(F.lit(1)).alias("chunks"), F.sum("word_count").alias("words"))


@query(f"with {CHK} select tag, count(*) as n from (select unnest(tags) as tag from chk) group by 1")
def metrics_k11_tags(spark, d):
    return graph.tag_counts(_chunks(spark, d, "tags"))


@query(f"""with {CHK}, {_SENT}, r as (select chunk_id, sentence_no, {_KEYROLE} as role from s), l as (select *, lag(role) over (partition by chunk_id order by sentence_no) is distinct from role as new from r),
 f as (select chunk_id, count(*) as sentences, array_to_string((list(role order by sentence_no) filter (new))[:5], ' -> ') as flow from l group by 1), c as (select chunk_id, role, count(*) as n, min(sentence_no) as a from r group by 1, 2)
 select chunk_id, sentences, flow, main_role from f join (select chunk_id, role as main_role from c qualify row_number() over (partition by chunk_id order by n desc, a) = 1) using (chunk_id)""")
def metrics_k12_role_flow(spark, d):
    return graph.role_flow(graph.sentence_roles(_chunks(spark, d, "content"), "chunk_id"), "chunk_id")


@query("""with e as (select *, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minute then 0 else 1 end as new from events), s as (select *, sum(new) over (partition by user_id order by ts rows between unbounded preceding and current row) as g from e)
 select user_id, min(ts) as session_start, max(ts) + interval 30 minute as session_end, count(*) as n_events, round(sum(value), 4) as total from s group by user_id, g""")
def stream_sessions(spark, d):
    return session_windows(src.table(spark, d, "events"))
