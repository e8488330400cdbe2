"""Queries for the older profiles and for operators that only the public interface calls, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataline.config import LEGACY
from strataline.functions import lexicon as lx
from strataline.functions import text as tx
from strataline.functions.patterns import sql
from strataline.operators import chunking, continuation, layout, references, toc
from strataline.plans import deck, pipeline
from strataline.plans import queries as q
from strataline.sources import tables as src
from strataline.plans.queries import CHK, ORACLES, QUERIES, SEG, query, s_fragment, s_hyphen, s_lower, s_match, s_open, s_starts, s_terminal, s_words  # noqa: F401

_L = LEGACY.weights
_LEGACY_SCORE = f"""0.0::double + (case when pbot and ctop then {_L['position']} else 0 end)::double + (case when coalesce(pc, 0) < 0 or coalesce(cc, 0) < 0 or coalesce(pc, 0) = coalesce(cc, 0) then {_L['column']} else 0 end)::double
 + (case when {s_hyphen('a')} then {_L['hyphen']} else 0 end)::double + (case when {s_open('a')} then {_L['open_clause']} else 0 end)::double + (case when {s_fragment('a')} then {_L['fragment']} else 0 end)::double
 + (case when {s_starts('b')} then {_L['start']} when {s_lower('b')} then {_L['start_lowercase']} else 0 end)::double + (case when ph is not distinct from ch then {_L['same_path']} else 0 end)::double
 + (case when pt is not distinct from ct then {_L['same_type']} else 0 end)::double + (case when a <> '' and not {s_terminal('a')} then {_L['incomplete']} else 0 end)::double + (case when a <> '' and not {s_terminal('a')} and {s_lower('b')} then {_L['incomplete_lowercase']} else 0 end)::double"""


@query(f"with {SEG}, {q._PREV}, sc as (select *, case when {q._OUT} then 0.0 else {_LEGACY_SCORE} end as score from j) select file_id, segment_id, round(score, 6) as score, case when score >= 0.7 - 1e-9 then 'full' when score >= 0.4 - 1e-9 then 'partial' else 'none' end as is_continuation from sc")
def cont_c5_legacy_score(spark, d):
    s = deck.segments(spark, d, "pos", "type", "text", "page", "column_index", "heading_path", "at_page_bottom", "at_page_top")
    return continuation.annotate(s, p=LEGACY).select("file_id", "segment_id", F.round("score", 6).alias("score"), "is_continuation")


@query(f"""with {SEG}, n as (select *, trim(coalesce(text, '')) as b, lag(type) over w as k, trim(coalesce(lag(text) over w, '')) as a, lag(page) over w as pg, coalesce(lag(column_index) over w, 0) as pc, row_number() over w as i from seg window w as (partition by file_id order by pos)),
 s as (select *, coalesce(type in ('Table', 'Picture', 'Formula', 'LearningObjective') or k in ('Table', 'Picture', 'Formula', 'LearningObjective'), false) as barred, case when regexp_matches(a, '[-‐‑‒–—]$') then 0.3::double else 0 end + case when {s_lower('b')} then 0.3::double else 0 end + case when not regexp_matches(a, '[.!?]$') then 0.2::double else 0 end
  + case when pg is not distinct from page or abs(coalesce(page, 0) - coalesce(pg, 0)) <= 1 then 0.1::double else 0 end + case when (pg is not distinct from page) <> (pc = coalesce(column_index, 0)) then 0.1::double else 0 end as st from n)
 select file_id, segment_id, case when i > 1 then case when barred then 0.0 else round(st, 6) end end as pair_score, case when i > 1 then case when barred then 'none' when st >= 0.7 - 1e-9 then 'full' when st >= 0.45 - 1e-9 then 'partial' else 'none' end end as pair_decision from s""")
def cont_c9_pairwise(spark, d):
    s = continuation.pairwise(deck.segments(spark, d, "pos", "type", "text", "page", "column_index"))
    return s.select("file_id", "segment_id", F.round("pair_score", 6).alias("pair_score"), "pair_decision")


@query(f"""with {SEG}, x as (select file_id, segment_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '\\s+$', '') as e, regexp_matches(regexp_replace(coalesce(text, ''), '^\\s+', ''), '^\\p{{Ll}}') as lo from seg)
 select file_id, segment_id, lo as starts_lowercase, t <> '' and not regexp_matches(e, '[.?!:;]$') as ends_incomplete, lower(regexp_extract(regexp_replace(e, '[.,;:!?]+$', ''), '(\\S+)\\s*$', 1)) in ({q.OPEN}) as ends_with_open_clause,
  lo or lower(regexp_replace(regexp_extract(t, '^\\s*(\\S+)', 1), '[.,;:]+$', '')) in ({q.STARTERS}) as starts_like_continuation, regexp_matches(e, '[.?!:;]$') as has_terminal_punctuation, ends_with(e, '-') as ends_with_hyphen, ends_with(e, ',') or ends_with(e, '...') as has_fragment_pattern from x""")
def cont_c11_fallback_hints(spark, d):
    return deck.segments(spark, d, "text").select("file_id", "segment_id", tx.fallback_hints(F.col("text")).alias("h")).select("file_id", "segment_id", "h.*")


_VERBS = sql("^(?:" + "|".join(lx.CAPTION_VERBS_LEGACY) + ")")
_NUMBERS = "coalesce(" + ", ".join(f"case when regexp_extract(t, {sql('(?i)' + p)}, 1) <> '' and not regexp_matches(lower(trim(regexp_replace(t, {sql('(?i)' + p)}, ''))), {_VERBS}) then regexp_extract(t, {sql('(?i)' + p)}, 1) end" for p in lx.CAPTION_PATTERNS) + ")"
_TARGET = "case when regexp_matches(lower(t), '^(?:table|tbl)') then 'Table' when regexp_matches(lower(t), '^(?:figure|fig|chart|graph|diagram)') then 'Figure' when starts_with(lower(t), 'exhibit') then 'Exhibit' when regexp_matches(lower(t), '^(?:equation|eq|formula)') then 'Equation' else 'Figure' end"


@query(f"with {SEG}, x as (select *, trim(coalesce(text, '')) as t from seg), c as (select *, {_NUMBERS} as caption_id from x) select file_id, segment_id, caption_id, {_TARGET} as target_type from c where caption_id is not null")
def ref_b1_captions_legacy(spark, d):
    s = deck.segments(spark, d, "text").withColumn("c", tx.caption_legacy(F.col("text")))
    return s.filter("c is not null").select("file_id", "segment_id", "c.caption_id", "c.target_type")


@query(f"""with {SEG}, x as (select *, trim(coalesce(text, '')) as t from seg), c as (select *, case when type = 'Caption' and t <> '' then coalesce(nullif(regexp_extract(t, {sql('(?i)' + lx.CAPTION_PATTERNS[0])}, 1), ''), 'unknown') else {_NUMBERS} end as caption_id from x)
 select file_id, segment_id, caption_id, {_TARGET} as target_type from c where caption_id is not null""")
def ref_b1_captions_trusted(spark, d):
    s = deck.segments(spark, d, "text", "type").withColumn("c", tx.caption_legacy(F.col("text"), F.col("type")))
    return s.filter("c is not null").select("file_id", "segment_id", "c.caption_id", "c.target_type")


@query(f"""with {SEG}, x as (select *, trim(coalesce(text, '')) as t from seg) select file_id, segment_id, case when contains(lower(t), 'table') then 'Table' when regexp_matches(lower(t), 'figure|fig\\.|chart|graph|exhibit') then 'Figure' when regexp_matches(lower(t), 'equation|formula') then 'Equation' else 'Block' end as target_type from x where {s_match('t', lx.CAPTION_PREFIXES)}""")
def ref_b1_captions_by_prefix(spark, d):
    s = deck.segments(spark, d, "text").withColumn("target_type", tx.caption_by_prefix(F.col("text")))
    return s.filter("target_type is not null").select("file_id", "segment_id", "target_type")


_PARTS = "struct_pack(segment_id := {0}.segment_id)"


@query(f"""with {SEG}, c as (select *, {s_words('t')} <= 40 and case {q._CAPS} end is not null as cap, row_number() over (partition by file_id order by pos) as n from (select *, trim(coalesce(text, '')) as t from seg)),
 j as (select b.file_id, b.n, arg_min(k.n, case when k.n < b.n then b.n - k.n else 3 + k.n - b.n end) as cn from c b join c k on k.file_id = b.file_id and k.page = b.page and k.n between b.n - 3 and b.n + 3 and k.n <> b.n and k.cap where b.type in ('Table', 'Picture', 'Formula') group by 1, 2)
 select j.file_id, b.segment_id, b.type, k.t as text, k.t as caption_text, k.segment_id || ',' || b.segment_id as bonded_segment_ids, least(coalesce(k.page, 0), coalesce(b.page, 0))::int as page, k.heading_path from j join c b on b.file_id = j.file_id and b.n = j.n join c k on k.file_id = j.file_id and k.n = j.cn""")
def ref_b4_bond_records(spark, d):
    s = deck.segments(spark, d, "pos", "type", "page", "text", "bbox", "heading_path")
    part = F.struct("segment_id", "type", "text", "page", "bbox", "heading_path")
    found = references.nearby_captions(s).select("file_id", "caption_segment_id", part.alias("block"))
    pairs = found.join(s.select("file_id", F.col("segment_id").alias("caption_segment_id"), part.alias("caption")), ["file_id", "caption_segment_id"])
    pairs = pairs.withColumn("notes", F.lit(None).cast(f"array<{s.select(part.alias('b')).schema['b'].dataType.simpleString()}>"))
    out = references.bond_records(pairs)
    return out.select("file_id", "segment_id", "type", "text", "caption_text", F.array_join("bonded_segment_ids", ",").alias("bonded_segment_ids"), "page", "heading_path")


_PATHS = "|".join(lx.SIDEBAR_PATHS)


@query(f"""with {SEG}, a as (select *, trim(coalesce(text, '')) as t, coalesce(page, 1) as pg, coalesce(len(bbox) >= 4, false) as boxed, upper(coalesce(heading_path, '')) as up from seg), b as (select *, {s_match('t', lx.SIDEBAR_HEADINGS)} as h, {s_match('t', lx.SIDEBAR_OBJECTIVES)} as o, case when boxed then bbox[3] - bbox[1] end as wd, max(case when boxed then bbox[3] - bbox[1] end) over w as most, max(case when boxed then bbox[3] end) over w as x from a window w as (partition by file_id, pg)),
 c as (select *, min(case when wd > 0.5 * most then bbox[1] end) over w as lf, max(case when wd > 0.5 * most then bbox[3] end) over w as rg, case when x > 0.9 * 612.0 then greatest(612.0, x * 1.05) else 612.0 end as width from b window w as (partition by file_id, pg)),
 z as (select *, case when wd <= 0.35 * most and bbox[3] < lf - 30.0 then 'left' when wd <= 0.35 * most and bbox[1] > rg + 30.0 then 'right' end as side, h and bbox[1] > 0.65 * width and wd / width < 0.35 as edge from c),
 zones as (select file_id, pg, 0 as o1, pos, bbox[1] as za, bbox[3] as zz, side from z where side is not null union all select file_id, pg, 1, 0, arg_min(bbox[1], pos), arg_min(width, pos), 'right' from z where edge and not exists (select 1 from z y where y.file_id = z.file_id and y.pg = z.pg and y.side = 'right') group by 1, 2),
 i as (select z.file_id, z.segment_id, arg_min(s.side, s.o1 * 1000000 + s.pos) as inz from z join zones s on s.file_id = z.file_id and s.pg = z.pg and z.boxed and (z.bbox[1] + z.bbox[3]) / 2 between s.za and s.zz group by 1, 2),
 r as (select z.*, inz, regexp_matches(up, '{_PATHS}') or inz is not null or coalesce(wd / width < 0.35 and o, false) as inside from z left join i using (file_id, segment_id))
 select file_id, segment_id, coalesce(inz, 'sidebar') as sidebar_zone, case when h then 'heading' when o or (regexp_matches(up, 'OBJECTIVES|OUTCOMES') and {s_words('t')} > 3) then 'learning_objective' when contains(up, 'KEY') then 'key_term' when contains(up, 'SUMMARY') then 'summary' else 'sidebar_content' end as sidebar_type from r where h or inside""")
def layout_l11_rich_sidebars(spark, d):
    s = layout.sidebars_rich(deck.segments(spark, d, "pos", "page", "text", "bbox", "heading_path"))
    return s.filter("is_sidebar").select("file_id", "segment_id", "sidebar_zone", "sidebar_type")


_IMPERATIVES = f"len(list_filter({q.s_sentences('content')}, lambda s: coalesce(lower(regexp_replace(regexp_extract(s, '^\\s*(\\S+)', 1), '[.,;:]+$', '')) in ({', '.join(sql(v) for v in lx.IMPERATIVE_VERBS)}), false)))"
_PRIORITY = " ".join(f"when list_contains(tg, '{t}') then '{t}'" for t in ("definition", "procedure", "example", "exercise", "formula", "summary"))


@query(f"""with {SEG}, {CHK}, k as (select chunk_id, bool_and(type = 'ListItem') as all_list from (select chunk_id, file_id, unnest(source_segments) as segment_id from chk) join seg using (file_id, segment_id) group by 1),
 x as (select chunk_id, coalesce(all_list, false) as all_list, string_split({q.s_tags('content', lx.TAGS_LEGACY_EMBEDDING, 'im')}, ',') as tg, {_IMPERATIVES} as n, len({q.s_sentences('content')}) as m from chk left join k using (chunk_id) where content is not null)
 select chunk_id, case when all_list then 'list' when list_contains(tg, 'theorem') then 'theorem' when list_contains(tg, 'proof') then 'proof' when m > 0 and n / m >= 0.5 then 'procedure' {_PRIORITY} else 'explanation' end as chunk_type from x""")
def chunk_k5_legacy_types(spark, d):
    s = deck.segments(spark, d, "type").select("file_id", "segment_id", "type")
    c = deck.chunks(spark, d, "file_id", "content", "source_segments").filter("content is not null")
    kinds = c.select("chunk_id", "file_id", F.explode("source_segments").alias("segment_id")).join(s, ["file_id", "segment_id"]).groupBy("chunk_id").agg(F.bool_and(F.col("type") == "ListItem").alias("all_list"))
    c = c.select("chunk_id", "content").join(kinds, "chunk_id", "left").withColumn("s", tx.sentences(F.col("content")))
    share = F.when(F.size("s") > 0, F.size(F.filter("s", lambda x: tx.is_imperative(x))) / F.size("s"))
    kind = chunking.infer_type_legacy(F.coalesce("all_list", F.lit(False)), F.lit(False), tx.tags(F.col("content"), lx.TAGS_LEGACY_EMBEDDING), share, objectives=False)
    return c.select("chunk_id", kind.alias("chunk_type"))


@query(f"with {CHK}, {q._SENT}, u as (select chunk_id, unnest(string_split({q.s_tags('sentence', lx.TAGS, 'im')}, ',')) as tag from s union all select chunk_id, unnest(string_split({q.s_tags('content', lx.TAGS, 'im')}, ',')) from chk where content is not null) select chunk_id, coalesce(string_agg(distinct tag, ',' order by tag) filter (tag <> ''), '') as tags from (select * from u union all select chunk_id, '' from chk where content is not null) group by 1")
def tag_g14_tag_union(spark, d):
    """The tags of a text and of its sentences, each once, by name."""
    c = deck.chunks(spark, d, "content").filter("content is not null")
    return c.select("chunk_id", F.array_join(chunking.tag_union(F.col("content")), ",").alias("tags"))


@query(f"with {CHK}, {q._SENT} select chunk_id, sentence_no::int as sentence_no, 'topic' as role from s where chunk_type = 'header'")
def tag_g9_forced_roles(spark, d):
    c = deck.chunks(spark, d, "chunk_type", "content").filter("content is not null")
    rows = c.select("chunk_id", F.posexplode(tx.sentences(F.col("content"))).alias("sentence_no", "sentence"), tx.forced_role(F.col("chunk_type"), F.lit(False)).alias("role"))
    return rows.filter("role is not null").select("chunk_id", "sentence_no", "role")


@query(f"""with {CHK}, {q._SENT}, r as (select chunk_id, sentence_no, {q._KEYROLE} as role from s), c as (select chunk_id, role, count(*) as n, min(sentence_no) as a from r group by 1, 2), m as (select chunk_id, role from c qualify row_number() over (partition by chunk_id order by n desc, a) = 1)
 select chunk_id, case when bool_or(r.role = 'example') then 'example' when bool_or(r.role = 'question') then 'question' when bool_or(r.role = 'definition') then 'definition' else any_value(m.role) end as chunk_type from r join m using (chunk_id) group by 1""")
def chunk_k5_types_by_roles(spark, d):
    c = deck.chunks(spark, d, "content").filter("content is not null").withColumn("roles", F.transform(tx.sentences(F.col("content")), lambda s: tx.role_by_keywords(s)))
    return c.filter(F.size("roles") > 0).select("chunk_id", chunking.type_by_roles(F.col("roles")).alias("chunk_type"))


# contents in the canonical plan ----------------------------------------------------------------------------------------

_BOOK = f"""h as (select file_id, doc_id * 100000 + i - 1 as pos, length(regexp_extract(l, '^(#+)\\s+(.*)$', 1)) as level, trim(regexp_extract(l, '^(#+)\\s+(.*)$', 2)) as title from (select file_id, doc_id, i, string_split(text, chr(10))[i] as l from (select file_id, doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents where text is not null and file_id is not null)) where regexp_matches(l, '^#+\\s')),
 hc as (select file_id, pos, level, regexp_replace(regexp_replace(title, '\\[(.*?)\\]\\(.*?\\)', '\\1', 'g'), '\\*\\*|__', '', 'g') as title from h where not {s_match('title', lx.LOGIC_NOISE)} and length(title) >= 2), {q.s_stack('level', 'title', 'file_id', 'pos', 'hc', levels=9)},
 book as (select file_id, {q.s_plain('title')} as norm, arg_max(path, case when level < 3 then pos else -1 - pos end) as path, min(pos) as ord from stacked group by 1, 2)"""


@query(f"""with {SEG}, {_BOOK}, x as (select *, {q.s_plain("coalesce(text, '')")} as norm from seg), own as (select distinct file_id, norm from x), near as (select own.file_id, own.norm, arg_min(b.path, b.ord) as path from own join book b on b.file_id = own.file_id and length(b.norm) > 10 and (starts_with(own.norm, b.norm) or starts_with(b.norm, own.norm)) group by 1, 2),
 l as (select x.*, coalesce(b.path, n.path) as logic from x left join book b on b.file_id = x.file_id and b.norm = x.norm left join near n on n.file_id = x.file_id and n.norm = x.norm)
 select file_id, segment_id, case when type = 'Header' and (coalesce(text, '') = '' or {s_match("coalesce(text, '')", lx.LOGIC_NOISE)}) then 'Paragraph' else type end as type, case when logic <> '' and length(logic) > length(coalesce(heading_path, '')) then logic else heading_path end as heading_path from l""")
def toc_t13_alignment(spark, d):
    """Segments by the headings of the markdown of their file: its documents, one after the other."""
    docs = src.table(spark, d, "documents").filter("file_id is not null")
    heads = src.markdown_headings(docs.select("doc_id", "text"), "doc_id", "text").join(docs.select("doc_id", "file_id"), "doc_id")
    heads = heads.select("file_id", (F.col("doc_id") * 100_000 + F.col("pos")).alias("pos"), "level", "title")
    rows = toc.align(deck.segments(spark, d, "type", "text", "heading_path"), toc.logic_book(heads, "file_id"))
    return rows.select("file_id", "segment_id", "type", "heading_path")


_SECTIONS = f"""r as (select *, trim(lower(title)) as t from toc where page_no is not null), s as (select file_id, min(struct_pack(o := ord, p := page_no)) as s from r where {s_match('t', lx.BODY_START_TITLES)} and page_no < 150 group by 1),
 g as (select r.*, s.s, (select min(struct_pack(o := n.ord, p := n.page_no)) from r n where n.file_id = r.file_id and n.ord > r.ord and coalesce(n.level, 1) = 1).p as nxt from r left join s using (file_id)),
 sec as (select file_id, coalesce(any_value(s.p), 1)::int as body_start, coalesce(case when any_value(s) is not null then min(case when ord >= s.o and page_no > s.p + 100 and {s_match('t', lx.BACK_TITLES)} and coalesce(level, 1) = 1 then page_no end) end, 9999)::int as back_start,
  (arg_max(page_no, ord) filter (contains(t, 'glossary')))::int as glossary_start, (arg_max(coalesce(nxt - 1, page_no + 15), ord) filter (contains(t, 'glossary')))::int as glossary_end from g group by file_id)"""


@query(f"""with {q.TOC}, {CHK}, {_SECTIONS}, z as (select chunk_id, chunk_type, page_range[1] as p, case when page_range[1] <= body_start - 1 then 'front' when page_range[1] >= back_start then 'back' else 'body' end as zone, glossary_start, glossary_end from chk left join sec using (file_id))
 select chunk_id, zone as doc_zone, case when zone = 'front' and chunk_type <> 'header' then 'front_matter' when zone = 'back' then case when p between glossary_start and glossary_end then 'glossary' else 'back_matter' end else chunk_type end as chunk_type from z""")
def toc_t14_zone_types(spark, d):
    c = deck.chunks(spark, d, "file_id", "chunk_type", "page_range").withColumn("first_page", F.try_element_at("page_range", F.lit(1))).withColumn("doc_zone", F.lit("body"))
    return pipeline.zoned(c, toc.section_map(deck.toc(spark, d))).select("chunk_id", "doc_zone", "chunk_type")


@query(f"""with {SEG}, {q._GLOSSARY_PAGES}, r as (select *, trim(coalesce(text, '')) as t, row_number() over (partition by file_id order by page, coalesce(bbox[2], 0.0), pos) as o from seg where (file_id, coalesce(page, 0)) in (select (file_id, page) from gp)), k as (select *, contains(t, ': ') as pair, not contains(t, ': ') and length(t) < 60 and not ends_with(t, '.') as term from r where length(t) >= 2 and lower(t) <> 'glossary'),
 g as (select *, sum((pair or term)::int) over (partition by file_id order by o) as g from k), h as (select file_id, g, arg_min(t, o) as head, arg_min(pair, o) as pair, string_agg(case when not pair and not term then t end, ' ' order by o) as body, string_agg(segment_id, ',' order by o) as segments, min(o) as o, arg_min(term, o) as term from g group by 1, 2),
 i as (select *, case when pair then trim(substring(head, 1, strpos(head, ': ') - 1)) || ': ' || trim(substring(head, strpos(head, ': ') + 2)) else head || ': ' || body end as content from h where pair or (term and coalesce(body, '') <> ''))
 select file_id, (row_number() over (partition by file_id order by o))::int as chunk_no, content, segments from i""")
def chunk_k9_glossary(spark, d):
    """The definitions that a glossary's pages become, numbered on from no chunks."""
    s = deck.segments(spark, d, "pos", "page", "text", "bbox")
    inside = s.withColumn("__p", F.coalesce("page", F.lit(0))).join(toc.glossary_pages(s).withColumnRenamed("page", "__p"), ["file_id", "__p"], "left_semi").drop("__p")
    none = deck.chunks(spark, d, "file_id", "chunk_no").filter(F.lit(False)).select("file_id", "chunk_no")
    return pipeline.with_glossary(none, inside).select("file_id", "chunk_no", "content", F.array_join("source_segments", ",").alias("segments"))


@query("select distinct source_file from source_files")
def src_s1_s3_parsed_documents(spark, d):
    """Parsed documents as JSON, one file each, written for the query and scanned as a directory: the files that it finds."""
    out = spark.conf.get("spark.sql.warehouse.dir") + "/_parsed"
    files = src.table(spark, d, "source_files").groupBy("source_file").agg(F.min("file_id").alias("file_id"))
    parts = src.latest(src.table(spark, d, "flat_segments").select("file_id", "segment_id", "type", "text", "page", "ingested_at"), ["file_id", "segment_id"])
    parts = parts.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("segment_id", "type", "text", "page"))).alias("flat_segments"))
    docs = files.join(parts, "file_id", "left").select(F.create_map(F.lit("source_file"), "source_file").alias("metadata"), F.lit("").alias("full_markdown"), "flat_segments")
    docs.write.mode("overwrite").json(out)
    back = spark.read.schema(src.DOCUMENT).json(out)
    return back.select(F.col("metadata")["source_file"].alias("source_file")).distinct()


@query(f"""with {SEG}, p as (select file_id, coalesce(page, 1)::int as page, lower(substring(string_agg(coalesce(text, ''), chr(10) order by pos), 1, 1000)) as head, sum(len(regexp_extract_all(coalesce(text, ''), '[\\.·0-9]{{5,}}'))) as runs from seg where coalesce(page, 1) <= 40 group by 1, 2)
 select file_id, page, ((case when regexp_matches(head, '{"|".join(lx.TOC_CANDIDATE_WORDS)}') then 5 else 0 end) + (case when runs > 3 then 5 else 0 end))::int as score from p""")
def src_s8_page_scores(spark, d):
    return toc.page_scores(deck.segments(spark, d, "pos", "page", "text"))
