"""The pN_ queries: each applies its operator, with production parameters, to its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.llm import boilerplate, encoding, leakage, mojibake, quality, scans, sentences, splitting, unify
from strataline.llm.common import latest, of_files, once, read, scanned_files, settled

PROSE_TYPES = ("explanation", "definition", "example", "procedure")


# 1 sentences ---------------------------------------------------------------------------------------------------------


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Sentence spans of the prose chunks of files that weren't scanned."""
    columns = ["file_id", "chunk_type", "content", "needs_review"]
    chunks = once(read(spark, d, "chunks", "chunk_id", *columns, "ingested_at"), ["chunk_id"], "ingested_at", columns)
    chunks = chunks.filter(F.col("chunk_type").isin(*PROSE_TYPES) & (F.col("needs_review") == F.lit(False)) & F.col("content").isNotNull())
    rows = of_files(chunks, scanned_files(spark, d, False))
    spans = rows.select("chunk_id", F.explode(sentences.sentence_spans(F.col("content"))).alias("s"))
    return spans.select("chunk_id", F.col("s.start_char").alias("start_char"), F.col("s.end_char").alias("end_char"))


def _contents(spark: SparkSession, d: str) -> DataFrame:
    """(chunk_id, content), each chunk once."""
    return once(read(spark, d, "chunks", "chunk_id", "content", "ingested_at"), ["chunk_id"], "ingested_at", ["content"])


def p1_sentences(spark: SparkSession, d: str) -> DataFrame:
    """The sentences of every chunk, with their place."""
    rows = sentences.with_sentences(_contents(spark, d)).select("chunk_id", F.posexplode("sentences").alias("sentence_no", "s"))
    return rows.select("chunk_id", "sentence_no", F.col("s.text").alias("text"), F.col("s.start_char").alias("start_char"), F.col("s.end_char").alias("end_char"))


# 2 quality -----------------------------------------------------------------------------------------------------------


def p2_quality(spark: SparkSession, d: str, files: DataFrame | None = None) -> DataFrame:
    """Text statistics and line label shares of every chunk that awaits review (of some files)."""
    columns = ["file_id", "content", "needs_review"]
    chunks = once(read(spark, d, "chunks", "chunk_id", *columns, "ingested_at"), ["chunk_id"], "ingested_at", columns)
    waiting = chunks.filter((F.col("needs_review") == F.lit(True)) & F.col("content").isNotNull())
    lone = quality.lone_words(read(spark, d, "chunks", "chunk_id", "content"))
    rows = settled(quality.with_alone(waiting.select("chunk_id", "file_id", "content"), lone))
    model = quality.train(rows, read(spark, d, "labels", "chunk_id", "kind", "labelled_at"))
    return quality.with_quality(rows if files is None else of_files(rows, files), model)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks awaiting review, of files that weren't scanned, whose content is not mostly prose."""
    return p2_quality(spark, d, scanned_files(spark, d, False)).filter(F.col("prose") < 0.5).select("chunk_id")


# 3 scans -------------------------------------------------------------------------------------------------------------


def _segments(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """(file_id, segment_id, columns) of segments, each once."""
    rows = read(spark, d, "flat_segments", "file_id", "segment_id", *columns, "ingested_at")
    return once(rows, ["file_id", "segment_id"], "ingested_at", list(columns))


def _lines(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Lines long enough to judge, as hashes, and the files of each site."""
    lines = boilerplate.with_line_hash(boilerplate.explode_lines(_segments(spark, d, "site", "text"), "text"), min_words=4).drop("text", "line")
    files = read(spark, d, "source_files", "file_id", "site").filter(F.col("site").isNotNull())
    return lines, files.groupBy("site").agg(F.count_distinct("file_id").alias("n_all"))


def _site_lines(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lines, totals = _lines(spark, d)
    return lines, boilerplate.repeated_lines(lines, totals)


def _mended(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The segments of the scanned files, and what became of each."""
    columns = ["file_id", "segment_id", "pos", "type", "level", "page", "heading_path", "text", "ingested_at"]
    segments = read(spark, d, "flat_segments", *columns)
    scanned, clean = scanned_files(spark, d, True), scanned_files(spark, d, False)
    words = scans.vocabulary(of_files(segments.select("file_id", "segment_id", "text"), clean), ["file_id", "segment_id"])
    lines, repeated = _site_lines(spark, d)
    site = boilerplate.mark_repeated(of_files(lines, scanned), repeated)
    own = of_files(segments, scanned)
    return own, scans.mend_segments(own, site.select("file_id", "segment_id", "line_no"), words)


def p3_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every segment of the scanned files, with its repaired text and what was wrong with it."""
    return _mended(spark, d)[1]


def _scanned_chunks(spark: SparkSession, d: str) -> DataFrame:
    columns = ["file_id", "content", "source_segments"]
    chunks = of_files(read(spark, d, "chunks", "chunk_id", *columns, "ingested_at"), scanned_files(spark, d, True))
    return once(chunks, ["chunk_id"], "ingested_at", columns)


def _with_texts(segments: DataFrame, mended: DataFrame) -> DataFrame:
    return mended.join(latest(segments, ["file_id", "segment_id"], "ingested_at", ["text"]), ["file_id", "segment_id"])


def p3_repaired_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk of the scanned files, with its repaired content and what was wrong with it."""
    segments, mended = _mended(spark, d)
    return scans.mend_chunks(_scanned_chunks(spark, d), _with_texts(segments, mended))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Segments that hold scan noise, and the chunks whose content holds any of it."""
    segments, mended = _mended(spark, d)
    bad = settled(mended.filter(F.size("reasons") > 0))
    chunks = scans.mend_chunks(_scanned_chunks(spark, d), _with_texts(segments, bad)).filter(F.size("reasons") > 0)
    key = F.concat_ws(":", F.col("file_id").cast("string"), "segment_id").alias("rec_key")
    return bad.select(F.lit("flat_segments").alias("source_table"), key).unionByName(chunks.select(F.lit("chunks").alias("source_table"), F.col("chunk_id").alias("rec_key")))


# 4 boilerplate -------------------------------------------------------------------------------------------------------


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines that a fifth of their site's files have, in each segment."""
    lines, repeated = _site_lines(spark, d)
    return boilerplate.mark_repeated(lines, repeated).select("file_id", "segment_id", F.col("line_no").cast("int").alias("line_no"))


def p4_boilerplate(spark: SparkSession, d: str) -> DataFrame:
    """The method as named: lines in a fifth of a site's clusters of equal documents, three at least, of two dates."""
    lines, totals = _lines(spark, d)
    files = read(spark, d, "source_files", "file_id", "site", "extraction_timestamp").filter(F.col("site").isNotNull())
    dates = files.select("site", "file_id", F.to_date("extraction_timestamp").alias("date"))
    return boilerplate.repeated_lines(lines, totals, dates=dates, least_dates=2, weigh="clusters")


def p4_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Every segment's text without the lines of its site."""
    return boilerplate.without_lines(_segments(spark, d, "text"), p4_found(spark, d), ["file_id", "segment_id"], "text", "clean_text").drop("text")


# 5 one form ----------------------------------------------------------------------------------------------------------


def p5_records(spark: SparkSession, d: str) -> DataFrame:
    """(file_id, rec_key, text) of all segments and entries, each once."""
    a = _segments(spark, d, "text").withColumnRenamed("segment_id", "rec_key")
    b = once(read(spark, d, "toc_entries", "file_id", "entry_id", "title", "ingested_at"), ["file_id", "entry_id"], "ingested_at", ["title"])
    return a.unionByName(b.select("file_id", F.col("entry_id").alias("rec_key"), F.col("title").alias("text")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of records of one file that look the same in different characters."""
    records = of_files(p5_records(spark, d), scanned_files(spark, d, False))
    return unify.look_alike_pairs(records, "file_id", "rec_key", "text")


def p5_unified(spark: SparkSession, d: str) -> DataFrame:
    """The one form of every text."""
    return p5_records(spark, d).select("file_id", "rec_key", unify.unified(F.col("text")).alias("form"))


# 6 splitting ---------------------------------------------------------------------------------------------------------


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Pieces within the limit of every chunk."""
    return splitting.split_items(_contents(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that the operator had to cut."""
    return splitting.split_items(_contents(spark, d)).filter("piece_no = 1").select("chunk_id")


# 7 encoding ----------------------------------------------------------------------------------------------------------


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids of every document's text by byte_bpe_50k."""
    return encoding.encode_texts(read(spark, d, "documents", "doc_id", "text"))


# 8 leakage -----------------------------------------------------------------------------------------------------------


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a passage of an evaluation item."""
    return leakage.find_leaks(read(spark, d, "documents", "doc_id", "text"), read(spark, d, "eval_items", "item_id", "text"))


# 9 garbled text ------------------------------------------------------------------------------------------------------


def p9_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its text restored as far as it can be had."""
    docs = read(spark, d, "documents", "doc_id", "text")
    return mojibake.repair_texts(docs).select("doc_id", "repaired", "garbled", "layers")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents of whose text some is garbled."""
    docs = read(spark, d, "documents", "doc_id", "text")
    odd = docs.filter(mojibake.suspect(F.col("text")))
    return mojibake.repair_texts(odd).filter("garbled").select("doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_sentences, p2_found, p2_quality, p3_found, p3_repaired, p3_repaired_chunks, p4_found, p4_boilerplate, p4_cleaned, p5_found, p5_unified, p6_found, p6_pieces, p7_ids, p8_found, p9_found, p9_repaired,
    )
}

_WORDS = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]|[^\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_LINES = """
with lines as (
  select distinct site, file_id, segment_id, i - 1 as line_no, string_split(text, chr(10))[i] as line
  from (select *, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from flat_segments where text is not null)
), forms as (
  select site, file_id, segment_id, line_no, line,
    regexp_replace(lower(line), '[\\s\\x0b\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\p{Nd}]+', '', 'g') as form
  from lines
  where len(list_filter(regexp_extract_all(line, '[^\\s\\x0b\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+'), lambda w: regexp_matches(w, '\\p{L}'))) >= 4
), repeated as (
  select site, form from forms join (select site, count(distinct file_id) as n from source_files where site is not null group by site) using (site)
  group by site, form, n having count(distinct file_id) >= 3 and count(distinct file_id) >= 0.2 * n
)
select distinct file_id, segment_id, line_no::int as line_no from forms join repeated using (site, form)
"""

_CLEANED = f"""
with found as ({_LINES}), once as (select file_id, segment_id, arg_max(text, coalesce(ingested_at, timestamp '1970-01-01')) as text from flat_segments group by 1, 2)
select file_id, segment_id, case when text is not null then array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: not list_contains(coalesce(gone, []), i - 1)), chr(10)) end as clean_text
from once left join (select file_id, segment_id, list(line_no) as gone from found group by 1, 2) using (file_id, segment_id)
"""

ORACLES = {
    "p4_found": _LINES,
    "p4_cleaned": _CLEANED,
    "p6_found": f"select distinct chunk_id from chunks where len(regexp_extract_all(content, '{_WORDS}')) > 500",
}

#: The queries that a bench times.
HEADLINES = ["p1_found", "p2_found", "p3_found", "p4_found", "p5_found", "p6_found", "p7_ids", "p8_found", "p9_found"]
