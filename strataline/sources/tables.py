"""Sources: the library's tables, lines of texts, parsed documents as JSON, markdown headings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HINTS = T.StructType(
    [T.StructField(n, T.StringType() if n == "segment_type" else T.IntegerType() if n == "word_count" else T.BooleanType()) for n in ("starts_lowercase", "ends_incomplete", "is_short", "has_list_marker", "segment_type", "ends_with_hyphen", "ends_with_open_clause", "has_fragment_pattern", "starts_like_continuation", "has_terminal_punctuation", "word_count")]
)
SEGMENT = T.StructType(
    [
        T.StructField("segment_id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("text", T.StringType()), T.StructField("page", T.IntegerType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())), T.StructField("depth", T.IntegerType()), T.StructField("heading_path", T.StringType()),
        T.StructField("full_context_text", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("at_page_top", T.BooleanType()),
        T.StructField("at_page_bottom", T.BooleanType()), T.StructField("column_index", T.IntegerType()), T.StructField("level", T.IntegerType()), T.StructField("style_hints", HINTS),
    ]
)
DOCUMENT = T.StructType(
    [
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())), T.StructField("full_markdown", T.StringType()),
        T.StructField("flat_segments", T.ArrayType(SEGMENT)),
    ]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def latest(df: DataFrame, keys: list[str], order: str = "ingested_at") -> DataFrame:
    """One row per key, the last delivered. Combines on the map side, so one key delivered often is no hot spot."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    best = F.max(F.struct(order, *rest)).alias("__r")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("__r")[c].alias(c) for c in (*rest, order)])


def settled(df: DataFrame) -> DataFrame:
    """``df``, computed once and kept in the session's checkpoint folder (``spark.checkpoint.dir``), so that several readers
    don't compute it again, also after an executor is lost. A folder beside the warehouse where the session names none."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    return df.checkpoint()


def segments(spark: SparkSession, folder: str, *columns: str, by_document: bool = False) -> DataFrame:
    """Layout segments, each (file_id, segment_id) once; only the named columns are read. ``by_document``: in the partitions
    of their document, for plans that go on in its order, so that they need no other shuffle."""
    df = table(spark, folder, "flat_segments")
    if columns:
        df = df.select(*dict.fromkeys(("file_id", "segment_id", *columns, "ingested_at")))
    return latest(df.repartition("file_id") if by_document else df, ["file_id", "segment_id"])


def toc(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of the tables of contents, each once, with ``ord`` and the page as a number where it is one."""
    return numbered(latest(table(spark, folder, "toc_entries"), ["file_id", "entry_id"]))


def numbered(df: DataFrame) -> DataFrame:
    """Entries with ``ord``, their place, and ``page_no``, their page where it is a number."""
    return df.withColumn("ord", F.regexp_extract("entry_id", r"(\d+)", 1).cast("int")).withColumn("page_no", F.expr("try_cast(page as int)"))


def lines(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Lines of texts in order: key, pos, text."""
    return df.select(key, F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "text"))


def parsed_documents(spark: SparkSession, path: str) -> DataFrame:
    """Segments of parsed documents, one JSON file each: source_file, pos and the fields of a segment."""
    df = spark.read.schema(DOCUMENT).option("multiLine", True).json(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return df.select(name.alias("source_file"), F.posexplode_outer("flat_segments").alias("pos", "s")).select("source_file", "pos", "s.*")


def unprocessed(files: DataFrame, done: DataFrame, key: str = "source_file") -> DataFrame:
    """Files that have no output yet."""
    return files.join(done.select(key).distinct(), key, "left_anti")


def write_documents(chunks: DataFrame, path: str, key: str = "file_id") -> None:
    """Chunks as JSON lines, in folders by document bucket (a folder for each document would be too many)."""
    chunks.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(256))).write.mode("overwrite").partitionBy("bucket").json(path)


def markdown_headings(df: DataFrame, key: str, text: str) -> DataFrame:
    """Headings of markdown texts: key, pos, level, title."""
    rows = lines(df, key, text).withColumn("m", F.regexp_extract("text", r"^(#+)\s+(.*)$", 1)).filter("m <> ''")
    title = F.trim(F.regexp_extract("text", r"^(#+)\s+(.*)$", 2))
    return rows.select(key, "pos", F.length("m").alias("level"), title.alias("title"))


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """PDF files of a folder: path, modification time, length, content. For a parser as a plug-in (``mapInPandas``)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)


def role_prototypes(spark: SparkSession, path: str) -> DataFrame:
    """(role, example) of a prototype library in JSON: prototypes by role, each with examples."""
    shape = "prototypes map<string, struct<description: string, examples: array<string>>>"
    rows = spark.read.schema(shape).option("multiLine", True).json(path).select(F.explode("prototypes").alias("role", "p"))
    return rows.select("role", F.explode("p.examples").alias("example"))
