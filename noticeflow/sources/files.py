"""JSON, JSON lines, Markdown query lists, history and contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.url import normalize_url


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole files, one document or an array each; a broken one fails."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object for each line, blank lines skipped; a broken line fails."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    """(file, before, first, bad) of each block of files that a task reads by itself: the lines before it in its file, and what of
    its lines is no JSON object, as (at, text).

    A block's rows come in their order from one task, so that their running numbers have no gaps. Counts are all that is summed up
    over a file; no file is read whole.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    v = F.try_parse_json("value")
    bad = (F.trim("value") != "") & (v.isNull() | ~F.startswith(F.schema_of_variant(v), F.lit("OBJECT")))
    each = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.collect_list(F.when(bad, F.struct("at", F.col("value").alias("text")))).alias("bad"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return each.select("file", F.coalesce(before, F.lit(0)).alias("before"), "first", "bad")


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text) of lines that are no JSON objects; lines count from 1, blank ones are none."""
    each = _blocks(spark, path).select("file", "before", "first", F.explode("bad").alias("x"))
    return each.select("file", (F.col("before") + F.col("x.at") - F.col("first") + 1).alias("line"), "x.text")


def checked_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object for each line, blank lines skipped; the first line that is none fails with its file and number."""
    if wrong := bad_lines(spark, path).orderBy("file", "line").limit(1).collect():
        raise ValueError(f"{wrong[0].file}:{wrong[0].line}: no JSON object")
    return read_jsonl(spark, path, schema)


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """History from {"records": [...]}, numbered in its order; missing columns are null. No list of records fails."""
    doc = spark.read.schema(f"records array<struct<{schemas.SEEN.replace(' ', ': ').replace(',: ', ', ')}>>, _corrupt_record string").option("multiLine", True).json(path)
    rows = doc.select(F.when(F.col("records").isNull(), F.raise_error(F.lit("no list of records"))).otherwise(F.col("records")).alias("records"))
    return rows.select(F.posexplode("records").alias("seen_ord", "r")).select("seen_ord", "r.*")


def read_query_list(spark: SparkSession, path: str, heading: str) -> DataFrame:
    """(query_no, query): numbered lines of a Markdown file between a heading, as it is written, and the next of its level."""
    text = spark.read.text(path, wholetext=True).select("value")
    part = F.regexp_extract("value", rf"(?s)(?:^|\n)\Q{heading}\E[^\n]*\n(.*?)(?=\n## |\z)", 1)
    line = text.select(F.explode(F.split(part, r"\r?\n")).alias("line"))
    pattern = r"^(\d+)\.\s+(\S.*?)\s*$"
    return line.where(F.col("line").rlike(pattern)).select(
        F.regexp_extract("line", pattern, 1).cast("int").alias("query_no"), F.regexp_extract("line", pattern, 2).alias("query")
    )


def declared_total(spark: SparkSession, path: str) -> DataFrame:
    """One row: the total that a Markdown query list declares in bold, or null."""
    text = spark.read.text(path, wholetext=True).select("value")
    return text.select(F.regexp_extract("value", r"\*\*(\d+)\s*条\*\*", 1).try_cast("int").alias("declared"))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(name, length) of each file of a folder; the files themselves aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return found.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "length")


def with_content(candidates: DataFrame, contents: DataFrame) -> DataFrame:
    """Adds summary, content and content_error: missing content, or content of another URL."""
    c = contents.select("candidate_id", F.col("source_url").alias("_url"), "summary", "content", F.lit(True).alias("_there"))
    j = candidates.join(c, "candidate_id", "left")
    wrong = F.when(F.col("_there").isNull(), "no content").when(normalize_url(F.col("_url")) != normalize_url(F.col("url")), "content of another URL")
    return j.withColumn("content_error", wrong).drop("_url", "_there")


def find(df: DataFrame, candidate_id: str) -> DataFrame:
    """The first row by `ord` of a candidate, if there is one."""
    return df.where(F.col("candidate_id") == candidate_id).orderBy("ord").limit(1)
