"""Sources (S1-S3, S6-S10): raw tables -> typed, keyed DataFrames.

Each reader is a DataFrame transformation so it composes with any upstream
(Parquet table, fixture, streaming micro-batch); ``read_*`` variants open files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.functions import meta_slug, page_key, strip_ws

META_SCHEMA = "`source-url` STRING, `fetch-timestamp` STRING"


def scan_pages(pages: DataFrame, url_col: str = "source_url", html_col: str = "html") -> DataFrame:
    """Stored pages keyed by page key (U5 of the fetched URL, ``.html`` stripped)."""
    return pages.select(page_key(F.col(url_col)).alias("page_key"),
                        F.col(url_col).alias("source_url"), F.col(html_col).alias("html"))


def read_page_files(spark: SparkSession, path_glob: str) -> DataFrame:
    """S1 over a directory of ``*.html`` files: one row per file, key from its name."""
    df = spark.read.text(path_glob, wholetext=True)
    return df.select(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.html$", "").alias("page_key"),
        F.lit(None).cast("string").alias("source_url"), F.col("value").alias("html"))


def scan_fetch_meta(meta: DataFrame) -> DataFrame:
    """Fetch metadata files -> page key, JSON validity and the two fields."""
    raw = F.col("raw_json")
    keys = F.json_object_keys(raw)
    parsed = F.from_json(raw, META_SCHEMA)
    return meta.select(
        meta_slug(F.col("meta_file")).alias("page_key"),
        F.col("meta_file"),
        keys.isNotNull().alias("meta_valid"),
        F.coalesce(F.array_contains(keys, "source-url"), F.lit(False)).alias("has_source_url"),
        F.coalesce(F.array_contains(keys, "fetch-timestamp"), F.lit(False)).alias("has_fetch_ts"),
        F.when(keys.isNotNull(), parsed["source-url"]).alias("meta_source_url"),
        F.when(keys.isNotNull(), parsed["fetch-timestamp"]).alias("fetch_timestamp"),
    )


def read_fetch_meta_files(spark: SparkSession, path_glob: str) -> DataFrame:
    """S2 over ``*.meta.json`` files."""
    df = spark.read.text(path_glob, wholetext=True)
    return scan_fetch_meta(df.select(F.col("_metadata.file_name").alias("meta_file"),
                                     F.col("value").alias("raw_json")))


def scan_url_queue(queue: DataFrame, states=("pending", "done")) -> DataFrame:
    """S3: URL-list lines of the given states, blank lines dropped."""
    q = queue.filter(F.col("state").isin(*states))
    return q.filter(F.col("url").isNotNull() & (strip_ws(F.col("url")) != "")) \
            .select("list_name", "pos", "url", "state")


def numbered_lines(spark: SparkSession, path_glob: str) -> DataFrame:
    """The lines of text files with their file and exact line number (``pos``, from 0).

    No file is read whole: files are split over tasks like any other text, a first pass counts
    the lines of each split, prefix sums over the splits of a file (one row a split) give the
    number of its first line, and the second pass adds the place within the split. Only the
    counts are shuffled. Lines end in ``\\n`` or ``\\r\\n``."""
    lines = spark.read.option("lineSep", "\n").text(path_glob).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("list_name"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"),
        F.regexp_replace("value", r"\r$", "").alias("line"))
    earlier = Window.partitionBy("s_file").orderBy("s_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy(F.col("file").alias("s_file"), F.col("split").alias("s_split")) \
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")) \
        .select("s_file", "s_split", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return lines.join(splits, (F.col("file") == F.col("s_file")) & (F.col("split") == F.col("s_split"))) \
        .select("file", "list_name", (F.col("at") + F.col("shift")).alias("pos"), "line")


def read_url_lists(spark: SparkSession, path_glob: str, state: str) -> DataFrame:
    """S3 over ``*.txt`` URL lists of any size; ``pos`` is the exact line number within its
    file, blank lines counted but dropped."""
    lines = numbered_lines(spark, path_glob)
    return scan_url_queue(lines.select("list_name", "pos", F.col("line").alias("url"), F.lit(state).alias("state")), states=(state,))


def completed_set(completed: DataFrame) -> DataFrame:
    """Distinct non-blank post ids of the completion ledger."""
    p = F.col("post_id")
    return completed.filter(p.isNotNull() & (strip_ws(p) != "")).select("post_id").distinct()


def alias_map(aliases: DataFrame) -> DataFrame:
    """One post id per URL, the last write (largest ``seq``) wins.

    ``max_by`` is a partial aggregate, so a URL written millions of times is
    combined map-side before the shuffle."""
    return aliases.filter(F.col("url").isNotNull()) \
        .groupBy("url").agg(F.max_by("post_id", "seq").alias("post_id"))


def ignore_set(lines: DataFrame, col: str = "line") -> DataFrame:
    """Ignore-list entries, trimmed first (V11), blanks and ``#`` comments dropped."""
    t = strip_ws(F.col(col))
    return lines.select(t.alias("domain")) \
        .filter((F.col("domain") != "") & ~F.col("domain").startswith("#")).distinct()


def scan_markdown(markdown: DataFrame) -> DataFrame:
    """Stored Markdown articles with their slug."""
    return markdown.select("slug", "md")


def read_markdown_files(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True)
    return df.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.md$", "").alias("slug"),
                     F.col("value").alias("md"))
