"""Documented-only curation operators.

All are aggregations with bounded per-group state (counts, one keeper, top k);
none collects a group into a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import url_host
from folio.operators.admission import author_candidates
from folio.operators.index import parse_flat_yaml, front_matter_block
from folio.operators.maintenance import orphans
from folio.sources.tables import scan_fetch_meta

# --- fixed values -----------------------------------------------------------
RECENT_ENTRIES = 10          # author job without a date range: most recent entries
JUNK_MAX_BYTES = 300         # Markdown files below this size are junk
UNKNOWN_VALUE = "unknown"
# ---------------------------------------------------------------------------


def top_k_per_group(df: DataFrame, group: str, order: list[Column], k: int, salt_buckets: int = 64,
                    salt_col: str | None = None) -> DataFrame:
    """Top ``k`` rows per group under a total ``order``, skew-safe.

    Phase 1 ranks inside (group, salt) sub-groups, so a hot group is spread
    over ``salt_buckets`` tasks; only the ``k`` best of each sub-group survive.
    Phase 2 ranks those (at most ``k * salt_buckets`` rows per group)."""
    salt = F.abs(F.xxhash64(F.col(salt_col) if salt_col else F.struct(*df.columns))) % salt_buckets
    d = df.withColumn("_salt", salt)
    w1 = Window.partitionBy(group, "_salt").orderBy(*order)
    d = d.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(group).orderBy(*order)
    return d.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)


def recent_entries(jobs: DataFrame, entries: DataFrame, k: int = RECENT_ENTRIES) -> DataFrame:
    """x_recent_entries: author jobs without a date range take the ``k`` most
    recent entries of their feed (ties broken by link)."""
    open_jobs = jobs.filter(F.col("date_range").isNull())
    cand = author_candidates(open_jobs, entries)
    return top_k_per_group(cand, "job_id", [F.col("published_date").desc(), F.col("link")], k, salt_col="link") \
        .select("job_id", "rank", "link", "published_date", "post_id")


def junk_articles(markdown: DataFrame) -> DataFrame:
    """x_junk_articles: (slug, reason) for Markdown under 300 bytes and for front
    matter holding an ``unknown`` value."""
    short = markdown.filter(F.octet_length("md") < JUNK_MAX_BYTES).select("slug", F.lit("short").alias("reason"))
    fm = markdown.select("slug", front_matter_block(F.col("md")).alias("fm")).filter(F.col("fm").isNotNull())
    unk = fm.filter(F.exists(parse_flat_yaml(F.col("fm")), lambda x: F.lower(x["v"]) == UNKNOWN_VALUE)) \
        .select("slug", F.lit("unknown_metadata").alias("reason"))
    return short.unionByName(unk)


def duplicate_sets(stage: DataFrame) -> DataFrame:
    """x_duplicate_sets: post ids stored under more than one page; the page whose
    source URL is the canonical URL is kept (then the smallest page key)."""
    s = stage.filter((F.col("status") != "error") & F.col("post_id").isNotNull()) \
        .select("post_id", "page_key", (F.col("source_url") != F.coalesce("canonical_url", F.lit(""))).alias("_nc"))
    g = s.groupBy("post_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_pages"),
                                 F.min(F.struct("_nc", "page_key")).page_key.alias("_keep"))
    j = s.join(g.filter(F.col("n_pages") > 1), "post_id")
    return j.select("post_id", "page_key", "n_pages",
                    F.when(F.col("page_key") == F.col("_keep"), F.lit("keep")).otherwise(F.lit("delete")).alias("action"))


def slug_collisions(stage: DataFrame) -> DataFrame:
    """x_slug_collisions: slugs claimed by canonical URLs of several hosts."""
    s = stage.filter((F.col("status") != "error") & F.col("post_id").isNotNull()) \
        .select(F.col("post_id").alias("slug"), url_host("canonical_url").alias("host"))
    return s.groupBy("slug").agg(F.countDistinct("host").cast("bigint").alias("n_hosts")) \
        .filter(F.col("n_hosts") > 1)


def refetch_orphans(pages: DataFrame, meta: DataFrame, parsed: DataFrame) -> DataFrame:
    """x_refetch_orphans: metadata without HTML -> re-crawl its source URL;
    HTML without metadata -> rebuild the metadata from the canonical URL
    (``parsed``: page_key + canonical_url from the HTML pass)."""
    o = orphans(pages, meta)
    m = scan_fetch_meta(meta).select("page_key", F.when(F.col("has_source_url"), F.col("meta_source_url"))
                                     .alias("url"))
    refetch = o.filter(F.col("category") == "orphaned_meta").join(m, "page_key") \
        .select("page_key", F.lit("refetch").alias("action"), "url")
    rebuild = o.filter(F.col("category") == "orphaned_html").join(
        parsed.select("page_key", F.col("canonical_url").alias("url")), "page_key") \
        .select("page_key", F.lit("rebuild_meta").alias("action"), "url")
    return refetch.unionByName(rebuild)
