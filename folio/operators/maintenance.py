"""Corpus maintenance.

All set algebra is joins: orphans are one full outer join on the page key;
pruning is ``left_semi``/``left_anti`` on ids and URLs (high-cardinality keys,
never the host). Nothing is deleted in place: ``prune_apply`` returns new table
versions to be written next to the old ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import content_corruption_reason, is_short_error_page, page_key, url_domain, url_filename
from folio.functions.text import MIN_HTML_BYTES, SHORT_PAGE_MAX_CHARS
from folio.operators.articles import extract_metadata
from folio.operators.html_pass import html_pass
from folio.operators.joins import lookup
from folio.session import materialize
from folio.sources.tables import alias_map, completed_set, scan_fetch_meta, scan_url_queue

# --- fixed values -----------------------------------------------------------
REASON_SMALL = "File size is less than 500 bytes"
REASON_BAD_JSON = "JSON parse error"
REASON_NO_SOURCE = "Missing mandatory :source-url key"
REASON_BAD_URL = "Malformed :source-url"
# ---------------------------------------------------------------------------


def url_by_page_key(queue: DataFrame) -> DataFrame:
    """A3 over the done lists: page key -> original URL, the last line wins
    (largest (list_name, pos)); ``max_by`` combines map-side."""
    q = scan_url_queue(queue, ("done",)).withColumn("page_key", page_key("url")) \
        .filter(F.col("page_key").isNotNull())
    return q.groupBy("page_key").agg(F.max_by("url", F.struct("list_name", "pos")).alias("url"))


def short_pages(pages: DataFrame) -> DataFrame:
    """stored pages that are rate-limit error pages."""
    p = html_pass(pages.filter(F.length("html") < SHORT_PAGE_MAX_CHARS), ["page_key"], parts=("short_body_text",), keep_html=True)
    return p.filter(is_short_error_page("html", "short_body_text")).select("page_key")


def recover_short_pages(pages: DataFrame, queue: DataFrame) -> DataFrame:
    """Original URLs of the short pages, sorted, for a re-crawl job."""
    return short_pages(pages).join(url_by_page_key(queue), "page_key") \
        .select("url", "page_key").orderBy("url")


def orphans(pages: DataFrame, meta: DataFrame) -> DataFrame:
    """One full outer join on the page key replaces three set operations."""
    h = pages.select(F.col("page_key").alias("h_key")).distinct()
    m = scan_fetch_meta(meta).select(F.col("page_key").alias("m_key")).distinct()
    j = h.join(m, h.h_key == m.m_key, "full_outer")
    return j.select(F.coalesce("h_key", "m_key").alias("page_key"),
                    F.when(F.col("m_key").isNull(), F.lit("orphaned_html"))
                     .when(F.col("h_key").isNull(), F.lit("orphaned_meta"))
                     .otherwise(F.lit("matched")).alias("category"))


def page_and_meta_facts(pages: DataFrame, meta: DataFrame) -> DataFrame:
    """Narrow facts of all pages and all fetch metadata, joined once and written: ``side``
    (matched, orphaned_html, orphaned_meta) and what M1 judges."""
    facts = pages.select("page_key", "html", F.octet_length("html").alias("n_bytes"),
                         content_corruption_reason("html").alias("corruption"))
    facts = extract_metadata(html_pass(facts, ["page_key", "n_bytes", "corruption"], parts=("meta",))) \
        .select(F.col("page_key").alias("h_key"), "n_bytes", "corruption", "canonical_slug", F.lit(True).alias("has_page"))
    m = scan_fetch_meta(meta).select(F.col("page_key").alias("m_key"), "meta_valid", "has_source_url", "meta_source_url")
    j = facts.join(m, F.col("h_key") == F.col("m_key"), "full_outer")
    side = F.when(F.col("has_page").isNull(), F.lit("orphaned_meta")).when(F.col("meta_valid").isNull(), F.lit("orphaned_html")).otherwise(F.lit("matched"))
    return materialize(j.select(F.coalesce("h_key", "m_key").alias("page_key"), side.alias("side"), "n_bytes", "corruption", "canonical_slug", "meta_valid",
                                "has_source_url", "meta_source_url"), "integrity")


def verify_integrity(pages: DataFrame, meta: DataFrame) -> DataFrame:
    """M1: one finding row per problem (page_key, category, reason); a page may
    have several. V10: the canonical-slug check is done as documented.

    The page side is reduced to narrow facts first (byte size and corruption
    reason natively, canonical slug from the HTML pass), so only those facts —
    never the HTML — meet the metadata, once, in a full outer join whose rows give
    orphans and findings alike."""
    met = page_and_meta_facts(pages, meta)
    orphan_rows = met.filter(F.col("side") != "matched").select("page_key", F.col("side").alias("category")).distinct() \
        .select("page_key", "category", F.lit(None).cast("string").alias("reason"))
    p = met.filter(F.col("side") == "matched")
    expected = url_filename("meta_source_url")
    no_source = F.col("meta_valid") & F.col("meta_source_url").isNull()     # key absent, or its value null
    f = lambda cond, cat, reason: F.when(cond, F.struct(F.lit(cat).alias("category"),
                                                        reason.alias("reason")))
    findings = F.array_compact(F.array(
        f(F.col("n_bytes") < MIN_HTML_BYTES, "corrupt_html", F.lit(REASON_SMALL)),
        f(F.col("corruption").isNotNull(), "corrupt_html", F.col("corruption")),
        f(~F.col("meta_valid"), "corrupt_meta", F.lit(REASON_BAD_JSON)),
        f(no_source, "corrupt_meta", F.lit(REASON_NO_SOURCE)),
        f(F.col("meta_source_url").isNotNull() & expected.isNull(), "mismatched", F.lit(REASON_BAD_URL)),
        f(F.col("meta_source_url").isNotNull() & (expected != F.concat(F.col("page_key"), F.lit(".html"))), "mismatched",
          F.concat(F.lit(":source-url implies filename should be "), expected)),
        f(F.col("canonical_slug").isNotNull() & (F.col("canonical_slug") != F.col("page_key")), "mismatched",
          F.concat(F.lit("Filename is '"), F.col("page_key"), F.lit("' but canonical slug in HTML is '"),
                   F.col("canonical_slug"), F.lit("'"))),
    ))
    rows = p.select("page_key", F.explode(findings).alias("x")) \
        .select("page_key", F.col("x.category").alias("category"), F.col("x.reason").alias("reason"))
    return orphan_rows.unionByName(rows)


def integrity_summary(pages: DataFrame, meta: DataFrame, findings: DataFrame) -> DataFrame:
    """A5: file counts and findings per category."""
    n_html = pages.agg(F.countDistinct("page_key").cast("bigint").alias("n")).select(F.lit("html_files").alias("metric"), "n")
    n_meta = scan_fetch_meta(meta).agg(F.countDistinct("page_key").cast("bigint").alias("n")) \
        .select(F.lit("meta_files").alias("metric"), "n")
    by_cat = findings.groupBy("category").agg(F.count(F.lit(1)).cast("bigint").alias("n")) \
        .select(F.col("category").alias("metric"), "n")
    return n_html.unionByName(n_meta).unionByName(by_cat)


def prune_candidates(meta: DataFrame, ignored: DataFrame, html_dir: str = "work/html",
                     meta_dir: str = "work/metadata", processed_dir: str = "work/processed") -> DataFrame:
    """F8 + J7: metadata whose source URL host (exact) is ignored, with the
    three artefact paths to remove."""
    m = scan_fetch_meta(meta).filter(F.col("has_source_url") & F.col("meta_source_url").isNotNull())
    m = m.withColumn("_host", url_domain("meta_source_url"))
    ign = lookup(ignored.select(F.col("domain").alias("_host")))
    c = m.join(ign, "_host", "left_semi")
    return c.select(F.col("page_key").alias("slug"), F.col("meta_source_url").alias("source_url"),
                    F.array(F.concat(F.lit(meta_dir + "/"), F.col("meta_file")),
                            F.concat(F.lit(html_dir + "/"), F.col("page_key"), F.lit(".html")),
                            F.concat(F.lit(processed_dir + "/"), F.col("page_key"), F.lit(".md"))
                            ).alias("files_to_delete"))


def prune_plan(candidates: DataFrame) -> DataFrame:
    """M3: dry-run listing, one row per artefact."""
    return candidates.select("slug", "source_url", F.posexplode("files_to_delete").alias("pos", "path"))


def prune_aliases(aliases: DataFrame, candidates: DataFrame) -> DataFrame:
    """Alias map without the rows whose id is condemned."""
    return alias_map(aliases).join(candidates.select(F.col("slug").alias("post_id")), "post_id", "left_anti") \
        .select("url", "post_id")


def prune_completed(completed: DataFrame, candidates: DataFrame) -> DataFrame:
    """Completed ids minus condemned slugs, ascending."""
    return completed_set(completed).join(candidates.select(F.col("slug").alias("post_id")), "post_id", "left_anti") \
        .orderBy("post_id")


def pruned_counts(aliases: DataFrame, candidates: DataFrame) -> DataFrame:
    """Condemned ids and alias entries removed."""
    n_ids = candidates.agg(F.countDistinct("slug").cast("bigint").alias("n")).select(F.lit("condemned_ids").alias("metric"), "n")
    am = alias_map(aliases)
    n_urls = am.join(candidates.select(F.col("slug").alias("post_id")).distinct(), "post_id", "left_semi") \
        .agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit("alias_entries_removed").alias("metric"), "n")
    return n_ids.unionByName(n_urls)


def prune_apply(articles: DataFrame, completed: DataFrame, aliases: DataFrame, candidates: DataFrame,
                force: bool = False) -> dict[str, DataFrame]:
    """M4: the corpus, ledger and alias tables without the condemned rows.
    Opt-in: without ``force`` the inputs are returned unchanged."""
    if not force:
        return {"articles": articles, "completed": completed_set(completed), "aliases": alias_map(aliases)}
    slugs = candidates.select(F.col("slug").alias("_s")).distinct()
    return {"articles": articles.join(slugs, articles.slug == slugs._s, "left_anti"),
            "completed": prune_completed(completed, candidates),
            "aliases": prune_aliases(aliases, candidates)}
