"""Plans for corpus maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import maintenance as MT
from folio.operators.index import build_article_index
from folio.plans.parse_plans import _M
from folio.plans.registry import W, plan
from folio.plans.sqlbits import d_filename, d_host, d_page_key, d_strip
from folio.sources.tables import ignore_set, scan_markdown, scan_pages

_MT = W("fx_docs", "fx_pages", "fx_meta", "fx_ignored", "fx_aliases", "fx_completed", "fx_queue",
        "fx_markdown") + _M.strip() + f""",
H AS (SELECT doc_id, concat('post-', CAST(doc_id AS VARCHAR)) AS page_key, html FROM fx_pages),
X3 AS (SELECT coalesce(H.page_key, m.page_key) AS page_key,
         CASE WHEN m.page_key IS NULL THEN 'orphaned_html' WHEN H.page_key IS NULL THEN 'orphaned_meta'
              ELSE 'matched' END AS category
       FROM H FULL OUTER JOIN m ON H.page_key = m.page_key),
MM AS (SELECT H.doc_id, H.page_key, H.html, m.ok, m.has_src, m.msrc, d.slug,
         CASE WHEN H.doc_id % 13 = 0 OR H.doc_id % 11 = 0 THEN NULL ELSE d.slug END AS cslug
       FROM H JOIN m ON H.page_key = m.page_key JOIN fx_docs d ON d.doc_id = H.doc_id),
M1 AS (SELECT page_key, category, CAST(NULL AS VARCHAR) AS reason FROM X3 WHERE category <> 'matched'
  UNION ALL SELECT page_key, 'corrupt_html', 'File size is less than 500 bytes' FROM MM WHERE strlen(html) < 500
  UNION ALL SELECT page_key, 'corrupt_html', CASE WHEN instr(html, '502 Bad Gateway') > 0 THEN 'Title contains ''502 Bad Gateway'''
      WHEN instr(html, 'Page not found') > 0 THEN 'Title contains ''Page not found'''
      ELSE 'Content is ''Too Many Requests'' error page' END FROM MM
    WHERE instr(html, '502 Bad Gateway') > 0 OR instr(html, 'Page not found') > 0 OR instr(html, 'Too Many Requests') > 0
  UNION ALL SELECT page_key, 'corrupt_meta', 'JSON parse error' FROM MM WHERE NOT ok
  UNION ALL SELECT page_key, 'corrupt_meta', 'Missing mandatory :source-url key' FROM MM WHERE ok AND NOT has_src
  UNION ALL SELECT page_key, 'mismatched', concat(':source-url implies filename should be ', {d_filename('msrc')}) FROM MM
    WHERE has_src AND {d_filename('msrc')} <> concat(page_key, '.html')
  UNION ALL SELECT page_key, 'mismatched', concat('Filename is ''', page_key, ''' but canonical slug in HTML is ''', cslug, '''')
    FROM MM WHERE cslug IS NOT NULL AND cslug <> page_key),
IG AS (SELECT DISTINCT {d_strip('line')} AS domain FROM fx_ignored
       WHERE {d_strip('line')} <> '' AND NOT starts_with({d_strip('line')}, '#')),
PC AS (SELECT page_key AS slug, msrc AS source_url, concat('work/metadata/', meta_file) AS meta_path,
         concat('work/html/', page_key, '.html') AS html_path, concat('work/processed/', page_key, '.md') AS md_path
       FROM m WHERE has_src AND msrc IS NOT NULL AND {d_host('msrc')} IN (SELECT domain FROM IG)),
AM AS (SELECT url, arg_max(post_id, seq) AS post_id FROM fx_aliases WHERE url IS NOT NULL GROUP BY url),
D AS (SELECT DISTINCT post_id FROM fx_completed WHERE post_id IS NOT NULL AND {d_strip('post_id')} <> ''),
LW AS (SELECT {d_page_key('url')} AS page_key, arg_max(url, (list_name, pos)) AS url FROM fx_queue
       WHERE state = 'done' AND url IS NOT NULL AND {d_strip('url')} <> '' AND {d_page_key('url')} IS NOT NULL GROUP BY 1)
"""


def _pages(fx):
    return scan_pages(fx["fx_pages"])


def _candidates(fx):
    return MT.prune_candidates(fx["fx_meta"], ignore_set(fx["fx_ignored"]))


@plan("orphans", _MT + "SELECT page_key, category FROM X3")
def orphans_q(fx):
    """Html-only, meta-only and matched page keys."""
    return MT.orphans(_pages(fx), fx["fx_meta"])


@plan("verify_integrity", _MT + "SELECT page_key, category, reason FROM M1")
def verify_integrity_q(fx):
    """M1: one finding per problem."""
    return MT.verify_integrity(_pages(fx), fx["fx_meta"])


@plan("integrity_summary", _MT + """SELECT 'html_files' AS metric, CAST(count(DISTINCT page_key) AS BIGINT) AS n FROM H
UNION ALL SELECT 'meta_files', CAST(count(DISTINCT page_key) AS BIGINT) FROM m
UNION ALL SELECT category, CAST(count(*) AS BIGINT) FROM M1 GROUP BY category""")
def integrity_summary_q(fx):
    """A5."""
    findings = MT.verify_integrity(_pages(fx), fx["fx_meta"])
    return MT.integrity_summary(_pages(fx), fx["fx_meta"], findings)


@plan("short_pages", _MT + "SELECT page_key FROM H WHERE doc_id % 13 = 0")
def short_pages_q(fx):
    """F6."""
    return MT.short_pages(_pages(fx))


@plan("recover_short_pages", _MT + "SELECT LW.url, H.page_key FROM H JOIN LW ON H.page_key = LW.page_key "
      "WHERE H.doc_id % 13 = 0")
def recover_short_pages_q(fx):
    """Short pages -> original URLs (last wins), sorted."""
    return MT.recover_short_pages(_pages(fx), fx["fx_queue"])


@plan("prune_candidates_filter", _MT + "SELECT slug, source_url FROM PC")
def prune_candidates_filter_q(fx):
    """F8: metadata whose source host is ignored (exact)."""
    return _candidates(fx).select("slug", "source_url")


@plan("prune_candidates", _MT + "SELECT slug, source_url, meta_path, html_path, md_path FROM PC")
def prune_candidates_q(fx):
    """Candidates with their three artefact paths."""
    c = _candidates(fx)
    return c.select("slug", "source_url", F.col("files_to_delete")[0].alias("meta_path"),
                    F.col("files_to_delete")[1].alias("html_path"), F.col("files_to_delete")[2].alias("md_path"))


@plan("prune_plan", _MT + """SELECT slug, source_url, 0 AS pos, meta_path AS path FROM PC
UNION ALL SELECT slug, source_url, 1, html_path FROM PC UNION ALL SELECT slug, source_url, 2, md_path FROM PC""")
def prune_plan_q(fx):
    """M3: dry-run listing."""
    return MT.prune_plan(_candidates(fx))


@plan("prune_aliases", _MT + "SELECT url, post_id FROM AM WHERE post_id NOT IN (SELECT slug FROM PC)")
def prune_aliases_q(fx):
    """J8."""
    return MT.prune_aliases(fx["fx_aliases"], _candidates(fx))


@plan("prune_completed", _MT + "SELECT post_id FROM D WHERE post_id NOT IN (SELECT slug FROM PC)")
def prune_completed_q(fx):
    """X4."""
    return MT.prune_completed(fx["fx_completed"], _candidates(fx))


@plan("pruned_counts", _MT + """SELECT 'condemned_ids' AS metric, CAST(count(DISTINCT slug) AS BIGINT) AS n FROM PC
UNION ALL SELECT 'alias_entries_removed', CAST(count(*) AS BIGINT) FROM AM WHERE post_id IN (SELECT slug FROM PC)""")
def pruned_counts_q(fx):
    """A6."""
    return MT.pruned_counts(fx["fx_aliases"], _candidates(fx))


@plan("prune_apply", _MT + f"""SELECT 'completed' AS tbl, post_id AS k, CAST(NULL AS VARCHAR) AS v FROM D
  WHERE post_id NOT IN (SELECT slug FROM PC)
UNION ALL SELECT 'aliases', url, post_id FROM AM WHERE post_id NOT IN (SELECT slug FROM PC)
UNION ALL SELECT 'articles', concat('post-', CAST(doc_id AS VARCHAR)), NULL FROM fx_docs
  WHERE doc_id % 97 NOT IN (1, 2) AND doc_id % 8 <> 0
    AND concat('post-', CAST(doc_id AS VARCHAR)) NOT IN (SELECT slug FROM PC)""")
def prune_apply_q(fx):
    """M4 (force): new versions of the index, ledger and alias tables."""
    idx = build_article_index(scan_markdown(fx["fx_markdown"]))
    out = MT.prune_apply(idx, fx["fx_completed"], fx["fx_aliases"], _candidates(fx), force=True)
    return (out["completed"].select(F.lit("completed").alias("tbl"), F.col("post_id").alias("k"),
                                    F.lit(None).cast("string").alias("v"))
            .unionByName(out["aliases"].select(F.lit("aliases").alias("tbl"), F.col("url").alias("k"),
                                               F.col("post_id").alias("v")))
            .unionByName(out["articles"].select(F.lit("articles").alias("tbl"), F.col("slug").alias("k"),
                                                F.lit(None).cast("string").alias("v"))))
