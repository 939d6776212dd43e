"""Plans for the documented-only operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio import functions as U
from folio.operators import articles as A
from folio.operators import curation as C
from folio.operators.admission import feed_entries
from folio.operators.html_pass import html_pass
from folio.plans.admission_plans import _ADM
from folio.plans.index_plans import _IDX
from folio.plans.maintenance_plans import _MT
from folio.plans.parse_plans import _PARSE
from folio.plans.registry import plan
from folio.sources.tables import scan_markdown, scan_pages


def _stage(fx):
    return A.parse_stage(scan_pages(fx["fx_pages"]), fx["fx_meta"], fx["fx_completed"], parts=())


@plan("x_recent_entries", _ADM + """, OJ AS (SELECT job_id FROM fx_jobs WHERE urls IS NULL AND author IS NOT NULL
  AND date_range IS NULL),
R AS (SELECT F1.*, row_number() OVER (PARTITION BY F1.job_id ORDER BY published_date DESC, link) AS rk
      FROM F1 WHERE job_id IN (SELECT job_id FROM OJ))
SELECT job_id, CAST(rk AS INT) AS rank, link, published_date, post_id FROM R WHERE rk <= 10""")
def x_recent_entries_q(fx):
    """Author job without a date range -> ten most recent entries (salted top-k)."""
    return C.recent_entries(fx["fx_jobs"], feed_entries(fx["fx_feeds"]))


@plan("x_junk_articles", _IDX + """SELECT slug, 'short' AS reason FROM fx_markdown WHERE strlen(md) < 300
UNION ALL SELECT concat('post-', CAST(doc_id AS VARCHAR)), 'unknown_metadata' FROM D
  WHERE doc_id % 97 NOT IN (1, 2) AND doc_id % 8 <> 0 AND doc_id % 17 = 0""")
def x_junk_articles_q(fx):
    """Markdown under 300 bytes, or front matter with an 'unknown' value."""
    return C.junk_articles(scan_markdown(fx["fx_markdown"]))


@plan("x_duplicate_sets", _PARSE + """, R AS (SELECT post_id, page_key, source_url <> coalesce(canonical_url, '') AS nc
  FROM s WHERE status <> 'error' AND post_id IS NOT NULL),
G AS (SELECT post_id, count(*) AS n, arg_min(page_key, (nc, page_key)) AS keep FROM R GROUP BY post_id HAVING count(*) > 1)
SELECT R.post_id, R.page_key, CAST(G.n AS BIGINT) AS n_pages,
  CASE WHEN R.page_key = G.keep THEN 'keep' ELSE 'delete' END AS action FROM R JOIN G ON R.post_id = G.post_id""")
def x_duplicate_sets_q(fx):
    """Post ids stored more than once; keep the canonical-URL page."""
    return C.duplicate_sets(_stage(fx))


@plan("x_slug_collisions", _PARSE + """ SELECT post_id AS slug, CAST(count(DISTINCT host) AS BIGINT) AS n_hosts FROM s
WHERE status <> 'error' AND post_id IS NOT NULL GROUP BY post_id HAVING count(DISTINCT host) > 1""")
def x_slug_collisions_q(fx):
    """One slug claimed by canonical URLs of several hosts."""
    return C.slug_collisions(_stage(fx))


@plan("x_refetch_orphans", _MT + """SELECT m.page_key, 'refetch' AS action, CASE WHEN m.has_src THEN m.msrc END AS url
FROM m WHERE m.page_key NOT IN (SELECT page_key FROM H)
UNION ALL SELECT H.page_key, 'rebuild_meta', CASE WHEN H.doc_id % 13 = 0 OR H.doc_id % 11 = 0 THEN NULL
  ELSE concat('https://', d.host, '/p/', d.slug) END
FROM H JOIN fx_docs d ON d.doc_id = H.doc_id WHERE H.page_key NOT IN (SELECT page_key FROM m)""")
def x_refetch_orphans_q(fx):
    """Metadata without HTML -> re-crawl; HTML without metadata -> rebuild from canonical URL."""
    pages = scan_pages(fx["fx_pages"])
    parsed = html_pass(pages, ["page_key"], parts=("meta",)).select(
        "page_key", F.col("canonical_href").alias("canonical_url"))
    return C.refetch_orphans(pages, fx["fx_meta"], parsed)


@plan("x_clean_body", _PARSE + "SELECT page_key, body_markdown FROM e")
def x_clean_body_q(fx):
    """Body Markdown with share/subscribe/footer furniture removed first."""
    p = html_pass(scan_pages(fx["fx_pages"]), ["page_key"], parts=("body", "clean"))
    return p.select("page_key", U.clean_markdown("body_md").alias("body_markdown"))


@plan("x_feed_jobs", _ADM + """, FJ AS (
SELECT concat('feedjob-', feed_url) AS job_id, feed_url,
  CASE WHEN CAST(regexp_extract(feed_url, 'page=([0-9]+)', 1) AS BIGINT) % 3 = 0
       THEN CASE WHEN kind = 'atom' THEN 'rss' ELSE 'atom' END ELSE kind END AS feed_type
FROM (SELECT DISTINCT feed_url, kind FROM EN) f)
SELECT FJ.job_id, EN.feed_url, EN.pos, EN.link, EN.published_date, EN.post_id, CAST(NULL AS VARCHAR) AS error
FROM FJ JOIN EN ON FJ.feed_url = EN.feed_url WHERE FJ.feed_type = EN.kind
UNION ALL SELECT DISTINCT FJ.job_id, FJ.feed_url, CAST(NULL AS INT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
  CAST(NULL AS VARCHAR), 'feed type does not match the document'
FROM FJ JOIN EN ON FJ.feed_url = EN.feed_url WHERE FJ.feed_type <> EN.kind""")
def x_feed_jobs_q(fx):
    """Jobs of type atom:/rss: naming a feed URL directly."""
    from folio.operators.admission import feed_job_candidates
    return feed_job_candidates(fx["fx_feed_jobs"], feed_entries(fx["fx_feeds"]))
