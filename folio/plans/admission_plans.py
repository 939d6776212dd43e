"""Plans for job and fetch admission."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import admission as AD
from folio.plans.registry import W, plan
from folio.plans.sqlbits import d_host, d_page_key, d_slug, d_strip
from folio.sources.tables import (alias_map, completed_set, ignore_set, scan_fetch_meta,
                                  scan_url_queue)

_FEED_BASE = "concat('https://', CASE WHEN instr(author, '.') > 0 THEN author ELSE concat(author, '.substack.com') END, '/feed')"

_ADM = W("fx_docs", "fx_jobs", "fx_feed_entries", "fx_completed", "fx_aliases", "fx_queue", "fx_meta",
         "fx_ignored") + f"""
S4 AS (SELECT job_id, 'urls' AS kind, CAST(p - 1 AS INT) AS pos, u AS url, CAST(NULL AS VARCHAR) AS error
       FROM fx_jobs, UNNEST(urls) WITH ORDINALITY AS t(u, p) WHERE urls IS NOT NULL
       UNION ALL SELECT job_id, 'author', NULL, {_FEED_BASE}, NULL FROM fx_jobs WHERE urls IS NULL AND author IS NOT NULL
       UNION ALL SELECT job_id, 'unknown', NULL, NULL, 'Unknown job type in job-spec' FROM fx_jobs
                 WHERE urls IS NULL AND author IS NULL),
EN AS (SELECT concat('https://', host, '/feed?page=', CAST(pg AS VARCHAR)) AS feed_url, fk AS kind,
         CAST(row_number() OVER (PARTITION BY host, pg ORDER BY doc_id) - 1 AS INT) AS pos,
         concat('https://', host, '/p/', slug) AS link,
         CASE WHEN fk = 'atom' AND doc_id % 2 = 0 THEN upd ELSE pub END AS published_date,
         CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CAST(doc_id AS VARCHAR) END AS post_id,
         CAST(NULL AS VARCHAR) AS error, concat('https://', host, '/feed') AS fb
       FROM fx_feed_entries WHERE fk IN ('atom', 'rss')),
ER AS (SELECT DISTINCT concat('https://', host, '/feed?page=', CAST(pg AS VARCHAR)) AS feed_url, 'error' AS kind,
         CAST(NULL AS INT) AS pos, CAST(NULL AS VARCHAR) AS link, CAST(NULL AS VARCHAR) AS published_date,
         CAST(NULL AS VARCHAR) AS post_id,
         CASE WHEN fk = 'malformed' THEN 'malformed XML' ELSE 'Unknown feed type for root tag: html' END AS error
       FROM fx_feed_entries WHERE fk IN ('malformed', 'unknown')),
AJ AS (SELECT job_id, {_FEED_BASE} AS fb, struct_extract(date_range, 'start') AS rs,
         struct_extract(date_range, 'end') AS re FROM fx_jobs WHERE urls IS NULL AND author IS NOT NULL),
F1 AS (SELECT AJ.job_id, EN.feed_url, EN.pos, EN.link, EN.published_date, EN.post_id FROM EN JOIN AJ ON EN.fb = AJ.fb
       WHERE (rs IS NULL OR published_date >= rs) AND (re IS NULL OR published_date <= re)),
C AS (SELECT job_id, pos, url AS link, CAST(NULL AS VARCHAR) AS post_id FROM S4 WHERE kind = 'urls'
      UNION ALL SELECT job_id, pos, link, post_id FROM F1),
D AS (SELECT DISTINCT post_id FROM fx_completed WHERE post_id IS NOT NULL AND {d_strip('post_id')} <> ''),
N AS (SELECT * FROM C WHERE (post_id IS NULL OR post_id NOT IN (SELECT post_id FROM D))
        AND ({d_slug('link')} IS NULL OR {d_slug('link')} NOT IN (SELECT post_id FROM D))),
AM AS (SELECT url, arg_max(post_id, seq) AS post_id FROM fx_aliases WHERE url IS NOT NULL GROUP BY url),
IG AS (SELECT DISTINCT {d_strip('line')} AS domain FROM fx_ignored
       WHERE {d_strip('line')} <> '' AND NOT starts_with({d_strip('line')}, '#')),
QU AS (SELECT list_name, pos, url, state FROM fx_queue WHERE url IS NOT NULL AND {d_strip('url')} <> '')
"""


def _entries(fx):
    return AD.feed_entries(fx["fx_feeds"])


@plan("scan_url_queue", _ADM + "SELECT list_name, pos, url, state FROM QU WHERE state IN ('pending', 'done')")
def scan_url_queue_q(fx):
    """S3: pending + done URL lists, blank lines dropped."""
    return scan_url_queue(fx["fx_queue"])


@plan("expand_job_specs", _ADM + "SELECT job_id, kind, pos, url, error FROM S4")
def expand_job_specs_q(fx):
    """S4."""
    return AD.expand_job_specs(fx["fx_jobs"])


@plan("feed_entries", _ADM + "SELECT feed_url, kind, pos, link, published_date, post_id, error FROM EN "
      "UNION ALL SELECT * FROM ER")
def feed_entries_q(fx):
    """Atom and RSS entries; malformed documents and unknown roots as error rows."""
    return _entries(fx)


@plan("completed_set", _ADM + "SELECT post_id FROM D")
def completed_set_q(fx):
    """S6."""
    return completed_set(fx["fx_completed"])


@plan("alias_map", _ADM + "SELECT url, post_id FROM AM")
def alias_map_q(fx):
    """S7."""
    return alias_map(fx["fx_aliases"])


@plan("last_write_wins", W("fx_queue") + f"x AS (SELECT 1) SELECT {d_page_key('url')} AS page_key, "
      "arg_max(url, (list_name, pos)) AS url FROM fx_queue WHERE state = 'done' AND url IS NOT NULL "
      f"AND {d_strip('url')} <> '' AND {d_page_key('url')} IS NOT NULL GROUP BY 1")
def last_write_wins_q(fx):
    """A3: file name -> original URL from the done lists, later lines win."""
    from folio.operators.maintenance import url_by_page_key
    return url_by_page_key(fx["fx_queue"])


@plan("feed_date_range", _ADM + "SELECT job_id, feed_url, pos, link, published_date, post_id FROM F1")
def feed_date_range_q(fx):
    """author-job entries inside the job's date range."""
    return AD.author_candidates(fx["fx_jobs"], _entries(fx))


@plan("job_new_articles", _ADM + "SELECT job_id, pos, link, post_id FROM N")
def job_new_articles_q(fx):
    """Candidates not yet complete (null ids kept)."""
    return AD.new_articles(AD.job_candidates(fx["fx_jobs"], _entries(fx)), fx["fx_completed"])


@plan("stage_counts", _ADM + """, CC AS (SELECT job_id, CAST(count(*) AS BIGINT) AS n FROM C GROUP BY job_id),
NN AS (SELECT job_id, CAST(count(*) AS BIGINT) AS n FROM N GROUP BY job_id)
SELECT CC.job_id, CC.n AS n_candidates, CAST(CC.n - coalesce(NN.n, 0) AS BIGINT) AS n_completed,
  CAST(coalesce(NN.n, 0) AS BIGINT) AS n_new FROM CC LEFT JOIN NN ON CC.job_id = NN.job_id""")
def stage_counts_q(fx):
    """A4."""
    return AD.stage_counts(AD.job_candidates(fx["fx_jobs"], _entries(fx)), fx["fx_completed"])


@plan("write_url_queue", _ADM + "SELECT job_id AS list_name, CAST(pos AS BIGINT) AS pos, link AS url, "
      "'pending' AS state FROM N")
def write_url_queue_q(fx):
    """K8: new URLs handed to the fetch stage as pending lines."""
    return AD.write_url_queue(AD.new_articles(AD.job_candidates(fx["fx_jobs"], _entries(fx)), fx["fx_completed"]))


@plan("resolve_url_to_id", _ADM + "SELECT QU.url, AM.post_id, QU.list_name, QU.pos FROM QU JOIN AM ON QU.url = AM.url "
      "WHERE QU.state IN ('pending', 'done') AND AM.post_id IN (SELECT post_id FROM D)")
def resolve_url_to_id_q(fx):
    """Queued URL -> id -> completed (raw URL equality)."""
    q = scan_url_queue(fx["fx_queue"])
    return AD.resolve_url_to_id(q, fx["fx_aliases"], fx["fx_completed"]).select("url", "post_id", "list_name", "pos")


@plan("fetch_admission", _ADM + f""",
Q AS (SELECT list_name, pos, url, {d_page_key('url')} AS page_key, {d_host('url')} AS h FROM QU WHERE state = 'pending'),
ST AS (SELECT DISTINCT regexp_replace(meta_file, '\\.html\\.meta\\.json$', '') AS k FROM fx_meta),
CU AS (SELECT DISTINCT url FROM AM WHERE post_id IN (SELECT post_id FROM D)),
R AS (SELECT *, CASE WHEN page_key IS NULL THEN 'malformed' WHEN page_key IN (SELECT k FROM ST) THEN 'exists'
        WHEN url IN (SELECT url FROM CU) THEN 'completed' WHEN h IN (SELECT domain FROM IG) THEN 'ignored'
        ELSE 'admit' END AS r0 FROM Q),
R2 AS (SELECT *, CASE WHEN r0 = 'admit' THEN row_number() OVER (PARTITION BY page_key, r0 ORDER BY list_name, pos, url) END AS rn FROM R)
SELECT list_name, pos, url, page_key, CASE WHEN r0 = 'admit' AND rn > 1 THEN 'exists' ELSE r0 END AS reason FROM R2""")
def fetch_admission_q(fx):
    """Why each pending URL is or is not fetched."""
    q = scan_url_queue(fx["fx_queue"], ("pending",))
    stored = scan_fetch_meta(fx["fx_meta"]).select("page_key")
    return AD.fetch_admission(q, stored, fx["fx_aliases"], fx["fx_completed"], ignore_set(fx["fx_ignored"]))


FETCH_TS = "2025-06-20T00:00:00Z"


@plan("ingest_pages", W("fx_pages") + f"x AS (SELECT 1) SELECT {d_page_key('source_url')} AS page_key, source_url, "
      f"CAST(json_object('source-url', source_url, 'fetch-timestamp', '{FETCH_TS}') AS VARCHAR) AS meta_json, "
      "html, CASE WHEN doc_id % 13 = 0 THEN 'retry' ELSE 'store' END AS action FROM fx_pages")
def ingest_pages_q(fx):
    """K9: crawl results -> stored page + metadata, short error pages -> retry."""
    crawled = fx["fx_pages"].select(F.col("source_url").alias("url"), "html")
    return AD.ingest_pages(crawled, FETCH_TS)


@plan("ingest_repeats", W("fx_odd_pages") + """c AS (SELECT * FROM fx_odd_pages UNION ALL SELECT * FROM fx_odd_pages WHERE kind IN ('b', 'home', 'none')),
k AS (SELECT source_url, CASE WHEN kind IN ('malformed', 'none') THEN NULL WHEN kind = 'home' THEN '_' ELSE concat('post-', CAST(doc_id AS VARCHAR)) END AS page_key FROM c)
SELECT source_url, page_key, CASE WHEN page_key IS NULL THEN 'malformed'
  WHEN row_number() OVER (PARTITION BY page_key ORDER BY source_url) = 1 THEN 'store' ELSE 'exists' END AS action FROM k""")
def ingest_repeats_q(fx):
    """K9 on a crawl with repeated rows, shared keys and malformed URLs: one page is stored a key."""
    odd = fx["fx_odd_pages"]
    crawled = odd.unionByName(odd.filter(F.col("kind").isin("b", "home", "none"))).select(F.col("source_url").alias("url"), "html")
    return AD.ingest_pages(crawled, FETCH_TS).select("source_url", "page_key", "action")
