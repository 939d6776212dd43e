"""Plans over fixtures in which every case of an operator occurs: all reasons of admission
(J3), several images an article (E5, K5), all error texts (U14), page furniture (x_clean_body),
odd metadata (M1), and the order of a sorted set as a column (O1).

The oracles say what is expected from the kind of a fixture row, not by the operator's rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio import functions as U
from folio.operators import admission as AD
from folio.operators import articles as A
from folio.operators import discovery as D
from folio.operators import maintenance as MT
from folio.operators.html_pass import html_pass
from folio.plans.discovery_plans import _LINKS
from folio.plans.registry import W, plan
from folio.plans.sqlbits import d_clean_md
from folio.sources.tables import ignore_set, scan_fetch_meta, scan_pages, scan_url_queue


@plan("fetch_admission_reasons", W("fx_admission") + """k AS (SELECT *, CAST(doc_id AS VARCHAR) AS n FROM fx_admission WHERE kind <> 'i_blank')
SELECT list_name, pos, url, CASE kind WHEN 'a_moved' THEN concat('moved-', n) WHEN 'b_gone' THEN concat('gone-', n) WHEN 'c_ignored' THEN concat('ad-', n)
    WHEN 'g_stored' THEN concat('post-', n) WHEN 'h_malformed' THEN NULL ELSE concat('rep-', n) END AS page_key,
  CASE kind WHEN 'a_moved' THEN CASE WHEN doc_id % 10 = 0 THEN 'completed' ELSE 'admit' END WHEN 'b_gone' THEN CASE WHEN doc_id % 30 = 0 THEN 'completed' ELSE 'ignored' END
    WHEN 'c_ignored' THEN 'ignored' WHEN 'd_first' THEN 'admit' WHEN 'g_stored' THEN CASE WHEN doc_id % 23 = 0 THEN 'admit' ELSE 'exists' END
    WHEN 'h_malformed' THEN 'malformed' ELSE 'exists' END AS reason FROM k""")
def fetch_admission_reasons_q(fx):
    """J3 with every reason, also where two of them hold: completed goes before ignored,
    stored before both, and of one page key on two hosts or lists the first line is admitted."""
    aliases = fx["fx_aliases"].select("url", "post_id", "seq").unionByName(fx["fx_moved_aliases"])
    queue = scan_url_queue(fx["fx_admission"], ("pending",))
    return AD.fetch_admission(queue, scan_fetch_meta(fx["fx_meta"]).select("page_key"), aliases, fx["fx_completed"], ignore_set(fx["fx_ignored"]))


_GALLERY = W("fx_gallery") + """g AS (SELECT *, CAST(doc_id AS VARCHAR) AS n FROM fx_gallery),
refs AS (
  SELECT concat('pic-', n) AS article_key, CAST(0 AS INT) AS pos, concat('https://img.example.org/g/', n, '-a.png') AS image_source_url,
    concat('img.example.org/g/', n, '-a.png') AS image_path, concat('Alt A ', n) AS alt, concat('Title ', n) AS title, concat('Cap A ', n) AS caption FROM g
  UNION ALL SELECT concat('pic-', n), 1, concat('https://cdn.example.com/image/w_10/https%3A%2F%2Fimages.example.net%2Fg%2F', n, '-b.jpg'),
    concat('images.example.net/g/', n, '-b.jpg'), '', '', '' FROM g WHERE doc_id % 2 = 0
  UNION ALL SELECT concat('pic-', n), CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END, 'https://img.example.org/shared.png?w=1#f', 'img.example.org/shared.png', 'Shared', '', '' FROM g)
"""


def _gallery(fx):
    g = fx["fx_gallery"]
    stage = A.parse_stage(scan_pages(g), g.select("meta_file", "raw_json"), fx["fx_completed"], ("images",))
    return A.image_refs(stage)


@plan("image_refs_many", _GALLERY + "SELECT * FROM refs")
def image_refs_many_q(fx):
    """E5 on several figures a page: positions count the usable images in page order."""
    return _gallery(fx)


@plan("image_manifest_shared", _GALLERY + """SELECT image_path, CAST(count(*) AS BIGINT) AS n_refs, CAST(count(DISTINCT article_key) AS BIGINT) AS n_articles,
  min(article_key) AS first_article_key, min(image_source_url) AS first_source_url FROM refs GROUP BY image_path""")
def image_manifest_shared_q(fx):
    """K5 with an image that every article holds (a hot path: counts only, no lists)."""
    return A.image_assets(_gallery(fx))


@plan("content_corruption_markers", W("fx_marked") + """x AS (SELECT 1) SELECT doc_id, CASE WHEN doc_id % 11 = 5 THEN NULL
  WHEN doc_id % 5 = 1 THEN 'Title contains ''502 Bad Gateway''' WHEN doc_id % 3 = 1 THEN 'Title contains ''Page not found'''
  WHEN doc_id % 2 = 1 THEN 'Content is ''Too Many Requests'' error page' END AS reason FROM fx_marked""")
def content_corruption_markers_q(fx):
    """U14 with all three error texts, alone and together: the rules' order decides, not the
    place in the page; other case is no error text."""
    return fx["fx_marked"].select("doc_id", U.content_corruption_reason("html").alias("reason"))


_FURNISHED = d_clean_md("concat('## Head ', CAST(doc_id AS VARCHAR), chr(10), 'Start', chr(10), 'Middle *', CAST(doc_id AS VARCHAR), '*', chr(10), 'Stays', chr(10), body)")


@plan("x_clean_body_furniture", W("fx_furnished") + f"x AS (SELECT 1) SELECT concat('furnished-', CAST(doc_id AS VARCHAR)) AS page_key, {_FURNISHED} AS body_markdown FROM fx_furnished")
def x_clean_body_furniture_q(fx):
    """Bodies that hold share, subscribe and footer elements: those go with all they hold, names
    that only begin alike stay."""
    p = html_pass(scan_pages(fx["fx_furnished"]), ["page_key"], parts=("body", "clean"))
    return p.select("page_key", U.clean_markdown("body_md").alias("body_markdown"))


@plan("verify_integrity_odd", W("fx_noted") + """k AS (SELECT *, concat('note-', n) AS page_key, doc_id % 6 AS c FROM fx_noted)
SELECT page_key, 'orphaned_html' AS category, CAST(NULL AS VARCHAR) AS reason FROM k WHERE c = 5
UNION ALL SELECT page_key, 'corrupt_html', 'File size is less than 500 bytes' FROM k WHERE c <> 5 AND doc_id % 9 = 7
UNION ALL SELECT page_key, 'corrupt_meta', 'Missing mandatory :source-url key' FROM k WHERE c = 0
UNION ALL SELECT page_key, 'mismatched', 'Malformed :source-url' FROM k WHERE c = 1
UNION ALL SELECT page_key, 'mismatched', concat(':source-url implies filename should be other-', n, '.html') FROM k WHERE c = 3
UNION ALL SELECT page_key, 'corrupt_meta', 'JSON parse error' FROM k WHERE c = 4
UNION ALL SELECT page_key, 'mismatched', concat('Filename is ''', page_key, ''' but canonical slug in HTML is ''canon-', n, '''') FROM k WHERE c <> 5 AND doc_id % 4 = 1""")
def verify_integrity_odd_q(fx):
    """M1 on null, malformed and foreign source URLs, broken JSON and missing metadata."""
    n = fx["fx_noted"]
    meta = n.filter(F.col("raw_json").isNotNull()).select(F.concat(F.lit("note-"), "n", F.lit(".html.meta.json")).alias("meta_file"), "raw_json")
    return MT.verify_integrity(scan_pages(n), meta)


@plan("sorted_urls_ranked", _LINKS + "SELECT CAST(row_number() OVER (ORDER BY url) - 1 AS BIGINT) AS rank, url FROM KU")
def sorted_urls_ranked_q(fx):
    """O1 with the place in the order as a column, so that the order itself is compared."""
    return D.ranked(D.known_urls(fx["fx_aliases"], fx["fx_queue"]), "url")
