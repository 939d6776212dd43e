"""Plans for the parse stage.

Oracles derive the expected article fields from ``fx_docs`` columns and the
fixture rules (which pages lack a canonical link, JSON-LD, ...), never from the
HTML text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from folio import functions as U
from folio.operators import articles as A
from folio.operators.html_pass import html_pass
from folio.plans.registry import W, plan
from folio.plans.sqlbits import d_clean_md, d_page_key
from folio.session import materialize, scratch_path
from folio.sources.tables import ignore_set, scan_fetch_meta, scan_pages

# --- oracle building blocks --------------------------------------------------
_M = """
m AS (SELECT regexp_replace(meta_file, '\\.html\\.meta\\.json$', '') AS page_key, json_valid(raw_json) AS ok,
        CASE WHEN json_valid(raw_json) THEN list_contains(json_keys(raw_json), 'source-url') ELSE false END AS has_src,
        CASE WHEN json_valid(raw_json) THEN list_contains(json_keys(raw_json), 'fetch-timestamp') ELSE false END AS has_ts,
        CASE WHEN json_valid(raw_json) THEN json_extract_string(raw_json, '$."source-url"') END AS msrc,
        CASE WHEN json_valid(raw_json) THEN json_extract_string(raw_json, '$."fetch-timestamp"') END AS mts,
        meta_file
      FROM fx_meta)"""

_BODY_RAW = """concat(chr(10), '## Part ', CAST(doc_id AS VARCHAR), chr(10), chr(10), body, chr(10), chr(10),
  'See [next](https://author', CAST(doc_id % 7 AS VARCHAR), '.substack.com/p/post-', CAST(doc_id * 7 % 1500 AS VARCHAR),
  '?ref=x) and **more**.', chr(10), chr(10), '![Alt ', CAST(doc_id % 50 AS VARCHAR), '](img.example.org/a/',
  CAST(doc_id % 50 AS VARCHAR), '.png "")', chr(10), '*Cap ', CAST(doc_id AS VARCHAR), '*', chr(10), chr(10),
  '> ', chr(10), '> Quote', chr(10), '> ', chr(10), chr(10), '* one', chr(10), '* two', chr(10))"""

# Expected raw E1/E2 fields of every fixture page.
_E = """
e AS (SELECT doc_id, concat('post-', CAST(doc_id AS VARCHAR)) AS page_key, host, slug, pub, body,
        CASE WHEN doc_id % 13 = 0 OR doc_id % 11 = 0 THEN NULL ELSE slug END AS post_id,
        CASE WHEN doc_id % 13 = 0 OR doc_id % 11 = 0 THEN NULL ELSE concat('https://', host, '/p/', slug) END AS canonical_url,
        CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN concat('Head ', CAST(doc_id AS VARCHAR))
             ELSE concat('Doc ', CAST(doc_id AS VARCHAR)) END AS title,
        CASE WHEN doc_id % 13 = 0 THEN 'unknown' WHEN doc_id % 2 = 0 THEN concat('Author ', CAST(doc_id % 9 AS VARCHAR))
             WHEN doc_id % 7 = 0 THEN 'unknown' ELSE concat('Writer ', CAST(doc_id % 7 AS VARCHAR)) END AS author,
        CASE WHEN doc_id % 13 = 0 THEN NULL ELSE pub END AS publication_date,
        CASE WHEN doc_id % 13 = 0 THEN 'body' WHEN doc_id % 5 = 0 THEN 'article' ELSE 'div.body.markup' END AS body_kind,
        CAST(CASE WHEN doc_id % 13 = 0 THEN 0 ELSE 1 END AS INT) AS n_images,
        CASE WHEN doc_id % 13 = 0 THEN 'Too Many Requests' ELSE """ + d_clean_md(_BODY_RAW) + """ END AS body_markdown
      FROM fx_docs)"""

# Expected parse-stage rows (E8 with J1, J5, V5, U11, U12).
_S = """
j AS (SELECT e.*, m.page_key IS NOT NULL AS has_meta, coalesce(m.ok, false) AS ok, coalesce(m.has_src, false) AS has_src,
        coalesce(m.has_ts, false) AS has_ts, m.msrc, m.mts
      FROM e LEFT JOIN m ON m.page_key = e.page_key),
s0 AS (SELECT *, CASE WHEN NOT has_meta THEN 'missing metadata' WHEN NOT ok THEN 'invalid metadata JSON' END AS error,
         coalesce(title, 'Untitled') AS title_d, coalesce(publication_date, 'unknown') AS pub_d,
         CASE WHEN has_src THEN msrc ELSE 'unknown' END AS source_url, mts AS fetch_timestamp
       FROM j),
s1 AS (SELECT *, coalesce(post_id, concat('unknown-article_', md5(CASE WHEN has_src AND msrc IS NOT NULL THEN msrc ELSE page_key END))) AS article_key,
         EXISTS (SELECT 1 FROM fx_completed c WHERE c.post_id = s0.post_id) AS in_ledger,
         CASE WHEN error IS NULL AND post_id IS NOT NULL THEN row_number() OVER (
           PARTITION BY (error IS NULL), post_id ORDER BY coalesce(fetch_timestamp, ''), coalesce(source_url, ''), page_key) END AS rn
       FROM s0),
s AS (SELECT *, CASE WHEN error IS NOT NULL THEN 'error' WHEN in_ledger OR coalesce(rn, 1) > 1 THEN 'duplicate'
                     ELSE 'compiled' END AS status,
        concat('---', chr(10), 'title: ', title_d, chr(10), 'author: ', author, chr(10),
          'publication-date: ', CASE WHEN pub_d = 'unknown' THEN 'unknown' ELSE concat('''', pub_d, '''') END, chr(10),
          'source-url: ', source_url, chr(10), 'canonical-url: ', coalesce(canonical_url, 'null'), chr(10),
          CASE WHEN has_ts THEN concat('fetch-timestamp: ''', fetch_timestamp, '''', chr(10)) ELSE '' END,
          'post-id: ', coalesce(post_id, 'null'), chr(10), 'article-key: ', article_key, chr(10), '---', chr(10), chr(10)) AS front_matter
      FROM s1)
"""
_PARSE = W("fx_docs", "fx_meta", "fx_completed") + _M + "," + _E + "," + _S


def _stage(fx, *parts):
    """The parse stage with the wide parts that the caller reads (none: decisions only)."""
    return A.parse_stage(scan_pages(fx["fx_pages"]), fx["fx_meta"], fx["fx_completed"], parts)


# --- sources -------------------------------------------------------------------
@plan("scan_pages", W("fx_docs") + f"x AS (SELECT 1) SELECT {d_page_key('url')} AS page_key, url AS source_url, "
      "CAST(length(html) AS BIGINT) AS n_chars FROM pages")
def scan_pages_q(fx):
    """S1 over the generated pages table."""
    return scan_pages(fx["pages"], url_col="url").select(
        "page_key", "source_url", F.length("html").cast("bigint").alias("n_chars"))


@plan("scan_fetch_meta", W("fx_meta") + _M.strip() + " SELECT page_key, meta_file, ok AS meta_valid, "
      "has_src AS has_source_url, has_ts AS has_fetch_ts, msrc AS meta_source_url, mts AS fetch_timestamp FROM m")
def scan_fetch_meta_q(fx):
    """S2."""
    return scan_fetch_meta(fx["fx_meta"])


# --- HTML-derived fields -------------------------------------------------------
@plan("extract_metadata", _PARSE + "SELECT page_key, title, author, publication_date, canonical_url, "
      "post_id AS canonical_slug FROM e")
def extract_metadata_q(fx):
    """E1 (+O2): raw metadata of every page, before defaults."""
    p = A.extract_metadata(A.parsed_pages(scan_pages(fx["fx_pages"]), parts=("meta",)))
    return p.select("page_key", "title", "author", "publication_date", "canonical_url", "canonical_slug")


@plan("select_body", _PARSE + "SELECT page_key, body_kind FROM e")
def select_body_q(fx):
    """E2."""
    return A.parsed_pages(scan_pages(fx["fx_pages"]), parts=("body",)).select("page_key", "body_kind")


@plan("extract_links", _PARSE + "SELECT page_key AS source_key, 0 AS pos, concat('https://author', "
      "CAST(doc_id % 7 AS VARCHAR), '.substack.com/p/post-', CAST(doc_id * 7 % 1500 AS VARCHAR), '?ref=x') AS href, "
      "'next' AS link_text FROM e WHERE doc_id % 13 <> 0")
def extract_links_q(fx):
    """Every anchor with an href in the whole page, in document order."""
    from folio.operators.discovery import extract_links
    return extract_links(scan_pages(fx["fx_pages"]))


@plan("html_to_markdown", _PARSE + "SELECT page_key, body_markdown FROM e")
def html_to_markdown_q(fx):
    """E4 (with the E7 blank-line cleanup, without front matter)."""
    p = A.parsed_pages(scan_pages(fx["fx_pages"]), parts=("body",))
    return p.select("page_key", U.clean_markdown("body_md").alias("body_markdown"))


_IMG_ORACLE = _PARSE + """SELECT article_key, CAST(0 AS INT) AS pos,
  concat('https://img.example.org/a/', CAST(doc_id % 50 AS VARCHAR), '.png?w=10') AS image_source_url,
  concat('img.example.org/a/', CAST(doc_id % 50 AS VARCHAR), '.png') AS image_path,
  concat('Alt ', CAST(doc_id % 50 AS VARCHAR)) AS alt, '' AS title, concat('Cap ', CAST(doc_id AS VARCHAR)) AS caption
FROM s WHERE status = 'compiled' AND doc_id % 13 <> 0"""


@plan("image_refs", _IMG_ORACLE)
def image_refs_q(fx):
    """E5: image records of compiled articles."""
    return A.image_refs(_stage(fx, "images"))


@plan("front_matter", _PARSE + "SELECT page_key, article_key, front_matter FROM s WHERE status <> 'error'")
def front_matter_q(fx):
    """E6."""
    return _stage(fx).filter(F.col("status") != "error").select("page_key", "article_key", "front_matter")


@plan("compile_article", _PARSE + "SELECT page_key, concat(front_matter, body_markdown) AS markdown "
      "FROM s WHERE status = 'compiled'")
def compile_article_q(fx):
    """Front matter + cleaned Markdown of the compiled articles."""
    return _stage(fx, "body").filter(F.col("status") == "compiled").select("page_key", "markdown")


@plan("extract_articles", _PARSE + """SELECT page_key, article_key, post_id, title_d AS title, author,
  pub_d AS publication_date, source_url, canonical_url, fetch_timestamp, status, body_kind, n_images,
  CASE WHEN status = 'compiled' THEN concat(front_matter, body_markdown) END AS markdown
FROM s WHERE status <> 'error'""")
def extract_articles_q(fx):
    """E8 (flagship): the whole parse stage over pages + metadata + ledger."""
    return A.extract_articles(scan_pages(fx["fx_pages"]), fx["fx_meta"], fx["fx_completed"])


@plan("article_defaults", _PARSE + "SELECT page_key, title_d AS title, author, pub_d AS publication_date, "
      "source_url FROM s WHERE status <> 'error'")
def article_defaults_q(fx):
    """Defaults applied, fetch metadata overriding parsed fields."""
    return _stage(fx).filter(F.col("status") != "error") \
        .select("page_key", "title", "author", "publication_date", "source_url")


@plan("short_error_page", _PARSE + "SELECT page_key, doc_id % 13 = 0 AS is_short FROM e")
def short_error_page_q(fx):
    """Short page whose whole body text is the rate-limit phrase."""
    p = html_pass(scan_pages(fx["fx_pages"]), ["page_key"], parts=("short_body_text",), keep_html=True)
    return p.select("page_key", U.is_short_error_page("html", "short_body_text").alias("is_short"))


# --- joins, ledger, sinks ----------------------------------------------------------
@plan("pages_with_meta", W("fx_docs", "fx_meta") + _M.strip() + """
SELECT concat('post-', CAST(d.doc_id AS VARCHAR)) AS page_key,
  CASE WHEN m.page_key IS NULL THEN 'missing' WHEN NOT m.ok THEN 'invalid' ELSE 'ok' END AS meta_status,
  m.msrc AS meta_source_url
FROM fx_docs d LEFT JOIN m ON m.page_key = concat('post-', CAST(d.doc_id AS VARCHAR))""")
def pages_with_meta_q(fx):
    """Every page with its metadata status; missing/invalid go to quarantine."""
    from folio.operators.articles import pages_with_meta
    return pages_with_meta(scan_pages(fx["fx_pages"]), fx["fx_meta"])


@plan("duplicate_articles", _PARSE + "SELECT page_key, post_id, status FROM s WHERE status <> 'error'")
def duplicate_articles_q(fx):
    """J5 (+V5): already-complete or later in-batch copies are ledger-only."""
    return _stage(fx).filter(F.col("status") != "error").select("page_key", "post_id", "status")


@plan("record_completion", _PARSE + """
r AS (SELECT * FROM s WHERE status <> 'error' AND post_id IS NOT NULL)
SELECT 'id' AS kind, CAST(NULL AS VARCHAR) AS url, post_id FROM r
UNION ALL SELECT 'alias', source_url, post_id FROM r WHERE source_url IS NOT NULL
UNION ALL SELECT 'alias', canonical_url, post_id FROM r WHERE canonical_url IS NOT NULL""".replace("\nr AS", ", r AS", 1))
def record_completion_q(fx):
    """K2: ledger and alias records appended by the parse stage."""
    return A.ledger_records(_stage(fx))


@plan("image_manifest", _IMG_ORACLE.replace("SELECT article_key, CAST(0 AS INT) AS pos,", ", refs AS (SELECT article_key, CAST(0 AS INT) AS pos,", 1)
      + """) SELECT image_path, CAST(count(*) AS BIGINT) AS n_refs, CAST(count(DISTINCT article_key) AS BIGINT) AS n_articles,
  min(article_key) AS first_article_key, min(image_source_url) AS first_source_url FROM refs GROUP BY image_path""")
def image_manifest_q(fx):
    """K5: one record per stored image asset."""
    return A.image_assets(A.image_refs(_stage(fx, "images")))


@plan("quarantine", _PARSE + "SELECT 'parser' AS stage, page_key, error AS reason, error AS detail FROM s "
      "WHERE status = 'error'")
def quarantine_q(fx):
    """K7."""
    return A.quarantine(_stage(fx))


@plan("write_articles", _PARSE + "SELECT article_key, coalesce(nullif(regexp_extract(pub_d, '^([0-9]{4}-[0-9]{2})', 1), ''), "
      "'unknown') AS pub_month, CAST(CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS batch_id FROM s WHERE status = 'compiled'")
def write_articles_q(fx):
    """K1: two overlapping batches; the later one wins where both wrote an article."""
    path = scratch_path(fx.spark, "articles")
    stage = materialize(A.store_rows(_stage(fx, "body")), "articles-stage")
    A.write_articles(stage, path, 0)
    A.write_articles(stage.filter(F.regexp_extract("page_key", "([0-9]+)", 1).cast("bigint") % 3 == 0), path, 1)
    return A.read_articles(fx.spark, path).select("article_key", "pub_month", "batch_id")


@plan("article_versions", _PARSE + """, a AS (SELECT article_key, doc_id, source_url, md5(concat(front_matter, body_markdown)) AS digest FROM s WHERE status = 'compiled'),
v1 AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS batch_id FROM a)
SELECT CAST(0 AS BIGINT) AS version, article_key, CAST(0 AS BIGINT) AS batch_id, digest FROM a
UNION ALL SELECT 1, article_key, batch_id, digest FROM v1
UNION ALL SELECT 2, article_key, batch_id, digest FROM v1 WHERE split_part(split_part(source_url, '://', 2), '/', 1) NOT IN ('www.custom0.com', 'www.custom1.com', 'www.custom4.com')""")
def article_versions_q(fx):
    """K1 + M4: the store's versions after a first batch, an overlapping second one and a
    prune of the ignored hosts; all three stay readable."""
    path = scratch_path(fx.spark, "article-versions")
    stage = materialize(A.store_rows(_stage(fx, "body")), "articles-stage")
    A.write_articles(stage, path, 0)
    A.write_articles(stage.filter(F.regexp_extract("page_key", "([0-9]+)", 1).cast("bigint") % 3 == 0), path, 1)
    stored = A.read_articles(fx.spark, path).withColumn("host", U.url_domain("source_url"))
    condemned = stored.join(ignore_set(fx["fx_ignored"]), F.col("host") == F.col("domain"), "left_semi")
    A.prune_articles(fx.spark, path, condemned, 2)
    versions = [A.read_articles(fx.spark, path, v).select(F.lit(v).cast("bigint").alias("version"), "article_key", "batch_id", F.md5("markdown").alias("digest")) for v in range(3)]
    return versions[0].unionByName(versions[1]).unionByName(versions[2])


PAGE_OUTCOMES = W("fx_odd_pages", "fx_meta", "fx_completed") + _M + """,
k AS (SELECT *, CASE WHEN kind IN ('malformed', 'none') THEN NULL WHEN kind = 'home' THEN '_'
        ELSE concat('post-', CAST(doc_id AS VARCHAR)) END AS page_key FROM fx_odd_pages),
o AS (SELECT *, page_key IS NOT NULL AND row_number() OVER (PARTITION BY page_key ORDER BY source_url) = 1 AS owner FROM k)
SELECT o.source_url, o.page_key,
  CASE WHEN o.page_key IS NULL THEN 'malformed url' WHEN NOT owner THEN 'duplicate page key'
       WHEN m.page_key IS NULL THEN 'missing metadata' WHEN NOT m.ok THEN 'invalid metadata JSON' END AS error,
  CASE WHEN o.page_key IS NULL OR NOT owner OR m.page_key IS NULL OR NOT m.ok THEN 'error'
       WHEN c.post_id IS NOT NULL THEN 'duplicate' ELSE 'compiled' END AS status,
  CASE WHEN owner AND coalesce(m.ok, false) AND c.post_id IS NULL THEN concat('Page of ', host) END AS body_markdown
FROM o LEFT JOIN m ON m.page_key = o.page_key
LEFT JOIN (SELECT DISTINCT post_id FROM fx_completed) c ON c.post_id = concat('post-', CAST(doc_id AS VARCHAR))"""


@plan("page_outcomes", PAGE_OUTCOMES)
def page_outcomes_q(fx):
    """E8/K7 on awkward pages: one page key on two hosts, home pages, malformed and missing
    URLs. Every input page comes out exactly once, with its own body."""
    pages = fx["fx_odd_pages"].select("source_url", "html")
    st = A.parse_stage(scan_pages(pages), fx["fx_meta"], fx["fx_completed"], ("body",))
    return st.select(
        F.col("page_url").alias("source_url"), "page_key", "error", "status",
        F.when(F.col("status") == "compiled", F.col("body_markdown")).alias("body_markdown"))


@plan("rebuild_ledger", _PARSE + """
r AS (SELECT * FROM s WHERE status <> 'error' AND post_id IS NOT NULL)
SELECT DISTINCT 'id' AS kind, CAST(NULL AS VARCHAR) AS url, post_id FROM r
UNION SELECT 'alias', source_url, post_id FROM r
UNION SELECT 'alias', canonical_url, post_id FROM r WHERE canonical_url IS NOT NULL""".replace("\nr AS", ", r AS", 1))
def rebuild_ledger_q(fx):
    """M5: ledger and alias map are a pure function of pages + metadata."""
    return A.rebuild_ledger(scan_pages(fx["fx_pages"]), fx["fx_meta"])


@plan("first_valid", _PARSE + """SELECT page_key, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE concat('Doc ', CAST(doc_id AS VARCHAR)) END
  AS first_title, canonical_url AS first_canonical, body_kind FROM e""")
def first_valid_q(fx):
    """O2: "first" selections of the pass: first <title> (trimmed), first
    canonical link, first matching body container."""
    p = A.parsed_pages(scan_pages(fx["fx_pages"]), parts=("meta", "body"))
    return p.select("page_key", U.strip_ws("title_text").alias("first_title"),
                    F.col("canonical_href").alias("first_canonical"), "body_kind")


ROWS_ONLY = {"html_to_markdown_pages"}


@plan("html_to_markdown_pages")
def html_to_markdown_pages_q(fx):
    """E2 + E4 over the generated pages (sloppy HTML: unclosed tags, scripts
    holding markup, navigation). Not expressible in SQL: rows-only here, and
    checked against a direct run of the same parser in tests."""
    p = A.parsed_pages(scan_pages(fx["pages"], url_col="url"), parts=("body",))
    return p.select("page_key", "body_kind", U.clean_markdown("body_md").alias("body_markdown"), "parse_error")
