"""Plans for discovery.

Links = E3 over the fixture pages (real extraction) plus ``fx_links`` (varied
URL shapes from the generated pages)."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions.urls import OTHER_SCHEME_RX
from folio.operators import discovery as D
from folio.plans.registry import W, plan
from folio.plans.sqlbits import d_canonical, d_classify, d_host, d_strip
from folio.session import scratch_path
from folio.sources.tables import ignore_set, scan_pages


def links_of(fx):
    return D.extract_links(scan_pages(fx["fx_pages"])).unionByName(fx["fx_links"])


def ignored_of(fx):
    return ignore_set(fx["fx_ignored"])


_LINKS = W("fx_docs", "fx_links", "fx_ignored", "fx_aliases", "fx_queue") + f"""
L AS (SELECT source_key, pos, href, link_text FROM fx_links
      UNION ALL SELECT concat('post-', CAST(doc_id AS VARCHAR)) AS source_key, 0 AS pos, concat('https://author',
        CAST(doc_id % 7 AS VARCHAR), '.substack.com/p/post-', CAST(doc_id * 7 % 1500 AS VARCHAR), '?ref=x') AS href,
        'next' AS link_text FROM fx_docs WHERE doc_id % 13 <> 0),
IG AS (SELECT DISTINCT {d_strip('line')} AS domain FROM fx_ignored
       WHERE {d_strip('line')} <> '' AND NOT starts_with({d_strip('line')}, '#')),
H AS (SELECT *, coalesce({d_host('href')}, CASE WHEN regexp_matches(href, '{OTHER_SCHEME_RX}') THEN '' END) AS h FROM L),
K AS (SELECT * FROM H WHERE h IS NOT NULL AND h NOT IN (SELECT domain FROM IG)
      AND split_part(h, '.', 1) NOT IN (SELECT domain FROM IG)),
C AS (SELECT source_key, pos, href, link_text, {d_classify('href')} AS link_class FROM K),
AM AS (SELECT url, arg_max(post_id, seq) AS post_id FROM fx_aliases WHERE url IS NOT NULL GROUP BY url),
KD AS (SELECT DISTINCT {d_host('url')} AS domain FROM AM WHERE {d_host('url')} IS NOT NULL),
AP AS (SELECT * FROM C WHERE link_class = 'substack_article' AND {d_host('href')} IN (SELECT domain FROM KD)),
KU AS (SELECT DISTINCT {d_canonical('url')} AS url FROM (SELECT url FROM AM UNION ALL SELECT url FROM fx_queue
        WHERE state IN ('pending', 'done') AND url IS NOT NULL AND {d_strip('url')} <> '') q
       WHERE {d_canonical('url')} IS NOT NULL),
NEWU AS (SELECT DISTINCT {d_canonical('href')} AS url FROM AP WHERE {d_canonical('href')} NOT IN (SELECT url FROM KU)),
NEWX AS (SELECT DISTINCT {d_canonical('href')} AS url FROM C WHERE link_class = 'substack_article'
         AND {d_canonical('href')} NOT IN (SELECT url FROM KU))
"""


@plan("ignore_set", W("fx_ignored") + f"x AS (SELECT 1) SELECT DISTINCT {d_strip('line')} AS domain FROM fx_ignored "
      f"WHERE {d_strip('line')} <> '' AND NOT starts_with({d_strip('line')}, '#')")
def ignore_set_q(fx):
    """S8."""
    return ignored_of(fx)


@plan("ignored_links", _LINKS + "SELECT source_key, pos, href FROM K")
def ignored_links_q(fx):
    """links surviving the ignore list."""
    return D.drop_ignored(links_of(fx), ignored_of(fx)).select("source_key", "pos", "href")


@plan("links_by_class", _LINKS + "SELECT source_key, pos, href, link_class FROM C")
def links_by_class_q(fx):
    """F3."""
    return D.classify(D.drop_ignored(links_of(fx), ignored_of(fx))).select("source_key", "pos", "href", "link_class")


@plan("known_domain_links", _LINKS + "SELECT source_key, pos, href FROM AP")
def known_domain_links_q(fx):
    """F4 (default mode: known domains only)."""
    return D.known_domain_links(links_of(fx), ignored_of(fx), D.known_domains(fx["fx_aliases"])).select("source_key", "pos", "href")


@plan("known_domains", _LINKS + "SELECT domain FROM KD")
def known_domains_q(fx):
    """A1."""
    return D.known_domains(fx["fx_aliases"])


@plan("link_class_counts", _LINKS + """SELECT link_class, CAST(count(*) AS BIGINT) AS n_links FROM C GROUP BY link_class
UNION ALL SELECT 'approved_article', CAST(count(*) AS BIGINT) FROM AP""")
def link_class_counts_q(fx):
    """A2: potential vs approved counts."""
    return D.link_class_counts(links_of(fx), ignored_of(fx), fx["fx_aliases"])


@plan("known_urls", _LINKS + "SELECT url FROM KU")
def known_urls_q(fx):
    """X1."""
    return D.known_urls(fx["fx_aliases"], fx["fx_queue"])


@plan("discover_new_articles", _LINKS + "SELECT url FROM NEWU")
def discover_new_articles_q(fx):
    """X2 (default mode)."""
    return D.discover_new_articles(links_of(fx), ignored_of(fx), fx["fx_aliases"], fx["fx_queue"])


@plan("discover_new_articles_expand", _LINKS + "SELECT url FROM NEWX")
def discover_new_articles_expand_q(fx):
    """X2 in expand mode (F4 skipped)."""
    return D.discover_new_articles(links_of(fx), ignored_of(fx), fx["fx_aliases"], fx["fx_queue"], expand=True)


@plan("external_links", _LINKS + "SELECT source_key AS source_article_key, link_text, href AS external_url "
      "FROM C WHERE link_class = 'external'")
def external_links_q(fx):
    """Duplicates kept."""
    return D.external_links(links_of(fx), ignored_of(fx))


@plan("write_external_links", _LINKS + "SELECT source_key AS source_article_key, link_text, href AS external_url "
      "FROM C WHERE link_class = 'external'")
def write_external_links_q(fx):
    """K3: write the CSV catalogue and read it back."""
    path = scratch_path(fx.spark, "external-links")
    D.write_external_links(D.external_links(links_of(fx), ignored_of(fx)), path)
    return fx.spark.read.option("header", True).schema(
        "source_article_key string, link_text string, external_url string").csv(path)


JOB_TS = "2025-06-14T15:00:00Z"


@plan("next_crawl_job", _LINKS + f"SELECT url, 'discovery' AS reason, '{JOB_TS}' AS job_ts FROM NEWX")
def next_crawl_job_q(fx):
    """K4: the expand-mode discoveries as one sorted, de-duplicated crawl job."""
    new = D.discover_new_articles(links_of(fx), ignored_of(fx), fx["fx_aliases"], fx["fx_queue"], expand=True)
    return D.next_crawl_job(new, JOB_TS)


@plan("sorted_urls", _LINKS + "SELECT url FROM KU")
def sorted_urls_q(fx):
    """O1: ascending order of a URL set (range-partitioned sort)."""
    return D.known_urls(fx["fx_aliases"], fx["fx_queue"]).orderBy("url")


@plan("discovery_job", _LINKS + f"""SELECT 'new' AS output, url AS k, CAST(1 AS BIGINT) AS n FROM NEWU
UNION ALL SELECT 'job', url, 1 FROM NEWU
UNION ALL SELECT 'external', concat(source_key, ' ', href), CAST(count(*) AS BIGINT) FROM C WHERE link_class = 'external' GROUP BY 2
UNION ALL SELECT 'count', link_class, CAST(count(*) AS BIGINT) FROM C GROUP BY link_class
UNION ALL SELECT 'count', 'approved_article', CAST(count(*) AS BIGINT) FROM AP""")
def discovery_job_q(fx):
    """A2 + X2 + X5 + K4 as one job: one pass over the HTML, one link table, all outputs."""
    out = D.discovery_job(links_of(fx), ignored_of(fx), fx["fx_aliases"], fx["fx_queue"], scratch_path(fx.spark, "links"), JOB_TS)
    one = F.lit(1).cast("bigint").alias("n")
    external = out["external"].groupBy(F.concat_ws(" ", "source_article_key", "external_url").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return (out["new_urls"].select(F.lit("new").alias("output"), F.col("url").alias("k"), one)
            .unionByName(out["crawl_job"].select(F.lit("job").alias("output"), F.col("url").alias("k"), one))
            .unionByName(external.select(F.lit("external").alias("output"), "k", "n"))
            .unionByName(out["counts"].select(F.lit("count").alias("output"), F.col("link_class").alias("k"), F.col("n_links").alias("n"))))


@plan("discover_to_the_end", _LINKS.replace("WITH", "WITH RECURSIVE", 1).rstrip() + f""",
STEP AS (SELECT DISTINCT source_key, {d_canonical('href')} AS url FROM AP WHERE {d_canonical('href')} NOT IN (SELECT url FROM KU)),
REACH(url) AS (SELECT url FROM STEP WHERE source_key IN (SELECT concat('post-', CAST(doc_id AS VARCHAR)) FROM fx_docs WHERE host = 'author1.substack.com')
  UNION SELECT STEP.url FROM REACH JOIN STEP ON STEP.source_key = split_part(REACH.url, '/p/', 2))
SELECT url FROM REACH""")
def discover_to_the_end_q(fx):
    """T4 to its end: from the stored pages of one author, round by round, until nothing is new."""
    pages = scan_pages(fx["fx_pages"])
    table, _ = D.link_table(D.extract_links(pages), ignored_of(fx), fx["fx_aliases"], scratch_path(fx.spark, "links"))
    start = pages.filter(F.col("source_url").startswith("https://author1.substack.com/")).select("page_key")
    return D.discover_to_the_end(table, start, fx["fx_aliases"], fx["fx_queue"]).select("url")
