"""Plans for the article index and Markdown maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import front_matter
from folio.operators import index as IX
from folio.plans.registry import W, plan
from folio.session import scratch_path
from folio.sources.tables import scan_markdown

_SRC = ("concat('https://', host, '/p/post-', CAST(doc_id AS VARCHAR), "
        "CASE doc_id % 4 WHEN 0 THEN '?utm_source=feed' WHEN 1 THEN '#top' ELSE '' END)")

_IDX = W("fx_docs", "fx_markdown", "fx_wild") + f"""
D AS (SELECT doc_id, host, slug, pub, body, {_SRC} AS src,
        CASE WHEN doc_id % 5 = 0 THEN 'Untitled' ELSE concat('Head ', CAST(doc_id AS VARCHAR)) END AS ttl,
        CASE WHEN doc_id % 17 = 0 THEN 'unknown' ELSE pub END AS pb FROM fx_docs),
IDX AS (SELECT concat('post-', CAST(doc_id AS VARCHAR)) AS slug,
          concat('work/processed/post-', CAST(doc_id AS VARCHAR), '.md') AS path, ttl AS title,
          CASE WHEN doc_id % 19 = 0 THEN 'Unknown' ELSE concat('Author ', CAST(doc_id % 9 AS VARCHAR)) END AS author,
          pb AS publication_date, CASE WHEN doc_id % 21 = 0 THEN NULL ELSE host END AS domain
        FROM D WHERE doc_id % 97 NOT IN (1, 2) AND doc_id % 8 <> 0),
Q1 AS (SELECT * FROM IDX WHERE author IS NOT NULL AND contains(lower(author), 'author 1')
         AND publication_date >= '2024-03-01' AND publication_date <= '2024-12-31'
         AND title IS NOT NULL AND contains(lower(title), 'head')),
BAD AS (SELECT doc_id FROM D WHERE doc_id % 97 IN (1, 2) OR doc_id % 8 = 0)
"""


def _index(fx):
    return IX.build_article_index(scan_markdown(fx["fx_markdown"]))


@plan("scan_markdown", W("fx_markdown") + "x AS (SELECT 1) SELECT slug, md FROM fx_markdown")
def scan_markdown_q(fx):
    """S9."""
    return scan_markdown(fx["fx_markdown"])


@plan("build_article_index", _IDX + "SELECT * FROM IDX")
def build_article_index_q(fx):
    """K6: front matter -> index rows; files without valid front matter skipped."""
    return _index(fx)


@plan("scan_article_index", _IDX + "SELECT * FROM IDX")
def scan_article_index_q(fx):
    """The index written as Parquet and read back."""
    path = scratch_path(fx.spark, "article-index")
    _index(fx).write.mode("overwrite").parquet(path)
    return fx.spark.read.parquet(path)


@plan("query_articles", _IDX + "SELECT * FROM Q1")
def query_articles_q(fx):
    """author / date range / title filters."""
    return IX.query_articles(_index(fx), author="author 1", since="2024-03-01", until="2024-12-31",
                             title_contains="head")


@plan("query_articles_domain", _IDX + "SELECT * FROM IDX WHERE domain = 'author2.substack.com' "
      "AND publication_date >= '2024-06-01'")
def query_articles_domain_q(fx):
    """domain equality + since (pushed down to the index scan)."""
    return IX.query_articles(_index(fx), domain="author2.substack.com", since="2024-06-01")


@plan("export_query_subset", _IDX + "SELECT m.slug, m.md FROM fx_markdown m WHERE m.slug IN (SELECT slug FROM Q1)")
def export_query_subset_q(fx):
    """The F5 selection materialised (overwrite) and read back."""
    path = scratch_path(fx.spark, "query-subset")
    sel = IX.query_articles(_index(fx), author="author 1", since="2024-03-01", until="2024-12-31",
                            title_contains="head")
    IX.export_query_subset(scan_markdown(fx["fx_markdown"]), sel, path)
    return fx.spark.read.parquet(path)


@plan("corrupt_markdown", _IDX + "SELECT concat('post-', CAST(doc_id AS VARCHAR)) AS slug FROM BAD")
def corrupt_markdown_q(fx):
    """F7."""
    return IX.corrupt_markdown(scan_markdown(fx["fx_markdown"])).select("slug")


@plan("repair_markdown", _IDX + """SELECT concat('post-', CAST(doc_id AS VARCHAR)) AS slug,
  CASE WHEN doc_id % 97 IN (1, 2) THEN NULL ELSE regexp_replace(concat('---', chr(10), 'title: ', ttl, chr(10),
    'publication-date: ', CASE WHEN pb = 'unknown' THEN 'unknown' ELSE concat('''', pb, '''') END, chr(10),
    'source-url: ', src, chr(10), 'post-id: ', slug, chr(10), '---', chr(10),
    '## Part ', CAST(doc_id AS VARCHAR), chr(10), body), '\\n+$', '') END AS repaired,
  CASE WHEN doc_id % 97 IN (1, 2) THEN 'skipped' ELSE 'repaired' END AS status
FROM D WHERE doc_id % 97 IN (1, 2) OR doc_id % 8 = 0""")
def repair_markdown_q(fx):
    """M2."""
    return IX.repair_markdown(scan_markdown(fx["fx_markdown"]))




def _wild_markdown(fx):
    """E6 over awkward values, beside files written by hand."""
    said = lambda c: (F.lit(True), F.col(c))
    own = front_matter({"title": said("title"), "author": said("author"), "publication-date": said("pub"), "source-url": said("url")})
    tail = F.concat(F.lit("author: \"A. \\\"B\\\" "), F.substring("author", 8, 1), F.lit("\\nC\"\npublication-date: '"), F.col("pub"), F.lit("'\nsource-url: "), F.col("url"), F.lit("\n---\n"))
    folded = F.concat(F.lit("---\n# by hand\ntitle: Folded\n  over\n  "), F.regexp_extract("title", "([0-9]+)$", 1), F.lit("\n"), tail)
    nested = F.concat(F.lit("---\ntitle: Nested\ntags:\n  - a\n"), tail)
    rows = fx["fx_wild"].withColumn("url", F.concat(F.lit("https://"), F.col("host"), F.lit("/p/"), F.col("slug")))
    return rows.select("slug", F.concat(F.when(F.col("written") == "nested", nested).when(F.col("written") == "folded", folded).otherwise(own), F.lit("# Body\n---\ntext")).alias("md"))


@plan("front_matter_round_trip", W("fx_wild") + """x AS (SELECT 1) SELECT slug, concat('work/processed/', slug, '.md') AS path, title, author, pub AS publication_date, host AS domain
FROM fx_wild WHERE written <> 'nested' AND contains(lower(author), '"b" 1') AND pub >= '2024-02-01'""")
def front_matter_round_trip_q(fx):
    """E6 -> K6 -> F5: values with line breaks, quotes, colons and backslashes come back as
    they were, and are found."""
    return IX.query_articles(IX.build_article_index(_wild_markdown(fx)), author='"b" 1', since="2024-02-01")


@plan("unreadable_markdown", _IDX + """, wild AS (SELECT slug FROM fx_wild WHERE written = 'nested')
SELECT concat('post-', CAST(doc_id AS VARCHAR)) AS slug, 'no front matter' AS reason FROM BAD UNION ALL SELECT slug, 'front matter is not flat' FROM wild""")
def unreadable_markdown_q(fx):
    """K6's quarantine: files that the index leaves out, with the reason."""
    return IX.unreadable_markdown(scan_markdown(fx["fx_markdown"]).unionByName(_wild_markdown(fx)))
