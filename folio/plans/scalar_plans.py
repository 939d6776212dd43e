"""Plans for the scalar operators (U1-U16) over URL/text corpora drawn from the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio import functions as U
from folio.plans.registry import W, plan
from folio.plans.sqlbits import (d_canonical, d_classify, d_filename, d_host, d_image_path,
                                 d_slug, d_strip)


def url_corpus(fx):
    """Every URL the fixtures hold: link hrefs, queue lines, alias keys."""
    return (fx["fx_links"].select(F.lit("link").alias("src"), F.col("href").alias("url"))
            .unionByName(fx["fx_queue"].select(F.lit("queue").alias("src"), "url"))
            .unionByName(fx["fx_aliases"].select(F.lit("alias").alias("src"), "url")))


_U = W("fx_links", "fx_queue", "fx_aliases") + """
u AS (SELECT 'link' AS src, href AS url FROM fx_links UNION ALL SELECT 'queue', url FROM fx_queue
      UNION ALL SELECT 'alias', url FROM fx_aliases)
"""


@plan("url_slug", _U + f"SELECT src, url, {d_slug('url')} AS slug FROM u")
def url_slug(fx):
    """U1."""
    return url_corpus(fx).select("src", "url", U.url_slug("url").alias("slug"))


@plan("meta_slug", W("fx_meta") + "x AS (SELECT 1) SELECT meta_file, "
      "regexp_replace(meta_file, '\\.html\\.meta\\.json$', '') AS page_key FROM fx_meta")
def meta_slug(fx):
    """U2."""
    return fx["fx_meta"].select("meta_file", U.meta_slug("meta_file").alias("page_key"))


@plan("url_canonical", _U + f"SELECT src, url, {d_canonical('url')} AS canonical FROM u")
def url_canonical(fx):
    """U3."""
    return url_corpus(fx).select("src", "url", U.url_canonical("url").alias("canonical"))


_IMG_SRC = """
SELECT doc_id, concat('https://img.example.org/a/', CAST(doc_id % 50 AS {S}), '.png?w=10') AS src FROM fx_docs
UNION ALL SELECT doc_id, concat('https://substackcdn.com/image/fetch/w_1456,c_limit/https%3A%2F%2F', host, '%2Fimages%2F', CAST(doc_id AS {S}), '.png') FROM fx_docs
UNION ALL SELECT doc_id, concat('/img/', CAST(doc_id AS {S}), '.png') FROM fx_docs WHERE doc_id % 10 = 0
UNION ALL SELECT doc_id, '  ' FROM fx_docs WHERE doc_id % 50 = 0
UNION ALL SELECT doc_id, concat('http://', host, ':8080/x/', CAST(doc_id AS {S}), '.jpg#f') FROM fx_docs WHERE doc_id % 7 = 0
"""


@plan("image_local_path", W("fx_docs") + "i AS (" + _IMG_SRC.replace("{S}", "VARCHAR") + ")\n"
      f"SELECT doc_id, src, {d_image_path('src')} AS image_path FROM i")
def image_local_path(fx):
    """U4 (native twin of the Python helper inside the HTML pass)."""
    src = fx.spark.sql(_IMG_SRC.replace("{S}", "STRING").replace("fx_docs", fx.view("fx_docs")))
    return src.select("doc_id", "src", U.image_local_path("src").alias("image_path"))


@plan("url_filename", _U + f"SELECT src, url, {d_filename('url')} AS filename FROM u")
def url_filename(fx):
    """U5."""
    return url_corpus(fx).select("src", "url", U.url_filename("url").alias("filename"))


@plan("url_domain", _U + f"SELECT src, url, {d_host('url')} AS domain FROM u")
def url_domain(fx):
    """U6."""
    return url_corpus(fx).select("src", "url", U.url_domain("url").alias("domain"))


@plan("host_first_label", _U + f"SELECT src, url, split_part({d_host('url')}, '.', 1) AS first_label FROM u")
def host_first_label(fx):
    """U7."""
    return url_corpus(fx).select("src", "url", U.host_first_label(U.url_domain("url")).alias("first_label"))


@plan("feed_url", W("fx_jobs") + "x AS (SELECT 1) SELECT job_id, author, concat('https://', "
      "CASE WHEN instr(author, '.') > 0 THEN author ELSE concat(author, '.substack.com') END, '/feed') AS feed_url "
      "FROM fx_jobs WHERE author IS NOT NULL")
def feed_url(fx):
    """U8."""
    return fx["fx_jobs"].filter(F.col("author").isNotNull()) \
        .select("job_id", "author", U.feed_url("author").alias("feed_url"))


_IDS = """
SELECT doc_id, concat('tag:', host, ',2024:post/', CAST(doc_id AS {S})) AS entry_id FROM fx_docs
UNION ALL SELECT doc_id, concat('substack:post:', CAST(doc_id AS {S})) FROM fx_docs
UNION ALL SELECT doc_id, concat('https://', host, '/p/', slug) FROM fx_docs
UNION ALL SELECT doc_id, concat('post/', CAST(doc_id AS {S}), '/x') FROM fx_docs WHERE doc_id % 5 = 0
"""


@plan("feed_post_id", W("fx_docs") + "i AS (" + _IDS.replace("{S}", "VARCHAR") + ")\n"
      "SELECT doc_id, entry_id, coalesce(nullif(regexp_extract(entry_id, 'post/([0-9]+)$', 1), ''), "
      "nullif(regexp_extract(entry_id, 'substack:post:([0-9]+)$', 1), '')) AS post_id FROM i")
def feed_post_id(fx):
    """U9."""
    ids = fx.spark.sql(_IDS.replace("{S}", "STRING").replace("fx_docs", fx.view("fx_docs")))
    return ids.select("doc_id", "entry_id", U.feed_post_id("entry_id").alias("post_id"))


@plan("feed_date", W("fx_feed_entries") + "x AS (SELECT 1) SELECT doc_id, fk AS kind, "
      "CASE WHEN fk = 'atom' AND doc_id % 2 = 0 THEN upd WHEN fk IN ('atom', 'rss') THEN pub END AS published_date "
      "FROM fx_feed_entries")
def feed_date(fx):
    """U10 on the date texts of feed entries (Atom: first of updated/published); entries of
    other kinds have no date."""
    e = fx["fx_feed_entries"]
    atom_txt = F.regexp_extract("entry", r"<(?:updated|published)>([^<]*)<", 1)
    rss_txt = F.regexp_extract("entry", r"<pubDate>([^<]*)<", 1)
    d = F.when(F.col("fk") == "atom", U.feed_date_atom(atom_txt)).when(F.col("fk") == "rss", U.feed_date_rss(rss_txt))
    return e.select("doc_id", F.col("fk").alias("kind"), d.alias("published_date"))


@plan("article_key", W("fx_pages") + "x AS (SELECT doc_id, source_url, CASE WHEN doc_id % 11 = 0 THEN NULL "
      "WHEN doc_id % 11 = 1 THEN '  ' ELSE concat('post-', CAST(doc_id AS VARCHAR)) END AS post_id FROM fx_pages) "
      f"SELECT doc_id, post_id, CASE WHEN post_id IS NULL OR {d_strip('post_id')} = '' THEN "
      "concat('unknown-article_', md5(coalesce(source_url, ''))) ELSE post_id END AS article_key FROM x")
def article_key(fx):
    """U11."""
    p = fx["fx_pages"].select("doc_id", "source_url", F.when(F.col("doc_id") % 11 == 0, F.lit(None))
                              .when(F.col("doc_id") % 11 == 1, F.lit("  "))
                              .otherwise(F.concat(F.lit("post-"), F.col("doc_id").cast("string"))).alias("post_id"))
    return p.select("doc_id", "post_id", U.article_key("post_id", "source_url").alias("article_key"))


_CORR = """
(CASE WHEN instr(html, '502 Bad Gateway') > 0 THEN 'Title contains ''502 Bad Gateway'''
      WHEN instr(html, 'Page not found') > 0 THEN 'Title contains ''Page not found'''
      WHEN instr(html, 'Too Many Requests') > 0 THEN 'Content is ''Too Many Requests'' error page' END)"""


@plan("content_corruption_reason", W("fx_pages") + "x AS (SELECT 1) "
      f"SELECT 'fx' AS src, CAST(doc_id AS BIGINT) AS id, {_CORR} AS reason FROM fx_pages "
      f"UNION ALL SELECT 'pages' AS src, page_id AS id, {_CORR} AS reason FROM pages")
def content_corruption_reason(fx):
    """U14 over the fixture pages and the generated pages."""
    a = fx["fx_pages"].select(F.lit("fx").alias("src"), F.col("doc_id").alias("id"),
                              U.content_corruption_reason("html").alias("reason"))
    b = fx["pages"].select(F.lit("pages").alias("src"), F.col("page_id").alias("id"),
                           U.content_corruption_reason("html").alias("reason"))
    return a.unionByName(b)


_KEB = "^([^:\\s][^:]*):(\\s|$)"


@plan("kebab_keys", W("fx_markdown") + "l AS (SELECT slug, CAST(n - 1 AS INT) AS line_no, line FROM fx_markdown, "
      "UNNEST(string_split(md, chr(10))) WITH ORDINALITY AS t(line, n)) "
      f"SELECT slug, line_no, CASE WHEN regexp_extract(line, '{_KEB}', 1) <> '' THEN "
      f"concat(replace(regexp_extract(line, '{_KEB}', 1), '_', '-'), "
      f"substr(line, length(regexp_extract(line, '{_KEB}', 1)) + 1)) ELSE line END AS line FROM l")
def kebab_keys(fx):
    """U15 applied line by line to whole Markdown files."""
    return fx["fx_markdown"].select("slug", F.posexplode(F.split("md", "\n", -1)).alias("line_no", "line")) \
        .select("slug", "line_no", U.kebab_key_line("line").alias("line"))


@plan("classify_link", _U + f"SELECT src, url, {d_classify('url')} AS link_class FROM u")
def classify_link(fx):
    """U16."""
    from folio.functions.urls import with_link_class
    return with_link_class(url_corpus(fx), "url", "link_class").select("src", "url", "link_class")
