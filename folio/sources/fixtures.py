"""Table fixtures derived from the generated test tables, in two dialects.

The generated ``pages`` carry no canonical links, JSON-LD, figures or absolute
hrefs, so the article operators are exercised on ``fx_*`` tables that are pure
functions of ``documents`` and ``pages`` (they grow with them). Each fixture is
written once as a template and rendered for Spark SQL (the engine's input) and
for DuckDB (inlined as a CTE chain in the oracle SQL), so both sides start from
identical rows.

Template placeholders: ``{S}`` string type, ``{G}`` the global flag DuckDB's
``regexp_replace`` needs, ``{NL}`` a newline, ``{<table>}`` a table reference.
Fixtures that need dialect-specific syntax are given as ``{"spark": .., "duckdb": ..}``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations"]

DIALECT = {
    "spark": {"S": "STRING", "G": "", "NL": "chr(10)"},
    "duckdb": {"S": "VARCHAR", "G": ", 'g'", "NL": "chr(10)"},
}

# Source URL and canonical URL of a fixture document (used by several fixtures).
_SRC = ("concat('https://', host, '/p/post-', CAST(doc_id AS {S}), "
        "CASE doc_id % 4 WHEN 0 THEN '?utm_source=feed' WHEN 1 THEN '#top' ELSE '' END)")
_CANON = "concat('https://', host, '/p/', slug)"

FIXTURES: dict[str, tuple[list[str], object]] = {}


def _sub(text: str, values: dict) -> str:
    for k, v in values.items():
        text = text.replace(f"@{k}@", v)
    return text


FIXTURES["fx_docs"] = (["documents"], """
SELECT doc_id,
  CASE WHEN doc_id % 3 = 0 THEN concat('www.custom', CAST(doc_id % 5 AS {S}), '.com')
       ELSE concat('author', CAST(doc_id % 7 AS {S}), '.substack.com') END AS host,
  concat('post-', CAST(CASE WHEN doc_id % 10 = 9 THEN doc_id - 1 ELSE doc_id END AS {S})) AS slug,
  substr(CAST(CAST('2024-01-01' AS DATE) + CAST(doc_id % 400 AS INT) AS {S}), 1, 10) AS pub,
  text AS body
FROM {documents}
""")

FIXTURES["fx_pages"] = (["fx_docs"], """
SELECT doc_id, """ + _SRC + """ AS source_url,
  CASE WHEN doc_id % 13 = 0 THEN
    '<html><head></head><body><pre>Too Many Requests</pre></body></html>'
  ELSE concat('<html><head><title> Doc ', CAST(doc_id AS {S}), ' </title>',
    CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat('<link rel="canonical" href="', """ + _CANON + """, '">') END,
    CASE WHEN doc_id % 7 = 0 THEN '' ELSE concat('<meta name="author" content="Writer ', CAST(doc_id % 7 AS {S}), '">') END,
    '<meta property="article:published_time" content="', pub, 'T08:00:00Z">',
    CASE WHEN doc_id % 2 = 0 THEN concat('<script type="application/ld+json">{{"headline":"Head ', CAST(doc_id AS {S}),
      '","author":[{{"name":"Author ', CAST(doc_id % 9 AS {S}), '"}}],"datePublished":"', pub, 'T08:00:00Z"}}</script>') ELSE '' END,
    CASE WHEN doc_id % 17 = 0 THEN '<script>var e="Too Many Requests";</script>' ELSE '' END,
    '</head><body>', CASE WHEN doc_id % 5 = 0 THEN '<article>' ELSE '<div class="body markup">' END,
    '<h2>Part ', CAST(doc_id AS {S}), '</h2><p>', replace(replace(replace(body, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '</p>',
    '<p>See <a href="https://author', CAST(doc_id % 7 AS {S}), '.substack.com/p/post-', CAST(doc_id * 7 % 1500 AS {S}), '?ref=x">next</a> and <strong>more</strong>.</p>',
    '<figure><img src="https://img.example.org/a/', CAST(doc_id % 50 AS {S}), '.png?w=10" alt="Alt ', CAST(doc_id % 50 AS {S}), '"><figcaption>Cap ', CAST(doc_id AS {S}), '</figcaption></figure>',
    '<blockquote><p>Quote</p></blockquote><ul><li>one</li><li>two</li></ul>',
    CASE WHEN doc_id % 5 = 0 THEN '</article>' ELSE '</div>' END, '</body></html>') END AS html
FROM {fx_docs}
""")

# Awkward pages: the same page key on two hosts, home pages (all share one key),
# malformed and missing URLs. The body names the host, so a mixed-up body shows.
FIXTURES["fx_odd_pages"] = (["fx_docs"], """
SELECT doc_id, kind, host, source_url,
  concat('<html><head><title>Odd ', CAST(doc_id AS {S}), '</title><link rel="canonical" href="https://x.example.org/p/post-', CAST(doc_id AS {S}),
    '"></head><body><p>Page of ', host, '</p></body></html>') AS html
FROM (
  SELECT doc_id, 'a' AS kind, 'a.example.org' AS host, concat('https://a.example.org/p/post-', CAST(doc_id AS {S})) AS source_url FROM {fx_docs}
  UNION ALL SELECT doc_id, 'b', 'b.example.net', concat('https://b.example.net/p/post-', CAST(doc_id AS {S})) FROM {fx_docs} WHERE doc_id % 4 = 0
  UNION ALL SELECT doc_id, 'home', concat('h', CAST(doc_id AS {S}), '.example.org'), concat('https://h', CAST(doc_id AS {S}), '.example.org/') FROM {fx_docs} WHERE doc_id % 6 = 0
  UNION ALL SELECT doc_id, 'malformed', 'nowhere', concat('not a url ', CAST(doc_id AS {S})) FROM {fx_docs} WHERE doc_id % 10 = 3
  UNION ALL SELECT doc_id, 'none', 'nowhere', CAST(NULL AS {S}) FROM {fx_docs} WHERE doc_id % 25 = 7) u
""")

_LINKS_OUTER = """
SELECT source_key, pos,
  CASE (page_id + pos) % 8 WHEN 0 THEN concat('https://', host, '/p/', w) WHEN 1 THEN concat('https://', host, '/p/', w, '?utm_source=feed#top')
   WHEN 2 THEN concat('https://cdn.substack.com/image/', w) WHEN 3 THEN concat('https://', w, '.substack.com/about')
   WHEN 4 THEN concat('https://', host, '/subscribe?next=', w) WHEN 5 THEN concat('https://en.wikipedia.org/wiki/', w)
   WHEN 6 THEN concat('/', w) ELSE 'mailto:a@example.org' END AS href,
  txt AS link_text
FROM (SELECT page_id, concat('page-', CAST(page_id AS {S})) AS source_key, pos, txt,
        regexp_extract(url, '://([^/?#:]*)', 1) AS host,
        concat('w', lower(regexp_replace(txt, '[^A-Za-z0-9]', ''{G}))) AS w
      FROM @FROM@) y
"""
_ANCHORS = "(SELECT page_id, url, regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1) AS ws FROM {pages}) x"
FIXTURES["fx_links"] = (["pages"], {
    "spark": _LINKS_OUTER.replace("@FROM@", _ANCHORS + " LATERAL VIEW posexplode(ws) e AS pos, txt"),
    "duckdb": _LINKS_OUTER.replace("@FROM@", "(SELECT page_id, url, CAST(pos1 - 1 AS INT) AS pos, txt FROM " + _ANCHORS
                                    + ", UNNEST(ws) WITH ORDINALITY AS e(txt, pos1)) z"),
})

# Fetch metadata files: one per page key. Missing for doc_id % 23 = 0, broken JSON
# for % 29, no source-url for % 31, a moved source URL for % 41, plus orphans.
FIXTURES["fx_meta"] = (["fx_docs"], """
SELECT concat('post-', CAST(doc_id AS {S}), '.html.meta.json') AS meta_file,
  CASE WHEN doc_id % 29 = 0 THEN concat('{{"source-url": "', src)
       WHEN doc_id % 31 = 0 THEN concat('{{"fetch-timestamp": "', ts, '"}}')
       WHEN doc_id % 41 = 0 THEN concat('{{"source-url": "https://', host, '/p/moved-', CAST(doc_id AS {S}), '", "fetch-timestamp": "', ts, '"}}')
       ELSE concat('{{"source-url": "', src, '", "fetch-timestamp": "', ts, '"}}') END AS raw_json
FROM (SELECT doc_id, host, """ + _SRC + """ AS src,
        concat('2025-06-14T14:13:21.', lpad(CAST((doc_id * 7919) % 1000000007 AS {S}), 9, '0'), 'Z') AS ts
      FROM {fx_docs}) d
WHERE doc_id % 23 <> 0
UNION ALL
SELECT concat('orphan-', CAST(doc_id AS {S}), '.html.meta.json') AS meta_file,
  concat('{{"source-url": "https://orphan.example.com/p/orphan-', CAST(doc_id AS {S}), '", "fetch-timestamp": "2025-06-15T00:00:00Z"}}') AS raw_json
FROM {fx_docs} WHERE doc_id % 37 = 0
""")

# Completion ledger: slugs of doc_id % 5 = 0, some twice, plus blank entries.
FIXTURES["fx_completed"] = (["fx_docs"], """
SELECT slug AS post_id, CAST(doc_id * 2 AS BIGINT) AS seq FROM {fx_docs} WHERE doc_id % 5 = 0
UNION ALL SELECT slug AS post_id, CAST(doc_id * 2 + 1 AS BIGINT) AS seq FROM {fx_docs} WHERE doc_id % 10 = 0
UNION ALL SELECT '  ' AS post_id, CAST(doc_id * 2 + 1 AS BIGINT) AS seq FROM {fx_docs} WHERE doc_id % 60 = 30
""")

# Alias log: source and canonical URL of completed docs; a later conflicting
# row for doc_id % 15 = 0 (last write wins).
FIXTURES["fx_aliases"] = (["fx_docs"], """
SELECT """ + _SRC + """ AS url, slug AS post_id, CAST(doc_id * 4 AS BIGINT) AS seq FROM {fx_docs} WHERE doc_id % 5 = 0
UNION ALL
SELECT """ + _CANON + """ AS url, slug AS post_id, CAST(doc_id * 4 + 1 AS BIGINT) AS seq FROM {fx_docs} WHERE doc_id % 5 = 0 AND doc_id % 11 <> 0
UNION ALL
SELECT """ + _SRC + """ AS url, concat('post-x-', CAST(doc_id AS {S})) AS post_id, CAST(doc_id * 4 + 2 AS BIGINT) AS seq FROM {fx_docs} WHERE doc_id % 15 = 0
""")

# Ignore list lines: a few fixed entries (custom0 owns completed ids and aliases, so pruning
# removes some) plus hosts of generated pages, padded, commented or blank.
FIXTURES["fx_ignored"] = (["pages"], """
SELECT line FROM (VALUES ('www.custom1.com'), ('www.custom0.com'), ('author3'), ('# comment'), (''),
                         ('  www.custom4.com  '), ('  # note'), ('cdn')) AS t(line)
UNION ALL
SELECT CASE page_id % 4 WHEN 0 THEN h WHEN 1 THEN concat('  ', h, ' ') WHEN 2 THEN concat('# ', h) ELSE '' END AS line
FROM (SELECT page_id, regexp_extract(url, '://([^/?#:]*)', 1) AS h FROM {pages}) p
WHERE page_id % 9 = 0
""")

# URL queue lists: every source URL, state by doc_id % 3; blank and malformed
# lines; a re-queued copy of short pages under a later position.
FIXTURES["fx_queue"] = (["fx_docs"], """
SELECT concat('list-', CAST(doc_id % 10 AS {S})) AS list_name, CAST(doc_id AS BIGINT) AS pos, """ + _SRC + """ AS url,
  CASE doc_id % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'done' ELSE 'error' END AS state FROM {fx_docs}
UNION ALL SELECT 'list-blank' AS list_name, CAST(doc_id AS BIGINT) AS pos, '   ' AS url, 'done' AS state FROM {fx_docs} WHERE doc_id % 50 = 0
UNION ALL SELECT 'list-bad' AS list_name, CAST(doc_id AS BIGINT) AS pos, concat('not a url ', CAST(doc_id AS {S})) AS url, 'pending' AS state FROM {fx_docs} WHERE doc_id % 50 = 25
UNION ALL SELECT 'list-retry' AS list_name, CAST(doc_id AS BIGINT) AS pos, concat('https://', host, '/p/post-', CAST(doc_id AS {S}), '?retry=1') AS url, 'done' AS state FROM {fx_docs} WHERE doc_id % 13 = 0
""")

# Job specs: url-list jobs of at most ten URLs, one author job per host
# (dotted = custom domain, undotted = platform author) with varied date ranges,
# and one spec of unknown type.
_JOBS = """
SELECT concat('urls-', CAST(CAST(floor(doc_id / 10) AS BIGINT) AS {S})) AS job_id, @sorted_urls@ AS urls,
       CAST(NULL AS {S}) AS author, CAST(NULL AS @range_t@) AS date_range
FROM (SELECT doc_id, """ + _SRC + """ AS src FROM {fx_docs}) u
GROUP BY CAST(floor(doc_id / 10) AS BIGINT)
UNION ALL
SELECT concat('author-', a) AS job_id, CAST(NULL AS @list_t@) AS urls, a AS author,
  CASE WHEN a = 'author3' THEN @range_start@
       WHEN a = 'author5' THEN @range_both@
       WHEN a = 'www.custom2.com' THEN @range_end@ END AS date_range
FROM (SELECT DISTINCT CASE WHEN host LIKE '%.substack.com' THEN split_part(host, '.', 1) ELSE host END AS a FROM {fx_docs}) h
UNION ALL
SELECT 'job-unknown' AS job_id, CAST(NULL AS @list_t@) AS urls, CAST(NULL AS {S}) AS author, CAST(NULL AS @range_t@) AS date_range
"""
FIXTURES["fx_jobs"] = (["fx_docs"], {
    "spark": _sub(_JOBS, {
        "sorted_urls": "array_sort(collect_list(src))",
        "range_t": "STRUCT<start: STRING, `end`: STRING>", "list_t": "ARRAY<STRING>",
        "range_start": "named_struct('start', '2024-03-01', 'end', CAST(NULL AS STRING))",
        "range_both": "named_struct('start', '2024-02-01', 'end', '2024-06-30')",
        "range_end": "named_struct('start', CAST(NULL AS STRING), 'end', '2024-09-30')"}),
    "duckdb": _sub(_JOBS, {
        "sorted_urls": "list_sort(list(src))",
        "range_t": "STRUCT(\"start\" VARCHAR, \"end\" VARCHAR)", "list_t": "VARCHAR[]",
        "range_start": "struct_pack(\"start\" := '2024-03-01', \"end\" := CAST(NULL AS VARCHAR))",
        "range_both": "struct_pack(\"start\" := '2024-02-01', \"end\" := '2024-06-30')",
        "range_end": "struct_pack(\"start\" := CAST(NULL AS VARCHAR), \"end\" := '2024-09-30')"}),
})

# Feed documents: one per (host, page of 20 doc ids). Atom on even pages, RSS on
# odd ones; page % 7 = 3 is malformed XML, page % 11 = 5 has an unknown root.
_ENTRY = """
  CASE WHEN fk = 'atom' THEN concat('<entry><title>Entry ', CAST(doc_id AS {S}), '</title><link rel="alternate" href="', """ + _CANON + """, '"/>',
      '<id>', CASE WHEN doc_id % 3 = 0 THEN """ + _CANON + """ ELSE concat('tag:', host, ',2024:post/', CAST(doc_id AS {S})) END, '</id>',
      CASE WHEN doc_id % 2 = 0 THEN concat('<updated>', upd, 'T09:00:00Z</updated><published>', pub, 'T08:00:00Z</published>')
           ELSE concat('<published>', pub, 'T08:00:00Z</published><updated>', upd, 'T09:00:00Z</updated>') END, '</entry>')
  ELSE concat('<item><title>Entry ', CAST(doc_id AS {S}), '</title><link>', """ + _CANON + """, '</link>',
      '<guid isPermaLink="false">', CASE WHEN doc_id % 3 = 0 THEN """ + _CANON + """ ELSE concat('substack:post:', CAST(doc_id AS {S})) END, '</guid>',
      '<pubDate>', @rfc@, ' 08:00:00 GMT</pubDate></item>') END"""
_ENTRY_SRC = """
SELECT doc_id, host, slug, pub, pg, fk, upd, """ + _ENTRY + """ AS entry
FROM (SELECT doc_id, host, slug, pub, pg,
        CASE WHEN pg % 7 = 3 THEN 'malformed' WHEN pg % 11 = 5 THEN 'unknown'
             WHEN pg % 2 = 0 THEN 'atom' ELSE 'rss' END AS fk,
        substr(CAST(CAST(pub AS DATE) + 1 AS {S}), 1, 10) AS upd
      FROM (SELECT *, CAST(floor(doc_id / 20) AS BIGINT) AS pg FROM {fx_docs}) d0) d
"""
FIXTURES["fx_feed_entries"] = (["fx_docs"], {
    "spark": _sub(_ENTRY_SRC, {"rfc": "date_format(CAST(pub AS DATE), 'EEE, dd MMM yyyy')"}),
    "duckdb": _sub(_ENTRY_SRC, {"rfc": "strftime(CAST(pub AS DATE), '%a, %d %b %Y')"}),
})
_FEEDS2 = """
SELECT concat('https://', host, '/feed?page=', CAST(pg AS {S})) AS feed_url, fk AS kind,
  CASE WHEN fk = 'atom' THEN concat('<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>', host, '</title>', body, '</feed>')
       WHEN fk = 'rss' THEN concat('<?xml version="1.0"?><rss version="2.0"><channel><title>', host, '</title>', body, '</channel></rss>')
       WHEN fk = 'malformed' THEN concat('<feed><entry><title>broken</entry>', body, '</feed>')
       ELSE concat('<html><body><p>not a feed</p>', body, '</body></html>') END AS xml
FROM (SELECT host, pg, fk, @agg@ AS body FROM {fx_feed_entries} GROUP BY host, pg, fk) f
"""
FIXTURES["fx_feeds"] = (["fx_feed_entries"], {
    "spark": _sub(_FEEDS2, {"agg": "array_join(transform(array_sort(collect_list(named_struct('d', doc_id, 'e', entry))), x -> x.e), '')"}),
    "duckdb": _sub(_FEEDS2, {"agg": "string_agg(entry, '' ORDER BY doc_id)"}),
})

# Explicit feed jobs (``atom:`` / ``rss:`` with a feed URL), one per feed
# document; every third page declares the other type (a mismatch).
FIXTURES["fx_feed_jobs"] = (["fx_feeds"], """
SELECT concat('feedjob-', feed_url) AS job_id, feed_url,
  CASE WHEN CAST(regexp_extract(feed_url, 'page=([0-9]+)', 1) AS BIGINT) % 3 = 0
       THEN CASE WHEN kind = 'atom' THEN 'rss' ELSE 'atom' END ELSE kind END AS feed_type
FROM {fx_feeds} WHERE kind IN ('atom', 'rss')
""")

# Stored Markdown articles (input of the index build and of repair): normal
# files, files whose front matter was corrupted (a line moved above the first
# delimiter, snake_case keys), one without delimiters per 97 docs, one empty.
FIXTURES["fx_markdown"] = (["fx_docs"], """
SELECT concat('post-', CAST(doc_id AS {S})) AS slug,
  CASE WHEN doc_id % 97 = 1 THEN concat('just text ', body)
       WHEN doc_id % 97 = 2 THEN ''
       WHEN doc_id % 8 = 0 THEN concat('title: ', ttl, {NL}, '---', {NL},
            'publication_date: ''', pb, '''', {NL}, 'source_url: ', src, {NL}, 'post_id: ', slug, {NL},
            '---', {NL}, '## Part ', CAST(doc_id AS {S}), {NL}, body)
       ELSE concat('---', {NL}, 'title: ', ttl, {NL},
            CASE WHEN doc_id % 19 = 0 THEN '' ELSE concat('author: Author ', CAST(doc_id % 9 AS {S}), {NL}) END,
            'publication-date: ''', pb, '''', {NL},
            CASE WHEN doc_id % 21 = 0 THEN '' ELSE concat('source-url: ', src, {NL}) END,
            'post-id: ', slug, {NL}, 'article-key: ', slug, {NL}, '---', {NL}, {NL},
            '## Part ', CAST(doc_id AS {S}), {NL}, body) END AS md
FROM (SELECT doc_id, slug, body, """ + _SRC + """ AS src,
        CASE WHEN doc_id % 5 = 0 THEN 'Untitled' ELSE concat('Head ', CAST(doc_id AS {S})) END AS ttl,
        CASE WHEN doc_id % 17 = 0 THEN 'unknown' ELSE pub END AS pb
      FROM {fx_docs}) d
""")


# Front-matter values that need care: line breaks, quotes, colons, backslashes, padding. Every
# eleventh file is written by hand, with folded lines (7) or a nested list (5).
FIXTURES["fx_wild"] = (["fx_docs"], """
SELECT slug_id AS slug, host, pub, CASE WHEN doc_id % 11 = 5 THEN 'nested' WHEN doc_id % 11 = 7 THEN 'folded' ELSE 'engine' END AS written,
  CASE WHEN doc_id % 11 = 7 THEN concat('Folded over ', n) WHEN doc_id % 6 = 0 THEN concat('Line one', {NL}, ' Line two: ', n) WHEN doc_id % 6 = 1 THEN concat('Colon: ', n)
       WHEN doc_id % 6 = 2 THEN concat('It''s "quoted" ', n) WHEN doc_id % 6 = 3 THEN concat('back', chr(92), 'n ', n, {NL}, {NL}, '---', {NL}, '# ', chr(92))
       WHEN doc_id % 6 = 4 THEN concat('  padded ', n, '  ') ELSE concat('- dash ', n) END AS title,
  concat('A. "B" ', CAST(doc_id % 4 AS {S}), {NL}, 'C') AS author
FROM (SELECT *, CAST(doc_id AS {S}) AS n, concat('wild-', CAST(doc_id AS {S})) AS slug_id FROM {fx_docs}) d
""")


# A crawl queue in which every reason of admission occurs: pages that moved (completed under
# another URL), hosts on the ignore list, one page key on two hosts and on two lists, stored
# pages, malformed and blank lines. ``kind`` says which.
FIXTURES["fx_admission"] = (["fx_docs"], """
SELECT doc_id, kind, concat('list-', kind) AS list_name, CAST(doc_id AS BIGINT) AS pos, url, 'pending' AS state FROM (
  SELECT doc_id, 'a_moved' AS kind, concat('https://moved.folio-fixture.org/p/moved-', CAST(doc_id AS {S})) AS url FROM {fx_docs}
  UNION ALL SELECT doc_id, 'b_gone', concat('https://www.custom0.com/p/gone-', CAST(doc_id AS {S})) FROM {fx_docs} WHERE doc_id % 3 = 0
  UNION ALL SELECT doc_id, 'c_ignored', concat('https://www.custom1.com/p/ad-', CAST(doc_id AS {S})) FROM {fx_docs} WHERE doc_id % 4 = 1
  UNION ALL SELECT doc_id, 'd_first', concat('https://r1.folio-fixture.org/p/rep-', CAST(doc_id AS {S})) FROM {fx_docs} WHERE doc_id % 2 = 1
  UNION ALL SELECT doc_id, 'e_second', concat('https://r2.folio-fixture.net/p/rep-', CAST(doc_id AS {S}), '?ref=x') FROM {fx_docs} WHERE doc_id % 6 = 1
  UNION ALL SELECT doc_id, 'f_again', concat('https://r1.folio-fixture.org/p/rep-', CAST(doc_id AS {S})) FROM {fx_docs} WHERE doc_id % 10 = 1
  UNION ALL SELECT doc_id, 'g_stored', concat('https://any.folio-fixture.org/p/post-', CAST(doc_id AS {S})) FROM {fx_docs} WHERE doc_id % 5 = 2 OR doc_id % 23 = 0
  UNION ALL SELECT doc_id, 'h_malformed', concat('nonsense ', CAST(doc_id AS {S})) FROM {fx_docs} WHERE doc_id % 7 = 3
  UNION ALL SELECT doc_id, 'i_blank', '   ' FROM {fx_docs} WHERE doc_id % 9 = 4) q
""")

# Aliases of moved pages, beside those of fx_aliases.
FIXTURES["fx_moved_aliases"] = (["fx_admission", "fx_docs"], """
SELECT a.url, d.slug AS post_id, CAST(a.doc_id AS BIGINT) AS seq
FROM {fx_admission} a JOIN {fx_docs} d ON d.doc_id = a.doc_id
WHERE a.doc_id % 2 = 0 AND a.kind IN ('a_moved', 'b_gone')
""")

# Articles with several figures: titles, captions with markup, a wrapped CDN source inside a
# quote, figures without source or image, relative sources, one image that all pages share.
FIXTURES["fx_gallery"] = (["fx_docs"], """
SELECT doc_id, concat('https://gallery.folio-fixture.org/p/pic-', n) AS source_url,
  concat('<html><head><title>Pics ', n, '</title><link rel="canonical" href="https://gallery.folio-fixture.org/p/pic-', n, '"></head><body><p>Start ', n, '</p>',
    '<figure><img src="https://img.example.org/g/', n, '-a.png" alt="Alt A ', n, '" title="Title ', n, '"><figcaption>Cap <b>A</b> ', n, '</figcaption></figure>',
    '<figure><img alt="no source"></figure>',
    CASE WHEN doc_id % 2 = 0 THEN concat('<blockquote><figure><img src="https://cdn.example.com/image/w_10/https%3A%2F%2Fimages.example.net%2Fg%2F', n, '-b.jpg"></figure></blockquote>') ELSE '' END,
    '<figure><img src="/relative.png" alt="dropped"></figure>',
    CASE WHEN doc_id % 3 = 0 THEN '<figure><figcaption>Only a caption</figcaption></figure>' ELSE '' END,
    '<figure><a href="https://x.example.org/"><img src="https://img.example.org/shared.png?w=1#f" alt="Shared"></a></figure><p>End</p></body></html>') AS html,
  concat('pic-', n, '.html.meta.json') AS meta_file, concat('{{"source-url": "https://gallery.folio-fixture.org/p/pic-', n, '"}}') AS raw_json
FROM (SELECT doc_id, CAST(doc_id AS {S}) AS n FROM {fx_docs}) d
""")

# Pages with any of the three error texts (in other order than their rank), with such texts in
# other case, and without html.
FIXTURES["fx_marked"] = (["fx_docs"], """
SELECT doc_id, CASE WHEN doc_id % 11 = 5 THEN CAST(NULL AS {S}) ELSE concat('<html><body>',
    CASE WHEN doc_id % 2 = 1 THEN '<p>Too Many Requests</p>' ELSE '' END, '<p>', coalesce(body, ''), '</p>',
    CASE WHEN doc_id % 3 = 1 THEN '<h1>Page not found</h1>' ELSE '' END,
    CASE WHEN doc_id % 5 = 1 THEN '<h1>502 Bad Gateway</h1>' ELSE '' END,
    CASE WHEN doc_id % 4 = 0 THEN '<p>page not found, too many requests</p>' ELSE '' END, '</body></html>') END AS html
FROM {fx_docs}
""")

# Bodies with interactive furniture between their paragraphs, and names that only resemble it.
FIXTURES["fx_furnished"] = (["fx_docs"], """
SELECT doc_id, concat('https://f.folio-fixture.org/p/furnished-', CAST(doc_id AS {S})) AS source_url, coalesce(body, '') AS body,
  concat('<html><body><div class="body markup"><h2>Head ', CAST(doc_id AS {S}), '</h2><p>Start</p>',
    '<div class="x share-dialog"><p>Share this</p><div><p>and that</p></div></div>', '<p>Middle <em>', CAST(doc_id AS {S}), '</em></p>',
    CASE WHEN doc_id % 2 = 0 THEN '<div class="subscribe-widget"><form><p>Subscribe now</p></form></div>' ELSE '<div class="subscribe-footer"><p>Subscribe now</p></div>' END,
    '<p class="button-wrapper"><a href="https://x.example.org/share">Share</a></p>', '<div class="share-dialogs"><p>Stays</p></div><p>',
    replace(replace(replace(coalesce(body, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '</p><div class="post-footer"><p>Likes</p></div></div></body></html>') AS html
FROM {fx_docs}
""")

# Pages whose metadata is odd: a null source URL, a malformed one, another page's, broken JSON,
# none at all; some name another canonical link.
FIXTURES["fx_noted"] = (["fx_docs"], """
SELECT doc_id, n, concat('https://n.folio-fixture.org/p/note-', n) AS source_url,
  concat('<html><head><title>Note ', n, '</title>', CASE WHEN doc_id % 4 = 1 THEN concat('<link rel="canonical" href="https://n.folio-fixture.org/p/canon-', n, '">') ELSE '' END,
    '</head><body><p>', CASE WHEN doc_id % 9 = 7 THEN 'short' ELSE repeat('long text ', 60) END, '</p></body></html>') AS html,
  CASE doc_id % 6 WHEN 0 THEN '{{"source-url": null, "fetch-timestamp": "t"}}' WHEN 1 THEN '{{"source-url": "not a url"}}'
    WHEN 2 THEN concat('{{"source-url": "https://n.folio-fixture.org/p/note-', n, '?x=1"}}')
    WHEN 3 THEN concat('{{"source-url": "https://n.folio-fixture.org/p/other-', n, '"}}') WHEN 4 THEN '{{"source-url": ' END AS raw_json
FROM (SELECT doc_id, CAST(doc_id AS {S}) AS n FROM {fx_docs}) d
""")


def render(name: str, dialect: str, refs: dict[str, str] | None = None) -> str:
    """SQL text of one fixture; ``refs`` maps table names to references."""
    deps, tmpl = FIXTURES[name]
    text = tmpl[dialect] if isinstance(tmpl, dict) else tmpl
    subs = dict(DIALECT[dialect])
    for d in deps:
        subs[d] = (refs or {}).get(d, d)
    return text.format(**subs)


def _closure(names):
    order, seen = [], set()

    def visit(n):
        if n in seen or n not in FIXTURES:
            return
        seen.add(n)
        for d in FIXTURES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def duckdb_with(*names: str) -> str:
    """``WITH`` clause defining the named fixtures (and their dependencies) for
    DuckDB, where the raw tables are pre-registered views."""
    parts = [f"{n} AS ({render(n, 'duckdb')})" for n in _closure(names)]
    return "WITH " + ",\n".join(parts) + "\n"


class Fixtures:
    """Lazily built fixture DataFrames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._df: dict[str, DataFrame] = {}
        self._view: dict[str, str] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._df:
            if name in FIXTURES:
                deps = FIXTURES[name][0]
                refs = {d: self._view_of(d) for d in deps}
                self._df[name] = self.spark.sql(render(name, "spark", refs))
            else:
                self._df[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._df[name]

    def _view_of(self, name: str) -> str:
        if name not in self._view:
            v = f"folio_{name}_{uuid.uuid4().hex[:10]}"
            self.table(name).createOrReplaceTempView(v)
            self._view[name] = v
        return self._view[name]

    __getitem__ = table
    view = _view_of
