"""URL scalar operators (U1-U9, U16) as native Column expressions.

Every function maps Column -> Column and stays inside whole-stage codegen; none
is a Python UDF. The same patterns are valid for Java regex (Spark) and RE2
(DuckDB), which is what the oracle SQL uses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Absolute-URL shape accepted by the reference's URL class for the schemes it
# reads: group 1 = host (no userinfo, no port), group 2 = path (raw, untrimmed).
URL_RX = r"^\s*(?i:https?|ftp)://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"
# Schemes the reference treats as valid URLs that have no host/path of interest.
OTHER_SCHEME_RX = r"^\s*(?i:mailto|file):"
# Marker of a CDN-wrapped image URL; the real URL follows its last occurrence.
CDN_MARKER = "/https%3A"
# Path fragments and hosts of the link classifier, in rule order.
NOISE_PATH_RX = r"/subscribe|/comments|/comment/|/share|/like|/restack"
NOISE_HOST_RX = r"cdn\.substack\.com"
ARTICLE_PATH_RX = r"^/p/"
PLATFORM_HOST_SUFFIX_RX = r"\.substack\.com$"
PLATFORM_DOMAIN = ".substack.com"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_absolute_url(u) -> Column:
    return _c(u).rlike(URL_RX)


def url_host(u) -> Column:
    """Host of an absolute URL; null when the URL is malformed (U6 core)."""
    u = _c(u)
    return F.when(u.rlike(URL_RX), F.regexp_extract(u, URL_RX, 1))


def url_path(u) -> Column:
    """Path of an absolute URL with trailing whitespace dropped; null if malformed."""
    u = _c(u)
    return F.when(u.rlike(URL_RX),
                  F.regexp_replace(F.regexp_extract(u, URL_RX, 2), r"\s+$", ""))


def url_scheme(u) -> Column:
    u = _c(u)
    return F.when(u.rlike(URL_RX), F.lower(F.regexp_extract(u, r"^\s*([A-Za-z]+):", 1)))


def url_slug(u) -> Column:
    """Last non-empty path segment. ``/`` -> null, empty path -> ``""``."""
    p = url_path(u)
    return (F.when(p.isNull(), F.lit(None).cast("string"))
            .when(p == "", F.lit(""))
            .otherwise(F.nullif(F.regexp_extract(p, r"([^/]+)/*$", 1), F.lit(""))))


def meta_slug(f) -> Column:
    """Page key from a metadata file name."""
    return F.regexp_replace(_c(f), r"\.html\.meta\.json$", "")


def url_canonical(u) -> Column:
    """Cut at the first ``#`` or ``?``; null stays null."""
    return F.regexp_replace(_c(u), r"(?s)[#?].*$", "")


def _unwrap_cdn(u: Column) -> Column:
    tail = F.regexp_extract(u, r"(?s)^.*/(https%3A.*)$", 1)
    return F.when(F.instr(u, CDN_MARKER) > 0, F.try_url_decode(tail)).otherwise(u)


def image_local_path(u) -> Column:
    """U4: ``host/path`` of an image URL, CDN-unwrapped; null when blank/invalid."""
    u = _c(u)
    clean = _unwrap_cdn(u)
    host, path = url_host(clean), url_path(clean)
    return (F.when(u.isNull() | (F.trim(u) == ""), F.lit(None).cast("string"))
            .when(host.isNull() | (F.length(path) < 1), F.lit(None).cast("string"))
            .otherwise(F.concat(host, F.lit("/"), F.substring(path, 2, 1 << 30))))


def url_filename(u) -> Column:
    """Stored-page file name of a URL (path, ``/p/`` stripped, unsafe -> ``_``)."""
    p = url_path(u)
    return F.when(p.isNotNull(), F.concat(
        F.regexp_replace(F.regexp_replace(p, r"^/p/", ""), r"[^a-zA-Z0-9-]", "_"),
        F.lit(".html")))


def page_key(u) -> Column:
    """Page key = U5 without the ``.html`` suffix (identity rule 2)."""
    return F.regexp_replace(url_filename(u), r"\.html$", "")


def url_domain(u) -> Column:
    """Host of the trimmed URL, case kept, null if malformed."""
    return url_host(u)


def host_first_label(h) -> Column:
    """Text before the first dot of a host."""
    return F.substring_index(_c(h), ".", 1)


def feed_url(author) -> Column:
    """U8: an author with a dot is a domain, else a platform sub-domain."""
    a = _c(author)
    domain = F.when(F.instr(a, ".") > 0, a).otherwise(F.concat(a, F.lit(PLATFORM_DOMAIN)))
    return F.concat(F.lit("https://"), domain, F.lit("/feed"))


def feed_post_id(entry_id) -> Column:
    """Numeric post id at the end of an Atom ``id`` / RSS ``guid``."""
    s = _c(entry_id)
    a = F.regexp_extract(s, r"post/([0-9]+)$", 1)
    b = F.regexp_extract(s, r"substack:post:([0-9]+)$", 1)
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))


def classify_link(href) -> Column:
    """U16: link class, rules applied in the reference's order.

    Self-contained Column form; on wide plans prefer ``with_link_class`` which
    computes the URL parts once as columns (smaller generated code)."""
    h = _c(href)
    return classify_parts(h.isNotNull() & h.rlike(URL_RX), url_host(h), url_path(h), url_scheme(h))


def classify_parts(valid: Column, host: Column, path: Column, scheme: Column) -> Column:
    """U16 over pre-computed URL parts."""
    return (F.when(~F.coalesce(valid, F.lit(False)), F.lit("noise"))
            .when(path.rlike(NOISE_PATH_RX), F.lit("noise"))
            .when(host.rlike(NOISE_HOST_RX), F.lit("noise"))
            .when(path.rlike(ARTICLE_PATH_RX), F.lit("substack_article"))
            .when(host.rlike(PLATFORM_HOST_SUFFIX_RX), F.lit("noise"))
            .when(scheme.isin("http", "https"), F.lit("external"))
            .otherwise(F.lit("noise")))


def with_url_parts(df, col: str, prefix: str = "_u_"):
    """Adds ``{prefix}ok/host/path/scheme`` computed once per row, so later
    expressions reference columns instead of repeating the regexes."""
    u = F.col(col)
    df = df.withColumn(prefix + "ok", u.isNotNull() & u.rlike(URL_RX))
    ok = F.col(prefix + "ok")
    return (df.withColumn(prefix + "host", F.when(ok, F.regexp_extract(u, URL_RX, 1)))
              .withColumn(prefix + "path", F.when(ok, F.regexp_replace(F.regexp_extract(u, URL_RX, 2), r"\s+$", "")))
              .withColumn(prefix + "scheme", F.when(ok, F.lower(F.regexp_extract(u, r"^\s*([A-Za-z]+):", 1)))))


def with_link_class(df, col: str = "href", out: str = "link_class"):
    """U16 as a DataFrame step (parts computed once)."""
    p = "_lc_"
    d = with_url_parts(df, col, p)
    return d.withColumn(out, classify_parts(F.col(p + "ok"), F.col(p + "host"), F.col(p + "path"),
                                            F.col(p + "scheme"))) \
            .drop(p + "ok", p + "host", p + "path", p + "scheme")
