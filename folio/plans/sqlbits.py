"""DuckDB SQL text for the scalar rules, used only by oracles.

The URL/text rules in the oracle's dialect (RE2, ``'g'`` flag, ``split_part``). The URL
patterns are the engine's own fixed values, so a wrong pattern would not show here; the
vectors of ``tests/test_urls.py`` and the oracles by kind of row (``case_plans``) hold those.
"""

from folio.functions.urls import (ARTICLE_PATH_RX, NOISE_HOST_RX, NOISE_PATH_RX,
                                  PLATFORM_HOST_SUFFIX_RX, URL_RX)


def d_host(u: str) -> str:
    return f"(CASE WHEN regexp_matches({u}, '{URL_RX}') THEN regexp_extract({u}, '{URL_RX}', 1) END)"


def d_path(u: str) -> str:
    return (f"(CASE WHEN regexp_matches({u}, '{URL_RX}') THEN "
            f"regexp_replace(regexp_extract({u}, '{URL_RX}', 2), '\\s+$', '') END)")


def d_slug(u: str) -> str:
    p = d_path(u)
    return (f"(CASE WHEN {p} IS NULL THEN NULL WHEN {p} = '' THEN '' "
            f"ELSE nullif(regexp_extract({p}, '([^/]+)/*$', 1), '') END)")


def d_canonical(u: str) -> str:
    return f"regexp_replace({u}, '(?s)[#?].*$', '')"


def d_filename(u: str) -> str:
    p = d_path(u)
    return (f"(CASE WHEN {p} IS NOT NULL THEN concat(regexp_replace(regexp_replace({p}, '^/p/', ''), "
            f"'[^a-zA-Z0-9-]', '_', 'g'), '.html') END)")


def d_page_key(u: str) -> str:
    return f"regexp_replace({d_filename(u)}, '\\.html$', '')"


def d_strip(s: str) -> str:
    return f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g')"


def d_classify(u: str) -> str:
    h, p = d_host(u), d_path(u)
    scheme = f"lower(regexp_extract({u}, '^\\s*([A-Za-z]+):', 1))"
    return (f"(CASE WHEN {u} IS NULL OR NOT regexp_matches({u}, '{URL_RX}') THEN 'noise' "
            f"WHEN regexp_matches({p}, '{NOISE_PATH_RX}') THEN 'noise' "
            f"WHEN regexp_matches({h}, '{NOISE_HOST_RX}') THEN 'noise' "
            f"WHEN regexp_matches({p}, '{ARTICLE_PATH_RX}') THEN 'substack_article' "
            f"WHEN regexp_matches({h}, '{PLATFORM_HOST_SUFFIX_RX}') THEN 'noise' "
            f"WHEN {scheme} IN ('http', 'https') THEN 'external' ELSE 'noise' END)")


def d_image_path(u: str) -> str:
    clean = (f"(CASE WHEN instr({u}, '/https%3A') > 0 THEN "
             f"url_decode(regexp_extract({u}, '(?s)^.*/(https%3A.*)$', 1)) ELSE {u} END)")
    h, p = d_host(clean), d_path(clean)
    return (f"(CASE WHEN {u} IS NULL OR trim({u}) = '' THEN NULL "
            f"WHEN {h} IS NULL OR length({p}) < 1 THEN NULL "
            f"ELSE concat({h}, '/', substr({p}, 2)) END)")


def d_clean_md(s: str) -> str:
    return d_strip(f"regexp_replace({s}, '(?m)^\\s*$\\n', '', 'g')")
