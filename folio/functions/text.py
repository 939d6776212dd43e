"""Text scalar operators (U10-U15) and front-matter formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
SHORT_PAGE_MAX_CHARS = 5000          # a "short" fetched page has fewer characters
SHORT_PAGE_BODY = "Too Many Requests"
MIN_HTML_BYTES = 500                 # integrity check: smaller files are corrupt
# Corruption markers checked anywhere in a stored page, in order, with reasons.
CORRUPTION_RULES = [
    ("502 Bad Gateway", "Title contains '502 Bad Gateway'"),
    ("Page not found", "Title contains 'Page not found'"),
    ("Too Many Requests", "Content is 'Too Many Requests' error page"),
]
SYNTHETIC_KEY_PREFIX = "unknown-article_"
DEFAULT_TITLE = "Untitled"
DEFAULT_DATE = "unknown"
DEFAULT_SOURCE = "unknown"
DEFAULT_AUTHOR = "unknown"
INDEX_DEFAULT_AUTHOR = "Unknown"
# Front-matter keys, in output order.
FRONT_MATTER_KEYS = ["title", "author", "publication-date", "source-url",
                     "canonical-url", "fetch-timestamp", "post-id", "article-key"]
# YAML escapes of double-quoted scalars (the backslash first), characters that need them, and
# YAML 1.1 implicit types: a plain scalar matching one of these would not read
# back as a string, so it must be quoted.
YAML_ESCAPES = {"\\": "\\", '"': '"', "0": "\0", "a": "\a", "b": "\b", "t": "\t", "n": "\n", "v": "\v", "f": "\f", "r": "\r", "e": "\x1b",
                "N": "\x85", "_": "\xa0", "L": "\u2028", "P": "\u2029"}
YAML_ESCAPED_RX = r"[\x00-\x08\x0a-\x1f\x7f\x85\u2028\u2029]"
YAML_IMPLICIT_RX = (
    r"^(?:~|null|Null|NULL|yes|Yes|YES|no|No|NO|true|True|TRUE|false|False|FALSE"
    r"|on|On|ON|off|Off|OFF|y|Y|n|N"
    r"|[-+]?(?:0|[1-9][0-9_]*)|[-+]?0[0-7_]+|[-+]?0x[0-9a-fA-F_]+|[-+]?0b[0-1_]+"
    r"|[-+]?(?:\.[0-9]+|[0-9][0-9_]*(?:\.[0-9_]*)?)(?:[eE][-+]?[0-9]+)?"
    r"|[-+]?\.(?:inf|Inf|INF)|\.(?:nan|NaN|NAN)"
    r"|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:(?:[Tt]|[ \t]+)[0-9]{1,2}:[0-9]{2}:[0-9]{2}"
    r"(?:\.[0-9]*)?(?:[ \t]*(?:Z|[-+][0-9]{1,2}(?::[0-9]{2})?))?)?"
    r"|<<|=)$"
)
# Other strings a YAML emitter cannot write plain: empty, leading/trailing
# blanks, a leading indicator character, ": " or " #", a trailing colon.
YAML_UNSAFE_RX = r"^$|^\s|\s$|^[-?:,\[\]{}#&*!|>'\"%@`]|: |\s#|:$"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(s) -> Column:
    """Trim all whitespace at both ends (Spark's ``trim`` only strips spaces)."""
    return F.regexp_replace(_c(s), r"^\s+|\s+$", "")


def is_short_error_page(html, body_text) -> Column:
    """Short page whose trimmed body text is exactly the rate-limit phrase."""
    return F.coalesce(
        (F.length(_c(html)) < SHORT_PAGE_MAX_CHARS) & (strip_ws(body_text) == SHORT_PAGE_BODY),
        F.lit(False))


def content_corruption_reason(html) -> Column:
    """First corruption marker found anywhere in the page, else null."""
    h = _c(html)
    expr = None
    for needle, reason in CORRUPTION_RULES:
        cond = F.instr(h, needle) > 0
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def kebab_key_line(line) -> Column:
    """``a_b: v`` -> ``a-b: v`` on the key part of one front-matter line."""
    ln = _c(line)
    key = F.regexp_extract(ln, r"^([^:\s][^:]*):(\s|$)", 1)
    return F.when(key != "", F.concat(F.translate(key, "_", "-"),
                                      F.substring(ln, F.length(key) + 1, 1 << 30))
                  ).otherwise(ln)


def feed_date_atom(s) -> Column:
    """U10 (Atom): first ten characters of the updated/published text."""
    return F.substring(_c(s), 1, 10)


def feed_date_rss(s) -> Column:
    """U10 (RSS): RFC-1123 date -> ISO local date ``yyyy-MM-dd``."""
    d = F.regexp_extract(_c(s), r"([0-9]{1,2} [A-Za-z]{3} [0-9]{4})", 1)
    return F.date_format(F.try_to_timestamp(d, F.lit("d MMM yyyy")), "yyyy-MM-dd")


def article_key(post_id, source_url) -> Column:
    """The slug, or a deterministic synthetic key when it is blank (V4)."""
    p = _c(post_id)
    return F.when(p.isNull() | (strip_ws(p) == ""),
                  F.concat(F.lit(SYNTHETIC_KEY_PREFIX), F.md5(F.coalesce(_c(source_url), F.lit("")))
                           )).otherwise(p)


def yaml_scalar(v) -> Column:
    """One YAML scalar that reads back as the same string: plain where that is so, double-quoted
    with escapes if the value holds line breaks or control characters, else single-quoted
    with ``''`` escaping; null -> ``null`` (V8)."""
    v = _c(v)
    quoted = F.concat(F.lit("'"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'"))
    escaped = v
    for letter, char in YAML_ESCAPES.items():
        escaped = F.replace(escaped, F.lit(char), F.lit("\\" + letter))
    return (F.when(v.isNull(), F.lit("null"))
            .when(v.rlike(YAML_ESCAPED_RX), F.concat(F.lit('"'), escaped, F.lit('"')))
            .when(v.rlike(YAML_IMPLICIT_RX) | v.rlike(YAML_UNSAFE_RX), quoted)
            .otherwise(v))


def _folded(s: Column) -> Column:
    """Line folding of YAML's flow scalars: one line break is a space, n of them are n - 1."""
    s = F.regexp_replace(s, r"[ \t]*\n[ \t]*", "\n")
    return F.regexp_replace(F.regexp_replace(s, r"(?<!\n)\n(?!\n)", " "), r"\n(\n+)", "$1")


def _unescaped(s: Column) -> Column:
    """A double-quoted scalar's content. Cut at escaped backslashes, so that what is left of
    an escape's backslash can only be its letter."""

    def coded(digits: int, code: str):
        return lambda y: F.concat(F.decode(F.unhex(F.substring(y, 1, digits)), code), F.substring(y, digits + 1, 1 << 30))

    def one(x: Column) -> Column:
        x = _folded(F.regexp_replace(x, r"\\[ \t]*\n[ \t]*", ""))
        for mark, digits, code in (("\\\\x", 2, "ISO-8859-1"), ("\\\\u", 4, "UTF-16BE")):
            cut = F.split(x, mark, -1)
            x = F.concat(F.element_at(cut, 1), F.array_join(F.transform(F.slice(cut, F.lit(2), F.size(cut)), coded(digits, code)), ""))
        for letter, char in YAML_ESCAPES.items():
            if char != "\\":
                x = F.replace(x, F.lit("\\" + letter), F.lit(char))
        return F.replace(F.replace(x, F.lit("\\/"), F.lit("/")), F.lit("\\ "), F.lit(" "))

    return F.array_join(F.transform(F.split(s, r"\\\\", -1), one), "\\")


def yaml_value(raw) -> Column:
    """The string that a scalar's text (with its continuation lines) stands for; null for
    YAML's nulls. Reads single and double quotes, folded plain text, literal (``|``) and
    folded (``>``) blocks."""
    raw = F.regexp_replace(_c(raw), r"^[ \t]+|\s+$", "")
    lines = F.slice(F.split(raw, "\n", -1), F.lit(2), F.greatest(F.size(F.split(raw, "\n", -1)) - 1, F.lit(0)))
    margin = F.length(F.regexp_extract(raw, r"\n( *)[^ \n]", 1))
    block = F.array_join(F.transform(lines, lambda x: F.substring(x, margin + 1, F.lit(1 << 30))), "\n")
    folds = F.regexp_replace(F.regexp_replace(block, r"(?<!\n)\n(?![\n ])", " "), r"\n(\n+)", "$1")
    chomp = F.when(raw.rlike(r"^[|>]-"), F.lit("")).otherwise(F.lit("\n"))
    return (F.when(raw.startswith("'"), F.replace(_folded(F.regexp_extract(raw, r"(?s)^'(.*)'$", 1)), F.lit("''"), F.lit("'")))
            .when(raw.startswith('"'), _unescaped(F.regexp_extract(raw, r'(?s)^"(.*)"$', 1)))
            .when(raw.rlike(r"^\|[+-]?(?:\n|$)"), F.concat(block, chomp))
            .when(raw.rlike(r"^>[+-]?(?:\n|$)"), F.concat(folds, chomp))
            .when(raw.isin("", "~", "null", "Null", "NULL"), F.lit(None).cast("string"))
            .otherwise(_folded(raw)))


def front_matter(fields: dict) -> Column:
    """``---`` block with the fixed key order; ``fields`` maps a front-matter
    key to ``(present: Column, value: Column)``. Absent keys produce no line."""
    lines = []
    for k in FRONT_MATTER_KEYS:
        if k not in fields:
            continue
        present, value = fields[k]
        lines.append(F.when(present, F.concat(F.lit(k + ": "), yaml_scalar(value), F.lit("\n"))))
    body = F.concat_ws("", *lines)
    return F.concat(F.lit("---\n"), body, F.lit("---\n\n"))


def clean_markdown(md) -> Column:
    """Drop blank lines, then trim the whole text."""
    return strip_ws(F.regexp_replace(_c(md), r"(?m)^\s*$\n", ""))
