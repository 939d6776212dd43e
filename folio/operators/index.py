"""Article index and queries.

Front matter is flat ``key: value`` YAML, so it is parsed with native array and
regex functions (``split``, ``array_position``, ``slice``, ``transform``): no
Python, whole files, one row per article.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import url_domain, yaml_scalar
from folio.functions.text import DEFAULT_TITLE, INDEX_DEFAULT_AUTHOR, yaml_value

# --- fixed values -----------------------------------------------------------
KV_RX = r"(?s)^([A-Za-z0-9_][A-Za-z0-9_-]*):(?:\s.*)?$"
# ---------------------------------------------------------------------------


def _lines(md: Column) -> Column:
    return F.split(md, "\r?\n", -1)


def _is_delim(x: Column) -> Column:
    return F.regexp_replace(x, r"^\s+|\s+$", "") == "---"


def _entries(lines: Column) -> Column:
    """Lines -> the text of each entry with its continuation lines, by a state machine over
    the lines: inside an open quote, or indented or blank, a line continues the entry;
    ``key:`` begins one; a comment is skipped; any other line is an entry that no key fits."""
    state = "struct<done:array<string>,now:string>"
    single, double = r"^[^:\s]+:[ \t]+'", r'^[^:\s]+:[ \t]+"'
    ended = r"(?:(?:[^']++|'')*+)'\s*$", r'(?:(?:[^"\\]++|\\(?s:.))*+)"\s*$'

    def step(a: Column, x: Column) -> Column:
        now = a["now"]
        is_open = now.isNotNull() & ((now.rlike(single) & ~now.rlike(single + ended[0])) | (now.rlike(double) & ~now.rlike(double + ended[1])))
        goes_on = now.isNotNull() & (is_open | x.rlike(r"^(?:\s|$)"))
        closed = F.when(now.isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(now)))
        return (F.when(goes_on, F.struct(a["done"].alias("done"), F.concat(now, F.lit("\n"), x).alias("now")))
                .when(x.rlike(r"^\s*(?:#|$)"), a)
                .otherwise(F.struct(closed.alias("done"), x.alias("now"))).cast(state))

    begin = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("now")).cast(state)
    return F.aggregate(lines, begin, step, lambda a: F.when(a["now"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["now"]))))


def parse_flat_yaml(lines: Column) -> Column:
    """array<string> of YAML lines -> array<struct<k, v, ok>>: one entry a key, with values
    over several lines; ``ok`` is false for an entry that is no flat ``key: value`` (nested
    maps and lists, open quotes)."""

    def entry(x: Column) -> Column:
        raw = F.regexp_extract(x, r"(?s)^[^:]*:(.*)$", 1)
        value = F.regexp_replace(raw, r"^[ \t]+|\s+$", "")
        quoted = value.rlike(r"(?s)^'(?:[^']++|'')*+'$") | value.rlike(r'(?s)^"(?:[^"\\]++|\\.)*+"$')
        block = value.rlike(r"^[|>][+-]?\n")
        nested = value.rlike(r"\n\s*(?:- |-$|[^\s:#][^:\n]*:(?:\s|$))")
        opened = value.startswith("'") | value.startswith('"')
        return F.struct(F.regexp_extract(x, KV_RX, 1).alias("k"), yaml_value(raw).alias("v"),
                        (x.rlike(KV_RX) & F.when(opened, quoted).otherwise(block | ~nested)).alias("ok"))

    return F.transform(_entries(lines), entry)


def _get(kv: Column, key: str) -> Column:
    return F.filter(kv, lambda x: x["k"] == key)


def front_matter_block(md: Column) -> Column:
    """Lines after a leading ``---`` up to the next ``---`` (or to the end);
    null when the first line is not a delimiter (or the file is empty)."""
    ls = _lines(md)
    rest = F.slice(ls, 2, F.greatest(F.size(ls) - 1, F.lit(0)))
    end = F.array_position(F.transform(rest, _is_delim), True)
    block = F.when(end > 0, F.slice(rest, 1, (end - 1).cast("int"))).otherwise(rest)
    return F.when((md != "") & _is_delim(F.element_at(ls, 1)), block)


def _first_line(md: Column) -> Column:
    return F.substring_index(md, "\n", 1)


def _once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Materialise ``expr`` as column ``name`` exactly once per row.

    Filters above a generator are not pushed below it, so the (whole-text)
    expression is not re-evaluated inside pushed-down predicates."""
    return df.select("*", F.explode(F.array(expr)).alias(name))


def _front_matter(markdown: DataFrame) -> DataFrame:
    """slug and ``kv``, the entries of the front matter, of files that begin with one.

    A cheap first-line test drops the others before any whole-text work; the text is split
    into lines once."""
    m = markdown.filter((F.col("md") != "") & _is_delim(_first_line(F.col("md")))).select("slug", "md")
    m = _once(m, "_ls", _lines(F.col("md"))).drop("md")
    m = m.withColumn("_rest", F.slice("_ls", 2, F.greatest(F.size("_ls") - 1, F.lit(0)))).drop("_ls")
    m = m.withColumn("_end", F.array_position(F.transform("_rest", _is_delim), True))
    m = m.select("slug", F.when(F.col("_end") > 0, F.slice("_rest", 1, (F.col("_end") - 1).cast("int")))
                 .otherwise(F.col("_rest")).alias("fm"))
    return _once(m, "kv", parse_flat_yaml(F.col("fm"))).drop("fm")


def build_article_index(markdown: DataFrame, base_path: str = "work/processed") -> DataFrame:
    """K6: one index row per article with front matter; files without it, or whose front
    matter is not flat YAML, are skipped (V13: empty files too; ``unreadable_markdown`` lists them)."""
    m = _front_matter(markdown).filter(F.forall("kv", lambda x: x["ok"]))
    m = m.select("slug", *[F.try_element_at(_get(F.col("kv"), k), F.lit(1)).alias(a) for k, a in
                           (("title", "_t"), ("author", "_a"), ("publication-date", "_p"), ("source-url", "_s"))])
    return m.select(
        "slug",
        F.concat(F.lit(base_path.rstrip("/") + "/"), F.col("slug"), F.lit(".md")).alias("path"),
        F.when(F.col("_t").isNull(), F.lit(DEFAULT_TITLE)).otherwise(F.col("_t.v")).alias("title"),
        F.when(F.col("_a").isNull(), F.lit(INDEX_DEFAULT_AUTHOR)).otherwise(F.col("_a.v")).alias("author"),
        F.col("_p.v").alias("publication_date"),
        url_domain(F.col("_s.v")).alias("domain"))


def unreadable_markdown(markdown: DataFrame) -> DataFrame:
    """K6's quarantine: the files that the index leaves out, with the reason and, where it is
    an entry, its text."""
    starts = F.coalesce((F.col("md") != "") & _is_delim(_first_line(F.col("md"))), F.lit(False))
    none = markdown.filter(~starts).select("slug", F.lit("no front matter").alias("reason"))
    bad = _front_matter(markdown).filter(F.exists("kv", lambda x: ~x["ok"])).select("slug", F.lit("front matter is not flat").alias("reason"))
    return none.unionByName(bad)


def query_articles(index: DataFrame, author: str | None = None, domain: str | None = None,
                   since: str | None = None, until: str | None = None,
                   title_contains: str | None = None) -> DataFrame:
    """conjunction of the optional filters. ``domain`` and the date bounds
    are plain comparisons that reach the Parquet scan; the substring filters
    are ``contains`` on lower-cased text (``%`` and ``_`` stay literal)."""
    df = index
    if author is not None:
        df = df.filter(F.col("author").isNotNull() & F.lower("author").contains(author.lower()))
    if domain is not None:
        df = df.filter(F.col("domain") == domain)
    if since is not None:
        df = df.filter(F.col("publication_date").isNotNull() & (F.col("publication_date") >= since))
    if until is not None:
        df = df.filter(F.col("publication_date").isNotNull() & (F.col("publication_date") <= until))
    if title_contains is not None:
        df = df.filter(F.col("title").isNotNull() & F.lower("title").contains(title_contains.lower()))
    return df


def export_query_subset(markdown: DataFrame, selection: DataFrame, path: str) -> None:
    """The selected articles materialised at ``path``; an earlier result
    of the same target is replaced."""
    markdown.join(selection.select("slug"), "slug", "left_semi").write.mode("overwrite").parquet(path)


def corrupt_markdown(markdown: DataFrame) -> DataFrame:
    """files whose first line (trimmed) is not ``---``."""
    return markdown.filter(~_is_delim(_first_line(F.col("md"))))


def repair_markdown(markdown: DataFrame) -> DataFrame:
    """M2: for each F7 file, lines above the first ``---`` join the YAML between
    the first two delimiters, keys are kebab-cased and the block is written
    back in front of the untouched body. Files without two delimiters or with
    non-flat YAML get ``repaired = null`` (skipped)."""
    c = _once(corrupt_markdown(markdown).select("slug", "md"), "ls", _lines(F.col("md")))
    idx = F.filter(F.sequence(F.lit(1), F.greatest(F.size("ls"), F.lit(1))),
                   lambda i: _is_delim(F.element_at(F.col("ls"), i)))
    c = c.withColumn("d", idx)
    first, second = F.element_at("d", 1), F.element_at("d", 2)
    two = F.size("d") >= 2
    misplaced = F.slice("ls", 1, (first - 1).cast("int"))
    yaml_lines = F.slice("ls", (first + 1).cast("int"), (second - first - 1).cast("int"))
    body = F.slice("ls", (second + 1).cast("int"), F.greatest(F.size("ls") - second, F.lit(0)).cast("int"))
    c = c.withColumn("kv", F.when(two, parse_flat_yaml(F.concat(
        F.when(first > 1, misplaced).otherwise(F.array().cast("array<string>")),
        F.when(second - first > 1, yaml_lines).otherwise(F.array().cast("array<string>"))))))
    c = c.withColumn("body", F.when(two, F.regexp_replace(F.array_join(body, "\n"), r"\n+$", "")))
    ok = two & F.forall("kv", lambda x: x["ok"])
    block = F.array_join(F.transform("kv", lambda x: F.concat(F.translate(x["k"], "_", "-"), F.lit(": "),
                                                              yaml_scalar(x["v"]))), "\n")
    repaired = F.concat(F.lit("---\n"), block, F.when(F.size("kv") > 0, F.lit("\n")).otherwise(F.lit("")),
                        F.lit("---\n"), F.col("body"))
    return c.select("slug", F.when(ok, repaired).alias("repaired"),
                    F.when(ok, F.lit("repaired")).otherwise(F.lit("skipped")).alias("status"))
