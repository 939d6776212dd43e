"""Front matter over several lines: what E6 writes, K6 and F5 read back; M2 repairs it."""

from pyspark.sql import functions as F

from folio.functions import front_matter
from folio.operators import index as IX

VALUES = ["plain", "Foo\n Bar", "a: b", "it's", 'say "hi"', "back\\slash", "mix \\n not break\n\"q\" 'x' \\\\ end\\", "tab\there", "\ttab first", "blank last ", "# hash", "- dash", "2024-01-01", "null", "~", "",
          "\u2028separators\u2029", "é\r\nü", "x\x85y", "---", "several\n---\nlines", "key: v\nother: w", "\\x41 \\u0041\n", "a\n\n\nb", "\0nul\x1b", "[a, b]", "| pipe", "> more", "x" * 50_000 + "\n'" * 2_000]


def test_values_come_back_unchanged(spark):
    rows = spark.createDataFrame([(f"s{i}", v) for i, v in enumerate(VALUES)], "slug string, title string")
    fields = {"title": (F.lit(True), F.col("title")), "author": (F.lit(True), F.col("title")), "publication-date": (F.lit(True), F.lit("2024-01-01")), "source-url": (F.lit(True), F.lit("https://h.org/p/x"))}
    md = rows.select("slug", F.concat(front_matter(fields), F.lit("# Body\n")).alias("md"))
    index = IX.build_article_index(md)
    assert {r.slug: (r.title, r.author, r.domain) for r in index.collect()} == {f"s{i}": (v, v, "h.org") for i, v in enumerate(VALUES)}
    assert [r.slug for r in IX.query_articles(index, title_contains="foo\n bar").collect()] == ["s1"]
    moved = md.select("slug", F.regexp_replace("md", r"(?s)^---\n(title: .*?)\nauthor: ", "$1\n---\nauthor: ").alias("md"))  # the title above the delimiter
    repaired = IX.repair_markdown(moved).filter("status = 'repaired'").select("slug", F.col("repaired").alias("md"))
    again = {r.slug: r.title for r in IX.build_article_index(repaired).collect()}
    assert again == {f"s{i}": v for i, v in enumerate(VALUES)}


BY_HAND = {
    "folded": ("---\ntitle: a long\n  title goes\n\n  on\nauthor: 'it''s\n  me'\n---\nx", ("a long title goes\non", "it's me")),
    "double": ('---\n# comment\ntitle: "a\\\n   b\\x41\\u00e9 \\\\n"\nauthor: >-\n  one\n  two\n---\n', ("abAé \\n", "one two")),
    "block": ("---\ntitle: |\n  l1\n   l2\nauthor: |-\n  x\n---\n", ("l1\n l2\n", "x")),
    "empty": ("---\ntitle:\nauthor: ''\n---\n", (None, "")),
    "list": ("---\ntitle:\n  - a\n---\n", None), "map": ("---\ntitle: x\nmeta:\n  a: b\n---\n", None),
    "open": ("---\ntitle: 'never closed\n---\n", None), "words": ("---\njust words\n---\n", None), "none": ("text", None), "nothing": ("", None), "null": (None, None)}


def test_files_written_by_hand(spark):
    rows = spark.createDataFrame([(k, v[0]) for k, v in BY_HAND.items()], "slug string, md string")
    got = {r.slug: (r.title, r.author) for r in IX.build_article_index(rows).collect()}
    assert got == {k: v for k, (_, v) in BY_HAND.items() if v}
    flat = "front matter is not flat"
    assert {r.slug: r.reason for r in IX.unreadable_markdown(rows).collect()} == {
        "list": flat, "map": flat, "open": flat, "words": flat, "none": "no front matter", "nothing": "no front matter", "null": "no front matter"}
