"""U10-U15, E6 quoting, E7 cleanup."""

from pyspark.sql import functions as F

from folio import functions as U


def _eval(spark, fn, values, t="string"):
    df = spark.createDataFrame([(v,) for v in values], f"u {t}")
    return [r[0] for r in df.select(fn(F.col("u"))).collect()]


def test_yaml_scalar(spark):
    got = _eval(spark, U.yaml_scalar, ["My Test Title", "2024-01-05", "2025-06-14T14:13:21.778821106Z",
                                       "https://a.b/p/x?y=1#z", "unknown", "yes", "123", "it's: here", None, ""])
    assert got == ["My Test Title", "'2024-01-05'", "'2025-06-14T14:13:21.778821106Z'",
                   "https://a.b/p/x?y=1#z", "unknown", "'yes'", "'123'", "'it''s: here'", "null", "''"]


def test_clean_markdown(spark):
    raw = "\n## A\n\n  \nbody \n\n> \n> Quote\n> \n\n* one\n"
    assert _eval(spark, U.clean_markdown, [raw]) == ["## A\nbody \n> \n> Quote\n> \n* one"]


def test_short_error_page(spark):
    df = spark.createDataFrame([("<html>x</html>", " Too Many Requests \n"), ("x" * 6000, "Too Many Requests"),
                                ("<p>", "Too Many Requests!")], "h string, b string")
    got = [r[0] for r in df.select(U.is_short_error_page("h", "b")).collect()]
    assert got == [True, False, False]


def test_corruption_reason(spark):
    got = _eval(spark, U.content_corruption_reason, ["a 502 Bad Gateway Page not found", "x Page not found",
                                                     "<script>Too Many Requests</script>", "fine"])
    assert got == ["Title contains '502 Bad Gateway'", "Title contains 'Page not found'",
                   "Content is 'Too Many Requests' error page", None]


def test_kebab_and_feed_dates(spark):
    assert _eval(spark, U.kebab_key_line, ["publication_date: '2024'", "body: text_x", "no key here"]) == [
        "publication-date: '2024'", "body: text_x", "no key here"]
    assert _eval(spark, U.feed_date_rss, ["Mon, 01 Jan 2024 08:00:00 GMT", "Fri, 9 Feb 2024 00:00:00 +0000"]) == [
        "2024-01-01", "2024-02-09"]
