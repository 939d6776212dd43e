"""U1-U7, U16 on the reference's literal vectors (and a few edge cases)."""

from pyspark.sql import functions as F

from folio import functions as U

CDN = ("https://substackcdn.com/image/fetch/w_1456,c_limit,f_webp,q_auto:good,fl_progressive:steep/"
       "https%3A%2F%2Fsubstack-post-media.s3.amazonaws.com%2Fpublic%2Fimages%2F123.png")


def _eval(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "u string")
    return [r[0] for r in df.select(fn(F.col("u"))).collect()]


def test_slug(spark):
    got = _eval(spark, U.url_slug, ["https://author.substack.com/p/my-great-article",
                                    "https://author.substack.com/p/article-with-slash/",
                                    "https://author.substack.com/p/article-with_under/",
                                    "https://example.com/", "not-a-valid-url", None, "https://example.com"])
    assert got == ["my-great-article", "article-with-slash", "article-with_under", None, None, None, ""]


def test_meta_slug(spark):
    assert _eval(spark, U.meta_slug, ["my-article-slug.html.meta.json", ""]) == ["my-article-slug", ""]


def test_domain(spark):
    got = _eval(spark, U.url_domain, ["https://www.example.com/path/to/page", "http://sub.domain.co.uk?query=1",
                                      "www.missing-protocol.com", "not a url", None])
    assert got == ["www.example.com", "sub.domain.co.uk", None, None, None]


def test_canonical(spark):
    got = _eval(spark, U.url_canonical, ["https://example.com/page?query=1#fragment",
                                         "https://example.com/page?query=1", "https://example.com/page#fragment",
                                         "https://example.com/page", None, ""])
    assert got == ["https://example.com/page"] * 4 + [None, ""]


def test_image_local_path(spark):
    got = _eval(spark, U.image_local_path, ["http://example.com/images/test.jpg", CDN,
                                            "https://example.com/path/image.png?version=2&source=test",
                                            None, "", "   "])
    assert got == ["example.com/images/test.jpg", "substack-post-media.s3.amazonaws.com/public/images/123.png",
                   "example.com/path/image.png", None, None, None]


def test_image_local_path_python_twin_agrees(spark):
    from folio.operators.html_pass import image_local_path as py
    vals = ["http://example.com/images/test.jpg", CDN, "https://example.com/path/image.png?version=2",
            "/relative.png", "", "https://h.org", "ftp://h.org/a b.png ", "https://u@h.org:81/x/y.gif#f"]
    assert _eval(spark, U.image_local_path, vals) == [py(v) for v in vals]


def test_filename(spark):
    got = _eval(spark, U.url_filename, ["https://author.substack.com/p/my-great-article",
                                        "https://www.custom.com/p/another-great-article",
                                        "https://author.substack.com/p/article-with-slash/",
                                        "https://example.com/some/weird_path/", None, "", "   "])
    assert got == ["my-great-article.html", "another-great-article.html", "article-with-slash_.html",
                   "_some_weird_path_.html", None, None, None]


def test_first_label_and_feed_url(spark):
    assert _eval(spark, U.host_first_label, ["author3.substack.com", "x"]) == ["author3", "x"]
    assert _eval(spark, U.feed_url, ["author3", "www.custom1.com"]) == [
        "https://author3.substack.com/feed", "https://www.custom1.com/feed"]


def test_feed_post_id(spark):
    assert _eval(spark, U.feed_post_id, ["tag:x,2024:post/12", "substack:post:7", "https://h/p/x", None]) == [
        "12", "7", None, None]


def test_classify(spark):
    vals = ["https://a.substack.com/p/like-a-stone", "https://a.substack.com/p/real", "https://x.com/p/real",
            "https://cdn.substack.com/p/x", "https://a.substack.com/about", "https://substack.com/about",
            "https://en.wikipedia.org/wiki/X", "mailto:a@b.org", "/relative", "ftp://h.org/x",
            "https://h.org/subscribe?x=1"]
    assert _eval(spark, U.classify_link, vals) == [
        "noise", "substack_article", "substack_article", "noise", "noise", "external", "external",
        "noise", "noise", "noise", "noise"]
