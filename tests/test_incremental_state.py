"""Versioned tables, and what the incremental jobs keep from batch to batch."""

from pyspark.sql import functions as F

from folio.operators.articles import articles_table, prune_articles, read_articles, write_articles
from folio.session import scratch_path
from folio.sources.fixtures import Fixtures
from folio.sources.tables import ignore_set, scan_pages
from folio.sources.versioned import VersionedTable
from folio.streaming import incremental as INC
from tests.conftest import SF_SMALL

SCHEMA = "source_url string, html string"


def page(host, text, canonical=None):
    link = f'<link rel="canonical" href="{canonical}">' if canonical else ""
    return f"<html><head><title>{host}</title>{link}</head><body><p>{text}</p></body></html>"


def extract(spark, root, meta, done, **more):
    schema = scan_pages(spark.createDataFrame([], SCHEMA)).schema
    INC.run_incremental_extract(spark, f"{root}/inbox", schema, meta, done, f"{root}/out", f"{root}/ckpt", **more)
    return spark.read.parquet(f"{root}/out/stage")


def arrive(spark, root, rows):
    INC.stage_inbox(scan_pages(spark.createDataFrame(rows, SCHEMA)), f"{root}/inbox", 1)


def metas(spark, *keys):
    return spark.createDataFrame([(f"{k}.html.meta.json", '{"source-url": "https://a.org/p/%s"}' % k) for k in keys], "meta_file string, raw_json string")


def test_a_page_key_keeps_its_owner_over_batches(spark):
    root, done = scratch_path(spark, "owners"), spark.createDataFrame([], "post_id string")
    meta = metas(spark, "x", "y")
    arrive(spark, root, [("https://b.org/p/x", page("b", "first"))])
    extract(spark, root, meta, done)                                    # default arguments
    arrive(spark, root, [("https://a.org/p/x", page("a", "later")), ("https://a.org/p/y", page("a", "other"))])
    arrive(spark, root, [("https://b.org/p/x", page("b", "fetched again")), ("https://c.org/p/y", page("c", "late"))])
    st = extract(spark, root, meta, done, batch_bytes=1)
    got = sorted((r.page_url, r.status, r.error, r.body_markdown) for r in st.collect())
    assert got == [("https://a.org/p/x", "error", "duplicate page key", "later"), ("https://a.org/p/y", "compiled", None, "other"),
                   ("https://b.org/p/x", "compiled", None, "fetched again"), ("https://b.org/p/x", "compiled", None, "first"),
                   ("https://c.org/p/y", "error", "duplicate page key", "late")]
    owners = INC.extract_state(spark, f"{root}/out").read().filter("kind = 'owner'").select("page_key", "url").distinct().collect()
    assert sorted(map(tuple, owners)) == [("x", "https://b.org/p/x"), ("y", "https://a.org/p/y")]


def test_a_replayed_batch_leaves_no_double(spark, monkeypatch):
    """Killed between the stage and the ledger, and again between the ledger and the end of the batch."""
    root, done = scratch_path(spark, "replay"), spark.createDataFrame([], "post_id string")
    arrive(spark, root, [("https://a.org/p/x", page("a", "text", "https://a.org/p/x")), ("https://a.org/p/y", page("a", "same", "https://a.org/p/x"))])
    append, vacuum = VersionedTable.append, VersionedTable.vacuum

    def broken(*_):
        raise RuntimeError("lost")

    for name, whole in (("append", append), ("vacuum", vacuum)):
        monkeypatch.setattr(VersionedTable, name, broken)
        try:
            extract(spark, root, metas(spark, "x", "y"), done)
        except Exception as e:
            assert "lost" in str(e)
        else:
            raise AssertionError("the batch did not fail")
        monkeypatch.setattr(VersionedTable, name, whole)
    st = extract(spark, root, metas(spark, "x", "y"), done)
    assert sorted(r.status for r in st.collect()) == ["compiled", "duplicate"]
    ids = INC.extract_state(spark, f"{root}/out").read().filter("kind = 'id'")
    assert [r.post_id for r in ids.distinct().collect()] == ["x"] and sorted(r.url for r in INC.ledger(spark, f"{root}/out").filter("kind = 'alias'").collect()) == ["https://a.org/p/x", "https://a.org/p/y"]


def test_discovery_with_default_arguments(spark):
    fx, root = Fixtures(spark, SF_SMALL), scratch_path(spark, "discover-default")
    pages = scan_pages(fx["fx_pages"])
    INC.stage_inbox(pages, f"{root}/inbox", 2)
    INC.run_incremental_discovery(spark, f"{root}/inbox", pages.schema, ignore_set(fx["fx_ignored"]), fx["fx_aliases"], fx["fx_queue"], f"{root}/out", f"{root}/ckpt")
    urls = [r.url for r in spark.read.parquet(f"{root}/out/discovered").collect()]
    assert urls and len(urls) == len(set(urls))


def test_ledger_reads_a_bounded_number_of_files(spark):
    t = VersionedTable(spark, scratch_path(spark, "ledger"), "k bigint, batch bigint", ["k"], buckets=2, runs=4, reduce=lambda df: df.groupBy("k").agg(F.min("batch").alias("batch")))
    opened = []
    for b in range(50):
        assert not t.applied(b)
        t.append(spark.range(b * 10, b * 10 + 15).select(F.col("id").alias("k"), F.lit(b).cast("bigint").alias("batch")).coalesce(1), b)
        t.vacuum()
        assert t.applied(b) and len(t.versions()) <= 2
        opened.append(len(t.files()))
    assert opened[49] <= max(opened[:10]) and max(opened) <= 2 + 3
    got = t.read().groupBy("k").agg(F.min("batch").alias("b")).collect()
    assert sorted((r.k, r.b) for r in got) == [(k, min(b for b in range(50) if b * 10 <= k < b * 10 + 15)) for k in range(505)]
    assert len(t.read().inputFiles()) == len(t.files())


def test_article_versions(spark):
    path = scratch_path(spark, "versions")
    row = lambda k, title: (k, title, "2024-05-01", "compiled")
    schema = "article_key string, title string, publication_date string, status string"
    frame = lambda *rows: spark.createDataFrame(rows, schema)
    write_articles(frame(*(row(f"k{i}", "1") for i in range(20)), ("no", "1", None, "error")), path, 0, buckets=4)
    first = set(articles_table(spark, path).files())
    write_articles(frame(row("k3", "2"), row("new", "2")), path, 1)
    write_articles(frame(row("k3", "3")), path, 1)   # a replay changes nothing
    second = set(articles_table(spark, path).files())
    assert first & second and first - second and second - first   # untouched buckets are not copied
    prune_articles(spark, path, spark.createDataFrame([("k3",), ("k4",), (None,), ("absent",)], "article_key string"), 2)
    read = lambda v=None: {r.article_key: r.title for r in read_articles(spark, path, v).collect()}
    assert read(0) == {f"k{i}": "1" for i in range(20)}
    assert read(1) == read(0) | {"k3": "2", "new": "2"}
    assert read() == {k: v for k, v in read(1).items() if k not in ("k3", "k4")}
    assert len(read_articles(spark, path).inputFiles()) == len(articles_table(spark, path).files())   # no superseded file is opened
