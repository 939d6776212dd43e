"""Restart safety of the incremental job, determinism of the ledger rebuild,
and the raw-file sources."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from folio.operators.articles import rebuild_ledger
from folio.session import scratch_path
from folio.sources.fixtures import Fixtures
from folio.sources.tables import (read_fetch_meta_files, read_markdown_files, read_page_files,
                                  read_url_lists, scan_pages)
from folio.streaming import incremental as INC
from tests.conftest import SF_SMALL


def test_rebuild_ledger_twice_is_identical(spark):
    fx = Fixtures(spark, SF_SMALL)
    a = rebuild_ledger(scan_pages(fx["fx_pages"]), fx["fx_meta"])
    b = rebuild_ledger(scan_pages(fx["fx_pages"]), fx["fx_meta"])
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_extract_restart(spark):
    """A second run on the same checkpoint consumes nothing twice; new files
    are picked up as new batches; every page ends up exactly once."""
    fx = Fixtures(spark, SF_SMALL)
    pages = scan_pages(fx["fx_pages"])
    root = scratch_path(spark, "restart-test")
    first, second = pages.filter(F.col("page_key") < "post-5"), pages.filter(F.col("page_key") >= "post-5")
    INC.stage_inbox(first, f"{root}/inbox", 2)
    run = lambda: INC.run_incremental_extract(spark, f"{root}/inbox", pages.schema, fx["fx_meta"],
                                              fx["fx_completed"], f"{root}/out", f"{root}/ckpt",
                                              batch_bytes=1)
    run()
    n1 = spark.read.parquet(f"{root}/out/stage").count()
    run()                                     # restart, nothing new
    assert spark.read.parquet(f"{root}/out/stage").count() == n1
    INC.stage_inbox(second, f"{root}/inbox", 2)
    run()                                     # restart with new arrivals
    st = spark.read.parquet(f"{root}/out/stage")
    assert st.count() == pages.count()
    assert st.groupBy("page_key").count().filter("count > 1").count() == 0
    compiled = st.filter((F.col("status") == "compiled") & F.col("post_id").isNotNull())
    assert compiled.groupBy("post_id").count().filter("count > 1").count() == 0


def test_file_sources(spark):
    d = tempfile.mkdtemp(prefix="folio-files-")
    os.makedirs(f"{d}/html"), os.makedirs(f"{d}/meta"), os.makedirs(f"{d}/md")
    pages = {"a-post": "<html><body><p>x</p></body></html>", "b_post": "<html></html>"}
    for k, h in pages.items():
        open(f"{d}/html/{k}.html", "w").write(h)
    open(f"{d}/meta/a-post.html.meta.json", "w").write(json.dumps(
        {"source-url": "https://h.org/p/a-post", "fetch-timestamp": "2025-06-14T14:13:21.778821106Z"}))
    open(f"{d}/meta/b_post.html.meta.json", "w").write('{"source-url": ')
    open(f"{d}/md/a-post.md", "w").write("---\ntitle: T\n---\n\nbody")
    open(f"{d}/md/notes.txt", "w").write("not markdown")

    p = {r.page_key: r.html for r in read_page_files(spark, f"{d}/html/*.html").collect()}
    assert p == pages
    m = {r.page_key: (r.meta_valid, r.meta_source_url) for r in read_fetch_meta_files(spark, f"{d}/meta/*.json").collect()}
    assert m == {"a-post": (True, "https://h.org/p/a-post"), "b_post": (False, None)}
    md = [(r.slug, r.md) for r in read_markdown_files(spark, f"{d}/md").collect()]
    assert md == [("a-post", "---\ntitle: T\n---\n\nbody")]


def test_url_list_files(spark):
    d = tempfile.mkdtemp(prefix="folio-lists-")
    open(f"{d}/job-1.txt", "w").write("https://a.org/p/x\n\n   \nhttps://a.org/p/y\n")
    open(f"{d}/job-2.txt", "w").write("https://b.org/p/z")
    got = sorted((r.list_name, r.pos, r.url) for r in read_url_lists(spark, f"{d}/*.txt", "done").collect())
    assert got == [("job-1.txt", 0, "https://a.org/p/x"), ("job-1.txt", 3, "https://a.org/p/y"),
                   ("job-2.txt", 0, "https://b.org/p/z")]


def test_articles_of_an_earlier_batch_stay(spark):
    from folio.operators.articles import read_articles, write_articles
    path = scratch_path(spark, "two-batches")
    row = lambda k, title: (k, title, "2024-05-01", "compiled")
    schema = "article_key string, title string, publication_date string, status string"
    write_articles(spark.createDataFrame([row("a", "1"), row("b", "1")], schema), path, 0)
    write_articles(spark.createDataFrame([row("b", "2"), row("c", "2")], schema), path, 1)
    write_articles(spark.createDataFrame([row("b", "2"), row("c", "2")], schema), path, 1)   # a replay
    assert sorted((r.article_key, r.title) for r in read_articles(spark, path).collect()) == [("a", "1"), ("b", "2"), ("c", "2")]


def test_every_page_comes_out_once(spark):
    """Shared, null and synthetic keys: no page is multiplied, lost or given another's body."""
    from folio.operators.articles import parse_stage
    page = lambda t: f"<html><body><p>{t}</p></body></html>"
    urls = ["https://a.org/", "https://b.org/", "https://c.org/", "not a url", None, "https://a.org/p/x", "https://b.org/p/y"]
    pages = scan_pages(spark.createDataFrame([(u, page(f"body {i}")) for i, u in enumerate(urls)], "source_url string, html string"))
    meta = spark.createDataFrame([(f"{k}.html.meta.json", "{}") for k in ("_", "x", "y")], "meta_file string, raw_json string")
    done = spark.createDataFrame([], "post_id string, seq bigint")
    rows = parse_stage(pages, meta, done, ("body",)).collect()
    assert sorted((r.page_url or "", r.body_markdown) for r in rows) == sorted((u or "", f"body {i}") for i, u in enumerate(urls))
    assert sorted(r.error for r in rows if r.error) == ["duplicate page key"] * 2 + ["malformed url"] * 2
    keys = [r.article_key for r in rows if r.status == "compiled"]
    assert len(keys) == len(set(keys)) == 3


def test_null_and_malformed_source_urls_are_findings(spark):
    from folio.operators.maintenance import verify_integrity
    html = "<html><body>" + "x" * 600 + "</body></html>"
    pages = spark.createDataFrame([(k, html) for k in "abc"], "page_key string, html string")
    meta = spark.createDataFrame([("a.html.meta.json", '{"source-url": null}'), ("b.html.meta.json", '{"source-url": "nowhere"}'),
                                  ("c.html.meta.json", '{"source-url": "https://h.org/p/c"}')], "meta_file string, raw_json string")
    got = {r.page_key: r.category for r in verify_integrity(pages, meta).collect()}
    assert got == {"a": "corrupt_meta", "b": "mismatched"}


def test_queries_run_from_another_folder():
    """The Python workers find the package wherever the driver was started."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.path.insert(0, %r)\nfrom pyspark.sql import SparkSession\n"
            "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "import __spark_entry__ as e\nprint('rows', e.queries()['select_body'](spark, %r).count())" % (root, SF_SMALL))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in out.stdout, out.stderr[-2000:]


def test_line_numbers_of_a_list_split_over_tasks(spark):
    """A list cut into many splits, with blank lines and both line ends: positions are exact."""
    import random
    rnd = random.Random(5)
    d = tempfile.mkdtemp(prefix="folio-long-lists-")
    want = []
    for name, n in (("long.txt", 6000), ("short.txt", 3)):
        lines = ["" if rnd.random() < 0.1 else f"https://h{rnd.randrange(9)}.org/p/{'x' * rnd.randrange(60)}{i}" for i in range(n)]
        open(f"{d}/{name}", "w", newline="").write("".join(s + rnd.choice(["\n", "\r\n"]) for s in lines))
        want += [(name, i, s) for i, s in enumerate(lines) if s]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        assert spark.read.text(d).rdd.getNumPartitions() > 20
        got = sorted((r.list_name, r.pos, r.url) for r in read_url_lists(spark, f"{d}/*.txt", "done").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(want)
