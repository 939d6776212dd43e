"""Known articles are not compiled again, and nothing else changes by that."""

from pyspark.sql import functions as F

from folio.operators import articles, known
from folio.session import scratch_path
from folio.sources.fixtures import Fixtures
from folio.sources.tables import scan_pages
from tests.conftest import SF_SMALL


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("post-é-"), F.col("id").cast("string")).alias("k")).unionByName(spark.createDataFrame([(None,), ("",)], "k string"))
    f = known.key_filter(keys, "k")
    assert all(f(f"post-é-{i}") for i in range(5000)) and not f(None) and not f("")
    assert sum(f(f"other-{i}") for i in range(5000)) < 250
    assert not any(known.key_filter(keys.limit(0), "k")(f"x{i}") for i in range(100))


def stage(spark, parts=("body", "images"), work=None):
    fx = Fixtures(spark, SF_SMALL)
    return articles.parse_stage(scan_pages(fx["fx_pages"]), fx["fx_meta"], fx["fx_completed"], parts, work_dir=work)


def compiled_rows(spark, work):
    rows = spark.read.parquet(work)
    return rows.filter("deferred").count(), rows.filter("body_md IS NOT NULL").count(), rows.filter("deferred AND body_md IS NOT NULL").count()


def test_known_pages_are_not_compiled(spark, monkeypatch):
    work = scratch_path(spark, "known")
    columns = ["page_key", "status", "error", "n_images", "body_kind", F.when(F.col("status") == "compiled", F.col("markdown")).alias("markdown")]
    got = sorted(map(tuple, stage(spark, work=work).select(*columns).collect()), key=str)
    deferred, compiled, both = compiled_rows(spark, work)
    duplicates = stage(spark, ()).join(Fixtures(spark, SF_SMALL)["fx_completed"], "post_id", "left_semi").count()
    assert deferred >= duplicates > 0 and both == 0 and deferred + compiled == len(got)
    # a filter that holds every id: all pages with a canonical link wait for the exact decision
    full = known.KeyFilter(1 << 15, spark.sparkContext.broadcast(b"\xff" * (1 << 12)))
    monkeypatch.setattr(articles, "key_filter", lambda keys, column: full)
    work = scratch_path(spark, "known")
    everything = sorted(map(tuple, stage(spark, work=work).select(*columns).collect()), key=str)
    assert everything == got and compiled_rows(spark, work)[0] > deferred
