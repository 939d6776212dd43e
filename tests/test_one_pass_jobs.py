"""Jobs that parse or join once, rounds of discovery, rows that maintenance must change."""

import time

from pyspark.sql import functions as F

import __spark_entry__ as E
from folio.operators import admission, discovery, html_pass, maintenance
from folio.plans import discovery_plans as DP
from folio.session import scratch_path
from folio.sources.fixtures import Fixtures
from folio.sources.tables import alias_map, completed_set, ignore_set, scan_pages
from tests.conftest import SF_SMALL


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_discovery_parses_once(spark, monkeypatch):
    fx, passes = Fixtures(spark, SF_SMALL), []
    whole = discovery.html_pass
    monkeypatch.setattr(discovery, "html_pass", lambda *a, **k: passes.append(1) or whole(*a, **k))
    out = discovery.discovery_job(DP.links_of(fx), DP.ignored_of(fx), fx["fx_aliases"], fx["fx_queue"], scratch_path(spark, "links"), "now")
    assert len(passes) == 1 and not any("MapInArrow" in executed(df) for df in out.values())
    assert out["new_urls"].count() == out["crawl_job"].count() > 0 and out["external"].count() > 0
    separate = {tuple(r) for r in E.queries()["link_class_counts"](spark, SF_SMALL).collect()}
    assert {tuple(r) for r in out["counts"].collect()} == separate


def test_discovery_goes_on_until_nothing_is_new(spark):
    url = lambda k: f"https://a.substack.com/p/{k}"
    links = {"s": ["p1", "known"], "p1": ["p2", "p1"], "p2": ["p3", "s"], "p3": ["p1"], "known": ["never"], "other": ["unseen"]}
    table = spark.createDataFrame([(k, url(t), True) for k, ts in links.items() for t in ts] + [("s", url("unapproved"), False)], "source_key string, url string, approved boolean")
    aliases = spark.createDataFrame([(url("known"), "known", 1), (url("s"), "s", 1)], "url string, post_id string, seq bigint")
    queue = spark.createDataFrame([], "list_name string, pos bigint, url string, state string")
    got = discovery.discover_to_the_end(table, spark.createDataFrame([("s",)], "page_key string"), aliases, queue).collect()
    assert sorted(map(tuple, got)) == [(url("p1"), 1), (url("p2"), 2), (url("p3"), 3)]
    assert discovery.discover_to_the_end(table.limit(0), spark.createDataFrame([("s",)], "page_key string"), aliases, queue).count() == 0


def test_equal_crawl_rows_are_stored_once(spark):
    rows = [("https://a.org/p/x", "<p>1</p>")] * 3 + [("https://b.org/p/x", "<p>2</p>"), ("nowhere", "<p>3</p>"), ("nowhere", "<p>3</p>"), (None, None)]
    got = admission.ingest_pages(spark.createDataFrame(rows, "url string, html string"), "now").collect()
    assert sorted((r.source_url or "", r.action) for r in got) == [("", "malformed"), ("https://a.org/p/x", "exists"), ("https://a.org/p/x", "exists"), ("https://a.org/p/x", "store"),
                                                                   ("https://b.org/p/x", "exists"), ("nowhere", "malformed"), ("nowhere", "malformed")]


def test_integrity_joins_once(spark, monkeypatch):
    fx, joins = Fixtures(spark, SF_SMALL), []
    keep = maintenance.materialize
    monkeypatch.setattr(maintenance, "materialize", lambda df, *a: joins.append(executed(df).count("Join")) or keep(df, *a))
    found = maintenance.verify_integrity(scan_pages(fx["fx_pages"]), fx["fx_meta"])
    assert joins == [1] and "Join" not in executed(found)
    assert {r.category for r in found.select("category").distinct().collect()} == {"orphaned_html", "orphaned_meta", "corrupt_html", "corrupt_meta", "mismatched"}


def test_feeds_are_parsed_once(spark):
    fx = Fixtures(spark, SF_SMALL)
    feeds = spark.createDataFrame(fx["fx_feeds"].limit(5).collect(), fx["fx_feeds"].schema)
    plan = admission.feed_entries(feeds)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1 and plan.count("LogicalRDD") == 1
    odd = spark.createDataFrame([("a", None), ("b", ""), ("c", "<rss><channel/></rss>"), ("d", "<feed/>"), ("e", "<feed><entry><updated>2024-01-02T</updated></entry></feed>")], "feed_url string, xml string")
    got = {r.feed_url: (r.kind, r.link, r.published_date) for r in admission.feed_entries(odd).collect()}
    assert got["e"] == ("atom", None, "2024-01-02") and "c" not in got and "d" not in got and got["b"][0] == "error"


def test_pruning_removes_rows(spark):
    fx = Fixtures(spark, SF_SMALL)
    condemned = maintenance.prune_candidates(fx["fx_meta"], ignore_set(fx["fx_ignored"]))
    before, after = completed_set(fx["fx_completed"]).count(), maintenance.prune_completed(fx["fx_completed"], condemned).count()
    assert 0 < after < before
    before, after = alias_map(fx["fx_aliases"]).count(), maintenance.prune_aliases(fx["fx_aliases"], condemned).count()
    assert 0 < after < before
    counts = {r.metric: r.n for r in maintenance.pruned_counts(fx["fx_aliases"], condemned).collect()}
    assert counts["alias_entries_removed"] == before - after


def test_deep_pages_take_linear_time():
    def seconds(n):
        page = "<p><button>" + "<span><div>" * n + "x"
        began = time.perf_counter()
        assert html_pass.node_text(html_pass.parse_html(page)) == "x"
        return time.perf_counter() - began

    seconds(500)
    assert seconds(16_000) < 16 * max(seconds(4_000), 0.02)
    nested = html_pass.parse_html("<ul><li>a<ul><li>b<li>c</ul><li>d</ul><p>x<table><td><p>y<p>z</table><p>w")
    shape = lambda n: [c if isinstance(c, str) else (c.tag, shape(c)) for c in n.children]
    assert shape(nested) == [("ul", [("li", ["a", ("ul", [("li", ["b"]), ("li", ["c"])])]), ("li", ["d"])]), ("p", ["x"]), ("table", [("td", [("p", ["y"]), ("p", ["z"])])]), ("p", ["w"])]
