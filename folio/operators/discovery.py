"""Link discovery.

Plan shape at scale: the HTML pass emits ``links`` per page (the only Python
step); links are exploded, filtered against the ignore list (small, size-checked
broadcast), classified by a native ``CASE``, restricted to known domains (a
``left_semi`` join, AQE picks broadcast or shuffle by the real size), and the
candidate URLs are de-duplicated and anti-joined against known URLs on the URL
itself — a high-cardinality key, so no host skew reaches a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from folio.functions import (host_first_label, page_key, url_canonical, url_domain,
                             url_host)
from folio.functions.urls import OTHER_SCHEME_RX, classify_parts, with_url_parts
from folio.operators.html_pass import html_pass
from folio.operators.joins import heavy_hitters, hot_keys, lookup, semi_join_hot
from folio.session import materialize
from folio.sources.tables import alias_map, scan_url_queue


def extract_links(pages: DataFrame) -> DataFrame:
    """Every anchor with an ``href`` anywhere in the page, text trimmed,
    with the page key as ``source_key``."""
    p = html_pass(pages, ["page_key"], parts=("links",))
    return p.select(F.col("page_key").alias("source_key"), F.explode("links").alias("l")) \
        .select("source_key", F.col("l.pos").alias("pos"), F.col("l.href").alias("href"),
                F.col("l.text").alias("link_text"))


def link_host(href) -> F.Column:
    """Host as the reference's URL class sees it: ``""`` for mailto/file URLs,
    null when malformed."""
    h = F.col(href) if isinstance(href, str) else href
    return F.coalesce(url_host(h), F.when(h.rlike(OTHER_SCHEME_RX), F.lit("")))


_P = "_lk_"          # prefix of the per-link URL-part columns
_PARTS = [_P + s for s in ("ok", "host", "path", "scheme")]


def with_link_parts(links: DataFrame) -> DataFrame:
    """Parse each href once into columns (``_lk_ok/host/path/scheme``); every
    later rule reads these columns instead of re-running the URL regexes."""
    return links if _P + "ok" in links.columns else with_url_parts(links, "href", _P)


def strip_link_parts(df: DataFrame) -> DataFrame:
    return df.drop(*_PARTS)


def drop_ignored(links: DataFrame, ignored: DataFrame) -> DataFrame:
    """drop links whose host or first host label is ignored, or whose URL is
    malformed (mailto/file URLs are valid with an empty host). Two ``left_anti``
    joins on equality (an OR condition would force a nested-loop join); the
    ignore list is a size-checked broadcast, so the skewed host column is never
    shuffled."""
    ign = lookup(ignored.select(F.col("domain").alias("ign")))
    l2 = with_link_parts(links)
    l2 = l2.withColumn("_host", F.when(F.col(_P + "ok"), F.col(_P + "host"))
                       .when(F.col("href").rlike(OTHER_SCHEME_RX), F.lit("")))
    l2 = l2.filter(F.col("_host").isNotNull()).withColumn("_label", host_first_label(F.col("_host")))
    l2 = l2.join(ign, l2._host == ign.ign, "left_anti")
    l2 = l2.join(ign, l2._label == ign.ign, "left_anti")
    return l2.drop("_host", "_label")


def classify(links: DataFrame) -> DataFrame:
    """Adds ``link_class`` (from the parsed URL parts)."""
    l2 = with_link_parts(links)
    return l2.withColumn("link_class", classify_parts(*[F.col(c) for c in _PARTS]))


def known_domains(aliases: DataFrame) -> DataFrame:
    """A1: distinct non-null hosts of alias-map URLs."""
    am = alias_map(aliases)
    return am.select(url_domain("url").alias("domain")).filter(F.col("domain").isNotNull()).distinct()


def known_urls(aliases: DataFrame, queue: DataFrame) -> DataFrame:
    """Alias-map URLs and in-flight (pending + done) queue URLs, canonical, distinct."""
    am = alias_map(aliases).select("url")
    q = scan_url_queue(queue, ("pending", "done")).select("url")
    return am.unionByName(q).select(url_canonical("url").alias("url")) \
        .filter(F.col("url").isNotNull()).distinct()


def hot_hosts(links: DataFrame, host: str = "host") -> list[str]:
    """Hosts that hold enough of the links to fill a shuffle partition: one pass over the host
    column, a bounded list."""
    found = links.agg(heavy_hitters(host).alias("hot")).first()["hot"]
    return hot_keys(found, int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def approved_articles(classified: DataFrame, domains: DataFrame | None, hot: list[str] | None = None) -> DataFrame:
    """article links whose host is a known domain; ``domains=None`` is the
    expand mode (every article link approved).

    ``hot``: hosts known to hold a large share of the links (``hot_hosts``), which are then
    looked up without a shuffle. It makes two filters of the links, so give it for links that
    are stored, not for ones that still come from the HTML pass."""
    arts = classified.filter(F.col("link_class") == "substack_article")
    if domains is None:
        return arts
    d = F.col(_P + "host") if _P + "host" in arts.columns else url_domain("href")
    return semi_join_hot(arts.withColumn("_d", d), "_d", domains.select("domain"), hot or []).drop("_d")


def known_domain_links(links: DataFrame, ignored: DataFrame, domains: DataFrame) -> DataFrame:
    """F4 as a job of its own: the article links are stored once with their hosts, a sketch
    over the stored hosts finds the hot ones, and only the other links are shuffled by host."""
    kept = classify(drop_ignored(links, ignored)).filter(F.col("link_class") == "substack_article")
    stored = materialize(strip_link_parts(kept.withColumn("host", F.col(_P + "host"))), "article-links")
    return semi_join_hot(stored, "host", domains.select("domain"), hot_hosts(stored)).drop("host")


def discover(links: DataFrame, ignored: DataFrame, aliases: DataFrame, queue: DataFrame,
             expand: bool = False) -> dict[str, DataFrame]:
    """The whole discovery job; returns its named outputs."""
    kept = classify(drop_ignored(links, ignored))
    approved = approved_articles(kept, None if expand else known_domains(aliases))
    candidates = approved.select(url_canonical("href").alias("url")).distinct()
    new = candidates.join(known_urls(aliases, queue), "url", "left_anti")
    return {"classified": strip_link_parts(kept), "approved": strip_link_parts(approved), "new_urls": new,
            "external": strip_link_parts(kept.filter(F.col("link_class") == "external"))}


def discover_new_articles(links, ignored, aliases, queue, expand=False) -> DataFrame:
    """Canonical approved article URLs not yet known."""
    return discover(links, ignored, aliases, queue, expand)["new_urls"]


def external_links(links, ignored) -> DataFrame:
    """External-class links, duplicates kept, in the catalogue's columns."""
    kept = classify(drop_ignored(links, ignored))
    return kept.filter(F.col("link_class") == "external").select(
        F.col("source_key").alias("source_article_key"), "link_text", F.col("href").alias("external_url"))


def link_class_counts(links, ignored, aliases, expand=False) -> DataFrame:
    """A2: links per class after the ignore filter, plus the approved count."""
    kept = classify(drop_ignored(links, ignored))
    approved = approved_articles(kept, None if expand else known_domains(aliases))
    by_class = kept.groupBy("link_class").agg(F.count(F.lit(1)).cast("bigint").alias("n_links"))
    n_approved = approved.agg(F.count(F.lit(1)).cast("bigint").alias("n_links")) \
        .select(F.lit("approved_article").alias("link_class"), "n_links")
    return by_class.unionByName(n_approved)


LINK_CLASSES = ("substack_article", "external", "noise")


def link_table(links: DataFrame, ignored: DataFrame, aliases: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """All links that the ignore list leaves, written once with what every output of
    discovery needs (class, canonical URL, whether the host is known), and the number of links
    by class, counted while they are written (A2). One pass over the HTML."""
    kept = classify(drop_ignored(links, ignored))
    hosts = known_domains(aliases).select(F.col("domain").alias("_d"), F.lit(True).alias("_known"))
    kept = kept.join(hosts, (F.col(_P + "host") == F.col("_d")) & (F.col("link_class") == LINK_CLASSES[0]), "left")
    out = strip_link_parts(kept.withColumn("approved", F.coalesce("_known", F.lit(False))).drop("_d", "_known")).withColumn("url", url_canonical("href"))
    seen = Observation()
    counts = [F.count_if(F.col("link_class") == c).alias(c) for c in LINK_CLASSES] + [F.count_if("approved").alias("approved_article")]
    out.observe(seen, *counts).write.mode("overwrite").parquet(path)
    return links.sparkSession.read.parquet(path), seen.get


def discovery_job(links: DataFrame, ignored: DataFrame, aliases: DataFrame, queue: DataFrame, path: str, job_ts: str, expand: bool = False) -> dict[str, DataFrame]:
    """The whole discovery job on one link table: ``new_urls`` (X2), ``crawl_job`` (K4),
    ``external`` (X5, K3) and ``counts`` (A2)."""
    table, counts = link_table(links, ignored, aliases, path)
    spark = links.sparkSession
    found = table.filter(F.col("link_class") == LINK_CLASSES[0]) if expand else table.filter("approved")
    new = found.select("url").distinct().join(known_urls(aliases, queue), "url", "left_anti")
    external = table.filter(F.col("link_class") == "external").select(F.col("source_key").alias("source_article_key"), "link_text", F.col("href").alias("external_url"))
    rows = [(k, n) for k, n in counts.items() if n or k == "approved_article"]
    return {"new_urls": new, "crawl_job": next_crawl_job(new, job_ts), "external": external, "counts": spark.createDataFrame(rows, "link_class string, n_links bigint")}


def discover_to_the_end(table: DataFrame, start: DataFrame, aliases: DataFrame, queue: DataFrame) -> DataFrame:
    """T4 to its end: (url, round) of all article URLs found from the pages of ``start``
    (column ``page_key``), from the pages under those URLs, and so on until a round finds
    nothing new. ``table``: the link table of all pages that can be fetched.

    Semi-naive: a round reads only the links of the pages that the last round found, so the
    rounds together read each page's links once. What is known is written once, each round's
    finds beside it."""
    links = table.filter("approved").select("source_key", "url")
    known = materialize(known_urls(aliases, queue), "discover-known")
    frontier, rounds = start.select("page_key").distinct(), []
    while True:
        new = links.join(frontier, links.source_key == F.col("page_key"), "left_semi").select("url").distinct()
        for earlier in [known, *rounds]:
            new = new.join(earlier.select("url"), "url", "left_anti")
        new = materialize(new.withColumn("round", F.lit(len(rounds) + 1)), "discover-round")
        if new.isEmpty():
            break
        rounds.append(new)
        frontier = new.select(page_key("url").alias("page_key")).filter("page_key is not null").distinct()
    out = known.select("url", F.lit(0).alias("round")).limit(0)
    for r in rounds:
        out = out.unionByName(r)
    return out


def next_crawl_job(new_urls: DataFrame, job_ts: str, reason: str = "discovery") -> DataFrame:
    """K4: the new URLs as one crawl job of the given time, unique and in ascending order
    (a range-partitioned global sort, no single-partition step). Empty input -> no rows."""
    return new_urls.select("url").distinct().withColumn("reason", F.lit(reason)) \
        .withColumn("job_ts", F.lit(job_ts)).orderBy("url")


def write_external_links(ext: DataFrame, path: str) -> None:
    """K3: CSV catalogue with a header (standard quoting, V9)."""
    ext.write.mode("overwrite").option("header", True).csv(path)


def ranked(df: DataFrame, by: str) -> DataFrame:
    """O1: the rows with their place (``rank``, from 0) in ascending order of ``by``.

    A range shuffle puts ever greater values into ever greater partitions, each of which sorts
    and numbers its own rows; the sizes of the partitions before (one row a partition) give
    the rest, so no task sees the whole order."""
    rows = materialize(df.repartitionByRange(by).sortWithinPartitions(by)
                       .select("*", F.monotonically_increasing_id().alias("_at")), "ranked")
    # the id holds the partition above bit 33 and the row's place in it below
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")) \
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.join(starts, part == F.col("_part")) \
        .select((F.col("_start") + place).alias("rank"), *df.columns)
