"""Job and fetch admission.

Feeds are parsed natively with ``from_xml`` (one schema covers Atom and RSS);
``xpath`` is used only for the Atom date, because the struct form loses the
document order of ``updated`` vs ``published``. Malformed XML is caught by the
corrupt-record column before ``xpath`` (which would throw) runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import (feed_date_atom, feed_date_rss, feed_post_id, feed_url, page_key,
                             url_canonical, url_host, url_slug)
from folio.operators.html_pass import html_pass
from folio.session import materialize
from folio.operators.joins import lookup
from folio.sources.tables import alias_map, completed_set

# --- fixed values -----------------------------------------------------------
UNKNOWN_JOB = "Unknown job type in job-spec"
UNKNOWN_ROOT = "Unknown feed type for root tag"
MALFORMED_XML = "malformed XML"
FEED_XML_SCHEMA = (
    "entry ARRAY<STRUCT<id: STRING, guid: STRING, link: ARRAY<STRUCT<_href: STRING, _VALUE: STRING>>>>, "
    "channel STRUCT<item: ARRAY<STRUCT<guid: STRUCT<_VALUE: STRING>, id: STRING, link: STRING, pubDate: STRING>>>, "
    "_corrupt_record STRING")
ATOM_DATE_XPATH = ("//*[local-name()='entry']/*[(local-name()='updated' or local-name()='published') and "
                   "not(preceding-sibling::*[local-name()='updated' or local-name()='published'])]/text()")
ROOT_RX = r"^\s*(?:<\?xml[^>]*\?>)?\s*(?:<!--.*?-->\s*)*<(?:[A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)"
# ---------------------------------------------------------------------------


def expand_job_specs(jobs: DataFrame) -> DataFrame:
    """``urls`` jobs -> one candidate per URL (null post id); ``author`` jobs
    -> their feed URL and date range; anything else -> an error row."""
    urls = jobs.filter(F.col("urls").isNotNull()) \
        .select("job_id", F.lit("urls").alias("kind"), F.posexplode("urls").alias("pos", "url")) \
        .select("job_id", "kind", "pos", "url", F.lit(None).cast("string").alias("error"))
    authors = jobs.filter(F.col("urls").isNull() & F.col("author").isNotNull()) \
        .select("job_id", F.lit("author").alias("kind"), F.lit(None).cast("int").alias("pos"),
                feed_url("author").alias("url"), F.lit(None).cast("string").alias("error"))
    bad = jobs.filter(F.col("urls").isNull() & F.col("author").isNull()) \
        .select("job_id", F.lit("unknown").alias("kind"), F.lit(None).cast("int").alias("pos"),
                F.lit(None).cast("string").alias("url"), F.lit(UNKNOWN_JOB).alias("error"))
    return urls.unionByName(authors).unionByName(bad)


def feed_entries(feeds: DataFrame) -> DataFrame:
    """Atom/RSS documents -> one row per entry (feed_url, kind, pos, link,
    published_date, post_id, error=null); a malformed document or an unknown
    root gives one error row."""
    x = F.col("xml")
    root = F.regexp_extract(x, ROOT_RX, 1)
    parsed = F.from_xml(x, FEED_XML_SCHEMA, {"mode": "PERMISSIVE",
                                             "columnNameOfCorruptRecord": "_corrupt_record"})
    # behind a generator each document is parsed once, whatever reads the parsed column
    f = feeds.select("feed_url", x.alias("xml"), root.alias("root"), F.explode(F.array(parsed)).alias("v"))
    ok = F.col("v._corrupt_record").isNull() & (F.col("root") != "")
    kind = F.when(~ok, F.lit("error")).when(F.col("root") == "feed", F.lit("atom")) \
            .when(F.col("root") == "rss", F.lit("rss")).otherwise(F.lit("error"))
    f = f.withColumn("kind", kind)
    none = F.lit(None).cast("string")

    def row(pos, link, date, post_id, error=none):
        return F.struct(pos.cast("int").alias("pos"), link.alias("link"), date.alias("published_date"), post_id.alias("post_id"), error.alias("error"))

    dates = F.expr(f"CASE WHEN kind = 'atom' THEN xpath(xml, \"{ATOM_DATE_XPATH}\") END")
    atom = F.transform(F.arrays_zip(F.col("v.entry").alias("entry"), dates.alias("date")), lambda e, i: row(
        i, F.get(e["entry"]["link"], F.lit(0))["_href"], feed_date_atom(e["date"]), feed_post_id(F.coalesce(e["entry"]["id"], e["entry"]["guid"]))))
    rss = F.transform(F.col("v.channel.item"), lambda e, i: row(
        i, e["link"], feed_date_rss(e["pubDate"]), feed_post_id(F.coalesce(e["id"], e["guid"]["_VALUE"]))))
    reason = F.when(F.col("v._corrupt_record").isNotNull(), F.lit(MALFORMED_XML)).otherwise(F.concat(F.lit(UNKNOWN_ROOT + ": "), F.col("root")))
    entries = F.when(F.col("kind") == "atom", atom).when(F.col("kind") == "rss", rss).otherwise(F.array(row(F.lit(None), none, none, none, reason)))
    return f.select("feed_url", "kind", F.explode(entries).alias("e")).select("feed_url", "kind", "e.*")


def in_date_range(date, start, end):
    """inclusive ``start <= date <= end``, each bound optional (V1: the
    documented intent, not the inverted comparison of the reference)."""
    d = F.col(date) if isinstance(date, str) else date
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return (s.isNull() | (d >= s)) & (e.isNull() | (d <= e))


def author_candidates(jobs: DataFrame, entries: DataFrame) -> DataFrame:
    """Author jobs joined to the entries of their feed (all pages of it), date
    range applied (F1)."""
    a = jobs.filter(F.col("urls").isNull() & F.col("author").isNotNull()) \
        .select("job_id", feed_url("author").alias("feed_base"),
                F.col("date_range.start").alias("rs"), F.col("date_range.end").alias("re"))
    e = entries.filter(F.col("error").isNull()).withColumn("feed_base", url_canonical("feed_url"))
    j = e.join(a, "feed_base")
    return j.filter(in_date_range("published_date", "rs", "re")) \
        .select("job_id", "feed_url", "pos", "link", "published_date", "post_id")


def job_candidates(jobs: DataFrame, entries: DataFrame) -> DataFrame:
    """All candidate articles of all jobs: (job_id, pos, link, post_id)."""
    u = expand_job_specs(jobs).filter(F.col("kind") == "urls") \
        .select("job_id", "pos", F.col("url").alias("link"), F.lit(None).cast("string").alias("post_id"))
    a = author_candidates(jobs, entries).select("job_id", "pos", "link", "post_id")
    return u.unionByName(a)


def new_articles(candidates: DataFrame, completed: DataFrame) -> DataFrame:
    """J2 (+V2, V3): candidates not yet complete. Anti-joined on the numeric id
    and on the slug of the link; null keys never match, so they stay."""
    done = completed_set(completed).select(F.col("post_id").alias("_d"))
    c = candidates.withColumn("_slug", url_slug("link"))
    c = c.join(done, c.post_id == done._d, "left_anti")
    c = c.join(done, c._slug == done._d, "left_anti")
    return c.drop("_slug")


def stage_counts(candidates: DataFrame, completed: DataFrame) -> DataFrame:
    """A4: per job, candidates, already complete and new (as J2 decides), in one aggregate
    over the candidates."""
    done = completed_set(completed).select(F.col("post_id").alias("_d"))
    by_id, by_slug = (done.select(F.col("_d").alias(k), F.lit(True).alias(f"{k}_done")) for k in ("_i", "_s"))
    c = candidates.withColumn("_slug", url_slug("link"))
    c = c.join(by_id, F.col("post_id") == F.col("_i"), "left").join(by_slug, F.col("_slug") == F.col("_s"), "left")
    known = F.coalesce("_i_done", "_s_done", F.lit(False))
    return c.groupBy("job_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_candidates"), F.count_if(known).cast("bigint").alias("n_completed"),
                                   F.count_if(~known).cast("bigint").alias("n_new"))


def write_url_queue(new: DataFrame) -> DataFrame:
    """K8: the new URLs of each job as pending queue lines (nothing for a job
    without new URLs)."""
    return new.select(F.col("job_id").alias("list_name"), F.col("pos").cast("bigint").alias("pos"),
                      F.col("link").alias("url"), F.lit("pending").alias("state"))


def resolve_url_to_id(urls: DataFrame, aliases: DataFrame, completed: DataFrame) -> DataFrame:
    """Raw URL -> post id (alias map, last write wins) -> in the ledger."""
    am = alias_map(aliases)
    j = urls.join(am, "url")
    return j.join(completed_set(completed), "post_id", "left_semi")


def fetch_admission(queue: DataFrame, stored: DataFrame, aliases: DataFrame,
                    completed: DataFrame, ignored: DataFrame) -> DataFrame:
    """Reason per queued URL, checks in the reference's order: ``malformed``
    (V6), ``exists`` (page key already stored, or an earlier admitted URL of this
    batch has the same key), ``completed`` (J4), ``ignored`` (exact host), else
    ``admit``."""
    q = queue.withColumn("page_key", page_key("url")).withColumn("_host", url_host("url"))
    st = stored.select(F.col("page_key").alias("_sk"), F.lit(True).alias("_stored")).distinct()
    q = q.join(st, q.page_key == st._sk, "left").drop("_sk")
    done = resolve_url_to_id(q.select("url").distinct(), aliases, completed) \
        .select(F.col("url").alias("_cu"), F.lit(True).alias("_completed")).distinct()
    q = q.join(done, q.url == done._cu, "left").drop("_cu")
    ign = lookup(ignored.select(F.col("domain").alias("_ig"), F.lit(True).alias("_ignored")))
    q = q.join(ign, q._host == ign._ig, "left").drop("_ig")
    base = (F.when(F.col("page_key").isNull(), F.lit("malformed"))
            .when(F.coalesce("_stored", F.lit(False)), F.lit("exists"))
            .when(F.coalesce("_completed", F.lit(False)), F.lit("completed"))
            .when(F.coalesce("_ignored", F.lit(False)), F.lit("ignored"))
            .otherwise(F.lit("admit")))
    q = q.withColumn("reason", base)
    # first admitted URL per page key wins (aggregate + join: skew-safe)
    first = q.filter(F.col("reason") == "admit").groupBy("page_key") \
        .agg(F.min(F.struct("list_name", "pos", "url")).alias("_first"))
    q = q.join(first, "page_key", "left")
    is_first = (F.col("_first.list_name") == F.col("list_name")) & (F.col("_first.pos") == F.col("pos")) \
        & (F.col("_first.url") == F.col("url"))
    q = q.withColumn("reason", F.when((F.col("reason") == "admit") & ~is_first, F.lit("exists"))
                     .otherwise(F.col("reason")))
    return q.select("list_name", "pos", "url", "page_key", "reason")


def ingest_pages(crawled: DataFrame, fetch_ts: str) -> DataFrame:
    """K9: crawl results (url, html) -> the page itself, its key, metadata JSON, and an
    action: ``malformed`` (no key), ``retry`` (a short rate-limit page is not stored),
    ``store``, or ``exists`` for a further page under a key that is stored already (the
    smallest URL, then content, is the one stored; of equal crawl rows, one)."""
    from folio.functions import is_short_error_page
    p = crawled.select("url", "html").withColumn("page_key", page_key("url")).withColumn("row_id", F.monotonically_increasing_id())
    p = html_pass(p, ["url", "page_key", "row_id"], parts=("short_body_text",), keep_html=True)
    action = (F.when(F.col("page_key").isNull(), F.lit("malformed"))
              .when(is_short_error_page("html", "short_body_text"), F.lit("retry")).otherwise(F.lit("store")))
    # written once, so that the row ids of both sides of the join agree
    p = materialize(p.withColumn("action", action).withColumn("_hash", F.xxhash64("html")).drop("short_body_text", "parse_error"), "ingest")
    owner = p.filter("action = 'store'").groupBy("page_key").agg(F.min(F.struct("url", "_hash", "row_id")).alias("_owner")) \
             .withColumnRenamed("page_key", "_key")
    p = p.join(owner, p.page_key == F.col("_key"), "left")
    first = F.col("row_id") == F.col("_owner.row_id")
    meta = F.to_json(F.struct(F.col("url").alias("source-url"), F.lit(fetch_ts).alias("fetch-timestamp")))
    return p.select("page_key", F.col("url").alias("source_url"), meta.alias("meta_json"), "html",
                    F.when((F.col("action") == "store") & ~first, F.lit("exists")).otherwise(F.col("action")).alias("action"))


FEED_TYPE_MISMATCH = "feed type does not match the document"


def feed_job_candidates(feed_jobs: DataFrame, entries: DataFrame) -> DataFrame:
    """x_feed_jobs: jobs naming a feed explicitly (``feed_type`` atom|rss and
    ``feed_url``) -> the entries of that document; a declared type that does
    not match the document's root, or a feed error, gives one error row."""
    e = entries.withColumnRenamed("kind", "doc_kind")
    j = feed_jobs.join(e, "feed_url")
    ok = (F.col("error").isNull()) & (F.col("doc_kind") == F.col("feed_type"))
    good = j.filter(ok).select("job_id", "feed_url", "pos", "link", "published_date", "post_id",
                               F.lit(None).cast("string").alias("error"))
    bad = j.filter(~ok).groupBy("job_id", "feed_url") \
        .agg(F.max(F.coalesce("error", F.lit(FEED_TYPE_MISMATCH))).alias("error")) \
        .select("job_id", "feed_url", F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("link"),
                F.lit(None).cast("string").alias("published_date"), F.lit(None).cast("string").alias("post_id"),
                "error")
    return good.unionByName(bad)
