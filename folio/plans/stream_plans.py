"""Plans for incremental processing (T1-T4): each runs a real Structured
Streaming query (file source, checkpoint, availableNow, foreachBatch) into a
fresh folder under the shared checkpoint root and returns a batch read of it.

Arrival order across micro-batches decides which copy of a duplicated slug is
compiled, so the oracles compare only order-independent facts: the fields of
every page, that each new post id is compiled exactly once, the quarantine,
and the union of discoveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators.articles import image_refs
from folio.operators.discovery import extract_links  # noqa: F401  (documented dependency)
from folio.plans.parse_plans import _PARSE, PAGE_OUTCOMES
from folio.plans.registry import plan
from folio.plans.discovery_plans import _LINKS
from folio.session import scratch_path
from folio.sources.tables import ignore_set, scan_pages
from folio.streaming import incremental as INC

N_ARRIVALS = 3
#: A batch takes all files of an arrival: each is consumed before the next one comes.
WHOLE_ARRIVAL = 1 << 62


def _arrivals(fx, pages, root):
    """The pages come to the inbox in ``N_ARRIVALS`` parts; the caller consumes each before the next."""
    INC.deal_arrivals(pages, f"{root}/arrivals", N_ARRIVALS)
    for k in range(N_ARRIVALS):
        INC.arrive(fx.spark, pages.schema, f"{root}/arrivals", k, f"{root}/inbox")
        yield k


def _extract(fx):
    root = scratch_path(fx.spark, "stream-extract")
    pages = scan_pages(fx["fx_pages"])
    for _ in _arrivals(fx, pages, root):
        INC.run_incremental_extract(fx.spark, f"{root}/inbox", pages.schema, fx["fx_meta"], fx["fx_completed"],
                                    f"{root}/out", f"{root}/ckpt", batch_bytes=WHOLE_ARRIVAL)
    return fx.spark.read.parquet(f"{root}/out/stage")


@plan("incremental_extract", _PARSE + """SELECT page_key, article_key, post_id, title_d AS title, author,
  pub_d AS publication_date, source_url, CASE WHEN status = 'error' THEN 'error' ELSE 'ok' END AS outcome FROM s""")
def incremental_extract_q(fx):
    """Pending pages consumed incrementally; per-page results equal the batch job."""
    st = _extract(fx)
    return st.select("page_key", "article_key", "post_id", "title", "author", "publication_date", "source_url",
                     F.when(F.col("status") == "error", F.lit("error")).otherwise(F.lit("ok")).alias("outcome"))


@plan("incremental_dedup", _PARSE + """SELECT post_id, CAST(1 AS BIGINT) AS n_compiled FROM s
WHERE status <> 'error' AND post_id IS NOT NULL AND NOT in_ledger GROUP BY post_id""")
def incremental_dedup_q(fx):
    """With the ledger read once per batch, every new post id is compiled once."""
    st = _extract(fx)
    return st.filter((F.col("status") == "compiled") & F.col("post_id").isNotNull()) \
        .groupBy("post_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_compiled"))


@plan("incremental_quarantine", _PARSE + "SELECT page_key, error AS reason FROM s WHERE status = 'error'")
def incremental_quarantine_q(fx):
    """Bad pages are set apart and the stream goes on."""
    st = _extract(fx)
    return st.filter(F.col("status") == "error").select("page_key", F.col("error").alias("reason"))


@plan("incremental_image_manifest", _PARSE + """SELECT post_id, CAST(1 AS BIGINT) AS n_images FROM s
WHERE status <> 'error' AND post_id IS NOT NULL AND NOT in_ledger GROUP BY post_id""")
def incremental_image_manifest_q(fx):
    """T1 + E5: image records of the incrementally compiled articles, by post. Where two
    pages share an id either may be compiled, but only one: a replay or a copy in a later
    batch would count its images twice."""
    images = image_refs(_extract(fx).withColumn("article_key", F.col("post_id")))
    return images.filter(F.col("article_key").isNotNull()).groupBy(F.col("article_key").alias("post_id")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_images"))


@plan("incremental_page_outcomes", PAGE_OUTCOMES)
def incremental_page_outcomes_q(fx):
    """T1 + T3: awkward pages (one page key on two hosts, home pages, malformed URLs) that
    arrive host by host in batches of their own: the first page of a key owns it in all
    later batches, so every outcome equals the batch job's."""
    root = scratch_path(fx.spark, "stream-outcomes")
    pages = scan_pages(fx["fx_odd_pages"].select("source_url", "html"))
    of = F.when(F.col("source_url") < "https://b", 0).when(F.col("source_url") < "https://c", 1).when(F.col("source_url") < "https://i", 2).otherwise(3)
    for k in range(4):
        # as many files as tasks wrote them: a batch of one file would be parsed by one task
        pages.filter(of == k).write.mode("append").parquet(f"{root}/inbox")
        INC.run_incremental_extract(fx.spark, f"{root}/inbox", pages.schema, fx["fx_meta"], fx["fx_completed"], f"{root}/out", f"{root}/ckpt", batch_bytes=WHOLE_ARRIVAL)
    st = fx.spark.read.parquet(f"{root}/out/stage")
    return st.select(F.col("page_url").alias("source_url"), "page_key", "error", "status", F.when(F.col("status") == "compiled", F.col("body_markdown")).alias("body_markdown"))


_T4 = _LINKS.replace("L AS (SELECT source_key, pos, href, link_text FROM fx_links\n      UNION ALL SELECT",
                     "L AS (SELECT")


@plan("incremental_discovery", _T4 + "SELECT url FROM NEWU")
def incremental_discovery_q(fx):
    """T4: discovery as pages arrive; the union of batches equals one batch run."""
    root = scratch_path(fx.spark, "stream-discover")
    pages = scan_pages(fx["fx_pages"])
    for _ in _arrivals(fx, pages, root):
        INC.run_incremental_discovery(fx.spark, f"{root}/inbox", pages.schema, ignore_set(fx["fx_ignored"]),
                                      fx["fx_aliases"], fx["fx_queue"], f"{root}/out", f"{root}/ckpt", batch_bytes=WHOLE_ARRIVAL)
    return fx.spark.read.parquet(f"{root}/out/discovered").select("url")


