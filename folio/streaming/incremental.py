"""Incremental processing (T1-T4) with Structured Streaming.

The reference consumes pending files and moves them to ``done``; here a
file-source stream over the page inbox plays that role, the checkpoint records
which files were consumed (restart-safe), and ``foreachBatch`` runs the batch
operators on each micro-batch:

* results are written under ``batch_id=<n>`` with overwrite, so a batch replayed
  after a failure replaces its own output (exactly once);
* what outlives a batch — completed ids, URL aliases, the owner of each page key,
  URLs that were discovered — is one versioned ledger (``sources.versioned``): a batch
  reads the version before it, a bounded number of files however many batches
  there were, and publishes its additions in one step after its results. A replay
  after that step finds its batch applied and does nothing. Batch numbers are those of the
  checkpoint, so an output folder belongs to one checkpoint: a new one needs a new folder;
* a page key belongs to the first page stored under it, in whatever batch: later
  pages of other URLs go to quarantine (T3);
* the parsed pages of a batch are scratch and go when its results are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import url_canonical
from folio.operators.articles import ledger_records, parse_stage
from folio.operators.discovery import (approved_articles, classify, drop_ignored, extract_links,
                                       known_domains, known_urls)
from folio.session import drop_folder, hadoop_path
from folio.sources.versioned import VersionedTable

# Input of one micro-batch: large enough that its fixed work does not matter.
BATCH_BYTES = 64 << 30
#: ``id``: a completed post_id; ``alias``: url -> post_id; ``owner``: page_key -> url of its page.
STATE_SCHEMA = "kind string, url string, post_id string, page_key string, batch bigint"


def _batch_dir(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def _settled(rows: DataFrame) -> DataFrame:
    """One row for each id, alias and owner: an alias keeps its last id, the others their first batch."""
    per = [F.col("kind"), F.when(F.col("kind") != "id", F.col("url")).alias("url"), F.when(F.col("kind") == "id", F.col("post_id")).alias("own_id"), F.col("page_key")]
    at = F.struct("batch", "post_id")
    return rows.groupBy(*per).agg(F.max(at).alias("last"), F.min("batch").alias("first")).select(
        "kind", "url", F.when(F.col("kind") == "alias", F.col("last.post_id")).otherwise(F.col("own_id")).alias("post_id"), "page_key",
        F.when(F.col("kind") == "alias", F.col("last.batch")).otherwise(F.col("first")).alias("batch"))


def extract_state(spark: SparkSession, out_root: str) -> VersionedTable:
    """The ledger of an incremental extraction."""
    return VersionedTable(spark, f"{out_root}/ledger", STATE_SCHEMA, ["kind", "url", "post_id", "page_key"], reduce=_settled)


def ledger(spark: SparkSession, out_root: str) -> DataFrame:
    """(kind, url, post_id): completed ids and aliases recorded by the batches so far."""
    return _settled(extract_state(spark, out_root).read().filter("kind <> 'owner'")).select("kind", "url", "post_id")


def stage_inbox(df: DataFrame, inbox: str, n_files: int) -> None:
    """Drop ``df`` into an inbox folder as ``n_files`` Parquet files (arrivals)."""
    df.repartition(n_files).write.mode("append").parquet(inbox)


def deal_arrivals(df: DataFrame, folder: str, n: int) -> None:
    """Deal the rows of ``df`` into ``n`` arrivals below ``folder``, in one pass and without a
    shuffle: every task writes the files of its own rows, so that the files of an arrival, and
    the tasks that later read them, grow with the input."""
    df.withColumn("arrival", F.pmod(F.monotonically_increasing_id(), F.lit(n))).write.partitionBy("arrival").parquet(folder)


def arrive(spark: SparkSession, schema, folder: str, k: int, inbox: str) -> None:
    """Arrival ``k`` of ``deal_arrivals`` moves into the inbox; one without rows is an empty file."""
    fs, came = hadoop_path(spark, f"{folder}/arrival={k}")
    if not fs.exists(came):
        return spark.createDataFrame([], schema).write.mode("append").parquet(inbox)
    fs.mkdirs(hadoop_path(spark, inbox)[1])
    for f in fs.listStatus(came):  # tasks name the files of all arrivals alike
        _, to = hadoop_path(spark, f"{inbox}/arrival-{k}-{f.getPath().getName()}")
        if not fs.rename(f.getPath(), to):
            raise RuntimeError(f"{to.toString()} did not arrive")


def pages_stream(spark: SparkSession, inbox: str, schema, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Pending pages; a micro-batch takes files up to ``batch_bytes`` (one at least)."""
    return (spark.readStream.schema(schema).option("maxBytesPerTrigger", str(int(batch_bytes)))
            .parquet(inbox))


def _drain(stream: DataFrame, each, ckpt: str) -> None:
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()


def run_incremental_extract(spark: SparkSession, inbox: str, schema, meta: DataFrame,
                            base_ledger: DataFrame, out_root: str, ckpt: str,
                            batch_bytes: int = BATCH_BYTES) -> None:
    """T1 + T2 + T3: consume all pending page files (availableNow), one parse
    stage per micro-batch. ``{out_root}/stage`` holds every page's outcome
    (compiled / duplicate / error = quarantine) per batch id, ``{out_root}/ledger``
    the state. Returns when the inbox is drained."""
    stage, state = f"{out_root}/stage", extract_state(spark, out_root)
    base = base_ledger.select("post_id")

    def each(batch: DataFrame, batch_id: int) -> None:
        if state.applied(batch_id):
            return
        earlier = state.read()
        done = base.unionByName(earlier.filter("kind = 'id'").select("post_id"))
        owners = earlier.filter("kind = 'owner'").groupBy("page_key").agg(F.min_by("url", "batch").alias("owner_url"))
        work = _batch_dir(f"{out_root}/parsed", batch_id)
        st = parse_stage(batch, meta, done.withColumn("seq", F.lit(0).cast("bigint")), work_dir=work, owners=owners)
        # one HTML pass per batch: the stage is written once, then read back
        st.write.mode("overwrite").parquet(_batch_dir(stage, batch_id))
        written = spark.read.parquet(_batch_dir(stage, batch_id))
        kept = written.filter((F.col("status") != "error") | (F.col("error") != "duplicate page key")).filter("page_key is not null")
        added = ledger_records(written.filter(F.col("status") != "error")).withColumn("page_key", F.lit(None).cast("string")).unionByName(
            kept.select(F.lit("owner").alias("kind"), F.coalesce("page_url", F.lit("")).alias("url"), F.lit(None).cast("string").alias("post_id"), "page_key"))
        state.append(added.withColumn("batch", F.lit(batch_id).cast("bigint")), batch_id)
        state.vacuum()
        drop_folder(spark, work)
        drop_folder(spark, f"{work}-late")

    _drain(pages_stream(spark, inbox, schema, batch_bytes), each, ckpt)


def run_incremental_discovery(spark: SparkSession, inbox: str, schema, ignored: DataFrame,
                              aliases: DataFrame, queue: DataFrame, out_root: str, ckpt: str,
                              batch_bytes: int = BATCH_BYTES) -> None:
    """T4: each micro-batch of newly stored pages yields the article URLs not
    known yet and not discovered by an earlier batch; the union over batches
    equals one batch discovery run over all pages."""
    found = f"{out_root}/discovered"
    seen = VersionedTable(spark, f"{out_root}/seen", "url string", ["url"])
    domains = known_domains(aliases)
    known = known_urls(aliases, queue)

    def each(batch: DataFrame, batch_id: int) -> None:
        if seen.applied(batch_id):
            return
        links = classify(drop_ignored(extract_links(batch), ignored))
        cand = approved_articles(links, domains).select(url_canonical("href").alias("url")).distinct()
        new = cand.join(known, "url", "left_anti").join(seen.read(), "url", "left_anti")
        new.write.mode("overwrite").parquet(_batch_dir(found, batch_id))
        seen.append(spark.read.schema("url string").parquet(_batch_dir(found, batch_id)), batch_id)
        seen.vacuum()

    _drain(pages_stream(spark, inbox, schema, batch_bytes), each, ckpt)
