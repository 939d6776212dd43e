"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Rows per Arrow batch for tables that carry raw HTML (pages average ~300 kB in a
# real crawl); the Spark default of 10 000 rows would build multi-GB batches.
HTML_ARROW_BATCH_ROWS = 256
# Bytes of HTML that a Python worker parses and returns at a time, whatever the rows.
HTML_SLICE_BYTES = 8 << 20


def build_session(master: str | None = None, app: str = "folio",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings the operators are tuned for.

    On a cluster leave ``master`` unset (spark-submit supplies it) and size
    ``shuffle_partitions`` to the data; AQE coalesces small partitions and splits
    skewed ones at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(HTML_ARROW_BATCH_ROWS),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (HDFS/S3/...). Only a local-mode session
    without any checkpoint folder gets a private temporary one, as in tests
    (``spark.checkpoint.dir`` is a static setting, so the fallback goes through
    ``SparkContext.setCheckpointDir``)."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="folio-ckpt-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop resolves them: the same place that Spark reads and
    writes, on any store, also for a path without a scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller made."""
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    p = f"{root}/folio/{name}-{uuid.uuid4().hex[:12]}"
    fs, folder = hadoop_path(spark, p)
    fs.mkdirs(folder)
    return p


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """Jobs run inside hand Python at most ``rows`` rows at a time, whatever the session says:
    a worker holds a whole batch, so its memory is that of so many rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = spark.conf.get(key)
    if 0 < int(held) <= rows:
        yield
        return
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, held)


def html_batches(spark: SparkSession):
    """Batches of at most ``HTML_ARROW_BATCH_ROWS`` pages."""
    return arrow_batches(spark, HTML_ARROW_BATCH_ROWS)


def materialize(df, name: str, path: str | None = None):
    """Write ``df`` as Parquet under the shared checkpoint root and read it back.

    Used where one expensive result feeds several branches (the HTML pass feeds
    the metadata join, the ledger join and the first-per-post aggregate): it is
    computed once, lineage is cut (a lost executor does not re-run the Python
    pass), and each branch reads only the columns it needs."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
