"""Arrivals on inputs of several files: work is spread, nothing is lost."""

import glob
import os
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from folio.session import checkpoint_root
from folio.streaming import incremental as INC

FILES, ROWS = 6, 40


@pytest.fixture(scope="module")
def many_files(spark):
    """Documents in several files, each a split of its own."""
    d = tempfile.mkdtemp(prefix="folio-many-")
    rows = spark.range(FILES * ROWS, numPartitions=FILES).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of "), F.col("id").cast("string")).alias("text"))
    rows.write.parquet(f"{d}/documents.parquet")
    spark.range(30).select(F.col("id").alias("page_id"), F.concat(F.lit("https://h"), "id", F.lit(".example.org/p/x")).alias("url"), F.lit("<a href='x'>x</a>").alias("html")).write.parquet(f"{d}/pages.parquet")
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(map(os.path.getsize, glob.glob(f"{d}/documents.parquet/*.parquet")))))
    yield d
    for k, v in held.items():
        spark.conf.set(k, v)


def _inbox(spark, kind, before):
    (new,) = set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/folio/{kind}-*")) - before
    return new, [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{new}/inbox/*.parquet")]


@pytest.mark.parametrize("name,kind,arrivals", [("incremental_quarantine", "stream-extract", 3), ("incremental_discovery", "stream-discover", 3), ("incremental_page_outcomes", "stream-outcomes", 4)])
def test_an_arrival_is_a_batch_of_as_many_files_as_tasks_wrote(spark, many_files, name, kind, arrivals):
    before = set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/folio/{kind}-*"))
    E.queries()[name](spark, many_files).count()
    root, rows = _inbox(spark, kind, before)
    assert len([n for n in rows if n]) >= arrivals * FILES - arrivals and max(rows) <= ROWS
    if kind != "stream-outcomes":
        assert sum(rows) == FILES * ROWS and not glob.glob(f"{root}/arrivals/arrival=*/*.parquet")
    batches = glob.glob(f"{root}/out/*/batch_id=*")
    assert len(batches) == arrivals


def test_arrivals_of_few_rows(spark):
    """Fewer rows than arrivals: the empty ones come as well."""
    root = tempfile.mkdtemp(prefix="folio-few-")
    df = spark.createDataFrame([("k", "u", "h")], "page_key string, source_url string, html string")
    INC.deal_arrivals(df, f"{root}/arrivals", 3)
    for k in range(3):
        INC.arrive(spark, df.schema, f"{root}/arrivals", k, f"{root}/inbox")
    assert [tuple(r) for r in spark.read.parquet(f"{root}/inbox").collect()] == [("k", "u", "h")]
    assert len(glob.glob(f"{root}/inbox/*.parquet")) == 3
