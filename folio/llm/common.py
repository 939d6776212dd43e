"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.session import arrow_batches, checkpoint_root, hadoop_path, materialize, scratch_path  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session; hash buckets follow it, so a user
    who sizes partitions to the data sizes the buckets too."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that clash with no column of ``df`` (case-insensitively)."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def with_column(df: DataFrame, name: str, kind: str) -> T.StructType:
    """The schema of ``df`` and one more column at its end."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(f"`{name}` {kind}").fields])


def narrow(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns that the text operators read, under fixed names."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def batch_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, type=schema.field(k).type)
                                       for k, x in columns.items()], schema=schema)
