"""Tables that change by versions: a folder of Parquet files and one small manifest a version.

A manifest lists the files that make up its version, so a reader opens these and no
superseded ones, and earlier versions stay readable until they are vacuumed. A change
writes new files, then publishes its manifest by one rename: readers see the old version
or the new one. A table has one writer at a time (a streaming query, a job).

Two ways of change, by need:

* ``append`` for ledgers that only grow and are read as a whole: a batch adds one run of
  files; when there are ``runs`` of them they are merged into one, and that into the base once it
  is a quarter of it. A row is rewritten a logarithmic number of times and a reader opens a
  bounded number of files, whether five batches were written or fifty.
* ``upsert`` and ``delete`` for rows that are replaced by key: rows lie in buckets of the
  key's hash, and only the buckets that the change touches are copied on write.

Changes carry a batch number; ``applied`` tells a replayed batch that it is in already."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.session import hadoop_path

BUCKETS, RUNS = 16, 4
#: The merged run goes into the base when it has this share of the base's rows.
SHARE = 0.25


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, key: list[str], buckets: int = BUCKETS, runs: int = RUNS,
                 reduce: Callable[[DataFrame], DataFrame] | None = None):
        """``reduce``: what merging does to the rows of runs (default: distinct rows)."""
        self.spark, self.path, self.key, self.buckets, self.runs = spark, path.rstrip("/"), key, buckets, runs
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.reduce = reduce or (lambda df: df.distinct())

    # --- versions -----------------------------------------------------------------
    def versions(self) -> list[int]:
        fs, p = hadoop_path(self.spark, f"{self.path}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, by default of the last one (empty before the first)."""
        have = self.versions()
        if version is None and not have:
            return {"version": -1, "batch": None, "files": []}
        fs, p = hadoop_path(self.spark, f"{self.path}/versions/v{have[-1] if version is None else version:010d}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def applied(self, batch: int) -> bool:
        last = self.manifest()["batch"]
        return last is not None and last >= batch

    def files(self, version: int | None = None) -> list[str]:
        return [f"{self.path}/data/{f['file']}" for f in self.manifest(version)["files"]]

    def read(self, version: int | None = None) -> DataFrame:
        return self._of(self.manifest(version)["files"])

    def vacuum(self, keep: int = 2) -> None:
        """Only the last ``keep`` versions stay; files that none of them lists go."""
        have = self.versions()
        gone, stay = have[:-keep], have[-keep:]
        live = {f["file"] for v in stay for f in self.manifest(v)["files"]}
        dead = {f["file"] for v in gone for f in self.manifest(v)["files"]} - live
        for name in [f"data/{f}" for f in dead] + [f"versions/v{v:010d}.json" for v in gone]:
            fs, p = hadoop_path(self.spark, f"{self.path}/{name}")
            fs.delete(p, False)

    # --- changes ------------------------------------------------------------------
    def append(self, rows: DataFrame, batch: int) -> None:
        """One more run; merged with the others when there are enough of them."""
        old = self.manifest()
        self.buckets = old.get("buckets", self.buckets)
        added = self._write(rows, run="run")
        runs = [f for f in old["files"] if f["run"] != "base"]
        if len({f["commit"] for f in runs}) + 1 < self.runs:
            return self._publish(old, old["files"] + added, batch)
        base = [f for f in old["files"] if f["run"] == "base"]
        n_base, n_runs = (sum(f["rows"] for f in {x["commit"]: x for x in group}.values()) for group in (base, runs + added))
        if n_runs < SHARE * n_base:
            return self._publish(old, base + self._write(self.reduce(self._of(runs + added)), run="run"), batch)
        self._publish(old, self._write(self.reduce(self._of(base + runs + added)), run="base"), batch)

    def upsert(self, rows: DataFrame, batch: int) -> None:
        """The rows replace those of equal keys; one row a key among them."""
        self._rewrite(rows, rows.select(*self.key), batch)

    def delete(self, keys: DataFrame, batch: int) -> None:
        self._rewrite(None, keys.select(*self.key), batch)

    def _rewrite(self, rows: DataFrame | None, keys: DataFrame, batch: int) -> None:
        old = self.manifest()
        self.buckets = old.get("buckets", self.buckets)  # a table keeps the number that it began with
        touched = {r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect()}  # at most ``buckets`` numbers
        hit, rest = [f for f in old["files"] if f["bucket"] in touched], [f for f in old["files"] if f["bucket"] not in touched]
        kept = self._of(hit).join(keys.distinct(), self.key, "left_anti")
        now = kept if rows is None else kept.unionByName(rows.select(*self.schema.names))
        self._publish(old, rest + self._write(now, run="base"), batch)

    # --- files --------------------------------------------------------------------
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _of(self, files: list[dict]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/data/{f['file']}" for f in files)).select(*self.schema.names)

    def _write(self, rows: DataFrame, run: str) -> list[dict]:
        """New files in a folder of their own. A run is small and goes unbucketed."""
        commit = uuid.uuid4().hex[:16]
        out = rows.select(*self.schema.names)
        count = Observation()
        out = out.observe(count, F.count(F.lit(1)).alias("n"))
        if run == "base":
            out = out.withColumn("bucket_", self._bucket()).hint("rebalance", "bucket_")
            out.write.partitionBy("bucket_").parquet(f"{self.path}/data/{commit}")
        else:
            out.hint("rebalance").write.parquet(f"{self.path}/data/{commit}")
        n, found = count.get["n"], []
        fs, p = hadoop_path(self.spark, f"{self.path}/data/{commit}")
        listed = fs.listFiles(p, True)
        while listed.hasNext():
            name = listed.next().getPath().toString()
            if name.endswith(".parquet"):
                inside = name[name.index(commit):]
                bucket = int(inside.split("bucket_=")[1].split("/")[0]) if "bucket_=" in inside else None
                found.append({"file": inside, "bucket": bucket, "run": run, "commit": commit, "rows": n})
        return found if n else []

    def _publish(self, old: dict, files: list[dict], batch: int) -> None:
        version = old["version"] + 1
        body = json.dumps({"version": version, "batch": batch, "buckets": old.get("buckets", self.buckets), "files": files})
        fs, tmp = hadoop_path(self.spark, f"{self.path}/versions/_{uuid.uuid4().hex}")
        _, final = hadoop_path(self.spark, f"{self.path}/versions/v{version:010d}.json")
        stream = fs.create(tmp, False)
        try:
            stream.write(bytearray(body.encode()))
        finally:
            stream.close()
        if fs.exists(final) or not fs.rename(tmp, final):
            raise RuntimeError(f"{final.toString()} was published by another writer")
