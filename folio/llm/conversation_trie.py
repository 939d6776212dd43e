"""Prefix tree of conversations, built as a z-fast trie.

A conversation is a string of turns; its prefixes are known by chained 128-bit fingerprints.
The trie is compacted: a node stands for a branching or an end, with the edge of turns
that leads to it from its parent. Nodes are found by hashing: a node's handle is its prefix
whose length is the two-fattest number between the parent's depth (exclusive) and its own
(inclusive), the one divisible by the highest power of two. The depth at which a
conversation leaves the trie is found by fat binary search: probe the two-fattest length
of the interval left, go on below a node that is hit, above a length that is missed.
All conversations search together, a round is one join on the handles, and a conversation of
n turns needs about log2(n) rounds.

Conversations are inserted in batches: all that are pending locate their exits, those that
end inside an edge cut it, and one per new direction (by hash) hangs its rest below its exit as
one edge; the others search again in the enlarged trie. The directions of a batch are
distinct, so a batch has no conflicts, and a hot first turn costs one row in it. Sums over
subtrees go up the compacted trie by pointer doubling. Last, edges are expanded: every
depth on an edge is a node of the answer.

A conversation is one record of narrow rows (fingerprint and word count of each turn; texts
never move). The ends of one node, also if a third of all conversations, are sorted
and joined in pieces by many tasks; only their digest is taken in order, as a stream.

Results for odd input: rows with a null conversation id take no part; null turns come
first; a null role or text counts as empty; equal turn numbers are ordered by the turn's
fingerprint, so repeated rows are repeated turns; an empty table has no nodes, not even a
root; extra columns are ignored."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import materialize, partitions

WORD = r"[^\x20\x09-\x0D]+"
ROOT = bytes(16)
#: Ids of one end that are joined into one piece.
PIECE_IDS = 50_000

_PATHS = "conv_id long, end binary, n int, hs array<binary>, ws array<long>"
_NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turns_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the ordered turns of each conversation as (turn, fingerprint, words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    t = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("t"), F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("w"))
    return t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "t", "w"))).alias("turns"))


def regrafted(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first h turns replaced by those of conversation
    ``conv_id - conv_id % every``, where h = crc32(conv_id) mod ``most``."""
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = convs.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    own = F.when(F.size("turns") > h, F.slice("turns", h + 1, F.size("turns"))).otherwise(F.slice("turns", 1, 0))
    x = convs.withColumn("base", base).join(heads, "base", "left")
    head = F.when(F.col("head").isNotNull() & (h > 0), F.slice("head", F.lit(1), F.greatest(h, F.lit(1)))).otherwise(F.slice("turns", 1, 0))
    return x.select("conv_id", F.concat(head, own).alias("turns"))


def paths_of(convs: DataFrame) -> DataFrame:
    """Fingerprints of all prefixes of each conversation, and the words of its turns."""

    def chain(batches):
        for b in batches:
            ids, ends, sizes, hs, ws = [], [], [], [], []
            for conv, ts, words in zip(*(b.column(c).to_pylist() for c in ("conv_id", "ts", "ws")), strict=True):
                last, own = ROOT, []
                for t in ts:
                    last = hashlib.md5(last + t, usedforsecurity=False).digest()
                    own.append(last)
                for column, value in zip((ids, ends, sizes, hs, ws), (conv, last, len(own), own, words), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ends, pa.binary()), pa.array(sizes, pa.int32()), pa.array(hs, pa.list_(pa.binary())), pa.array(ws, pa.list_(pa.int64()))],
                                             ["conv_id", "end", "n", "hs", "ws"])

    return convs.select("conv_id", F.col("turns.t").alias("ts"), F.col("turns.w").alias("ws")).mapInArrow(chain, _PATHS)


def two_fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the highest power of two divides; null if there is none."""
    return F.expr(f"CASE WHEN {low} < {high} THEN {high} & shiftleft(-1, CAST(length(bin(CAST({low} ^ {high} AS BIGINT))) AS INT) - 1) END")


def _handled(nodes: DataFrame) -> DataFrame:
    """Nodes with the fingerprints they are found by: handle, and name (the edge's first turn)."""
    f = two_fattest("par_depth", "depth")
    return nodes.select("par_depth", "par_hash", "depth", "hash", "edge", "words").withColumn("f", f).select(
        "*", F.expr("element_at(edge, f - par_depth)").alias("handle"), F.expr("element_at(edge, 1)").alias("name")).drop("f")


def located(pending: DataFrame, nodes: DataFrame, deepest: int) -> DataFrame:
    """Where each pending conversation leaves the trie: ``exit`` (depth of the last shared
    turn), ``turn_to`` (fingerprint of the first own turn, null if it ends there) and ``cut``
    (the node in whose edge it leaves, null if it leaves at a node). ``deepest``: depth that no
    node exceeds, so no handle does."""
    p = pending.withColumn("l", F.lit(0)).withColumn("r", F.least("n", F.lit(deepest)))
    handles = nodes.select("handle", F.col("par_depth").alias("h_par"), F.col("depth").alias("h_depth"), F.col("hash").alias("h_hash"))
    for _ in range(deepest.bit_length()):
        p = p.withColumn("f", two_fattest("l", "r")).withColumn("probe", F.expr("CASE WHEN f IS NOT NULL THEN element_at(hs, f) END"))
        p = p.join(handles, F.col("probe") == F.col("handle"), "left")
        within = F.expr("h_depth <= n AND coalesce(try_element_at(hs, h_depth) = h_hash, false)")
        p = p.select(*pending.columns,
                     F.when(F.col("h_par").isNull(), F.col("l")).when(within, F.col("h_depth")).otherwise(F.col("h_par")).alias("l"),
                     # missed: above the probe; hit below the exit: done
                     F.when(F.col("f").isNull(), F.col("r")).when(F.col("h_par").isNull(), F.col("f") - 1).when(within, F.col("r")).otherwise(F.col("h_par")).alias("r"))
    # the exit's edge is the one below l in the conversation's own direction
    edges = nodes.select("name", F.col("edge").alias("e_edge"), F.col("hash").alias("e_hash"), F.col("depth").alias("e_depth"))
    p = p.withColumn("next", F.expr("try_element_at(hs, l + 1)")).join(edges, F.col("next") == F.col("name"), "left")
    p = p.withColumn("exit", F.col("l") + F.when(F.col("e_hash").isNull(), 0).otherwise(F.size(F.array_intersect("e_edge", "hs"))))
    return p.select(*pending.columns, "exit", F.expr("try_element_at(hs, exit + 1)").alias("turn_to"), F.when(F.col("exit") < F.col("e_depth"), F.col("e_hash")).alias("cut"))


def inserted(pending: DataFrame, nodes: DataFrame, deepest: int) -> tuple[DataFrame, DataFrame]:
    """One batch: the enlarged trie and the conversations that are still pending."""
    found = materialize(located(pending, nodes, deepest), "trie-exits")
    chosen = found.filter("turn_to IS NOT NULL").groupBy("turn_to").agg(F.min(F.struct(F.xxhash64("end").alias("o"), "end")).end.alias("end")).select("end")
    leaves = found.join(chosen, "end", "left_semi").select(
        F.col("exit").alias("par_depth"), F.when(F.col("exit") == 0, F.lit(ROOT)).otherwise(F.expr("try_element_at(hs, exit)")).alias("par_hash"), F.col("n").alias("depth"), F.col("end").alias("hash"),
        F.expr("slice(hs, exit + 1, n - exit)").alias("edge"), F.expr("slice(ws, exit + 1, n - exit)").alias("words"))
    cuts = found.filter("cut IS NOT NULL").groupBy("cut").agg(F.array_sort(F.collect_set("exit")).alias("cuts"))  # at most the edge's length
    parts = nodes.join(cuts, F.col("hash") == F.col("cut"), "left").withColumn("at", F.expr("concat(array(par_depth), coalesce(cuts, array()), array(depth))"))
    parts = parts.withColumn("i", F.explode(F.expr("sequence(1, size(at) - 1)"))).withColumn("lo", F.expr("element_at(at, i)")).withColumn("hi", F.expr("element_at(at, i + 1)")).select(
        F.col("lo").alias("par_depth"), F.expr("CASE WHEN i = 1 THEN par_hash ELSE element_at(edge, lo - par_depth) END").alias("par_hash"), F.col("hi").alias("depth"),
        F.expr("element_at(edge, hi - par_depth)").alias("hash"), F.expr("slice(edge, lo - par_depth + 1, hi - lo)").alias("edge"), F.expr("slice(words, lo - par_depth + 1, hi - lo)").alias("words"))
    grown = materialize(_handled(parts.unionByName(leaves)), "trie-nodes")
    return grown, materialize(found.filter("turn_to IS NOT NULL").select(*pending.columns).join(chosen, "end", "left_anti"), "trie-pending")


def compacted(texts: DataFrame) -> DataFrame:
    """The compacted trie, without the root, of distinct conversations (end, n, hs, ws)."""
    spark = texts.sparkSession
    nodes = _handled(spark.createDataFrame([], "par_depth int, par_hash binary, depth int, hash binary, edge array<binary>, words array<long>"))
    pending, deepest = texts.filter("n > 0").select("end", "n", "hs", "ws"), 0
    while not pending.isEmpty():
        nodes, pending = inserted(pending, nodes, deepest)
        deepest = nodes.agg(F.max("depth")).first()[0]
    return nodes


def subtree_sums(nodes: DataFrame, sums: list[str], least: list[str]) -> DataFrame:
    """(hash, the columns): sums and minima over each node's subtree, itself included; nodes
    (hash, par_hash, columns) with the root's parent null. By pointer doubling: after round
    k a node holds its descendants nearer than 2^k and points 2^k steps up."""
    columns = [*sums, *least]
    x = nodes.select("hash", F.col("par_hash").alias("up"), *columns)
    while True:
        x = materialize(x, "trie-sums")
        if not x.filter("up IS NOT NULL").limit(1).count():
            return x.drop("up")
        below = x.filter("up IS NOT NULL").groupBy(F.col("up").alias("of")).agg(*(F.sum(c).alias(f"b_{c}") for c in sums), *(F.min(c).alias(f"b_{c}") for c in least))
        above = x.select(F.col("hash").alias("at"), F.col("up").alias("further"))
        x = x.join(below, F.col("hash") == F.col("of"), "left").join(above, F.col("up") == F.col("at"), "left").select(
            "hash", F.col("further").alias("up"), *((F.col(c) + F.coalesce(F.col(f"b_{c}"), F.lit(0))).alias(c) for c in sums), *(F.least(c, f"b_{c}").alias(c) for c in least))


def end_digests(paths: DataFrame) -> DataFrame:
    """(hash, ends_sha256): SHA-256 of the ids that end at a node, ascending, joined by commas."""
    n = partitions(paths.sparkSession)

    def pieces(batches):
        for b in batches:
            ends, ids = b.column("end").to_pylist(), b.column("conv_id").to_numpy()
            starts = [i for i in range(len(ends)) if i == 0 or ends[i] != ends[i - 1]] + [len(ends)]
            cut = [(a, min(a + PIECE_IDS, z)) for s, z in zip(starts, starts[1:], strict=False) for a in range(s, z, PIECE_IDS)]
            yield pa.RecordBatch.from_arrays([pa.array([ends[a] for a, _ in cut], pa.binary()), pa.array([int(ids[a]) for a, _ in cut], pa.int64()),
                                              pa.array([",".join(map(str, ids[a:z].tolist())) for a, z in cut], pa.string())], ["end", "first_id", "piece"])

    def digests(batches):
        now, digest = None, None
        for b in batches:
            out: list[tuple] = []
            for end, piece in zip(b.column("end").to_pylist(), b.column("piece").to_pylist(), strict=True):
                if end == now:
                    digest.update(b"," + piece.encode())
                    continue
                if now is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = end, hashlib.sha256(piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], ["hash", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["hash", "ends_sha256"])

    ordered = paths.select("end", "conv_id").repartitionByRange(n, "end", "conv_id").sortWithinPartitions("end", "conv_id")
    joined = ordered.mapInArrow(pieces, "end binary, first_id long, piece string")
    return joined.repartition(n, "end").sortWithinPartitions("end", "first_id").mapInArrow(digests, "hash binary, ends_sha256 string")


def expanded(nodes: DataFrame) -> DataFrame:
    """Every depth of every edge as a node of its own."""
    empty = hashlib.sha256(b"").hexdigest()
    schema = pa.schema([(c, pa.string() if c == "ends_sha256" else pa.int64()) for c in (x.split()[0] for x in _NODES.split(", "))])

    def expand(batches):
        for b in batches:
            for r in b.to_pylist():
                size = len(r["words"])
                if not size:  # the root
                    yield pa.RecordBatch.from_pylist([r | {"conv_id": r["first_id"], "parent_conv_id": None, "saved_tokens": r["below"]}], schema)
                    continue
                first = r["first_id"]
                children, digests, parents = np.ones(size, np.int64), [empty] * size, np.full(size, first)
                children[-1], digests[-1], parents[0] = r["n_children"], r["ends_sha256"], r["parent_id"]
                rest = np.cumsum(np.array(r["words"])[::-1])[::-1] * (r["n_convs"] - 1) + r["below"]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((np.full(size, first), np.arange(size) + r["depth"] - size + 1, parents, np.full(size, r["n_convs"]), children,
                                                                                       np.full(size, r["n_leaves"]), rest, digests), schema, strict=True)], schema=schema)

    def joined(batches):
        held, n = [], 0
        for b in expand(batches):
            held.append(b)
            n += len(b)
            if n >= 10_000:
                yield from pa.Table.from_batches(held, schema).combine_chunks().to_batches()
                held, n = [], 0
        yield from pa.Table.from_batches(held, schema).combine_chunks().to_batches()

    return nodes.mapInArrow(joined, _NODES)


def trie(convs: DataFrame) -> DataFrame:
    """The nodes of the prefix tree of conversations (conv_id, turns as ``turns_of`` gives)."""
    paths = materialize(paths_of(convs), "trie-paths")
    texts = materialize(paths.groupBy("end").agg(F.count(F.lit(1)).alias("ends"), F.min("conv_id").alias("first_id"), F.first("n").alias("n"), F.first("hs").alias("hs"), F.first("ws").alias("ws")), "trie-texts")
    edges = compacted(texts).select("hash", "par_hash", "depth", "words")
    spark = convs.sparkSession
    root = spark.createDataFrame([(ROOT, None, 0, [])], "hash binary, par_hash binary, depth int, words array<long>")
    children = edges.groupBy(F.col("par_hash").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    ends = texts.select(F.col("end").alias("e"), "ends", "first_id")
    nodes = edges.unionByName(root).join(children, F.col("hash") == F.col("of"), "left").join(ends, F.col("hash") == F.col("e"), "left").select(
        "hash", "par_hash", "depth", "words", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("ends", F.lit(0)).alias("n_convs"), "first_id",
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"))
    nodes = materialize(nodes, "trie-nodes")
    members = subtree_sums(nodes, ["n_convs", "n_leaves"], ["first_id"])
    nodes = nodes.drop("n_convs", "n_leaves", "first_id").join(members, "hash").filter("n_convs > 0")  # no conversations, no root
    saved = subtree_sums(nodes.select("hash", "par_hash", ((F.col("n_convs") - 1) * F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + w)).alias("saved")), ["saved"], [])
    own = (F.col("n_convs") - 1) * F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + w)
    parents = members.select(F.col("hash").alias("of"), F.col("first_id").alias("parent_id"))
    full = nodes.join(saved, "hash").join(end_digests(paths), "hash", "left").join(parents, F.col("par_hash") == F.col("of"), "left")
    return expanded(full.select("first_id", "depth", "words", "parent_id", "n_convs", "n_children", "n_leaves", (F.col("saved") - own).alias("below"),
                                F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
