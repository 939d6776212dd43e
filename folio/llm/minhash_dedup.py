"""Near duplicates by fast similarity sketching, banding and exact verification.

Sketch: in round i every shingle is thrown into one of ``BINS`` bins by a hash of the round,
with the round and a hash value as its rank; a bin keeps its least rank. Rounds go on for
the documents that still have empty bins; from round ``BINS`` on all shingles go to bin
i - BINS, so after 2 * BINS rounds every coordinate is filled. Most documents are full
after a round or two, so the cost is that of one hash a shingle, yet coordinates agree with
the probability of the Jaccard similarity, with concentration as for independent ones.

Equal sets are one class, and only the class's smallest document goes on. Bands of ``ROWS``
coordinates give candidates; a pair at similarity 0.8 is missed with (1 - 0.8**4)**32,
under 1e-7. Candidates are verified on full shingle sets. In a bucket of many classes each
is first compared with a few hubs, the classes with the fewest shingles of their own; then only
classes are compared that are not yet connected and share one of their rarest shingles, as
every similar pair must. So a group of near copies needs few of its pairs, and no component is missed.

Results for odd input: null, empty and word-less texts have 0 shingles, are linked with
nothing and kept; a row with a null id is kept and linked with nothing (component null);
rows with equal ids share the fate of that id; an empty table gives an empty result; other
columns are ignored (``dedupe`` carries them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm import texthash as H
from folio.llm.common import fresh, materialize, narrow
from folio.llm.components import connected

U64 = np.uint64
ROWS, BANDS = 4, 32
BINS = ROWS * BANDS
WORDS = 4  # words of a shingle in the query; five are usual elsewhere
PERCENT = 80
#: Buckets of up to this many classes compare all their pairs at once; in larger ones
#: every class is compared with this many hubs first, then across components.
SMALL, HUBS = 6, 4

_SEEDS = H.random_values(2 * BINS, 31)
_BAND_SEEDS = H.random_values(BANDS, 37)


def shingle_sets(texts: H.Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles, in document order.

    A text of fewer words has its whole word sequence as one shingle."""
    _, _, first, hashes = H.word_hashes(texts, lower=True)
    where, shingles = H.window_hashes(hashes, first, words)
    doc = np.searchsorted(first, where, "right") - 1
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        whole = H.mix(H.ranges(H.prefix_sums(hashes, H.ITEM_POWERS), first[short], first[short + 1]) + counts[short].astype(U64))
        doc, shingles = np.concatenate([doc, short]), np.concatenate([shingles, whole])
    order = np.lexsort((shingles, doc))
    doc, shingles = doc[order], shingles[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingles[1:] != shingles[:-1])
    return doc[new], shingles[new]


def sketches(doc: np.ndarray, shingles: np.ndarray, n: int) -> np.ndarray:
    """The sketch of each of ``n`` documents (rows of documents without shingles stay empty)."""
    empty = U64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * BINS, empty, dtype=U64)
    open_docs = np.bincount(doc, minlength=n) > 0
    for i in range(2 * BINS):
        alive = open_docs[doc]
        if not alive.all():
            doc, shingles = doc[alive], shingles[alive]
        if not len(doc):
            break
        h = H.mix(shingles ^ _SEEDS[i])
        bins = ((h >> U64(32)) * U64(BINS) >> U64(32)).astype(np.int64) if i < BINS else np.full(len(doc), i - BINS)
        rank = (U64(i) << U64(55)) | (H.mix(h) >> U64(9))
        np.minimum.at(out, doc * BINS + bins, rank)
        open_docs &= (out.reshape(n, BINS) == empty).any(axis=1)
    return out.reshape(n, BINS)


def bands(sketch: np.ndarray) -> np.ndarray:
    """One hash for each band of a sketch, different from band to band."""
    rows = sketch.reshape(len(sketch), BANDS, ROWS)
    out = np.broadcast_to(_BAND_SEEDS, (len(sketch), BANDS)).copy()
    for r in range(ROWS):
        out = H.mix(out ^ rows[:, :, r]) * U64(0x9E3779B97F4A7C15)
    return H.mix(out)


def _sketch_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in H.slices(batch):
                n = len(texts)
                doc, shingles = shingle_sets(texts, words)
                size = np.bincount(doc, minlength=n)
                # the set's digest: sums over its members, so their order does not matter
                digest = [np.zeros(n, U64), np.zeros(n, U64)]
                for d, seed in zip(digest, _BAND_SEEDS[:2], strict=True):
                    np.add.at(d, doc, H.mix(shingles ^ seed))
                has = np.flatnonzero(size)
                found = np.zeros((n, BANDS), U64)
                found[has] = bands(sketches(doc, shingles, n)[has]) if len(has) else 0
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS), pa.int32()), pa.array(found.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.first, n), pa.array(size.astype(np.int64)), pa.array(digest[0].view(np.int64)),
                                                  pa.array(digest[1].view(np.int64)), lists], names=["doc_id", "n_shingles", "d1", "d2", "bands"])

    return run


def _verify_batches(words: int, percent: int):
    """Pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in H.pieces(whole, ["text_a", "text_b"]):
                n, sets = batch.num_rows, []
                for name in ("text_a", "text_b"):
                    pairs, shingles = [np.zeros(0, np.int64)], [np.zeros(0, U64)]
                    for texts in H.slices(batch, name):
                        doc, found = shingle_sets(texts, words)
                        pairs.append(doc + texts.first)
                        shingles.append(found)
                    sets.append((np.concatenate(pairs), np.concatenate(shingles)))
                pair = np.concatenate([s[0] for s in sets])
                shingle = np.concatenate([s[1] for s in sets])
                order = np.lexsort((shingle, pair))
                pair, shingle = pair[order], shingle[order]
                both = np.bincount(pair[1:][(pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1])], minlength=n)
                union = np.bincount(pair, minlength=n) - both
                yield batch.select(["a", "b"]).filter(pa.array((100 * both >= percent * union) & (both > 0)))

    return run


def _shingle_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = H.ids(batch, "rep")
            for texts in H.slices(batch):
                doc, shingles = shingle_sets(texts, words)
                yield pa.RecordBatch.from_arrays([pa.array(ids[texts.first + doc]), pa.array(shingles.view(np.int64))], names=["rep", "shingle"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b), checked beside the texts of their classes."""
    b = pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
    ab = b.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
    return ab.select("a", "b", "text_a", "text_b").mapInArrow(_verify_batches(words, percent), "a long, b long")


def components(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    docs = narrow(docs)
    sketched = materialize(docs.mapInArrow(_sketch_batches(words), "doc_id long, n_shingles long, d1 long, d2 long, bands array<bigint>"), "sketches")
    real = sketched.filter("doc_id is not null and n_shingles > 0")
    # one class for each different set, under its smallest document
    classes = real.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = materialize(classes, "classes")

    # members of buckets that hold two classes or more
    rows = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket")).repartition("bucket")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialize(rows.join(sizes, "bucket"), "members")
    involved = members.select("rep").distinct()
    texts = materialize(docs.join(involved, docs["doc_id"] == involved["rep"]).select("rep", "text").dropDuplicates(["rep"]), "texts")

    x, y = (members.filter(f"size <= {SMALL}").alias(k) for k in "xy")
    pairs = x.join(y, F.expr("x.bucket = y.bucket and x.rep < y.rep")).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    large = members.filter(f"size > {SMALL}").select("bucket", "rep", "n")
    crowded = bool(large.take(1))
    if crowded:
        prefixes = materialize(_prefixes(large, texts, words, percent), "prefixes")
        large = materialize(large.join(prefixes.filter("rank = 1").select("rep", "own"), "rep"), "large")
        hubs = materialize(_hubs(large), "hubs")
        to_hub = large.alias("x").join(hubs.alias("y"), (F.expr("x.bucket = y.bucket and x.rep != y.rep")) & _possible("x", "y", percent))
        pairs = pairs.unionByName(to_hub.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")))
    joined = connected(_verified(pairs.distinct(), texts, words, percent))
    if crowded:
        # the stars found so far stand for their links
        stars = joined.filter("node != component").select(F.col("component").alias("a"), F.col("node").alias("b"))
        joined = connected(stars.unionByName(_verified(_open_pairs(prefixes, joined, percent), texts, words, percent)))

    class_of = classes.join(joined, F.col("rep") == F.col("node"), "left").select(
        F.col("d1").alias("c1"), F.col("d2").alias("c2"), F.col("n_shingles").alias("cn"), F.coalesce("component", "rep").alias("component_id"))
    same = (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")) & (F.col("n_shingles") == F.col("cn"))
    # documents without shingles or id get keys of their own sign, so they meet nobody
    out = sketched.select("doc_id", "n_shingles", "d1", "d2").join(class_of, same, "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _prefixes(large: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(rep, n, token, rank, own): each class's rarest shingles first, as far as a similar
    class must share one of them, and how many of its shingles no other class has."""
    sizes = large.select("rep", "n").distinct()
    rows = texts.join(sizes, "rep", "left_semi").mapInArrow(_shingle_rows(words), "rep long, shingle long").repartition("shingle")
    ranked = rows.join(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("classes")), "shingle")
    mine = Window.partitionBy("rep")
    ranked = ranked.select("rep", F.col("shingle").alias("token"), F.row_number().over(mine.orderBy("classes", "shingle")).alias("rank"),
                           F.sum((F.col("classes") == 1).cast("int")).over(mine).alias("own"), F.count(F.lit(1)).over(mine).alias("n"))
    return ranked.filter(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)


def _possible(x: str, y: str, percent: int):
    """Can two classes still be similar enough, given the shingles that each has alone?

    They share at most what is not own to either, so their similarity has a bound that
    needs no texts; it rules out most pairs of heavily edited copies."""
    shared = F.least(F.col(f"{x}.n") - F.col(f"{x}.own"), F.col(f"{y}.n") - F.col(f"{y}.own"))
    return shared * 100 >= (F.col(f"{x}.n") + F.col(f"{y}.n") - shared) * percent


def _hubs(large: DataFrame) -> DataFrame:
    """A few classes of each large bucket with the fewest own shingles, the most central
    ones. Spark keeps that many rows of a bucket in each task before the shuffle (window
    group limit), so no bucket is gathered. The order is the same everywhere, so the
    buckets of a group have mostly the same hubs."""
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("own", "rep"))
    return large.select("bucket", "own", "rep", "n", place.alias("place")).filter(F.col("place") <= HUBS).drop("place")


def _open_pairs(prefixes: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes in different components so far that can still be similar.

    Exact, by prefixes: two sets that share at least o shingles share one of the first
    n - o + 1 in any common order. In the order of rarity, heavily edited copies lead with
    their edits, so they meet only classes with the same edits. A token's main component is
    not paired with itself."""
    rows = prefixes.join(joined, F.col("rep") == F.col("node"), "left").select("rep", "n", "own", "token", "rank", F.coalesce("component", "rep").alias("component"))
    holders = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("held"))
    tokens = holders.groupBy("token").agg(F.max_by("component", "held").alias("main"), F.count(F.lit(1)).alias("components")).filter("components > 1")
    rows = materialize(rows.join(tokens.select("token", "main"), "token"), "open")
    x, y = rows.filter("component != main").alias("x"), rows.alias("y")
    # sets with J >= p share at least p / (1 + p) of the sum of their sizes
    shared = F.ceil((F.col("x.n") + F.col("y.n")) * F.lit(percent) / F.lit(100 + percent))
    near = (F.col("x.rank") <= F.col("x.n") - shared + 1) & (F.col("y.rank") <= F.col("y.n") - shared + 1)
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.rep") < F.col("y.rep"))
    pairs = x.join(y, F.expr("x.token = y.token and x.component != y.component") & near & once & _possible("x", "y", percent))
    return pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def dedupe(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """The documents of which one stays for each group, with their own columns."""
    (gone,) = fresh(docs, "near_duplicate_id")
    lost = components(docs, words, percent).filter(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(lost, docs["doc_id"] == lost[gone], "left_anti")
