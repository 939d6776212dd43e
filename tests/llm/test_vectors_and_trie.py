"""Permutation index, inverted multi-index and z-fast trie against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from folio.llm import conversation_trie, multi_index, permutation_index, queries
from tests.conftest import SF_SMALL
from tests.llm.brute import WORD

VECTORS = "vec_id long, embedding array<double>, label int, rid long, score double, cell_q int, vec array<double>"


def vectors(n: int, dim: int = 16, seed: int = 5, spread: float = 0.0, copies: int = 0) -> list[tuple]:
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= 1 + spread * r.random((n, 1))
    x[n - copies:] = x[n // 2]
    return [(i, x[i].tolist(), int(r.integers(0, 4)), 1, 0.5, 7, None) for i in range(n)]


def test_recall_and_scores_of_the_permutation_index(spark):
    for rows, share in ((vectors(3000, spread=0.0), 0.9), (vectors(3000, spread=0.5), 0.9), (vectors(3000, copies=1000), 0.9)):
        got = defaultdict(list)
        found = permutation_index.neighbours(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0)
        for r in found.collect():
            got[r.query_id].append((r.rank, r.vec_id, r.score))
        x = np.array([r[1] for r in rows])
        hits = []
        for q in range(0, len(rows), 20):
            s = (x * x[q]).sum(axis=1)
            mine = sorted(got[q])
            assert [m[0] for m in mine] == list(range(1, 21)) and q not in [m[1] for m in mine]
            assert [m[2] for m in mine] == [s[m[1]] for m in mine]  # exactly the inner product, ties to the smaller id
            assert [(-m[2], m[1]) for m in mine] == sorted((-m[2], m[1]) for m in mine)
            s[q] = -np.inf
            true = np.lexsort((np.arange(len(rows)), -s))[:20]
            hits.append(len(set(true) & {m[1] for m in mine}) / 20)
        assert sum(hits) / len(hits) >= share
        assert len(got) == len(range(0, len(rows), 20))


def test_recall_on_the_given_vectors(spark):
    got = {(r.query_id, r.vec_id) for r in queries.op11_permutation_index(spark, SF_SMALL).collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    x, ids = np.array([r.embedding for r in rows]), np.array([r.vec_id for r in rows])
    want = set()
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        want |= {(int(ids[i]), int(ids[j])) for j in np.argsort(-s)[:20]}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_agreement_is_the_footrule_distance():
    r = np.random.default_rng(1)
    n, length = 12, 5
    a, b = (np.array([r.permutation(n)[:length] for _ in range(k)]) for k in (4, 9))
    got = permutation_index.agreement(a, permutation_index.places(b, n), len(b), n)

    def place(order, p):
        return list(order).index(p) if p in order else length

    for i, x in enumerate(a):
        for j, y in enumerate(b):
            assert length * (length + 1) - 2 * got[i, j] == sum(abs(place(x, p) - place(y, p)) for p in range(n))


ODD = [(None, [1.0, 0.0], 1), (40, None, 1), (60, [], 1), (80, [0.0, 0.0], 1), (100, [1.0, None], 1), (120, [float("nan"), 1.0], 1), (140, [float("inf"), 1.0], 1),
       (0, [1.0, 0.0, 0.0], 0), (0, [1.0, 0.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [0.5], 1), (3, [0.5], 1), (20, [0.0, 0.0, 2.0], None), (4, [-1.0, 0.0, 0.0], 0)]


def test_odd_vectors(spark):
    rows = spark.createDataFrame([(*r, 1, 0.5, 7, None) for r in ODD], VECTORS)
    got = sorted(map(tuple, permutation_index.neighbours(rows, F.col("vec_id") % 20 == 0, k=3).collect()))
    # the two rows of id 0 each find the other one first; a vector of one component counts as filled up
    assert got == sorted([(0, 1, 0, 1.0), (0, 2, 1, 0.5), (0, 3, 2, 0.5)] * 2 + [(20, 1, 0, 0.0), (20, 2, 0, 0.0), (20, 3, 1, 0.0)])
    assert permutation_index.neighbours(rows.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert multi_index.mine(rows.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert permutation_index.neighbours(rows.filter("vec_id = 1"), F.col("vec_id") == 1).count() == 0


def brute_negatives(rows: list[tuple], anchor) -> Counter:
    good = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out: Counter = Counter()
    for a, (i, lab, v) in enumerate(good):
        if not anchor(i):
            continue
        s = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), j, other) for b, (j, other, w) in enumerate(good) if b != a)
        for p, j, _ in [x for x in s if x[2] == lab][:5]:
            negatives = [x for x in s if x[2] != lab and 30 * -p <= 100 * -x[0] <= 90 * -p][:10]
            out.update((i, j, k + 1, x[1], -p, -x[0]) for k, x in enumerate(negatives))
    return out


def test_hard_negatives_against_brute_force(spark):
    wide = [(i, [4000 * x for x in v], lab, *rest) for i, v, lab, *rest in vectors(300, seed=8, spread=0.3)]
    for rows in (vectors(900, seed=6, copies=300), vectors(700, dim=3, seed=7, spread=2.0), wide):
        got = multi_index.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0, words=5)
        assert Counter(tuple(r) for r in got.collect()) == brute_negatives([r[:3] for r in rows], lambda i: i % 50 == 0)
    odd = [*ODD, *((i + 1000, [0.1 * (i % 7), -0.2 * (i % 3), 0.4], i % 3) for i in range(60))]
    got = multi_index.mine(spark.createDataFrame([(*r, 1, 0.5, 7, None) for r in odd], VECTORS), F.col("vec_id") % 20 == 0)
    assert Counter(tuple(r) for r in got.collect()) == brute_negatives(odd, lambda i: i % 20 == 0)


def test_visits_are_certified_and_stop_early():
    r = np.random.default_rng(4)
    vec = np.concatenate([np.floor(256 * (c + 0.05 * r.standard_normal((200, 8)))) for c in r.standard_normal((12, 8))])
    books = [multi_index.codebook(vec[:, :4], 8), multi_index.codebook(vec[:, 4:], 8)]
    code = np.stack([multi_index.nearest(vec[:, :4], books[0]), multi_index.nearest(vec[:, 4:], books[1])], axis=1)
    cells = multi_index.Cells(vec, code, books)
    for q in vec[::300]:
        s, seen, last = vec @ q, [], np.inf
        for bound, rows in cells.visits(q):
            assert bound <= last and s[rows].max() <= bound
            last = bound
            seen += rows.tolist()
        assert sorted(seen) == list(range(len(vec)))

    class Counted(multi_index.Cells):
        rows = 0

        def visits(self, query):
            for bound, part in super().visits(query):
                self.rows += len(part)
                yield bound, part

    counted = Counted(vec, code, books)
    rows = {"id": np.arange(len(vec)), "vec": vec}
    (ids, best), = multi_index.certified(counted, rows, vec[0], np.ones(len(vec), bool), [(None, None)], 5, True)
    assert best.tolist() == np.sort(vec @ vec[0])[::-1][:5].tolist() and counted.rows < 0.75 * len(vec)


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple]]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        out[c] = own.get(base, [])[:h] + t[h:]
    return out


def brute_trie(rows: list[tuple]) -> list[tuple]:
    convs = rebuilt(rows)
    members = defaultdict(set)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].add(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []
    saved, leaves = {}, {}
    for p in sorted(members, key=len, reverse=True):
        saved[p] = (len(members[p]) - 1) * (len(WORD.findall(p[-1][1])) if p else 0) + sum(saved[c] for c in children[p])
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        ends = sorted(c for c in members[p] if len(convs[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda x: (x[1], x[0]))


CONVERSATIONS = "conv_id long, turn long, role string, text string, end string, n int, hash binary"


def test_trie_against_brute_force(spark):
    r = random.Random(9)
    rows: list[tuple] = [(None, 0, "user", "lost"), (3, None, None, None), (3, None, None, "null first"), (3, 1, "user", ""), (3, 1, "user", "tie"), (3, 1, "user", "tie"), (-7, 0, "user", "negative id"), (-7, 1, "a", "b c")]
    says = [f"word{k} " * r.randint(0, 5) for k in range(6)]
    for c in range(10, 160):
        depth = r.choice([0, 1, 2, 3, 5, 8, 13]) if c % 17 else 60
        rows += [(c, d, "user" if d % 2 else "assistant", says[r.randrange(6)] if r.random() < 0.25 else says[d % 6]) for d in range(depth)]
    rows += [(c, d, "user", says[0]) for c in range(200, 260) for d in range(4)]  # a large group of copies
    rows += [(c, d, "user", says[d % 6]) for c in range(300, 340) for d in range(c - 299)]  # each the prefix of the next
    frame = spark.createDataFrame([(*x, "e", 1, b"h") for x in rows], CONVERSATIONS)
    build = lambda f: conversation_trie.trie(conversation_trie.regrafted(conversation_trie.turns_of(f)))
    got = [tuple(x) for x in build(frame).collect()]
    assert sorted(got, key=lambda x: (x[1], x[0])) == brute_trie(rows)
    assert build(frame.limit(0)).count() == 0
    one = [(20, 5, "user", "only turn")]  # its own first turns are replaced by themselves
    assert [tuple(x) for x in build(spark.createDataFrame([(*x, "e", 1, b"h") for x in one], CONVERSATIONS)).orderBy("depth").collect()] == brute_trie(one)
    turnless = [(21, 0, "user", "replaced by nothing")] if zlib.crc32(b"21") % 4 else [(22, 0, "user", "replaced by nothing")]
    assert [tuple(x) for x in build(spark.createDataFrame([(*x, "e", 1, b"h") for x in turnless], CONVERSATIONS)).collect()] == brute_trie(turnless)


def test_two_fattest_numbers(spark):
    pairs = [(a, b) for a in range(40) for b in range(40)]
    got = spark.createDataFrame(pairs, "a int, b int").select("a", "b", conversation_trie.two_fattest("a", "b").alias("f")).collect()
    for r in got:
        assert r.f == max(range(r.a + 1, r.b + 1), key=lambda x: x & -x, default=None)
