"""Language identification by hierarchical discrimination.

A text is the multiset of its byte trigrams (letters of A-Z and Latin-1 lower-cased, all
ASCII that is no letter as one space), hashed into ``DIM`` features. The family is decided
first, by one linear SVM for each family against the rest; then one-versus-one linear SVMs
vote among the languages of that family. Families are learned too: the languages' mean
vectors are merged by average linkage until the square root of their number is left.

Training uses a bounded sample: of the documents with a language whose
crc32(doc_id as text) mod 4 is not 2, at most ``PER_LANGUAGE`` for each language and
``SAMPLE`` in all, drawn by a seeded hash over all such rows. Prediction reads nothing but
the text.

Results for odd input: a null text or one without a letter is ``und`` with score 0, as is
every text when there is nothing to learn from; with one language, that is predicted; equal
votes fall to the larger margin, then to code-point order; repeated rows are predicted each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm import texthash as H

DIM = 1 << 12
PER_LANGUAGE = 400
SAMPLE = 4000
SEED = 6
HELD_OUT = (4, 2)  # crc32 modulus and remainder

#: Byte classes: letters lower-cased, other ASCII as space, the rest as it is.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 0x20
_FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1)]] = True
_GRAM = [(H.random_values(256, 41 + i) >> np.uint64(32)).astype(np.uint32) for i in range(3)]


class Model(NamedTuple):
    """Rows of ``weights``: one for each family, then one for each pair of languages."""

    languages: list[str]
    families: list[list[int]]
    pairs: list[tuple[int, int]]
    weights: np.ndarray
    bias: np.ndarray


def features(texts: H.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(feature of each trigram, trigram offsets of the documents)."""
    data, off = texts.data, texts.offsets
    folded = _FOLD[data]
    folded[H.latin_capitals(data)] += 0x20
    n = max(0, len(data) - 2)
    grams = ((_GRAM[0][folded[:n]] ^ _GRAM[1][folded[1:n + 1]]) + _GRAM[2][folded[2:n + 2]]) >> np.uint32(32 - DIM.bit_length() + 1)
    inside = H.inside(off, 3, len(data))
    inside = inside[inside < n]
    # runs of spaces say nothing
    some = (folded[inside] != 0x20) | (folded[inside + 1] != 0x20) | (folded[inside + 2] != 0x20)
    inside = inside[some]
    return grams[inside], np.searchsorted(inside, off)


def lettered(texts: H.Texts) -> np.ndarray:
    """Which documents have a letter."""
    data, off = texts.data, texts.offsets
    out = H.per_doc(_LETTER[_FOLD[data]].astype(np.int64), off) > 0
    for i in np.flatnonzero(~out & (H.per_doc((data >= 0x80).astype(np.int64), off) > 0)):
        out[i] = any(c.isalpha() for c in data[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per sampled document its language and relative trigram frequencies, sparse."""
    for batch in batches:
        for texts in H.slices(batch):
            grams, at = features(texts)
            lang = batch.column(0).slice(texts.first, len(texts))
            index, value = [], []
            for a, b in zip(at[:-1], at[1:], strict=True):
                counts = np.bincount(grams[a:b], minlength=DIM)
                has = np.flatnonzero(counts)
                index.append(has.astype(np.uint16).tobytes())
                value.append((counts[has] / max(1, b - a)).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([lang, pa.array(index, pa.binary()), pa.array(value, pa.binary())], names=["lang", "at", "value"])


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % HELD_OUT[0] == HELD_OUT[1]


def train(docs: DataFrame) -> Model:
    """Fits families and machines on the bounded sample; the result is a few arrays."""
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~F.coalesce(held_out(F.col("doc_id")), F.lit(True)))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    known = sizes.count()
    if not known:
        return Model([], [], [], np.zeros((0, DIM), np.float32), np.zeros(0, np.float32))
    most = max(8, min(PER_LANGUAGE, SAMPLE // known))
    draw = F.xxhash64(F.lit(SEED), "doc_id").bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    drawn = rows.join(F.broadcast(sizes), "lang").withColumn("draw", draw).filter(F.col("draw") * F.col("n") < 3.0 * most)
    drawn = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", F.xxhash64("text")))).filter(F.col("rank") <= most)
    sample = drawn.select("lang", "text").mapInArrow(_vectors, "lang string, at binary, value binary").collect()
    if not sample:
        return Model([], [], [], np.zeros((0, DIM), np.float32), np.zeros(0, np.float32))
    sample.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["value"])))
    x = np.zeros((len(sample), DIM), dtype=np.float32)
    for i, r in enumerate(sample):
        x[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["value"], np.float32)
    languages = sorted({r["lang"] for r in sample})
    y = np.array([languages.index(r["lang"]) for r in sample])
    return fit(x, y, languages)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str]) -> Model:
    families = _families(np.stack([x[y == k].mean(axis=0) for k in range(len(languages))]))
    pairs = [(a, b) for f in families for i, a in enumerate(f) for b in f[i + 1:]]
    family_of = np.array([next(i for i, f in enumerate(families) if k in f) for k in range(len(languages))])
    machines = [_svm(x, np.where(family_of[y] == i, 1.0, -1.0)) for i in range(len(families))] if len(families) > 1 else [(np.zeros(DIM, np.float32), 1.0)]
    for a, b in pairs:
        mine = (y == a) | (y == b)
        machines.append(_svm(x[mine], np.where(y[mine] == a, 1.0, -1.0)))
    return Model(languages, families, pairs, np.stack([m[0] for m in machines]).astype(np.float32), np.array([m[1] for m in machines], np.float32))


def _families(means: np.ndarray) -> list[list[int]]:
    """Average linkage by cosine until the square root of the languages is left."""
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    like = unit @ unit.T
    groups = [[k] for k in range(len(means))]
    while len(groups) > max(1, round(len(means) ** 0.5)):
        score, i, j = max((like[np.ix_(a, b)].mean(), -i, -j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        groups[-i] = sorted(groups[-i] + groups[-j])
        del groups[-j]
    return sorted(groups)


def _largest(x: np.ndarray) -> float:
    """A little over the largest eigenvalue of x'x, by power iteration."""
    v = np.ones(x.shape[1], np.float32)
    for _ in range(30):
        v = x.T @ (x @ (v / np.linalg.norm(v)))
    return 1.1 * float(np.linalg.norm(v))


def _svm(x: np.ndarray, sign: np.ndarray, steps: int = 150, cost: float = 100.0) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, balanced classes, by accelerated gradient steps."""
    scale = 1.0 / max(1e-12, float(np.sqrt((x * x).sum(axis=1).mean())))
    x = np.hstack([x * scale, np.ones((len(x), 1), np.float32)]).astype(np.float32)
    weight = np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum()))
    norm = _largest(x * np.sqrt(weight).astype(np.float32)[:, None])
    rate = 1.0 / (1.0 + 2 * cost * norm)
    w = v = np.zeros(x.shape[1], np.float32)
    sign, weight = sign.astype(np.float32), weight.astype(np.float32)
    for k in range(steps):
        slack = np.maximum(0.0, 1.0 - sign * (x @ v))
        grad = v - np.float32(2 * cost) * ((weight * slack * sign) @ x)
        new = v - np.float32(rate) * grad
        v = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    return (w[:-1] * scale).astype(np.float32), float(w[-1])


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(3.0 * x, -50, 50)))


def classify(texts: H.Texts, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(language index, score); index -1 means undetermined."""
    n = len(texts)
    lang, score = np.full(n, -1), np.zeros(n)
    ok = lettered(texts)
    if not model.languages or not ok.any():
        return lang, score
    grams, at = features(texts)
    count = np.maximum(1, np.diff(at))
    margins = np.empty((len(model.weights), n))
    for k, w in enumerate(model.weights):
        total = np.zeros(len(grams) + 1)
        np.cumsum(w[grams], dtype=np.float64, out=total[1:])
        margins[k] = (total[at[1:]] - total[at[:-1]]) / count + model.bias[k]
    families = len(model.families)
    family = margins[:families].argmax(axis=0)
    sure = _sigmoid(margins[family, np.arange(n)]) if families > 1 else np.ones(n)
    for f, members in enumerate(model.families):
        rows = np.flatnonzero((family == f) & ok)
        votes, strength = np.zeros((len(members), len(rows))), np.zeros((len(members), len(rows)))
        for k, (a, b) in enumerate(model.pairs):
            if a in members:
                m, i, j = margins[families + k][rows], members.index(a), members.index(b)
                votes[i] += m >= 0
                votes[j] += m < 0
                strength[i] += _sigmoid(m)
                strength[j] += _sigmoid(-m)
        best = (votes + strength / (len(members) + 1)).argmax(axis=0)
        lang[rows] = np.array(members)[best]
        score[rows] = sure[rows] * (strength[best, np.arange(len(rows))] / (len(members) - 1) if len(members) > 1 else 1.0)
    return lang, np.clip(score, 0.0, 1.0)


def _predict(model: Model):
    names = np.array([*model.languages, "und"], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [classify(t, model) for t in H.slices(batch)]
            if parts:
                lang = np.concatenate([p[0] for p in parts])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names[lang].tolist(), pa.string()), pa.array(np.concatenate([p[1] for p in parts]))],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    model = train(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
