"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements and
one integer whose bit k says that rule k failed. Policies are versioned sets of
rules; applying one is ``bits & mask``, so a policy change never reads the texts
again, and ablations (what would rule k alone decide?) are bitwise aggregations over
the ledger.

The query and its SQL hold the rules of ``RULES``; ``LATER_RULES`` continue their bits in the
ledger. Policy ``v3``, which the pipeline applies, has two of them in place of rules that
reject clean documents for their length or script.

Results for odd input: a null or empty text has measurements 0 and fails
``too_few_words``; repeated rows and equal ids are judged each on its own; an empty
table gives an empty ledger; other columns are ignored or carried unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm import texthash as H
from folio.llm.common import fresh, narrow, with_column

WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_letters", "n_upper")

#: Measurements of the rules that came after the query's SQL.
LATER_MEASURES = ("n_spaced_chars", "n_spaced_words")

#: Rule k fails when its condition holds; k is the bit, so names are only appended.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbol_words": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "few_distinct_words": "n_words >= 50 and 100 * n_distinct_words < 10 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "short_words": "n_words >= 10 and word_chars < 2 * n_words",
    "shouting": "n_letters >= 50 and 100 * n_upper > 60 * n_letters",
    "few_letters": "n_words >= 10 and 100 * n_letters < 40 * word_chars",
}

#: Distinct words grow about with the square root of a text: 10 % holds up to 10,000 words,
#: then ten times the root. Word length counts only what stands outside of scripts that
#: part no words by spaces.
LATER_RULES: dict[str, str] = {
    "few_distinct_words_for_length": "n_words >= 50 and 100 * n_distinct_words < 10 * n_words and n_distinct_words * n_distinct_words < 100 * n_words",
    "long_spaced_words": "n_spaced_chars > 25 * n_spaced_words",
}
ALL_RULES = RULES | LATER_RULES

BASE = ("too_few_words", "repeated_windows")
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "symbol_words", "duplicate_lines"),
    "v2": (*BASE, "symbol_words", "duplicate_lines", "few_distinct_words", "long_words", "short_words", "shouting", "few_letters"),
    "v3": (*BASE, "symbol_words", "duplicate_lines", "few_distinct_words_for_length", "long_spaced_words", "short_words", "shouting", "few_letters"),
}
PRODUCTION = "v2"
PIPELINE = "v3"

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_ALPHA = np.zeros(256, dtype=np.int64)
_ALPHA[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0xC3, 0xF5)]] = 1
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[ord("A"):ord("Z") + 1] = 1


def measure(texts: H.Texts) -> dict[str, np.ndarray]:
    """All measurements of a slice of documents.

    ``n_letters`` counts ASCII letters and the lead bytes of characters beyond Latin-1's
    symbols; ``n_upper`` counts A-Z."""
    data, offsets = texts.data, texts.offsets
    n = len(texts)
    sep = H.IS_SEP[data]
    starts, ends, first = H.split_at(data, offsets, sep)
    sums = texts.byte_sums()
    words = H.mix(H.ranges(sums, starts, ends))
    doc = np.repeat(np.arange(n), np.diff(first))
    out = {"n_words": np.diff(first)}
    lead = ((data & 0xC0) != 0x80).astype(np.int64)
    out["word_chars"] = H.per_doc(lead * ~sep, offsets)
    out["n_symbols"] = H.per_doc(_SYMBOL[data], offsets)
    out["n_letters"] = H.per_doc(_ALPHA[data], offsets)
    out["n_upper"] = H.per_doc(_UPPER[data], offsets)
    out["n_distinct_words"] = np.bincount(doc[first_of_each(doc, words)], minlength=n)

    # what is left without the characters of scripts that part no words
    wide = np.flatnonzero(data >= 0xE0)
    own, marks = H.unspaced(data[wide], data[wide + 1], data[wide + 2])
    wide = wide[own | marks]
    out["n_spaced_chars"], out["n_spaced_words"] = out["word_chars"], out["n_words"]
    if len(wide):
        apart = sep.copy()
        for k in range(3):
            apart[wide + k] = True
        wide = wide[data[wide] >= 0xF0]
        apart[wide + 3] = True
        out["n_spaced_chars"] = H.per_doc(lead * ~apart, offsets)
        out["n_spaced_words"] = np.diff(H.split_at(data, offsets, apart)[2])

    # lines: only those that hold a word count
    line_start, line_end, line_first = H.split_at(data, offsets, data == 0x0A)
    line_doc = np.repeat(np.arange(n), np.diff(line_first))
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, line_doc = line_start[has_word], line_end[has_word], line_doc[has_word]
    lines = H.mix(H.ranges(sums, line_start, line_end))
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_doc[first_of_each(line_doc, lines)], minlength=n)

    # words inside windows that occur twice or more in the same text
    where, windows = H.window_hashes(words, first, WINDOW)
    window_doc = doc[where]
    order = np.lexsort((windows, window_doc))
    w, d = windows[order], window_doc[order]
    same = (w[1:] == w[:-1]) & (d[1:] == d[:-1])
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = where[order[twice]]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    covered = (np.cumsum(edge)[:-1] > 0).astype(np.int64)
    out["n_repeat_words"] = H.per_doc(covered, first)
    return out


def first_of_each(doc: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of one item of each distinct (document, value)."""
    if not len(values):
        return np.zeros(0, np.int64)
    order = np.lexsort((values, doc))
    d, v = doc[order], values[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    return order[new]


def _measure_batches(text: str, into: str):
    measures = MEASURES + LATER_MEASURES
    kind = pa.struct([(m, pa.int64()) for m in measures])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [measure(t) for t in H.slices(batch, text)]
            cols = [pa.array(np.concatenate([p[m] for p in parts]) if parts else [], type=pa.int64()) for m in measures]
            struct = pa.StructArray.from_arrays(cols, fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, into])

    return run


def ledger(docs: DataFrame, text: str = "text", into: str = "ledger") -> DataFrame:
    """``docs`` with a struct column of all measurements and ``bits`` of failed rules.

    One pass over the texts, no shuffle."""
    (tmp,) = fresh(docs, "measures")
    schema = with_column(docs, tmp, "struct<" + ",".join(f"{m}:bigint" for m in MEASURES + LATER_MEASURES) + ">")
    out = docs.mapInArrow(_measure_batches(text, tmp), schema)
    m = {name: F.col(tmp)[name] for name in MEASURES + LATER_MEASURES}
    return out.withColumn(into, F.struct(*[c.alias(k) for k, c in m.items()], failed_bits(tmp).alias("bits"))).drop(tmp)


def failed_bits(struct: str) -> Column:
    """Bits of the failed rules, from a struct of measurements."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(ALL_RULES.values()):
        condition = F.expr(re.sub(r"\b(n_\w+|word_chars)\b", rf"`{struct}`.\1", rule))
        bits = bits.bitwiseOR(F.when(condition, F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return bits


def mask(rules) -> int:
    names = list(ALL_RULES)
    return sum(1 << names.index(r) for r in rules)


def passes(bits: Column, policy: str = PRODUCTION) -> Column:
    return bits.bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ablations(led: DataFrame, policy: str = PRODUCTION, bits: str = "ledger.bits") -> DataFrame:
    """Per rule of a policy: documents that fail it, that only it rejects, and that the
    policy would keep without it. One aggregation over the stored bits."""
    rules, names, all_bits = POLICIES[policy], list(ALL_RULES), mask(POLICIES[policy])
    b = F.col(bits).bitwiseAND(F.lit(all_bits).cast("long"))
    count = lambda cond: F.count(F.when(cond, 1))
    row = led.agg(F.count(F.lit(1)).alias("docs"), *[x for r in rules for x in (
        count(b.bitwiseAND(F.lit(1 << names.index(r)).cast("long")) != 0).alias(f"{r}_failed"),
        count(b == F.lit(1 << names.index(r)).cast("long")).alias(f"{r}_alone"))], count(b == 0).alias("kept"))
    return row.select(F.explode(F.array(*[F.struct(
        F.lit(policy).alias("policy"), F.lit(r).alias("rule"), F.col("docs"), F.col(f"{r}_failed").alias("failed"),
        F.col(f"{r}_alone").alias("failed_alone"), F.col("kept"), (F.col("kept") + F.col(f"{r}_alone")).alias("kept_without")) for r in rules])).alias("x")).select("x.*")


def verdicts(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Per document its measurements, failed bits of ``RULES`` and the verdicts of base and
    policy."""
    led = ledger(narrow(docs))
    base = ~passes(F.col("ledger.bits"), "base")
    return led.select("doc_id", *[F.col(f"ledger.{m}").alias(m) for m in MEASURES], base.alias("base_failed"),
                      (~base & passes(F.col("ledger.bits"), policy)).alias("kept"), F.col("ledger.bits").bitwiseAND(F.lit(mask(RULES)).cast("long")).alias("bits"))


def keep_good(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """The documents that the base rules and the policy keep, with their own columns."""
    (into,) = fresh(docs, "ledger")
    led = ledger(docs, into=into)
    return led.filter(passes(F.col(f"{into}.bits"), "base") & passes(F.col(f"{into}.bits"), policy)).drop(into)
