"""Benchmark decontamination by template canonicalisation.

Texts become templates: words lose outer punctuation and case (A-Z and Latin-1), and numbers, names (inner
capitalised words) and units after numbers become typed placeholders. Windows of ``WIDTH``
template words of the documents are hash-joined with those of the benchmark items. An item
counts as leaked when at least ``COVERAGE`` of its windows stand in the document and its
slots are filled consistently: one value of the item always against one value of the
document and the other way round, so a question with exchanged numbers or names is caught
and a chance mixture of placeholders is not. Every place of a document where enough windows
stand at about the same distance from their places in the item is judged by itself, and so
are the first occurrences of all windows together (a copy in pieces); the best one counts.

The benchmark is the stated query set: it is read in blocks of bounded size (``BLOCK_BYTES``
of text), each broadcast to one pass over the documents, so no side grows with the corpus
and any size of benchmark works.

Beside these templates, windows are joined with every capitalised word as a name, whatever
its place (a renamed question whose names open sentences or lines; there an exchanged word
of ``OPENERS`` counts against the item), and as literal words, which depend on neither case
nor layout and need no window that is half literal. Each of the three is judged by itself.
An item of fewer than ``SHORTEST`` words is searched only literally. Characters of scripts
that do not part words by spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese) are words of
their own.

Results for odd input: null and empty texts match nothing; an item of fewer than ``LEAST``
words matches nothing; very long and repetitive texts take bounded memory; items of fewer than ``WIDTH`` words are one window; repeated rows and
equal ids are judged each; an empty table on either side gives no row; other columns are
ignored (``drop_contaminated`` carries them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import texthash as H
from folio.llm.common import narrow

WIDTH = 8
SHORTEST = 4  # words of an item that is searched with placeholders
LEAST = 3  # and of one that is searched literally
COVERAGE = 0.5
AGREE = 0.8
BAND = 8  # words put in or left out that an alignment may hold
BLOCK_BYTES = 16 << 20
HITS = 1 << 19  # occurrences of an item's windows in a document held at a time
U64 = np.uint64

UNITS = """mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ounce ounces ton tons
second seconds minute minutes hour hours day days week weeks month months year years ml l liter liters litre litres gallon gallons
degree degrees percent dollar dollars euro euros cent cents usd eur gbp mph kmh watt watts volt volts""".split()

#: Words that open sentences with a capital and are no names.
OPENERS = """a all also although an and another any are as at because before both but by can could did do does each every find for from
give given had has have he her here his how i if in is it its let many may more most my no not now of on once one only or our she since
so some that the their then there these they this those to two was we were what when where which while who whose why will with would you your
au aux avec ce ces cette combien comme dans de des du elle en est et il ils je la le les leur mais nous on où par pour quand que quel quelle
qui quoi sa se ses si son sur un une vous aber als am auf aus bei das dem den der die dies diese ein eine er es für hat ich im ist mit nach
nicht oder sie sind so und von wann warum was wenn wer wie wir wo zu al como con cuando cuándo cuánto cuántos cómo del dónde el ella ellos
esta este está hay las lo los más no para pero por porque qué quién se ser su sus también una y ya""".split()

_CORE = np.zeros(256, dtype=bool)
_CORE[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_DIGIT = np.zeros(256, dtype=np.int32)
_DIGIT[ord("0"):ord("9") + 1] = 1
_SMALL = np.zeros(256, dtype=np.int32)
_SMALL[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = 1
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:;\"'"]] = True
_KIND = H.random_values(4, 51)  # placeholders: number, name, unit


class Template(NamedTuple):
    """Template words of some documents: template and value hash, slot mark, offsets;
    ``loose`` and ``loose_slot`` with every capitalised word as a name."""

    template: np.ndarray
    value: np.ndarray
    slot: np.ndarray
    first: np.ndarray
    loose: np.ndarray
    loose_slot: np.ndarray


def _sum_before(mask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(mask) + 1, dtype=np.int32)
    np.cumsum(mask, out=out[1:])
    return out


def spaced(texts: H.Texts) -> H.Texts:
    """The texts with spaces around each character of a script that parts no words, and
    in place of punctuation beyond ASCII (quotes, dashes, East Asian marks)."""
    data = texts.data
    lead = np.flatnonzero((data >= 0xE0) | (data == 0xC2))
    if not len(lead):
        return texts
    a, b, c = data[lead], data[lead + 1], data[np.minimum(lead + 2, len(data) - 1)]
    own, marks = H.unspaced(a, b, c)
    marks |= (a == 0xC2) & ((b == 0xA1) | (b == 0xAB) | (b == 0xBB) | (b == 0xBF))
    marks |= (a == 0xE2) & (b == 0x80) & ((c >= 0x93) & (c <= 0x9F) | (c == 0xA6) | (c == 0xB9) | (c == 0xBA))
    if not (own.any() or marks.any()):
        return texts
    data, at = data.copy(), lead[marks]
    data[at] = data[at + 1] = 0x20
    data[at[a[marks] >= 0xE0] + 2] = 0x20
    at = np.unique(np.concatenate([lead[own], lead[own] + np.where(a[own] == 0xF0, 4, 3)]))
    offsets = texts.offsets + np.searchsorted(at, texts.offsets)
    data = np.insert(data, at, 0x20)
    offsets[-1] = len(data)
    return H.Texts(data, offsets, texts.first)


def canonical(texts: H.Texts) -> Template:
    texts = spaced(texts)
    data = texts.data
    starts, ends, first = texts.words()
    n = len(starts)
    if not n:
        none = np.zeros(0, U64)
        return Template(none, none, np.zeros(0, bool), first, none, np.zeros(0, bool))
    core = _CORE[data]
    lo, hi = starts.copy(), ends.copy()
    places = None
    ragged = np.flatnonzero(~core[starts] | ~core[ends - 1])
    if len(ragged):
        places = np.flatnonzero(core)
        padded = np.append(places, len(data))
        lo[ragged] = np.minimum(padded[np.searchsorted(places, starts[ragged])], ends[ragged])
        before = np.searchsorted(places, ends[ragged]) - 1
        hi[ragged] = np.where(before >= 0, places[np.maximum(before, 0)] + 1 if len(places) else 0, 0)
    real = lo < hi
    hi = np.maximum(hi, lo)
    capitals = H.latin_capitals(data)
    folded, is_small = data.copy(), _SMALL[data]
    folded[capitals] += 0x20
    is_small[capitals] = 0
    is_small[np.flatnonzero(capitals) - 1] = 0
    value = H.mix(H.ranges(H.Texts(folded, texts.offsets, 0).byte_sums(lower=True), lo, hi))
    digits, small, breaks = _sum_before(_DIGIT[data]), _sum_before(is_small), _sum_before(data == 0x0A)
    number = digits[hi] > digits[lo]
    at = np.minimum(lo, len(data) - 1)
    capital = (data[at] >= 0x41) & (data[at] <= 0x5A) | capitals[np.minimum(at + 1, len(data) - 1)] & (data[at] == 0xC3)
    opens = np.ones(n, dtype=bool)
    opens[1:] = _STOP[data[ends[:-1] - 1]] | (breaks[starts[1:]] > breaks[ends[:-1]])
    opens[first[:-1][first[:-1] < first[1:]]] = True
    proper = capital & ~number & (hi - lo > 1) & (small[hi] > small[lo])
    name = proper & ~opens
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    value, number, name, proper, doc = value[real], number[real], name[real], proper[real], doc[real]
    unit = np.zeros(len(value), dtype=bool)
    unit[1:] = number[:-1] & (doc[1:] == doc[:-1])
    unit &= ~number & np.isin(value, _UNIT_HASHES)
    template = np.where(number, _KIND[0], np.where(name, _KIND[1], np.where(unit, _KIND[2], value)))
    slot = number | name | unit
    return Template(template, value, slot, np.searchsorted(doc, np.arange(len(first))), np.where(proper, _KIND[1], template), slot | proper)


def _texts(values: list[bytes]) -> H.Texts:
    return H.Texts(np.frombuffer(b"".join(values), np.uint8), np.cumsum([0, *map(len, values)]).astype(np.int64), 0)


def _word_values(words: list[str]) -> np.ndarray:
    texts = _texts([w.encode() for w in words])
    return H.mix(H.ranges(texts.byte_sums(lower=True), texts.offsets[:-1], texts.offsets[1:]))


_UNIT_HASHES = np.sort(_word_values(UNITS))
_OPENER_HASHES = frozenset(_word_values(OPENERS).tolist())


class Table(NamedTuple):
    """Windows of a block of items of one kind (a column of ``Template``) and width: sorted
    keys, and for each key the span of ``item`` and ``place`` that holds where it stands;
    ``totals`` are the windows of each item, ``by_item`` the rows in order of items and
    ``item_first`` where an item's begin."""

    kind: str
    width: int
    keys: np.ndarray
    begin: np.ndarray
    item: np.ndarray
    place: np.ndarray
    maybe: np.ndarray
    totals: np.ndarray
    by_item: np.ndarray
    item_first: np.ndarray


class Block(NamedTuple):
    item_ids: list[int | None]
    words: Template
    tables: list[Table]


def block_of(item_ids: list[int | None], values: list[str | None]) -> Block:
    words = canonical(_texts([(v or "").encode() for v in values]))
    counts = np.diff(words.first)
    return Block(item_ids, words, [
        *_tables("template", words, words.slot, counts >= SHORTEST), *_tables("loose", words, words.loose_slot, counts >= SHORTEST),
        *_tables("value", words, np.zeros(len(words.slot), bool), counts >= LEAST)])


def _tables(kind: str, words: Template, slot: np.ndarray, wanted: np.ndarray) -> list[Table]:
    """The tables of the wanted items, with their windows that are half literal."""
    counts, tables = np.diff(words.first), []
    literal = np.concatenate([[0], np.cumsum(~slot)])
    for width in sorted({min(WIDTH, int(c)) for c in counts[wanted]}):
        where, keys = H.window_hashes(getattr(words, kind), words.first, width)
        item = np.searchsorted(words.first, where, "right") - 1
        ok = wanted[item] & (np.minimum(WIDTH, counts[item]) == width) & (2 * (literal[where + width] - literal[where]) >= width)
        where, keys, item = where[ok], keys[ok], item[ok]
        if not len(keys):
            continue
        order = np.argsort(keys, kind="stable")
        unique, begin = np.unique(keys[order], return_index=True)
        maybe = np.zeros(1 << 20, dtype=bool)
        maybe[(unique >> U64(44)).astype(np.int64)] = True
        totals, item = np.bincount(item, minlength=len(counts)), item[order]
        tables.append(Table(kind, width, unique, np.append(begin, len(keys)), item, where[order] - words.first[item], maybe, totals, np.argsort(item, kind="stable"), np.cumsum([0, *totals])))
    return tables


def matches(texts: H.Texts, block: Block) -> list[tuple]:
    """(document, item, matched, total, slots, changed) of the leaked items of a slice.

    Which items have enough windows in a document is told by the document's different windows;
    all occurrences are looked at only for those, ``HITS`` at a time."""
    found, words = {}, canonical(texts)
    for table in block.tables:
        keys, begin, item, place, totals = table.keys, table.begin, table.item, table.place, table.totals
        where, hashes = H.window_hashes(getattr(words, table.kind), words.first, table.width)
        near = table.maybe[(hashes >> U64(44)).astype(np.int64)]
        where, hashes = where[near], hashes[near]
        if not len(where):
            continue
        k = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        hit = keys[k] == hashes
        where, k = where[hit], k[hit]
        doc = np.searchsorted(words.first, where, "right") - 1
        # the first place in the document of each of its windows, spread over the items' places
        _, first = np.unique(doc * len(keys) + k, return_index=True)
        many = begin[k[first] + 1] - begin[k[first]]
        at = _spread(begin[k[first]], many)
        pair = np.repeat(doc[first], many) * len(totals) + item[at]
        order = np.lexsort((place[at], pair))
        pair, spot, earliest = pair[order], place[at][order], np.repeat(where[first], many)[order]
        pairs, counts = np.unique(pair, return_counts=True)
        pairs = pairs[counts >= COVERAGE * totals[pairs % len(totals)]]
        for p, a, b in zip(pairs.tolist(), np.searchsorted(pair, pairs).tolist(), np.searchsorted(pair, pairs, "right").tolist(), strict=True):
            d, it = divmod(p, len(totals))
            total, best = int(totals[it]), None
            lo, hi = np.searchsorted(doc, [d, d + 1])
            for there, spots in _alignments(earliest[a:b], spot[a:b], where[lo:hi], k[lo:hi], table, words, d, it):
                slots, changed, agree = _slots(words, block.words, there, spots + block.words.first[it], table.width)
                if agree and (best is None or (len(spots), -changed) > (best[0], -best[2])):
                    best = len(spots), slots, changed
                    if len(spots) == total and not changed:
                        break
            # the best kind of windows: the most of them, then the fewest changes
            if best and ((d, it) not in found or (best[0] / total, -best[2]) > (found[d, it][0] / found[d, it][1], -found[d, it][3])):
                found[d, it] = best[0], total, *best[1:]
    return [(*pair, *said) for pair, said in found.items()]


def _spread(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (many[0] of them), begin[1], ..."""
    return np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))


def _alignments(earliest: np.ndarray, spots: np.ndarray, where: np.ndarray, k: np.ndarray, table: Table, words: Template, d: int, it: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(where, spot) of the hits of a document and item that are judged together, one for each
    spot: the first occurrences of all windows, then, for every diagonal (distance between the
    places in both) with enough hits near it, those within ``BAND`` and those on it.

    A diagonal has at most one hit a spot, so diagonals are taken in runs of ``HITS`` hits at
    most, whatever the text repeats; and a diagonal around which the document reads as around an
    earlier one is judged like that one."""
    yield earliest, spots
    least = COVERAGE * int(table.totals[it])
    rows = table.by_item[table.item_first[it]:table.item_first[it + 1]]
    places, span = table.place[rows], int(table.place[rows].max()) + 1
    held = (np.searchsorted(table.begin, rows, "right") - 1) * span + places  # ascending
    if len(spots) == (np.searchsorted(held, (k + 1) * span) - np.searchsorted(held, k * span)).sum() and np.ptp(earliest - spots) == 0:
        return  # one diagonal holds all hits
    start, end = int(words.first[d]), int(words.first[d + 1])
    run = max(1, HITS // len(rows) - 2 * BAND)
    columns = (words.value, words.slot, words.loose_slot, getattr(words, table.kind))
    judged: set[bytes] = set()
    low, last = int(where[0]) - span + 1, int(where[-1])
    while low <= last:
        # hits on the diagonals low - BAND to low + run + BAND
        part = slice(*np.searchsorted(where, [low - BAND, low + run + BAND + span]))
        here, key = where[part], k[part] * span
        first = np.searchsorted(held, key + np.clip(here - (low + run - 1 + BAND), 0, span))
        many = np.maximum(np.searchsorted(held, key + np.clip(here - (low - BAND), -1, span - 1), "right") - first, 0)
        there, spot = np.repeat(here, many), places[_spread(first, many)]
        diagonal = there - spot
        order = np.argsort(diagonal, kind="stable")
        ranked = diagonal[order]
        every = np.unique(ranked)
        lo, hi = np.searchsorted(ranked, every - BAND), np.searchsorted(ranked, every + BAND, "right")
        for i in np.flatnonzero((hi - lo >= least) & (every >= low) & (every < low + run)).tolist():
            at = int(every[i])
            a, b = max(start, at - BAND), min(end, at + BAND + span + table.width)
            said = hashlib.blake2b(b"%d %d" % (a - at, b - at), digest_size=16)
            for column in columns:
                said.update(column[a:b].tobytes())
            if said.digest() in judged:
                continue
            judged.add(said.digest())
            near = order[lo[i]:hi[i]]
            off = np.abs(diagonal[near] - at)
            by = np.lexsort((there[near], off, spot[near]))
            near, off = near[by], off[by]
            nearest = np.append(True, spot[near[1:]] != spot[near[:-1]])
            for chosen in (near[nearest], near[off == 0]):
                if len(chosen) >= least:
                    yield there[chosen], spot[chosen]
        low += run


def _slots(words: Template, items: Template, where: np.ndarray, spot: np.ndarray, width: int) -> tuple[int, int, bool]:
    """Slots of the matched windows, how many differ from the item's, and whether the
    values go with each other one to one (``AGREE`` of them)."""
    step = np.arange(width)
    a, b = (spot[:, None] + step).reshape(-1), (where[:, None] + step).reshape(-1)
    _, once = np.unique(a, return_index=True)
    a, b = a[once], b[once]
    slot = items.slot[a] | (items.loose_slot[a] & (items.value[a] != words.value[b]))
    a, b = a[slot], b[slot]
    x, y, sure = items.value[a], words.value[b], items.slot[a] & words.slot[b]
    if not len(x):
        return 0, 0, True
    forth, back = {}, {}
    good = sum((s or p == q or not (p in _OPENER_HASHES or q in _OPENER_HASHES)) and forth.setdefault(p, q) == q and back.setdefault(q, p) == p
               for p, q, s in zip(x.tolist(), y.tolist(), sure.tolist(), strict=True))
    return len(x), int((x != y).sum()), good >= AGREE * len(x)


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in blocks whose text is bounded on average by ``BLOCK_BYTES``."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    number = max(1, -(-2 * int(size) // BLOCK_BYTES))
    for i in range(number):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == i).collect() if size else []
        yield block_of([r["item_id"] for r in rows], [r["text"] for r in rows])


_LEAKS = "doc_id long, item_id long, matched long, total long, coverage double, n_slots long, n_changed long"
_LEAK_SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("matched", pa.int64()), ("total", pa.int64()), ("coverage", pa.float64()), ("n_slots", pa.int64()), ("n_changed", pa.int64())])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that it holds."""
    docs, out = narrow(docs), None
    for block in blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            block = held.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[t.first + d], block.item_ids[it], m, n, m / n, s, c) for t in H.slices(batch) for d, it, m, n, s, c in matches(t, block)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _LEAK_SCHEMA, strict=True)], schema=_LEAK_SCHEMA)

        found = docs.mapInArrow(run, _LEAKS)
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no item, with their own columns; one pass, no shuffle."""
    for block in blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for t in H.slices(batch, text):
                    keep[[t.first + m[0] for m in matches(t, held.value)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
