"""Repeated byte passages by prefix-free parsing.

A rolling hash over ``TRIGGER`` bytes picks triggers: a position whose hash is the least of
some ``LENGTH``-byte window around it, so every such window holds one, and texts that share
the window share it. The triggers cut a text into phrases; a trigger with the context that
any window over it can reach is a *dictionary phrase*. Round one builds the dictionary of
the corpus: distinct phrases in sorted order under their triggers, with the first document
of each. A phrase seen in a smaller document is repeated as a whole, however often it
occurs, which is all the work that copies cost. Only where different phrases share a
trigger do their suffixes need comparing: round two sorts the ``LENGTH``-byte suffixes
around those triggers, once per distinct phrase, into one order over the corpus in which
equal ones are neighbours and the smallest document comes first.

The order is that of 96-bit fingerprints of the suffixes (phrases: of trigger and 56 bits
more), not of their letters: removal needs to know equal from different, and letters
would be several times the text on disk.

Results for odd input: null and empty texts have 0 bytes and nothing removed; a row with a
null id is kept whole and removes nothing; rows with equal ids do not remove each other's
bytes; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folio.llm import texthash as H
from folio.llm.chunked import Entries, groups, run
from folio.llm.common import narrow, partitions

LENGTH = 50
TRIGGER = 24
REACH = LENGTH - TRIGGER

_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
_RESULT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

_TABLE2 = H.random_values(256, 23)
U64 = np.uint64


def sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) of every ``width`` neighbours, by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = least(out[:-have], out[have:])
        have *= 2
    if have < width:
        n = len(x) - width + 1
        out = least(out[:n], out[width - have:width - have + n])
    return out


def triggers(texts: H.Texts, sums) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, document, hash) of the triggers of a slice of documents."""
    n, off = len(texts.data), texts.offsets
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, U64)
    hashes = H.mix(H.rolling(sums, TRIGGER)) | U64(1)
    least = sliding(hashes, REACH + 1, np.minimum)
    cut = np.zeros(n + 1, np.int64)  # window starts that would cross a document's end
    np.add.at(cut, np.maximum(off[1:] - LENGTH + 1, off[:-1]), 1)
    np.add.at(cut, off[1:], -1)
    least[np.cumsum(cut)[:len(least)] > 0] = 0
    pad = np.zeros(REACH, U64)
    at = np.flatnonzero(sliding(np.concatenate([pad, least, pad]), REACH + 1, np.maximum) == hashes)
    return at, np.searchsorted(off, at, "right") - 1, hashes[at]


class _State:
    def __init__(self, table: pa.Table):
        self.table = table.combine_chunks()
        self.slices = [t for b in self.table.to_batches() for t in H.slices(b)]
        self.doc_ids = self.table["doc_id"].to_numpy()


class PhraseRepeats:
    def __init__(self, key_bits: int):
        self.key_bits = key_bits

    def load(self, table: pa.Table) -> _State:
        return _State(table)

    def first(self, s: _State) -> Entries:
        found, base = [], 0
        for texts in s.slices:
            sums = texts.byte_sums()
            at, doc, trigger = triggers(texts, sums)
            lo = np.maximum(at - REACH, texts.offsets[doc])
            hi = np.minimum(at + LENGTH, texts.offsets[doc + 1])
            phrase = H.mix(H.ranges(sums, lo, hi) + (at - lo).astype(U64) * U64(0x9E3779B97F4A7C15) + (hi - at).astype(U64))
            # triggers are the least hashes around, so mixed once more to fill the buckets evenly
            found.append((at, doc + base, H.mix(trigger), phrase >> U64(8)))
            base += len(texts)
        s.at = [f[0] for f in found]
        s.ends = np.cumsum([0] + [len(a) for a in s.at])
        doc, trigger, phrase = (np.concatenate([f[i] for f in found]) for i in (1, 2, 3))
        s.doc = doc
        # by trigger, then phrase
        order = np.lexsort((phrase, trigger))
        t, p = trigger[order], phrase[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (t[1:] != t[:-1]) | (p[1:] != p[:-1])
        s.group = np.empty(len(order), np.int64)
        s.group[order] = np.cumsum(new) - 1
        ids = s.doc_ids[doc]
        s.least = np.minimum.reduceat(ids[order], np.flatnonzero(new)) if len(order) else ids
        s.ids = ids
        sent = p[new]
        planes = sent.view(np.uint8).reshape(-1, 8)
        return Entries(t[new], [np.ascontiguousarray(planes[:, :4]).view(np.uint32).reshape(-1), np.ascontiguousarray(planes[:, 4:6]).view(np.uint16).reshape(-1), planes[:, 6].copy()])

    @staticmethod
    def answer_first(key, ship, chunk):
        """Bit 1: the phrase stands in a smaller chunk. Bit 2: its trigger has other phrases."""
        phrase = ship[0].astype(U64) | ship[1].astype(U64) << U64(32) | ship[2].astype(U64) << U64(48)
        order = np.lexsort((phrase, key))
        k, p, c = key[order], phrase[order], chunk[order]
        new_key = np.ones(len(k), dtype=bool)
        new_key[1:] = k[1:] != k[:-1]
        new = new_key.copy()
        new[1:] |= p[1:] != p[:-1]
        least = np.minimum.reduceat(c, np.flatnonzero(new))[np.cumsum(new) - 1]
        kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_key))[np.cumsum(new_key) - 1]
        out = np.empty(len(k), np.uint8)
        out[order] = (c > least).astype(np.uint8) | (kinds > 1).astype(np.uint8) << 1
        return out

    def second(self, s: _State, bits: np.ndarray) -> Entries:
        """Marks whole phrases as repeated; the suffixes around the other shared triggers."""
        mine = bits[s.group] if len(bits) else np.zeros(0, np.uint8)
        repeated = (mine & 1 > 0) | (s.ids > s.least[s.group]) if len(mine) else mine > 0
        compare = ~repeated & (mine & 2 > 0)
        s.gone, s.windows, h1s, h2s, docs, base = [], [], [], [], [], 0
        for i, texts in enumerate(s.slices):
            lo, hi = s.ends[i], s.ends[i + 1]
            at, off = s.at[i], texts.offsets
            doc = s.doc[lo:hi] - base
            first = np.maximum(at - REACH, off[doc])
            last = np.minimum(at, off[doc + 1] - LENGTH)
            gone, near = (_marked(len(texts.data), first[m], last[m] + 1) for m in (repeated[lo:hi], compare[lo:hi]))
            where = np.flatnonzero(near & ~gone)
            s.gone.append(np.flatnonzero(gone))
            s.windows.append(where)
            if len(where):
                h1s.append(H.mix(H.ranges(texts.byte_sums(), where, where + LENGTH)))
                second = H.prefix_sums(_TABLE2[texts.data], H.ITEM_POWERS)
                h2s.append((H.mix(H.ranges(second, where, where + LENGTH)) >> U64(32)).astype(np.uint32))
                docs.append(base + np.searchsorted(off, where, "right") - 1)
            base += len(texts)
        if not h1s:
            s.window_group = np.zeros(0, np.int64)
            return Entries(np.zeros(0, U64), [np.zeros(0, np.uint32)])
        h1, h2, doc = np.concatenate(h1s), np.concatenate(h2s), np.concatenate(docs)
        order, new = groups(h1, h2)
        s.window_group = np.empty(len(order), np.int64)
        s.window_group[order] = np.cumsum(new) - 1
        s.window_ids = s.doc_ids[doc]
        s.window_least = np.minimum.reduceat(s.window_ids[order], np.flatnonzero(new))
        return Entries(h1[order][new], [h2[order][new]])

    @staticmethod
    def answer_second(key, ship, chunk):
        """Does a smaller chunk, so a smaller document, have the suffix?"""
        order, new = groups(key, *ship)
        c = chunk[order]
        least = np.minimum.reduceat(c, np.flatnonzero(new))
        out = np.empty(len(key), np.uint8)
        out[order] = c > least[np.cumsum(new) - 1]
        return out

    def finish(self, s: _State | None, bits: np.ndarray) -> pa.Table:
        if s is None:
            return _RESULT.empty_table()
        n_window = len(s.window_group)
        again = (bits[s.window_group] > 0) | (s.window_ids > s.window_least[s.window_group]) if n_window else np.zeros(0, bool)
        out, k, base = [], 0, 0
        for texts, gone, windows in zip(s.slices, s.gone, s.windows, strict=True):
            starts = np.concatenate([gone, windows[again[k:k + len(windows)]]])
            k += len(windows)
            data, off = texts.data, texts.offsets
            removed = _marked(len(data), starts, starts + LENGTH)
            begins = removed.copy()
            begins[1:] &= ~removed[:-1]
            cut = off[:-1][off[:-1] < off[1:]]
            begins[cut] = removed[cut]
            n_removed = H.per_doc(removed, off)
            kept, ends = data[~removed].tobytes(), np.cumsum(np.concatenate([[0], np.diff(off) - n_removed]))
            sha = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            out.append(pa.table([s.doc_ids[base:base + len(texts)], np.diff(off), n_removed, H.per_doc(begins, off), sha], schema=_RESULT))
            base += len(texts)
        return pa.concat_tables(out)


def _marked(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the ranges."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge)[:n] > 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans and kept_sha256 of the remaining bytes."""
    docs = narrow(docs)
    bits = min(64, 34 + partitions(docs.sparkSession).bit_length())
    found = run(docs, PhraseRepeats(bits), _RESULT_DDL)
    return found.unionByName(docs.filter("doc_id is null").mapInArrow(_whole, _RESULT_DDL))


def _whole(batches):
    for batch in batches:
        if len(batch):
            raw = [x.as_py() or b"" for x in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(raw), pa.int64()), pa.array([len(x) for x in raw], pa.int64()), pa.array([0] * len(raw), pa.int64()),
                                              pa.array([0] * len(raw), pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in raw])], schema=_RESULT)
