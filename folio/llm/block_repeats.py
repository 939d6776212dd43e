"""Repeated passages by fixed-block anchors.

The index holds the non-overlapping blocks of ``BLOCK`` words of every document. A window
of ``WINDOW`` = 2 * BLOCK words holds a whole block of each document it stands in, so its
other copies show as a rolling window of ``BLOCK`` words that hits that block. Round one
sends all rolling windows, marked where they are blocks, and learns which are hits; round
two extends the hits: the windows that hold a hit are compared exactly (96 bits of two
independent hashes of 64-bit word hashes), and unite to the maximal repeats.

Results for odd input: null and empty texts have 0 words and nothing removed; a row with
a null id is kept whole and removes nothing; rows with equal ids do not remove each
other's words, but smaller ids remove from all of them; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folio.llm import texthash as H
from folio.llm.chunked import Entries, groups, run
from folio.llm.common import narrow, partitions

BLOCK = 25
WINDOW = 2 * BLOCK

_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("n_spans", pa.int64())])
_RESULT_DDL = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long"


class _State:
    def __init__(self, table: pa.Table):
        self.batches = table.combine_chunks().to_batches()
        parts = [H.word_hashes(t) for b in self.batches for t in H.slices(b)]
        self.doc_ids = table["doc_id"].to_numpy()
        self.words = np.concatenate([p[3] for p in parts])
        counts = np.concatenate([np.diff(p[2]) for p in parts])
        self.first = np.concatenate([[0], np.cumsum(counts)])
        # documents in the order of their ids
        self.doc_of_word = np.repeat(np.arange(len(counts)), counts)


class BlockRepeats:
    def __init__(self, key_bits: int):
        self.key_bits = key_bits

    def load(self, table: pa.Table) -> _State:
        return _State(table)

    def first(self, s: _State) -> Entries:
        s.at, hashes = H.window_hashes(s.words, s.first, BLOCK)
        doc = s.doc_of_word[s.at]
        block = (s.at - s.first[doc]) % BLOCK == 0
        order, new = groups(hashes)
        begin = np.flatnonzero(new)
        s.group = np.empty(len(order), np.int64)
        s.group[order] = np.cumsum(new) - 1
        if not len(begin):
            s.block, s.several = np.zeros(0, bool), np.zeros(0, bool)
            return Entries(np.zeros(0, np.uint64), [np.zeros(0, np.uint8)])
        s.block = np.logical_or.reduceat(block[order], begin)
        ids = s.doc_ids[doc[order]]
        s.several = np.minimum.reduceat(ids, begin) != np.maximum.reduceat(ids, begin)
        return Entries(hashes[order][new], [s.block.astype(np.uint8)])

    @staticmethod
    def answer_first(key, ship, chunk):
        """Hit: some chunk has it as a block, and another chunk has it too."""
        order, new = groups(key)
        begin, group = np.flatnonzero(new), np.cumsum(new) - 1
        c = chunk[order]
        hit = np.logical_or.reduceat(ship[0][order] > 0, begin) & (np.minimum.reduceat(c, begin) != np.maximum.reduceat(c, begin))
        out = np.empty(len(key), np.uint8)
        out[order] = hit[group]
        return out

    def second(self, s: _State, bits: np.ndarray) -> Entries:
        hit = (bits > 0) | (s.block & s.several)
        n = len(s.words)
        edge = np.zeros(n + 2, np.int64)
        at = s.at[hit[s.group]] if len(hit) else s.at
        np.add.at(edge, np.maximum(at - (WINDOW - BLOCK), s.first[s.doc_of_word[at]]), 1)
        np.add.at(edge, at + 1, -1)
        near = np.cumsum(edge)[:n] > 0
        where = H.inside(s.first, WINDOW, n)
        s.windows = where[near[where]]
        h1 = H.mix(H.rolling(H.prefix_sums(s.words, H.ITEM_POWERS), WINDOW))[s.windows]
        salted = H.mix(s.words + H.random_values(1, 5)[0])
        h2 = (H.mix(H.rolling(H.prefix_sums(salted, H.ITEM_POWERS), WINDOW))[s.windows] >> np.uint64(32)).astype(np.uint32)
        order, new = groups(h1, h2)
        s.window_group = np.empty(len(order), np.int64)
        s.window_group[order] = np.cumsum(new) - 1
        ids = s.doc_ids[s.doc_of_word[s.windows]]
        s.least = np.minimum.reduceat(ids[order], np.flatnonzero(new)) if len(order) else ids
        s.window_ids = ids
        return Entries(h1[order][new], [h2[order][new]])

    @staticmethod
    def answer_second(key, ship, chunk):
        """Does a smaller chunk, so a smaller document, have the window?"""
        order, new = groups(key, *ship)
        c = chunk[order]
        least = np.minimum.reduceat(c, np.flatnonzero(new))
        out = np.empty(len(key), np.uint8)
        out[order] = c > least[np.cumsum(new) - 1]
        return out

    def finish(self, s: _State | None, bits: np.ndarray) -> pa.Table:
        if s is None:
            return _RESULT.empty_table()
        gone = s.windows[(bits[s.window_group] > 0) | (s.window_ids > s.least[s.window_group])] if len(s.windows) else s.windows
        edge = np.zeros(len(s.words) + 1, np.int64)
        np.add.at(edge, gone, 1)
        np.add.at(edge, gone + WINDOW, -1)
        removed = np.cumsum(edge)[:-1] > 0
        begins = removed.copy()
        begins[1:] &= ~removed[:-1] | (s.doc_of_word[1:] != s.doc_of_word[:-1])
        n_removed = H.per_doc(removed, s.first)
        sha, i = [], 0
        for batch in s.batches:
            for text in batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary()):
                words = (text.as_py() or b"").split()
                if n_removed[i]:
                    words = compress(words, (~removed[s.first[i]:s.first[i + 1]]).tolist())
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                i += 1
        return pa.table([s.doc_ids, np.diff(s.first), n_removed, sha, H.per_doc(begins, s.first)], schema=_RESULT)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: n_words, n_removed, kept_sha256 of what is left, and n_spans."""
    docs = narrow(docs)
    bits = min(64, 34 + partitions(docs.sparkSession).bit_length())
    found = run(docs, BlockRepeats(bits), _RESULT_DDL)
    return found.unionByName(docs.filter("doc_id is null").mapInArrow(_whole, _RESULT_DDL))


def _whole(batches):
    finder = BlockRepeats(64)
    for batch in batches:
        if len(batch):
            table = pa.table({"doc_id": pa.array(np.arange(len(batch))), "text": batch.column(1)})
            s = finder.load(table)
            s.windows, s.window_group = np.zeros(0, np.int64), np.zeros(0, np.int64)
            out = finder.finish(s, np.zeros(0, np.uint8))
            out = out.set_column(0, _RESULT.field(0), pa.nulls(len(out), pa.int64()))
            yield from out.to_batches()


