"""Token-id output: one wavelet-matrix file per shard, in ascending document order.

Texts are sorted by document id over the cluster and encoded where they land. A task
cuts its range into shards of about ``SHARD_TOKENS`` tokens (never inside a document)
and writes each as one file; a file's bytes follow from its documents alone, and it
takes its name only when complete, so a repeated task writes the same file again.

Encoding: words between ASCII white space are encoded by the tokenizers library once per
worker and kept; the tokenizer drops white space and treats words alone, so joined word
encodings equal the encoding of the whole text (``WordEncoder`` says which tokenizers
allow that; others encode whole texts).

Results for odd input: a null or empty text has only the end id; null document ids come
first; rows with equal ids follow each other by text; an empty table writes no file and
reads back as an empty table; other columns are ignored. A very long text makes a longer
shard.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import arrow_batches, hadoop_path, narrow, scratch_path
from folio.llm.wavelet import WaveletFile, build

END_ID = 2
SHARD_TOKENS = 1 << 20
#: Words that a worker keeps; beyond that it starts over (only a matter of speed).
KEPT_WORDS = 500_000
#: Slices of about 1 MB that are encoded together, so that their words are looked up once.
ENCODED_SLICES = 2
#: Documents that reach a worker at a time; it and the JVM hold whole batches.
BATCH_ROWS = 256

#: A pattern that takes runs of letters whole, beside parts that begin with an apostrophe.
_LETTER_RUNS = re.compile(r"('\w+\|)*\[\\p\{L\}\]\+\|")

_ENCODERS: dict[str, WordEncoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class WordEncoder:
    """Token ids of whole texts, encoding each distinct word once.

    Joining words is exact if white space is dropped before the model, no token spans it,
    and the normalizer sees characters of one word only. That is so for a ``Split``
    pre-tokenizer that keeps only matches without white space after NFC, white-space
    replacement and lower-casing; texts of any other tokenizer are encoded whole."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer, pre_tokenizers
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        plain = all(not x["lstrip"] and not x["rstrip"] and not x["single_word"] for x in spec["added_tokens"])
        self.by_word = plain and set(steps) <= {"NFC", "Replace", "Lowercase"} and pre.get("type") == "Split" and pre.get("behavior") == "Removed" and pre.get("invert") is True
        vocabulary = self.tokenizer.get_vocab()
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = self.by_word and bool(suffix)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.index: dict[bytes, int] = {}
        # the same model for small letters, which the normalizer and the pattern leave whole
        self.of_letters = self.tokenizer
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        if self.by_word and len(steps) == 2 and steps[1] == {**steps[1], "type": "ByteLevel", "add_prefix_space": False, "use_regex": False} and _LETTER_RUNS.match(steps[0]["pattern"].get("Regex", "")):
            self.of_letters = Tokenizer(self.tokenizer.model)
            self.of_letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # ids of word i: flat[stops[i]:stops[i + 1]]; both arrays may be longer than filled
        self.stops, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts joined, each followed by the end id, and their offsets."""
        if not self.by_word:
            ids = [[*x.ids, END_ID] for x in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
            lens = np.array([len(x) for x in ids], dtype=np.int64)
            return np.fromiter((i for x in ids for i in x), dtype=np.uint32, count=int(lens.sum())), np.concatenate([[0], np.cumsum(lens)])
        if len(self.index) > KEPT_WORDS:
            self._forget(KEPT_WORDS // 2)
        words, ends = _words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.index.get, distinct))
        new = [k for k, i in enumerate(found) if i is None]
        if new:
            self._learn([distinct[k] for k in new])
            for k in new:
                found[k] = self.index[distinct[k]]
        at = np.array(found, dtype=np.int64)
        starts, stops = self.stops[at], self.stops[at + 1]
        # the ids of each distinct word as a list, the end id as one list more
        edges = np.concatenate([[0], np.cumsum(stops - starts)])
        flat = np.append(self.flat[np.arange(int(edges[-1])) + np.repeat(starts - edges[:-1], stops - starts)], END_ID).astype(np.uint32)
        lists = pa.LargeListArray.from_arrays(np.append(edges, len(flat)), flat)
        taken = lists.take(pa.array(np.insert(coded.indices.to_numpy(), ends, len(distinct))))
        offsets = taken.offsets.to_numpy()[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])]
        return taken.values.to_numpy()[int(offsets[0]):int(offsets[-1])], offsets - offsets[0]

    def _forget(self, n: int) -> None:
        """Keeps the ``n`` words that were met first, among them the frequent ones."""
        self.index = dict(islice(self.index.items(), n))
        self.stops = self.stops[:n + 1].copy()
        self.flat = self.flat[:int(self.stops[-1])].copy()

    def _learn(self, words: list[bytes]) -> None:
        """Encodes new words: those of letters alone joined by spaces, since each is one word
        of the model and ends where a token with the word-end mark stands; others singly."""
        letters = [w for w in words if w.isalpha() or _plain_letters(w)]
        rest = set(words).difference(letters)
        flat, lens = [], []
        for lo in range(0, len(letters), 4000):
            group = letters[lo:lo + 4000]
            (encoded,) = self.of_letters.encode_batch_fast([b" ".join(group).decode().lower()], add_special_tokens=False)
            ids = np.array(encoded.ids, dtype=np.uint32)
            ends = np.flatnonzero(self.ends_word[ids])
            if len(ends) != len(group):
                raise ValueError("words of letters did not encode one by one")
            flat.append(ids)
            lens.append(np.diff(ends, prepend=-1))
        if rest:
            rest = sorted(rest)
            encoded = [x.ids for x in self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)]
            flat.append(np.array([i for x in encoded for i in x], dtype=np.uint32))
            lens.append(np.array([len(x) for x in encoded], dtype=np.int64))
        learned, n = [*letters, *rest], len(self.index)
        flat, stops = np.concatenate(flat), np.cumsum(np.concatenate(lens)) + self.stops[n]
        self.index.update(zip(learned, range(n, n + len(learned)), strict=True))
        self.flat = _put_at(self.flat, int(self.stops[n]), flat)
        self.stops = _put_at(self.stops, n + 1, stops)


def _put_at(held: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` from ``at`` on; grows by half at least, so that it is seldom copied."""
    if at + len(more) > len(held):
        held = np.concatenate([held[:at], np.zeros(max(len(more), at // 2), held.dtype)])
    held[at:at + len(more)] = more
    return held


def _words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and how many there are up to the end of each text.

    ASCII letters become small, and a word is cut between a letter and ASCII punctuation (no
    apostrophe) after it: the pre-tokenizer cuts there too, so only fewer distinct words
    remain. Texts that may hold added tokens stay as they are."""
    marked = [b"<|" in t for t in texts]
    data = np.frombuffer(b"\n".join([t if m else t.lower() for t, m in zip(texts, marked, strict=True)]), np.uint8)
    text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    keep = ~_SPACE[data]
    first = keep.copy()
    first[1:] &= ~keep[:-1]
    at = np.flatnonzero(_PUNCTUATION[data])
    at = at[at > 0]
    before = data[at - 1]
    pair = data[at - 2].astype(np.uint16) << 8 | before  # no text starts with the second byte of a letter
    at = at[_LETTER[before] | _LATIN[pair]]
    if any(marked):
        at = at[~np.array(marked)[np.searchsorted(text_ends, at)]]
    first[at] = True
    ends = np.searchsorted(np.flatnonzero(first), text_ends)
    left = data[keep]
    offsets = np.append(np.flatnonzero(first[keep]), len(left)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(left)]), ends


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1)]] = True
#: UTF-8 of the letters from U+00C0 to U+024F, but those whose lower case is more than one character.
_LATIN = np.zeros(1 << 16, dtype=bool)
_LATIN[[int.from_bytes(chr(c).encode()) for c in range(0xC0, 0x250) if chr(c).isalpha() and len(chr(c).lower()) == 1]] = True
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[list(b".,;:!?*#$%&|()")] = True


def _plain_letters(word: bytes) -> bool:
    """Letters up to the Latin extensions whose lower case is one letter each."""
    if word.isascii():
        return False
    text = word.decode()
    return text.isalpha() and max(text) < "\u0250" and "\u0130" not in text


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a shared folder, by its scheme (file or none: a mounted path)."""
    if "://" in uri and not uri.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))
    if uri.startswith("file:"):
        uri = re.sub("^file:/*", "/", uri)
    return pyarrow.fs.LocalFileSystem(), uri


def _put(folder: str, name: str, raw: bytes, attempt: int) -> None:
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{attempt}.part"
    with fs.open_output_stream(part) as f:
        f.write(raw)
    fs.move(part, f"{path}/{name}")


_MANIFEST = pa.schema([("name", pa.string()), ("part", pa.int64()), ("seq", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list]]:
    """Texts and ids, as many documents at a time as surely stay near the shard's size (a
    token has a byte at least), however the batches are cut."""
    texts, ids, size = [], [], 0
    for batch in batches:
        for text, doc_id in zip(batch.column(1).cast(pa.large_binary()).to_numpy(zero_copy_only=False), batch.column(0).to_pylist(), strict=True):
            texts.append(text or b"")
            ids.append(doc_id)
            size += len(texts[-1])
            if size >= 1 << 20:
                yield texts, ids
                texts, ids, size = [], [], 0
    if texts:
        yield texts, ids


def _write_shards(folder: str, tokenizer: str, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt, seq = context.partitionId(), context.taskAttemptId(), 0
        enc = encoder(tokenizer)
        held: list[tuple] = []
        tokens = 0

        def close() -> pa.RecordBatch:
            nonlocal held, tokens, seq
            ids = np.concatenate([h[0] for h in held])
            lens = np.concatenate([np.diff(h[1]) for h in held])
            offsets = np.concatenate([[0], np.cumsum(lens)])
            raw = build(ids, np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held]), offsets)
            name = f"shard-{part:06d}-{seq:06d}.wm"
            _put(folder, name, raw, attempt)
            row = pa.RecordBatch.from_pylist([{"name": name, "part": part, "seq": seq, "docs": len(lens), "tokens": len(ids), "bytes": len(raw)}], schema=_MANIFEST)
            held, tokens, seq = [], 0, seq + 1
            return row

        slices = _slices(batches)
        while group := list(islice(slices, ENCODED_SLICES if enc.by_word else 1)):
            ids, offsets = enc.encode([t for texts, _ in group for t in texts])
            lo = 0
            for texts, at in group:
                hi = lo + len(texts)
                mine = offsets[lo:hi + 1]
                held.append((ids[mine[0]:mine[-1]], mine, np.array([d or 0 for d in at], dtype=np.int64), np.array([d is None for d in at])))
                tokens += int(mine[-1] - mine[0])
                lo = hi
                if tokens >= shard_tokens:
                    yield close()
        if held:
            yield close()

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the shard files into a new folder; returns the manifest, one row a file.

    The manifest is written beside the files and read back, so the work is done once. The
    folder is resolved as Spark resolves it, so tasks and readers mean the same place."""
    spark = docs.sparkSession
    fs, place = hadoop_path(spark, folder)
    folder = fs.makeQualified(place).toString()
    rows = narrow(docs).repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    made = rows.mapInArrow(_write_shards(f"{folder}/shards", tokenizer or default_tokenizer(), shard_tokens), "name string, part long, seq long, docs long, tokens long, bytes long")
    with arrow_batches(spark, BATCH_ROWS):
        made.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


_ROWS = pa.schema([("name", pa.string()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("local_start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            file = WaveletFile(content.as_buffer())
            ids, offsets = file.decode().astype("<u4"), file.offsets
            raw = memoryview(ids).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            n = file.docs
            yield pa.RecordBatch.from_arrays([
                pa.array([path.as_py().rsplit("/", 1)[-1]] * n, pa.string()), pa.array(np.arange(n)), pa.array(file.doc_ids.astype(np.int64), mask=file.nulls),
                pa.array(offsets[:-1]), pa.array(np.diff(offsets)), pa.array(crc, pa.int64())], schema=_ROWS)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files alone but for the order of the shards:
    doc_id, start, n_tokens, ids_crc32, shard and the document's place in it. Fails if a file
    of the manifest is missing or has another size."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    by_part = manifest.groupBy("part").agg(F.sum("tokens").alias("t"))
    parts = by_part.withColumn("part_start", F.coalesce(F.sum("t").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("t")
    inner = F.coalesce(F.sum("tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = manifest.withColumn("inner", inner).join(parts, "part").select("name", (F.col("part_start") + F.col("inner")).alias("shard_start"))
    if not manifest.take(1):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, shard string, place long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(f"{folder}/shards")
    there = files.select(F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("bytes"))
    lost = manifest.select("name", "bytes").join(there, ["name", "bytes"], "left_anti").take(3)
    if lost:
        raise FileNotFoundError(f"shards of the manifest are missing or cut short under {folder}: {[r.name for r in lost]}; is the folder shared by all executors?")
    rows = files.select("path", "content").mapInArrow(_read_shards, "name string, pos long, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "name").select("doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", F.col("name").alias("shard"), F.col("pos").alias("place"))


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes the files under the shared checkpoint folder and reads them back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer)
    return read_tokens(docs.sparkSession, folder)
