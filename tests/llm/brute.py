"""Plain, slow versions of the operators' contracts, and the odd rows they are held to."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Extra columns whose names clash with names that operators use inside.
CLASHING = ("chunk", "rep", "component", "bucket", "size", "taken", "ledger", "measures", "rid", "kind", "rank", "at")


def vocabulary(seed: int, n: int = 400) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnoprstuvwz") for _ in range(r.randint(2, 9))) for _ in range(n)]


def prose(r: random.Random, words: list[str], n: int) -> list[str]:
    return [r.choice(words) for _ in range(n)]


def odd_rows() -> list[tuple]:
    """(doc_id, text, lang, source): nulls in every column, empty, blank, very long and
    non-ASCII texts, copies, near copies, shared passages, repeated rows."""
    r, words = random.Random(3), vocabulary(1)
    rows, passage = [], prose(r, words, 70)
    base = prose(r, words, 120)
    texts: list[str | None] = [None, "", " \t\n", "x", "...", "日本語。テキスト ß É", "one two three", "a" * 300, "ab " * 400, "\x00 \x1c \x85 \xa0 end"]
    texts += [" ".join(base), " ".join(base), "\n".join(base), " ".join(base).upper()]
    for k in range(1, 25):
        copy = list(base)
        for i in r.sample(range(len(copy)), k % 9):
            copy[i] = f"edit{k}x{i}"
        texts.append(" ".join(copy))
    texts += [" ".join(prose(r, words, 20) + passage + prose(r, words, r.randint(0, 30))) for _ in range(6)]
    texts += [" ".join(passage[:50]), " ".join(passage[:49]), " ".join(passage[:50] + ["tail"]), " ".join(passage[5:62])]
    texts += [" ".join(prose(r, words, n)) for n in (5, 9, 30, 200)]
    texts.append(" ".join(prose(r, vocabulary(7, 5000), 30_000)))
    texts += ["é" * 60 + " " + " ".join(passage[10:40]), "é" * 60, "# " * 40, "line one is here\n" * 30 + "tail"]
    order = list(range(len(texts)))
    r.shuffle(order)
    for i, k in enumerate(order):
        rows.append((i * 3, texts[k], ["en", "de", None][i % 3], ["s1", "s2", "s2", None][i % 4]))
    rows += [(None, " ".join(base), "en", "s1"), (None, None, None, None), rows[4], rows[11]]
    return rows


def frame(spark, rows: list[tuple]):
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*x, *["extra"] * len(CLASHING)) for x in rows], schema).repartition(4)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text: str | None, n: int) -> frozenset:
    w = words_of(lower(text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near_components(rows: list[tuple[int, str | None]], n: int) -> dict[int, tuple[int, int, bool]]:
    sets = {d: shingles(t, n) for d, t in rows}
    of = defaultdict(list)
    for d, s in sets.items():
        for k in s:
            of[k].append(d)
    root = {d: d for d in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for d, s in sets.items():
        for e, i in Counter(e for k in s for e in of[k] if e < d).items():
            if 100 * i >= 80 * (len(s) + len(sets[e]) - i):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def removed(items, n: int, before: set) -> bytearray:
    gone = bytearray(len(items))
    for i in range(len(items) - n + 1):
        if tuple(items[i:i + n]) in before:
            gone[i:i + n] = b"\1" * n
    return gone


def repeats(rows: list[tuple[int, str | None]], split, n: int) -> list[tuple]:
    """(doc_id, items, marks) judging by windows of documents with smaller ids."""
    out, before, pending, last = [], set(), [], None
    for d, text in sorted(rows, key=lambda x: x[0]):
        if d != last:
            for items in pending:
                before |= {tuple(items[i:i + n]) for i in range(len(items) - n + 1)}
            pending, last = [], d
        items = split(text)
        out.append((d, items, removed(items, n, before)))
        pending.append(items)
    return out


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()
