"""Removal of long repeats by recompression: consistent symbols reveal them, two window hashes verify."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import BLOBS, ENTRIES, Lookup, blobs, frame, length, merged, shard_of, shards_for, shared_folder, small, write
from .text import hashes, mix, table, window_hashes, words

WIDTH = 20
ROUNDS = 4
MIN_SPAN = 4  # words of a high-level symbol
LAST = np.int64(2**63 - 1)  # null ids stand behind all others
_ONE = np.uint64(1)

Batch = tuple[np.ndarray, np.ndarray, np.ndarray]


def symbols(h: np.ndarray, solid: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """(name, start, end, low, high) of the symbols after ``rounds`` rounds of pair naming, then of runs.

    Each round deals the symbols to a left and a right class by a bit of their
    hash; every left symbol before a right one is replaced, with it, by a name for
    the pair. Names are hashes, so they are the same everywhere. ``low`` to
    ``high`` are the words that decided a symbol: wherever these words stand, the
    symbol stands. Runs of equal symbols get a name too, decided by their
    neighbours also. Entries that are not ``solid`` separate documents.
    """
    name, start = h, np.arange(len(h))
    end = start + 1
    low, high = start, end
    for r in range(rounds):
        left = ((mix(name, r) >> np.uint64(40)) & _ONE).astype(bool)
        pair = left[:-1] & ~left[1:] & solid[:-1] & solid[1:]
        head, tail = np.append(pair, False), np.append(False, pair)
        asks_right, asks_left = left & solid & ~head, ~left & solid & ~tail
        after, before = np.append(high[1:], len(h) + 1), np.append(-1, low[:-1])
        high = np.where(head | asks_right, np.maximum(high, after), high)
        low = np.where(asks_left, np.minimum(low, before), low)
        at = np.flatnonzero(head)
        name, end = name.copy(), end.copy()
        name[at], end[at], low[at] = mix(name[at], name[at + 1]), end[at + 1], np.minimum(low[at], low[at + 1])
        keep = ~tail
        name, start, end, low, high, solid = (x[keep] for x in (name, start, end, low, high, solid))
    same = (name[1:] == name[:-1]) & solid[1:] & solid[:-1]
    edges = np.diff(np.concatenate([[0], same.astype(np.int8), [0]]))
    a, b = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    runs = (mix(name[a], (b - a).astype(np.uint64) + np.uint64(7)), start[a], end[b],
            np.where(a > 0, low[a - 1], -1), np.where(b + 1 < len(name), high[np.minimum(b + 1, len(name) - 1)], len(h) + 1))
    return tuple(np.concatenate([x[solid], y]) for x, y in zip((name, start, end, low, high), runs))


def _batch(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts, one separator after each, and the texts' numbers of words."""
    tokens = [words(t) for t in texts]
    counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
    h = np.zeros(int(counts.sum()) + len(tokens), np.uint64)
    if len(h):
        solid = _solid(counts)
        h[solid] = hashes([w for ws in tokens for w in ws])
    return h, counts


def _solid(counts: np.ndarray) -> np.ndarray:
    solid = np.ones(int(counts.sum()) + len(counts), bool)
    solid[np.cumsum(counts + 1) - 1] = False
    return solid


def _places(counts: np.ndarray, width: int) -> np.ndarray:
    """Starts of all windows inside one text."""
    begins = np.cumsum(counts + 1) - counts - 1
    n = np.maximum(0, counts - width + 1)
    return np.repeat(begins - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _keys(h: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Window starts and hashes; symbol keys with the first and last window they stand in; bare windows.

    A window's keys are the symbols decided inside it. A window without any is
    bare: its own hash is its key. Equal windows have equal keys.
    """
    at = _places(counts, width)
    w = window_hashes(h, width)[at] if len(at) else np.zeros(0, np.uint64)
    name, start, end, low, high = symbols(h, _solid(counts))
    kept = (end - start >= MIN_SPAN) & (high - low <= width) & (low >= 0)
    first, last, name = np.maximum(high[kept] - width, 0), low[kept], mix(name[kept], 1)
    covered = _cover(first, last, len(h))
    bare = covered[at] == 0
    return at, w, name, first, last, bare


def _cover(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    return np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(last + 1, minlength=n + 1))


def _bare_key(w: np.ndarray) -> np.ndarray:
    return mix(w, 2)


def _batches(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list]]:
    """Ids (as text) and texts in lots of about half a million words or one long text."""
    ids, texts, size = [], [], 0
    for part in parts:
        for doc_id, text in zip(part.doc_id, part.text):
            ids.append(doc_id)
            texts.append(text)
            size += len(text or "")
            if size >= 3_000_000:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _numbers(ids: list) -> np.ndarray:
    return np.array([LAST if i is None else int(i) for i in ids], np.int64)


def _distinct(keys: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with whether it came more than once or was marked so before."""
    order = np.argsort(keys, kind="stable")
    keys, many = keys[order], many[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    n = np.diff(np.append(first, len(keys)))
    return keys[first], (n > 1) | (np.maximum.reduceat(many, first) if len(first) else many)


def _firsts(keys: np.ndarray, checks: np.ndarray, docs: np.ndarray, at: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each pair of key and check once, with its first place and whether it has another."""
    order = np.lexsort((at, docs, checks, keys))
    keys, checks, docs, at, many = keys[order], checks[order], docs[order], at[order], many[order]
    new = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
    first = np.flatnonzero(np.append(True, new)) if len(keys) else np.zeros(0, int)
    n = np.diff(np.append(first, len(keys)))
    return keys[first], checks[first], docs[first], at[first], (n > 1) | (np.maximum.reduceat(many, first) if len(first) else many)


def _checks(h: np.ndarray, width: int) -> np.ndarray:
    """A second hash of every window, independent of ``window_hashes(h)``: windows are equal where both are."""
    return window_hashes(mix(h, 3), width)


def repeated_keys(docs: DataFrame, shards: int, width: int) -> Lookup:
    """Keys that stand at two or more places of the corpus."""
    folder = shared_folder(docs.sparkSession, "repeat-keys")

    def gather(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def flush() -> pd.DataFrame:
            keys = np.concatenate(held)
            keys, many = _distinct(keys, np.zeros(len(keys), bool))
            return frame(list(blobs(shard_of(keys, shards), (keys, many), shards)))

        for _, texts in _batches(parts):
            h, counts = _batch(texts)
            _, w, name, _, _, bare = _keys(h, counts, width)
            held += [name, _bare_key(w[bare])]
            n += len(held[-2]) + len(held[-1])
            if n >= ENTRIES:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    def merge(shard: int, parts: list) -> pd.DataFrame:
        keys, many = _distinct(*(np.concatenate(c) for c in zip(*parts)))
        write(folder, f"key-{shard}", keys[many])
        return length(shard, many.sum())

    found = merged(docs.mapInPandas(gather, BLOBS), merge, shards).collect()  # one row per shard
    return Lookup(folder, shards, dict(map(tuple, found)))


def first_places(docs: DataFrame, keys: Lookup, shards: int, width: int) -> Lookup:
    """Windows (hash and second hash) that stand at two or more places, each with the first: document and start.

    Only windows all of whose keys are repeated can be repeated; the others are
    never gathered. What is gathered is exact.
    """
    folder = shared_folder(docs.sparkSession, "repeat-windows")

    def gather(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def flush() -> pd.DataFrame:
            w, check, doc, at, many = _firsts(*(np.concatenate(c) for c in zip(*held)))
            # Ids counted from the least one take few bytes.
            low = doc.min() if len(doc) else LAST
            apart = small(doc.view(np.uint64) - low.view(np.uint64))
            return frame(list(blobs(shard_of(w, shards), (w, check, apart, small(at), many), shards, low)))

        for ids, texts in _batches(parts):
            h, counts = _batch(texts)
            at, w, name, first, last, bare = _keys(h, counts, width)
            every = np.unique(np.concatenate([name, _bare_key(w[bare])]))
            again = every[keys.find(every)[0] >= 0]
            single = ~np.isin(name, again)
            could = _cover(first[single], last[single], len(h))[at] == 0
            could[bare] = np.isin(_bare_key(w[bare]), again)
            begins = np.cumsum(counts + 1) - counts - 1
            owner = np.searchsorted(begins, at[could], "right") - 1
            check = _checks(h, width)[at[could]] if len(at) else w
            held.append((w[could], check, _numbers(ids)[owner], at[could] - begins[owner], np.zeros(int(could.sum()), bool)))
            n += len(held[-1][0])
            if n >= ENTRIES:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    def merge(shard: int, parts: list) -> pd.DataFrame:
        parts = [(w, check, (doc.astype(np.uint64) + low.view(np.uint64)).view(np.int64), at.astype(np.int64), many)
                 for low, w, check, doc, at, many in parts]
        w, check, doc, at, many = _firsts(*(np.concatenate(c) for c in zip(*parts)))
        write(folder, f"doc-{shard}", doc[many])
        write(folder, f"at-{shard}", small(at[many]))
        write(folder, f"check-{shard}", check[many].view(np.int64))
        write(folder, f"key-{shard}", w[many])
        return length(shard, many.sum())

    found = merged(docs.mapInPandas(gather, BLOBS), merge, shards).collect()  # one row per shard
    return Lookup(folder, shards, dict(map(tuple, found)))


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept) of ``docs`` (doc_id, text).

    A word goes if a window of ``width`` consecutive words over it also starts
    earlier: in a smaller id, or before in the same text. Null ids stand last,
    null texts have no words, and rows with the same id stand at the same place,
    so none of them is earlier. ``kept`` are the words left, joined by spaces.
    """
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")  # pandas has no long beside nulls
    shards = shards_for(docs)
    firsts = first_places(docs, repeated_keys(docs, shards, width), shards, width)

    def remove(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, texts in _batches(parts):
            h, counts = _batch(texts)
            begins, numbers = np.cumsum(counts + 1) - counts - 1, _numbers(ids)
            at = _places(counts, width)
            w = window_hashes(h, width)[at] if len(at) else np.zeros(0, np.uint64)
            hit, doc, start = _verified(firsts, w, _checks(h, width)[at].view(np.int64) if len(at) else w.view(np.int64))
            owner = np.searchsorted(begins, at[hit], "right") - 1
            mine, here = numbers[owner], at[hit] - begins[owner]
            gone = at[hit][(doc < mine) | ((doc == mine) & (start < here))]
            covered = _cover(gone, gone + width - 1, len(h))[:len(h)] > 0
            rows = []
            for i, text in enumerate(texts):
                mask = covered[begins[i]:begins[i] + counts[i]]
                removed = int(mask.sum())
                left = words(text) if not removed else [x for x, g in zip(words(text), mask) if not g]
                rows.append((ids[i], int(counts[i]), removed, b" ".join(left).decode("utf-8", "surrogatepass")))
                if len(rows) >= 1000:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)

    return docs.mapInPandas(remove, "doc_id string, n_words long, n_removed long, kept string").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def _verified(firsts: Lookup, w: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, document, start) of the windows that stand in ``firsts`` with both hashes."""
    left, out, skip = np.argsort(w, kind="stable"), [], 0
    while True:
        place, doc, start, other = firsts.find(w[left], "doc", "at", "check", skip=skip)
        same = (place >= 0) & (other == check[left])
        out.append((left[same], doc[same], start[same]))
        left, skip = left[(place >= 0) & ~same], skip + 1  # another window of the same first hash
        if not len(left):
            return tuple(map(np.concatenate, zip(*out)))


def _rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept"]).astype({"n_words": "int64", "n_removed": "int64"})


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP10_SQL = rf"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
           from documents),
win as (select doc_id, i, array_to_string(w[i:i + {WIDTH - 1}], ' ') as s
        from (select doc_id, w, unnest(range(1, len(w) - {WIDTH - 2})) as i from d)),
later as (select doc_id, i from (select doc_id, i, row_number() over (partition by s order by doc_id, i) as k from win) where k > 1),
gone as (select distinct doc_id, unnest(range(i, i + {WIDTH})) as j from later),
per as (select doc_id, list(j) as js, count(*) as n from gone group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
  sha256(array_to_string(case when n is null then w else list_transform(list_filter(range(1, len(w) + 1),
    lambda k: not list_contains(js, k)), lambda k: w[k]) end, ' ')) as kept_sha256
from d left join per using (doc_id)
"""
