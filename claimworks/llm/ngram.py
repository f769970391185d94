"""Interpolated modified Kneser-Ney bigram model, counted in Spark, kept as sorted arrays, mapped by workers."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import BLOBS, ENTRIES, Lookup, blobs, frame, mapped, merged, shard_of, shards_for, shared_folder, small, write
from .text import checkpointed, fold_of, hashes, table, words

END = b"\n"  # no word holds white space
START = 0  # ids of words are places in the vocabulary plus one


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, place of each token among them, tokens per text): lower-cased words and an end per text."""
    tokens = [words(t, lower=True) for t in texts]
    counts = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    every, at = np.unique(hashes([w for ws in tokens for w in (*ws, END)]), return_inverse=True)
    return every, at, counts


def _lots(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[list, ...]]:
    """Columns of the rows in lots of about three million characters or one long text."""
    rows, size = [], 0
    for part in parts:
        for row in part.itertuples(index=False):
            rows.append(row)
            size += len(row.text or "")
            if size >= 3_000_000:
                yield tuple(map(list, zip(*rows)))
                rows, size = [], 0
    if rows:
        yield tuple(map(list, zip(*rows)))


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order].astype(np.int64)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def vocabulary(docs: DataFrame, shards: int) -> tuple[Lookup, int]:
    """Every token's count, by hash, and the number of all tokens."""
    folder = shared_folder(docs.sparkSession, "lm-words")

    def gather(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for (texts,) in _lots(parts):
            every, at, _ = _tokens(texts)
            held.append((every, np.bincount(at, minlength=len(every))))
            n += len(every)
            if n >= ENTRIES:
                keys, sums = _summed(*map(np.concatenate, zip(*held)))
                yield frame(list(blobs(shard_of(keys, shards), (keys, small(sums)), shards)))
                held, n = [], 0
        if held:
            keys, sums = _summed(*map(np.concatenate, zip(*held)))
            yield frame(list(blobs(shard_of(keys, shards), (keys, small(sums)), shards)))

    def merge(shard: int, parts: list) -> pd.DataFrame:
        keys, n = _summed(*map(np.concatenate, zip(*parts)))
        write(folder, f"count-{shard}", n)
        write(folder, f"key-{shard}", keys)
        return pd.DataFrame([(shard, len(keys), int(n.sum()))], columns=["shard", "n", "tokens"])

    found = merged(docs.select("text").mapInPandas(gather, BLOBS), merge, shards, "shard int, n long, tokens long").collect()
    return Lookup(folder, shards, {r.shard: r.n for r in found}), sum(r.tokens for r in found)


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from how many entries have counts 1 to 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    out = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] and n[k + 1] else 0.75 * (k + 1) for k in range(3)]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(out)]


def _discount(c: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(c, 3)]


class Bigrams:
    """Where the bigram arrays are: ``step`` word ids share a shard, by the first word and by the second."""

    def __init__(self, folder: str, step: int, firsts: set[int], seconds: set[int]):
        self.folder, self.step, self.firsts, self.seconds = folder, step, firsts, seconds


def bigrams(docs: DataFrame, known: Lookup, shards: int) -> tuple[Bigrams, list[int], list[int], int]:
    """Bigram counts by first word, numbers of left neighbours by second word, and the histograms of both.

    A shard of first words is a sparse matrix: row starts, second words and counts,
    with each row's sum and its numbers of entries with counts 1, 2 and 3 or more.
    """
    folder = shared_folder(docs.sparkSession, "lm-bigrams")
    if known.size + 1 >= 1 << 32:
        raise ValueError(f"{known.size} different tokens: pairs are packed as two numbers below 2**32")
    step = -(-(known.size + 1) // shards)

    def packed(held: list) -> pd.DataFrame:
        keys, n = _summed(*map(np.concatenate, zip(*held)))
        first, second = _split(keys)
        rows, ends = [], np.searchsorted(first // step, np.arange(shards + 1))
        for s in map(int, np.flatnonzero(np.diff(ends))):
            cut = slice(ends[s], ends[s + 1])
            row, lengths = np.unique(first[cut], return_counts=True)
            rows.append((s, pickle.dumps((small(row - s * step), small(lengths), second[cut], small(n[cut])), protocol=5)))
        return frame(rows)

    def gather(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for (texts,) in _lots(parts):
            every, at, counts = _tokens(texts)
            ids = (known.find(every)[0] + 1)[at]
            before = np.append(START, ids[:-1])
            before[np.cumsum(counts) - counts] = START
            held.append(np.unique((before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64), return_counts=True))
            n += len(held[-1][0])
            if n >= ENTRIES:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    def merge(shard: int, parts: list) -> pd.DataFrame:
        keys = np.concatenate([(np.repeat(row.astype(np.uint64), lengths) << np.uint64(32)) | second
                               for row, lengths, second, _ in parts])
        keys, n = _summed(keys, np.concatenate([c.astype(np.int64) for *_, c in parts]))
        row, second = _split(keys)
        arrays = {"starts": np.searchsorted(row, np.arange(step + 1)), "count": n, "total": np.bincount(row, n, step)}
        arrays |= {f"n{k}": np.bincount(row[np.minimum(n, 3) == k], minlength=step) for k in (1, 2, 3)}
        for name, array in arrays.items():
            write(folder, f"{name}-{shard}", small(array))
        write(folder, f"second-{shard}", second)
        words_, lefts = np.unique(second, return_counts=True)
        rows = frame(list(blobs(words_ // step, (words_, small(lefts)), shards)) + [(-1 - shard, pickle.dumps(_histogram(n)))])
        return rows

    def continued(shard: int, parts: list) -> pd.DataFrame:
        second, n = _summed(*map(np.concatenate, zip(*parts)))
        lefts = np.bincount(second.astype(np.int64) - shard * step, n, step).astype(np.int64)
        write(folder, f"left-{shard}", small(lefts))
        return frame([(shard, pickle.dumps((*_histogram(n), int(n.sum()))))])

    # One row per shard and histogram reaches the driver.
    first = checkpointed(merged(docs.select("text").mapInPandas(gather, BLOBS), merge, shards, BLOBS))
    seen = {-1 - r.shard: pickle.loads(r.data) for r in first.where("shard < 0").collect()}
    left = {r.shard: pickle.loads(r.data) for r in merged(first.where("shard >= 0"), continued, shards, BLOBS).collect()}
    total = lambda rows, n: [sum(r[i] for r in rows.values()) for i in range(n)]
    *lefts, n_left = total(left, 5)
    return Bigrams(folder, step, set(seen), set(left)), total(seen, 4), lefts, n_left


def _split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _histogram(n: np.ndarray) -> tuple[int, ...]:
    """How many entries have counts 1, 2, 3 and 4."""
    return tuple(map(int, np.bincount(np.minimum(n, 5), minlength=6)[1:5]))


class Model:
    """p(w | v) = max(c(v w) - D, 0) / c(v) + rest(v) * p(w); p(w) likewise from left neighbours, over a uniform share."""

    def __init__(self, known: Lookup, tokens: int, grams: Bigrams, seen: list[int], lefts: list[int], n_left: int):
        self.known, self.tokens, self.grams = known, tokens, grams
        self.high, self.low, self.n_left = discounts(seen), discounts(lefts), n_left
        # What the discounts leave over, from the numbers of words with 1, 2 and 3 or more left neighbours.
        more = known.size - lefts[0] - lefts[1]
        freed = self.low[0] * lefts[0] + self.low[1] * lefts[1] + self.low[2] * more
        self.spread = (freed / n_left if n_left else 1.0) / (known.size + 1)

    def _rows(self, ids: np.ndarray, shards: set[int], *names: str) -> list[np.ndarray]:
        """Values of dense arrays at sorted ids from 0; 0 where a shard has none."""
        out = [np.zeros(len(ids), np.int64) for _ in names]
        shard = ids // self.grams.step
        for s in np.unique(shard):
            if int(s) in shards:
                cut = slice(*np.searchsorted(shard, (s, s + 1)))
                for values, name in zip(out, names):
                    values[cut] = mapped(self.grams.folder, f"{name}-{s}")[ids[cut] - s * self.grams.step]
        return out

    def unigrams(self, ids: np.ndarray) -> np.ndarray:
        """Lower-order probabilities of sorted word ids; -1 is an unknown word."""
        lefts = np.zeros(len(ids), np.int64)
        real = ids >= 0
        lefts[real] = self._rows(ids[real], self.grams.seconds, "left")[0]
        return np.maximum(lefts - _discount(lefts, self.low), 0) / max(1, self.n_left) + self.spread

    def counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of bigrams, sorted by first word; a search in each first word's row."""
        out = np.zeros(len(first), np.int64)
        shard = first // self.grams.step
        for s in np.unique(shard):
            if int(s) not in self.grams.firsts:
                continue
            cut = slice(*np.searchsorted(shard, (s, s + 1)))
            starts, words_, count = (mapped(self.grams.folder, f"{name}-{s}") for name in ("starts", "second", "count"))
            row, wanted = first[cut] - s * self.grams.step, second[cut]
            a, b = starts[row].astype(np.int64), starts[row + 1].astype(np.int64)
            end = b.copy()
            while (open_ := a < b).any():
                middle = (a + b) // 2
                less = open_ & (words_[np.minimum(middle, len(words_) - 1)] < wanted)
                a, b = np.where(less, middle + 1, a), np.where(open_ & ~less, middle, b)
            at = np.minimum(a, len(words_) - 1)
            out[cut] = np.where((a < end) & (words_[at] == wanted), count[at], 0)
        return out

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base score and score."""
        every, at, counts = _tokens(texts)
        place, c = self.known.find(every, "count")
        ids = np.where(place >= 0, place + 1, -1)
        order = np.argsort(ids, kind="stable")
        p1 = np.empty(len(every))
        p1[order] = self.unigrams(ids[order])
        base = np.log10((c + 0.5) / (self.tokens + 0.5 * (self.known.size + 1)))
        before = np.append(-2, at[:-1])
        begins = np.cumsum(counts) - counts
        before[begins] = len(every)  # the start
        first = np.append(ids, START)[before]
        pairs, back = np.unique((first + 1) * (len(every) + 1) + at, return_inverse=True)
        first, word = pairs // (len(every) + 1) - 1, pairs % (len(every) + 1)
        p = p1[word]
        use = np.flatnonzero(first >= 0)
        if len(use):
            v, w = first[use], ids[word[use]]
            total, *n = self._rows(v, self.grams.firsts, "total", "n1", "n2", "n3")
            pair = np.where(w >= 0, self.counts(v, np.maximum(w, 0)), 0)
            rest = sum(d * k for d, k in zip(self.high, n))
            there = total > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                whole = (np.maximum(pair - _discount(pair, self.high), 0) + rest * p[use]) / total
            p[use] = np.where(there, whole, p[use])
        logs = np.log10(p)[back]
        add = lambda x: np.add.reduceat(x, begins)
        return counts, add((c > 0)[at].astype(np.int64)), add(base[at]), add(logs)


def fit(docs: DataFrame, shards: int | None = None) -> Model:
    """Count the tokens and bigrams of all texts; null and empty texts are one end token."""
    shards = shards or shards_for(docs)
    known, tokens = vocabulary(docs, shards)
    return Model(known, tokens, *bigrams(docs, known, shards))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, base_score, score) for rows (doc_id, held_out, text)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, held_out, texts in _lots(parts):
            n, n_known, base, score = model.score(texts)
            yield pd.DataFrame({"doc_id": ids, "held_out": held_out, "n_tokens": n, "n_known": n_known, "base_score": base, "score": score})

    # Ids travel as text: pandas would turn long ids beside nulls into floats.
    found = docs.select(F.col("doc_id").cast("string"), "held_out", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        run, "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), 5) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "text")
    model = fit(docs.where(~F.col("held_out")))
    return scored(docs, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
