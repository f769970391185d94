"""Benchmark decontamination: windows of canonical templates, joined by hash, with consistent slots."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import hashes, table, window_hashes

WIDTH = 10  # words of a window; shorter items are one window
MIN_SHARE = 0.5  # of an item's words that a document must hold in windows
MIN_RUN = 30  # words of one passage that count whatever an item's length
MIN_PLAIN = 5  # words of a template window that are no placeholders (half, if it is shorter)
LOT = 100_000  # words whose windows are hashed at once
FILTER_BITS = (16, 28)  # least and most of a filter: 8 KB to 32 MB
CHUNK = 16  # of them in one row while the filter is gathered

NUMBER, NAME = "<num>", "<name>"
# Number words and units.
NUMBERS = set("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty "
              "seventy eighty ninety hundred thousand million".split())
UNITS = set("mm cm m km in ft yd mi mg g kg t lb oz ml l gal s sec min h hr hour hours day days week weeks month months "
            "year years minute minutes second seconds meter meters metre metres kilometer kilometers mile miles inch "
            "inches foot feet gram grams kilogram kilograms pound pounds liter liters litre litres dollar dollars cent "
            "cents euro euros percent degree degrees".split())
_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*")
_PLACEHOLDER = {kind: xxhash.xxh64_intdigest(kind) for kind in (NUMBER, NAME)}


def _inside(before: str) -> bool:
    """Whether a sentence goes on after these two characters: a letter other than A-Z, a comma or a semicolon, and a space."""
    c = before[:1]
    return before[1:] == " " and (c in ",;" or c.isalpha() and not "A" <= c <= "Z")


def _slots(kinds: dict[int, str], lowered: str, words: list[str], starts: np.ndarray) -> list[tuple[int, int, str, str, str]]:
    """(first word, end, kind, value, unit) of each slot; words of one kind with only blanks or a dash between are one."""
    found: list[tuple[int, int, str, str, str]] = []
    for i in sorted(kinds):
        kind, value = kinds[i], words[i]
        unit = words[i + 1] if kind == NUMBER and i + 1 < len(words) and words[i + 1] in UNITS else ""
        end = i + 1 + bool(unit)
        if found and found[-1][1] == i and found[-1][2] == kind and not found[-1][4] and not lowered[
                starts[i - 1] + len(words[i - 1]):starts[i]].strip(" \t\n-"):
            first, *_, before, _ = found.pop()
            found.append((first, end, kind, f"{before} {value}", unit))
        else:
            found.append((i, end, kind, value, unit))
    return found


@lru_cache(maxsize=2)
def _classes(size: int) -> np.ndarray:
    """By code point: 1 what words are made of, 2 digits, 4 what may stand between digits."""
    kinds = np.fromiter((2 if c.isdecimal() else c.isalnum() for c in map(chr, range(size))), np.uint8, size)
    kinds[[ord("."), ord(",")]] = 4
    return kinds


def _token_starts(lowered: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens of ``_TOKEN`` start, and whether each is a number."""
    points = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.zeros(len(points) + 2, np.uint8)
    kinds[2:] = _classes(1 << 16 if points.max(initial=0) < 1 << 16 else 0x110000)[points]
    digit, now = kinds == 2, kinds[2:]
    begins = (now == 1) & (kinds[1:-1] != 1)
    begins |= digit[2:] & ~digit[1:-1] & ~((kinds[1:-1] == 4) & digit[:-2])
    starts = np.flatnonzero(begins)
    return starts, digit[2:][starts]


def canonical(text: str | None) -> tuple[list[str], list[list[tuple[int, int, str, str, str]]]]:
    """Lower-cased words, and the slots of each reading of them that has some.

    A name is a capitalised word (A-Z, then a-z) inside a sentence; the last
    reading also takes those that start a sentence, line or quotation. A slot is
    a name of any number of words, or a number of any number of words with or
    without a unit, so a template does not change with the words of its slots.
    """
    text = text or ""
    lowered = text.lower()
    plain = _TOKEN.findall(lowered)
    if not plain:
        return plain, []
    starts, digits = _token_starts(lowered)
    kinds = dict.fromkeys(np.flatnonzero(digits).tolist(), NUMBER)
    spelt = NUMBERS.intersection(plain)
    if spelt:
        kinds |= {i: NUMBER for i, w in enumerate(plain) if w in spelt}
    units = {i + 1 for i in kinds if i + 1 < len(plain) and plain[i + 1] in UNITS}
    names = {}
    if len(lowered) == len(text):  # else places do not agree
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        first, second = points[starts] - ord("A"), points[np.minimum(starts + 1, len(points) - 1)] - ord("a")
        for i in np.flatnonzero((first < 26) & (second < 26)).tolist():
            if i not in kinds and i not in units:
                names[i] = int(starts[i])
    if not names and not kinds:
        return plain, []
    inside = kinds | {i: NAME for i, at in names.items() if at > 1 and _inside(text[at - 2:at])}
    every = kinds | dict.fromkeys(names, NAME)
    found = [inside, every] if len(every) > len(inside) else [inside]
    return plain, [_slots(k, lowered, plain, starts) for k in found if k]


class _Reading:
    """One reading of a text: words or slots, where each starts among the plain words, and their hashes."""

    def __init__(self, words: list[str], h: np.ndarray, slots: list[tuple[int, int, str, str, str]],
                 known: list[tuple[int, int, str, str, str]] = ()):
        self.words, self.h, self._slots, self._earlier = words, h, slots, known
        if slots:
            self.h = h.copy()
            self.h[[s[0] for s in slots]] = [_PLACEHOLDER[s[2]] for s in slots]
            self._inner = [i for s in slots for i in range(s[0] + 1, s[1])]
            if self._inner:
                self.h = np.delete(self.h, self._inner)

    @cached_property
    def slots(self) -> dict[int, tuple[int, int, str, str, str]]:
        return {s[0]: s for s in self._slots}

    @cached_property
    def firsts(self) -> np.ndarray:
        """Where slots start that an earlier reading has not."""
        return np.array(sorted(s[0] for s in {*self._slots}.difference(self._earlier)), np.int64)

    @cached_property
    def places(self) -> np.ndarray:
        """The plain word at which each word or slot starts, and the number of plain words."""
        every = np.arange(len(self.words) + 1)
        return np.delete(every, self._inner) if self._slots else every

    def slotted(self, starts: np.ndarray, n: int) -> np.ndarray:
        """Whether the windows of ``n`` from the starts hold a slot that an earlier reading has not."""
        return np.searchsorted(self.firsts, self.places[starts + n]) > np.searchsorted(self.firsts, self.places[starts])

    def row(self, start: int, n: int) -> tuple | None:
        """(start, first word, end, template text, slot values) of a window, or None if it has too few words of its own."""
        places = self.places[start:start + n].tolist()
        held = [self.slots.get(i) for i in places]
        if sum(s is None for s in held) < min(MIN_PLAIN, (n + 1) // 2):
            return None
        template = " ".join(s[2] if s else self.words[i] for i, s in zip(places, held))
        return start, places[0], int(self.places[start + n]), template, [v for s in held if s for v in s[3:]]


def _readings(text: str | None) -> list[_Reading]:
    """The words as they are, and with slots if there are any."""
    plain, slotted = canonical(text)
    h = hashes(plain)
    return [_Reading(plain, h, slots, known) for slots, known in zip([[], *slotted], [[], [], *slotted])]


def _windows(texts: list[list[_Reading]], widths: tuple[int, ...], bits: np.ndarray | None = None
             ) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, reading, width, start, hash) of the windows of several texts' readings, hashed as one run.

    Windows of a later reading hold a slot of its own. With ``bits`` only those that may be in the filter.
    """
    for k in range(max(map(len, texts), default=0)):
        own = [i for i, readings in enumerate(texts) if len(readings) > k]
        ends = np.cumsum([len(texts[i][k].h) for i in own])
        h = np.concatenate([texts[i][k].h for i in own])
        for n in widths:
            hs = window_hashes(h, n)
            at = may_hold(bits, hs) if bits is not None else np.arange(len(hs))
            of = np.searchsorted(ends, at, "right")
            whole = np.flatnonzero(at + n <= ends[of]) if len(at) else at
            at, of = at[whole], of[whole]
            cuts = np.flatnonzero(np.diff(of)) + 1
            for of, at in zip(np.split(of, cuts), np.split(at, cuts)) if len(at) else ():
                i, begin = own[of[0]], ends[of[0]] - len(texts[own[of[0]]][k].h)
                starts = at - begin
                keep = texts[i][k].slotted(starts, n) if k else slice(None)
                for start, value in zip(starts[keep].tolist(), _signed(hs[at[keep]])):
                    yield i, k, n, start, value


def filter_of(hashes: DataFrame) -> np.ndarray:
    """A bit per place for the hashes in column ``h`` (two places each), at most 32 MB whatever their number.

    Over 128 bits a hash as long as that fits; beyond, more windows pass that meet
    nothing in the join. Gathered as chunks of 8 KB.
    """
    low, high = FILTER_BITS
    k = min(high, max(low, (128 * hashes.count()).bit_length()))
    places = hashes.select(F.explode(F.array(F.shiftrightunsigned("h", 64 - k), F.col("h").bitwiseAND((1 << k) - 1))).alias("p"))

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << CHUNK, np.uint8)
        bits[part.p.to_numpy() & ((1 << CHUNK) - 1)] = 1
        return pd.DataFrame([(key[0], np.packbits(bits, bitorder="little").tobytes())], columns=["chunk", "bits"])

    chunks = places.distinct().withColumn("chunk", F.shiftright("p", CHUNK)).groupBy("chunk").applyInPandas(pack, "chunk long, bits binary")
    out = np.zeros(1 << (k - 3), np.uint8)
    for r in chunks.collect():
        out[r.chunk << (CHUNK - 3):(r.chunk + 1) << (CHUNK - 3)] = np.frombuffer(r.bits, np.uint8)
    return out


def may_hold(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places of the hashes of which both bits are set."""
    k = (8 * len(bits)).bit_length() - 1
    held = lambda p: bits[p >> 3] >> (p & 7).astype(np.uint8) & 1
    found = np.flatnonzero(held((h >> np.uint64(64 - k)).astype(np.int64)))
    return found[held((h[found] & np.uint64((1 << k) - 1)).astype(np.int64)) == 1]


def _signed(h: np.ndarray) -> list[int]:
    return h.view(np.int64).tolist()


_WINDOW = "h long, reading int, start int, first int, end int, template string, slots array<string>"


def benchmark_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows (item_id, n_words, n_free, width, h, exact, reading, start, first, end, template, slots): all windows of all items.

    ``exact`` windows hold the words of a slot as they are; ``n_free`` words are
    in others, so can be met where the slots' words are other ones. A reading shorter than ``width`` is one window of its own length; items
    without a word, and null ones, have none.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for item, text in zip(part.item_id, part.text):
                readings = _readings(text)
                own, bound = [], np.zeros(len(readings[0].words) + 1, bool)
                for first, last, *_ in readings[-1].slots.values():
                    bound[first:last] = True
                for k, read in enumerate(readings):
                    n = min(width, len(read.h))
                    for _, j, _, start, h in _windows([readings], (n,)) if n else ():
                        if j == k and (r := read.row(start, n)):
                            own.append((n, h, k == 0 and bool(bound[r[1]:r[2]].any()), k, *r))
                free = np.zeros(len(bound), bool)
                for _, _, exact, _, _, first, last, *_ in own:
                    free[first:last] |= not exact
                rows += [(item, len(bound) - 1, int(free.sum()), *r) for r in own]
            yield pd.DataFrame(rows, columns=["item_id", "n_words", "n_free", "width", "h", "exact", "reading", "start",
                                              "first", "end", "template", "slots"])

    return items.where("item_id IS NOT NULL").select(F.col("item_id").cast("string"), "text").mapInPandas(
        run, "item_id string, n_words int, n_free int, width int, " + _WINDOW.replace("h long", "h long, exact boolean"))


def _consistent(windows: list[dict]) -> list[dict]:
    """The windows that do not contradict the most frequent value of a slot."""
    votes = Counter(p for w in windows for p in w["pairs"])
    most: dict[str, int] = {}
    for (value, _), n in votes.items():
        most[value] = max(n, most.get(value, 0))
    return [w for w in windows if all(votes[p] >= most[p[0]] for p in w["pairs"])]


def _runs(windows: list[dict]) -> list[list[dict]]:
    """Windows of one alignment, cut where they do not touch."""
    out: list[list[dict]] = []
    for w in sorted(windows, key=lambda w: w["at"]):
        if out and w["first"] <= out[-1][-1]["end"]:
            out[-1].append(w)
        else:
            out.append([w])
    return out


def _chain(runs: list[list[dict]]) -> list[list[dict]]:
    """The runs that cover most of an item's words in the item's order, the closer ones if equal."""
    runs = sorted(runs, key=lambda r: (r[0]["doc_first"], r[0]["first"]))
    a, b, s, e = (np.array([r[i][k] for r in runs]) for i, k in ((0, "first"), (-1, "end"), (0, "doc_first"), (-1, "doc_end")))
    score, before = (b - a).astype(float), np.full(len(runs), -1)
    for j in range(1, len(runs)):
        i = np.flatnonzero((a[:j] < a[j]) & (b[:j] < b[j]) & (s[:j] < s[j]) & (e[:j] < e[j]))
        if len(i):
            total = score[i] + b[j] - np.maximum(a[j], b[i]) - 1e-7 * np.abs((s[j] - e[i]) - (a[j] - b[i]))
            k = int(np.argmax(total))
            if total[k] > score[j]:
                score[j], before[j] = total[k], i[k]
    out, j = [], int(np.argmax(score))
    while j >= 0:
        out.append(runs[j])
        j = int(before[j])
    return out[::-1]


def _covered(windows: list[dict], n_words: int) -> np.ndarray:
    words = np.zeros(n_words, bool)
    for w in windows:
        words[w["first"]:w["end"]] = True
    return words


def _share(windows: list[dict], n_words: int, n_free: int) -> float:
    """Of all words, or of those that can be met whatever the slots' words are."""
    free = _covered([w for w in windows if not w["exact"]], n_words).sum()
    return max(_covered(windows, n_words).mean(), free / n_free if n_free else 0.0)


def _passage(runs: list[list[dict]], n_words: int) -> int:
    """Most words held by runs that follow each other with no more than a window's width between, in item and document."""
    most, near = 0, []
    for run in runs:
        if near and max(run[0][k] - near[-1][j] for k, j in (("first", "end"), ("doc_first", "doc_end"))) > WIDTH:
            near = []
        near = near + run
        most = max(most, int(_covered(near, n_words).sum()))
    return most


def held_share(windows: list[dict], n_words: int, n_free: int) -> tuple[float, int]:
    """The share of an item's words that a document holds, and the longest passage in words.

    Windows count at one alignment, or at several if they follow each other in
    the item's order; either way those with contradicting slots do not count.
    """
    alignments = defaultdict(list)
    for w in windows:
        alignments[w["reading"], w["doc_reading"], w["start"] - w["at"]].append(w)
    sound = [good for at in alignments.values() if (good := _consistent(at))]
    parts = [_runs(good) for good in sound]
    share, passage = max(_share(good, n_words, n_free) for good in sound), max(_passage(p, n_words) for p in parts)
    if len(sound) > 1 and share < 1:
        chain = _chain([run for p in parts for run in p])
        good = {id(w): w for w in _consistent([w for run in chain for w in run])}
        left = [kept for run in chain if (kept := [w for w in run if id(w) in good])]
        share, passage = max(share, _share(list(good.values()), n_words, n_free)), max(passage, _passage(left, n_words))
    return float(share), passage


def matches(docs: DataFrame, items: DataFrame, width: int = WIDTH, min_share: float = MIN_SHARE) -> DataFrame:
    """Rows (doc_id, row_key, item_id, share): documents that hold ``min_share`` of an item's words in windows,
    or a passage of ``MIN_RUN`` words of it.

    Windows meet by hash and then by their template text. They count at one
    alignment (difference of starts) or, where words were put in or left out, at
    several in the item's order. Their slots must be consistent: equal values in
    the item have equal values in the document; windows that contradict the most
    frequent value of a slot do not count. A document may hold an item's words,
    or its template with other numbers, names and units.
    ``row_key`` hashes id and text, so rows with equal ids stay apart.
    """
    known = benchmark_windows(items, width)
    widths = tuple(sorted(r[0] for r in known.select("width").distinct().collect()))  # ``width`` values at most
    bits = filter_of(known.select("h").distinct())

    def held(lot: list[tuple[str, int, list[_Reading]]]) -> list[tuple]:
        texts = [readings for *_, readings in lot]
        return [(*lot[i][:2], h, k, *r) for i, k, n, start, h in _windows(texts, widths, bits) if (r := texts[i][k].row(start, n))]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows, lot, words = [], [], 0
            for doc, key, text in zip(part.doc_id, part.row_key, part.text):
                lot.append((doc, key, _readings(text)))
                words += len(lot[-1][2][0].words)
                if words >= LOT:
                    rows, lot, words = rows + held(lot), [], 0
            rows += held(lot)
            yield pd.DataFrame(rows, columns=["doc_id", "row_key", "h", "reading", "start", "first", "end", "template", "slots"])

    def shares(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for doc, key, item, n_words, n_free, windows in part.itertuples(index=False):
                for w in windows:  # a slot's value and unit; one that is missing on either side says nothing
                    w["pairs"] = [p for p in zip(w["values"], w["slots"]) if all(p)]
                rows.append((doc, key, item, *held_share(list(windows), n_words, n_free)))
            yield pd.DataFrame(rows, columns=["doc_id", "row_key", "item_id", "share", "passage"])

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_key"), "text")
    found = rows.mapInPandas(run, f"doc_id string, row_key long, {_WINDOW}").select(
        "doc_id", "row_key", "h", F.col("reading").alias("doc_reading"), "start", F.col("first").alias("doc_first"),
        F.col("end").alias("doc_end"), "template", "slots")
    k = known.select("item_id", "n_words", "n_free", "h", "exact", "reading", F.col("start").alias("at"), "first", "end", "template",
                     F.col("slots").alias("values"))
    window = F.struct("exact", "reading", "doc_reading", "at", "start", "first", "end", "doc_first", "doc_end", "values", "slots")
    # One group is one item's windows in one document.
    groups = found.join(k, ["h", "template"]).groupBy("doc_id", "row_key", "item_id", "n_words", "n_free").agg(
        F.collect_set(window).alias("windows"))
    whole = groups.mapInPandas(shares, "doc_id string, row_key long, item_id string, share double, passage int")
    return whole.where((F.col("share") >= min_share) | (F.col("passage") >= MIN_RUN)).select(
        F.col("doc_id").cast("long").alias("doc_id"), "row_key", "item_id", "share")


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    leaks = matches(docs, items).select(F.col("row_key").alias("_leak")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("doc_id", "text").alias("_key"))
    return rows.join(leaks, F.col("_key") == F.col("_leak"), "left_anti").select("row.*")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the items it holds (ids as text, in order) and the largest share of one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = matches(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    per = found.groupBy("row_key").agg(F.array_join(F.array_sort(F.collect_set("item_id")), ",").alias("items"),
                                       F.max("share").alias("share"))
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"))
    return rows.join(per, "row_key", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.lit("")).alias("items"),
        F.coalesce("share", F.lit(0.0)).alias("share"))
