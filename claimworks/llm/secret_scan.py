"""Secrets: an Aho-Corasick prefilter, patterns anchored at its hits, checksums inside the found keys."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import product
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import table

HEX_RUN = 4  # hex digits that make one keyword of the prefilter: a run of 24 starts with one
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)  # fixed values of the code


def crc_base62(body: str, check: str) -> bool:
    """Whether ``check`` is the CRC-32 of ``body`` in base 62, six digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits == check


def base58_check(key: str) -> bool:
    """Whether the last four of the key's bytes are the head of the others' double SHA-256."""
    value = 0
    for c in key:
        value = value * 58 + BASE58.index(c)
    data = value.to_bytes((value.bit_length() + 7) // 8, "big")
    return hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


def bech32_check(key: str) -> bool:
    """Whether the checksum of a bech32 string (prefix, 1, data) holds."""
    prefix, _, data = key.lower().rpartition("1")
    value = 1
    for v in (*(ord(c) >> 5 for c in prefix), 0, *(ord(c) & 31 for c in prefix), *map(BECH32.index, data)):
        top = value >> 25
        value = (value & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate(_GENERATOR):
            value ^= g if top >> i & 1 else 0
    return value == 1


class Kind(NamedTuple):
    """One kind of secret: keywords (lower case), the pattern at a hit, the test a match must pass."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    holds: Callable[[re.Match], bool]
    base: bool = False


def _checked(name: str, keywords: tuple[str, ...], pattern: str, holds: Callable[[str], bool]) -> Kind:
    """A kind with an embedded checksum; it stands between characters of no key."""
    return Kind(name, keywords, re.compile(rf"(?<![A-Za-z0-9_])(?:{pattern})(?![A-Za-z0-9_])"), lambda m: holds(m.group()))


# The base patterns and the published forms of keys that carry a checksum.
KINDS = (
    Kind("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"), re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE),
        lambda m: len(m.group(2)) >= 6, True),
    Kind("access", ("akia",), re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20, True),
    Kind("hex", tuple(map("".join, product("0123456789abcdef", repeat=HEX_RUN))), re.compile("[0-9a-f]+"),
         lambda m: len(m.group()) >= 24, True),
    _checked("forge", tuple(f"gh{c}_" for c in "pousr"), "gh[pousr]_[A-Za-z0-9]{36}", lambda k: crc_base62(k[4:34], k[34:])),
    _checked("registry", ("npm_",), "npm_[A-Za-z0-9]{36}", lambda k: crc_base62(k[4:34], k[34:])),
    _checked("wallet", ("xprv",), "xprv[1-9A-HJ-NP-Za-km-z]{107}", base58_check),
    _checked("age", ("age-secret-key-1",), f"AGE-SECRET-KEY-1[{BECH32.upper()}]{{58}}", bech32_check),
    _checked("nostr", ("nsec1",), f"nsec1[{BECH32}]{{58}}", bech32_check),
)
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


@lru_cache(maxsize=1)
def _automaton() -> tuple[ahocorasick.Automaton, list[tuple[int, int]]]:
    """The keywords of all kinds in one automaton; its value for a hit tells (kind, length)."""
    automaton, meaning = ahocorasick.Automaton(ahocorasick.STORE_INTS), []
    for i, kind in enumerate(KINDS):
        for length in sorted({len(k) for k in kind.keywords}):
            for keyword in kind.keywords:
                if len(keyword) == length:
                    automaton.add_word(keyword, len(meaning))
            meaning.append((i, length))
    automaton.make_automaton()
    return automaton, meaning


def find(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the secrets in a text, in that order; places count code points, ends are exclusive.

    A kind's pattern is tried at the prefilter's hits only, left to right and
    never inside an earlier match of its kind, whether that passed its test or
    not. Every match starts with one of its kind's keywords, and the first hit of
    a hex run is where it starts, so this gives what a search of the whole text gives.
    """
    if not text:
        return []
    automaton, meaning = _automaton()
    done, found = [0] * len(KINDS), []
    # Only for the prefilter: the one letter whose lower case is longer is replaced, so that places stay.
    for last, value in automaton.iter(text.replace("İ", "i").lower()):
        i, length = meaning[value]
        start = last - length + 1
        if start < done[i]:
            continue
        match = KINDS[i].pattern.match(text, start)
        if match:
            done[i] = match.end()
            if KINDS[i].holds(match):
                found.append((start, i, match.end()))
    return sorted(found)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: kind, start, end and whether the kind is a base one, by start, then kind as listed.

    A column of that name is replaced; rows, repeated ones too, and all other
    columns stay as they are. Null and empty texts have no secrets. Time is in
    proportion to the text's length; a task holds one Arrow batch.
    """

    @F.pandas_udf(SPANS)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([[(KINDS[i].name, s, e, KINDS[i].base) for s, i, e in find(t)] for t in part], dtype="object")

    return docs.withColumn("secrets", run(F.col(text_col)))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text of ``documents``; one row per row of the table."""
    found, spans = scan(table(spark, sf_dir, "documents").select("doc_id", "text")), F.col("secrets")
    written = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.array_join(F.transform(F.filter(spans, lambda s: s["base"]), written), ",")
    return found.select("doc_id", *[count(k.name) for k in KINDS if k.base], F.sha2(base, 256).alias("base_sha256"),
                        F.array_join(F.transform(spans, written), ",").alias("spans"))
