"""Operators with one right answer, against brute force."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from claimworks.llm import decontaminate, license, mixing, multiset, ngram, pii, simhash, substring
from claimworks.llm.components import components

from . import fixture

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    text = (text or "").translate(ASCII) if lower else text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def grouped(rows):
    """Rows by id; rows with equal ids in any order."""
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(tuple(r[1:]))
    return {k: sorted(v, key=repr) for k, v in out.items()}


# SimHash -----------------------------------------------------------------

def simhash_of(text):
    w = words(text, True)
    parts = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    counts = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(parts))


def test_simhash_components(spark):
    rng = random.Random(3)
    base = fixture.sentence(rng, 300).split()
    near = []
    for i in range(40):
        mutated = list(base)
        mutated[rng.randrange(300)] = f"new{i}"
        near.append((500 + i, " ".join(mutated)))
    docs = fixture.table(spark, near)
    rows = [(r[0], r[1], simhash_of(r[1])) for r in fixture.rows(near)]
    root = {f: f for *_, f in rows}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    prints = sorted(root)
    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                root[find(b)] = find(a)
    least = defaultdict(lambda: None)
    for i, _, f in rows:
        if i is not None:
            least[find(f)] = i if least[find(f)] is None else min(i, least[find(f)])
    found = simhash.near_groups(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()
    assert grouped(found) == grouped([(i, f"{f:016x}", least[find(f)]) for i, _, f in rows])
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({find(f) for *_, f in rows})
    assert {i for i in ids if i is not None} == set(least.values()) - {None}


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 7])
def test_simhash_links_lose_none(spark, bits):
    rng = random.Random(bits)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        f = rng.getrandbits(64)
        prints.add(f)
        for _ in range(8):
            g = f
            for b in rng.sample(range(64), rng.randrange(1, 9)):
                g ^= 1 << b
            prints.add(g)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), bits).collect()
    expected = {frozenset((a, b)) for a in prints for b in prints if a != b and (a ^ b).bit_count() <= bits}
    got = [frozenset((a % 2**64, b % 2**64)) for a, b in found]
    assert len(got) == len(set(got)) and set(got) == expected


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1002), (1000, 1002), (7, 7)]
    random.Random(1).shuffle(edges)
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{i: 0 for i in range(1, 301)}, 1001: 1000, 1002: 1000}


# Mixing ------------------------------------------------------------------

def level(sizes, weights, cap=3):
    full, total = set(), sum(sizes)
    while True:
        rest = sum(w for i, w in enumerate(weights) if i not in full)
        left = total - sum(cap * sizes[i] for i in full)
        t = [cap * s if i in full else (left * weights[i] / rest if rest else 0) for i, s in enumerate(sizes)]
        above = {i for i in range(len(t)) if t[i] > cap * sizes[i]}
        if not above:
            return t
        full |= above


def test_mixing(spark):
    docs = fixture.table(spark)
    rows = fixture.rows()
    size = Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    expected = dict(zip(order, level([size[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])))
    found = mixing.mix(docs).select("doc_id", "row.source", "size", "source_size", "target", "taken", "row.text").collect()
    assert len(found) == len(rows)
    taken = Counter()
    for r in found:
        assert r.size == len(words(r.text)) and r.source_size == size[r.source]
        assert math.isclose(r.target, expected[r.source], rel_tol=1e-9)
        assert 0 <= r.taken <= 3 * r.size
        assert r.taken >= math.floor(r.target / r.source_size) * r.size  # complete epochs precede
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - expected[s]) <= 3
    again = mixing.mix(docs.repartition(3)).select("doc_id", "size", "taken").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in mixing.mix(docs).select("doc_id", "size", "taken").collect())


@pytest.mark.parametrize("sizes", [[1, 1000, 5], [10, 10, 10, 0], [100, 1, 1, 1, 1, 1, 1], [7]])
def test_mixing_targets(spark, sizes):
    rows = [(f"s{i:02}", 1, s) for i, s in enumerate(sizes)]
    found = mixing.targets(spark.createDataFrame(rows, "source string, n long, source_size long")).orderBy("source").collect()
    expected = level(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert np.allclose([r.target for r in found], expected)


def test_mixing_prefers_quality(spark):
    good = [(i, fixture.sentence(random.Random(i), 40).replace("1", "a"), "s") for i in range(300)]
    bad = [(1000 + i, "## 12 == 99 %% " * 10, "s") for i in range(300)]
    other = [(5000 + i, "word " * 100, "a") for i in range(200)]
    docs = spark.createDataFrame(good + bad + other, "doc_id long, text string, source string")
    found = mixing.mix(docs).where("row.source = 's'").toPandas()
    assert found.taken[found.doc_id < 1000].gt(0).mean() > found.taken[found.doc_id >= 1000].gt(0).mean() + 0.2


# Fingerprints ------------------------------------------------------------

def test_multiset_edits(spark):
    rows = [r for r in fixture.rows() if r[0] not in (None, 9006)]
    docs = spark.createDataFrame(rows, fixture.SCHEMA).repartition(4)
    found = {r.doc_id: r for r in multiset.edits(docs).collect()}
    order = sorted(((r[0], r[1] or "") for r in rows), reverse=True)
    assert len(found) == len(order)
    for k, (i, text) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = found[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == multiset.of(text).text() and r.edited_fingerprint == multiset.of(edited).text()
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1


def test_multiset_keeps_every_row(spark):
    assert multiset.edits(fixture.table(spark)).count() == len(fixture.rows())
    lone = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert multiset.edits(lone).first().near_next == 1.0


def test_multiset_algebra():
    rng = random.Random(5)
    parts = [fixture.sentence(rng, rng.randrange(1, 12)) for _ in range(30)] + ["again"] * 4
    text, shuffled = "\n".join(parts), "\n".join(rng.sample(parts, len(parts)))
    assert multiset.of(text).text() == multiset.of(shuffled).text()
    assert multiset.of(text).text() != multiset.of("\n".join(parts[:-1])).text()
    assert multiset.of(text).add(parts[:3], -1).text() == multiset.of("\n".join(parts[3:])).text()
    assert multiset.of(text).edited(text, shuffled + "\nnew").add(["new"], -1).text() == multiset.of(text).text()
    assert multiset.Fingerprint.parse(multiset.of(text).text()).likeness(multiset.of(text)) == 1.0
    long = [fixture.sentence(rng, 20, 10**6) for _ in range(40)]
    half = multiset.of("\n".join(long)).likeness(multiset.of("\n".join(long[:20] + [fixture.sentence(rng, 20, 10**6) for _ in range(20)])))
    assert 0.35 < half < 0.65


# License scan ------------------------------------------------------------

LICENSES = [
    (700, "Released under the MIT License."), (701, "mit\n\n-license x MIT LICENSE mitt license"), (702, "GNU GENERAL public.license v3"),
    (703, "Licensed under the Apache License, Version 2.0."), (704, "under the apache, license of version 2"),
    (705, "the émit license"), (706, "Permission is granted free of charge to any person obtaining a copy of software"),
    (707, "all\nrights reserved"), (708, "x " * 20_000 + "apache license " + "y " * 20_000 + "Apache License"),
    (709, "Redistribution and use in source and binary forms with or without modification are not permitted at all"),
    (710, "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that"),
    (711, "under the terms of the GNU Lesser General Public\nLicense as published"),
    (712, "subject to the terms of the Mozilla Public License, v. 2.0."),
    (713, "We reserved a table for all of you; the rights of guests matter."),
    (714, "creative people have much in commons and the attribution of a work is no license"),
    (715, "all rights all reserved rights all rights reserved " * 300), (716, "reserved rights all"),
]


def test_license_scan(spark):
    docs = fixture.table(spark, LICENSES)
    found = license.scan(docs).select("doc_id", "text", "license_matches").collect()
    assert len(found) == len(fixture.rows(LICENSES))
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(ASCII))
    n = 0
    for r in found:
        expected, held = set(), split(r.text or "")
        for label, template in ((label, t) for label, texts in license.TEMPLATES.items() for t in texts):
            t, width = set(split(template)), len(split(template))
            for i, w in enumerate(held):
                if w in t and len(t & set(held[i:i + width])) / len(t) >= license.THRESHOLD:
                    expected.add((i, label, len(t & set(held[i:i + width])) / len(t)))
        assert list(map(tuple, r.license_matches)) == sorted(expected), r.text
        n += len(expected)
        labels = {m.label for m in r.license_matches}
        wanted = {710: {"bsd"}, 711: {"lgpl"}, 712: {"mpl"}, 713: set(), 714: set(), 715: {"reserved"}, 716: {"reserved"}}
        assert labels == wanted.get(r.doc_id, labels)
    assert n >= 5


# Personal data -----------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PERSONAL = [
    (800, "write a@b.co, a@b.c@d.e.f and a@b.c_d@e.f or \U0001F600x.y@z.org."), (801, "1.2.3.4.5.6.7.8 and 256.1.1.1 and 0255.1.1.01"),
    (802, "4111 1111 1111 1111 or 4111-1111-1111-1111 or 4111111111111112 or 4111  1111"), (803, "+1 (555) 123-4567 +1 2 +123456789012345678 ++44 20 7946 0958."),
    (804, "+1 (499) 555-6503 4785380592391139"), (805, 'token = "2abc3ff2ca8fb1e4c565a0eb63815530a9480000" x'), (806, "a@" * 5000),
    (807, "1" * 50_000), (808, "+1" + "(" * 30_000), (809, "+1 (333) 555-0100 " * 300), (810, "me [at] host [dot] org"), (811, "@@ + 1.2.3 4"),
]


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "phone" and not 8 <= len(digits) <= 15
                    or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits))):
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_personal_data(spark):
    docs = fixture.table(spark, PERSONAL)
    found = pii.find(docs)
    assert found.columns == [*docs.columns, "pii_spans"]
    rows = found.collect()
    assert len(rows) == len(fixture.rows(PERSONAL))
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.pii_spans if s.base] == base_spans(r.text)
        assert all(0 <= s.start < s.end <= len(r.text) for s in r.pii_spans)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_redaction(spark):
    done = {r.doc_id: r.text for r in pii.redact(fixture.table(spark, PERSONAL)).collect()}
    assert done[804] == "+1 [PHONE] 4785380592391139"  # too long for a base phone; the digits are no card
    assert "@" not in done[800].replace("[EMAIL]@d.e.f", "").replace("@d.e.f", "")
    assert done[803].startswith("[PHONE]") and done[9001] is None and done[9002] == "" and done[807] == "1" * 50_000
    assert done[809].count("[PHONE]") >= 1


def test_personal_data_query(spark, tmp_path):
    """Counts, digest and spans of the query, against ``re``."""
    fixture.table(spark, PERSONAL).write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r[0]: r[1] for r in fixture.rows(PERSONAL)}
    rows = [r for r in pii.op1_pii(spark, str(tmp_path)).collect() if r.doc_id is not None and r.doc_id != 9006]
    assert len(rows) == len(fixture.rows(PERSONAL)) - 5
    for r in rows:
        spans = sorted(base_spans(texts[r.doc_id]), key=lambda s: (list(BASE).index(s[0]), s[1]))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in BASE]
        written = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert set(written) <= set(every)
        order = [((*BASE, "secret").index(s.split(":")[0]), int(s.split(":")[1])) for s in every]
        assert order == sorted(order)


def test_texts_with_very_many_spans(spark):
    """Time in proportion: a fold that copies its list takes minutes for this."""
    rng = random.Random(4)
    parts = [rng.choice(["1.2.3.4 x", "me@host.org", "me [at] host [dot] org", "call 555-123-4567", "+1 (555) 123-4567", "\ufeffé\U0001F600"])
             for _ in range(20_000)]
    text = " ".join(parts)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    spans = pii.find(docs).first().pii_spans
    assert [(s.kind, s.start, s.end) for s in spans if s.base] == base_spans(text)
    done = pii.redact(docs).first().text
    assert time.time() - start < 300
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, s.end, s.kind)):
        if s.start >= at:
            out += [text[at:s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    assert done == "".join(out) + text[at:]


def test_other_spans_stay_apart_from_base_ones(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(200):
        spans = lambda: sorted((a, a + rng.randrange(1, 6)) for a in rng.sample(range(60), rng.randrange(9)))
        rows.append((spans(), spans()))
    df = spark.createDataFrame([([tuple(x) for x in b], [tuple(x) for x in e]) for b, e in rows],
                               "base array<struct<start:int,end:int>>, extra array<struct<start:int,end:int>>")
    got = df.select("base", "extra", pii._apart(F.col("base"), F.col("extra")).alias("kept")).collect()
    for r in got:
        expected = [e for e in r.extra if not any(b.start < e.end and e.start < b.end for b in r.base)]
        assert sorted(r.kept) == sorted(expected)


def test_supervision_learns_reliable_labelers():
    class Row(dict):
        __getattr__ = dict.__getitem__

    def row(n, *votes, kind="email"):
        return Row(kind=kind, n=n, **dict(zip(pii.LABELERS, votes)), length=3, left="space", right="space")

    belief = pii.estimate([row(90, 1, 1, -1, 1), row(60, 0, 0, -1, 0), row(8, 1, 1, 0, 1), row(5, 0, 0, 1, 0)])
    assert belief["email", (1, 1, -1, 1)] > 0.9 and belief["email", (0, 0, -1, 0)] < 0.1
    assert belief["email", (1, 1, 0, 1)] > 0.5 > belief["email", (0, 0, 1, 0)]
    assert pii.estimate([]) == {} and pii.train([]) == {}


# Language model ----------------------------------------------------------

def test_language_model(spark):
    rows = [(r[0], k % 4 == 0, r[1]) for k, r in enumerate(fixture.rows([(600, "The the THE unseenword É the")]))]
    docs = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string").repartition(4)
    model = ngram.fit(docs.where("NOT held_out"), shards=5)
    tokens = [(i, h, [*words(t, True), "\n"]) for i, h, t in rows]
    train = [t for _, h, t in tokens if not h]
    c, pairs = Counter(w for t in train for w in t), Counter((a, b) for t in train for a, b in zip([None, *t], t))
    n, v = sum(c.values()), len(c)
    lefts, total, freed = Counter(w for _, w in pairs), Counter(), Counter()
    kinds = lambda values: [sum(x == k for x in values) for k in (1, 2, 3, 4)]
    high, low = ngram.discounts(kinds(pairs.values())), ngram.discounts(kinds(lefts.values()))
    cut = lambda x, d: d[min(x, 3) - 1] if x else 0.0
    for (a, _), x in pairs.items():
        total[a] += x
        freed[a] += cut(x, high)
    spread = sum(cut(x, low) for x in lefts.values()) / sum(lefts.values()) / (v + 1)

    def p(a, w):
        one = max(lefts[w] - cut(lefts[w], low), 0) / sum(lefts.values()) + spread
        return (max(pairs[a, w] - cut(pairs[a, w], high), 0) + freed[a] * one) / total[a] if a in total else one

    for a in (None, "the", "\n", "unseenword", next(iter(c))):
        assert math.isclose(sum(p(a, w) for w in c) + p(a, "never"), 1.0, rel_tol=1e-9)
    expected = grouped([(i, len(t), sum(w in c for w in t),
                         round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 4),
                         round(sum(math.log10(p(a, w)) for a, w in zip([None, *t], t)), 4)) for i, _, t in tokens])
    found = ngram.scored(docs, model).select("doc_id", "n_tokens", "n_known", F.round("base_score", 4), F.round("score", 4)).collect()
    got = grouped(found)
    assert got.keys() == expected.keys() and model.tokens == n
    for k in got:
        assert np.allclose(np.array(got[k], float), np.array(expected[k], float), atol=2e-4)


def test_language_model_without_text(spark):
    docs = spark.createDataFrame([(1, False, "a b")], "doc_id long, held_out boolean, text string")
    model = ngram.fit(docs.where("held_out"))
    got = ngram.scored(docs, model).first()
    assert (got.n_tokens, got.n_known, got.score, got.base_score) == (3, 0, 0.0, 0.0)


# Decontamination ---------------------------------------------------------

def test_decontamination(spark):
    item = "Tom buys 3 apples of 5 kg and 3 pears. Later old Mary sells seven of the apples to Tom."
    changed = "Tom buys 4 apples of 9 kg and 4 pears. Later old Jane sells nine of the apples to Tom."
    broken = "Tom buys 4 apples of 9 kg and 8 pears. Later old Jane sells nine of the apples to Tom."
    quoted = "the quick brown fox jumps over the lazy dog near the river bank at dawn"
    filler = fixture.sentence(random.Random(8), 50)
    docs = fixture.table(spark, [
        (900, f"{filler}. {item} {filler}"), (901, f"{filler} {changed}"), (902, f"{filler}. {quoted.upper()}!! {filler}"),
        (903, "the quick brown fox is not here but the lazy dog is near the river"), (904, " ".join(reversed(quoted.split()))),
        (905, "short item text"), (906, broken)])
    items = spark.createDataFrame([(1, item), (2, quoted), (3, None), (4, ""), (5, "short item text"), (6, "...")], "item_id long, text string")
    found = decontaminate.matches(docs, items).collect()
    shares = {(r.doc_id, r.item_id): r.share for r in found}
    assert {k: v for k, v in shares.items() if k != (906, "1")} == {(900, "1"): 1.0, (901, "1"): pytest.approx(1.0, abs=0.35),
                                                                   (902, "2"): 1.0, (905, "5"): 1.0}
    assert shares.get((906, "1"), 0) < shares[901, "1"]
    kept = decontaminate.drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert {903, 904} <= {r.doc_id for r in kept.collect()} and kept.count() == docs.count() - len({k for k, _ in shares})


def test_decontamination_across_alignments(spark):
    rng = random.Random(21)
    made = lambda n: ["".join(rng.choices("abcdefghij", k=8)) for _ in range(n)]
    item, long, filler = made(25), made(120), made(40)
    dealt = "Then Mary pays 25 dollars for 5 kg of flour and old Jane adds 3 eggs to the bowl of dough."
    other = "Then Lucy Ann pays thirty five dollars for 9 of flour and old Peggy Sue adds six eggs to the bowl of dough."
    texts = {910: [*filler, *item[:12], "indeed", *item[12:], *filler], 911: [*filler, *item[:12], *item[13:]],
             912: [*item[13:], *filler, *item[:12]], 913: [*filler, "end.", other], 914: [*filler, *long[30:70], *filler],
             915: [*filler, *long[30:55], *filler]}
    docs = fixture.table(spark, [(i, " ".join(t)) for i, t in texts.items()])
    items = spark.createDataFrame([(1, " ".join(item)), (2, dealt), (3, " ".join(long))], "item_id long, text string")
    shares = {(r.doc_id, r.item_id): r.share for r in decontaminate.matches(docs, items).collect()}
    assert shares == {(910, "1"): 1.0, (911, "1"): 24 / 25, (913, "2"): 1.0, (914, "3"): pytest.approx(40 / 120)}


def test_decontamination_names_that_start_a_sentence(spark):
    item = "Alice has 3 apples. Bob has 5 apples. Alice gives Bob 2."
    short = "Rose buys 4 pears and sells 2 of them"
    dense = "Add 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16 to get the total of all of these numbers in the end"
    docs = fixture.table(spark, [
        (920, "Carol has 7 apples. Dave has 9 apples. Carol gives Dave 4."), (921, "some say\nMartha buys 8 pears and sells 3 of them"),
        (922, "Add 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 32, 33, 34, 35, 36 to get the total of all of these numbers in the end"),
        (923, "Carol has many apples. Dave likes pears. Carol sees him.")])
    items = spark.createDataFrame([(1, item), (2, short), (3, dense)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, items).collect()}
    assert found == {(920, "1"), (921, "2"), (922, "3")}


def planted(rng):
    """(item, copy of it): words put in or left out near its ends or its middle, other names and numbers, other case."""
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randrange(5, 9)))
    n = rng.randrange(24, 70)
    item, slots = [word() for _ in range(n)], {}
    for i in rng.sample(range(2, n - 2), rng.randrange(3)):
        item[i] = slots[i] = rng.choice(["Anna", "Bert", "7", "12", "three"])
    copy = list(item)
    new = {"Anna": "Clara", "Bert": "David Lee", "7": "31", "12": "8.5", "three": "twenty one"}
    if rng.random() < 0.5:
        copy = [new[w] if i in slots else w for i, w in enumerate(copy)]
    kind, at = rng.randrange(3), rng.choice([1, n // 2, n - 2])
    if kind == 1:
        copy.insert(at, "indeed")
    elif kind == 2:
        del copy[at]
    return " ".join(item), " ".join(copy)


def test_decontamination_recall(spark):
    """Random items, copied with edits into documents; the same words in another order are no copy."""
    rng = random.Random(77)
    pairs = [planted(rng) for _ in range(150)]
    texts = {}
    for k, (item, copy) in enumerate(pairs):
        around = [fixture.sentence(rng, rng.randrange(80)) for _ in range(2)]
        texts[2000 + k] = f"{around[0]} so {copy} and {around[1]}"
        mixed = copy.split()
        rng.shuffle(mixed)
        texts[4000 + k] = f"{around[0]} {' '.join(mixed)}"
    docs = fixture.table(spark, list(texts.items()))
    items = spark.createDataFrame(list(enumerate(i for i, _ in pairs)), "item_id long, text string")
    found = {(r.doc_id, int(r.item_id)) for r in decontaminate.matches(docs, items).collect()}
    assert {d - 2000 for d, _ in found} <= set(range(150)) and all(d - 2000 == i for d, i in found)
    assert len(found) >= 0.9 * len(pairs)


def test_window_filter(spark):
    """Every hash that was put in is found; few others are; the same at a filter's least and most size."""
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    put = spark.createDataFrame([(int(x),) for x in h[:2000].view(np.int64)], "h long")
    bits = decontaminate.filter_of(put)
    hits = decontaminate.may_hold(bits, h)
    assert set(range(2000)) <= set(hits.tolist()) and len(hits) < 2100
    least = decontaminate.filter_of(put.limit(0))
    assert len(least) == 8192 and len(decontaminate.may_hold(least, h)) == 0


# Substrings --------------------------------------------------------------

def without_repeats(rows, width):
    places = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for i, text in order:
        w = words(text)
        for k in range(len(w) - width + 1):
            key, at = tuple(w[k:k + width]), (i is None, i or 0, k)
            places[key] = min(places.get(key, at), at)
    out = []
    for i, text in order:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if places[tuple(w[k:k + width])] < (i is None, i or 0, k):
                gone[k:k + width] = [True] * width
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("width", [20, 7])
def test_substring_dedup(spark, width):
    rng = random.Random(11)
    passages = [fixture.sentence(rng, n, 30) for n in (19, 20, 21, 25, 60)]
    extra = [(300 + i, " ".join([fixture.sentence(rng, rng.randrange(0, 30), 30), rng.choice(passages), fixture.sentence(rng, 5, 30),
                                 rng.choice(passages)])) for i in range(60)]
    extra += [(400, "a b " * 100), (401, "b a " * 40), (402, "a " * 64), (403, "a " * 19)]
    docs = fixture.table(spark, extra)
    found = substring.remove_repeats(docs, width).collect()
    assert grouped(found) == grouped(without_repeats([r[:2] for r in fixture.rows(extra)], width))


def test_windows_of_one_hash_are_told_apart():
    """Where first hashes are equal the second one decides, in what is kept and in what is looked up."""
    w = np.array([5, 5, 9, 9, 5], np.uint64)
    check, doc, at = np.array([1, 2, 1, 1, 2], np.uint64), np.array([3, 4, 1, 0, 2]), np.zeros(5, np.int64)
    keys, checks, docs, _, many = substring._firsts(w, check, doc, at, np.zeros(5, bool))
    assert list(zip(keys.tolist(), checks.tolist(), docs.tolist(), many.tolist())) == [(5, 1, 3, False), (5, 2, 2, True), (9, 1, 0, True)]

    class Table:
        rows = [(5, 11, 1), (5, 12, 2), (5, 13, 3), (9, 11, 4)]

        def find(self, keys, *columns, skip):
            out = []
            for k in keys.tolist():
                own = [(i, r) for i, r in enumerate(self.rows) if r[0] == k][skip:skip + 1]
                out.append((own[0][0], own[0][1][2], 0, own[0][1][1]) if own else (-1, 0, 0, 0))
            return tuple(np.array(c, np.int64) for c in zip(*out))

    asked = [(9, 11), (5, 13), (5, 99), (7, 11), (5, 11), (9, 12), (5, 13)]
    hit, docs, _ = substring._verified(Table(), np.array([a for a, _ in asked], np.uint64), np.array([b for _, b in asked], np.int64))
    assert sorted(zip(hit.tolist(), docs.tolist())) == [(0, 4), (1, 3), (4, 1), (6, 3)]


def test_symbols_are_consistent():
    """Equal windows hold the same symbols, whatever stands around them."""
    rng = np.random.default_rng(2)
    inner = rng.integers(0, 12, 40).astype(np.uint64)
    seen = []
    for _ in range(30):
        before, after = (rng.integers(0, 12, rng.integers(0, 30)).astype(np.uint64) for _ in range(2))
        h = np.concatenate([before, inner, after, np.zeros(1, np.uint64)])
        solid = np.arange(len(h)) < len(h) - 1
        name, start, end, low, high = substring.symbols(h, solid)
        at = len(before)
        inside = (low >= at) & (high <= at + len(inner))
        seen.append({(int(n), int(s) - at, int(e) - at) for n, s, e in zip(name[inside], start[inside], end[inside])})
    assert all(s == seen[0] for s in seen) and len(seen[0]) > 3


# Sorted arrays -----------------------------------------------------------

def test_lookups_hold_few_handles(tmp_path):
    """A thousand shards under a limit of 256 handles; every key is found, in the order of the whole table."""
    import resource

    from claimworks.llm import arrays

    rng, folder, shards = np.random.default_rng(1), f"file:{tmp_path}", 1000
    keys = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2))
    of, lengths = arrays.shard_of(keys, shards), {}
    for s in range(shards):
        own = keys[of == s]
        lengths[s] = len(own)
        arrays.write(folder, f"key-{s}", own)
        arrays.write(folder, f"n-{s}", np.arange(len(own)) + s)
    table = arrays.Lookup(folder, shards, lengths)
    limit = resource.getrlimit(resource.RLIMIT_NOFILE)
    resource.setrlimit(resource.RLIMIT_NOFILE, (256, limit[1]))
    try:
        place, n = table.find(keys, "n")
        assert (place == np.arange(len(keys))).all() and (n[:5] >= 0).all()
        assert (table.find(keys + np.uint64(1), "n")[0] == -1).all()
        assert table.find(keys[:0])[0].size == 0
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, limit)
    assert len(arrays._mapped) <= arrays.MAPPED
    arrays.write(folder, "none", np.zeros(0, np.uint32))
    assert arrays.mapped(folder, "none").dtype == np.uint32 and len(arrays.mapped(folder, "none")) == 0


def test_folders_name_their_file_system(spark):
    from claimworks.llm import arrays

    assert arrays.shared_folder(spark, "x").startswith("file:/")
    assert arrays._open("file:///a/b")[1] == arrays._open("file:/a/b")[1] == "/a/b"
    system, path = arrays._open("s3a://bucket/key?region=eu-west-1")
    assert system.type_name == "s3" and path == "bucket/key"
    with pytest.raises(ValueError):
        arrays._open("/a/b")


# Empty tables ------------------------------------------------------------

def test_empty_tables(spark):
    docs = fixture.empty(spark)
    assert simhash.near_groups(docs).count() == simhash.drop_near_copies(docs).count() == 0
    assert mixing.mix(docs).count() == multiset.edits(docs).count() == license.scan(docs).count() == 0
    assert pii.find(docs).count() == pii.redact(docs).count() == substring.remove_repeats(docs).count() == 0
    none = docs.select("doc_id", F.lit(True).alias("held_out"), "text")
    assert ngram.scored(none, ngram.fit(none)).count() == 0
    items = spark.createDataFrame([(1, "some words of a benchmark item")], "item_id long, text string")
    assert decontaminate.matches(docs, items).count() == 0
    assert decontaminate.drop_leaks(fixture.table(spark), items.where("item_id > 1")).count() == len(fixture.rows())
