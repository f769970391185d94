"""Operators that learn: held-out accuracy and defined results for awkward rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimworks.llm import language, toxicity
from claimworks.llm.queries import ORACLES, QUERIES
from claimworks.session import scratch_dir

from . import fixture

SYLLABLES = {"en": "the and ing er on", "de": "der sch ung ich en", "fr": "le eau que tion ai", "es": "el cion os que ado", "xx": "zz qo yy"}


def written(rng, lang, n, insults=()):
    parts = SYLLABLES[lang].split()
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    for w in insults:
        made.insert(rng.randrange(len(made) + 1), w)
    return " ".join(made)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        lang, toxic = rng.choice(list(SYLLABLES)), rng.random() < 0.15
        insults = [rng.choice(["idiot", "moron", "scum", "trash"]) for _ in range(4)] if toxic else []
        rows.append((i, written(rng, lang, rng.randrange(20, 80), insults), lang if rng.random() < 0.9 else None))
        if rng.random() < 0.6:
            labels.append((i, int(toxic)))
    labels += [(None, 1), (5, None), (7, 0), (7, 1)]
    truth = {i: any(w in t.split() for w in ("idiot", "moron", "scum", "trash")) for i, t, _ in rows}
    rows += [(i, t, "en") for i, t in fixture.ODD]
    docs = spark.createDataFrame([(*r, "junk", "junk", "junk") for r in rows],
                                 "doc_id long, text string, lang string, score string, got string, held_out string").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), rows, truth


def test_language(corpus):
    docs, _, rows, _ = corpus
    found = language.identify(docs).drop("row").collect()
    assert len(found) == len(rows)
    lang = {i: code for i, _, code in rows}
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 900 and lang[r.doc_id]]
    assert len(held) > 150 and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    for r in found:
        assert 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1)
        if r.doc_id in (9001, 9002, 9003, 9005):
            assert (r.lang_pred, r.score) == (language.UNKNOWN, 0.0)
        elif r.doc_id != 9007:
            assert r.lang_pred in SYLLABLES
    again = language.identify(docs.repartition(7)).drop("row").collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_language_learns_only_from_its_folds(spark, corpus):
    docs, *_ = corpus
    held = docs.where("crc32(coalesce(CAST(doc_id AS STRING), '')) % 3 = 1")
    assert {r.lang_pred for r in language.identify(held).collect()} == {language.UNKNOWN}
    kept = language.keep_known(docs)
    assert kept.columns == docs.columns and {9001, 9002, 9003, 9005}.isdisjoint(r.doc_id for r in kept.collect())


def test_languages_of_few_texts_and_very_many_languages(spark, monkeypatch):
    """A language that is thousands of copies of two texts is learned; vectors stay bounded, rare languages are left out."""
    rng = random.Random(8)
    rows = [(written(rng, "en", 40), "en") for _ in range(300)] + [(written(rng, "de", 40), "de") for _ in range(2)] * 1500
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert set(model.languages) == {"en", "de"} if hasattr(model, "languages") else model.predict(written(rng, "de", 40))[0] == "de"
    sizes = []
    monkeypatch.setattr(language, "Model", lambda x, codes: sizes.append((len(x), len(set(codes)))))
    monkeypatch.setattr(language, "VECTORS", 600)
    monkeypatch.setattr(language, "LANGUAGES", 50)
    many = [(written(rng, "fr", 40), f"x{k % 80}") for k in range(4000)]
    language.fit(spark.createDataFrame(many, "text string, lang string"))
    (vectors, codes), = sizes
    assert 30 < codes <= 50 and vectors <= 1200


def test_families_come_first():
    rng = random.Random(1)
    texts = [(code, written(rng, code, 60)) for code in ("en", "de", "fr", "es") for _ in range(40)]
    model = language.Model(np.array([language.features(t.encode()) for _, t in texts]), [c for c, _ in texts])
    assert [name for name, _ in model.groups] == ["germanic", "romance"] and set(model.pairs) == {("de", "en"), ("es", "fr")}
    assert model.predict(written(rng, "es", 30))[0] == "es"
    assert language.Model(np.zeros((0, language.SLOTS), np.float32), []).predict("text") == (language.UNKNOWN, 0.0)
    one = language.Model(np.array([language.features(b"some text")]), ["en"])
    assert one.predict("any") == ("en", 1.0)


def test_toxicity(corpus):
    docs, labels, rows, truth = corpus
    found = toxicity.classify(docs.select("doc_id", "text"), labels).collect()
    assert len(found) == len(rows)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    toxic, clean = ([r for r in held if truth[r.doc_id] is flag] for flag in (True, False))
    assert np.mean([r.predicted for r in toxic]) > 0.9 and np.mean([r.predicted for r in clean]) < 0.05
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
    again = toxicity.classify(docs.select("doc_id", "text").repartition(7), labels).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_toxicity_without_labels(spark, corpus):
    docs, labels, *_ = corpus
    scores = {r.score for r in toxicity.classify(docs.select("doc_id", "text"), labels.where("toxic > 1")).collect()}
    assert len(scores) == 1 and scores.pop() == pytest.approx(toxicity.DEFAULT_PRIOR)


def test_risk_estimate_stays_non_negative():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(50, 5, False)) for _ in range(3000)]
    rows = [np.unique(np.append(r, 50)) if i < 600 else r for i, r in enumerate(rows)]
    positive = np.arange(3000) < 400  # 200 more positives hide among the unlabelled
    weights, bias = toxicity.nnpu(rows, positive, 51, prior=200 / 2600)
    scores = np.array([weights[r].sum() for r in rows]) + bias
    assert (scores[400:600] > 0).mean() > 0.95 and (scores[600:] > 0).mean() < 0.05


def test_empty_tables(spark):
    docs = fixture.empty(spark)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert language.identify(docs).count() == language.keep_known(docs).count() == 0
    assert toxicity.classify(docs.select("doc_id", "text"), labels).count() == 0


def test_pipeline(spark, tmp_path):
    rng = random.Random(6)
    item = "what is the sum of all even numbers between the first and the last page of a book"
    rows = [(i, written(rng, rng.choice(["en", "fr", "es"]), 60), ("en", "fr")[i % 2], f"s{i % 3}", 0) for i in range(120)]
    rows += [(200 + i, rows[i][1], "en", "s0", 0) for i in range(10)]  # copies
    rows += [(300, rows[50][1] + ". " + item, "en", "s1", 0), (301, "123 456", "en", "s1", 0), (302, None, None, None, 0),
             (303, rows[60][1][::-1] + " mail me@host.org", "en", "s2", 0)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        path = scratch_dir(spark, "test")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "leaks", "personal_data", "mixture"]
    assert {301, 302}.isdisjoint(seen["language"]) and set(range(120)) <= set(seen["language"])
    assert not any(200 + i in seen["near_copies"] for i in range(10)) and set(range(120)) <= set(seen["near_copies"])
    assert 300 not in seen["leaks"] and set(range(120)) <= set(seen["leaks"])
    assert seen["personal_data"][303].endswith("[EMAIL]") and seen["personal_data"].keys() == seen["leaks"].keys()
    assert {r.doc_id for r in docs.where("taken > 0").collect()} == set(seen["mixture"])
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == set(seen["mixture"])


def test_stages_keep_clashing_columns(spark, tmp_path):
    docs = fixture.table(spark, [(800, "write me@host.org")]).withColumns({c: F.lit(f"own {c}") for c in (
        "_before", "pii_spans", "target", "taken", "source_size", "_leak", "m")})
    done = corpus_pipeline.personal_data(spark, docs, "")
    assert done.columns == docs.columns and done.count() == docs.count()
    one = done.where("doc_id = 800").first()
    assert one.text == "write [EMAIL]" and one.pii_spans == "own pii_spans" and one._before == "own _before"
    mixed = corpus_pipeline.mixture(spark, docs, "")
    assert set(mixed.columns) == set(docs.columns) and dict(mixed.dtypes)["taken"] == "bigint"
    assert mixed.first().m == "own m" and mixed.where("size = 0").count() == 0


def test_registration():
    import __spark_entry__ as entry

    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in QUERIES) == 1 for n in names)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
