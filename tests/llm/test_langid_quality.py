from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from strata.llm import langid, quality
from strata.llm.common import table
from tests.llm.conftest import docs_of

SF = "/root/testdata/sf0.01"


def phrases_by_search(text, train):
    """Greedy longest matches by substring search over the whole text."""
    count = i = 0
    while i < len(text):
        n = 0
        while i + n < len(text) and text[i : i + n + 1] in train:
            n += 1
        i += max(1, n)
        count += 1
    return count


@pytest.mark.parametrize("few, cells", [(1, 1 << 20), (1, 0), (3, 2000), (1000, 2000)])  # all together, partly alone, all alone
def test_phrases_match_substring_search(monkeypatch, few, cells):
    monkeypatch.setattr(langid, "DENSE_CELLS", cells)
    train = {"x": ["the cat sat on the mat and the dog"], "y": ["le chat est sur la table du chien"], "z": ["q"], "none": ["12 ..."]}
    model = langid.Model(train)
    rng = np.random.default_rng(3)
    long = " ".join(rng.choice("the cat sat le chien sur zq 日本".split(), size=3000))
    texts = ["The cat! sat, on the TABLE", "le chien est sur le chat", "zzz 日本語 the", "", "a", "the the the " * 30, long]
    monkeypatch.setattr(langid, "FEW", few)
    got = model.phrases([model.symbols(t) for t in texts])
    for t, row in zip(texts, got, strict=True):
        for lang, n in zip(model.languages, row, strict=True):
            assert n == phrases_by_search(langid.normalise(t), langid.normalise(train[lang][0])), (t[:40], lang)


@pytest.mark.parametrize("columns", [0, 1, 30, 2000])  # all hashed to all dense
def test_transitions_are_those_of_the_automaton(columns):
    rng = np.random.default_rng(5)
    automaton = langid.Automaton((rng.integers(0, 800, size=5000) // rng.integers(1, 9, size=5000)).tolist())
    table = langid.Transitions(automaton, 901, columns)
    symbols = np.arange(901, dtype=np.int32)
    for state in [0, *range(1, len(automaton.next), 40)]:
        moves = table.step(np.full(901, state, dtype=np.int32), symbols)
        assert {int(s): int(m) >> 1 for s, m in zip(symbols, moves, strict=True) if not m & 1} == (automaton.next[state] if state else {})
        assert all(m >> 1 == automaton.next[0].get(int(s), 0) for s, m in zip(symbols, moves, strict=True) if m & 1)
    assert table.walk(0, []) == 0
    assert table._walked == {state * 901 + s: to for state, out in enumerate(automaton.next) if state for s, to in out.items()}


def words_of(rng, letters, n):
    return ["".join(rng.choice(letters, size=rng.integers(1, 4))) for _ in range(n)]


def test_every_letter_is_learned(spark):
    """Two languages of disjoint Han letters, more than 200 each, and English."""
    rng = np.random.default_rng(7)
    han = [chr(0x4E00 + k) for k in range(1200)]
    vocabulary = {"zh": words_of(rng, han[:600], 900), "ja": words_of(rng, han[600:], 900), "en": "the of and to in is that it was for".split()}
    rows = [(k, " ".join(rng.choice(vocabulary[lang], size=40)), lang) for k, lang in enumerate(["zh", "ja", "en"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.lang == r.lang_pred for r in got) and len(got) == 180


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(9)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    vocabulary = {f"l{k:03d}": words_of(rng, letters, 60) for k in range(120)}
    rows = [(k, " ".join(rng.choice(vocabulary[lang], size=60)), lang) for k, lang in enumerate(sorted(vocabulary) * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.languages == sorted(vocabulary)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


def test_long_labelled_texts_are_cut_not_left_out(spark):
    english, german = "the of and to in is that it was for ".split(), "der die und das nicht ist mit von auf dem".split()
    rng = np.random.default_rng(11)
    rows = [(k, " ".join(rng.choice(english, size=150)), "en") for k in range(20)]
    rows += [(100 + k, " ".join(rng.choice(german, size=8000)), "de") for k in range(20)]
    rows += [(200, rows[0][1], "en")] * 300  # copies are one text of the draw
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = langid.training_sample(docs)
    assert {k: len(v) for k, v in sample.items()} == {"en": 21, "de": 20}
    assert {len(t) for t in sample["de"]} == {langid.SAMPLE_ROW_CHARS}
    assert any(not rows[20 + k][1].startswith(t) for k in range(20) for t in sample["de"][:1])
    model = langid.fit(docs)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang").distinct(), "doc_id").collect()
    assert all(r.lang == r.lang_pred for r in got)


def test_a_language_of_one_word_wins_no_other_texts():
    model = langid.Model({"en": ["the cat sat on the mat and the dog ran to the house " * 20], "one": ["the"], "bare": ["..."]})
    names, _ = model.predict(["the dog sat on the house", "the", "and the cat ran"])
    assert names[0] == names[2] == "en"


def test_symbols_follow_normalise():
    model = langid.Model({"x": ["abc def"]})
    for text in ("  Abc--def  ", "1a2b3", "...", "a", " é a"):
        assert len(model.symbols(text)) == len(langid.normalise(text))


def test_languages_of_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    model = langid.fit(docs.filter(~langid.held_out(docs.doc_id)))
    got = langid.identify(docs, model).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert got.filter("lang = lang_pred").count() / got.count() > 0.97


def test_language_edges(spark, edge_docs, no_docs):
    model = langid.Model({"en": ["one two three four five words of text"], "fr": ["un deux trois quatre cinq mots"]})
    got = langid.identify(edge_docs, model).collect()
    assert len(got) == edge_docs.count()
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3, 8}
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.identify(no_docs, model).count() == 0
    kept = langid.drop_unidentified(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() == len(got) - 4
    nothing = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.identify(edge_docs, nothing).collect()} == {"und"}


def test_training_sample_is_bounded(spark):
    docs = docs_of(spark, [f"text {k}" for k in range(500)])
    assert len(langid.training_sample(docs, rows=20)["en"]) == 20


def test_quality_of_held_out_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = quality.score_documents(docs, quality.fit(docs, labels)).filter("held_out").join(labels, "doc_id").toPandas()
    good, bad = got[got.quality == 1].score.to_numpy(), got[got.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert (got.predicted == got.quality).mean() > 0.93


def test_prior_and_risk_on_two_gaussians():
    rng = np.random.default_rng(0)
    positive = rng.normal(2, 1, size=(3000, 2))
    mixed = np.concatenate([rng.normal(2, 1, size=(1800, 2)), rng.normal(-2, 1, size=(1200, 2))])
    model = quality.train(positive, mixed)
    assert abs(model.prior - 0.6) < 0.1
    assert (model.score(rng.normal(2, 1, size=(500, 2))) > 0.5).mean() > 0.95
    assert (model.score(rng.normal(-2, 1, size=(500, 2))) < 0.5).mean() > 0.95


def test_one_good_id_of_many_rows_is_one_positive(spark, monkeypatch):
    docs = spark.createDataFrame([(5, f"good text {k}") for k in range(400)] + [(7, "other words"), (9, "more")], "doc_id long, text string")
    labels = spark.createDataFrame([(5, 1), (7, 1)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda p, u: seen.append((len(p), len(u))))
    quality.fit(docs, labels)
    learnt = [k for k in (5, 7) if zlib.crc32(str(k).encode()) % 5]
    assert seen[0][0] == len(learnt) and seen[0][1] >= 400 * (5 in learnt)


def test_descent_follows_the_plain_non_negative_risk(monkeypatch):
    """Against sums row by row, slopes by small differences and plain moments."""
    rng = np.random.default_rng(1)
    positive, mixed, prior = rng.normal(1, 1, size=(12, 2)), rng.normal(-0.5, 2, size=(20, 2)), 0.7
    monkeypatch.setattr(quality, "STEPS", 60)

    def chance(row, w):
        return 1 / (1 + math.exp(-(row[0] * w[0] + row[1] * w[1] + w[2])))

    def gain(w):
        return prior * sum(-math.log(chance(r, w)) for r in positive) / len(positive)

    def loss(w):
        as_bad = sum(-math.log(1 - chance(r, w)) for r in mixed) / len(mixed)
        return as_bad - prior * sum(-math.log(1 - chance(r, w)) for r in positive) / len(positive)

    w, first, second, clipped = [0.0] * 3, [0.0] * 3, [0.0] * 3, 0
    for step in range(1, 61):
        clipped += loss(w) < 0
        target = (lambda v: gain(v) + loss(v)) if loss(w) >= 0 else (lambda v: -loss(v))
        new = []
        for i in range(3):
            up, down = list(w), list(w)
            up[i], down[i] = w[i] + 1e-6, w[i] - 1e-6
            slope = (target(up) - target(down)) / 2e-6 + (quality.RIDGE * w[i] if i < 2 else 0)
            first[i], second[i] = 0.9 * first[i] + 0.1 * slope, 0.999 * second[i] + 0.001 * slope**2
            new.append(w[i] - quality.RATE * (first[i] / (1 - 0.9**step)) / (math.sqrt(second[i] / (1 - 0.999**step)) + 1e-8))
        w = new
    np.testing.assert_allclose(quality._descend(positive, mixed, prior), w, atol=1e-4)
    assert clipped  # the bound at zero was met


def test_quality_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(5, 1, 0), (7, 1, 0), (None, 1, None), (4, None, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(edge_docs, labels)
    got = quality.score_documents(edge_docs, model).collect()
    assert len(got) == edge_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    empty = quality.fit(no_docs, labels.limit(0))
    assert {r.score for r in quality.score_documents(edge_docs, empty).collect()} == {0.5}
    assert quality.score_documents(no_docs, model).count() == 0
