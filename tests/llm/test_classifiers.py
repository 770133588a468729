"""Quality and language against held-out labels, and what they do with odd rows."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlake.llm import langid, quality
from eventlake.llm.queries import QUERIES


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


LABELS = "doc_id long, quality int, toxic int"


def test_quality_query(spark, tables):
    labels = {
        r.doc_id: r.quality for r in spark.read.parquet(f"{tables}/labels.parquet").collect()
    }
    got = QUERIES["op1_quality"](spark, tables).collect()
    assert len(got) == spark.read.parquet(f"{tables}/documents.parquet").count()
    assert all(r.held_out == is_held_out(r.doc_id) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    scores = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    good = [score for score, label in scores if label]
    bad = [score for score, label in scores if not label]
    above = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert above > 0.9
    assert np.mean([score >= 0.3 for score in good]) > 0.95


def test_quality_learns_from_positives_and_the_rest_only(spark, documents):
    rows = [(i, f"A fine text number {i} about things.") for i in range(300)]
    rows += [(1000 + i, f"BUY!! {i} NOW!! BUY!! {i} NOW!!") for i in range(100)]
    docs = documents(rows)
    good = spark.createDataFrame([(i, 1, 0) for i in range(200)], LABELS)
    with_bad = good.union(spark.createDataFrame([(1000 + i, 0, 1) for i in range(100)], LABELS))
    one = quality.train(docs, good)
    other = quality.train(docs, with_bad)
    assert np.array_equal(one.weight, other.weight) and one.prior == other.prior
    assert 0.6 < one.prior < 0.9
    got = {r.doc_id: r.score for r in quality.grade(docs, one).collect()}
    assert min(got[i] for i in range(300)) > max(got[1000 + i] for i in range(100))
    held = [i for i in range(200) if is_held_out(i)]
    changed = good.where(~F.col("doc_id").isin(held))
    assert np.array_equal(quality.train(docs, changed).weight, one.weight)


def test_quality_of_odd_rows(spark, documents, odd_texts):
    rows = [*enumerate(odd_texts), (None, "a b"), (1, None), (1, None)]
    docs = documents(rows).withColumn("Score", F.lit("x")).withColumn("predicted", F.lit("y"))
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(0, 300)] + [(5, 1, 0), (None, 1, 0), (7, None, 0)], LABELS
    )
    model = quality.train(docs, labels)
    out = quality.grade(docs, model).collect()
    assert len(out) == len(rows)
    assert all(r.score is not None and 0 <= r.score <= 1 for r in out)
    by_text = {}
    for row in out:
        assert by_text.setdefault(row.text or "", row.score) == pytest.approx(row.score)
    nothing = docs.where("doc_id = -1")
    assert quality.grade(nothing, model).collect() == []
    assert quality.train(docs, labels.where("quality = 0")) is None
    assert quality.train(nothing, labels) is None
    assert {r.score for r in quality.grade(docs, None).collect()} == {0.5}


def test_features_do_not_depend_on_the_batch():
    texts = ["One two.", "", "A A A A", "é" * 500, "x"]
    alone = np.vstack([quality.features(pa.array([text]), 8) for text in texts])
    assert np.array_equal(quality.features(pa.array(texts), 8), alone)
    longer = pa.array(["zzz", *texts]).slice(1)
    assert np.array_equal(quality.features(longer, 8), alone)


def long_texts():
    import random

    draw = random.Random(8)
    words = ["Wort", "wort", "été", "naïve", "a", "b2", "x.y", "日本語", "--", "İstanbul", "W" * 30]
    return ["".join(draw.choice(words) + draw.choice(" \n\t ") * draw.randint(0, 2) for _ in range(4000)),
            "same " * 3000, "é" * 9000, " " * 5000 + "z", "\n".join("ab" * 50 for _ in range(200))]


@pytest.mark.parametrize("block", [64, 1000])
def test_long_texts_have_the_same_features_in_blocks(monkeypatch, block):
    for text in long_texts():
        one = pa.array([text])
        whole = quality.features(one, 8)
        monkeypatch.setattr(quality, "BLOCK", block)
        assert np.array_equal(quality.features(one, 8), whole), text[:20]
        monkeypatch.undo()


def plain_risk(prior, x, z):
    """Non-negative risk of outputs for positives and unlabelled rows, by its definition."""
    loss = lambda out, label: np.log1p(np.exp(-label * out)).mean()
    return prior * loss(x, 1) + max(0.0, loss(z, -1) - prior * loss(x, -1))


def test_slope_is_the_gradient_of_the_plain_risk():
    draw = np.random.default_rng(2)
    for prior, shift in ((0.3, 0.0), (0.5, 1.0), (0.2, -1.0)):
        x, z = draw.normal(shift, 1, 7), draw.normal(0.5, 1, 9)
        rest = np.logaddexp(0, z).mean() - prior * np.logaddexp(0, x).mean()
        assert rest > 0
        on_x, on_z = quality.non_negative(prior, 0.0)(x, z)
        for values, found in ((x, on_x), (z, on_z)):
            for place in range(len(values)):
                before = values[place]
                values[place] = before + 1e-6
                up = plain_risk(prior, x, z)
                values[place] = before - 1e-6
                down = plain_risk(prior, x, z)
                values[place] = before
                assert found[place] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_prior_of_a_known_mixture():
    draw = np.random.default_rng(0)
    positive = draw.normal(2, 1, (2000, 3))
    mixed = np.vstack([draw.normal(2, 1, (1400, 3)), draw.normal(-2, 1, (600, 3))])
    mixed = mixed[draw.permutation(len(mixed))]
    prior = quality.estimate_prior(quality.Settings(), positive, mixed)
    assert abs(prior - 0.7) < 0.08


def test_non_negative_risk_climbs_when_below_zero():
    slope = quality.non_negative(0.9, slack=0.0)
    on_x, on_z = slope(np.array([5.0, 5.0]), np.array([-5.0, -5.0]))
    assert (on_x > 0).all() and (on_z < 0).all()
    on_x, on_z = slope(np.array([-5.0, -5.0]), np.array([5.0, 5.0]))
    assert (on_x < 0).all() and (on_z > 0).all()


def test_language_query(spark, tables):
    lang = {
        r.doc_id: r.lang for r in spark.read.parquet(f"{tables}/documents.parquet").collect()
    }
    got = QUERIES["op9_language"](spark, tables).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == is_held_out(r.doc_id) for r in got)
    assert {r.lang_pred for r in got} <= set(lang.values())
    right = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert np.mean(right) > 0.97
    assert np.mean([r.accepted for r in got]) > 0.98


SAMPLES = {
    "en": "the cat and the dog were with another thing there",
    "de": "der Hund und die Katze waren nicht mit einem Ding",
    "fr": "le chien et la chatte étaient avec une autre chose",
}


def spoken(count):
    draw = np.random.default_rng(1)
    return [
        (i, " ".join(draw.permutation(SAMPLES[name].split())), name, "s", 1)
        for i, name in enumerate(draw.choice(list(SAMPLES), count))
    ]


def fitted(rows):
    settings = langid.Settings()
    return langid.fit([(langid.packed(text, settings), name) for text, name in rows])


def test_language_of_odd_rows(documents, odd_texts):
    rows = spoken(200)
    rows += [(1000 + i, text, None, None, None) for i, text in enumerate(odd_texts)]
    rows += [(None, "the cat", "xx", "s", 1), (1, None, "en", "s", 1), (1, "42 !", "fr", "s", 1)]
    rows.append((9000, SAMPLES["en"] * 5000, "en", "s", 1))
    docs = documents(rows).withColumn("Accepted", F.lit("x")).withColumn("_found2", F.lit(1))
    model = langid.train(docs)
    assert model.languages == ["de", "en", "fr"]
    out = langid.identify(docs, model).collect()
    assert len(out) == len(rows)
    for row in out:
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == (not letters)
        assert 0 <= row.score <= 1 and (row.score == 0) == (not letters)
        if not letters:
            assert row.accepted is False
    right = [r.lang_pred == r.lang for r in out if r.doc_id in range(200) and r.text in SAMPLES]
    assert all(right)
    nothing = docs.where("doc_id = -1")
    assert langid.train(nothing) is None
    assert langid.identify(nothing, model).collect() == []
    assert Counter(r.lang_pred for r in langid.identify(docs, None).collect()) == {"und": len(rows)}


def test_every_label_is_learned(documents):
    texts = {"de": "der Hund und die Katze", "en": "the dog and the cat",
             "fr": "le chien et le chat", "es": "el perro y el gato"}
    rows = [
        (i, f"{text} {i}", language, "src", 30)
        for i in range(60)
        for language, text in texts.items()
    ] + [(70, "um cachorro", "pt", "src", 11)]
    settings = langid.Settings(per_language=40, languages=2, least=5)
    docs = documents(rows)
    assert len(langid.sample(docs, settings, "text", "lang", "doc_id")) < 120
    assert langid.train(docs, settings).languages == ["de", "en", "es", "fr", "pt"]


def test_language_scores_do_not_depend_on_the_batch():
    model = fitted([(text, name) for _, text, name, _, _ in spoken(200)])
    texts = [*SAMPLES.values(), "", "a", "der", "é", "x" * 3000]
    names, scores = langid.predict(pa.array(texts), model)
    for place, text in enumerate(texts):
        name, score = langid.predict(pa.array([text]), model)
        assert name == [names[place]] and score[0] == pytest.approx(scores[place])
    assert names[:3] == list(SAMPLES)


def test_long_texts_have_the_same_language_in_blocks(monkeypatch):
    model = fitted([(text, name) for _, text, name, _, _ in spoken(60)])
    for text in [*long_texts(), "der Hund und die Katze " * 2000]:
        buckets, shares = langid.bag(text, model.settings)
        found = [b[: n[0]] for b, _, n in langid.grams(pa.array([text]), model.settings)]
        want, counts = np.unique(np.concatenate(found), return_counts=True)
        assert np.array_equal(buckets, want)
        assert np.allclose(shares, counts / counts.sum(), rtol=1e-6)
        monkeypatch.setattr(langid, "BLOCK", 777)
        assert np.array_equal(langid.bag(text, model.settings)[1], shares)
        monkeypatch.undo()
        name, score = langid.predict(pa.array([text + " "]), model)
        monkeypatch.setattr(langid, "bucket_counts", None)
        monkeypatch.setattr(langid.pc, "binary_length", lambda column: pa.array([0] * len(column)))
        try:
            plain_name, plain_score = langid.predict(pa.array([text + " "]), model)
        finally:
            monkeypatch.undo()
        assert name == plain_name and np.allclose(score, plain_score, atol=1e-9)


def test_memory_of_long_texts_and_many_labels():
    import tracemalloc

    draw = np.random.default_rng(1)
    settings = langid.Settings()
    labels = [f"l{i:03}" for i in range(1000)]
    scores = draw.normal(size=(1 << settings.bits, len(labels)))
    model = langid.Model(labels, scores, np.zeros(len(labels)), 1.0, 0.0, settings)
    texts = pa.array(["ein kurzer Text " * 30] * 300 + ["ein langer Text " * 1_500_000])
    tracemalloc.start()
    langid.predict(texts, model)
    quality.features(texts.slice(300), 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6


def test_one_language_and_one_row():
    model = fitted([("hello there", "en")])
    assert langid.predict(pa.array(["something", None]), model)[0] == ["en", "und"]


def test_rejection_is_calibrated():
    """Text of no language scores lower than text of one; the threshold keeps right predictions."""
    model = fitted([(text, name) for _, text, name, _, _ in spoken(600)])
    _, scores = langid.predict(pa.array([text for _, text, _, _, _ in spoken(300)]), model)
    assert (scores >= model.threshold).mean() > 0.99
    assert 0 < model.threshold <= 0.5 and model.temperature >= 1
