"""Spelling variants against plain comparisons of all words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventlake.llm import spelling


def differ_by_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, factor=5):
    """word -> (n, n_near, form, form_n, root)."""
    near = {w: [v for v in counts if differ_by_one(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= factor * counts[word] else None
    found = {}
    for word in counts:
        root = word
        while form[root] is not None:
            root = form[root]
        at = form[word]
        found[word] = (counts[word], len(near[word]), at, counts.get(at), root)
    return found


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def table(report):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in report.collect()}


@pytest.mark.parametrize("longest", [64, 6])
def test_variants_of_random_words(spark, monkeypatch, longest):
    monkeypatch.setattr(spelling, "LONGEST", longest)
    draw = random.Random(longest)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(1, 9))) for _ in range(700)}
    counts = {word: draw.choice([1, 5, 25, 25, 130, 700, 4000]) for word in words}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert table(spelling.variants(rows)) == plain(counts)


def test_ties_go_by_code_points(spark):
    counts = {"aaaaaa": 1, "aaaaab": 50, "aaaaaé": 50, "éaaaaa": 50, "aaaaa": 50, "aaaaaaa": 50}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = table(spelling.variants(rows))
    assert got == plain(counts)
    assert got["aaaaaa"][1:3] == (5, "aaaaa")


@pytest.mark.parametrize("size", [62, 63, 64, 65, 66, 300])
def test_long_words(spark, size):
    """Around the size at which rotations are sorted by fingerprint."""
    base = "abcde" * size
    counts = {base[:size]: 900}
    for change in ("x", "", "xy"):
        for at in (0, 1, size // 2, size - 1):
            counts[base[:at] + change + base[at + 1 : size]] = 6 + at + len(change)
    counts[base[: size + 1]] = 100
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert table(spelling.variants(rows)) == plain(counts)


def test_rotations_of_a_very_long_word_take_little_memory():
    import tracemalloc

    word = "abc" * 100_000
    tracemalloc.start()
    n = sum(1 for _ in spelling.rotations(word))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2 * len(word) + 1 and peak < 10 * len(word)


def test_small_batches(spark, monkeypatch):
    """Groups that go on in the next Arrow batch, and counts that are handed on early."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    monkeypatch.setattr(spelling, "BATCH", 4)
    try:
        counts = {f"{a}bcde{b}": 6 for a in "abcdefgh" for b in "xyzuvw"}
        rows = spark.createDataFrame(list(counts.items()), "word string, n long")
        assert table(spelling.variants(rows)) == plain(counts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_report_of_documents(documents, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 50)
    draw = random.Random(3)
    vocabulary = ["étranger", "Étranger", "ÉTRANGER", "colour", "color", "colours", "Behaviour",
                  "behavior", "naïveté", "tiny", "abcdef", "abcdex", "separate", "seperate", "x×y÷zabc"]
    weights = [90, 3, 1, 400, 40, 60, 300, 20, 5, 100, 30, 5, 800, 30, 7]
    rows = [
        (i, " ".join(draw.choices(vocabulary, weights, k=draw.randint(0, 60)))) for i in range(600)
    ]
    rows += [(None, "separate colour behaviour " * 3), (1, None), (2, ""), (3, " \n1 2-3"),
             (5, "colour,separate_seperate;" * 3000), (5, "colour,separate_seperate;" * 3000),
             (6, "q" * 70_000)]
    losing = next(i for i in range(10**4, 10**5) if zlib.crc32(b"%d:separate" % i) % 199 == 0)
    rows.append((losing, "Separate " * 9))
    counts = plain_counts(rows)
    assert any(len(word) == 7 and n == 9 for word, n in counts.items())
    docs = documents(rows).withColumn("word", F.lit(1)).withColumn("n", F.lit(1))
    assert table(spelling.spelling_report(docs.repartition(4))) == plain(counts)


def test_long_texts_are_counted_alike():
    settings = spelling.Settings(misspell=199)
    text = "Colour étrange word separate " * 40_000
    assert dict(spelling.counted("7", text, settings)) == {
        w: n * 40_000 for w, n in spelling.counted("7", "Colour étrange word separate", settings)
    }


def test_empty_table(documents):
    report = spelling.spelling_report(documents([]))
    assert report.collect() == []
    assert report.dtypes == [
        ("word", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form", "string"),
        ("form_n", "bigint"), ("root", "string"),
    ]
