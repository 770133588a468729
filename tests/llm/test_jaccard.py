"""Groups of near duplicates against all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import jaccard
from eventlake.llm.components import connected_components
from eventlake.llm.jaccard import Settings, similar_groups
from eventlake.llm.queries import QUERIES
from tests.llm.conftest import words


def brute(rows, size, percent):
    """n_shingles and the smallest reachable id of every row, rows of one id together."""
    sets = []
    for _, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = words(lower)
        grams = {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}
        sets.append(grams or ({tuple(found)} if found else set()))
    holders = defaultdict(list)
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for place, grams in enumerate(sets):
        common = defaultdict(int)
        for gram in grams:
            for other in holders[gram]:
                common[other] += 1
            holders[gram].append(place)
        for other, count in common.items():
            if 100 * count >= percent * (len(grams) + len(sets[other]) - count):
                a, b = root(rows[place][0]), root(rows[other][0])
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(s), root(i)) for (i, _), s in zip(rows, sets, strict=True))


def grouped(docs, settings):
    return sorted(map(tuple, similar_groups(docs, settings).collect()))


def edited(draw, text, edits):
    found = text.split(" ")
    for _ in range(edits):
        found[draw.randrange(len(found))] = f"new{draw.randrange(10**6)}"
    return " ".join(found)


@pytest.fixture(scope="module")
def families():
    """Families of edited copies of all lengths, on either side of the similarity, and passages."""
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = " ".join(draw.choices(vocabulary, k=60))
    texts = []
    for _ in range(40):
        text = " ".join(draw.choices(vocabulary, k=draw.choice([3, 5, 12, 40, 150, 400])))
        copies = [edited(draw, text, draw.randrange(0, 6)) for _ in range(draw.randrange(1, 8))]
        texts += [text, text.upper(), text + " tail", *copies]
    texts += [passage + " " + " ".join(draw.choices(vocabulary, k=30)) for _ in range(60)]
    return list(enumerate(draw.sample(texts, len(texts))))


@pytest.mark.parametrize(
    "settings",
    [
        Settings(),
        Settings(words=4, percent=85),
        Settings(words=1, percent=50),
        Settings(words=4, percent=85, frequent=2, ordered=20),
        Settings(words=4, percent=85, more=0),
        Settings(words=4, percent=85, more=15, shard_sets=3),
        Settings(words=3, percent=60, shard_sets=2),
        Settings(words=4, percent=100),
    ],
)
def test_families(documents, families, settings):
    got = grouped(documents(families), settings)
    assert got == brute(families, settings.words, settings.percent)


def test_one_large_group_over_many_shards(documents):
    draw = random.Random(4)
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(i, edited(draw, text, 2)) for i in range(300)] + [(900, text), (901, text)]
    settings = Settings(words=4, percent=70, shard_sets=20, askers=7)
    assert grouped(documents(rows), settings) == brute(rows, 4, 70)


def test_white_space_case_and_missing_texts(documents):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "\x0bone\x0c two\r"),
        (6, "ONE TWO three"), (7, "é É"), (8, "É É"), (9, "a\xa0b"), (10, "a b"), (11, "a\x85b"),
    ]
    assert grouped(documents(rows), Settings()) == brute(rows, 5, 80)


def test_rows_of_one_id_and_none(documents):
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (5, "x y z"), (2, "x y z"),
            (None, "x y z"), (None, "q r s"), (9, "a b c d e f g")]
    docs = documents(rows).withColumn("size", F.lit("x")).withColumn("set", F.lit(1))
    got = sorted(map(tuple, similar_groups(docs).collect()), key=str)
    assert got == sorted(
        [(5, 3, 2), (5, 3, 2), (5, 1, 2), (2, 1, 2), (None, 1, 2), (None, 1, None), (9, 3, 2)],
        key=str,
    )
    assert similar_groups(docs.where("doc_id = 77")).collect() == []


def test_rows_without_id_link_like_others(documents):
    """A row without an id is a near copy of two documents that are none of each other."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words[:50])), (None, " ".join(words[:55])), (3, " ".join(words)),
            (None, " ".join(f"n{i}" for i in range(40))), (None, " ".join(f"n{i}" for i in range(41))),
            (None, "alone by itself"), (None, None), (4, "q " + " ".join(words[20:]))]
    # Stand-ins for the rows without an id, larger than all ids.
    named = [(1000 + place if doc_id is None else doc_id, text) for place, (doc_id, text) in enumerate(rows)]
    want = Counter()
    for (doc_id, _), (_, size, component) in zip(
        sorted(rows, key=lambda r: named[rows.index(r)]), sorted(brute(named, 5, 85)), strict=True
    ):
        want[doc_id, size, component if component < 1000 else None] += 1
    found = similar_groups(documents(rows), Settings(percent=85)).collect()
    assert Counter(map(tuple, found)) == want
    assert want[3, 56, 1] == 1


def test_different_texts_of_one_id(documents):
    short = " ".join(f"s{i}" for i in range(24))
    long = " ".join(f"l{i}" for i in range(1004))
    # What the long text shares with another is far from what links need.
    other = " ".join(f"l{i}" for i in range(40)) + " " + " ".join(f"o{i}" for i in range(1000))
    rows = [(5, long), (5, short), (9, short + " tail"), (7, other)]
    assert grouped(documents(rows), Settings()) == brute(rows, 5, 80)


def test_long_texts(documents):
    text = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, text), (2, text + " end"), (3, "start " + text[: len(text) // 2]), (4, "a " * 50_000)]
    assert grouped(documents(rows), Settings()) == brute(rows, 5, 80)


def test_merge_skip_counts():
    draw = random.Random(2)
    for need in (1, 2, 3, 6):
        lists = [sorted(draw.sample(range(40), draw.randrange(1, 25))) for _ in range(8)]
        counts = defaultdict(int)
        for numbers in lists:
            for number in numbers:
                counts[number] += 1
        want = [(n, c) for n, c in sorted(counts.items()) if c >= need]
        assert list(jaccard.merge_skip(lists, need)) == want


def test_prefixes_take_frequent_grams_last():
    sets = [np.arange(20, dtype=np.int64), np.arange(5, 45, dtype=np.int64)]
    order, often = np.array([0, 1, 6]), np.array([9, 5, 7])
    found, owner = jaccard.prefixes(sets, order, often, Settings(percent=50, more=0))
    assert sorted(found["token"][owner == 0].tolist()) == [2, 3, 4, 5, *range(7, 14)]
    assert sorted(found["token"][owner == 1].tolist()) == [5, *range(7, 27)]


def test_components(spark):
    draw = random.Random(6)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted((i, root(i)) for i in parent)
    empty = connected_components(spark.createDataFrame([], "a long, b long"))
    assert empty.collect() == []


def test_query(spark, tables):
    rows = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op5_jaccard"](spark, tables).collect()))
    assert got == brute(list(map(tuple, rows)), 4, 85)
