"""Targets against repeated resharing, and the queue against one list in one place."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventlake.llm import mixing
from eventlake.llm.mixing import Settings
from eventlake.llm.queries import QUERIES
from tests.llm.conftest import words


def targets(sizes, settings=Settings()):
    """Share the budget by weight; cap what is above its limit and share again."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: settings.weights[i % len(settings.weights)] for i, n in enumerate(names)}
    fixed, budget = {}, sum(sizes.values()) * settings.share
    while free := [n for n in names if n not in fixed]:
        left = budget - sum(fixed.values())
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if share[n] > settings.repeats * sizes[n]]
        if not over:
            return fixed | share
        fixed |= {n: settings.repeats * sizes[n] for n in over}
    return fixed


def check(rows, got, settings=Settings()):
    """`rows` are (doc_id, source, size), all different; `got` the mixed rows."""
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    want = targets(sizes, settings)
    assert Counter((r.doc_id, r.source) for r in got) == Counter((i, s) for i, s, _ in rows)
    taken, largest = Counter(), Counter()
    for row in got:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(want[row.source])
        assert row.taken == (row.size or 0) * row.copies and 0 <= row.copies <= settings.repeats
        taken[row.source] += row.taken
        largest[row.source] = max(largest[row.source], row.size or 0)
    top = max(largest.values(), default=0)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 2 * largest[source] + top
    total = sum(sizes.values()) * settings.share
    assert total - 2 * sum(largest.values()) - top <= sum(taken.values()) <= total + 1e-6


@pytest.mark.parametrize(
    "settings", [Settings(), Settings(weights=(5,), share=0.4), Settings(repeats=1, share=0.9)]
)
@pytest.mark.parametrize("chunk_rows", [4, 20_000])
def test_mix(spark, settings, chunk_rows):
    settings = Settings(settings.weights, settings.share, settings.repeats, chunk_rows)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", 1 + i * 37 % 50) for i in range(400)]
    rows += [(1000 + i, None, i) for i in range(30)] + [(2000, "é", 10), (2001, "Z", 12)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(5)
    got = mixing.mix(docs, settings).collect()
    check(rows, got, settings)
    again = mixing.mix(docs.repartition(3), settings).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_queue_is_cut_where_the_budget_ends(spark):
    """Replays the queue from its keys in plain Python."""
    settings = Settings(chunk_rows=5)
    rows = [(i, f"s{i % 4}", 1 + i * 7 % 30) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    key = F.xxhash64(F.lit(settings.seed), "doc_id", "source", "size")
    keyed = docs.withColumn("key", key).withColumn(
        "order", mixing.uniform(F.lit(settings.seed), F.col("key"))
    )
    sizes, queue = Counter(), []
    for row in sorted(keyed.collect(), key=lambda r: r.order):
        sizes[row.source] += row.size
        queue.append((row, sizes[row.source]))
    want = targets(sizes, settings)
    entries = sorted(
        (
            (turn * sizes[row.source] + through - row.size / 2) / want[row.source],
            row.key, row.doc_id, row.size,
        )
        for row, through in queue
        for turn in range(settings.repeats)
    )
    copies, used = Counter(), 0
    for _, _, doc_id, size in entries:
        used += size
        if used > sum(sizes.values()):
            break
        copies[doc_id] += 1
    got = {r.doc_id: r.copies for r in mixing.mix(docs, settings).collect()}
    assert got == {i: copies[i] for i, _, _ in rows}


def test_words_are_counted_as_named(documents):
    texts = [None, "", " ", "a", " a\tb\x0bc\x0cd\re\n", "a\xa0b\x85c\x1cd e", "é " * 50_000]
    docs = documents(list(enumerate(texts)))
    got = {r[0]: r[1] for r in docs.select("doc_id", mixing.word_count("text")).collect()}
    assert got == {i: len(words(text or "")) for i, text in enumerate(texts)}


def test_missing_and_repeated_rows(spark):
    rows = [(1, "a", 5)] * 4 + [(None, None, 3), (2, "b", None), (3, "b", 0), (4, "c", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    docs = docs.withColumn("Target", F.lit("x")).withColumn("_key2", F.lit(1))
    got = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter(rows)
    assert all(r.taken == 0 for r in got if not r["size"])
    assert mixing.mix(docs.where("doc_id = 77")).collect() == []
    nothing = mixing.mix(docs.where("size = 0")).collect()
    assert [(r.taken, r.target) for r in nothing] == [(0, 0.0)] * 2


def test_names_and_types_of_other_columns(spark):
    rows = [(i, f"s{i % 3}", 1 + i % 20) for i in range(60)]
    plain = spark.createDataFrame(rows, "doc_id long, source string, size long")
    names = ["_source", "_size", "_key", "_words", "_rank", "_row", "_n", "_order", "_chunk", "_named"]
    docs = plain.withColumns({name: F.lit(name) for name in names}).withColumns(
        {"m": F.create_map(F.lit("k"), "doc_id"), "deep": F.array(F.struct(F.create_map("size", "size")))}
    )
    got = mixing.mix(docs)
    assert got.columns == [*docs.columns, "source_size", "target", "copies", "taken"]
    found = got.collect()
    check(rows, found)
    assert all(r["_rank"] == "_rank" and r.m == {"k": r.doc_id} for r in found)


def test_equal_rows_are_dealt_to_many_tasks(spark):
    """Two thirds of the rows are equal, and two further rows are frequent."""
    rows = [(1, "a", 7)] * 6000 + [(2, "a", 5)] * 900 + [(3, "b", 4)] * 800
    rows += [(10 + i, "a" if i % 2 else "b", 1 + i % 30) for i in range(1300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(6)
    settings = Settings(chunk_rows=100, hot_share=20)
    got = mixing.mix(docs, settings)
    found = got.collect()
    check(rows, found, settings)
    plain = mixing.mix(docs.repartition(2), Settings(chunk_rows=100)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, plain))
    placed = spark.createDataFrame(
        [(0, 0.5, 1, n, 0) for n in range(5000)] + [(0, 0.1 + n / 9000, n, n, 0) for n in range(5000, 5100)],
        "_rank int, _order double, _key long, _n long, _chunk long",
    )
    largest = mixing.sliced(placed, 5100, settings).groupBy("_chunk", "_after", "_slice").count()
    assert largest.agg(F.max("count")).first()[0] == 100


def test_sources_miss_their_targets_by_half_a_document(spark):
    rows = [(i, f"s{i % 5}", 100) for i in range(500)] + [(1000, "s0", 3000), (1001, "s4", 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    taken, targets_ = Counter(), {}
    for row in mixing.mix(docs).collect():
        taken[row.source] += row.taken
        targets_[row.source] = row.target
    for source, target in targets_.items():
        largest = max(size for _, name, size in rows if name == source)
        assert abs(taken[source] - target) <= largest / 2 + 100


def test_query(spark, tables):
    rows = spark.read.parquet(f"{tables}/documents.parquet").collect()
    source = {r.doc_id: r.source for r in rows}
    count = {r.doc_id: len(words(r.text)) for r in rows}
    got = QUERIES["op7_mix"](spark, tables).collect()
    assert {r.doc_id: r["size"] for r in got} == count
    sizes = Counter()
    for doc_id, size in count.items():
        sizes[source[doc_id]] += size
    want = targets(sizes)
    for row in got:
        assert row.target == pytest.approx(want[source[row.doc_id]])
        assert row.source_size == sizes[source[row.doc_id]]
        assert row.taken % max(1, row["size"]) == 0 and row.taken <= 3 * row["size"]
    assert sum(r.taken for r in got) <= sum(sizes.values())
    assert sum(r.taken for r in got) > 0.97 * sum(sizes.values())
