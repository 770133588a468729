"""The prefix trie against a plain one, kept in dicts."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import trie

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows, graft=True):
    """Rows of the report out of (conv_id, turn, role, text) rows without ties."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {conv: [item for *_, item in sorted(items)] for conv, items in turns.items()}
    paths = {}
    for conv, items in own.items():
        cut = zlib.crc32(str(conv).encode()) % 4 if graft else 0
        stock = own.get(conv - int(np.fmod(conv, 20)), []) if graft else []
        paths[conv] = stock[:cut] + items[cut:]
    members = defaultdict(list)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(conv)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += children[node] == 0
            saved[node[:depth]] += (len(convs) - 1) * words
    return sorted(
        (
            min(convs), len(node), str(min(members[node[:-1]]) if node else None), len(convs),
            children[node], leaves[node], saved[node],
            hashlib.sha256(
                ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node)).encode()
            ).hexdigest(),
        )
        for node, convs in members.items()
    )


def table(report):
    return sorted(
        (
            r.conv_id, r.depth, str(r.parent_conv_id), r.n_convs, r.n_children, r.n_leaves,
            r.saved_tokens, r.ends_sha256,
        )
        for r in report.collect()
    )


def random_rows(seed, size, texts=3):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-30, 4 * size), size):
        for turn in draw.sample([None, *range(9)], draw.randint(1, 6)):
            rows.append((conv, turn, draw.choice(["user", None, ""]), "a b c"[: draw.randrange(2 * texts)]))
    return rows + [(None, 1, "user", "lost"), (None, None, None, None)]


@pytest.mark.parametrize("graft", [True, False])
def test_random_conversations(spark, graft):
    rows = random_rows(1, 300)
    found = trie.prefix_trie(
        spark.createDataFrame(rows, TURNS).repartition(4), trie.Graft() if graft else None
    )
    assert table(found) == plain(rows, graft)


def test_deep_top_and_written_runs(spark, monkeypatch):
    """Nodes of a few members are the top already, and the queue holds next to nothing."""
    monkeypatch.setattr(trie, "FEW_MEMBERS", 4)
    monkeypatch.setattr(trie, "QUEUE_ROWS", 2)
    monkeypatch.setattr(trie, "RUN_BLOCK", 2)
    monkeypatch.setattr(trie, "JOINED", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = random_rows(2, 400)
        rows += [(5000 + i, t, "user", f"same {t}") for i in range(120) for t in range(5)]
        assert table(trie.trie_report(spark.createDataFrame(rows, TURNS).repartition(5))) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_conversation_over_many_tasks(spark):
    rows = [(40, turn, "user", f"t {turn % 3}") for turn in range(700)]
    rows += [(41, turn, "user", f"t {turn % 3}") for turn in range(650)]
    rows += [(c, 0, "user", "t 0") for c in range(42, 60)]
    docs = spark.createDataFrame(rows, TURNS).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        _, pieces = trie.in_order(trie.marked_turns(docs))
        assert pieces.where("conv = 40").count() > 2
        assert table(trie.trie_report(docs)) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_the_queue(tmp_path, monkeypatch):
    monkeypatch.setattr(trie, "QUEUE_ROWS", 50)
    monkeypatch.setattr(trie, "RUN_BLOCK", 7)
    draw = np.random.default_rng(3)
    waiting = trie.Waiting(f"file://{tmp_path}/runs")
    want = np.zeros((1000, 3), np.int64)
    for _ in range(60):
        rows = draw.integers(0, 1000, (40, 4))
        np.add.at(want, rows[:, 0], rows[:, 1:])
        waiting.push(4, rows)
    assert len(list((tmp_path / "runs").iterdir())) > 3
    got = [waiting.pop(4, np.arange(low, low + 100)) for low in range(0, 1000, 100)]
    assert np.array_equal(np.concatenate(got), want)
    waiting.close()
    assert list((tmp_path / "runs").iterdir()) == []


def test_ties_repeats_nulls_and_other_columns(spark):
    rows = [(1, 1, "user", "x"), (1, 1, "user", "x"), (1, None, None, None), (1, 1, "a", "y" * 200_000)]
    docs = spark.createDataFrame(rows, TURNS)
    clashing = docs.withColumns({n: F.lit("z") for n in ("conv", "part", "words", "k1", "depth", "sent")})
    some = table(trie.prefix_trie(clashing))
    assert some == table(trie.prefix_trie(docs.orderBy("text").repartition(2)))
    assert [r[1] for r in some] == [0, 1, 2, 3, 4]
    assert table(trie.prefix_trie(docs.where("conv_id = 2"))) == []
    assert trie.trie_report(docs).dtypes == [
        ("conv_id", "bigint"), ("depth", "bigint"), ("parent_conv_id", "bigint"), ("n_convs", "bigint"),
        ("n_children", "bigint"), ("n_leaves", "bigint"), ("saved_tokens", "bigint"), ("ends_sha256", "string"),
    ]


def test_conversations_without_turns_are_members_of_the_root(spark):
    """Of ids whose stock is absent only what lies beyond the cut remains."""
    rows = [(conv, 0, "user", "hi") for conv in range(101, 120)]
    found = table(trie.trie_report(spark.createDataFrame(rows, TURNS)))
    assert found == plain(rows)
    assert any(zlib.crc32(b"%d" % conv) % 4 for conv in range(101, 120))
