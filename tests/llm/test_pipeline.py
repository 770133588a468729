"""The stages, each on its own input, and the whole run."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventlake.llm import bpe, jaccard, mixing, secrets
from eventlake.llm.tables import FOLDERS
from tests.llm.test_jaccard import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def docs(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet").where("doc_id < 400").persist()


def test_stages_return_documents(spark, docs, tables):
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, tables).columns == COLUMNS, name


def test_languages_keep_clean_documents(spark, documents, tables, docs):
    extra = documents([(10_001, None), (10_002, ""), (10_003, "123 !!")])
    kept = stage("language")(spark, docs.union(extra), tables)
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {10_001, 10_002, 10_003}
    assert len(ids) > 0.98 * docs.count()


def test_one_document_of_each_group_stays(spark, docs, tables):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = stage("near_duplicates")(spark, docs, tables).collect()
    want = {component for _, _, component in brute(rows, 5, 80)}
    assert sorted(r.doc_id for r in kept) == sorted(want)
    assert {r.doc_id: r.text for r in kept} == {i: t for i, t in rows if i in want}


def test_repeated_rows_and_rows_without_id(spark, documents, tables):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other"), (None, "x y"), (None, "x y"), (2, None)]
    kept = stage("near_duplicates")(spark, documents(rows), tables).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == {
        (1, "a b c d e f"): 1, (1, "other"): 1, (None, "x y"): 1, (2, None): 1,
    }


def test_two_texts_of_one_id_stay_unless_they_are_linked(spark, documents, tables):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(7, long), (7, "another text altogether"), (3, long + " tail"), (None, long + " end"),
            (None, "without an id"), (None, "without an id"), (8, ""), (8, ""), (9, None)]
    kept = stage("near_duplicates")(spark, documents(rows), tables).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == {
        (3, long + " tail"): 1, (7, "another text altogether"): 1, (None, "without an id"): 1,
        (8, ""): 2, (9, None): 1,
    }


def test_map_columns_and_clashing_names_pass_every_stage(spark, documents, tables):
    texts = ["the quick brown fox and the dog that it sees in the town"] * 2 + [
        f"the {w} of the house is in the town and it is the best of all {w}" for w in ("cat", "dog", "man")
    ]
    names = ["_row", "_n", "_id", "_size", "_key", "_rank", "component_id", "size", "copies", "_copy", "secrets"]
    docs = documents([(i, text) for i, text in enumerate(texts * 40)]).withColumns(
        {name: F.lit(name) for name in names}
    )
    docs = docs.withColumn("tags", F.create_map(F.lit("k"), "doc_id"))
    for name, step in corpus_pipeline.STAGES[:-1]:
        found = step(spark, docs, tables)
        assert found.columns == docs.columns, name
        rows = found.collect()
        assert rows and all(r.tags == {"k": r.doc_id} and r["_rank"] == "_rank" for r in rows), name
    assert stage("tokens")(spark, docs, tables).count() == docs.count()


def test_empty_tables_pass_every_stage(spark, docs, tables):
    for name, step in corpus_pipeline.STAGES[1:]:
        assert step(spark, docs.where("doc_id < 0"), tables).collect() == [], name


def test_secrets_are_gone(spark, docs, tables):
    before = {r.doc_id: r for r in docs.collect()}
    after = {r.doc_id: r for r in stage("secrets")(spark, docs, tables).collect()}
    assert after.keys() == before.keys()
    for doc_id, row in after.items():
        assert secrets.scan(row.text) == []
        assert row.n_chars == len(row.text)
        if not secrets.scan(before[doc_id].text):
            assert row == before[doc_id]


def test_mix_repeats_documents(spark, docs, tables):
    sized = docs.withColumn("size", mixing.word_count("text"))
    want = Counter({r.doc_id: r.copies for r in mixing.mix(sized).collect()})
    got = stage("mix")(spark, docs, tables).collect()
    words = {r.doc_id: r["size"] for r in sized.collect()}
    total = sum(words.values())
    assert sum(words[r.doc_id] for r in got) == pytest.approx(total, rel=0.05)
    assert max(Counter(r.doc_id for r in got).values()) <= 3
    assert sum(want.values()) == pytest.approx(len(got), rel=0.2)


def test_tokens_decode_to_their_texts(spark, docs, tables):
    out = stage("tokens")(spark, docs, tables).collect()
    vocabulary = bpe.load(corpus_pipeline.vocabulary_file("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in out:
        ids = np.frombuffer(row.ids, "<u4").astype(np.int64)
        assert row.exact and row.n_tokens == len(ids)
        assert bpe.decode_ids(vocabulary, ids, np.array([len(ids)])) == [texts[row.doc_id]]


def test_odd_documents_pass_every_stage(spark, documents, tables, odd_texts):
    rows = [(i, text, None if i % 7 else "en", None if i % 5 else "s", None)
            for i, text in enumerate(odd_texts)]
    rows += [(None, "a b c", None, None, None), (3, "dup", "en", "s", 3), (3, "dup", "en", "s", 3)]
    odd = documents(rows)
    for extra in ("score", "accepted", "size", "copies", "ids", "component_id", "target", "set"):
        odd = odd.withColumn(extra, F.lit("extra"))
    for step in (odd, odd.where("doc_id = -1")):
        for name, function in corpus_pipeline.STAGES:
            found = function(spark, step, tables)
            if name != "tokens":
                assert found.columns == odd.columns, name
                assert {r.score for r in found.collect()} <= {"extra"}
                step = found
            else:
                assert all(r.exact for r in found.collect())


def test_run(spark, tables):
    before = len(FOLDERS)
    out = corpus_pipeline.run(spark, tables)
    assert len(FOLDERS) == before + 1
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "exact"]
    rows = out.drop("ids").collect()
    assert rows and all(r.exact for r in rows)
    groups = jaccard.similar_groups(spark.read.parquet(f"{tables}/documents.parquet"))
    heads = {r.component_id for r in groups.collect()}
    assert {r.doc_id for r in rows} <= heads


def test_entry_does_without_the_subpackage(tmp_path):
    root = Path(corpus_pipeline.__file__).parent
    copy = tmp_path / "eventlake"
    copy.mkdir()
    for part in (root / "eventlake").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (copy / part.name).symlink_to(part)
    (tmp_path / "__spark_entry__.py").write_text((root / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; print(sorted(e.queries()), sorted(e.oracle_sql()))"
    said = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert "json_event_ingest" in said.stdout and "op1_" not in said.stdout
