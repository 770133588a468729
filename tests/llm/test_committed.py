"""Committed steps, and removing them."""

from pathlib import Path

from eventlake.llm import tables


def test_committed_rows_are_fixed(spark):
    first = len(tables.FOLDERS)
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = tables.committed(spark.range(10).mapInArrow(watched, "id long"))
    assert rows.count() == rows.distinct().count() == 10
    assert seen.value == 10
    (folder,) = tables.FOLDERS[first:]
    tables.remove_folders(spark, first)
    assert len(tables.FOLDERS) == first and not Path(folder).exists()


def test_folds(spark):
    rows = spark.createDataFrame([(0,), (7,), (None,)], "doc_id long")
    got = rows.select("doc_id", tables.held_out("doc_id"), tables.trained_on("doc_id")).collect()
    import zlib

    def fold(i):
        return zlib.crc32(str(i).encode()) % 5

    assert [tuple(r) for r in got] == [
        (0, fold(0) == 0, fold(0) != 0), (7, fold(7) == 0, fold(7) != 0), (None, False, False)
    ]
