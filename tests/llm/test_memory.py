"""What a Python worker still holds after its tasks."""

import random
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
from pyspark import cloudpickle

import corpus_pipeline
from eventlake.llm import bpe

WORKER = """
import pickle, re, sys
import numpy, pyarrow as pa

def held():
    with open("/proc/self/smaps_rollup") as file:
        return int(re.search(r"\\nPss_Anon:\\s+(\\d+)", file.read()).group(1)) / 1024

run, first, second = pickle.load(open(sys.argv[1], "rb"))
for _ in run(iter([first.slice(0, 10)])):
    pass
before, most = held(), 0
for _ in run(iter([first, second])):
    most = max(most, held())
print(most - before, held() - before)
"""


def test_tokens_leave_a_worker_small(spark, tmp_path, monkeypatch):
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(40_000)]
    texts = [" ".join(draw.choices(words, k=400)) for _ in range(6_000)]
    batches = [
        pa.RecordBatch.from_pydict({"doc_id": list(range(3_000)), "text": texts[at : at + 3_000]})
        for at in (0, 3_000)
    ]
    caught = []
    documents = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(
        type(documents), "mapInArrow", lambda rows, run, schema: caught.append(run)
    )
    bpe.round_trip(documents, bpe.load(corpus_pipeline.vocabulary_file("byte_bpe_50k.json")))
    task = tmp_path / "task"
    task.write_bytes(cloudpickle.dumps((*caught, *batches)))
    said = subprocess.run(
        [sys.executable, "-c", WORKER, str(task)],
        cwd=Path(corpus_pipeline.__file__).parent, capture_output=True, text=True, check=True,
    )
    most, left = map(float, said.stdout.split())
    assert most < 34 and left < 20
