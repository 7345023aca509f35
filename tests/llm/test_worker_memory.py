"""What kernels leave in a Python worker, and the size of the batches that they hand to the JVM."""

import ctypes
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from quirework.llm import decontaminate, jaccard_join

ROLLUP = Path("/proc/self/smaps_rollup")


class Shared:
    def __init__(self, value):
        self.value = value


def texts(rows: int, words: int):
    draw = np.random.default_rng(1)
    return pa.array([" ".join(f"w{x}" for x in draw.integers(0, 1 << 40, words).tolist()) for _ in range(rows)])


def test_texts_leave_a_worker_in_small_batches():
    text = texts(3000, 150)
    block = decontaminate.Block([("a", text[1700].as_py()[100:400])], 10)
    block.order({k: np.zeros(len(v), np.int64) for k, v in block.shingles.items()})
    ids = pa.array(range(3000), pa.int64())
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *decontaminate.RESULT])
    batch = pa.RecordBatch.from_arrays([ids, text], ["doc_id", "text"])
    assert batch.nbytes > 4 << 20
    out = list(decontaminate._probing([Shared(block)], 1, [0, 1], schema)(iter([batch])))
    assert all(x.nbytes < 2 << 20 for x in out)
    whole = pa.Table.from_batches(out)
    assert whole["doc_id"].to_pylist() == ids.to_pylist() and whole["text"].combine_chunks().to_pylist() == text.to_pylist()
    assert [i for i, s in enumerate(whole["spans"].to_pylist()) if s] == [1700]


@pytest.mark.skipif(not ROLLUP.exists() or not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="needs Linux and glibc")
def test_free_memory_goes_back_at_the_end_of_a_task():
    def trimmed() -> float:
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
        return held()

    def held() -> float:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", ROLLUP.read_text())[1]) / 1024

    batch = pa.RecordBatch.from_arrays([pa.array(range(3000), pa.int64()), texts(3000, 300)], ["doc_id", "text"])
    trimmed()
    rows = sum(x.num_rows for x in jaccard_join._reading(5)(iter([batch])))
    left = held()
    assert rows > 3000 and left - trimmed() < 8
