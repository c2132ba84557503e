"""What shows only on tables larger than the smallest ones."""

import random
import sys
import time
import tracemalloc
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from voxloom import plans
from voxloom.operators import alignment as A
from voxloom.operators import audio as W
from voxloom.operators import vocabulary as Y


def test_names_of_long_ordinals_equal_their_sql(spark, tmp_path):
    spark.sql("SELECT id AS doc_id, 'x' AS text FROM VALUES (7L), (99999L), (100000L), (123456L), (1234567890L) AS t(id)").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(con.execute(plans.oracle_sql()["ordinal_names"]).fetchall())
    assert sorted(map(tuple, plans.queries()["ordinal_names"](spark, str(tmp_path)).collect())) == want


TEXTS = st.text("abcßS", max_size=12)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), min_size=1, max_size=12), st.sampled_from([A.Scores(), A.Scores(2, -1, -1), A.Scores(3, -2, -2), A.Scores(1, 0, -1)]))
def test_tables_filled_together_equal_single_ones(texts, s):
    pairs = [A.codes(q, r) for r, q in texts if r and q]
    if pairs:
        with pytest.MonkeyPatch.context() as m:
            m.setattr(A, "ROW", 1 << 40)  # never one by one
            together = A.traced_together(pairs, s)
        assert together == A.traced_together(pairs, s)
        assert together == [A.traced(A.filled(q, r, s), q, r, s) for q, r in pairs]


def test_batches_hold_every_pair_once_and_few_cells(monkeypatch):
    monkeypatch.setattr(A, "CELLS", 5000)
    sizes = [(n, m) for n in (1, 20, 90) for m in (1, 40, 80)] * 7
    got = list(A.batches(sizes))
    assert sorted(k for b in got for k in b) == list(range(len(sizes))) and len(got) < len(sizes)
    assert all(len(b) == 1 or len(b) * max(sizes[k][0] for k in b) * max(sizes[k][1] for k in b) <= 5000 for b in got)


def test_many_pairs_take_fewer_passes_than_tables_of_their_own():
    """One table at a time took 7 ms a pair of these lengths."""
    rng = np.random.default_rng(0)
    pairs = [tuple(rng.integers(0, 30, (2, 500))) for _ in range(200)]
    began = time.process_time()
    together = A.traced_together(pairs[:100], A.Scores()) + A.traced_together(pairs[100:], A.Scores())
    spent = time.process_time() - began
    began = time.process_time()
    alone = [A.traced(A.filled(*p, A.Scores()), *p, A.Scores()) for p in pairs[:40]]
    assert together[:40] == alone and spent / 200 < (time.process_time() - began) / 40 / 2


def test_recordings_side_by_side_equal_single_ones(spark, monkeypatch):
    monkeypatch.setattr(A, "CHARACTERS", 300)
    rng = random.Random(2)
    targets, chunks = [], []
    for n in range(25):
        words = [f"w{rng.randint(0, 30)}" for _ in range(40)]
        targets.append((f"r{n}", " ".join(words)))
        for k in range(6):
            part = [w if rng.random() < 0.95 else "zz" for w in words[6 * k : 6 * k + rng.randint(1, 8)]]
            chunks.append((f"r{n}", k, f"{k}.txt", " ".join(part) if k != 3 else None))
    targets.append(("silent", "w1 w2 w3"))
    chunks.append(("untold", 0, "0.txt", "w1 w2 w3"))
    got = A.align_recordings(spark.createDataFrame(targets, "rec string, text string"), spark.createDataFrame(chunks, "rec string, ord int, file_name string, text string"))
    assert "MapInPandas" in got._jdf.queryExecution().toString()  # no call of Python for each recording
    want = [
        (rec, name, tier, kept, a.overall_accuracy, a.r_pos)
        for rec, text in targets
        for name, tier, kept, a in A.aligned_chunks(text, [(c[2], c[3] or "") for c in chunks if c[0] == rec])
    ]
    assert sorted(map(tuple, got.select("rec", "file_name", "tier", "text", "accuracy", "r_pos").collect())) == sorted(want) and len(want) > 60


def test_samples_are_not_held_as_numbers_of_python():
    rows = [[1.0, None, 0.5], None, [], [0.25]]
    assert W.lists(W.each(pa.array(rows, pa.list_(pa.float64())))).to_pylist() == rows
    assert W.lists(W.each(pa.array(rows, pa.list_(pa.float64())).slice(1, 3))).to_pylist() == rows[1:]
    values = pa.FixedSizeListArray.from_arrays(pa.array(np.arange(1e6)), 500).cast(pa.list_(pa.float64()))
    tracemalloc.start()
    out = W.lists(x * 2 for x in W.each(values))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 2000 and peak < 24e6  # lists of a million numbers take 32 MB, and they were held for each effect


def test_vocabulary_reads_the_documents_once(spark):
    for name in ("vocab_count", "vocab_count_dedup"):
        plan = plans.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and "Union" not in plan


@pytest.mark.parametrize("dedup,want", [(False, {"a b": 1, "a": 3, "b": 1, " c": 1, "c": 1, "": 1, None: 1}), (True, {"a b": 1, "a": 2, "b": 1, " c": 1, "c": 1, "": 1, None: 1})])
def test_words_bring_their_syllables(spark, dedup, want):
    rows = spark.createDataFrame([(["a b", "a", " c", "", None],), ([],), (None,)], "ws array<string>")
    assert {r["word"]: r["num"] for r in Y.word_counts(rows, F.col("ws"), dedup).collect()} == want
