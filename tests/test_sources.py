"""Files in and out, and the driver's contract."""

import json

from pyspark.sql import functions as F

from voxloom.sources import files as R
from voxloom.sources import sinks as O
from voxloom.sources.paged import PagedSource


def test_files_and_texts(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "a/b/1.txt").write_text("x\ny", encoding="utf8")
    (tmp_path / "a/2.wav").write_bytes(b"12")
    got = {r["rel_path"]: (r["dir"], r["stem"], r["ext"]) for r in R.files(spark, str(tmp_path)).collect()}
    assert got == {"a/b/1.txt": ("a/b", "1", "txt"), "a/2.wav": ("a", "2", "wav")}
    assert R.texts(spark, str(tmp_path)).first()["text"] == "x\ny"


def test_manifest_round_trip(spark, tmp_path):
    rows = [("d1", "1.wav", 'say "hi",\nthere'), ("d1", "2.wav", None), ("d2", "3.wav", "ok")]
    df = spark.createDataFrame(rows, "dir string, file_name string, transcription string")
    O.write_manifest(df, str(tmp_path / "m"))
    got = R.manifest(spark, str(tmp_path / "m/*/*.csv"))
    assert sorted((r["file_name"], r["transcription"]) for r in got.collect()) == [(f, t) for _, f, t in rows]
    assert {r["dir"].split("/")[-1] for r in got.collect()} == {"dir=d1", "dir=d2"}


def test_report_segments_and_state(spark, tmp_path):
    df = spark.createDataFrame([(k, float(k % 3)) for k in range(10)], "k long, wer double")
    O.write_report(df, str(tmp_path / "r"), "wer", "k")
    lines = next((tmp_path / "r").glob("*.csv")).read_text().split()
    assert lines[1:5] == ["2,2.0", "5,2.0", "8,2.0", "1,1.0"]
    O.write_segments(df, str(tmp_path / "s"), 4, "k", done=spark.createDataFrame([(1,)], "segment long"))
    assert sorted((r["k"], r["segment"]) for r in R.columnar(spark, str(tmp_path / "s")).withColumn("segment", F.floor(F.col("k") / 4)).collect()) == [(k, k // 4) for k in (0, 1, 2, 3, 8, 9)]
    (tmp_path / "state.json").write_text(json.dumps({"last_file_reading": "a", "final_read_segment": 3}))
    assert tuple(R.state(spark, str(tmp_path / "state.json")).first()) == ("a", 3)
    O.write_columnar(df, str(tmp_path / "c"), shards=2, rows_per_file=3)
    assert len(list((tmp_path / "c").glob("*.parquet"))) >= 4


def test_lists_and_prompts(spark, tmp_path):
    (tmp_path / "w.txt").write_text("a b\nc\n", encoding="utf8")
    assert [r["word"] for r in R.word_list(spark, str(tmp_path / "w.txt")).collect()] == ["a b", "c"]
    (tmp_path / "p.txt").write_text("S1_02 Xin CHAO\nS2_1\n", encoding="utf8")
    assert sorted(map(tuple, R.prompts(spark, str(tmp_path / "p.txt")).collect())) == [("S1", "S1/S1_02.wav", "xin chao"), ("S2", "S2/S2_1.wav", "")]


def test_paged_source(spark, tmp_path):
    (tmp_path / "first.json").write_text(json.dumps({"items": [{"id": "1", "caption": True}], "nextPageToken": "b"}))
    (tmp_path / "b.json").write_text(json.dumps({"items": [{"id": "2"}, {"id": "3"}]}))
    spark.dataSource.register(PagedSource)
    got = spark.read.format("paged").option("root", str(tmp_path)).load()
    assert sorted((r["page"], r["id"]) for r in got.collect()) == [(0, "1"), (1, "2"), (1, "3")]


def test_contract(spark):
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 90
    assert entry.entry(spark).columns == ["conv_id", "turn", "wer"]


def test_llm_is_apart():
    """Nothing outside the subpackage, the entry and the pipeline names it."""
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for path in (root / "voxloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert "voxloom.llm" not in path.read_text(encoding="utf8")
