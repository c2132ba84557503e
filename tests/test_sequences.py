"""Alignment, packing, audio, sampling, vocabulary and streams."""

import json
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxloom.operators import alignment as A
from voxloom.operators import audio as W
from voxloom.operators import clip_packing as K
from voxloom.operators import manifest as M
from voxloom.operators import ordered as O
from voxloom.operators import paths as P
from voxloom.operators import sampling as S
from voxloom.operators import vocabulary as Y

REF = "a b c d e f g h i j".split()


@pytest.mark.parametrize("query,cigar,places,counts,accuracy", [
    ("c d e f", "4m", (0, 2, 5), (4, 0, 0), 1.0),
    ("C D E F", "4m", (0, 2, 5), (4, 0, 0), 1.0),
    ("c d X f g", "5m", (0, 2, 6), (4, 1, 0), 0.8),
    ("d e f g X", "4m", (0, 3, 7), (4, 1, 0), 0.8),
    ("X d e f", "1d3m", (1, 2, 5), (3, 0, 1), 0.5625),
    ("c e f g h", "1d4m", (1, 3, 7), (4, 0, 1), 0.64),
    ("a b c d f g h i", "4m1d4m", (0, 0, 8), (8, 0, 1), 8 / 9),
    ("a b c d Z e f g h", "4m1i4m", (0, 0, 7), (8, 0, 1), 8 / 9),
])
def test_worked_alignments(query, cigar, places, counts, accuracy):
    a = A.align_words(REF, query.split())
    assert (a.cigar, (a.q_pos, a.r_pos, a.r_end), (a.matches, a.mismatches, a.gap_count)) == (cigar, places, counts)
    assert a.overall_accuracy == pytest.approx(accuracy)


def test_alignment_without_a_match_or_words():
    a = A.align_words(REF, ["p", "q", "r"])
    assert a.overall_accuracy == 0 and a.r_pos == 0
    assert A.align_words([], ["a"]).overall_accuracy == 0 and A.align_words(["a"], []).overall_accuracy == 0
    assert A.align_chars("", "a") == A.NOTHING


def plain_table(q, r, s):
    t = [[0] * (len(r) + 1) for _ in range(len(q) + 1)]
    for i in range(1, len(q) + 1):
        for j in range(1, len(r) + 1):
            up, left = t[i - 1][j], t[i][j - 1]
            t[i][j] = max(0, t[i - 1][j - 1] + (s.match if q[i - 1] == r[j - 1] else s.mismatch), up + s.gap if up > 0 else 0, left + s.gap if left > 0 else 0)
    return t


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=14), st.sampled_from([A.Scores(), A.Scores(2, -1, -1), A.Scores(3, -2, -2)]))
def test_rows_equal_a_plain_table(q, r, s):
    assert A.filled(np.array(q, np.int64), np.array(r, np.int64), s).tolist() == plain_table(q, r, s)


def test_char_level():
    a = A.align_chars("xxhello worldyy", "hello worl")
    assert (a.matches, a.r_pos, a.r_end, a.overall_accuracy) == (10, 2, 12, 1.0)


def test_pretty():
    assert A.pretty(A.align_words(REF, "c d X f".split())).split("\n")[1] == "| | . |"


def test_recording_tiers(spark):
    rng = random.Random(1)
    text = [f"w{k}" for k in range(60)]
    chunks = [text[0:8], ["no", "such", "words", "here"], text[8:18], ["x"], [*text[18:28], "zz", *text[28:38]], text[38:60]]
    rows = [("r", k, f"{k}.txt", " ".join(c)) for k, c in enumerate(chunks)]
    got = {r["file_name"]: r for r in A.align_recordings(
        spark.createDataFrame([("r", " ".join(text)), ("alone", "x")], "rec string, text string"),
        spark.createDataFrame(rows, "rec string, ord int, file_name string, text string"),
    ).collect()}
    assert {k: r["tier"] for k, r in got.items()} == {"0.txt": "perfect", "2.txt": "perfect", "4.txt": "accepted", "5.txt": "perfect"}
    assert got["4.txt"]["gap_class"] == "nogap" and "zz" in got["4.txt"]["text"]
    assert rng is not None


def test_recording_ends_after_failures():
    p = A.Policy(terminate=2)
    chunks = [(str(k), "no such words") for k in range(4)] + [("good", "w1 w2 w3 w4 w5 w6")]
    assert list(A.aligned_chunks("w1 w2 w3 w4 w5 w6", chunks, p)) == []
    assert len(list(A.aligned_chunks("w1 w2 w3 w4 w5 w6", chunks[2:], p))) == 1


def test_packing_example(spark):
    clips = [("a", 10), ("b", 10), ("c", 10), ("d", 12), ("e", 12), ("f", 40), ("g", 9)]
    table = spark.createDataFrame([("p", k, c, n) for k, (c, n) in enumerate(clips)], "part string, ord int, clip string, length int")
    got = K.pack_clips(table, K.Packing(("sssss", "ssss-", "sss-s"), window=30, pause_least=5, pause_most=10))
    rows = sorted((r["window_no"] or 99, r["ord"] or 0, r["type"], r["clip"]) for r in got.collect())
    assert rows == [(1, 1, "sss--", "a"), (1, 2, "sss--", "b"), (1, 3, "sss--", "c"), (2, 1, "ss---", "d"), (2, 2, "ss---", "e"), (3, 1, "s----", "g"), (99, 0, None, "f")]
    texts = table.select("part", "clip", F.col("clip").alias("text"))
    manifest = {r["file_name"]: r["transcription"] for r in K.window_manifest(got, texts).collect()}
    assert manifest == {"1.wav": "a b c", "2.wav": "d e", "3.wav": "g"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=40), st.sampled_from([K.LABELLED, K.UNLABELLED, K.STREAMED]), st.integers(1, 7))
def test_packing_keeps_all_clips_in_order(lengths, patterns, cut):
    p = K.Packing(patterns, window=30, pause_least=5, pause_most=10)
    clips = [(str(k), n) for k, n in enumerate(lengths)]
    rejects: list[str] = []
    whole = list(K.packed(p, "g", iter(clips), K.State(), rejects, True))
    assert [c for _, _, held in whole for c, _ in held] + rejects == sorted((c for c, _ in clips), key=lambda c: (c in rejects, int(c)))
    for _, kind, held in whole:
        size = dict(clips)
        ends = [at + size[c] for c, at in held]
        assert ends[-1] <= 30 and all(e <= at for e, (_, at) in zip(ends, held[1:], strict=False)) and kind.count("s") == len(held)
    state, parts, again = K.State(), [], []
    for k in range(0, len(clips) + 1, cut):
        saved = json.loads(json.dumps(vars(state)))
        state = K.State(**saved)
        state.clips = [tuple(c) for c in state.clips]
        parts += K.packed(p, "g", iter(clips[k : k + cut]), state, again, k + cut > len(clips))
    assert parts == whole


def test_stream_equals_batch(spark, tmp_path):
    from voxloom.streaming import incremental as I

    rows = [(p, k, f"{p}{k}", (k * 37) % 90 + 10) for p in "ab" for k in range(30)]
    schema = "part string, ord int, clip string, length int"
    for n, part in enumerate([rows[:10] + rows[30:35], rows[10:30] + rows[35:], [("a", 99, "", 0), ("b", 99, "", 0)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = I.pack_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), K.Packing(window=100, pause_least=5, pause_most=9))
        I.run_to_end(got, str(tmp_path / "state"), lambda df, k: df.write.mode("append").parquet(str(tmp_path / "out")))
        assert n < 3
    batch = K.pack_clips(spark.createDataFrame(rows, schema), K.Packing(window=100, pause_least=5, pause_most=9))
    key = lambda df: sorted(map(tuple, df.select("part", "window_no", "type", "ord", "clip", "start_at").collect()))
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(batch)


def test_wav_and_effects(spark):
    x = np.sin(np.arange(1600) / 9) / 2
    df = spark.createDataFrame([(1, x.tolist())], "k long, x array<double>").withColumn("wav", W.wav_bytes(F.col("x"), 8000))
    row = df.select(W.wav_header(F.col("wav")).alias("h"), W.wav_samples(F.col("wav"), 8000).alias("y"), W.wav_samples(F.col("wav"), 16000, 0.1, 0.05).alias("z"), W.decodable(F.lit(b"no")).alias("bad")).first()
    assert tuple(row["h"]) == (8000, 1, 1600, 0.2) and np.allclose(row["y"], x, atol=1e-4) and len(row["z"]) == 800 and row["bad"] is False
    made = df.select(W.with_noise(F.col("x"), 1, F.col("k"), 20, 20).alias("n"), W.with_tanh(F.col("x"), 0.5).alias("t"), W.with_clipping(F.col("x"), 40).alias("c"), W.with_background(F.col("x"), F.slice("x", 1, 9), 10).alias("b")).first()
    noise = np.asarray(made["n"]) - x
    assert 15 < 20 * np.log10(np.std(x) / np.std(noise)) < 25
    assert np.sqrt(np.mean(np.square(made["t"]))) == pytest.approx(np.sqrt(np.mean(x**2)), rel=1e-6)
    assert max(made["c"]) < x.max() and len(made["b"]) == 1600


def test_chunks_and_silence(spark):
    df = spark.createDataFrame([("a", [1.0] * 7), ("b", [])], "k string, x array<double>")
    got = W.chunk_rows(df, "k", "x", 3).collect()
    assert [(r["n"], r["chunk"]) for r in got] == [(1, [1.0] * 3), (2, [1.0] * 3), (3, [1.0, 0.0, 0.0])]
    tone = np.concatenate([np.ones(3000), np.zeros(4000), np.ones(3000), np.zeros(4000), np.ones(500)])
    pieces, rest = W.silence_pieces(tone, 1000, 30, 512, 5, 2)
    assert [len(p) > 2900 for p in pieces] == [True, True] and rest is not None and len(rest) < 2000
    assert W.silence_pieces(np.ones(10), 1000, 30, 512, 5, 2)[0] == []


def test_effect_table():
    table = W.effect_weights(3)
    assert table[0] == ("background_high", 3, 0, 3) and table[-1][3] == 18 + 22000


def test_ordinals_and_shards(spark):
    df = spark.range(1000).repartition(7)
    got = O.ordinal(df, "id").collect()
    assert sorted((r["id"], r["rn"]) for r in got) == [(k, k) for k in range(1000)]
    n, t = 103, 7
    shards = spark.range(n).select("id", O.range_shard(F.col("id"), F.lit(n), t).alias("s")).collect()
    assert all(int(r["s"] * n / t) <= r["id"] < int((r["s"] + 1) * n / t) for r in shards)
    assert O.resume_point(spark.createDataFrame([("x",)], "stem string")).first()["next"] == 1


def test_budget_keeps_the_crossing_row(spark):
    rows = [("c", 9 - k, 50.0, k != 1) for k in range(6)]
    df = spark.createDataFrame(rows, "channel string, at int, seconds double, ok boolean")
    got = O.within_budget(df, ["channel"], [F.desc("at")], F.col("seconds"), F.col("ok"), 100.0).collect()
    assert [r["at"] for r in got] == [9, 7, 6]
    assert O.within_budget(df, ["channel"], [F.desc("at")], F.col("seconds"), F.col("ok"), 100.0, most=2).count() == 1


def test_sampling(spark):
    df = spark.range(2000)
    a, b = (S.shuffled(df.repartition(n), 3, "id").collect() for n in (2, 5))
    assert a == b and [r["id"] for r in a] != list(range(2000))
    assert S.exact_split(df, 60, 1, "id").where("split = 'test'").count() == 60
    assert 30 < S.hash_split(df, 0.03, 1, "id").where("split = 'test'").count() < 95
    one = spark.range(1).select(S.binary_pattern(F.lit(3), F.lit(8), 1, "id").alias("p"), S.draws_with_replacement(F.array(F.lit("x"), F.lit("y")), F.lit(5), 2, "id").alias("d")).first()
    assert sorted(one["p"]) == [0] * 5 + [1] * 3 and len(one["d"]) == 5 and set(one["d"]) <= {"x", "y"}
    assert S.pick_undone(df, df, ["id"], 1).count() == 0


def test_vocabulary(spark):
    rows = spark.createDataFrame([(["a b", "c"],)], "ws array<string>")
    count = lambda **k: {r["word"]: r["num"] for r in Y.word_counts(rows, F.col("ws"), **k).collect()}
    assert count() == {"a b": 1, "a": 1, "b": 1, "c": 2} and count(dedup=True) == {"a b": 1, "a": 1, "b": 1, "c": 1}
    text = spark.range(1).select(Y.sentence(F.array(F.lit("U")), F.array(F.lit("s")), 7, 0.3, 1, "id")).first()[0].split()
    assert sorted(text) == ["U"] * 3 + ["s"] * 4


def test_directories(spark):
    files = spark.createDataFrame([("a/b/1.wav",), ("a/b/2.wav",), ("a/3.txt",), ("top.txt",), ("c/d/e/4.wav",)], "rel_path string")
    assert sorted(r[0] for r in P.leaf_dirs(files).collect()) == ["a/b", "c/d/e"]
    assert sorted(r[0] for r in P.dirs_with(files, "txt").collect()) == ["", "a"]
    assert dict(map(tuple, P.dir_depths(files).collect())) == {"a": 2, "a/b": 1, "c": 3, "c/d": 2, "c/d/e": 1}
    moved = spark.range(1).select(P.rerooted(F.lit("/r/x/r/y.v.wav"), "/r", "/q", ".txt")).first()[0]
    assert moved == "/q/x/r/y.v.txt"


def test_manifests(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y2")], "k int, v string")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(map(tuple, M.mismatches(a, b, ["k"]).collect())) == [(1, "left_only"), (3, "right_only")]
    assert M.unmatched(a, b, ["k"]).count() + M.kept(a, b, ["k"]).count() == 3
    with pytest.raises(ValueError):
        M.union_same(a, b)
    files = spark.createDataFrame([("/d/1.wav",), ("/d/1.wav",), ("/e/2.wav",)], "file string")
    assert sorted(map(tuple, M.delete_list(files).collect())) == [("/d", "1.wav"), ("/e", "2.wav")]
    pairs = spark.createDataFrame([("f", "a b", "a b")] * 5 + [("f", "a b", None), ("g", "a", "b")], "dir string, original string, fixed string")
    assert {r["dir"]: r["accepted"] for r in M.accepted_folders(pairs).collect()} == {"f": True, "g": False}


def test_maps(spark):
    from voxloom.operators import mapper

    calls = lambda: (lambda t: pd.DataFrame({"id": t["id"], "n": [len(t)] * len(t)}))
    mapper.register("sizes", calls, "id long, n long")
    got = mapper.apply(spark.range(10).coalesce(1), "sizes", done=spark.range(3), on=["id"], batch=4).collect()
    assert sorted(r["n"] for r in got) == [3, 3, 3, 4, 4, 4, 4]
    assert spark.range(1).select(mapper.segmented_words(F.lit("ab cd"), lambda t: [t[:1]])).first()[0] == ["a"]


def test_more_effects(spark):
    t = np.arange(8000) / 8000
    x = np.sin(2 * np.pi * 200 * t) + np.sin(2 * np.pi * 1500 * t)
    df = spark.createDataFrame([(x.tolist(),), ([],), (None,)], "x array<double>")
    got = df.select(W.with_band_pass(F.col("x"), 100, 400, 8000).alias("b"), W.with_pitch(F.col("x"), 2.0).alias("p"), W.with_room(F.col("x"), 0.1, 1, 8000).alias("r")).collect()
    assert np.allclose(got[0]["b"], np.sin(2 * np.pi * 200 * t), atol=1e-6)
    assert len(got[0]["p"]) == len(got[0]["r"]) == 8000
    assert np.sqrt(np.mean(np.square(got[0]["r"]))) == pytest.approx(np.sqrt(np.mean(x**2)))
    low = np.sin(2 * np.pi * 200 * t)
    peak = np.fft.rfftfreq(8000, 1 / 8000)[np.abs(np.fft.rfft(W.shifted(low, 12.0))).argmax()]
    assert 380 < peak < 420
    assert tuple(got[1]) == ([], [], []) and tuple(got[2]) == (None, None, None)
