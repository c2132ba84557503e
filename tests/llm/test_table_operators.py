"""Operators 1, 3, 6 and 10, and the pipeline."""

import base64
import gzip
import hashlib
import zlib
from pathlib import Path

import brute
import pytest

from voxloom.llm import packing, secrets, sharding, warc

SF = "/root/testdata/sf0.001"


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# --- 3
def test_ids_equal_the_tokenizers_library(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_tokenizer())
    plain.encode_special_tokens = True
    encode = packing.encoder(packing.default_tokenizer())
    odd = ["<|endoftext|> a", "  two  spaces\n\n\nlines\t", "it's we'll I'D", "１２３ ٣ é́   😀👍🏽", "\x00\x1c", "a" * 3000]
    for text in [*(t or "" for t in texts.values()), *odd]:
        assert encode(text) == plain.encode(text, add_special_tokens=False).ids


def test_added_tokens_in_a_text_get_their_own_id(spark):
    import numpy as np
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_tokenizer())
    texts = dict(enumerate(["<|endoftext|> a", "a <|endoftext|>\n\n<|endoftext|><|endoftext|>b's", "<|endoftext|", "é <|endoftext|>" * 900, "none"]))
    got = packing.pieces(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), size=64).collect()
    assert library.encode(texts[0], add_special_tokens=False).ids == [50256, 257]
    for d, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        mine = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got if r["doc_id"] == d)
        assert mine == [(k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 64))]


def test_cut():
    assert packing.cut(1) == [(0, 1)]
    assert packing.cut(2048) == [(0, 2048)]
    assert packing.cut(2049) == [(0, 1), (1, 2048)]
    assert packing.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)]


def check_packing(got, texts, size):
    import numpy as np

    encode = packing.encoder(packing.default_tokenizer())
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for d, parts in by_doc.items():
        ids = np.array([*encode(texts[d] or ""), 0], "<u4")
        parts.sort(key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in parts] == [(k, s, n) for k, (s, n) in enumerate(packing.cut(len(ids), size))]
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in parts)
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    return len(by_sequence)


@pytest.mark.parametrize("size,group", [(2048, 4000), (64, 5)])
def test_packing(docs, texts, size, group):
    got = packing.packed(packing.pieces(docs, size=size), size, group).collect()
    check_packing(got, texts, size)


def test_sum_of_squares_is_tight():
    import numpy as np

    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 2048, 2000))[::-1]
    where, offset = packing.sum_of_squares(lengths)
    used = np.bincount(where, lengths)
    assert used.max() <= 2048 and len(used) <= 1.03 * lengths.sum() / 2048 + 1
    assert packing.sum_of_squares(np.array([], dtype=np.int64))[0].size == 0
    assert offset[0] == 0


def test_packing_of_nothing(empty):
    assert packing.packed(packing.pieces(empty)).count() == 0


# --- 6
def check_shards(got, texts, shards=8):
    sizes = [0] * shards
    slots = [set() for _ in range(shards)]
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        sizes[r["shard"]] += 1
        slots[r["shard"]].add(r["slot"])
    assert max(sizes) - min(sizes) <= 1
    assert all(s == set(range(n)) for s, n in zip(slots, sizes, strict=True))


def test_sharding(docs, texts):
    got = sharding.sharded(docs).collect()
    assert len(got) == len(texts)
    check_shards(got, texts)
    assert len({r["shard"] for r in got if r["doc_id"] in (10, 11, 12, 13)}) == 1


def test_sharding_of_a_hot_group(spark):
    texts = {k: "same" if k < 200 else f"text {k // 3}" for k in range(500)}
    got = sharding.sharded(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), unit=10).collect()
    check_shards(got, texts)
    cut = {r["doc_id"] // 3 for r in got if r["doc_id"] >= 201 and r["cut"]}
    assert len(cut) <= 15


def test_sharding_of_repeated_rows_and_nothing(spark, empty):
    rows = [(1, None), (1, None), (2, ""), (2, "")] * 5
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_shards(got, {1: None, 2: ""})
    assert sharding.sharded(empty).count() == 0


def test_sharding_of_clashing_names(clashing, texts):
    check_shards(sharding.sharded(clashing).collect(), texts)


# --- 1
def secret_docs():
    keys = [hashlib.sha1(str(k).encode()).hexdigest() for k in range(60)]
    out = [(k, f'set token = "{x}" here') for k, x in enumerate(keys)]
    out += [(100 + k, f"see /usr/share/thingsandotherthings{k}/readmefilenames and http://a.example/{x}") for k, x in enumerate(keys)]
    return [*out, (300, None), (301, ""), (302, "a" * 9000), (303, f'TOKEN = "{keys[0].upper()}"'), (303, f'TOKEN = "{keys[0].upper()}"')]


def test_secret_scan(spark):
    got = secrets.scan(spark.createDataFrame(secret_docs(), "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got if r["secret"]} >= set(range(60)) | {303}
    assert not any(r["secret"] for r in got if 100 <= r["doc_id"] < 300)
    texts = dict(secret_docs())
    assert all(texts[r["doc_id"]][r["start"] : r["end"]] == r["value"] for r in got)


def test_secret_scan_with_given_findings(spark):
    docs = spark.createDataFrame(secret_docs(), "doc_id long, text string")
    found = secrets.candidates(docs.select("doc_id", "text")).collect()
    findings = [(r["doc_id"], r["start"], r["end"], r["doc_id"] >= 100) for r in found]
    got = secrets.scan(docs, spark.createDataFrame(findings, "doc_id long, start int, end int, secret boolean")).collect()
    assert not any(r["secret"] for r in got if r["doc_id"] < 60)


def test_secret_scan_of_short_values_and_other_letters(spark):
    """Whole assigned values from six letters, and passwords in addresses, of any letters."""
    more = [
        (400, 'password = "S3cr3t!Pass9" here', "S3cr3t!Pass9"), (401, "go postgres://user:p4ss:w0rd$1@db.local/x", "p4ss:w0rd$1"),
        (402, "é pwd=h7nt3r.9 # x", "h7nt3r.9"), (403, "'passwd': 'a1 b2#c3d4'", "a1 b2#c3d4"), (404, 'PASSWORD: "k9"', None), (405, "http://a.example:808080/x@y", None),
    ]
    docs = spark.createDataFrame([*secret_docs(), *((d, t) for d, t, _ in more)], "doc_id long, text string")
    got = [r for r in secrets.scan(docs).collect() if r["doc_id"] >= 400]
    assert {(r["doc_id"], r["value"]) for r in got if r["secret"]} == {(d, v) for d, _, v in more if v}
    assert all(dict((d, t) for d, t, _ in more)[r["doc_id"]][r["start"] : r["end"]] == r["value"] for r in got)


def test_secret_scan_of_nothing(empty, clashing):
    assert secrets.scan(empty).count() == 0
    assert secrets.scan(clashing).count() >= 0


# --- 10
def pages(spark):
    html = '<html lang="en"><head><title>A &amp; B</title><style>p{}</style></head><body><p>One<!-- no --> <b>two</b><br>three &lt;3&gt;</p><a class=x href="/l">link</a></body></html>'
    return spark.createDataFrame([(1, "http://a/", html), (2, None, None), (3, "http://c/", ""), (1, "http://a/", html)], "page_id long, url string, html string")


def base32(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def test_warc_records(spark):
    got = warc.derivatives(pages(spark)).collect()
    assert len(got) == 12
    one = {r["record_type"]: r for r in got if r["page_id"] == 1}
    assert one["conversion"]["block"] == "One two\nthree <3>\nlink"
    assert "title: A & B\r\n" in one["metadata"]["block"] and "outlink: /l\r\n" in one["metadata"]["block"]
    assert one["conversion"]["refers_to"] == one["metadata"]["refers_to"] == one["response"]["record_id"]
    for r in got:
        assert r["block_digest"] == base32(r["block"].encode()) and r["content_length"] == len(r["block"].encode())
        assert f"WARC-Payload-Digest: {r['payload']}" in r["header"]
    assert [r["block"] for r in got if r["page_id"] == 2 and r["record_type"] == "conversion"] == [""]


def test_warc_files_and_source_headers(spark, tmp_path):
    from pyspark.sql import functions as F

    table = pages(spark).withColumn("headers", F.lit("HTTP/1.1 200 OK\r\nX: y\r\n\r\n"))
    warc.write_warc(table.coalesce(1), str(tmp_path / "out"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "out").glob("part-*"))
    n = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        if b"WARC-Type: response" in head:
            assert rest[:size].startswith(b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n")
        assert rest[size : size + 4] == b"\r\n\r\n"
        data, n = rest[size + 4 :], n + 1
    assert n == 12


# --- pipeline
def test_pipeline_decisions(spark, texts):
    import corpus_pipeline
    from voxloom.session import read_table

    docs, stages = read_table(spark, SF, "documents"), dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    columns = docs.columns
    good = stages["quality rules"](spark, docs, SF)
    assert good.columns == columns and not any(brute.statistics(r["text"])[5] for r in good.collect())
    lined = stages["line dedup"](spark, good, SF)
    want = brute.line_dedup({r["doc_id"]: r["text"] for r in good.collect()})
    assert lined.columns == columns and {r["doc_id"]: brute.sha(r["text"]) for r in lined.collect()} == {d: s for d, (_, n, s) in want.items() if not n or s != brute.sha("")}
    single = stages["near duplicates"](spark, lined, SF)
    have = {r["doc_id"]: r["text"] for r in lined.collect()}
    assert {r["doc_id"] for r in single.collect()} == {d for d, (_, c) in brute.classes(have).items() if d == c}
    clean = stages["decontamination"](spark, single, SF)
    items = {r["item_id"]: r["text"] for r in read_table(spark, SF, "benchmark").collect()}
    left = {r["doc_id"]: r["text"] for r in single.collect()}
    assert {r["doc_id"] for r in clean.collect()} == {d for d, x in brute.contaminated(left, items).items() if not x[4]}
    final = stages["packing"](spark, clean, SF).collect()
    check_packing(final, {r["doc_id"]: r["text"] for r in clean.collect()}, 2048)
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(final)
