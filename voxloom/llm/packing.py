"""Best-fit packing by the sum-of-squares rule (operator 3).

A document is its token ids and then ``END``; only longer ones than ``SEQUENCE`` are cut, all pieces but the first being
full. A piece goes where the sum, over residual gaps, of the squared number of open sequences with that gap becomes
smallest; ties go to the smallest gap. Pieces come longest first, and a sequence is opened only where no open one has room.

Tokens are made once, in Arrow batches, and leave as lengths and checksums. Full pieces are sequences of their own. The
others are dealt by a hash into groups of about ``GROUP`` pieces; groups are packed apart, so that memory and time of a task
are bounded and each group leaves about one sequence with room.

The ids are those of the ``tokenizers`` file whose path is a parameter. They are computed by ``tiktoken`` over the vocabulary
read from that file, which gives equal ids (a test holds one against the other) about three times as fast. Texts that hold
the string of one of the file's added tokens go to ``tokenizers`` itself, with the file's own settings, and so get its id.

Defined cases: a null or empty text is the single id ``END``; repeated rows are packed each; an empty table packs nothing;
further columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import Scratch
from voxloom.session import read_table, spread

SEQUENCE, END, GROUP = 2048, 0, 4000
#: Fixed: how byte-level BPE of this vocabulary cuts a text before merging.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizer() -> str:
    """Where the public 50k byte-level vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """Text -> ids, with the vocabulary of a byte-level BPE file of ``tokenizers``; added tokens are ordinary text."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    special = {x["content"] for x in told.get("added_tokens", ())}
    byte = byte_letters()
    ranks = {bytes(byte[c] for c in word): k for word, k in told["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding("own", pat_str=CUT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@lru_cache(maxsize=2)
def whole_encoder(path: str):
    """Text -> the ids of ``Tokenizer.encode(text, add_special_tokens=False)``, added tokens in the text included."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        added = [x["content"] for x in json.load(f).get("added_tokens", ())]
    plain, library = encoder(path), Tokenizer.from_file(path)

    def encode(text: str) -> list[int]:
        if any(a in text for a in added):
            return library.encode(text, add_special_tokens=False).ids
        return plain(text)

    return encode


def cut(n: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all full but perhaps the first."""
    first = (n - 1) % size + 1
    return [(0, first), *((s, size) for s in range(first, n, size))]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """One row for each piece of each document, without its ids."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = whole_encoder(path)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), END], dtype="<u4")
                out += ((doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), size)))
            columns = [list(c) for c in zip(*out, strict=True)] if out else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def sum_of_squares(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, in the order given: see the module's text for the rule."""
    count = np.zeros(size + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]
    used: list[int] = []
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, n in enumerate(lengths.tolist()):
        at = 0
        fits = np.flatnonzero(count[n:])
        if len(fits):
            after = count[fits]
            after[fits == 0] = 0
            gain = after - count[fits + n] + (fits > 0)
            gap = int(fits[int(gain.argmin())]) + n
            at = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, at = size, len(used)
            used.append(0)
        where[k], offset[k] = at, used[at]
        used[at] += n
        if gap > n:
            open_bins[gap - n].append(at)
            count[gap - n] += 1
    return where, offset


def packed(rows: DataFrame, size: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """``rows`` of pieces with sequence_id and offset."""
    short = rows.where(F.col("length") < size)
    groups = max(1, -(-short.count() // group))
    dealt = short.withColumn("_g", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True])
        where, offset = sum_of_squares(part["length"].to_numpy(), size)
        return part.drop(columns="_g").assign(sequence_id=where * groups + key[0], offset=offset)

    some = dealt.groupBy("_g").applyInPandas(pack, f"{PIECES}, sequence_id long, offset long")
    whole = rows.where(F.col("length") >= size)
    alone = whole.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return some.unionByName(alone)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over all ``documents``."""
    rows = Scratch.write(pieces(spread(read_table(spark, sf_dir, "documents"))), "pieces")
    return packed(rows)
