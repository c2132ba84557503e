"""Normalisers, numbers, names and error rates on small literals."""

import random

import pytest
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.functions import vietnamese as V
from voxloom.functions.wer import utterance_wer, word_edits, word_edits_array


def one(spark, value, *columns):
    df = spark.createDataFrame([(value,)], "x string")
    row = df.select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


@pytest.mark.parametrize("text,space,delete,generator", [
    ("A, b!", "a b", "a b", "a b"),
    ("  A--b <unk> it's\n(x) ", "a b it s x", "ab <unk> it's\nx", "  ab <unk> it's\nx "),
    ("a  b", "a b", "a  b", "a  b"),
    ("", "", "", ""),
])
def test_normalisers(spark, text, space, delete, generator):
    x = F.col("x")
    assert one(spark, text, T.normalize(x), T.normalize_delete(x), T.normalize_generator(x)) == (space, delete, generator)


def test_nulls_stay_null(spark):
    x = F.col("x")
    assert one(spark, None, T.normalize(x), T.strip_urls(x), V.replace_all(x)) == (None, None, None)
    assert one(spark, None, T.tokens(x)) == []


def test_brackets_may_span(spark):
    assert one(spark, "a [x] b] c [y", T.strip_brackets(F.col("x"))) == "a   c [y"


def test_urls(spark):
    assert one(spark, "see http://a.b/c?d=1 and www.x.yz ok", T.strip_urls(F.col("x"))) == "see   and   ok"


def test_symbols_letters_and_blanks(spark):
    assert one(spark, "5% w", T.collapse_lower(T.speak_symbols(F.col("x")))) == "5 phần trăm vê kép "
    assert one(spark, "Đi ß x?", T.keep_vietnamese(F.col("x"))) == "Đi   x "
    assert one(spark, "a`b“c\x0cd", T.eliminate(F.col("x"))) == "a b c d"


def test_names_and_addresses(spark):
    x = F.col("x")
    assert tuple(one(spark, "q/a_b_Le_Van_17.txt", T.contributor(x))) == ("Le_Van", "17")
    assert one(spark, "https://y.example/@chan/videos?v=1&k=2", T.channel_handle(x), T.query_value(x, "k"), T.query_value(x, "z"), T.basename(x)) == ("chan", "2", None, "videos")
    assert one(spark, "PT1H2M3.5S", T.iso_seconds(x)) == 3723.5
    assert one(spark, "1h", T.iso_seconds(x)) is None
    assert one(spark, "12", T.padded(x.cast("long"), 5)) == "00012"
    assert one(spark, "a##b##c", T.after_marker(x, "##")) == "b"


@pytest.mark.parametrize("n,words", [
    (0, "không"), (5, "năm"), (10, "mười"), (15, "mười lăm"), (21, "hai mươi mốt"), (24, "hai mươi tư"), (105, "một trăm lẻ năm"),
    (1000, "một nghìn"), (2020, "hai nghìn không trăm hai mươi"), (1_000_000, "một triệu"), (2 * 10**9, "hai tỷ"),
])
def test_spelling(n, words):
    assert V.spell(n) == words


@pytest.mark.parametrize("text,words", [
    ("007", "bảy"), ("1.234", V.spell(1234)), ("1 2 3", V.spell(123)), ("3,05", "ba phẩy năm"), ("9" * 5000, " ".join(["chín"] * 5000)),
])
def test_number_tokens(text, words):
    assert V.speak_numbers(text) == words


def test_dates_in_order():
    assert V.speak_dates("12/05/2020") == f"{V.spell(12)} tháng năm năm {V.spell(2020)}"
    assert V.speak_dates("5/2020") == f"năm năm {V.spell(2020)}"
    assert V.speak_dates("31/12") == f"{V.spell(31)} tháng {V.spell(12)}"


def test_romans():
    assert V.speak_romans(" XIV ") == " mười bốn "
    assert V.speak_romans(" I II ") == " một II "


def test_whole_chain(spark):
    assert one(spark, "Xem www.a.bc\nngày 5/2020: 10%!", V.replace_all(F.col("x"))) == "xem ngày năm năm hai nghìn không trăm hai mươi mười phần trăm "


def plain_edits(r, h):
    d = list(range(len(h) + 1))
    for i, w in enumerate(r, 1):
        last, d[0] = d[0], i
        for j, v in enumerate(h, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (w != v))
    return d[-1]


def test_word_edits(spark):
    rng = random.Random(2)
    rows = [([], []), (["a"], []), ([], ["a", "b"]), (["a", "b"], ["c", "d"])]
    rows += [([rng.choice("abcdé") for _ in range(rng.randint(0, 9))], [rng.choice("abcdé") for _ in range(rng.randint(0, 9))]) for _ in range(40)]
    df = spark.createDataFrame(rows, "r array<string>, h array<string>")
    for got in df.select("r", "h", word_edits(F.col("r"), F.col("h")).alias("a"), word_edits_array(F.col("r"), F.col("h")).alias("b")).collect():
        assert got["a"] == got["b"] == plain_edits(got["r"], got["h"])


def test_rates(spark):
    df = spark.createDataFrame([("a b c d", "a x c"), ("", "a"), ("a", "")], "r string, h string")
    assert [r[0] for r in df.select(utterance_wer(F.col("r"), F.col("h"))).collect()] == [50.0, None, 100.0]
    guard = df.select(T.guard(F.lit("ab"), F.lit("AB"), F.lit(0.1))["text"], T.guard(F.lit("ab"), F.lit("abc"), F.lit(0.1))["is_changed"], T.guard(F.lit("ab"), F.lit("AB"), F.lit(None).cast("double"))["text"])
    assert tuple(guard.first()) == ("AB", 0, "ab")
