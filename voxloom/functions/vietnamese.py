"""Numbers, dates and Roman numerals in Vietnamese words, and the whole chain for book text.

Replacements are functions of what they match, so they run as pandas UDFs on Arrow batches; everything around them is a
Spark expression. Numerals follow public Vietnamese grammar; equality with an external library is not verified.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions import text as T

# --- fixed values -------------------------------------------------------------------------------------------------
DIGIT_WORDS = ("không", "một", "hai", "ba", "bốn", "năm", "sáu", "bảy", "tám", "chín")
GROUP_WORDS = ("", "nghìn", "triệu", "tỷ")
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
NUMBER = re.compile(r"((?:\d+(?:(?:\.| )))*(?:\d+))(,(?:\d+(?:(?:\.|\s)))*(?:\d+))?")
ROMAN_TOKEN = re.compile(r"\s[MDCLVXI]+\s")
DAY_MONTH_YEAR = re.compile(r"\d+\/\d+\/\d+")
MONTH_YEAR = re.compile(r"(((?<!\d)(0?[1-9]))|(1[0-2]))\/(\d+)")
DAY_MONTH = re.compile(r"(\d+\/\d+)")
# ------------------------------------------------------------------------------------------------------------------


def below_thousand(n: int, whole: bool) -> str:
    """Three digits; whole: hundreds are spoken even if there are none."""
    hundreds, tens, ones = n // 100, n // 10 % 10, n % 10
    out = []
    if hundreds or whole:
        out += [DIGIT_WORDS[hundreds], "trăm"]
    if tens > 1:
        out += [DIGIT_WORDS[tens], "mươi"]
        out += [{0: "", 1: "mốt", 4: "tư", 5: "lăm"}.get(ones, DIGIT_WORDS[ones])]
    elif tens == 1:
        out += ["mười", {0: "", 5: "lăm"}.get(ones, DIGIT_WORDS[ones])]
    elif ones:
        out += [*(["lẻ"] if out else []), DIGIT_WORDS[ones]]
    return " ".join(w for w in out if w)


def spell(n: int) -> str:
    """A whole number in words."""
    if n < 0:
        return "âm " + spell(-n)
    if n == 0:
        return DIGIT_WORDS[0]
    if n >= 10**9:
        high, low = divmod(n, 10**9)
        rest = spell_low(low, whole=True) if low else ""
        return " ".join(x for x in (spell(high), GROUP_WORDS[3], rest) if x)
    return spell_low(n, whole=False)


def spell_low(n: int, whole: bool) -> str:
    """Below a thousand million."""
    out, spoken = [], whole
    for k in (2, 1, 0):
        part = n // 1000**k % 1000
        if part:
            out += [below_thousand(part, spoken), GROUP_WORDS[k]]
            spoken = True
    return " ".join(w for w in out if w)


def number_words(digits: str) -> str:
    """A run of digits in words; runs no counting word reaches are read digit by digit."""
    return spell(int(digits)) if len(digits) <= 60 else " ".join(DIGIT_WORDS[int(c)] for c in digits)


def read_number(token: str) -> str:
    """A number token: dots and blanks part thousands, a comma parts two numbers that are read one by one."""
    plain = re.sub(r"\s", "", token.replace(".", ""))
    return " phẩy ".join(number_words(x) for x in plain.split(","))


def roman_value(token: str) -> int:
    """Subtractive reading, letter by letter."""
    values = [ROMAN[c] for c in token.strip().upper()]
    return sum(-v if any(w > v for w in values[k + 1 : k + 2]) else v for k, v in enumerate(values))


def spoken(parts: str, joints: tuple[str, ...]) -> str:
    """``d/m/y`` and the like with words between the numbers."""
    numbers = [number_words(x) for x in parts.split("/")]
    return numbers[0] + "".join(f" {j} {n}" for j, n in zip(joints, numbers[1:], strict=True))


def speak_dates(text: str) -> str:
    if "/" not in text:
        return text
    text = DAY_MONTH_YEAR.sub(lambda m: spoken(m[0], ("tháng", "năm")), text)
    text = MONTH_YEAR.sub(lambda m: spoken(m[0], ("năm",)), text)
    return DAY_MONTH.sub(lambda m: spoken(m[0], ("tháng",)), text)


def speak_numbers(text: str) -> str:
    return NUMBER.sub(lambda m: read_number(m[0]), text)


def speak_romans(text: str) -> str:
    return ROMAN_TOKEN.sub(lambda m: f" {spell(roman_value(m[0]))} ", text)


def over(function, name: str):
    """A pandas UDF of a text function; nulls stay null."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else function(t))

    run.__name__ = name
    return F.pandas_udf(run, "string")


def dates_as_words(text: Column) -> Column:
    return over(speak_dates, "dates_as_words")(text)


def numbers_as_words(text: Column) -> Column:
    return over(speak_numbers, "numbers_as_words")(text)


def romans_as_words(text: Column) -> Column:
    return over(speak_romans, "romans_as_words")(text)


def replace_all(text: Column, characters: str = T.BOOK_PUNCTUATION) -> Column:
    """Book text as it is read aloud. The order matters: addresses, dates, line ends, numbers, punctuation, symbols,
    Roman numerals, letters, blanks. What lies between the dates and the Roman numerals runs beside them, in one pass through Python."""
    blanks = {ord(c): " " for c in characters}

    def aloud(t: str) -> str:
        t = speak_numbers(speak_dates(t).replace("\n", ";")).translate(blanks)
        for symbol, words in T.SPOKEN:
            t = t.replace(symbol, words)
        return speak_romans(t)

    return T.collapse_lower(T.keep_vietnamese(over(aloud, "read_aloud")(T.strip_urls(text))))
