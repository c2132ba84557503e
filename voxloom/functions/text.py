"""Transcript text as Spark expressions: normalising, tokenising, names, addresses, durations. No Python at run time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------------------------
#: Punctuation of the three normalisers.
PUNCTUATION = '!()-;:",.?@#$%&*()_[]'
#: Characters that book text loses.
BOOK_PUNCTUATION = "`~!^&()_-[]{}|\\:;'\",./?\x0c‘’“”"
#: Symbols that are spoken, in the order of replacement.
SPOKEN = (
    ("%", " phần trăm "), ("@", " a còng "), ("#", " thăng "), ("+", " cộng "), ("$", " đô la "), (">", " lớn hơn "),
    ("<", " bé hơn "), ("w", " vê kép "),
)
#: Letters of Vietnamese besides a-z, in lower case.
VIETNAMESE = "àáãạảăắằẳẵặâấầẩẫậèéẹẻẽêềếểễệđìíĩỉịòóõọỏôốồổỗộơớờởỡợùúũụủưứừửữựỳỵỷỹý"
#: Addresses.
URL = r"(?:(?:https?|ftp)://)[\w/\-?=%.]+\.[\w/\-&?=%.]+|www\.[\w/\-?=%.]+\.[\w/\-&?=%.]+"
BRACKETED = r"\[[^\[]*\]"
# ------------------------------------------------------------------------------------------------------------------

UNIQUE_PUNCTUATION = "".join(dict.fromkeys(PUNCTUATION))
UNICODE_SPACE = r"(?U)\s+"


def collapse(text: Column) -> Column:
    """Runs of white space, Unicode's included, as one blank."""
    return F.regexp_replace(text, UNICODE_SPACE, " ")


def strip(text: Column) -> Column:
    """Without white space, Unicode's included, at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalize(text: Column) -> Column:
    """The canonical form: unknown markers, apostrophes, punctuation and line ends become blanks; lower case; blanks collapsed."""
    blanked = F.translate(F.regexp_replace(text, "<unk>|'", " "), UNIQUE_PUNCTUATION + "\n", " " * (len(UNIQUE_PUNCTUATION) + 1))
    return F.trim(collapse(F.lower(blanked)))


def normalize_delete(text: Column) -> Column:
    """The labelling form: punctuation goes, lower case, ends stripped, blanks inside kept."""
    return strip(normalize_generator(text))


def normalize_generator(text: Column) -> Column:
    """The generator's form: punctuation goes, lower case, nothing stripped."""
    return F.lower(F.translate(text, UNIQUE_PUNCTUATION, ""))


def strip_brackets(text: Column) -> Column:
    """Captions in square brackets become blanks; a match may run past a closing bracket up to the last before the next opening."""
    return F.regexp_replace(text, BRACKETED, " ")


def lower_strip(text: Column) -> Column:
    return strip(F.lower(text))


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, "(?U)" + URL, " ")


def eliminate(text: Column, characters: str = BOOK_PUNCTUATION) -> Column:
    """Each of the characters becomes a blank."""
    each = "".join(dict.fromkeys(characters))
    return F.translate(text, each, " " * len(each))


def speak_symbols(text: Column) -> Column:
    for symbol, words in SPOKEN:
        text = F.replace(text, F.lit(symbol), F.lit(words))
    return text


def ranges(characters: str) -> str:
    """The inside of a regular expression's class: runs of neighbouring code points, which are matched faster than single ones."""
    points = sorted(map(ord, set(characters)))
    starts = [p for p in points if p - 1 not in points]
    ends = [p for p in points if p + 1 not in points]
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True))


def keep_vietnamese(text: Column) -> Column:
    """All but letters of Vietnamese, ASCII letters, digits and the underscore become blanks.

    A small class is looked at first, so that only the few other characters are held against the long one."""
    return F.regexp_replace(text, f"(?=[^a-z0-9A-Z_ ])[^{ranges(VIETNAMESE + VIETNAMESE.upper())}]", " ")


def collapse_lower(text: Column) -> Column:
    return F.lower(collapse(text))


def tokens(text: Column) -> Column:
    """Words between white space; none for an empty or null text."""
    return F.array_remove(F.split(collapse(F.coalesce(text, F.lit(""))), " "), "")


def token_count(text: Column) -> Column:
    return F.size(tokens(text))


def contributor(file_name: Column) -> Column:
    """(name, id) from ``a_b_<name...>_<id>.ext``."""
    stem = F.regexp_replace(F.element_at(F.split(file_name, "/"), -1), r"\.[^.]*$", "")
    parts = F.split(stem, "_")
    name = F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 3, F.lit(0))), "_")
    return F.struct(name.alias("name"), F.element_at(parts, -1).alias("id"))


def contributor_file(stem: Column, name: Column, number: Column, suffix: str = ".txt") -> Column:
    return F.concat(F.concat_ws("_", stem, name, number), F.lit(suffix))


def channel_handle(url: Column) -> Column:
    """The handle after ``@``, or the last part of a channel address."""
    handle = F.regexp_extract(url, r"/@([^/?#]+)", 1)
    return F.when(handle != "", handle).otherwise(F.regexp_extract(url, r"/([^/?#]+)/?(?:[?#].*)?$", 1))


def query_value(url: Column, name: str) -> Column:
    """A parameter of an address; null where it is missing."""
    got = F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)
    return F.when(got != "", got)


def basename(url: Column) -> Column:
    return F.substring_index(F.regexp_replace(url, r"[?#].*$", ""), "/", -1)


def iso_seconds(duration: Column) -> Column:
    """``P1DT2H3M4.5S`` in seconds; null if it is no such duration."""
    shape = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?$"
    part = lambda k: F.coalesce(F.regexp_extract(duration, shape, k).try_cast("double"), F.lit(0.0))
    return F.when(duration.rlike(shape), part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4))


def caption_text(lines: Column) -> Column:
    """Caption entries as plain text, one line each; lines: array of structs with a ``text``."""
    return F.array_join(F.transform(lines, lambda x: x["text"]), "\n")


def prompt(template: str, *values: Column) -> Column:
    """``template`` with %s for each value."""
    return F.format_string(template, *values)


def after_marker(response: Column, marker: str) -> Column:
    """What stands between the first and the second marker; null where there is none."""
    return F.get(F.split(response, "\\Q" + marker + "\\E", -1), F.lit(1))


def rename_key(key: Column, names: list[tuple[str, str]]) -> Column:
    """A key with each substring of the list replaced, in order."""
    for old, new in names:
        key = F.replace(key, F.lit(old), F.lit(new))
    return key


def metric_text(text: Column) -> Column:
    """The evaluation-time normaliser after :func:`normalize`: bracketed parts and symbols go. An approximation of an
    external library; off by default."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(text), r"[<\[][^>\]]*[>\]]", ""), r"\(([^)]+?)\)", "")
    return collapse(F.regexp_replace(bare, r"[\p{M}\p{S}\p{P}]", " "))


def padded(number: Column, width: int = 9, fixed: bool = False) -> Column:
    """A zero-padded ordinal; longer numbers are left whole. ``fixed``: they keep their first ``width`` digits, as SQL's lpad has it,
    and are no longer told apart."""
    text = number.cast("string")
    return F.lpad(text, width, "0") if fixed else F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def guard(pred: Column, fixed: Column, wer: Column, most: float = 0.2) -> Column:
    """(text, is_changed): a correction counts only with the prediction's length and a word error rate under ``most``."""
    good = (F.char_length(fixed) == F.char_length(pred)) & (wer < most)
    good = F.coalesce(good, F.lit(False))
    return F.struct(F.when(good, fixed).otherwise(pred).alias("text"), good.cast("int").alias("is_changed"))
