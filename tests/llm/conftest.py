"""Small document tables with the awkward cases in them."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("the of and to in erat onen thing blyt sh ine ou ré ä zoo Qua".split()) + rng.choice(["", "", "x", "y", "zz"]) for _ in range(n))


def corpus() -> list[tuple[int, str | None]]:
    """Texts with copies, near copies, shared lines and passages, blanks, nulls, long words, white space of all kinds."""
    rng = random.Random(5)
    base = words(rng, 120)
    line = "This very Line is shared by many documents\t"
    rows: list[tuple[int, str | None]] = [(0, None), (1, ""), (2, " \n\t\r\x0b\x0c "), (3, "one two"), (4, "one  two"), (5, "x" * 5000)]
    rows += [(10 + k, base) for k in range(4)]
    near = base.split()
    for k in range(6):
        changed = near[:]
        changed[5 + 9 * k] = "changed"
        rows.append((20 + k, " ".join(changed)))
    rows += [(30 + k, f"{words(rng, 40)}\n  {line.upper() if k % 2 else line}\n{words(rng, 30)}\n{line}") for k in range(5)]
    rows += [(40 + k, words(rng, rng.randint(1, 300))) for k in range(12)]
    rows += [(60, "É É one É ONE two\x1cthree"), (61, words(rng, 6000))]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in corpus()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def texts():
    return dict(corpus())


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows with further columns that have names an operator might use."""
    from pyspark.sql import functions as F

    names = "n pos line key h1 h2 row kept rule n_lines n_dropped runs sid token comp block words window_id size shard slot start end value score before piece length label"
    return docs.select("*", *(F.lit(1).alias(c) for c in names.split()))
