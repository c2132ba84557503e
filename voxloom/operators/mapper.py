"""Maps with a callable of the user's: model inference, feature preparation, segmentation, language-model correction.

The engine brings no model. A callable takes and returns pandas tables; what is done already is filtered before it runs, as a
join is never moved below a Python map by the optimiser."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.functions.wer import utterance_wer

Table = Callable[[pd.DataFrame], pd.DataFrame]
REGISTRY: dict[str, tuple[Callable[[], Table], str]] = {}


def register(name: str, make: Callable[[], Table], schema: str) -> None:
    """Names a map. ``make`` is called once for each task, where a model is loaded."""
    REGISTRY[name] = (make, schema)


def apply(df: DataFrame, name_or_make: str | Callable[[], Table], schema: str | None = None, done: DataFrame | None = None, on: list[str] | None = None, batch: int = 64) -> DataFrame:
    """Rows through a map in batches of ``batch``; rows whose key is in ``done`` are left out first."""
    make, out = REGISTRY[name_or_make] if isinstance(name_or_make, str) else (name_or_make, schema)
    if out is None:
        raise ValueError("a map that is not registered needs a schema")
    if done is not None:
        df = df.join(done.select(*on), on, "left_anti")

    def run(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        function = make()
        for table in tables:
            for k in range(0, len(table), batch):
                yield function(table.iloc[k : k + batch])

    return df.mapInPandas(run, out)


def segmented_words(text: Column, segment: Callable[[str], list[str]] | None = None) -> Column:
    """Words of a text by a callable; without one, by white space."""
    if segment is None:
        return T.tokens(text)

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: segment(t or ""))

    return F.pandas_udf(run, "array<string>")(text)


def corrected(df: DataFrame, pred: str, label: str, fixed: str, suffix: str) -> DataFrame:
    """``df`` with the guarded correction, its flag and its error rate, worst first by the caller's sort."""
    chosen = T.guard(F.col(pred), F.col(fixed), utterance_wer(F.col(label), F.col(fixed)) / 100)
    out = df.withColumn("_g", chosen).withColumns({f"pred_with_{suffix}": F.col("_g.text"), f"is_changed_{suffix}": F.col("_g.is_changed")}).drop("_g")
    return out.withColumn(f"wer_{suffix}", utterance_wer(F.col(label), F.col(f"pred_with_{suffix}")))


def padded_batch(df: DataFrame, batch: str, labels: str, fill: int = -100) -> DataFrame:
    """Labels filled up to the longest of their batch."""
    longest = df.groupBy(batch).agg(F.max(F.size(labels)).alias("_n"))
    return df.join(longest, batch).withColumn(labels, F.concat(labels, F.array_repeat(F.lit(fill), F.col("_n") - F.size(labels)))).drop("_n")
