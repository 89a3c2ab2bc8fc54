"""Pluggable user code: scorers, detectors and provenance chains."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import numbered, previous


def score(df: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Add the scorer's columns to every row; it sees one Arrow batch at a time."""
    full = T.StructType([*df.schema.fields, *T.StructType.fromDDL(schema).fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.concat([pdf.reset_index(drop=True), scorer(pdf).reset_index(drop=True)], axis=1)

    return df.mapInPandas(run, full)


def detect(df: DataFrame, detector: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Zero, one or many figures per input row, as the detector returns them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield detector(pdf)

    return df.mapInPandas(run, schema)


def provenance(df: DataFrame, key: str, seq: str, file: str) -> DataFrame:
    """Every file with the one it came from and its depth in the chain of its key.

    The chain is kept as links, whole at any length, instead of an array that
    would have to gather a key in one place.
    """
    linked = previous(df, [key], seq, {"prior": F.col(file)})
    return numbered(linked, [key], seq, "depth")
