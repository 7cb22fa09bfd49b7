"""How alike two texts are, in [0, 1]."""

from __future__ import annotations

import difflib
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import normalize_definition


# The function travels by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(T.DoubleType())
def _ratcliff(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio; NULL pairs cost nothing, they were decided before."""
    return pd.Series(
        [
            None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio()
            for x, y in zip(a, b)
        ],
        dtype="float64",
    )


def distance_within(a: str, b: str, threshold: float) -> Column:
    """Edit distance of two columns where their similarity may reach ``threshold``, else -1."""
    longest = F.greatest(F.length(a), F.length(b))
    # One more than the share of the length, so that rounding cannot cut a text at the threshold.
    band = F.floor(longest * F.lit(1.0 - threshold)).cast("int") + F.lit(1)
    return F.call_function("levenshtein", F.col(a), F.col(b), band)


def similarity_of_normalized(a: Column, b: Column, method: str = "levenshtein", distance: Column | None = None) -> Column:
    """Similarity of two already normalised texts; only unequal pairs are measured.

    ``distance``: the edit distance where it is known, -1 where it is not.
    """
    undecided = (a != "") & (b != "") & (a != b)
    if method == "ratcliff":
        # A Python UDF sees every row even inside when(): hand it NULLs instead of texts.
        measured = _ratcliff(F.when(undecided, a), F.when(undecided, b))
    elif method == "levenshtein":
        full = F.levenshtein(a, b)
        edits = full if distance is None else F.when(distance >= 0, distance).otherwise(full)
        measured = F.lit(1.0) - edits.cast("double") / F.greatest(
            F.length(a), F.length(b)
        ).cast("double")
    else:
        raise ValueError(f"unknown similarity method {method!r}")
    return (
        F.when(a == b, F.lit(1.0))
        .when((a == "") | (b == ""), F.lit(0.0))
        .otherwise(measured)
    )


def text_similarity(a: str | Column, b: str | Column, method: str = "levenshtein") -> Column:
    return similarity_of_normalized(normalize_definition(a), normalize_definition(b), method)


def definitions_match(
    a: str | Column, b: str | Column, threshold: float = 0.90, method: str = "levenshtein"
) -> Column:
    return text_similarity(a, b, method) >= F.lit(threshold)
