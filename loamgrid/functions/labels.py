"""Matching of misspelt class labels."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def closest(col: Column, names: list[str], cutoff: float = 0.8) -> Column:
    """The name most like the label by difflib's ratio, null if none reaches the cutoff. Labels are matched once each."""

    @F.pandas_udf("string")
    def match(labels: pd.Series) -> pd.Series:
        found = {x: next(iter(difflib.get_close_matches(x, names, 1, cutoff)), None) for x in labels.dropna().unique()}
        return labels.map(found, na_action="ignore")

    return match(col)
