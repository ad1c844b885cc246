"""Small configuration tables: bucket ranges and the list of features."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Configuration is written by hand; a table above this size is a mistake, not configuration.
MAX_CONFIG_ROWS = 10_000


class Range(NamedTuple):
    """``start < value <= end`` gives ``code``; the match with the highest ``ord`` wins."""

    ord: int
    feature_code: str
    flag: str
    start: float
    end: float
    code: str
    desc: str


class Feature(NamedTuple):
    """A feature column. ``model_flag``: 0 both models, 1 month only, 2 year only."""

    idx: int
    col_name: str
    pcode: str
    desc: str
    feature_flag: int
    model_flag: int


def _load(df: DataFrame, kind: type, order: str) -> list:
    rows = df.select(*kind._fields).limit(MAX_CONFIG_ROWS + 1).collect()
    if len(rows) > MAX_CONFIG_ROWS:
        raise ValueError(f"more than {MAX_CONFIG_ROWS} configuration rows")
    return sorted((kind(*row) for row in rows), key=lambda r: getattr(r, order))


def load_ranges(df: DataFrame) -> list[Range]:
    return _load(df, Range, "ord")


def load_feature_list(df: DataFrame) -> list[Feature]:
    return _load(df, Feature, "idx")


def active_features(cfg: DataFrame, model: str | None = None) -> DataFrame:
    """Rows of the feature list in use, all or those of the ``month`` or ``year`` model."""
    rows = cfg.where(F.col("feature_flag") == 1)
    if model is None:
        return rows
    return rows.where(F.col("model_flag") != {"month": 2, "year": 1}[model])
