"""From feature values to codes, slots, one-hot positions and back to labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscore.functions import category_value
from payscore.shared import Stored, lookup_each, numbered, split_by, store
from payscore.sources.config import Feature

SEPARATOR = "_"


def portrait(
    df: DataFrame, catalog: Stored, features: Sequence[Feature], out: str = "features", slots: str | None = None
) -> DataFrame:
    """Add the sorted codes of the row's feature values, joined by ``_``.

    One lookup per feature, with no regrouping of rows; a value without a code adds nothing.
    ``slots`` names an array to add: the code of each feature in its own place, null where the
    value has none. Models count codes by slot, so they take this array, not the text.
    """
    names, dims = [f"_code_{i}" for i in range(len(features))], []
    parts = split_by(catalog, "feature_pcode", [f.pcode for f in features])
    for i, (f, part) in enumerate(zip(features, parts)):
        codes = part.select(F.col("feature_value").alias(f"_v_{i}"), F.col("feature_code").alias(names[i]))
        dims.append((codes, [(category_value(F.col(f.col_name)), f"_v_{i}")]))
    df = lookup_each(df, dims)
    if slots:
        df = df.withColumn(slots, F.array(*names))
    return df.withColumn(out, F.array_join(F.array_sort(F.array(*names)), SEPARATOR)).drop(*names)


def _fits(codes: Column, n: int) -> Column:
    """The codes, or a failure where a row has more of them than there are slots."""
    return F.when(F.size(codes) > n, F.raise_error(F.lit(f"a row has more than {n} codes"))).otherwise(codes)


def code_array(features: Column) -> Column:
    return F.array_sort(F.split(features, SEPARATOR))


def slot_names(n: int) -> list[str]:
    return [f"FEATURE{i}" for i in range(1, n + 1)]


def explode_slots(df: DataFrame, n: int, column: str = "features") -> DataFrame:
    """Spread the sorted codes over columns ``feature1..n``; null where a row has fewer, a failure where it has more."""
    codes = _fits(code_array(F.col(column)), n)
    return df.withColumns({f"feature{i}": F.get(codes, F.lit(i - 1)) for i in range(1, n + 1)})


def slot_entries(slots: Sequence[str], codes: str = "codes", head: bool = False) -> Column:
    """The row's (slot, code) pairs as an array; ``head`` puts an empty pair first, for totals.

    Fails on a row with more codes than slots.
    """
    # One place that looks at the number of codes is enough.
    array = [_fits(F.col(codes), len(slots)), *[F.col(codes)] * (len(slots) - 1)]
    pairs = [F.struct(F.lit(s).alias("slot"), F.get(array[i], F.lit(i)).alias("code")) for i, s in enumerate(slots)]
    first = [F.struct(F.lit("").alias("slot"), F.lit("").alias("code"))] if head else []
    return F.array(*first, *pairs)


def index_slots(df: DataFrame, slots: Sequence[str], codes: str = "codes") -> Stored:
    """Positions of the codes of each slot, the most frequent first, ties by code.

    Columns: slot, code, cnt, idx (0-based in the slot), width (codes in the slot), pos (in the
    whole vector, slots one after the other).
    """
    pairs = df.select(F.inline(slot_entries(slots, codes))).where(F.col("code").isNotNull())
    counted = pairs.groupBy("slot", "code").agg(F.count(F.lit(1)).alias("cnt"))
    levels = store(counted)
    widths = {r["slot"]: r["count"] for r in levels.df.groupBy("slot").count().collect()}
    before, start = {}, 0
    for s in slots:
        before[s] = start
        start += widths.get(s, 0)

    def per_slot(numbers: dict[str, int]) -> Column:
        return F.coalesce(*[F.when(F.col("slot") == s, F.lit(numbers.get(s, 0))) for s in slots])

    idx = F.col("rn") - 1
    ranked = numbered(levels, "slot", [F.desc("cnt"), F.asc("code")], "rn")
    return store(
        ranked.select(
            "slot", "code", "cnt", idx.cast("int").alias("idx"),
            per_slot(widths).cast("int").alias("width"),
            (per_slot(before) + idx).cast("int").alias("pos"),
        )
    )


def build_dictionary(index: Stored) -> DataFrame:
    """The saved form of the encoding, all text: slot, code, ``"1"``, slot width, index in the slot."""
    return index.df.select(
        F.col("slot").alias("feature_code"),
        F.col("code").alias("feature_col_name"),
        F.lit("1").alias("feature_value"),
        F.col("width").cast("string").alias("feature_vector_cnt"),
        F.col("idx").cast("string").alias("feature_vector_index"),
    ).distinct()


def load_dictionary(dictionary: DataFrame, slots: Sequence[str]) -> Stored:
    """Back from the saved form to positions."""
    rows = dictionary.select(
        F.col("feature_code").alias("slot"),
        F.col("feature_col_name").alias("code"),
        F.col("feature_vector_cnt").cast("int").alias("width"),
        F.col("feature_vector_index").cast("int").alias("idx"),
    )
    widths = {r["slot"]: r["w"] for r in rows.groupBy("slot").agg(F.max("width").alias("w")).collect()}
    pos, start = F.lit(None).cast("int"), 0
    for s in slots:
        pos = F.when(F.col("slot") == s, F.lit(start) + F.col("idx")).otherwise(pos)
        start += widths.get(s, 0)
    return store(rows.withColumn("pos", pos))


def encode(
    df: DataFrame, index: Stored, slots: Sequence[str], codes: str = "codes", out: str = "active"
) -> DataFrame:
    """Add the positions of the row's ones in the one-hot vector, ascending.

    The vector's length is fixed by ``index``. A code counts only in its own slot, and an
    unknown code sets no position.
    """
    names, dims = [f"_pos_{i}" for i in range(len(slots))], []
    for i, part in enumerate(split_by(index, "slot", slots)):
        table = part.select(F.col("code").alias(f"_c_{i}"), F.col("pos").alias(names[i]))
        array = F.col(codes) if i else _fits(F.col(codes), len(slots))
        dims.append((table, [(F.get(array, F.lit(i)), f"_c_{i}")]))
    df = lookup_each(df, dims)
    return df.withColumn(out, F.array_compact(F.array(*names))).drop(*names)


def encode_with_dictionary(
    df: DataFrame, dictionary: DataFrame, slots: Sequence[str], codes: str = "codes", out: str = "active"
) -> DataFrame:
    """Encode new rows with a saved dictionary."""
    return encode(df, load_dictionary(dictionary, slots), slots, codes, out)


def dense_vector(active: Column, size: int) -> Column:
    """The one-hot vector itself, for use with ``pyspark.ml.functions.array_to_vector``."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.array_contains(active, i).cast("double")
    )
