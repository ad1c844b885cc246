"""Stored intermediate tables and joins that stay safe under skew.

Two things are needed by most operators: a place to cut lineage that outlives a lost
executor, and an equi lookup that broadcasts only tables of known size and otherwise
spreads hot keys over many tasks.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A table is broadcast only when rows * row_bytes is at most this.
BROADCAST_BYTES = 64 << 20
#: A row width that keeps any table from being broadcast.
UNMEASURED = 1 << 40
#: A key is hot when it holds more than 1/HOT_SHARE of the rows, so at most HOT_SHARE keys are.
HOT_SHARE = 1000
#: Number of tasks the rows of one hot key are spread over.
SALTS = 64


@dataclass(frozen=True)
class Stored:
    """A table written to the shared folder, with its exact row count and the mean width of a row."""

    df: DataFrame
    rows: int
    row_bytes: int = 256

    @property
    def broadcastable(self) -> bool:
        return self.rows * self.row_bytes <= BROADCAST_BYTES

    def select(self, *columns: str | Column) -> Stored:
        return replace(self, df=self.df.select(*columns))


# Column types of small tables made here.
_ARROW = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str, row_bytes: int = 4096) -> Stored:
    """A table of a few rows that live in the plan itself."""
    fields = [f.split() for f in schema.split(", ")]
    columns = [pa.array([r[i] for r in rows], _ARROW[kind]) for i, (_, kind) in enumerate(fields)]
    table = pa.table(columns, names=[name for name, _ in fields])
    return Stored(spark.createDataFrame(table), len(rows), row_bytes)


def split_by(table: Stored, column: str, values: Sequence[str]) -> list[Stored]:
    """The parts of ``table`` with each value of ``column``.

    A part of a small table is small; only for a larger one the parts are counted.
    """
    parts = [table.df.where(F.col(column) == v) for v in values]
    if table.broadcastable:
        return [Stored(p, table.rows, table.row_bytes) for p in parts]
    counts = table.df.where(F.col(column).isin(list(values))).groupBy(column).count().collect()
    rows = {r[0]: r[1] for r in counts}
    return [Stored(p, rows.get(v, 0), table.row_bytes) for p, v in zip(parts, values)]


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: the cluster's checkpoint folder, which must be set."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return path.rstrip("/")


#: What a value takes in memory besides its content.
VALUE_BYTES = 16


def _width(column: Column, kind: T.DataType) -> Column:
    """The size of a value in memory, about."""
    if isinstance(kind, T.StringType | T.BinaryType):
        size = F.octet_length(column)
    elif isinstance(kind, T.StructType):
        parts = [_width(column[f"`{f.name}`"] if "." in f.name else column[f.name], f.dataType) for f in kind.fields]
        return sum(parts, F.lit(VALUE_BYTES).cast("long"))
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType):
            size = F.octet_length(F.array_join(column, "", "")) + F.size(column) * VALUE_BYTES
        elif isinstance(kind.elementType, T.StructType | T.ArrayType | T.MapType | T.BinaryType):
            size = F.octet_length(F.to_json(F.struct(column))) + F.size(column) * VALUE_BYTES
        else:
            size = F.size(column) * 8
    elif isinstance(kind, T.MapType):
        size = F.octet_length(F.to_json(column)) + F.size(column) * VALUE_BYTES
    else:
        return F.lit(VALUE_BYTES).cast("long")
    return F.coalesce(size, F.lit(0)).cast("long") + VALUE_BYTES


def store(df: DataFrame, row_bytes: int = 0) -> Stored:
    """Write ``df`` once to the shared folder and read it back.

    The row count and the rows' width are observed by the write itself, so knowing the size costs no
    extra job. ``row_bytes`` is the least width to assume; a caller that will never broadcast the
    table gives ``UNMEASURED`` and saves the measuring.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/payscore-{uuid.uuid4().hex}"
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    if row_bytes < UNMEASURED:
        widths = [_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
        measures.append(F.sum(sum(widths, F.lit(0).cast("long"))).alias("bytes"))
    df.observe(seen, *measures).write.parquet(path)
    got = seen.get
    rows = got["rows"]
    measured = -(-(got.get("bytes") or 0) // max(rows, 1))
    return Stored(spark.read.schema(df.schema).parquet(path), rows, max(row_bytes, measured))


def key_hash(*cols: Column) -> Column:
    return F.xxhash64(*cols)


def hot_hashes(df: DataFrame, keys: Sequence[Column]) -> list[int]:
    """Hashes of the keys that hold a large share of ``df``, at most HOT_SHARE of them.

    The input partitions are put in SALTS groups, and the frequent keys of each group are found
    by sketches of fixed size, so there is no shuffle by key and no task merges the sketches of
    all others. A key frequent overall is frequent in some group. The list only steers where
    rows are sent: a missed or surplus key changes the balance, never the result.
    """
    some = df.select(key_hash(*keys).alias("h"), (F.spark_partition_id() % SALTS).alias("g"))
    top = F.call_function("approx_top_k", F.col("h"), F.lit(HOT_SHARE), F.lit(10 * HOT_SHARE))
    groups = some.groupBy("g").agg(top.alias("top"), F.count(F.lit(1)).alias("n")).collect()
    counts: Counter[int] = Counter()
    for group in groups:
        counts.update({item["item"]: item["count"] for item in group["top"]})
    floor = max(sum(g["n"] for g in groups) / HOT_SHARE, 1)
    return [h for h, n in counts.most_common(HOT_SHARE) if n > floor]


def hot_from_counts(counts: DataFrame, keys: Sequence[str], cnt: str, total: int) -> list[int]:
    """As :func:`hot_hashes`, exact, when a table of rows per key is at hand."""
    hot = counts.where(F.col(cnt) * HOT_SHARE > total)
    return [r[0] for r in hot.select(key_hash(*[F.col(k) for k in keys])).collect()]


def spread(cols: Sequence[str]) -> Column:
    """A salt that is the same on a task retry and spreads even identical rows."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in cols]), F.lit(SALTS)).cast("int")


def _same_types(fact: DataFrame, dim: Stored, on: Sequence[tuple[Column, str]]) -> tuple[list[tuple[Column, str]], Stored]:
    """Both sides' keys in their common type: equal keys of different types have different hashes."""
    same, table = [], dim.df
    for key, name in on:
        ours, theirs = fact.select(key).schema[0].dataType, table.schema[name].dataType
        if ours != theirs:
            kind = fact.select(F.array(key, F.lit(None).cast(theirs))).schema[0].dataType.elementType
            key, table = key.cast(kind), table.withColumn(name, F.col(name).cast(kind))
        same.append((key, name))
    return same, replace(dim, df=table)


def _join(
    fact: DataFrame, dim: Stored, on: Sequence[tuple[Column, str]], how: str, hot: Sequence[int] | None
) -> DataFrame:
    on, dim = _same_types(fact, dim, on)
    keys, names = [k for k, _ in on], [n for _, n in on]
    cond = [k == F.col(n) for k, n in on]
    if dim.broadcastable:
        return fact.join(F.broadcast(dim.df), cond, how)

    if hot is None:
        hot = hot_hashes(fact, keys)
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | key.isNull()
    is_hot = key_hash(*keys).isin(list(hot)) if hot else F.lit(False)
    salted = fact.withColumn("_salt", F.when(is_hot | no_key, spread(fact.columns)).otherwise(F.lit(0)))

    dim_hot = key_hash(*[F.col(n) for n in names]).isin(list(hot)) if hot else F.lit(False)
    copies = F.when(dim_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    table = dim.df.withColumn("_copy", F.explode(copies))
    cond.append(F.col("_salt") == F.col("_copy"))
    return salted.join(table, cond, how).drop("_salt", "_copy")


def lookup(
    fact: DataFrame,
    dim: Stored,
    on: Mapping[str, str],
    how: str = "left",
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Equi join of ``fact`` with ``dim`` on fact column -> dim column.

    Adds dim's other columns. A dim of proven small size is broadcast. Any other is joined by
    a shuffle in which only the hot keys are salted: their few dim rows are copied to every
    salt, so no task gets a hot key whole, and rows with a null key are spread the same way.
    """
    names = {d: f"_on_{i}" for i, d in enumerate(on.values())}
    table = replace(dim, df=dim.df.withColumnsRenamed(names))
    return _join(fact, table, [(F.col(f), names[d]) for f, d in on.items()], how, hot).drop(*names.values())


def lookup_each(
    fact: DataFrame, dims: Sequence[tuple[Stored, Sequence[tuple[Column, str]]]]
) -> DataFrame:
    """One left :func:`lookup` after the other, on expressions of ``fact``.

    All key columns of the dims must have names of their own; they are dropped at the end.
    """
    for dim, on in dims:
        fact = _join(fact, dim, on, "left", None)
    return fact.drop(*[name for _, on in dims for _, name in on])


def with_total(df: DataFrame, total: DataFrame) -> DataFrame:
    """Add the columns of ``total``, an aggregate without keys and so one row, to every row."""
    one = total.withColumn("_one", F.lit(1))
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one").drop("_one")


#: Up to this many rows one task may number a group; larger tables are numbered by ranges.
WINDOW_ROWS = 1_000_000


def numbered(table: Stored, group: str, order: Sequence[Column], out: str) -> DataFrame:
    """Number the rows of each group from 1 in the given order.

    A large table is cut into sorted ranges, numbered inside each range, and shifted by the
    row counts of the ranges before it, so no task ever holds a whole group.
    """
    if table.rows <= WINDOW_ROWS:
        return table.df.withColumn(out, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    parts = -(-table.rows // WINDOW_ROWS) * 4
    ranged = table.df.repartitionByRange(parts, F.col(group), *order)
    ranged = store(ranged.withColumn("_range", F.spark_partition_id())).df
    inside = Window.partitionBy(group, "_range").orderBy(*order)
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    shift = sizes.select(group, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    return (
        ranged.withColumn("_rn", F.row_number().over(inside))
        .join(shift, [group, "_range"])
        .withColumn(out, (F.col("_rn") + F.col("_shift")).cast("int"))
        .drop("_range", "_rn", "_shift")
    )
