"""Cleaning and profiling (stage 1 and helpers): B01-B03, B26, B30."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

# The reference's missing-value tokens and text fill.
NA_TOKENS = ("NA", "")
TEXT_FILL = "<None>"


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in ex]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in ex]


def nan_to_null(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def fill_missing(
    df: DataFrame, numeric_fill: float = 0, text_fill: str = TEXT_FILL, na_tokens: Sequence[str] = NA_TOKENS,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Numeric NULL/NaN -> ``numeric_fill``; text NULL or a NA token -> ``text_fill``.

    One projection over the whole schema; other types pass through.
    """
    ex = set(exclude)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in ex:
            cols.append(c)
        elif is_numeric(f.dataType):
            cols.append(F.coalesce(nan_to_null(c, f.dataType), F.lit(numeric_fill).cast(f.dataType)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            missing = c.isNull() | c.isin(*na_tokens)
            cols.append(F.when(missing, F.lit(text_fill)).otherwise(c).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def column_profile(df: DataFrame, max_unique: int = 15, exact: bool = True) -> DataFrame:
    """Per column its type class, distinct count and (when small) the sorted distinct values.

    Pass 1 counts distinct values of every column in one aggregate (``exact=False``
    uses HyperLogLog sketches, cheaper at scale).  Pass 2 collects the value sets
    only for columns with at most ``max_unique`` values, so every buffer is bounded.
    Output: ``column, type, n_unique, unique_values`` (values joined by ``", "``).
    """
    fields = list(df.schema.fields)
    cnt = F.count_distinct if exact else F.approx_count_distinct
    counts = df.agg(*[cnt(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)]).first()
    small = [i for i, f in enumerate(fields) if counts[f"c{i}"] <= max_unique]
    values = {}
    if small:
        row = df.agg(
            *[F.sort_array(F.collect_set(F.col(f"`{fields[i].name}`"))).cast("array<string>").alias(f"v{i}") for i in small]
        ).first()
        values = {i: row[f"v{i}"] for i in small}
    rows = []
    for i, f in enumerate(fields):
        n = int(counts[f"c{i}"])
        if is_numeric(f.dataType):
            kind = "numeric (discrete)" if n <= max_unique else "numeric (continuous)"
        else:
            kind = "categorical"
        vals = ", ".join(values[i]) if i in values else f"{n} unique values"
        rows.append((f.name, kind, n, vals))
    schema = "column string, type string, n_unique long, unique_values string"
    return df.sparkSession.createDataFrame(rows, schema)


def remove_outliers(df: DataFrame, condition: Column, train_flag: str | None = "is_train") -> DataFrame:
    """Drop rows matching ``condition`` from the training part only.

    NULL comparisons count as False (pandas NaN semantics).
    """
    hit = F.coalesce(condition, F.lit(False))
    if train_flag:
        hit = hit & F.col(train_flag)
    return df.where(~hit)


def coerce_numeric(df: DataFrame, cols: Iterable[str], to: str = "double") -> DataFrame:
    """Invalid text -> NULL instead of an error (``pd.to_numeric(errors='coerce')``)."""
    cols = set(cols)
    return df.select(
        *[F.expr(f"try_cast(`{c}` AS {to})").alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns]
    )


def coerce_timestamp(df: DataFrame, cols: Iterable[str], fmt: str | None = None) -> DataFrame:
    """Text -> timestamp, unparsable -> NULL."""
    cols = set(cols)

    def conv(c: str) -> Column:
        col = F.col(f"`{c}`").cast("string")
        return (F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)).alias(c)

    return df.select(*[conv(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def keep_numeric(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop every non-numeric column (except ``keep``) before modelling."""
    keep = set(keep)
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if is_numeric(f.dataType) or f.name in keep])
