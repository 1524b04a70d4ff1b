"""Standard scaling with the population deviation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scaling_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: its mean and population deviation."""
    wide = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"m_{c}").alias("mean"),
                F.col(f"s_{c}").alias("std"),
            )
            for c in columns
        ]
    )
    return wide.select(F.inline(entries))


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and divisor of each column; a constant column is divided by 1."""
    rows = scaling_table(df, columns).collect()
    return {r["feature"]: (r["mean"], r["std"] or 1.0) for r in rows}


def zscore(
    df: DataFrame, params: Mapping[str, tuple[float, float]], suffix: str = "_z"
) -> DataFrame:
    return df.withColumns(
        {f"{c}{suffix}": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()}
    )


def scaler_stage(
    params: Mapping[str, tuple[float, float]], suffix: str = "_z"
) -> SQLTransformer:
    """The fitted scaling as a pipeline stage, saved along with the model."""
    scaled = ", ".join(
        f"(`{c}` - {float(m)!r}D) / {float(s)!r}D AS `{c}{suffix}`" for c, (m, s) in params.items()
    )
    return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")
