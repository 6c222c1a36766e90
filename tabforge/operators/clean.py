"""Cleaning rules and row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabforge.operators.profile import long_rows, quoted


def null_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column, the only missing marker used here."""
    out = []
    for f in df.schema.fields:
        c = F.col(quoted(f.name))
        if f.dataType.typeName() in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def clean_sentinels(df: DataFrame, rules: dict[str, float]) -> DataFrame:
    """Overwrite a sentinel value by NULL, per column."""
    return df.select(
        *[
            F.when(F.col(quoted(c)) != F.lit(rules[c]), F.col(quoted(c))).alias(c) if c in rules else F.col(quoted(c))
            for c in df.columns
        ]
    )


def sentinel_report(df: DataFrame, rules: dict[str, float]) -> DataFrame:
    cols = list(rules)
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(quoted(c)) == F.lit(rules[c])).alias(f"{i}_h") for i, c in enumerate(cols)],
    )
    return long_rows(wide, cols, {"hits": "h"}).select(
        "feature", "hits", (F.col("hits") * 100.0 / F.col("total")).alias("hit_pct")
    )


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with at most one distinct value: min equals max, so no distinct set is built."""
    wide = df.agg(
        *[e for i, c in enumerate(columns) for e in (F.min(quoted(c)).alias(f"{i}_lo"), F.max(quoted(c)).alias(f"{i}_hi"))]
    )
    structs = [
        F.struct(
            F.lit(c).alias("feature"), F.coalesce(F.col(f"{i}_lo") == F.col(f"{i}_hi"), F.lit(True)).cast("int").alias("is_constant")
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def keep_top_classes(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows of the k most frequent classes; ties by class name."""
    top = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col(column))
        .limit(k)
        .select(column)
    )
    return df.join(F.broadcast(top), column, "left_semi")


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna("any", subset=list(columns))
