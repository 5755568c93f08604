"""Derived model columns: pairwise products and dummies."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F


def interactions(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The features and the products of every two different ones (no squares)."""
    products = [(F.col(a) * F.col(b)).alias(f"{a}__x__{b}") for a, b in combinations(features, 2)]
    return df.select(*keep, *features, *products)


def interaction_names(features: Sequence[str]) -> list[str]:
    return [*features, *[f"{a}__x__{b}" for a, b in combinations(features, 2)]]


def one_hot(value: Column, levels: Sequence, prefix: str) -> list[Column]:
    """0/1 columns for all levels but the first; a null value gives zeros."""
    return [
        F.coalesce(value == F.lit(level), F.lit(False)).cast("int").alias(f"{prefix}{level}")
        for level in list(levels)[1:]
    ]
