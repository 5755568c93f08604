"""Code glossaries as small dimension tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def describe_codes(df: DataFrame, code: str, names: Mapping[str, str], target: str) -> DataFrame:
    """Left lookup of a description; unknown codes get null. The glossary is a fixed handful of rows."""
    glossary = df.sparkSession.createDataFrame(list(names.items()), f"`{code}` string, `{target}` string")
    return df.join(F.broadcast(glossary), code, "left")
