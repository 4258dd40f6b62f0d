"""Small tables of rules and vocabularies, joined by broadcast: their size is that of the rule list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def keyword_lists(spark: SparkSession, lists: Sequence[tuple[str, list[str]]], key: str = "lang") -> DataFrame:
    return spark.createDataFrame(list(lists), f"{key} string, keywords array<string>")


def pair_rules(spark: SparkSession, rules: Sequence[tuple[str, str]], key: str = "lang") -> DataFrame:
    return spark.createDataFrame(list(rules), f"{key} string, part string").groupBy(key).agg(F.collect_list("part").alias("parts"))


def verdict(value: Column, good: float, ok: float, higher_better: bool = False) -> Column:
    """GOOD, OK or BAD by two bounds that belong to the better side."""
    first, second = (value >= good, value >= ok) if higher_better else (value <= good, value <= ok)
    return F.when(first, "GOOD").when(second, "OK").otherwise("BAD")


def canonical_labels(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """rows with label: the first value that is a prefix of the column's or of which it is one; else as it is."""
    spark = rows.sparkSession
    axis = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "pos int, axis_value string")
    a, b = F.lower("axis_value"), F.lower(column)
    found = rows.select(column).distinct().join(F.broadcast(axis), F.startswith(a, b) | F.startswith(b, a)).groupBy(column).agg(F.min_by("axis_value", "pos").alias("axis_value"))
    return rows.join(found, column, "left").withColumn("label", F.coalesce("axis_value", F.col(column))).drop("axis_value")


def resolve_prefixes(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """rows with hits (how many values start with the column's text, whatever the case) and resolved (the value if just one does)."""
    axis = rows.sparkSession.createDataFrame([(v,) for v in values], "axis_value string")
    found = rows.select(column).distinct().join(F.broadcast(axis), F.startswith(F.lower("axis_value"), F.lower(column)), "left")
    per = found.groupBy(column).agg(F.count("axis_value").alias("hits"), F.min("axis_value").alias("one"))
    return rows.join(per, column).withColumn("resolved", F.when(F.col("hits") == 1, F.col("one"))).drop("one")
