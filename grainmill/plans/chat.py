"""Conversations as prompts, responses and arms.

Two arms: conversations 2k and 2k + 1 answer prompt k, as `pipeline` and `plain`."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .registry import table


def first_turns(spark, sf_dir: str, role: str) -> DataFrame:
    """conv_id, prompt_id, arm, text of each conversation's first turn of a role."""
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == role)
    first = turns.groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    return first.select("conv_id", F.floor(F.col("conv_id") / 2).alias("prompt_id"), F.when(F.col("conv_id") % 2 == 0, "pipeline").otherwise("plain").alias("arm"), "text")


def responses(spark, sf_dir: str) -> DataFrame:
    return first_turns(spark, sf_dir, "assistant")


def prompts(spark, sf_dir: str) -> DataFrame:
    return first_turns(spark, sf_dir, "user")


def sql(role: str) -> str:
    """The same as a subquery."""
    return f"(SELECT conv_id, conv_id // 2 AS prompt_id, CASE WHEN conv_id % 2 = 0 THEN 'pipeline' ELSE 'plain' END AS arm, arg_min(text, turn) AS text FROM conversations WHERE role = '{role}' GROUP BY conv_id)"
