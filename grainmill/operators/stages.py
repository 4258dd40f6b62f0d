"""Stages that send rows to a model: pending rows only, accepted rows and failures apart, answers kept by key.

A client is any object with complete(prompt) -> (text, stop_reason); only an offline stub is part of this library. Spark
may run a task again, so answers are written by key before they are read: a second run finds them and asks nothing."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .lineage import pending


class StubClient:
    """A deterministic answer from the prompt's digest; every `fail_every`-th digest is cut off."""

    def __init__(self, fail_every: int = 0, tag: str = "document"):
        self.fail_every, self.tag = fail_every, tag

    def complete(self, prompt: str) -> tuple[str, str]:
        h = int(hashlib.md5(prompt.encode()).hexdigest()[:8], 16)
        if self.fail_every and h % self.fail_every == 0:
            return f"<{self.tag}>cut", "max_tokens"
        return f"<{self.tag}>answer {h}</{self.tag}>", "end_turn"


def call(prompts: DataFrame, key: str, client, prompt: str = "prompt", tasks: int = 4) -> DataFrame:
    """key, raw, stop_reason."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, *client.complete(p)) for k, p in zip(batch[key], batch[prompt])]
            yield pd.DataFrame(rows, columns=[key, "raw", "stop_reason"])

    kind = prompts.schema[key].dataType.simpleString()
    return prompts.select(key, prompt).repartition(tasks, key).mapInPandas(work, f"{key} {kind}, raw string, stop_reason string")


def run(prompts: DataFrame, key: str, client, store: str, parse: Callable[[Column], Column], prompt: str = "prompt") -> tuple[DataFrame, DataFrame, int]:
    """(accepted, failures, calls): rows that the stored answers don't cover are asked and appended; an answer is accepted
    if it ended by itself and parses. Failures aren't done: another run asks them again."""
    from ..sources.files import exists

    spark = prompts.sparkSession
    schema = f"{key} {prompts.schema[key].dataType.simpleString()}, raw string, stop_reason string"
    done = spark.read.schema(schema).parquet(store) if exists(spark, store) else spark.createDataFrame([], schema)
    parsed = lambda rows: rows.withColumn("parsed", F.when(F.col("stop_reason") == "end_turn", parse(F.col("raw"))))
    asked = pending(prompts, [parsed(done).where("parsed is not null")], [key])
    calls = asked.count()
    if calls:
        call(asked, key, client, prompt).write.mode("append").parquet(store)
    answers = parsed(spark.read.schema(schema).parquet(store)) if exists(spark, store) else parsed(done)
    good = answers.where("parsed is not null").dropDuplicates([key])
    bad = answers.join(good.select(key), key, "left_anti").dropDuplicates([key])
    if calls and good.isEmpty():
        raise RuntimeError("every call of the stage failed")
    return good, bad, calls


def attempts(prompts: DataFrame, key: str, client, store: str, parse, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """run() again for failures, at most so many times; what is left then is rejected."""
    good, bad, calls = run(prompts, key, client, store, parse)
    for _ in range(most - 1):
        if bad.isEmpty():
            break
        good, bad, calls = run(prompts, key, client, store, parse)
    return good, bad
