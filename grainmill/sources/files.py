"""Readers and writers of records, templates, principles and settings. Schemas are explicit, never inferred."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import strip


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def load_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An absent file is an empty table, blank lines are skipped, a malformed line is an error."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def save_jsonl(rows: DataFrame, path: str, append: bool = False) -> None:
    """Explicit nulls are written."""
    rows.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def append_and_mark(rows: DataFrame, path: str, marks: str, key: str) -> DataFrame:
    """Append those rows whose key isn't marked yet, and mark them once they are written; what is returned was appended. A run
    that dies in between appends some rows again, but never marks one that isn't there: readers take the last row of a key."""
    from .store import written

    spark = rows.sparkSession
    kind = f"{key} {rows.schema[key].dataType.simpleString()}"
    done = load_jsonl(spark, marks, kind)
    fresh = written(rows.join(done, key, "left_anti"), "fresh")
    save_jsonl(fresh, path, append=True)
    save_jsonl(fresh.select(key).distinct(), marks, append=True)
    return fresh


def sections(rows: DataFrame, text: str = "text", keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """keys, pos, title, body of each `## ` section; one without a line of body is dropped."""
    parts = F.split(F.concat(F.lit("\n"), F.col(text)), "\n## ")
    cut = rows.select(*keys, F.posexplode(F.slice(parts, F.lit(2), F.size(parts))).alias("pos", "part"))
    title, body = F.substring_index("part", "\n", 1), F.when(F.contains("part", F.lit("\n")), strip(F.regexp_replace("part", r"^[^\n]*\n", ""))).otherwise("")
    return cut.select(*keys, F.col("pos").cast("long").alias("pos"), title.alias("title"), body.alias("body")).where("body <> ''")


def render_principles(rows: DataFrame) -> DataFrame:
    """One text of numbered principles with their application and quoted excerpt; old column names are read too."""
    has = lambda *names: F.coalesce(*[F.col(n) for n in names if n in rows.columns], F.lit(""))
    head = F.concat(F.col("number").cast("string"), F.lit(". "), F.col("principle"))
    block = F.concat_ws("\n", head, F.nullif(has("welfare_application", "constitution_summary"), F.lit("")), F.when(has("constitution_excerpts") != "", F.concat(F.lit('"'), has("constitution_excerpts"), F.lit('"'))))
    return rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", block.alias("b")))), lambda x: x["b"]), "\n\n").alias("block"))


def newest(runs: DataFrame, explicit: str | None = None) -> DataFrame:
    """The run that is named, or the newest by its time stamp."""
    if explicit:
        return runs.where(F.col("run_id") == explicit)
    return runs.where(F.col("run_id").rlike(r"^\d{4}-\d{2}-\d{2}_\d{2}-\d{2}_")).agg(F.max("run_id").alias("run_id"))


def run_id(taken: set[str], stamp: str, label: str) -> str:
    """stamp_label, with -2, -3 .. where it is taken."""
    base = f"{stamp}_{re.sub(r'[^A-Za-z0-9-]+', '-', label).strip('-')}"
    return next(x for x in [base, *(f"{base}-{k}" for k in range(2, len(taken) + 3))] if x not in taken)


def cached(cache: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) of an embedding cache by the digest of model, NUL and text; each text once."""
    key = F.sha2(F.concat("model", F.lit("\x00"), "text"), 256)
    asked = wanted.withColumn("key", key).dropDuplicates(["key"])
    return asked.join(cache.select("key"), "key", "left_semi"), asked.join(cache.select("key"), "key", "left_anti")


def seeds(rows: DataFrame) -> DataFrame:
    """id, prompt of handwritten examples (id, prompt, user_message): the first text there is, blank ones skipped. An id that is
    there twice is an error, as later stages know an example by it."""
    out = rows.select("id", strip(F.coalesce(F.nullif(F.col("prompt"), F.lit("")), "user_message", F.lit(""))).alias("prompt")).where("prompt <> ''")
    twice = out.where("id is not null").groupBy("id").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"the id {twice[0].id} is there twice")
    return out


MESSAGES = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))
