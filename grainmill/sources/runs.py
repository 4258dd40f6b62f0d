"""Runs: folders of stage files with a manifest; their creation, listing, settings, templates and libraries.

Paths go through Hadoop's file system, so a run may stand in any store that Spark reads."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import strip
from .files import exists, load_jsonl, run_id

# Names and markers that stored runs have.
MANIFEST = "run_manifest.json"
LIBRARY_NAMES = ("reasoning_library.csv", "reasoning_library.json")
SYSTEM_MARK, USER_MARK = "=== SYSTEM PROMPT ===", "=== USER PROMPT ==="


# ---- files


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text; None where there is none."""
    if not exists(spark, path):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, links left out."""
    fs, target = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory() and not s.isSymlink()) if fs.exists(target) else []


# ---- runs


def create(spark: SparkSession, root: str, stamp: str, label: str, config: Mapping, inputs: Mapping[str, str] | None = None) -> str:
    """A new run's id: its folder holds the manifest and a snapshot of the input texts."""
    name = run_id(set(folders(spark, root)), stamp, label)
    inputs = dict(inputs or {})
    for file, text in inputs.items():
        write_text(spark, f"{root}/{name}/inputs/{file}", text)
    manifest = {"manifest_version": 2, "run_id": name, "label": label, "created_at": stamp, "inputs_snapshot": bool(inputs), "model": config.get("model"), "config": dict(config)}
    write_text(spark, f"{root}/{name}/{MANIFEST}", json.dumps(manifest, sort_keys=True))
    return name


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """run_id, label, created_at, model, config (JSON) of the runs that have a manifest."""
    found = [(n, json.loads(text)) for n in folders(spark, root) if (text := read_text(spark, f"{root}/{n}/{MANIFEST}"))]
    rows = [(n, m.get("label"), m.get("created_at"), m.get("model"), json.dumps(m.get("config") or {}, sort_keys=True)) for n, m in found]
    return spark.createDataFrame(rows, "run_id string, label string, created_at string, model string, config string")


def stage_counts(counts: DataFrame) -> DataFrame:
    """run_id, counts: a map of stage to rows; stages without rows are dropped, all but `final`."""
    kept = counts.where("n > 0 or stage = 'final'")
    return kept.groupBy("run_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("stage", "n")))).alias("counts"))


def pass_rate(scored: DataFrame, final: DataFrame) -> DataFrame:
    """run_id, pass_rate: final over scored rows; null for runs without any scored row. Tables of run_id."""
    a = scored.groupBy("run_id").agg(F.count(F.lit(1)).alias("scored"))
    b = final.groupBy("run_id").agg(F.count(F.lit(1)).alias("final"))
    return a.join(b, "run_id", "full_outer").select("run_id", F.try_divide(F.coalesce("final", F.lit(0)), F.nullif("scored", F.lit(0))).alias("pass_rate"))


def listed(runs: DataFrame, rows: DataFrame, costs: DataFrame) -> DataFrame:
    """runs(run_id, ..) newest first by place, with counts, pass_rate and total_cost: rows(run_id, stage), a row for each record
    of a stage; costs(run_id, cost_usd)."""
    counts = stage_counts(rows.groupBy("run_id", "stage").agg(F.count(F.lit(1)).alias("n")))
    rate = pass_rate(rows.where("stage = 'scores'").select("run_id"), rows.where("stage = 'final'").select("run_id"))
    cost = costs.groupBy("run_id").agg(F.round(F.sum("cost_usd"), 4).alias("total_cost"))
    out = runs.join(counts, "run_id", "left").join(rate, "run_id", "left").join(cost, "run_id", "left")
    return out.withColumn("total_cost", F.coalesce("total_cost", F.lit(0.0)))


def changed_settings(manifest: DataFrame, live: Mapping[str, str]) -> DataFrame:
    """setting, was, now of a run's settings(setting, value) that differ from the live ones, for a warning on resume."""
    now = manifest.sparkSession.createDataFrame(sorted(live.items()) or [(None, None)], "setting string, now string").where("setting is not null")
    both = manifest.select("setting", F.col("value").alias("was")).join(now, "setting", "full_outer")
    return both.where(~F.col("was").eqNullSafe(F.col("now")))


class Stages:
    """Reads stage files of runs; a table is kept until its file changes. An absent file is an empty table."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held = spark, {}

    def read(self, path: str, schema: str) -> DataFrame:
        fs, target = _fs(self.spark, path)
        changed = fs.getFileStatus(target).getModificationTime() if fs.exists(target) else None
        held = self.held.get((path, schema))
        if held is None or held[0] != changed:
            if held is not None:
                held[1].unpersist()
            held = self.held[path, schema] = (changed, load_jsonl(self.spark, path, schema).cache())
        return held[1]


def corpus_input(spark: SparkSession, path: str, final: Sequence[str] = ("final/corpus.jsonl",)) -> tuple[str, str]:
    """(corpus file, folder for its reports): of a run, its final corpus and its audit folder; of a bare file, a folder beside it."""
    if path.endswith(".jsonl"):
        return path, f"{path.removesuffix('.jsonl')}_audit"
    for name in final:
        if exists(spark, f"{path}/{name}"):
            return f"{path}/{name}", f"{path}/audit"
    raise FileNotFoundError(f"{path} has none of {', '.join(final)}")


def write_report(spark: SparkSession, path: str, report: Mapping) -> None:
    write_text(spark, path, json.dumps(report, indent=2, ensure_ascii=False))


def read_report(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, path)
    return None if text is None else json.loads(text)


def settings(spark: SparkSession, path: str) -> dict:
    """A YAML file; empty where there is none."""
    import yaml

    return yaml.safe_load(read_text(spark, path) or "") or {}


def phrase_lists(spark: SparkSession, tree: Mapping) -> DataFrame:
    """origin, phrase, note of the watch lists and the ignore list; an entry is a map or the phrase alone."""
    one = lambda origin, e: (origin, e["phrase"], e.get("family") or e.get("reason")) if isinstance(e, Mapping) else (origin, str(e), None)
    rows = [one(o, e) for o, entries in (tree.get("watch") or {}).items() for e in entries or []] + [one("ignore", e) for e in tree.get("ignore") or []]
    return spark.createDataFrame(rows, "origin string, phrase string, note string")


def template_source(snapshot: DataFrame, live: DataFrame) -> DataFrame:
    """name, text, source of templates(name, text): the run's snapshot first, else the live one, else missing."""
    both = snapshot.withColumn("source", F.lit("snapshot")).join(live.select("name", F.col("text").alias("__live")), "name", "full_outer")
    return both.select("name", F.coalesce("text", "__live").alias("text"), F.coalesce("source", F.when(F.col("__live").isNotNull(), "live"), F.lit("missing")).alias("source"))


# ---- prompts and libraries


def split_sections(x: Column) -> tuple[Column, Column]:
    """(system, user) of a rendered prompt; without the user's marker all is the user's, and an empty system part is null."""
    there = F.contains(x, F.lit(USER_MARK))
    before, after = F.substring_index(x, USER_MARK, 1), F.substring(x, F.instr(x, F.lit(USER_MARK)) + F.lit(len(USER_MARK)), F.length(x))
    at = F.instr(before, F.lit(SYSTEM_MARK))
    system = F.when(at > 0, F.concat(F.substring(before, F.lit(1), at - 1), F.substring(before, at + F.lit(len(SYSTEM_MARK)), F.length(before)))).otherwise(before)
    return F.when(there, F.nullif(strip(system), F.lit(""))), F.when(there, strip(after)).otherwise(strip(x))


def joined_parts(*parts: Column) -> Column:
    """Texts one after the other, ruled off."""
    return F.concat_ws("\n---\n\n", *parts)


def library(spark: SparkSession, folder: str, older: Sequence[str] = (), schema: str = "id string, category string, claim string, reasoning string, trigger_condition string, transferable_move string") -> DataFrame:
    """Entries in file order (pos): the current file, or the first of the older names that is there; none, an error."""
    names = [*LIBRARY_NAMES, *older]
    for name in names:
        path = f"{folder}/{name}"
        if exists(spark, path):
            if name.endswith(".csv"):
                rows = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
                return rows.withColumn("pos", F.monotonically_increasing_id())  # one file, one partition: its order
            tree = json.loads(read_text(spark, path))
            columns = [c.split()[0] for c in schema.split(", ")]
            entries = tree.get("entries") or tree.get("principles") or []
            return spark.createDataFrame([(*(e.get(n) for n in columns), i) for i, e in enumerate(entries)], f"{schema}, pos long")
    raise FileNotFoundError(f"{folder} has none of {', '.join(names)}")


def chosen_entries(asked: DataFrame, entries: DataFrame, key: str) -> DataFrame:
    """key, entries: those of asked(key, ids array) in the order asked for; unknown ids go."""
    each = asked.select(key, F.posexplode("ids").alias("at", "id"))
    rest = [c for c in entries.columns if c not in ("id", "pos")]
    got = each.join(F.broadcast(entries.drop("pos")), "id").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "id", *rest))).alias("x"))
    return got.select(key, F.transform("x", lambda e: F.struct(e["id"].alias("id"), *[e[c].alias(c) for c in rest])).alias("entries"))


# ---- preference inputs


def preference_prompts(rows: DataFrame) -> DataFrame:
    """prompt_id, user_message of rows(pos, user_message, prompt, prompt_id, scenario_id): the first id there is, or the row's
    number; rows without text are skipped."""
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    text = strip(F.coalesce(filled("user_message"), filled("prompt"), F.lit("")))
    name = F.coalesce(filled("prompt_id"), filled("scenario_id"), F.format_string("row%04d", "pos"))
    return rows.select("pos", name.alias("prompt_id"), text.alias("user_message")).where("user_message <> ''")


def arms(config: Mapping | None, files: Mapping[str, str] | None = None) -> dict[str, dict]:
    """The two arms' settings, complete: a prompt is given inline or by a file of `files`; defaults where arms are absent."""
    given = (config or {}).get("arms") or {"a": {"name": "pipeline"}, "b": {"name": "plain"}}
    out = {}
    for key in ("a", "b"):
        if key not in given:
            raise ValueError(f"arm {key} is missing")
        arm = given[key]
        file = arm.get("system_prompt_file")
        out[key] = {"name": arm.get("name", key), "system_prompt": (files or {})[file] if file else arm.get("system_prompt") or "", "model": arm.get("model"), "max_tokens": arm.get("max_tokens")}
    return out


ARMS = "inputs/arm_prompts.yaml"


def frozen_arms(spark: SparkSession, run: str, config: Mapping | None, files: Mapping[str, str] | None = None) -> dict[str, dict]:
    """The arms of a run. Resolved once and written into the run, so that a resumed run plays the same ones whatever became of
    its settings and files since. JSON is YAML; a file that people wrote as YAML is read too."""
    held = read_text(spark, f"{run}/{ARMS}")
    if held is None:
        out = arms(config, files)
        write_text(spark, f"{run}/{ARMS}", json.dumps(out, indent=2, ensure_ascii=False))
        return out
    try:
        return json.loads(held)
    except ValueError:
        return settings(spark, f"{run}/{ARMS}")


CHOICES = ("left", "right", "tie", "both_bad")


def rated(ratings: DataFrame, fresh: DataFrame, pairs: DataFrame) -> DataFrame:
    """ratings with fresh(pair_id, rater, choice, note) appended: the arm that the side stands for; another choice is an error."""
    bad = fresh.where(~F.col("choice").isin(*CHOICES) | F.col("choice").isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"choice must be one of {', '.join(CHOICES)}, got {bad[0].choice!r}")
    other = F.when(F.col("left_arm") == "a", "b").otherwise("a")
    arm = F.when(F.col("choice") == "left", F.col("left_arm")).when(F.col("choice") == "right", other)
    rows = fresh.join(pairs.select("pair_id", F.coalesce("left_arm", F.lit("a")).alias("left_arm")), "pair_id").withColumns({"chosen_arm": arm, "note": strip(F.coalesce("note", F.lit("")))})
    return ratings.unionByName(rows.select(*ratings.columns))


def runs_with_pairs(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """place, run_id: newest first, of the runs that have pairs to rate."""
    from pyspark.sql import Window

    kept = runs.join(pairs.select("run_id").distinct(), "run_id", "left_semi").select("run_id")
    return kept.select(F.row_number().over(Window.orderBy(F.desc("run_id"))).cast("long").alias("place"), "run_id")  # a row for each run
