"""Clients, run folders, settings and the parsers' odd cases."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from grainmill.functions import parse
from grainmill.operators import clients, generation as gen
from grainmill.sources import files, runs, store


class Flaky:
    def __init__(self, errors, answer=("fine", "end_turn")):
        self.errors, self.answer, self.asked = list(errors), answer, 0

    def complete(self, prompt, attempt=1, model=None):
        self.asked += 1
        if self.errors:
            raise self.errors.pop(0)
        return self.answer


def test_router_waits_and_retries():
    waits, backend = [], Flaky([clients.TransientError()] * 6)
    assert clients.Router([backend], sleep=waits.append).complete("q") == ("fine", "end_turn")
    assert waits == [4, 8, 16, 32, 60, 60]
    with pytest.raises(clients.TransientError):
        clients.Router([Flaky([clients.TransientError()] * 8)], sleep=waits.append).complete("q")


def test_router_demotes_a_broken_backend():
    broken, spare = Flaky([ValueError("gone")]), Flaky([])
    router = clients.Router([broken, spare], sleep=lambda s: None)
    assert router.complete("q") == ("fine", "end_turn") and router.complete("q") == ("fine", "end_turn")
    assert broken.asked == 1 and spare.asked == 2
    with pytest.raises(ValueError):
        clients.Router([Flaky([ValueError("bad")])]).complete("q")


def test_router_ends_at_the_usage_limit_and_shapes_refusals():
    spare = Flaky([])
    with pytest.raises(clients.UsageLimit):
        clients.Router([Flaky([clients.UsageLimit()]), spare]).complete("q")
    assert spare.asked == 0
    assert clients.Router([Flaky([], ("half a sen", "refusal"))]).complete("q") == ("", "refusal")


def test_evaluations_never_take_the_run_with_them():
    def broken():
        raise ValueError("no data")

    evals = [("a", lambda: None), ("b", broken)]
    assert clients.evaluated(evals, False) == [("a", "done", None), ("b", "failed", "no data")]
    assert {s for _, s, _ in clients.evaluated(evals, True)} == {"skipped"}


def _twice(prompt, attempt, model):
    return ("<document>d</document>", "end_turn" if attempt == 2 else "max_tokens")


def test_a_stage_that_runs_again_asks_only_for_what_is_missing(spark):
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(5)], "k long, prompt string")
    folder = store.new_path(spark, "answers")
    decide = lambda a: a.withColumn("done", F.col("stop_reason") == "end_turn")
    got = gen.answered(rows, "k", clients.ScriptedClient(_twice), folder, decide, gen.times(3))
    assert sorted((r.k, r.attempt) for r in got.collect()) == sorted((i, a) for i in range(5) for a in (1, 2))
    again = gen.answered(rows, "k", clients.ScriptedClient(None), folder, decide, gen.times(3))  # would fail if asked
    assert again.count() == 10


def test_plans_that_stay_unusable_abort(spark):
    rows = spark.createDataFrame([(1, "p")], "k long, prompt string")
    with pytest.raises(RuntimeError, match="1 plans"):
        gen.planned(rows, "k", clients.ScriptedClient(_twice), store.new_path(spark, "answers"), "main")


def test_drafting_ends_after_its_passes(spark):
    rows = spark.createDataFrame([(1, "p")], "k long, prompt string")
    with pytest.raises(RuntimeError, match="2 passes"):
        gen.prompts(rows, "k", clients.ScriptedClient(_twice), store.new_path(spark, "answers"), passes=2, drafts=9)


def test_arms_are_resolved():
    assert [a["name"] for a in runs.arms(None).values()] == ["pipeline", "plain"]
    got = runs.arms({"arms": {"a": {"system_prompt_file": "x.txt", "model": "m"}, "b": {"name": "bare", "system_prompt": None}}}, {"x.txt": "be kind"})
    assert got["a"] == {"name": "a", "system_prompt": "be kind", "model": "m", "max_tokens": None} and got["b"]["system_prompt"] == ""
    with pytest.raises(ValueError):
        runs.arms({"arms": {"a": {}}})


def test_arms_are_frozen_in_a_run(spark):
    run = store.new_path(spark, "run")
    config = {"arms": {"a": {"system_prompt_file": "x.txt"}, "b": {"name": "bare"}}}
    first = runs.frozen_arms(spark, run, config, {"x.txt": "be kind: “é”\nalways"})
    assert first == runs.arms(config, {"x.txt": "be kind: “é”\nalways"})
    assert runs.frozen_arms(spark, run, {"arms": {}}, {"x.txt": "changed"}) == first
    assert runs.frozen_arms(spark, store.new_path(spark, "run"), None)["b"]["name"] == "plain"


def test_settings_and_phrase_lists(spark):
    pytest.importorskip("yaml")
    path = store.new_path(spark, "tics.yaml")
    assert runs.settings(spark, path) == {}
    runs.write_text(spark, path, "watch:\n  opening:\n    - {phrase: so then, family: start}\n    - well now\nignore:\n  - {phrase: of the, reason: common}\n")
    got = {tuple(r) for r in runs.phrase_lists(spark, runs.settings(spark, path)).collect()}
    assert got == {("opening", "so then", "start"), ("opening", "well now", None), ("ignore", "of the", "common")}
    assert runs.phrase_lists(spark, {}).collect() == []


def test_libraries_prefer_the_current_file(spark):
    folder = store.new_path(spark, "prompts")
    with pytest.raises(FileNotFoundError):
        runs.library(spark, folder)
    runs.write_text(spark, f"{folder}/{runs.LIBRARY_NAMES[1]}", json.dumps({"entries": [{"id": "old", "claim": "c"}]}))
    assert [r.id for r in runs.library(spark, folder).collect()] == ["old"]
    runs.write_text(spark, f"{folder}/{runs.LIBRARY_NAMES[0]}", 'id,category,claim,reasoning,trigger_condition,transferable_move\nC1,Conduct,"a ""quoted""\nclaim",r,t,m\nT1,Topic,b,r,t,m\n')
    assert [(r.id, r.claim) for r in runs.library(spark, folder).orderBy("pos").collect()] == [("C1", 'a "quoted"\nclaim'), ("T1", "b")]


def test_reports_and_corpora_of_runs(spark):
    root = store.new_path(spark, "runs")
    assert runs.read_report(spark, f"{root}/none.json") is None
    runs.write_report(spark, f"{root}/r/audit/report.json", {"é": 1})
    assert runs.read_report(spark, f"{root}/r/audit/report.json") == {"é": 1}
    with pytest.raises(FileNotFoundError):
        runs.corpus_input(spark, f"{root}/r")
    files.save_jsonl(spark.range(2), f"{root}/r/final/corpus.jsonl")
    assert runs.corpus_input(spark, f"{root}/r") == (f"{root}/r/final/corpus.jsonl", f"{root}/r/audit")
    assert runs.corpus_input(spark, "x/corpus.jsonl") == ("x/corpus.jsonl", "x/corpus_audit")


def test_other_choices_are_errors(spark):
    pairs = spark.createDataFrame([(1, "a")], "pair_id long, left_arm string")
    fresh = spark.createDataFrame([(1, "ann", "middle", None)], "pair_id long, rater string, choice string, note string")
    none = spark.createDataFrame([], "pair_id long, rater string, choice string, chosen_arm string, left_arm string, note string")
    with pytest.raises(ValueError, match="middle"):
        runs.rated(none, fresh, pairs)


def test_shared_folders_are_the_clusters(spark):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        store.shared_dir(Session())


@pytest.mark.parametrize(
    ("text", "found"),
    [
        (None, None), ("", None), ("no value", None), ('```json\n{"a": 1}\n```', '{"a": 1}'), ('so [1] and {"a": [1, 2, 3]}', '{"a": [1, 2, 3]}'),
        ('{"a": "line\nbreak"}', '{"a": "line\nbreak"}'), ('{"a": 1} {"b": {"c": 2}}', '{"b": {"c": 2}}'), ('{"a": "}"}', '{"a": "}"}'), ('{"cut": [1, 2', None),
    ],
)
def test_json_is_found_in_prose(text, found):
    assert parse.find_json(text) == found


def test_json_is_salvaged():
    assert parse.salvage('[{"a": 1}, {"b": "x]"}, {"c": ') == ['{"a": 1}', '{"b": "x]"}']
    assert parse.salvage("nothing") == [] and parse.salvage(None) == [] and parse.salvage("[]") == []
