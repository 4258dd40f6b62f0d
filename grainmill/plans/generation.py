"""Queries of the model stages L02-L18 and V07 with a scripted client, whose answers SQL replays from the rows' numbers."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import generation as gen, judged
from ..operators.clients import ScriptedClient
from ..sources import store
from .registry import query, table


def _number(prompt: str) -> int:
    return int(re.search(r"#(\d+)", prompt).group(1))


def _rows(spark, sf_dir, word: str = "do"):
    i = F.col("item_id").cast("string")
    return table(spark, sf_dir, "benchmark").select("item_id", F.concat(F.lit(f"{word} #"), i).alias("prompt"))


def _folder(spark):
    return store.new_path(spark, "answers")


def _draft(prompt, attempt, model):
    n = _number(prompt)
    return {0: ("<document>cut", "max_tokens"), 1: ("no tag", "end_turn"), 2: ("<document> </document>", "end_turn")}.get(n % 5, (f"<document> text {n}\n</document>", "end_turn"))


@query("SELECT item_id, 'text ' || item_id AS content FROM benchmark WHERE item_id % 5 > 2")
def l02_draft(spark, sf_dir):
    return gen.drafted(_rows(spark, sf_dir), "item_id", ScriptedClient(_draft), _folder(spark))[0].select("item_id", "content")


def _rewrite(prompt, attempt, model):
    n = _number(prompt)
    return (f"review {n}\n<document>better {n}</document>" if n % 3 else f"<document>same {n}</document>", "refusal" if n % 7 == 0 else "end_turn")


@query("SELECT item_id, CASE WHEN item_id % 3 <> 0 THEN 'review ' || item_id END AS review, CASE WHEN item_id % 3 <> 0 THEN 'better ' ELSE 'same ' END || item_id AS content FROM benchmark WHERE item_id % 7 <> 0")
def l03_rewrite(spark, sf_dir):
    return gen.drafted(_rows(spark, sf_dir), "item_id", ScriptedClient(_rewrite), _folder(spark), "rewrite")[0]


def _score(prompt, attempt, model):
    n = _number(prompt)
    return ('{"alignment": 9, "realism": 8}', '{"alignment": 7}', "{broken", '{"alignment": 6, "realism": 10}')[n % 4], "end_turn"


@query("SELECT item_id, [9, 7, 5, 6][item_id % 4 + 1] AS alignment, [8, 0, 5, 10][item_id % 4 + 1] AS realism, item_id % 4 = 0 AS kept FROM benchmark")
def l04_score(spark, sf_dir):
    return gen.scored(_rows(spark, sf_dir), "item_id", ScriptedClient(_score), _folder(spark))


def _plan(prompt, attempt, model):
    n, tag = _number(prompt), "scenario_description"
    good = f"<{tag}>plan {n}</{tag}>"
    case = n % 6
    if case == 0:
        return (good, "end_turn") if attempt == 3 and model == "other" else (good, "refusal")
    if case == 1:
        return (good, "end_turn" if attempt == 2 else "max_tokens")
    if case == 2:
        return f"<{tag}>INCOHERENT</{tag}>", "end_turn"
    if case == 3:
        return f"<{tag}>plan {n}", "end_turn"
    return (good if case == 4 or attempt == 2 else "untagged", "end_turn")


@query("SELECT item_id, CASE item_id % 6 WHEN 2 THEN 'incoherent' ELSE 'planned' END AS outcome, CASE WHEN item_id % 6 <> 2 THEN 'plan ' || item_id END AS description, [3, 2, 1, 1, 1, 2][item_id % 6 + 1] AS attempts, CASE WHEN item_id % 6 = 0 THEN 'other' END AS model_fallback, item_id % 6 = 3 AS recovered FROM benchmark")
def l05_scenario_plan(spark, sf_dir):
    """Refused twice and planned by the fallback; cut once; incoherent; unclosed; planned; untagged once."""
    return gen.planned(_rows(spark, sf_dir), "item_id", ScriptedClient(_plan), _folder(spark), "main", "other")


def _loop(prompt, attempt, model):
    """Drafts, gates and edits of one scenario, by its number and the draft's pass, which stands in the draft's text."""
    n = _number(prompt)
    if prompt.startswith("gate"):
        v = int(re.search(r"v(\d+)", prompt).group(1))
        if n % 5 == 1 and v < 3 or n % 5 == 2:
            return f'so {{"pass": false, "failures": ["dull {v}", " "]}}', "end_turn"
        if n % 5 == 3:
            return ("unreadable", "end_turn") if n % 2 or attempt == 1 else ('{"pass": true}', "end_turn")
        return '{"pass": true, "failures": []}', "end_turn"
    if prompt.startswith("edit"):
        if n % 7 == 0:
            return "<unfixable>too thin</unfixable>", "end_turn"
        if n % 7 == 1:
            return "nothing of use", "end_turn"
        return (f"tightened\n<user_prompt>edited {n}</user_prompt>", "max_tokens" if n % 7 == 2 and attempt == 1 else "end_turn")
    if n % 11 == 10:
        return "never a tag", "end_turn"
    if n % 4 == 0 and attempt == 1:
        return "<user_prompt>x</user_prompt>", "refusal"
    told = " told" if "PRIOR ATTEMPT" in prompt and "- dull" in prompt else ""
    return f"<user_prompt>draft #{n} v{attempt}{told}</user_prompt>", "end_turn"


#: first pass with a draft; the pass that ships; the gate's last failures
_LOOP_SQL = """b AS (SELECT item_id AS n, CASE WHEN item_id % 4 = 0 THEN 2 ELSE 1 END AS f FROM benchmark),
g AS (SELECT n, f, CASE WHEN n % 5 = 1 THEN greatest(f, 3) WHEN n % 5 = 2 THEN f + 2 ELSE f END AS p FROM b),
d AS (SELECT n, p, 'draft #' || n || ' v' || p || CASE WHEN p > f THEN ' told' ELSE '' END AS draft, CASE WHEN n % 5 = 2 THEN ['dull ' || p, ' '] END AS gf FROM g WHERE n % 11 <> 10)"""


@query(f"WITH {_LOOP_SQL} SELECT n AS item_id, 'shipped' AS status, draft AS user_message, p AS passes, CASE WHEN gf IS NOT NULL THEN gf[1] END AS gate_failures FROM d UNION ALL SELECT n, 'draft_rejected', NULL, 4, NULL FROM b WHERE n % 11 = 10")
def l07_gate(spark, sf_dir):
    out = gen.prompts(_rows(spark, sf_dir), "item_id", ScriptedClient(_loop), _folder(spark), gate=lambda d: F.concat(F.lit("gate "), d))
    return out.select("item_id", "status", "user_message", "passes", F.array_join("gate_failures", ",").alias("gate_failures"))


@query("SELECT item_id, CASE WHEN item_id % 11 = 10 THEN 'draft_rejected' ELSE 'shipped' END AS status, CASE WHEN item_id % 11 <> 10 THEN 'draft #' || item_id || CASE WHEN item_id % 4 = 0 THEN ' v2' ELSE ' v1' END END AS user_message, CASE WHEN item_id % 11 = 10 THEN 4 WHEN item_id % 4 = 0 THEN 2 ELSE 1 END AS passes FROM benchmark")
def l06_prompt_draft(spark, sf_dir):
    """Four unusable drafts reject a scenario; a refused one is drafted in the next pass."""
    return gen.prompts(_rows(spark, sf_dir), "item_id", ScriptedClient(_loop), _folder(spark)).select("item_id", "status", "user_message", "passes")


@query(f"WITH {_LOOP_SQL} SELECT n AS item_id, CASE WHEN n % 7 = 0 THEN 'refine_rejected' ELSE 'shipped' END AS status, CASE n % 7 WHEN 0 THEN NULL WHEN 1 THEN draft ELSE 'edited ' || n END AS user_message, CASE WHEN n % 7 > 1 THEN 'tightened' END AS notes, n % 7 = 1 AS refine_failed FROM d UNION ALL SELECT n, 'draft_rejected', NULL, NULL, false FROM b WHERE n % 11 = 10")
def l08_refine(spark, sf_dir):
    out = gen.prompts(_rows(spark, sf_dir), "item_id", ScriptedClient(_loop), _folder(spark), gate=lambda d: F.concat(F.lit("gate "), d), refine=lambda d: F.concat(F.lit("edit "), d))
    return out.select("item_id", "status", "user_message", "notes", "refine_failed")


def _answer(prompt, attempt, model):
    n = _number(prompt)
    sample = prompt.rpartition("sample ")[2] if "sample" in prompt else ""
    return {0: ("  ", "end_turn"), 1: (f"cut {n}", "max_tokens"), 2: (f"USER: q\nASSISTANT: {n}", "end_turn")}.get(n % 6, (f" answer {n}{sample} ", "end_turn"))


@query("SELECT item_id, CASE WHEN item_id % 6 = 2 THEN 'USER: q' || chr(10) || 'ASSISTANT: ' || item_id ELSE 'answer ' || item_id END AS response FROM benchmark WHERE item_id % 6 > 1")
def l09_baseline(spark, sf_dir):
    return gen.baseline(_rows(spark, sf_dir), "item_id", ScriptedClient(_answer), _folder(spark))


def _scope(prompt, attempt, model):
    n = _number(prompt)
    full = "{" + ", ".join(f'"{a}": "x{n}"' for a in gen.SCOPE) + "}"
    if n % 4 == 0:
        return (full if attempt == 3 else full.replace(f'"cost": "x{n}"', '"cost": " "')), "end_turn"
    if n % 4 == 1:
        return full.replace(f'"goal": "x{n}"', '"goal": 5'), "end_turn"
    return full, "max_tokens" if n % 4 == 2 and attempt == 1 else "end_turn"


@query("SELECT item_id, 'x' || item_id AS upside FROM benchmark WHERE item_id % 4 <> 1")
def l10_scope(spark, sf_dir):
    good, _ = gen.scopes(_rows(spark, sf_dir), "item_id", ScriptedClient(_scope), _folder(spark))
    return good.select("item_id", F.get_json_object("scope", "$.upside").alias("upside"))


@query("SELECT item_id, 3 AS attempts FROM benchmark WHERE item_id % 4 = 1")
def l10_scope_rejects(spark, sf_dir):
    return gen.scopes(_rows(spark, sf_dir), "item_id", ScriptedClient(_scope), _folder(spark))[1]


def _select(prompt, attempt, model):
    n = _number(prompt)
    return (("`T7`, c1; (M3). nope T7", "c1,T7", "none of them", "M3")[n % 4], "max_tokens" if n % 8 == 3 else "end_turn")


@query("SELECT item_id, CASE WHEN item_id % 4 = 2 OR item_id % 8 = 3 THEN 'M3,T7,c1' WHEN item_id % 4 = 0 THEN 'M3,T7,c1' WHEN item_id % 4 = 1 THEN 'T7,c1' ELSE 'M3' END AS entry_ids, item_id % 4 = 2 OR item_id % 8 = 3 AS selection_fallback FROM benchmark")
def l11_library_selection(spark, sf_dir):
    out = gen.selected(_rows(spark, sf_dir), "item_id", ScriptedClient(_select), _folder(spark), ["M3", "T7", "c1"])
    return out.withColumn("entry_ids", F.array_join("entry_ids", ","))


@query("SELECT item_id, s AS sample_index, 'answer ' || item_id || s AS response FROM benchmark, range(0, 2) t(s) WHERE item_id % 6 > 2")
def l12_respond(spark, sf_dir):
    return gen.responded(_rows(spark, sf_dir), "item_id", ScriptedClient(_answer), _folder(spark), samples=2)


def _longer(prompt, attempt, model):
    n = _number(prompt)
    return {0: ("", "end_turn"), 1: (f"long {n}", "max_tokens"), 2: (f"long {n}", "max_tokens" if attempt == 1 else "end_turn")}.get(n % 4, (f"short {n}", "end_turn"))


@query("SELECT item_id, CASE item_id % 4 WHEN 2 THEN 'long ' ELSE 'short ' END || item_id AS response FROM benchmark WHERE item_id % 4 > 1")
def l13_constitution_rewrite(spark, sf_dir):
    return gen.rewritten(_rows(spark, sf_dir), "item_id", ScriptedClient(_longer), _folder(spark))[0]


@query("SELECT item_id, CASE item_id % 4 WHEN 0 THEN 'empty' ELSE 'truncated' END AS why FROM benchmark WHERE item_id % 4 < 2")
def l13_rewrite_failures(spark, sf_dir):
    return gen.rewritten(_rows(spark, sf_dir), "item_id", ScriptedClient(_longer), _folder(spark))[1]


def _arm(prompt, attempt, model):
    n, kind = _number(prompt), prompt.partition("\n")[0]
    return (f"{kind} {n}", "max_tokens" if n % (3 if kind == "kind" else 5) == 0 else "end_turn")


@query("SELECT item_id, 'kind ' || item_id AS response_a, 'plain ' || item_id AS response_b FROM benchmark WHERE item_id % 3 <> 0 AND item_id % 5 <> 0")
def l14_two_arm_pairs(spark, sf_dir):
    return gen.pairs(_rows(spark, sf_dir), "item_id", ScriptedClient(_arm), _folder(spark), {"a": {"system_prompt": "kind"}, "b": {"system_prompt": "plain"}})


def _scan(prompt, attempt, model):
    n = _number(prompt)
    if n % 9 == 0:
        return "no list", "end_turn"
    return f'[{{"pattern": "P{n % 4}", "is_defect": {str(n % 8 == 1).lower()}}}, {{"pattern": " p{n % 6} ", "is_defect": false}}]', "end_turn"


@query("WITH f AS (SELECT item_id, 'p' || item_id % 4 AS pattern, item_id % 8 = 1 AS d FROM benchmark WHERE item_id % 9 <> 0 UNION ALL SELECT item_id, 'p' || item_id % 6, false FROM benchmark WHERE item_id % 9 <> 0), t AS (SELECT pattern, count(DISTINCT item_id) AS n, bool_or(d) AS is_defect FROM f GROUP BY 1) SELECT row_number() OVER (ORDER BY n DESC, pattern) - 1 AS id, pattern, is_defect FROM t ORDER BY n DESC, pattern LIMIT 5")
def l15_pattern_scan(spark, sf_dir):
    out = gen.patterns(_rows(spark, sf_dir), "item_id", ScriptedClient(_scan), _folder(spark), most=5)
    return out.withColumn("id", F.col("id").cast("long"))


def _numbers(prompt, attempt, model):
    n = _number(prompt)
    return ("sorry" if n % 6 == 0 else f'[{n % 4}, "x", {n % 4}, 77]'), "end_turn"


@query("WITH r AS (SELECT item_id % 4 AS number FROM benchmark WHERE item_id % 6 <> 0), n AS (SELECT count(*) AS rated FROM r), h AS (SELECT number, count(*) AS hits FROM r GROUP BY 1) SELECT r_regionkey AS number, r_name AS principle, round(coalesce(hits, 0) / rated, 3) AS share, coalesce(hits, 0) / rated < 0.05 AS starved FROM region LEFT JOIN h ON number = r_regionkey, n")
def l16_principle_coverage(spark, sf_dir):
    """What the judge lists, cleaned, over the documents that it rated."""
    ids = gen.listed_numbers(_rows(spark, sf_dir), "item_id", ScriptedClient(_numbers), _folder(spark), "coverage").withColumnRenamed("item_id", "doc_id")
    principles = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("int").alias("number"), F.col("r_name").alias("principle"))
    return judged.coverage(principles, ids).withColumn("number", F.col("number").cast("long"))


def _reasons(prompt, attempt, model):
    n = _number(prompt)
    return ("{}" if n % 5 == 0 else f'here: ["r{n % 7}", " ", "r{n % 3}"]'), "end_turn"


@query("WITH r AS (SELECT item_id, CASE item_id % 2 WHEN 0 THEN 'pipeline' ELSE 'plain' END AS arm, length(text) AS chars FROM benchmark WHERE item_id % 5 <> 0), x AS (SELECT arm, 'r' || item_id % 7 AS reason, item_id FROM r UNION ALL SELECT arm, 'r' || item_id % 3, item_id FROM r), e AS (SELECT arm, count(*) AS n, sum(chars) AS chars FROM (SELECT r.*, item_id AS i FROM r) GROUP BY 1) SELECT arm, n, 2.0 AS mean_unique, (SELECT count(DISTINCT reason) FROM x WHERE x.arm = e.arm) AS corpus_distinct, round(2 * n / chars * 1000, 2) AS density_per_1k, 0 AS checkback FROM e")
def l17_reasons(spark, sf_dir):
    got = gen.stated(_rows(spark, sf_dir), "item_id", ScriptedClient(_reasons), _folder(spark))
    b = table(spark, sf_dir, "benchmark").select("item_id", F.when(F.col("item_id") % 2 == 0, "pipeline").otherwise("plain").alias("arm"), F.length("text").alias("chars"))
    return judged.reasons(got.join(b, "item_id").select(F.col("item_id").alias("prompt_id"), "arm", "reasons", "chars", F.lit(0).alias("added")))


@query("SELECT item_id, 2 AS asked, [9, 7, 5, 6][item_id % 4 + 1] AS alignment FROM benchmark")
def l18_judge_resumes(spark, sf_dir):
    """A second run finds all answers and asks nothing: one answer in the table for each row."""
    folder, rows = _folder(spark), _rows(spark, sf_dir)
    first = gen.scored(rows, "item_id", ScriptedClient(_score), folder)
    again = gen.scored(rows, "item_id", ScriptedClient(_draft), folder)
    return first.unionByName(again).groupBy("item_id").agg(F.count(F.lit(1)).alias("asked"), F.max("alignment").alias("alignment"))


def _idea(prompt, attempt, model):
    n = _number(prompt)
    return f"\n idea {n} \nand more", ("refusal" if n % 3 == 0 else "end_turn")


@query("SELECT item_id, 'idea ' || item_id AS idea FROM benchmark WHERE item_id % 3 <> 0")
def v07_idea_summaries(spark, sf_dir):
    return gen.ideas(_rows(spark, sf_dir), "item_id", ScriptedClient(_idea), _folder(spark))
