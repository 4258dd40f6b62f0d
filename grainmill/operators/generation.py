"""The model stages of the document, chat and preference pipelines: what is asked again, what is rejected, what fails open.

Each stage keeps every answer in a table of its own below `folder` (key, attempt, raw, stop_reason, model), written before
it is read. So a stage that runs again asks only for what is missing, and lost tasks ask nothing twice that was written.
Output that the model was stopped in (`max_tokens`, `refusal`) is never parsed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import parse, text as t
from ..sources.store import written

STOPPED = ("max_tokens", "refusal")


def ask(rows: DataFrame, key: str, client, tasks: int = 8) -> DataFrame:
    """key, attempt, raw, stop_reason, model of rows(key, prompt, attempt, model)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [client.complete(p, attempt=int(a), model=m) for p, a, m in zip(batch.prompt, batch.attempt, batch.model)]
            yield pd.DataFrame({key: batch[key], "attempt": batch.attempt, "raw": [g[0] for g in got], "stop_reason": [g[1] for g in got], "model": batch.model})

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "prompt", F.col("attempt").cast("int").alias("attempt"), F.col("model").cast("string").alias("model")).repartition(tasks, key).mapInPandas(work, f"{key} {kind}, attempt int, raw string, stop_reason string, model string")


def answered(rows: DataFrame, key: str, client, store: str, decide: Callable[[DataFrame], DataFrame], allowed: Callable[[Column, Column], Column], model: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """All answers with `done` (whether they settle their row). Open rows of rows(key, prompt) are asked, one attempt each
    round, while `allowed` (of the attempts made and whether one was refused) says so; `model` names the model of the next
    attempt. As many rounds as the most patient row has attempts."""
    from ..sources.files import exists

    spark = rows.sparkSession
    schema = f"{key} {rows.schema[key].dataType.simpleString()}, attempt int, raw string, stop_reason string, model string"
    while True:
        answers = decide(spark.read.schema(schema).parquet(store) if exists(spark, store) else spark.createDataFrame([], schema))
        state = answers.groupBy(key).agg(F.max("attempt").alias("__n"), F.bool_or("done").alias("__done"), F.bool_or(F.col("stop_reason") == "refusal").alias("__refused"))
        open_ = rows.join(state, key, "left").withColumns({"__n": F.coalesce("__n", F.lit(0)), "__refused": F.coalesce("__refused", F.lit(False))})
        open_ = open_.where(~F.coalesce("__done", F.lit(False)) & (F.col("__n") < allowed(F.col("__n"), F.col("__refused"))))
        if open_.isEmpty():
            return answers
        named = model(F.col("__n") + 1, F.col("__refused")) if model else F.lit(None).cast("string")
        ask(open_.select(key, "prompt", (F.col("__n") + 1).alias("attempt"), named.alias("model")), key, client).write.mode("append").parquet(store)


def times(n: int) -> Callable[[Column, Column], Column]:
    return lambda made, refused: F.lit(n)


def ended() -> Column:
    return ~F.col("stop_reason").isin(*STOPPED)


# ---- documents


def drafted(rows: DataFrame, key: str, client, folder: str, stage: str = "draft", tag: str = "document") -> tuple[DataFrame, DataFrame]:
    """(key, review, content; failures): the tag's text of an answer that ended by itself, and what stands before it. What is
    unusable is left for another run."""
    before = t.strip(F.regexp_extract("raw", rf"(?s)^(.*?)<{tag}>", 1))
    decide = lambda a: a.withColumn("content", F.when(F.col("stop_reason") == "end_turn", t.tag("raw", tag))).withColumn("done", F.col("content").isNotNull())
    answers = answered(rows, key, client, f"{folder}/{stage}", decide, times(1))
    good = answers.where("done").select(key, F.nullif(before, F.lit("")).alias("review"), "content")
    return good, answers.where("not done").select(key, "raw", "stop_reason")


def scored(rows: DataFrame, key: str, client, folder: str, least: int = 7) -> DataFrame:
    """key, alignment, realism, kept: an unreadable answer is recorded with the default scores and not asked again."""
    answers = answered(rows, key, client, f"{folder}/score", lambda a: a.withColumn("done", F.lit(True)), times(1))
    s = answers.select(key, parse.scores(F.col("raw")).alias("s")).select(key, "s.*")
    return s.withColumn("kept", (F.col("alignment") >= least) & (F.col("realism") >= least))


# ---- chat: scenarios


def planned(rows: DataFrame, key: str, client, folder: str, stage_model: str, fallback: str | None = None, tag: str = "scenario_description") -> DataFrame:
    """key, outcome (planned, incoherent), description, attempts, model_fallback, recovered. Two attempts; a refusal grants a
    third, on the fallback model if there is one. An unclosed tag counts where the answer ended by itself. Any row without an
    outcome then is an error: what is planned is kept, so another run asks only for the rest."""
    ok = ended()
    closed, tail = t.tag("raw", tag), t.tag_tail(F.col("raw"), tag, F.col("stop_reason") == "end_turn")

    def decide(a: DataFrame) -> DataFrame:
        a = a.withColumn("incoherent", ok & t.incoherent("raw", tag)).withColumn("closed", F.when(ok, closed)).withColumn("description", F.when(~F.col("incoherent") & ok, F.coalesce(closed, tail)))
        return a.withColumn("done", F.col("incoherent") | F.col("description").isNotNull())

    def named(attempt: Column, refused: Column) -> Column:
        return F.when(refused & (attempt == 3) & F.lit(fallback is not None), F.lit(fallback)).otherwise(F.lit(stage_model))

    answers = answered(rows, key, client, f"{folder}/plan", decide, lambda made, refused: F.when(refused, 3).otherwise(2), named)
    out = answers.where("done").select(key, F.when(F.col("incoherent"), "incoherent").otherwise("planned").alias("outcome"), "description", F.col("attempt").cast("long").alias("attempts"), F.when(~F.col("incoherent") & (F.col("model") != stage_model), F.col("model")).alias("model_fallback"), (~F.col("incoherent") & F.col("closed").isNull()).alias("recovered"))
    left = rows.join(out, key, "left_anti")
    if not left.isEmpty():
        raise RuntimeError(f"{left.count()} plans are unusable after all attempts; those that are planned are kept")
    return out


def feedback(reasons: Column) -> Column:
    lines = F.array_join(F.transform(reasons, lambda r: F.concat(F.lit("- "), r)), "\n")
    return F.when(F.coalesce(F.size(reasons), F.lit(0)) > 0, F.concat(F.lit("\nPRIOR ATTEMPT: rejected for these reasons:\n"), lines)).otherwise("")


def verdicts(drafts: DataFrame, key: str, client, folder: str, tries: int = 2) -> DataFrame:
    """key, passed, reasons: the gate's JSON answer of rows(key, prompt); null where every answer was unusable."""

    def decide(a: DataFrame) -> DataFrame:
        a = a.withColumn("__j", parse.extract_json("raw"))
        passed = F.get_json_object("__j", "$.pass")
        return a.withColumn("passed", F.when(F.startswith("__j", F.lit("{")) & passed.isNotNull(), passed.isin("true", "1"))).withColumn("done", F.col("passed").isNotNull())

    answers = answered(drafts, key, client, folder, decide, times(tries))
    reasons = F.filter(F.from_json(F.get_json_object("__j", "$.failures"), "array<string>"), lambda r: t.strip(r) != "")
    good = answers.where("done").select(key, "passed", F.when(~F.col("passed"), F.coalesce(reasons, F.array().cast("array<string>"))).alias("reasons"))
    return drafts.select(key).join(good, key, "left")


def refined(drafts: DataFrame, key: str, client, folder: str, tries: int = 2) -> DataFrame:
    """key, message, notes, unfixable: the editor's rewrite with what it said before, or its verdict that there is no fixing;
    all null where no answer was usable."""

    def decide(a: DataFrame) -> DataFrame:
        cut = F.col("stop_reason") != "max_tokens"
        message = F.coalesce(t.tag("raw", "revised_prompt"), t.tag("raw", "user_prompt"))
        a = a.withColumn("unfixable", F.when(cut, t.tag("raw", "unfixable"))).withColumn("message", F.when(cut & F.col("unfixable").isNull(), message))
        return a.withColumn("done", F.col("unfixable").isNotNull() | F.col("message").isNotNull())

    answers = answered(drafts, key, client, folder, decide, times(tries))
    notes = F.coalesce(F.nullif(t.strip(F.regexp_extract("raw", r"(?s)^(.*?)<(?:revised_prompt|user_prompt)>", 1)), F.lit("")), F.lit("(no notes)"))
    good = answers.where("done").select(key, "message", F.when(F.col("message").isNotNull(), notes).alias("notes"), "unfixable")
    return drafts.select(key).join(good, key, "left")


def prompts(scenarios: DataFrame, key: str, client, folder: str, gate: Callable[[Column], Column] | None = None, refine: Callable[[Column], Column] | None = None, passes: int = 12, drafts: int = 4, redrafts: int = 3) -> DataFrame:
    """key, status (shipped, draft_rejected, refine_rejected), user_message, draft, notes, gate_failures, refine_failed, passes.

    Scenarios (key, prompt) are drafted in passes, 12 at most. Four unusable drafts reject a scenario. The gate's rejection
    sends it back with the gate's reasons; the third one ships it with the failures on record, as does an unusable gate
    without. The editor may rewrite the draft, reject the scenario, or fail, which ships the draft with a mark. gate and
    refine give the prompts of those steps from the draft; without them the steps are left out."""
    empty = F.array().cast("array<string>")
    state = scenarios.select(key, "prompt", F.lit(0).alias("bad"), F.lit(0).alias("gates"), empty.alias("reasons"), F.lit(None).cast("string").alias("status"), *[F.lit(None).cast(k).alias(c) for c, k in (("user_message", "string"), ("draft", "string"), ("notes", "string"), ("gate_failures", "array<string>"), ("refine_failed", "boolean"), ("passes", "long"))])
    state = written(state, "prompts")
    names, now = state.columns, 0
    while True:
        open_ = state.where("status is null")
        if open_.isEmpty():
            break
        now += 1
        if now > passes:
            raise RuntimeError(f"{passes} passes, and {open_.count()} scenarios are still unfilled")
        asked = written(ask(open_.select(key, F.concat("prompt", feedback(F.col("reasons"))).alias("prompt"), F.lit(now).alias("attempt"), F.lit(None).alias("model")), key, client), f"draft-{now}")
        got = asked.select(key, F.when(ended(), t.tag("raw", "user_prompt")).alias("text"))
        rows = written(open_.drop("draft").join(got, key).withColumnRenamed("text", "draft"), f"drafted-{now}")
        bad = F.col("bad") + 1
        failed = rows.where("draft is null").withColumns({"bad": bad, "status": F.when(bad >= drafts, "draft_rejected"), "passes": F.lit(now).cast("long")})
        good = rows.where("draft is not null")
        if gate:
            verdict = verdicts(good.select(key, gate(F.col("draft")).alias("prompt")), key, client, f"{folder}/gate-{now}")
            good = good.join(verdict.withColumnRenamed("reasons", "__why"), key).withColumn("gates", F.col("gates") + 1)
        else:
            good = good.withColumns({"passed": F.lit(True), "__why": empty})
        no = F.coalesce(~F.col("passed"), F.lit(False))
        good = written(good.withColumn("__again", no & (F.col("gates") < redrafts)), f"gated-{now}")
        back = good.where("__again").withColumns({"reasons": F.col("__why"), "draft": F.lit(None).cast("string")})
        ship = good.where("not __again").withColumn("gate_failures", F.when(no, F.col("__why"))).withColumn("passes", F.lit(now).cast("long"))
        if refine:
            edit = refined(ship.select(key, refine(F.col("draft")).alias("prompt")), key, client, f"{folder}/refine-{now}")
            ship = ship.drop("notes").join(edit, key).withColumns({"user_message": F.when(F.col("unfixable").isNull(), F.coalesce("message", "draft")), "refine_failed": F.col("message").isNull() & F.col("unfixable").isNull(), "status": F.when(F.col("unfixable").isNull(), "shipped").otherwise("refine_rejected")})
        else:
            ship = ship.withColumns({"user_message": F.col("draft"), "refine_failed": F.lit(False), "status": F.lit("shipped")})
        parts = [state.where("status is not null"), failed, back, ship]
        state = written(parts[0].unionByName(parts[1].select(*names)).unionByName(parts[2].select(*names)).unionByName(parts[3].select(*names)), f"prompts-{now}")
    return state.select(key, "status", "user_message", "draft", "notes", "gate_failures", F.coalesce("refine_failed", F.lit(False)).alias("refine_failed"), "passes")


# ---- chat: responses


#: The axes that a scope must fill.
SCOPE = ("patients", "goal", "levers", "cost", "magnitude", "upside", "replaceability")


def valid_scope(scope: Column) -> Column:
    """Whether a JSON object holds text for every axis."""
    filled = lambda a: (F.schema_of_variant(F.try_variant_get(F.try_parse_json(scope), f"$.{a}", "variant")) == "STRING") & (t.strip(F.coalesce(F.get_json_object(scope, f"$.{a}"), F.lit(""))) != "")
    out = F.coalesce(F.startswith(scope, F.lit("{")), F.lit(False))
    for a in SCOPE:
        out &= F.coalesce(filled(a), F.lit(False))
    return out


def scopes(rows: DataFrame, key: str, client, folder: str, tries: int = 3) -> tuple[DataFrame, DataFrame]:
    """(key, scope; rejects): three attempts at an answer with all axes, then the prompt is rejected."""
    decide = lambda a: a.withColumn("scope", F.when(F.col("stop_reason") != "max_tokens", parse.extract_json("raw"))).withColumn("done", valid_scope(F.col("scope")))
    answers = answered(rows, key, client, f"{folder}/scope", decide, times(tries))
    good = answers.where("done").select(key, "scope")
    return good, rows.select(key).join(good, key, "left_anti").withColumn("attempts", F.lit(tries))


def chosen_ids(raw: Column, library: list[str]) -> Column:
    """Known ids of a free list, each once, in the library's order."""
    edge = r"[`'\"*_.,;:!?()\[\]{}<>]+"
    found = F.transform(F.split(F.regexp_replace(raw, ",", " "), r"\s+"), lambda x: F.regexp_replace(x, f"^{edge}|{edge}$", ""))
    return F.filter(F.array(*map(F.lit, library)), lambda x: F.array_contains(found, x))


def selected(rows: DataFrame, key: str, client, folder: str, library: list[str]) -> DataFrame:
    """key, entry_ids, selection_fallback: one attempt; an unusable one opens the whole library."""
    answers = answered(rows, key, client, f"{folder}/select", lambda a: a.withColumn("done", F.lit(True)), times(1))
    ids = F.when(F.col("stop_reason") != "max_tokens", chosen_ids(F.col("raw"), library))
    none = F.coalesce(F.size(ids), F.lit(0)) <= 0
    return answers.select(key, F.when(none, F.array(*map(F.lit, library))).otherwise(ids).alias("entry_ids"), none.alias("selection_fallback"))


def whole(raw: Column) -> Column:
    """An answer that may become a record: neither empty, nor cut off, nor a transcript's echo."""
    text = t.strip(raw)
    return F.when((F.col("stop_reason") != "max_tokens") & (text != "") & ~t.echoes_transcript(text), text)


def responded(rows: DataFrame, key: str, client, folder: str, samples: int = 1) -> DataFrame:
    """key, sample_index, response: samples of rows(key, prompt); what isn't whole is skipped and left for another run."""
    each = rows.select(key, F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("sample_index"), "prompt")
    named = each.select(F.concat(F.col(key).cast("string"), F.lit("_s"), F.col("sample_index").cast("string")).alias("item"), key, "sample_index", F.concat("prompt", F.lit("\nsample "), F.col("sample_index").cast("string")).alias("prompt"))
    answers = answered(named, "item", client, f"{folder}/respond", lambda a: a.withColumn("response", whole(F.col("raw"))).withColumn("done", F.col("response").isNotNull()), times(1))
    return answers.where("done").join(named.select("item", key, "sample_index"), "item").select(key, F.col("sample_index").cast("long").alias("sample_index"), "response")


def rewritten(rows: DataFrame, key: str, client, folder: str) -> tuple[DataFrame, DataFrame]:
    """(key, response; failures with why): an answer cut off at the first limit is asked once more at twice the limit."""
    decide = lambda a: a.withColumn("response", whole(F.col("raw"))).withColumn("done", F.col("stop_reason") != "max_tokens")
    answers = answered(rows, key, client, f"{folder}/rewrite", decide, times(2))
    last = answers.groupBy(key).agg(F.max_by(F.struct("raw", "response", "stop_reason"), "attempt").alias("x")).select(key, "x.*")
    why = F.when(F.col("stop_reason") == "max_tokens", "truncated").when(t.strip("raw") == "", "empty").otherwise("echo")
    return last.where("response is not null").select(key, "response"), last.where("response is null").select(key, why.alias("why"))


def baseline(rows: DataFrame, key: str, client, folder: str) -> DataFrame:
    """key, response without any system prompt; empty or cut answers are skipped."""
    decide = lambda a: a.withColumn("response", F.when(F.col("stop_reason") != "max_tokens", F.nullif(t.strip("raw"), F.lit("")))).withColumn("done", F.col("response").isNotNull())
    return answered(rows, key, client, f"{folder}/baseline", decide, times(1)).where("done").select(key, "response")


# ---- preferences


def pairs(rows: DataFrame, key: str, client, folder: str, arms: dict[str, dict]) -> DataFrame:
    """key, response_a, response_b: each arm's answers are kept on their own; a pair needs both."""
    got = {}
    for arm, given in arms.items():
        asked = rows.select(key, F.concat(F.lit(given["system_prompt"]), F.lit("\n"), "prompt").alias("prompt"))
        decide = lambda a: a.withColumn("response", F.when(F.col("stop_reason") != "max_tokens", F.nullif(t.strip("raw"), F.lit("")))).withColumn("done", F.col("response").isNotNull())
        got[arm] = answered(asked, key, client, f"{folder}/arm-{arm}", decide, times(1)).where("done").select(key, F.col("response").alias(f"response_{arm}"))
    return got["a"].join(got["b"], key)


# ---- judges


def patterns(rows: DataFrame, key: str, client, folder: str, most: int = 15) -> DataFrame:
    """id, pattern, is_defect: what scans of groups of documents (key, prompt) found, consolidated to the `most` named by most
    groups. Names are compared in lower case; one that any group calls a defect is one."""
    answers = answered(rows, key, client, f"{folder}/scan", lambda a: a.withColumn("done", F.lit(True)), times(1))
    found = answers.select(key, F.explode(F.from_json(parse.extract_json("raw"), "array<struct<pattern: string, is_defect: boolean>>")).alias("p"))
    named = found.select(key, F.lower(t.strip("p.pattern")).alias("pattern"), F.coalesce("p.is_defect", F.lit(False)).alias("is_defect")).where("pattern <> ''")
    top = named.groupBy("pattern").agg(F.count_distinct(key).alias("n"), F.bool_or("is_defect").alias("is_defect")).orderBy(F.desc("n"), "pattern").limit(most)
    rows_ = [(i, r.pattern, r.is_defect) for i, r in enumerate(top.collect())]  # `most` rows
    return rows.sparkSession.createDataFrame(rows_, "id int, pattern string, is_defect boolean")


def listed_numbers(rows: DataFrame, key: str, client, folder: str, stage: str) -> DataFrame:
    """key, ids: the whole numbers of a judge's list; null where the answer has none to read."""
    answers = answered(rows, key, client, f"{folder}/{stage}", lambda a: a.withColumn("done", F.lit(True)), times(1))
    found = F.from_json(parse.extract_json("raw"), "array<string>")
    return answers.select(key, F.when(found.isNotNull(), F.filter(F.transform(found, lambda x: x.try_cast("int")), lambda x: x.isNotNull())).alias("ids"))


def stated(rows: DataFrame, key: str, client, folder: str, stage: str = "reasons") -> DataFrame:
    """key, reasons: a judge's list of texts, blank ones left out; null where the answer is no list: failures are counted,
    never fatal."""
    answers = answered(rows, key, client, f"{folder}/{stage}", lambda a: a.withColumn("done", F.lit(True)), times(1))
    found = F.from_json(parse.extract_json("raw"), "array<string>")
    return answers.select(key, F.filter(F.transform(found, lambda x: t.strip(x)), lambda x: x != "").alias("reasons"))


def ideas(rows: DataFrame, key: str, client, folder: str) -> DataFrame:
    """key, idea: one line for each record; failures are dropped."""
    line = F.nullif(t.strip(F.substring_index(t.strip("raw"), "\n", 1)), F.lit(""))
    decide = lambda a: a.withColumn("idea", F.when(ended(), line)).withColumn("done", F.col("idea").isNotNull())
    return answered(rows, key, client, f"{folder}/ideas", decide, times(1)).where("done").select(key, "idea")
