"""Queries of runs, templates, libraries and preference inputs: S08, S11, S12, S14, S16-S18, S23, S25, S28, I04, I05, K11, P06, P07."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions import parse
from ..operators import lineage as g
from ..sources import files, runs, store
from .registry import query, table


@query("WITH x AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN '=== SYSTEM PROMPT ===' || chr(10) || lang || chr(10) || '=== USER PROMPT ===' || chr(10) || source WHEN 2 THEN '=== USER PROMPT ===' || source ELSE lang || ' === USER PROMPT === ' || source || ' === USER PROMPT ===' END AS p FROM documents) SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN lang WHEN 3 THEN lang END AS system, CASE doc_id % 4 WHEN 0 THEN trim(p, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) WHEN 3 THEN source || ' === USER PROMPT ===' ELSE source END AS user FROM x JOIN documents USING (doc_id)")
def s08_split_sections(spark, sf_dir):
    d = F.col("doc_id") % 4
    prompt = F.when(d == 0, F.col("text")).when(d == 1, F.concat(F.lit("=== SYSTEM PROMPT ===\n"), "lang", F.lit("\n=== USER PROMPT ===\n"), "source")).when(d == 2, F.concat(F.lit("=== USER PROMPT ==="), "source")).otherwise(F.concat("lang", F.lit(" === USER PROMPT === "), "source", F.lit(" === USER PROMPT ===")))
    rows = table(spark, sf_dir, "documents").select("doc_id", prompt.alias("p"))
    system, user = runs.split_sections(F.col("p"))
    return rows.select("doc_id", system.alias("system"), user.alias("user"))


@query("SELECT n_nationkey AS id, n_name || chr(10) || '---' || chr(10) || chr(10) || r_name AS text FROM nation JOIN region ON n_regionkey = r_regionkey")
def s11_joined_parts(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(F.col("n_nationkey").alias("id"), runs.joined_parts(F.col("n_name"), F.col("r_name")).alias("text"))


@query("SELECT n_name AS id, 'claim, \"' || n_nationkey || '\"' AS claim, row_number() OVER (ORDER BY n_nationkey) - 1 AS pos FROM nation")
def s12_library(spark, sf_dir):
    """A library under an older name is found, in file order."""
    import json

    folder = store.new_path(spark, "prompts")
    names = [r.n_name for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()]  # 25 rows
    runs.write_text(spark, f"{folder}/old_library.json", json.dumps({"principles": [{"id": n, "claim": f'claim, "{k}"'} for k, n in enumerate(names)]}))
    return runs.library(spark, folder, older=["older.json", "old_library.json"]).select("id", "claim", "pos")


@query("WITH a AS (SELECT user_id, [event_type, 'nothing', 'view'] AS ids FROM events) SELECT user_id, count(*) AS n, min(event_type) AS least FROM (SELECT user_id, unnest(ids) AS event_type FROM a) WHERE event_type IN ('click', 'view') GROUP BY 1")
def k13_chosen_entries(spark, sf_dir):
    entries = spark.createDataFrame([("view", "v", 0), ("click", "c", 1)], "id string, claim string, pos long")
    asked = table(spark, sf_dir, "events").groupBy("user_id").agg(F.flatten(F.collect_list(F.array("event_type", F.lit("nothing"), F.lit("view")))).alias("ids"))
    return runs.chosen_entries(asked, entries, "user_id").select("user_id", F.size("entries").cast("long").alias("n"), F.array_min(F.transform("entries", lambda e: e["id"])).alias("least"))


@query("SELECT unnest(['2024-01-02_03-04_first', '2024-01-02_03-04_first-2', '2024-01-03_00-00_other']) AS run_id, unnest(['first', 'first', 'other']) AS label, unnest(['m', 'm', NULL]) AS model")
def s14_run_creation(spark, sf_dir):
    """A second run of the same minute and label gets a number; folders without a manifest are no runs."""
    root = store.new_path(spark, "runs")
    for stamp, label, config in (("2024-01-02_03-04", "first", {"model": "m"}), ("2024-01-02_03-04", "first", {"model": "m"}), ("2024-01-03_00-00", "other", {})):
        runs.create(spark, root, stamp, label, config, {"prompt.txt": "hello"})
    runs.write_text(spark, f"{root}/2025-01-01_00-00_stray/notes.txt", "no manifest")
    return runs.manifests(spark, root).select("run_id", "label", "model")


@query("SELECT unnest(['backend', 'model', 'workers']) AS setting, unnest(['api', 'a', NULL]) AS was, unnest([NULL, 'b', '8']) AS now")
def s16_changed_settings(spark, sf_dir):
    manifest = spark.createDataFrame([("backend", "api"), ("model", "a"), ("seed", "7")], "setting string, value string")
    return runs.changed_settings(manifest, {"model": "b", "seed": "7", "workers": "8"})


@query("""WITH e AS (SELECT 'run-' || (user_id % 9) AS run_id, CASE WHEN event_id % 4 = 0 THEN 'final' WHEN event_id % 4 = 1 AND user_id % 9 <> 3 THEN 'scores' ELSE 'drafts' END AS stage, value FROM events),
c AS (SELECT run_id, stage, count(*) AS n FROM e GROUP BY 1, 2), l AS (SELECT run_id, string_agg(stage || '=' || n, ',' ORDER BY stage) AS counts, max(n) FILTER (stage = 'final') / max(n) FILTER (stage = 'scores') AS pass_rate FROM c GROUP BY 1)
SELECT l.run_id, counts, pass_rate, (SELECT round(sum(value), 4) FROM e WHERE e.run_id = l.run_id) AS total_cost FROM l""")
def s17_run_listing(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    d, u = F.col("event_id") % 4, F.col("user_id") % 9
    rows = e.select(F.concat(F.lit("run-"), u.cast("string")).alias("run_id"), F.when(d == 0, "final").when((d == 1) & (u != 3), "scores").otherwise("drafts").alias("stage"), F.col("value").alias("cost_usd"))
    listed = runs.listed(rows.select("run_id").distinct(), rows.select("run_id", "stage"), rows.select("run_id", "cost_usd"))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("counts")), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ",")
    return listed.select("run_id", shown.alias("counts"), "pass_rate", "total_cost")


@query("SELECT doc_id, lang FROM documents")
def s18_stage_read(spark, sf_dir):
    """The second read sees the file's new state."""
    held, path = runs.Stages(spark), store.new_path(spark, "stage")
    assert held.read(path, "doc_id long, lang string").isEmpty()
    files.save_jsonl(table(spark, sf_dir, "documents").select("doc_id", "lang"), path)
    return held.read(path, "doc_id long, lang string")


@query("SELECT doc_id, round(length(coalesce(text, '')) * 0.02 / 1e6, 6) AS cost_usd, false AS unknown_model FROM documents")
def s23_embedding_cost(spark, sf_dir):
    """Embedding calls have input tokens only."""
    calls = table(spark, sf_dir, "documents").select("doc_id", F.lit("e").alias("model"), F.length(F.coalesce("text", F.lit(""))).alias("input_tokens"), F.lit(0).alias("output_tokens"), F.lit(None).cast("int").alias("cache_creation_tokens"), F.lit(None).cast("int").alias("cache_read_tokens"))
    return g.priced(calls, spark.createDataFrame([("e", 0.02, 0.0)], "model string, price_in double, price_out double"), (5.0, 25.0)).select("doc_id", "cost_usd", "unknown_model")


@query("SELECT event_id AS pos, CASE event_id % 3 WHEN 0 THEN 'p' || event_id WHEN 1 THEN 's' || event_id ELSE 'row' || printf('%04d', event_id) END AS prompt_id, CASE WHEN event_id % 5 = 0 THEN 'ask ' ELSE '' END || event_type AS user_message FROM events WHERE event_id % 7 <> 0")
def s25_preference_prompts(spark, sf_dir):
    e = F.col("event_id")
    some = lambda keep, x: F.when(keep, x).otherwise(F.lit(""))
    rows = table(spark, sf_dir, "events").select(
        e.alias("pos"), some((e % 5 == 0) & (e % 7 != 0), F.concat(F.lit(" ask "), "event_type")).alias("user_message"), F.when(e % 7 != 0, F.concat("event_type", F.lit("\n"))).alias("prompt"),
        some(e % 3 == 0, F.concat(F.lit("p"), e.cast("string"))).alias("prompt_id"), some(e % 3 == 1, F.concat(F.lit("s"), e.cast("string"))).alias("scenario_id"),
    )
    return runs.preference_prompts(rows)


@query("SELECT n_name AS name, CASE WHEN n_nationkey % 3 = 0 THEN 'old ' || n_name WHEN n_nationkey % 3 = 1 THEN 'new ' || n_name END AS text, CASE n_nationkey % 3 WHEN 0 THEN 'snapshot' WHEN 1 THEN 'live' ELSE 'missing' END AS source FROM nation")
def s28_template_source(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    old = n.where("n_nationkey % 3 = 0").select(F.col("n_name").alias("name"), F.concat(F.lit("old "), "n_name").alias("text"))
    new = n.select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 3 < 2, F.concat(F.lit("new "), "n_name")).alias("text"))
    return runs.template_source(old, new)


@query("WITH m AS (SELECT max(doc_id + 5) AS top FROM documents WHERE doc_id % 3 = 0) SELECT doc_id, printf('AW-%04d', CASE WHEN doc_id % 3 = 0 THEN doc_id + 5 ELSE top + row_number() OVER (PARTITION BY doc_id % 3 = 0 ORDER BY doc_id) END) AS prompt_id FROM documents, m")
def i04_next_prompt_id(spark, sf_dir):
    """Rows without an id are numbered above the greatest one."""
    d = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(d % 3 == 0, F.format_string("AW-%04d", d + 5)).alias("prompt_id"))
    return g.numbered(rows, "prompt_id", "AW", "doc_id").select("doc_id", "prompt_id")


@query("WITH r AS (SELECT doc_id // 100 AS run, doc_id, CASE WHEN doc_id // 100 >= 2 AND doc_id % 10 = 0 THEN 'P-' || doc_id END AS gid FROM documents), f AS (SELECT min(run) AS first FROM r WHERE gid IS NOT NULL) SELECT doc_id, CASE WHEN run >= first THEN coalesce(gid, 'new') END AS gid FROM r, f")
def i05_backfill(spark, sf_dir):
    """Ids are filled in from the first run that has any; earlier runs stay without."""
    d = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.floor(d / 100).alias("run"), F.when((d >= 200) & (d % 10 == 0), F.concat(F.lit("P-"), d.cast("string"))).alias("gid"), F.lit("new").alias("found"))
    return g.backfilled(rows, "run", "gid", "found").select("doc_id", "gid")


@query("""WITH a AS (SELECT doc_id, source AS scenario, lang AS injection FROM documents WHERE doc_id % 2 = 0), b AS (SELECT doc_id, source AS scenario, lang AS injection FROM documents WHERE doc_id % 2 = 1 AND doc_id % 5 <> 0),
x AS (SELECT scenario, injection, count(*) AS n FROM a WHERE starts_with(scenario, 'src1') GROUP BY 1, 2), y AS (SELECT scenario, injection, count(*) AS n FROM b WHERE starts_with(scenario, 'src1') GROUP BY 1, 2), u AS (SELECT injection, count(*) AS n FROM a WHERE NOT starts_with(scenario, 'src1') GROUP BY 1), v AS (SELECT injection, count(*) AS n FROM b WHERE NOT starts_with(scenario, 'src1') GROUP BY 1)
SELECT scenario || ' [' || injection || ']' AS label, 'exact' AS kind, x.n AS in_a, y.n AS in_b FROM x JOIN y USING (scenario, injection) UNION ALL SELECT 'principle p [' || injection || ']', 'group', u.n, v.n FROM u JOIN v USING (injection)""")
def k11_legacy_match(spark, sf_dir):
    """Scenarios of a fixed set match exactly, all others by principle."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("scenario"), F.lit("p").alias("principle"), F.col("lang").alias("injection"))
    return g.legacy_matched(d.where("doc_id % 2 = 0"), d.where("doc_id % 2 = 1 and doc_id % 5 <> 0"), "src1")


@query("WITH p AS (SELECT doc_id AS pair_id, CASE WHEN doc_id % 3 = 0 THEN 'b' ELSE 'a' END AS left_arm FROM documents WHERE doc_id % 2 = 0) SELECT pair_id, 'ann' AS rater, c AS choice, CASE WHEN c = 'left' THEN left_arm WHEN c = 'right' THEN CASE WHEN left_arm = 'a' THEN 'b' ELSE 'a' END END AS chosen_arm, left_arm, 'note' AS note FROM (SELECT *, ['left', 'right', 'tie', 'both_bad'][pair_id % 8 // 2 + 1] AS c FROM p)")
def p06_record_ratings(spark, sf_dir):
    d = F.col("doc_id")
    pairs = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select(d.alias("pair_id"), F.when(d % 3 == 0, "b").otherwise("a").alias("left_arm"))
    choice = F.element_at(F.array(*map(F.lit, runs.CHOICES)), (F.floor(F.col("pair_id") % 8 / 2) + 1).cast("int"))
    fresh = pairs.select("pair_id", F.lit("ann").alias("rater"), choice.alias("choice"), F.lit(" note ").alias("note"))
    none = spark.createDataFrame([], "pair_id long, rater string, choice string, chosen_arm string, left_arm string, note string")
    return runs.rated(none, fresh, pairs)


@query("WITH r AS (SELECT DISTINCT 'run-' || lpad((user_id % 30)::VARCHAR, 2, '0') AS run_id FROM events WHERE user_id % 30 <> 4) SELECT row_number() OVER (ORDER BY run_id DESC) AS place, run_id FROM r")
def p07_runs_with_pairs(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("run-"), F.lpad((F.col("user_id") % 30).cast("string"), 2, "0")).alias("run_id"), "user_id")
    return runs.runs_with_pairs(e.select("run_id").distinct(), e.where("user_id % 30 <> 4"))


@query()
def t29_word_diff(spark, sf_dir):
    """Each document against the next one's words; difflib's alignment has no SQL."""
    d = table(spark, sf_dir, "benchmark").select("item_id", "text")
    after = F.lead("text", 1, "").over(Window.orderBy("item_id"))  # the benchmark is a short list
    return d.select("item_id", parse.word_diff(F.col("text"), after).alias("html"))


@query("SELECT 'second' AS pass, count(*) FILTER (doc_id % 3 <> 0) AS appended, count(*) AS there FROM documents")
def s03_append_and_mark(spark, sf_dir):
    """A third of the rows first; the second pass appends only the others."""
    path, marks = store.new_path(spark, "records"), store.new_path(spark, "marks")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    files.append_and_mark(d.where("doc_id % 3 = 0"), path, marks, "doc_id")
    fresh = files.append_and_mark(d, path, marks, "doc_id")
    there = files.load_jsonl(spark, path, "doc_id long, lang string").agg(F.count_distinct("doc_id").alias("there"))
    return fresh.agg(F.count(F.lit(1)).alias("appended")).crossJoin(there).select(F.lit("second").alias("pass"), "appended", "there")  # one row each


@query("WITH r AS (SELECT DISTINCT '2024-0' || (1 + user_id % 9) || '-01_00-00_run' AS run_id FROM events) SELECT max(run_id) AS run_id FROM r")
def s15_newest_run(spark, sf_dir):
    r = table(spark, sf_dir, "events").select(F.concat(F.lit("2024-0"), (1 + F.col("user_id") % 9).cast("string"), F.lit("-01_00-00_run")).alias("run_id")).distinct()
    odd = spark.createDataFrame([("zz-not-a-run",)], "run_id string")
    return files.newest(r.unionByName(odd))


@query("WITH h AS (SELECT doc_id, md5(doc_id::VARCHAR || chr(31) || coalesce(lang, chr(0)) || chr(31) || coalesce(source, chr(0))) AS h FROM documents) SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS record_id FROM h")
def i06_record_id(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", g.record_id(F.col("doc_id"), F.col("lang"), F.col("source")).alias("record_id"))


@query("SELECT item_id, CASE WHEN item_id % 3 = 0 THEN item_id END AS a, item_id % 3 = 0 AS is_object FROM benchmark")
def j02_objects_only(spark, sf_dir):
    """A list, or no JSON at all, where an object was asked for counts as unreadable."""
    i = F.col("item_id")
    raw = F.when(i % 3 == 0, F.concat(F.lit('sure: {"a": '), i.cast("string"), F.lit("}"))).when(i % 3 == 1, F.concat(F.lit("["), i.cast("string"), F.lit("]"))).otherwise("none")
    rows = table(spark, sf_dir, "benchmark").select("item_id", parse.json_object(raw).alias("j"))
    return rows.select("item_id", F.get_json_object("j", "$.a").try_cast("long").alias("a"), F.col("j").isNotNull().alias("is_object"))
