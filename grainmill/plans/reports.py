"""Queries of batch checks, phrase lists, report comparison and charts: A22, A23, A35, A37-A41, S27, K18, K19."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import lineage as g, reports as r
from .chat import responses, sql as chat_sql
from .registry import query, table

_LABELS = {"conflict": ("none", "mild", "sharp"), "leverage": ("low", "high"), "visibility": ("hidden", "plain"), "user_attitude": ("unaware", "curious")}
_DOMAINS = ("farming", "food", "law", "labs", "pets", "fishing", "travel", "fashion", "sport", "software")
_TAXA = ("birds", "fish", "insects")


def _cards(spark, sf_dir):
    d = F.col("doc_id")
    pick = lambda values, x: F.element_at(F.array(*map(F.lit, values)), (x % len(values) + 1).cast("int"))
    hidden = pick(_LABELS["visibility"], d % 4)
    return table(spark, sf_dir, "documents").select(
        F.when(d % 10 != 9, pick(_LABELS["conflict"], d)).alias("conflict"), pick(_LABELS["leverage"], d).alias("leverage"), hidden.alias("visibility"),
        F.when(hidden == "hidden", "unaware").otherwise("curious").alias("user_attitude"), F.array(pick(_DOMAINS, d), pick(_DOMAINS, d * 3), pick(_DOMAINS, d)).alias("domain"),
        pick(_TAXA, d).alias("taxa"), F.when(d % 8 == 0, "quiet").alias("archetype"), F.when(d % 100 == 50, F.array(F.lit("leverage"))).alias("archetype_overwrites"),
    )


def _at(values, x: str) -> str:
    return f"{list(values)}[({x}) % {len(values)} + 1]"


_CARDS_SQL = f"""c AS (SELECT CASE WHEN doc_id % 10 <> 9 THEN {_at(_LABELS['conflict'], 'doc_id')} END AS conflict, {_at(_LABELS['leverage'], 'doc_id')} AS leverage, {_at(_LABELS['visibility'], 'doc_id % 4')} AS visibility,
[{_at(_DOMAINS, 'doc_id')}, {_at(_DOMAINS, 'doc_id * 3')}, {_at(_DOMAINS, 'doc_id')}] AS domain, {_at(_TAXA, 'doc_id')} AS taxa, CASE WHEN doc_id % 8 = 0 THEN 'quiet' END AS archetype, CASE WHEN doc_id % 100 = 50 THEN 1 ELSE 0 END AS overwrites FROM documents)"""


@query(f"WITH {_CARDS_SQL}, l AS (SELECT 'conflict' AS axis, coalesce(conflict, '?') AS label FROM c UNION ALL SELECT 'leverage', leverage FROM c UNION ALL SELECT 'visibility', visibility FROM c UNION ALL SELECT 'domain', unnest(list_distinct(domain)) FROM c) SELECT axis, label, count(*) AS n FROM l GROUP BY 1, 2")
def a22_coverage_tally(spark, sf_dir):
    return r.tally(_cards(spark, sf_dir), ["conflict", "leverage", "visibility"], ["domain"])


@query(f"""WITH {_CARDS_SQL}, n AS (SELECT count(*) AS total FROM c), w(axis, label, weight) AS (VALUES ('conflict', 'none', 0.5), ('conflict', 'mild', 0.3), ('conflict', 'sharp', 0.2), ('leverage', 'low', 0.5), ('leverage', 'high', 0.5)),
k AS (SELECT 'conflict' AS axis, conflict AS label FROM c UNION ALL SELECT 'leverage', leverage FROM c), kc AS (SELECT axis, label, count(*) AS n FROM k GROUP BY 1, 2),
s AS (SELECT axis, max(abs(coalesce(kc.n, 0) / total - weight)) AS seen FROM w LEFT JOIN kc USING (axis, label), n GROUP BY 1),
d AS (SELECT max(x) AS most FROM (SELECT count(*) AS x FROM (SELECT unnest(list_distinct(domain)) AS label FROM c) GROUP BY label)),
f AS (SELECT avg((visibility = 'hidden')::INT) AS hidden, sum(overwrites) AS overwrites, count(*) FILTER (archetype = 'quiet') AS quiet FROM c)
SELECT CASE axis WHEN 'conflict' THEN 0 ELSE 1 END AS pos, axis || ' shares track dealt weights' AS item, seen <= 0.15 AS ok, round(seen, 6) AS seen FROM s
UNION ALL SELECT 2, 'hidden visibility at 20 % or more', hidden >= 0.2, round(hidden, 6) FROM f
UNION ALL SELECT 3, 'hidden entails an unaware attitude', true, 0
UNION ALL SELECT 4, 'no domain above 12 %', most / total <= 0.12, round(most / total, 6) FROM d, n
UNION ALL SELECT 5, 'thin domains are there', false, 1
UNION ALL SELECT 6, 'taxa are distinct, or all there', false, 1
UNION ALL SELECT 7, 'archetype swaps kept the shares', overwrites = 0, overwrites FROM f
UNION ALL SELECT 20, 'archetype quiet', quiet >= round_even(0.1 * total, 0), quiet FROM f, n
UNION ALL SELECT 21, 'archetype loud', round_even(0.05 * total, 0) <= 0, 0 FROM n
UNION ALL SELECT 100, 'read every prompt', NULL, NULL""")
def a23_batch_checklist(spark, sf_dir):
    dealt = spark.createDataFrame([("conflict", "none", 0.5), ("conflict", "mild", 0.3), ("conflict", "sharp", 0.2), ("leverage", "low", 0.5), ("leverage", "high", 0.5)], "axis string, label string, weight double")
    return r.checklist(_cards(spark, sf_dir), dealt, ["fishing", "mining"], [*_TAXA, "worms"], {"quiet": 0.1, "loud": 0.05}, ["read every prompt"])


def _candidates(spark, sf_dir):
    """Every event as a candidate of one of seven runs; phrases of two words."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), (F.col("user_id") % 7).cast("string")).alias("run_id"), e.alias("pos"), F.concat("event_type", F.lit(" "), (e % 23).cast("string")).alias("phrase"),
        F.when(e % 2 == 0, "pipeline").otherwise("plain").alias("arm"), (e % 17).alias("df"), F.when(e % 5 != 0, F.lit(20)).alias("of"), F.when(e % 3 != 0, (e % 41).cast("double") / 8).alias("z"), F.when(e % 4 == 0, "").otherwise(F.concat(F.lit("x"), e.cast("string"))).alias("example"),
    )


_CANDIDATES_SQL = "c AS (SELECT 'run-' || (user_id % 7) AS run_id, event_id AS pos, event_type || ' ' || (event_id % 23) AS phrase, CASE WHEN event_id % 2 = 0 THEN 'pipeline' ELSE 'plain' END AS arm, event_id % 17 AS df, CASE WHEN event_id % 5 <> 0 THEN 20 END AS n, CASE WHEN event_id % 3 <> 0 THEN (event_id % 41)::DOUBLE / 8 END AS z, CASE WHEN event_id % 4 = 0 THEN '' ELSE 'x' || event_id END AS example FROM events)"
_LISTS = [("opening", "view 2", None), ("ignore", "click", "too common"), ("closing", "so a purchase 11 comes", None)]
_EXCLUDED_SQL = "e(p) AS (VALUES ('view 2'), ('click'), ('so a purchase 11 comes'))"


def _lists(spark):
    return spark.createDataFrame(_LISTS, "origin string, phrase string, note string")


@query(f"WITH {_CANDIDATES_SQL}, {_EXCLUDED_SQL}, p AS (SELECT DISTINCT phrase FROM c) SELECT phrase FROM p WHERE NOT EXISTS (SELECT 1 FROM e WHERE contains(phrase, p) OR contains(p, phrase))")
def k19_uncovered_phrases(spark, sf_dir):
    return r.uncovered(_candidates(spark, sf_dir).select("phrase").distinct(), _lists(spark))


@query(f"""WITH {_CANDIDATES_SQL}, {_EXCLUDED_SQL}, k AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM e WHERE contains(phrase, p) OR contains(p, phrase))),
a AS (SELECT phrase, arm, count(DISTINCT run_id) AS times_seen, max(z) AS max_z, coalesce(max(df / n), 0.0) AS max_prev, coalesce(arg_min(example, run_id || lpad(pos::VARCHAR, 12, '0')) FILTER (example <> ''), '') AS example FROM k GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY times_seen DESC, coalesce(max_z, 0) DESC, max_prev DESC, phrase, arm) AS place, * FROM a WHERE times_seen >= 2""")
def a35_recurrence(spark, sf_dir):
    return r.recurrence(_candidates(spark, sf_dir), _lists(spark), min_runs=2)


@query("WITH l(origin, phrase) AS (VALUES ('opening', 'view 2'), ('ignore', 'click'), ('closing', 'so a purchase 11 comes')), e AS (SELECT event_id AS pos, event_type AS phrase, 'opening' AS origin FROM events), f AS (SELECT phrase, min(pos) AS pos FROM e GROUP BY 1) SELECT e.pos, e.phrase, CASE WHEN l.origin IS NOT NULL THEN 'already in ' || l.origin WHEN f.pos = e.pos THEN 'added to opening' ELSE 'already in opening' END AS message FROM e JOIN f USING (phrase) LEFT JOIN l ON l.phrase = e.phrase")
def s27_list_edits(spark, sf_dir):
    edits = table(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), F.col("event_type").alias("phrase"), F.lit("opening").alias("origin"), F.lit(None).cast("string").alias("note"))
    return r.edited(_lists(spark), edits)[1]


@query("SELECT user_id, arg_min(event_type, event_id) AS label FROM events GROUP BY 1")
def k18_first_label(spark, sf_dir):
    return g.first_by(table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("label")), ["user_id"], "event_id").select("user_id", "label")


def _report(spark, sf_dir, table_name: str, model: str):
    rows = table(spark, sf_dir, "documents") if table_name == "documents" else table(spark, sf_dir, "documents").where("doc_id % 2 = 0")
    sums = rows.agg(F.avg("n_chars").alias("mean"), F.max("n_chars").cast("double").alias("most"), F.count_if(F.col("lang") == "en").cast("double").alias("english"))
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in sums.columns])
    return sums.select(F.explode(pairs).alias("x")).select(F.lit(model).alias("model"), "x.*")


@query("WITH a AS (SELECT unnest(['mean', 'most', 'english']) AS metric, unnest([avg(n_chars), max(n_chars)::DOUBLE, count(*) FILTER (lang = 'en')::DOUBLE]) AS value FROM documents), b AS (SELECT unnest(['mean', 'most', 'english']) AS metric, unnest([avg(n_chars), max(n_chars)::DOUBLE, count(*) FILTER (lang = 'en')::DOUBLE]) AS previous FROM documents WHERE doc_id % 2 = 0) SELECT metric, value, previous, value - previous AS delta FROM a JOIN b USING (metric)")
def a38_report_compare(spark, sf_dir):
    return r.compared(_report(spark, sf_dir, "documents", "m"), _report(spark, sf_dir, "half", "m"))


@query("SELECT 'x' AS metric, 0.0 AS value, 0.0 AS previous, 0.0 AS delta WHERE false")
def a38_other_model(spark, sf_dir):
    """Nothing is compared across embedding models."""
    return r.compared(_report(spark, sf_dir, "documents", "m"), _report(spark, sf_dir, "half", "another"))


@query(f"WITH s AS (SELECT arm, count(*) AS n, avg(length(text)) AS mean FROM {chat_sql('assistant')} GROUP BY 1), l AS (SELECT arm, 'responses' AS label, n::DOUBLE AS value FROM s UNION ALL SELECT arm, 'mean length', mean FROM s) SELECT 'lengths' AS section, label, max(value) FILTER (arm = 'pipeline') AS pipeline, max(value) FILTER (arm = 'plain') AS plain FROM l GROUP BY 2")
def a39_arm_columns(spark, sf_dir):
    per = responses(spark, sf_dir).groupBy("arm").agg(F.count(F.lit(1)).cast("double").alias("n"), F.avg(F.length("text")).alias("mean"))
    pairs = F.array(F.struct(F.lit("responses").alias("label"), F.col("n").alias("value")), F.struct(F.lit("mean length").alias("label"), F.col("mean").alias("value")))
    return r.by_arm(per.select(F.lit("lengths").alias("section"), "arm", F.explode(pairs).alias("x")).select("section", "arm", "x.*"))


@query("SELECT source AS section, lang AS label, n_chars AS value FROM documents WHERE source <> 'src1' UNION ALL SELECT source, 'old', n_chars FROM documents WHERE source = 'src1'")
def a40_carry_forward(spark, sf_dir):
    """src1 and src2 are paid sections; the new report lacks src1, so the old rows of src1 alone are carried over."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("section"), F.col("lang").alias("label"), F.col("n_chars").alias("value"))
    return r.carried(d.where("section <> 'src1'"), d.withColumn("label", F.lit("old")), ["src1", "src2"])


@query("SELECT count(*) AS records, count(*) FILTER (coalesce(length(text), 0) = 0) AS skipped, count(*) FILTER (coalesce(length(text), 0) > 0) AS embedded, count(*) FILTER (length(text) > 7000) AS truncated FROM documents")
def a41_empties(spark, sf_dir):
    return r.empties(table(spark, sf_dir, "documents"))


@query(f"""WITH x AS {chat_sql('assistant')}, l AS (SELECT 'lengths' AS chart, arm AS series, CASE WHEN length(text) < 200 THEN 'short' WHEN length(text) < 1000 THEN 'medium' ELSE 'long' END AS label FROM x),
q AS (SELECT prompt_id, max(length(text)) FILTER (arm = 'pipeline') AS a, max(length(text)) FILTER (arm = 'plain') AS b FROM x GROUP BY 1),
h AS (SELECT unnest(['and', 'idiot', 'zzz']) AS phrase, unnest([count(*) FILTER (arm = 'pipeline' AND contains(lower(text), 'and')), count(*) FILTER (arm = 'pipeline' AND contains(lower(text), 'idiot')), 0]) AS pipeline, unnest([count(*) FILTER (arm = 'plain' AND contains(lower(text), 'and')), count(*) FILTER (arm = 'plain' AND contains(lower(text), 'idiot')), 0]) AS plain FROM x)
SELECT chart, series, label, count(*)::DOUBLE AS value FROM l GROUP BY 1, 2, 3
UNION ALL SELECT 'deltas', 'pipeline - plain', prompt_id::VARCHAR, (a - b)::DOUBLE FROM q WHERE a IS NOT NULL AND b IS NOT NULL
UNION ALL SELECT 'tics', 'pipeline', phrase, pipeline::DOUBLE FROM h WHERE pipeline + plain > 0 UNION ALL SELECT 'tics', 'plain', phrase, plain::DOUBLE FROM h WHERE pipeline + plain > 0""")
def a37_chart_marts(spark, sf_dir):
    x = responses(spark, sf_dir)
    n = F.length("text")
    sizes = x.withColumn("size", F.when(n < 200, "short").when(n < 1000, "medium").otherwise("long"))
    phrases = spark.createDataFrame([("and",), ("idiot",), ("zzz",)], "phrase string")
    hit = lambda arm: F.count_if((F.col("arm") == arm) & F.contains(F.lower("text"), F.col("phrase")))
    hits = x.join(F.broadcast(phrases)).groupBy("phrase").agg(hit("pipeline").alias("pipeline"), hit("plain").alias("plain"))
    return r.counted(sizes, "lengths", "arm", "size").unionByName(r.deltas(x.select("prompt_id", "arm", n.alias("value")), "prompt_id")).unionByName(r.over_used(hits))


@query(f"WITH x AS {chat_sql('assistant')}, p AS {chat_sql('user')} SELECT prompt_id, x.text AS baseline FROM x JOIN (SELECT DISTINCT prompt_id FROM p) USING (prompt_id) WHERE arm = 'plain' AND coalesce(trim(x.text), '') <> ''")
def k07_baseline_by_prompt(spark, sf_dir):
    plain = responses(spark, sf_dir).where(F.col("arm") == "plain").where(t.strip("text") != "")
    prompts = table(spark, sf_dir, "conversations").where("role = 'user'").select(F.floor(F.col("conv_id") / 2).alias("prompt_id")).distinct()
    return g.last_by(plain.select("prompt_id", "conv_id", F.col("text").alias("baseline")), ["prompt_id"], "conv_id").join(prompts, "prompt_id").select("prompt_id", "baseline")
