"""Queries over judgments: A30-A33, J10. Judgments are derived from the tables' numbers, so that SQL can state them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import judged as j, reports as r
from .registry import query, table

_PATTERNS = [(0, "opens alike", True), (1, "lists three", False), (2, "ends with a question", True), (3, "never seen", True)]
_PATTERNS_SQL = "p(id, pattern, is_defect) AS (VALUES (0, 'opens alike', true), (1, 'lists three', false), (2, 'ends with a question', true), (3, 'never seen', true))"


def _ids(spark, sf_dir):
    """Judgments with numbers out of range and repeats."""
    d = F.col("doc_id").cast("int")
    raw = F.array(d % 2, d % 7, d % 2, F.lit(99), F.lit(-1))
    return table(spark, sf_dir, "documents").select("doc_id", raw.alias("raw"))


_IDS_SQL = "r AS (SELECT doc_id, [doc_id % 2, doc_id % 7, doc_id % 2, 99, -1] AS raw FROM documents)"


@query(f"WITH {_IDS_SQL} SELECT doc_id, list_sort(list_distinct(list_filter(raw, lambda x: x BETWEEN 0 AND 3))) AS ids FROM r")
def j10_known_ids(spark, sf_dir):
    rows = _ids(spark, sf_dir).select("doc_id", F.array_sort(j.known(F.col("raw"), F.array(*map(F.lit, range(4))))).alias("ids"))
    return rows.withColumn("ids", F.col("ids").cast("array<long>"))


@query("SELECT CASE WHEN lower(trim(event_type)) IN ('click', 'view') THEN lower(trim(event_type)) ELSE 'other' END AS type, count(*) AS n FROM events GROUP BY 1")
def j10_folded_labels(spark, sf_dir):
    return j.type_histogram(table(spark, sf_dir, "events").select(F.concat(F.lit(" "), F.initcap("event_type")).alias("type")), ("click", "view"))


@query(f"WITH {_IDS_SQL}, {_PATTERNS_SQL}, h AS (SELECT id, count(DISTINCT doc_id) AS hits FROM r, unnest(raw) u(id) GROUP BY 1), n AS (SELECT count(*) AS total FROM r) SELECT p.id, pattern, is_defect, round(coalesce(hits, 0) / greatest(total, 1), 3) AS prevalence, is_defect AND coalesce(hits, 0) / greatest(total, 1) > 0.3 AS flagged FROM p LEFT JOIN h USING (id), n")
def a30_pattern_prevalence(spark, sf_dir):
    patterns = spark.createDataFrame(_PATTERNS, "id int, pattern string, is_defect boolean")
    judged = _ids(spark, sf_dir).select("doc_id", j.known(F.col("raw"), F.array(*map(F.lit, range(4)))).alias("ids"))
    return j.prevalence(patterns, judged)


@query("WITH r AS (SELECT doc_id, doc_id % 5 AS a, doc_id % 40 AS b FROM documents WHERE doc_id % 9 <> 0), h AS (SELECT number, count(DISTINCT doc_id) AS hits FROM (SELECT doc_id, a AS number FROM r UNION ALL SELECT doc_id, b FROM r) GROUP BY 1), n AS (SELECT count(*) AS rated FROM r) SELECT n_nationkey AS number, n_name AS principle, round(coalesce(hits, 0) / rated, 3) AS share, coalesce(hits, 0) / rated < 0.05 AS starved FROM nation LEFT JOIN h ON number = n_nationkey, n")
def a31_principle_coverage(spark, sf_dir):
    d = F.col("doc_id")
    ids = F.when(d % 9 != 0, F.array(d % 5, d % 40))
    principles = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("number"), F.col("n_name").alias("principle"))
    return j.coverage(principles, table(spark, sf_dir, "documents").select("doc_id", ids.alias("ids")))


def _cases(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    id_ = F.col("doc_id")
    some = F.transform(F.sequence(F.lit(0), (id_ % 4).cast("int")), lambda i: F.concat(F.lit("r"), ((id_ + i * 7) % 50).cast("string")))
    return d.select(F.floor(id_ / 2).alias("prompt_id"), F.when(id_ % 2 == 0, "pipeline").otherwise("plain").alias("arm"), F.when(id_ % 11 != 0, some).alias("reasons"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"), (id_ % 3).alias("added"))


@query("WITH c AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'pipeline' ELSE 'plain' END AS arm, coalesce(length(text), 0) AS chars, doc_id % 3 AS added FROM documents WHERE doc_id % 11 <> 0), r AS (SELECT arm, (doc_id + i * 7) % 50 AS reason FROM c, range(0, 4) t(i) WHERE i <= doc_id % 4), e AS (SELECT arm, count(*) AS n, sum(doc_id % 4 + 1) AS total, sum(chars) AS chars, sum(added) AS checkback FROM c GROUP BY 1) SELECT arm, n, round(total / n, 2) AS mean_unique, (SELECT count(DISTINCT reason) FROM r WHERE r.arm = e.arm) AS corpus_distinct, CASE WHEN chars > 0 THEN round(total / chars * 1000, 2) ELSE 0.0 END AS density_per_1k, checkback FROM e")
def a32_reason_stats(spark, sf_dir):
    return j.reasons(_cases(spark, sf_dir))


def _anchored(spark, sf_dir, text: str):
    """A list of up to five anchored points with verdicts, and additions of which some are blank."""
    id_ = F.col("doc_id")
    point = lambda i: F.struct(F.concat(F.lit("p"), i.cast("string")).alias(text), F.element_at(F.array(*map(F.lit, ("kept", "weakened", "dropped", "unclear"))), ((id_ + i) % 4 + 1).cast("int")).alias("verdict"))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("prompt_id"), F.when(id_ % 13 != 0, F.transform(F.sequence(F.lit(0), (id_ % 5).cast("int")), point)).alias("anchored"), F.when(id_ % 3 == 0, F.array(F.lit("more"), F.lit(" "))).otherwise(F.array(F.lit("one"), F.lit("two"))).alias("added"))


_ANCHORED_SQL = "c AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END AS added FROM documents WHERE doc_id % 13 <> 0), a AS (SELECT doc_id, (doc_id + i) % 4 AS v FROM c, range(0, 5) t(i) WHERE i <= doc_id % 5)"


@query(f"WITH {_ANCHORED_SQL}, s AS (SELECT (SELECT count(*) FROM c) AS judged, count(*) FILTER (v = 0) AS kept, count(*) FILTER (v = 1) AS weakened, count(*) FILTER (v = 2) AS dropped, (SELECT sum(added) FROM c) AS added FROM a), t AS (SELECT *, dropped / (kept + weakened + dropped) AS x FROM s) SELECT judged, kept, weakened, dropped, round(x, 3) AS dropped_share, CASE WHEN x <= 0.1 THEN 'GOOD' WHEN x <= 0.3 THEN 'OK' ELSE 'BAD' END AS verdict, added, round(added / judged, 1) AS added_per_response FROM t")
def a32_reason_survival(spark, sf_dir):
    return j.survival(_anchored(spark, sf_dir, "reason"))


@query(f"WITH {_ANCHORED_SQL}, s AS (SELECT (SELECT count(*) FROM c) AS n, count(*) FILTER (v < 3) AS plain, count(*) FILTER (v < 2) + (SELECT sum(added) FROM c) AS pipeline, (SELECT sum(added) FROM c) AS extra FROM a) SELECT n, round(pipeline / n, 2) AS pipeline_mean, round(plain / n, 2) AS plain_mean, extra AS pipeline_only, CASE WHEN extra / n >= 0.5 THEN 'GOOD' WHEN extra / n >= 0.2 THEN 'OK' ELSE 'BAD' END AS verdict FROM s")
def a33_alternatives(spark, sf_dir):
    return j.alternatives(_anchored(spark, sf_dir, "alternative").where("anchored is not null"))


@query("""WITH c AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'pipeline' ELSE 'plain' END AS arm, CASE WHEN doc_id % 6 < 5 THEN doc_id % 3 = 0 END AS defers, doc_id % 4 = 1 AS calibrated, doc_id % 7 = 0 AS moralizes, CASE doc_id % 5 WHEN 0 THEN 'over_refusal' WHEN 1 THEN 'appropriate_refusal' ELSE 'engages' END AS e FROM documents),
l AS (SELECT arm, unnest(['defers', 'calibrated', 'moralizes', 'engagement:engages', 'engagement:appropriate_refusal', 'engagement:over_refusal']) AS trait, unnest([coalesce(defers, false), calibrated, moralizes, e = 'engages', e = 'appropriate_refusal', e = 'over_refusal']) AS x FROM c),
s AS (SELECT arm, trait, avg(x::INT) AS s FROM l GROUP BY 1, 2) SELECT arm, trait, round(s, 3) AS share, CASE WHEN trait = 'moralizes' AND arm = 'pipeline' THEN CASE WHEN s <= 0.1 THEN 'GOOD' WHEN s <= 0.3 THEN 'OK' ELSE 'BAD' END END AS verdict FROM s""")
def a33_stance(spark, sf_dir):
    d = F.col("doc_id")
    engagement = F.when(d % 5 == 0, "Over_Refusal ").when(d % 5 == 1, "appropriate_refusal").when(d % 5 == 2, "engages").when(d % 5 == 3, "dances")
    rows = table(spark, sf_dir, "documents").select(F.when(d % 2 == 0, "pipeline").otherwise("plain").alias("arm"), F.when(d % 6 < 5, d % 3 == 0).alias("defers"), (d % 4 == 1).alias("calibrated"), (d % 7 == 0).alias("moralizes"), engagement.alias("engagement"))
    return j.stance(rows)


_MARTS_SQL = f"""{_ANCHORED_SQL}, cat(v, name, k) AS (VALUES (0, 'kept', 0), (1, 'weakened', 1), (2, 'dropped', 2)),
p AS (SELECT doc_id, i, (doc_id + i) % 4 AS v FROM c, range(0, 5) t(i) WHERE i <= doc_id % 5),
s AS (SELECT doc_id, name, count(*) AS n, string_agg('p' || i, ' • ' ORDER BY i) AS detail FROM p JOIN cat USING (v) GROUP BY 1, 2),
r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'pipeline' ELSE 'plain' END AS arm, doc_id % 4 + 1 AS n, (SELECT string_agg('r' || ((doc_id + i * 7) % 50), ' • ' ORDER BY i) FROM range(0, 4) t(i) WHERE i <= doc_id % 4) AS detail FROM documents WHERE doc_id % 11 <> 0),
u AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS ids FROM events WHERE event_type IS NOT NULL GROUP BY 1)"""


@query(f"""WITH {_MARTS_SQL}
SELECT 'survival' AS chart, name AS series, doc_id::VARCHAR AS label, n::DOUBLE AS value, detail FROM s
UNION ALL SELECT 'survival', 'added', doc_id::VARCHAR, 2.0, CASE WHEN doc_id % 3 = 0 THEN 'more •  ' ELSE 'one • two' END FROM c
UNION ALL SELECT 'reasons', arm, (doc_id // 2)::VARCHAR, n::DOUBLE, detail FROM r
UNION ALL SELECT 'alternatives', 'plain', doc_id::VARCHAR, count(*)::DOUBLE, NULL FROM p GROUP BY doc_id
UNION ALL SELECT 'alternatives', 'pipeline', doc_id::VARCHAR, (count(*) FILTER (v < 2) + 2)::DOUBLE, NULL FROM p GROUP BY doc_id""")
def a37_reason_marts(spark, sf_dir):
    """What became of each record's reasons, how many each arm gives, and what each offers beside."""
    judged = _anchored(spark, sf_dir, "reason")
    return r.survived(judged, "reason").unionByName(r.reason_counts(_cases(spark, sf_dir))).unionByName(r.offered(judged))


@query(f"""WITH {_MARTS_SQL}, m AS (SELECT count(*) AS n, event_type FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 2), lib(entry, move) AS (VALUES ('view', 'look'), ('purchase', 'buy'), ('never', 'none'))
SELECT 'pulls' AS chart, 'pulled' AS series, user_id::VARCHAR AS label, len(ids)::DOUBLE AS value, array_to_string(ids, ', ') AS detail FROM u
UNION ALL SELECT 'scatter', len(ids)::VARCHAR, user_id::VARCHAR, 2.0, array_to_string(ids, ', ') FROM u JOIN c ON c.doc_id = u.user_id
UNION ALL SELECT 'triggers', move, entry, coalesce(n, 0)::DOUBLE, NULL FROM lib LEFT JOIN m ON m.event_type = entry""")
def a37_library_marts(spark, sf_dir):
    """What each record pulled from a library, against what was added to it, and how often each entry was pulled."""
    pulled = table(spark, sf_dir, "events").where("event_type is not null").groupBy(F.col("user_id").alias("prompt_id")).agg(F.array_sort(F.collect_set("event_type")).alias("ids"))
    library = spark.createDataFrame([("view", "look"), ("purchase", "buy"), ("never", "none")], "entry string, move string")
    return r.pulls(pulled).unionByName(r.pull_scatter(pulled, _anchored(spark, sf_dir, "reason"))).unionByName(r.triggers(pulled, library))


@query("""WITH c AS (SELECT doc_id // 2 AS p, sum(CASE WHEN doc_id % 2 = 0 THEN coalesce(length(text), 0) END) AS a, sum(CASE WHEN doc_id % 2 = 1 THEN coalesce(length(text), 0) END) AS b,
  sum(CASE WHEN doc_id % 2 = 0 AND doc_id % 11 <> 0 THEN doc_id % 4 + 1 END) AS x, sum(CASE WHEN doc_id % 2 = 1 AND doc_id % 11 <> 0 THEN doc_id % 4 + 1 END) AS y FROM documents GROUP BY 1),
t AS (SELECT 'characters' AS metric, sum(b)::BIGINT AS plain, sum(a)::BIGINT AS pipeline FROM c WHERE a IS NOT NULL AND b IS NOT NULL UNION ALL SELECT 'unique reasons', sum(y)::BIGINT, sum(x)::BIGINT FROM c WHERE x IS NOT NULL AND y IS NOT NULL)
SELECT metric, plain, pipeline, pipeline - plain AS difference, CASE WHEN plain <> 0 THEN round((pipeline - plain) / plain, 6) END AS share FROM t WHERE plain IS NOT NULL""")
def a37_batch_totals(spark, sf_dir):
    """Characters and reasons of both arms over the records that both have."""
    cases = _cases(spark, sf_dir)
    sizes = cases.select("prompt_id", "arm", F.lit("characters").alias("metric"), F.col("chars").cast("long").alias("value"))
    return r.batch_totals(sizes.unionByName(cases.where("reasons is not null").select("prompt_id", "arm", F.lit("unique reasons").alias("metric"), F.size("reasons").cast("long").alias("value"))))
