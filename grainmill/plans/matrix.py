"""Queries M01 to M25, S04, S05 and S07 over a vocabulary of our own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import matrix as m
from .registry import query, table

VOCABULARY = """
# our own axes
{topic}
  0.5 :: rivers
  0.3 :: bridges
  0.2 :: clocks
{tone}
  dry
  warm
  brisk
{visibility}
  explicit
  implied
  hidden
{attitude}
  curious
  unaware
{conflict}
  none
  trap
{persona}
  formal
  plain
{opening}
  casual
  direct
{closing}
  trailing
  question
{frame}
  none
  report
{severity}
  low
  high
{scope}
  one
  many
"""
TEMPLATE = "Write about {topic} in a {tone} tone; open {opening}."
_AXES = m.parse_axes(VOCABULARY)
_VALUES = ", ".join(f"('{a}', {ap}, {p}, '{v}', {w!r}::DOUBLE)" for a, ap, p, v, w in _AXES)
_V = f"v(axis, axis_pos, pos, value, weight) AS (VALUES {_VALUES})"
_QUOTA = f"""{_V}, e AS (SELECT *, round(weight * 100, 9) AS x FROM v), f AS (SELECT *, floor(x) AS fl, x - floor(x) AS rm FROM e),
q AS (SELECT axis, axis_pos, pos, value, weight, (fl + (row_number() OVER (PARTITION BY axis ORDER BY rm DESC, pos) <= 100 - sum(fl) OVER (PARTITION BY axis))::INT)::BIGINT AS quota FROM f)"""
_DECK = f"""{_QUOTA}, c AS (SELECT axis, axis_pos, pos, value, unnest(range(1, quota + 1)) AS k FROM q),
d AS (SELECT row_number() OVER (PARTITION BY axis ORDER BY md5('7:' || axis || ':' || pos || ':' || k)) - 1 AS slot, axis, axis_pos, value FROM c)"""


def vocabulary(spark):
    return m.axes(spark, VOCABULARY)


def _deal(spark, n=100):
    return m.deal(vocabulary(spark), n, 7)


@query(f"WITH {_V} SELECT axis, axis_pos, pos, value, round(weight, 9) AS weight FROM v")
def s04_variables_file(spark, sf_dir):
    return vocabulary(spark).withColumn("weight", F.round("weight", 9))


@query(f"WITH {_V} SELECT axis, count(*) AS n, round(sum(weight), 9) AS total FROM v GROUP BY axis")
def s05_split_weights(spark, sf_dir):
    return vocabulary(spark).groupBy("axis").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("weight"), 9).alias("total"))


@query(f"WITH {_V} SELECT 'matrix_' || lpad((a.pos * 9 + b.pos * 3 + c.pos)::VARCHAR, 6, '0') AS prompt_id, a.value AS topic, b.value AS tone, c.value AS visibility FROM v a, v b, v c WHERE a.axis = 'topic' AND b.axis = 'tone' AND c.axis = 'visibility'")
def m01_cross_product(spark, sf_dir):
    return m.product(vocabulary(spark), ["topic", "tone", "visibility"])


@query(f"WITH {_QUOTA} SELECT axis, value, quota FROM q")
def m02_largest_remainder(spark, sf_dir):
    return m.quotas(vocabulary(spark), 100).select("axis", "value", "quota")


@query(f"WITH {_DECK} SELECT slot, axis, value FROM d")
def m03_deck_sample(spark, sf_dir):
    return m.decks(vocabulary(spark), 100, 7).select("slot", "axis", "value")


@query(f"WITH {_V}, e AS (SELECT *, round(weight * 100, 9) AS x FROM v), f AS (SELECT *, floor(x) AS fl, x - floor(x) AS rm FROM e) SELECT axis, value, (fl + (row_number() OVER (PARTITION BY axis ORDER BY rm DESC, md5('3:' || axis || ':' || pos)) <= 100 - sum(fl) OVER (PARTITION BY axis))::INT)::BIGINT AS quota FROM f")
def m04_random_ties(spark, sf_dir):
    return m.quotas(vocabulary(spark), 100, m.order_key(3, F.col("axis"), F.col("pos"))).select("axis", "value", "quota")


@query(f"WITH {_DECK} SELECT value, count(*) AS n FROM d WHERE axis = 'tone' GROUP BY value")
def m05_deal_axis(spark, sf_dir):
    return m.decks(vocabulary(spark).where("axis = 'tone'"), 100, 7).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


_TYPES = ["click here", "view", "viewport", "purchase order"]


@query("WITH a(v) AS (VALUES ('click here'), ('view'), ('viewport'), ('purchase order')), e AS (SELECT DISTINCT event_type FROM events), h AS (SELECT event_type, count(v) AS hits, min(v) AS one FROM e LEFT JOIN a ON starts_with(lower(v), lower(event_type)) GROUP BY 1) SELECT event_type, hits, CASE WHEN hits = 1 THEN one END AS resolved FROM h")
def m06_resolve_prefix(spark, sf_dir):
    from ..operators.rules import resolve_prefixes

    return resolve_prefixes(table(spark, sf_dir, "events").select("event_type").distinct(), "event_type", _TYPES).select("event_type", "hits", "resolved")


@query("SELECT c_mktsegment AS segment, CASE WHEN starts_with(lower(c_mktsegment), 'auto') THEN 'cars' WHEN starts_with(lower(c_mktsegment), 'build') THEN 'works' END AS payload, count(*) AS n FROM customer GROUP BY 1, 2")
def m07_payload_by_prefix(spark, sf_dir):
    rules = spark.createDataFrame([("auto", "cars"), ("build", "works")], "prefix string, payload string")
    seg = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    return seg.join(F.broadcast(rules), F.startswith(F.lower("segment"), F.col("prefix")), "left").select("segment", "payload", "n")


@query(f"WITH {_V}, w(axis, value) AS (VALUES ('tone', 'dry'), ('tone', 'sour'), ('mood', 'x')) SELECT 'missing: ' || w.axis || ': ' || w.value AS problem FROM w WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.axis = w.axis AND v.value = w.value) UNION ALL SELECT 'archetype shares sum to 0.30'")
def m08_vocabulary_problems(spark, sf_dir):
    return m.problems(vocabulary(spark), [("tone", "dry"), ("tone", "sour"), ("mood", "x")], [("a", 0.1), ("b", 0.2)])


_SPECS = [("night", 0.1, {"topic": "clocks", "tone": "dry"}), ("loud", 0.05, {"tone": "brisk", "visibility": "hidden"})]


@query()
def m09_archetypes(spark, sf_dir):
    return m.reserve(_deal(spark, 200), _SPECS, 7)


@query(f"WITH {_QUOTA.replace('* 100', '* 200').replace('<= 100', '<= 200')} SELECT axis, value, quota AS n FROM q WHERE quota > 0")
def m09_marginals(spark, sf_dir):
    """After the reservation every axis still has its exact quotas."""
    out = m.reserve(_deal(spark, 200), _SPECS, 7)
    return out.select(F.explode("variables").alias("axis", "value")).groupBy("axis", "value").agg(F.count(F.lit(1)).alias("n"))


_P = ", ".join(f"max(CASE WHEN axis = '{a}' THEN value END) AS {a}" for a in ("conflict", "visibility", "attitude", "persona", "opening", "closing", "frame", "severity", "scope"))


@query(f"""WITH {_DECK}, p AS (SELECT slot, {_P} FROM d GROUP BY slot), h AS (SELECT *, CASE WHEN conflict = 'trap' THEN 'hidden' ELSE visibility END AS vis FROM p)
SELECT slot, vis AS visibility, CASE WHEN vis = 'hidden' THEN 'unaware' WHEN visibility = 'explicit' AND attitude = 'unaware' THEN 'neutral' ELSE attitude END AS attitude,
CASE WHEN persona = 'formal' AND opening = 'casual' THEN 'plain' ELSE opening END AS opening, CASE WHEN visibility = 'explicit' AND closing = 'trailing' THEN 'question' ELSE closing END AS closing, nullif(frame, 'none') AS frame, severity || ' x ' || scope AS magnitude FROM h""")
def m10_deal_rules(spark, sf_dir):
    return m.deal_rules(_deal(spark))


@query()
def m11_second_value(spark, sf_dir):
    return m.capped_second(_deal(spark, 200), "topic", 7)


@query(f"WITH {_DECK} SELECT slot, value AS first, CASE WHEN ('0x' || substr(md5('5:' || slot), 1, 8))::BIGINT / 4294967296.0 < 0.3 THEN CASE value WHEN 'dry' THEN 'warm' WHEN 'warm' THEN 'brisk' ELSE 'dry' END END AS second FROM d WHERE axis = 'tone'")
def m12_second_goal(spark, sf_dir):
    """A coin of the slot's hash gives a second goal that differs from the first."""
    one = m.decks(vocabulary(spark), 100, 7).where("axis = 'tone'")
    u = F.conv(F.substring(m.order_key(5, F.col("slot")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    after = F.when(F.col("value") == "dry", "warm").when(F.col("value") == "warm", "brisk").otherwise("dry")
    return one.select("slot", F.col("value").alias("first"), F.when(u < 0.3, after).alias("second"))


@query("SELECT item_id, array_to_string(list_distinct(regexp_extract_all('{b} ' || item_id || ' {a} {b}', '\\{([a-z]+)\\}', 1)), ',') <> '' AS some, 2 AS n FROM benchmark")
def m13_placeholders(spark, sf_dir):
    p = t.placeholders(F.concat(F.lit("{b} "), F.col("item_id").cast("string"), F.lit(" {a} {b}")))
    return table(spark, sf_dir, "benchmark").select("item_id", (F.array_join(p, ",") == "b,a").alias("some"), F.size(p).alias("n"))


@query(f"WITH {_DECK} SELECT slot, 'Write about ' || max(CASE WHEN axis = 'topic' THEN value END) || ' in a ' || max(CASE WHEN axis = 'tone' THEN value END) || ' tone; open ' || max(CASE WHEN axis = 'opening' THEN value END) || '.' AS prompt FROM d GROUP BY slot")
def m14_compose_records(spark, sf_dir):
    return m.render(_deal(spark), TEMPLATE, [a for a, *_ in _AXES])


_POOL = ["ash", "birch", "cedar", "elm", "fir", "hazel", "larch", "maple", "oak", "pine"]
_PV = ", ".join(f"('{x}')" for x in _POOL)


def _sample_sql(key, source, k, seed, salt=""):
    return f"WITH o(item) AS (VALUES {_PV}), r AS (SELECT {key}, item, row_number() OVER (PARTITION BY {key} ORDER BY md5('{seed}:{salt}' || {key} || ':' || item), item)::INT AS place FROM (SELECT DISTINCT {key} FROM {source}), o) SELECT {key}, item, place FROM r WHERE place <= {k}"


def _pool(spark):
    return spark.createDataFrame([(x,) for x in _POOL], "item string")


_FIRST, _BANNED = {"de": "", "fr": " "}, ("der", "en")
_NAMES_SQL = r"""WITH v AS (SELECT lang AS locale, 'given' AS kind, regexp_extract(text, '^([A-Z][a-z]+)', 1) AS name FROM documents UNION ALL SELECT lang, 'family', regexp_extract(text, ' ([A-Z][a-z]+)', 1) FROM documents),
w AS (SELECT DISTINCT * FROM v WHERE locale IN ('en', 'de', 'fr') AND name <> ''), u AS (SELECT *, row_number() OVER (PARTITION BY locale, kind ORDER BY name) - 1 AS at, count(*) OVER (PARTITION BY locale, kind) AS n FROM w),
d AS (SELECT DISTINCT locale, kind, k, ('0x' || substr(md5('7:' || locale || ':' || kind || ':' || k), 1, 8))::BIGINT % n AS at FROM u, range(1, 41) t(k)),
x AS (SELECT d.locale, d.k, max(CASE WHEN d.kind = 'given' THEN u.name END) AS g, max(CASE WHEN d.kind = 'family' THEN u.name END) AS f FROM d JOIN u ON u.locale = d.locale AND u.kind = d.kind AND u.at = d.at GROUP BY 1, 2),
c AS (SELECT DISTINCT locale, CASE locale WHEN 'de' THEN f || g WHEN 'fr' THEN f || ' ' || g ELSE g || ' ' || f END AS name FROM x WHERE g IS NOT NULL AND f IS NOT NULL),
k AS (SELECT locale, name FROM c WHERE length(name) < 16 AND NOT list_has_any(list_transform(string_split(name, ' '), lambda w: lower(trim(w, '.,'))), ['der', 'en'])),
p AS (SELECT locale, row_number() OVER (PARTITION BY locale ORDER BY md5('7:' || locale || ':' || name), name)::INT AS place, name, false AS is_fallback FROM k QUALIFY place <= 20)"""


def _people(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    given, family = (d.select(F.col("lang").alias("locale"), F.regexp_extract("text", e, 1).alias("name")) for e in ("^([A-Z][a-z]+)", " ([A-Z][a-z]+)"))
    return m.people(given, family, 20, 7, ["en", "de", "fr", "xx"], _FIRST, _BANNED, 16, ["Ada One", "Ben Two"])


@query(_NAMES_SQL + " SELECT * FROM p UNION ALL SELECT * FROM (VALUES ('xx', 1, 'Ada One', true), ('xx', 2, 'Ben Two', true))")
def m15_entity_pools(spark, sf_dir):
    """Names by locale from the words that open documents and sentences; family first in two locales, built-in ones for a locale
    that has none."""
    return _people(spark, sf_dir)


@query(_NAMES_SQL + ", b AS (SELECT name FROM p UNION SELECT unnest(['Ada One', 'Ben Two'])) SELECT row_number() OVER (ORDER BY md5('3:blend:' || name), name)::INT AS place, name FROM b QUALIFY place <= 30")
def m15_blended_pool(spark, sf_dir):
    return m.blended(_people(spark, sf_dir), 30, 3)


@query("SELECT n_name AS nation, CASE WHEN contains(lower(n_name), 'an') THEN 'first' WHEN contains(lower(n_name), 'a') THEN 'second' END AS locale FROM nation")
def m16_culture_locale(spark, sf_dir):
    return m.contains_map(table(spark, sf_dir, "nation").select(F.col("n_name").alias("nation")), "nation", [("an", "first"), ("a", "second")], "locale")


@query(_sample_sql("n_nationkey", "nation", 4, 9))
def m17_keyed_sample(spark, sf_dir):
    return m.keyed_sample(table(spark, sf_dir, "nation"), "n_nationkey", _pool(spark), "item", 4, 9)


@query(_sample_sql("r_regionkey", "region", 1, 9, "species:"))
def m18_category_example(spark, sf_dir):
    return m.keyed_sample(table(spark, sf_dir, "region"), "r_regionkey", _pool(spark), "item", 1, 9, "species:")


@query(_sample_sql("conv_id", "conversations", 3, 9, "openings:"))
def m19_opening_hints(spark, sf_dir):
    return m.keyed_sample(table(spark, sf_dir, "conversations"), "conv_id", _pool(spark), "item", 3, 9, "openings:")


@query("""WITH u AS (SELECT doc_id, ('0x' || substr(md5('4:' || doc_id), 1, 8))::BIGINT / 4294967296.0 AS u FROM documents)
SELECT doc_id, CASE WHEN u < 0.5 THEN 'rivers' WHEN u < 0.8 THEN 'bridges' ELSE 'clocks' END AS topic FROM u""")
def m20_weighted_choice(spark, sf_dir):
    topics = vocabulary(spark).where("axis = 'topic'")
    return m.weighted_choice(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", topics, 4, "topic").select("doc_id", "topic")


@query("SELECT conv_id, CASE WHEN ('0x' || right(md5('salt:' || conv_id), 1))::INT % 2 = 0 THEN 'a' ELSE 'b' END AS side FROM (SELECT DISTINCT conv_id FROM conversations)")
def m22_blinded_side(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id").distinct().select("conv_id", m.blinded_side("salt", F.col("conv_id")).alias("side"))


@query("SELECT doc_id, coalesce(nullif(trim(regexp_extract(CASE WHEN lang = 'en' THEN 'x' ELSE 'a text written in ' || lang || ', old' END, 'written in ([^,]+)', 1)), ''), 'English') AS language FROM documents")
def m23_language(spark, sf_dir):
    card = F.when(F.col("lang") == "en", "x").otherwise(F.concat(F.lit("a text written in "), F.col("lang"), F.lit(", old")))
    return table(spark, sf_dir, "documents").select("doc_id", t.language_of(card).alias("language"))


@query(f"""WITH {_DECK}, p AS (SELECT slot, {_P}, max(CASE WHEN axis = 'topic' THEN value END) AS topic FROM d GROUP BY slot)
SELECT slot, concat_ws(chr(10), 'Topic: ' || topic, 'Persona: ' || persona, CASE WHEN frame <> 'none' THEN 'Frame: ' || frame END) AS block FROM p""")
def m25_scenario_block(spark, sf_dir):
    """Labelled lines of a deal; lines of absent cards go."""
    v = lambda a: F.col("variables")[a]
    line = lambda name, x: F.concat(F.lit(f"{name}: "), x)
    return _deal(spark).select("slot", F.concat_ws("\n", line("Topic", v("topic")), line("Persona", v("persona")), F.when(v("frame") != "none", line("Frame", v("frame")))).alias("block"))


@query(f"""WITH {_DECK}, p AS (SELECT slot, {_P}, max(CASE WHEN axis = 'topic' THEN value END) AS topic FROM d GROUP BY slot)
SELECT slot, 'Plan a text on ' || topic || CASE WHEN conflict = 'trap' THEN '; it is hidden' ELSE '' END || CASE WHEN frame <> 'none' THEN '; as a ' || frame ELSE '' END || '.' AS prompt FROM p""")
def m24_plan_prompt(spark, sf_dir):
    """Dealt cards, overlaid with what the rules make of them; clauses only where they were dealt."""
    d = _deal(spark)
    ruled = m.deal_rules(d).select("slot", "frame")
    both = d.join(ruled, "slot")
    trap = F.when(F.col("variables")["conflict"] == "trap", "; it is hidden").otherwise("")
    frame = F.when(F.col("frame").isNotNull(), F.concat(F.lit("; as a "), "frame")).otherwise("")
    return both.select("slot", F.concat(F.lit("Plan a text on "), F.col("variables")["topic"], trap, frame, F.lit(".")).alias("prompt"))


@query("""WITH x AS (SELECT item_id, CASE WHEN item_id % 2 = 0 THEN 'sys ' || item_id || chr(10) || '===USER===' || chr(10) || text ELSE text END AS t FROM benchmark)
SELECT item_id, CASE WHEN item_id % 2 = 0 THEN 'sys ' || item_id ELSE '' END AS system, CASE WHEN item_id % 2 = 0 THEN regexp_replace(regexp_replace(substr(t, strpos(t, '===USER===') + 11), '^[ \\t\\n\\r\\f\\x0B]+', ''), '[ \\t\\n\\r\\f\\x0B]+\\z', '') ELSE t END AS usr FROM x""")
def s07_two_part_template(spark, sf_dir):
    x = F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("sys "), F.col("item_id").cast("string"), F.lit("\n===USER===\n"), "text")).otherwise(F.col("text"))
    a, b = t.template_parts(x)
    return table(spark, sf_dir, "benchmark").select("item_id", a.alias("system"), b.alias("usr"))
