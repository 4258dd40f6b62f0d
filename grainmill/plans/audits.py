"""Queries A01 to A21 and N01 to N08: audits of documents and of conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import audits as a, phrases, reports, rules
from . import chat
from .registry import query, table
from .text import CHAT_FIRST, CLEAN, FIRST, LAST, OPENERS, RSTRIP, SQL, STOP_CARD, STRIP, TRAIL, WS, _N

PHRASES = ["the the", "of the", "in order to", "und die", "rights reserved"]
#: Own rules: structural families of prompts and of chat openings.
FAMILIES = [("question", r"\?"), ("numbered", r"[0-9]"), ("listing", r","), ("short", r"(?s)^.{0,80}\z")]
_END = t.TERMINAL.replace("'", "''")


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query("""SELECT axis, value, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY axis) AS share FROM (
SELECT 'lang' AS axis, coalesce(lang, 'unknown') AS value FROM documents UNION ALL SELECT 'source', coalesce(source, 'unknown') FROM documents) GROUP BY axis, value""")
def a01_composition(spark, sf_dir):
    return a.composition(docs(spark, sf_dir), ["lang", "source"])


@query("""WITH p AS (SELECT coalesce(source, 'unknown') AS v, count(*) AS n FROM documents GROUP BY 1)
SELECT count(*) AS n_types, arg_max(v, (n, v)) AS top, max(n) / sum(n) AS top_share, CASE WHEN count(*) >= 8 THEN CASE WHEN max(n) / sum(n) <= 0.15 THEN 'GOOD' WHEN max(n) / sum(n) <= 0.3 THEN 'OK' ELSE 'BAD' END END AS verdict FROM p""")
def a01_top_share(spark, sf_dir):
    return a.top_share(docs(spark, sf_dir), "source")


@query("""WITH l AS (SELECT list(length(text) ORDER BY length(text)) AS l, count(*) AS n FROM documents)
SELECT n, l[n // 10 + 1] AS p10, l[n // 2 + 1] AS median, l[least(n - 1, 9 * n // 10) + 1] AS p90 FROM l""")
def a02_length_picks(spark, sf_dir):
    return a.length_picks(docs(spark, sf_dir))


@query(f"""WITH x AS (SELECT {TRAIL} AS t, {RSTRIP('text')} AS r FROM documents),
y AS (SELECT count(*) AS n, sum((t <> '' AND NOT contains('{_END}', right(t, 1)))::INT) AS truncated, sum((r <> '' AND r <> t)::INT) AS trailing_separator FROM x)
SELECT n, truncated::BIGINT AS truncated, trailing_separator::BIGINT AS trailing_separator, truncated / n AS truncated_share, CASE WHEN truncated = 0 THEN 'GOOD' WHEN truncated / n <= 0.02 THEN 'OK' ELSE 'BAD' END AS verdict FROM y""")
def a03_truncation(spark, sf_dir):
    return a.truncation(docs(spark, sf_dir))


@query("SELECT " + "avg((" + " OR ".join(f"regexp_matches(text, '{SQL(p)}')" for p in t.MARKDOWN.values()) + ")::INT) AS any_share, " + ", ".join(f"avg(regexp_matches(text, '{SQL(p)}')::INT) AS {k}" for k, p in t.MARKDOWN.items()) + f", CASE WHEN avg(regexp_matches(text, '{SQL(t.MARKDOWN['bold'])}')::INT) <= 0.1 THEN 'GOOD' WHEN avg(regexp_matches(text, '{SQL(t.MARKDOWN['bold'])}')::INT) <= 0.3 THEN 'OK' ELSE 'BAD' END AS verdict FROM documents")
def a04_markdown(spark, sf_dir):
    return a.markdown(docs(spark, sf_dir))


_NAMES = "list_distinct(list_filter(list_transform(regexp_extract_all(regexp_replace(text, '[ªµºÀ-ÖØ-öø-ɏ]', '0', 'g'), '\\b([A-Z][a-z]{2,}(?:[ \\t\\n\\r\\f\\x0B]+[A-Z][a-z]{2,}){1,2})\\b', 1), lambda n: trim(regexp_replace(n, '^The ', ''))), lambda n: n <> '' AND n <> 'United States'))"


@query(f"""WITH d AS (SELECT name, count(*) AS df FROM (SELECT unnest({_NAMES}) AS name FROM documents) GROUP BY name),
b AS (SELECT * FROM d WHERE df >= 2 ORDER BY df DESC, name LIMIT 12), w AS (SELECT coalesce(max(df), 0) AS worst FROM b), n AS (SELECT count(*) AS n FROM documents)
SELECT name, df, CASE WHEN worst < greatest(2, 0.1 * n) THEN 'GOOD' WHEN worst <= 0.2 * n THEN 'OK' ELSE 'BAD' END AS verdict FROM b, w, n""")
def a05_name_collapse(spark, sf_dir):
    return a.names(docs(spark, sf_dir), stop=("United States",))


@query(f"""WITH n AS (SELECT doc_id, {_NAMES} AS names FROM documents), w(name) AS (VALUES ('On'), ('Th'), ('Zz'), ('Er')), c AS (SELECT w.name, count(*) FILTER (len(list_filter(names, lambda x: contains(x, w.name))) > 0) AS docs FROM w, n GROUP BY 1) SELECT name, docs FROM c WHERE docs > 0""")
def a05_watched_names(spark, sf_dir):
    return a.watched_names(docs(spark, sf_dir), ["On", "Th", "Zz", "Er"], stop=("United States",))


@query("SELECT phrase, (SELECT count(*) FROM documents WHERE contains(lower(text), phrase)) AS docs FROM (VALUES " + ", ".join(f"('{p}')" for p in PHRASES) + ") p(phrase)")
def a06_stock_phrases(spark, sf_dir):
    return a.phrase_hits(docs(spark, sf_dir), PHRASES)


_FIRST_WORDS = "list_slice(regexp_extract_all(lower(text), '[a-z'']+'), 1, 2)"


@query(f"WITH p AS (SELECT DISTINCT array_to_string({_FIRST_WORDS}, ' ') AS phrase FROM documents WHERE len({_FIRST_WORDS}) = 2) SELECT p.phrase, count(d.doc_id) AS docs FROM p LEFT JOIN documents d ON contains(lower(d.text), p.phrase) GROUP BY p.phrase")
def a06_many_phrases(spark, sf_dir):
    """The first two words of every document as phrases, counted in all documents in one pass."""
    d = docs(spark, sf_dir)
    first = F.slice(t.ascii_words("text"), 1, 2)
    return a.phrase_hits(d, d.where(F.size(first) == 2).select(F.array_join(first, " ").alias("phrase")))


_OPEN = "CASE " + " ".join(f"WHEN regexp_matches({STRIP('f')}, '{SQL(p)}') THEN '{n}'" for n, p in OPENERS) + " ELSE 'other' END"


@query(f"""WITH f AS (SELECT {FIRST} AS f FROM documents), p AS (SELECT {_OPEN} AS pattern, count(*) AS n FROM f GROUP BY 1),
s AS (SELECT pattern, n, n / sum(n) OVER () AS share, sum(CASE WHEN pattern <> 'other' THEN n ELSE 0 END) OVER () / sum(n) OVER () AS formulaic FROM p)
SELECT *, CASE WHEN formulaic <= 0.15 THEN 'GOOD' WHEN formulaic <= 0.35 THEN 'OK' ELSE 'BAD' END AS verdict FROM s""")
def a07_openings(spark, sf_dir):
    return a.openings(docs(spark, sf_dir), OPENERS)


@query(f"""WITH s AS (SELECT array_to_string(list_slice(list_filter(string_split_regex(lower({FIRST}), '{WS}+'), lambda w: w <> ''), 1, 5), ' ') AS stem FROM documents)
SELECT stem, count(*) AS n FROM s WHERE stem <> '' GROUP BY stem HAVING count(*) >= 2 ORDER BY n DESC, stem LIMIT 5""")
def a07_repeated_stems(spark, sf_dir):
    return a.repeated_stems(docs(spark, sf_dir))


_PM = lambda p: f"(len(regexp_extract_all(text, '{SQL(p)}')) * 1000.0 / greatest(len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')), 1))"


@query(f"SELECT count(*) AS n, avg(({_PM(t.FIRST_PERSON)} >= 5 AND {_PM(t.CONTRACTION)} >= 2)::INT) AS personal_share FROM documents WHERE lower(coalesce(lang, 'English')) IN ('en', 'english')")
def a08_register(spark, sf_dir):
    return a.register(docs(spark, sf_dir))


@query("SELECT label, avg(embedding[1]) AS value, CASE WHEN avg(embedding[1]) <= 0.0 THEN 'GOOD' WHEN avg(embedding[1]) <= 0.05 THEN 'OK' ELSE 'BAD' END AS verdict, CASE WHEN avg(embedding[1]) >= 0.05 THEN 'GOOD' WHEN avg(embedding[1]) >= 0.0 THEN 'OK' ELSE 'BAD' END AS verdict_higher FROM embeddings GROUP BY label")
def a09_verdicts(spark, sf_dir):
    per = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.avg(F.get("embedding", F.lit(0))).alias("value"))
    return per.withColumns({"verdict": rules.verdict(F.col("value"), 0.0, 0.05), "verdict_higher": rules.verdict(F.col("value"), 0.05, 0.0, higher_better=True)})


@query("""WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2), p AS (SELECT lang, n / sum(n) OVER (PARTITION BY lang) AS p FROM c)
SELECT lang, exp(-sum(p * ln(p))) AS effective, count(*) AS "distinct" FROM p GROUP BY lang""")
def a10_effective_number(spark, sf_dir):
    counts = docs(spark, sf_dir).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    return a.effective_number(counts, group=["lang"])


_FAM = "CASE " + " ".join(f"WHEN regexp_matches(text, '{SQL(p)}') THEN '{n}'" for n, p in FAMILIES) + " ELSE 'other' END"


@query(f"""WITH p AS {chat.sql('user')}, f AS (SELECT {_FAM} AS family, (regexp_matches(text, '\\?') OR regexp_matches(text, '[0-9]')) AS named FROM p),
c AS (SELECT family, count(*) AS n FROM f GROUP BY 1), u AS (SELECT avg(named::INT) AS s, count(*) AS n FROM f), w AS (SELECT arg_max(family, (n, family)) AS worst, max(n) AS worst_n FROM c WHERE family <> 'other')
SELECT family, c.n, u.s AS named_share, w.worst, w.worst_n / u.n AS worst_share, CASE WHEN u.s <= 0.3 THEN 'GOOD' WHEN u.s <= 0.5 THEN 'OK' ELSE 'BAD' END AS verdict FROM c, u, w""")
def a11_skeletons(spark, sf_dir):
    """Families of prompts; the share of the union of the first two (both at once count once); the largest named family."""
    p = chat.prompts(spark, sf_dir)
    named = F.regexp_like("text", F.lit(FAMILIES[0][1])) | F.regexp_like("text", F.lit(FAMILIES[1][1]))
    f = p.select(t.classify(F.col("text"), FAMILIES).alias("family"), named.alias("named"))
    c = f.groupBy("family").agg(F.count(F.lit(1)).alias("n"))
    u = f.agg(a.share(F.col("named")).alias("named_share"), F.count(F.lit(1)).alias("total"))
    w = c.where("family <> 'other'").agg(F.max(F.struct("n", "family")).alias("w"))
    out = c.crossJoin(F.broadcast(u)).crossJoin(F.broadcast(w))  # two single rows
    return out.select("family", "n", "named_share", F.col("w.family").alias("worst"), (F.col("w.n") / F.col("total")).alias("worst_share"), rules.verdict(F.col("named_share"), 0.3, 0.5).alias("verdict"))


@query(f"""WITH p AS {chat.sql('user')}, b AS (SELECT 'open' AS side, array_to_string(list_slice({CLEAN('text')}, 1, 3), ' ') AS words FROM p UNION ALL SELECT 'close', array_to_string(list_slice({CLEAN(LAST)}, 1, 3), ' ') FROM p),
c AS (SELECT side, words, count(*) AS n FROM b GROUP BY 1, 2), r AS (SELECT *, count(*) OVER (PARTITION BY side) AS "distinct", sum(n) OVER (PARTITION BY side)::BIGINT AS total, row_number() OVER (PARTITION BY side ORDER BY n DESC, words) AS place FROM c)
SELECT side, words, n, "distinct", total, CASE WHEN "distinct" / total >= 0.9 THEN 'GOOD' WHEN "distinct" / total >= 0.75 THEN 'OK' ELSE 'BAD' END AS verdict FROM r WHERE place <= 5 AND n > 1""")
def a12_openers_closers(spark, sf_dir):
    return a.ends(chat.prompts(spark, sf_dir))


@query("""WITH c AS (SELECT doc_id, CASE lang WHEN 'en' THEN contains(lower(text), 'the ') OR contains(lower(text), 'and ') WHEN 'de' THEN contains(lower(text), 'der') OR contains(lower(text), 'und') WHEN 'fr' THEN contains(lower(text), 'les ') END AS v FROM documents)
SELECT count(v) AS checked, count(*) - count(v) AS unmapped, sum((NOT v)::INT)::BIGINT AS unrealised, sum((NOT v)::INT) / count(v) AS unrealised_share FROM c""")
def a13_unrealised(spark, sf_dir):
    from .text import KEYWORDS

    v = docs(spark, sf_dir).join(F.broadcast(rules.keyword_lists(spark, KEYWORDS)), "lang", "left").select(t.realised("text", F.col("keywords")).alias("v"))
    out = v.agg(F.count("v").alias("checked"), F.count_if(F.col("v").isNull()).alias("unmapped"), F.count_if(~F.col("v")).alias("unrealised"))
    return out.withColumn("unrealised_share", F.col("unrealised") / F.col("checked"))


@query("""WITH s AS (SELECT user_id, count(DISTINCT event_type) AS n FROM events GROUP BY user_id), l AS (SELECT count(DISTINCT event_type) AS lib FROM events)
SELECT min(n) AS least, median(n) AS median, max(n) AS most, avg(n) / min(lib) AS library_share, avg((n = lib)::INT) AS fallback_rate FROM s, l""")
def a14_selection_sizes(spark, sf_dir):
    """Sizes of selections from a library: users select event types; a selection of all is the fallback."""
    e = table(spark, sf_dir, "events")
    lib = e.agg(F.count_distinct("event_type").alias("lib"))
    s = e.groupBy("user_id").agg(F.count_distinct("event_type").alias("n")).crossJoin(F.broadcast(lib))
    return s.agg(F.min("n").alias("least"), F.median("n").alias("median"), F.max("n").alias("most"), (F.avg("n") / F.min("lib")).alias("library_share"), a.share(F.col("n") == F.col("lib")).alias("fallback_rate"))


@query("""WITH lib(entry) AS (SELECT unnest(['click', 'view', 'purchase', 'never', 'search'])), u AS (SELECT DISTINCT user_id, event_type FROM events), n AS (SELECT count(DISTINCT user_id) AS n FROM events)
SELECT entry, count(u.user_id) AS cases, count(u.user_id) = 0 AS never_selected, CASE WHEN min(n.n) >= 20 THEN count(u.user_id) / min(n.n) END AS share FROM n, lib LEFT JOIN u ON u.event_type = lib.entry GROUP BY entry""")
def a15_library_coverage(spark, sf_dir):
    """Cases for each library entry, a case once; entries that no case selected stay with 0."""
    lib = spark.createDataFrame([(x,) for x in ("click", "view", "purchase", "never", "search")], "entry string")
    cases = table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    per = cases.groupBy("event_type").agg(F.count(F.lit(1)).alias("cases"))
    n = cases.agg(F.count_distinct("user_id").alias("n"))
    out = F.broadcast(lib).join(per, F.col("entry") == F.col("event_type"), "left").crossJoin(F.broadcast(n)).withColumn("cases", F.coalesce("cases", F.lit(0)))
    return out.select("entry", "cases", (F.col("cases") == 0).alias("never_selected"), F.when(F.col("n") >= 20, F.col("cases") / F.col("n")).alias("share"))


_TERMS = ["the", "und", "ation"]


@query(f"WITH p AS {chat.sql('assistant')} SELECT term, " + ", ".join(f"sum(CASE WHEN arm = '{x}' THEN len(regexp_extract_all(lower(text), term)) ELSE 0 END)::BIGINT AS {x}_hits, sum(CASE WHEN arm = '{x}' AND contains(lower(text), term) THEN 1 ELSE 0 END)::BIGINT AS {x}_cases" for x in ("pipeline", "plain")) + " FROM p, (VALUES " + ", ".join(f"('{x}')" for x in _TERMS) + ") v(term) GROUP BY term")
def a16_jargon(spark, sf_dir):
    """A term's occurrences and cases in both arms."""
    r = chat.responses(spark, sf_dir).select("arm", F.lower("text").alias("low"))
    found = phrases.hits(r, _TERMS, "low", ["arm"])
    arm = lambda x, c: F.coalesce(F.sum(F.when(F.col("arm") == x, F.col(c))), F.lit(0)).cast("long")
    every = spark.createDataFrame([(x,) for x in _TERMS], "phrase string").join(found, "phrase", "left")
    return every.groupBy(F.col("phrase").alias("term")).agg(*[arm(x, c).alias(f"{x}_{n}") for x in ("pipeline", "plain") for n, c in (("hits", "times"), ("cases", "docs"))])


@query(f"""WITH p AS {chat.sql('assistant')}, w AS (SELECT prompt_id, max(CASE WHEN arm = 'pipeline' THEN length(text) END) AS a, max(CASE WHEN arm = 'plain' THEN length(text) END) AS b FROM p GROUP BY prompt_id)
SELECT count(a) AS n, median(a) AS pipeline_median, median(b) AS plain_median, median(a) / median(b) AS ratio, sum(CASE WHEN b IS NOT NULL THEN a END)::BIGINT AS pipeline_total, sum(CASE WHEN a IS NOT NULL THEN b END)::BIGINT AS plain_total,
CASE WHEN median(a) / median(b) < 0.8 THEN 'OK' WHEN median(a) / median(b) <= 1.5 THEN 'GOOD' WHEN median(a) / median(b) <= 2.5 THEN 'OK' ELSE 'BAD' END AS verdict FROM w""")
def a17_response_lengths(spark, sf_dir):
    """Medians of both arms, their ratio, and totals over prompts that both arms answer."""
    side = lambda x: F.max(F.when(F.col("arm") == x, F.length("text")))
    w = chat.responses(spark, sf_dir).groupBy("prompt_id").agg(side("pipeline").alias("a"), side("plain").alias("b"))
    out = w.agg(F.count("a").alias("n"), F.median("a").alias("pipeline_median"), F.median("b").alias("plain_median"), F.sum(F.when(F.col("b").isNotNull(), F.col("a"))).cast("long").alias("pipeline_total"), F.sum(F.when(F.col("a").isNotNull(), F.col("b"))).cast("long").alias("plain_total"))
    ratio = F.col("pipeline_median") / F.col("plain_median")
    return out.withColumn("ratio", ratio).withColumn("verdict", F.when(ratio < 0.8, "OK").otherwise(rules.verdict(ratio, 1.5, 2.5)))


@query(f"WITH p AS {chat.sql('assistant')} SELECT arm, phrase, count(*) AS docs FROM p, (VALUES " + ", ".join(f"('{x}')" for x in PHRASES) + f") v(phrase) WHERE contains(lower({CLEAN('text')}::VARCHAR), phrase) OR contains(lower(regexp_replace(translate(text, '’-', ''' '), '{WS}+', ' ', 'g')), phrase) GROUP BY arm, phrase")
def a18_tracked_tics(spark, sf_dir):
    """In how many responses of each arm a tracked phrase stands, after soft normalisation."""
    r = chat.responses(spark, sf_dir).withColumn("soft", t.soft("text"))
    return phrases.hits(r, PHRASES, "soft", ["arm"]).select("arm", "phrase", "docs")


_SHAPE = f"""concat_ws(' · ', CASE WHEN {_N} <= 2 THEN '1-2' WHEN {_N} <= 5 THEN '3-5' WHEN {_N} <= 9 THEN '6-9' ELSE '10+' END || ' paras',
  CASE WHEN regexp_matches(text, '(?m)^{WS}*[-*•] ') THEN 'bullets' END, CASE WHEN regexp_matches(text, '(?m)^{WS}*[0-9]+[.)] ') THEN 'numbered' END,
  CASE WHEN regexp_matches(text, '(?m)^#{{1,4}} |^\\*\\*[^*\\n]{{2,60}}\\*\\*:?[ \\t]*$') THEN 'headed' END, CASE WHEN right({RSTRIP('text')}, 1) = '?' THEN 'ends-question' END)"""


@query(f"""WITH s AS (SELECT lang AS arm, {_SHAPE} AS shape, {_N} AS paras FROM documents), c AS (SELECT arm, shape, count(*) AS n FROM s GROUP BY 1, 2),
e AS (SELECT arm, exp(-sum(p * ln(p))) AS effective, count(*) AS distinct_shapes FROM (SELECT arm, n / sum(n) OVER (PARTITION BY arm) AS p FROM c) GROUP BY arm),
m AS (SELECT arm, l[len(l) // 2 + 1] AS median_paras FROM (SELECT arm, list(paras ORDER BY paras) AS l FROM s GROUP BY arm)),
k AS (SELECT arm, sum(n)::BIGINT AS n, max(n) AS top_n, {", ".join(f"sum(CASE WHEN contains(shape, '{x}') THEN n ELSE 0 END)::BIGINT AS {x.replace('-', '_')}" for x in ('bullets', 'numbered', 'headed', 'ends-question'))} FROM c GROUP BY arm)
SELECT arm, n, top_n, bullets, numbered, headed, ends_question, effective, distinct_shapes, median_paras, top_n / n AS top_share, CASE WHEN top_n / n <= 0.3 THEN 'GOOD' WHEN top_n / n <= 0.5 THEN 'OK' ELSE 'BAD' END AS verdict FROM k JOIN e USING (arm) JOIN m USING (arm)""")
def a19_structure(spark, sf_dir):
    return a.structure(docs(spark, sf_dir).withColumnRenamed("lang", "arm"))


@query(f"""WITH p AS (SELECT conv_id, {CHAT_FIRST} AS f FROM conversations WHERE role = 'assistant'), x AS (SELECT conv_id, {_FAM.replace('text', 'lower(f)')} AS family, array_to_string(list_slice({CLEAN('f')}, 1, 3), ' ') AS w FROM p)
SELECT conv_id, count(*) AS n, count(DISTINCT family) AS families, count(DISTINCT w) AS openings FROM x GROUP BY conv_id HAVING count(*) > 1""")
def a20_opening_spread(spark, sf_dir):
    """Within a case of several responses: how many families and first three words."""
    r = table(spark, sf_dir, "conversations").where("role = 'assistant'").select("conv_id", t.first_chat_sentence("text").alias("f"))
    x = r.select("conv_id", t.classify(F.lower("f"), FAMILIES).alias("family"), t.first_words("f").alias("w"))
    return x.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("family").alias("families"), F.count_distinct("w").alias("openings")).where("n > 1")


@query(f"WITH x AS {chat.sql('assistant')} SELECT 'shapes' AS chart, arm AS series, {_SHAPE} AS label, count(*)::DOUBLE AS value FROM x GROUP BY 2, 3")
def a37_shape_marts(spark, sf_dir):
    return reports.counted(chat.responses(spark, sf_dir).withColumn("shape", t.shape("text")), "shapes", "arm", "shape")


@query(f"""WITH p AS (SELECT {CHAT_FIRST} AS f FROM conversations WHERE role = 'assistant' AND {STRIP('text')} <> ''), c AS (SELECT {_FAM.replace('text', 'lower(f)')} AS family, count(*) AS n FROM p GROUP BY 1),
a AS (SELECT sum(n) AS total, coalesce(max(n) FILTER (family <> 'other'), 0) AS most, arg_min(family, (-n, family)) FILTER (family <> 'other') AS top FROM c), e AS (SELECT exp(-sum(n / total * ln(n / total))) AS effective FROM c, a)
SELECT family, n, n / total AS share, top, most / total AS top_share, effective, CASE WHEN most / total <= 0.3 THEN 'GOOD' WHEN most / total <= 0.5 THEN 'OK' ELSE 'BAD' END AS verdict FROM c, a, e""")
def a20_opening_families(spark, sf_dir):
    return a.opening_families(table(spark, sf_dir, "conversations").where("role = 'assistant'"), FAMILIES)


@query(f"""WITH p AS (SELECT {CHAT_FIRST} AS f FROM conversations WHERE role = 'assistant' AND {STRIP('text')} <> ''), w AS (SELECT lower(array_to_string(list_slice(list_filter(regexp_split_to_array(f, '{WS}+'), lambda x: x <> ''), 1, 3), ' ')) AS start FROM p),
c AS (SELECT start, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, start LIMIT 5) SELECT * FROM c WHERE n > 1""")
def a20_repeated_starts(spark, sf_dir):
    return a.repeated_starts(table(spark, sf_dir, "conversations").where("role = 'assistant'"))


@query(f"""WITH p AS (SELECT arg_min(text, turn) AS card FROM conversations WHERE role = 'user' GROUP BY conv_id), k AS (SELECT DISTINCT card FROM p WHERE card <> '' ORDER BY card LIMIT 8),
h AS (SELECT {CHAT_FIRST} AS f, conv_id, turn, card, row_number() OVER (PARTITION BY conv_id, turn ORDER BY md5(conv_id || ':' || turn || ':' || card)) AS place FROM conversations, k WHERE role = 'assistant' AND {STRIP('text')} <> ''),
w AS (SELECT card, {CLEAN('f')} AS s, {CLEAN('card')} AS c FROM h WHERE place <= 3),
g AS (SELECT card, list_filter(list_transform(range(1, len(c) - 1), lambda i: list_slice(c, i, i + 2)), lambda x: len(list_filter(x, lambda v: v NOT IN ('the', 'a', 'of', 'and', 'to', 'in', 'is'))) > 0) AS cg, list_transform(range(1, len(s) - 1), lambda i: list_slice(s, i, i + 2)) AS sg FROM w),
d AS (SELECT card, count(*) AS draws, count(*) FILTER (list_has_any(cg, sg)) AS echoes FROM g GROUP BY 1), r AS (SELECT sum(echoes) / sum(draws) AS echo_rate FROM d)
SELECT card, draws, echoes, echo_rate, CASE WHEN echo_rate <= 0 THEN 'GOOD' WHEN echo_rate <= 0.2 THEN 'OK' ELSE 'BAD' END AS verdict FROM d, r""")
def a20_hint_echoes(spark, sf_dir):
    """Three cards drawn for each response by a hash, of eight first prompts as cards, and how often its opening echoes them."""
    turns = table(spark, sf_dir, "conversations")
    cards = chat.prompts(spark, sf_dir).select(F.col("text").alias("card")).where("card <> ''").distinct().orderBy("card").limit(8)
    pool = cards.agg(F.array_sort(F.collect_list("card")).alias("cards"))
    drawn = F.transform(F.slice(F.array_sort(F.transform("cards", lambda c: F.struct(F.md5(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"), c)).alias("h"), c.alias("card")))), 1, 3), lambda x: x["card"])
    rows = turns.where("role = 'assistant'").crossJoin(F.broadcast(pool)).withColumn("hints", drawn)  # one row of eight cards
    return a.hint_echoes(rows, STOP_CARD)


@query(f"""WITH p AS (SELECT lang AS class, length(text) AS len FROM documents), l AS (SELECT class, list(len ORDER BY len) AS l, sum((len > 1000)::INT)::BIGINT AS over_1000 FROM p GROUP BY class)
SELECT class, len(l)::BIGINT AS n, l[1] AS least, l[len(l) // 2 + 1] AS median, l[len(l)] AS most, over_1000 FROM l""")
def a21_length_by_class(spark, sf_dir):
    rows = docs(spark, sf_dir).select(F.col("lang").alias("class"), F.length("text").cast("long").alias("len"))
    r = a.ranked(rows, "len", ["class"])
    return r.groupBy("class").agg(F.max("n").alias("n"), F.min("len").alias("least"), a.at(F.floor(F.col("n") / 2), "len").alias("median"), F.max("len").alias("most"), F.sum(F.when(F.col("len") > 1000, F.col("c")).otherwise(0)).alias("over_1000")).orderBy("median")


def _df_sql(sizes, source, where="true"):
    w = "regexp_extract_all(lower(text), '[a-z'']+')"
    return " UNION ALL ".join(f"SELECT {n} AS n_words, unnest(list_distinct(list_transform(range(1, len({w}) - {n} + 2), lambda i: array_to_string(list_slice({w}, i, i + {n - 1}), ' ')))) AS gram FROM {source} WHERE {where}" for n in sizes)


@query("""WITH w AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS i FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z'']+') AS w FROM documents)),
g AS (SELECT DISTINCT doc_id, gram FROM (SELECT doc_id, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS gram FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE gram IS NOT NULL),
d AS (SELECT gram, count(*) AS df FROM g GROUP BY gram ORDER BY df DESC, gram LIMIT 200)
SELECT gram, df FROM d WHERE df >= greatest(3, 0.05 * (SELECT count(*) FROM documents)) ORDER BY df DESC, gram LIMIT 8""")
def n01_recurring_5grams(spark, sf_dir):
    return a.recurring(docs(spark, sf_dir))


@query(f"WITH p AS {chat.sql('user')}, g AS ({_df_sql([3, 4], 'p')}), d AS (SELECT n_words, gram, count(*) AS df, row_number() OVER (PARTITION BY n_words ORDER BY count(*) DESC, gram) AS place FROM g GROUP BY 1, 2) SELECT n_words, gram, df FROM d WHERE place <= 15 AND df >= greatest(3, round_even(0.1 * (SELECT count(*) FROM p), 0))")
def n02_shared_ngrams(spark, sf_dir):
    from pyspark.sql import Window

    p = chat.prompts(spark, sf_dir)
    df = a.gram_df(p, (4, 3), t.ascii_words("text"))
    place = F.row_number().over(Window.partitionBy("n_words").orderBy(F.desc("df"), "gram"))
    return df.withColumn("place", place).where((F.col("place") <= 15) & (F.col("df") >= max(3, round(0.1 * p.count())))).drop("place")


@query(f"WITH p AS {chat.sql('assistant')}, g AS ({_df_sql([2, 3, 4, 5], 'p')}) SELECT n_words, gram, count(*) AS df FROM g GROUP BY 1, 2")
def n03_gram_document_frequency(spark, sf_dir):
    return a.gram_df(chat.responses(spark, sf_dir), (2, 3, 4, 5), t.ascii_words("text"))


_Z = "ln((a + 0.5) * (nb - b + 0.5) / ((na - a + 0.5) * (b + 0.5))) / sqrt(1 / (a + 0.5) + 1 / (na - a + 0.5) + 1 / (b + 0.5) + 1 / (nb - b + 0.5))"


@query(f"WITH c AS (SELECT source, sum((lang = 'en')::INT) AS a, count(*) AS na FROM documents GROUP BY source), x AS (SELECT source, a, na, sum(a) OVER () - a AS b, sum(na) OVER () - na AS nb FROM c) SELECT source, {_Z} AS z FROM x")
def n04_log_odds(spark, sf_dir):
    from pyspark.sql import Window

    c = docs(spark, sf_dir).groupBy("source").agg(F.count_if(F.col("lang") == "en").alias("a"), F.count(F.lit(1)).alias("na"))
    w = Window.partitionBy(F.lit(1))  # a row for each source
    x = c.withColumns({"b": F.sum("a").over(w) - F.col("a"), "nb": F.sum("na").over(w) - F.col("na")})
    return x.select("source", a.log_odds(F.col("a"), F.col("na"), F.col("b"), F.col("nb")).alias("z"))


_CAND = f"""WITH p AS {chat.sql('assistant')}, g AS ({_df_sql([2, 3, 4, 5], 'p', "arm = 'pipeline'")}), h AS ({_df_sql([2, 3, 4, 5], 'p', "arm = 'plain'")}),
gd AS (SELECT n_words, gram AS phrase, count(*) AS a FROM g GROUP BY 1, 2), hd AS (SELECT gram AS phrase, count(*) AS b FROM h GROUP BY 1),
n AS (SELECT count(*) FILTER (arm = 'pipeline') AS na, count(*) FILTER (arm = 'plain') AS nb FROM p),
x AS (SELECT n_words, phrase, a, na, coalesce(b, 0) AS b, nb FROM gd CROSS JOIN n LEFT JOIN hd USING (phrase) WHERE a >= greatest(3, round_even(0.1 * na, 0)) AND NOT contains(phrase, 'of the') AND NOT contains('of the', phrase)),
z AS (SELECT *, {_Z} AS z FROM x) SELECT phrase, n_words, a AS df, na AS "of", b AS ref_df, nb AS ref_of, round(z, 9) AS z FROM z WHERE z >= 1"""


@query(_CAND)
def n05_phrase_candidates(spark, sf_dir):
    out = a.phrase_candidates(chat.responses(spark, sf_dir), "arm", "pipeline", "plain", ["of the"])
    return out.select("phrase", "n_words", "df", "of", "ref_df", "ref_of", F.round("z", 9).alias("z"))


@query(_CAND.replace("WITH p AS", "WITH RECURSIVE p AS", 1).rpartition(" SELECT phrase")[0] + """,
k AS (SELECT phrase, n_words, a AS df, na AS "of", b AS ref_df, nb AS ref_of, z, row_number() OVER (ORDER BY round(z, 9) DESC, a DESC, phrase) AS place FROM z WHERE z >= 1),
r(place, kept) AS (SELECT 0::BIGINT, []::VARCHAR[] UNION ALL SELECT k.place, CASE WHEN len(kept) < 25 AND len(list_filter(kept, lambda x: contains(x, k.phrase) OR contains(k.phrase, x))) = 0 THEN list_append(kept, k.phrase) ELSE kept END FROM r JOIN k ON k.place = r.place + 1),
l AS (SELECT kept FROM r ORDER BY place DESC LIMIT 1)
SELECT phrase, n_words, df, "of", ref_df, ref_of, round(z, 9) AS z FROM k WHERE list_contains((SELECT kept FROM l), phrase)""")
def n05_phrase_shortlist(spark, sf_dir):
    out = a.without_nested(a.phrase_candidates(chat.responses(spark, sf_dir), "arm", "pipeline", "plain", ["of the"]))
    return out.select("phrase", "n_words", "df", "of", "ref_df", "ref_of", F.round("z", 9).alias("z"))


_WORD_SHARE = "bw AS (SELECT word, count(*) / sum(count(*)) OVER () AS share FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z'']+')) AS word FROM documents) GROUP BY word)"


@query(_CAND.rpartition(" SELECT phrase")[0] + f""", {_WORD_SHARE},
f AS (SELECT phrase, CASE WHEN bool_or(share IS NULL) THEN 0.0 ELSE greatest(0.0, log10(1e9 / sum(1 / share))) END AS zipf FROM (SELECT phrase, unnest(string_split(phrase, ' ')) AS word FROM z) LEFT JOIN bw USING (word) GROUP BY phrase)
SELECT phrase, n_words, a AS df, b AS ref_df, round(z, 9) AS z FROM z JOIN f USING (phrase) WHERE z >= 1 AND zipf < 7""")
def n05_rare_candidates(spark, sf_dir):
    """Candidates that the words of all documents make no common ones."""
    responses = chat.responses(spark, sf_dir)
    every = a.phrase_candidates(responses, "arm", "pipeline", "plain", ["of the"])
    known = a.zipf(every, a.background(docs(spark, sf_dir)))
    out = a.phrase_candidates(responses, "arm", "pipeline", "plain", ["of the"], known, ceiling=7.0)
    return out.select("phrase", "n_words", "df", "ref_df", F.round("z", 9).alias("z"))


@query(f"""WITH p AS {chat.sql('assistant')}, q(phrase) AS (VALUES ('the '), ('er '), ('zzz')), h AS (SELECT phrase, arg_min(text, conv_id) AS text FROM p, q WHERE contains(text, phrase) GROUP BY phrase)
SELECT phrase, '…' || {STRIP("substring(text, greatest(1, instr(text, phrase) - 30), length(phrase) + 30 + least(30, instr(text, phrase) - 1))")} || '…' AS example FROM h""")
def n06_phrase_example(spark, sf_dir):
    return a.example(chat.responses(spark, sf_dir), spark.createDataFrame([("the ",), ("er ",), ("zzz",)], "phrase string"), "conv_id")


def _grams_sql(n, source):
    return f"SELECT arm, conv_id, {n} AS n_words, unnest(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(list_slice(w, i, i + {n - 1}), ' '))) AS gram FROM {source}"


@query(f"WITH p AS {chat.sql('assistant')}, w AS (SELECT arm, conv_id, {CLEAN('text')} AS w FROM p), g AS ({' UNION ALL '.join(_grams_sql(n, 'w') for n in (1, 2, 3))}) SELECT arm, n_words, count(DISTINCT gram) / count(*) AS distinct_n FROM g GROUP BY arm, n_words")
def n07_distinct_n(spark, sf_dir):
    return a.distinct_n(chat.responses(spark, sf_dir), group=["arm"])


@query(f"""WITH p AS {chat.sql('assistant')}, w AS (SELECT arm, conv_id, {CLEAN('text')} AS w FROM p WHERE length({STRIP('text')}) > 0), g AS ({' UNION ALL '.join(_grams_sql(n, 'w') for n in (1, 2, 3, 4))}),
c AS (SELECT conv_id, n_words AS k, gram, count(*) AS c FROM g GROUP BY 1, 2, 3),
o AS (SELECT x.conv_id, x.k, x.gram, x.c, coalesce(max(y.c), 0) AS m FROM c x LEFT JOIN c y ON x.k = y.k AND x.gram = y.gram AND x.conv_id <> y.conv_id GROUP BY 1, 2, 3, 4),
s AS (SELECT conv_id, k, sum(c) AS total, sum(least(c, m)) AS hit FROM o GROUP BY 1, 2),
l AS (SELECT conv_id, sum(ln(CASE WHEN hit > 0 THEN hit / total ELSE 0.1 / total END)) + (4 - count(*)) * ln(1e-9) AS lp FROM s GROUP BY 1),
r AS (SELECT a.conv_id, len(a.w) AS n, arg_min(len(b.w), (abs(len(b.w) - len(a.w)), len(b.w))) AS ref FROM w a JOIN w b ON a.conv_id <> b.conv_id WHERE len(a.w) > 0 GROUP BY 1, 2)
SELECT conv_id, round(CASE WHEN n >= ref THEN 1 ELSE exp(1 - ref / n) END * exp(lp / 4), 9) AS bleu FROM l JOIN r USING (conv_id)""")
def n08_self_bleu(spark, sf_dir):
    return a.self_bleu(chat.responses(spark, sf_dir), "conv_id").select("conv_id", F.round("bleu", 9).alias("bleu"))
