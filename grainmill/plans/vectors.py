"""Queries V01 to V15."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import neighbours, spectrum, vectors as v
from . import chat
from ..sources.store import written
from .registry import query, table

_U = "u AS (SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS e FROM embeddings)"
_MEAN = "CASE WHEN n > 1 THEN (q - n) / (n * (n - 1)) END"


def _rows(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


@query()
def v01_embed(spark, sf_dir):
    return v.hashed_embedding(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "embedding")


@query(f"WITH {_U}, s AS (SELECT d, sum(x) AS s, count(*) AS n FROM (SELECT unnest(e) AS x, unnest(range(64)) AS d FROM u) GROUP BY d), t AS (SELECT sum(s * s) AS q, max(n) AS n FROM s) SELECT n, round({_MEAN}, 9) AS mean_cosine FROM t")
def v02_mean_cosine(spark, sf_dir):
    return v.mean_cosine(_rows(spark, sf_dir)).select("n", F.round("mean_cosine", 9).alias("mean_cosine"))


_NN = f"WITH {_U}, p AS (SELECT a.vec_id, b.vec_id AS nn, list_dot_product(a.e, b.e) AS sim FROM u a JOIN u b ON a.vec_id <> b.vec_id), n AS (SELECT vec_id, arg_max(nn, (sim, -nn)) AS nn, max(sim) AS sim FROM p GROUP BY vec_id)"


@query(_NN + " SELECT vec_id, nn, round(sim, 6) AS sim FROM n")
def v03_nearest(spark, sf_dir):
    return v.neighbours(_rows(spark, sf_dir), "vec_id").select("vec_id", "nn", F.round("sim", 6).alias("sim"))


@query()
def v04_vendi(spark, sf_dir):
    score, n = v.vendi(_rows(spark, sf_dir)), _rows(spark, sf_dir).count()
    return spark.createDataFrame([(n, score, score / n if n else 0.0)], "n long, vendi double, ratio double")


@query()
def v05_evenness(spark, sf_dir):
    return v.evenness(_rows(spark, sf_dir))


@query()
def v06_plane(spark, sf_dir):
    return v.plane(_rows(spark, sf_dir), "vec_id")


@query(_NN + ", q AS (SELECT least(vec_id, nn) AS a, greatest(vec_id, nn) AS b, max(sim) AS sim FROM n WHERE sim >= 0.3 GROUP BY 1, 2) SELECT a, b, round(sim, 6) AS sim FROM q ORDER BY round(q.sim, 9) DESC, a, b LIMIT 10")
def v08_top_pairs(spark, sf_dir):
    return v.top_pairs(v.neighbours(_rows(spark, sf_dir), "vec_id"), "vec_id", 10, 0.3).select("a", "b", F.round("sim", 6).alias("sim"))


@query(f"WITH {_U}, s AS (SELECT label, d, sum(x) AS s, count(*) AS n FROM (SELECT label, unnest(e) AS x, unnest(range(64)) AS d FROM u) GROUP BY 1, 2), t AS (SELECT label, sum(s * s) AS q, max(n) AS n FROM s GROUP BY label) SELECT label, n, round({_MEAN}, 9) AS mean_cosine FROM t")
def v09_group_cosine(spark, sf_dir):
    return v.mean_cosine(_rows(spark, sf_dir), ["label"]).select("label", "n", F.round("mean_cosine", 9).alias("mean_cosine"))


@query(f"WITH {_U}, c AS (SELECT label, d, avg(x) AS x FROM (SELECT label, unnest(e) AS x, unnest(range(64)) AS d FROM u) GROUP BY 1, 2), w AS (SELECT label, sqrt(sum(x * x)) AS w FROM c GROUP BY label), s AS (SELECT d, sum(x / w) AS s, count(*) AS n FROM c JOIN w USING (label) WHERE w > 0 GROUP BY d), t AS (SELECT sum(s * s) AS q, max(n) AS n FROM s) SELECT n AS groups, round({_MEAN}, 9) AS mean_cosine FROM t")
def v09_centroid_cosine(spark, sf_dir):
    return v.centroid_cosine(_rows(spark, sf_dir), "label").select("groups", F.round("mean_cosine", 9).alias("mean_cosine"))


@query(f"WITH {_U}, s AS (SELECT label, d, sum(x) AS s, count(*) AS n FROM (SELECT label, unnest(e) AS x, unnest(range(64)) AS d FROM u) GROUP BY 1, 2), t AS (SELECT label, sum(s * s) AS q, max(n) AS n FROM s GROUP BY label) SELECT label, coalesce(n_name, label::VARCHAR) AS name, n, round({_MEAN}, 4) AS mean_cosine FROM t LEFT JOIN nation ON n_nationkey = label WHERE (SELECT count(*) FROM t) >= 2")
def a42_group_breakdown(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("label"), "n_name")
    rows = _rows(spark, sf_dir).join(names, "label", "left")
    return v.group_breakdown(rows, "label", "n_name", "vec_id").select("label", "name", "n", F.round("mean_cosine", 4).alias("mean_cosine"))


@query("WITH m AS (SELECT conv_id, list(text ORDER BY turn) AS t, list(role ORDER BY turn) AS r FROM conversations GROUP BY conv_id) SELECT conv_id, list_extract(list_filter(t, lambda x, i: r[i] = 'user'), 1) AS prompt, list_extract(list_filter(t, lambda x, i: r[i] = 'assistant'), 1) AS response, array_to_string(t, chr(10) || chr(10)) AS combined FROM m")
def v10_scopes(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    m = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    first = lambda role: F.get(F.filter("m", lambda x: x["role"] == role), F.lit(0))["text"]
    return m.select("conv_id", first("user").alias("prompt"), first("assistant").alias("response"), F.array_join(F.transform("m", lambda x: x["text"]), "\n\n").alias("combined"))


@query("SELECT coalesce('doc-' || d.doc_id, 'row') AS id, coalesce(nullif(d.text, ''), b.text, '') AS content, length(coalesce(nullif(d.text, ''), b.text, '')) AS n FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id")
def v11_record_text(spark, sf_dir):
    """A record's id and text by precedence of its columns."""
    d, b = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("other"))
    content = F.coalesce(F.nullif(F.col("text"), F.lit("")), F.col("other"), F.lit(""))
    return d.join(b, "doc_id", "left").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"), content.alias("content"), F.length(content).cast("long").alias("n"))


@query()
def v12_first_sentence_check(spark, sf_dir):
    """Mean cosine and near pairs of the embedded first sentences."""
    from ..functions.text import first_chat_sentence

    r = v.hashed_embedding(chat.responses(spark, sf_dir).select("conv_id", first_chat_sentence("text").alias("text"))).where("embedding is not null")
    near = v.neighbours(r, "conv_id")
    return v.mean_cosine(r).crossJoin(near.agg(F.count_if(F.col("sim") > 0.9).alias("over_90")))


_STYLE = f"""p AS {chat.sql('user')}, s AS (SELECT conv_id, regexp_replace(lower(text), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g') AS s FROM p), n AS (SELECT count(*) AS n FROM s),
g AS (SELECT conv_id, unnest(list_transform(range(1, length(s) - k + 2), lambda i: substring(s, i, k))) AS gram FROM s, (VALUES (3), (4), (5)) k(k)),
c AS (SELECT conv_id, gram, count(*) AS c FROM g GROUP BY 1, 2), d AS (SELECT gram, count(*) AS df FROM c GROUP BY 1),
r AS (SELECT conv_id, gram, (1 + ln(c)) * ln((1.0 + n) / (1 + df)) + 1 AS w FROM c JOIN d USING (gram), n), v AS (SELECT conv_id, gram, w / sqrt(sum(w * w) OVER (PARTITION BY conv_id)) AS w FROM r)"""


def _style(spark, sf_dir):
    prompts = written(chat.prompts(spark, sf_dir), "prompts")
    return written(v.style_vectors(prompts, "conv_id"), "style"), prompts.select("conv_id")


@query(f"WITH {_STYLE} SELECT conv_id, count(*) AS grams, round(max(w), 9) AS heaviest, round(sum(w * w), 6) AS norm FROM v GROUP BY conv_id")
def v13_style_vectors(spark, sf_dir):
    w = v.style_vectors(chat.prompts(spark, sf_dir), "conv_id")
    return w.groupBy("conv_id").agg(F.count(F.lit(1)).alias("grams"), F.round(F.max("w"), 9).alias("heaviest"), F.round(F.sum(F.col("w") * F.col("w")), 6).alias("norm"))


@query(f"WITH {_STYLE}, x AS (SELECT a.conv_id, sum(a.w * b.w) AS sim FROM v a JOIN v b ON a.gram = b.gram AND a.conv_id <> b.conv_id GROUP BY a.conv_id, b.conv_id) SELECT p.conv_id, round(greatest(0, least(1, coalesce(max(sim), 0))), 9) AS nn FROM p LEFT JOIN x USING (conv_id) GROUP BY p.conv_id")
def v14_style_nearest(spark, sf_dir):
    near = neighbours.of_features(*_style(spark, sf_dir), "conv_id")
    return near.select("conv_id", F.round("nn", 9).alias("nn"))


@query(f"WITH {_STYLE}, x AS (SELECT sum(a.w * b.w) AS sim FROM v a JOIN v b ON a.gram = b.gram GROUP BY a.conv_id, b.conv_id) SELECT n, round((SELECT sum(w * w) FROM v) / n, 6) AS trace, round((SELECT sum(sim * sim) FROM x) / n / n, 9) AS squared FROM n")
def v14_style_spectrum(spark, sf_dir):
    """Sums of the eigenvalues of the style vectors' products and of their squares."""
    return spectrum.moments(*_style(spark, sf_dir), "conv_id").select("n", F.round("trace", 6).alias("trace"), F.round("squared", 9).alias("squared"))


@query()
def v14_style_vendi(spark, sf_dir):
    return spectrum.spectrum(*_style(spark, sf_dir), "conv_id").select("n", "vendi", "ratio", "complete")


@query()
def v14_style_plane(spark, sf_dir):
    return spectrum.plane(*_style(spark, sf_dir), "conv_id")


@query("""WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS k, coalesce(length(text), 0) AS len FROM documents),
r(k, batch, place, size) AS (SELECT k, 0::BIGINT, 0::BIGINT, len FROM d WHERE k = 1 UNION ALL
  SELECT d.k, CASE WHEN r.place + 1 >= 128 OR r.size + d.len > 180000 THEN r.batch + 1 ELSE r.batch END, CASE WHEN r.place + 1 >= 128 OR r.size + d.len > 180000 THEN 0 ELSE r.place + 1 END, CASE WHEN r.place + 1 >= 128 OR r.size + d.len > 180000 THEN d.len ELSE r.size + d.len END
  FROM r JOIN d ON d.k = r.k + 1)
SELECT doc_id, batch, place FROM r JOIN d USING (k)""")
def v15_request_batches(spark, sf_dir):
    return v.request_batches(table(spark, sf_dir, "documents"), "doc_id")
