"""The registered queries of this package, opN_<name>, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import divergence, fingerprints, mixing, neardup, packing, repetitions, sharding, suffixes, tokenfiles, topk, toxicity, url_filter, warc

URL_RULES = [
    url_filter.parse(text, verdict)
    for text, verdict in (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.copies(docs.select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=4, percent=80)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(~toxicity.learnable(F.col("doc_id")), F.lit(False))
    return toxicity.score(docs, model, at=0.7).select("doc_id", held_out.alias("held_out"), "score", "predicted", "evidence")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def replanted(docs: DataFrame) -> DataFrame:
    """doc_id, text: each tenth text by the hash of its doc_id repeats a stretch of its words to its end."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    g, n = F.floor(h / 10), F.size("w")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    again = F.concat(F.slice("w", F.lit(1), a), F.transform(F.sequence(a, n - 1), lambda i: F.get("w", (a + (i - a) % p).cast("int"))))
    odd = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"))
    return odd.select("doc_id", F.when(F.size("w") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetitions.find(replanted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    rows = found.select("doc_id", "runs", "collapsed", best.alias("best"), lines.alias("lines"))
    length, period = F.col("best.length"), -F.col("best.less")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(F.lit(1000) * length / period).alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_mixing, op3_near_duplicates, op4_suffix_dedup, op5_packing, op6_exact_topk, op7_fingerprints, op8_sharding, op9_warc, op10_toxicity, op11_source_divergence, op12_periodic_runs, op13_token_files)}

_OP1_SQL = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r(rhost, rpath, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT page_id, host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(r.verdict, length(rhost || rpath)) AS verdict
  FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id, host, path)
SELECT u.page_id, u.host, u.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
FROM u LEFT JOIN best USING (page_id, host, path)
"""

# Shingles are lists of words; equal sets are one node; components by the least doc_id that is reached.
_OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) END) AS s
  FROM w),
h AS (SELECT doc_id, md5(array_to_string(list_sort(s), chr(10))) AS class, s, len(s) AS n FROM s),
c AS (SELECT class, min(doc_id) AS rep, any_value(s) AS s, any_value(n) AS n FROM h WHERE n > 0 GROUP BY class),
e AS (SELECT rep, n, md5_number_lower(g) AS g FROM (SELECT rep, n, unnest(s) AS g FROM c)),
b AS (
  SELECT x.rep AS a, y.rep AS b FROM e x JOIN e y ON x.g = y.g AND x.rep < y.rep
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY x.rep, y.rep, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
l AS (SELECT a, b FROM b UNION ALL SELECT b, a FROM b),
r(rep, root) AS (SELECT rep, rep FROM c UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.rep AND r.root < l.b),
t AS (SELECT rep, min(root) AS root FROM r GROUP BY rep)
SELECT h.doc_id, h.n AS n_shingles, coalesce(t.root, h.doc_id) AS component_id, coalesce(t.root, h.doc_id) = h.doc_id AS kept
FROM h LEFT JOIN c ON c.class = h.class AND h.n > 0 LEFT JOIN t ON t.rep = c.rep
"""

# Bytes are pairs of hexadecimal digits; a window is a hundred of them.
_OP4_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING count(*) > 1),
m AS (SELECT w.doc_id, w.i FROM w JOIN f USING (s) WHERE w.doc_id > f.first),
g AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM m),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g) GROUP BY doc_id, run),
p AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
k AS (SELECT d.doc_id, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(x), 2 * max(z) + 1) AS x, sum(z - a) AS removed, count(*) AS spans FROM p JOIN d USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(k.removed, 0)::BIGINT AS n_removed, coalesce(k.spans, 0) AS n_spans, sha256(unhex(coalesce(k.x, d.x))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

_OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

# Base 32 takes five bits at a time: eight letters for ten hexadecimal digits.
_OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, max(page_id) AS last FROM p GROUP BY h)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(p.h, (10 * (i // 8) + 1)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM p JOIN f USING (h)
"""

# Every group against every kept term of its language.
_OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
t AS (SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0) AS total, (SELECT count(*) FROM k WHERE k.lang = g.lang) AS v FROM g),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (t.total + 2 * t.v) AS p FROM t JOIN k USING (lang) LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q FROM k),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM x)
SELECT lang, source, part, item, value, rank FROM z WHERE part = 'pair' OR rank <= 10
"""

ORACLE_SQL = {"op1_url_filter": _OP1_SQL, "op3_near_duplicates": _OP3_SQL, "op4_suffix_dedup": _OP4_SQL, "op6_exact_topk": _OP6_SQL, "op9_warc": _OP9_SQL, "op11_source_divergence": _OP11_SQL}
