"""Queries of sources, parsing, model stages and streams: S, J, L, D05, S21."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse, text as t
from ..operators import generation, stages
from ..sources import files, log, store
from ..streaming import keepfirst
from .dedup import GREEDY
from .registry import query, table
from .text import STRIP

_DOC = "doc_id long, text string, lang string"


@query("SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS lang FROM documents")
def s02_jsonl_round_trip(spark, sf_dir):
    """Written with explicit nulls, read back under a fixed schema."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"))
    path = store.new_path(spark, "jsonl")
    files.save_jsonl(rows, path)
    return files.load_jsonl(spark, path, _DOC)


@query("SELECT doc_id, text, lang FROM documents WHERE false")
def s01_absent_file(spark, sf_dir):
    return files.load_jsonl(spark, store.new_path(spark, "absent"), _DOC)


@query("WITH p AS (SELECT item_id, unnest([1, 2]) AS pos FROM benchmark) SELECT item_id, (pos - 1)::BIGINT AS pos, 'Part ' || pos AS title, CASE pos WHEN 1 THEN 'body ' || item_id ELSE 'more' END AS body FROM p")
def s10_markdown_sections(spark, sf_dir):
    i = F.col("item_id").cast("string")
    text = F.concat(F.lit("# Title\nintro\n## Part 1\n\nbody "), i, F.lit("\n\n## Part 2\nmore\n## Empty\n"))
    return files.sections(table(spark, sf_dir, "benchmark").select("item_id", text.alias("text")), keys=("item_id",)).select("item_id", "pos", "title", "body")


@query("SELECT array_to_string(list(n_nationkey || '. ' || n_name || chr(10) || '\"see ' || n_regionkey || '\"' ORDER BY n_nationkey), chr(10) || chr(10)) AS block FROM nation")
def s09_principles(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("number"), F.col("n_name").alias("principle"), F.concat(F.lit("see "), F.col("n_regionkey").cast("string")).alias("constitution_excerpts"))
    return files.render_principles(n)


@query("WITH a AS (SELECT DISTINCT text FROM documents), h AS (SELECT DISTINCT text FROM documents WHERE doc_id % 2 = 0) SELECT (SELECT count(*) FROM h) AS hits, (SELECT count(*) FROM a) - (SELECT count(*) FROM h) AS misses")
def s21_embedding_cache(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.lit("m").alias("model"), "text", "doc_id")
    cache = d.where("doc_id % 2 = 0").select(F.sha2(F.concat("model", F.lit("\x00"), "text"), 256).alias("key"))
    hits, misses = files.cached(cache, d.drop("doc_id"))
    return hits.agg(F.count(F.lit(1)).alias("hits")).crossJoin(misses.agg(F.count(F.lit(1)).alias("misses")))


@query("SELECT CASE WHEN event_type = 'view' THEN NULL ELSE 'seed-' || event_id END AS id, event_type AS prompt FROM events WHERE event_type <> ''")
def s24_seed_import(spark, sf_dir):
    """Seeds from either column, blank ones skipped; a repeated id is an error."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.when(F.col("event_type") != "view", F.concat(F.lit("seed-"), F.col("event_id").cast("string"))).alias("id"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("prompt"), F.when(F.col("event_id") % 2 == 1, F.concat("event_type", F.lit("\n"))).alias("user_message"))
    return files.seeds(rows)


@query("SELECT event_id, props AS value FROM events")
def j01_extract_json(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("so: "), "props", F.lit(" and [1, {broken")).alias("raw"))
    return e.select("event_id", parse.extract_json("raw").alias("value"))


@query("SELECT event_id, CASE WHEN props IS NULL THEN 0 ELSE 2 END AS objects FROM events")
def j03_salvage(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("["), "props", F.lit(', {"a": 1}, {"b": ')).alias("raw"))
    return e.select("event_id", F.size(parse.salvaged("raw")).alias("objects"))


@query(f"WITH x AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '<document> ' || text || '</document>' WHEN doc_id % 3 = 1 THEN '<document></document>' ELSE text END AS raw FROM documents) SELECT doc_id, nullif({STRIP("regexp_extract(raw, '(?s)<document>(.*?)</document>', 1)")}, '') AS value FROM x")
def j04_tag_capture(spark, sf_dir):
    raw = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<document> "), "text", F.lit("</document>"))).when(F.col("doc_id") % 3 == 1, "<document></document>").otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", t.tag(raw, "document").alias("value"))


@query(f"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN nullif({STRIP('text')}, '') END AS value FROM documents")
def j05_unclosed_tag(spark, sf_dir):
    """The rest behind the last open tag, where the text ended by itself."""
    raw = F.concat(F.lit("<plan>old <plan>"), "text")
    return table(spark, sf_dir, "documents").select("doc_id", t.tag_tail(raw, "plan", F.col("doc_id") % 2 == 0).alias("value"))


@query("SELECT doc_id, doc_id % 4 = 0 AS value FROM documents")
def j06_incoherent(spark, sf_dir):
    raw = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("<plan>INCOHERENT</plan>"), "text")).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("<plan>fine</plan> INCOHERENT"), "text")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", t.incoherent(raw, "plan").alias("value"))


@query("WITH l(id, pos) AS (VALUES ('c1', 0), ('c2', 1), ('c3', 2)) SELECT item_id, CASE item_id % 2 WHEN 0 THEN 'c1,c3' ELSE 'c2' END AS ids FROM benchmark")
def j07_selected_ids(spark, sf_dir):
    """Known ids of a free list, each once, in the library's order."""
    raw = F.when(F.col("item_id") % 2 == 0, "c3, (c1); c3 c9").otherwise("c2.")
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(generation.chosen_ids(raw, ["c1", "c2", "c3"]), ",").alias("ids"))


@query("SELECT event_id, event_id % 9 = 0 AS valid FROM events")
def j08_scope_validity(spark, sf_dir):
    """Whether all seven axes hold text: one is missing, blank, a number or null in turn, or the scope is no object."""
    e = F.col("event_id")
    full = "{" + ", ".join(f'"{a}": "x"' for a in generation.SCOPE) + "}"
    raw = F.lit(full)
    for k, a in enumerate(generation.SCOPE, 1):
        bad = (f'"{a}": " "', f'"{a}": 7', f'"{a}": null', f'"{a}x": "x"')[k % 4]
        raw = F.when(e % 9 == k, full.replace(f'"{a}": "x"', bad)).otherwise(raw)
    return table(spark, sf_dir, "events").select("event_id", generation.valid_scope(F.when(e % 9 == 8, "[1]").otherwise(raw)).alias("valid"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 7 WHEN 1 THEN 0 ELSE 5 END AS alignment, CASE doc_id % 3 WHEN 0 THEN 8 WHEN 1 THEN 3 ELSE 5 END AS realism FROM documents")
def j09_score_parse(spark, sf_dir):
    raw = F.when(F.col("doc_id") % 3 == 0, '{"alignment": 7, "realism": 8}').when(F.col("doc_id") % 3 == 1, '{"realism": 3}').otherwise("not json {")
    return table(spark, sf_dir, "documents").select("doc_id", parse.scores(raw).alias("s")).select("doc_id", "s.alignment", "s.realism")


@query("WITH h AS (SELECT item_id, ('0x' || substr(md5(text), 1, 8))::BIGINT AS h FROM benchmark) SELECT item_id, 'answer ' || h AS parsed FROM h WHERE h % 7 <> 0")
def l01_stage_with_stub(spark, sf_dir):
    """Prompts through the offline stub, three attempts at most; the answers that were accepted."""
    prompts = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("prompt"))
    good, _ = stages.attempts(prompts, "item_id", stages.StubClient(7), store.new_path(spark, "answers"), lambda x: t.tag(x, "document"))
    return good.select("item_id", "parsed")


@query(GREEDY + " SELECT d.doc_id FROM documents d LEFT JOIN b ON b.j = d.doc_id WHERE b.kept_id IS NULL AND d.text IS NOT NULL")
def d05_incremental_filter(spark, sf_dir):
    """The keep-first filter over a stream of three batches."""
    path, out, progress = (store.new_path(spark, x) for x in ("stream", "kept", "progress"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").where("text is not null")
    ends = docs.agg(F.min("doc_id").alias("a"), (F.max("doc_id") + 1).alias("z")).first()
    keep = keepfirst.KeepFirst(spark, out)
    for part in range(3):  # files come in three times, in the order of their ids; each time the stream goes on where it was
        low, high = (ends.a + (ends.z - ends.a) * k // 3 if ends.a is not None else 0 for k in (part, part + 1))
        docs.where((F.col("doc_id") >= low) & (F.col("doc_id") < high)).write.mode("append").parquet(path)
        stream = spark.readStream.schema("doc_id long, text string").parquet(path)
        stream.writeStream.foreachBatch(keep).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    return keep.kept().select("doc_id")


@query("SELECT coalesce(event_type, 'untagged') AS stage, count(*) AS calls, round(sum(value), 6) AS cost FROM events GROUP BY 1", name="s22_cost_stream")
def s22_cost_stream(spark, sf_dir):
    """The cost roll-up as a stream over the log, run to its end."""
    calls = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    out = keepfirst.Snapshot(spark, store.new_path(spark, "costs"), "stage string, calls long, cost double")
    keepfirst.cost_by_stage(calls).writeStream.outputMode("complete").foreachBatch(out).option("checkpointLocation", store.new_path(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return out.read().withColumn("cost", F.round("cost", 6))


@query("SELECT count(*) FILTER (doc_id % 3 = 0) AS first, count(*) FILTER (doc_id % 3 <> 0) AS second, 0::BIGINT AS third, count(*) AS there FROM documents")
def s03_committed_append(spark, sf_dir):
    """A third of the rows, then all, then all again: each pass adds what isn't there yet, whole or not at all."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    held = log.Log(spark, store.new_path(spark, "log"), "doc_id long, lang string")
    first, second, third = (held.append_once(x, "doc_id").agg(F.count(F.lit(1)).alias(n)) for x, n in ((d.where("doc_id % 3 = 0"), "first"), (d, "second"), (d, "third")))
    there = held.read().agg(F.count_distinct("doc_id").alias("there"))
    return first.crossJoin(second).crossJoin(third).crossJoin(there)  # one row each


@query("WITH t AS (SELECT coalesce(text, '') AS text, max((doc_id % 3 = 0)::INT) AS late, max((doc_id % 2 = 0)::INT) AS early FROM documents GROUP BY 1) SELECT d.doc_id, CASE WHEN late = 1 THEN 2 WHEN early = 1 THEN 1 ELSE 0 END::BIGINT AS version FROM documents d JOIN t ON t.text = coalesce(d.text, '')")
def s21_cache_upserts(spark, sf_dir):
    """An embedding cache that is written twice and compacted: each text has the entry that came last, 0 where it has none."""
    key = F.sha2(F.concat(F.lit("m\x00"), F.coalesce("text", F.lit(""))), 256).alias("key")
    d = table(spark, sf_dir, "documents").select("doc_id", key)
    cache = log.Log(spark, store.new_path(spark, "cache"), "key string, version long")
    for _ in range(2):  # the second time nothing is added
        cache.append(d.where("doc_id % 2 = 0").select("key", F.lit(1).alias("version")).distinct(), "first")
        cache.append(d.where("doc_id % 3 = 0").select("key", F.lit(2).alias("version")).distinct(), "second")
    cache.compact("key")
    return d.join(cache.latest("key"), "key", "left").select("doc_id", F.coalesce("version", F.lit(0)).cast("long").alias("version"))


@query("SELECT coalesce(event_type, 'untagged') AS stage, count(*) AS calls FROM events GROUP BY 1")
def s22_cost_log_appends(spark, sf_dir):
    """Calls streamed into the cost log; a stream that begins again from its first batch adds nothing."""
    held = log.Log(spark, store.new_path(spark, "log"), "event_id long, event_type string, value double")
    for _ in range(2):
        events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
        events.writeStream.foreachBatch(held.sink).option("checkpointLocation", store.new_path(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return held.read().groupBy(F.coalesce("event_type", F.lit("untagged")).alias("stage")).agg(F.count(F.lit(1)).alias("calls"))
