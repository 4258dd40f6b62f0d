"""Batch checks, phrase lists across runs, report comparison and the long tables behind charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .lineage import first_by
from .judged import VERDICTS
from .phrases import uncovered

#: Shares that a batch is checked against.
DRIFT, HIDDEN, CROWDED = 0.15, 0.20, 0.12


def tally(cards: DataFrame, axes: Sequence[str], lists: Sequence[str] = ()) -> DataFrame:
    """axis, label, n: how many cards have a label; a missing one is "?". Of a list column each label counts once a card."""
    one = F.array(*[F.struct(F.lit(a).alias("axis"), F.coalesce(F.col(a), F.lit("?")).alias("label")) for a in axes])

    def labels(name: str) -> Column:
        held = F.array_distinct(F.coalesce(F.col(name), F.array().cast("array<string>")))
        return F.transform(held, lambda x: F.struct(F.lit(name).alias("axis"), x.alias("label")))

    many = map(labels, lists)
    return cards.select(F.explode(F.concat(one, *many)).alias("x")).select("x.*").groupBy("axis", "label").agg(F.count(F.lit(1)).alias("n"))


def checklist(cards: DataFrame, dealt: DataFrame, thin: Sequence[str], categories: Sequence[str], archetypes: Mapping[str, float], manual: Sequence[str] = (), domains: str = "domain") -> DataFrame:
    """pos, item, ok, seen: the mechanical checks of a batch; manual ones have no ok.

    cards(conflict, leverage, visibility, user_attitude, domain array, taxa, archetype, archetype_overwrites); dealt(axis,
    label, weight) holds the weights of the weighted axes. No cards, no rows."""
    spark = cards.sparkSession
    total = cards.agg(F.count(F.lit(1)).alias("total")).where("total > 0")
    counts = tally(cards, ["conflict", "leverage", "taxa"], [domains])
    share = dealt.join(counts, ["axis", "label"], "left").crossJoin(total).withColumn("off", F.abs(F.coalesce("n", F.lit(0)) / F.col("total") - F.col("weight")))
    weighted = share.groupBy("axis").agg(F.max("off").alias("seen")).select(F.concat(F.col("axis"), F.lit(" shares track dealt weights")).alias("item"), F.when(F.col("axis") == "conflict", 0).otherwise(1).alias("pos"), (F.col("seen") <= DRIFT).alias("ok"), F.round("seen", 6).alias("seen"))
    hidden = F.coalesce(F.col("visibility"), F.lit("")) == "hidden"
    facts = cards.agg(
        F.avg(hidden.cast("int")).alias("hidden"),
        F.count_if(hidden & (F.coalesce(F.col("user_attitude"), F.lit("")) != "unaware")).alias("aware"),
        F.coalesce(F.sum(F.size(F.coalesce("archetype_overwrites", F.array().cast("array<string>")))), F.lit(0)).alias("overwrites"),
    ).crossJoin(total)
    top = counts.where(F.col("axis") == domains).agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"))
    held = counts.where(F.col("axis") == domains).agg(F.collect_set(F.when(F.col("label").isin(*thin), F.col("label"))).alias("thin")) if thin else None
    taxa = counts.where((F.col("axis") == "taxa") & (F.col("label") != "?")).agg(F.collect_set("label").alias("taxa"), F.coalesce(F.max("n"), F.lit(0)).alias("most_taxa"))
    both = facts.crossJoin(top).crossJoin(taxa)  # one row each
    both = both.crossJoin(held) if held is not None else both.withColumn("thin", F.array().cast("array<string>"))
    small = F.col("total") <= len(categories)
    missing = F.size(F.array_except(F.array(*map(F.lit, categories)), "taxa"))
    checks = [
        ("hidden visibility at 20 % or more", F.col("hidden") >= HIDDEN, F.col("hidden")),
        ("hidden entails an unaware attitude", F.col("aware") == 0, F.col("aware")),
        ("no domain above 12 %", F.col("most") / F.col("total") <= CROWDED, F.col("most") / F.col("total")),
        ("thin domains are there", F.size("thin") == len(set(thin)), F.size("thin")),
        ("taxa are distinct, or all there", F.when(small, F.col("most_taxa") <= 1).otherwise(missing == 0), F.when(small, F.col("most_taxa")).otherwise(missing)),
        ("archetype swaps kept the shares", F.col("overwrites") == 0, F.col("overwrites")),
    ]
    row = lambda k, x: F.struct(F.lit(x[0]).alias("item"), F.lit(k + 2).alias("pos"), x[1].alias("ok"), F.round(x[2].cast("double"), 6).alias("seen"))
    plain = both.select(F.explode(F.array(*[row(k, x) for k, x in enumerate(checks)])).alias("x")).select("x.*")
    kinds = spark.createDataFrame([(k, a, s) for k, (a, s) in enumerate(archetypes.items())] or [(0, None, None)], "k int, archetype string, share double").where("archetype is not null")
    seen = cards.groupBy("archetype").agg(F.count(F.lit(1)).alias("n"))
    quota = kinds.join(seen, "archetype", "left").crossJoin(total).select(F.concat(F.lit("archetype "), "archetype").alias("item"), (F.col("k") + 20).alias("pos"), (F.coalesce("n", F.lit(0)) >= F.bround(F.col("share") * F.col("total"))).alias("ok"), F.coalesce("n", F.lit(0)).cast("double").alias("seen"))
    by_hand = spark.createDataFrame([(m, 100 + k) for k, m in enumerate(manual)] or [("", -1)], "item string, pos int").where("pos >= 0").crossJoin(total).select("item", "pos", F.lit(None).cast("boolean").alias("ok"), F.lit(None).cast("double").alias("seen"))
    rows = weighted.unionByName(plain).unionByName(quota).unionByName(by_hand)
    return rows.select(F.col("pos").cast("long").alias("pos"), "item", "ok", "seen")


# ---- phrase lists


def recurrence(candidates: DataFrame, excluded: DataFrame, arm: str | None = None, min_runs: int = 1) -> DataFrame:
    """place, phrase, arm, times_seen, max_z, max_prev, example over the candidates of all runs (run_id, pos, phrase, arm, df,
    of, z, example): most runs first, then the highest z, then the highest share of documents."""
    rows = uncovered(candidates if arm is None else candidates.where(F.col("arm") == arm), excluded)
    share = F.when(F.col("of") > 0, F.col("df") / F.col("of"))
    per = rows.groupBy("phrase", "arm").agg(
        F.count_distinct("run_id").alias("times_seen"), F.max("z").alias("max_z"), F.coalesce(F.max(share), F.lit(0.0)).alias("max_prev"),
        F.coalesce(F.min_by("example", F.when(F.col("example") != "", F.struct("run_id", "pos"))), F.lit("")).alias("example"),
    ).where(F.col("times_seen") >= min_runs)
    order = Window.orderBy(F.desc("times_seen"), F.desc(F.coalesce("max_z", F.lit(0.0))), F.desc("max_prev"), "phrase", "arm")
    return per.withColumn("place", F.row_number().over(order).cast("long"))


def edited(lists: DataFrame, edits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lists, messages): edits(pos, phrase, origin, note) appended to lists(origin, phrase, note), origin `ignore` for the
    phrases to leave alone. A phrase that is there already, or earlier among the edits, is only reported."""
    first = first_by(edits, ["phrase"], "pos").select("phrase", F.col("pos").alias("__first"))
    there = lists.groupBy("phrase").agg(F.min("origin").alias("__in"))
    known = edits.join(there, "phrase", "left").join(first, "phrase")
    fresh = F.col("__in").isNull() & (F.col("pos") == F.col("__first"))
    twice = F.concat(F.lit("already in "), F.coalesce("__in", F.col("origin")))
    messages = known.select("pos", "phrase", F.when(fresh, F.concat(F.lit("added to "), "origin")).otherwise(twice).alias("message"))
    return lists.unionByName(known.where(fresh).select("origin", "phrase", "note")), messages


# ---- reports


def compared(current: DataFrame, previous: DataFrame) -> DataFrame:
    """metric, value, previous, delta of metrics that both reports (model, metric, value) have; none if the reports were made
    with different embedding models, whose cosines can't be compared."""
    old = previous.select("metric", F.col("model").alias("__m"), F.col("value").alias("previous"))
    both = current.join(old, "metric").where("model = __m and value is not null and previous is not null")
    return both.select("metric", "value", "previous", (F.col("value") - F.col("previous")).alias("delta"))


def by_arm(rows: DataFrame, arms: Sequence[str] = ("pipeline", "plain")) -> DataFrame:
    """A column for each arm: rows(section, label, arm, value)."""
    return rows.groupBy("section", "label").pivot("arm", list(arms)).agg(F.first("value"))


def carried(current: DataFrame, previous: DataFrame, paid: Sequence[str]) -> DataFrame:
    """The rows of a report with those paid sections of the previous one that it lacks."""
    mine = current.select("section").distinct()
    return current.unionByName(previous.where(F.col("section").isin(*paid)).join(mine, "section", "left_anti"))


def empties(rows: DataFrame, column: str = "text", most: int = 7000) -> DataFrame:
    """One row: records, skipped, embedded, truncated; empty records aren't embedded, long ones only their front."""
    empty = F.coalesce(F.length(column), F.lit(0)) == 0
    return rows.agg(F.count(F.lit(1)).alias("records"), F.count_if(empty).alias("skipped"), F.count_if(~empty).alias("embedded"), F.count_if(F.length(column) > most).alias("truncated"))


# ---- charts: long tables (chart, series, label, value)


def chart(rows: DataFrame, name: str, series: Column, label: Column, value: Column) -> DataFrame:
    return rows.select(F.lit(name).alias("chart"), series.cast("string").alias("series"), label.cast("string").alias("label"), value.cast("double").alias("value"))


def counted(rows: DataFrame, name: str, series: str, label: str) -> DataFrame:
    """How many rows of each series have a label; the shapes of responses, types of reasons, verdicts."""
    return chart(rows.groupBy(series, label).agg(F.count(F.lit(1)).alias("n")), name, F.col(series), F.col(label), F.col("n"))


def over_used(hits: DataFrame, name: str = "tics") -> DataFrame:
    """phrases(phrase, pipeline, plain) that appear in either arm, two points each."""
    rows = hits.where("pipeline > 0 or plain > 0")
    pair = F.array(*[F.struct(F.lit(a).alias("series"), F.col(a).alias("value")) for a in ("pipeline", "plain")])
    return chart(rows.select("phrase", F.explode(pair).alias("x")), name, F.col("x.series"), F.col("phrase"), F.col("x.value"))


def deltas(rows: DataFrame, key: str, name: str = "deltas") -> DataFrame:
    """The pipeline's value less the plain one's for each key that both arms have: rows(key, arm, value)."""
    both = rows.groupBy(key).pivot("arm", ["pipeline", "plain"]).agg(F.first("value")).where("pipeline is not null and plain is not null")
    return chart(both, name, F.lit("pipeline - plain"), F.col(key), F.col("pipeline") - F.col("plain"))


# ---- charts of judged reasons and of a library: a label is a record, `detail` what stands behind a value


def _detailed(rows: DataFrame, name: str, series: Column, label: Column, value: Column, detail: Column) -> DataFrame:
    return rows.select(F.lit(name).alias("chart"), series.cast("string").alias("series"), label.cast("string").alias("label"), value.cast("double").alias("value"), detail.cast("string").alias("detail"))


def survived(judged: DataFrame, point: str = "reason", name: str = "survival") -> DataFrame:
    """By record, how many of the plain arm's points were kept, weakened and dropped, and how many were added, with the points:
    judged(prompt_id, anchored array<struct<point, verdict>>, added). Empty buckets and records that weren't judged have no row."""
    of = lambda v: F.struct(F.lit(v).alias("series"), F.transform(F.filter("anchored", lambda a: a["verdict"] == v), lambda a: a[point]).alias("points"))
    buckets = F.array(*map(of, VERDICTS), F.struct(F.lit("added").alias("series"), F.coalesce("added", F.array().cast("array<string>")).alias("points")))
    rows = judged.where("anchored is not null").select("prompt_id", F.explode(buckets).alias("b")).where(F.size("b.points") > 0)
    return _detailed(rows, name, F.col("b.series"), F.col("prompt_id"), F.size("b.points"), F.array_join("b.points", " • ", "None"))


def reason_counts(cases: DataFrame, name: str = "reasons") -> DataFrame:
    """How many reasons each arm gives by record: cases(prompt_id, arm, reasons); unread ones have no row."""
    return _detailed(cases.where("reasons is not null"), name, F.col("arm"), F.col("prompt_id"), F.size("reasons"), F.array_join("reasons", " • "))


def offered(judged: DataFrame, name: str = "alternatives") -> DataFrame:
    """What both arms offer by record: the plain one all that is anchored, the pipeline what it kept or weakened of that and added."""
    rows = judged.where("anchored is not null")
    kept = F.size(F.filter("anchored", lambda a: a["verdict"].isin("kept", "weakened"))) + F.size(F.coalesce("added", F.array().cast("array<string>")))
    both = F.array(F.struct(F.lit("plain").alias("series"), F.size("anchored").alias("n")), F.struct(F.lit("pipeline").alias("series"), kept.alias("n")))
    return _detailed(rows.select("prompt_id", F.explode(both).alias("x")), name, F.col("x.series"), F.col("prompt_id"), F.col("x.n"), F.lit(None))


def pulls(pulled: DataFrame, name: str = "pulls") -> DataFrame:
    """How many entries each record pulled, and which: pulled(prompt_id, ids)."""
    return _detailed(pulled, name, F.lit("pulled"), F.col("prompt_id"), F.size("ids"), F.array_join("ids", ", "))


def pull_scatter(pulled: DataFrame, judged: DataFrame, name: str = "scatter") -> DataFrame:
    """Of records with both: how many reasons were added (the value) where so many entries were pulled (the series)."""
    both = pulled.join(judged.where("anchored is not null").select("prompt_id", "added"), "prompt_id")
    return _detailed(both, name, F.size("ids"), F.col("prompt_id"), F.size(F.coalesce("added", F.array().cast("array<string>"))), F.array_join("ids", ", "))


def triggers(pulled: DataFrame, library: DataFrame, name: str = "triggers") -> DataFrame:
    """In how many records each entry of library(entry, move) was pulled, those of none with 0."""
    hits = pulled.select(F.explode(F.array_distinct("ids")).alias("entry")).groupBy("entry").agg(F.count(F.lit(1)).alias("n"))
    return _detailed(library.join(hits, "entry", "left"), name, F.col("move"), F.col("entry"), F.coalesce("n", F.lit(0)), F.lit(None))


def batch_totals(values: DataFrame) -> DataFrame:
    """metric, plain, pipeline, difference, share (of plain; null where that is 0): sums of values(prompt_id, arm, metric, value)
    over the records that both arms have."""
    side = lambda arm: F.sum(F.when(F.col("arm") == arm, F.col("value")))
    both = values.groupBy("metric", "prompt_id").agg(side("plain").alias("plain"), side("pipeline").alias("pipeline")).where("plain is not null and pipeline is not null")
    rows = both.groupBy("metric").agg(F.sum("plain").alias("plain"), F.sum("pipeline").alias("pipeline"))
    difference = F.col("pipeline") - F.col("plain")
    return rows.select("metric", "plain", "pipeline", difference.alias("difference"), F.when(F.col("plain") != 0, F.round(difference / F.col("plain"), 6)).alias("share"))
