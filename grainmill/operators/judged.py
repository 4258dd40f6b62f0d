"""Audits of what a judge returned: lists cleaned to what was asked for, prevalence, coverage, reasons, survival, stance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip
from .rules import verdict

#: A pattern that is a defect is flagged above this share; a principle below the floor is starved.
WIDESPREAD, FLOOR = 0.30, 0.05


def known(values: Column, allowed: Column) -> Column:
    """Those values, each once, that were to choose from."""
    return F.array_intersect(F.array_distinct(values), allowed)


def folded(label: Column, allowed: Sequence[str], other: str = "other") -> Column:
    """The label in lower case, or `other` if it isn't one that was asked for."""
    clean = F.lower(strip(F.coalesce(label, F.lit(""))))
    return F.when(clean.isin(*allowed), clean).otherwise(other)


def prevalence(patterns: DataFrame, judged: DataFrame) -> DataFrame:
    """id, pattern, is_defect, prevalence, flagged: of patterns(id, pattern, is_defect), the share of all documents of
    judged(doc_id, ids) that show it. A document without ids counts with none."""
    total = judged.agg(F.count(F.lit(1)).alias("total"))
    hits = judged.select("doc_id", F.explode(F.array_distinct("ids")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("hits"))
    share = F.coalesce("hits", F.lit(0)) / F.greatest(F.col("total"), F.lit(1))
    rows = F.broadcast(patterns).join(hits, "id", "left").crossJoin(total)  # one row of totals
    return rows.select("id", "pattern", "is_defect", F.round(share, 3).alias("prevalence"), (F.col("is_defect") & (share > WIDESPREAD)).alias("flagged"))


def coverage(principles: DataFrame, judged: DataFrame) -> DataFrame:
    """number, principle, share, starved: over the documents that were rated; judged(doc_id, ids), ids null where the
    judge's answer was unusable, which is unrated and not zero. Without any rating there are no rows."""
    rated = judged.where("ids is not null")
    total = rated.agg(F.count(F.lit(1)).alias("rated"))
    hits = rated.select(F.explode(F.array_distinct("ids")).alias("number")).groupBy("number").agg(F.count(F.lit(1)).alias("hits"))
    share = F.coalesce("hits", F.lit(0)) / F.col("rated")
    rows = F.broadcast(principles).join(hits, "number", "left").crossJoin(total.where("rated > 0"))
    return rows.select("number", "principle", F.round(share, 3).alias("share"), (share < FLOOR).alias("starved"))


def reasons(cases: DataFrame) -> DataFrame:
    """arm, n, mean_unique, corpus_distinct, density_per_1k, checkback: cases(prompt_id, arm, reasons, chars, added), a row
    for each response whose reasons could be read (others have null reasons and are left out)."""
    read = cases.where("reasons is not null")
    each = read.groupBy("arm").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("reasons")).alias("total"), F.sum("chars").alias("chars"), F.sum("added").alias("checkback"))
    distinct = read.select("arm", F.explode("reasons").alias("reason")).groupBy("arm").agg(F.count_distinct("reason").alias("corpus_distinct"))
    rows = each.join(distinct, "arm", "left")
    density = F.when(F.col("chars") > 0, F.round(F.col("total") / F.col("chars") * 1000, 2)).otherwise(0.0)
    return rows.select("arm", "n", F.round(F.col("total") / F.col("n"), 2).alias("mean_unique"), F.coalesce("corpus_distinct", F.lit(0)).alias("corpus_distinct"), density.alias("density_per_1k"), "checkback")


def type_histogram(labels: DataFrame, allowed: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """group, type, n of labels(type); those that weren't asked for count as other."""
    return labels.select(*group, folded(F.col("type"), allowed).alias("type")).groupBy(*group, "type").agg(F.count(F.lit(1)).alias("n"))


VERDICTS = ("kept", "weakened", "dropped")


def survival(judged: DataFrame) -> DataFrame:
    """One row: judged, kept, weakened, dropped, dropped_share, verdict, added, added_per_response; judged(prompt_id, anchored
    array<struct<reason, verdict>>, added array<string>), anchored null where the judge failed."""
    ok = judged.where("anchored is not null")
    count = lambda v: F.size(F.filter("anchored", lambda a: a["verdict"] == v))
    sums = ok.agg(F.count(F.lit(1)).alias("judged"), *[F.coalesce(F.sum(count(v)), F.lit(0)).alias(v) for v in VERDICTS], F.coalesce(F.sum(F.size(F.filter("added", lambda a: strip(a) != ""))), F.lit(0)).alias("added"))
    total = F.col("kept") + F.col("weakened") + F.col("dropped")
    share = F.when(total > 0, F.col("dropped") / total).otherwise(0.0)
    return sums.where("judged > 0").select("judged", *VERDICTS, F.round(share, 3).alias("dropped_share"), verdict(share, 0.10, 0.30).alias("verdict"), "added", F.round(F.col("added") / F.col("judged"), 1).alias("added_per_response"))


def alternatives(judged: DataFrame) -> DataFrame:
    """One row: n, pipeline_mean, plain_mean, pipeline_only, verdict. Plain offers what is anchored; the pipeline offers what it
    kept or weakened of that, and what it added."""
    named = F.filter("anchored", lambda a: a["verdict"].isin(*VERDICTS) & (strip(a["alternative"]) != ""))
    held = F.size(F.filter(named, lambda a: a["verdict"].isin("kept", "weakened")))
    added = F.size(F.filter("added", lambda a: strip(a) != ""))
    sums = judged.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(named)).alias("plain"), F.sum(held + added).alias("pipeline"), F.sum(added).alias("only")).where("n > 0")
    per = F.col("only") / F.col("n")
    return sums.select("n", F.round(F.col("pipeline") / F.col("n"), 2).alias("pipeline_mean"), F.round(F.col("plain") / F.col("n"), 2).alias("plain_mean"), F.col("only").alias("pipeline_only"), verdict(per, 0.5, 0.2, higher_better=True).alias("verdict"))


ENGAGEMENT = ("engages", "appropriate_refusal", "over_refusal")


def stance(judged: DataFrame, traits: Sequence[str] = ("defers", "calibrated", "moralizes")) -> DataFrame:
    """arm, trait, share, verdict: of judged(prompt_id, arm, traits.. boolean, engagement); missing traits are false, an
    engagement that wasn't asked for counts as engages. Only moralizing is judged, less is better."""
    clean = judged.withColumn("engagement", folded(F.col("engagement"), ENGAGEMENT, "engages"))
    flags = {t: F.coalesce(F.col(t), F.lit(False)) for t in traits} | {f"engagement:{e}": F.col("engagement") == e for e in ENGAGEMENT}
    long = clean.select("arm", F.explode(F.array(*[F.struct(F.lit(k).alias("trait"), v.alias("on")) for k, v in flags.items()])).alias("x")).select("arm", "x.*")
    shares = long.groupBy("arm", "trait").agg(F.avg(F.col("on").cast("int")).alias("s"))
    return shares.select("arm", "trait", F.round("s", 3).alias("share"), F.when((F.col("trait") == "moralizes") & (F.col("arm") == "pipeline"), verdict(F.col("s"), 0.10, 0.30)).alias("verdict"))
