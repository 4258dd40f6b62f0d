"""Lineage: keyed lookups, first and last rows, pending work, matches of two runs, content ids, costs, preferences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import key as squeezed
from ..sources.store import written


def last_by(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key; no window: one aggregate with map-side combine."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(*keys, "__r.*")


def first_by(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__r")).select(*keys, "__r.*")


def pending(items: DataFrame, done: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Items that are in none of the done tables."""
    for d in done:
        items = items.join(d.select(*keys).distinct(), list(keys), "left_anti")
    return items


def matched(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, status: matched, only_a or only_b."""
    left, right = a.select(*keys).distinct().withColumn("__a", F.lit(1)), b.select(*keys).distinct().withColumn("__b", F.lit(1))
    status = F.when(F.col("__a").isNull(), "only_b").when(F.col("__b").isNull(), "only_a").otherwise("matched")
    return left.join(right, list(keys), "full_outer").select(*keys, status.alias("status"))


def matched_in_two_tiers(a: DataFrame, b: DataFrame, name: str, position: str) -> DataFrame:
    """name_a, name_b: by equal name, then what is left by equal position."""
    exact = a.select(F.col(name).alias("name_a")).join(b.select(F.col(name).alias("name_b")), F.col("name_a") == F.col("name_b"))
    left = a.join(b.select(name), name, "left_anti").select(F.col(name).alias("name_a"), position)
    right = b.join(a.select(name), name, "left_anti").select(F.col(name).alias("name_b"), position)
    return exact.unionByName(left.join(right, position).select("name_a", "name_b"))


def placed(rows: DataFrame, order: Sequence[str], group: str | None = None) -> DataFrame:
    """rows with place, from 0 in the order (of each group). Rows are sorted by range and numbered within; what stands ahead of a
    range is summed from a row for each, so no task sees all rows of a group."""
    keys = [group] if group else []
    at = written(rows.orderBy(*keys, *order).withColumn("__at", F.monotonically_increasing_id()), "ordered").withColumn("__part", F.shiftright("__at", 33))
    sizes = at.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__low"))
    before = F.coalesce(F.sum("__n").over((Window.partitionBy(group) if group else Window.partitionBy(F.lit(1))).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(*[F.col(k).alias("__g") for k in keys], F.col("__part").alias("__p"), (F.col("__low") - before).alias("__from"))
    same = F.col("__part") == F.col("__p")
    same = same & F.col(group).eqNullSafe(F.col("__g")) if group else same
    return at.join(starts, same).withColumn("place", F.col("__at") - F.col("__from")).select(*rows.columns, "place")


def fingerprint(text: Column) -> Column:
    """16 hex digits of the sha256 of the text as JSON, white space squeezed."""
    return F.substring(F.sha2(F.concat(F.lit('"'), squeezed(text), F.lit('"')), 256), 1, 16)


def assigned(registry: DataFrame, found: DataFrame) -> DataFrame:
    """registry(kind, fingerprint, num) with numbers for new fingerprints of found(kind, fingerprint, pos): the greatest of
    the kind and one more, in the order they were first seen."""
    fresh = found.join(registry, ["kind", "fingerprint"], "left_anti").groupBy("kind", "fingerprint").agg(F.min("pos").alias("pos"))
    top = registry.groupBy("kind").agg(F.max("num").alias("top"))
    new = placed(fresh, ["pos", "fingerprint"], "kind").join(F.broadcast(top), "kind", "left").select("kind", "fingerprint", (F.coalesce("top", F.lit(0)) + F.col("place") + 1).cast("long").alias("num"))
    return registry.select("kind", "fingerprint", "num").unionByName(new)


def record_id(*parts: Column) -> Column:
    """A record's id from its content, in the form of a uuid: the same record has the same id in every run."""
    h = F.md5(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def formatted_id(prefix: str, number: Column) -> Column:
    return F.format_string(prefix + "-%04d", number)


def by_stage(costs: DataFrame) -> DataFrame:
    """stage, calls, cost, models; rows without a stage are "untagged"."""
    return costs.groupBy(F.coalesce("stage", F.lit("untagged")).alias("stage")).agg(F.count(F.lit(1)).alias("calls"), F.sum("cost_usd").alias("cost"), F.array_join(F.array_sort(F.collect_set("model")), ",").alias("models"))


def priced(calls: DataFrame, prices: DataFrame, default: tuple[float, float]) -> DataFrame:
    """calls with cost_usd, 6 digits: input, cache writes at 1.25 and cache reads at 0.1 of the input price, output; prices
    are for a million tokens, unknown models take the default and are marked."""
    p = calls.join(F.broadcast(prices), "model", "left")
    i, o = F.coalesce("price_in", F.lit(default[0])), F.coalesce("price_out", F.lit(default[1]))
    tokens = F.col("input_tokens") + 1.25 * F.coalesce("cache_creation_tokens", F.lit(0)) + 0.1 * F.coalesce("cache_read_tokens", F.lit(0))
    return p.select(*calls.columns, F.round((tokens * i + F.col("output_tokens") * o) / 1e6, 6).alias("cost_usd"), F.col("price_in").isNull().alias("unknown_model"))


def preferences(pairs: DataFrame, ratings: DataFrame) -> DataFrame:
    """pair_id, rater, chosen, rejected, chosen_arm for decisive ratings; every rater's counts on its own."""
    other = F.when(F.col("left_arm") == "a", "b").otherwise("a")
    arm = F.when(F.col("choice") == "left", F.col("left_arm")).when(F.col("choice") == "right", other)
    both = ratings.join(pairs, "pair_id").withColumn("chosen_arm", arm).where("chosen_arm is not null")
    pick = lambda x, y: F.when(F.col("chosen_arm") == "a", F.col(x)).otherwise(F.col(y))
    return both.select("pair_id", "rater", pick("response_a", "response_b").alias("chosen"), pick("response_b", "response_a").alias("rejected"), "chosen_arm")


def win_counts(ratings: DataFrame, pairs: DataFrame) -> DataFrame:
    other = F.when(F.col("left_arm") == "a", "b").otherwise("a")
    outcome = F.when(F.col("choice") == "left", F.col("left_arm")).when(F.col("choice") == "right", other).otherwise(F.col("choice"))
    return ratings.join(pairs.select("pair_id", "left_arm"), "pair_id").groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def verdict_summary(rows: DataFrame) -> DataFrame:
    """section, worst verdict, rows with one."""
    rank = F.when(F.col("verdict") == "BAD", 2).when(F.col("verdict") == "OK", 1).when(F.col("verdict") == "GOOD", 0)
    worst = F.max(rank)
    return rows.groupBy("section").agg(F.when(worst == 2, "BAD").when(worst == 1, "OK").when(worst == 0, "GOOD").alias("worst"), F.count("verdict").alias("judged"), (F.count("verdict") == 0).alias("skipped"))


def numbered(rows: DataFrame, column: str, prefix: str, order: str) -> DataFrame:
    """rows whose missing ids are prefix-0000 .. above the greatest there is, in order."""
    number = F.regexp_extract(F.col(column), rf"^{prefix}-(\d+)$", 1).try_cast("long")
    top = rows.agg(F.coalesce(F.max(number), F.lit(0))).first()[0]
    got = placed(rows.where(F.col(column).isNull()), [order]).withColumn(column, formatted_id(prefix, F.col("place") + F.lit(top + 1)))
    return rows.where(F.col(column).isNotNull()).unionByName(got.select(*rows.columns))


def backfilled(rows: DataFrame, run: str, gid: str, found: str) -> DataFrame:
    """rows with missing ids taken from `found`, from the first run on that has any."""
    first = rows.where(F.col(gid).isNotNull()).agg(F.min(run).alias("__first"))
    return rows.crossJoin(F.broadcast(first)).withColumn(gid, F.when(F.col(run) >= F.col("__first"), F.coalesce(gid, found)).otherwise(F.col(gid))).drop("__first")  # one row


def legacy_matched(a: DataFrame, b: DataFrame, fixed: str) -> DataFrame:
    """label, kind, in_a, in_b of records(scenario, principle, injection) of two runs: scenarios of the fixed set by scenario
    and injection, all others by principle and injection."""

    def tiers(rows: DataFrame, n: str) -> tuple[DataFrame, DataFrame]:
        own = F.startswith("scenario", F.lit(fixed))
        return tuple(rows.where(c).groupBy(k, "injection").agg(F.count(F.lit(1)).alias(n)) for c, k in ((own, "scenario"), (~own, "principle")))

    (exact_a, group_a), (exact_b, group_b) = tiers(a, "in_a"), tiers(b, "in_b")
    tail = F.concat(F.lit(" ["), "injection", F.lit("]"))
    exact = exact_a.join(exact_b, ["scenario", "injection"]).select(F.concat("scenario", tail).alias("label"), F.lit("exact").alias("kind"), "in_a", "in_b")
    group = group_a.join(group_b, ["principle", "injection"]).select(F.concat(F.lit("principle "), "principle", tail).alias("label"), F.lit("group").alias("kind"), "in_a", "in_b")
    return exact.unionByName(group)


# ---- costs and scores


def cost_items(costs: DataFrame) -> DataFrame:
    """costs with item and batch_size: a row for each of a call's comma-joined items; a call without any has none."""
    ids = F.split("item_id", ",")
    return costs.withColumn("batch_size", F.size(ids).cast("long")).withColumn("item", F.explode(ids))


def call_stats(costs: DataFrame, group: Sequence[str]) -> DataFrame:
    """group, calls, models, cost_usd, duration_s, retries: times and retries only where every call recorded them."""
    every = lambda c, x: F.when(F.bool_and(F.col(c).isNotNull()), x)
    return costs.groupBy(*group).agg(
        F.count(F.lit(1)).alias("calls"), F.array_join(F.array_sort(F.collect_set("model")), ",").alias("models"), F.round(F.sum("cost_usd"), 4).alias("cost_usd"),
        every("duration_s", F.round(F.sum("duration_s"), 1)).alias("duration_s"), every("attempts", F.sum(F.col("attempts") - 1)).alias("retries"),
    )


def item_stats(costs: DataFrame, stage: str, item: str) -> DataFrame:
    """One row of call_stats with per_item and batch_size for one item of a stage. Where no call of the stage names items, the
    stage's as a whole; where calls do, but none this one, no row."""
    rows = costs.where(F.col("stage") == stage)
    own = cost_items(rows).where(F.col("item") == item)
    if not own.isEmpty():
        batch = own.agg(F.max("batch_size").alias("batch_size"))
        return call_stats(own, []).withColumn("per_item", F.lit(True)).crossJoin(batch)  # one row each
    old = rows if rows.where("item_id is not null").isEmpty() else rows.limit(0)
    return call_stats(old, []).where("calls > 0").withColumns({"per_item": F.lit(False), "batch_size": F.lit(None).cast("long")})


def kept_rate(rows: DataFrame, kept: Column, group: Sequence[str]) -> DataFrame:
    """group, pass_rate: the share kept of the rows that were judged; null where none was."""
    return rows.groupBy(*group).agg(F.avg(kept.cast("int")).alias("pass_rate"))


def total_cost(costs: DataFrame) -> DataFrame:
    return costs.agg(F.coalesce(F.round(F.sum("cost_usd"), 4), F.lit(0.0)).alias("total"))


def gated(scores: DataFrame, least: dict[str, float]) -> DataFrame:
    """Rows whose scores reach their bounds; advisory scores have none."""
    for name, bound in least.items():
        scores = scores.where(F.col(name) >= bound)
    return scores


def score_summary(scores: DataFrame, group: Sequence[str], names: Sequence[str], least: dict[str, float] | None = None, mean: float | None = None, critical: float | None = None) -> DataFrame:
    """group, the mean of each score, and passed: the share of rows that reach all bounds, or whose mean and least score reach
    mean and critical."""
    ok = F.lit(True)
    for name, bound in (least or {}).items():
        ok &= F.col(name) >= bound
    if mean is not None:
        total = sum((F.col(n) for n in names), F.lit(0))
        ok &= (total / len(names) >= mean) & (F.least(*names) >= critical if len(names) > 1 else F.col(names[0]) >= critical)
    return scores.groupBy(*group).agg(*[F.avg(n).alias(n) for n in names], F.avg(ok.cast("int")).alias("passed"))
