"""Sharding by sampled splitters, law `bytes`: shards of nearly equal size.

Records are ordered by (hash of the text, doc_id), so that equal texts stand together. A sample drawn with odds in
proportion to size gives quantile boundaries for many more ranges than shards; ranges that turn out overfull are
subdivided by a denser sample of their own until they are small or hold a single record. Whole ranges then go to
shards, the largest first, each to the emptiest; a record's slot counts from its range's first slot in its shard.
Equal texts share a shard unless together they exceed an even one; then they are parted by doc_id, and rows equal in
text and doc_id by a hash of their place in the input. Each round cuts every overfull range, until none is left.

Null texts have no bytes (size 16, crc32 0). Rows that repeat a doc_id are records of their own. Very long texts count by
their size alone: a record is never cut, so a shard may exceed the others by one record. Ties of size go to the smaller
range and shard. An empty table gives an empty result. Extra columns play no part and are not returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import written

OVERHEAD = 16
#: Ranges per shard, sampled records per range; both bound what reaches the driver.
RANGES, DRAWS = 32, 24


def records(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    # d orders rows of equal text: the doc_id, and for repeated rows their place
    return docs.select("doc_id", (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("k"), F.monotonically_increasing_id().alias("at"))


def _sampled(keyed: DataFrame, wanted: int, total: int, seed: int) -> list[tuple[int, int, float]]:
    """(k, d, weight): each record with odds of wanted * size / total, at most 1; about `wanted` rows."""
    odds = F.least(F.lit(1.0), F.col("size") * F.lit(wanted / max(total, 1)))
    drawn = keyed.where((F.pmod(F.xxhash64("k", "d", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))) < odds)
    return [(r.k, r.d, r.size / r.odds) for r in drawn.select("k", "d", "size", odds.alias("odds")).collect()]


def _quantiles(sample: list[tuple[int, int, float]], n: int) -> list[tuple[int, int]]:
    """At most n - 1 boundaries; a boundary is the last key of its range. Between two texts' keys a text isn't cut."""
    if n < 2 or not sample:
        return []
    sample.sort()
    at = np.cumsum([w for *_, w in sample])
    cuts = {int(np.searchsorted(at, at[-1] * q / n)) for q in range(1, n)}
    return sorted({sample[i][:2] for i in cuts})


def _assign(keyed: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    sent = keyed.sparkSession.sparkContext.broadcast((np.array([b[0] for b in bounds], np.int64), np.array([b[1] for b in bounds], np.int64)))

    @F.pandas_udf("int")
    def range_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hi, lo = sent.value
        for k, d in batches:
            k, d = k.to_numpy(np.int64), d.to_numpy(np.int64)
            at, end = np.searchsorted(hi, k, "left"), np.searchsorted(hi, k, "right")
            for i in np.flatnonzero(at < end):  # only keys that are boundaries themselves compare d
                at[i] += np.searchsorted(lo[at[i] : end[i]], d[i], "left")
            yield pd.Series(at.astype(np.int32))

    return keyed.withColumn("range", range_of("k", "d"))


def shard(docs: DataFrame, shards: int = 40, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot."""
    keyed = records(docs)
    keyed = written(keyed.withColumn("d", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))), "shard-keys")
    again = keyed.groupBy("k", "d").count().where("count > 1").select("k", "d")
    if not again.isEmpty():  # rows equal in text and doc_id are told apart by their place
        again = again.withColumn("again", F.lit(True))
        keyed = written(keyed.join(again, ["k", "d"], "left").withColumn("d", F.when(F.col("again"), F.xxhash64("d", "at")).otherwise(F.col("d"))).drop("again"), "shard-keys")
    total = keyed.agg(F.sum("size")).first()[0] or 0
    limit = max(1, total // (shards * RANGES))
    alone = max(2 * limit, total // shards)  # equal texts stay together up to an even shard
    top = 2**63 - 1
    # a boundary in the middle of equal texts is moved to their end; only overfull ranges cut texts' groups by doc_id
    bounds = {(k, top) for k, _ in _quantiles(_sampled(keyed, shards * RANGES * DRAWS, total, seed), shards * RANGES)}
    rounds = 0
    while True:
        dealt = _assign(keyed, sorted(bounds))
        sums = F.sum("size").alias("size"), F.max("size").alias("largest"), F.count(F.lit(1)).alias("n"), F.min("k").alias("first"), F.max("k").alias("last"), F.min("d").alias("low"), F.max("d").alias("high")
        held = {r.range: r for r in dealt.groupBy("range").agg(*sums).collect()}
        # records that are large themselves can't be parted further
        full = [r for r in held.values() if r.n > 1 and r["size"] > (alone if r.first == r.last else 2 * limit) and r["size"] > 1.5 * r.largest and (r.first, r.low) != (r.last, r.high)]
        if not full:
            break
        rounds += 1
        inside = _sampled(dealt.where(F.col("range").isin([r.range for r in full])), sum(-(-r["size"] // limit) for r in full) * DRAWS, sum(r["size"] for r in full), seed + rounds)
        before, edges = len(bounds), sorted(bounds)
        his, los = np.array([e[0] for e in edges], np.int64), np.array([e[1] for e in edges], np.int64)
        groups: dict[int, list] = {}
        for x in inside:
            i = int(np.searchsorted(his, x[0], "left"))
            while i < len(his) and his[i] == x[0] and los[i] < x[1]:
                i += 1
            groups.setdefault(i, []).append(x)
        for r in full:
            mine = groups.get(r.range, [])
            cuts = _quantiles(mine, -(-r["size"] // limit))
            if r.first == r.last:
                bounds |= (set(cuts) - bounds) or {(r.first, r.low)}  # without a cut in the sample, the first record goes alone
                continue
            fresh = {(k, top) for k, _ in cuts if k < r.last}
            many = [k for k, _, _ in mine]  # a text's group that overfills a range gets a range alone
            for k, c in zip(*np.unique(many, return_counts=True)) if many else ():
                if c > len(many) / 2:
                    fresh |= {(int(k), top), *([(int(k) - 1, top)] if k > -(2**63) else [])}
            bounds |= (fresh - bounds) or {(r.first, top)}
        if len(bounds) == before:  # can't be, as a range that can be parted gets a boundary inside
            raise RuntimeError(f"{len(full)} ranges stay overfull after {rounds} rounds; the largest holds {max(r['size'] for r in full)} bytes of {total}")
    heap = [(0, s, 0) for s in range(shards)]
    placed = []
    for r in sorted(held.values(), key=lambda r: (-r["size"], r.range)):
        size, s, slots = heapq.heappop(heap)
        placed.append((r.range, s, slots))
        heapq.heappush(heap, (size + r["size"], s, slots + r.n))
    table = keyed.sparkSession.createDataFrame(placed, "range int, shard int, first long")  # a row for each range
    inside = F.row_number().over(Window.partitionBy("range").orderBy("k", "d")) - F.lit(1)
    return dealt.withColumn("inside", inside).join(F.broadcast(table), "range").select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("inside")).cast("long").alias("slot"))
