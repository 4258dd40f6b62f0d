"""Mixing sources to target weights by Pareto order sampling.

Targets: every source is owed its weight's share of all words, at most `cap` times its own; the excess is shared again
by weight until none is above.

Documents count unequally: one of weight w is wanted c = min(cap, level * w) times, where its source's level makes the
words wanted, the sum of c * size, its target. The weight is the size to the power LEAN, or a column; weights stand in
steps of an eighth of an octave, so that a level is found from a few sums. floor(c) copies are certain. The fraction
p = c - floor(c) is the inclusion probability of one more, which a fixed-size unequal-probability sample decides: documents
are ranked by their random odds u / (1 - u) over their inclusion odds p / (1 - p), and the front of that order is taken.

The size that is fixed is words. Each source's documents are parted by the octave of their size; of an octave the front is
taken up to the words wanted there, the document at the cut if that comes nearer. What is then too few or too many words,
half a document, is made up in the octave below, so at the end half of a short document is wrong, if the lower octaves hold
enough documents to make up for it.

u is a hash of the seed, doc_id and text, so reruns agree, and ties of the ranks go by doc_id and text. Null and empty texts
have size 0 and are only taken whole. Null sources form one source, the last. Repeated rows are documents of their own.
Sources of size 0 have target 0. Very long texts are only counted. An empty table gives an empty result. Extra columns are
kept, those of the operator's own names replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import few, lean, small, written

WORD = r"[^\x20\x09-\x0D]+"
#: The power of the size that is a document's weight.
LEAN = 0.25
#: Bins of the Pareto order in a source's octave: about BIN documents each, so that one bin's rows fit a task.
BIN = 2000


def sizes(docs: DataFrame) -> DataFrame:
    """Native count of words; null: 0."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def targets(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """source, source_size, target: a row for each source.

    Sources are ordered by code point, null last. One task sees a row for each source, as a global order must; the
    rows of documents are summed before. The cap is solved by levels: T = min(cap * size, level * weight).
    """
    w = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    # Spark orders strings by their UTF-8 bytes, which is the order of code points
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(w) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = per.withColumn("w", place).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    # in order of most / w, sources fill up first; the level is set by those behind the last full one
    by = Window.orderBy((F.col("most") / F.col("w")), "source")
    all_rows = Window.partitionBy(F.lit(1))
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(after)
    filled = ranked.withColumn("level", level).withColumn("open", F.col("level") * F.col("w") <= F.col("most"))
    first = F.max(F.when(F.col("open"), F.col("level"))).over(all_rows)  # behind the first open one it only sinks
    target = F.when(F.col("source_size") == 0, 0.0).otherwise(F.coalesce(F.least(F.col("most"), first * F.col("w")), F.col("most")))
    return filled.withColumn("target", target).select("source", "source_size", "target")


def copies(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, seed: int = 11, weight: str | None = None) -> DataFrame:
    """doc_id, h (hash of the text), source, u, size, wanted (c, the copies expected), source_size, target, copies and taken
    (= copies * size) of every row."""
    unit = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 40)).cast("double") + 0.5) / F.lit(float(1 << 40))
    sized = sizes(docs)
    like = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(1e-9)) if weight else F.pow(F.greatest("size", F.lit(1)), F.lit(LEAN))
    octave = F.when(F.col("size") > 0, F.floor(F.log2(F.col("size") + F.lit(0.5)))).otherwise(-1).cast("int")
    rows = sized.select("doc_id", "source", "size", unit.alias("u"), F.round(8 * F.log2(like)).cast("int").alias("step"), octave.alias("octave"), F.xxhash64("text").alias("h"))
    rows = written(rows, "mix-rows")
    # a row for each source, step and octave: a few hundred a source
    sums = written(few(rows.groupBy("source", "step", "octave").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))), "mix-sums")
    per = written(few(targets(sums.withColumnRenamed("words", "size"), weights, cap)), "mix-sources")
    named = lambda df: df.withColumnRenamed("source", "s")
    steps = sums.groupBy("source", "step").agg(F.sum("words").alias("words")).withColumn("w", F.pow(F.lit(2.0), F.col("step") / 8))
    steps = steps.join(named(per), steps.source.eqNullSafe(F.col("s"))).drop("s")
    # heavier steps reach the cap first; the level is set by those behind the last that does
    order = Window.partitionBy("source").orderBy(F.desc("step"))
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    rest = F.col("target") - F.lit(float(cap)) * F.coalesce(F.sum("words").over(before), F.lit(0))
    steps = steps.withColumn("level", F.try_divide(rest, F.sum(F.col("w") * F.col("words")).over(after)))
    open_ = F.when(F.col("level") * F.col("w") <= cap, F.col("level"))
    steps = steps.withColumn("level", F.max(open_).over(Window.partitionBy("source")))
    wanted = F.when(F.col("source_size") == 0, 0.0).otherwise(F.least(F.lit(float(cap)), F.greatest(F.lit(0.0), F.coalesce(F.col("level") * F.col("w"), F.lit(float(cap))))))
    steps = steps.withColumn("wanted", wanted).withColumn("whole", F.floor(F.col("wanted") + 1e-9)).withColumn("p", F.greatest(F.lit(0.0), F.col("wanted") - F.col("whole")))
    steps = steps.withColumn("p", F.when(F.col("p") < 1e-9, 0.0).otherwise(F.least("p", F.lit(1 - 1e-9))))
    steps = written(few(steps).select("source", "step", "source_size", "target", "wanted", "whole", "p"), "mix-steps")
    # of an octave: the words wanted of the sample, and the documents that it is drawn from
    drawn = sums.join(named(steps).withColumnRenamed("step", "t"), sums.source.eqNullSafe(F.col("s")) & (F.col("step") == F.col("t"))).where("p > 0 and octave >= 0")
    octaves = drawn.groupBy("source", "octave").agg(F.sum(F.col("p") * F.col("words")).alias("owed"), F.sum("words").alias("all"), F.sum("n").alias("n"))
    top = F.pow(F.lit(2.0), F.max("octave").over(Window.partitionBy("source")) + 1)  # no carry is as large
    octaves = written(few(octaves).select("source", "octave", "owed", (F.col("owed") / F.col("all")).alias("even"), F.greatest(F.lit(64), F.col("n") / BIN).cast("long").alias("bins"), top.alias("reach")), "mix-octaves")
    side = small(named(steps).withColumnRenamed("step", "t"), 200_000)
    rows = rows.join(side, rows.source.eqNullSafe(F.col("s")) & (F.col("step") == F.col("t"))).drop("s", "t")
    out = ["doc_id", "h", "source", "u", "size", "wanted", "source_size", "target", "whole"]
    certain = rows.where("p = 0 or octave < 0").select(*out, F.lit(0).cast("long").alias("more"))
    side = small(named(octaves).withColumnRenamed("octave", "o"), 200_000)
    ranked = rows.where("p > 0 and octave >= 0").join(side, F.col("source").eqNullSafe(F.col("s")) & (F.col("octave") == F.col("o"))).drop("s", "o")
    ranked = ranked.withColumn("q", (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p"))))
    # ranks of mean odds fall evenly into bins, however near to 0 or 1 the wanted part is
    even = F.col("q") * F.col("even") / (1 - F.col("even"))
    ranked = ranked.withColumn("bin", F.floor(even / (1 + even) * F.col("bins")))
    summed = ranked.groupBy("source", "octave", "bin").agg(F.sum("size").alias("words"), F.first("owed").alias("owed"), F.first("reach").alias("reach"))
    running = summed.withColumn("upto", F.sum("words").over(Window.partitionBy("source", "octave").orderBy("bin"))).withColumn("ahead", F.col("upto") - F.col("words"))
    role = F.when(F.col("upto") <= F.col("owed") - F.col("reach"), "in").when(F.col("ahead") <= F.col("owed") + F.col("reach"), "cut")
    bins = written(running.select(F.col("source").alias("s"), F.col("octave").alias("o"), F.col("bin").alias("b"), "ahead", role.alias("role")).where("role is not null"), "mix-bins")
    seen = ranked.join(bins, ranked.source.eqNullSafe(bins.s) & (F.col("octave") == F.col("o")) & (F.col("bin") == F.col("b")), "left").drop("s", "o", "b")
    sure = seen.where("role is null or role = 'in'").select(*out, F.when(F.col("role") == "in", 1).otherwise(0).cast("long").alias("more"))
    kinds = {c: seen.schema[c].dataType.simpleString() for c in out}
    cut = seen.where("role = 'cut'").select(*out, "octave", "q", "owed", "ahead").groupBy("source").applyInPandas(lean(_cut), ", ".join(f"{c} {t}" for c, t in kinds.items()) + ", more long")
    got = certain.unionByName(sure).unionByName(cut).withColumn("copies", F.col("whole") + F.col("more"))
    return got.withColumn("taken", F.col("copies") * F.col("size")).drop("whole", "more")


def _cut(rows: pd.DataFrame) -> pd.DataFrame:
    """One source's rows about the cuts of its octaves, the longest first; a few bins of each."""
    rows = rows.sort_values(["octave", "q", "doc_id", "h"], ascending=[False, True, True, True], ignore_index=True)
    more, carry = pd.Series(0, index=rows.index, dtype="int64"), 0.0
    for _, own in rows.groupby("octave", sort=False):
        owed, got = float(own.owed.iloc[0]) + carry, float(own.ahead.min())
        for i, size in own["size"].items():
            if 2 * (owed - got) <= size:  # not taken is as near
                break
            more[i] = 1
            got += size
        carry = owed - got
    return rows.drop(columns=["octave", "q", "owed", "ahead"]).assign(more=more)


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, seed: int = 11, weight: str | None = None) -> DataFrame:
    """docs with size, source_size, target, copies and taken (= copies * size)."""
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    out = copies(docs, weights, cap, seed, weight)
    left = docs.select(*own, F.xxhash64("text").alias("__h"))
    right = out.select(F.col("doc_id").alias("__d"), F.col("h").alias("__g"), "size", "source_size", "target", "copies", "taken", F.col("source").alias("__s"))
    same = (F.col("doc_id").eqNullSafe(F.col("__d"))) & (F.col("__h") == F.col("__g")) & F.col("source").eqNullSafe(F.col("__s"))
    if out.groupBy("doc_id", "h", "source").count().where("count > 1").limit(1).count():  # rows equal in all that are numbered alike
        left = left.withColumn("__n", F.row_number().over(Window.partitionBy("doc_id", "__h", "source").orderBy(F.lit(1))))
        right = right.withColumn("__m", F.row_number().over(Window.partitionBy("__d", "__g", "__s").orderBy("copies")))
        same &= F.col("__n") == F.col("__m")
    return left.join(right, same).select(*own, "size", "source_size", "target", "copies", "taken")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with the columns of docs."""
    out = mix(docs, **options)
    return out.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)
