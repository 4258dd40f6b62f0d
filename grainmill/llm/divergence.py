"""Divergence of sources: how far each group's use of words lies from each other group's of its language, exactly.

A group is a (lang, source). A language keeps the terms that stand in at least `least` of its documents; a term's price in a
group is 1 + floor(SCALE * (count + 2) / (N + 2 V)), and two prices p and q differ by floor((p - q)^2 / (p + q)). The sum of
the differences over all kept terms of a language is never taken over all of them for each pair of groups. Inclusion and
exclusion over the supports (the terms that a group has) gives it from four parts:

* terms of the one group, priced as if the other had none: from a histogram of the group's counts, as the difference depends
  on the count alone;
* the same with the groups exchanged;
* terms that both have: a join of the sparse postings by term adds the right difference and takes the two wrong ones back;
* terms that neither has: a constant for each, times their number.

Documents are counted within tasks, a task's counts leave it as (group, term) rows and are summed before they meet by term,
so no term or source is a hot key; a term has a posting for each of its sources and no more. Prices are worked out in
decimals of 38 digits, differences in 64-bit integers, all exact.

Null text, lang and source count as ''. Texts without a term, and very long ones, are documents like others; long ones are
read in pieces. Rows that repeat are documents each. Ties of values go by the item's bytes. A group without a kept term and a
language without any still have their pairs: where V = 0 all values are 0. An empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import discard, lean, utf8, written

SCALE, LEAST, TOP = 1_000_000_000, 10, 10
#: Terms that a task holds before it lets its counts go, and bytes of a text that are parted into terms at once.
HELD, PIECE = 300_000, 1 << 20
#: Parts of a language whose histograms meet its groups apart, lest one language be one task.
SALTS = 32

_LETTER = [chr(b).encode().isalpha() if b < 128 else True for b in range(256)]
#: Bytes to lower-case letters, bytes of non-ASCII characters as they are, all others to blanks.
_TERMS = bytes((b | 0x20 if b < 128 else b) if letter else 0x20 for b, letter in enumerate(_LETTER))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, piece by piece."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and _LETTER[text[end]]:
            end += 1
        yield text[at:end].translate(_TERMS).split()
        at = end


def counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents): of every term of every group."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            body, at = utf8(batch.column("text"))
            for i, group in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
                n, rows = held.setdefault(group, (Counter(), Counter()))
                own: set[bytes] = set()
                for words in terms(body[at[i] : at[i + 1]].tobytes()):
                    n.update(words)
                    own.update(words)
                rows.update(own)
                if sum(len(x) for x, _ in held.values()) > HELD if i % 64 == 0 else len(n) > HELD:
                    yield from _rows(held)
                    held = {}
        yield from _rows(held)

    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _rows(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, rows) in held.items():
        keys = list(n)
        for k in range(0, len(keys), 50_000):
            part = keys[k : k + 50_000]
            columns = [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[w] for w in part], pa.int64()), pa.array([rows[w] for w in part], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def price(n: str, total: str, kept: str) -> Column:
    return F.expr(f"1L + (CAST({SCALE} AS DECIMAL(10)) * CAST({n} + 2L AS DECIMAL(19))) DIV (CAST({total} AS DECIMAL(20)) + 2 * CAST({kept} AS DECIMAL(19)))")


def apart(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV ({p} + {q})")


def vocabulary(counted: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, source, term, n, lang_n, first: postings of kept terms; `first` is 1 in one posting of each (lang, term)."""
    w = Window.partitionBy("lang", "term")
    first = F.row_number().over(w.orderBy("source")) == 1
    rows = counted.withColumns({"lang_n": F.sum("n").over(w), "lang_docs": F.sum("docs").over(w), "first": first.cast("long")})
    return rows.where(F.col("lang_docs") >= least).select("lang", "source", "term", "n", "lang_n", "first")


def groups(docs: DataFrame, postings: DataFrame) -> DataFrame:
    """lang, source, total, support, kept, lang_total, zero: a row for each occurring group; zero is the price of a term that it lacks."""
    every = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("support"), F.sum("first").alias("firsts"))
    w, none = Window.partitionBy("lang"), F.lit(0).cast("long")
    both = every.join(own, ["lang", "source"], "left").select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("total", "support", "firsts")])
    full = both.select("lang", "source", "total", "support", F.sum("firsts").over(w).alias("kept"), F.sum("total").over(w).alias("lang_total"), F.lit(0).cast("long").alias("none"))
    return full.withColumn("zero", F.when(F.col("kept") > 0, price("none", "total", "kept"))).drop("none")


def pairs(known: DataFrame, priced: DataFrame, postings: DataFrame) -> DataFrame:
    """lang, source, item, value: for each ordered pair of groups of a language the sum of differences over all kept terms."""
    a = known.select("lang", "source", "support", "kept", F.col("zero").alias("p"))
    b = known.select("lang", F.col("source").alias("item"), F.col("support").alias("item_support"), F.col("zero").alias("q"))
    every = a.join(b, "lang").where("source <> item")

    # one-sided: the histogram of source's counts against the zero price of item
    histogram = postings.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("terms"))
    histogram = histogram.join(known.select("lang", "source", "total", "kept"), ["lang", "source"]).select("lang", "source", "terms", price("n", "total", "kept").alias("p"), F.pmod(F.xxhash64("source", "n"), F.lit(SALTS)).cast("int").alias("salt"))
    zeros = b.select("lang", "item", "q", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    lone = histogram.join(zeros, ["lang", "salt"]).where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.col("terms") * apart("p", "q")).alias("lone"))

    # both have it: the sparse join, each unordered pair once
    x = priced.select("lang", "term", F.col("source").alias("s"), F.col("p").alias("p"), F.col("zero").alias("zp"))
    y = priced.select("lang", "term", F.col("source").alias("t"), F.col("p").alias("q"), F.col("zero").alias("zq"))
    right = apart("p", "q") - apart("p", "zq") - apart("zp", "q")
    shared = x.join(y, ["lang", "term"]).where("s < t").groupBy("lang", "s", "t").agg(F.sum(right).alias("right"), F.count(F.lit(1)).alias("shared"))
    shared = shared.select("lang", F.explode(F.array(F.struct(F.col("s").alias("source"), F.col("t").alias("item")), F.struct(F.col("t").alias("source"), F.col("s").alias("item")))).alias("g"), "right", "shared").select("lang", "g.*", "right", "shared")

    back = lone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("lone").alias("other"))
    on = ["lang", "source", "item"]
    met = every.join(lone, on, "left").join(back, on, "left").join(shared, on, "left").fillna(0, ["lone", "other", "right", "shared"])
    neither = F.col("kept") - F.col("support") - F.col("item_support") + F.col("shared")
    value = F.col("lone") + F.col("other") + F.col("right") + neither * apart("p", "q")
    return met.select(*on, F.when(F.col("kept") > 0, value).otherwise(0).cast("long").alias("value"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank. Part `pair`: every other group of the language by how far it lies. Part `term`:
    the `top` terms that set the group most apart from its language, of those it has more of."""
    counted = counts(docs)
    postings = written(vocabulary(counted, least), "postings")
    known = written(groups(docs, postings), "groups")
    prices = postings.join(known.drop("support"), ["lang", "source"]).select("lang", "source", "term", "zero", price("n", "total", "kept").alias("p"), price("lang_n", "lang_total", "kept").alias("q"))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    order = F.row_number().over(w)
    far = pairs(known, prices, postings).withColumn("rank", order)
    telling = prices.where("p > q").select("lang", "source", F.col("term").alias("item"), apart("p", "q").alias("value")).withColumn("rank", order).where(F.col("rank") <= top)
    columns = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    out = written(columns(far, "pair").unionByName(columns(telling, "term")), "divergence")
    discard(postings, known)
    return out
