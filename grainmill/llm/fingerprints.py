"""Document fingerprints: invertible Bloom lookup sketches of paragraphs. DataFrame functions only.

A text's paragraphs are its lines, cut after every WORDS words; their 64-bit digests form a set. A digest is added to
three cells of a table, one in each third: a cell counts, and xors digests and their checks. The fingerprint is the table
of CELLS cells as a string, so equal texts have equal fingerprints. Subtracting two tables leaves the digests in which the
texts differ: a cell with one of them is read and taken out of its other cells, until the table is empty. If it can't be
emptied, larger sketches of both versions are made, subtracted and peeled: RETRIES in turn, of a size that grows with the
texts and with other places for the digests each time. The odds that all of them fail are below 1e-9; such a pair is
compared digest by digest. Likeness is the share of both texts' digests that the other has: 1 for the same set, 0 if all differ; 1 if both are empty.

The edited text has its last floor(n / 2) code points replaced by the first as many, or all, of the next document in
descending order of doc_id; after the last comes the first. Documents of equal doc_id have one place in that order, and
the least of their texts speaks for them. A missing doc_id comes last. Null texts are empty. A lone document is its own
next. An empty table gives an empty result. Extra columns play no part and are not returned.

The order of ids is found from the ids alone. A text moves once, by doc_id, and of its successor only the part that is
wanted and its digests; work on a pair stays within the row and grows with its length, not its square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

WORDS = 16
#: Cells of the published sketch; each third of a table is so wide.
CELLS = 24
#: What a retry's thirds are at least, the share of both texts' digests that they add, and the retries' salts.
RETRIES = ((32, 0.5, 1), (128, 1.0, 2), (512, 4.0, 3))
#: Rounds of peeling; each takes out all digests that stand alone in a cell.
ROUNDS = 40
PARAGRAPHS = rf"(?:\S++[^\S\n]*+){{1,{WORDS}}}+"


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x evaluated once."""
    return F.element_at(F.transform(F.array(x), f), 1)


def digests(text: Column) -> Column:
    """The set of paragraph digests, array<bigint>."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPHS), F.lit(0)), lambda p: F.xxhash64(F.rtrim(p))))


# A table is an array of its cells that aren't zero, in order: p the place, c the count, k the xor of digests, h of checks.


def _cell(p: Column, c: Column, k: Column, h: Column) -> Column:
    return F.struct(p.cast("int").alias("p"), c.cast("int").alias("c"), k.cast("long").alias("k"), h.cast("int").alias("h"))


def _cells_of(k: Column, sign: Column, width: Column, salt: int) -> list[Column]:
    """The three cells of one digest, one in each third of a table."""
    m = F.xxhash64(k, F.lit(salt))
    place = lambda t: F.pmod(F.shiftrightunsigned(m, 20 * t).bitwiseAND(F.lit((1 << 20) - 1)), width) + F.lit(t) * width
    return [_cell(place(t), sign, k, F.hash(k)) for t in range(3)]


def _summed(cells: Column) -> Column:
    """Cells of equal place as one: sorted, and runs added up."""

    def run(u: Column, at: Column, n: Column) -> Column:
        first = F.get(u, at)
        add = lambda x, y: _cell(x["p"], x["c"] + y["c"], x["k"].bitwiseXOR(y["k"]), x["h"].bitwiseXOR(y["h"]))
        return F.when(n == 1, first).otherwise(F.aggregate(F.slice(u, at + 2, n - 1), first, add))

    def runs(u: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(0), F.size(u)), lambda i: (i == 0) | (i == F.size(u)) | (F.get(u, i)["p"] != F.get(u, i - 1)["p"]))
        return let(ends, lambda e: F.transform(F.slice(e, F.lit(1), F.size(e) - 1), lambda at, j: run(u, at, F.get(e, j + 1) - at)))

    return F.filter(let(F.sort_array(cells), runs), lambda x: (x["c"] != 0) | (x["k"] != 0) | (x["h"] != 0))


def sketch(digests_: Column, width: Column | None = None, salt: int = 0) -> Column:
    width = F.lit(CELLS // 3) if width is None else width
    return _summed(F.flatten(F.transform(digests_, lambda k: F.array(*_cells_of(k, F.lit(1), width, salt)))))


def text_of(table: Column) -> Column:
    """The fingerprint as it is shown."""
    return F.array_join(F.transform(table, lambda x: F.concat_ws(":", x["p"].cast("string"), x["c"].cast("string"), F.hex(x["k"]), F.hex(x["h"]))), ";")


def subtract(a: Column, b: Column) -> Column:
    return _summed(F.concat(a, F.transform(b, lambda x: _cell(x["p"], -x["c"], x["k"], x["h"]))))


def peel(table: Column, width: Column | None = None, salt: int = 0) -> Column:
    """The digests left in a table, array<struct<k, s>>, s 1 for the first text's and -1 for the second's; null if it
    can't be emptied."""
    width = F.lit(CELLS // 3) if width is None else width
    lone = lambda x: (F.abs(x["c"]) == 1) & (x["h"] == F.hash(x["k"]))
    pure = lambda t: F.array_distinct(F.transform(F.filter(t, lone), lambda x: F.struct(x["k"].alias("k"), x["c"].alias("s"))))
    none = F.filter(F.array(F.struct(F.lit(0).cast("long").alias("k"), F.lit(0).cast("int").alias("s"))), lambda x: x["s"] != 0)
    state = lambda t, found, over: F.struct(t.alias("t"), found.alias("f"), over.alias("over"))

    def step(at: Column, _: Column) -> Column:
        def with_(p: Column) -> Column:
            out = F.flatten(F.transform(p, lambda e: F.array(*_cells_of(e["k"], -e["s"], width, salt))))
            return F.when(F.size(p) == 0, state(at["t"], at["f"], F.lit(True))).otherwise(state(_summed(F.concat(at["t"], out)), F.concat(at["f"], p), F.lit(False)))

        return F.when(at["over"], at).otherwise(let(pure(at["t"]), with_))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state(table, none, F.lit(False)), step, lambda at: F.when(F.size(at["t"]) == 0, at["f"]))


def _larger(a: Column, b: Column, least: int, share: float, salt: int) -> Column:
    """The difference by larger sketches of both versions."""
    width = F.greatest(F.lit(least), (F.lit(share) * (F.size(a) + F.size(b))).cast("int") + F.lit(least))
    return let(width, lambda w: peel(subtract(sketch(a, w, salt), sketch(b, w, salt)), w, salt))


def _plain(a: Column, b: Column) -> Column:
    """Digest by digest, for the one pair in some billions whose sketches all fail."""
    side = lambda x, y, s: F.transform(F.array_except(x, y), lambda k: F.struct(k.alias("k"), F.lit(s).cast("int").alias("s")))
    return F.concat(side(a, b, 1), side(b, a, -1))


def differing(a: Column, b: Column, ta: Column, tb: Column) -> Column:
    """array<struct<k, s>> of the digests in which two texts differ, from their sketches or from larger ones."""
    return F.coalesce(peel(subtract(ta, tb)), *(_larger(a, b, *retry) for retry in RETRIES), _plain(a, b))


def likeness(a: Column, b: Column, ta: Column, tb: Column) -> Column:
    both = F.size(a) + F.size(b)
    same = both - F.size(differing(a, b, ta, tb))
    return F.when(both == 0, 1.0).otherwise(F.try_divide(same, both))


def successors(ids: DataFrame) -> DataFrame:
    """doc_id, n, next_id for ids(doc_id, n): the next smaller id, after the least the greatest. Sorted by range; the
    first id of each range, a row for each, closes the gaps between ranges."""
    at = written(ids.orderBy(F.desc("doc_id")).withColumn("at", F.monotonically_increasing_id()), "id-order").withColumn("part", F.shiftright("at", 33))
    firsts = at.groupBy("part").agg(F.min_by(F.struct("doc_id"), "at").alias("first"))
    over = Window.orderBy("part")
    wrap = F.first("first").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("part", F.coalesce(F.lead("first").over(over), wrap).alias("after"))
    inner = F.lead(F.struct("doc_id")).over(Window.partitionBy("part").orderBy("at"))
    return at.withColumn("inner", inner).join(F.broadcast(firsts), "part").select("doc_id", F.coalesce("inner", "after")["doc_id"].alias("next_id"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sized = rows.groupBy("doc_id").agg(F.max(F.length("text")).alias("n"), F.count(F.lit(1)).alias("c"))
    sized = written(sized, "ids")
    pairs = successors(sized.select("doc_id")).join(sized.select(F.col("doc_id").alias("i"), "n"), F.col("doc_id").eqNullSafe(F.col("i"))).drop("i")
    speakers = rows
    if sized.where("c > 1").limit(1).count():
        speakers = rows.groupBy("doc_id").agg(F.min("text").alias("text"))
    half = lambda n: F.floor(n / 2).cast("int")
    asked = pairs.select(F.col("next_id"), F.col("doc_id").alias("asker"), half(F.col("n")).alias("want"))
    given = speakers.join(asked, speakers.doc_id.eqNullSafe(asked.next_id)).select("asker", F.substring("text", F.lit(1), F.col("want")).alias("front"), digests(F.col("text")).alias("dn"))
    met = rows.join(given, rows.doc_id.eqNullSafe(given.asker))
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - half(n)), F.substring("front", F.lit(1), half(n)))
    own = met.select("doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), "dn")
    own = own.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), digests(F.col("text")).alias("d"), digests(F.col("edited")).alias("de"), "dn")
    own = own.select("*", sketch(F.col("d")).alias("t"), sketch(F.col("de")).alias("te"), sketch(F.col("dn")).alias("tn"))
    d, de, dn, t, te, tn = map(F.col, ("d", "de", "dn", "t", "te", "tn"))
    return own.select("doc_id", "n_chars", "edited_sha256", text_of(t).alias("fingerprint"), text_of(te).alias("edited_fingerprint"), likeness(d, de, t, te).alias("near_edited"), likeness(d, dn, t, tn).alias("near_next"))
