"""Near duplicates by SetSketch registers.

A document's set is its distinct word shingles (A-Z in lower case; words part at space and \\t to \\r); with fewer words
than a shingle has, the whole sequence is the one element. Equal sets are one class. For each class an exponential
process marks registers at random; a register keeps the least mark, truncated to its place on an exponential scale:
mergeable by maximum, and equal in two sets with nearly their Jaccard similarity as odds. Bands of registers collect
candidate classes in buckets. Of a pair of candidates, the joint likelihood of which registers are greater, smaller and
equal is taken, given both set sizes; pairs for which the wanted similarity is out of the question go, and all others
are confirmed on the full sets.

Buckets are never expanded into rows of pairs. First each bucket's members meet its smallest member. Then, in buckets that
still hold several components, those outside the largest one meet the other members: full sets travel to blocks of bounded
bytes, pairs are decided there, and a block returns a forest of links. So one bucket may hold any share of the rows.
Components are found by contracting the edges of each task, and by alternating large and small stars between tasks. What is left to chance: a pair at the very threshold meets in no band with odds of 5e-8, and is wrongly ruled out
by its likelihood with odds below 1e-6.

Null, empty and blank texts have no elements, link with nothing and are kept. Rows that repeat a doc_id are rows of
their own, of one id. An empty table gives an empty result. Texts are read whole. Extra columns play no part and are not
returned. Rows without a doc_id count in their class, whose least id represents it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, lean, mix64, parts, slabs, utf8, written

#: Registers of a sketch and of a band, base of their scale, and the mark that counts as its beginning: none is later.
REGISTERS, ROWS, BASE, LATEST = 128, 4, 1.001, 20.0
BANDS = REGISTERS // ROWS
#: A pair is ruled out if the wanted similarity is less likely than the best one by this factor's logarithm.
DOUBT = 12.5
#: Bytes of registers and sets on each side of a block, and in a task.
BLOCK, TASK = 2 << 20, 4 << 20
#: Pairs whose registers are compared at once.
PAIRS = 60_000
SLAB = 1 << 20
#: Edges that a task contracts at once.
EDGES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True
_VALUE = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
for _c in range(65, 91):
    _VALUE[_c] = _VALUE[_c + 32]
_B = 0xD1342543DE82EF95
_B_INVERSE = pow(_B, -1, 1 << 64)


def _powers(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Shingler:
    """Distinct shingle hashes of a slab of texts, per text in order."""

    def __init__(self, words: int):
        self.words = words
        self.up = self.down = np.ones(1, np.uint64)
        self.factor = mix64(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)

    def hashes(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sorted distinct hashes, start of each text's hashes) for texts body[offsets[i]:offsets[i + 1]]."""
        n, texts = len(body), len(offsets) - 1
        if len(self.up) <= n:
            self.up, self.down = _powers(_B, n + 1), _powers(_B_INVERSE, n + 1)
        letter = ~_SPACE[body]
        first = letter.copy()
        first[1:] &= ~letter[:-1]
        inner = offsets[(offsets > 0) & (offsets < n)]
        first[inner] = letter[inner]
        last = letter.copy()
        last[:-1] &= ~letter[1:]
        last[inner - 1] = letter[inner - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[body] * self.down[:n], out=total[1:])
        word = mix64((total[end] - total[start]) * self.up[start] + (end - start).astype(np.uint64))
        del total
        of = np.searchsorted(offsets, start, side="right") - 1  # the text of each word
        count = np.bincount(of, minlength=texts)
        begin = np.concatenate([[0], np.cumsum(count)])
        k = self.words
        made = np.maximum(np.where(count > 0, 1, 0), count - k + 1)
        at = np.concatenate([[0], np.cumsum(made)])
        item = np.arange(at[-1])
        text = np.repeat(np.arange(texts), made)
        pos = begin[text] + item - at[text]
        short = count[text]
        h = np.zeros(len(item), np.uint64)
        for j in range(k):
            there = j < short  # a short text's one element holds all its words
            h += np.where(there, word[np.minimum(pos + j, len(word) - 1)] * self.factor[j], np.uint64(0)) if len(word) else np.uint64(0)
        h = mix64(h + np.minimum(short, k).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a > 1:
                h[a:b].sort()
        new = np.ones(len(h), bool)
        if len(h):
            new[1:] = h[1:] != h[:-1]
            new[at[:-1][made > 0]] = True
        sizes = np.bincount(text[new], minlength=texts)
        return h[new], np.concatenate([[0], np.cumsum(sizes)])


def registers(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """uint16 registers of each set. Every element runs a Poisson process whose points fall on registers at random, until
    its next point lies beyond the set's largest register."""
    sets = len(starts) - 1
    least = np.full((sets, REGISTERS), np.inf)
    flat = least.reshape(-1)
    of = np.repeat(np.arange(sets), np.diff(starts))
    x, j = np.zeros(len(h)), 0
    worst = np.full(sets, np.inf)
    while len(h):
        j += 1
        r = mix64(h + np.uint64((j * 0x9E3779B97F4A7C15) % (1 << 64)))
        x = x - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / REGISTERS
        np.minimum.at(flat, of * REGISTERS + (r & np.uint64(REGISTERS - 1)).astype(np.int64), x)
        live = of[np.concatenate([[True], of[1:] != of[:-1]])]
        worst[live] = least[live].max(axis=1)
        keep = x < worst[of]
        h, of, x = h[keep], of[keep], x[keep]
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(least / LATEST) / np.log(BASE)), 0, 65535).astype(np.uint16)


def least_equal(share: float) -> int:
    """Equal registers that a pair of this similarity has but for seven deviations."""
    p = 1 + 2 * np.log1p(-(1 - share) / 2 * (BASE - 1) / BASE) / np.log(BASE)
    return int(REGISTERS * p - 7 * np.sqrt(REGISTERS * p * (1 - p)))


def may_reach(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(whether a similarity of `share` is possible, the likeliest similarity) of rows of registers with known set sizes."""
    na, nb = na.astype(np.float64), nb.astype(np.float64)
    most = np.minimum(na, nb) / np.maximum(na, nb)
    up, down = (a > b).sum(axis=-1), (a < b).sum(axis=-1)
    u, v = na / (na + nb), nb / (na + nb)
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(s):
        x, y = p(u - v * s), p(v - u * s)
        return up * np.log(x) + down * np.log(y) + (REGISTERS - up - down) * np.log(np.maximum(1 - x - y, 1e-12))

    best, value = np.zeros(len(up)), np.full(len(up), -np.inf)
    for t in np.linspace(0, 1, 41):
        got = likelihood(t * most)
        better = got > value
        best[better], value[better] = (t * most)[better], got[better]
    wanted = np.minimum(share, most)
    return (most >= share - 1e-9) & ((best >= share) | (value - likelihood(wanted) <= DOUBT)), best


def _named(h: np.ndarray, at: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit name of each set, whatever the order of its elements."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(h ^ np.uint64(salt)))])
    return mix64(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64)


_SALTS = 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, h (hash of the text), n, node, node2 (hashes of the set), regs."""

    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            body, offsets = utf8(batch.column(2))
            for i, j in slabs(offsets, SLAB):
                h, at = shingler.hashes(body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                n, sums = np.diff(at), [_named(h, at, salt) for salt in _SALTS]
                regs = registers(h, at)
                given = [batch.column(c).slice(i, j - i) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*given, pa.array(n, pa.int64()), pa.array(sums[0]), pa.array(sums[1]), pa.array([r.tobytes() for r in regs], pa.binary())], ["doc_id", "h", "n", "node", "node2", "regs"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text").mapInArrow(scan, "doc_id long, h long, n long, node long, node2 long, regs binary")


def sets_of(docs: DataFrame, words: int) -> DataFrame:
    """node, set: the sorted hashes of each row's set as bytes; docs(node, text). A null node stands for the text's own."""

    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            body, offsets = utf8(batch.column(1))
            for i, j in slabs(offsets, SLAB):
                h, at = shingler.hashes(body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                given, name = batch.column(0).slice(i, j - i), _named(h, at, _SALTS[0])
                node = np.where(given.is_null().to_numpy(zero_copy_only=False), name, given.fill_null(0).to_numpy(zero_copy_only=False))
                same = np.flatnonzero(name == node)  # not so for another text of a repeated doc_id
                yield pa.RecordBatch.from_arrays([pa.array(node[same], pa.int64()), pa.array([h[at[k] : at[k + 1]].tobytes() for k in same], pa.binary())], ["node", "set"])

    return docs.select("node", "text").mapInArrow(scan, "node long, set binary")


def _bands(classes: DataFrame) -> DataFrame:
    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u8").reshape(-1, BANDS).astype(np.uint64)
                band = np.arange(BANDS, dtype=np.uint64)
                keys = (mix64(regs + band * np.uint64(0x9E3779B97F4A7C15)) & ~np.uint64(BANDS - 1) | band).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS))], ["key", "node"])

    return classes.select("node", "regs").mapInArrow(scan, "key long, node long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets reach percent of their union."""

    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            good = [i for i, (p, q) in enumerate(zip(x, y)) if _alike(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), percent)]
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in good], pa.int64()), pa.array([b[i] for i in good], pa.int64())], ["a", "b"])

    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(scan, "a long, b long")


def _least(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the same components: each node that isn't the least of its own, and the least one."""
    node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, up = at[: len(a)], at[len(a) :], np.arange(len(node))
    while len(open_ := np.flatnonzero(up[x] != up[y])):
        x, y = x[open_], y[open_]
        np.minimum.at(up, np.maximum(up[x], up[y]), np.minimum(up[x], up[y]))  # roots alone, as paths are short
        while (up != up[up]).any():
            up = up[up]
    low = np.flatnonzero(up != np.arange(len(node)))
    return node[low], node[up[low]]


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b), b < a, of the same components: of each EDGES rows a forest of stars, so fewer than they have nodes."""

    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, EDGES):
                held.append(batch.slice(at, EDGES))
                size += held[-1].num_rows
                if size >= EDGES:
                    yield forest(held)
                    held, size = [], 0
        if size:
            yield forest(held)

    def forest(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        found = _least(*(np.concatenate([x.column(k).to_numpy() for x in held]) for k in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "b"])

    return edges.select("a", "b").mapInArrow(scan, "a long, b long")


def stars(edges: DataFrame) -> DataFrame:
    """(a, b), written: each node of edges (a, b) that isn't the least of its component, and the least one. Edges that meet
    in a task are contracted there; while some are left to join, large and small stars alternate, and are contracted again."""
    files = lambda rows, each: max(1, min(parts(edges.sparkSession), -(-rows // each)))
    rows = edges.count()
    now = written(_contracted(edges.coalesce(files(rows, EDGES))), "edges")
    while True:
        ends = now.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("x"))
        # no node has two edges upwards, or one up and one down
        if ends.groupBy("x.node").agg(F.sum("x.up").alias("up"), F.min("x.up").alias("least")).where("up > 1 or up > least").isEmpty():
            return now
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        after = written(_contracted(small.where("a <> b").distinct().coalesce(files(rows, 1 << 20))), "edges")
        discard(now)
        now = after


def components(edges: DataFrame) -> DataFrame:
    """node, comp for every node of edges (a, b); comp is the least node of its component."""
    found = stars(edges)
    return found.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(found.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def _likely(pairs: DataFrame, classes: DataFrame, share: float) -> DataFrame:
    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                regs = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (4, 5)]
                good, _ = may_reach(*regs, batch.column(2).to_numpy(), batch.column(3).to_numpy(), share)
                yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(good)) for k in (0, 1)], ["a", "b"])

    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ra", "rb").mapInArrow(scan, "a long, b long")


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with comp, the component of their node by the stars found; of a node that has none, the node."""
    return rows.join(found.select(F.col("a").alias("node"), F.col("b").alias("comp")), "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _linked(members: DataFrame, found: DataFrame, classes: DataFrame, sets: DataFrame, share: float, percent: int) -> DataFrame:
    """(a, b): links between components, the stars found so far, within the buckets. In a bucket that holds several components, each class outside
    the largest one meets all others. Classes travel with their full sets to blocks of about BLOCK bytes; there, pairs whose
    likelihood allows the share are compared on their sets, the likeliest first, unless links found before join them already.
    A block returns a forest: fewer links than it has members, however many pairs there are."""
    placed = _placed(members.join(classes.select("node", "n"), "node"), found).withColumn("bytes", F.lit(2 * REGISTERS + 64) + 8 * F.col("n"))
    per = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("bytes").alias("bytes"))
    state = per.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.sum("bytes").alias("total"), F.max_by(F.struct("comp", "bytes"), F.struct("c", "comp")).alias("main")).where("comps > 1")
    blocks = lambda x: F.greatest(F.lit(1), F.ceil(x / F.lit(BLOCK))).cast("int")
    state = state.select("key", F.col("main.comp").alias("main"), "total", blocks(F.col("total")).alias("cm"), blocks(F.col("total") - F.col("main.bytes")).alias("cv"))
    state = written(state, "buckets")
    sums = state.agg(F.sum(F.col("total") * (F.col("cm") + F.col("cv")))).first()[0] or 0
    tasks = max(2 * parts(members.sparkSession), -(-int(sums) // TASK))
    own = lambda c, salt: F.pmod(F.xxhash64("node", F.lit(salt)), c).cast("int")
    rows = placed.join(state.drop("total"), "key")
    # a row's places: a member in each block of its bucket's column, and where it asks, in each of its row
    place = lambda probe, i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(probe).alias("probe"))
    held = F.transform(F.sequence(F.lit(0), F.col("cv") - 1), lambda i: place(False, i, own(F.col("cm"), 1)))
    asks = F.transform(F.sequence(F.lit(0), F.col("cm") - 1), lambda j: place(True, own(F.col("cv"), 2), j))
    every = F.when(F.col("comp") == F.col("main"), held).otherwise(F.concat(held, asks))
    both = rows.select("key", F.explode(every).alias("x"), "node", "comp", "main").select("key", "x.i", "x.j", "x.probe", "node", "comp", "main")
    # one row for each class and task, with its places there: the set travels once to a task
    dealt = both.withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(tasks)))
    dealt = dealt.groupBy("task", "node").agg(F.first("comp").alias("comp"), F.collect_list(F.struct("key", "i", "j", "probe", "main")).alias("places"))
    full = dealt.join(classes.select("node", "n", "regs"), "node").join(sets, "node")

    @lean
    def compare(rows: pa.Table) -> pa.Table:
        node, comp, n = (rows[c].to_numpy() for c in ("node", "comp", "n"))
        regs = np.frombuffer(b"".join(rows["regs"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
        body, at = utf8(rows["set"])
        hashes, at = np.frombuffer(body.tobytes(), np.uint64), at // 8
        places = rows["places"].combine_chunks()
        of = np.repeat(np.arange(len(node)), np.diff(places.offsets.to_numpy()))
        key, i, j, probe, main = (places.flatten().field(c).to_numpy(zero_copy_only=False) for c in range(5))
        order = np.lexsort((probe, j, i, key))
        of, key, i, j, probe, main = (x[order] for x in (of, key, i, j, probe, main))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        start = np.flatnonzero(new)
        asks = np.flatnonzero(probe)
        first = start[np.searchsorted(start, asks, side="right") - 1]
        count = np.add.reduceat((~probe).astype(np.int64), start)[np.searchsorted(start, asks, side="right") - 1]  # members stand before the probes
        forest, found = _Forest(), []
        upto, a = np.cumsum(count), 0
        while a < len(asks):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, side="right")))
            for q, m in zip(*_possible(asks[a:b], first[a:b], count[a:b], key, main, of, node, comp, n, regs, share)):
                x, y = int(comp[q]), int(comp[m])
                if forest.of(x) != forest.of(y) and _alike(hashes[at[q] : at[q + 1]], hashes[at[m] : at[m + 1]], percent):
                    forest.join(x, y)
                    found.append((x, y))
            a = b
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return full.groupBy("task").applyInArrow(compare, "a long, b long")


class _Forest:
    """Which components are joined by now."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def of(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.of(x)] = self.of(y)


def _alike(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    both = np.concatenate([p, q])
    both.sort(kind="stable")  # two sorted runs are merged
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(p) + len(q) - shared)


def _possible(asks, first, count, key, main, of, node, comp, n, regs, share: float) -> tuple[list[int], list[int]]:
    """Pairs of classes, of each place in asks with its block's members (places first .. first + count), that may reach the
    share; the likeliest first."""
    p = np.repeat(asks, count)
    at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(p))
    q, m = of[p], of[at]
    # of two that both ask, the one with the smaller node does
    keep = (comp[q] != comp[m]) & ((comp[m] == main[p]) | (node[m] > node[q])) & (np.minimum(n[q], n[m]) >= share * np.maximum(n[q], n[m]) - 1e-6)
    p, q, m = p[keep], q[keep], m[keep]
    keep = (regs[q] == regs[m]).sum(axis=1) >= least_equal(share)
    p, q, m = p[keep], q[keep], m[keep]
    band = regs.view("<u8")
    before = np.arange(BANDS) < (key[p] & (BANDS - 1))[:, None]  # a pair is compared in the first band that it shares
    keep = ~((band[q] == band[m]) & before).any(axis=1)
    q, m = q[keep], m[keep]
    good, like = may_reach(regs[q], regs[m], n[q], n[m], share)
    order = np.lexsort((m[good], q[good], -like[good]))
    return q[good][order].tolist(), m[good][order].tolist()


def classified(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles, component_id and comp (a name of the component, null without words) of each
    row; links are pairs with 100 * intersection >= percent * union."""
    share = percent / 100
    rows = written(sketches(docs, words), "sketches")
    full = rows.where("n > 0")
    classes = written(full.groupBy("node", "node2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("regs").alias("regs")), "classes")
    bands = _bands(classes)
    buckets = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("hub")).where("size > 1")
    members = written(bands.join(buckets, "key"), "members")
    pairs = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    # the full sets of those classes that share a bucket with another; text moves once, by doc_id
    wanted = members.select("node").distinct().join(classes.select("node", "rep"), "node").select("node", F.col("rep").alias("doc_id"))
    text = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id")
    sets = sets_of(text, words)
    nameless = wanted.where("doc_id is null").select("node")  # classes of rows without a doc_id: by the text's own name
    bare = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("node"), "text")
    if not nameless.isEmpty():
        sets = sets.unionByName(sets_of(bare, words).join(nameless, "node", "left_semi"))
    if rows.groupBy("doc_id").count().where("count > 1").limit(1).count():
        sets = sets.dropDuplicates(["node"])
    sets = written(sets, "sets")
    edges = written(_confirmed(_likely(pairs, classes, share), sets, percent), "links")
    found = stars(edges)
    more = written(_linked(members.where("size > 2"), found, classes, sets, share, percent), "links")
    if not more.isEmpty():
        before, found = found, stars(found.unionByName(more))
        discard(before)
    discard(members, sets, edges, more)  # the result needs the classes, the components and the rows' sketches
    named = _placed(classes.select("node", "node2", "rep"), found)
    ids = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of = named.join(ids, "comp").select("node", "node2", "component_id", "comp")
    joined = rows.join(of, ["node", "node2"], "left")
    return joined.select("doc_id", "h", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "comp")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    return classified(docs, words, percent).select("doc_id", "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs without near copies: of each component the row of least doc_id (none: last), then of least hash of the text. Rows
    equal in doc_id and text are one. Rows without words stay."""
    every = written(classified(docs, words, percent), "classified")
    first = every.where("comp is not null").groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("x"))
    keep = first.select("x.doc_id", "x.h").unionByName(every.where("comp is null").select("doc_id", "h")).distinct().select(F.col("doc_id").alias("__d"), F.col("h").alias("__h"))
    mine = [F.col("doc_id").cast("long").eqNullSafe(F.col("__d")), F.xxhash64("text") == F.col("__h")]
    kept = docs.join(keep, mine[0] & mine[1], "left_semi")
    again = every.where("comp is not null").groupBy("doc_id", "h").count().where("count > 1").select(F.col("doc_id").alias("__d"), F.col("h").alias("__h"))
    if again.isEmpty():
        return kept
    once = kept.join(again, mine[0] & mine[1], "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, mine[0] & mine[1], "left_anti").unionByName(once)
