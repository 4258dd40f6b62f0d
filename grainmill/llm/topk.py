"""Exact top-k by inner product with M-trees.

Vectors are quantized, floor(scale * x), so that scores are whole numbers. A bounded sample of PIVOTS vectors at most is
drawn in the order of a hash; every vector goes to its nearest pivot, whose ball gets a covering radius. The vectors of a
ball are built into M-trees of about BLOCK vectors, once, and written: pages of at most PAGE entries, each with its
distance to the page's pivot, inner ones with a covering radius. Inside a tree a vector v gets one more component,
sqrt(M^2 - |v|^2) with M the largest norm there, and a query gets 0: then |q - v|^2 = |q|^2 + M^2 - 2 q.v, so the highest
scores are the nearest neighbours in a metric space. A search visits pages best bound first. The triangle inequality over
the stored distances rules entries out before their distance is computed; what is left is scored in whole numbers. It
ends when no page can hold a score as high as the k-th.

A query first searches one tree of its own nearest ball. Its k-th score there is a floor: it then goes only to balls whose
radius lets a score as high lie inside, and what can't reach the floor is ruled out in their trees as well. Queries travel
to trees, never trees to queries, and each tree is read once for all of them.

Null vectors and vectors with null or non-finite components take no part, neither do rows without an id. A vector that is
shorter than others counts as 0 beyond its end. A query isn't compared with rows of its own id. Rows that repeat an id are
candidates each; a repeated query row has its own k answers, under the same id. With fewer than k candidates all are
returned; an empty table gives an empty result. Ties go to the smaller id. Extra columns play no part and are not returned.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import lean, parts, written

#: Vectors of a tree, entries of a page, and the most pivots, which bounds what is broadcast.
BLOCK, PAGE, PIVOTS = 8192, 256, 1024
#: Rows that a worker sends on at once.
ROWS = 4096
#: Up to this size of component, sums of products stay exact in 64 bits for any dimension that fits memory.
EXACT = 1 << 20


class MTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE):
        """vectors: whole numbers (int64, or object for huge ones)."""
        order = np.argsort(ids, kind="stable")
        self.ids, self.v = ids[order], vectors[order]
        wide = self.wide = self.v.astype(np.float64)
        self.most = float(np.abs(wide).max(initial=0.0))
        norms = np.einsum("ij,ij->i", wide, wide)
        self.m2 = float(norms.max(initial=0.0))
        self.points = np.hstack([wide, np.sqrt(np.maximum(0.0, self.m2 - norms))[:, None]])
        self.page, self.computed = page, 0
        self.root = self._build(np.arange(len(ids)), 0) if len(ids) else None

    def __getstate__(self) -> dict:
        """As it is written: whole numbers in the narrowest type, and the pages."""
        kind = next((k for k in ("i1", "i2", "i4") if self.v.dtype != object and self.most <= np.iinfo(k).max), None)
        return {"ids": self.ids, "v": self.v.astype(kind) if kind else self.v, "m2": self.m2, "page": self.page, "root": self.root}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.v = self.v if self.v.dtype == object else self.v.astype(np.int64)
        wide = self.wide = self.v.astype(np.float64)
        self.most, self.computed = float(np.abs(wide).max(initial=0.0)), 0
        self.points = np.hstack([wide, np.sqrt(np.maximum(0.0, self.m2 - np.einsum("ij,ij->i", wide, wide)))[:, None]])

    def _build(self, rows: np.ndarray, pivot: int) -> dict:
        """A page: its pivot, radius, and entries with their distances to the pivot."""
        far = self._far(self.points[rows], self.points[pivot])
        node = {"pivot": pivot, "radius": float(far.max(initial=0.0))}
        if len(rows) <= self.page or node["radius"] == 0.0:
            return node | {"rows": rows, "far": far}
        fan = min(self.page, max(2, len(rows) // (self.page // 2)))
        spread = rows[np.argsort(far, kind="stable")][np.linspace(0, len(rows) - 1, fan).astype(int)]
        near = np.argmin(np.stack([self._far(self.points[rows], self.points[p]) for p in spread]), axis=0)
        groups = [(p, rows[near == g]) for g, p in enumerate(spread)]
        groups = [(p, g) for p, g in groups if len(g)]
        if len(groups) < 2:  # all lie at the same place for the pivots: halves by distance part them
            by = rows[np.argsort(far, kind="stable")]
            groups = [(half[0], half) for half in np.array_split(by, 2)]
        children = [self._build(g, int(p)) for p, g in groups]
        pivots = np.array([c["pivot"] for c in children])
        return node | {"children": children, "pivots": pivots, "radii": np.array([c["radius"] for c in children]), "far": self._far(self.points[pivots], self.points[pivot])}

    @staticmethod
    def _far(points: np.ndarray, one: np.ndarray) -> np.ndarray:
        d = points - one
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def search(self, qid: int, query: np.ndarray, k: int, floor: int | None = None) -> list[tuple[int, int]]:
        """(score, id) of the k highest scores of at least `floor`, highest first, ties to the smaller id."""
        width = self.v.shape[1]
        query = query[:width] if len(query) >= width else np.append(query, np.zeros(width - len(query), query.dtype))
        wide = np.append(query.astype(np.float64), 0.0)
        whole = float(wide @ wide) + self.m2
        slack = 1e-7 * (whole + 1.0)  # rounding of distances must never rule out a winner
        bound = lambda far: (whole - np.maximum(0.0, far) ** 2) / 2 + slack  # noqa: E731  highest score beyond a distance
        best: list[tuple[int, int]] = []  # heap of (score, -id); the worst is first
        least = lambda: best[0][0] if len(best) == k else -np.inf if floor is None else floor
        # sums of products below 2^53 are exact in doubles, and a product of matrices is faster there
        plain = self.most * float(np.abs(wide).max(initial=0.0)) * max(1, len(query)) < 2.0**53
        rows_of, exact = (self.wide, wide[:-1]) if plain else (self.v, query.astype(self.v.dtype))

        def take(rows: np.ndarray) -> None:
            self.computed += len(rows)
            scores = rows_of[rows] @ exact
            scores = scores.astype(np.int64) if plain else scores
            keep = scores >= least()
            rows, scores = rows[keep], scores[keep]
            for s, i in zip(scores.tolist(), self.ids[rows].tolist()):
                if i != qid:
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))

        d0 = float(self._far(self.points[self.root["pivot"]][None], wide)[0])
        queue = [(-float(bound(d0 - self.root["radius"])), 0, self.root, d0)]
        n = 1
        while queue:
            up, _, node, d = heapq.heappop(queue)
            if -up < least():
                break
            if "rows" in node:
                rows = node["rows"]
                take(rows[bound(np.abs(d - node["far"])) >= least()])
                continue
            able = np.flatnonzero(bound(np.abs(d - node["far"]) - node["radii"]) >= least())  # by stored distances alone
            if len(able):
                self.computed += len(able)
                dist = self._far(self.points[node["pivots"][able]], wide)
                ups = bound(dist - node["radii"][able])
                for c, dc, u in zip(able.tolist(), dist.tolist(), ups.tolist()):
                    if u >= least():
                        heapq.heappush(queue, (-u, n, node["children"][c], dc))
                        n += 1
        return [(s, -i) for s, i in sorted(best, key=lambda x: (-x[0], -x[1]))]


def quantized(rows: list[np.ndarray]) -> np.ndarray:
    """Rows of whole numbers in doubles as a matrix, padded with 0; Python's numbers where 64 bits might not do."""
    wide = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, x in enumerate(rows):
        wide[i, : len(x)] = x
    if np.abs(wide).max(initial=0.0) < EXACT:
        return wide.astype(np.int64)
    return np.array([[int(x) for x in row] for row in wide], dtype=object).reshape(wide.shape)


def _doubles(bodies: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(b, np.float64) for b in bodies]


def _matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """As doubles, cut or padded to the width; what is cut meets only zeros."""
    out = np.zeros((len(vectors), width))
    for i, x in enumerate(vectors):
        out[i, : min(width, len(x))] = x[:width]
    return out


def usable(vectors: DataFrame, id_: str, vector: str, scale: float) -> DataFrame:
    """id, v: the quantized components as doubles, in bytes."""
    x = F.col("v")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(False)))

    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat, at = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False)), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())], ["id", "v"])

    return rows.mapInArrow(scan, "id long, v binary")


class Balls:
    """Pivots with their covering radii and numbers of trees; a bounded table."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.radius, self.trees = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)

    def nearest(self, vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(pivot, distance) of each; components beyond the pivots' width count for the distance."""
        v = _matrix(vectors, self.pivots.shape[1])
        beyond = np.array([float(x[self.pivots.shape[1] :] @ x[self.pivots.shape[1] :]) for x in vectors])
        d2 = (v * v).sum(axis=1)[:, None] - 2 * v @ self.pivots.T + (self.pivots * self.pivots).sum(axis=1)
        home = d2.argmin(axis=1)
        return home, np.sqrt(((v - self.pivots[home]) ** 2).sum(axis=1) + beyond)

    def may_hold(self, vectors: list[np.ndarray], floors: np.ndarray) -> np.ndarray:
        """Of each query and ball, whether a score of at least the query's floor can lie inside."""
        q = _matrix(vectors, self.pivots.shape[1])
        norm = np.array([np.sqrt(float(x @ x)) for x in vectors])
        most = q @ self.pivots.T + norm[:, None] * self.radius
        return (most + 1e-7 * (np.abs(most) + 1) >= floors[:, None]) & (self.trees > 0)


SENT = "tree long, q long, id long, floor long, body binary"


def _searched(trees: DataFrame, sent: DataFrame, k: int, tasks: int) -> DataFrame:
    """q, id, vec_id, score, computed: what each tree answers to the queries sent to it, and a row without vec_id that counts
    the distances computed. A tree stands before its queries in its partition, so one tree is in memory at a time."""
    rows = trees.select("tree", F.lit(None).cast("long").alias("q"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("floor"), "body").unionByName(sent)

    @lean
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, of = None, None
        for batch in batches:
            out: list[tuple] = []
            for key, q, id_, floor, body in zip(*(c.to_pylist() for c in batch.columns)):
                if q is None:
                    tree, of = pickle.loads(body), key
                    continue
                if of != key:
                    raise RuntimeError(f"a query came to tree {key} before the tree")
                query, before = quantized(_doubles([body]))[0], tree.computed
                out += [(q, id_, i, s, 0) for s, i in tree.search(id_, query, k, floor)]
                out.append((q, id_, None, None, tree.computed - before))
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(5)], ["q", "id", "vec_id", "score", "computed"])

    return rows.repartition(tasks, "tree").sortWithinPartitions("tree", F.col("q").isNotNull()).mapInArrow(search, "q long, id long, vec_id long, score long, computed long")


def found(vectors: DataFrame, queries: DataFrame, k: int = 5, id_: str = "vec_id", vector: str = "embedding", scale: float = 256.0, block: int = BLOCK) -> DataFrame:
    """q (a number for each row of queries), id, vec_id, score, computed: the winners of all trees that were searched."""
    spark = vectors.sparkSession
    rows = written(usable(vectors, id_, vector, scale), "vectors")
    n = rows.count()
    drawn = rows.orderBy(F.xxhash64("v", "id")).limit(min(PIVOTS, max(1, -(-n // block)))).collect()
    pivots = _doubles([bytes(r.v) for r in drawn])
    balls = Balls(_matrix(pivots, max(map(len, pivots), default=0)))
    sent = spark.sparkContext.broadcast(balls)

    @lean
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                home, far = sent.value.nearest(_doubles(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home, pa.int64()), pa.array(far)], ["id", "v", "ball", "far"])

    placed = written(rows.mapInArrow(place, "id long, v binary, ball long, far double"), "balls")
    for r in placed.groupBy("ball").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect():  # a row for each pivot
        balls.radius[r.ball], balls.trees[r.ball] = r.far, -(-r.n // block)
    first = np.concatenate([[0], np.cumsum(balls.trees)]).tolist()  # of each ball, its first tree's number
    edges, many = F.array(*[F.lit(x) for x in first[:-1]]) if pivots else F.array(F.lit(0)), F.array(*[F.lit(int(x)) for x in balls.trees]) if pivots else F.array(F.lit(1))
    own = lambda key: F.get(edges, F.col("ball").cast("int")) + F.pmod(key, F.get(many, F.col("ball").cast("int")))

    @lean
    def build(pdf: pa.Table) -> pa.Table:
        tree = MTree(pdf["id"].to_numpy(), quantized(_doubles(pdf["v"].to_pylist())))
        return pa.table({"tree": pdf["tree"].slice(0, 1), "body": pa.array([pickle.dumps(tree, 5)], pa.binary())})

    trees = written(placed.withColumn("tree", own(F.xxhash64("id", "v"))).groupBy("tree").applyInArrow(build, "tree long, body binary"), "trees")
    asked = written(usable(queries, id_, vector, scale).mapInArrow(place, "id long, v binary, ball long, far double").withColumn("q", F.monotonically_increasing_id()), "queries")
    tasks = max(parts(spark), min(10_000, first[-1]))
    # a query whose own ball is empty can't be: pivots are vectors
    at_home = asked.select(own(F.xxhash64("q")).alias("tree"), "q", "id", F.lit(None).cast("long").alias("floor"), F.col("v").alias("body"))
    near = written(_searched(trees, at_home, k, tasks), "near")
    kth = near.where("vec_id is not null").groupBy("q").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("c")).where(F.col("c") >= k).select("q", "floor")
    rest = asked.withColumn("home", own(F.xxhash64("q"))).join(kth, "q", "left").select("q", "id", "home", "floor", "v")
    sent = spark.sparkContext.broadcast((balls, first))

    @lean
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls, first = sent.value
        first = np.array(first)
        for batch in batches:
            for i in range(batch.num_rows):
                q, id_, home, floor, v = (c[i].as_py() for c in batch.columns)
                able = np.flatnonzero(balls.may_hold(_doubles([v]), np.array([-np.inf if floor is None else floor]))[0])
                for b in able:
                    for at in range(first[b], first[b + 1], ROWS):
                        tree = np.arange(at, min(at + ROWS, first[b + 1]))
                        tree = tree[tree != home]
                        if len(tree):
                            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int64()), *(pa.array([x] * len(tree), t) for x, t in ((q, pa.int64()), (id_, pa.int64()), (floor, pa.int64()), (v, pa.binary())))], ["tree", "q", "id", "floor", "body"])

    return near.unionByName(_searched(trees, rest.mapInArrow(route, SENT), k, tasks))


def top(vectors: DataFrame, queries: DataFrame, k: int = 5, **options) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of queries the k highest inner products among the rows of vectors."""
    near = found(vectors, queries, k, **options).where("vec_id is not null")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", place).where(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
