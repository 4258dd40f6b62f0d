"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Examples are a bounded sample of the labelled rows that may be learnt from: at most TOXIC rows of label 1 and CLEAN rows
of label 0, the first in the order of a hash of the text. Terms are all words of letters in lower case that any example
holds. A term weighs (1 + ln count) times its inverse document frequency among all documents: no label enters a weight or a
similarity, and no term is left out. Vectors have length 1.

A text's K nearest examples are found exactly. The lists of rare terms give each example a part of its similarity; the
long lists are bounded by their largest weight in each block of examples, and only blocks of which some example can still
be among the K are read there (equal similarities go to the smaller place). Neighbours' labels vote with their
similarities. The share is calibrated by isotonic regression on the examples' own votes, weighed up to the labelled rows.
K was chosen by two-fold cross-validation inside the rows that may be learnt from. An example whose text is the text that is scored has no vote, in calibration as in scoring. A text without any term that
an example holds has no neighbour; its share is the rate of label 1.

Near copies of one label are one example, so that no group of copies makes its words a sign: texts whose runs of three
words have the same SKETCH least hashes, and texts of which those hashes, walked in the order of the sample, put the
Jaccard similarity to a text taken before at ALIKE or more. A sketch is the whole set where there are no more runs. Texts
without words are alike only if they are equal. The walk goes on until the sample is full or all rows are seen.

Null and empty texts have no terms. Without any label 1, or none at all, all texts score the rate of label 1. Rows that
repeat a doc_id are scored each; a doc_id labelled both ways counts as 1; a row without a doc_id has no
label, is scored, and isn't held out. Empty tables give empty results. Texts are read
whole. Only the text enters a score. Extra columns are kept, those of the operator's own names replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import discard, few, lean, parts, spread, trim, written

#: The bounded sample of labelled rows, and how many neighbours vote.
TOXIC, CLEAN, K = 1200, 1800, 100
#: Examples in a block of the index; the share of examples whose lists are long.
BLOCK, LONG = 64, 0.1
#: Tasks whose results make up the examples' terms.
RESULTS = 96
WORDS = re.compile(r"[^\W\d_]+")
#: Least hashes kept of a text's runs of three words, and the likeness that makes a near copy.
SKETCH, ALIKE = 64, 0.5


def counted(text: str | None) -> Counter:
    return Counter(WORDS.findall((text or "").lower()))


class Index:
    """Postings of unit vectors by term, with the largest weight in each block; searched exactly."""

    def __init__(self, example: np.ndarray, term: np.ndarray, weight: np.ndarray, examples: int, terms: int):
        order = np.lexsort((example, term))
        term, self.example, self.weight = term[order], example[order].astype(np.int32), weight[order].astype(np.float32)
        self.n, self.blocks = examples, -(-examples // BLOCK)
        block = self.example // BLOCK
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(term)), bool), (term[1:] != term[:-1]) | (block[1:] != block[:-1])]))
        #: of each pair of a term and a block: where its postings begin, the block, and the largest weight
        self.at = np.append(first, len(term)).astype(np.int32)
        self.block = block[first].astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0, np.float32)
        self.pairs = np.searchsorted(term[first], np.arange(terms + 1)).astype(np.int32)
        self.long = np.bincount(term, minlength=terms) > LONG * examples

    def _sums(self, pairs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Of all examples, over the postings of those pairs."""
        size = self.at[pairs + 1] - self.at[pairs]
        place = spread(self.at[pairs], size)
        return np.bincount(self.example[place], np.repeat(weights, size) * self.weight[place], minlength=self.n).astype(float)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, but: list[int] = ()) -> list[tuple[int, float]]:
        """The k examples of highest cosine above 0 but some, ties to the smaller place."""
        count = self.pairs[terms + 1] - self.pairs[terms]
        pairs, w = spread(self.pairs[terms], count), np.repeat(weights, count)
        long = np.repeat(self.long[terms], count)
        score = self._sums(pairs[~long], w[~long])
        score[list(but)] = -np.inf
        pairs, w = pairs[long], w[long]
        bound = np.bincount(self.block[pairs], w * self.most[pairs], minlength=self.blocks)  # of what long lists can add
        part = np.maximum.reduceat(score, np.arange(0, self.n, BLOCK))
        kth = max(0.0, float(np.partition(score, self.n - k)[self.n - k])) if self.n > k else 0.0
        able = (part + bound >= kth - 1e-6) & (part > -np.inf)
        score += self._sums(pairs[able[self.block[pairs]]], w[able[self.block[pairs]]])
        score = np.where(np.repeat(able, BLOCK)[: self.n], np.round(score, 9), -np.inf)
        best = np.argpartition(-score, k)[:k] if self.n > k else np.arange(self.n)
        if self.n > k:  # with all that equal the last one
            best = np.flatnonzero(score >= score[best].min())
        best = best[score[best] > 0]
        return [(int(i), float(score[i])) for i in best[np.lexsort((best, -score[best]))][:k]]


class Model:
    """Terms, index and calibration; its size is bounded by the sample's texts."""

    def __init__(self, doc_ids: list, labels: np.ndarray, hashes: np.ndarray, example: np.ndarray, term: np.ndarray, count: np.ndarray, names: pa.Array, rate: float, held: np.ndarray, docs: int):
        self.ids, self.labels, self.rate, self.names = doc_ids, labels.astype(float), rate, names
        self.equal: dict[int, list[int]] = {}
        for i, h in enumerate(hashes.tolist()):
            self.equal.setdefault(h, []).append(i)
        n = len(labels)
        self.weights = np.log((1 + docs) / np.minimum(held + 1, docs + 0.5))
        weight = (1 + np.log(count)) * self.weights[term]
        norm = np.sqrt(np.bincount(example, weight * weight, minlength=n))
        self.index = Index(example, term, weight / norm[example], n, len(names))
        self.knots: tuple[list[float], list[float]] = ([0.0, 1.0], [0.0, 1.0])

    @cached_property
    def place(self) -> dict[str, int]:
        """Terms by name, made where texts are scored: the driver has no use for it."""
        return {t: i for i, t in enumerate(self.names.to_pylist())}

    def near(self, text: str | None, h: int) -> list[tuple[int, float]]:
        found = counted(text)
        places = [self.place.get(t, -1) for t in found]
        terms, counts = np.array(places, np.int64), np.fromiter(found.values(), float, len(found))
        terms, counts = terms[terms >= 0], counts[terms >= 0]
        if not len(terms):
            return []
        w = (1 + np.log(counts)) * self.weights[terms]
        return self.index.nearest(terms, w / np.sqrt(w @ w), K, self.equal.get(h, ()))

    def share(self, near: list[tuple[int, float]]) -> float:
        return sum(s for i, s in near if self.labels[i]) / sum(s for _, s in near) if near else self.rate


def _isotonic(votes: list[tuple[float, int, float]], rate: float) -> tuple[list[float], list[float]]:
    """Pooled adjacent violators; knots (share, probability). Each pool is smoothed by one row at the base rate."""
    pools: list[list[float]] = []  # weight, weight of label 1, least and largest share
    for s, y, w in votes:
        if pools and pools[-1][3] == s:
            pools[-1][0] += w
            pools[-1][1] += w * y
        else:
            pools.append([w, w * y, s, s])
        while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
            w2, y2, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + w2, pools[-1][1] + y2, pools[-1][2], hi]
    at, value = [], []
    for w, y, lo, hi in pools:
        p = (y + rate) / (w + 1)
        at += [lo, hi] if hi > lo else [lo]
        value += [p, p] if hi > lo else [p]
    return (at, list(np.maximum.accumulate(value))) if at else ([0.0], [rate])


def learnable(doc_id) -> F.Column:
    """Rows whose crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 != 1


def sketch() -> F.Column:
    """The least hashes of the text's runs of three words, in order; the text's own hash if it has no words."""
    found = F.transform(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)), lambda w: F.xxhash64(w))
    runs = lambda w: F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    least = F.element_at(F.transform(F.array(found), lambda w: F.slice(F.sort_array(F.array_distinct(runs(w))), 1, SKETCH)), 1)
    return F.when(F.size(least) > 0, least).otherwise(F.array(F.xxhash64("text")))


def likeness(a: list[int], b: list[int]) -> float:
    """The Jaccard similarity of two sets by their sketches."""
    union = sorted({*a, *b})[:SKETCH]
    both = {*a} & {*b}
    return sum(x in both for x in union) / len(union)


def sample(rows: DataFrame, most: dict[int, int], sketched) -> list[tuple[int, int, int]]:
    """doc_id, toxic, h: of each label the first rows, `most` of it, in the order of h that are no near copies of ones
    before. rows(doc_id, toxic, h); sketched gives the sketches of some of them. Only rows of a range of hashes, which are
    even, reach the driver at a time: at most some 16 times the sample."""
    out: list[tuple[int, int, int]] = []
    total = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    state = {y: {"size": 2 * most[y], "low": -(1 << 63), "taken": 0, "near": [], "held": {}} for y in total}
    end = 1 << 63
    while open_ := {y: s for y, s in state.items() if s["taken"] < most[y] and s["low"] < end}:
        part = F.lit(False)
        for y, s in open_.items():
            s["high"] = min(end, s["low"] + (s["size"] << 64) // total[y] + 1)
            part |= (F.col("toxic") == y) & F.col("h").between(s["low"], s["high"] - 1)
        for r in sorted(sketched(rows.where(part)), key=lambda r: (r.h, r.doc_id)):
            s = state[r.toxic]
            near, held = s["near"], s["held"]
            shared = Counter(k for x in r.near for k in held.get(x, ()))
            if s["taken"] < most[r.toxic] and not any(m >= ALIKE * max(len(r.near), len(near[k])) and likeness(r.near, near[k]) >= ALIKE for k, m in shared.items()):
                for x in r.near:
                    held.setdefault(x, []).append(len(near))
                out.append((r.doc_id, r.toxic, r.h))
                near.append(r.near)
                s["taken"] += 1
        for y, s in open_.items():
            s["low"], s["size"] = s["high"], min(2 * s["size"], 16 * most[y])
    return out


def frequencies(docs: DataFrame, names: pa.Array) -> tuple[np.ndarray, int]:
    """(in how many documents each of these terms stands, how many documents there are)."""
    sent = docs.sparkSession.sparkContext.broadcast(names)

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows = {t: i for i, t in enumerate(sent.value.to_pylist())}, 0
        total = np.zeros(len(place), np.int64)
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column(0):
                found = map(place.get, set(WORDS.findall((text.as_py() or "").lower())))
                total[[i for i in found if i is not None]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], ["i", "n"])

    sums = docs.select("text").mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    out, i, n = np.zeros(len(names), np.int64), sums["i"].to_numpy(), sums["n"].to_numpy()
    out[i[i >= 0]] = n[i >= 0]
    sent.destroy()
    return out, int(n[i < 0].sum())


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learnable(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text").where(learnable(F.col("doc_id")))
    # hashes of each text meet the labels, not the texts
    keyed = written(rows.select("doc_id", "h").join(marked, "doc_id").select("doc_id", "toxic", "h"), "labelled")
    total = {r.toxic: r["count"] for r in keyed.groupBy("toxic").count().collect()}
    equal = written(keyed.groupBy("toxic", "h").agg(F.min("doc_id").alias("doc_id")), "unlike")

    def texts(some: list[tuple]) -> DataFrame:
        """at, toxic, h, text of a bounded number of rows, `at` their place among them: one scan."""
        table = spark.createDataFrame([(i, *r) for i, r in enumerate(some)], "at long, doc_id long, toxic int, h long")
        return rows.join(F.broadcast(table), ["doc_id", "h"]).dropDuplicates(["at"])

    def sketched(some: DataFrame) -> Iterator:
        return texts([(r.doc_id, r.toxic, r.h) for r in some.collect()]).select("doc_id", "toxic", "h", sketch().alias("near")).toLocalIterator()

    picked = sample(equal, {1: TOXIC, 0: CLEAN}, sketched)
    rate = total.get(1, 0) / max(1, sum(total.values()))
    ids, marks, hashes = [d for d, _, _ in picked], np.array([y for _, y, _ in picked], float), np.array([h for *_, h in picked], np.int64)
    found = written(few(texts(picked)), "examples")

    @lean
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(i, t, c) for i, text in zip(batch["at"], batch.text) for t, c in counted(text).items()]
            yield pd.DataFrame(out, columns=["at", "term", "n"])

    # many small results: large ones would be fetched through buffers that the driver keeps
    trim()  # what the sample took
    terms = found.select("at", "text").repartition(max(parts(spark), RESULTS)).mapInPandas(count, "at long, term string, n int").toArrow()
    example, held = terms["at"].to_numpy().astype(np.int32), terms["n"].to_numpy().copy()
    coded = terms["term"].combine_chunks().dictionary_encode()
    del terms
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    term, names = rank[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order))
    del coded, rank, order
    trim()  # the examples' words, one by one
    model = Model(ids, marks, hashes, example, term, held, names, rate, *frequencies(docs, names))
    del example, held, term, names
    trim()
    if 0 < marks.sum() < len(marks):
        weights = {y: total[y] / (marks == y).sum() for y in (0, 1)}
        sent = spark.sparkContext.broadcast(model)
        votes = _judged(found, sent).select("toxic", "__judged.share").collect()
        sent.destroy()
        model.knots = _isotonic(sorted((r.share, r.toxic, weights[r.toxic]) for r in votes), rate)
    else:
        model.knots = ([0.0], [rate])
    discard(keyed, equal, found)
    trim()
    return model


def _judged(docs: DataFrame, sent) -> DataFrame:
    kind = pa.struct([("score", pa.float64()), ("share", pa.float64()), ("evidence", pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())])))])

    @lean
    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = sent.value
        for texts, hashes in batches:
            out = []
            for text, h in zip(texts, hashes):
                near = model.near(text.as_py(), h.as_py())
                share = model.share(near)
                out.append((float(np.interp(share, *model.knots)), share, [{"doc_id": model.ids[i], "similarity": s, "toxic": int(model.labels[i])} for i, s in near[:5]]))
            yield pa.array([dict(zip(("score", "share", "evidence"), x)) for x in out], kind)

    judge = F.arrow_udf(judge, "score double, share double, evidence array<struct<doc_id: long, similarity: double, toxic: int>>")
    return docs.withColumn("__judged", judge("text", F.xxhash64("text")))


def score(docs: DataFrame, model: Model, at: float = 0.7) -> DataFrame:
    """docs with score, predicted and evidence (at most five nearest examples: doc_id, similarity, label)."""
    got = _judged(docs, docs.sparkSession.sparkContext.broadcast(model))
    return got.withColumns({"score": F.col("__judged.score"), "predicted": (F.col("__judged.score") >= at).cast("int"), "evidence": F.col("__judged.evidence")}).drop("__judged")
