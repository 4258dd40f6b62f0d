"""Periodic runs of words: stretches in which a phrase stands again and again, found by divide and conquer.

A run of period q is a stretch of words of which those q apart are identical, that no neighbouring word extends, whose
smallest period is q and that holds at least `least` words and `times` periods. Words are interned as integers, task by
task. The search is Main and Lorentz's: halve a stretch; a run that crosses the middle holds two periods on one side of it at
least, so the Z-function of the right half, or of the left half read backwards, shows a square at the middle; extend it as
far as it goes; then search the halves. Of squares at a middle only those of primitive period count: one of period q inside
a stretch of smaller period of length 2 q repeats that one (Fine and Wilf), and a middle inside a run that is known with the
same period has nothing new. Intervals found twice are one, with the smallest period.

Before it, stretches that can hold no run are ruled out: in a run every word but those of the last period recurs at most q
words later, and at least times - 1 periods of such words follow each other. So a word that doesn't recur soon enough for the
stretch of recurring words around it parts that stretch, until none is parted any more. This loses no run.

Rows are taken one by one, so nothing is shuffled and no group of rows meets. A row's memory is its words as integers and its
distinct words; long texts are parted into words piece by piece. Null and empty texts have no words, no runs and an empty
collapsed text. Rows that repeat a key are rows each; a null key is kept. Runs of equal length, start and period can't be two;
ties of length go to the smaller start. An empty table gives an empty result. Extra columns are not returned.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import lean, slabs, utf8

LEAST, TIMES = 6, 4
#: Bytes of texts whose words are in memory at once, and rounds of parting.
SLAB, ROUNDS = 1 << 20, 12
RUNS = "array<struct<start:long,length:long,period:long>>"


class _Words(dict):
    """Word -> number, in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def interned(text: bytes, known: _Words) -> np.ndarray:
    """The words of a text as numbers; a long text piece by piece."""
    out, at = [], 0
    while at < len(text):
        end = at + SLAB
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        words = text[at:end].split()
        out.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def recurrence(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How many words later each word stands next in its document; 0 if it doesn't."""
    key = doc.astype(np.int64) << 32 | ids
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    out = np.zeros(len(ids), np.int64)
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def stretches(gap: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """(from, to) that hold every run; a run lies in one of them."""
    at = np.flatnonzero(gap)
    for k in range(ROUNDS + 1):
        if not len(at):
            return []
        new = np.flatnonzero(np.diff(at, prepend=at[0] - 2) != 1)
        size = np.diff(np.append(new, len(at)))
        around = np.repeat(size, size)
        keep = (gap[at] * (times - 1) <= around) & (around >= max(times - 1, least - least // times))
        if k == ROUNDS or keep.all():
            break
        at = at[keep]
    reach = np.maximum.reduceat(gap[at], new)
    return [(int(at[i]), int(at[i]) + int(n) + int(r)) for i, n, r in zip(new, size, reach)]


def z_function(s: list) -> list[int]:
    """How far the list from each place on agrees with the list from its start."""
    z, left, right = [0] * len(s), 0, 0
    n = len(s)
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i], left, right = k, i, i + k
    return z


def squares(half: list) -> Iterator[tuple[int, int]]:
    """(period, how long it holds) of the squares of primitive period at the start of a list."""
    z, held = z_function(half), 0
    for q in range(1, len(half) // 2 + 1):
        if z[q] >= q:
            if 2 * q > held:
                yield q, q + z[q]
            held = max(held, q + z[q])


def runs(w: list, start: int, end: int, least: int = LEAST, times: int = TIMES) -> dict[tuple[int, int], int]:
    """{(from, to): period} of the runs that lie in w[start:end], and of others met on the way."""
    found: dict[tuple[int, int], int] = {}
    known: dict[int, list[tuple[int, int]]] = {}
    todo, n = [(start, end)], len(w)
    while todo:
        lo, hi = todo.pop()
        if hi - lo < least:
            continue
        middle = (lo + hi) // 2
        for back, half in ((False, w[middle:hi]), (True, w[lo:middle][::-1])):
            for q, holds in squares(half):
                a, b = (middle - holds, middle) if back else (middle, middle + holds)
                mine = known.setdefault(q, [])
                i = bisect_right(mine, (a, n)) - 1
                if i >= 0 and mine[i][1] >= b:
                    continue
                while a > 0 and w[a - 1] == w[a - 1 + q]:
                    a -= 1
                while b < n and w[b] == w[b - q]:
                    b += 1
                insort(mine, (a, b))
                if b - a >= max(least, times * q):
                    found[a, b] = min(q, found.get((a, b), q))
        todo += [(lo, middle), (middle, hi)]
    return found


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """key, n_words, runs (by start, then period), collapsed: the words without those that a run repeats, that is without
    all words of runs but the first period of each, joined by blanks."""

    @lean
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, at = utf8(batch.column(1))
            for i, j in slabs(at, SLAB):
                known = _Words()
                ids = [interned(body[at[k] : at[k + 1]].tobytes(), known) for k in range(i, j)]
                names = list(known)
                del known
                starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                gap = recurrence(np.concatenate(ids), np.repeat(np.arange(j - i), np.diff(starts)))
                found: list[dict] = [{} for _ in ids]
                lists: dict[int, list] = {}
                for a, b in stretches(gap, least, times):
                    k = int(np.searchsorted(starts, a, side="right")) - 1
                    if k not in lists:
                        lists = {k: ids[k].tolist()}  # stretches come document after document
                    for span, q in runs(lists[k], a - int(starts[k]), min(b, int(starts[k + 1])) - int(starts[k]), least, times).items():
                        found[k][span] = min(q, found[k].get(span, q))
                shown, kept = [], []
                for own, has in zip(ids, found):
                    gone = np.zeros(len(own), bool)
                    for (a, b), q in has.items():
                        gone[a + q : b] = True
                    shown.append(sorted(({"start": a, "length": b - a, "period": q} for (a, b), q in has.items()), key=lambda r: (r["start"], r["period"])))
                    kept.append(b" ".join(map(names.__getitem__, own[~gone].tolist())))
                columns = [batch.column(0).slice(i, j - i), pa.array([len(x) for x in ids], pa.int64()), pa.array(shown, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), pa.array(kept, pa.large_binary()).cast(pa.large_string())]
                yield pa.RecordBatch.from_arrays(columns, [key, "n_words", "runs", "collapsed"])

    rows = docs.select(key, F.coalesce(text, F.lit("")).alias("__text"))
    return rows.mapInArrow(search, f"{key} {rows.schema[key].dataType.simpleString()}, n_words long, runs {RUNS}, collapsed string")
