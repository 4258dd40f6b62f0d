"""Repeated passages by suffix sorting with difference covers.

A byte goes if a string of `length` bytes around it also starts in a document of smaller doc_id; matches never cross
documents, and strings are judged on the input. The work is dealt so that no global suffix array is needed:

1. Every window of `length` bytes has an anchor, the one of its GRAM-byte grams with the least hash (the first of equal
   ones); neighbouring windows mostly share it. Equal windows have equal anchors at equal places. Documents stand in
   blocks; each block asks, once for each anchor, whether another document has that gram, and learns which do.
2. Of each shared anchor the block sends its slice, the bytes of all windows that own the anchor, to the task of that
   anchor. Slices that are equal within the block travel once, for the smallest doc_id; the others go at once.
3. That task sorts the windows of its slices, but for slices none of whose windows' hashes stands twice, by the
   difference-cover algorithm: positions i % 3 != 0 are sorted by
   triples, named, and sorted by recursion on the names until names cover `length` bytes; the remaining suffixes follow
   from their first byte and their neighbour's rank, and are merged in. Adjacent suffixes whose prefixes of `length`
   bytes agree are one string; all but those of its smallest doc_id are marked.
4. Marks return to the blocks by the row's name, a hash of id and text, and are joined into spans.

An anchor that very many blocks share sends its windows one by one, each to the task of the window's own bytes, again
once for each block. So a passage that stands in a third of all documents costs each block one row, never a task all.
Whole texts that are copies of another row's, told by their SHA-256, take no part; all their bytes go, if they have a
window at all. Slices of equal hash are compared byte by byte before one stands for the others.

Null texts are empty. Texts shorter than `length` keep all. Rows of equal doc_id don't remove from each other, rows
without a doc_id count as last. Very long texts are one row of their block, read slab by slab. An empty table gives an empty result. Extra columns play no part and are not returned.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import lean, mix64, slabs, spread, utf8, written
from .neardup import _B, _B_INVERSE, _powers

Key = tuple[pa.Scalar, ...]
LENGTH, GRAM = 50, 20
#: Bytes whose anchors are found, or whose windows are sorted, at once.
SLAB = 1 << 19
#: Text bytes in a block, and the number of blocks that makes an anchor a hot one.
BLOCK_BYTES, HOT = 4 << 20, 750
LAST = (1 << 63) - 1
_BYTE = mix64((np.arange(256, dtype=np.uint64) + np.uint64(77)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Anchors:
    """The anchors of a slab of texts: a run of windows for each."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.up = self.down = np.ones(1, np.uint64)

    def _sums(self, body: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(body):
            self.up, self.down = _powers(_B, len(body) + 1), _powers(_B_INVERSE, len(body) + 1)
        total = np.zeros(len(body) + 1, np.uint64)
        np.cumsum(_BYTE[body] * self.down[: len(body)], out=total[1:])
        return total

    def runs(self, body: np.ndarray, offsets: np.ndarray):
        """(key, text, first window, windows, hash of the slice, total) of each run; windows count from the slab's start."""
        n, width = len(body), self.length - self.gram + 1
        none = np.zeros(0, np.int64)
        if n < self.length:
            return none.astype(np.uint64), none, none, none, none.astype(np.uint64), None
        total = self._sums(body)
        h = mix64((total[self.gram :] - total[: -self.gram]) * self.up[: n - self.gram + 1])
        bits = max(24, int(n).bit_length())
        order = ((h >> np.uint64(bits)) << np.uint64(bits)) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while 2 * step <= width:
            order = np.minimum(order[:-step], order[step:])
            step *= 2
        if step < width:
            order = np.minimum(order[: len(order) - (width - step)], order[width - step :])
        at = (order & np.uint64((1 << bits) - 1)).astype(np.int64)  # anchor of the window that starts here
        sizes = np.diff(offsets)
        whole = np.maximum(0, sizes - self.length + 1)
        valid = np.zeros(len(at) + 1, np.int8)
        starts = offsets[:-1][whole > 0]
        np.add.at(valid, starts, 1)
        np.add.at(valid, starts + whole[whole > 0], -1)
        good = np.cumsum(valid[:-1]).astype(bool)
        first = good.copy()
        first[1:] &= ~good[:-1] | (at[1:] != at[:-1])
        begin = np.flatnonzero(first)
        last = good.copy()
        last[:-1] &= ~good[1:] | first[1:]
        count = np.flatnonzero(last) + 1 - begin
        text = np.searchsorted(offsets, begin, side="right") - 1
        end = begin + count - 1 + self.length
        slice_hash = mix64((total[end] - total[begin]) * self.up[begin] + count.astype(np.uint64))
        return h[at[begin]], text, begin, count, slice_hash, total

    def windows(self, total: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return mix64((total[starts + self.length] - total[starts]) * self.up[starts] ^ np.uint64(0x5851F42D4C957F2D))


# ---- suffix sorting


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of text in the order of their suffixes' first `depth` letters at least; equal ones in any order."""
    return np.argsort(_ranks(text.astype(np.int64) + 1, 1, depth), kind="stable")


def _names(*columns: np.ndarray) -> tuple[np.ndarray, int]:
    """Names 1.. in the order of the rows of the columns, whose values are below 2^21 or stand alone."""
    key = columns[0]
    for c in columns[1:]:
        key = _joined(key, c)
    values, name = np.unique(key, return_inverse=True)
    return name.reshape(-1) + 1, len(values)


def _joined(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Pairs as one number in the same order; ranks stand in where numbers would overflow."""
    span = int(low.max(initial=0)) + 1
    if int(high.max(initial=0)) >= (1 << 62) // span:
        high = np.unique(high, return_inverse=True)[1].reshape(-1)
    return high * span + low


def _ranks(t: np.ndarray, covered: int, depth: int) -> np.ndarray:
    """Ranks of all suffixes of t, letters from 1; a letter of t covers so many letters of the text."""
    n = len(t)
    if n < 8:
        order = sorted(range(n), key=lambda i: t[i:].tolist())
        out = np.zeros(n, np.int64)
        out[order] = np.arange(1, n + 1)
        return out
    padded = np.concatenate([t, np.zeros(3, np.int64)])
    ones, twos = np.arange(1, n + 1, 3), np.arange(2, n + 2, 3)  # with one position past the end, so that all meet
    ones, twos = ones[ones <= n], twos[twos <= n]
    sample = np.concatenate([ones, twos])
    name, distinct = _names(padded[sample], padded[sample + 1], padded[np.minimum(sample + 2, n + 2)])
    if distinct < len(sample) and 3 * covered < depth:
        name = _ranks(name, 3 * covered, depth)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = name
    zeros = np.arange(0, n, 3)
    pair = lambda i, top: _two(padded[i], rank[i + 1], top)
    top = int(rank.max()) + 1
    ones, twos = ones[ones < n], twos[twos < n]
    z2, o2 = pair(zeros, top), pair(ones, top)
    both = np.concatenate([zeros, twos])
    threes = _joined(_joined(padded[both], padded[both + 1]), rank[both + 2])
    z3, t3 = threes[: len(zeros)], threes[len(zeros) :]
    by0, by1, by2 = np.argsort(z2, kind="stable"), np.argsort(o2, kind="stable"), np.argsort(t3, kind="stable")
    z2s, o2s, t3s = z2[by0], o2[by1], t3[by2]
    z3s = np.sort(z3)
    # places in the merged order: those ahead in the own class and in each other class
    own12 = np.concatenate([rank[ones], rank[twos]])
    ahead12 = np.empty(len(own12), np.int64)
    ahead12[np.argsort(own12, kind="stable")] = np.arange(len(own12))
    out = np.empty(n, np.int64)
    place0 = np.empty(len(zeros), np.int64)
    place0[by0] = np.arange(len(zeros))
    out[zeros] = place0 + np.searchsorted(o2s, z2, side="left") + np.searchsorted(t3s, z3, side="left")
    out[ones] = ahead12[: len(ones)] + np.searchsorted(z2s, o2, side="right")
    out[twos] = ahead12[len(ones) :] + np.searchsorted(z3s, t3, side="right")
    return out + 1


def _two(high: np.ndarray, low: np.ndarray, span: int) -> np.ndarray:
    return high * np.int64(span) + low


def equal_windows(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in starts, in suffix order; whether each one's window differs from the one before)."""
    rank = np.empty(len(text), np.int64)
    rank[suffix_order(text, length)] = np.arange(len(text))
    order = np.argsort(rank[starts], kind="stable")
    new = np.ones(len(order), bool)
    for a in range(1, len(order), 1 << 18):  # adjacent prefixes
        b = min(len(order), a + (1 << 18))
        left, right = starts[order[a - 1 : b - 1]], starts[order[a:b]]
        same = np.ones(b - a, bool)
        for k in range(0, length, 8):
            span = min(8, length - k)
            for d in range(k, k + span):
                same &= text[left + d] == text[right + d]
        new[a:b] = ~same
    return order, new


# ---- what travels


def _row(columns: dict[str, tuple[list, pa.DataType]]) -> pa.Table:
    return pa.table({k: pa.array(v, t) for k, (v, t) in columns.items()})


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(LAST).to_numpy()


def _same(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One number for a row's id and text."""
    return mix64(doc.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ h.astype(np.int64).view(np.uint64))


def _members(found: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(found), bool)
    at = np.minimum(np.searchsorted(among, found), len(among) - 1)
    return among[at] == found


def _told(notes: pa.Table, kind: int, dtype) -> np.ndarray:
    picked = [b for k, b in zip(notes["kind"].to_pylist(), notes["body"].to_pylist()) if k == kind]
    return np.frombuffer(b"".join(picked), dtype)


def _texts(docs: pa.Table, notes: pa.Table):
    """Doc ids, names and texts of the rows that take part."""
    ids, h = _ids(docs["doc_id"]), docs["h"].to_numpy()
    name = _same(ids, h)
    part = ~_members(name, np.sort(_told(notes, 0, np.uint64)))
    body, offsets = utf8(docs["text"])
    return ids, name, part, body, offsets


def _slabs(anchors: Anchors, part: np.ndarray, body: np.ndarray, offsets: np.ndarray):
    for i, j in slabs(offsets, SLAB):
        key, text, begin, count, h, total = anchors.runs(body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        use = part[i + text] if len(text) else np.zeros(0, bool)
        yield i, int(offsets[i]), key[use], text[use] + i, begin[use], count[use], h[use], total


NOTE = "block int, kind int, body binary"
#: kinds of notes to a block: 0 rows that are copies, 1 shared anchors, 2 shared and hot anchors, 3 marked spans


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, block_bytes: int = BLOCK_BYTES, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_bytes, spans (start, end of each maximal removed run of bytes), kept (the remaining bytes), and the columns
    to carry along, which spares a join by the document."""
    spark = docs.sparkSession
    carried = [F.col(c).alias(f"__{c}") for c in carry]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *carried).withColumn("h", F.xxhash64("text"))
    keyed = written(rows.select("doc_id", "h", F.octet_length("text").alias("n"), F.sha2(F.encode("text", "UTF-8"), 256).alias("sha")), "texts")
    blocks = max(1, -(-(keyed.agg(F.sum("n")).first()[0] or 0) // block_bytes))
    block = F.pmod(F.xxhash64("doc_id", "h"), F.lit(blocks)).cast("int").alias("block")
    last = F.coalesce("doc_id", F.lit(LAST))
    first = keyed.groupBy("sha", "n").agg(F.min(last).alias("first"))
    copies = keyed.where(F.col("n") >= length).join(first, ["sha", "n"]).where(last > F.col("first")).select("doc_id", "h", block)

    def name_copies(key: Key, pdf: pa.Table) -> pa.Table:
        body = _same(_ids(pdf["doc_id"]), pdf["h"].to_numpy()).tobytes()
        return _row({"block": ([key[0].as_py()], pa.int32()), "kind": ([0], pa.int32()), "body": ([body], pa.binary())})

    copied = written(copies.groupBy("block").applyInArrow(name_copies, NOTE), "copies")
    dealt = rows.select(block, "doc_id", "h", "text", *[f"__{c}" for c in carry])

    @lean
    def ask(key: Key, left: pa.Table, notes: pa.Table) -> pa.Table:
        mine = Anchors(length, gram)
        _, name, part, body, offsets = _texts(left, notes)
        keys, of = [], []
        for _, _, key_, text, *_ in _slabs(mine, part, body, offsets):
            keys.append(key_)
            of.append(name[text])
        keys, of = np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(of or [np.zeros(0, np.uint64)])
        order = np.argsort(keys, kind="stable")
        keys, of = keys[order], of[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        start = np.flatnonzero(new)
        # whether two documents of this block share the anchor already
        many = np.minimum.reduceat(of, start) != np.maximum.reduceat(of, start) if len(start) else np.zeros(0, bool)
        keys = keys[start]
        task = (keys % np.uint64(blocks)).astype(np.int64)
        out = {"task": ([], pa.int32()), "block": ([], pa.int32()), "ones": ([], pa.binary()), "twos": ([], pa.binary())}
        for t, pick in _by_task(task):
            ones, twos = keys[pick][~many[pick]], keys[pick][many[pick]]
            for c, x in zip(out, (t, key[0].as_py(), _six(ones), _six(twos))):
                out[c][0].append(x)
        return _row(out)

    @lean
    def answer(pdf: pa.Table) -> pa.Table:
        of = pdf["block"].to_pylist()
        ones, twos = ([_wide(b) for b in pdf[c].to_pylist()] for c in ("ones", "twos"))
        every = np.concatenate([*ones, *twos])
        value, count = np.unique(every, return_counts=True)
        two = np.unique(np.concatenate(twos))
        shared = value[(count > 1) | _members(value, two)]
        heavy = value[count > hot]
        out = {"block": ([], pa.int32()), "kind": ([], pa.int32()), "body": ([], pa.binary())}
        at: dict[int, list[int]] = {}
        for i, b in enumerate(of):
            at.setdefault(b, []).append(i)
        for b, own in sorted(at.items()):
            mine = np.concatenate([x[i] for i in own for x in (ones, twos)])
            mine = mine[_members(mine, shared)]
            of_heavy = _members(mine, heavy)
            for kind, keys in ((1, mine[~of_heavy]), (2, mine[of_heavy])):
                if len(keys):
                    for c, x in zip(out, (b, kind, keys.tobytes())):
                        out[c][0].append(x)
        return _row(out)

    @lean
    def send(key: Key, left: pa.Table, notes: pa.Table) -> pa.Table:
        """Slices of shared anchors, for their tasks, and spans that are marked already."""
        mine = Anchors(length, gram)
        ids, name, part, body, offsets = _texts(left, notes)
        name = name.view(np.int64)
        shared, heavy = np.sort(_told(notes, 1, np.uint64)), np.sort(_told(notes, 2, np.uint64))
        got = []
        for _, base, keys, text, begin, count, h, total in _slabs(mine, part, body, offsets):
            low = keys & np.uint64((1 << 48) - 1)
            a = _members(low, shared)
            got.append((low[a], ids[text[a]], name[text[a]], begin[a] + base - offsets[text[a]], begin[a] + base, count[a], h[a]))
            a = np.flatnonzero(_members(low, heavy))
            if len(a):  # each window on its own, by its own bytes
                many = count[a]
                start = np.repeat(begin[a], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                w, t = mine.windows(total, start), np.repeat(text[a], many)
                got.append((w & np.uint64((1 << 48) - 1), ids[t], name[t], start + base - offsets[t], start + base, np.ones(len(t), np.int64), w))
        keys, doc, row, pos, at, count, h = (np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0, np.uint64),) * 7
        h = _told_apart(keys, doc, h, at, count - 1 + length, body)
        order = np.lexsort((doc, h, keys))
        keys, doc, row, pos, at, count, h = (x[order] for x in (keys, doc, row, pos, at, count, h))
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (h[1:] != h[:-1])
        start = np.flatnonzero(new)
        lead = doc[start][np.cumsum(new) - 1] if len(start) else doc
        out = {"task": ([], pa.int32()), "block": ([], pa.int32()), "facts": ([], pa.binary()), "bytes": ([], pa.binary())}
        # rows of the smallest doc_id travel (its first slice stands for its others too); those of larger ones are marked
        sure = doc > lead
        marks = np.stack([row[sure], pos[sure], pos[sure] + count[sure] - 1 + length]).astype(np.int64) if sure.any() else np.zeros((3, 0), np.int64)
        if marks.size:
            for c, x in zip(out, (key[0].as_py(), key[0].as_py(), _merged(marks).tobytes(), None)):
                out[c][0].append(x)
        go = np.flatnonzero(~sure)
        task = (mix64(keys[go].astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)
        for t, own in _by_task(task):
            pick = go[own]
            size = count[pick] - 1 + length
            index = spread(at[pick], size)
            facts = np.stack([keys[pick].astype(np.int64), doc[pick].astype(np.int64), row[pick].astype(np.int64), pos[pick], count[pick], h[pick].astype(np.uint64).view(np.int64)]).astype(np.int64)
            for c, x in zip(out, (t, key[0].as_py(), facts.tobytes(), body[index].tobytes())):
                out[c][0].append(x)
        return _row(out)

    @lean
    def sort(pdf: pa.Table) -> pa.Table:
        out = {"block": ([], pa.int32()), "kind": ([], pa.int32()), "body": ([], pa.binary())}
        facts, texts, of = [], [], []
        for b, f, t in zip(pdf["block"].to_pylist(), pdf["facts"].to_pylist(), pdf["bytes"].to_pylist()):
            if t is None:  # spans on their way home
                for c, x in zip(out, (b, 3, f)):
                    out[c][0].append(x)
            else:
                facts.append(np.frombuffer(f, np.int64).reshape(6, -1))
                texts.append(np.frombuffer(t, np.uint8))
                of.append(np.full(facts[-1].shape[1], b))
        if facts:
            (key, doc, row, pos, count, h), body, of = np.hstack(facts), np.concatenate(texts), np.concatenate(of)
            for b, marks in _marked(key, doc, row, pos, count, h, body, of, length, Anchors(length, gram)):
                for c, x in zip(out, (b, 3, _merged(marks).tobytes())):
                    out[c][0].append(x)
        return _row(out)

    @lean
    def finish(key: Key, left: pa.Table, notes: pa.Table) -> pa.Table:
        _, name, part, body, offsets = _texts(left, notes)
        marks = [np.frombuffer(b, np.int64).reshape(3, -1) for k, b in zip(notes["kind"].to_pylist(), notes["body"].to_pylist()) if k == 3]
        row, a, z = _merged(np.hstack(marks)) if marks else np.zeros((3, 0), np.int64)
        spans, kept = [], []
        for i, d in enumerate(name.view(np.int64).tolist()):
            text = body[offsets[i] : offsets[i + 1]]
            if not part[i]:
                spans.append([{"start": 0, "end": len(text)}])
                kept.append(b"")
                continue
            lo, hi = np.searchsorted(row, d, "left"), np.searchsorted(row, d, "right")
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(a[lo:hi], z[lo:hi])])
            if lo == hi:
                kept.append(text.tobytes())
            else:
                keep = np.ones(len(text), bool)
                for x, y in zip(a[lo:hi], z[lo:hi]):
                    keep[x:y] = False
                kept.append(text[keep].tobytes())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({**{f"__{c}": left[f"__{c}"] for c in carry}, "doc_id": left["doc_id"], "h": left["h"], "n_bytes": pa.array(np.diff(offsets), pa.int64()), "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.large_binary()).cast(pa.binary())})

    grouped = lambda: dealt.groupBy("block")  # noqa: E731  the same exchange each time, which Spark reuses
    asked = grouped().cogroup(copied.groupBy("block")).applyInArrow(ask, "task int, block int, ones binary, twos binary")
    answers = asked.groupBy("task").applyInArrow(answer, NOTE)
    told = copied.unionByName(answers)
    sent = grouped().cogroup(told.groupBy("block")).applyInArrow(send, "task int, block int, facts binary, bytes binary")
    marked = sent.groupBy("task").applyInArrow(sort, NOTE)
    back = copied.unionByName(marked)
    kinds = "".join(f"`__{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    out = grouped().cogroup(back.groupBy("block")).applyInArrow(finish, kinds + "doc_id long, h long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
    return out.select("doc_id", "n_bytes", "spans", "kept", *[F.col(f"__{c}").alias(c) for c in carry])


def _by_task(task: np.ndarray):
    """(task, places) of those tasks that stand in the array."""
    by = np.argsort(task, kind="stable")
    ends = np.flatnonzero(np.append(task[by][1:] != task[by][:-1], True)) + 1 if len(by) else []
    start = 0
    for end in ends:
        yield int(task[by[start]]), by[start:end]
        start = end


def _told_apart(key: np.ndarray, doc: np.ndarray, h: np.ndarray, at: np.ndarray, size: np.ndarray, body: np.ndarray) -> np.ndarray:
    """h, made another where a slice of equal key and h as one of a smaller document hasn't the same bytes."""
    if not len(h):
        return h
    order = np.lexsort((doc, h, key))
    new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (h[order][1:] != h[order][:-1])])
    lead = order[new][np.cumsum(new) - 1]
    left, right = order[~new], lead[~new]
    same = size[left] == size[right]
    left, right, odd = left[same], right[same], left[~same]
    upto, i = np.cumsum(size[left]), 0
    while i < len(left):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + SLAB, side="right")))
        equal = body[spread(at[left[i:j]], size[left[i:j]])] == body[spread(at[right[i:j]], size[right[i:j]])]
        odd = np.concatenate([odd, left[i:j][~np.logical_and.reduceat(equal, upto[i:j] - size[left[i:j]] - (upto[i - 1] if i else 0))]])
        i = j
    if len(odd):
        h = h.copy()
        h[odd] = (mix64(np.arange(1, len(odd) + 1, dtype=np.uint64)) ^ h[odd].astype(np.int64).view(np.uint64)).astype(h.dtype)
        return _told_apart(key, doc, h, at, size, body)
    return h


def _six(keys: np.ndarray) -> bytes:
    """The lower 48 bits, six bytes each."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _wide(body: bytes) -> np.ndarray:
    out = np.zeros((len(body) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(body, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _merged(marks: np.ndarray) -> np.ndarray:
    """(row, start, end) with those that touch or overlap within a row joined, in order."""
    if not marks.shape[1]:
        return marks
    row, a, z = marks[:, np.lexsort((marks[1], marks[0]))]
    shift = int(z.max()) + 2
    rank = np.concatenate([[0], np.cumsum(row[1:] != row[:-1])])
    far = np.maximum.accumulate(z + rank * shift)
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] + rank[1:] * shift > far[:-1])
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:] - 1, [len(a) - 1]])
    return np.stack([row[begin], a[begin], far[end] - rank[begin] * shift]).astype(np.int64)


def _marked(key, doc, row, pos, count, h, body, of, length: int, mine: Anchors):
    """Spans by block, of rows by their names, of those windows that a smaller doc_id also has."""
    size = count - 1 + length
    at = np.cumsum(size) - size
    h = _told_apart(key, doc, h, at, size, body)
    order = np.lexsort((doc, h, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (h[order][1:] != h[order][:-1])
    group = np.cumsum(new) - 1
    lead = order[new][group]  # of equal slices, one of the smallest doc_id stands for all
    whole = doc[order] > doc[lead]
    marks = [np.stack([of[order][whole], row[order][whole], pos[order][whole], (pos + size)[order][whole]])]
    # anchors with two slices or more that differ
    stay = order[~whole]
    keys = key[stay]
    distinct = np.concatenate([[True], (keys[1:] != keys[:-1])])
    runs = np.flatnonzero(distinct)
    several = np.repeat(np.maximum.reduceat(h[stay], runs) != np.minimum.reduceat(h[stay], runs), np.diff(np.append(runs, len(stay))))
    pick = stay[several]
    for part in _by_key(key[pick], size[pick]):
        marks.append(_sorted_marks(pick[part], doc, row, pos, count, size, at, body, of, length, mine))
    every = np.hstack(marks).astype(np.int64)
    for b in np.unique(every[0]):
        yield int(b), every[1:, every[0] == b]


def _by_key(keys: np.ndarray, sizes: np.ndarray, most: int = SLAB):
    """Slices of the rows, whole keys each and about `most` bytes."""
    if not len(keys):
        return
    run = np.append(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])), len(keys))
    upto = np.concatenate([[0], np.cumsum(sizes)])[run]
    i = 0
    while i < len(run) - 1:
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + most, side="right")) - 1)
        yield slice(run[i], run[j])
        i = j


def _sorted_marks(pick, doc, row, pos, count, size, at, body, of, length: int, mine: Anchors) -> np.ndarray:
    """(block, row, start, end) of the windows of these slices that a smaller doc_id has among them too. Windows whose hash is
    alone have no equal; only slices with others are sorted."""
    none = np.zeros((4, 0), np.int64)
    for again in (False, True):
        text = body[spread(at[pick], size[pick])]
        n = count[pick]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        starts, of_slice = spread(np.cumsum(size[pick]) - size[pick], n), np.repeat(pick, n)
        w = mine.windows(mine._sums(text), starts)
        _, name, times = np.unique(w, return_inverse=True, return_counts=True)
        shared = times[name.reshape(-1)] > 1
        if not shared.any():
            return none
        if not again:
            pick = pick[np.isin(pick, of_slice[shared])]
    inside, starts, of_slice = inside[shared], starts[shared], of_slice[shared]
    rank, fresh = equal_windows(text, starts, length)
    run = np.flatnonzero(fresh)
    docs = doc[of_slice[rank]]
    least = np.repeat(np.minimum.reduceat(docs, run), np.diff(np.append(run, len(docs))))
    w = rank[docs > least]
    begin = pos[of_slice[w]] + inside[w]
    return np.stack([of[of_slice[w]], row[of_slice[w]], begin, begin + length])


def readable(kept: str):
    """The bytes as text, without those that a cut through a character left."""

    @F.pandas_udf("string")
    def decode(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: b.decode("utf-8", "ignore"))

    return decode(kept)
