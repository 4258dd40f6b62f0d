import hashlib
import random

import numpy as np
from hypothesis import given, settings, strategies as st

from grainmill.llm import suffixes

from . import cases


def brute(rows, length=50):
    first, out = {}, {}
    big = (1 << 63) - 1
    for i, text in sorted(((big if r[0] is None else r[0]), r[1] or "") for r in rows):
        b = text.encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if first.setdefault(b[k : k + length], i) < i:
                gone[k : k + length] = True
        out.setdefault(i, []).append((len(b), int(gone.sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return {k: sorted(v) for k, v in out.items()}


def result(df, **options):
    out = {}
    for r in suffixes.repeats(df, **options).collect():
        gone = sum(s.end - s.start for s in r.spans)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
        out.setdefault((1 << 63) - 1 if r.doc_id is None else r.doc_id, []).append((r.n_bytes, gone, bytes(r.kept)))
    return {k: sorted(v) for k, v in out.items()}


def test_cases(spark):
    assert result(cases.docs(spark, extra=True)) == brute(cases.rows())


def passages():
    r = random.Random(3)
    parts = [cases.prose(200 + i, 25) for i in range(6)]
    rows = []
    for i in range(60):
        text = " ".join(r.choice(parts)[r.randint(0, 40) :] if r.random() < 0.5 else cases.prose(1000 * i + k, 15) for k in range(6))
        rows.append((i, text, "en", "a", 0))
    return rows


def test_shared_passages_in_many_blocks(spark):
    rows = passages()
    df = spark.createDataFrame(rows, cases.DOCS)
    assert result(df, block_bytes=2000) == brute(rows)


def test_hot_anchors(spark):
    """Anchors that more than one block shares go the way of hot ones."""
    rows = passages()
    assert result(spark.createDataFrame(rows, cases.DOCS), block_bytes=2000, hot=1) == brute(rows)


def test_empty_and_repeated(spark):
    assert suffixes.repeats(cases.empty(spark)).collect() == []
    df = cases.repeated(spark)
    rows = [tuple(r) for r in df.collect()]
    assert result(df) == brute(rows)


def test_rows_of_one_id_have_their_own_spans(spark):
    """Of rows that share an id, or have none, only those that hold the passage lose it."""
    base = cases.prose(1, 120)
    long = [cases.prose(700 + i, 150) for i in range(6)]
    rows = [(1, base, "en", "a", 0)] + [(i, text, "en", "a", 0) for i, text in ((7, long[0] + base[:300]), (7, long[1]), (7, base[100:400] + long[2]), (7, "short"), (None, base[:200] + long[3]), (None, long[4]), (None, long[5][:90] + base[60:]))]
    for options in ({}, {"block_bytes": 500}, {"block_bytes": 500, "hot": 1}):
        assert result(spark.createDataFrame(rows, cases.DOCS), **options) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=300), st.sampled_from([3, 9, 50]))
def test_suffix_order(letters, depth):
    text = np.array(letters, np.uint8)
    order = suffixes.suffix_order(text, depth)
    assert sorted(order.tolist()) == list(range(len(text)))
    cut = [bytes(letters[i : i + depth]) for i in order]
    assert cut == sorted(cut)


def test_digest_of_the_query(spark):
    rows = [(1, "x" * 49, "en", "a", 0), (2, "y" * 60, "en", "a", 0), (3, "z" + "y" * 60, "en", "a", 0)]
    got = {r.doc_id: bytes(r.kept) for r in suffixes.repeats(spark.createDataFrame(rows, cases.DOCS)).collect()}
    assert got == {1: b"x" * 49, 2: b"y" * 60, 3: b"z"}
    assert hashlib.sha256(got[3]).hexdigest() == hashlib.sha256(b"z").hexdigest()
