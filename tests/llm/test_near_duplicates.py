import random
import re
from collections import defaultdict

import numpy as np
import pytest

from grainmill.llm import neardup

from . import cases


def brute(rows, words, percent):
    sets = {}
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        sets[r[0]] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def result(df, words):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df, words, 80).collect()}


def test_cases(spark):
    for words in (4, 5):
        assert result(cases.docs(spark, extra=True), words) == brute(cases.rows(), words, 80)


def test_group_of_near_copies(spark):
    """Many copies whose similarities lie about the threshold: components must be those of all pairs."""
    r, base = random.Random(5), cases.prose(9, 80).split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randint(1, 5)):
            w[r.randrange(len(w))] = f"w{r.randrange(999)}"
        rows.append((i, " ".join(w), "en", "a", 0))
    df = spark.createDataFrame(rows, cases.DOCS)
    assert result(df, 4) == brute(rows, 4, 80)


def test_blocks_and_rounds(spark, monkeypatch):
    """The same with blocks and tasks of a few members, so that replicas meet and links come from many tasks."""
    monkeypatch.setattr(neardup, "BLOCK", 16 * 900)
    monkeypatch.setattr(neardup, "TASK", 1 << 12)
    monkeypatch.setattr(neardup, "PAIRS", 40)
    test_group_of_near_copies(spark)


def test_empty_and_repeated(spark):
    assert neardup.near_duplicates(cases.empty(spark)).collect() == []
    out = neardup.near_duplicates(cases.repeated(spark), 4).collect()
    assert len(out) == len(cases.rows()) + 3
    assert {r.component_id for r in out if r.doc_id == 3} == {1}


def test_sketch_likelihood():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    one, two = np.sort(np.concatenate([common, a])), np.sort(np.concatenate([common, b]))
    regs = neardup.registers(np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)]))
    good, like = neardup.may_reach(regs[:1], regs[1:], np.array([900]), np.array([900]), 0.8)
    assert good[0] and abs(like[0] - 0.8) < 0.15
    other = neardup.registers(np.sort(rng.integers(0, 2**63, 900, dtype=np.uint64)), np.array([0, 900]))
    assert not neardup.may_reach(regs[:1], other, np.array([900]), np.array([900]), 0.8)[0][0]
    # mergeable: the registers of a union are the larger ones
    union = np.unique(np.concatenate([one, two]))
    assert (neardup.registers(union, np.array([0, len(union)]))[0] == np.maximum(regs[0], regs[1])).all()


@pytest.mark.parametrize("n", [1, 7, 60])
def test_components(spark, n):
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1002)]
    got = {r.node: r.comp for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = defaultdict(int, {i: 0 for i in range(n + 1)}) | {1000: 1000, 1001: 1000, 1002: 1000}
    assert got == dict(want)


def test_edges_of_a_task_are_contracted_at_once(spark, monkeypatch):
    """A chain in one task takes one table; dealt in small parts over tasks it takes rounds, with the same result."""
    made = []
    monkeypatch.setattr(neardup, "written", lambda df, name, f=neardup.written: made.append(name) or f(df, name))
    test_components(spark, 300)
    assert made == ["edges"]
    monkeypatch.setattr(neardup, "EDGES", 16)
    test_components(spark, 300)
    assert len(made) > 2


@pytest.mark.parametrize("nodes", [40, 400, 4000])
def test_least_of_random_edges(nodes):
    r = np.random.default_rng(nodes)
    a, b = r.integers(-nodes, nodes, (2, nodes))
    label = {int(x): int(x) for x in np.concatenate([a, b])}
    while any(label[x] != label[y] for x, y in zip(a.tolist(), b.tolist())):
        for x, y in zip(a.tolist(), b.tolist()):
            label[x] = label[y] = min(label[x], label[y])
    up, least = neardup._least(a, b)
    assert dict(zip(up.tolist(), least.tolist())) == {x: y for x, y in label.items() if x != y}


def test_near_copies_without_an_id_are_linked(spark):
    base = cases.prose(1, 120).split()
    near = [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in (30, 60, 90)]
    rows = [(3, " ".join(base), "en", "a", 0), (None, near[0], "en", "a", 0), (None, near[1], "en", "a", 0), (4, near[2], "en", "a", 0), (None, cases.prose(77, 90), "en", "a", 0)]
    got = [(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(spark.createDataFrame(rows, cases.DOCS), 4, 80).collect()]
    assert sorted(got, key=repr) == sorted([(3, 3, True), (None, 3, False), (None, 3, False), (4, 3, False), (None, None, True)], key=repr)


def test_blocks_return_forests(spark, monkeypatch):
    """However many pairs there are, a block returns fewer links than it has members."""
    made = {}
    monkeypatch.setattr(neardup, "written", lambda df, name, f=neardup.written: made.setdefault(name, []).append(f(df, name)) or made[name][-1])
    counts = []
    monkeypatch.setattr(neardup, "_linked", lambda *a, f=neardup._linked: counts.append(f(*a).count()) or f(*a))
    test_group_of_near_copies(spark)
    assert counts and counts[0] < 150 * 8


def test_short_texts_share_no_bands():
    """One-word texts: registers of different elements differ."""
    regs = neardup.registers(neardup.mix64(np.arange(1, 200, dtype=np.uint64)), np.arange(200))
    bands = regs.view("<u8")
    for k in range(neardup.BANDS):
        assert len(np.unique(bands[:, k])) >= 198
