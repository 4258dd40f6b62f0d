"""Exact values, anchors and invariants on hand-made tables."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from grainmill.functions import parse, text as t
from grainmill.operators import audits as a, lineage as g, matrix as m, shingles as s, signatures, stages, vectors as v
from grainmill.sources import files
from grainmill.streaming.keepfirst import KeepFirst


def values(spark, texts, f):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [r.y for r in df.select("i", f("x").alias("y")).orderBy("i").collect()]


def test_truncation(spark):
    texts = ["One. Two three four. Five", 'He said "so."', "Short. " + "x" * 40, "  ", "Done.\n---\n", "A\n\n---", None]
    assert values(spark, texts, t.trim_unfinished)[:4] == ["One. Two three four.", 'He said "so."', "Short. " + "x" * 40, ""]
    assert values(spark, texts, t.ends_mid_sentence) == [True, False, True, False, False, True, False]
    assert values(spark, texts, t.has_trailing_separator) == [False, False, False, False, True, True, False]


def test_words_and_tags(spark):
    assert values(spark, ["Héllo, it's 日本"], t.words) == [["héllo", "it's", "日本"]]
    assert values(spark, ["<a> x </a><a>y</a>", "<a></a>", "<b>x</b>"], lambda x: t.tag(x, "a")) == ["x", None, None]
    assert values(spark, ["{a} {b} {a}"], t.placeholders) == [["a", "b"]]
    assert values(spark, ["What now? Go.", "# **Head** one", ""], t.first_chat_sentence) == ["What now?", "Head one", ""]


def docs(spark, texts):
    return spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")


TEXTS = ["the cat sat on the mat by the door of the old house", "the cat sat on the mat by the door of the old house!", "an entirely different text about rivers and stones", "rivers run deep", ""]


def test_greedy_filter(spark):
    d = docs(spark, TEXTS)
    got = {r.doc_id: r.kept_id for r in signatures.keep_first(s.packed(d), d, 0.9).collect()}
    assert got == {0: None, 1: 0, 2: None, 3: None, 4: None}


def test_edges_and_greedy_against_brute_force(spark):
    r = random.Random(4)
    texts = []
    for _ in range(60):
        base = r.choice(texts).split() if texts and r.random() < 0.6 else [r.choice("abcdefghij") * r.randint(1, 3) for _ in range(30)]
        base[r.randrange(len(base))] = "z"
        texts.append(" ".join(base))
    d = docs(spark, texts)
    w = {}
    for row in s.vectors(d).collect():
        w.setdefault(row.doc_id, {})[row.bucket] = row.w
    sim = {(i, j): sum(x * w[j].get(b, 0) for b, x in w[i].items()) for i in w for j in w if i < j}
    got = {(e.i, e.j): e.sim for e in signatures.edges(s.packed(d), 0.7).collect()}
    assert got == pytest.approx({k: x for k, x in sim.items() if x >= 0.7})
    kept, want = [], {}
    for j in range(60):
        best = max(((round(sim[i, j], 12), -i) for i in kept), default=(0, 0))
        want[j] = -best[1] if best[0] >= 0.7 else None
        if want[j] is None:
            kept.append(j)
    assert {x.doc_id: x.kept_id for x in signatures.keep_first(s.packed(d), d, 0.7).collect()} == want


def test_large_buckets_and_copies_against_brute_force(spark, monkeypatch):
    """Groups of near copies and of copies, with buckets of any size taken as large ones."""
    monkeypatch.setattr(signatures, "FEW", 3)
    r, texts = random.Random(7), []
    for group in range(4):
        base = [r.choice("abcdefghij") * r.randint(1, 4) for _ in range(40)]
        for k in range(18):
            words = list(base)
            for _ in range(r.choice((0, 0, 1, 2, 4))):
                words[r.randrange(40)] = f"z{r.randrange(3)}"
            texts.append(" ".join(words))
    r.shuffle(texts)
    d = docs(spark, texts)
    w = {row.doc_id: dict(zip(row.b, row.w)) for row in s.packed(d).collect()}
    sim = {(i, j): sum(x * w[j].get(b, 0) for b, x in w[i].items()) for i in w for j in w if i < j}
    kept, want = [], {}
    for j in range(len(texts)):
        best = max(((round(sim[i, j], 12), -i) for i in kept), default=(0, 0))
        want[j] = -best[1] if best[0] >= 0.9 else None
        if want[j] is None:
            kept.append(j)
    assert {x.doc_id: x.kept_id for x in signatures.keep_first(s.packed(d), d, 0.9).collect()} == want
    got = {(e.i, e.j) for e in signatures.edges(s.packed(d), 0.9).collect()}
    assert got == {p for p, x in sim.items() if x >= 0.9}


@pytest.mark.parametrize("t", [0.7, 0.8, 0.9, 0.95])
@pytest.mark.parametrize("n", [1, 1000, 10**6, 10**9])
def test_bands_hardly_miss(n, t):
    width, bands = signatures.plan(n, t)
    assert width * bands <= s.DIM - signatures.SKETCH
    assert (1 - signatures.agreement(t) ** width) ** bands < 1e-6


def test_signs_agree_as_often_as_angles_say():
    import numpy as np

    r, dim = np.random.default_rng(3), s.DIM
    for cos in (0.0, 0.5, 0.9, 0.98):
        for size in (2, 50, 3000):
            a, b = r.standard_normal((2, size))
            b -= a * (a @ b) / (a @ a)
            a, b = a / np.linalg.norm(a), b / np.linalg.norm(b)
            at = r.choice(dim, size, replace=False)
            up = signatures._projected([(at, a), (at, cos * a + math.sqrt(1 - cos * cos) * b)])
            assert (up[0] == up[1]).mean() == pytest.approx(signatures.agreement(cos), abs=0.025)


def test_incremental_filter_equals_the_whole(spark, tmp_path):
    keep = KeepFirst(spark, f"file://{tmp_path}/kept")
    d = docs(spark, [*TEXTS, TEXTS[2] + ".", TEXTS[0]])
    for n, (lo, hi) in enumerate([(0, 2), (2, 5), (5, 9)]):
        for _ in range(2):  # a batch that runs twice changes nothing
            keep(d.where((F.col("doc_id") >= lo) & (F.col("doc_id") < hi)), n)
    assert [(r["batch"], r["rows"]) for r in keep.report[::2]] == [(0, 2), (1, 3), (2, 2)]
    whole = {r.doc_id for r in signatures.keep_first(s.packed(d), d, 0.9).where("kept_id is null").collect()}
    assert {r.doc_id for r in keep.kept().collect()} == whole == {0, 2, 3, 4}


def test_distinct_n_and_self_bleu(spark):
    d = {r.n_words: r.distinct_n for r in a.distinct_n(docs(spark, ["a b a b"])).collect()}
    assert d[1] == 0.5 and d[2] == pytest.approx(2 / 3)
    assert {r.n_words: r.distinct_n for r in a.distinct_n(docs(spark, ["a b", "a b"])).collect()}[1] == 0.5
    same = a.self_bleu(docs(spark, ["one two three four five"] * 3), "doc_id").collect()
    assert all(r.bleu == pytest.approx(1.0) for r in same)
    apart = a.self_bleu(docs(spark, ["a b c d e", "f g h i j", "k l m n o"]), "doc_id").collect()
    assert sum(r.bleu for r in apart) / 3 < 0.05


def test_vector_anchors(spark):
    def of(rows):
        return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")

    eye = of([[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]])
    assert v.vendi(eye) == pytest.approx(4) and v.vendi(of([[1, 2]] * 3)) == pytest.approx(1) and v.vendi(of([[1, 0], [1, 0], [0, 1], [0, 1]])) == pytest.approx(2)
    assert v.mean_cosine(eye).first().mean_cosine == pytest.approx(0) and v.mean_cosine(of([[1, 2]] * 3)).first().mean_cosine == pytest.approx(1)
    assert v.mean_cosine(of([[1, 2]])).first().mean_cosine is None
    assert {r.vec_id: r.nn for r in v.neighbours(of([[1, 0], [0, 1], [1, 0.1]]), "vec_id", rows=1).collect()} == {0: 2, 1: 2, 2: 0}


def test_stride(spark):
    d = docs(spark, ["x"] * 23)
    assert [r.doc_id for r in s.stride(d, 10).orderBy("doc_id").collect()] == [int(i * 23 / 10) for i in range(10)]
    assert s.stride(d, 23).count() == 23


def test_matrix(spark):
    axes = m.axes(spark, "{a}\n  0.25 :: x\n  0.75 :: y\n{b}\n  p\n  q\n  r\n")
    quota = {(r.axis, r.value): r.quota for r in m.quotas(axes, 10).collect()}
    assert quota == {("a", "x"): 3, ("a", "y"): 7, ("b", "p"): 4, ("b", "q"): 3, ("b", "r"): 3}
    one, two = (sorted(map(tuple, m.decks(axes, 10, 3).select("slot", "axis", "value").collect())) for _ in range(2))
    assert one == two
    for bad in ("  x", "{a}\n  0.5 :: x\n  y", "{a}\n  0.5 :: x", "{a}\n x\n{a}\n y"):
        with pytest.raises(ValueError):
            m.parse_axes(bad)
    with pytest.raises(KeyError, match="missing"):
        m.render(m.deal(axes, 2, 1), "{a} {missing}", ["a", "b"])


def test_reservation_keeps_marginals(spark):
    axes = m.axes(spark, "{a}\n  x\n  y\n  z\n{b}\n  p\n  q\n")
    deals = m.deal(axes, 40, 5)
    out = m.reserve(deals, [("one", 0.1, {"a": "x", "b": "q"}), ("two", 0.05, {"a": "nowhere"})], 5)
    rows = out.collect()
    count = lambda rs, axis: sorted((v_, sum(r.variables[axis] == v_ for r in rs)) for v_ in {r.variables[axis] for r in rs})
    assert sum(r.archetype == "one" for r in rows) == 4 and all(r.variables["a"] == "x" and r.variables["b"] == "q" for r in rows if r.archetype == "one")
    assert count(rows, "b") == count(deals.collect(), "b")
    assert all(r.overwritten == ["a"] for r in rows if r.archetype == "two")


def test_json(spark):
    cases = ['so {"a": [1, 2]} ok', "[1, 2] and {\"b\": 1, \"c\": 22222}", '{"a": {"b": 1}', "none", None, '{"x": "line\nbreak"}']
    assert values(spark, cases, parse.extract_json) == ['{"a": [1, 2]}', '{"b": 1, "c": 22222}', None, None, None, '{"x": "line\nbreak"}']
    assert parse.salvage('[{"a": "}"}, {"b": 2}, {"c": ') == ['{"a": "}"}', '{"b": 2}']
    df = spark.createDataFrame([("a b c", "a x c")], "a string, b string")
    assert df.select(parse.word_diff("a", "b").alias("d")).first().d == "a <del>b</del> <ins>x</ins> c"


def test_stage_resumes_without_calls(spark, tmp_path):
    prompts = spark.createDataFrame([(i, f"prompt {i}") for i in range(12)], "id long, prompt string")
    go = lambda client: stages.run(prompts, "id", client, f"file://{tmp_path}/answers", lambda x: t.tag(x, "document"))
    good, bad, calls = go(stages.StubClient(3))
    failed = bad.count()
    assert calls == 12 and good.count() + failed == 12 and failed
    good, bad, calls = go(stages.StubClient())
    assert calls == failed and good.count() == 12 and bad.count() == 0
    assert go(stages.StubClient())[2] == 0


def test_registry(spark):
    reg = spark.createDataFrame([("p", "f1", 4)], "kind string, fingerprint string, num long")
    found = spark.createDataFrame([("p", "f2", 3), ("p", "f1", 1), ("p", "f3", 2), ("p", "f2", 9), ("q", "f1", 5)], "kind string, fingerprint string, pos long")
    assert {(r.kind, r.fingerprint): r.num for r in g.assigned(reg, found).collect()} == {("p", "f1"): 4, ("p", "f3"): 5, ("p", "f2"): 6, ("q", "f1"): 1}


def test_effective_number(spark):
    df = spark.createDataFrame([("a", 40), *[(str(i), 10) for i in range(6)]], "k string, n long")
    p = [0.4] + [0.1] * 6
    assert a.effective_number(df).first().effective == pytest.approx(math.exp(-sum(x * math.log(x) for x in p)))


def test_files(spark, tmp_path):
    path = f"file://{tmp_path}/x"
    assert files.load_jsonl(spark, path, "a long").count() == 0
    files.save_jsonl(spark.createDataFrame([(1, None), (2, "é")], "a long, b string"), path)
    assert {(r.a, r.b) for r in files.load_jsonl(spark, path, "a long, b string").collect()} == {(1, None), (2, "é")}
    assert files.run_id({"2026-01-01_00-00_x", "2026-01-01_00-00_x-2"}, "2026-01-01_00-00", "x") == "2026-01-01_00-00_x-3"


def test_formatted_ids_are_those_of_the_sql_from_ten_thousand_on(spark, monkeypatch):
    import duckdb

    from grainmill.plans import lineage

    nums = [1, 42, 9999, 10000, 123456]
    monkeypatch.setattr(lineage, "_registry", lambda spark, sf_dir: spark.createDataFrame([("doc", f"f{n}", n) for n in nums], "kind string, fingerprint string, num long"))
    got = {r.fingerprint: r.gid for r in lineage.i03_formatted_id(spark, "").collect()}
    assert got == {f"f{n}": duckdb.sql(f"SELECT 'P-' || lpad({n}::VARCHAR, 4, '0')").fetchall()[0][0] for n in nums}
    assert spark.createDataFrame([(10000,)], "n long").select(g.formatted_id("P", F.col("n"))).first()[0] == "P-10000"  # the operator cuts none


def test_unlinked_members_of_large_buckets_take_few_rounds(spark, monkeypatch):
    """Texts that are alike but not linked: rounds grow with the logarithm of a bucket's size."""
    monkeypatch.setattr(signatures, "FEW", 3)
    rounds, confirmed = [], signatures.Classes.confirmed
    monkeypatch.setattr(signatures.Classes, "confirmed", lambda *a: (rounds.append(1), confirmed(*a))[1])
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join([*base, *[f"c{k}x{i}" for i in range(12)]]) for k in range(48)]
    d = docs(spark, texts)
    assert signatures.keep_first(s.packed(d), d, 0.9).where("kept_id is null").count() == 48
    assert len(rounds) <= 5


def test_shingles_are_counted_without_a_shuffle(spark):
    d = docs(spark, ["a b c d", "a a a a a", "one", "", None, "x y x y x y x"])
    out = s.counted(d)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: (r.n, r.n_distinct) for r in out.collect()} == {0: (2, 2), 1: (3, 1), 2: (1, 1), 5: (5, 2)}
