import base64
import gzip
import hashlib
import io
import json
import math
import random
import struct
import zipfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grainmill.llm import fingerprints, mixing, packing, sharding, topk, toxicity, url_filter, warc
from grainmill.llm.queries import QUERIES, URL_RULES

from . import cases

# ---- 1 URL filters

URLS = [
    "http://Example.COM/en/a?x#y", "https://www.example.com/en/b", "ftp://a.b.example.com/de/", "x://net/es/", "http://sub.net/fr/q", "http://net.example.org/fr/", "http://notexample.com/en/", "no scheme", "", None,
    "http://com", "http://com/", "http://example.com?u=://x/", "http://u@example.com:80/en/", "http://", "://x.com/y", "http://ex%20ample.com/en/\n/z",
]


def brute_rule(url):
    rest = (url or "").partition("://")[2]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else "allow"


@pytest.mark.parametrize("most", [0, 100])
def test_url_filter(spark, most, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", most)
    df = spark.createDataFrame([(i, u, "kept") for i, u in enumerate([*URLS, *URLS[:3]])], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, URL_RULES).collect()}
    assert got == {i: brute_rule(u) for i, u in enumerate([*URLS, *URLS[:3]])}
    assert url_filter.judge(df.limit(0), URL_RULES).collect() == []


def test_long_urls_and_no_rules(spark):
    long = "http://a.example.com/en/" + "x/" * 200_000
    df = spark.createDataFrame([(1, long), (1, long)], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in url_filter.judge(df, URL_RULES).collect()] == [("example.com/en/", "block")] * 2
    assert [(r.rule, r.verdict) for r in url_filter.judge(df, []).collect()] == [(None, "allow")] * 2


def test_url_rules_are_filed_by_their_rarest_token():
    rules = [url_filter.parse(x, "block") for x in ("ads.com/a/", "ads.com/b/", "x.com/a/", "/any")]
    filed = url_filter.index(rules)
    assert {t: sorted(r.text for r in rs) for t, rs in filed.items()} == {"b": ["ads.com/b/"], "x": ["x.com/a/"], "ads": ["ads.com/a/"], None: ["/any"]}


# ---- 2 mixing


def test_mixing(spark):
    for df in (cases.docs(spark, extra=True), cases.repeated(spark)):
        rows = mixing.mix(df).collect()
        assert len(rows) == df.count()
        per = {}
        for r in rows:
            assert r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
            s = per.setdefault(r.source, [0, 0, r.source_size, r.target])
            s[0] += r["size"]
            s[1] += r.taken
        total = sum(s[0] for s in per.values())
        assert sum(s[3] for s in per.values()) == pytest.approx(total)
        for size, taken, source_size, target in per.values():
            assert size == source_size and target <= 3 * size + 1e-9
    again = [sorted(mixing.mix(cases.docs(spark)).select("doc_id", "taken").collect()) for _ in range(2)]
    assert again[0] == again[1]
    assert mixing.mix(cases.empty(spark)).collect() == []


def test_mixing_comes_near_its_targets(spark):
    r = random.Random(1)
    rows = [(i, cases.prose(i, int(r.paretovariate(1.2) * 8) % 900 + 1), "en", f"s{i % 7 if i % 3 else 0}", 0) for i in range(900)]
    out = mixing.mix(spark.createDataFrame(rows, cases.DOCS)).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w")).collect()
    assert all(abs(r.t - r.w) <= max(3, 0.005 * r.w) for r in out)
    copies = mixing.mixed(spark.createDataFrame(rows, cases.DOCS))
    assert copies.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def brute_mix(rows, weights, cap=3.0):
    """rows: (doc_id, source, size, u, h) -> (wanted, copies) of each, one document after the other."""
    from collections import defaultdict

    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    total, sizes = sum(r[2] for r in rows), {s: sum(r[2] for r in by[s]) for s in by}
    goal, open_, left = {}, {s: weights[k % len(weights)] for k, s in enumerate(order)}, float(total)
    while open_:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if level * w > cap * sizes[s]]
        goal |= {s: cap * sizes[s] for s in full} or {s: level * w for s, w in open_.items()}
        left -= sum(goal[s] for s in full)
        open_ = {s: w for s, w in open_.items() if s not in goal}
    out = {}
    for s, own in by.items():
        w = [2 ** (math.floor(8 * math.log2(max(r[2], 1) ** mixing.LEAN) + 0.5) / 8) for r in own]
        lo, hi = 0.0, 1e9
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if sum(min(cap, mid * x) * r[2] for x, r in zip(w, own)) < goal[s] else (lo, mid)
        c = [min(cap, hi * x) if goal[s] < cap * sizes[s] - 1e-6 else cap for x in w] if sizes[s] else [0.0] * len(own)
        whole = [math.floor(x + 1e-9) for x in c]
        more, carry = [0] * len(own), 0.0
        pool = [i for i, r in enumerate(own) if r[2] and c[i] - whole[i] > 1e-8]
        for o in sorted({own[i][2].bit_length() for i in pool}, reverse=True):
            mine = [i for i in pool if own[i][2].bit_length() == o]
            p = {i: c[i] - whole[i] for i in mine}
            owed, got = carry + sum(p[i] * own[i][2] for i in mine), 0
            for i in sorted(mine, key=lambda i: (own[i][3] / (1 - own[i][3]) / (p[i] / (1 - p[i])), own[i][0])):
                if 2 * (owed - got) <= own[i][2]:
                    break
                more[i], got = 1, got + own[i][2]
            carry = owed - got
        for i, r in enumerate(own):
            out[r[0]] = (c[i], whole[i] + more[i])
    return out


def test_mixing_is_the_brute_force_one(spark):
    r = random.Random(3)
    rows = [(i, " ".join(["w"] * int(r.lognormvariate(3, 1.2))), "en", None if i % 11 == 0 else f"s{i % 5 if i % 2 else 0}", 0) for i in range(1500)]
    for weights in ((5, 2, 1), (1, 30)):
        out = mixing.copies(spark.createDataFrame(rows, cases.DOCS), weights).collect()
        want = brute_mix([(x.doc_id, x.source, x["size"], x.u, x.h) for x in out], weights)
        assert {x.doc_id: x.copies for x in out} == {k: v[1] for k, v in want.items()}
        assert all(x.wanted == pytest.approx(want[x.doc_id][0], abs=1e-6) for x in out)
        assert len({round(x.wanted, 6) for x in out}) > 20  # unequal probabilities


def test_inclusion_is_as_likely_as_wanted(spark):
    """Over many seeds, documents are taken as often as they are wanted, long ones and short ones."""
    r = random.Random(4)
    rows = [(i, " ".join(["w"] * (3 + i % 40)), "en", "ab"[i % 7 == 0], 0) for i in range(300)]
    df = spark.createDataFrame(rows, cases.DOCS).cache()
    wanted, taken = {}, {}
    for seed in range(25):
        for x in mixing.copies(df, (1, 2), seed=seed).collect():
            key = (x.source, x["size"].bit_length())
            wanted[key] = wanted.get(key, 0) + x.wanted
            taken[key] = taken.get(key, 0) + x.copies
    assert all(abs(taken[k] - wanted[k]) <= 0.06 * wanted[k] + 12 for k in wanted), (wanted, taken)


def test_only_a_few_bins_are_read_row_by_row(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(mixing, "written", lambda df, name, f=mixing.written: made.setdefault(name, f(df, name)))
    one = [(i, f"w{i}", "en", "a", 0) for i in range(3000)]
    for rows, most in ((one, 0), ([*one, (5000, "only", "en", "b", 0)], 12)):  # nothing owed; all but two words of 3000 owed
        made.clear()
        out = mixing.copies(spark.createDataFrame(rows, cases.DOCS), weights=(1, 5)).collect()
        assert sum(r.taken for r in out) == len(rows)
        assert made["mix-bins"].where("role = 'cut'").count() <= most
        assert sum(r.taken for r in out if r.source == "a") == (3000 if len(rows) == 3000 else 2998)


def test_targets_are_levelled(spark):
    df = spark.createDataFrame([("a", 100), ("b", 1), ("c", 50), (None, 49)], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want, left, open_ = {}, 200.0, {"a": (300.0, 5), "b": (3.0, 2), "c": (150.0, 1), None: (147.0, 5)}
    while True:  # share by weight, cap, share the excess again
        level = left / sum(w for _, w in open_.values())
        full = {k: m for k, (m, w) in open_.items() if level * w > m}
        if not full:
            want |= {k: level * w for k, (_, w) in open_.items()}
            break
        want |= full
        left -= sum(full.values())
        open_ = {k: v for k, v in open_.items() if k not in full}
    assert got == pytest.approx(want)


# ---- 5 packing


def test_tokens_are_the_tokenizers():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.default_vocabulary())
    words = packing.WordIds(packing.default_vocabulary())
    odd = ["It's We'LL don't ", "ÀÉÎ ñandú Straße ŒUVRE", "a\x1cb\x1dc", "İstanbul ΑΣ ΟΔΟΣ", "日本語 テスト", "e\u0301 o\u0308", "1234 ½ ² %%% --- a_b", "\u2003x\u00a0y\u0085z", "😀👍 ok", "ﬁ ﬂ", "x" * 3000, "ſ ŉ Ÿ", "'''s 'T 'rE", "a\u200bb", "\ufeffx"]
    for text in [*odd, *(cases.prose(i, 60).title() for i in range(30)), " ".join(odd)]:
        assert np.frombuffer(words.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_merges_by_ranks_are_the_librarys(monkeypatch):
    """A release of the library without the call that merges one word."""
    import tiktoken

    texts = [cases.prose(i, 40).title() for i in range(5)] + ["ünïcödé straße naïve", "a b c", "supercalifragilistic!"]
    want = [packing.WordIds(packing.default_vocabulary()).of(t) for t in texts]
    monkeypatch.delattr(tiktoken.Encoding, "_encode_single_piece")
    assert [packing.WordIds(packing.default_vocabulary()).of(t) for t in texts] == want


def test_added_tokens_are_found(tmp_path):
    from tokenizers import AddedToken, Tokenizer

    whole = Tokenizer.from_file(packing.default_vocabulary())
    words = packing.WordIds(packing.default_vocabulary())
    texts = ["end of <|endoftext|> here", "a<|startoftext|>b<|endoftext|>", "é<|endoftext|>é", "<|ENDOFTEXT|> <|end oftext|>", "日本<|endoftext|>", "<|endoftext|>\n<|endoftext|> It's"]
    for text in texts:
        assert np.frombuffer(words.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text
    assert 49407 in np.frombuffer(words.of(texts[0]), "<u4")
    whole.add_tokens([AddedToken("two words", normalized=True), AddedToken("<X>", normalized=False, lstrip=True, rstrip=True)])
    whole.save(path := str(tmp_path / "more.json"))
    words = packing.WordIds(path)
    for text in [*texts, "my Two \t words are", "a <X> b", "a<X>b<x>"]:
        assert np.frombuffer(words.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("length", [4096, 64])
def test_packing(spark, length):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.default_vocabulary())
    rows = packing.pack(cases.docs(spark, extra=True), length=length).collect()
    ids = {r[0]: whole.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in cases.rows()}
    by, bins = {}, {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r["length"]]
        assert r.start == length * r.piece and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        by[r.doc_id] = by.get(r.doc_id, 0) + r["length"]
        bins.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    assert by == {k: len(v) for k, v in ids.items()}
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= length
    assert len(bins) <= -(-sum(by.values()) // length) + 1
    assert packing.pack(cases.empty(spark)).collect() == []
    assert packing.pack(cases.repeated(spark)).count() == packing.pack(cases.docs(spark)).count() + 3


def test_search_empties_bins():
    sizes = np.array([6, 5, 5, 4, 3, 3, 2, 2])
    held = packing.search(sizes, [[0, 4], [1, 5], [2, 6], [3, 7]], 10)
    left = [b for b in held.bins if b]
    assert len(left) == 3 and sorted(i for b in left for i in b) == list(range(8))
    r = random.Random(2)
    for _ in range(50):
        sizes = np.array([r.randint(1, 40) for _ in range(60)])
        start = packing.next_fit(sizes, 50)
        held = packing.search(sizes, start, 50)
        out = [b for b in held.bins if b]
        assert len(out) <= len(start) and all(sizes[b].sum() <= 50 for b in out)
        assert sum(sizes[b].sum() ** 2 for b in out) >= sum(sizes[b].sum() ** 2 for b in start)
        assert sorted(i for b in out for i in b) == list(range(60))
    assert packing.search(np.zeros(0, np.int64), [], 50).bins == []


def test_search_makes_every_kind_of_step():
    moves = packing.search(np.array([3, 7, 6, 4]), [[0], [1], [2, 3]], 10)
    assert [sorted(b) for b in moves.bins] == [[], [0, 1], [2, 3]] and moves.steps == {"moves": 1, "one for one": 0, "two for one": 0}
    trade = packing.Bins(np.array([5, 7, 2]), [[0], [1, 2]], 12)
    assert not trade.drain(0) and trade.steps["one for one"] == 1 and trade.fill == [2, 12]
    two = packing.Bins(np.array([3, 4, 6, 3]), [[0, 1], [2, 3]], 10)
    two.drain(0)
    assert two.steps["two for one"] + two.steps["one for one"] >= 1 and max(two.fill) == 10


def test_search_comes_near_the_least_number_of_bins():
    r = random.Random(3)
    sizes = np.array([min(4095, int(r.lognormvariate(6.6, 0.9)) + 1) for _ in range(5000)])
    start = packing.next_fit(sizes, 4096)
    held = packing.search(sizes, start, 4096)
    least = -(-int(sizes.sum()) // 4096)
    left = sum(1 for b in held.bins if b)
    assert len(start) > 1.15 * least and left <= 1.003 * least + 1 and sum(held.steps.values()) > 500


# ---- 6 exact top-k


def test_topk(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(12) * (1 + i % 3)).tolist(), "x") for i in range(400)]
    rows[5] = (5, rows[4][1], "x")
    rows += [(900, None, "x"), (901, [1.0, None] + [0.0] * 10, "x"), (902, [float("nan")] * 12, "x"), (903, [float("inf")] * 12, "x"), (904, [], "x"), (905, [3e9] * 12, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top(df, df.where("vec_id % 50 = 0")).collect())
    q = {}
    for i, v, _ in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            q[i] = [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (12 - len(v))
    want = []
    for i in (k for k in q if k % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)[:5]
        want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert got == sorted(want)
    assert topk.top(df.limit(0), df.limit(0)).collect() == []
    assert len(topk.top(df.where("vec_id < 3"), df.where("vec_id = 0")).collect()) == 2


def test_topk_answers_repeated_rows_each(spark):
    rng = np.random.default_rng(5)
    rows = [(i % 60, rng.standard_normal(6).tolist()) for i in range(90)] + [(50, [0.0] * 6)] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    q = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    want = []
    for i, v in q:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in q if j != i)[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    for block in (8192, 8):  # one tree, or many balls and trees
        got = sorted(tuple(r) for r in topk.top(df, df.where("vec_id % 50 = 0"), block=block).collect())
        assert got == sorted(want)


def test_balls_and_bounds_save_distances(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 10, (40, 16))
    rows = [(i, (centres[i % 40] + rng.normal(0, 0.1, 16)).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = df.where("vec_id % 50 = 0")
    near = topk.found(df, asked, block=100).groupBy("q").agg(F.sum("computed").alias("c")).collect()
    assert len(near) == 80 and sum(r.c for r in near) < 0.3 * 80 * 4000
    v = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top(df, asked, block=100).collect()}
    for q in range(0, 4000, 50):
        best = sorted((-int(v[q] @ v[j]), j) for j in range(4000) if j != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(j, -s) for s, j in best]


def test_mtree_saves_distances():
    rng = np.random.default_rng(4)
    centres = rng.integers(-3000, 3000, (40, 16))
    v = (centres[rng.integers(0, 40, 4000)] + rng.integers(-20, 20, (4000, 16))).astype(np.int64)
    tree = topk.MTree(np.arange(4000), v)
    for q in range(0, 4000, 97):
        best = sorted(((-int(v[q] @ v[j]), j) for j in range(4000) if j != q))[:5]
        assert tree.search(q, v[q], 5) == [(-s, j) for s, j in best]
    assert tree.computed < 0.6 * 42 * 4000


# ---- 7 fingerprints


def test_fingerprints(spark):
    rows = sorted(cases.rows(), reverse=True, key=lambda r: r[0])
    got = {r.doc_id: r for r in fingerprints.fingerprints(cases.docs(spark, extra=True)).collect()}
    import re

    pieces = lambda t: {x.rstrip(" ") for x in re.findall(r"(?:\S+[^\S\n]*){1,16}", t)}
    alike = lambda a, b: 1.0 if not a and not b else 2 * len(a & b) / (len(a) + len(b))
    for k, r in enumerate(rows):
        text, after = r[1] or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited, x = text[: len(text) - half] + after[:half], got[r[0]]
        assert (x.n_chars, x.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert x.near_edited == pytest.approx(alike(pieces(text), pieces(edited)))
        assert x.near_next == pytest.approx(alike(pieces(text), pieces(after)))
    assert got[1].fingerprint == got[3].fingerprint == got[13].fingerprint != got[2].fingerprint
    assert fingerprints.fingerprints(cases.empty(spark)).collect() == []
    assert fingerprints.fingerprints(cases.docs(spark).where("doc_id = 1")).first().near_next == 1.0
    assert fingerprints.fingerprints(cases.repeated(spark)).count() == len(cases.rows()) + 3


def test_peeling_recovers_the_difference(spark):
    a, b = list(range(1, 41)), list(range(5, 45))
    df = spark.createDataFrame([(a, b, a[:8] + [99])], "a array<long>, b array<long>, c array<long>")
    t = {x: fingerprints.sketch(F.col(x)) for x in "abc"}
    found = lambda x, y: F.transform(fingerprints.differing(F.col(x), F.col(y), t[x], t[y]), lambda e: e["k"] * e["s"])
    r = df.select(found("a", "b").alias("ab"), found("a", "a").alias("aa")).first()
    assert sorted(r.ab) == sorted([1, 2, 3, 4, -41, -42, -43, -44]) and r.aa == []


def test_fingerprints_are_native(spark):
    plan = fingerprints.fingerprints(cases.docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- 8 sharding


def test_sharding(spark):
    r = random.Random(8)
    rows = [(i, cases.prose(i % 700, r.randint(3, 60)), "en", "a", 0) for i in range(2000)] + [(5000 + i, "the very same text " * 20, "en", "a", 0) for i in range(1500)]
    for df in (spark.createDataFrame(rows, cases.DOCS).repartition(5), cases.docs(spark, extra=True), cases.repeated(spark)):
        out = sharding.shard(df, 10).collect()
        n = df.count()
        assert len(out) == n
        texts = {x.doc_id: x.text or "" for x in df.collect()}
        slots, sizes = {}, {}
        for x in out:
            if n > 1000:
                assert x.text_crc32 == zlib.crc32(texts[x.doc_id].encode()) and x["size"] == len(texts[x.doc_id].encode()) + 16
            slots.setdefault(x.shard, []).append(x.slot)
            sizes[x.shard] = sizes.get(x.shard, 0) + x["size"]
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        if n > 1000:
            assert max(sizes.values()) < 1.02 * min(sizes.values()) and len(sizes) == 10
    assert sharding.shard(cases.empty(spark)).collect() == []


def test_groups_that_fit_a_shard_stay_whole(spark):
    r = random.Random(10)
    rows = [(i, cases.prose(i, 40), "en", "a", 0) for i in range(900)]
    even = sum(len(x[1]) + 16 for x in rows) * 1.25 / 10
    group, n = "copy of copies " * 6, 0
    while (n + 1) * (len(group) + 16) < 0.8 * even:
        n += 1
    rows += [(2000 + i, group, "en", "a", 0) for i in range(n)]
    out = sharding.shard(spark.createDataFrame(rows, cases.DOCS).repartition(3), 10).collect()
    assert len({x.shard for x in out if x.doc_id >= 2000}) == 1 and len(out) == len(rows)
    texts = {x[0]: x[1] for x in rows}
    where, sizes = {}, {}
    for x in out:
        assert (x["size"], x.text_crc32) == (len(texts[x.doc_id].encode()) + 16, zlib.crc32(texts[x.doc_id].encode()))
        where.setdefault(texts[x.doc_id], set()).add(x.shard)
        sizes[x.shard] = sizes.get(x.shard, 0) + x["size"]
    assert all(len(w) == 1 for w in where.values()) and max(sizes.values()) < 1.06 * min(sizes.values())


def test_two_large_records_are_parted(spark):
    """Quantiles of a sample may all fall on the last record of a range."""
    rows = [(i, "x" * (94_200 if i % 2 else 188_700) + str(i), "en", "a", 0) for i in range(120)]
    out = sharding.shard(spark.createDataFrame(rows, cases.DOCS).repartition(3), 3).collect()
    slots, sizes = {}, {}
    for x in out:
        slots.setdefault(x.shard, []).append(x.slot)
        sizes[x.shard] = sizes.get(x.shard, 0) + x["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(out) == 120
    assert max(sizes.values()) < 1.08 * min(sizes.values())


def test_rows_equal_in_all_are_parted(spark):
    """One row a thousand times: more than a shard holds, and no key tells them apart."""
    df = spark.createDataFrame([(1, "the same", "en", "a", 0)] * 1000 + [(None, None, None, None, None)] * 3, cases.DOCS)
    out = sharding.shard(df, 4).collect()
    slots = {}
    for x in out:
        slots.setdefault(x.shard, []).append(x.slot)
    assert len(out) == 1003 and len(slots) == 4 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) < 1.2 * min(map(len, slots.values()))


# ---- 9 WARC


def pages(spark):
    rows = [(1, "http://a/\u00e9 x", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "x", ""), (5, "http://c\r\nX: y", "long " * 50_000), (6, "http://d", "<p>é</p>"), (None, "http://n", "lonely"), (8, "q", "--\r\n\r\n--")]
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, kind string")


def test_warc_round_trip(spark):
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(spark, pages(spark)).collect()}
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    e = "<p>é</p>"
    assert got[1] == (9, digest(e), "revisit", 6) and got[6] == (9, digest(e), "response", None) and got[2][2:] == ("revisit", 6)
    assert got[3] == (0, digest(""), "revisit", 4) and got[4][2] == "response" and got[5][0] == 250_000 and got[None][2] == "response"
    assert len(got) == 8
    few = {r.page_id: r.record_type for r in warc.round_trip(spark, pages(spark), least=10).collect()}
    assert set(few.values()) == {"response"}
    assert warc.round_trip(spark, pages(spark).limit(0)).collect() == []
    assert warc.round_trip(spark, pages(spark).union(pages(spark))).count() == 16


def test_payloads_are_read_back(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    made = warc.write(pages(spark), folder)
    got = {r.page_id: bytes(r.payload) for r in warc.read(made, folder, payload=True).collect() if r.record_type == "response"}
    assert got[5] == b"long " * 10_000 * 5 and got[8] == b"--\r\n\r\n--"


def as_archive(body: bytes) -> warc.Archive:
    return warc.Archive(pa.PythonFile(io.BytesIO(body), mode="r"))


def test_archives_of_other_writers():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for i in range(70_000):  # beyond the 16-bit count
            z.writestr(f"m{i}", b"")
        with z.open("big", "w", force_zip64=True) as f:
            f.write(b"hello")
        z.writestr("packed", b"x" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 in a comment"
    a = as_archive(out.getvalue())
    assert len(a.members) == 70_002
    at, n = a.stored("big")
    assert a.read(at, n) == b"hello"
    with pytest.raises(ValueError, match="deflated"):
        a.stored("packed")
    with pytest.raises(ValueError, match="not a ZIP"):
        as_archive(b"nothing here")


def test_members_and_indexes_are_located():
    """Several archives, with an index of another layout for one, gzipped, and none for the other."""
    first = [warc.record(i, f"http://x/{i}", b"one" * i, "response", None) for i in range(1, 40)]
    second = [warc.record(i, f"http://y/{i}", b"two" * i, "response", None) for i in range(50, 60)]
    lines, at = ["!meta a header line"], 0
    for r in first:
        lines.append(f'com,x)/ 20240101 {{"offset": "{at}", "length": "{len(r)}", "filename": "archive/a.warc.gz"}}')
        at += len(r)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("datapackage.json", '{"profile": "data-package"}')
        z.writestr("archive/a.warc.gz", b"".join(first))
        z.writestr("archive/b.warc.gz", b"".join(second))
        z.writestr("indexes/index.cdx.gz", gzip.compress("\n".join(lines).encode()))
    a = as_archive(out.getvalue())
    assert {k: len(v) for k, v in a.indexed().items()} == {"archive/a.warc.gz": 39, "archive/b.warc.gz": 0}
    assert list(a.records()) == first + second
    assert [warc.facts(r)[0] for r in a.records()] == [*range(1, 40), *range(50, 60)]


def brute_warc(rows, least=0):
    last = {}
    for i, _, html in rows:
        body = (html or "").encode()
        last[body] = max(last.get(body, (False, 0)), (i is not None, i or 0))
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        revisit = len(body) >= least and (i is not None, i or 0) != last[body]
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", last[body][1] if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 9, 10])
def test_warc_is_the_brute_force_one(spark, least):
    r = random.Random(9)
    rows = [(i, f"http://x/{i}", r.choice([None, "", "same", "ünïcode " * 3, cases.prose(i % 9, 50), cases.prose(i, 30)])) for i in range(200)]
    df = spark.createDataFrame([(*x, "extra") for x in rows], "page_id long, url string, html string, sha string")
    got = [tuple(x) for x in warc.round_trip(spark, df, least=least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=repr) == brute_warc(rows, least)


@pytest.mark.parametrize("packed", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
@pytest.mark.parametrize("read_bytes", [50, 2 << 20])
def test_packages_of_ordinary_tools(spark, tmp_path, monkeypatch, packed, read_bytes):
    """Deflated side members and archives, JSON that is no index, a bare archive with records of other kinds."""
    monkeypatch.setattr(warc, "READ_BYTES", read_bytes)
    gz = [warc.record(i, f"http://x/{i}", b"one" * i, "response", None) for i in range(1, 20)]
    bare = [gzip.decompress(warc.record(i, f"http://y/{i}", b"two\r\n\r\n" * i, "response", None)) for i in range(30, 40)]
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1-2>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    other = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:3-4>\r\nContent-Length: 26\r\n\r\nHTTP/1.1 200 OK\r\n\r\npayload\r\n\r\n"
    at, lines = 0, []
    for r in gz:
        lines.append(json.dumps({"offset": at, "length": len(r), "filename": "x.warc.gz"}))
        at += len(r)
    with zipfile.ZipFile(tmp_path / "p.zip", "w", packed) as z:
        z.writestr("datapackage.json", json.dumps({"profile": "data-package", "resources": [{"offset": "none"}] * 50}, indent=1))
        z.writestr("pages/pages.jsonl", "\n".join(['{"format": "json-pages-1.0"}', '{"url": "http://x/1"}'] * 40))
        z.writestr("indexes/broken.cdxj.gz", b"no gzip")
        z.writestr("indexes/index.cdxj", "\n".join(lines))
        z.writestr("archive/x.warc.gz", b"".join(gz))
        z.writestr("archive/y.warc", info + b"".join(bare) + other)
    with pa.OSFile(str(tmp_path / "p.zip")) as f:
        found = [x for x in map(warc.facts, warc.Archive(f).records()) if x]
    assert [x[0] for x in found] == [*range(1, 20), *range(30, 40), None]
    assert [x[1] for x in found] == [3 * i for i in range(1, 20)] + [7 * i for i in range(30, 40)] + [7]
    table = spark.createDataFrame([("p.zip",)], "archive string")
    assert warc.read(table, f"file://{tmp_path}").count() == 30


def test_a_bare_archive_that_is_cut_off():
    whole = gzip.decompress(warc.record(1, "http://x/", b"payload", "response", None))
    assert list(warc._plain(iter([whole[:9], whole[9:]]))) == [whole.rstrip(b"\r\n")]
    with pytest.raises(ValueError, match="cut off"):
        list(warc._plain(iter([whole[:-12]])))


def test_zip64_fields():
    """A directory whose offsets and sizes stand in ZIP64 fields, as in packages beyond 4 GB."""
    name, data = b"a", b"12345"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, zlib.crc32(data), 0xFFFFFFFF, 0xFFFFFFFF, 1, 20) + name + struct.pack("<HHQQ", 1, 16, 5, 5) + data
    extra = struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, zlib.crc32(data), 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), len(local)) + struct.pack("<4sIQI", b"PK\x06\x07", 0, len(local) + len(entry), 1)
    body = local + entry + end + struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    a = as_archive(body)
    assert a.read(*a.stored("a")) == data


# ---- 10 toxicity


def marked(spark):
    r = random.Random(6)
    bad = ["vile", "nasty", "awful"]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        words = cases.prose(3000 + i, 60).split()
        if toxic:
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(bad) + r.choice(["", "ly", "ness"]))
        rows.append((i, " ".join(words), "en", "a", 0))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None, None, None, None), (1001, "", None, None, None), (1002, "vile " * 5000, None, None, None)]
    return spark.createDataFrame(rows, cases.DOCS), spark.createDataFrame([*labels, (None, 1, 1), (7777, None, None)], "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = marked(spark)
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs.withColumn("score", F.lit("x")), model).collect()
    assert len(rows) == 403 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in held) >= 0.97 * len(held)
    assert {r.doc_id: r.predicted for r in rows if r.doc_id >= 1000} == {1000: 0, 1001: 0, 1002: 1}
    assert all(e.doc_id % 5 == 0 for r in rows if r.predicted for e in r.evidence if e.toxic)
    learnt = {e.doc_id for r in rows for e in r.evidence}
    assert all(zlib.crc32(str(i).encode()) % 3 != 1 for i in learnt)


def test_only_near_copies_of_one_label_are_merged(spark):
    docs, labels = marked(spark)
    docs = docs.where("doc_id < 400").withColumn("text", F.concat("text", F.lit(" extraordinary")))  # the one long word
    learnt = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    model = toxicity.fit(docs, labels)
    assert {i for i, y in zip(model.ids, model.labels) if y} == {i for i in learnt if i % 5 == 0}
    first = next(i for i in learnt if i % 5 == 0)
    text = docs.where(F.col("doc_id") == first).first().text
    copies = [(i, f"{text} again", "en", "a", 0) for i in range(2000, 2060) if zlib.crc32(str(i).encode()) % 3 != 1]
    for label, more in ((1, 0), (0, 1)):  # copies of the other label are one example of their own
        model = toxicity.fit(docs.union(spark.createDataFrame(copies, cases.DOCS)), labels.union(spark.createDataFrame([(r[0], 1, label) for r in copies], labels.schema)))
        mine = [(i, y) for i, y in zip(model.ids, model.labels) if i == first or i >= 2000]
        assert len(mine) == 1 + more and {y for _, y in mine} == {1, label}


def test_the_sample_is_filled_past_near_copies(spark):
    base = [list(range(100 * i, 100 * i + 64)) for i in range(6)]
    near = {k: [*base[0][: 63 - k % 20], 10_000 + k] for k in range(40)} | {100 + i: base[i] for i in range(1, 6)}
    df = spark.createDataFrame([(k, 1, k) for k in near], "doc_id long, toxic int, h long")
    sketched = lambda some: [r for r in some.join(spark.createDataFrame(list(near.items()), "doc_id long, near array<long>"), "doc_id").collect()]
    assert [x[0] for x in toxicity.sample(df, {1: 4, 0: 4}, sketched)] == [0, 101, 102, 103]
    assert [x[0] for x in toxicity.sample(df, {1: 100, 0: 100}, sketched)] == [0, 101, 102, 103, 104, 105]


def test_toxicity_without_examples(spark):
    docs, labels = marked(spark)
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        rows = toxicity.score(docs, toxicity.fit(docs, some)).collect()
        assert len(rows) == 403 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(cases.empty(spark), toxicity.fit(cases.empty(spark), labels)).collect() == []


@pytest.mark.parametrize("long", [0.0, 0.1, 1.0])
def test_block_max_search_is_exact(long, monkeypatch):
    monkeypatch.setattr(toxicity, "LONG", long)
    r = random.Random(7)
    vectors = []
    for _ in range(700):
        v = {min(r.randrange(40), r.randrange(40)): r.random() for _ in range(r.randint(1, 6))}
        norm = sum(x * x for x in v.values()) ** 0.5
        vectors.append({k: x / norm for k, x in v.items()})
    example, term, weight = (np.array(x) for x in zip(*((i, t, w) for i, v in enumerate(vectors) for t, w in v.items())))
    index = toxicity.Index(example, term, weight, 700, 40)
    for n, q in enumerate(vectors[:80]):
        but = [n] if n % 2 else []
        scores = [(-round(sum(w * v.get(t, 0) for t, w in sorted(q.items())), 9), i) for i, v in enumerate(vectors) if i not in but]
        want = sorted(x for x in scores if x[0] < 0)[:15]
        got = index.nearest(np.array(list(q)), np.array(list(q.values())), 15, but)
        assert [s for _, s in got] == pytest.approx([-s for s, _ in want])
        assert [i for i, _ in got] == [i for _, i in want]


def test_scores_are_those_of_brute_force(spark):
    """Every term of every example, all examples, one by one."""
    docs, labels = marked(spark)
    model = toxicity.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    n, every = len(texts), [toxicity.counted(t) for t in texts.values()]
    bags = [toxicity.counted(texts[i]) for i in model.ids]
    held = {t: sum(t in b for b in every) for t in {t for b in bags for t in b}}

    def weight(t):
        return math.log((1 + n) / min(held[t] + 1, n + 0.5))

    def vector(bag):
        v = {t: (1 + math.log(c)) * weight(t) for t, c in bag.items() if t in held}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    vectors = [vector(b) for b in bags]
    at, value = model.knots
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for i, text in texts.items():
        v = vector(toxicity.counted(text))
        near = sorted((-round(sum(x * w.get(t, 0) for t, x in v.items()), 9), k) for k, w in enumerate(vectors) if texts[model.ids[k]] != text)
        near = [(k, -s) for s, k in near if s < 0][: toxicity.K]
        votes = sum(s for k, s in near if model.labels[k]) / sum(s for _, s in near) if near else model.rate
        assert got[i].score == pytest.approx(float(np.interp(votes, at, value)), abs=1e-6)
        assert [e.doc_id for e in got[i].evidence] == [model.ids[k] for k, _ in near[:5]]


def test_rows_without_an_id_and_clashing_columns(spark, tmp_path):
    docs, labels = marked(spark)
    none = spark.createDataFrame([(None, "vile nasty awful words", "en", "a", 0), (None, None, None, None, None)], cases.DOCS)
    every = docs.unionByName(none).withColumn("evidence", F.lit("clash")).withColumn("predicted", F.lit("clash"))
    every.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = QUERIES["op10_toxicity"](spark, str(tmp_path)).collect()
    assert len(rows) == 405 and [r.held_out for r in rows if r.doc_id is None] == [False, False]
    assert all(e.doc_id is not None for r in rows for e in r.evidence)
    model = toxicity.fit(every, labels)
    scored = toxicity.score(every, model)
    assert sorted(scored.columns) == sorted([*cases.docs(spark).columns, "score", "predicted", "evidence"])
    assert {r.predicted for r in scored.collect()} <= {0, 1}


def test_labelled_texts_do_not_vote_for_themselves(spark):
    docs, labels = marked(spark)
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert all(e.doc_id != r.doc_id for r in rows for e in r.evidence)
    doubled = docs.union(docs)
    again = toxicity.score(doubled, toxicity.fit(doubled, labels)).collect()
    assert len(again) == 2 * len(rows)


def test_the_fit_leaves_no_dictionary_of_terms_in_the_driver(spark):
    docs, labels = marked(spark)
    model = toxicity.fit(docs, labels)
    assert "place" not in vars(model)
    names = model.names.to_pylist()
    assert names == sorted(set(names)) and model.place == {t: i for i, t in enumerate(names)}
