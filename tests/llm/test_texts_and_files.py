"""Source divergence, periodic runs and token files against plain versions of them, and their odd cases."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from grainmill.llm import divergence, repetitions, tokenfiles
from grainmill.llm.queries import QUERIES, replanted

from . import cases

SF = "/root/testdata/sf0.001"


# ---- source divergence


def plain_audit(rows, least=10, top=10):
    docs = [tuple(x or "" for x in r) for r in rows]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t, _, _ in docs]
    df, n = defaultdict(Counter), defaultdict(Counter)
    for (_, lang, source), words in zip(docs, terms):
        df[lang].update(set(words))
        n[lang, source].update(words)
    out = set()
    for lang in {d[1] for d in docs}:
        kept = [t for t, c in df[lang].items() if c >= least]
        groups = sorted({d[2] for d in docs if d[1] == lang})
        counts = {s: {t: n[lang, s][t] for t in kept} for s in groups}
        price = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p = {s: price(c) for s, c in counts.items()}
        q = price({t: sum(counts[s][t] for s in groups) for t in kept})
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            far = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            telling = [(-f(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(far)), ("term", sorted(telling)[:top])):
                out |= {(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(found, 1)}
    return out


def documents(rows=400, seed=1):
    r = random.Random(seed)
    words = [w for w in cases.prose(3, 60).split()] + ["Éa", "éa", "x1y", "Straße", "漢字", "don't"]
    out = []
    for i in range(rows):
        lang = r.choice(["en", "de", None, ""])
        source = "hot" if r.random() < 0.4 else r.choice(["a", "b", None, "Z", "é", "lonely" if i % 97 == 0 else "c"])
        text = None if i % 50 == 0 else " ".join(r.choice(words[: 20 + 8 * len(source or "")]) for _ in range(r.randint(0, 40)))
        out.append((text.title() if text and i % 7 == 0 else text, lang, source))
    return [*out, ("rare words only here", "fr", "one"), (None, "fr", "two"), (None, "it", "one"), ("...", "it", "two")]


@pytest.mark.parametrize("held", [divergence.HELD, 5])
def test_divergence_is_that_of_all_terms(spark, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "PIECE", 16)
    rows = documents()
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit("clash")).withColumn("n", F.lit("x"))
    got = [tuple(r) for r in divergence.audit(df).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(rows)
    assert {r[1:] for r in got if r[0] == "it"} == {("one", "pair", "two", 0, 1), ("two", "pair", "one", 0, 1)}


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_terms_of_long_texts_are_not_cut(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = "abc Déjà-vu x9Yz  tail".encode()
    assert [w for part in divergence.terms(text) for w in part] == [b"abc", "déjà".encode(), b"vu", b"x", b"yz", b"tail"]


# ---- periodic runs


def plain_runs(w, least=6, times=4):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, times * q):
                found.setdefault((s, i + q), q)
            i += i == s
    return found


def test_runs_are_those_of_all_periods():
    r = random.Random(4)
    for _ in range(3000):
        n = r.randint(0, 70)
        w = [r.randrange(r.choice((1, 2, 3, 6))) for _ in range(n)]
        if n and r.random() < 0.6:
            p, a = r.randint(1, max(1, n // 4)), r.randint(0, n // 2)
            w = w[:a] + [w[a + (i - a) % p] if a + (i - a) % p < n else 0 for i in range(a, n)]
        want, x = plain_runs(w), np.array(w, np.int32)
        got = {}
        if n:
            for a, b in repetitions.stretches(repetitions.recurrence(x, np.zeros(n, np.int64)), 6, 4):
                got |= repetitions.runs(w, a, min(b, n))
        assert got == want == repetitions.runs(w, 0, n), w


def digest(found, words):
    runs = sorted((a, b - a, q) for (a, b), q in found.items())
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (
        len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest(), hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def test_query_against_all_periods(spark, tmp_path):
    r = random.Random(8)
    rows = cases.rows() + [(1000 + i, " ".join(r.choice("abcdefgh") for _ in range(r.randint(0, 90))), "en", "a", 0) for i in range(300)]
    rows += [(2000, ("tick tock " * 500).strip(), "en", "a", 0), (2001, "x " * 3000, "en", "a", 0), (2002, "a b " * 9, "en", "a", 0)]
    spark.createDataFrame(rows, cases.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {x[0]: tuple(x)[1:] for x in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len({x[0] for x in rows})
    for doc_id, text, *_ in rows:
        words = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        assert got[doc_id] == digest(plain_runs(words), words), doc_id


def test_query_over_the_documents(spark):
    got = {x[0]: tuple(x)[1:] for x in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("n_chars < 6000").collect():
        words = planted(x.doc_id, re.findall(r"[^\x20\x09-\x0D]+", x.text or ""))
        assert got[x.doc_id] == digest(plain_runs(words), words)


def test_runs_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(repetitions, "SLAB", 40)
    rows = [(1, "go " * 7), (1, "go " * 7), (None, "a b " * 5), (3, None), (4, " \n"), (5, "Go go " * 4 + cases.prose(1, 300))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash")).withColumn("collapsed", F.lit(1))
    got = sorted((tuple(x) for x in repetitions.find(df).collect()), key=repr)
    spans = {(x[0], x[1]): ([tuple(r) for r in x[2]], x[3]) for x in got}
    assert len(got) == 6 and spans[1, 7] == ([(0, 7, 1)], "go") and spans[None, 10] == ([(0, 10, 2)], "a b")
    assert spans[3, 0] == spans[4, 0] == ([], "") and spans[5, 308] == ([(0, 8, 2)], "Go go " + cases.prose(1, 300))
    assert repetitions.find(df.limit(0)).count() == 0


def test_a_document_without_an_id_is_not_replanted(spark):
    df = spark.createDataFrame([(None, "a b c d e f g h"), (None, None)], "doc_id long, text string")
    assert {x.text for x in replanted(df).collect()} == {"a b c d e f g h", None}


# ---- token files


def library():
    return Tokenizer.from_file(tokenfiles.default_vocabulary())


def expected(rows):
    full, at, out = library(), 0, []
    for doc_id, text in rows:
        ids = [*full.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def test_query_against_the_library(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert sorted(tuple(x) for x in QUERIES["op13_token_files"](spark, SF).collect()) == expected(rows)


def test_odd_texts_and_small_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(tokenfiles, "FILE_BYTES", 300)
    odd = ["a<|endoftext|>b", "<|endoftext|>", "\x1c\x85 ​ x", "tabs\t\t and  blanks \n\n", "漢字 👩‍👩‍👧", "it's WE'LL 'S", "z" * 4000, " " * 3000, "no break 　wide"]
    rows = sorted([(i, t) for i, t, *_ in cases.rows()] + [(500 + i, t) for i, t in enumerate(odd)])
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("name", F.lit("clash")).withColumn("ids", F.lit(1))
    assert sorted(tuple(x) for x in tokenfiles.round_trip(spark, df).collect()) == expected(rows)


def test_rows_without_an_id_repeats_and_an_empty_table(spark):
    rows = [(None, "first"), (None, "first"), (None, None), (7, "again"), (7, "again"), (7, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(x) for x in tokenfiles.round_trip(spark, df).orderBy("start").collect()]
    assert [x[0] for x in got] == [None] * 3 + [7] * 3
    ends = np.cumsum([x[2] for x in got])
    assert [x[1] for x in got] == [0, *ends[:-1].tolist()]
    assert Counter(x[3] for x in got) == Counter(x[3] for x in expected(rows))
    assert tokenfiles.round_trip(spark, df.limit(0)).count() == 0


def test_ids_are_the_librarys():
    own, full, r = tokenfiles.Ids(tokenfiles.default_vocabulary()), library(), random.Random(9)
    letters = [*"ab'stre l1.,#", " ", " ", "\n", "\t", "\r", "\x0b", *map(chr, (0xA0, 0x2003, 0x3000, 0x85, 0x1C, 0x200B)), "é", "ß", "漢", "😀", "<|endoftext|>"]
    assert own.quick and own.bits == 16
    for _ in range(4000):
        s = "".join(r.choice(letters) for _ in range(r.randint(0, 16)))
        assert own.of(s).tolist() == full.encode(s, add_special_tokens=False).ids, s


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 20, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1003).astype(np.uint32)
    body = tokenfiles.packed(ids, bits)
    assert len(body) == -(-1003 * bits // 8)
    assert (tokenfiles.unpacked(body, bits, 1003) == ids).all() and (tokenfiles.unpacked(body, bits, 50, 900) == ids[900:950]).all()


def test_an_id_that_needs_more_bits_is_refused():
    with pytest.raises(ValueError):
        tokenfiles.packed(np.array([8], np.uint32), 3)


@pytest.mark.parametrize(("bits", "block"), [(16, 8), (17, 8), (13, 5), (11, 3)])
def test_random_access_reads_few_bytes(tmp_path, bits, block):
    r = np.random.default_rng(0)
    docs = [(None if i == 5 else i * 3, r.integers(0, 1 << bits, int(n)).astype(np.uint32)) for i, n in enumerate([0, 1, 2, 40, 0, 7, 5000, 3])]
    out = tokenfiles.Writer(f"file://{tmp_path}", bits, block)
    for key, ids in docs:
        out.add(key, ids)
    name, n, total = out.close()
    assert (n, total) == (8, sum(len(x) for _, x in docs))
    with pa.OSFile(f"{tmp_path}/{name}") as f:
        reader = tokenfiles.Reader(f)
        assert [k if has else None for k, has in zip(reader.keys.tolist(), reader.keyed)] == [k for k, _ in docs]
        for i in (7, 3, 0, 6, 1, 5):
            assert (reader.document(i) == docs[i][1]).all()
        assert (np.concatenate([x for *_, x in reader.documents()]) == np.concatenate([x for _, x in docs])).all()


@pytest.mark.parametrize("at", [3, 20, -3, -40])
def test_broken_files_are_errors(tmp_path, at):
    out = tokenfiles.Writer(f"file://{tmp_path}", 16, 8)
    out.add(1, np.arange(100, dtype=np.uint32))
    name, *_ = out.close()
    body = bytearray((tmp_path / name).read_bytes())
    body[at] ^= 0xFF
    (tmp_path / name).write_bytes(body)
    with pa.OSFile(f"{tmp_path}/{name}") as f, pytest.raises(ValueError):
        tokenfiles.Reader(f).document(0)
