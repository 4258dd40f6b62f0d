"""Many phrases in one pass against looking for each."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from grainmill.operators import audits, phrases


def count(text: str, phrase: str) -> int:
    return text.count(phrase) if phrase else 1


@pytest.mark.parametrize("sent", [phrases.SENT, 7])
def test_hits_are_those_of_each_phrase(spark, monkeypatch, sent):
    monkeypatch.setattr(phrases, "SENT", sent)
    r = random.Random(2)
    texts = [(i, "ab"[i % 2], "".join(r.choice("aab \n") for _ in range(r.randint(0, 30)))) for i in range(120)] + [(200, "a", None), (201, None, ""), (202, None, "aaaa")]
    wanted = ["", "a", "aa", "ab", "aba", "b a", "\n", "zz", "aaa", "aa", None]
    rows = spark.createDataFrame(texts, "i long, arm string, text string").withColumn("phrase", F.lit("clash"))
    got = {(x.arm, x.phrase): (x.docs, x.times) for x in phrases.hits(rows, wanted, group=["arm"]).collect()}
    want = {}
    for arm in ("a", "b", None):
        for p in {w for w in wanted if w is not None}:
            held = [count(t, p) for _, own, t in texts if own == arm and t is not None and p in t]
            if held:
                want[arm, p] = (len(held), sum(held))
    assert got == want


@pytest.mark.parametrize("sent", [phrases.SENT, 5])
def test_uncovered(spark, monkeypatch, sent):
    monkeypatch.setattr(phrases, "SENT", sent)
    given = ["one two", "two", "three", "o", "", "x\x00y", "four", "fourteen", None]
    rows = spark.createDataFrame([(p,) for p in given], "phrase string")
    for excluded in ([], ["two three"], ["our"], ["x", "y"], ["teen", "one two three"], [""]):
        want = [p for p in given if p is None or not any(e in p or p in e for e in excluded)]
        assert sorted((x.phrase for x in phrases.uncovered(rows, excluded).collect()), key=str) == sorted(want, key=str)


def test_ten_thousand_phrases_cost_little_more_than_ten(spark):
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(4000)]
    texts = spark.createDataFrame([(" ".join(r.choice(words) for _ in range(300)),) for _ in range(2000)], "text string").repartition(4).cache()
    texts.count()
    every = sorted({f"{r.choice(words)} {r.choice(words)}" for _ in range(10_000)} | {w[:3] for w in words})[:10_000]
    took = {}
    for n in (10, 10, len(every)):
        began = time.time()
        found = audits.phrase_hits(texts, every[:n]).where("docs > 0").count()
        took[n] = time.time() - began
    assert found > 100 and took[len(every)] < 10 * took[10] + 5
