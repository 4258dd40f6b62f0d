"""What must not grow faster than the rows."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from grainmill.functions import text as t
from grainmill.operators import shingles as s, signatures
from grainmill.streaming.keepfirst import KeepFirst


def test_card_echo_splits_once_and_meets_by_hash(spark):
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(6000))
    other = long.replace("w", "v")
    rows = [("Of the night we sang", "and of the night"), ("of the in", "of the in"), ("a b", "a b"), (None, "a b c"), (long, other), (long, other + " waaa wbaa wcaa")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, x string, card string")
    began = time.time()
    got = [r.y for r in df.select("i", t.echoes_card("x", "card", ["the", "a", "of", "and", "to", "in", "is"]).alias("y")).orderBy("i").collect()]
    assert got == [True, False, False, False, False, True]
    assert time.time() - began < 20


def test_stream_bands_grow_with_what_is_kept(spark, tmp_path):
    d = spark.createDataFrame([(i, " ".join(f"w{(i - i % 5 * (i % 3 == 0)) * 31 + j}" for j in range(40))) for i in range(90)], "doc_id long, text string")
    keep, plans = KeepFirst(spark, f"file://{tmp_path}/kept", expected=16), []
    for n in range(3):
        for _ in range(2):  # a batch that runs twice changes nothing
            keep(d.where((F.col("doc_id") >= 30 * n) & (F.col("doc_id") < 30 * n + 30)), n)
        plans.append(keep.expected)
    assert plans == [64, 64, 256]
    assert keep.bands == signatures.plan(256, 0.9)
    whole = {r.doc_id for r in signatures.keep_first(s.packed(d), d, 0.9).where("kept_id is null").collect()}
    assert {r.doc_id for r in keep.kept().collect()} == whole and len(whole) < 90
