"""The pipeline's stages on small tables with odd cases, one after the other and as a whole."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from grainmill.llm import packing

from . import cases
from .test_near_duplicates import brute
from .test_others import marked


def written(spark, path, docs, labels=None):
    docs.write.parquet(f"{path}/documents.parquet")
    (spark.createDataFrame([], "doc_id long, quality int, toxic int") if labels is None else labels).write.parquet(f"{path}/labels.parquet")
    return str(path)


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*pipeline.COLUMNS).collect())


def test_stages_are_those_of_the_job():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near duplicates", "repeated passages", "mixing", "packing"]


def test_toxic_documents_go_and_clean_ones_stay(spark, tmp_path):
    docs, labels = marked(spark)
    sf = written(spark, tmp_path, docs, labels)
    kept = rows_of(pipeline.toxic(spark, docs, sf))
    assert all(kept[tuple(r)] for r in docs.collect() if r.doc_id in (1000, 1001) or r.doc_id < 400 and r.doc_id % 5)
    gone = {r.doc_id for r in docs.collect() if not kept[tuple(r)]}
    assert 1002 in gone and len(gone) >= 75 and all(i % 5 == 0 for i in gone - {1002})
    assert pipeline.toxic(spark, cases.empty(spark), sf).collect() == []


def test_one_row_of_each_group_stays(spark):
    docs = cases.docs(spark, extra=True)
    comps = brute(cases.rows(), 5, 80)
    kept = pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == list(pipeline.COLUMNS)
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, root, _) in comps.items() if i == root}
    assert pipeline.near_duplicates(spark, cases.empty(spark), "").collect() == []


def test_rows_that_share_an_id_are_decided_each(spark):
    base, other = cases.prose(1, 120), cases.prose(60, 90)
    near = base.replace(base.split()[60], "changed", 1)
    rows = [(1, base), (2, near), (2, other), (2, other), (3, None), (3, None), (None, near + " end"), (None, cases.prose(70, 80)), (9, " "), (9, " ")]
    docs = spark.createDataFrame([(*r, "en", "a", 0) for r in rows], cases.DOCS)
    got = Counter((r.doc_id, r.text) for r in pipeline.near_duplicates(spark, docs, "").collect())
    assert got == Counter({(1, base): 1, (2, other): 1, (3, None): 2, (None, cases.prose(70, 80)): 1, (9, " "): 2})


def test_passages_go_and_texts_stay_readable(spark):
    docs = cases.repeated(spark)
    out = pipeline.repeated_passages(spark, docs, "").collect()
    assert len(out) == docs.count() and pipeline.repeated_passages(spark, cases.empty(spark), "").collect() == []
    by = {r.doc_id: r for r in out if r.doc_id not in (1, 7, None)}
    base = cases.prose(1, 120)
    assert by[3].text == "" and by[10].text == cases.prose(3, 300) + "\n" and by[4].text is None and by[9].text == cases.prose(2, 9000)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)
    assert {r.text for r in out if r.doc_id == 1} == {base}


def test_copies_are_whole_documents(spark):
    docs = cases.docs(spark, extra=True)
    before = {tuple(r) for r in docs.select(*pipeline.COLUMNS).collect()}
    out = rows_of(pipeline.mixed(spark, docs, ""))
    assert set(out) <= before and max(out.values()) <= 3
    assert pipeline.mixed(spark, cases.empty(spark), "").collect() == []


@pytest.mark.parametrize("some", ["docs", "repeated", "empty"])
def test_the_whole(spark, tmp_path, some):
    docs = getattr(cases, some)(spark)
    sf = written(spark, tmp_path, docs)
    packed = pipeline.run(spark, sf).collect()
    now = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        path = f"{tmp_path}/{stage.__name__}"
        stage(spark, now, sf).write.parquet(path)
        now = spark.read.parquet(path)
        assert now.columns == list(pipeline.COLUMNS)
    whole = Tokenizer.from_file(packing.default_vocabulary())
    want = Counter((r.doc_id, len(whole.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in now.collect())
    got: Counter = Counter()
    total: dict = {}
    for r in packed:
        total.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
        got[r.doc_id] += r["length"]
    sums: Counter = Counter()
    for (i, n), k in want.items():
        sums[i] += n * k
    assert got == sums
    for pieces in total.values():
        pieces.sort()
        assert all(at + n == nxt for (at, n), (nxt, _) in zip(pieces, pieces[1:])) and pieces[0][0] == 0 and sum(n for _, n in pieces) <= 4096


def test_labels_without_documents_and_extra_columns(spark, tmp_path):
    docs = cases.docs(spark, extra=True)
    labels = spark.createDataFrame([(7777, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    sf = written(spark, tmp_path, docs, labels)
    assert pipeline.toxic(spark, docs, sf).count() == docs.count()
    assert pipeline.run(spark, sf).where(F.col("length") <= 0).count() == 0
