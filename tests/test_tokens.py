"""Token counts and cuts against the tokenizers themselves."""

from __future__ import annotations

import base64

import public_tokenizers as public
import pytest
import tiktoken
from pyspark.sql import functions as F

from grainmill.functions import tokens
from grainmill.plans.catalog import QUERIES

TEXTS = ["", None, "plain words, and more of them", "  two  blanks\n\nand lines\t", "é" * 40, "漢字とかな" * 9, "👍🏽 emoji 👩‍👩‍👧 and é", "a" * 5000, "mixed 漢 text – with dashes … " * 50]


def ranks():
    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=table, special_tokens={})


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"])
@pytest.mark.parametrize("most", [0, 1, 7, 10_000])
def test_cuts(spark, name, most):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i long, text string")
    got = rows.select("i", tokens.capped("text", most, public.path(name)).alias("c")).select("i", "c.*").collect()
    known = tokens.vocabulary(public.path(name))
    for r in got:
        whole = TEXTS[r.i] or ""
        assert whole.startswith(r.text) and r.kept_tokens == min(most, r.n_tokens) and r.n_tokens == len(known.ends(whole))
        assert r.text == whole or r.n_tokens > most


def test_a_cut_is_what_the_first_tokens_say(spark):
    own = ranks()
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i long, text string")
    for most in (1, 3, 20):
        for r in rows.select("i", tokens.capped("text", most, public.path("byte_bpe_50k.tiktoken")).alias("c")).select("i", "c.*").collect():
            whole = TEXTS[r.i] or ""
            ids = own.encode_ordinary(whole)
            assert r.n_tokens == len(ids)
            assert r.text == (whole if len(ids) <= most else own.decode_bytes(ids[:most]).decode("utf-8", "ignore"))


def test_query_counts_every_document(spark):
    own, docs = ranks(), spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in QUERIES["t22_token_cap"](spark, "/root/testdata/sf0.001").collect()}
    for r in docs.collect():
        ids = own.encode_ordinary(r.text or "")
        cut = (r.text or "") if len(ids) <= 512 else own.decode_bytes(ids[:512]).decode("utf-8", "ignore")
        assert (got[r.doc_id].n_tokens, got[r.doc_id].kept_tokens, got[r.doc_id].kept_chars) == (len(ids), min(512, len(ids)), len(cut))
    assert len(got) == docs.count()


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        tokens.vocabulary("/nowhere/words.txt")
    with pytest.raises(ValueError):
        tokens.capped(F.lit("x"), -1, "/nowhere/words.json")
