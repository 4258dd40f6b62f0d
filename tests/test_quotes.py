"""Containment of quotes: the pairs that stand, and what is done to documents that hold none."""

from __future__ import annotations

from grainmill.operators import quotes


def test_only_candidates_are_normalised(spark, monkeypatch):
    """Quotes of one to nine words, one that ends inside words, one of a run that stands elsewhere; in both ways to meet them."""
    texts = ["One  two three\nfour five six seven eight nine", "xone two three four fivex", "two three", "", None, "a one two three four, five", "it's two   three four"]
    asked = ["one two three four five six seven eight nine", "ne TWO three four five", "two  three", "two", "it's two three", "one two three four six", " "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    q = spark.createDataFrame(list(enumerate(asked)), "item_id long, text string")
    plain = lambda x: " ".join((x or "").split()).lower()
    want = {(d, i) for d, x in enumerate(texts) for i, y in enumerate(asked) if plain(y) and plain(y) in plain(x)}
    for most in (quotes.MOST, 0):
        monkeypatch.setattr(quotes, "MOST", most)
        found = quotes.containment(docs, q)
        assert {tuple(r) for r in found.select("doc_id", "item_id").collect()} == want
        lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
        for i, line in enumerate(lines):
            if "Generate explode" in line:
                assert "regexp_replace" not in lines[i + 1]
