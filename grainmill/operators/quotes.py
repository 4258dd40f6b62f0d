"""Verbatim containment of a fixed reference set of quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import normalize, words

#: Up to so many quotes go along with the documents; more meet them in a shuffled join, with the same result.
MOST = 50_000


def containment(docs: DataFrame, quotes: DataFrame, n: int = 5) -> DataFrame:
    """doc_id, item_id where the normalised quote stands in the normalised document.

    A quote's first and last word may be parts of longer words in a document, but what lies between are whole words. So
    candidates share the hash of the quote's first inner run, of n words or, for short quotes, as many as there are; only
    those pairs are compared, where the document's body already is. Quotes without an inner word, of one or two words, are
    looked for in every document; they go along as a list."""
    q = quotes.select("item_id", normalize("text").alias("quote"), words("text").alias("w")).where("quote <> ''")
    q = q.withColumn("k", F.least(F.lit(n), F.size("w") - 2))
    run = F.coalesce(*[F.when(F.col("k") == k, F.xxhash64(*[F.get("w", F.lit(1 + j)) for j in range(k)])) for k in range(1, n + 1)])
    q = q.select("item_id", "quote", "k", run.alias("run"))
    sizes = [r.k for r in q.select("k").distinct().collect()]  # n numbers at most, and those below 1
    some, body = docs.select("doc_id", "text", words("text").alias("w")), normalize("text")

    def runs(k: int):
        """Hashes of all runs of k words, none if there are fewer."""
        one = F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - (k - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get("w", i + j) for j in range(1, k)]))
        return F.transform(F.array_distinct(one), lambda h: F.struct(F.lit(k).alias("k"), h.alias("run")))

    out = None
    inner = sorted(k for k in sizes if k >= 1)
    if inner:
        long = q.where("k >= 1")
        hashed = F.explode(F.concat(*map(runs, inner))).alias("x")
        if long.limit(MOST + 1).count() <= MOST:  # the list goes to the documents, which are compared where they are
            each = some.select("doc_id", "text", hashed).select("doc_id", "text", "x.k", "x.run")
            met = each.join(F.broadcast(long), ["k", "run"]).where(F.contains(body, F.col("quote")))  # only candidates are normalised
        else:
            found = some.select("doc_id", hashed).select("doc_id", "x.k", "x.run").join(long.select("item_id", "k", "run"), ["k", "run"]).select("doc_id", "item_id").distinct()
            met = found.join(docs.select("doc_id", body.alias("body")), "doc_id").join(long.select("item_id", "quote"), "item_id").where(F.contains("body", F.col("quote")))
        out = met.select("doc_id", "item_id").distinct()
    if any(k < 1 for k in sizes):
        few = docs.select("doc_id", body.alias("body")).join(F.broadcast(q.where("k < 1").select("item_id", "quote")), F.contains("body", F.col("quote"))).select("doc_id", "item_id")
        out = few if out is None else out.unionByName(few)
    return out if out is not None else docs.select("doc_id").limit(0).withColumn("item_id", F.lit(None).cast(quotes.schema["item_id"].dataType))
