"""Many phrases in one pass over the texts: an Aho-Corasick automaton, whatever their number.

The phrases are a table or a list. They are sent to the tasks in parts of at most SENT characters, so what is sent has a proven
bound, and the texts are read once for each part; each worker builds a part's automaton once. A text is walked once, and
tells which phrases it holds and how often. Counts are summed within tasks before they are shuffled.

Null texts and null phrases hold and are nothing. The empty phrase is held by every text, once. Phrases that repeat are one.
Texts and phrases are compared as they are: lower or normalise them before. Extra columns play no part.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.store import written

SENT = 1 << 20
_built: dict[str, object] = {}


def parts(spark: SparkSession, phrases: DataFrame | Sequence[str], column: str = "phrase") -> Iterator[list[str]]:
    """The distinct phrases, at most SENT characters at a time (or one longer phrase)."""
    if not isinstance(phrases, DataFrame):
        phrases = spark.createDataFrame([(p,) for p in phrases], f"{column} string")
    every = written(phrases.select(F.col(column).alias("p")).where("p is not null").distinct(), "phrases")
    size = every.agg(F.sum(F.length("p") + 1).alias("n")).first().n or 0
    n = max(1, -(-2 * size // SENT))  # even by hash, within a factor of two
    for k in range(n):
        held, chars = [], 0
        for row in every.where(F.pmod(F.xxhash64("p"), F.lit(n)) == k).toLocalIterator():
            if held and chars + len(row.p) > SENT:
                yield held
                held, chars = [], 0
            held.append(row.p)
            chars += len(row.p)
        if held:
            yield held


def automaton(name: str, phrases: Sequence[str]):
    """Of these phrases, built once in each process."""
    if name not in _built:
        import ahocorasick

        _built.clear()  # one part at a time
        made = ahocorasick.Automaton()
        for i, p in enumerate(phrases):
            if p:
                made.add_word(p, (i, len(p)))
        if len(made):
            made.make_automaton()
        _built[name] = made
    return _built[name]


def held(made, empty: list[int], text: str) -> dict[int, int]:
    """Numbers of the phrases in a text, and how often each stands there without overlapping itself."""
    out, last = dict.fromkeys(empty, 1), {}
    if len(made):
        for end, (i, n) in made.iter(text):
            if end - n >= last.get(i, -1):
                last[i] = end
                out[i] = out.get(i, 0) + 1
    return out


def _counter(name: str, sent, group: Sequence[str]):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, empty = automaton(name, sent.value), [i for i, p in enumerate(sent.value) if not p]
        docs, times = Counter(), Counter()
        for batch in batches:
            for *key, t in batch.itertuples(index=False, name=None):
                for i, n in held(made, empty, t).items():
                    docs[*key, i] += 1
                    times[*key, i] += n
        if docs:
            keys = list(docs)
            yield pd.DataFrame({**{c: [k[j] for k in keys] for j, c in enumerate(group)}, "phrase": [sent.value[k[-1]] for k in keys], "docs": [docs[k] for k in keys], "times": [times[k] for k in keys]})

    return count


def hits(rows: DataFrame, phrases: DataFrame | Sequence[str], text: str = "text", group: Sequence[str] = ()) -> DataFrame:
    """group, phrase, docs (rows that hold it), times (occurrences) of phrases that any row of the group holds."""
    spark, out = rows.sparkSession, None
    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in group]
    schema = ", ".join([*kinds, "phrase string", "docs long", "times long"])
    for some in parts(spark, phrases):
        count = _counter(uuid.uuid4().hex, spark.sparkContext.broadcast(some), tuple(group))
        found = rows.select(*group, text).where(F.col(text).isNotNull()).mapInPandas(count, schema)
        part = written(found.groupBy(*group, "phrase").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times")), "hits")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def _free(name: str, sent):
    @F.pandas_udf("boolean")
    def free(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        made, every, empty = automaton(name, sent.value), "\x00".join(sent.value), "" in sent.value

        def one(p: str | None) -> bool:
            if p is None:
                return True
            lies = p in every if "\x00" not in p else any(p in e for e in sent.value)
            return not (empty or lies or (len(made) and next(made.iter(p), None) is not None))

        for batch in batches:
            yield batch.map(one).astype(bool)

    return free


def uncovered(rows: DataFrame, excluded: DataFrame | Sequence[str], column: str = "phrase") -> DataFrame:
    """Rows whose phrase neither holds an excluded phrase nor lies in one."""
    for some in parts(rows.sparkSession, excluded):
        rows = rows.where(_free(uuid.uuid4().hex, rows.sparkSession.sparkContext.broadcast(some))(F.col(column)))
    return rows
