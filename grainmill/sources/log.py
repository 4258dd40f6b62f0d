"""Tables that are only added to, a whole append or none: parts, and a log of records that name them.

An append writes its rows into a part of a fresh name, then renames a record into its number's place; a number is taken once,
so of two writers one goes on to the next. Readers see the parts that records name, and no others. What dies before its
record leaves a part that nobody reads, and what dies after it is done; run again under the same `txn`, an append that is
recorded is skipped. So nothing is lost and nothing is there twice. Rows are Parquet; records are read by the driver, one for
each append since the last `compact`, which writes all rows into one part and a record that stands for those before it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .files import exists

VERSION = "_version"


class Log:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), T._parse_datatype_string(schema)

    # ---- records

    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def records(self) -> list[dict]:
        """Those that count, in order, with their numbers."""
        if not exists(self.spark, f"{self.path}/log"):
            return []
        text = self.spark.read.text(f"{self.path}/log", wholetext=True, pathGlobFilter="*.json").select(F.input_file_name().alias("name"), "value")
        found = sorted((json.loads(r.value) | {"number": int(r["name"].rpartition("/")[2].removesuffix(".json"))} for r in text.toLocalIterator()), key=lambda r: r["number"])
        base = max((r["number"] for r in found if r.get("whole")), default=0)
        return [r for r in found if r["number"] >= base]

    def _record(self, record: dict, number: int) -> bool:
        """Put the record in its place; false if the number is taken."""
        jvm = self.spark.sparkContext._jvm
        draft, files = self._hadoop(f"{self.path}/log/.{uuid.uuid4().hex}")
        final, _ = self._hadoop(f"{self.path}/log/{number:012d}.json")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        if files.exists(final):
            files.delete(draft, False)
            return False
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else jvm.java.net.URI("file:///"), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, final, none)
        except Exception as e:
            files.delete(draft, False)
            if "exist" in str(e).lower():
                return False
            raise
        return True

    def _part(self, rows: DataFrame) -> str:
        name = f"parts/{uuid.uuid4().hex}"
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).write.parquet(f"{self.path}/{name}")
        return name

    # ---- tables

    def append(self, rows: DataFrame, txn: str | None = None) -> bool:
        """Add the rows; false if an append of this txn is recorded already."""
        known = self.records()
        if txn is not None and any(txn in r["txns"] for r in known):
            return False
        part = self._part(rows)
        while True:
            number = max((r["number"] for r in known), default=0) + 1
            if self._record({"parts": [part], "txns": [txn] if txn is not None else []}, number):
                return True
            known = self.records()
            if txn is not None and any(txn in r["txns"] for r in known):
                return False

    def append_once(self, rows: DataFrame, key: str) -> DataFrame:
        """Add those rows whose key no row has yet, one for each key (rows without one all the time); what was added."""
        fresh = rows.join(self.read().select(key), key, "left_anti").dropDuplicates([key])
        part = self._part(fresh)
        while not self._record({"parts": [part], "txns": []}, max((r["number"] for r in self.records()), default=0) + 1):
            pass
        return self._of([{"parts": [part], "number": 0}]).drop(VERSION)

    def _of(self, records: list[dict]) -> DataFrame:
        out = self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField(VERSION, T.LongType())]))
        paths = {f"{self.path}/{p}": r["number"] for r in records for p in r["parts"]}
        if paths:
            rows = self.spark.read.schema(self.schema).parquet(*paths)
            number = F.element_at(F.create_map(*[F.lit(x) for p, n in paths.items() for x in (p.rpartition("/")[2], n)]), F.regexp_extract(F.input_file_name(), r"/parts/([0-9a-f]{32})/", 1))
            return rows.withColumn(VERSION, number.cast("long"))
        return out

    def read(self) -> DataFrame:
        return self._of(self.records()).drop(VERSION)

    def latest(self, key: str) -> DataFrame:
        """Of each key the row that was added last: an upsert is an append."""
        rest = [f.name for f in self.schema if f.name != key]
        newest = self._of(self.records()).groupBy(key).agg(F.max_by(F.struct(*rest), VERSION).alias("__r"))
        return newest.select(*[key if f.name == key else F.col(f"__r.{f.name}").alias(f.name) for f in self.schema])

    def compact(self, key: str | None = None) -> None:
        """All rows, or the latest of each key, in one part."""
        known = self.records()
        part = self._part(self.latest(key) if key else self.read())
        txns = sorted({t for r in known for t in r["txns"]})
        if known and not self._record({"parts": [part], "txns": txns, "whole": True}, known[-1]["number"] + 1):
            raise RuntimeError("something was appended meanwhile; compact again")

    def sink(self, batch: DataFrame, number: int) -> None:
        """foreachBatch: a batch that runs again adds nothing."""
        self.append(batch, f"batch-{number}")
