"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a session in one process gets a folder of its own; a cluster must name one."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="grainmill-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _clean() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # the session is over; its folder is its owner's to clear
            return


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it is deleted when this Python process ends."""
    if not _made:
        atexit.register(_clean)
    path = f"{shared_dir(spark).rstrip('/')}/grainmill/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table below the shared folder, read back, so that nothing before it runs again."""
    path = new_path(df.sparkSession, name)
    with _shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def dealt(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """df as written() has it, in buckets of a key: tables of equal buckets meet by the key without a shuffle."""
    path = new_path(df.sparkSession, name)
    table = path.rpartition("/")[2].replace("-", "_")
    with _shuffles_dropped(df.sparkSession):
        df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path).saveAsTable(table, format="parquet")
    out = df.sparkSession.read.table(table)
    out.written_to, out.written_as = path, table
    return out


#: Cells of blocks that a round of crossed() shuffles, on both sides together.
ROUND = 1 << 28


def rounds(spark: SparkSession, cells: int, groups: int) -> int:
    """The room of crossed(): pairs of groups of so many cells in all that make ROUND, or four tasks a core if these are more."""
    return max(ROUND // max(1, 2 * -(-cells // groups)), 4 * spark.sparkContext.defaultParallelism)


def crossed(blocks: DataFrame, own: Column, groups: int, room: int, meet: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, name: str) -> list[DataFrame]:
    """meet(left, right) of each two groups of blocks, as written tables. `own` is a block's group, 0 .. groups - 1; left has g and
    right has h as its own group, g <= h. Pairs of groups go in rounds of `room` pairs, and what a round shuffled is gone
    before the next, so disk grows with the room and not with groups times rows."""
    out, every = [], groups * (groups + 1) // 2
    blocks = blocks.withColumn("own", own.cast("int"))
    number = lambda g, h: g.cast("long") * groups + h - F.floor(g.cast("long") * (g + 1) / 2)
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    for low in range(0, every, room):
        pairs = min(room, every - low)
        parts = max(pairs, min(3 * pairs, 12 * cores))  # few pairs seldom share a task
        here = lambda g, h: (number(g, h) >= low) & (number(g, h) < low + room)  # noqa: E731, B023
        sides = (
            blocks.withColumn("g", F.col("own")).withColumn("h", F.explode(F.filter(F.sequence("own", F.lit(groups - 1)), lambda h: here(F.col("own"), h)))),
            blocks.withColumn("h", F.col("own")).withColumn("g", F.explode(F.filter(F.sequence(F.lit(0), "own"), lambda g: here(g, F.col("own"))))),
        )
        left, right = (x.drop("own").repartition(parts, "g", "h").groupBy("g", "h") for x in sides)
        out.append(written(left.cogroup(right).applyInPandas(meet, schema), name))
    return out


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is written within sends so many rows to a Python worker at once: for rows that may be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(*tables: DataFrame) -> None:
    """Delete tables that written() or dealt() made and that no plan needs any more."""
    for df in tables:
        if table := vars(df).get("written_as"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
        _delete(df.sparkSession, df.written_to)
        _made[:] = [m for m in _made if m[1] != df.written_to]
