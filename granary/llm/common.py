"""Shared pieces of the training-data operators."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: The six white-space characters that end a word, as a SQL string literal.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def words_of(c: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null: none."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE_CLASS + "+"), "")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or what SparkContext.setCheckpointDir was given.

    Where none is set, a master of one JVM (local, as in tests) gets a temporary one; on a cluster that folder would be each machine's own, so it raises.
    """
    sc = spark.sparkContext
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not set_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="granary-shared-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        set_dir = "file://" + own
        sc.setCheckpointDir(set_dir)
    return set_dir.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """df computed once and kept on the executors' disks until drop(); what a lost executor held is computed again from its lineage.

    For large tables that are dropped before an operator returns. Plans show a kept table's own plan, so what stands on several of them, what iterations carry on
    and what a result still reads is checkpointed().
    """
    out = df.persist(StorageLevel.DISK_ONLY)
    out.count()
    return out


def drop(df: DataFrame) -> None:
    """Let go of a table of materialize() that no later plan reads."""
    df.unpersist()


#: Tasks that write a checkpoint, for each core: more partitions are written one after another, into few files.
FILES_A_CORE = 1


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside remove their shuffle files as soon as they end; else these stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def settle(spark: SparkSession) -> None:
    """Let the driver's JVM collect what finished queries have left, plan trees and texts, between phases of many queries; no result depends on it.

    Each shuffle of an adaptive plan has a thread that lives for a minute, and what threads free stays in their malloc arenas, so that part goes back to the system too.
    """
    spark.sparkContext._jvm.System.gc()
    trim_native(spark)


def trim_native(spark: SparkSession) -> bool:
    """Have the driver's JVM return freed native memory to the system (jcmd System.trim_native_heap); False where it has no such command."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    obj, kind = jvm.java.lang.Object, jvm.java.lang.Class
    try:
        takes = gateway.new_array(kind, 4)
        for i, c in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            takes[i] = kind.forName(c)
        given = gateway.new_array(obj, 4)
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        # Through the interface: the server's own class is not open to callers.
        kind.forName("javax.management.MBeanServer").getMethod("invoke", takes).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JError:
        return False
    return True


def checkpointed(df: DataFrame) -> DataFrame:
    """df cut off from its lineage by a checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.coalesce(FILES_A_CORE * sc.defaultParallelism).checkpoint()


_written: list[tuple[SparkSession, str]] = []


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder, read again; it lives until the driver's exit."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/granary/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _clean_up() -> None:
    for spark, path in _written:
        if spark.sparkContext._jsc is not None:  # else the JVM has ended first; its folder is then the cluster's to clean
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Plain:
    """A table under positional column names (c0, c1, ...), so that no name of an operator clashes with one of the table's, in whatever case."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.df = df.toDF(*[f"c{i}" for i in range(len(self.names))])

    def find(self, name: str) -> str | None:
        """The positional name of a column: the exact name first, then the first in another case."""
        same = [i for i, c in enumerate(self.names) if c == name] or [i for i, c in enumerate(self.names) if c.lower() == name.lower()]
        return f"c{same[0]}" if same else None

    def __getitem__(self, name: str) -> str:
        found = self.find(name)
        if found is None:
            raise ValueError(f"no column {name} among {self.names}")
        return found

    def back(self, df: DataFrame, *added: str) -> DataFrame:
        """The table's columns under their own names, but for those that ``added`` replaces, then the added ones."""
        new = {a.lower() for a in added}
        kept = [(f"c{i}", c) for i, c in enumerate(self.names) if c.lower() not in new]
        return df.select(*[i for i, _ in kept], *added).toDF(*[c for _, c in kept], *added)


#: Bits of a membership filter: 256 KB whatever it holds. It only spares rows a shuffle; with very many keys it lets more of them through.
FILTER_BITS, FILTER_HASHES = 1 << 21, 2


def one_row(spark: SparkSession, name: str, values: np.ndarray) -> DataFrame:
    """A table of one row with one array column; plans read it as a scalar subquery and do not show its values."""
    return spark.createDataFrame(pa.table({name: pa.array([values])}))


def bit_positions(key: Column, seed: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * 64 + i)), F.lit(bits).cast("long")) for i in range(hashes)]


@dataclass(frozen=True)
class Bits:
    """A Bloom filter whose words lie in a table of one row."""

    table: DataFrame
    seed: int
    bits: int
    hashes: int

    def holds(self, key: Column, words: Column | None = None) -> Column:
        """words: a column that already holds the table's array, for use inside of higher-order functions."""
        words, hit = self.table.scalar() if words is None else words, F.lit(True)
        for p in bit_positions(key, self.seed, self.bits, self.hashes):
            hit = hit & (F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")) == 1)
        return hit


def bit_filter(keys: DataFrame, seed: int = 0, bits: int = FILTER_BITS, hashes: int = FILTER_HASHES) -> Bits:
    """A filter of the column ``key``; the driver gets bits / 64 words at most."""
    at = keys.select(F.explode(F.array(*bit_positions(F.col("key"), seed, bits, hashes))).alias("p"))
    found = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[found["w"].to_numpy()] = found["b"].to_numpy()
    return Bits(one_row(keys.sparkSession, "words", words), seed, bits, hashes)
