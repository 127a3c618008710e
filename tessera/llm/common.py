"""Helpers shared by the operators: scratch tables, id filters, components."""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path


#: Rows of an Arrow batch. Rows hold whole texts, so Spark's default of 10,000
#: would take a few hundred MB of buffers on both sides of each worker.
BATCH_ROWS = 2000
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this library, once a session.

    Also keeps Arrow batches small, unless the session has its own setting.
    """
    sc = spark.sparkContext
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    if getattr(sc, "_tessera_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-lib-"), "tessera_lib.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._tessera_shipped = True


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back.

    Cuts the lineage so that a lost executor costs a re-read, not a recompute,
    and so that a later join reads both of its sides through a shuffle, which
    adaptive execution can split when one key is hot.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fast_indices(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions below ``2**bits`` for each 64-bit key."""
    x = keys.astype(np.uint64)
    a = x * np.uint64(0x9E3779B97F4A7C15)
    b = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    s = np.uint64(64 - bits)
    return (a >> s).astype(np.int64), (b >> s).astype(np.int64)


def text_slices(batch, column: str = "text", most: int = 1 << 21):
    """Parts of an Arrow batch whose texts have about ``most`` bytes (one long text is a part of its own).

    Only a part at a time is turned into Python strings, so a task's memory
    does not follow the size of its batches.
    """
    import pyarrow.compute as pc
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    first, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and total + size > most:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += size
    if first < batch.num_rows:
        yield batch.slice(first)


class IdFilter:
    """Bloom filter of ids with a fixed size (``2**bits`` bits, 2 MB by default), broadcast to the tasks.

    It only spares work: ids that pass by mistake are dropped by the exact
    join that follows each use. Its size does not depend on the data; with
    very many ids it merely spares less.
    """

    def __init__(self, ids: DataFrame, bits: int = 24):
        """``ids``: one column of bigint; nulls are ignored."""
        column = ids.columns[0]
        self.bits = bits

        def words(batches):
            import pyarrow as pa
            seen = np.zeros(1 << bits, dtype=np.bool_)
            for batch in batches:
                for at in fast_indices(np.asarray(batch.column(0)), bits):
                    seen[at] = True
            packed = np.packbits(seen).view(np.int64)
            at = np.flatnonzero(packed)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(packed[at])], ["at", "word"])

        found = (ids.where(F.col(column).isNotNull()).select(F.col(column).cast("bigint"))
                 .mapInArrow(words, "at bigint, word bigint")
                 .groupBy("at").agg(F.bit_or("word").alias("word")).toArrow())
        packed = np.zeros((1 << bits) // 64, dtype=np.int64)
        packed[found.column("at").to_numpy()] = found.column("word").to_numpy()
        self.shared = ids.sparkSession.sparkContext.broadcast(packed.view(np.uint8))

    def __getstate__(self):
        return {"shared": self.shared, "bits": self.bits}

    def may_contain(self, keys: np.ndarray) -> np.ndarray:
        packed = self.shared.value
        a, b = fast_indices(keys, self.bits)
        hit = lambda at: (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        return (hit(a) & hit(b)).astype(bool)


def connected_components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """Distributed union-find: ``(node, component)`` for every node of an edge.

    ``edges`` has two bigint columns ``a`` and ``b``; ``component`` is the
    smallest node reachable. Alternates the large-star and small-star steps of
    Kiveris et al. (2014): every node is hooked to the least node it sees, so
    paths shrink geometrically and no task ever holds a whole component. Loops,
    nulls and repeated edges are ignored. Each step is written to the shared
    folder, and minima are materialised before they are joined, so a hub's rows
    can be split between tasks.
    """
    e = materialise(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{label}-edges")
    for _ in range(max_rounds):
        least = materialise(
            e.select(F.col("u").alias("node"), F.col("v").alias("m"), F.lit(True).alias("down"))
            .union(e.select(F.col("v").alias("node"), F.col("u").alias("m"), F.lit(False).alias("down")))
            .groupBy("node").agg(F.least("node", F.min("m")).alias("m"), F.count_if("down").alias("lower"),
                                 F.bool_or(~F.col("down")).alias("higher")), f"{label}-least")
        # stars everywhere: every node has one lower neighbour and no higher one, or only higher ones
        if least.where("lower > 1 or (lower = 1 and higher)").isEmpty():
            return least.select("node", F.col("m").alias("component"))
        large = materialise(
            e.join(least.select("node", "m"), F.col("v") == F.col("node")).select("u", F.col("m").alias("v")).distinct(),
            f"{label}-large")
        hook = materialise(large.groupBy("u").agg(F.min("v").alias("m")), f"{label}-hook")
        e = materialise(
            large.join(hook, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(hook.select("u", F.col("m").alias("v"))).distinct(), f"{label}-small")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
