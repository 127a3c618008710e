"""Near-duplicate embeddings by cross-polytope hashing, with verified links.

Vectors of one label are compared by cosine in double precision.

1. Equal vectors are one class with a weight.
2. Cross-polytope hashing: a vector, padded with zeros, goes through three rounds
   of random signs and a fast Hadamard transform; the largest coordinate with its
   sign is the hash. A table joins ``HASHES`` of them. Besides its own bucket, a
   vector probes the buckets that its next largest coordinates would give.
3. In the first tables each vector is compared with the least vector of its
   bucket (a star). One that links with such a leader joins the leader's cell.
4. Buckets then only have to name pairs of cells that meet: a bucket with a
   thousand near copies names their one cell. Every pair of vectors belongs to
   one pair of cells, so links are counted once however many buckets agree.
5. Cells are cut into blocks by the angle to their leader. The angle between two
   leaders and the blocks' ranges bound every angle between their members: most
   pairs of blocks are settled as all or none, the others are multiplied out.
   A hot cell is thus many small tasks, and no pair of vectors is ever a row.

Links are exact for the pairs examined (none is below the threshold), and the
tables and probes make it very unlikely that a pair above it never meets; the
tests measure recall against brute force.

Defined results: a vector that is null, empty, zero, or holds a null or a
non-finite component links with nothing, as does one with a null label; vectors
of different length do not link; rows that repeat an id are one node, whose
links are those of its first vector (the least by its bytes); a null id is
returned with no links and a null component; empty tables give empty results.
Only the id, vector and label columns are used.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialise

HASHES = 2
TABLES = 14
PROBES = 9
LEADER_TABLES = 4
LEAST_DIMENSION = 256
BLOCK = 256
RINGS_PER_RADIAN = 60
#: Slack on angles in radians, far above rounding; pairs within it of a bound are multiplied out.
SLACK = 1e-6


def hadamard(x: np.ndarray) -> np.ndarray:
    """Unnormalised fast Walsh-Hadamard transform of each row."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x


def bucket_hashes(vectors: np.ndarray, seed: int = 5) -> np.ndarray:
    """[vector, table, probe] bucket numbers; probe 0 is the vector's own bucket."""
    n, dim = vectors.shape
    size = max(LEAST_DIMENSION, 1 << max(1, math.ceil(math.log2(max(2, dim)))))
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (TABLES, HASHES, 3, size)).astype(np.float32)
    padded = np.zeros((n, size), dtype=np.float32)
    padded[:, :dim] = vectors
    wide = math.ceil(math.sqrt(PROBES)) if HASHES == 2 else PROBES
    out = np.empty((n, TABLES, PROBES), dtype=np.int64)
    for t in range(TABLES):
        codes, losses = [], []
        for k in range(HASHES):
            y = padded
            for r in range(3):
                y = hadamard(y * signs[t, k, r]) / np.float32(math.sqrt(size))
            strength = np.abs(y)
            top = np.argsort(-strength, axis=1, kind="stable")[:, :wide]
            values = np.take_along_axis(strength, top, 1)
            codes.append(top * 2 + (np.take_along_axis(y, top, 1) < 0))
            losses.append(values[:, :1] - values)
        combos = list(itertools.product(range(wide), repeat=HASHES))
        loss = np.stack([sum(losses[k][:, c[k]] ** 2 for k in range(HASHES)) for c in combos], axis=1)
        code = np.zeros((n, len(combos)), dtype=np.int64)
        for k in range(HASHES):
            code = code * (2 * size) + codes[k][:, [c[k] for c in combos]]
        best = np.argsort(loss, axis=1, kind="stable")[:, :PROBES]
        out[:, t] = np.take_along_axis(code, best, 1) * TABLES + t
    return out


def _matrix(column) -> np.ndarray:
    """Vectors of equal length, stored as bytes of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def _by_length(batches):
    """Batches of rows whose vectors ``v`` have one length."""
    import pyarrow.compute as pc
    for batch in batches:
        sizes = pc.binary_length(batch.column("v"))
        for size in pc.unique(sizes).to_pylist():
            yield batch.filter(pc.equal(sizes, size))


def _angle(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Angle of unit rows, accurate for small angles too."""
    return 2 * np.arctan2(np.linalg.norm(x - y, axis=-1), np.linalg.norm(x + y, axis=-1))


def _vectors(df: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """Rows with an id: ``id, g`` (label and length), ``v`` (bytes of doubles, null if unusable)."""

    def packed(batches):
        import pyarrow as pa
        for batch in batches:
            out = []
            for e in batch.column("e").to_pylist():
                x = None if not e or None in e else np.array(e, dtype=np.float64)
                norm = 0.0 if x is None else float(np.linalg.norm(x))
                out.append(x.tobytes() if x is not None and np.isfinite(x).all() and 0 < norm < math.inf else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(out, pa.binary())],
                                             ["id", "label", "v"])

    rows = (df.select(F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"),
                      F.col(embedding).alias("e")).where("id is not null")
            .mapInArrow(packed, "id bigint, label string, v binary"))
    return rows.select("id", F.concat_ws("/", F.octet_length("v").cast("string"), "label").alias("g"),
                       F.when(F.col("label").isNotNull(), F.col("v")).alias("v"))


def link_vectors(df: DataFrame, cosine: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding",
                 label: str = "label", name: str = "embeddings") -> DataFrame:
    """One row a vector row: ``vec_id, n_links, component_id, kept``."""
    theta = math.acos(cosine)
    every = materialise(_vectors(df, vec_id, embedding, label), f"{name}-rows")
    rows = (every.where("v is not null").groupBy("id").agg(F.min(F.struct("g", "v")).alias("x"))
            .select("id", "x.g", "x.v", F.xxhash64("x.g", "x.v").alias("key"), F.sha2("x.v", 256).alias("sha")))
    rows = materialise(rows, f"{name}-vectors")
    classes = materialise(rows.groupBy("g", "key", "sha").agg(
        F.min("id").alias("c"), F.count("*").alias("w"), F.first("v").alias("v")), f"{name}-classes")

    def buckets(batches):
        import pyarrow as pa
        for batch in _by_length(batches):
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                codes = bucket_hashes(_unit(_matrix(part.column("v"))))
                n = part.num_rows
                at = np.repeat(np.arange(n), TABLES * PROBES)
                yield pa.RecordBatch.from_arrays(
                    [part.column("c").take(pa.array(at)), part.column("g").take(pa.array(at)), pa.array(codes.ravel()),
                     pa.array(np.tile(np.arange(PROBES, dtype=np.int32), n * TABLES))], ["c", "g", "code", "probe"])

    probes = materialise(classes.mapInArrow(buckets, "c bigint, g string, code bigint, probe int")
                         .select("c", F.xxhash64("g", "code").alias("bucket"), "probe",
                                 F.pmod("code", F.lit(TABLES)).alias("t")), f"{name}-probes")
    vectors = classes.select("c", "g", "v")

    # 3. stars: the least vector of a bucket leads it
    first = probes.where((F.col("probe") == 0) & (F.col("t") < LEADER_TABLES))
    heads = materialise(first.groupBy("bucket").agg(F.min("c").alias("lead"), F.count("*").alias("size"))
                        .where("size > 1").select("bucket", "lead"), f"{name}-heads")
    stars = materialise(first.join(heads, "bucket").where("c <> lead").select("c", "lead").distinct(), f"{name}-stars")
    close = materialise(_angles(stars.select(F.col("c").alias("a"), F.col("lead").alias("b")), vectors)
                        .where(F.col("cos") >= cosine), f"{name}-close")
    chosen = (close.join(close.select(F.col("a").alias("b")).distinct(), "b", "left_anti")
              .groupBy("a").agg(F.min(F.struct("angle", "b")).alias("best")))
    cells = materialise(
        classes.join(chosen.withColumnRenamed("a", "c"), "c", "left")
        .select("c", "g", "v", "w", F.coalesce("best.b", "c").alias("cell"),
                F.coalesce("best.angle", F.lit(0.0)).alias("angle")), f"{name}-cells")

    # 4. pairs of cells that meet in a bucket; a cell meets itself
    named = cells.select("c", "cell")
    where = materialise(probes.join(named, "c").select("bucket", "cell", (F.col("probe") == 0).alias("home")).distinct(),
                        f"{name}-where")
    homes = where.where("home").select("bucket", F.col("cell").alias("other"))
    meet = (where.join(homes, "bucket").where("cell <> other")
            .select(F.least("cell", "other").alias("a"), F.greatest("cell", "other").alias("b")).distinct())
    meet = materialise(meet, f"{name}-meet")
    leaders = cells.where("c = cell").select("c", "g", "v")

    # 5. blocks by ring around the leader; crowded rings are dealt to several
    ringed = cells.withColumn("ring", F.floor(F.col("angle") * RINGS_PER_RADIAN).cast("int"))
    crowd = materialise(ringed.groupBy("cell", "ring").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), f"{name}-crowd")
    placed = materialise(
        ringed.join(crowd, ["cell", "ring"])
        .withColumn("part", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int"))
        .select("cell", F.xxhash64("cell", "ring", "part").alias("block"), "c", "w", "angle", "v"), f"{name}-placed")
    blocks = materialise(placed.groupBy("cell", "block").agg(
        F.min("angle").alias("near"), F.max("angle").alias("far"), F.count("*").alias("size"), F.sum("w").alias("weight")),
        f"{name}-blocks")
    side = lambda s: blocks.select(*[F.col(k).alias(k + s) for k in ("cell", "block", "near", "far", "size", "weight")])
    reach = materialise(cells.groupBy("cell").agg(F.max("angle").alias("reach")), f"{name}-reach")
    between = materialise(_angles(meet, leaders), f"{name}-between")
    near = (between.join(reach.select(F.col("cell").alias("a"), F.col("reach").alias("ra")), "a")
            .join(reach.select(F.col("cell").alias("b"), F.col("reach").alias("rb")), "b")
            .where(F.col("angle") - F.col("ra") - F.col("rb") <= theta + SLACK)
            .select(F.col("a").alias("cellx"), F.col("b").alias("celly"), "angle"))
    alone = reach.select(F.col("cell").alias("cellx"), F.col("cell").alias("celly"), F.lit(0.0).alias("angle"))
    pairs = (near.union(alone).join(side("x"), "cellx").join(side("y"), "celly")
             .where((F.col("cellx") != F.col("celly")) | (F.col("blockx") <= F.col("blocky")))
             .withColumn("least", F.greatest(
                 F.col("angle") - F.col("farx") - F.col("fary"), F.col("nearx") - F.col("angle") - F.col("fary"),
                 F.col("neary") - F.col("angle") - F.col("farx")))
             .withColumn("most", F.col("angle") + F.col("farx") + F.col("fary"))
             .where(F.col("least") <= theta + SLACK))
    pairs = materialise(pairs.select("cellx", "celly", "blockx", "blocky", "weightx", "weighty", "sizex", "sizey",
                                     (F.col("most") < theta - SLACK).alias("all")), f"{name}-pairs")
    same = F.col("blockx") == F.col("blocky")
    settled = pairs.where("all")
    by_block = (settled.select(F.col("blockx").alias("block"), F.col("weighty").alias("n"))
                .union(settled.where(~same).select(F.col("blocky").alias("block"), F.col("weightx").alias("n")))
                .groupBy("block").agg(F.sum("n").alias("n")))

    def multiplied(batches):
        import pyarrow as pa
        for batch in batches:
            ids, counts, met = [], [], []
            for row in batch.to_pylist():
                x, y = row["mx"], row["my"]
                u, v = (_unit(np.frombuffer(b"".join(m["v"] for m in z), np.float64).reshape(len(z), -1)) for z in (x, y))
                product = u @ v.T
                hit = product >= cosine
                for i, j in np.argwhere(np.abs(product - cosine) < 1e-12):  # within rounding: once more, one by one
                    hit[i, j] = _cosine(x[i]["v"], y[j]["v"]) >= cosine
                wx, wy = np.array([m["w"] for m in x]), np.array([m["w"] for m in y])
                ids += [m["c"] for m in x]
                counts += (hit @ wy).tolist()
                met += [None] * len(x)
                if row["blockx"] != row["blocky"]:
                    ids += [m["c"] for m in y]
                    counts += (wx @ hit).tolist()
                    met += [None] * len(y)
                if row["cellx"] != row["celly"] and hit.any():
                    ids.append(row["cellx"])
                    counts.append(0)
                    met.append(row["celly"])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(met, pa.int64())],
                                             ["c", "n", "met"])

    open_pairs = pairs.where(~F.col("all"))
    wanted = open_pairs.select(F.col("blockx").alias("block")).union(open_pairs.select("blocky")).distinct()
    members = materialise(placed.join(wanted, "block").groupBy("block").agg(
        F.collect_list(F.struct("c", "w", "v")).alias("m")), f"{name}-members")
    shape = (open_pairs.select("cellx", "celly", "blockx", "blocky")
             .join(members.select(F.col("block").alias("blockx"), F.col("m").alias("mx")), "blockx")
             .join(members.select(F.col("block").alias("blocky"), F.col("m").alias("my")), "blocky"))
    counted = materialise(shape.mapInArrow(multiplied, "c bigint, n bigint, met bigint"), f"{name}-counted")

    # a vector meets itself once in its own cell, so its class weight is counted too; less itself, that is its links
    links = (counted.groupBy("c").agg(F.sum("n").alias("n"))
             .union(placed.join(materialise(by_block, f"{name}-settled"), "block").select("c", "n"))
             .groupBy("c").agg((F.sum("n") - 1).alias("n_links")))
    edges = (cells.where("c <> cell").select(F.col("c").alias("a"), F.col("cell").alias("b"))
             .union(counted.where("met is not null").select(F.col("c").alias("a"), F.col("met").alias("b")))
             .union(settled.where("cellx <> celly").select(F.col("cellx").alias("a"), F.col("celly").alias("b"))))
    components = materialise(connected_components(edges, name), f"{name}-components")
    by_class = materialise(classes.select("c", "g", "key", "sha").join(materialise(links, f"{name}-links"), "c", "left")
                           .join(components, F.col("c") == F.col("node"), "left")
                           .select("g", "key", "sha", "n_links", F.coalesce("component", "c").alias("component")), f"{name}-by-class")
    by_id = materialise(rows.select("id", "g", "key", "sha").join(by_class, ["g", "key", "sha"])
                        .select("id", "n_links", "component"), f"{name}-by-id")
    given = df.select(F.col(vec_id).cast("bigint").alias("id"))
    return (given.join(by_id, "id", "left")
            .select(F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(vec_id) == F.col("component_id"), F.lit(False))))


def _cosine(x: bytes, y: bytes) -> float:
    a, b = np.frombuffer(x, np.float64), np.frombuffer(y, np.float64)
    return float(a @ b) / (math.sqrt(float(a @ a)) * math.sqrt(float(b @ b)))


def _angles(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``a, b, cos, angle`` of the pairs whose vectors may be compared."""

    def measured(batches):
        import pyarrow as pa
        for batch in _by_length(batches):
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                x, y = _matrix(part.column("v")), _matrix(part.column("vb"))
                cos = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(cos), pa.array(_angle(_unit(x), _unit(y)))],
                    ["a", "b", "cos", "angle"])

    side = vectors.select(F.col("c").alias("b"), F.col("g").alias("gb"), F.col("v").alias("vb"))
    return (pairs.join(vectors.select(F.col("c").alias("a"), "g", "v"), "a").join(side, "b").where("g = gb")
            .select("a", "b", "v", "vb").mapInArrow(measured, "a bigint, b bigint, cos double, angle double"))
