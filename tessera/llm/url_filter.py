"""URL filter: host and path rules held in Bloom filter cascades.

A cascade stores a list of keys exactly, relative to a known universe of keys:
level 0 encodes the listed keys, level 1 the keys of the universe that pass
level 0 by mistake, level 2 the listed keys that pass level 1 by mistake, and
so on until nothing is left. Asking a key of the universe then gives the exact
answer from bitmaps alone, without a join.

The universe is the corpus's own set of keys: every host with each of its
parent domains, with each path prefix as long as some rule's path. Blocked and
allowed rules have a cascade each, and the longest key found decides.

Defined results: a null url, or one without ``://``, has an empty host and path
and falls to no rule; no rule means ``allow`` (the cascades list no key of it).
Repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # "block" or "allow"

    @property
    def key(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(rest, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """Keys a rule for this url could have: parent domains times path prefixes."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n),
                           lambda i: F.array_join(F.slice(labels, i, n - i + F.lit(1)), "."))
    prefixes = F.array_compact(F.array(*[
        F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in sorted(set(path_lengths))]))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def _seeded(key: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed))


def _bit_at(h: np.ndarray, level: int, j: int, m: int) -> np.ndarray:
    """Bit position of hash function ``j`` of a level; m is a power of two."""
    with np.errstate(over="ignore"):
        salt = np.uint64((0x9E3779B97F4A7C15 * (16 * level + j + 1)) % 2**64 | 1)
        x = (h.view(np.uint64) ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(29))) & np.uint64(m - 1)).astype(np.int64)


@dataclass
class Level:
    bitmap: np.ndarray  # bool of a power-of-two length
    hashes: int

    def passes(self, h: np.ndarray, level: int) -> np.ndarray:
        out = np.ones(len(h), dtype=bool)
        for j in range(self.hashes):
            out &= self.bitmap[_bit_at(h, level, j, len(self.bitmap))]
        return out


class Cascade:
    """Exact membership of universe keys, from alternating Bloom filters."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def contains(self, h: np.ndarray) -> np.ndarray:
        """``h``: 64-bit hashes of keys of the universe."""
        inside = np.zeros(len(h), dtype=bool)
        alive = np.arange(len(h))
        for k, level in enumerate(self.levels):
            passed = level.passes(h[alive], k)
            inside[alive[~passed]] = k % 2 == 1
            alive = alive[passed]
        inside[alive] = len(self.levels) % 2 == 1
        return inside


def _level(keys: DataFrame, n: int, bits_per_key: float, number: int) -> Level:
    """One filter over the keys' hashes: bits are set in the tasks, merged by an aggregate.

    The bitmap is sized by the number of keys it encodes, so what reaches the
    driver is bounded by the rule list (and by the mistakes that the first
    level's size holds to about as many), not by the corpus.
    """
    m = 1 << max(6, math.ceil(math.log2(max(1, n) * bits_per_key)))
    hashes = max(1, round(m / max(1, n) * math.log(2)))
    hashes = min(hashes, 12)

    def positions(batches):
        import pyarrow as pa
        for batch in batches:
            h = np.asarray(batch.column(0)).astype(np.int64)
            at = np.unique(np.concatenate([_bit_at(h, number, j, m) for j in range(hashes)]))
            yield pa.RecordBatch.from_arrays([pa.array(at)], ["at"])

    words = (keys.select("h").mapInArrow(positions, "at bigint")
             .groupBy(F.shiftright("at", 5).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 31 as int))")).alias("bits")).toPandas())
    bitmap = np.zeros(m, dtype=bool)
    for word, bits in zip(words["word"], words["bits"]):
        for b in range(min(32, m)):
            if int(bits) >> b & 1:
                bitmap[int(word) * 32 + b] = True
    return Level(bitmap, hashes)


def build_cascade(listed: DataFrame, universe: DataFrame, label: str = "cascade",
                  max_levels: int = 40) -> Cascade:
    """``listed`` and ``universe``: one string column ``key`` each.

    Listed keys outside the universe are never asked for and are left out.
    """
    h = F.xxhash64("key").alias("h")
    universe = materialise(universe.where("key is not null").select("key", h).distinct(), f"{label}-universe")
    listed = materialise(listed.where("key is not null").select("key").distinct().join(universe, "key", "left_semi")
                         .select("key", h), f"{label}-listed")
    others = universe.join(listed.select("key"), "key", "left_anti")
    n, total = listed.count(), universe.count()
    if not n:
        return Cascade([])
    inner, outer, levels = listed, others, []
    bits = 1.44 * math.log2(max(4.0, total / n))
    while len(levels) < max_levels:
        level = _level(inner, n, bits, len(levels))
        levels.append(level)
        shared = universe.sparkSession.sparkContext.broadcast(level)
        number = len(levels) - 1

        def mistaken(batches, shared=shared, number=number):
            import pyarrow as pa
            for batch in batches:
                passed = shared.value.passes(np.asarray(batch.column("h")).astype(np.int64), number)
                yield batch.filter(pa.array(passed))

        wrong = materialise(outer.select("key", "h").mapInArrow(mistaken, "key string, h bigint"),
                            f"{label}-mistaken")
        n = wrong.count()
        if not n:
            return Cascade(levels)
        inner, outer, bits = wrong, inner, 4.0
    raise ValueError("two different keys share all hashes")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", label: str = "urls") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (key of the longest rule that fits) and ``verdict``.

    Input columns that clash with these four names are replaced.
    """
    spark: SparkSession = pages.sparkSession
    lengths = [len(r.path) for r in rules] or [0]
    parts = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    keys = candidate_keys(F.col("host"), F.col("path"), lengths)
    universe = materialise(parts.select("host", F.substring("path", 1, max(lengths)).alias("path")).distinct()
                           .select(F.explode(keys).alias("key")).distinct(), f"{label}-keys")
    cascades = {}
    for verdict in ("block", "allow"):
        listed = spark.createDataFrame([(r.key,) for r in rules if r.verdict == verdict], "key string")
        cascades[verdict] = build_cascade(listed, universe, f"{label}-{verdict}")
    shared = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("array<int>")
    def found(hashes: pd.Series) -> pd.Series:
        """0: not listed, 1: blocked, 2: allowed; for each candidate key."""
        sizes = hashes.map(len).to_numpy()
        flat = np.concatenate([np.asarray(x, dtype=np.int64) for x in hashes]) if len(hashes) else np.zeros(0, np.int64)
        got = np.where(shared.value["allow"].contains(flat), 2,
                       np.where(shared.value["block"].contains(flat), 1, 0)).astype(np.int32)
        return pd.Series(np.split(got, np.cumsum(sizes)[:-1]) if len(sizes) else [])

    hit = (F.array_max(F.filter(
        F.transform(F.arrays_zip(F.col("_keys"), F.col("_found")),
                    lambda x: F.struct(F.length(x["_keys"]).alias("n"), x["_keys"].alias("key"), x["_found"].alias("found"))),
        lambda x: x["found"] > 0)))
    return (parts.withColumn("_keys", keys)
            .withColumn("_found", found(F.transform("_keys", lambda k: F.xxhash64(k))))
            .withColumn("_hit", hit)
            .withColumns({"rule": F.col("_hit.key"),
                          "verdict": F.when(F.col("_hit.found") == 1, "block").otherwise("allow")})
            .drop("_keys", "_found", "_hit"))
