"""Mixing sources to target weights by temperature, as budgeted block permutations.

A source with share ``p`` of all tokens gets a weight proportional to
``p**a``. The exponent is found by bisection on the table of source totals:
either the least exponent (the flattest mix) at which no source is repeated
more than ``max_repeats`` times within the budget, or the one whose weights
have ``target_entropy`` (in bits).

The weights are realised within ``budget`` tokens: each source's documents are
dealt by a hash into a fixed number of blocks, and the blocks are permuted by
a hash. A source whose target is f whole passes and a rest gives every
document f times, and once more those of the first blocks of the permutation
that fit into the rest; the block in which it runs out is cut in the order of
its documents' hashes. Sums over blocks replace sums over documents, so no
task holds a source, however large its share.

Defined results: documents with a null source form a source of their own;
a null text has no tokens; documents of a source without any tokens cost
nothing and are given once; rows that repeat both id and text share a hash and
are taken or left together; an empty table gives an empty result. Input
columns that clash with the added ones are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

GRID = 16


@dataclass
class Mix:
    """Shares and weights of the sources, and what each block gives."""

    exponent: float
    budget: int
    sources: DataFrame  # source, tokens, weight, target
    blocks: DataFrame   # source, block, block_order, copies, cut (hash up to which one more copy is given)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def find_exponent(shares: DataFrame, ratio: float, max_repeats: float | None = None,
                  target_entropy: float | None = None, rounds: int = 9) -> float:
    """Bisect the exponent; each round asks ``GRID`` exponents in one aggregate of ``shares`` (column p > 0).

    ``ratio``: budget over all tokens.
    """
    if (max_repeats is None) == (target_entropy is None):
        raise ValueError("give either max_repeats or target_entropy")
    if max_repeats is not None and ratio > max_repeats:
        raise ValueError("the budget alone needs more repeats than max_repeats")
    low, high = (0.0, 1.0) if max_repeats is not None else (0.0, 16.0)

    def meets(rows, a, k):
        z, s, least = rows[f"z{k}"], rows[f"s{k}"], rows["least"]
        if max_repeats is not None:
            return ratio * least ** (a - 1) / z <= max_repeats * (1 + 1e-12)
        return math.log2(z) - a * s / z / math.log(2) <= target_entropy + 1e-12

    for _ in range(rounds):
        tried = [low + (high - low) * k / GRID for k in range(GRID + 1)]
        rows = shares.agg(F.min("p").alias("least"), *[
            x for k, a in enumerate(tried) for x in (
                F.sum(F.pow("p", F.lit(a))).alias(f"z{k}"),
                F.sum(F.pow("p", F.lit(a)) * F.log("p")).alias(f"s{k}"))]).first()
        if rows["least"] is None:
            return 1.0
        first = next((k for k, a in enumerate(tried) if meets(rows, a, k)), GRID)
        if first == 0:
            return tried[0]
        low, high = tried[first - 1], tried[first]
    return round(high, 9)


def plan(docs: DataFrame, budget_ratio: float = 1.0, max_repeats: float | None = 2.0,
         target_entropy: float | None = None, blocks: int = 4096, seed: int = 11, source: str = "source",
         doc_id: str = "doc_id", text: str = "text", label: str = "mix") -> Mix:
    """Weights and block allotment; the budget is ``budget_ratio`` times all tokens."""
    each = materialise(
        docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("tokens"),
                    *_dealt(doc_id, text, source, blocks, seed)), f"{label}-docs")
    in_block = materialise(each.groupBy("source", "_block").agg(F.sum("tokens").alias("tokens")), f"{label}-blocks")
    totals = in_block.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    budget = int(total * budget_ratio)
    shares = materialise(totals.withColumn("p", F.col("tokens") / F.lit(float(max(1, total)))), f"{label}-shares")
    some = shares.where("p > 0")
    exponent = find_exponent(some, budget_ratio, max_repeats, target_entropy) if total else 1.0
    z = some.agg(F.sum(F.pow("p", F.lit(exponent)))).first()[0] or 1.0
    weight = F.when(F.col("p") > 0, F.pow("p", F.lit(exponent)) / F.lit(z)).otherwise(0.0)
    sources = (shares.withColumn("weight", weight)
               .withColumn("target", F.floor(F.round(F.col("weight") * budget, 3)).cast("bigint"))
               .select("source", "tokens", "weight", "target"))
    passes = F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(1).cast("bigint")
    order = W.partitionBy("source").orderBy(F.xxhash64(F.col("_block"), F.lit(seed + 1)), "_block")
    # at most `blocks` rows a source are in a window
    placed = (in_block.join(sources.select(F.col("source").alias("_s"), F.col("tokens").alias("total"), "target"),
                            F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
              .withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("total"))
              .withColumn("block_order", F.row_number().over(order))
              .withColumn("upto", F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, 0)))
              .withColumn("left", F.col("rest") - (F.col("upto") - F.col("tokens"))))
    placed = materialise(placed.select(
        "source", "_block", "block_order", "left",
        (F.col("passes") + ((F.col("total") > 0) & (F.col("left") >= F.col("tokens"))).cast("int")).alias("copies"),
        ((F.col("total") > 0) & (F.col("left") > 0) & (F.col("left") < F.col("tokens"))).alias("cuts")), f"{label}-placed")
    cut = placed.where("cuts").select(F.col("source").alias("_s"), F.col("_block").alias("_b"), "left")
    within = W.partitionBy("source", "_block").orderBy("_hash")  # by value, so equal hashes stay together
    cuts = (each.join(F.broadcast(cut), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
            .withColumn("upto", F.sum("tokens").over(within)).where("upto <= left")
            .groupBy("source", "_block").agg(F.max("_hash").alias("cut"))
            .select(F.col("source").alias("_s"), F.col("_block").alias("_b"), "cut"))
    given = (placed.join(cuts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")), "left")
             .select("source", F.col("_block").alias("block"), "block_order", "copies", "cut"))
    return Mix(exponent, budget, sources, materialise(given, f"{label}-given"))


def _dealt(doc_id: str, text: str, source: str, blocks: int, seed: int) -> list[Column]:
    h = F.xxhash64(F.col(doc_id), F.xxhash64(F.col(text)), F.lit(seed))
    return [F.pmod(h, F.lit(blocks)).cast("int").alias("_block"), h.alias("_hash")]


def allot(docs: DataFrame, mix: Mix, blocks: int = 4096, seed: int = 11, source: str = "source",
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``block``, ``block_order`` and ``copies``, by the same ``blocks`` and ``seed`` as `plan`."""
    given = mix.blocks.select(F.col("source").alias("_s"), F.col("block").alias("_b"),
                              F.col("block_order").alias("_order"), F.col("copies").alias("_copies"), "cut")
    block, h = _dealt(doc_id, text, source, blocks, seed)
    return (docs.withColumns({"_block": block, "_hash": h})
            .join(given, F.col(source).eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
            .withColumns({"block": F.col("_block"), "block_order": F.col("_order"),
                          "copies": F.col("_copies") + F.coalesce(F.col("_hash") <= F.col("cut"), F.lit(False)).cast("int")})
            .drop("_block", "_hash", "_s", "_b", "_order", "_copies", "cut"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix gives it; same columns."""
    dealt = {k: v for k, v in options.items() if k in ("blocks", "seed", "source", "doc_id", "text")}
    given = allot(docs, plan(docs, **options), **dealt)
    return (given.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
            .select(docs.columns))
