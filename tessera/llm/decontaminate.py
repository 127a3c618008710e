"""Benchmark decontamination with DataFrame functions only.

Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z.
A window is ``window`` consecutive words of a benchmark item (all its words if
it has fewer). The distinct windows are hashed by an anchor, the longest word
of each, and broadcast; the corpus is scanned once, word by word, against that
hash table, and every candidate is verified by comparing all its words. Only
verified hits and one small row a document are shuffled.

Defined results: null or wordless texts have no words and no hits; an item
without words has no windows; a null ``item_id`` is not listed among items but
its windows count; repeated rows are judged like any other and stay repeated;
empty tables give empty results. Only the id and text columns are used, so
extra columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Separators: every ASCII character that is not a digit or a lower-case letter.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
#: Windows broadcast at once. More are taken in blocks, with one scan of the corpus each.
BLOCK = 200_000


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), f"[{SEPARATORS}]+"), "")


def windows_of(benchmark: DataFrame, window: int = 10, item: str = "item_id", text: str = "text") -> DataFrame:
    """One row a distinct window: ``anchor``, ``before`` (words ahead of it), ``k``, ``win``, ``items``."""
    each = (benchmark.select(F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("w"))
            .where(F.size("w") > 0).withColumn("k", F.least(F.lit(window), F.size("w")))
            .select("item", "k", F.explode(F.transform(
                F.sequence(F.lit(1), F.size("w") - F.col("k") + 1),
                lambda i: F.slice(F.col("w"), i, F.col("k")))).alias("win")))
    longest = F.array_max(F.transform("win", lambda w, i: F.struct(F.length(w).alias("n"), (-i).alias("at"), w.alias("word"))))
    return (each.groupBy("win").agg(F.first("k").alias("k"), F.collect_set("item").alias("items"))
            .withColumn("a", longest)
            .select(F.col("a.word").alias("anchor"), (-F.col("a.at")).alias("before"), "k", "win", "items"))


def _scan(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Hits ``(doc, key, n_words, copies, start, k, items)``; a row with null start for each document row."""
    d = docs.select(F.col("doc"), F.xxhash64("text").alias("key"), F.length("text").alias("chars"),
                    words_of(F.col("text")).alias("w"))
    d = d.withColumn("n_words", F.size("w"))
    # position 0 is a row for the document itself, the words follow from 1
    each = d.select("doc", "key", "chars", "n_words", "w",
                    F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.col("w"))).alias("pos", "word"))
    win = F.broadcast(windows)
    start = F.col("pos") - F.col("before")
    fits = F.when((start >= 1) & (start + F.col("k") - 1 <= F.col("n_words")),
                  F.slice("w", F.greatest(start, F.lit(1)), F.col("k")) == F.col("win")).otherwise(False)
    return (each.join(win, (F.col("word") == F.col("anchor")) & fits, "left")
            .where((F.col("pos") == 0) | F.col("win").isNotNull())
            .select("doc", "key", "chars", "n_words", (F.col("pos") == 0).cast("int").alias("copies"),
                    F.when(F.col("win").isNotNull(), F.struct(start.alias("start"), F.col("k").alias("k"))).alias("span"),
                    "items"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row a document row: doc_id, its text's ``key`` and ``chars``, n_words, n_hit, spans, items.

    ``spans``: merged word ranges ``(start, stop)``, 1-based, stop excluded.
    """
    windows = windows_of(benchmark, window, item, item_text)
    n = windows.count()
    blocks = max(1, -(-n // block))
    bucket = F.pmod(F.xxhash64("win"), F.lit(blocks))
    base = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    hits = reduce(DataFrame.union, [
        _scan(base, windows.where(bucket == b) if blocks > 1 else windows)
        .withColumn("copies", F.col("copies") * int(b == 0)) for b in range(blocks)])
    zero = F.struct(F.array().cast("array<struct<start:int,stop:int>>").alias("done"),
                    F.lit(None).cast("struct<start:int,stop:int>").alias("open"))

    def merge(acc, span):
        stop = (span["start"] + span["k"]).cast("int")
        here = F.struct(span["start"].cast("int").alias("start"), stop.alias("stop"))
        apart = acc["open"].isNull() | (span["start"] > acc["open"]["stop"])
        return F.when(apart, F.struct(
            F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))).alias("done"),
            here.alias("open"))).otherwise(F.struct(
                acc["done"].alias("done"),
                F.struct(acc["open"]["start"].alias("start"),
                         F.greatest(acc["open"]["stop"], stop).alias("stop")).alias("open")))

    spans = F.aggregate(F.array_sort("spans"), zero, merge, lambda acc: F.when(
        acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))
    return (hits.groupBy("doc", "key", "chars")
            .agg(F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"),
                 F.collect_set("span").alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
            .withColumn("spans", spans)
            .select(F.col("doc").alias("doc_id"), "key", "chars", "n_words",
                    F.aggregate("spans", F.lit(0).cast("bigint"),
                                lambda a, s: a + (s["stop"] - s["start"])).alias("n_hit"), "spans", "items",
                    F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .drop("copy"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = 10,
                  doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """``docs`` without what the benchmark leaked into.

    ``remove="documents"`` drops each document with a hit; ``"spans"`` drops
    the hit words, each with the separators that follow it.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: documents or spans, not {remove!r}")
    found = (report(docs, benchmark, window, doc_id, text, **names).where("n_hit > 0")
             .select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), F.col("chars").alias("_chars"),
                     F.col("spans").alias("_spans")).dropDuplicates(["_doc", "_key", "_chars"]))
    own = F.coalesce(F.col(text), F.lit(""))
    same = (F.col(doc_id).eqNullSafe(F.col("_doc")) & (F.xxhash64(own) == F.col("_key"))
            & (F.length(own) == F.col("_chars")))
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    # of the text as it stands, so capitals belong to words
    letter, gap = r"[0-9A-Za-z\x{80}-\x{10FFFF}]", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    head = F.regexp_extract(text, f"^{gap}*", 0)
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"{letter}+{gap}*"), F.lit(0))
    left = F.filter(pieces, lambda p, i: ~F.exists(
        "_spans", lambda s: (i + 1 >= s["start"]) & (i + 1 < s["stop"])))
    cleaned = F.concat(head, F.array_join(left, ""))
    return (docs.join(found, same, "left")
            .withColumn(text, F.when(F.col("_spans").isNull(), F.col(text)).otherwise(cleaned))
            .select(docs.columns))
