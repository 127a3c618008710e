"""How far each source's words diverge from those of its language and of its other sources.

Identical texts of a language are collapsed first: copies are counted by source
in the tasks and then over all, so a text with thousands of copies is one text
with multiplicities, and is tokenised once. Its terms count for every source
with the multiplicity there, and its multiplicities add up to the document
frequency. From then on only ``(lang, source, term)`` counts are moved.

A term's smoothed share in a group is ``p = 1 + floor(1e9 * (count + 1) / (N + V))``
over the ``V`` kept terms of the language (those in at least ``least`` of its
documents), all in integers, and ``f(p, q) = floor((p - q)^2 / q)``. The sum of
``f`` over all kept terms is evaluated sparsely for a pair of sources: with
``p0, q0`` the shares of an absent term,

    sum f = V f(p0, q0) + sum over a's terms  [f(p, q0) - f(p0, q0)]
                        + sum over b's terms  [f(p0, q) - f(p0, q0)]
                        + sum over both's     [f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)]

The second and third sums need only how many terms of a source have each count.
The last one takes the terms two sources share, in blocks of at most ``BLOCK``
sources by as many, summed in the tasks: no row is made for a term and a pair.

Defined results: null text, language and source are the empty string; rows that
repeat anything count each by itself; a group whose texts hold no term has rows
for its pairs all the same; a language without kept terms gives pairs of
value 0; an empty table gives no rows. Only the three columns are used, so
extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, text_slices

SCALE = 1_000_000_000
#: Sources compared with as many others at once, and histogram entries in a row.
BLOCK = 512
#: Pairs of a term's sources that are evaluated at once.
PAIRS = 1 << 20
#: Bytes of text whose terms are counted at once.
SLICE = 8 << 20


def _letters() -> bytes:
    """A-Z to a-z, letters and bytes of other characters kept, the rest to a blank."""
    return bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


LETTERS = _letters()


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / total)`` without overflow, by long division in thousands."""
    whole, rest = np.divmod(count + 1, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + more
    return 1 + whole


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _codes(lang, source):
    """A number for each distinct pair of two text columns, and the pairs' languages and sources."""
    import pyarrow as pa
    a, b = lang.dictionary_encode(), source.dictionary_encode()
    both = np.asarray(a.indices).astype(np.int64) * max(1, len(b.dictionary)) + np.asarray(b.indices)
    kinds, code = np.unique(both, return_inverse=True)
    x, y = np.divmod(kinds, max(1, len(b.dictionary)))
    return code, (a.dictionary.take(pa.array(x)), b.dictionary.take(pa.array(y)))


def _terms(texts: list[str]):
    """Term counts of texts, in groups of about ``SLICE`` bytes, without an object for each word.

    Yields ``(first text, (term number, count) of each text's distinct terms, the
    terms, (start, size) of each text's part of them)``.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        # one blank after each word, so that a word's end is the next one's start
        held.append(b" ".join(t.encode().translate(LETTERS).split()) + b" ")
        size += len(held[-1])
        if size < SLICE and i + 1 < len(texts):
            continue
        data = b"".join(x if len(x) > 1 else b"" for x in held)
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 32).astype(np.int32) + 1
        words = pa.Array.from_buffers(pa.binary(), len(ends), [
            None, pa.py_buffer(np.concatenate([np.zeros(1, np.int32), ends]).tobytes()), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        n_words = np.array([x.count(b" ") if len(x) > 1 else 0 for x in held])
        text = np.repeat(np.arange(len(held)), n_words)
        key = text * max(1, len(coded.dictionary)) + np.asarray(coded.indices).astype(np.int64)
        distinct, counts = np.unique(key, return_counts=True)
        of, term = np.divmod(distinct, max(1, len(coded.dictionary)))
        sizes = np.bincount(of, minlength=len(held))
        terms = pc.utf8_rtrim(coded.dictionary.cast(pa.string()), " ")
        yield first, (term, counts), terms, np.stack([np.cumsum(sizes) - sizes, sizes], axis=1)
        first, held, size = i + 1, [], 0


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
                size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``(lang, source, term, n, df)``, and the occurring ``(lang, source)`` groups."""
    empty = F.lit("")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), empty).alias("lang"),
                       F.coalesce(F.col(source).cast("string"), empty).alias("source"),
                       F.coalesce(F.col(text), empty).alias("text"))
    keyed = rows.withColumn("h", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    # one row a distinct text and source, without the text; and one a distinct text, with it
    copies = materialise(keyed.groupBy("lang", "h", "source").agg(F.count("*").alias("n")), "copies")
    texts = keyed.groupBy("lang", "h").agg(F.first("text").alias("text"))
    groups = materialise(copies.select("lang", "source").distinct(), "groups")
    # a text's sources are one list, or lists of about ``size`` where a language has more sources than that
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    by_text = copies.groupBy("lang", "h", F.pmod(F.xxhash64("source"), F.lit(1 + most // size)).alias("part")).agg(
        F.collect_list(F.struct("source", "n")).alias("copies"))
    each = texts.join(by_text, ["lang", "h"]).select("lang", "copies", "text")

    def count(batches):
        import pyarrow as pa
        for batch in (part for whole in batches for part in text_slices(whole, most=SLICE)):
            place = batch.column("copies")
            # one entry a text and source; a list may start anywhere in the values
            text_of = np.repeat(np.arange(batch.num_rows), np.diff(place.offsets))
            copies = place.flatten()
            # texts of one language and source are one group of this slice
            group, names = _codes(batch.column("lang").take(pa.array(text_of)), copies.field("source"))
            times = np.asarray(copies.field("n"))
            for first, term, terms, n in _terms(batch.column("text").to_pylist()):
                # entries whose text is among these, repeated for its terms
                low, high = np.searchsorted(text_of, [first, first + len(n)])
                some = text_of[low:high] - first
                starts, sizes = n[some, 0], n[some, 1]
                at = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
                entry = np.repeat(np.arange(low, high), sizes)
                key = group[entry] * len(terms) + term[0][at]
                order = np.argsort(key, kind="stable")
                cuts = np.flatnonzero(np.diff(key[order], prepend=-1))
                if not len(cuts):
                    continue
                weight = times[entry][order]
                total = np.add.reduceat(term[1][at][order] * weight, cuts)
                df = np.add.reduceat(weight, cuts)
                g, t = np.divmod(key[order][cuts], len(terms))
                yield pa.RecordBatch.from_arrays(
                    [names[0].take(pa.array(g)), names[1].take(pa.array(g)), terms.take(pa.array(t)), pa.array(total),
                     pa.array(df)], ["lang", "source", "term", "n", "df"])

    counted = each.mapInArrow(count, "lang string, source string, term string, n bigint, df bigint")
    summed = materialise(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")),
                         "term-counts")
    return summed, groups


SUM_SCHEMA = "lang string, a bigint, b bigint, value bigint"


def _shared_terms(size: int):
    """Last sum of the sparse form: one row holds a term's counts in two blocks of ``size`` sources."""

    def told(matrices):
        import pyarrow as pa
        for (lang, a, b), m in matrices.items():
            at = np.flatnonzero(m)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(a * size + at // size), pa.array(b * size + at % size),
                 pa.array(m[at])], ["lang", "a", "b", "value"])

    def add(batches):
        matrices: dict = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            v = np.asarray(batch.column("v"))
            keys = list(zip(langs, batch.column("block_a").to_pylist(), batch.column("block_b").to_pylist()))
            sides = []
            for column in ("in_a", "in_b"):
                places = batch.column(column)
                sizes = np.diff(np.asarray(places.offsets)).astype(np.int64)
                flat = places.flatten()
                total = np.asarray(flat.field("total")) + np.repeat(v, sizes)
                n = np.asarray(flat.field("n"))
                sides.append((np.cumsum(sizes) - sizes, sizes, np.asarray(flat.field("id")) % size,
                              shares(n, total), shares(n * 0, total)))
            (at, da, i, p, p0), (bt, db, j, q, q0) = sides
            number = {k: x for x, k in enumerate(dict.fromkeys(keys))}
            kind = np.array([number[k] for k in keys])
            for k, x in number.items():
                if k not in matrices:
                    if len(matrices) >= 32:
                        yield from told(matrices)
                        matrices.clear()
                    matrices[k] = np.zeros(size * size, dtype=np.int64)
                rows = np.flatnonzero(kind == x)
                # so many rows at once that their pairs stay below a bound
                upto = np.cumsum(da[rows] * db[rows])
                for some in np.split(rows, np.searchsorted(upto, np.arange(PAIRS, upto[-1], PAIRS))):
                    pairs = da[some] * db[some]
                    row = np.repeat(some, pairs)
                    nth = np.arange(len(row)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
                    a, b = at[row] + nth // db[row], bt[row] + nth % db[row]
                    np.add.at(matrices[k], i[a] * size + j[b],
                              divergence(p[a], q[b]) - divergence(p[a], q0[b]) - divergence(p0[a], q[b])
                              + divergence(p0[a], q0[b]))
        yield from told(matrices)

    return add


def _single_terms(batches):
    """Second and third sum: a row holds some counts of one source and a block of sources."""
    import pyarrow as pa
    for batch in batches:
        for row in batch.to_pylist():
            v = row["v"]
            n = np.array([x["n"] for x in row["counts"]], dtype=np.int64)[:, None]
            times = np.array([x["times"] for x in row["counts"]], dtype=np.int64)[:, None]
            other = np.array([x["id"] for x in row["others"]], dtype=np.int64)
            totals = np.array([x["total"] for x in row["others"]], dtype=np.int64)[None, :] + v
            own = np.array([[row["total"] + v]], dtype=np.int64)
            p, p0, q0 = shares(n, own), shares(n[:1] * 0, own), shares(totals * 0, totals)
            ahead = (times * (divergence(p, q0) - divergence(p0, q0))).sum(axis=0)
            behind = (times * (divergence(q0, p) - divergence(q0, p0))).sum(axis=0)
            me = np.full(len(other), row["id"])
            for a, b, value in ((me, other, ahead), (other, me, behind)):
                yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(other)), pa.array(a), pa.array(b),
                                                  pa.array(value)], ["lang", "a", "b", "value"])


def _absent_terms(batches):
    """First sum: a row holds two blocks of sources; every pair gets a value."""
    import pyarrow as pa
    for batch in batches:
        for row in batch.to_pylist():
            v = row["v"]
            i, p = (np.array([x[k] for x in row["in_a"]], dtype=np.int64) for k in ("id", "total"))
            j, q = (np.array([x[k] for x in row["in_b"]], dtype=np.int64) for k in ("id", "total"))
            value = np.zeros((len(i), len(j)), dtype=np.int64)
            if v:
                value = v * divergence(shares(p * 0, p + v)[:, None], shares(q * 0, q + v)[None, :])
            a, b = np.repeat(i, len(j)), np.tile(j, len(i))
            yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(a)), pa.array(a), pa.array(b),
                                              pa.array(value.ravel())], ["lang", "a", "b", "value"])


def audit(docs: DataFrame, least: int = 3, top: int = 200, lang: str = "lang", source: str = "source",
          text: str = "text", size: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank`` for the parts ``pair`` and ``term``.

    ``pair``: the divergence of the source from each other source of its
    language. ``term``: the ``top`` terms by which the source exceeds its
    language. Ranks go from the greatest value down, ties by the item's bytes.
    ``size``: sources in a block.
    """
    counts, groups = term_counts(docs, lang, source, text, size)
    kept = materialise(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"))
                       .where(F.col("df") >= least).drop("df"), "kept")
    langs = materialise(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")), "langs")
    sparse = materialise(counts.drop("df").join(kept, ["lang", "term"]), "sparse")
    totals = sparse.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # sources get a number within their language
    named = materialise(
        groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"),
                "lang_total", (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).cast("bigint").alias("id")),
        "sources")

    block = F.floor(F.col("id") / size).cast("int")
    blocks = named.groupBy("lang", "v", block.alias("block")).agg(F.collect_list(F.struct("id", "total")).alias("others"))
    # a source's terms by count; a source of N words has at most sqrt(2 N) different counts, here in 64 rows
    of_count = sparse.groupBy("lang", "source", "n").agg(F.count("*").alias("times")).join(
        named.select("lang", "source", "id", "total"), ["lang", "source"])
    some = of_count.groupBy("lang", "id", "total", F.pmod(F.col("n"), F.lit(64)).alias("part")).agg(
        F.collect_list(F.struct("n", "times")).alias("counts"))
    single = some.join(blocks, "lang").select("lang", "v", "id", "total", "counts", "others").mapInArrow(_single_terms, SUM_SCHEMA)

    # dealt by term once, for the lists and for joining them
    lists = (sparse.join(named.select("lang", "source", "id", "total", "v"), ["lang", "source"])
             .select("lang", "term", "v", block.alias("block"), "id", "n", "total").repartition("lang", "term")
             .groupBy("lang", "term", "v", "block").agg(F.collect_list(F.struct("id", "n", "total")).alias("places")))
    shared = (lists.select("lang", "term", "v", F.col("block").alias("block_a"), F.col("places").alias("in_a"))
              .join(lists.select("lang", "term", F.col("block").alias("block_b"), F.col("places").alias("in_b")),
                    ["lang", "term"])
              .select("lang", "v", "block_a", "block_b", "in_a", "in_b").mapInArrow(_shared_terms(size), SUM_SCHEMA))

    absent = (blocks.select("lang", "v", F.col("others").alias("in_a"))
              .join(blocks.select("lang", F.col("others").alias("in_b")), "lang")
              .mapInArrow(_absent_terms, SUM_SCHEMA))

    summed = (absent.unionByName(single).unionByName(shared).where("a <> b")
              .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    name = lambda k, as_: named.select("lang", F.col("id").alias(k), F.col("source").alias(as_))
    pairs = summed.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")

    # decimals, since SCALE times a count may pass a bigint
    share = lambda n, total: (F.lit(1) + F.call_function(
        "div", F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)"), (total + F.col("v")).cast("decimal(20,0)")))
    each = sparse.join(named, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total")).alias("q")).where("p > q")
    terms = each.select("lang", "source", F.lit("term").alias("part"), "item",
                        F.expr("(p - q) * (p - q) div q").alias("value"))
    nth = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    return (pairs.withColumn("rank", nth)
            .unionByName(terms.withColumn("rank", nth).where(F.col("rank") <= top)))
