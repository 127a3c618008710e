"""Language identification by prediction by partial matching (PPM).

For each language a byte context tree of orders 0 to 3 is counted on a bounded,
documented sample of labelled text (slices of distinct texts, see ``sample``). The code length of a byte after a context
of up to three bytes is found by PPM with escape method C: a byte seen after
the context costs ``-log2(count / (total + kinds))``; another one costs the
escape ``-log2(kinds / (total + kinds))`` and is coded in the next shorter
context, at last uniformly over 256 bytes. A context that a language never saw
is left for the shorter one at no cost. The statistics are frozen after
fitting, so the exact code length of each (context, byte) is worked out once
and scoring is two array lookups a byte.

The language with the shortest code for the whole text wins; ``score`` is its
posterior under equal priors (``2**-length``, normalised over the languages).

Defined results: null text, or text with no letter, is ``und`` with score 0;
so is every text when nothing could be learned. Ties go to the alphabetically
first language. Very long texts are scored in slices of bounded memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices

ORDER = 3
SLICE = 1 << 20
PIECE = 4096


@dataclass
class ContextTrees:
    """Frozen code lengths of all languages, indexed by context node and byte class."""

    languages: list[str]
    classes: np.ndarray   # byte -> class; 0 is the start of a text, 1 any byte never seen
    nodes: np.ndarray     # packed three-class context -> row of ``lengths``
    lengths: np.ndarray   # [row, class, language] bits

    @property
    def width(self) -> int:
        return int(self.classes.max()) + 1

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text in each language."""
        width, n_lang = self.width, len(self.languages)
        out = np.zeros((len(texts), n_lang))
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        first = 0
        while first < len(texts):
            last, total = first, 0
            while last < len(texts) and (last == first or total + sizes[last] + ORDER <= SLICE):
                total += sizes[last] + ORDER
                last += 1
            if total > SLICE:  # one very long text
                text, state = texts[first], np.zeros(ORDER, dtype=np.int32)
                for at in range(0, len(text), SLICE):
                    c = np.concatenate([state, self.classes[np.frombuffer(text[at:at + SLICE], np.uint8)]])
                    out[first] += self._bits(c, width)[ORDER:].sum(axis=0, dtype=np.float64)
                    state = c[-ORDER:]
            else:
                pad = bytes(ORDER)
                raw = np.frombuffer(b"".join(x for t in texts[first:last] for x in (pad, t)), np.uint8)
                c = self.classes[raw]
                starts = np.concatenate([[0], np.cumsum(sizes[first:last] + ORDER)[:-1]])
                heads = (starts[:, None] + np.arange(ORDER)).ravel()
                c[heads] = 0
                bits = self._bits(c, width)
                bits[heads] = 0
                out[first:last] = np.add.reduceat(bits, starts, axis=0, dtype=np.float64)
            first = last
        return out

    def _bits(self, c: np.ndarray, width: int) -> np.ndarray:
        context = np.zeros(len(c), dtype=np.int32)
        context[ORDER:] = (c[:-3] * width + c[1:-2]) * width + c[2:-1]
        row = self.nodes[context]
        return self.lengths[row, c]


def _ngram_counts(texts: pd.Series, inner: pd.Series | None = None) -> pd.DataFrame:
    """Counts of each byte after each context of ``ORDER`` bytes; 256 marks the start of a text.

    ``inner`` texts are cut from longer ones; their first ``ORDER`` bytes are only context.
    """
    codes = []
    for text, cut in zip(texts, [False] * len(texts) if inner is None else inner):
        raw = np.frombuffer(text.encode() if isinstance(text, str) else text, np.uint8)
        b = (raw if cut else np.concatenate([np.full(ORDER, 256), raw])).astype(np.int64)
        code = b[ORDER:]
        for k in range(1, ORDER + 1):
            code = code + (b[ORDER - k:len(b) - k] << (9 * k))
        codes.append(code)
    code, n = np.unique(np.concatenate(codes) if codes else np.zeros(0, np.int64), return_counts=True)
    return pd.DataFrame({"code": code, "n": n})


def _lowest(most: int):
    """Keeps, of the pieces of all batches, each once, those of lowest hash that fit ``most`` bytes a language, or the first."""

    def kept(held: pd.DataFrame) -> pd.DataFrame:
        held = held.drop_duplicates(["lang", "h"]).sort_values(["lang", "h"])
        total = held.groupby("lang")["size"].cumsum()
        return held[(total <= most) | (total == held["size"])]

    def prune(batches):
        held, new = None, []
        for pdf in batches:
            new.append(pdf)
            if sum(map(len, new)) > 50_000:
                held, new = kept(pd.concat([*([] if held is None else [held]), *new])), []
        if new:
            held = kept(pd.concat([*([] if held is None else [held]), *new]))
        if held is not None:
            yield held

    return prune


def sample(labelled: DataFrame, text: str = "text", lang: str = "lang",
           max_bytes_per_language: int = 1_000_000, seed: int = 7) -> DataFrame:
    """``lang, inner, piece``: the text a model is learned from, at most ``max_bytes_per_language`` each.

    Texts are cut into pieces of ``PIECE`` bytes, and copies of a text count
    once. A language gets its pieces of lowest hash (of the text and the piece's
    number) up to the bound, so every language with a text has at least one, all
    of them where they fit, and neither long nor repeated texts fill or empty
    it. Tasks keep what fits the bound, so only that is shuffled. ``inner``
    pieces begin with ``ORDER`` more bytes, the context of their first.
    """
    size = min(PIECE, max(1, max_bytes_per_language))
    rows = (labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
            .where("text is not null and lang is not null and octet_length(text) > 0")
            .select("lang", "text", F.xxhash64("text", F.lit(seed)).alias("t"), F.octet_length("text").alias("bytes")))
    numbers = F.sequence(F.lit(0), F.floor((F.col("bytes") - 1) / size).cast("int"))
    pieces = (rows.select("lang", "t", "bytes", F.explode(numbers).alias("k"))
              .select("lang", F.xxhash64("t", "k", F.lit(seed)).alias("h"),
                      F.least(F.lit(size), F.col("bytes") - F.col("k") * size).cast("bigint").alias("size")))
    kind, prune = "lang string, h bigint, size bigint", _lowest(max_bytes_per_language)
    for keys in (("lang", "h"), ("lang",)):
        pieces = pieces.mapInPandas(prune, kind).repartition(*keys)
    limits = pieces.mapInPandas(prune, kind).groupBy("lang").agg(F.max("h").alias("most")).collect()
    limits = labelled.sparkSession.createDataFrame([tuple(r) for r in limits], "lang string, most bigint")

    def cut(batches):
        import pyarrow as pa
        seen = set()
        for batch in (part for whole in batches for part in text_slices(whole)):
            out = []
            for name, t, x, ks in zip(*(batch.column(c).to_pylist() for c in ("lang", "t", "text", "ks"))):
                ks = [k for k in ks if (name, t, k) not in seen]
                seen.update((name, t, k) for k in ks)
                raw = x.encode() if ks else b""
                out += [(name, t, k, raw[max(0, k * size - ORDER):(k + 1) * size]) for k in ks]
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], kind) for j, kind in enumerate(kinds)],
                                             ["lang", "t", "k", "piece"])

    return (rows.join(F.broadcast(limits), "lang")
            .select("lang", "t", "text", F.filter(numbers, lambda k: F.xxhash64("t", k, F.lit(seed)) <= F.col("most")).alias("ks"))
            .where(F.size("ks") > 0)
            .mapInArrow(cut, "lang string, t bigint, k int, piece binary")
            .groupBy("lang", "t", "k").agg(F.first("piece").alias("piece"))
            .select("lang", (F.col("k") > 0).alias("inner"), "piece"))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang",
        max_bytes_per_language: int = 1_000_000, seed: int = 7) -> ContextTrees:
    """Learn from a bounded ``sample`` of the rows of ``labelled`` with a text and a language.

    Counts are summed in the tasks, so the driver gets the trees (at most one
    count a sampled byte) and no text.
    """

    def count(batches):
        for pdf in batches:
            for name, part in pdf.groupby("lang"):
                yield _ngram_counts(part["piece"], part["inner"]).assign(lang=name)

    counts = (sample(labelled, text, lang, max_bytes_per_language, seed)
              .mapInPandas(count, "code bigint, n bigint, lang string")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(counts["lang"].unique())
    if not languages:
        return ContextTrees([], np.zeros(256, np.int32), np.zeros(1, np.int32), np.zeros((1, 1, 0), np.float32))
    return _trees(languages, counts)


def _trees(languages: list[str], counts: pd.DataFrame) -> ContextTrees:
    code = counts["code"].to_numpy(dtype=np.int64)
    seen = np.unique(code & 511)
    classes = np.ones(256, dtype=np.int32)
    classes[seen] = np.arange(2, 2 + len(seen))
    width = 2 + len(seen)
    of = np.concatenate([classes, [0]])  # 256 marks the start
    symbol = of[code & 511]
    back = [of[(code >> (9 * k)) & 511] for k in range(1, ORDER + 1)]  # nearest byte first
    lang = np.searchsorted(languages, counts["lang"].to_numpy(dtype=str))
    n = counts["n"].to_numpy(dtype=np.float64)

    # row 0 is the empty context; then the contexts of one, two and three classes that were seen
    rows: dict[int, tuple[np.ndarray, int]] = {}
    base = 1
    for k in range(1, ORDER + 1):
        packed = sum(back[j].astype(np.int64) * width**j for j in range(k))
        keys = np.unique(packed)
        rows[k] = (keys, base)
        base += len(keys)
    lengths = np.empty((base, width, len(languages)), dtype=np.float32)

    def coded(mine: np.ndarray, row: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Code lengths in the contexts ``row`` counts, from those in their shorter contexts."""
        table = np.zeros(shorter.shape)
        np.add.at(table, (row, symbol[mine], lang[mine]), n[mine])
        total, kinds = table.sum(axis=1, keepdims=True), (table > 0).sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = -np.log2(table / (total + kinds))
            escape = -np.log2(kinds / (total + kinds))
        return np.where(table > 0, hit, np.where(total > 0, escape, 0) + shorter)

    every = np.arange(len(code))
    lengths[:1] = coded(every, np.zeros(len(code), np.int64), np.full((1, width, len(languages)), 8.0))
    for k in range(1, ORDER + 1):
        keys, start = rows[k]
        packed = sum(back[j].astype(np.int64) * width**j for j in range(k))
        if k == 1:
            parent = np.zeros(len(keys), np.int64)
        else:
            up, up_start = rows[k - 1]
            parent = up_start + np.searchsorted(up, keys % width**(k - 1))
        where = np.searchsorted(keys, packed)
        for a in range(0, len(keys), 4096):  # a slice of contexts at a time
            b = min(a + 4096, len(keys))
            mine = np.flatnonzero((where >= a) & (where < b))
            lengths[start + a:start + b] = coded(mine, where[mine] - a, lengths[parent[a:b]])

    # every three-class context -> its longest context that was seen
    every = np.arange(width**ORDER, dtype=np.int64)  # by _bits, nearest class lowest
    nodes = np.zeros(width**ORDER, dtype=np.int32)
    for k in range(1, ORDER + 1):
        keys, start = rows[k]
        low = every % width**k
        at = np.minimum(np.searchsorted(keys, low), len(keys) - 1)
        nodes = np.where(keys[at] == low, start + at, nodes).astype(np.int32)
    return ContextTrees(languages, classes, nodes, lengths)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: ContextTrees, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; input columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def best(texts: pd.Series) -> pd.DataFrame:
        trees = shared.value
        if not trees.languages:
            return pd.DataFrame({"lang": ["und"] * len(texts), "score": 0.0})
        bits = trees.code_lengths([t.encode() for t in texts])
        least = bits.min(axis=1, keepdims=True)
        score = 1 / np.exp2(np.clip(least - bits, -1000, 0)).sum(axis=1)
        names = np.array(trees.languages, dtype=object)
        return pd.DataFrame({"lang": names[bits.argmin(axis=1)], "score": score})

    known = has_letter(F.col(text))
    return (docs.drop("lang_pred", "score")
            .withColumn("_known", known)
            .withColumn("_best", best(F.when(F.col("_known"), F.col(text)).otherwise(F.lit(""))))
            .withColumns({"lang_pred": F.when(F.col("_known"), F.col("_best.lang")).otherwise("und"),
                          "score": F.when(F.col("_known"), F.col("_best.score")).otherwise(0.0)})
            .drop("_known", "_best"))
