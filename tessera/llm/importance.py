"""Importance resampling towards a target, with word runs hashed through an Aho-Corasick dictionary.

Features are all runs of one to ``n`` consecutive words, hashed by the CRC-32
of their UTF-8 bytes. The dictionary holds the corpus's most frequent words, a
bounded number of bounded bytes, each as a pattern between two blanks with its
CRC and length as payload. One scan of an automaton over the bytes of many texts
emits the payloads of the words they hold; words outside the dictionary get the
same payload from their own bytes, so every feature is exact whatever the
dictionary holds. The CRC of a run comes from its words' payloads: moving a
CRC past ``m`` further bytes is linear over bits, so a run is put together with
four table look-ups a word, for all runs of a slice at once in numpy.

Bucket counts are summed in the tasks before they are shuffled (``buckets`` rows
a task at most), gains are one number a bucket, and a second scan scores
each document. Drawn ranks come from a range partition by score, numbered
within each range; no window runs over all rows.

Defined results: null texts have no words and no features; every row is scored
and drawn by itself, rows that repeat an id included; a null id is hashed as the
empty string and comes last among ties; an empty target or corpus gives
gains all the same (counts of nothing); an empty table of documents gives no
rows. Only the id and text columns are used, so extra columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, text_slices

#: Words of the dictionary and their longest length in bytes: together the bound of what is sent to the tasks.
DICTIONARY_WORDS = 1 << 16
WORD_BYTES = 64
#: Distinct words a task counts before it passes its counts on.
COUNTED = 400_000
MOST_LENGTH = 256
#: Bytes of text that are scanned at once.
SEGMENT = 1 << 21


def _folding() -> bytes:
    """A-Z to a-z, every other ASCII character but digits and letters to a blank, all other bytes kept."""
    return bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
                 for b in range(256))


FOLD = _folding()


def _zero_tables() -> np.ndarray:
    """``[length][byte of the CRC][its value]``: what a CRC becomes ``length`` zero bytes on."""
    one = np.empty(256, dtype=np.uint32)
    for b in range(256):
        c = b
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        one[b] = c
    out = np.empty((MOST_LENGTH + 1, 4, 256), dtype=np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, MOST_LENGTH + 1):
        out[n] = one[out[n - 1] & np.uint32(255)] ^ out[n - 1] >> np.uint32(8)
    return out


ZEROS = _zero_tables()


def joined(crc: np.ndarray, more: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of ``a + b`` from those of ``a`` (``crc``) and of ``b`` (``more``, of ``length`` bytes)."""
    left = length.copy()
    far = left > MOST_LENGTH
    while far.any():
        c = crc[far]
        crc = crc.copy()
        crc[far] = (ZEROS[MOST_LENGTH, 0][c & 255] ^ ZEROS[MOST_LENGTH, 1][c >> 8 & 255]
                    ^ ZEROS[MOST_LENGTH, 2][c >> 16 & 255] ^ ZEROS[MOST_LENGTH, 3][c >> 24])
        left[far] -= MOST_LENGTH
        far = left > MOST_LENGTH
    return (ZEROS[left, 0, crc & 255] ^ ZEROS[left, 1, crc >> 8 & 255] ^ ZEROS[left, 2, crc >> 16 & 255]
            ^ ZEROS[left, 3, crc >> 24] ^ more)


class Scanner:
    """Automaton over `` word `` patterns. A pattern's value is the place of its payload in ``crc`` and ``length``."""

    def __init__(self, words: list[bytes]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, w in enumerate(words):
            # one character a byte, so that places and lengths are those of the bytes
            self.automaton.add_word(f" {w.decode('latin-1')} ", i)
        self.crc = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        self.empty = not words
        if words:
            self.automaton.make_automaton()

    def words(self, folded: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """CRC and length of every word of folded texts, in order, and the number of words of each."""
        data = b" " + b" ".join(folded) + b" "
        blank = np.frombuffer(data, np.uint8) == 32
        start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        end = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        crc = np.zeros(len(start), dtype=np.uint32)
        missing = np.ones(len(start), dtype=bool)
        if not self.empty:
            found = np.fromiter((x for pair in self.automaton.iter(data.decode("latin-1")) for x in pair), np.int64)
            at, which = found[0::2], found[1::2]
            # a match ends with the blank after its word
            word = np.searchsorted(start, at - self.length[which])
            crc[word] = self.crc[which]
            missing[word] = False
        for i in np.flatnonzero(missing).tolist():
            crc[i] = zlib.crc32(data[start[i]:end[i]])
        ends = np.cumsum([len(x) + 1 for x in folded])
        upto = np.searchsorted(start, ends, side="right")
        return crc, end - start, np.diff(upto, prepend=0)


def segments(texts: list[str | None], n: int):
    """Folded texts in groups of about ``SEGMENT`` bytes: ``(bytes, index of each one's text, sign)``.

    A longer text comes in several segments, each repeating the last ``n - 1``
    words before it; those words then come alone with a negative sign. So the
    signed sums over the segments of a text count each of its runs once.
    """
    group: list[bytes] = []
    owner: list[int] = []
    sign: list[int] = []
    held = 0
    for i, t in enumerate(texts):
        data = (t or "").encode().translate(FOLD)
        first, tail = 0, b""
        while first == 0 or first < len(data):
            last = len(data)
            if last - first > SEGMENT:
                at = data.find(b" ", first + SEGMENT)
                last = last if at < 0 else at + 1
            if tail:
                group.append(tail)
                owner.append(i)
                sign.append(-1)
            group.append(tail + b" " + data[first:last] if tail else data[first:last] if first or last < len(data) else data)
            owner.append(i)
            sign.append(1)
            held += len(group[-1])
            # blanks may be many, so the last words are looked for from the end
            tail = b" ".join(group[-1].rsplit(None, n - 1)[-(n - 1):]) if n > 1 and last < len(data) else b""
            first = max(last, 1)
            if held > SEGMENT:
                yield group, np.array(owner), np.array(sign)
                group, owner, sign, held = [], [], [], 0
    if group:
        yield group, np.array(owner), np.array(sign)


def runs(crc: np.ndarray, length: np.ndarray, n_words: np.ndarray, most: int):
    """For each run length: CRCs of all runs, and the text each belongs to."""
    text = np.repeat(np.arange(len(n_words)), n_words)
    last = np.repeat(np.cumsum(n_words), n_words)
    place = np.arange(len(crc))
    blank = np.full(len(crc), 1, dtype=np.int64)
    sofar = crc
    for n in range(1, most + 1):
        if n > 1:
            keep = place + n <= last
            place, text, last, sofar = place[keep], text[keep], last[keep], sofar[keep]
            spaced = joined(sofar, np.full(len(sofar), BLANK_CRC, dtype=np.uint32), blank[:len(sofar)])
            sofar = joined(spaced, crc[place + n - 1], length[place + n - 1])
        yield sofar, text


BLANK_CRC = zlib.crc32(b" ")
_SCANNERS: dict[int, Scanner] = {}


def scanner(shared) -> Scanner:
    """One automaton for each worker process and dictionary, kept between tasks."""
    if shared.id not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[shared.id] = Scanner(shared.words.value)
    return _SCANNERS[shared.id]


class Dictionary:
    """The words sent to the tasks."""

    def __init__(self, spark, words: list[bytes]):
        self.words = spark.sparkContext.broadcast(words)
        self.id = self.words._jbroadcast.id()

    def __getstate__(self):
        return {"words": self.words, "id": self.id}


def frequent_words(docs: DataFrame, text: str = "text", most: int = DICTIONARY_WORDS) -> list[bytes]:
    """At most ``most`` of the corpus's words, the most frequent ones of up to ``WORD_BYTES`` bytes.

    Words are counted over all rows; the least count comes from a histogram of
    the counts, so that only the words taken reach the driver.
    """

    def count(batches):
        import pyarrow as pa
        seen: Counter = Counter()

        def told():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                              ["word", "n"])
        for batch in (part for whole in batches for part in text_slices(whole)):
            for t in batch.column("text").to_pylist():
                if t:
                    seen.update(w for w in t.encode().translate(FOLD).split() if len(w) <= WORD_BYTES)
            if len(seen) > COUNTED:
                yield told()
                seen.clear()
        if seen:
            yield told()

    counts = materialise(docs.select(F.col(text).alias("text")).mapInArrow(count, "word binary, n bigint")
                         .groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"), "words")
    # some hundred classes of counts, each within a tenth
    level = F.floor(F.log(F.col("n")) * 10)
    total, least = 0, None
    for row in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():
        total += row["n"]
        if total > most:
            break
        least = row["level"]
    if least is None:
        return []
    return [bytes(r["word"]) for r in counts.where(level >= least).select("word").collect()]


def bucket_counts(docs: DataFrame, dictionary: Dictionary, n: int, buckets: int, text: str = "text") -> DataFrame:
    """``bucket, n`` over all features of all rows; buckets without any are absent."""

    def count(batches):
        import pyarrow as pa
        scan = scanner(dictionary)
        total = np.zeros(buckets, dtype=np.int64)
        for batch in (part for whole in batches for part in text_slices(whole)):
            for group, _, sign in segments(batch.column("text").to_pylist(), n):
                for crc, text_of in runs(*scan.words(group), n):
                    total += np.bincount(crc % buckets, minlength=buckets)
                    again = sign[text_of] < 0
                    if again.any():
                        total -= 2 * np.bincount(crc[again] % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["bucket", "n"])

    return (docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket int, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """``floor(1000 * ln(((t + 1) * (S + buckets)) / ((s + 1) * (T + buckets))))`` of each bucket."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, into in ((corpus, s), (target, t)):
        for row in counts.collect():  # one row a bucket at most
            into[row["bucket"]] = row["n"]
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def scored(docs: DataFrame, dictionary: Dictionary, gain: np.ndarray, n: int, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batches):
        import pyarrow as pa
        scan, worth = scanner(dictionary), shared.value
        for batch in (part for whole in batches for part in text_slices(whole)):
            out = np.zeros((3, batch.num_rows), dtype=np.int64)
            for group, owner, sign in segments(batch.column("text").to_pylist(), n):
                crc, length, n_words = scan.words(group)
                np.add.at(out[0], owner, sign * n_words)
                for each, text_of in runs(crc, length, n_words, n):
                    # the texts of runs ascend, so sums are differences of running sums
                    sums = np.concatenate([[0], np.cumsum(worth[each % len(worth)])])
                    ends = np.searchsorted(text_of, np.arange(len(group)), side="right")
                    np.add.at(out[1], owner, sign * np.diff(ends, prepend=0))
                    np.add.at(out[2], owner, sign * np.diff(sums[ends], prepend=0))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out)],
                                              ["doc_id", "n_words", "n_features", "weight"])

    return (docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(score, "doc_id bigint, n_words bigint, n_features bigint, weight bigint"))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``score, doc_id``) and ``rank``, 1 from the highest score down, ties to the smaller id.

    Rows are dealt by range of score, id and position (which splits rows alike
    in both), numbered within their range, and the ranges' totals added up.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_at").asc()]
    names = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("_shard", T.IntegerType()),
                           T.StructField("_nth", T.LongType())])

    def number(batches):
        import pyarrow as pa
        shard, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(np.full(batch.num_rows, shard, dtype=np.int32)),
                 pa.array(np.arange(seen + 1, seen + 1 + batch.num_rows))], [*names, "_shard", "_nth"])
            seen += batch.num_rows

    dealt = rows.withColumn("_at", F.monotonically_increasing_id())
    listed = materialise(
        dealt.repartitionByRange(*order).sortWithinPartitions(*order).drop("_at")
        .mapInArrow(number, schema), "ranked")
    # one row a range; every range takes the totals of the ranges before it
    totals = [(r["_shard"], r["n"]) for r in listed.groupBy("_shard").agg(F.count("*").alias("n")).collect()]
    before, sofar = [], 0
    for shard, n in sorted(totals):
        before.append((shard, sofar))
        sofar += n
    starts = rows.sparkSession.createDataFrame(before, "_shard int, _before bigint")
    return (listed.join(F.broadcast(starts), "_shard").withColumn("rank", F.col("_before") + F.col("_nth"))
            .drop("_shard", "_nth", "_before"))


def resample(docs: DataFrame, target: DataFrame, n: int = 3, buckets: int = 10_000, percent: int = 5, least_words: int = 20,
             seed: int = 42, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every row by how much likelier its features are in ``target``, and draw by Gumbel noise.

    Returns ``doc_id, n_words, n_features, weight, score, rank``; ``rank`` is
    null where a row is not drawn. ``floor(percent * N / 100)`` of the ``N`` rows
    with at least ``least_words`` words are drawn. The noise depends on the seed
    and the id alone.
    """
    spark = docs.sparkSession
    dictionary = Dictionary(spark, frequent_words(docs, text))
    gain = gains(bucket_counts(docs, dictionary, n, buckets, text), bucket_counts(target, dictionary, n, buckets), buckets)
    rows = scored(docs, dictionary, gain, n, doc_id, text)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = materialise(rows.withColumn("score", F.col("weight") + noise), "scored")
    drawn = ranked(rows.where(F.col("n_words") >= least_words))
    few = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    most = rows.where(F.col("n_words") >= least_words).count() * percent // 100
    return drawn.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank"))).unionByName(few)
