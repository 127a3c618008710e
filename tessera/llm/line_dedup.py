"""Fuzzy line deduplication by MinHash.

Lines are compared by the Jaccard similarity of their character shingles (the
whole line if it is shorter). Signatures of ``BANDS`` times ``ROWS`` minima are
banded; equal lines share everything and are one class. Buckets are dealt into
parts, packed as arrays. In a bucket of a few lines all pairs are compared; in
any other every line is compared with one leader, which differs from band to
band; both exactly, on the lines' texts. Links join classes by distributed
union-find. A large bucket whose members are then in one component is settled.
In the rest every pair whose ends are not joined yet is compared exactly too:
the bucket is dealt into blocks of bounded size, each pair of blocks is a
task's work of its own, and overlaps are counted over the blocks' shingles, so
pairs are no rows; they give links of components. Of each component's lines
only the first is kept, by document id and line number. A part's entries (16
bytes each) are held by a task; ``PARTS`` bounds them.

So every pair that shares a bucket is compared or connected by links. At a
similarity of 0.75 a pair shares one with probability 0.997 (more above it);
pairs that share none are found only through other lines.

Defined results: a line without any visible character is structure: it is kept
and not compared. Null texts have no lines; the empty text has one such line.
Rows that repeat id and text get the same result, as one row; null ids come
first. Empty tables give empty results. Very long texts are handled a line
group at a time. Only the id and text columns are used.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IdFilter, connected_components, materialise, text_slices
from .shingles import _BASE, _mix

SHINGLE = 8
BANDS, ROWS = 16, 4
_U = np.uint64
_FACTORS = (_mix(np.arange(1, BANDS * ROWS + 1, dtype=_U) * _U(0xC6BC279692B5C323)) >> _U(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (_mix(np.arange(1, BANDS * ROWS + 1, dtype=_U) * _U(0xE7037ED1A0B428DB)) >> _U(32)).astype(np.uint32)
_LETTERS = _mix(np.arange(0x800, dtype=_U) + _U(77))
_LONG = 0xA0761D6478BD642F
_STEPS = (1, 2, 4)  # SHINGLE is 8
FILTER_BITS = 25
#: Letters, and shingles, that are worked on at once.
CACHED = 1 << 16
#: Parts that the buckets are dealt into, and entries of a task that are dealt at once.
PARTS, DEALT = 1024, 1 << 21
#: Lines of a bucket up to which all its pairs are compared without a leader.
FEW = 8
BLOCK_LINES, BLOCK_CHARS = 1024, 1 << 20
CELLS = 1 << 22


def _hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    width = np.maximum(size, SHINGLE)
    short = np.flatnonzero(size < SHINGLE)
    letters = np.frombuffer("".join([x.ljust(SHINGLE, "\0") for x in lines] if len(short) else lines).encode("utf-32-le"), np.uint32)
    sums = _LETTERS[letters] if letters.max() < len(_LETTERS) else _mix(letters.astype(_U) + _U(77))
    ends = np.cumsum(width)
    for i in short.tolist():
        sums[ends[i] - SHINGLE + size[i]:ends[i]] = 0
    for step in _STEPS:  # polynomials of 2, 4 and 8 letters
        sums = sums[:-step] + sums[step:] * _U(pow(_BASE, step, 2**64))
    starts = np.ones(len(letters), dtype=bool)
    starts[(ends[:, None] - np.arange(1, SHINGLE)).ravel()] = False
    sums = sums[starts[:len(sums)]] + _U(SHINGLE * _LONG % 2**64)
    first = np.cumsum(width - SHINGLE + 1) - (width - SHINGLE + 1)
    sums[first[short]] -= (SHINGLE - size[short]).astype(_U) * _U(_LONG)
    return _mix(sums), first


def _near(lines: list[str]):
    """Lines in groups whose arrays stay in a core's cache."""
    yield from ([x for _, x in group] for group in _groups(list(enumerate(lines)), CACHED))


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of non-empty lines, one after the other, and where each line's begin."""
    out, firsts, n = [np.zeros(0, _U)], [np.zeros(0, np.int64)], 0
    for group in _near(lines):
        hashes, first = _hashes(group)
        out.append(hashes)
        firsts.append(first + n)
        n += len(hashes)
    return np.concatenate(out), np.concatenate(firsts)


def line_keys(lines: list[str]) -> np.ndarray:
    return np.frombuffer(b"".join([hashlib.blake2b(x.encode(), digest_size=8).digest() for x in lines]), "<i8")


def bands_of(lines: list[str]) -> np.ndarray:
    """[line, band] bucket numbers."""
    minima = np.empty((BANDS * ROWS, len(lines)), dtype=np.uint32)
    n = 0
    for group in _near(lines):
        hashes, first = _hashes(group)
        low = (hashes >> _U(32)).astype(np.uint32)
        turned = np.empty_like(low)
        for k in range(BANDS * ROWS):
            np.multiply(low, _FACTORS[k], out=turned)
            np.add(turned, _SHIFTS[k], out=turned)
            np.minimum.reduceat(turned, first, out=minima[k, n:n + len(group)])
        n += len(group)
    out = np.zeros((BANDS, len(lines)), dtype=_U)
    for k in range(BANDS * ROWS):
        out[k // ROWS] = _mix(out[k // ROWS] * _U(0x9E3779B97F4A7C15) + minima[k].astype(_U) + _U(k // ROWS + 1))
    return np.ascontiguousarray(out.T).view(np.int64)


def similar(a: str, b: str, percent: int) -> bool:
    return similar_lines([a], [b], percent)[0]


def similar_lines(a: list[str], b: list[str], percent: int) -> list[bool]:
    """Whether each line of ``a`` is similar to the one of ``b``; each distinct line's shingles are made once.

    Pairs are counted some at a time: a shingle's number is its pair's, its
    hash (less the bits that the pair takes) and its side, so one sort brings
    together what a pair shares.
    """
    number: dict[str, int] = {}
    x = np.array([number.setdefault(t, len(number)) for t in a], dtype=np.int64)
    y = np.array([number.setdefault(t, len(number)) for t in b], dtype=np.int64)
    hashes, first = shingle_hashes(list(number))
    ends = np.append(first[1:], len(hashes))
    total = np.concatenate([[0], np.cumsum((ends - first)[x] + (ends - first)[y])])
    out: list[bool] = []
    i = 0
    while i < len(x):
        j = max(i + 1, int(np.searchsorted(total, total[i] + CACHED, "right")) - 1)
        both = np.stack([x[i:j], y[i:j]], axis=1).ravel()
        size = (ends - first)[both]
        bits = max(1, (j - i - 1).bit_length())
        tag = (np.arange(j - i, dtype=_U) << _U(64 - bits)).repeat(2) | np.tile(np.array([0, 1], dtype=_U), j - i)
        found = np.concatenate([hashes[s:e] for s, e in zip(first[both].tolist(), ends[both].tolist())])
        found = np.sort((found >> _U(bits + 1) << _U(1)) | tag.repeat(size))
        found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        pair = (found >> _U(64 - bits)).astype(np.int64)
        n = np.bincount(pair, minlength=j - i)
        o = np.bincount(pair[1:][found[1:] >> _U(1) == found[:-1] >> _U(1)], minlength=j - i)
        out += (100 * o >= percent * (n - o)).tolist()
        i = j
    return out


def close_pairs(lines: list[str], group: np.ndarray, side: np.ndarray, component: np.ndarray,
                percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the lines of each similar pair within a group that differ in component.

    Lines come by group. Where a group has two sides, pairs are made across them.
    Pairs within a group's largest component are not looked at.
    """
    m = len(lines)
    _, known, size = np.unique(np.stack([group, component]), axis=1, return_inverse=True, return_counts=True)
    known = known.ravel()
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    place = np.repeat(np.arange(len(starts)), np.diff(np.concatenate([starts, [m]])))
    order = np.lexsort((size[known], place))
    large = known == known[order[np.concatenate([starts[1:], [m]]) - 1]][place]
    crossed = (np.minimum.reduceat(side, starts) != np.maximum.reduceat(side, starts))[place]
    kind = 2 * (side * crossed) + large  # order of a shingle's list: sides, and in each the largest component last

    hashes, first = shingle_hashes(lines)
    line = np.repeat(np.arange(m), np.diff(np.concatenate([first, [len(hashes)]])))
    _, token = np.unique(_mix(hashes + _mix(place[line].astype(_U) + _U(1))), return_inverse=True)  # groups share none
    packed = np.sort((token.ravel() * 4 + kind[line]) * m + line)  # by shingle, kind and line
    packed = packed[np.concatenate([[True], packed[1:] != packed[:-1]])]  # a shingle of a line once
    token, line = packed // (4 * m), packed % m
    n = np.bincount(line, minlength=m)
    heads = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    at = np.repeat(np.arange(len(heads)), np.diff(np.concatenate([heads, [len(token)]])))
    of = np.bincount(4 * at + kind[line], minlength=4 * len(heads)).reshape(-1, 4)
    ends = (heads[:, None] + np.cumsum(of, axis=1))[at]  # of each kind in the shingle's list
    k, two = kind[line], crossed[line]
    left = np.where(two, ends[:, 1], np.arange(len(token)) + 1)
    right = np.where(two & (k == 1), ends[:, 2], ends[:, 3])
    right = np.where(np.where(two, k < 2, k == 0), right, left)
    use = np.flatnonzero(right > left)
    use = use[np.argsort(line[use], kind="stable")]
    left, many, asks = left[use], (right - left)[use], line[use]

    out_a, out_b = [], []
    bounds = np.flatnonzero(np.concatenate([[True], asks[1:] != asks[:-1], [True]])) if len(asks) else np.zeros(1, np.int64)
    total = np.concatenate([[0], np.cumsum(many)])
    i = 0
    while i + 1 < len(bounds):
        j = i + 1  # a few asking lines at a time
        while j + 1 < len(bounds) and (j + 1 - i) * m <= CELLS and total[bounds[j + 1]] - total[bounds[i]] <= CELLS:
            j += 1
        x, y = bounds[i], bounds[j]
        width = many[x:y]
        spots = np.arange(total[y] - total[x]) + np.repeat(left[x:y] - (total[x:y] - total[x]), width)
        asking = asks[bounds[i:j]]
        row = np.repeat(np.repeat(np.arange(j - i), np.diff(bounds[i:j + 1])), width)
        o = np.bincount(row * m + line[spots], minlength=(j - i) * m)
        cell = np.flatnonzero(o)
        a, b, o = asking[cell // m], cell % m, o[cell]
        hit = (100 * o >= percent * (n[a] + n[b] - o)) & (component[a] != component[b])
        out_a.append(a[hit])
        out_b.append(b[hit])
        i = j
    none = [np.zeros(0, np.int64)]
    return np.concatenate(out_a or none), np.concatenate(out_b or none)


def _part(numbers: np.ndarray) -> np.ndarray:
    """The part that a bucket or a line's key is dealt to."""
    return (numbers.view(_U) % _U(PARTS)).astype(np.uint16)


def meetings(buckets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of keys that meet in a bucket of few, and each key of any other bucket with the bucket's leader.

    Entries of a bucket may repeat. The third array is 0, or the bucket that has a leader.
    """
    order = np.argsort(buckets)
    same = buckets[order][1:] == buckets[order][:-1]
    order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
    buckets, keys = buckets[order], keys[order]
    order = np.lexsort((keys, buckets))
    buckets, keys = buckets[order], keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (buckets[1:] != buckets[:-1]) | (keys[1:] != keys[:-1])
    buckets, keys = buckets[new], keys[new]
    starts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])) if len(buckets) else np.zeros(0, np.int64)
    n = np.diff(np.append(starts, len(buckets)))
    left, right, led = [], [], []
    for size in range(2, FEW + 1):
        some = keys[starts[n == size][:, None] + np.arange(size)]
        i, j = np.triu_indices(size, 1)
        left.append(some[:, i].ravel())
        right.append(some[:, j].ravel())
        led.append(np.zeros(left[-1].size, np.int64))
    many = np.repeat(n > FEW, n)
    if many.any():
        keys, buckets, n = keys[many], buckets[many], n[n > FEW]
        # keys are turned by the bucket, so that leaders differ from band to band
        lead = np.minimum.reduceat(keys ^ buckets, np.cumsum(n) - n).repeat(n) ^ buckets
        left.append(keys)
        right.append(lead)
        led.append(buckets)
    return np.concatenate(left), np.concatenate(right), np.concatenate(led)


def _lines(text: str) -> list[tuple[int, str]]:
    """Lines with a visible character, by number."""
    return [(i, x) for i, x in enumerate(text.split("\n")) if x and not x.isspace()]


def _groups(items: list, most: int = 1 << 20):
    first, total = 0, 0
    for i, (_, x) in enumerate(items):
        if i > first and total + len(x) > most:
            yield items[first:i]
            first, total = i, 0
        total += len(x)
    if first < len(items):
        yield items[first:]


def drop_lines(docs: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text",
               label: str = "lines", with_text: bool = False) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of each distinct row, and ``kept`` on request.

    ``n_lines`` counts lines with a visible character; the kept text joins what
    is left by line ends.
    """
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).select(
        "doc", F.coalesce("doc", F.lit(-(2**63))).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("d", F.xxhash64("text"))

    def split(batches):
        import pyarrow as pa

        def column(values, part):
            order = np.argsort(part, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=PARTS))]) * 8
            return pa.Array.from_buffers(pa.binary(), PARTS, [None, pa.py_buffer(ends.astype(np.int32).tobytes()),
                                                              pa.py_buffer(values[order].tobytes())])

        def dealt(keys, distinct, bands):
            distinct, first = np.unique(np.concatenate(distinct), return_index=True)
            buckets = np.concatenate(bands)[first].ravel()
            part = _part(buckets)
            keys, n = np.unique(np.concatenate(keys), return_counts=True)
            keys = np.repeat(keys, np.minimum(n, 2))  # whether a line repeats is all that is asked
            batch = pa.RecordBatch.from_arrays(
                [pa.array(np.arange(PARTS, dtype=np.int32)), column(buckets, part),
                 column(np.repeat(distinct, BANDS), part), column(keys, _part(keys))], ["part", "buckets", "keys", "all"])
            return batch.filter(pa.array((np.bincount(part, minlength=PARTS) + np.bincount(_part(keys), minlength=PARTS)) > 0))

        keys, distinct, bands, n = [], [], [], 0
        for batch in (part for whole in batches for part in text_slices(whole)):
            for group in _groups([x for t in batch.column("text").to_pylist() for x in _lines(t)]):
                lines = [x for _, x in group]
                keys.append(line_keys(lines))
                some, first = np.unique(keys[-1], return_index=True)
                distinct.append(some)
                bands.append(bands_of([lines[i] for i in first.tolist()]))
                n += BANDS * len(some) + len(lines)
                if n > DEALT:
                    yield dealt(keys, distinct, bands)
                    keys, distinct, bands, n = [], [], [], 0
        if keys:
            yield dealt(keys, distinct, bands)

    def meet(batches):
        import pyarrow as pa

        def met(buckets, keys, every):
            a, b, bucket = meetings(*(np.frombuffer(b"".join(x), np.int64) for x in (buckets, keys)))
            every = np.sort(np.frombuffer(b"".join(every), np.int64))
            twice = np.unique(every[1:][every[1:] == every[:-1]])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([a, twice])), pa.array(np.concatenate([b, twice])),
                 pa.array(np.concatenate([bucket, np.zeros_like(twice)]), mask=np.concatenate([bucket == 0, twice == twice]))],
                ["a", "b", "bucket"])

        now, held = None, ([], [], [])
        for batch in batches:
            for part, *columns in zip(*(batch.column(c).to_pylist() for c in ("part", "buckets", "keys", "all"))):
                if part != now and now is not None:
                    yield met(*held)
                    held = ([], [], [])
                now = part
                for one, more in zip(held, columns):
                    one.append(more)
        if now is not None:
            yield met(*held)

    # a row is a part of a task's buckets: pairs of lines that meet in a bucket of few, each line of any other
    # bucket with the bucket's leader, and lines that repeat with themselves
    met = materialise(
        own.select("text").mapInArrow(split, "part int, buckets binary, keys binary, all binary")
        .repartition("part").sortWithinPartitions("part").mapInArrow(meet, "a bigint, b bigint, bucket bigint"), f"{label}-met")
    pairs = materialise(met.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                        f"{label}-pairs")
    compared_keys = IdFilter(pairs.select("a").union(pairs.select("b")), FILTER_BITS)
    wanted = IdFilter(met.select("a").union(met.select("b")), FILTER_BITS)

    def fetch(batches):
        import pyarrow as pa
        for batch in (part for whole in batches for part in text_slices(whole)):
            docs, d, ids, texts = (batch.column(c).to_pylist() for c in ("doc", "d", "id", "text"))
            split_up = [_lines(t) for t in texts]
            many = np.array([len(x) for x in split_up], dtype=np.int64)
            lines = [x for one in split_up for _, x in one]
            keys = line_keys(lines)
            hit = np.flatnonzero(wanted.may_contain(keys))
            row = np.repeat(np.arange(len(texts)), many)[hit]
            place = np.fromiter((n for one in split_up for n, _ in one), np.int64, len(lines))[hit]
            once = np.zeros(len(hit), dtype=bool)
            once[np.unique(keys[hit], return_index=True)[1]] = True
            once &= compared_keys.may_contain(keys[hit])
            shown = [lines[i] if yes else None for i, yes in zip(hit.tolist(), once.tolist())]
            no, none = [None] * len(hit), [None] * len(texts)
            yield pa.RecordBatch.from_arrays([
                pa.array(none + keys[hit].tolist(), pa.int64()),
                pa.array(docs + no, pa.int64()),
                pa.array(d + np.array(d, dtype=np.int64)[row].tolist(), pa.int64()),
                pa.array(ids + np.array(ids, dtype=np.int64)[row].tolist(), pa.int64()),
                pa.array(np.concatenate([many, place])),
                pa.array(none + shown, pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts] + no, pa.string())],
                ["key", "doc", "d", "id", "n", "line", "whole"])

    # a row for each text, and for each line that may repeat or be compared (its text once a batch)
    found = materialise(own.select("doc", "d", "id", "text").mapInArrow(
        fetch, "key bigint, doc bigint, d bigint, id bigint, n bigint, line string, whole string"), f"{label}-found")
    texts = materialise(found.where("line is not null").groupBy("key").agg(F.first("line").alias("line"))
                        .withColumn("size", F.length("line").cast("bigint")), f"{label}-texts")

    def verify(batches):
        import pyarrow as pa
        for batch in (part for whole in batches for part in text_slices(whole, "line", 1 << 18)):
            hit = similar_lines(batch.column("line").to_pylist(), batch.column("other_line").to_pylist(), percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(hit, pa.bool_()))

    edges = materialise(
        pairs.join(texts.select(F.col("key").alias("a"), "line"), "a")
        .join(texts.select(F.col("key").alias("b"), F.col("line").alias("other_line")), "b")
        .select("a", "b", "line", "other_line").mapInArrow(verify, "a bigint, b bigint"), f"{label}-edges")
    led = materialise(connected_components(edges, f"{label}-led"), f"{label}-known")

    # what the leaders leave open; where all buckets are of few lines, nothing
    inside = materialise(
        met.where("bucket is not null").select(F.col("a").alias("key"), "bucket").join(led, F.col("key") == F.col("node"), "left")
        .join(texts.select("key", "size"), "key")
        .select("key", "bucket", "size", F.coalesce("component", "key").alias("component")), f"{label}-inside")
    unsettled = materialise(
        inside.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("size"),
                                     F.min("component").alias("least"), F.max("component").alias("most"))
        .where("least <> most")
        .select("bucket", F.ceil(F.greatest(F.col("n") / BLOCK_LINES, F.col("size") / BLOCK_CHARS)).cast("int").alias("blocks")),
        f"{label}-unsettled")
    block = F.pmod(F.xxhash64("key", "bucket"), "blocks").cast("int")
    dealt = (inside.join(unsettled, "bucket").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "bucket", "component", "block", F.least("block", "other").alias("lo"),
                     F.greatest("block", "other").alias("hi")))

    def across(batches):
        import pyarrow as pa

        def compared(rows):
            _, group = np.unique(np.array([r[:3] for r in rows], dtype=np.int64), axis=0, return_inverse=True)
            group = group.ravel()
            order = np.argsort(group, kind="stable")
            rows, group = [rows[i] for i in order], group[order]
            component = np.array([r[5] for r in rows], dtype=np.int64)
            a, b = close_pairs([r[6] for r in rows], group, np.array([int(r[3] != r[1]) for r in rows]), component, percent)
            linked = np.unique(np.stack([component[a], component[b]]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(linked[0]), pa.array(linked[1])], ["a", "b"])

        held, chars = [], 0  # whole groups, and one that may go on
        for batch in (part for whole in batches for part in text_slices(whole, "line")):
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "lo", "hi", "block", "key", "component", "line"))):
                if held and held[-1][:3] != row[:3] and (len(held) >= BLOCK_LINES or chars >= BLOCK_CHARS):
                    yield compared(held)
                    held, chars = [], 0
                held.append(row)
                chars += len(row[6])
        if held:
            yield compared(held)

    further = materialise(
        dealt.join(texts.select("key", "line"), "key").repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
        .mapInArrow(across, "a bigint, b bigint").distinct(), f"{label}-further")
    components = led
    if not further.isEmpty():  # links of components
        joined = materialise(connected_components(further, label), f"{label}-joined").withColumnsRenamed(
            {"node": "part", "component": "whole"})
        components = materialise(
            led.join(joined, F.col("component") == F.col("part"), "left").select("node", F.coalesce("whole", "component").alias("component"))
            .union(joined.join(led, F.col("part") == F.col("node"), "left_anti").select("part", "whole")), f"{label}-components")
    placed = materialise(
        found.where("key is not null").join(components, F.col("key") == F.col("node"), "left")
        .select("d", "id", F.col("n").alias("line"), F.coalesce("component", "key").alias("component")), f"{label}-placed")
    first = materialise(placed.groupBy("component").agg(F.min(F.struct("id", "line", "d")).alias("kept"), F.count("*").alias("n"))
                        .where("n > 1").select("component", "kept"), f"{label}-first")
    dropped = materialise(
        placed.join(first, "component").where(F.struct("id", "line", "d") != F.col("kept"))
        .groupBy("d", "id").agg(F.collect_set("line").alias("lines")), f"{label}-dropped")
    asked_rows = IdFilter(dropped.select("d"))

    @F.pandas_udf("boolean")
    def maybe(d: pd.Series) -> pd.Series:
        return pd.Series(asked_rows.may_contain(d.to_numpy(dtype=np.int64)))

    def cut(batches):
        import pyarrow as pa
        for batch in (part for whole in batches for part in text_slices(whole)):
            out = []
            for d, i, t, gone in zip(*(batch.column(c).to_pylist() for c in ("d", "id", "text", "lines"))):
                gone = set(gone)
                kept = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
                out.append((d, i, len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept if with_text else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], kind) for j, kind in enumerate(kinds)],
                                             ["d", "id", "n_dropped", "sha", "kept"])

    changed = materialise(own.where(maybe("d")).select("d", "id", "text").dropDuplicates(["d", "id"]).join(dropped, ["d", "id"])
                          .mapInArrow(cut, "d bigint, id bigint, n_dropped bigint, sha string, kept string"), f"{label}-changed")
    facts = found.where("key is null").select("doc", "d", "id", F.col("n").alias("n_lines"), "whole").dropDuplicates(["d", "id"])
    if with_text:
        facts = facts.join(own.select("d", "id", "text").dropDuplicates(["d", "id"]), ["d", "id"])
    rows = materialise(facts, f"{label}-facts").join(changed, ["d", "id"], "left")
    columns = [F.col("doc").alias(doc_id), "n_lines",
               F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
               F.coalesce("sha", "whole").alias("kept_sha256")]
    if with_text:
        columns.append(F.coalesce("kept", "text").alias("kept"))
    return rows.select(*columns)
