"""Repeated byte strings of ``length`` or more, found and removed across all documents.

The suffixes that matter are sampled by content: of the ``length // 2``-byte
strings in each window of ``length`` bytes, the one with the least hash (the
leftmost of equals) is the window's anchor. Equal windows have equal anchors at
equal offsets, so it is enough to compare suffixes that begin at anchors with
the same hash. Consecutive windows with the same anchor are one cell.

* Pass 1 counts cells. A cell whose whole text stands elsewhere too needs
  nothing more; an anchor seen once is dropped.
* Pass 2 fetches, for the anchors that cells of different texts share, each
  distinct text once. Per anchor these make an enhanced suffix array: suffixes
  sorted from the anchor on, with the common prefix lengths of neighbours. A
  stack scan of those lengths gives the interval tree. Each interval's members
  are sorted by what precedes the anchor, and a second scan keeps the sets whose
  left extensions differ: the maximal repeats ``(left, right)`` around the
  anchor with all their members, not only neighbours.

Every window that stands anywhere else lies in such a repeat, or in a repeated
cell, and nothing else does, so the bytes covered are exact.

An anchor shared by more than ``SPLIT`` different cells (a passage in very many
near copies) is not gathered in one task: its windows are counted one by one
with a pre-aggregated count, spread over all tasks, which covers the same bytes.

Defined results: null is the empty text; texts shorter than ``length`` lose
nothing; texts of at least ``length`` bytes that stand more than once are
removed whole from every row; ids may be null or repeat (rows are told apart by
id and text); empty tables give empty results; very long texts are scanned in
pieces of bounded size. Only the id and text columns are used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IdFilter, materialise, text_slices
from .shingles import _BASE, _mix, _powers

_U = np.uint64
PIECE = 1 << 20
SPLIT = 2000
FILTER_BITS = 25
_BYTES = _mix(np.arange(1, 257, dtype=_U) * _U(0x9FB21C651E98DF25))


class Cells:
    """The cells of one piece of text (or of several texts laid end to end)."""

    def __init__(self, data: bytes, stops: np.ndarray, length: int):
        """``stops``: end of each text in ``data``."""
        raw = np.frombuffer(data, np.uint8)
        n, k = len(raw), length // 2
        w = length - k + 1
        up, down = _powers(n + 1)
        sums = np.zeros(n + 1, dtype=_U)
        np.cumsum(_BYTES[raw] * up[:n], dtype=_U, out=sums[1:])
        self.sums, self.down = sums, down
        m = n - length + 1
        grams = self.hash(np.arange(n - k + 1), k)
        least, at = grams, np.arange(len(grams), dtype=np.int32)
        have = 1
        while have < w:  # minima of ever wider windows; the left one wins ties
            step = min(have, w - have)
            right = least[step:] < least[:len(least) - step]
            least = np.where(right, least[step:], least[:len(right)])
            at = np.where(right, at[step:], at[:len(right)])
            have += step
        at = at[:m].copy()
        starts = np.arange(m)
        inside = starts + length <= stops[np.searchsorted(stops, starts, side="right")]
        at[~inside] = -1
        edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([edge[1:], [m]]) - 1
        held = at[edge] >= 0
        self.first, self.last, self.anchor = edge[held], last[held], at[edge[held]].astype(np.int64)
        # a cell ends with its text
        self.low, self.high = self.anchor - self.last, self.anchor - self.first
        size = self.last + length - self.first
        self.h = grams[self.anchor].view(np.int64)
        self.u = _mix(self.hash(self.first, size) + (self.low * 1024 + self.high).astype(_U) * _U(0xA24BAED4963EE407)).view(np.int64)

    def hash(self, start: np.ndarray, size) -> np.ndarray:
        return _mix((self.sums[start + size] - self.sums[start]) * self.down[start])


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(number of the first text, offset in it, bytes, ends): short texts together, long ones cut with an overlap."""
    first = 0
    while first < len(texts):
        size = len(texts[first])
        if size > PIECE:
            for at in range(0, size - length + 1, PIECE):
                part = texts[first][at:at + PIECE + length - 1]
                yield first, at, part, np.array([len(part)])
            first += 1
            continue
        last, total = first, 0
        while last < len(texts) and total + len(texts[last]) <= PIECE:
            total += len(texts[last])
            last += 1
        if total >= length:
            yield first, 0, b"".join(texts[first:last]), np.cumsum([len(t) for t in texts[first:last]])
        first = last


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def lcp_intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan: ``(value, first, last)`` of each interval of value ``least`` or more; lcp[i] is of i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > value:
            top, first = stack.pop()
            if top >= least:
                yield top, first, i
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """``(left, right, members)``: the members share exactly so many bytes before and from their anchors.

    ``lefts`` are reversed. Only repeats of ``length`` or more are given.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [_common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    by_left = sorted(range(len(lefts)), key=lefts.__getitem__)
    rank = {i: r for r, i in enumerate(by_left)}
    longest = max(map(len, lefts))
    place = {i: p for p, i in enumerate(order)}
    for right, first, last in lcp_intervals(lcp, length - longest):
        members = sorted(order[first:last + 1], key=rank.__getitem__)
        before = [_common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        for left, a, b in lcp_intervals(before, max(0, length - right)):
            found = members[a:b + 1]
            ends = min(found, key=place.__getitem__), max(found, key=place.__getitem__)
            if _common(rights[ends[0]], rights[ends[1]]) == right:  # else a longer interval has them
                yield left, right, found


def _scan(texts: DataFrame, length: int, fn, schema: str) -> DataFrame:
    """``fn(batch, number, offset, bytes, Cells)`` gives record batches; texts has d, id, text."""

    def run(batches):
        for batch in (part for whole in batches for part in text_slices(whole)):
            data = [t.encode() for t in batch.column("text").to_pylist()]
            for number, offset, part, stops in _pieces(data, length):
                cells = Cells(part, stops, length)
                if len(cells.anchor):
                    yield from fn(batch, number, offset, part, stops, cells)

    return texts.mapInArrow(run, schema)


def _whole(docs: DataFrame, length: int, label: str):
    """Row facts, texts that stand more than once, and one row of each other or repeated text to scan."""
    own = docs.withColumns({"d": F.xxhash64("text", F.lit(1)), "e": F.xxhash64("text", F.lit(2)),
                            "n": F.octet_length("text"), "id": F.coalesce("doc", F.lit(0))})
    facts = materialise(own.select("doc", "id", "d", "e", "n", F.sha2(F.col("text").cast("binary"), 256).alias("sha")),
                        f"{label}-facts")
    copied = materialise(facts.where(F.col("n") >= length).groupBy("d", "e", "n")
                         .agg(F.count("*").alias("copies"), F.min("id").alias("kept")).where("copies > 1"), f"{label}-copied")
    asked = IdFilter(copied.select("d"))

    @F.pandas_udf("boolean")
    def maybe(d: pd.Series) -> pd.Series:
        return pd.Series(asked.may_contain(d.to_numpy(dtype=np.int64)))

    long = own.where(F.col("n") >= length).withColumn("maybe", maybe("d")).select("id", "d", "e", "n", "text", "maybe")
    doubtful = (long.where("maybe").join(copied, ["d", "e", "n"], "left")
                .where(F.col("kept").isNull() | (F.col("kept") == F.col("id"))))
    return own, facts, copied, long.where(~F.col("maybe")).select("d", "id", "text").union(doubtful.select("d", "id", "text"))


def find_repeats(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text",
                 label: str = "repeats", all_members: bool = False, reach_only: bool = False):
    """``(facts, copied, spans)``.

    ``spans``: ``d, id`` (the text), ``g`` (repeat group), ``start``, ``stop`` in
    bytes; each text that stands more than once is scanned once. With
    ``all_members`` every group lists all its occurrences; otherwise cells that
    are repeated whole are left out of the groups they do not add bytes to.
    With ``reach_only`` the repeats around an anchor are told as the one stretch
    of bytes that they cover together, and ``g`` is null there: every repeat
    holds its anchor, so they overlap or meet, and nested ones are no rows.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own, facts, copied, texts = _whole(docs, length, label)

    def count(batch, number, offset, part, stops, cells):
        import pyarrow as pa
        u, first, n = np.unique(cells.u, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(cells.h[first]), pa.array(u), pa.array(n.astype(np.int64))], ["h", "u", "n"])

    # rows stay by anchor for both aggregates: one shuffle
    cells = (_scan(texts, length, count, "h bigint, u bigint, n bigint").repartition("h")
             .groupBy("h", "u").agg(F.sum("n").alias("n")))
    seen = materialise(cells.groupBy("h").agg(
        F.count("*").alias("kinds"), F.sum("n").alias("n"),
        F.min("u").alias("u")).where("n > 1"), f"{label}-anchors")
    plain = seen.where("kinds = 1")  # every cell of the anchor is the same: repeated whole
    mixed = seen.where("kinds > 1")
    plain_filter, mixed_filter = IdFilter(plain.select("u"), FILTER_BITS), IdFilter(mixed.select("h"), FILTER_BITS)

    def fetch(batch, number, offset, part, stops, cells):
        import pyarrow as pa
        whole, partly = plain_filter.may_contain(cells.u), mixed_filter.may_contain(cells.h)
        at = np.flatnonzero(whole | partly)
        if not len(at):
            return
        text = np.searchsorted(stops, cells.first[at], side="right")
        base = np.concatenate([[0], stops[:-1]])[text] - offset
        rows = pa.array(number + text)
        _, new = np.unique(np.where(partly[at], cells.u[at], 0), return_index=True)
        fresh = np.zeros(len(at), dtype=bool)
        fresh[new] = True
        fresh &= partly[at]  # each distinct cell text of a shared anchor goes along once a piece
        context = [part[cells.first[i]:cells.last[i] + length] if f else None for i, f in zip(at, fresh)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("d").take(rows), batch.column("id").take(rows), pa.array(cells.anchor[at] - base),
             pa.array(cells.low[at].astype(np.int32)), pa.array(cells.high[at].astype(np.int32)),
             pa.array(cells.h[at]), pa.array(cells.u[at]), pa.array(partly[at]), pa.array(context, pa.binary())],
            ["d", "id", "anchor", "low", "high", "h", "u", "partly", "context"])

    found = materialise(_scan(
        texts, length, fetch, "d bigint, id bigint, anchor bigint, low int, high int, h bigint, u bigint, "
        "partly boolean, context binary"), f"{label}-cells")
    cell = found.select("d", "id", "anchor", "low", "high", "h", "u")

    # repeated whole: exact counts of every cell that passed the filters
    counted = materialise(cell.groupBy("h", "u").agg(F.count("*").alias("n")), f"{label}-counted")
    whole = counted.where("n > 1").select("h", "u")
    variants = (found.where("context is not null").groupBy("h", "u")
                .agg(F.first("context").alias("context"), F.first("low").alias("low"), F.first("high").alias("high")))
    variants = materialise(variants.join(counted, ["h", "u"]), f"{label}-variants")
    kinds = variants.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    kinds = materialise(kinds, f"{label}-kinds")
    few = variants.join(kinds.where(F.col("kinds") <= SPLIT).select("h"), "h")
    many = variants.join(kinds.where(F.col("kinds") > SPLIT).select("h"), "h")

    def resolve(batches):
        import pyarrow as pa
        rows = [(h, u, c, low, high, n) for b in batches for h, u, c, low, high, n in zip(
            *(b.column(x).to_pylist() for x in ("h", "u", "context", "low", "high", "n")))]
        rows.sort(key=lambda r: r[0])
        out, first = [], 0
        while first < len(rows):
            last = first
            while last < len(rows) and rows[last][0] == rows[first][0]:
                last += 1
            group = rows[first:last]
            reach: dict[int, tuple[int, int]] = {}
            if len(group) > 1:
                lefts = [r[2][:r[4]][::-1] for r in group]
                rights = [r[2][r[4]:] for r in group]
                for left, right, members in maximal_repeats(lefts, rights, length):
                    if reach_only:
                        for m in members:
                            if group[m][5] == 1:
                                a, b = reach.get(m, (0, 0))
                                reach[m] = (max(a, left), max(b, right))
                        continue
                    i = members[0]
                    text = lefts[i][:left][::-1] + rights[i][:right]
                    g = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)
                    out += [(group[m][0], group[m][1], g, -left, right) for m in members if all_members or group[m][5] == 1]
            out += [(group[m][0], group[m][1], None, -a, b) for m, (a, b) in reach.items()]
            first = last
            if len(out) > 100_000 or first == len(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], pa.int64()) for i in range(5)], ["h", "u", "g", "start", "stop"])
                out = []

    def windows(batches):
        import pyarrow as pa
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                part = b.slice(i, 2000)
                out = [(h, u, high - k, int.from_bytes(hashlib.blake2b(c[k:k + length], digest_size=8).digest(), "little", signed=True), n)
                       for h, u, c, high, n in zip(*(part.column(x).to_pylist() for x in ("h", "u", "context", "high", "n")))
                       for k in range(len(c) - length + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in out], pa.int64()) for j in range(5)], ["h", "u", "before", "g", "n"])

    shape = "h bigint, u bigint, g bigint, start bigint, stop bigint"
    within = few.select("h", "u", "context", "low", "high", "n").repartition("h").mapInArrow(resolve, shape)
    each = materialise(many.mapInArrow(windows, "h bigint, u bigint, before bigint, g bigint, n bigint"), f"{label}-windows")
    again = materialise(each.groupBy("g", "before").agg(F.count("*").alias("times")).where("times > 1"), f"{label}-again")
    one_by_one = (each.join(again, ["g", "before"]).where(F.lit(all_members) | (F.col("n") == 1))
                  .select("h", "u", "g", (-F.col("before")).alias("start"), (length - F.col("before")).alias("stop")))
    parts = materialise(within.union(one_by_one), f"{label}-parts")
    spans = (cell.join(materialise(whole, f"{label}-whole"), ["h", "u"])
             .select("d", "id", F.col("u").alias("g"), (F.col("anchor") - F.col("high")).alias("start"),
                     (F.col("anchor") - F.col("low") + length).alias("stop"))
             .union(cell.join(parts, ["h", "u"]).select(
                 "d", "id", "g", (F.col("anchor") + F.col("start")).alias("start"),
                 (F.col("anchor") + F.col("stop")).alias("stop"))))
    return own, facts, copied, spans


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of the spans."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.concatenate([[True], starts[1:] > stops[:-1]])
    return starts[new], stops[np.concatenate([np.flatnonzero(new)[1:], [len(stops)]]) - 1]


def remove_repeats(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text",
                   label: str = "repeats", with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row, and ``kept`` (bytes) on request."""
    own, facts, copied, spans = find_repeats(docs, length, doc_id, text, label, reach_only=True)
    by_text = materialise(spans.groupBy("d", "id").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans"))
        .select("d", "id", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops")), f"{label}-spans")
    asked = IdFilter(by_text.select("d"))

    @F.pandas_udf("boolean")
    def maybe(d: pd.Series) -> pd.Series:
        return pd.Series(asked.may_contain(d.to_numpy(dtype=np.int64)))

    def cut(batches):
        import pyarrow as pa
        for batch in (part for whole in batches for part in text_slices(whole)):
            out = []
            for d, i, t, starts, stops in zip(*(batch.column(c).to_pylist() for c in ("d", "id", "text", "starts", "stops"))):
                data = t.encode()
                a, b = merged(np.array(starts), np.array(stops))
                kept = b"".join(data[x:y] for x, y in zip([0, *b], [*a, len(data)]))
                out.append((d, i, int((b - a).sum()), len(a), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], kind) for j, kind in enumerate(kinds)],
                                             ["d", "id", "removed", "spans", "kept_sha", "kept"])

    changed = (own.where(maybe("d")).select("d", "id", "text").join(by_text, ["d", "id"])
               .mapInArrow(cut, "d bigint, id bigint, removed bigint, spans bigint, kept_sha string, kept binary"))
    changed = materialise(changed.dropDuplicates(["d", "id"]), f"{label}-changed")
    gone = F.col("copies").isNotNull()
    rows = facts.join(copied.select("d", "e", "n", "copies"), ["d", "e", "n"], "left").join(changed, ["d", "id"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    columns = [F.col("doc").alias(doc_id), F.col("n").cast("bigint").alias("n_bytes"),
               F.when(gone, F.col("n")).otherwise(F.coalesce("removed", F.lit(0))).cast("bigint").alias("n_removed"),
               F.when(gone, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("bigint").alias("n_spans"),
               F.when(gone, F.lit(empty)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256")]
    if with_text:
        whole = own.select("d", F.col("id").alias("id"), F.col("text").cast("binary").alias("whole")).dropDuplicates(["d", "id"])
        rows = rows.join(whole, ["d", "id"], "left")
        columns.append(F.when(gone, F.lit(b"")).otherwise(F.coalesce("kept", "whole")).alias("kept"))
    return rows.select(*columns)
