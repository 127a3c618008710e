"""Token sequences packed to a length limit by minimum bin slack.

Documents are encoded in the tasks and cut into pieces of at most ``limit``
ids. Which pieces share a sequence depends on their lengths alone, so the plan
is made from the histogram of lengths (``limit`` counts at most, whatever the
corpus): for each sequence the longest length left is set, and subset sums of
the lengths that are left, held as the bits of an integer, give the fullest
combination for the rest of it. The combination is taken as often as the counts
allow and removed. A combination stays out of reach once it is taken, and every
time a count is used up or at least halved, so the plan has at most some three
combinations a length, each of at most ``sqrt(2 * limit)`` lengths; its size
does not follow the corpus.

Pieces of one length are numbered by task and position, with prefix sums over
the tasks, and each number finds its sequence and offset in the plan. No text
or id is shuffled and no group is gathered, however many pieces a length has.

Defined results: a null text is the empty one and is a piece of the end id
alone; every row is packed, rows that repeat an id or a text included; null
ids stay null; an empty table gives no pieces. Only the id and text columns are
used, so extra columns cannot clash.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, text_slices

#: Words whose ids a worker remembers; it begins anew beyond that.
REMEMBERED = 900_000
#: Characters of one text, and of texts together, that are cut into words at once.
PART = 1 << 20
SLICE = 8 << 20


#: Classes of the bytes of a folded text: blank, letter, digit, other. ``C2`` begins the two marks of DOUBTFUL's class.
BLANK, LETTER, DIGIT, OTHER = range(4)


def _byte_classes() -> np.ndarray:
    kind = np.full(256, OTHER, dtype=np.uint8)
    kind[list(b"\t\n\r ")] = BLANK
    kind[list(b"abcdefghijklmnopqrstuvwxyz")] = LETTER
    kind[list(b"0123456789")] = DIGIT
    kind[0x80:] = LETTER
    kind[0xC2] = OTHER
    return kind


CLASSES = _byte_classes()


class WordEncoder:
    """Whole-text ids of a tokenizer that drops white space and encodes word by word.

    A word's ids do not depend on its neighbours, and its last id is one that
    ends a word. So many texts are cut at once, by the classes of their bytes as
    the tokenizer's own pattern does it; the library is given the words not seen
    before, joined by blanks, and its ids are cut at the word ends; and the ids
    of all words are gathered from there. Texts with characters whose class is
    in doubt, or with the strings of added tokens, go to the library whole, as do
    all texts of another kind of tokenizer.
    """

    #: The published pattern of the words, and the characters it is applied to here.
    TOLD = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    DOUBTFUL = re.compile("[^\t\n\r -~¡¿À-ÖØ-öø-įı-ɏ]")
    BLANK = re.compile("[\t\n\r ]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        steps = (told.get("normalizer") or {}).get("normalizers") or []
        cuts = (told.get("pre_tokenizer") or {}).get("pretokenizers") or []
        suffix = told["model"].get("end_of_word_suffix")
        self.by_word = bool(
            suffix and told["model"]["type"] == "BPE" and not told["model"].get("dropout")
            and [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": "\\s+"} and steps[1]["content"] == " "
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": self.TOLD} and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed"
            and not cuts[1]["use_regex"] and not cuts[1]["add_prefix_space"])
        self.added = [t["content"] for t in told.get("added_tokens", [])]
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if suffix:
            for token, i in vocabulary.items():
                self.ends[i] = token.endswith(suffix)
        if self.by_word:
            # for words that are already cut and folded
            self.bare = Tokenizer.from_file(path)
            self.bare.normalizer = normalizers.Sequence([])
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}                  # word to its number
        self.sizes = np.zeros(0, dtype=np.int64)           # ids of each word
        self.ids = np.zeros(0, dtype="<u4")                # all words' ids, one after another

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def learn(self, words: list[bytes]) -> None:
        sizes, ids = [self.sizes], [self.ids]
        for a in range(0, len(words), 2000):
            part = [w.decode() for w in words[a:a + 2000]]
            some = np.array(self.bare.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            size = np.diff(np.flatnonzero(self.ends[some]) + 1, prepend=0)
            if len(size) != len(part):  # a word that does not end in such an id
                each = [self.whole(w) for w in part]
                some, size = np.concatenate(each), np.array([len(x) for x in each])
            ids.append(some)
            sizes.append(size)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.sizes, self.ids = np.concatenate(sizes), np.concatenate(ids)

    def words(self, data: bytes):
        """The words of folded bytes, as an Arrow array, and where each begins. The bytes end with two blanks."""
        import pyarrow as pa
        buf = np.frombuffer(data, np.uint8)
        kind = CLASSES[buf]
        marks = np.flatnonzero(buf == 0xC2)
        kind[marks + 1] = OTHER
        begins = np.empty(len(buf), dtype=bool)
        begins[0] = kind[0] != BLANK
        begins[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) & (kind[1:] != BLANK)
        # an apostrophe alone before certain letters takes them along
        at = np.flatnonzero((buf[:-1] == 39) & begins[:-1] & (kind[1:] == LETTER))
        one, two = buf[at + 1], buf[at + 2]
        taken = np.where(np.isin(one, list(b"stmd")), 1, 0)
        taken[((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)] = 2
        at, taken = at[taken > 0], taken[taken > 0]
        begins[at + 1] = False
        begins[at + 1 + taken] |= kind[at + 1 + taken] == LETTER
        keep = kind != BLANK
        start = np.flatnonzero(begins)
        offsets = np.append(np.cumsum(keep, dtype=np.int64)[start] - 1, np.count_nonzero(keep)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(start), [
            None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(buf[keep].tobytes())]), start

    def cut(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of texts whose characters are all of a known class."""
        folded = [p.lower().encode() for p in parts]
        words, start = self.words(b" ".join(folded) + b"  ")
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > REMEMBERED:
            self.forget()
        self.learn([w for w in distinct if w not in self.known])
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        code = number[np.asarray(coded.indices)] if len(distinct) else np.zeros(0, np.int64)
        first = np.cumsum(self.sizes) - self.sizes
        size = self.sizes[code]
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        ids = self.ids[np.arange(total) + np.repeat(first[code] - (upto - size), size)]
        ends = np.searchsorted(start, np.cumsum([len(f) + 1 for f in folded]))
        bounds = np.concatenate([[0], upto])[ends]
        return np.split(ids, bounds[:-1])

    def parts(self, text: str):
        """The text in parts, cut at white space."""
        first = 0
        while len(text) - first > PART:
            at = self.BLANK.search(text, first + PART)
            if at is None:
                break
            yield text[first:at.start()]
            first = at.end()
        yield text[first:] if first else text

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[str] = []
        owner: list[int] = []
        size = 0

        def take():
            for i, ids in zip(owner, self.cut(held)):
                out[i].append(ids)
            held.clear()
            owner.clear()

        for i, text in enumerate(texts):
            if not self.by_word or self.DOUBTFUL.search(text) or any(a in text for a in self.added):
                out[i].append(self.whole(text))
                continue
            for part in self.parts(text):
                held.append(part)
                owner.append(i)
                size += len(part)
                if size > SLICE:
                    take()
                    size = 0
        if held:
            take()
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, limit: int, doc_id: str = "doc_id", text: str = "text",
               with_ids: bool = False) -> DataFrame:
    """One row a piece, numbered among the pieces of its length in its task (``shard, length, nth``)."""

    def cut(batches):
        import pyarrow as pa
        enc = encoder(tokenizer)
        tail = np.array([end_id], dtype="<u4").tobytes()
        shard = TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, dtype=np.int64)
        for batch in (part for whole in batches for part in text_slices(whole, most=SLICE)):
            names = batch.column("doc_id")
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, raw in enumerate(enc.encode(batch.column("text").to_pylist())):
                raw = raw.tobytes() + tail
                for k, a in enumerate(range(0, len(raw), 4 * limit)):
                    part = raw[a:a + 4 * limit]
                    rows.append(i)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4"))
            sizes = np.array(length, dtype=np.int64)
            order = np.argsort(sizes, kind="stable")
            first = np.searchsorted(sizes[order], sizes[order])
            nth = np.empty(len(sizes), dtype=np.int64)
            nth[order] = seen[sizes[order]] + np.arange(len(sizes)) - first
            seen += np.bincount(sizes, minlength=limit + 1)
            columns = [names.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(sizes), pa.array(crc, pa.int64()), pa.array(np.full(len(sizes), shard, dtype=np.int32)),
                       pa.array(nth)]
            if with_ids:
                columns.append(pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, fields)

    fields = ["doc_id", "piece", "start", "length", "ids_crc32", "shard", "nth"] + ["ids"] * with_ids
    schema = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, shard int, nth bigint"
              + ", ids array<bigint>" * with_ids)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, schema)


def fullest(available: dict[int, int], room: int) -> dict[int, int]:
    """Lengths (with how many of each) that fill ``room`` best, by subset sums over bits.

    Bit ``i`` of ``reach`` says that some combination of the lengths so far
    sums to ``i``. Lengths are taken in descending order until ``room`` itself
    is reached.
    """
    reach, full, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in available if x <= room), reverse=True):
        left = min(available[length], room // length)
        size = 1
        while left and not reach >> room & 1:
            n = min(size, left)
            steps.append((length, n, reach))
            reach |= reach << length * n & full
            left -= n
            size *= 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, n, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + n
            at -= length * n
    return used


def plan_sequences(counts: dict[int, int], limit: int) -> list[tuple[int, dict[int, int], int]]:
    """``(first sequence, {length: how many}, sequences made so)`` until no length is left."""
    left = {k: n for k, n in counts.items() if n}
    plan, sequences = [], 0
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        used = fullest({k: n for k, n in rest.items() if n}, limit - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        plan.append((sequences, used, times))
        sequences += times
        for k, n in used.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


class Places:
    """The plan by length: where the ``k``-th piece of a length goes. Sent to the tasks; bounded by the limit."""

    def __init__(self, plan):
        seen: dict[int, int] = {}
        rows: dict[int, list] = {}
        for first, used, times in plan:
            offset = 0
            for length in sorted(used, reverse=True):
                n = used[length]
                low = seen.get(length, 0)
                rows.setdefault(length, []).append((low, first, n, offset))
                seen[length] = low + n * times
                offset += n * length
        self.rows = {k: np.array(v, dtype=np.int64).T for k, v in rows.items()}

    def of(self, length: int, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of ``length`` numbered ``k``."""
        low, first, n, offset = self.rows[length]
        at = np.searchsorted(low, k, side="right") - 1
        past = k - low[at]
        return first[at] + past // n[at], offset[at] + past % n[at] * length


def pack(docs: DataFrame, tokenizer: str, end_id: int, limit: int = 4096, doc_id: str = "doc_id", text: str = "text",
         with_ids: bool = False) -> DataFrame:
    """Pack every row: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) of each piece.

    ``tokenizer``: a tokenizers JSON file that every worker can open.
    ``end_id`` follows each document's ids. Only a document with more than
    ``limit`` ids is cut; offsets of a sequence's pieces leave no gap.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    pieces = materialise(cut_pieces(docs, tokenizer, end_id, limit, doc_id, text, with_ids), "pieces")
    held = materialise(pieces.groupBy("shard", "length").agg(F.count("*").alias("n")), "piece-lengths")
    # one row a length: at most ``limit``
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(Places(plan_sequences(counts, limit)))
    before = held.select("shard", "length", (F.sum("n").over(W.partitionBy("length").orderBy("shard")) - F.col("n"))
                         .alias("before"))

    def place(batches):
        import pyarrow as pa
        for batch in batches:
            size = np.asarray(batch.column("length"))
            k = np.asarray(batch.column("k"))
            sequence, offset = np.empty(len(k), dtype=np.int64), np.empty(len(k), dtype=np.int64)
            order = np.argsort(size, kind="stable")
            cuts = np.flatnonzero(np.diff(size[order])) + 1
            for some in np.split(order, cuts):
                if len(some):
                    sequence[some], offset[some] = places.value.of(int(size[some[0]]), k[some])
            columns = [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
              + ", ids array<bigint>" * with_ids + ", sequence_id bigint, offset bigint")
    numbered = pieces.join(before, ["shard", "length"]).withColumn("k", F.col("before") + F.col("nth"))
    return numbered.select(*kept, "k").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, offsets`` of each sequence, from ``pack(..., with_ids=True)``.

    A sequence holds at most ``limit`` ids, so no group is large.
    """
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (packed.groupBy("sequence_id").agg(inside.alias("p"))
            .select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"),
                    F.col("p.offset").alias("offsets")))
