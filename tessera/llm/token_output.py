"""Token ids written with fixed-width bit packing, readable at random.

Documents are range-partitioned and sorted by id, encoded in the tasks, and
written as shards of blocks. A block is one row of a Parquet file (so any store
Spark can write will do, and lost tasks are simply written again):

    shard, block      where the block stands; shards ascend with the ids' range
    first             ids of the shard before this block
    n_docs, n_ids     what it holds; documents stay whole within a block
    doc_ids, sizes    int64 and uint32 arrays, little-endian
    width, payload    ids of ``width`` bits each, the minimum for the vocabulary,
                      lowest bit first, the last byte padded with zeros

Any id's bits are at ``width * i`` of its block, so a block is unpacked in one
vectorised step, and a range of ids is found from the shard totals and
``first`` alone (`read_range`).

Defined results: a null text is the empty one and holds only the end id; rows
that repeat a document id are all kept, ordered by their texts; null document
ids come first and are kept as such; an empty table gives no blocks. Only the
id and text columns are used.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from itertools import chain, repeat

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import text_slices

#: Ids after which a block is closed.
BLOCK_IDS = 1 << 16
#: Pre-tokens whose ids a worker remembers; it begins anew beyond that.
REMEMBERED = 500_000
#: Characters of one text, and of texts together, that are cut at once.
PART = 1 << 20
SLICE = 2 << 20
#: Ids that are packed or unpacked at once.
STEP = 1 << 16
NO_DOC = -(2**63)

BLOCK_SCHEMA = ("shard int, block int, first bigint, n_docs int, n_ids bigint, width int, "
                "doc_ids binary, sizes binary, payload binary")


def pack(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    out = []
    # STEP is a multiple of 8, so every step but the last ends with a whole byte
    for a in range(0, len(ids), STEP):
        bits = (ids[a:a + STEP].astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(payload: bytes, width: int, first: int, n: int) -> np.ndarray:
    """Ids ``first`` to ``first + n`` of a block, reading only their bytes."""
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(payload, f"<u{size}", n, first * size).astype(np.uint32)
    out = np.empty(n, dtype=np.uint32)
    places = np.arange(width, dtype=np.uint32)
    for a in range(0, n, STEP):
        some = min(STEP, n - a)
        begin, end = (first + a) * width, (first + a + some) * width
        raw = np.frombuffer(payload, np.uint8, -(-end // 8) - begin // 8, begin // 8)
        bits = np.unpackbits(raw, bitorder="little")[begin % 8:begin % 8 + some * width].reshape(some, width)
        out[a:a + some] = (bits.astype(np.uint32) << places).sum(axis=1, dtype=np.uint32)
    return out


#: Classes of the bytes of a text: what stands between texts, letter, digit, other, white space.
BETWEEN, LETTER, DIGIT, OTHER, SPACE = range(5)


def _byte_classes() -> np.ndarray:
    kind = np.full(256, OTHER, dtype=np.uint8)
    kind[0] = BETWEEN
    kind[list(b"\t\n\r ")] = SPACE
    kind[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = LETTER
    kind[list(b"0123456789")] = DIGIT
    kind[0x80:] = LETTER
    kind[0xC2] = OTHER  # begins the two marks of DOUBTFUL's class
    return kind


CLASSES = _byte_classes()


class Encoder:
    """Whole-text ids of the tokenizers library, remembering pre-tokens.

    A byte-level BPE encodes each pre-token on its own, so texts made only of
    characters whose class is beyond doubt are cut here, many at once, as the
    tokenizer's own published pattern cuts them; the library is asked once for
    each distinct piece, and the ids of all pieces are gathered from there. Any
    other text, and any other kind of tokenizer, goes to the library whole.
    """

    DOUBTFUL = re.compile("[^\t\n\r -~¡¿À-ÖØ-öø-ɏ]")
    #: What is not doubtful of ASCII.
    PLAIN = bytes([9, 10, 13, *range(32, 127)])
    #: A blank that begins a piece whatever stands before and after.
    SEAM = re.compile(r"(?<=\S) (?=[^\W\d_])")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        cut = told.get("pre_tokenizer") or {}
        self.cuts = (told.get("normalizer") is None and told["model"]["type"] == "BPE"
                     and not told["model"].get("dropout") and cut.get("type") == "ByteLevel"
                     and cut.get("use_regex", True) and not cut.get("add_prefix_space"))
        self.added = [t["content"] for t in told.get("added_tokens", [])]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}                  # piece to its number
        self.sizes = np.zeros(0, dtype=np.int64)           # ids of each piece
        self.ids = np.zeros(0, dtype="<u4")                # all pieces' ids, one after another

    def doubtful(self, text: str) -> bool:
        if text.isascii():  # deleting bytes is several times faster than the search
            return bool(text.encode().translate(None, self.PLAIN))
        return self.DOUBTFUL.search(text) is not None

    def width(self, *more: int) -> int:
        return max(1, max(self.library.get_vocab_size(with_added_tokens=True) - 1, *more).bit_length())

    def learn(self, pieces: list[bytes]) -> None:
        ids, sizes = [self.ids], [self.sizes]
        for a in range(0, len(pieces), 50_000):
            # the fast form leaves out offsets, which are not wanted here
            some = [e.ids for e in self.library.encode_batch_fast([p.decode() for p in pieces[a:a + 50_000]],
                                                                  add_special_tokens=False)]
            sizes.append(np.array([len(x) for x in some], dtype=np.int64))
            ids.append(np.fromiter(chain.from_iterable(some), "<u4", int(sizes[-1].sum())))
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)

    def pieces(self, data: bytes):
        """Pre-tokens of texts that a zero byte ends, as an Arrow array, and where each begins."""
        import pyarrow as pa
        buf = np.frombuffer(data, np.uint8)
        kind = CLASSES[buf]
        kind[np.flatnonzero(buf == 0xC2) + 1] = OTHER
        before = np.concatenate([[BETWEEN], kind[:-1]]).astype(np.uint8)
        after = np.concatenate([kind[1:], [BETWEEN]]).astype(np.uint8)
        blank = buf == 32
        begins = (kind != before) & (kind != BETWEEN)
        # the last of some white space goes to what follows if it is a blank, and else stands alone
        last = (kind == SPACE) & (after != SPACE) & (after != BETWEEN)
        begins |= last
        begins[1:] &= ~(last & blank)[:-1]
        # an apostrophe that begins a piece takes certain letters along
        at = np.flatnonzero((buf[:-1] == 39) & begins[:-1] & (kind[1:] == LETTER))
        one, two = buf[at + 1], buf[np.minimum(at + 2, len(buf) - 1)]
        taken = np.where(np.isin(one, list(b"sdmt")), 1, 0)
        taken[((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)] = 2
        at, taken = at[taken > 0], taken[taken > 0]
        begins[at + 1] = False
        begins[at + 1 + taken] |= kind[at + 1 + taken] == LETTER
        keep = kind != BETWEEN
        start = np.flatnonzero(begins)
        offsets = np.append(np.cumsum(keep, dtype=np.int64)[start] - 1, np.count_nonzero(keep)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(start), [
            None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(buf[keep].tobytes())]), start

    def cut(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts whose characters are all of a known class."""
        raw = [t.encode() for t in texts]
        pieces, start = self.pieces(b"\0".join(raw) + b"\0")
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)  # several times faster than to_pylist
        if len(self.known) + len(distinct) > REMEMBERED:
            self.forget()
        number = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(number < 0)
        number[new] = len(self.known) + np.arange(len(new))
        self.learn(distinct[new].tolist())
        code = number[np.asarray(coded.indices)] if len(distinct) else np.zeros(0, np.int64)
        first = np.cumsum(self.sizes) - self.sizes
        size = self.sizes[code]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(upto[-1]) + np.repeat(first[code] - upto[:-1], size)]
        ends = np.searchsorted(start, np.cumsum([len(r) + 1 for r in raw]))
        return np.split(ids, upto[ends][:-1])

    def parts(self, text: str):
        """The text in parts, cut where a piece begins."""
        first = 0
        while len(text) - first > PART:
            at = self.SEAM.search(text, first + PART)
            if at is None:
                break
            yield text[first:at.start()]
            first = at.start()
        yield text[first:] if first else text

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[str] = []
        owner: list[int] = []
        size = 0

        def take():
            for i, ids in zip(owner, self.cut(held)):
                out[i].append(ids)
            held.clear()
            owner.clear()

        whole = []
        for i, t in enumerate(texts):
            if not self.cuts or self.doubtful(t) or any(a in t for a in self.added):
                whole.append(i)
                continue
            for part in self.parts(t):
                held.append(part)
                owner.append(i)
                size += len(part)
                if size > SLICE:
                    take()
                    size = 0
        if held:
            take()
        for a in range(0, len(whole), 256):
            part = whole[a:a + 256]
            for i, e in zip(part, self.library.encode_batch([texts[i] for i in part], add_special_tokens=False)):
                out[i].append(np.array(e.ids, dtype="<u4"))
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process, kept between tasks."""
    if path not in _ENCODERS:
        # tasks share the cores already; the library's own threads would only wait for each other
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id",
              text: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode every row and write its ids, ``end_id`` appended, to ``path``.

    ``tokenizer``: a tokenizers JSON file that every worker can open.
    """
    rows = (docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .repartitionByRange(F.col("doc_id").asc()).sortWithinPartitions("doc_id", "text"))

    def blocks(batches):
        import pyarrow as pa
        enc = encoder(tokenizer)
        width = enc.width(end_id)
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        names: list[int] = []
        parts: list[np.ndarray] = []
        held = 0
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_docs", pa.int32()),
                            ("n_ids", pa.int64()), ("width", pa.int32()), ("doc_ids", pa.binary()),
                            ("sizes", pa.binary()), ("payload", pa.binary())])

        def closed():
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "block": block, "first": first, "n_docs": len(names), "n_ids": len(ids), "width": width,
                "doc_ids": np.array(names, dtype="<i8").tobytes(),
                "sizes": np.array([len(p) for p in parts], dtype="<u4").tobytes(),
                "payload": pack(ids, width)}], schema)

        tail = np.array([end_id], dtype="<u4")
        for batch in (part for whole in batches for part in text_slices(whole, most=SLICE)):
            texts = batch.column("text").to_pylist()
            for key, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(texts)):
                names.append(NO_DOC if key is None else key)
                parts.append(np.concatenate([ids, tail]))
                held += len(ids) + 1
                if held >= block_ids:
                    yield closed()
                    names, parts, block, first, held = [], [], block + 1, first + held, 0
        if names:
            yield closed()

    rows.mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(path)


def _with_start(blocks: DataFrame) -> DataFrame:
    """Blocks with ``start``, the ids of all shards and blocks before them.

    The totals are one row a shard, that is a task of the write, so their
    broadcast is bounded by the number of partitions; the payload is not shuffled.
    """
    shards = (blocks.groupBy("shard").agg(F.max(F.col("first") + F.col("n_ids")).alias("n"))
              .select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("shard_start")))
    return blocks.join(F.broadcast(shards), "shard").withColumn("start", F.col("shard_start") + F.col("first"))


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of each document, from the files."""
    blocks = _with_start(spark.read.parquet(path))

    def documents(batches):
        import pyarrow as pa
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["width"], 0, row["n_ids"]).astype("<u4")
                sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
                ends = np.cumsum(sizes)
                names = np.frombuffer(row["doc_ids"], "<i8")
                each = [ids[e - n:e] for e, n in zip(ends, sizes)]
                columns = [pa.array(names, mask=names == NO_DOC), pa.array(row["start"] + ends - sizes), pa.array(sizes),
                           pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64())]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int64) for x in each], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, fields)

    fields = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return blocks.select("start", "n_ids", "width", "doc_ids", "sizes", "payload").mapInArrow(documents, schema)


def read_range(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """Ids ``start`` to ``start + n`` of the whole stream, unpacking only the blocks that hold them."""
    hit = (_with_start(spark.read.parquet(path))
           .where((F.col("start") < start + n) & (F.col("start") + F.col("n_ids") > start))
           .select("start", "n_ids", "width", "payload").orderBy("start").toLocalIterator())
    parts = [np.zeros(0, np.uint32)]
    for row in hit:
        a, b = max(start, row["start"]) - row["start"], min(start + n, row["start"] + row["n_ids"]) - row["start"]
        parts.append(unpack(row["payload"], row["width"], a, b - a))
    return np.concatenate(parts)
