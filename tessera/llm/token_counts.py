"""Token counts by rank-synchronous array merging of a BPE piece vocabulary.

The text is cut into pre-tokens where a blank follows a non-blank: no piece of
the vocabulary crosses such a place, which is checked on loading. Each distinct
pre-token of a batch becomes one row of a ragged array of symbols (its
characters), grouped by length. All rows then step together: in each step every
row finds its lowest-rank adjacent pair (the leftmost of equals), merges it,
and the pairs next to the merge are looked up again. A row is done when no
pair of it is a piece. Surviving symbols are counted; one that is no piece
counts as its UTF-8 bytes (byte fallback).

Defined results: null is the empty text, with 0 bytes and 0 tokens; strings
that look like special tokens are ordinary text; repeated rows are counted
alike; empty tables give empty results; only the id and text columns are used,
so extra columns cannot clash. A pre-token of more than ``LONG`` characters is
merged alone with a heap of its pairs, in the same order, so that its time does
not grow with the square of its length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

BLANK = "▁"
LONG = 400
#: Pre-tokens whose counts a task remembers; the memory is emptied beyond that.
REMEMBERED = 400_000
NO_PAIR = np.int32(2**31 - 1)


class PieceVocabulary:
    """Pieces with their merge ranks, as sorted arrays of symbol pairs."""

    def __init__(self, pieces: list[tuple[str, float]]):
        """``pieces``: the ordinary pieces with their scores, best merged first."""
        order = sorted({-score for _, score in pieces})
        rank_of = {s: i for i, s in enumerate(order)}  # equal scores have equal ranks
        self.ids = {piece: i for i, (piece, _) in enumerate(pieces)}
        if any(BLANK in piece.lstrip(BLANK) for piece in self.ids):
            raise ValueError("a piece crosses a blank; pre-tokens would be cut wrongly")
        n = len(pieces)
        self.size = n
        self.of_letter = np.full(0x110000, -1, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.of_letter[ord(piece)] = i
        self.cuts_lines = "\n" not in self.ids
        pairs = {}
        for piece, score in pieces:
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * n + right] = (rank_of[-score], self.ids[piece])
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in keys], dtype=np.int32)
        self.merged = np.array([pairs[k][1] for k in keys], dtype=np.int32)
        # open addressing with linear probes, a quarter full
        self.bits = max(4, int(np.ceil(np.log2(4 * max(1, len(keys))))))
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self.keys = keys
        waiting, at = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.slots[at] < 0
            self.slots[at[free]] = waiting[free]
            lost = self.slots[at] != waiting
            waiting, at = waiting[lost], (at[lost] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair, or -1."""
        out = np.full(len(left), -1, dtype=np.int32)
        asked = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[asked].astype(np.int64) * self.size + right[asked]
        at = self._slot(keys)
        while len(asked):
            found = self.slots[at]
            hit = (found >= 0) & (self.keys[found] == keys)
            out[asked[hit]] = found[hit]
            more = (found >= 0) & ~hit
            asked, keys, at = asked[more], keys[more], (at[more] + 1) & ((1 << self.bits) - 1)
        return out

    def _steps(self, words: list[str], n: int) -> np.ndarray:
        """Token counts of words of at most ``n`` characters, all stepping together.

        ``rank[r, i]`` belongs to the pair of symbol i and the next living one;
        ``after`` and ``before`` link the living symbols of a row, so a merge
        moves nothing.
        """
        size, wide = len(words), n + 2  # a column on each side that never pairs
        lengths = np.fromiter(map(len, words), np.int64, size)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbols = np.full((size, wide), -1, dtype=np.int32)
        filled = (np.arange(wide) >= 1) & (np.arange(wide) <= lengths[:, None])
        symbols[filled] = self.of_letter[letters]
        lost = self.of_letter[letters] < 0
        out = lengths.copy()
        if lost.any():  # byte fallback
            more = lost * ((letters >= 0x80).astype(np.int64) + (letters >= 0x800) + (letters >= 0x10000))
            out += np.add.reduceat(more, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
        rank = np.full((size, wide), NO_PAIR, dtype=np.int32)
        found = self.pair(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        rank[:, :-1] = np.where(found >= 0, self.ranks[found], NO_PAIR).reshape(size, wide - 1)
        after = np.arange(1, wide + 1, dtype=np.int32)[None].repeat(size, 0)
        before = np.arange(-1, wide - 1, dtype=np.int32)[None].repeat(size, 0)
        alive = np.arange(size)
        while len(alive):
            at = rank.argmin(axis=1)
            base = np.arange(len(alive)) * wide
            here = base + at
            going = rank.ravel()[here] != NO_PAIR
            if going.sum() < 0.7 * len(alive):  # leave the finished rows behind
                alive, symbols, rank = alive[going], symbols[going], rank[going]
                after, before, at = after[going], before[going], at[going]
                base = np.arange(len(alive)) * wide
                here = base + at
            elif not going.all():
                base, here = base[going], here[going]
            if not len(here):
                break
            out[alive[base // wide]] -= 1
            s, r, nxt, prv = symbols.ravel(), rank.ravel(), after.ravel(), before.ravel()
            gone = base + nxt[here]
            s[here] = self.merged[self.pair(s[here], s[gone])]
            r[gone] = NO_PAIR
            s[gone] = -1
            nxt[here] = nxt[gone]
            right, left = base + nxt[here], base + prv[here]
            prv[right] = here - base
            for one, two in ((here, right), (left, here)):
                got = self.pair(s[one], s[two])
                r[one] = np.where(got >= 0, self.ranks[got], NO_PAIR)
        return out

    def _alone(self, word: str) -> int:
        """Token count of one long word; pairs wait in a heap by rank, then position."""
        ids, n = self.ids, len(word)
        symbols = np.array([ids.get(c, -1) for c in word], dtype=np.int64)
        count = n + sum(len(c.encode()) - 1 for c, s in zip(word, symbols) if s < 0)
        found = self.pair(symbols[:-1], symbols[1:])
        heap = [(int(self.ranks[p]), i, int(p)) for i, p in enumerate(found) if p >= 0]
        heapq.heapify(heap)
        current, symbols = found.tolist() + [-1], symbols.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def look(i):
            j = after[i] if i >= 0 else n
            if i < 0:
                return
            current[i] = -1
            if j < n and symbols[i] >= 0 and symbols[j] >= 0:
                p = int(self.pair(np.array([symbols[i]]), np.array([symbols[j]]))[0])
                if p >= 0:
                    current[i] = p
                    heapq.heappush(heap, (int(self.ranks[p]), i, p))

        while heap:
            _, i, p = heapq.heappop(heap)
            if current[i] != p:
                continue  # one of its symbols has been merged meanwhile
            j = after[i]
            symbols[i], current[j] = int(self.merged[p]), -2
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            count -= 1
            look(i)
            look(before[i])
        return count

    def count_words(self, words: list[str]) -> np.ndarray:
        """Token counts of pre-tokens, in batches of similar length."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        out = np.zeros(len(words), dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        first = 0
        while first < len(order):
            n = int(lengths[order[first]])
            if n > LONG:
                out[order[first]] = self._alone(words[order[first]])
                first += 1
                continue
            most = min(LONG, max(8, n + n // 4))
            last = min(int(np.searchsorted(lengths[order], most, side="right")), first + max(1, 2_000_000 // most))
            rows = order[first:last]
            out[rows] = self._steps([words[i] for i in rows], int(lengths[rows].max()))
            first = last
        return out


def pre_tokens(text: str, cut_lines: bool) -> list[str]:
    """Cut before each blank run that follows a non-blank; runs stay with what follows.

    A line end that is no piece never merges: with ``cut_lines`` it also begins
    a pre-token of its own.
    """
    parts = (text.replace("\n", BLANK + "\n") if cut_lines else text).split(BLANK)
    words, run = [parts[0]] if parts[0] else [], 0
    if "" not in parts[1:]:
        return words + [p if cut_lines and p[0] == "\n" else BLANK + p for p in parts[1:]]
    for p in parts[1:]:
        run += 1
        if p:
            words.append(BLANK * (run - (cut_lines and p[0] == "\n")) + p)
            run = 0
    return words + [BLANK * run] if run else words


class TokenCounter:
    """Counts for whole texts, with a bounded memory of pre-token counts."""

    def __init__(self, vocabulary: PieceVocabulary):
        self.vocabulary, self.known = vocabulary, {}

    def counts(self, texts: list[str]) -> Iterator[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        lines = self.vocabulary.cuts_lines
        cut = [pre_tokens(BLANK + t.replace(" ", BLANK), lines) if t else [] for t in texts]
        new = list({w for words in cut for w in words if w not in known})
        known.update(zip(new, self.vocabulary.count_words(new).tolist()))
        return (sum(map(known.__getitem__, words)) for words in cut)


def load_piece_model(path: str) -> PieceVocabulary:
    """Vocabulary of a sentencepiece BPE model; only its tables are read.

    The merging is exact for models with identity normalisation, a dummy
    prefix, kept blanks and byte fallback, which the probe texts check.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())
                if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
    vocabulary = PieceVocabulary(ordinary)
    probes = ["", " ", "a  b ", "ﬁ①　x", "<s>a</s>\n\tb", "İé ▁z"]
    if list(TokenCounter(vocabulary).counts(probes)) != [len(model.encode(p)) for p in probes]:
        raise ValueError("the model normalises text or falls back otherwise than this operator does")
    return vocabulary


def count_tokens(docs: DataFrame, vocabulary: PieceVocabulary, limit: int = 4096, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def count(batches):
        import pyarrow as pa
        counter = TokenCounter(shared.value)
        for batch in (part for whole in batches for part in text_slices(whole)):
            texts = batch.column("text").to_pylist()
            n = list(counter.counts(texts))
            size = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
