"""Parts of the operators that need no Spark."""

import math
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from tessera.llm import embedding_dedup, language_id, line_dedup, suffix_dedup, token_output
from tessera.llm.shingles import overlap, shingle_sets
from tessera.llm.token_counts import LONG, TokenCounter, load_piece_model
from tessera.llm.url_filter import Cascade, Level, _bit_at

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")

ALPHABET = ["a", "b", "th", "e", " ", "  ", "▁", "\n", "\n\n", "é", "中", "²", "er", "'s", "_", ".", "<s>", "\x00",
            "12", " the", "ﬁ", " ", "\t", "\r\n", "<|endoftext|>", "𝒳"]


def noise(seed, n, most=60):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, most))) for _ in range(n)]


# ------------------------------------------------------------------ token counts

@pytest.fixture(scope="module")
def pieces():
    path = public.path("piece_bpe_32k.model")
    return TokenCounter(load_piece_model(path)), sentencepiece.SentencePieceProcessor(model_file=path)


def test_counts_equal_the_library(pieces):
    ours, library = pieces
    texts = [*noise(1, 2000), "a" * (LONG + 1), "theing" * 700, " " * 900, "中" * 500, "inin" * 101, "", " ", "\n"]
    assert list(ours.counts(texts)) == [len(x) for x in library.encode(texts)]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80).filter(lambda t: not any(0xD800 <= ord(c) < 0xE000 for c in t)))
def test_counts_of_any_text(pieces, text):
    ours, library = pieces
    assert list(ours.counts([text])) == [len(library.encode(text))]


def test_long_and_short_paths_agree(pieces):
    ours, _ = pieces
    words = [w for t in noise(3, 300) for w in t.split(" ") if len(w) > 1]
    v = ours.vocabulary
    assert [v._alone(w) for w in words] == v.count_words(words).tolist()


# ------------------------------------------------------------------ token output

def test_ids_equal_the_library():
    enc = token_output.Encoder(public.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(7)
    alphabet = list("abst 'rvelmd\n1.é¿¡-É_\t  ") + ["'ll", "'re", " '", "''", "  ", "\n\n", " \n"]
    texts = noise(2, 2000) + ["".join(rng.choice(alphabet, 60)) for _ in range(2000)]
    texts += ["", " ", "\n", "  a", "a  ", "a \n", "\n a", " \n a", "\x00a\x00", "x<|endoftext|>y"]
    texts += [f"{chr(c)} a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in [*range(1, 0x250), 0x301, 0x4E2D, 0x1F642]]
    want = [e.ids for e in enc.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc.encode(texts)] == want


def test_ids_of_parts_and_of_a_worker_that_forgets(monkeypatch):
    monkeypatch.setattr(token_output, "PART", 40)
    monkeypatch.setattr(token_output, "SLICE", 500)
    monkeypatch.setattr(token_output, "REMEMBERED", 60)
    enc = token_output.Encoder(public.path("byte_bpe_50k.json"))
    texts = [" ".join(noise(3, 30)), "word " * 500, "x" * 3000, " " * 500 + "end", "", "It's  a\n\ntest, isn't it? " * 40]
    assert [x.tolist() for x in enc.encode(texts)] == [enc.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert enc.encode([]) == []


def test_a_text_of_20_mb():
    enc = token_output.Encoder(public.path("byte_bpe_50k.json"))
    part = "The quick brown fox isn't here; it's 12345 miles away.\n  Über élan\t" * 1000
    text = part * (20_000_000 // len(part.encode()) + 1)
    once = enc.library.encode(part, add_special_tokens=False).ids
    got, = enc.encode([text])
    assert len(text.encode()) >= 20_000_000
    assert got[:len(once) - 2].tolist() == once[:-2] and len(got) >= (len(once) - 2) * len(text) // len(part)
    packed = token_output.pack(got, enc.width(2))
    assert (token_output.unpack(packed, enc.width(2), 0, len(got)) == got).all()
    where = len(got) // 2 + 1
    assert (token_output.unpack(packed, enc.width(2), where, 100_001) == got[where:where + 100_001]).all()


@pytest.mark.parametrize("width", range(1, 33))
def test_packing_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 2**width, 1001).astype(np.uint32)
    packed = token_output.pack(ids, width)
    assert len(packed) == -(-1001 * width // 8)
    assert (token_output.unpack(packed, width, 0, 1001) == ids).all()
    assert (token_output.unpack(packed, width, 37, 500) == ids[37:537]).all()


# ---------------------------------------------------------------------- shingles

def test_shingle_sets_equal_brute_force():
    texts = [*noise(4, 300), "One two three four FIVE six", "one two", "", " \t ", "x " * 1000]
    assert [len(s) for s in shingle_sets([t.encode() for t in texts])] == [len(brute.shingles(t)) for t in texts]


def test_long_text_is_cut_between_words():
    text = (" ".join(noise(5, 3000, 40)) + " ") * 40
    whole = next(iter(shingle_sets([text.encode()])))
    assert len(whole) == len(brute.shingles(text))
    parts = list(shingle_sets([t.encode() for t in ("a b c d e f", "A b C d e", "f e d c b a")]))
    assert overlap(parts[0], parts[1]) == 1 and overlap(parts[0], parts[2]) == 0


def test_line_shingles():
    for a, b in [("abcdefghij" * 8, "abcdefghij" * 8 + "!"), ("short", "short"), ("x" * 50, "y" * 50)]:
        x, y = brute.char_shingles(a), brute.char_shingles(b)
        o = len(x & y)
        assert line_dedup.similar(a, b, 75) == (100 * o >= 75 * (len(x) + len(y) - o))


# ---------------------------------------------------------------- suffix arrays

@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=6), st.text("ab", min_size=1, max_size=8)), min_size=2, max_size=8, unique=True),
       st.integers(2, 6))
def test_maximal_repeats_cover_what_repeats(pairs, length):
    lefts = [a[::-1].encode() for a, _ in pairs]
    rights = [b.encode() for _, b in pairs]
    covered = {(i, o) for left, right, members in suffix_dedup.maximal_repeats(lefts, rights, length)
               for i in members for o in range(left + 1) if o + right >= length and o <= left and length - o <= right}
    want = set()
    for i, (a, b) in enumerate(pairs):
        for o in range(min(len(a), length) + 1):
            need = length - o
            if need > len(b):
                continue
            window = a[len(a) - o:] + b[:need]
            if any(j != i and len(p) >= o and p[len(p) - o:] + q[:need] == window and len(q) >= need
                   for j, (p, q) in enumerate(pairs)):
                want.add((i, o))
    assert {(i, o) for i, o in covered if o <= length} == want


def test_cells_do_not_depend_on_what_is_around():
    rnd = np.random.default_rng(1)
    core = rnd.integers(0, 4, 600).astype(np.uint8).tobytes()
    found = []
    for before in (0, 17, 333):
        data = rnd.integers(0, 4, before).astype(np.uint8).tobytes() + core + rnd.integers(0, 4, 90).astype(np.uint8).tobytes()
        cells = suffix_dedup.Cells(data, np.array([len(data)]), 200)
        inner = (cells.first > before) & (cells.last + 200 < before + 600)
        found.append(set(cells.u[inner].tolist()))
    assert found[0] and found[0] & found[1] & found[2]


def test_merged_spans():
    a, b = suffix_dedup.merged(np.array([5, 0, 3, 20]), np.array([9, 2, 6, 21]))
    assert list(zip(a, b)) == [(0, 2), (3, 9), (20, 21)]


# ------------------------------------------------------------------ other parts

def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    y = embedding_dedup.hadamard(x) / 8
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))


def test_near_vectors_meet():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * z   # exactly on the threshold: the hardest pairs
    a, b = embedding_dedup.bucket_hashes(x), embedding_dedup.bucket_hashes(y)
    met = [bool(set(p[:, 0].tolist()) & set(q.ravel().tolist()) or set(q[:, 0].tolist()) & set(p.ravel().tolist()))
           for p, q in zip(a, b)]
    assert np.mean(met) >= 0.99


def test_cascade_levels_alternate():
    rng = np.random.default_rng(2)
    listed, others = rng.integers(-2**63, 2**63, 50), rng.integers(-2**63, 2**63, 5000)
    levels, inner, outer = [], listed, others
    while len(inner):
        bitmap = np.zeros(256 if not levels else 1 << max(6, int(np.ceil(np.log2(4 * len(inner))))), dtype=bool)
        k = len(levels)
        for j in range(2):
            bitmap[_bit_at(inner, k, j, len(bitmap))] = True
        levels.append(Level(bitmap, 2))
        inner, outer = outer[levels[-1].passes(outer, k)], inner
    cascade = Cascade(levels)
    assert len(levels) > 1 and cascade.contains(listed).all() and not cascade.contains(others).any()


def test_code_lengths_by_hand():
    import pandas as pd
    counts = pd.concat([language_id._ngram_counts(pd.Series(t)).assign(lang=lang)
                        for lang, t in (("x", ["abab", "abc"]), ("y", ["zz"]))])
    trees = language_id._trees(["x", "y"], counts)
    got = trees.code_lengths([b"ab", b"", b"q"])
    # x: 'a' begins both texts (2 of 2, one kind); after it 'b' always follows (its three contexts agree)
    assert got[0, 0] == pytest.approx(-2 * math.log2(2 / 3))
    assert got[1].tolist() == [0.0, 0.0]
    assert (got[2] > 8).all()   # an unseen byte escapes through every order
    long = b"ab" * (language_id.SLICE // 2 + 10)
    whole = trees.code_lengths([long])[0, 0]
    per = (trees.code_lengths([b"ab" * 40])[0, 0] - trees.code_lengths([b"ab" * 30])[0, 0]) / 10
    assert whole == pytest.approx(per * len(long) / 2, rel=1e-3)


@pytest.mark.parametrize("seed", range(6))
def test_close_pairs(seed):
    rng = np.random.default_rng(seed)
    group, lines, component, side = [], [], [], []
    for g, size in enumerate((1, 2, 9, 40)):
        base = rng.choice(list("abcdef"), 60)
        for k in range(size):
            line = base.copy()
            line[rng.integers(0, 60, 2)] = rng.choice(list("xyz"), 2)
            lines.append("".join(line[:rng.integers(40, 61)]))
            group.append(g)
            component.append(int(rng.integers(0, 3)) if k % 2 else 100 + k)
            side.append(int(rng.integers(0, 2)) if g % 2 else 0)
    a, b = line_dedup.close_pairs(lines, np.array(group), np.array(side), np.array(component), 75)
    got = [tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())]
    two = {g: len({s for s, h in zip(side, group) if h == g}) == 2 for g in group}
    want = {(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines))
            if group[i] == group[j] and component[i] != component[j] and not (two[group[i]] and side[i] == side[j])
            and line_dedup.similar(lines[i], lines[j], 75)}
    assert set(got) == want and len(got) == len(want) and want


def test_lines_are_shingled_once_however_many_they_are_compared_with(monkeypatch):
    rng = np.random.default_rng(21)
    words = ["alpha", "beta", "gamma", "delta", "é", "x" * 9]
    lines = ["a", "1234567", "12345678"] + [" ".join(rng.choice(words, 8)) for _ in range(40)]
    a, b = [x for x in lines for _ in lines], lines * len(lines)
    shingled, real = [], line_dedup.shingle_hashes
    monkeypatch.setattr(line_dedup, "shingle_hashes", lambda some: (shingled.extend(some), real(some))[1])
    got = line_dedup.similar_lines(a, b, 75)
    assert sorted(shingled) == sorted(set(lines))
    sets = [{x[i:i + 8] for i in range(max(1, len(x) - 7))} for x in lines]
    assert list(map(bool, got)) == [100 * len(x & y) >= 75 * len(x | y) for x in sets for y in sets]


def test_plain_texts_are_not_searched():
    enc = token_output.Encoder.__new__(token_output.Encoder)
    for c in map(chr, range(0x300)):
        for text in (c, f"a b{c}", f"{c}é"):
            assert enc.doubtful(text) == bool(enc.DOUBTFUL.search(text))


def test_pieces_are_looked_up_once_without_the_library_s_threads(monkeypatch):
    asked = []

    class Known(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

        def __contains__(self, key):
            asked.append(key)
            return super().__contains__(key)

        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    monkeypatch.setattr(token_output, "_ENCODERS", {})
    enc = token_output.encoder(public.path("byte_bpe_50k.json"))
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    monkeypatch.delenv("TOKENIZERS_PARALLELISM")
    enc.known = Known()
    texts = ["one two three", "two three four"]
    for _ in range(2):
        asked.clear()
        got = [x.tolist() for x in enc.encode(texts)]
        assert sorted(asked) == [b" four", b" three", b" two", b"one", b"two"]
        assert got == [enc.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_lines_that_meet_in_a_bucket_of_few_are_compared_without_a_leader():
    rng = np.random.default_rng(5)
    sizes = {10: 1, 11: 2, 12: 3, 13: line_dedup.FEW, 14: line_dedup.FEW + 1, -15: 40}
    of = {b: rng.integers(-2**63, 2**63 - 1, n) for b, n in sizes.items()}
    buckets = np.concatenate([np.full(2 * n, b) for b, n in sizes.items()])
    keys = np.concatenate([np.tile(of[b], 2) for b in sizes])  # every entry twice
    order = rng.permutation(len(keys))
    a, b, led = line_dedup.meetings(buckets[order], keys[order])
    few = [(x, y) for x, y, bucket in zip(a.tolist(), b.tolist(), led.tolist()) if not bucket]
    want = [(x, y) for n in (10, 11, 12, 13) for i, x in enumerate(sorted(of[n].tolist())) for y in sorted(of[n].tolist())[i + 1:]]
    assert sorted(few) == sorted(want)
    for bucket in (14, -15):
        assert sorted(a[led == bucket].tolist()) == sorted(of[bucket].tolist())
        assert set(b[led == bucket].tolist()) <= set(of[bucket].tolist()) and len(set(b[led == bucket].tolist())) == 1
    empty = np.zeros(0, np.int64)
    assert [len(x) for x in line_dedup.meetings(empty, empty)] == [0, 0, 0]


def test_shingles_do_not_depend_on_what_is_hashed_along(monkeypatch):
    lines = ["a", "1234567", "12345678", "\0" * 3, "\0" * 9, "é" * 12, "中x" * 9, "😀 and more", "abcdefgh" * 30] * 2
    hashes, first = line_dedup.shingle_hashes(lines)
    alone = [line_dedup.shingle_hashes([x]) for x in lines]
    assert hashes.tolist() == [h for x, _ in alone for h in x.tolist()]
    assert first.tolist() == [0, *np.cumsum([len(x) for x, _ in alone])[:-1]]
    assert len({h for x, _ in alone for h in x.tolist()}) == len({x[i:i + 8] for x in lines for i in range(max(1, len(x) - 7))})
    whole = line_dedup.bands_of(lines)
    monkeypatch.setattr(line_dedup, "CACHED", 10)
    assert (line_dedup.bands_of(lines) == whole).all() and line_dedup.shingle_hashes(lines)[0].tolist() == hashes.tolist()
