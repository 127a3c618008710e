"""Operators 11 to 13 against the library and brute force, on the smallest driver tables with hard rows added."""

import functools
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tessera.llm import entries, importance, packing, source_audit
from test_operators import SCHEMA, SF, hard_rows

ODD = ["'s 'tis I've we'LL ''s '' 'd'm it's", "a\x0bb\x1c\x85 c d", "x<|endoftext|>y <|endoftext|", "İstanbul ΑΣ ΣΑΣ é ½²",
       "don't stop… — 12345 3.14 ___a_b", "\t\n\r  ", "ǅ ŉ ſ ß ÿ Ÿ × ÷ ª º µ", "日本語 тест 𝒳 🙂🙂", "a" * 5000, "!" * 3000 + "'", "'" * 99]


@pytest.fixture(scope="module")
def rows():
    table = duckdb.sql(f"select doc_id, text, lang, source from '{SF}/documents.parquet'").fetchall()
    odd = [(9100 + i, t, "xx", "odd") for i, t in enumerate(ODD)]
    copies = [(9200 + i % 7, "the same passage of some few words again " * 4, "en", f"src{i % 3}") for i in range(60)]
    return table + hard_rows() + odd + copies


@pytest.fixture(scope="module")
def docs(llm, rows):
    return llm.createDataFrame([(*r, *["clash"] * 8) for r in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def none(llm):
    return llm.createDataFrame([], SCHEMA)


# -------------------------------------------------------------------- 11 packing

@pytest.fixture(scope="module")
def tokenizer():
    return entries.tokenizer_file("word_bpe_49k.json")


@functools.cache
def library(tokenizer):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer)


def library_ids(tokenizer, text):
    return library(tokenizer).encode(text or "", add_special_tokens=False).ids


def test_words_are_encoded_like_texts(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "PART", 50)
    enc = packing.WordEncoder(tokenizer)
    assert enc.by_word
    singles = [f"{chr(c)} a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in [*range(1, 0x250), 0x301, 0x3A3, 0x1E9E, 0x4E2D, 0x1F642]]
    texts = ODD + singles + [" ".join(singles[60:90]), "word " * 500]
    rng = np.random.default_rng(7)
    alphabet = list("abst 'rvelmd\n1.é¿¡-É") + ["'ll", "'re", " '", "''"]
    texts += ["".join(rng.choice(alphabet, 60)) for _ in range(400)]
    want = [library_ids(tokenizer, t) for t in texts]
    assert [x.tolist() for x in enc.encode(texts)] == want
    monkeypatch.setattr(packing, "SLICE", 300)
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    assert [x.tolist() for x in enc.encode(texts[::-1])] == want[::-1]
    assert enc.encode([]) == [] and enc.encode(["", " "])[1].tolist() == []


@pytest.mark.parametrize("limit", [4096, 64, 7])
def test_pieces_and_sequences(docs, rows, tokenizer, limit):
    packed = packing.pack(docs, tokenizer, end_id=1, limit=limit).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = np.array([*library_ids(tokenizer, t), 1], dtype="<u4")
        for k, a in enumerate(range(0, len(ids), limit)):
            part = ids[a:a + limit]
            want[i, k, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == want
    places = defaultdict(list)
    for r in packed:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for some in places.values():
        assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(sorted(some)))
        assert min(some)[0] == 0 and max(a + n for a, n in some) <= limit
    lengths = sorted((r["length"] for r in packed), reverse=True)
    assert len(places) <= first_fit(lengths, limit)
    assert len(places) <= -(-sum(lengths) // limit) * 1.01 + 1


def first_fit(lengths, limit):
    """Bins of first-fit decreasing."""
    room = []
    for n in lengths:
        at = next((i for i, r in enumerate(room) if r >= n), None)
        if at is None:
            room.append(limit - n)
        else:
            room[at] -= n
    return len(room)


def test_fullest_combination():
    rng = np.random.default_rng(0)
    for _ in range(200):
        sizes = rng.integers(1, 30, rng.integers(1, 9)).tolist()
        room = int(rng.integers(0, 60))
        best = max(sum(c) for k in range(len(sizes) + 1) for c in itertools.combinations(sizes, k) if sum(c) <= room)
        used = packing.fullest(dict(Counter(sizes)), room)
        assert sum(k * n for k, n in used.items()) == best
        assert all(n <= Counter(sizes)[k] for k, n in used.items())


def test_plan_does_not_follow_the_corpus():
    counts = {k: 1 + 7919 * k % 1000 for k in range(1, 257)}
    few, many = (packing.plan_sequences({k: n * m for k, n in counts.items()}, 256) for m in (1, 10**9))
    assert len(many) < 3 * 256 and len(few) < 3 * 256
    assert Counter({k: sum(u.get(k, 0) * t for _, u, t in many) for k in counts}) == {k: n * 10**9 for k, n in counts.items()}


def test_sequences_hold_the_ids(llm, docs, rows, tokenizer):
    some = docs.where("doc_id < 40 or doc_id is null")
    packed = packing.pack(some, tokenizer, end_id=1, limit=512, with_ids=True).cache()
    made = packing.sequences(packed).collect()
    assert all(len(r["ids"]) <= 512 for r in made)
    total = Counter()
    for i, t, *_ in rows:
        if i is None or i < 40:
            total.update([*library_ids(tokenizer, t), 1])
    assert Counter(x for r in made for x in r["ids"]) == total


def test_nothing_to_pack(none, tokenizer):
    assert packing.pack(none, tokenizer, end_id=1).collect() == []


# ----------------------------------------------------------------- 12 importance

def word_features(text, n):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return len(words), Counter(zlib.crc32(b" ".join(words[i:i + k])) for k in range(1, n + 1)
                               for i in range(len(words) - k + 1))


def resampled(rows, target, n, buckets, percent, least, seed):
    s, t = Counter(), Counter()
    each = [(i, *word_features(x, n)) for i, x in rows]
    for _, _, f in each:
        s.update({b: 0 for b in ()})
        for c, k in f.items():
            s[c % buckets] += k
    for x in target:
        for c, k in word_features(x, n)[1].items():
            t[c % buckets] += k
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for i, words, f in each:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[c % buckets] * k for c, k in f.items())
        out.append([i, words, sum(f.values()), weight,
                    weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[5] = k
    return out


@pytest.mark.parametrize("words,segment,percent", [(1 << 16, 1 << 21, 5), (12, 1 << 21, 50), (0, 500, 100)])
def test_resampling(llm, docs, rows, monkeypatch, words, segment, percent):
    monkeypatch.setattr(importance.frequent_words, "__defaults__", ("text", words))
    monkeypatch.setattr(importance, "SEGMENT", segment)
    target = llm.createDataFrame([(t, "clash") for t in [None, "", "one two three four", "the of and der die"] * 3], "text string, doc_id string")
    got = importance.resample(docs, target, n=3, buckets=1000, percent=percent, least_words=20, seed=42).collect()
    want = resampled([r[:2] for r in rows], [r["text"] for r in target.collect()], 3, 1000, percent, 20, 42)
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def test_segments_count_every_run_once():
    rng = np.random.default_rng(3)
    texts = [None, "", "a" * 200, " " * 300] + ["".join(rng.choice(list("abC é.  \n"), n)) for n in rng.integers(0, 300, 200)]
    scan = importance.Scanner([b"a", b"ab", "é".encode()])
    old, importance.SEGMENT = importance.SEGMENT, 40
    try:
        for n in (1, 2, 3, 5):
            got = [Counter() for _ in texts]
            for group, owner, sign in importance.segments(texts, n):
                for crc, of in importance.runs(*scan.words(group), n):
                    for c, o in zip(crc.tolist(), of.tolist()):
                        got[owner[o]][c] += int(sign[o])
            assert [+g for g in got] == [word_features(t, n)[1] for t in texts]
    finally:
        importance.SEGMENT = old


def test_long_words_are_hashed_exactly():
    texts = ["x" * 300 + " " + "y" * 1000 + " z " + "é" * 400]
    got = Counter()
    for crc, _ in importance.runs(*importance.Scanner([b"z"]).words([texts[0].encode().translate(importance.FOLD)]), 3):
        got.update(crc.tolist())
    assert got == word_features(texts[0], 3)[1]


def test_rare_words_stay_out_of_the_dictionary(llm):
    docs = llm.createDataFrame([("a " * 50 + "b " * 40 + "c " * 3 + "d e f",)], "text string")
    assert set(importance.frequent_words(docs, most=2)) == {b"a", b"b"}
    assert set(importance.frequent_words(docs, most=10)) == {b"a", b"b", b"c"}


def test_ties_are_drawn_by_id(llm):
    text = "some words that are all the same " * 5
    docs = llm.createDataFrame([(5, text)] * 30 + [(None, text)] * 3, "doc_id bigint, text string").repartition(3)
    got = importance.resample(docs, docs, percent=100).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 34))
    by_score = sorted(got, key=lambda r: r["rank"])
    assert [r["score"] for r in by_score] == sorted((r["score"] for r in got), reverse=True)


def test_nothing_to_resample(llm, docs, none):
    assert importance.resample(none, docs).collect() == []
    assert importance.resample(docs.where("doc_id < 9"), none).where("rank is not null").collect() == []   # 5 % of few


# ---------------------------------------------------------------------- 13 audit

def audited(rows, least, top):
    docs = [(lang or "", source or "", Counter(
        w.decode() for w in re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))))
        for t, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(w for _, _, c in own for w in c)
        kept = [w for w, n in seen.items() if n >= least]

        def share(counters):
            n = Counter()
            for c in counters:
                n.update(c)
            total = sum(n[w] for w in kept)
            return n, {w: 1 + 1_000_000_000 * (n[w] + 1) // (total + len(kept)) for w in kept}
        _, q = share([c for _, _, c in own])
        groups = {s: share([c for _, x, c in own if x == s]) for s in {d[1] for d in own}}
        for s, (n, p) in groups.items():
            pair = [(o, sum((p[w] - r[w]) ** 2 // r[w] for w in kept)) for o, (_, r) in groups.items() if o != s]
            term = [(w, (p[w] - q[w]) ** 2 // q[w]) for w in kept if n[w] and p[w] > q[w]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(items[:most], 1)}
    return out


@pytest.mark.parametrize("size,top", [(source_audit.BLOCK, 200), (3, 5)])
def test_audit(docs, rows, size, top):
    got = source_audit.audit(docs, least=3, top=top, size=size).collect()
    want = audited([r[1:] for r in rows], 3, top)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_audit_without_terms(llm, none):
    assert source_audit.audit(none).collect() == []
    docs = llm.createDataFrame([("12 34", "a", "x"), (None, "a", "y"), ("one two", "a", None), ("one", None, None)],
                               "text string, lang string, source string")
    got = {tuple(r) for r in source_audit.audit(docs).collect()}
    assert got == audited([tuple(r) for r in docs.collect()], 3, 200) and len(got) == 6


def test_large_counts_do_not_overflow():
    count, total = np.array([10**12, 0, 9 * 10**14]), np.array([10**15, 10**15, 10**15])
    want = [1 + 1_000_000_000 * (int(c) + 1) // int(t) for c, t in zip(count, total)]
    assert source_audit.shares(count, total).tolist() == want
