"""Brute-force versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter


def components(nodes, links):
    """Least node reachable, by repeated relabelling."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def ngram_join(docs):
    """docs: (doc_id, text) with distinct ids -> {doc_id: (n_shingles, component_id)}"""
    sets = {i: shingles(t) for i, t in docs}
    at = {}
    for i, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(i)
    shared = Counter(p for ids in at.values() for p in itertools.combinations(sorted(ids), 2))
    links = [(a, b) for (a, b), o in shared.items()
             if 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o)]
    label = components(list(sets), links)
    return {i: (len(s), label[i]) for i, s in sets.items()}


def repeats(docs, length=200):
    """docs: (doc_id, text) -> {doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(d[k:k + length] for _, d in data for k in range(len(d) - length + 1))
    out = {}
    for i, d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out[i] = (len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def char_shingles(line, n=8):
    return frozenset(line[i:i + n] for i in range(max(1, len(line) - n + 1)))


def line_dedup(docs, percent=75):
    """docs: (doc_id, text) with distinct ids -> {doc_id: (n_lines, n_dropped, kept_sha256)}"""
    where = {}
    for i, t in sorted(docs):
        for n, x in enumerate((t or "").split("\n")):
            if x and not x.isspace():
                where.setdefault(x, []).append((i, n))
    sets = {x: char_shingles(x) for x in where}
    at = {}
    for x, s in sets.items():
        for c in s:
            at.setdefault(c, []).append(x)
    shared = Counter(p for xs in at.values() for p in itertools.combinations(sorted(xs), 2))
    links = [(a, b) for (a, b), o in shared.items() if 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o)]
    label = components(list(where), links)
    first = {}
    for x, spots in where.items():
        first[label[x]] = min(first.get(label[x], spots[0]), spots[0])
    kept = set(first.values())
    out = {}
    for i, t in docs:
        lines = list(enumerate((t or "").split("\n")))
        seen = [n for n, x in lines if x and not x.isspace()]
        gone = {n for n in seen if (i, n) not in kept}
        text = "\n".join(x for n, x in lines if n not in gone)
        out[i] = (len(seen), len(gone), hashlib.sha256(text.encode()).hexdigest())
    return out
