"""Exact Jaccard self-join of word n-gram sets, with set-relation skipping.

Two texts link when ``100 * |A & B| >= percent * |A | B|``. No link is lost:

1. Equal sets are one class from the start.
2. Highly similar sets are found first by a few minima of their hashes: each
   class is compared with one leader of each of its keys' groups (a star, never
   all pairs), exactly; the leader is the class that shares keys with most
   others. A class that links with such a leader follows it; its overlap ``o``
   with the leader leaves it ``a = n - o`` shingles of its own. Groups in which
   links were found have another round with new leaders among those that
   neither lead nor follow yet.
3. The rest is a prefix-filter join. Shingles are ordered by how often the
   corpus has them, then by hash; if two sets link they share a shingle among
   the first ``n - ceil(n * percent / 100) + 1`` of each. Index lists are keyed by
   shingle and made of blocks by (leader, set size), each with its least
   position; blocks are skipped by size and by position (the shingles that can
   still follow bound the overlap), blocks of one leader never meet.
4. What passes are pairs of leaders. Their overlap ``o`` is computed once, and
   the answers of everything that follows them are derived from it: sets x and
   y that follow them share at most ``o + a_x + a_y`` shingles, which settles
   nearly all pairs without looking at them. Only a pair of sets for which that
   bound reaches the threshold, and which no other link has connected yet, is
   compared: the larger family of two meets the members of all families it is
   open with, block by block, so a text is sent once a block and not once a pair.

How often the corpus has a shingle is counted over every text, in the tasks,
by blocks of a few million shingles, from two occurrences in a block on. The
``COMMON`` most frequent ones (so the size is bounded, whatever the corpus) are
gathered and broadcast. They only set the order: any order gives the same
links, this one keeps common passages out of the prefixes.

Defined results: null texts and texts without words have an empty set and link
with nothing; rows that repeat an id are one node of the graph; rows with a
null id are returned with their size and a null component, and link with
nothing; empty tables give empty results; only the id and text columns are
used, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IdFilter, connected_components, materialise, text_slices
from .shingles import overlap, shingle_sets

KEYS = 8
CHUNK = 1 << 22
COMMON = 1 << 20
MARKS = 23
ROUNDS = 2
#: Shares that a family's members are dealt into, and where the rounds that take them begin and end.
DEALT = 32
SHARES = (0, 4, DEALT)
#: Members of a family, or of its partners, that one task's group holds (and no more than CHUNK shingles).
BLOCK = 1024
_U = np.uint64


def set_key(tokens: np.ndarray) -> int:
    """64-bit key of a whole set, which names its class."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def min_keys(tokens: np.ndarray) -> list[int]:
    """Minima of the set under a few hash functions, each made distinct by its number."""
    out = []
    for j in range(KEYS):
        factor = _U((0x9E3779B97F4A7C15 * (2 * j + 3)) % 2**64 | 1)
        x = tokens * factor
        out.append(int(((x ^ (x >> _U(31))) * _U(0xD6E8FEB86659FD93) ^ _U(j)).min().view(np.int64)))
    return out


def _texts(batch) -> list[bytes]:
    return [t.encode() for t in batch.column("text").to_pylist()]


def _profile(docs: DataFrame, words: int) -> DataFrame:
    """A row a document (id, n, c: set key, keys), and rows of counts of shingles (tok, cnt)."""

    def profile(batches):
        import pyarrow as pa
        schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("c", pa.int64()), ("keys", pa.list_(pa.int64())),
                            ("tok", pa.int64()), ("cnt", pa.int64())])
        held, size, seen = [], 0, set()

        def counted():
            tok, cnt = np.unique(np.concatenate(held), return_counts=True)
            often = cnt >= 2
            k = int(often.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64())] * 3 + [pa.nulls(k, pa.list_(pa.int64())),
                 pa.array(tok[often].view(np.int64)), pa.array(cnt[often].astype(np.int64))], schema=schema)

        for batch in (part for whole in batches for part in text_slices(whole)):
            n, c, keys = [], [], []
            for tokens in shingle_sets(_texts(batch), words):
                n.append(len(tokens))
                c.append(set_key(tokens))
                keys.append(min_keys(tokens) if len(tokens) else [])
                if len(tokens) and c[-1] not in seen:  # copies in the same block of texts count once
                    seen.add(c[-1])
                    held.append(tokens)
                    size += len(tokens)
                if size >= CHUNK:
                    yield counted()
                    held, size, seen = [], 0, set()
            k = len(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                 pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], schema=schema)
        if held:
            yield counted()

    return docs.mapInArrow(profile, "id bigint, n bigint, c bigint, keys array<bigint>, tok bigint, cnt bigint")


def _common(profile: DataFrame) -> dict[str, np.ndarray]:
    """Common shingles, sorted, with the size class of their counts."""
    counts = profile.where("tok is not null").groupBy("tok").agg(F.sum("cnt").alias("cnt"))
    # the least count that at most COMMON shingles reach; counts of counts are few
    sizes = sorted(counts.groupBy(F.least("cnt", F.lit(100_000)).alias("cnt")).count().collect(), reverse=True)
    least, reached = 2, 0
    for size, n in sizes:
        reached += n
        if reached > COMMON:
            least = size + 1
            break
    found = counts.where(F.col("cnt") >= least).limit(COMMON).toArrow()  # the limit only meets ties above 100,000
    tok = found.column("tok").to_numpy().astype(np.int64).view(_U)
    order = np.argsort(tok)
    tok = tok[order]
    marks = np.zeros(1 << MARKS, dtype=bool)  # by leading bits: most shingles need no search
    marks[tok >> _U(64 - MARKS)] = True
    return {"tok": tok, "marks": marks,
            "often": np.log2(found.column("cnt").to_numpy().astype(np.float64))[order].astype(np.int64)}


def prefix(tokens: np.ndarray, common: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """The first shingles of a set in the corpus order: rare ones by hash, then common ones by count."""
    n = len(tokens)
    k = n - -(-n * percent // 100) + 1
    tok = common["tok"]
    marked = np.flatnonzero(common["marks"][tokens >> _U(64 - MARKS)])
    at = np.minimum(np.searchsorted(tok, tokens[marked]), len(tok) - 1) if len(tok) else marked
    hit = tok[at] == tokens[marked] if len(tok) else np.zeros(0, dtype=bool)
    if not hit.any():
        return tokens[:k]
    often = np.zeros(n, dtype=np.int64)
    often[marked[hit]] = common["often"][at[hit]]
    rare = tokens[often == 0]
    return rare[:k] if len(rare) >= k else tokens[np.lexsort((tokens, often))][:k]


def _fetch(docs: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """Texts of the documents asked for (and a few more: the joins that follow are exact), from one scan."""
    asked = IdFilter(ids)

    @F.pandas_udf("boolean")
    def wanted(ids: pd.Series) -> pd.Series:
        return pd.Series(asked.may_contain(ids.to_numpy(dtype=np.int64)))

    return materialise(docs.where("id is not null").where(wanted("id")), f"{label}-texts")


def _compare(pairs: DataFrame, texts: DataFrame, words: int, percent: int, label: str) -> DataFrame:
    """``pairs`` (ca, ida, cb, idb) with ``o``, the exact overlap of their sets, and whether they link."""
    pairs = materialise(pairs, f"{label}-pairs")

    def overlaps(batches):
        import pyarrow as pa
        known: dict[bytes, np.ndarray] = {}
        held = 0
        for batch in (part for whole in batches for part in text_slices(whole, "ta")):
            ca, ida, cb, idb, ta, tb = (batch.column(k).to_pylist() for k in ("ca", "ida", "cb", "idb", "ta", "tb"))
            out = []
            for a, i, b, j, x, y in zip(ca, ida, cb, idb, ta, tb):
                new = [t for t, k in ((x, a), (y, b)) if k not in known]
                if held > CHUNK:
                    known, held, new = {}, 0, [x, y]
                for s in shingle_sets([t.encode() for t in new], words):
                    known[set_key(s)] = s
                    held += len(s)
                if a in known and b in known:  # else a row that repeats an id with another text
                    o = overlap(known[a], known[b])
                    out.append((a, i, b, j, o, (100 + percent) * o >= percent * (len(known[a]) + len(known[b]))))
            kinds = (*[pa.int64()] * 5, pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
                                             ["ca", "ida", "cb", "idb", "o", "linked"])

    both = (pairs.join(texts.select(F.col("id").alias("ida"), F.col("text").alias("ta")), "ida")
            .join(texts.select(F.col("id").alias("idb"), F.col("text").alias("tb")), "idb")
            .select("ca", "ida", "cb", "idb", "ta", "tb"))
    return materialise(both.mapInArrow(overlaps, "ca bigint, ida bigint, cb bigint, idb bigint, o bigint, linked boolean"),
                       f"{label}-overlaps")


def _meet(x: DataFrame, y: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between hubs' members and partners' members (hub, lead, o, c, rep, n, slack), one a family and group.

    Both sides are dealt into blocks, and each pair of blocks is a group of its
    own: a text goes along once for each block of the other side, so pairs are
    no rows. Overlaps are exact, and taken only where ``o`` and the slacks allow
    a link.
    """
    def blocks(df, name):
        return df.groupBy("hub").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / CHUNK)).cast("int").alias(name))

    sides = blocks(x, "nx").join(blocks(y, "ny"), "hub")
    own = lambda n: F.pmod(F.xxhash64("c", "hub"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = ["hub", "bx", "by", "side", "lead", "slack", "o", "c", "rep", "n"]
    both = (x.join(sides, "hub").withColumns({"bx": own("nx"), "side": F.lit(0)}).withColumn("by", each("ny")).select(rows)
            .union(y.join(sides, "hub").withColumns({"by": own("ny"), "side": F.lit(1)}).withColumn("bx", each("nx")).select(rows)))

    def links(batches):
        import pyarrow as pa
        at, near, packed, joined = None, [], None, set()
        for batch in (part for whole in batches for part in text_slices(whole)):
            out = []
            for row, tokens in zip(zip(*(batch.column(k).to_pylist() for k in rows)), shingle_sets(_texts(batch), words)):
                *key, side, lead, slack, o, c, rep, n = row
                if set_key(tokens) != c:
                    continue  # a row that repeats an id with another text
                if key != at:
                    at, near, packed, joined = key, [], None, set()
                if side == 0:
                    near.append((slack, n, rep, tokens))
                    continue
                if lead in joined or not near:
                    continue
                if packed is None:  # the hub's members come first, by slack
                    size = np.array([r[1] for r in near], dtype=np.int64)
                    packed = (np.array([r[0] for r in near], dtype=np.int64), size, np.concatenate([[0], np.cumsum(size)]),
                              np.concatenate([r[3] for r in near]))
                slacks, size, ends, theirs = packed
                m = int(np.searchsorted(slacks, (100 + percent) * o - slack, side="right"))
                if not m:
                    continue
                theirs = theirs[:ends[m]]
                shared = np.add.reduceat(tokens[np.minimum(np.searchsorted(tokens, theirs), n - 1)] == theirs, ends[:m], dtype=np.int64)
                hit = np.flatnonzero((100 + percent) * shared >= percent * (size[:m] + n))
                if len(hit):
                    joined.add(lead)
                    out.append((rep, near[hit[0]][2]))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(2)], ["a", "b"])

    return (both.join(texts.select(F.col("id").alias("rep"), "text"), "rep").select(*rows, "text")
            .repartition("hub", "bx", "by").sortWithinPartitions("hub", "bx", "by", "side", "lead", "slack")
            .mapInArrow(links, "a bigint, b bigint"))


def _blocks_that_meet(batches, percent: int):
    """Pairs of leaders whose blocks pass the size and position filters, for lists of whole shingles."""
    import pyarrow as pa
    parts = [[np.asarray(b.column(i)) for i in range(4)] for b in batches]
    if not parts:
        return
    tok, lead, n, pos = (np.concatenate([p[i] for p in parts]) for i in range(4))
    del parts
    order = np.lexsort((pos, lead, n, tok))
    tok, lead, n, pos = tok[order], lead[order], n[order], pos[order]
    first = np.ones(len(tok), dtype=bool)  # the least position of each block
    first[1:] = (tok[1:] != tok[:-1]) | (n[1:] != n[:-1]) | (lead[1:] != lead[:-1])
    tok, lead, n, pos = tok[first], lead[first], n[first].astype(np.int64), pos[first].astype(np.int64)
    ends = np.concatenate([np.flatnonzero(tok[1:] != tok[:-1]), [len(tok) - 1]]) if len(tok) else np.zeros(0, int)
    last = np.repeat(ends, np.diff(np.concatenate([[-1], ends])))  # last block of each block's list
    mixed = np.zeros(len(tok), dtype=bool)  # lists of more than one leader
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    if len(tok):
        mixed = np.repeat(np.minimum.reduceat(lead, starts) != np.maximum.reduceat(lead, starts), ends - starts + 1)
    i = np.flatnonzero(mixed)
    found: list[np.ndarray] = []
    pending, step = 0, 1

    def distinct():
        return [np.unique(np.concatenate(found, axis=0), axis=0)] if found else []

    while len(i):
        j = i + step
        near = j <= last[i]
        i, j = i[near], j[near]
        # sizes ascend within a list, so the rest of it is skipped once one is too large
        near = 100 * n[i] >= percent * n[j]
        i, j = i[near], j[near]
        need = -(-percent * (n[i] + n[j]) // (100 + percent))
        meets = (lead[i] != lead[j]) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need)
        if meets.any():
            a, b = lead[i[meets]], lead[j[meets]]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
            pending += len(a)
            if pending > 2_000_000:
                found = distinct()
                pending = 0
        step += 1
    for pairs in distinct():
        for a in range(0, len(pairs), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[a:a + 100_000, 0]), pa.array(pairs[a:a + 100_000, 1])],
                                             ["la", "lb"])


def link_sets(docs: DataFrame, words: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text",
              label: str = "ngrams") -> DataFrame:
    """One row a document: ``doc_id, n_shingles, component_id`` (least id reachable by links).

    These are the classes that the links make, and not the links: pairs that
    are in one component already are not compared, so neither the links nor
    their number is known.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spark = docs.sparkSession
    profile = materialise(_profile(docs, words), f"{label}-profile")
    common = spark.sparkContext.broadcast(_common(profile))
    rows = profile.where("tok is null").select("id", "n", "c", "keys")

    classes = materialise(rows.where("n > 0 and id is not null").groupBy("c")
                          .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys")),
                          f"{label}-classes")
    named = classes.select("c", "rep", "n")

    # 2. leaders
    sized = lambda a, b: (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))
    loose = classes.select("c", "rep", "n", F.explode("keys").alias("key"))
    sizes = materialise(loose.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), f"{label}-sizes")
    grouped = materialise(loose.join(sizes, "key"), f"{label}-grouped")
    # the class that shares its keys with most others is the likeliest to be near them all
    liked = materialise(grouped.groupBy("c").agg(F.sum("size").alias("liked")), f"{label}-liked")
    loose = materialise(grouped.drop("size").join(liked, "c"), f"{label}-loose")
    texts = _fetch(docs, loose.select("rep").distinct(), f"{label}-stars")
    close_rounds, held_rounds = [], []
    for k in range(ROUNDS):
        at = f"{label}-{k}"
        heads = materialise(
            loose.groupBy("key").agg(F.max(F.struct("liked", F.xxhash64("c", F.lit(k)), "rep", "c", "n")).alias("head"),
                                     F.count("*").alias("size")).where("size > 1")
            .select("key", F.col("head.rep").alias("idb"), F.col("head.c").alias("cb"), F.col("head.n").alias("nb")), f"{at}-heads")
        stars = materialise(
            loose.join(heads, "key").where(F.col("c") != F.col("cb")).where(sized("n", "nb"))
            .select("key", F.col("c").alias("ca"), F.col("rep").alias("ida"), "cb", "idb"), f"{at}-stars")
        close = _compare(stars.drop("key").distinct(), texts, words, percent, at).where("linked").drop("linked")
        # of its leaders that follow none themselves, a class follows the most similar one
        held = materialise(
            close.join(close.select(F.col("ca").alias("cb")).distinct(), "cb", "left_anti")
            .groupBy("ca").agg(F.max(F.struct("o", "cb")).alias("best"))
            .select(F.col("ca").alias("c"), F.col("best.cb").alias("lead"), F.col("best.o").alias("o")), f"{at}-held")
        close_rounds.append(close)
        held_rounds.append(held)
        if k + 1 == ROUNDS or held.isEmpty():
            break
        settled = held.select("c").union(held.select("lead")).distinct()
        live = stars.join(close.select("ca", "cb"), ["ca", "cb"], "left_semi").select("key").distinct()
        loose = materialise(loose.join(materialise(live, f"{at}-live"), "key", "left_semi")
                            .join(materialise(settled, f"{at}-settled"), "c", "left_anti"), f"{at}-loose")
    close, held = reduce(DataFrame.union, close_rounds), reduce(DataFrame.union, held_rounds)
    follow = materialise(
        named.join(held, "c", "left")
        .select("c", "rep", "n", F.coalesce("lead", "c").alias("lead"),
                F.coalesce(F.col("n") - F.col("o"), F.lit(0)).alias("own"))
        # x and y can only link if (100 + percent) * o >= slack(x) + slack(y)
        .withColumn("slack", percent * F.col("n") - (100 + percent) * F.col("own")), f"{label}-follow")

    # 3. index lists
    def entries(batches):
        import pyarrow as pa
        for batch in (part for whole in batches for part in text_slices(whole)):
            cs, leads = batch.column("c").to_pylist(), batch.column("lead").to_pylist()
            toks, lead, n, pos = [], [], [], []
            for tokens, c, at in zip(shingle_sets(_texts(batch), words), cs, leads):
                if set_key(tokens) != c:
                    continue  # a row that repeats an id with another text
                p = prefix(tokens, common.value, percent)
                toks.append(p)
                lead.append(np.full(len(p), at, np.int64))
                n.append(np.full(len(p), len(tokens), np.int32))
                pos.append(np.arange(len(p), dtype=np.int32))
            if toks:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(toks).view(np.int64)), pa.array(np.concatenate(lead)),
                     pa.array(np.concatenate(n)), pa.array(np.concatenate(pos))], ["tok", "lead", "n", "pos"])

    index = (docs.join(follow.select(F.col("rep").alias("id"), "c", "lead"), "id").select("c", "lead", "text")
             .mapInArrow(entries, "tok bigint, lead bigint, n int, pos int"))
    meeting = materialise(index.repartition("tok").mapInArrow(
        lambda b: _blocks_that_meet(b, percent), "la bigint, lb bigint").distinct(), f"{label}-meeting")
    # their texts, and those of all that follow them
    texts = _fetch(docs, follow.join(meeting.select(F.col("la").alias("lead")).union(meeting.select("lb")).distinct(),
                                     "lead").select("rep"), f"{label}-meeting")

    # 4. leaders' answers, and from them those of their followers
    lead_of = follow.where("lead = c").select("c", "rep")
    pairs = (meeting.join(lead_of.select(F.col("c").alias("la"), F.col("rep").alias("ida")), "la")
             .join(lead_of.select(F.col("c").alias("lb"), F.col("rep").alias("idb")), "lb")
             .select(F.col("la").alias("ca"), "ida", F.col("lb").alias("cb"), "idb"))
    between = _compare(pairs, texts, words, percent, f"{label}-between")
    joined = between.where("linked")
    least = materialise(follow.groupBy("lead").agg(F.min("slack").alias("slack"), F.count("*").alias("size")), f"{label}-least")
    weight = 100 + percent
    by_id = lambda df: df.select(F.col("ida").alias("a"), F.col("idb").alias("b"))
    known = materialise(connected_components(by_id(close).union(by_id(joined)), f"{label}-known"), f"{label}-together")
    # the larger family of a pair is its hub, which meets the members of all its partners at once
    hub = F.col("ka") >= F.col("kb")
    other = lambda x, y: F.when(hub, F.col(x)).otherwise(F.col(y))
    open_pairs = materialise(
        between.where("not linked")
        .join(least.select(F.col("lead").alias("ca"), F.col("slack").alias("sa"), F.col("size").alias("ka")), "ca")
        .join(least.select(F.col("lead").alias("cb"), F.col("slack").alias("sb"), F.col("size").alias("kb")), "cb")
        .where((F.col("ka") + F.col("kb") > 2) & (weight * F.col("o") >= F.col("sa") + F.col("sb")))
        .select(other("ca", "cb").alias("hub"), other("ida", "idb").alias("ida"), other("sa", "sb").alias("sa"),
                other("cb", "ca").alias("lead"), other("idb", "ida").alias("idb"), other("sb", "sa").alias("sb"), "o"),
        f"{label}-open")
    dealt = F.pmod(F.xxhash64("c", F.lit(ROUNDS)), F.lit(DEALT))
    # A follower is linked with its leader, so one link between two families joins
    # them whole. Hubs therefore meet their partners in rounds, a share of their
    # members first, and families that a round has joined have none left to compare.
    for k, (low, high) in enumerate(zip(SHARES, SHARES[1:])):
        group = lambda s: known.select(F.col("node").alias(f"id{s}"), F.col("component").alias(f"in{s}"))  # noqa: B023, E731
        apart = materialise(
            open_pairs.join(group("a"), "ida", "left").join(group("b"), "idb", "left")
            .where(F.coalesce("ina", "ida") != F.coalesce("inb", "idb")).select("hub", "lead", "o", "sa", "sb"), f"{label}-apart-{k}")
        x = (follow.withColumnRenamed("lead", "hub")
             .join(apart.groupBy("hub").agg(F.max(weight * F.col("o") - F.col("sb")).alias("most")), "hub")
             .where((F.col("slack") <= F.col("most")) & (dealt >= low) & (dealt < high))
             .select("hub", F.col("hub").alias("lead"), F.lit(0).cast("bigint").alias("o"), "c", "rep", "n", "slack"))
        y = (apart.join(follow, "lead").where(weight * F.col("o") >= F.col("slack") + F.col("sa"))
             .select("hub", "lead", "o", "c", "rep", "n", "slack"))
        rest = materialise(_meet(materialise(x, f"{label}-hubs-{k}"), materialise(y, f"{label}-partners-{k}"),
                                 texts, words, percent), f"{label}-rest-{k}")
        if not rest.isEmpty():
            known = materialise(connected_components(
                rest.union(known.select(F.col("node").alias("a"), F.col("component").alias("b"))), f"{label}-known-{k}"),
                f"{label}-together-{k}")
    # an id with rows of several texts stands for all of their classes
    several = rows.where("n > 0 and id is not null").groupBy("id").agg(
        F.min("c").alias("c"), F.max("c").alias("d")).where("c <> d").select("id")
    several = (rows.where("n > 0").select("id", "c").join(several, "id").join(named.select("c", "rep"), "c")
               .select(F.col("id").alias("a"), F.col("rep").alias("b")))
    more = materialise(several, f"{label}-more")
    components = known if more.isEmpty() else materialise(connected_components(
        more.union(known.select(F.col("node").alias("a"), F.col("component").alias("b"))), label), f"{label}-components")
    placed = materialise(named.join(components, F.col("rep") == F.col("node"), "left")
                         .select("c", F.coalesce("component", "rep").alias("component_id")), f"{label}-placed")
    return (rows.join(placed, "c", "left")
            .select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("id"))
                    .otherwise(F.col("component_id")).alias("component_id")))
