"""Near-duplicate records with small edits (problem 3): an exact set-similarity join over signature trees.

Records are sets of word shingles. A record can only resemble another above the
threshold if both hold a common shingle among their rarest ones, so each
shingle's subtree receives the records that have it there. In a subtree the
records, sorted by size, are the leaves of a tree whose nodes hold OR-combined
bitmaps and size ranges; a dual traversal from (root, root) drops every pair of
nodes whose sizes or whose largest possible overlap exclude the threshold. What
is left of pairs of records is verified on whole texts.

What reaches the driver is bounded: the frequency sketch (at most
2**SKETCH_BITS bytes, sized by the collection) and, if the candidates are few
enough for one, the filter of their keys (at most 2**FILTER_BITS bits; beyond
that they meet the texts in a join). Both are merged in two levels. Texts are
never written; each pass reads them where they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexgrid.llm import words as W
from codexgrid.plans.materialize import written

SKETCH_BITS = 24  # at most; a cell for every second shingle or more below that
BLOCK_BITS = 16
FILTER_BITS = 27  # at most
KEY_BITS = 16  # of the filter for each key
FANOUT = 8
HOT = 100_000  # records of one shingle beyond which its subtree is sliced
POSTINGS_PER_BUCKET = 1_000_000
FRONTIER = 1 << 14
BITS_A_SHINGLE = 2.75  # width of the bitmaps, in steps of 64, over the mean size of a record
STEP = 1 << 20  # characters handled at once in a task
SLICE = 1000  # members of a class of equal texts that one task pairs with as many
SHARES = 1000  # a class that holds a SHARES-th of all records is looked up by broadcast

_mix = W.mix


def _read(it: Iterator[pd.DataFrame], least: int) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """(frame, places in it, word hashes, words of each) of the texts of ``least`` words or more, in parts of about STEP characters."""
    for pdf in it:
        texts = pdf["text"].tolist()
        for a, b in W.batches(texts, STEP):
            h, n = W.hashed(texts[a:b])
            keep = n >= least
            yield pdf, a + np.flatnonzero(keep), h[np.repeat(keep, n)], n[keep]


def _key(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return W.combined(h, n, 1).view(np.int64), W.combined(h, n, 2).view(np.int64)


def _merged(rows: DataFrame, size: int, add) -> list:
    """Rows (block, body, n) of the pieces (block, salt, body, n) of all tasks: merged by block and salt, then by block."""
    merge = lambda key, pdf: pd.DataFrame({"block": [int(key[0])], "salt": [0], "body": [add(int(key[0]), list(pdf["body"]))], "n": [int(pdf["n"].sum())]})
    schema = "block int, salt int, body binary, n long"
    return rows.groupBy("block", "salt").applyInPandas(merge, schema).groupBy("block").applyInPandas(merge, schema).collect()


def _salt() -> int:
    from pyspark import TaskContext

    ctx = TaskContext.get()
    return ctx.partitionId() % 256 if ctx else 0


def _counted(at: np.ndarray, n: np.ndarray) -> bytes:
    """Places in a block and what they count, the counts in as few bytes as they need."""
    width = 1 if n.max() < 1 << 8 else 4 if n.max() < 1 << 32 else 8
    return bytes([width]) + at.astype(np.uint16).tobytes() + n.astype(f"u{width}").tobytes()


def _add_counts(block: int, bodies: list[bytes]) -> bytes:
    if block < 0:
        return b""
    total = np.zeros(1 << BLOCK_BITS, np.uint64)
    for body in bodies:
        width = body[0]
        m = (len(body) - 1) // (2 + width)
        total[np.frombuffer(body, np.uint16, m, 1)] += np.frombuffer(body[1 + 2 * m :], f"u{width}").astype(np.uint64)
    at = np.flatnonzero(total)
    return _counted(at, total[at])


def _sketch(docs: DataFrame, k: int, least: int) -> tuple[np.ndarray, int, int]:
    """Log-scaled counts of shingles by hash (one byte each), the number of shingles and of texts."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = int(np.clip(math.ceil(math.log2(chars / 12 + 1)), BLOCK_BITS, SKETCH_BITS))

    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, docs_n = np.zeros(1 << bits, np.uint32), 0
        for _, _, words, n in _read(it, least):
            _, h = W.sequences(words, n, k)
            docs_n += len(n)
            if len(h) > 1 << (bits - 3):
                total += np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint32)
            else:
                np.add.at(total, (h >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
        for b in range(1 << (bits - BLOCK_BITS)):
            part = total[b << BLOCK_BITS : (b + 1) << BLOCK_BITS]
            at = np.flatnonzero(part)
            if len(at):
                yield pd.DataFrame({"block": [b], "salt": [_salt()], "body": [_counted(at, part[at])], "n": [int(part.sum(dtype=np.int64))]})
        yield pd.DataFrame({"block": [-1], "salt": [_salt()], "body": [b""], "n": [docs_n]})

    out, n, texts = np.zeros(1 << bits, np.uint8), 0, 0
    for r in _merged(docs.select("text").mapInPandas(count, "block int, salt int, body binary, n long"), 1 << bits, _add_counts):
        if r.block < 0:
            texts = r.n
            continue
        n += r.n
        width, body = r.body[0], bytes(r.body)
        m = (len(body) - 1) // (2 + width)
        at = np.frombuffer(body, np.uint16, m, 1).astype(np.int64)
        out[(r.block << BLOCK_BITS) + at] = np.minimum(255, np.ceil(8 * np.log2(np.frombuffer(body[1 + 2 * m :], f"u{width}") + 1.0))).astype(np.uint8)
    return out, n, texts


def _least(share: float, n: np.ndarray) -> np.ndarray:
    return np.ceil(share * n - 1e-9).astype(np.int64)


def _postings(docs: DataFrame, k: int, t: float, least: int, sketch: np.ndarray, width: int, buckets: int) -> DataFrame:
    """Each record's rarest shingles with its size and bitmap, packed by bucket of shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)  # 2**SKETCH_BITS bytes at most
    bits = np.uint64(64 - (len(sketch).bit_length() - 1))
    hot_level = np.ceil(8 * np.log2(HOT + 1.0))

    def pack(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = shared.value
        for _, _, words, n in _read(it, least):
            key, _ = _key(words, n)
            once = np.zeros(len(n), bool)
            once[np.unique(key, return_index=True)[1]] = True  # equal texts beside each other
            key, words, n = key[once], words[np.repeat(once, n)], n[once]
            row, h = W.sequences(words, n, k)
            q = np.take(counts, (h >> bits).astype(np.int64))
            s = (q.astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))
            o = np.lexsort((s, row))
            row, h, q, s = row[o], h[o], q[o], s[o]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (s[1:] != s[:-1])
            row, h, q = row[new], h[new], q[new]
            n = np.bincount(row, minlength=len(key))
            places = np.zeros((len(key), width), np.uint8)
            places[row, (h % np.uint64(width)).astype(np.int64)] = 1
            sig = np.packbits(places, axis=1).view(np.uint64)
            rank = np.arange(len(row)) - (np.cumsum(n) - n)[row]
            keep = (rank <= n[row] - _least(t, n)[row]) & (q > 8)  # 8: seen once in all texts
            row, h, q, rank = row[keep], h[keep], q[keep], rank[keep]
            tok = ((h >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).astype(np.uint64)
            if (big := q >= hot_level).any():  # slices: a record meets each slice of a hot shingle's records in one subtree
                parts = np.maximum(2, np.exp2(q[big] / 8.0) // HOT).astype(np.int64)
                r2, t2, p2 = (np.repeat(x[big], parts) for x in (row, tok, rank))
                m = np.repeat(parts, parts)
                other = np.arange(len(m)) - np.repeat(np.cumsum(parts) - parts, parts)
                mine = (key[r2].astype(np.uint64) % m.astype(np.uint64)).astype(np.int64)
                t2 = _mix(t2 * np.uint64(1 << 20) + (np.minimum(mine, other) * m + np.maximum(mine, other)).astype(np.uint64)) & np.uint64(0xFFFFFFFF)
                row, tok, rank = (np.concatenate([a[~big], b]) for a, b in ((row, r2), (tok, t2), (rank, p2)))
            bucket = (tok % np.uint64(buckets)).astype(np.int64)
            o = np.argsort(bucket, kind="stable")
            row, tok, rank, bucket = row[o], tok[o], rank[o], bucket[o]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            out_b, out = [], []
            for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(bucket)]])):
                if a == b:
                    continue
                recs, at = np.unique(row[a:b], return_inverse=True)
                out_b.append(int(bucket[a]))
                few, low = (np.dtype(f"u{k}") for k in (_bytes(n.max()), _bytes(rank.max())))
                out.append(
                    np.array([len(recs), b - a, few.itemsize, low.itemsize], np.uint32).tobytes() + key[recs].tobytes() + sig[recs].tobytes() + n[recs].astype(few).tobytes() + tok[a:b].astype(np.uint32).tobytes() + at.astype(np.uint16 if len(recs) < 1 << 16 else np.uint32).tobytes() + rank[a:b].astype(low).tobytes()
                )
            yield pd.DataFrame({"bucket": out_b, "body": out})

    return docs.select("text").mapInPandas(pack, "bucket int, body binary").repartitionById(buckets, "bucket")  # a task for each bucket, however many there are


def _bytes(most: int) -> int:
    return 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4


def _unpack(bodies: list[bytes], words: int):
    key, sig, n, tok, rec, rank, base = [], [], [], [], [], [], 0
    for b in bodies:
        r, p, few, low = (int(x) for x in np.frombuffer(b, np.uint32, 4))
        at = 16

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(b, kind, count, at)
            at += out.nbytes
            return out

        key.append(take("i8", r))
        sig.append(take("u8", r * words).reshape(r, words))
        n.append(take(f"u{few}", r).astype(np.uint32))
        tok.append(take("u4", p))
        rec.append(take("u2" if r < 1 << 16 else "u4", p).astype(np.int64) + base)
        rank.append(take(f"u{low}", p).astype(np.int32))
        base += r
    return tuple(map(np.concatenate, (key, sig, n, tok, rec, rank)))


class _Level:
    __slots__ = ("least", "most", "room", "sig", "spare", "start", "count")

    def __init__(self, least, most, room, sig, spare, start=None, count=None):
        self.least, self.most, self.room, self.sig, self.spare, self.start, self.count = least, most, room, sig, spare, start, count


def _forest(n: np.ndarray, room: np.ndarray, sig: np.ndarray, run: np.ndarray) -> list[_Level]:
    """Signature trees of all runs at once: level 0 has the records, the last one root a run.

    ``room``: how many shingles a record has from the run's shingle on. A pair
    that meets first in this run can't share more.
    """
    levels = [_Level(n, n, room, sig, n - np.bitwise_count(sig).sum(1).astype(np.int32))]
    while True:
        first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        size = np.diff(np.concatenate([first, [len(run)]]))
        below = levels[-1]
        if len(levels) > 1 and size.max() == 1:
            return levels
        offset = np.arange(len(run)) - np.repeat(first, size)
        start = np.flatnonzero(offset % FANOUT == 0)
        count = np.diff(np.concatenate([start, [len(run)]]))
        levels.append(
            _Level(np.minimum.reduceat(below.least, start), np.maximum.reduceat(below.most, start), np.maximum.reduceat(below.room, start), np.bitwise_or.reduceat(below.sig, start, axis=0), np.maximum.reduceat(below.spare, start), start, count)
        )
        run = run[start]


def _dual(levels: list[_Level], t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of records (earlier, later in their run) that no bound excludes."""
    roots = np.arange(len(levels[-1].least))
    stack = [(len(levels) - 1, roots[i : i + FRONTIER], roots[i : i + FRONTIER]) for i in range(0, len(roots), FRONTIER)]
    while stack:
        level, a, b = stack.pop()
        up, low = levels[level], levels[level - 1]
        ca, cb = up.count[a], up.count[b]
        total = ca * cb
        rep = np.repeat(np.arange(len(a)), total)
        local = np.arange(len(rep)) - np.repeat(np.cumsum(total) - total, total)
        i, j = up.start[a][rep] + local // cb[rep], up.start[b][rep] + local % cb[rep]
        ok = (i < j) if level == 1 else (i <= j)
        ok &= low.least[j] * t <= low.most[i] + 1e-9
        i, j = i[ok], j[ok]
        need = np.ceil(t / (1 + t) * (low.least[i] + low.least[j]) - 1e-9)
        ok = np.minimum(low.room[i], low.room[j]) >= need
        i, j, need = i[ok], j[ok], need[ok]
        most = np.bitwise_count(low.sig[i] & low.sig[j]).sum(1) + np.minimum(low.spare[i], low.spare[j])
        ok = most >= need
        i, j = i[ok], j[ok]
        if level == 1:
            yield i, j
        else:
            stack += [(level - 1, i[x : x + FRONTIER], j[x : x + FRONTIER]) for x in range(0, len(i), FRONTIER)]


def _candidates(posts: DataFrame, t: float, width: int) -> DataFrame:
    def join(bodies: list[bytes]) -> pd.DataFrame:
        key, sig, n, tok, rec, rank = _unpack(bodies, width // 64)
        _, first, same = np.unique(key, return_index=True, return_inverse=True)
        rec = first[same[rec]]
        n = n.astype(np.int32)
        o = np.lexsort((rec, n[rec], tok))
        tok, rec, rank = tok[o], rec[o], rank[o]
        new = np.ones(len(tok), bool)
        new[1:] = (tok[1:] != tok[:-1]) | (rec[1:] != rec[:-1])
        tok, rec, rank = tok[new], rec[new], rank[new]
        edge = tok[1:] != tok[:-1]
        alone = np.concatenate([[True], edge]) & np.concatenate([edge, [True]])
        tok, rec, rank = tok[~alone], rec[~alone], rank[~alone]
        found = []
        if len(tok):
            levels = _forest(n[rec], n[rec] - rank, sig[rec], tok)
            for i, j in _dual(levels, t):
                a, b = key[rec[i]], key[rec[j]]
                found.append(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0))
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    def joined(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_bucket: dict[int, list[bytes]] = {}  # one, as a task has one bucket
        for pdf in it:
            for k, body in zip(pdf["bucket"].tolist(), pdf["body"]):
                by_bucket.setdefault(k, []).append(body)
        for bodies in by_bucket.values():
            yield join(bodies)

    return posts.mapInPandas(joined, "a long, b long").distinct()


def _key_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """A filter of 2**bits bits of the long column ``k1``, packed."""

    def put(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            at = np.unique(_mix(pdf["k1"].to_numpy().astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.int64)
            block = at >> BLOCK_BITS
            for a, b in _segments(block):
                yield pd.DataFrame({"block": [int(block[a])], "salt": [_salt()], "body": [(at[a:b] & ((1 << BLOCK_BITS) - 1)).astype(np.uint16).tobytes()], "n": [0]})

    add = lambda block, bodies: np.unique(np.frombuffer(b"".join(bodies), np.uint16)).tobytes()
    out = np.zeros(1 << bits, bool)
    for r in _merged(keys.select("k1").mapInPandas(put, "block int, salt int, body binary, n long"), 1 << bits, add):
        out[(r.block << BLOCK_BITS) + np.frombuffer(bytes(r.body), np.uint16).astype(np.int64)] = True
    return np.packbits(out)


def _segments(x: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(x)) + 1
    for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(x)]])):
        if a < b:
            yield int(a), int(b)


def similar_classes(docs: DataFrame, k: int, t: float, least: int) -> DataFrame:
    """Pairs (k1a, k2a, k1b, k2b, likeness) of different texts of ``least`` words or more whose likeness is at least ``t``.

    ``docs`` has ``text``; equal texts may repeat. k1 and k2 are two hashes of the words of a text (``text_keys``).
    """
    spark = docs.sparkSession
    sketch, total, texts = _sketch(docs, k, least)
    if not texts:
        return spark.createDataFrame([], "k1a long, k2a long, k1b long, k2b long, likeness double")
    width = 64 * max(2, round(BITS_A_SHINGLE * total / texts / 64))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((1 - t) * total / POSTINGS_PER_BUCKET))
    cand = written(_candidates(_postings(docs, k, t, least, sketch, width, buckets), t, width), "sigtree-candidates")
    keys = cand.select(F.explode(F.array("a", "b")).alias("k1")).distinct()
    bits = max(BLOCK_BITS, math.ceil(math.log2(KEY_BITS * keys.count() + 1)))
    held = spark.sparkContext.broadcast(_key_filter(keys, bits)) if bits <= FILTER_BITS else None

    def wanted(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, at, h, n in _read(it, least):
            k1, k2 = _key(h, n)
            if held is not None:
                x = (_mix(k1.view(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.int64)
                some = np.flatnonzero((held.value[x >> 3] >> (7 - (x & 7))) & 1)
                at, k1, k2 = at[some], k1[some], k2[some]
            if len(at):
                yield pd.DataFrame({"k1": k1, "k2": k2, "words": pdf["text"].to_numpy()[at]})

    one = docs.select("text").mapInPandas(wanted, "k1 long, k2 long, words string")
    if held is None:
        one = one.join(keys, "k1", "left_semi")
    one = one.groupBy("k1", "k2").agg(F.first("words").alias("words"))
    left = one.select(F.col("k1").alias("a"), F.col("k2").alias("k2a"), F.col("words").alias("wa"))
    right = one.select(F.col("k1").alias("b"), F.col("k2").alias("k2b"), F.col("words").alias("wb"))

    def verify(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if not len(pdf):
                continue
            # each text of the batch is read once: its shingles as numbers, all sets in one sorted array
            one_of = lambda k1, k2: pdf[k1].to_numpy().view(np.uint64) ^ _mix(pdf[k2].to_numpy().view(np.uint64))
            _, first, which = np.unique(np.concatenate([one_of("a", "k2a"), one_of("b", "k2b")]), return_index=True, return_inverse=True)
            texts = [*pdf["wa"], *pdf["wb"]]
            row, h = W.sequences(*W.hashed([texts[i] for i in first]), k)
            different, code = np.unique(h, return_inverse=True)
            sets = np.unique(row * len(different) + code)
            size = np.bincount(sets // len(different), minlength=len(first))
            begin = np.cumsum(size) - size
            x, y = which[: len(pdf)], which[len(pdf) :]
            x, y = np.where(size[x] <= size[y], x, y), np.where(size[x] <= size[y], y, x)
            pair = np.repeat(np.arange(len(x)), size[x])
            element = sets[np.arange(len(pair)) + np.repeat(begin[x] - (np.cumsum(size[x]) - size[x]), size[x])] % len(different) + y[pair] * len(different)
            at = np.minimum(np.searchsorted(sets, element), len(sets) - 1)
            both = np.bincount(pair[sets[at] == element], minlength=len(x))
            either = np.maximum(size[x] + size[y] - both, 1)
            keep = both >= t * either - 1e-9
            yield pdf[["a", "k2a", "b", "k2b"]].assign(likeness=both / either)[keep].rename(columns={"a": "k1a", "b": "k1b"})

    return cand.join(left, "a").join(right, "b").select("a", "k2a", "b", "k2b", "wa", "wb").mapInPandas(verify, "k1a long, k2a long, k1b long, k2b long, likeness double")


def _docs(rows: DataFrame, id_col: str, columns: tuple[str, ...]) -> DataFrame:
    text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    return rows.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), text.alias("text"))


def text_keys(docs: DataFrame, least: int) -> DataFrame:
    """id, k1, k2 of the texts (id, text) of ``least`` words or more; equal words give equal keys."""

    def keys(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, at, h, n in _read(it, least):
            k1, k2 = _key(h, n)
            yield pd.DataFrame({"id": pdf["id"].to_numpy()[at], "k1": k1, "k2": k2})

    return docs.mapInPandas(keys, f"id {docs.schema['id'].dataType.simpleString()}, k1 long, k2 long")


def _members(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """id, k1, k2, slice of the records, and k1, k2, slices, class_id, class_size of their classes of equal texts.

    Classes that hold a large share of all records go to them by broadcast (at
    most SHARES of them); a class of more than SLICE has slices.
    """
    members = written(text_keys(docs, least).distinct(), "sigtree-members")
    total = members.count()
    size = members.groupBy("k1", "k2").agg(F.count("*").alias("class_size"), F.min("id").alias("class_id"))
    size = written(size.withColumn("slices", F.ceil(F.col("class_size") / SLICE).cast("int")), "sigtree-sizes")
    often = F.col("class_size") * SHARES >= total
    hot, cold = F.broadcast(size.filter(often)), size.filter(~often)
    m = members.join(hot, ["k1", "k2"]).unionByName(members.join(hot.select("k1", "k2"), ["k1", "k2"], "left_anti").join(cold, ["k1", "k2"]))
    return m.withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")), size


def similar_pairs(rows: DataFrame, id_col: str = "block_id", columns: tuple[str, ...] = ("title", "text"), k: int = 3, t: float = 0.6, least_words: int = 40) -> DataFrame:
    """All pairs (id_a < id_b) of records with likeness at least ``t``: Jaccard similarity of their sets of ``k`` successive words.

    Defined results: null columns count as empty; records under ``least_words``
    words (at least ``k``) and records without id are left out; repeated rows of
    an id count once; equal texts under different ids are pairs of likeness 1;
    an empty table yields no row; other columns are ignored.
    """
    docs, least = _docs(rows, id_col, columns), max(k, least_words)
    classes = similar_classes(docs, k, t, least)
    members, size = _members(docs, least)
    slices = lambda d, own, other: d.withColumn(own, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
    side = lambda x: members.select(F.col("id").alias(f"id{x}"), F.col("k1").alias(f"k1{x}"), F.col("k2").alias(f"k2{x}"), F.col("slice").alias(f"s{x}"))
    parts = lambda x: size.select(F.col("k1").alias(f"k1{x}"), F.col("k2").alias(f"k2{x}"), F.col("slices").alias(f"n{x}"))
    met = slices(slices(classes.join(parts("a"), ["k1a", "k2a"]).join(parts("b"), ["k1b", "k2b"]), "sa", "na"), "sb", "nb").drop("na", "nb")
    across = met.join(side("a"), ["k1a", "k2a", "sa"]).join(side("b"), ["k1b", "k2b", "sb"]).select("ida", "idb", "likeness")
    several = members.filter("class_size > 1")
    first = slices(several.select(F.col("id").alias("ida"), "k1", "k2", F.col("slice").alias("sa"), "slices"), "sb", "slices").drop("slices")
    second = slices(several.select(F.col("id").alias("idb"), "k1", "k2", F.col("slice").alias("sb"), "slices"), "sa", "slices").drop("slices")
    within = first.join(second, ["k1", "k2", "sa", "sb"]).filter("ida < idb").select("ida", "idb", F.lit(1.0).alias("likeness"))
    return across.unionByName(within).filter("ida <> idb").select(F.least("ida", "idb").alias(f"{id_col}_a"), F.greatest("ida", "idb").alias(f"{id_col}_b"), "likeness").distinct()


def similar_records(rows: DataFrame, id_col: str = "block_id", columns: tuple[str, ...] = ("title", "text"), k: int = 5, t: float = 0.8, least_words: int = 5) -> DataFrame:
    """One row per record: its class of equal texts (least id), the class size and its number of links to different texts.

    Nulls, repeated rows and empty tables as in ``similar_pairs``.
    """
    docs, least = _docs(rows, id_col, columns), max(k, least_words)
    classes = similar_classes(docs, k, t, least)
    links = classes.select(F.explode(F.array(F.struct(F.col("k1a").alias("k1"), F.col("k2a").alias("k2")), F.struct(F.col("k1b").alias("k1"), F.col("k2b").alias("k2")))).alias("x")).groupBy("x.k1", "x.k2").agg(F.count("*").alias("n_links"))
    members, size = _members(docs, least)
    total = size.agg(F.sum("class_size")).first()[0] or 0
    linked = links.join(size.select("k1", "k2", "class_size"), ["k1", "k2"])
    often = F.col("class_size") * SHARES >= total
    hot, cold = F.broadcast(linked.filter(often)), linked.filter(~often)
    m = members.select("id", "k1", "k2", "class_id", "class_size")
    count = lambda d, x, how: d.join(x.select("k1", "k2", "n_links"), ["k1", "k2"], how)
    t_ = count(m, hot, "inner").unionByName(count(m.join(hot.select("k1", "k2"), ["k1", "k2"], "left_anti"), cold, "left"))
    return t_.select(F.col("id").alias(id_col), "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"))
