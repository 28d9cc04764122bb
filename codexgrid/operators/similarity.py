"""Similarity of texts by matching blocks, and joins on it without materialised pairs."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TASKS = 4  # for each core or partition, where work doesn't go with bytes
BLOCK = 256  # rows of either side in one task's block
CLASSES = 64  # of characters, for the bound
REACH = 12  # characters on the way to a rare one that are looked up
CELLS = 1 << 25  # characters of right texts times left texts that are looked up at once
FREQUENT = 200  # from this length on difflib lets frequent characters begin no block
MIX = np.uint64(0x9E3779B97F4A7C15)
NONE = np.uint64(1 << 32)


def ratio(a: str, b: str) -> float:
    """Twice the matched characters over all characters, as difflib has it (the second text's frequent characters don't begin matches)."""
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(T.DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else 1.0 if x == y else 2.0 * _matched(x, y, SequenceMatcher(None, "", y)) / (len(x) + len(y)) for x, y in zip(a, b)], dtype="float64")


def _histograms(texts: list[str]) -> np.ndarray:
    """How often the characters of each of CLASSES classes occur in each text."""
    out = np.zeros((len(texts), CLASSES), np.int32)
    for i, t in enumerate(texts):
        out[i] = np.bincount(np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32) % CLASSES, minlength=CLASSES)
    return out


class _Joined:
    """Texts one after the other as numbers, with a place after each that is no character."""

    def __init__(self, texts: list[str]) -> None:
        sizes = np.asarray([len(x) + 1 for x in texts])
        self.ends = np.cumsum(sizes) - 1
        self.starts = self.ends + 1 - sizes
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        self.chars = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.chars[self.ends] = NONE

    def hashes(self) -> Iterator[tuple[int, np.ndarray]]:
        """(size, hashes of so many characters from each place on) for the sizes to REACH."""
        h = self.chars * MIX
        for size in range(1, REACH + 1):
            if size > 1:
                h = (h[:-1] ^ self.chars[size - 1 :]) * MIX
            yield size, h


class _Common:
    """How many characters each left text can at most have in common, in order, with a right text."""

    def __init__(self, left: list[str]) -> None:
        self.left = _Joined(left)
        self.width = (len(self.left.chars) + 7) // 8
        self.full = self._bits(self.left.chars != NONE)
        self.masks: dict[str, int] = {}

    @staticmethod
    def _bits(of: np.ndarray) -> int:
        return int.from_bytes(np.packbits(of, bitorder="little").tobytes(), "little")

    def of(self, text: str) -> np.ndarray:
        """The longest common subsequence of each left text with ``text``, a bit for each left character, all texts in one number."""
        full, masks, v = self.full, self.masks, self.full
        for c in {*text} - masks.keys():
            masks[c] = self._bits(self.left.chars == ord(c))
        for c in text:
            if m := masks[c]:
                u = v & m
                v = ((v + u) | (v - u)) & full  # a text's carry ends at the bit after it
        found = np.unpackbits(np.frombuffer((full ^ v).to_bytes(self.width, "little"), np.uint8), bitorder="little")
        return np.add.reduceat(found, self.left.starts, dtype=np.int64)


class _Reach:
    """How many characters of right texts can be in a matching block, for each left text, as only rare characters begin blocks.

    A block has a rare character, so each of its characters comes with the way
    to the next rare one on its left or on its right, and the left text has that way
    too. Only a common beginning of both texts can be a block without one, so what
    is before the first rare one counts always. Ways over REACH characters are
    cut, which leaves them necessary. Equal hashes of different ways only raise the bound.
    """

    def __init__(self, left: _Joined, n: int, right: list[str]) -> None:
        r = _Joined(right)
        k, start, end = np.arange(len(r.chars)), r.starts[r.owner], r.ends[r.owner]
        _, which, count = np.unique((r.owner.astype(np.uint64) << np.uint64(33)) | r.chars, return_inverse=True, return_counts=True)
        rare = (r.chars != NONE) & ((end - start < FREQUENT) | (count[which] <= (end - start) // 100 + 1))
        after = np.minimum.accumulate(np.where(rare, k, len(k))[::-1])[::-1]
        before = np.maximum.accumulate(np.where(rare, k, -1))
        far, near = np.where(after < end, np.minimum(after - k + 1, REACH), 0), np.where(before >= start, np.minimum(k - before + 1, REACH), 0)  # 0: no rare one
        self.starts, self.ends = r.starts, r.ends
        self.far, self.near = np.zeros(len(k), np.int64), np.where(before >= start, 0, 1)  # rows of ``has``; 0: in no left text, 1: in all
        has, first = [np.arange(2)[:, None].repeat(n, 1).astype(bool)], 2
        for (size, h), (_, g) in zip(r.hashes(), left.hashes()):
            x, y = np.flatnonzero(far == size), np.flatnonzero(near == size)
            ways, row = np.unique(np.concatenate([h[x], h[y - size + 1]]), return_inverse=True)
            self.far[x], self.near[y] = first + row[: len(x)], first + row[len(x) :]
            first += len(ways)
            has.append(np.zeros((len(ways), n), bool))
            if len(ways):
                i = np.minimum(np.searchsorted(ways, g), len(ways) - 1)
                hit = np.flatnonzero(ways[i] == g)
                has[-1][i[hit], left.owner[hit]] = True
        self.has = np.concatenate(has)

    def of(self, j: int) -> np.ndarray:
        """For the right text at place ``j``, by left text."""
        far, near = self.far[self.starts[j] : self.ends[j]], self.near[self.starts[j] : self.ends[j]]
        return sum((self.has[far[k : k + 4096]] | self.has[near[k : k + 4096]]).sum(0, dtype=np.int64) for k in range(0, len(far), 4096))


def _plain(a: str, b: str) -> Callable[[int, int, int, int], tuple[int, int, int]]:
    """Finds the longest common block of two ranges, the earliest in ``a`` and then in ``b``: places and size."""

    def longest(alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
        y, at, size = b[blo:bhi], alo, 0
        for i in range(alo, ahi):
            if i + size >= ahi:
                break
            if a[i : i + size + 1] in y:
                size += 1
                while i + size < ahi and a[i : i + size + 1] in y:
                    size += 1
                at = i
        return at, blo + y.find(a[at : at + size]), size

    return longest


def _seeded(a: str, b: str, places: dict[str, list[int]]) -> Callable[[int, int, int, int], tuple[int, int, int]]:
    """As ``_plain``, but by runs of the characters in ``places`` (theirs in ``b``), which any others then lengthen."""
    marks = [i for i, c in enumerate(a) if c in places]

    def longest(alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
        besti, bestj, size, last, runs = alo, blo, 0, -1, {}
        for i in marks[bisect_left(marks, alo) : bisect_left(marks, ahi)]:
            before, runs = runs if i == last + 1 else {}, {}
            last = i
            for j in places[a[i]]:
                if j >= bhi:
                    break
                if j >= blo:
                    k = runs[j] = before.get(j - 1, 0) + 1
                    if k > size:
                        besti, bestj, size = i - k + 1, j - k + 1, k
        while besti > alo and bestj > blo and a[besti - 1] == b[bestj - 1]:
            besti, bestj, size = besti - 1, bestj - 1, size + 1
        while besti + size < ahi and bestj + size < bhi and a[besti + size] == b[bestj + size]:
            size += 1
        return besti, bestj, size

    return longest


def _matched(a: str, b: str, m: SequenceMatcher, least: int = 0) -> int:
    """Characters in matching blocks as ``m`` has them, whose second text is ``b``; -1 if they are fewer than ``least``.

    The longest block, then the same on both sides of it. What is left of the
    shorter sides bounds what can come.
    """
    longest = _seeded(a, b, m.b2j) if m.bpopular else _plain(a, b)
    got, rest, todo = 0, min(len(a), len(b)), [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        rest -= min(ahi - alo, bhi - blo)
        i, j, size = longest(alo, ahi, blo, bhi)
        if size:
            got += size
            for lo, hi, lower, upper in ((alo, i, blo, j), (i + size, ahi, j + size, bhi)):
                if lo < hi and lower < upper:
                    todo.append((lo, hi, lower, upper))
                    rest += min(hi - lo, upper - lower)
        if got + rest < least:
            return -1
    return got


def ratios_at_least(left: list[str], right: list[str], t: float) -> Iterator[tuple[int, int, float]]:
    """(place in left, place in right, ratio) of the pairs whose ratio(left, right) is at least ``t``.

    A pair can't match more characters than both have of any class, nor more than
    both have in the same order, nor, where the right text's frequent characters
    begin no block, more than its rare ones reach. What those bounds leave is
    compared, each right text being indexed once.
    """
    size = np.asarray([len(x) for x in left])
    have = _histograms(left)
    m = SequenceMatcher(None)
    some: dict[int, np.ndarray] = {}  # the left places that the bounds leave, by right place

    def leave(j: int, of: np.ndarray, most: np.ndarray) -> None:
        of = of[2 * most[of] >= t * (size[of] + len(right[j])) - 1e-9]
        if len(of):
            some[j] = of

    for j, h in enumerate(_histograms(right)):
        leave(j, np.arange(len(left)), np.minimum(have, h).sum(1))
    short, long = [j for j in some if len(right[j]) < FREQUENT], [j for j in some if len(right[j]) >= FREQUENT]
    if short:
        common = _Common(left)
        for j in short:
            leave(j, some.pop(j), common.of(right[j]))
    joined = _Joined(left) if long else None
    while long:
        n = max(1, int(np.searchsorted(np.cumsum([len(right[j]) for j in long]), CELLS // len(left), "right")))
        part, long = long[:n], long[n:]
        reach = _Reach(joined, len(left), [right[j] for j in part])
        for k, j in enumerate(part):
            leave(j, some.pop(j), reach.of(k))
    for j, found in some.items():
        text = right[j]
        m.set_seq2(text)
        for i in found.tolist():
            both = len(left[i]) + len(text)
            if left[i] == text:
                yield i, j, 1.0
            elif (r := 2.0 * _matched(left[i], text, m, math.ceil(t * both / 2 - 1e-9)) / both) >= t:
                yield i, j, r


def _blocked(df: DataFrame, other: DataFrame, keys: list[str], mine: str, theirs: str) -> DataFrame:
    """Rows in blocks of about BLOCK by hash, repeated for every block of the other side."""
    n = df.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_n"))
    m = other.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_m"))
    d = df.join(n, keys).join(m, keys)
    d = d.select(*(F.col(c).alias(c) for c in d.columns))
    return d.withColumn(mine, F.pmod(F.xxhash64("id", "text"), F.col("_n")).cast("int")).withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col("_m") - 1))).drop("_n", "_m")


def spread(df: DataFrame) -> int:
    """Partitions for few bytes with much work, which Spark would put together by their bytes."""
    spark = df.sparkSession
    return TASKS * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def similar_texts(left: DataFrame, right: DataFrame, keys: list[str], t: float, ordered: bool = False) -> DataFrame:
    """Pairs (keys, left_id, right_id, similarity) of texts under equal keys whose ratio(left, right) is at least ``t``.

    Both sides have the keys, ``id`` (a number) and ``text``. Texts whose lengths
    differ too much for ``t`` never meet: lengths are put in bands so wide that
    only the same and the next band can. Hot keys are cut into blocks of both
    sides; a task sees one pair of blocks and emits only what reaches ``t``.
    ``ordered``: only left_id < right_id (a join with itself).
    """
    width = math.log((2.0 - t) / t)  # of the logarithms of two lengths that may still reach t
    band = F.when(F.length("text") == 0, F.lit(-2)).otherwise(F.floor(F.log(F.greatest(F.length("text"), F.lit(1)).cast("double")) / F.lit(width))).cast("int")
    fresh = lambda d: d.select(*(F.col(k).alias(k) for k in keys), F.col("id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))  # noqa: E731 (new columns: both sides may be one table)
    a = fresh(left).withColumn("_band", F.explode(F.array(band - 1, band, band + 1)))
    b = fresh(right).withColumn("_band", band)
    at = [*keys, "_band"]
    la, rb = _blocked(a, b, at, "_bl", "_br"), _blocked(b, a, at, "_br", "_bl")
    fields = ", ".join(f"`{k}` {left.schema[k].dataType.simpleString()}" for k in keys)

    def pairs(x: pa.Table, y: pa.Table) -> pa.Table:
        i, j = x["id"].to_pylist(), y["id"].to_pylist()
        out = [(p, i[p], j[q], r) for p, q, r in ratios_at_least(x["text"].to_pylist(), y["text"].to_pylist(), t) if not ordered or i[p] < j[q]]
        found = pa.table({"p": pa.array([o[0] for o in out], pa.int64()), "left_id": pa.array([o[1] for o in out], pa.int64()), "right_id": pa.array([o[2] for o in out], pa.int64()), "similarity": pa.array([o[3] for o in out], pa.float64())})
        return pa.table({**{k: x[k].take(found["p"]) for k in keys}, **{c: found[c] for c in found.column_names[1:]}})

    by = [*at, "_bl", "_br"]
    la, rb = (d.repartition(spread(d), *by) for d in (la, rb))
    return la.groupBy(*by).cogroup(rb.groupBy(*by)).applyInArrow(pairs, f"{fields}, left_id long, right_id long, similarity double")


def near_duplicates(rows: DataFrame, keys: list[str], t: float = 0.9) -> DataFrame:
    """(keys, id) of the rows that have another under the same keys with at least ratio ``t`` (earlier, later).

    Equal texts are found by counting; only different ones are compared.
    """
    r = rows.select(*keys, "id", F.coalesce("text", F.lit("")).alias("text"))
    classes = r.groupBy(*keys, "text").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    several = classes.groupBy(*keys).agg(F.count("*").alias("_c")).filter("_c > 1").select(*keys)
    some = classes.join(several, keys, "left_semi")
    pairs = similar_texts(some, some, keys, t, ordered=True)
    hit = pairs.select(*keys, F.explode(F.array("left_id", "right_id")).alias("id")).unionByName(classes.filter("n > 1").select(*keys, "id")).distinct()
    texts = classes.join(hit, [*keys, "id"], "left_semi").select(*keys, "text")
    return r.join(texts, [*keys, "text"], "left_semi").select(*keys, "id")
