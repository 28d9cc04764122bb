"""Evaluation texts leaking into training text (problem 7): latent semantic retrieval and exact checks.

Texts are cut into overlapping passages of words. Every corpus passage is held
against every section of the items: those with enough words in common to meet a
check, a condition that each check implies, are checked on words: runs of common
words, longest common subsequence, and whether the item's figures occur. All
checks run on bit masks over the item's words, and no pair that meets one is
left out. A distributed randomised SVD (one pass over all passages, Nystroem
form) of the TF-IDF passages of corpus and items gives a latent space, in which
the cosine of each pair found is measured; no bound on it cuts pairs off.

The items are a stated query set: they are taken in blocks of at most
``BLOCK_WORDS`` words and ``BLOCK_CELLS`` cells of sections by words, and only a
block's passages and vocabulary are broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexgrid.llm import words as W

RUN = 13  # words; passages have twice as many and begin every RUN words
SECTION = 128  # words of an item that one bit mask covers; longer items have several, half overlapping
RANK = 64
EXTRA = 8  # additional random directions
BLOCK_WORDS = 200_000  # words of the items compared in one pass
BLOCK_CELLS = 16_000_000  # sections of the items times their different words
ORDERED = 18  # words of a passage in order that make a paraphrase
PART = ORDERED - RUN // 2  # of them at least lie in the nearer of the two passages that a paraphrase meets, wherever it begins
STEP = 1 << 20  # characters handled at once in a task
PAIRS = 8192  # pairs checked at once
COUNTED = 1 << 22  # rows of words times sections counted at once
OFTEN = 128  # words that the sketch takes by a product

_WORD = re.compile(r"[^\W_]+")


@dataclass
class Space:
    """A block of items in latent form; of a size bounded by BLOCK_WORDS and BLOCK_CELLS."""

    vocabulary: np.ndarray  # sorted hashes of the items' words
    sections: np.ndarray  # word numbers of each section, padded with -2
    ids: np.ndarray  # the item of each section
    digits: np.ndarray  # which words are figures; the last stands for -1
    at: np.ndarray  # (section, word): which mask says where the section has the word; 0 for none
    held: np.ndarray  # (word, section): whether it has, one byte each
    masks: np.ndarray  # of the places in a section, SECTION bits
    figures: np.ndarray  # the places of figures in each section
    shift: np.uint64  # that takes a hash to its slot
    slots: np.ndarray | None  # the word of each slot, where no two share one
    spans: list  # (mask of the places, which sections have figures there) of each passage of the sections
    term: np.ndarray | None = None  # latent vector of each word, times its inverse document frequency; the last is zero
    passage: np.ndarray | None = None  # (n, section): normed latent vectors of the n-th passages of the sections, zero where there is none

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 if the items don't have it."""
        at = np.take(self.slots, (hashes >> self.shift).astype(np.int32)) if self.slots is not None else np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1).astype(np.int32)
        at[np.take(self.vocabulary, at) != hashes] = -1
        return at

    def cosines(self, z: np.ndarray) -> np.ndarray:
        """(vector, section): the greatest cosine with a passage of the section."""
        z = z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
        best = z @ self.passage[0].T
        for p in self.passage[1:]:
            np.maximum(best, z @ p.T, out=best)
        return best


def _bits(places: np.ndarray) -> np.ndarray:
    """Booleans over SECTION places as two 64-bit masks."""
    return np.packbits(places, axis=-1, bitorder="little").view(np.uint64)


def _prepared(items: list[tuple]) -> Space | None:
    """The words of a block of items (id, text); None without any."""
    sections, ids = [], []
    for key, text in items:
        h, _ = W.hashed([text])
        for a in range(0, max(len(h) - SECTION // 2, 1), SECTION // 2):
            if len(h):
                sections.append(h[a : a + SECTION])
                ids.append(key)
    if not sections:
        return None
    vocabulary = np.unique(np.concatenate(sections))
    figures = {w for _, t in items for w in _WORD.findall(t.lower()) if w[0].isdigit()}
    marked = np.isin(vocabulary, W.hashed(sorted(figures))[0])
    padded = np.full((len(sections), SECTION), -2, np.int32)
    for k, h in enumerate(sections):
        padded[k, : len(h)] = np.searchsorted(vocabulary, h)
    owner, place = np.nonzero(padded >= 0)
    word = padded[owner, place]
    pair, inverse = np.unique(owner.astype(np.int64) * len(vocabulary) + word, return_inverse=True)
    places = np.zeros((len(pair) + 1, SECTION), bool)
    places[inverse + 1, place] = True
    at = np.zeros((len(sections), len(vocabulary) + 1), np.int32)  # the last column stands for -1
    at.ravel()[pair // len(vocabulary) * (len(vocabulary) + 1) + pair % len(vocabulary)] = np.arange(1, len(pair) + 1)
    figure = _bits((padded >= 0) & np.concatenate([marked, [False, False]])[padded])
    slots = None
    for bits in range(16, 23):
        shift = np.uint64(64 - bits)
        slot = vocabulary >> shift
        if len(np.unique(slot)) == len(vocabulary):
            slots = np.zeros(1 << bits, np.int16 if len(vocabulary) < 1 << 15 else np.int32)
            slots[slot] = np.arange(len(vocabulary))
            break
    spans = []
    for a in range(0, SECTION - 1, RUN):
        inside = np.zeros(SECTION, bool)
        inside[a : a + 2 * RUN] = True
        n = np.bitwise_count(figure & _bits(inside)).sum(1)
        if n.any():
            spans.append((_bits(inside), n))
    return Space(vocabulary, padded, np.asarray(ids), np.concatenate([marked, [False]]), at, np.ascontiguousarray((at > 0).T.astype(np.uint8)), _bits(places), figure, shift, slots, spans)


def _item_blocks(items: DataFrame) -> Iterator[Space]:
    """The items (item, text) in prepared blocks of bounded size."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // (2 * BLOCK_WORDS)))
    todo = [(parts, p) for p in range(parts)]
    while todo:
        parts, p = todo.pop()
        block = [(r.item, r.text) for r in items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == p).orderBy("item", "text").toLocalIterator()]
        space = _prepared(block)
        if space is None:
            continue
        if space.at.size > BLOCK_CELLS and len(block) > 1 and parts < 1 << 20:
            todo += [(2 * parts, p), (2 * parts, p + parts)]
        else:
            yield space


def _rows(code: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers in rows of RUN words (padded with -1) and the text of each row."""
    rows = -(-counts // RUN)
    first, start = np.cumsum(rows) - rows, np.cumsum(counts) - counts
    out = np.full(int(rows.sum()) * RUN, -1, code.dtype)
    out[np.arange(len(code)) + np.repeat(first * RUN - start, counts)] = code
    return out.reshape(-1, RUN), np.repeat(np.arange(len(counts)), rows)


def _tied(owner: np.ndarray) -> np.ndarray:
    """Row j stands for the passage of rows j and j + 1; False where row j + 1 belongs to another text."""
    return np.concatenate([owner[1:] == owner[:-1], [False]]) if len(owner) else np.empty(0, bool)


def _row_sums(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the table's vectors over the words of each row; the table's last vector, for -1, is zero."""
    out, one = np.zeros((len(rows), table.shape[1]), np.float32), np.empty((len(rows), table.shape[1]), np.float32)
    for p in range(RUN):
        out += np.take(table, rows[:, p], axis=0, out=one, mode="wrap")
    return out


def _sum_arrays(df: DataFrame, size: int) -> np.ndarray:
    """Sum of the float64 arrays in column body (each of ``size`` numbers), in two steps of bounded groups."""
    part = 1 << 16

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(len(pdf["body"].iloc[0]) // 8)
        for b in pdf["body"]:
            out += np.frombuffer(b)
        return pd.DataFrame({"chunk": [int(key[0])], "half": [0], "body": [out.tobytes()]})

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for salt, b in zip(pdf["salt"], pdf["body"]):
                for c in range(-(-size // part)):
                    yield pd.DataFrame({"chunk": [c], "half": [int(salt)], "body": [b[8 * part * c : 8 * part * (c + 1)]]})

    schema = "chunk int, half int, body binary"
    rows = df.mapInPandas(cut, schema).groupBy("chunk", "half").applyInPandas(add, schema).groupBy("chunk").applyInPandas(add, schema).collect()
    return np.concatenate([np.frombuffer(r.body) for r in sorted(rows, key=lambda r: r.chunk)]) if rows else np.zeros(size)


def _fit(space: Space, docs: DataFrame, seed: int = 3) -> None:
    """The latent space of all passages of ``docs`` (text) and of the items: words and the items' passages in it."""
    v, r = len(space.vocabulary), RANK + EXTRA
    rng = np.random.default_rng(seed)
    omega = np.vstack([rng.standard_normal((v, r)), np.zeros((1, r))]).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((space, omega))  # bounded by BLOCK_WORDS

    def sketch(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        sp, om = shared.value
        y, df, n = np.zeros((r, v)), np.zeros(v), 0
        for pdf in it:
            texts = pdf["text"].tolist()
            for a, b in W.batches(texts, STEP):
                h, counts = W.hashed(texts[a:b])
                rows, owner = _rows(sp.codes(h), counts)
                tied = _tied(owner)[:-1]
                z = _row_sums(om, rows)
                n += len(z)
                # a word of row j lies in passages j and j - 1: of them both, the words of rows j - 1 to j + 1
                u = z + z
                u[:-1][tied] += z[1:][tied]
                u[1:][tied] += z[:-1][tied]
                # the most frequent words by a product, the others by sums
                n_of = np.bincount(rows.ravel() + 1, minlength=v + 1)[1:]
                often = np.argsort(-n_of)[:OFTEN]
                rank = np.full(v + 1, -1, np.int32)
                rank[often] = np.arange(len(often))
                code = np.take(rank, rows.ravel(), mode="wrap")
                at = np.flatnonzero(code >= 0)
                tf = np.bincount(at // RUN * len(often) + code[at], minlength=len(rows) * len(often)).astype(np.float32)
                y[:, often] += u.T @ tf.reshape(len(rows), -1)
                at = np.flatnonzero((code < 0) & (rows.ravel() >= 0))
                code, line, u = rows.ravel()[at], at // RUN, np.ascontiguousarray(u.T)
                for d in range(r):
                    y[d] += np.bincount(code, u[d][line], minlength=v)
                rows.sort(axis=1)
                fresh = rows >= 0
                fresh[:, 1:] &= rows[:, 1:] != rows[:, :-1]
                df += np.bincount(rows[fresh], minlength=v)
        ctx = TaskContext.get()
        yield pd.DataFrame({"salt": [ctx.partitionId() % 256 if ctx else 0], "body": [np.concatenate([y.T.ravel(), df, [n]]).tobytes()]})

    got = _sum_arrays(docs.select("text").mapInPandas(sketch, "salt int, body binary"), v * r + v + 1)
    y, df, n = got[: v * r].reshape(v, r), got[v * r : -1], max(got[-1], 1.0)
    idf = np.log((2 * n + 1) / (2 * df + 1)) + 0.1  # a word of a row lies in two passages
    om = omega[:v].astype(np.float64)
    # the items' own passages, exactly; both collections weigh the same
    whole, owner, nth = [], [], []
    for k, x in enumerate(space.sections):
        size = int((x >= 0).sum())
        for a in range(0, max(size - RUN, 0) + 1, RUN):
            whole.append(np.concatenate([x[a : a + 2 * RUN], np.full(2 * RUN - len(x[a : a + 2 * RUN]), -2)]))
            owner.append(k)
            nth.append(a // RUN)
    whole, owner, nth = np.stack(whole), np.asarray(owner), np.asarray(nth)
    held = whole >= 0
    sums = lambda table: (table[np.maximum(whole, 0)] * held[..., None]).sum(1)
    own = np.zeros_like(y)
    np.add.at(own, whole[held], np.repeat(sums(om), held.sum(1), axis=0))
    y = y / n + own / len(whole)
    # Nystroem: Gram matrix of counts ~ y (om' y)^-1 y'; TF-IDF weights scale its rows
    c = om.T @ y
    w, q = np.linalg.eigh((c + c.T) / 2)
    keep = w > max(w.max(), 1e-12) * 1e-9
    u, _, _ = np.linalg.svd(idf[:, None] * (y @ (q[:, keep] / np.sqrt(w[keep]))), full_matrices=False)
    term = (u[:, :RANK] * idf[:, None]).astype(np.float32)
    z = sums(term)
    space.term = np.vstack([term, np.zeros((1, term.shape[1]), np.float32)])
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
    space.passage = np.zeros((nth.max() + 1, len(space.sections), z.shape[1]), np.float32)
    space.passage[nth, owner] = z


def _best(space: Space, z: np.ndarray, section: np.ndarray) -> np.ndarray:
    """The greatest cosine of each vector with a passage of its section."""
    return space.cosines(z)[np.arange(len(z)), section]


def _shifted(m: np.ndarray, k: int) -> np.ndarray:
    """Masks (..., 2) moved up by ``k`` < 64 places."""
    out = m << np.uint64(k)
    out[..., 1] |= m[..., 0] >> np.uint64(64 - k)
    return out


def _has_run(m: np.ndarray) -> np.ndarray:
    """Whether RUN successive words (axis 1 of the masks) stand in the section in succession."""
    have, width, reach, done = m, 1, None, 0
    for bit in range(RUN.bit_length()):  # runs of powers of two, put together to RUN
        if RUN >> bit & 1:
            reach, done = (have, width) if reach is None else _joined(reach, done, have, width)
        if RUN >> (bit + 1):
            have, width = _joined(have, width, have, width)
    return reach.any(axis=(1, 2))


def _joined(a: np.ndarray, n: int, b: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Runs of n + k words, at their last word, from runs of n words followed by runs of k; position p of an array of runs of n is word p + n - 1."""
    size = a.shape[1] - k
    return _shifted(a[:, :size], k) & b[:, n : n + size], n + k


def _lcs(m: np.ndarray) -> np.ndarray:
    """Greatest number of the words (axis 1 of the masks) that stand in the section in order."""
    v0, v1 = np.full(len(m), ~np.uint64(0)), np.full(len(m), ~np.uint64(0))
    for p in range(m.shape[1]):
        u0, u1 = v0 & m[:, p, 0], v1 & m[:, p, 1]
        s0 = v0 + u0
        v0, v1 = s0 | (v0 ^ u0), (v1 + u1 + (s0 < u0)) | (v1 ^ u1)
    return (np.bitwise_count(~v0) + np.bitwise_count(~v1)).astype(np.int32)


def _longest_run(m: np.ndarray) -> np.ndarray:
    out, reach = np.zeros(len(m), np.int32), np.ones(len(m), bool)
    have, width = m, 1
    while reach.any():
        out = np.where(reach, width, out)
        if m.shape[1] <= width:
            break
        have, width = _joined(have, width, m, 1)
        reach = have.any(axis=(1, 2))
    return np.where(m.any(axis=(1, 2)), out, 0)


def _figures(space: Space, k: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Greatest share of the figures of a passage of section ``k`` at the places ``hit``; 1 for sections without figures."""
    out = np.where(space.figures[k].any(1), 0.0, 1.0)
    for span, n in space.spans:
        got = np.bitwise_count(hit & space.figures[k] & span).sum(1)
        out = np.maximum(out, np.where(n[k] > 0, got / np.maximum(n[k], 1), 0.0))
    return out


def _checked(space: Space, rows: np.ndarray, owner: np.ndarray, i: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which pairs (of ``_alike``) of passage ``i`` and section ``k`` meet a check, and their longest run, subsequence and share of figures.

    Runs are looked for in the passage; rewordings in all windows of two rows
    that begin at any word from the row before to the row after it.
    """
    after = np.minimum(i + 1, len(rows) - 1)
    code = np.concatenate([rows[i], np.where((owner[after] == owner[i])[:, None] & (after > i)[:, None], rows[after], -1)], axis=1)
    m = space.masks[space.at[k[:, None], code]]
    run = _has_run(m)
    some = run | (_lcs(m) >= PART)
    enough = np.flatnonzero(some)
    run, i, k = run[some], i[some], k[some]
    beside = i[:, None] + np.arange(-1, 3)
    inside = (beside >= 0) & (beside < len(rows))
    beside = np.clip(beside, 0, len(rows) - 1)
    inside &= owner[beside] == owner[i][:, None]
    at = space.at[k[:, None], np.where(inside[:, :, None], rows[beside], -1).reshape(len(i), 4 * RUN)]
    met = np.zeros((len(i), 4 * RUN + 1), np.int32)
    np.cumsum(at > 0, axis=1, out=met[:, 1:])
    met = met[:, 2 * RUN :] - met[:, : 2 * RUN + 1]  # words of each window that the section has
    some = run | (met.max(1, initial=0) >= ORDERED)
    enough, run, k, at, met = enough[some], run[some], k[some], at[some], met[some]
    m = space.masks[at]
    some = run | ((_figures(space, k, np.bitwise_or.reduce(m, axis=1)) >= 0.5) & (_lcs(m) >= ORDERED))
    enough, run, k, m, met = enough[some], run[some], k[some], m[some], met[some]
    lcs, share = np.zeros(len(k), np.int32), np.zeros(len(k))
    pair, begin = np.nonzero(met >= np.where(run, 1, ORDERED)[:, None])
    for a in range(0, len(pair), 4 * PAIRS):
        x = pair[a : a + 4 * PAIRS]
        window = m[x[:, None], begin[a : a + 4 * PAIRS, None] + np.arange(2 * RUN)]
        got = _lcs(window)
        np.maximum.at(lcs, x, got)
        told = np.flatnonzero(got >= ORDERED)
        np.maximum.at(share, x[told], _figures(space, k[x[told]], np.bitwise_or.reduce(window[told], axis=1)))
    keep = np.flatnonzero(run | ((lcs >= ORDERED) & (share >= 0.5)))
    return enough[keep], _longest_run(m[keep][:, RUN : 3 * RUN]), lcs[keep], share[keep]


def _possible(space: Space, rows: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The passages that could meet a check: no gap in the items' words for a run, or ORDERED of two rows of them with a figure beside it, and PART in it."""
    known = rows >= 0
    tied = _tied(owner)
    per_row = known.sum(1)
    both = per_row.copy()
    both[:-1][tied[:-1]] += per_row[1:][tied[:-1]]
    # windows may reach into the next text, which only adds passages
    size = rows.size
    starts = np.arange(size)
    one, two = np.minimum(starts + RUN, size), np.minimum(starts + 2 * RUN, size)
    total = np.zeros(size + 1, np.int32)
    np.cumsum(known.ravel(), out=total[1:])
    run = total[one] - total[:-1] >= RUN
    told = total[two] - total[:-1] >= ORDERED
    if space.figures.any(1).all():
        np.cumsum(np.take(space.digits, rows.ravel(), mode="wrap"), out=total[1:])
        told &= total[two] > total[:-1]
    run, told = run.reshape(-1, RUN).any(1), told.reshape(-1, RUN).any(1)
    beside = told.copy()
    beside[:-1] |= told[1:]
    beside[1:] |= told[:-1]
    return np.flatnonzero((both >= PART) & (run | beside))


def _alike(space: Space, rows: np.ndarray, owner: np.ndarray, passages: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of a passage and a section that have the words in common that a check needs.

    A run needs RUN of the passage's words in the section. A rewording needs PART of them, and ORDERED in
    three rows: two rows that begin anywhere from the row before to the row after lie in three.
    """
    size = max(COUNTED // space.held.shape[1], 16)
    for c in range(0, len(passages), size):
        p = passages[c : c + size]
        beside = p[:, None] + np.arange(-1, 3)
        inside = (beside >= 0) & (beside < len(rows))
        inside &= owner[np.clip(beside, 0, len(rows) - 1)] == owner[p][:, None]
        need, at = np.unique(np.clip(beside, 0, len(rows) - 1), return_inverse=True)
        have = np.zeros((len(need) + 1, space.held.shape[1]), np.uint8)  # words of each row that each section has; the last for none
        for q in range(RUN):
            have[:-1] += np.take(space.held, rows[need, q], axis=0, mode="wrap")
        before, own, after, last = np.where(inside, at.reshape(beside.shape), len(need)).T
        both = have[own] + have[after]
        i, k = np.nonzero(both >= PART)
        both = both[i, k]
        reach = both + np.maximum(have[before[i], k], have[last[i], k])
        some = (both >= RUN) | (reach >= ORDERED)
        yield p[i[some]], k[some]


def leaked_passages(corpus: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The (document, item) pairs that share a passage: the best cosine and the checks on words.

    Columns: doc_id, item_id, cosine, longest_run (successive common words of a
    passage of 26 words), lcs (greatest number of common words in order within
    26 words), figures (greatest share of the figures of 26 item words found
    there; 1 for an item without figures) and kind: ``verbatim`` (run of at
    least 13) or ``paraphrase`` (no such run, but 18 words in order and half of
    the figures).

    Defined results: null, empty texts and items under 13 words match nothing
    verbatim; equal rows count once; an item id given with several texts stands
    for each of them; words are maximal runs of letters or digits in lower case;
    an empty table yields no row; other columns are ignored. Documents and
    items are read whole, however long.
    """
    spark = corpus.sparkSession
    docs = corpus.filter(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    q = items.filter(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).distinct()
    kind_d, kind_i = corpus.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"{doc_id} {kind_d}, {item_id} {kind_i}, cosine double, longest_run int, lcs int, figures double"
    out = None
    for space in _item_blocks(q):
        _fit(space, docs)
        shared = spark.sparkContext.broadcast(space)  # bounded by BLOCK_WORDS and BLOCK_CELLS

        def search(it: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            sp = shared.value
            for pdf in it:
                texts, keys = pdf["text"].tolist(), pdf["doc"].to_numpy()
                for a, b in W.batches(texts, STEP):
                    h, counts = W.hashed(texts[a:b])
                    rows, owner = _rows(sp.codes(h), counts)
                    for i, k in _alike(sp, rows, owner, _possible(sp, rows, owner)):
                        for d in range(0, len(i), PAIRS):
                            met, run, lcs, share = _checked(sp, rows, owner, i[d : d + PAIRS], k[d : d + PAIRS])
                            if len(met):
                                x, y = i[d : d + PAIRS][met], k[d : d + PAIRS][met]
                                after = np.minimum(x + 1, len(rows) - 1)
                                z = _row_sums(sp.term, rows[x]) + _row_sums(sp.term, rows[after]) * ((owner[after] == owner[x]) & (after > x))[:, None]
                                yield pd.DataFrame({doc_id: keys[a + owner[x]], item_id: sp.ids[y], "cosine": _best(sp, z, y).astype(float), "longest_run": run, "lcs": lcs, "figures": share})

        got = docs.mapInPandas(search, schema)
        out = got if out is None else out.unionByName(got)
    if out is None:
        return spark.createDataFrame([], schema + ", kind string")
    best = out.groupBy(doc_id, item_id).agg(F.max("cosine").alias("cosine"), F.max("longest_run").alias("longest_run"), F.max("lcs").alias("lcs"), F.max("figures").alias("figures"))
    return best.withColumn("kind", F.when(F.col("longest_run") >= RUN, "verbatim").otherwise("paraphrase"))


def leaked_items(corpus: DataFrame, items: DataFrame) -> DataFrame:
    """Per item that leaks verbatim or as a paraphrase: documents concerned and its longest run."""
    found = leaked_passages(corpus, items)
    return found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.sum((F.col("kind") == "verbatim").cast("int")).alias("n_verbatim"), F.max("longest_run").alias("longest_run"))
