"""Splitting oversized items at natural boundaries (problem 9).

Every token boundary of a text has a strength (paragraph, line, sentence,
clause, word, inside a word). A sparse table over the strengths answers "where
is the strongest boundary of this window" in constant time; ties go to the
right, so pieces are as long as their best boundary allows. The next piece
steps back by the overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexgrid.llm import tokens

PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, INSIDE, BROKEN = 6, 5, 4, 3, 2, 1, 0


def strengths(data: bytes, ends: np.ndarray) -> np.ndarray:
    """The strength of the boundary after each token; BROKEN inside a character."""
    if not len(ends):
        return np.empty(0, np.int8)
    b = np.frombuffer(data + b"\n\n\n", np.uint8)
    pad = np.concatenate([np.zeros(3, np.uint8), b])  # pad[e + 3 + i] is byte e + i
    at = lambda i: pad[ends + 3 + i]
    nxt, prv = at(0), at(-1)
    one = lambda x, chars: np.isin(x, np.frombuffer(chars, np.uint8))
    blank = one(nxt, b" \t\n\r")
    s = np.full(len(ends), INSIDE, np.int8)
    s[blank | one(prv, b" \t")] = WORD
    wide = at(-3).astype(np.int64) << 16 | at(-2).astype(np.int64) << 8 | prv
    s[(one(prv, b";:,") & blank) | np.isin(wide, (0xE38081, 0xEFBC9B, 0xEFBC9A, 0xEFBC8C))] = CLAUSE
    after = at(1)
    starts = one(after, b"\"'(\n\r") | ((after >= 65) & (after <= 90)) | (after >= 0xC0)
    s[(one(prv, b".?!") & blank & starts) | np.isin(wide, (0xE38082, 0xEFBC8E, 0xEFBC81, 0xEFBC9F))] = SENTENCE
    s[(prv == 10) & (nxt != 10)] = LINE
    s[(prv == 10) & (nxt != 10) & (at(-2) == 10)] = PARAGRAPH
    s[(nxt & 0xC0) == 0x80] = BROKEN
    return s


class Strongest:
    """Sparse table: the rightmost position of the greatest value of any range."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        # value first, then position: the maximum of a range is its strongest, rightmost boundary
        row = values.astype(np.int64) * (n + 1) + np.arange(n)
        self.n, self.rows, step = n, [row], 1
        while 2 * step <= n:
            row = np.maximum(row[:-step], row[step:])
            self.rows.append(row)
            step *= 2

    def query(self, a: int, b: int) -> int:
        """Of a..b, both included."""
        k = (b - a + 1).bit_length() - 1
        row = self.rows[k]
        return int(max(row[a], row[b - (1 << k) + 1]) % (self.n + 1))


def cuts(s: np.ndarray, limit: int, overlap: int, least: int) -> list[tuple[int, int]]:
    """Token ranges [start, end) of the pieces."""
    n = len(s)
    if n <= limit:
        return [(0, n)] if n else []
    table, out, start = Strongest(s), [], 0
    while n - start > limit:
        low = start + max(least, overlap + 1)
        end = table.query(low - 1, start + limit - 1) + 1
        out.append((start, end))
        back = end - overlap
        while back > start + 1 and s[back - 1] == BROKEN:  # a piece begins with a whole character
            back -= 1
        start = back
    out.append((start, n))
    return out


def split_oversized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 1500, overlap: int = 100, least: int | None = None, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """The pieces of each text of more than ``limit`` tokens.

    Columns: the id, piece_no (from 1), n_pieces, start_token, end_token
    (exclusive), n_tokens, strength (of the boundary at its end) and piece. A
    piece has at most ``limit`` tokens of the whole text's tokenization, at
    least ``least`` (default limit // 2) but for the last, ends at the strongest
    boundary of that window, the rightmost of equals, and begins ``overlap``
    tokens before the end of the one before (up to three more where that would
    divide a character). Pieces joined without their overlaps are the text.

    Rows are independent: no shuffle, one pass. Texts of at most ``limit`` bytes
    can't have more tokens and are never tokenized. Defined results: null and
    empty texts have no pieces; equal rows give equal pieces each; other columns
    are ignored.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("overlap must be under half the limit")
    low = limit // 2 if least is None else least

    def split(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for key, text in zip(pdf["id"], pdf["text"]):
                ends = tokens.ends(text, vocabulary)
                if len(ends) <= limit:
                    continue
                data = text.encode("utf-8")
                s = strengths(data, ends)
                ranges = cuts(s, limit, overlap, low)
                for k, (a, b) in enumerate(ranges, 1):
                    piece = data[ends[a - 1] if a else 0 : ends[b - 1]].decode("utf-8")
                    out.append((key, k, len(ranges), a, b, b - a, int(s[b - 1]), piece))
            yield pd.DataFrame(out, columns=["id", "piece_no", "n_pieces", "start_token", "end_token", "n_tokens", "strength", "piece"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece_no int, n_pieces int, start_token long, end_token long, n_tokens long, strength int, piece string"
    big = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.octet_length("text") > limit)
    return big.mapInPandas(split, schema).withColumnRenamed("id", id_col)
