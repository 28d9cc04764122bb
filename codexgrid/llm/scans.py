"""Noise in text from scanned pages (problem 1): finding and repairing it.

Line-pair classifiers (boosted trees) tell page furniture from text, page numbers
from headers and from titles that end in a number, and decide how two lines
join. Word forms and the shapes of numbers are counted over the whole
collection; an inverted join over character q-grams (with their place and the
form's length) retrieves, for every rare form, the frequent forms that resemble
it, and boosted trees rank them as replacements. The classifiers are fitted on damage made from at most ``TRAIN_ROWS`` rows and
``TRAIN_FORMS`` frequent forms of the collection itself; counts, candidates and
replacements cover all rows. Only the ``COMMON`` most frequent sound forms are
broadcast; all other forms meet their replacements in a join.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexgrid.llm.boosting import Boosted
from codexgrid.llm.sampling import bounded
from codexgrid.plans.materialize import written

TRAIN_ROWS = 800
TRAIN_FORMS = 1500
COMMON = 200_000  # forms broadcast, at most
RATIO = 20  # a replacement is so many times as frequent as the form
RATIO_FIGURES = 500  # the same for forms of figures, whose shapes are few
RATIO_NUMBERS = 3  # and of numbers of headings, which have no letters
FREQUENT = 5  # and occurs at least so often

#: Shapes that recognition confuses (fixed values): what is printed, what is read.
CONFUSED = (
    ("o", "0"), ("l", "1"), ("i", "1"), ("l", "i"), ("s", "5"), ("g", "9"), ("b", "6"), ("b", "8"), ("z", "2"), ("q", "9"), ("t", "+"), ("a", "@"), ("e", "c"), ("h", "b"),
    ("i", "l"), ("rn", "m"), ("m", "rn"), ("u", "ii"), ("n", "ri"), ("w", "vv"), ("d", "cl"), ("cl", "d"), ("h", "li"), ("l", "|"), ("i", "!"), ("i", "j"), ("f", "t"), ("c", "e"), ("o", "c"), ("n", "u"), ("u", "n"), ("s", "$"), ("e", "€"), ("a", "o"), ("v", "y"),
    ("9", "s"), ("9", "b"), ("9", "z"), ("9", "l"), ("9", "i"), ("9", "o"), ("9", "|"), ("0", "o"), ("1", "l"), ("1", "i"), ("2", "z"), ("5", "s"), ("8", "b"), ("6", "b"), ("9", "q"),
)
#: Only these may be assumed where both sides are plain letters.
_RARE = {("f", "t"), ("c", "e"), ("o", "c"), ("n", "u"), ("u", "n"), ("a", "o"), ("v", "y"), ("i", "j")}
_HYPHEN = "-‐‑­¬"
_BREAK = re.compile(rf"([A-Za-z0-9@+|]+)[{_HYPHEN}][ \t]*\n[ \t]*(?=[A-Za-z0-9@+|])")
_ENDS_BROKEN = re.compile(rf"[A-Za-z0-9@+|][{_HYPHEN}][ \t]*$")
_END = re.compile(r"^(.*?)([\s.…·_]*)((?:\b(?:p\.?|page)\s*)?)(\d{1,4})\s*$", re.I | re.S)
_PAGE = re.compile(r"^\W*(?:(?:page|p\.|pg\.?|seite)\s*)?\d{1,4}(?:\s*(?:/|of|von|-)\s*\d{1,4})?\W*$", re.I)
_HEAD_WORDS = re.compile(r"\b(?:ece|regulation|annex|appendix|rev|add|amend|consolidated|trans|page|suppl(?:ement)?|corr)\b", re.I)
_STRIP = "-‐‑­¬\"'“”‘’()[]{}.,;:!?、。–—…«»"


def form(token: str) -> str:
    """The counted form of a token: lower case, outer punctuation off, digits as 9 unless the token is mostly letters; '' for none."""
    t = token.strip(_STRIP).lower()
    if not t:
        return ""
    letters = sum(c.isalpha() for c in t)
    digits = sum(c.isdigit() for c in t)
    if not letters + digits:
        return ""
    if digits and (letters < 2 or letters < digits):
        t = re.sub(r"\d", "9", t)
    return t


def number_form(number: str) -> str:
    """The counted form of a heading's number: its shape behind a mark of its own; '' for none."""
    t = re.sub(r"\d", "9", number.strip().strip(".").lower())
    return "#" + t if t else ""


_TOKEN = re.compile(r"[^\s\-–—]+")


def _token_lists(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lists = [_TOKEN.findall(t) for t in texts]
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.empty(int(n.sum()), object)
    flat[:] = [w for x in lists for w in x]
    return flat, np.repeat(np.arange(len(lists)), n)


# lines ---------------------------------------------------------------------------------------------------------------


def _line_features(before: str, line: str, after: str, longest: int) -> list[float]:
    t = line.strip()
    n = max(len(t), 1)
    words = t.split()
    prev, nxt = before.rstrip(), after.strip()
    return [
        len(t), len(t) / max(longest, 1), len(words), sum(c.isdigit() for c in t) / n, float(bool(_PAGE.match(t))), len(_HEAD_WORDS.findall(t)), float(bool(re.search(r"\b[A-Z]/?[A-Z]{2,}/|\bE?C?E/", t))),
        float(bool(re.match(r"(?:UN )?regulation no\W|annex \d+\W*(?:$|- )|r\d+ / |e?/?ece/", t, re.I))), float(t[:1].isupper()), float(t[:1].islower()), float(t.endswith((".", ";", ":", ","))), len(line) - len(line.lstrip()),
        float(bool(prev) and not prev.endswith((".", ":", ";"))), float(nxt[:1].islower() or nxt[:1].isdigit()), float(bool(re.search(r"\b(?:and|of|the|to|shall|in|by|with|for|or|a)$", t))),
        float(bool(re.match(r"^(?:UN )?regulation no\.? ?\d+\W*(?:$|\s{2,}|annex)", t, re.I))), float(bool(re.search(r"\b(?:and|thereof|paragraph|shall|the)\b", t))), float(not prev), float(not nxt), float(bool(_ENDS_BROKEN.search(prev))),
    ]


def _pair_features(head: str, tail: str, mark: str, common: dict) -> list[float]:
    """How a line-final part before a hyphen-like mark and the next line's first word belong together."""
    a, b = head.lower(), tail.lower()
    joined, compound = form(a + b), f"{a}-{b}"
    return [
        float(joined in common), float(form(a) in common), float(form(b) in common), float(compound in common), len(a), len(b), float(mark == "-"), float(tail[:1].isupper()), float(tail[:1].islower()),
        float(a.isalpha()), float(b.isalpha()), np.log1p(common.get(joined, 0)), np.log1p(common.get(compound, 0)),
    ]


def _end_features(title: str) -> list[float] | None:
    """How a title ends in a number of up to four digits; None if it doesn't."""
    m = _END.match(title)
    if m is None:
        return None
    head, gap, word, number = m.groups()
    dots = sum(c in ".…·_" for c in gap)
    last = head.split()[-1] if head.split() else ""
    return [
        float(len(gap)), float(dots), float("…" in gap), float("\t" in gap), float(gap.count(" ")), float(bool(word)), float(len(number)), float(int(number)), float(len(head)), float(len(last)), float(last[-1:].isalpha()), float(last[-1:].isdigit()),
        float(last[:1].isupper()), float(len(_HEAD_WORDS.findall(last))), float(len(head.split())), float(last[-1:] in ")]"), float(bool(re.search(r"\s[.…]\s*$", gap))),
    ]


class Lines:
    """The fitted line classifiers: furniture or text, page number or header, joined or not, and page numbers that end titles."""

    def __init__(self, furniture: Boosted | None, kind: Boosted | None, pair: Boosted | None, ending: Boosted | None) -> None:
        self.furniture, self.kind, self.pair, self.ending = furniture, kind, pair, ending

    def paged(self, titles: list[str | None]) -> list[bool]:
        """Which titles end in a page number."""
        out, at, rows = [False] * len(titles), [], []
        for i, t in enumerate(titles):
            if t and t.rstrip()[-1:].isdigit() and (x := _end_features(t)) is not None:
                at.append(i)
                rows.append(x)
        if rows and self.ending is not None:
            for i, p in zip(at, self.ending.predict(np.asarray(rows))):
                out[i] = p > 0.5
        return out

    def read(self, texts: list[str], common: dict) -> list[tuple[str, set[str]]]:
        """Each text as one continuous string and the kinds of noise its lines show; all lines are classified at once."""
        kinds: list[set[str]] = [set() for _ in texts]
        filled = [[x for x in t.split("\n") if x.strip()] if "\n" in t else None for t in texts]
        rows, at = [], []
        for i, (t, lines) in enumerate(zip(texts, filled)):
            if lines is not None and len(lines) > 1:
                longest = max(map(len, t.split("\n")))
                at += [(i, k) for k in range(len(lines))]
                rows += [_line_features(lines[k - 1] if k else "", s, lines[k + 1] if k + 1 < len(lines) else "", longest) for k, s in enumerate(lines)]
        furniture: dict[int, dict[int, str]] = {}
        if rows and self.furniture is not None:
            hit = np.flatnonzero(self.furniture.predict(np.asarray(rows)) > 0.5)
            paged = self.kind.predict(np.asarray(rows)[hit]) > 0.5 if len(hit) and self.kind is not None else np.zeros(len(hit), bool)
            for x, page in zip(hit, paged):
                i, k = at[x]
                furniture.setdefault(i, {})[k] = "page_number" if page else "running_header"
        joints, pair_rows = {}, []
        for i, lines in enumerate(filled):
            if lines is None:
                continue
            drop = furniture.get(i, {})
            if len(drop) == len(lines):
                drop = {}
            kinds[i].update(drop.values())
            kept = filled[i] = [s.strip() for k, s in enumerate(lines) if k not in drop]
            for k in range(len(kept) - 1):
                m, n = _DIVIDED.search(kept[k]), _BEGINS.match(kept[k + 1])
                if m and n:
                    joints[i, k] = (m.group(1), n.group(), m.group(2))
                    pair_rows.append(_pair_features(m.group(1), n.group(), m.group(2), common))
        broken = dict(zip(joints, self.pair.predict(np.asarray(pair_rows)) > 0.5)) if pair_rows and self.pair is not None else {}
        out = []
        for i, (t, lines) in enumerate(zip(texts, filled)):
            if lines is None:
                out.append((t, kinds[i]))
                continue
            joined = lines[0] if lines else ""
            for k, s in enumerate(lines[1:]):
                if (i, k) not in broken:
                    joined += " " + s
                elif broken[i, k]:
                    head, tail, mark = joints[i, k]
                    kinds[i].add("hyphen_break")
                    own = form(head + tail) not in common and f"{head}-{tail}".lower() in common
                    joined = joined[: -len(mark)] + ("-" if own else "") + s
                else:
                    joined += s
            out.append((joined, kinds[i]))
        return out


_DIVIDED = re.compile(rf"([A-Za-z0-9@+|]+)([{_HYPHEN}])$")
_BEGINS = re.compile(r"[A-Za-z0-9@+|]+")


#: From these furniture is made for the fit; # stands for a number.
_HEADERS = (
    "E/ECE/#/Rev.#", "ECE/TR/#/Add.#", "UN Regulation No. #", "Regulation No. #", "REGULATION No. #   Annex #", "Annex #", "Annex # - Appendix #", "R# / Rev.# — consolidated text", "E/ECE/#  Regulation No. #", "ECE/TRANS/#", "Appendix #",
)
_PAGES = ("#", "- # -", "– # –", "[#]", "#/#", "Page # of #", "page #", "                #", "p. #")


def _fit_ends(titles: list[str], number, pick, rng) -> tuple[list, list]:
    """Titles with page numbers made behind leaders, and titles that end in a number of their own."""
    x, y = [], []
    for title in titles:
        head = title.rstrip()
        if not head or head[-1].isdigit():
            if (own := _end_features(head)) is not None and own[1] < 2 and not own[5]:  # a number without leader is the title's
                x.append(own)
                y.append(0)
            continue
        dots = int(rng.integers(2, 40))
        for gap in (f" {'.' * dots} ", "." * dots, f" {'…' * int(rng.integers(1, 8))} ", " ." * dots + " ", "\t", f" {'·' * dots} ", " p. ", " page ", f" {'_' * dots} ", " … "):
            if rng.random() < 0.5 and (made := _end_features(number(head + gap + "#"))) is not None:
                x.append(made)
                y.append(1)
        words = head.split()
        for word in (pick(("Annex", "Appendix", "Class", "Type", "Part", "No.", "Category", "Table", "Figure", "paragraph", "Group", "Stage")), words[-1]):
            made = _end_features(f"{' '.join(words[: int(rng.integers(0, len(words) + 1))])} {word} {int(10 ** rng.uniform(0, 2.5))}".strip())
            if made is not None:
                x.append(made)
                y.append(0)
    return x, y


def _fit_lines(texts: list[str], titles: list[str], common: dict, seed: int = 4) -> Lines:
    rng = np.random.default_rng(seed)
    number = lambda s: re.sub("#", lambda _: str(int(10 ** rng.uniform(0, 3.3))), s)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    fx, fy, kx, ky, px, py = [], [], [], [], [], []
    for text in texts:
        words = text.split()
        if len(words) < 12:
            continue
        width, ragged = int(rng.integers(50, 90)), rng.random() < 0.3
        lines, line = [], ""
        for w in words:
            if ragged and not line:
                width = int(rng.integers(15, 90))
            if line and len(line) + len(w) + 1 > width:
                lines.append((line, 0))
                line = w
            else:
                line = f"{line} {w}" if line else w
        lines.append((line, 0))
        for made, make in enumerate((_HEADERS, _PAGES), 1):
            if len(lines) > 1 and rng.random() < 0.8:
                lines.insert(int(rng.integers(0, len(lines) + 1)), (number(pick(make)), made))
        longest = max(len(s) for s, _ in lines)
        for k, (s, y) in enumerate(lines):
            fx.append(_line_features(lines[k - 1][0] if k else "", s, lines[k + 1][0] if k + 1 < len(lines) else "", longest))
            fy.append(y > 0)
            if y:
                kx.append(fx[-1])
                ky.append(y == 2)
        for w in [w for w in words if w.isalpha() and len(w) >= 5][:6]:
            k = int(rng.integers(2, len(w) - 1))
            px.append(_pair_features(w[:k], w[k:], pick(_HYPHEN) if rng.random() < 0.5 else "-", common))
            py.append(1)
        for w in [w for w in words if re.fullmatch(r"[A-Za-z]+-[A-Za-z]+", w)][:6]:
            a, b = w.split("-")
            for mark, y in (("-", 0), (pick(_HYPHEN[1:]), 1)):  # lines also end after a word's own hyphen, but only with that mark
                px.append(_pair_features(a, b, mark, common))
                py.append(y)
    fit = lambda x, y: Boosted().fit(np.asarray(x, float), np.asarray(y, float)) if len(set(y)) == 2 else None
    pair = fit(px, py)
    if pair is None and px:
        pair = Boosted(rounds=0).fit(np.asarray(px, float), np.ones(len(px)))
    return Lines(fit(fx, fy), fit(kx, ky), pair, fit(*_fit_ends(titles, number, pick, rng)))


# words ---------------------------------------------------------------------------------------------------------------


def _costs(read: str, printed: str) -> tuple[float, int, int]:
    """(cost of the cheapest edit, confusions, other edits) that turn the printed form into the read one."""
    n, m = len(printed), len(read)
    best = {(0, 0): (0.0, 0, 0)}
    for i in range(n + 1):
        for j in range(m + 1):
            if (i, j) == (0, 0):
                continue
            options = []
            if i and j and (b := best.get((i - 1, j - 1))) is not None:
                same = printed[i - 1] == read[j - 1]
                options.append((b[0] + (0 if same else 1.0), b[1], b[2] + (not same)))
            for p, r in _BY_END.get(read[j - 1 : j], ()):
                if printed[max(i - len(p), 0) : i] == p and read[max(j - len(r), 0) : j] == r and (b := best.get((i - len(p), j - len(r)))) is not None:
                    options.append((b[0] + (0.35 if (p, r) in _RARE else 0.2), b[1] + 1, b[2]))
            if i and (b := best.get((i - 1, j))) is not None:
                options.append((b[0] + 1.0, b[1], b[2] + 1))
            if j and (b := best.get((i, j - 1))) is not None:
                options.append((b[0] + 1.0, b[1], b[2] + 1))
            if options:
                best[i, j] = min(options)
    return best[n, m]


_BY_END: dict[str, list[tuple[str, str]]] = {}
for _p, _r in CONFUSED:
    _BY_END.setdefault(_r[-1], []).append((_p, _r))


def _rank_features(read: str, printed: str, n_read: float, n_printed: float) -> list[float]:
    cost, confused, other = _costs(read, printed)
    odd = sum(not c.isalpha() for c in read)
    return [
        cost, confused, other, len(read), len(printed), len(read) - len(printed), float(printed.startswith(read)), float(read.startswith(printed)), float(odd > 0), odd - sum(not c.isalpha() for c in printed),
        np.log1p(n_printed) - np.log1p(n_read), np.log1p(n_printed), float(read[:1] == printed[:1]), float(read[-1:] == printed[-1:]), cost / max(len(read), 1),
    ]


def _fit_ranker(forms: list[tuple[str, int]], seed: int = 6) -> Boosted | None:
    """Positives: frequent forms with a confusion or two; negatives: cuts, additions, other edits and other forms."""
    rng = np.random.default_rng(seed)
    known = {f for f, _ in forms}
    x, y = [], []
    letters = "abcdefghijklmnopqrstuvwxyz"
    by_size: dict[int, list[tuple[str, int]]] = {}
    for f, n in forms:
        by_size.setdefault(len(f), []).append((f, n))
    for f, n in forms:
        few = max(1.0, n / RATIO * rng.random() ** 3)
        ways = [(p, r) for p, r in CONFUSED if p in f and ((p, r) not in _RARE or rng.random() < 0.15)]
        for _ in range(2):
            if ways:
                g = f
                for _ in range(1 if rng.random() < 0.8 else 2):
                    p, r = ways[int(rng.integers(len(ways)))]
                    at = [m.start() for m in re.finditer(re.escape(p), g)]
                    if at:
                        k = at[int(rng.integers(len(at)))]
                        g = g[:k] + r + g[k + len(p) :]
                if g not in known:
                    x.append(_rank_features(g, f, few, n))
                    y.append(1)
        k = int(rng.integers(1, len(f))) if len(f) > 1 else 1
        c = letters[int(rng.integers(26))]
        for g in (f[:k], f[k:], f[:-1], f + c, f[:k] + c + f[k:], f[:k] + f[k + 1 :], f[:k] + c + f[k + 1 :], f + "s", f + f[-2:]):
            if g and g != f and (g in known or _costs(g, f)[2]):
                x.append(_rank_features(g, f, few, n))
                y.append(0)
        near = by_size[len(f)]
        other, m = near[int(rng.integers(len(near)))]
        if other != f:
            x.append(_rank_features(other, f, few, n))
            y.append(0)
    return Boosted(rounds=80).fit(np.asarray(x, float), np.asarray(y, float)) if len(set(y)) == 2 else None


def _grams(c: str) -> str:
    """SQL: the padded bigrams of column ``c`` with their place, for the inverted join."""
    return f"transform(sequence(1, length({c}) + 1), i -> struct(substring(concat('^', {c}, '$'), i, 2) as g, i as at))"


def _replacements(counts: DataFrame, ranker: Boosted | None) -> DataFrame:
    """(form, replacement, score) for the forms that a frequent form explains as misread."""
    spark = counts.sparkSession
    schema = "form string, replacement string, score double"
    if ranker is None:
        return spark.createDataFrame([], schema)
    usual = counts.filter((F.col("n") >= FREQUENT) & (F.length("form") >= 2) & (F.col("form").rlike("^[a-z]+$") | F.col("form").rlike(r"^#?9+(?:\.9+)*$")))
    top = usual.agg(F.max("n")).first()[0] or 0
    times = lambda c: F.when(c.startswith("#"), RATIO_NUMBERS).when(c.startswith("9"), RATIO_FIGURES).otherwise(RATIO)
    # a shape of figures alone is a sound number, however rare
    rare = counts.filter((F.col("n") * times(F.col("form")) <= F.lit(top)) & (F.length("form") >= 2) & ~F.col("form").rlike(r"^#?9+(?:\.9+)*$"))
    # bigram, place and length are the key; the frequent forms, far fewer, are put at all places and lengths that a rare form may have
    a = rare.select("form", "n", F.length("form").alias("len"), F.explode(F.expr(_grams("form"))).alias("x")).select("form", "n", "len", "x.g", "x.at")
    b = usual.select(F.col("form").alias("cand"), F.col("n").alias("nc"), F.explode(F.expr(_grams("form"))).alias("x"), F.expr("sequence(greatest(length(form) - 2, 2), length(form) + 2)").alias("lens"))
    b = b.select("cand", "nc", "x.g", F.explode(F.expr("sequence(x.at - 1, x.at + 1)")).alias("at"), "lens").select("cand", "nc", "g", "at", F.explode("lens").alias("len"))
    met = a.join(b, ["g", "at", "len"]).filter((F.col("n") * times(F.col("cand")) <= F.col("nc")) & (F.col("form") != F.col("cand")) & (F.col("form").startswith("#") == F.col("cand").startswith("#")))
    shared = met.groupBy("form", "cand", "n", "nc").agg(F.countDistinct("g").alias("k"))
    # a confusion touches two bigrams (three where one character becomes two); forms of up to four characters may keep one only
    close = shared.filter(F.col("k") >= F.greatest(F.lit(1), F.floor((F.length("form") + 1) * 0.45)))
    held = spark.sparkContext.broadcast(ranker)  # some dozen trees

    def rank(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if not len(pdf):
                continue
            x = [_rank_features(r.form, r.cand, r.n, r.nc) for r in pdf.itertuples(index=False)]
            x = np.asarray(x, float)
            score = held.value.predict(x)
            keep = score > 0.5
            yield pd.DataFrame({"form": pdf["form"][keep], "replacement": pdf["cand"][keep], "score": score[keep], "nc": pdf["nc"][keep]})

    ranked = close.mapInPandas(rank, schema + ", nc long")
    return ranked.groupBy("form").agg(F.max_by("replacement", F.struct("score", "nc", "replacement")).alias("replacement"), F.max("score").alias("score"))


def _counts(rows: DataFrame) -> DataFrame:
    """How often each form occurs in numbers, titles and texts; parts of words divided at line ends are not counted."""

    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for pdf in it:
            total.update(f for x in pdf["number"] if x and (f := number_form(x)))
            texts = [_BREAK.sub(" ", t) if "\n" in t else t for t in pdf["body"]]
            flat, _ = _token_lists(texts)
            code, uniques = pd.factorize(flat)
            for u, n in zip(uniques, np.bincount(code, minlength=len(uniques)).tolist()):
                if f := form(u):
                    total[f] += n
            for c, n in Counter(m.lower() for t in texts for m in re.findall(r"[A-Za-z]+-[A-Za-z]+", t)).items():
                total[c] += n
            if len(total) > 200_000:
                yield pd.DataFrame({"form": list(total), "n": list(total.values())})
                total.clear()
        if total:
            yield pd.DataFrame({"form": list(total), "n": list(total.values())})

    body = rows.select("number", F.concat_ws("\n\n", "title", "text").alias("body"))
    return body.mapInPandas(count, "form string, n long").groupBy("form").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The forms from the least power of two on at which there are no more than ``most``."""
    by_power = {r.p: r.c for r in counts.groupBy(F.floor(F.log2("n")).alias("p")).agg(F.count("*").alias("c")).collect()}
    least, have = max(by_power, default=0) + 1, 0
    for p in sorted(by_power, reverse=True):
        have += by_power[p]
        if have > most:
            break
        least = p
    return counts.filter(F.col("n") >= 2**least)


class Scans:
    """The fitted parts and the replacements of a collection; use ``found`` and ``repaired``."""

    def __init__(self, rows: DataFrame) -> None:
        base = rows.filter(F.col("block_id").isNotNull()).select("block_id", "number", "title", "text")
        self.base = base
        spark = rows.sparkSession
        counts = written(_counts(self.base), "scans-counts")
        usual = counts.filter((F.col("n") >= FREQUENT) & F.col("form").rlike(r"^(?:[a-z]{2,}|#?9+(?:\.9+)*)$"))
        frequent = [(r.form, r.n) for r in _most_frequent(usual, COMMON).orderBy(F.desc("n"), "form").limit(TRAIN_FORMS).collect()]
        self.replacements = written(_replacements(counts, _fit_ranker(frequent)), "scans-replacements")
        sound = _most_frequent(counts.join(self.replacements, "form", "left_anti"), COMMON)
        self.common = {r.form: r.n for r in sound.collect()}
        texts = [r.text for r in bounded(self.base.filter("text is not null").select("text"), TRAIN_ROWS)]
        titles = [r.title for r in bounded(self.base.filter("title is not null").select("title"), TRAIN_ROWS)]
        self.lines = _fit_lines([t.replace("\n", " ") for t in texts], titles, self.common)
        self.shared = spark.sparkContext.broadcast((self.common, self.lines))  # COMMON forms at most

    def _read(self, texts: bool = True) -> DataFrame:
        """Per row: the joined text, the kinds of noise seen without the replacements, and the forms not known as sound; without ``texts`` only the latter two."""
        shared, whole = self.shared, texts

        def read(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            common, lines = shared.value
            prefixes = {f[:k] for f in common for k in range(1, len(f))}
            for pdf in it:
                joined_texts, kinds = [], []
                lined = lines.read([t or "" for t in pdf["text"]], common)
                paged = lines.paged(list(pdf["title"]))
                for (joined, k), page in zip(lined, paged):
                    joined_texts.append(joined)
                    kinds.append(sorted(k | {"page_number"} if page else k))
                heads = [(_END.match(t)[1] if page else t) if t else "" for t, page in zip(pdf["title"], paged)]
                flat, row = _token_lists([f"{h}\n{t}" for h, t in zip(heads, joined_texts)])
                code, uniques = pd.factorize(flat)
                fs = [form(u) for u in uniques]
                unknown = np.asarray([bool(f) and f not in common for f in fs], bool) if len(fs) else np.zeros(0, bool)
                odd: list[set] = [set() for _ in range(len(pdf))]
                for r, c in zip(row[unknown[code]], code[unknown[code]]) if len(code) else ():
                    odd[r].add(fs[c])
                for o, h, number in zip(odd, heads, pdf["number"]):
                    # a heading that was cut ends in the beginning of a word, which is no misread one
                    if o and h and (last := form(h.split()[-1]) if h.split() else "") in prefixes and last.isalpha():
                        o.discard(last)
                    if number and (f := number_form(number)) and f not in common:
                        o.add(f)
                if not whole:
                    yield pd.DataFrame({"block_id": pdf["block_id"], "kinds": kinds, "odd": [sorted(o) for o in odd]})
                    continue
                yield pd.DataFrame({"block_id": pdf["block_id"], "number": pdf["number"], "title": pdf["title"], "head": [None if t is None else h.strip() for t, h in zip(pdf["title"], heads)], "text": pdf["text"], "joined": joined_texts, "kinds": kinds, "odd": [sorted(o) for o in odd]})

        kind = self.base.schema["block_id"].dataType.simpleString()
        if not texts:
            return self.base.mapInPandas(read, f"block_id {kind}, kinds array<string>, odd array<string>")
        return self.base.mapInPandas(read, f"block_id {kind}, number string, title string, head string, text string, joined string, kinds array<string>, odd array<string>")

    def found(self) -> DataFrame:
        """(block_id, noise), each once."""
        r = self._read(texts=False)
        seen = r.select("block_id", F.explode(F.concat(F.transform("kinds", lambda k: F.concat(F.lit("="), k)), "odd")).alias("x")).distinct()
        seen = written(seen, "scans-seen")  # a few forms a row; both branches read it
        direct = seen.filter(F.col("x").startswith("=")).select("block_id", F.expr("substring(x, 2)").alias("noise"))
        words = seen.filter(~F.col("x").startswith("=")).join(self.replacements.select(F.col("form").alias("x")), "x").select("block_id", F.lit("misread").alias("noise"))
        return direct.unionByName(words).distinct()

    def repaired(self) -> DataFrame:
        """block_id, number, title, text: continuous text without furniture, divisions and misread words; one row per id and text."""
        r = self._read().withColumn("key", F.xxhash64("block_id", "number", "title", "text"))
        words = r.select("key", F.explode("odd").alias("form")).distinct().join(self.replacements.select("form", "replacement"), "form")
        maps = words.groupBy("key").agg(F.map_from_entries(F.collect_set(F.struct("form", "replacement"))).alias("map"))  # a row's own forms

        def mend(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in it:
                out = []
                for r in pdf.itertuples(index=False):
                    change = dict(r.map) if r.map is not None else {}
                    title = None if r.head is None else _swap(r.head, change)
                    text = None if r.text is None else re.sub(r"\s+", " ", _swap(r.joined, change)).strip()
                    number = r.number
                    if number and number_form(number) in change:
                        number = number.translate(_DIGITS)
                    out.append((r.block_id, number, title, text))
                yield pd.DataFrame(out, columns=["block_id", "number", "title", "text"])

        kind = self.base.schema["block_id"].dataType.simpleString()
        return r.join(maps, "key", "left").select("block_id", "number", "head", "text", "joined", "map").mapInPandas(mend, f"block_id {kind}, number string, title string, text string").distinct()


_DIGITS = str.maketrans("OoQIlLi|SsBbZz", "00011111558622")


def _swap(text: str, change: dict[str, str]) -> str:
    if not change:
        return text

    def one(m: re.Match) -> str:
        raw = m.group()
        to = change.get(form(raw))
        if to is None:
            return raw
        core = raw.strip(_STRIP)
        at = raw.find(core)
        if "9" in to:  # figures keep their digits; only the misread ones change
            new = core.translate(_DIGITS)
        else:
            new = to.upper() if core.isupper() and len(core) > 1 else to.capitalize() if core[:1].isupper() and core[1:] != core[1:].upper() else to
        return raw[:at] + new + raw[at + len(core) :]

    return _TOKEN.sub(one, text)


def scan_noise(rows: DataFrame) -> DataFrame:
    """(block_id, noise): hyphen_break, misread, running_header and page_number, each once per record.

    Defined results: null columns show no noise; rows without block_id are left
    out; rows given again count once; line breaks alone are no damage; an empty
    table yields no row; other columns are ignored; texts are read whole.
    """
    return Scans(rows).found()


def repaired_records(rows: DataFrame) -> DataFrame:
    """The records with continuous paragraphs and clean titles and numbers; nulls stay null, rows given again appear once."""
    return Scans(rows).repaired()
