"""Operators for text collections: brute force on small fixtures, round trips and edge cases."""

from __future__ import annotations

import random
import re
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from codexgrid.llm import alignment, leakage, mixture, pairs, scans, sigtree, splitting, tokens, truncation
from codexgrid.llm.boosting import Boosted

WORDS = re.compile(r"[^\W_]+")


# near duplicates ------------------------------------------------------------------------------------------------------

DUP = "block_id long, title string, text string, k1 string, words int"  # clashing names beside


def brute_pairs(rows, k, t, least):
    sets = {}
    for b, title, text in rows:
        w = WORDS.findall(f"{title or ''} {text or ''}".lower())
        if b is not None and len(w) >= least:
            sets[b] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    ids = sorted(sets)
    return {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-12}


def edited(rng, words, vocab):
    w = list(words)
    for _ in range(rng.randint(0, 5)):
        i = rng.randrange(len(w))
        w[i : i + 1] = rng.choice([[], [rng.choice(vocab)], [w[i], rng.choice(vocab)]])
    return w if rng.random() < 0.8 else w[len(w) // 2 :] + w[: len(w) // 2]


@pytest.mark.parametrize("k,t,least", [(3, 0.6, 40), (5, 0.8, 5)])
def test_similar_pairs_equal_brute_force(spark, k, t, least, monkeypatch):
    monkeypatch.setattr(sigtree, "HOT", 6)  # slices of hot shingles too
    monkeypatch.setattr(sigtree, "SLICE", 2)  # slices of classes of equal texts
    monkeypatch.setattr(sigtree, "SHARES", 30)
    if k == 5:
        monkeypatch.setattr(sigtree, "FILTER_BITS", 10)  # too small for the candidates: they meet the texts in a join
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    rows = []
    for base in range(12):
        words = [rng.choice(vocab) for _ in range(rng.randint(30, 90))]
        rows += [(len(rows) + j, f"T{base}", " ".join(edited(rng, words, vocab)) if j else " ".join(words)) for j in range(5)]
    rows += [(900, None, rows[0][2]), (901, None, rows[0][2].upper() + "!"), (902, "", None), (None, "x", rows[0][2]), (903, "a", "short text"), rows[0]]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], DUP)
    got = [(r.block_id_a, r.block_id_b) for r in sigtree.similar_pairs(df, k=k, t=t, least_words=least).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(rows, k, t, max(least, k))


def test_similar_records_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, "", text, "k", 1), (2, "", text, "k", 1), (3, "", text + " x", "k", 1), (4, "", "a b c d e f", "k", 1)], DUP)
    got = {r.block_id: (r.class_id, r.class_size, r.n_links) for r in sigtree.similar_records(df).collect()}
    assert got == {1: (1, 2, 1), 2: (1, 2, 1), 3: (3, 1, 1), 4: (4, 1, 0)}
    assert sigtree.similar_pairs(df.limit(0)).count() == 0


# truncation -----------------------------------------------------------------------------------------------------------

CUT = "block_id long, source string, title string, text string, translation string, field string, value string"


def test_truncation(spark):
    rng = random.Random(2)
    nouns = ["housing", "indicator", "suspension", "connector", "actuator"]
    full = lambda: f"{rng.choice(['Marking', 'Sealing', 'Endurance'])} of the {rng.choice(['front', 'rear', 'upper'])} {rng.choice(['brake', 'door', 'lamp'])} {rng.choice(nouns)} for vehicles with raised {rng.choice(nouns)}"
    rows = [(i, "good", full(), "A text.", "訳文である。", None, None) for i in range(300)]
    rows += [(1000 + i, "short", full()[:40].rstrip(), "A text.", "訳文である。", None, None) for i in range(40)]
    rows += [(2000, "good", "Marking of the rear brake actu", "A text.", "訳文", None, None), (2001, "good", None, "A text.", None, None, None), (2002, None, "", "A text.", "…", None, None), (2003, "good", full(), "Place", "場所", None, None), (2000, "good", "Marking of the rear brake actu", "A text.", "訳文", None, None)]
    df = spark.createDataFrame(rows, CUT)
    got = {(r.block_id, r.field_name) for r in truncation.truncated_values(df).collect()}
    assert {(2000, "title"), (2000, "translation")} <= got and len([g for g in got if g[1] == "translation"]) == 1
    assert len([g for g in got if g[0] >= 1000 and g[0] < 2000]) >= 39 and not [g for g in got if g[0] < 1000 or g[0] in (2001, 2002, 2003)]
    rep = {(r.source, r.field_name): r for r in truncation.truncation_report(df).collect()}
    assert rep["short", "title"].limit_chars == 40 and rep["short", "title"].cut_share > 0.9 and rep["good", "title"].limit_chars is None
    assert truncation.truncated_values(df.limit(0)).count() == 0


# pieces ---------------------------------------------------------------------------------------------------------------


def test_pieces_round_trip(spark):
    rng = random.Random(1)
    para = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "漢字", "é"]) for _ in range(rng.randint(5, 60))) + rng.choice([".", ";", "。", ""])
    texts = ["\n\n".join(para() for _ in range(60)), "x" * 5000, "あ" * 3000, " ".join(["word"] * 4000), "short", "", None]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, piece int")
    got = splitting.split_oversized(df, limit=300, overlap=20).orderBy("doc_id", "piece_no").collect()
    for i, t in enumerate(texts):
        mine = [r for r in got if r.doc_id == i]
        if not t or tokens.count(t) <= 300:
            assert not mine
            continue
        ends = np.concatenate([[0], tokens.ends(t)])
        data = t.encode()
        assert mine[0].start_token == 0 and mine[-1].end_token == len(ends) - 1
        for r in mine:
            assert r.n_tokens <= 300 and data[ends[r.start_token] : ends[r.end_token]].decode() == r.piece
        strong = splitting.strengths(data, ends[1:])
        for r in mine[:-1]:  # no boundary of the window is stronger, and none as strong lies further right
            window = strong[r.start_token + 149 : r.start_token + 300]
            assert r.strength == window.max() and not (strong[r.end_token : r.start_token + 300] >= r.strength).any()
        for a, b in zip(mine, mine[1:]):
            assert 20 <= a.end_token - b.start_token <= 23 and b.end_token > a.end_token
    assert {r.strength for r in got if r.doc_id == 0 and r.piece_no < r.n_pieces} <= {splitting.PARAGRAPH, splitting.SENTENCE}
    with pytest.raises(ValueError):
        splitting.split_oversized(df, limit=100, overlap=60)


def test_strongest_equals_scan():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 5, 200)
    s = splitting.Strongest(v)
    for _ in range(300):
        a = int(rng.integers(0, 200))
        b = int(rng.integers(a, 200))
        best = max(range(a, b + 1), key=lambda i: (v[i], i))
        assert s.query(a, b) == best


# mixture --------------------------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, source string, n_tokens int, uses int"


def test_mixture(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(5, 60))) + f" {i}.", rng.choice("AAAB"), 0, 0) for i in range(400)]
    rows += [(1000, rows[0][1], rows[0][2], 0, 0), (1001, None, "A", 0, 0), (1002, "", "B", 0, 0), (1003, "z z z", None, 0, 0), (1004, "only here", "C", 0, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    targets = spark.createDataFrame([("A", 0.4, 1), ("B", 0.5, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeat int")
    m = mixture.mixture(docs, targets).collect()
    by = {s: sum(r.n_tokens * r.uses for r in m if r.source == s) for s in "AB"}
    assert abs(by["A"] / (by["A"] + by["B"]) - 4 / 9) < 0.02
    assert max(r.uses for r in m if r.source == "A") == 1 and max(r.uses for r in m if r.source == "B") <= 3
    text = {r[0]: r[1] for r in rows}
    assert len({text[r.doc_id] for r in m}) == len(m) and {r.source for r in m} == {"A", "B"}
    assert mixture.mixture(docs, targets).exceptAll(mixture.mixture(docs, targets)).count() == 0  # the same every time
    rep = {r.source: r for r in mixture.mixture_report(docs, targets).collect()}
    assert rep["none"].used_tokens == 0 and abs(sum(r.reached_share for r in rep.values()) - 1) < 1e-9
    assert mixture.mixture(docs.limit(0), targets).count() == 0


def test_mixture_fills_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixture, "TEXTS_PER_RANGE", 40)
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([3, 30, 300]))) + f" {i}.", "A", 0, 0) for i in range(1500)], DOCS)
    targets = spark.createDataFrame([("A", 1.0, 1)], "source string, target_share double, max_repeat int")
    total = 60_000
    sized, b = mixture._plan(docs, targets, total, 11, tokens.VOCABULARY)
    rest, want = total, set()
    for r in sorted(sized.collect(), key=lambda r: (r.key, r.doc_id)):
        if r.n_tokens <= rest:
            rest -= r.n_tokens
            want.add(r.doc_id)
    assert {r.doc_id for r in mixture.mixture(docs, targets, total).collect()} == want
    slots = mixture._ranged(sized).groupBy("source", "slot").count()
    assert slots.agg(F.max("count")).first()[0] <= 80


# leakage --------------------------------------------------------------------------------------------------------------


def test_leakage_equals_brute_force(spark):
    rng = random.Random(4)
    common = [f"c{i}" for i in range(150)]
    items = [(i, " ".join(rng.choice(common + [f"q{i}x{j}" for j in range(40)]) for _ in range(50))) for i in range(12)] + [(50, "too short"), (51, None), (0, None)]
    docs = []
    for d in range(120):
        w = [rng.choice(common) for _ in range(rng.choice([3, 40, 400]))]
        if rng.random() < 0.4:
            it = rng.choice(items[:12])[1].split()
            n, a = rng.choice([12, 13, 14, 30]), rng.randint(0, 19)
            at = rng.randint(0, len(w))
            w[at:at] = it[a : a + n]
        docs.append((d, (" ".join(w)).upper() if d % 2 else ", ".join(w), 1))
    docs += [(900, None, 1), (901, "", 1), docs[0]]
    got = {(r.doc_id, r.item_id) for r in leakage.leaked_passages(spark.createDataFrame(docs, "doc_id long, text string, words int"), spark.createDataFrame(items, "item_id int, text string")).filter("kind = 'verbatim'").collect()}
    grams = {}
    for i, t in items:
        w = WORDS.findall((t or "").lower())
        for a in range(len(w) - 12):
            grams.setdefault(tuple(w[a : a + 13]), set()).add(i)
    want = set()
    for d, t, _ in docs:
        w = WORDS.findall((t or "").lower())
        for a in range(len(w) - 12):
            want |= {(d, i) for i in grams.get(tuple(w[a : a + 13]), ())}
    assert want and got == want
    empty = spark.createDataFrame([], "item_id int, text string")
    assert leakage.leaked_passages(spark.createDataFrame(docs, "doc_id long, text string, words int"), empty).count() == 0


def test_paraphrases_begin_anywhere(spark):
    rng = random.Random(8)
    items = [(i, " ".join([str(100 + i), *(f"w{rng.randrange(400)}" for _ in range(24)), str(200 + i)])) for i in range(20)]
    docs = []
    for d in range(39):
        # every third word differs: 18 of 26 are kept, no run reaches 13
        told = [f"x{rng.randrange(900)}" if k % 3 == 2 and k < 24 else w for k, w in enumerate(items[d % 20][1].split())]
        before = [f"w{rng.randrange(400)}" for _ in range(39 + d % 13)]
        docs.append((d, " ".join(before + told + [f"w{rng.randrange(400)}" for _ in range(40)])))
    docs.append((99, " ".join(told)))  # a text of its own, with nothing beside
    found = leakage.leaked_passages(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")).filter("kind = 'paraphrase'")
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(d, d % 20) for d in range(39)} | {(99, 38 % 20)}


def test_leaks_in_any_surroundings(spark):
    rng = random.Random(11)
    items = [(i, " ".join(f"w{rng.randrange(300)}" if k % 5 else str(100 * i + k) for k in range(40))) for i in range(10)]
    words = [t.split() for _, t in items]
    docs = [(d, " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randint(100, 300)))) for d in range(150)]
    # parts of an item within one word of another one, again and again, in long texts
    for d in range(6):
        loud = [words[(d + 1) % 10][0]] * 40
        told = words[d][7:20] if d < 3 else [w if k % 3 < 2 or k > 23 else loud[0] for k, w in enumerate(words[d][10:36])]
        plain = [f"w{rng.randrange(300)}" for _ in range(2600)]
        docs.append((500 + d, " ".join(plain + loud + told + loud + plain)))
    found = leakage.leaked_passages(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string"))
    assert {(r.doc_id, r.item_id, r.kind) for r in found.collect()} == {(500 + d, d, "verbatim" if d < 3 else "paraphrase") for d in range(6)}


def test_alike_passages():
    rng = np.random.default_rng(7)
    space = leakage._prepared([(i, " ".join(f"w{x}" for x in rng.integers(0, 60, 50))) for i in range(9)] + [(9, "7 w1")])
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 70, n)) for n in (5, 26, 90, 13, 400)]
    h, counts = leakage.W.hashed(texts)
    rows, owner = leakage._rows(space.codes(h), counts)
    got = {(int(a), int(b)) for i, k in leakage._alike(space, rows, owner, np.arange(len(rows))) for a, b in zip(i, k)}
    have = (space.at[:, rows] > 0).sum(2)  # (section, row)
    of = lambda k, r, i: int(have[k, r]) if 0 <= r < len(rows) and owner[r] == owner[i] else 0
    both = {(i, k): of(k, i, i) + of(k, i + 1, i) for i in range(len(rows)) for k in range(len(have))}
    reach = {(i, k): n + max(of(k, i - 1, i), of(k, i + 2, i)) for (i, k), n in both.items()}
    assert got and got == {p for p, n in both.items() if n >= leakage.RUN or n >= leakage.PART and reach[p] >= leakage.ORDERED}


def test_word_checks():
    rng = np.random.default_rng(3)
    section = rng.integers(0, 9, 100)
    space = leakage._prepared([(1, " ".join(f"w{x}" for x in section))])
    words = rng.integers(0, 12, (200, 26))
    words[:20, 3:20] = section[np.arange(17) + rng.integers(0, 80, 20)[:, None]]
    h = np.asarray([leakage.W.hashed([f"w{x}"])[0][0] for x in range(12)])
    m = space.masks[space.at[0][space.codes(h)[words]]]

    def naive(ws):
        run = lcs = 0
        table = np.zeros((27, 101), int)
        runs = np.zeros((27, 101), int)
        for p, w in enumerate(ws, 1):
            for q, x in enumerate(section, 1):
                runs[p, q] = runs[p - 1, q - 1] + 1 if w == x else 0
                table[p, q] = table[p - 1, q - 1] + 1 if w == x else max(table[p - 1, q], table[p, q - 1])
        return runs.max(), table[-1, -1]

    want = [naive(ws) for ws in words]
    assert leakage._lcs(m).tolist() == [b for _, b in want]
    assert leakage._longest_run(m).tolist() == [a for a, _ in want] and leakage._has_run(m).tolist() == [a >= 13 for a, _ in want]


def test_hashed_words():
    from codexgrid.llm import words

    texts = ["", "A b_c é漢字 12.5", "x" * 300_000 + " y", " ", "İstanbul ΣΑΣ"]
    h, n = words.hashed(texts)
    flat = [w for t in texts for w in WORDS.findall(t.lower())]
    assert n.tolist() == [len(WORDS.findall(t.lower())) for t in texts] and len(set(h.tolist())) == len(set(flat)) == len(flat)


def test_long_items(spark):
    rng = random.Random(5)
    long = [f"w{rng.randrange(3000)}" for _ in range(700)]
    items = spark.createDataFrame([(1, " ".join(long)), (2, "w1 w2")], "item_id int, text string")
    docs = spark.createDataFrame([(k, " ".join([f"z{j}" for j in range(40)] + long[a : a + 13] + ["w1", "q"])) for k, a in enumerate(range(0, 687, 7))] + [(500, " ".join(long[:12]))], "doc_id long, text string")
    assert {(r.doc_id, r.item_id, r.kind) for r in leakage.leaked_passages(docs, items).collect()} == {(k, 1, "verbatim") for k in range(len(range(0, 687, 7)))}


# pairs ----------------------------------------------------------------------------------------------------------------

PAIR = "block_id long, text string, translation string, summary_ja string, answer string"


def test_broken_pairs(spark):
    text = "The relay of the lamp shall resist corrosion for {} hours. The lock shall release at {} daN."
    ja = "灯火のリレーは、{}時間の腐食に抵抗すること。錠は{}daNで解除されるものとする。"
    rows = [(i, text.format(i, i + 1), ja.format(i, i + 1), "リレーに関する耐久性。" if i % 2 else None, None) for i in range(300)]
    t = text.format(7, 8)
    bad = {
        1000: ("N/A", "empty"), 1001: (None, "empty"), 1002: ("　", "empty"), 1003: ("申し訳ございませんが、この文章の翻訳はできかねます。", "refusal"), 1004: ("I'm sorry, I cannot translate this passage.", "refusal"),
        1005: (t.upper(), "copied"), 1006: ("以下が翻訳です。\n" + t.replace(",", ""), "copied"), 1007: ("Der Hersteller stellt 7 Muster aus dem Los 8 zur Verfügung.", "wrong_language"), 1008: ("제조자는 로트에서 시료를 제출하여야 한다.", "wrong_language"),
        1009: ("制造商应从批次371中提供132个样品。", "wrong_language"), 1010: (ja.format(7, 8)[:20], "truncated"), 1011: (ja.format(7, 8), None),
    }
    rows += [(k, t, a, None, None) for k, (a, _) in bad.items()]
    rows += [(2000, "Specimen of the record", "記録の様式", None, None), (2001, "(Deleted)", "(削除)", "要約", None), (2002, None, "訳文である。", None, None), (None, t, "x", None, None), rows[0]]
    df = spark.createDataFrame(rows, PAIR)
    got = {(r.block_id, r.answer): r.defect for r in pairs.broken_pairs(df).collect()}
    for k, (_, d) in bad.items():
        assert got.get((k, "translation")) == d, k
    assert not [k for k in got if k[0] < 1000] and (2000, "translation") not in got and (2001, "translation") not in got
    assert pairs.broken_pairs(df.limit(0)).count() == 0


def test_long_answers_are_tagged_whole():
    rng = np.random.default_rng(4)
    w, tr = rng.standard_normal((len(pairs.FEATURES), pairs.TAGS)), 3 * rng.standard_normal((pairs.TAGS, pairs.TAGS))
    seq = [[int(x)] for x in rng.integers(0, len(pairs.FEATURES), 300)]
    tags = pairs._viterbi([seq, seq[:3], []], (w, tr))
    best = w[seq[0]].sum(0)
    for f in seq[1:]:
        best = (best[:, None] + tr).max(0) + w[f].sum(0)
    score = sum(w[f].sum(0)[t] for f, t in zip(seq, tags[0])) + sum(tr[a, b] for a, b in zip(tags[0], tags[0][1:]))
    assert len(tags[0]) == 300 and len(tags[1]) == 3 and len(tags[2]) == 0 and abs(score - best.max()) < 1e-9


def test_fit_rows_of_repeated_texts(spark):
    from codexgrid.llm.sampling import bounded

    df = spark.createDataFrame([(f"t{i % 40}",) for i in range(4000)], "t string")
    assert len(bounded(df, 20)) == 20 and len(bounded(df, 100)) == 40 and len(bounded(df, 30, F.col("t") > "t2")) == 27


def test_crf_learns_transitions():
    seqs = [[[pairs._AT["bias"]], [pairs._AT["sorry"]]], [[pairs._AT["bias"]], [pairs._AT["han"]]]] * 20
    model = pairs._fit(seqs, [[1, 1], [0, 0]] * 20)
    assert [t.tolist() for t in pairs._viterbi(seqs[:2], model)] == [[1, 1], [0, 0]]


# alignment ------------------------------------------------------------------------------------------------------------


def test_sentence_rules():
    assert alignment.english_sentences('Of No. 92 and 3.7. below. "So" it is! Yes? no') == ["Of No. 92 and 3.7. below.", '"So" it is!', "Yes? no"]
    assert alignment.japanese_sentences("一。 二。\n三") == ["一。", "二。", "三"]


def test_alignment(spark):
    rng = random.Random(6)
    parts = [("relay", "リレー"), ("lens", "レンズ"), ("lever", "レバー"), ("spring", "ばね"), ("housing", "筐体")]
    acts = [("resist corrosion for {} hours", "{}時間の腐食に抵抗する"), ("release at {} daN", "{}daNで解除される"), ("draw {} mA", "{}mAを消費する"), ("deflect by {} mm", "{}mm撓む")]
    rows, want = [], set()
    for k in range(200):
        en, ja = [], []
        for _ in range(rng.randint(2, 6)):
            p, a, n = rng.choice(parts), rng.choice(acts), rng.randint(10, 9999)
            en.append(f"The {p[0]} shall {a[0].format(n)}.")
            ja.append(f"{p[1]}は、{a[1].format(n)}こと。")
        order = list(range(len(ja)))
        if k % 3 == 0:
            order = order[1:] + order[:1]
        if k % 4 == 0 and len(order) > 2:
            order.pop()
        rows.append((k, " ".join(en), "".join(ja[i] for i in order), 0))
        want |= {(k, i + 1, j + 1) for j, i in enumerate(order)}
    rows += [(1000, None, "一。", 0), (1001, "A b.", None, 0), (1002, "", "", 0), rows[0]]
    df = spark.createDataFrame(rows, "block_id long, text string, translation string, text_no int")
    got = {(r.block_id, r.text_no, r.trans_no) for r in alignment.aligned_sentences(df).collect()}
    assert len(got & want) / len(want) > 0.95 and len(got & want) / len(got) > 0.95
    assert alignment.aligned_sentences(df.limit(0)).count() == 0


def test_alignment_threshold_from_all_rows(spark, monkeypatch):
    rng = random.Random(9)
    words = [(f"{a}{b}", f"{chr(0x4E00 + 40 * i)}{chr(0x5200 + 30 * j)}") for i, a in enumerate(["ka", "ro", "mi", "te", "su"]) for j, b in enumerate(["lan", "der", "mot", "pix"])]
    rows = []
    for k in range(120):
        told = [[*rng.sample(words, 4), (str(n := rng.randint(1, 40)),) * 2] for _ in range(rng.randint(1, 4))]
        rows.append((k, " ".join("The " + " ".join(w for w, _ in s) + "." for s in told), "".join("、".join(w for _, w in s) + "。" for s in told)))
    df = spark.createDataFrame(rows + rows[:30], "block_id long, text string, translation string")
    model = alignment.fit(df, "text", "translation")
    sides = list(alignment._sides(((t, j) for _, t, j in rows), model.vectors()))
    every = np.concatenate([(x.a @ y.b.T).ravel() for x in sides for y in sides if x is not y])
    assert abs(model.threshold - np.quantile(every, alignment.SHARE)) < 2e-3
    # in groups too, all rows count, however they lie
    monkeypatch.setattr(alignment, "MET", 20)
    monkeypatch.setattr(alignment, "BLOCK", 9)
    given = df.selectExpr("text as t", "translation as j")
    first = alignment._threshold(given, 120, model)
    assert first == alignment._threshold(given.repartition(7, "j"), 120, model) and abs(first - model.threshold) < 0.05


def test_alignment_tokens():
    en = ["The K-type relay draws 12mA at 3.7.2V.", "İstanbul aİb-c 5\x1ea", "", "10 ° x²3y ①a"]
    assert alignment._tokens(en, alignment._EN) == [["the", "k-type", "relay", "draws", "12", "ma", "at", "3.7.2", "v"], ["stanbul", "a", "b-c", "5", "a"], [], ["10", "°", "x", "23", "y", "1", "a"]]
    assert alignment._tokens(["各12mm、リレーは", "消費する12時間"], alignment._JA) == [["各", "12", "mm", "リレー"], ["消費", "12", "時間"]] and alignment._tokens([], alignment._JA) == []


def test_alignment_vectors(monkeypatch):
    rng = np.random.default_rng(5)
    words = {w: rng.standard_normal(alignment.SIZE) for w in "abcdef"}
    weight = {"a": 2.0, "b": 0.5}
    sentences = [["a", "b", "a", "12", "none"], [], ["none"], ["3.5", "12"], ["f", "e", "d", "c"]]
    want = np.zeros((5, alignment.SIZE + alignment.FIGURES))
    for out, tokens in zip(want, sentences):
        for t in set(tokens):
            out[: alignment.SIZE] += words.get(t, 0) * np.float64(weight.get(t, 3.0))
            out[alignment.SIZE :] += alignment._figure_vector(t) if t[0].isdigit() else 0
        for at, share in ((slice(0, alignment.SIZE), 0.7), (slice(alignment.SIZE, None), 0.714), (slice(None), 1.0)):
            out[at] *= share / (np.linalg.norm(out[at]) or 1)
    vectors = alignment.Vectors(words, weight, 3.0)
    assert np.allclose(vectors.embed(sentences), want)
    monkeypatch.setattr(alignment, "OFTEN", 1)  # one of them by a product
    assert np.allclose(vectors.embed(sentences), want)
    monkeypatch.setattr(alignment, "GATHERED", 1)  # in many parts, and figures forgotten
    assert np.allclose(vectors.embed(sentences), want) and np.allclose(vectors.embed(sentences[::-1]), want[::-1])


def test_nearest_in_blocks(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 7)
    rng = np.random.default_rng(3)
    a, b = rng.standard_normal((20, 5)), rng.standard_normal((33, 5))
    at, best = alignment._nearest(a, b)
    assert at.tolist() == (a @ b.T).argmax(1).tolist() and np.allclose(best, (a @ b.T).max(1))


def test_warping_is_monotone_and_whole():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((40, 8))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    path = alignment.warping(a, np.repeat(a, 2, axis=0))
    assert path[0] == (0, 0) and path[-1] == (39, 79)
    assert all(0 <= x - p <= 1 and 0 <= y - q <= 1 for (p, q), (x, y) in zip(path, path[1:]))
    assert sum((j // 2) == i for i, j in path) >= 70


# scans ----------------------------------------------------------------------------------------------------------------

SCAN = "block_id long, number string, title string, text string, form string, joined string"


def test_scans(spark):
    rng = random.Random(9)
    subj = ["indicator", "housing", "connector", "suspension", "actuator", "ventilation"]
    verb = ["tolerate vibration", "signal a fault", "resist corrosion", "remain legible", "absorb energy"]
    sent = lambda: f"The {rng.choice(subj)} of the self-locking buckle shall {rng.choice(verb)} for {rng.randint(10, 999)} hours in accordance with paragraph {rng.randint(1, 9)}.{rng.randint(1, 9)}. of Annex {rng.randint(1, 20)}."
    rows = [(i, f"{i % 9 + 1}.{i % 7 + 1}", f"Marking of the {rng.choice(subj)}", " ".join(sent() for _ in range(3)), None, None) for i in range(500)]
    good = rows[3][3]
    bad = [
        (1000, "1.2", "Marking", good.replace("accordance", "accor-\ndance", 1), {"hyphen_break"}),
        (1001, "1.2", "Marking", good.replace("accordance", "accordancc", 1), {"misread"}),
        (1002, "1.2", "Marking ........ 37", good, {"page_number"}),
        (1003, "3.Z", "Marking", good, {"misread"}),
        (1004, "1.2", "Marking", good[:60] + "\nE/ECE/4411/Rev.4\n" + good[60:], {"running_header"}),
        (1005, "1.2", "Marking", good[:60] + "\n12/60\n" + good[60:], {"page_number"}),
        (1006, "1.2", "Marking", good.replace(" in accordance", "\nin accordance"), set()),
        (1007, "1.2", "Marking", good.replace("self-locking", "self-\nlocking", 1), set()),
        (1008, "1.2", "Mark1ng", good, {"misread"}),
        (1009, None, None, None, set()),
        (1012, "1.2", "Marking of Annex 12", good, set()),
        (1013, "1.2", "Marking", good.replace("accordance", "x" * 300 + " accordance", 1), set()),
        (1010, "", "", "", set()),
    ]
    df = spark.createDataFrame([*rows, *[(*b[:4], None, None) for b in bad], (None, "1", "x", "y", None, None), (*bad[1][:4], None, None)], SCAN)
    sc = scans.Scans(df)
    got = {}
    for r in sc.found().collect():
        got.setdefault(r.block_id, set()).add(r.noise)
    for b in bad:
        assert got.get(b[0], set()) == b[4], b
    assert not [k for k in got if k < 1000]
    fixed = {r.block_id: r for r in sc.repaired().collect()}
    for k in (1000, 1001, 1006, 1007):
        assert fixed[k].text == good, k
    assert "ECE" not in fixed[1004].text and fixed[1002].title == "Marking" and fixed[1003].number == "3.2" and fixed[1008].title == "Marking" and fixed[1009].text is None
    assert scans.scan_noise(df.limit(0)).count() == 0


def test_boosting_learns():
    rng = np.random.default_rng(0)
    x = rng.random((600, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    p = Boosted(rounds=80).fit(x, y).predict(x)
    assert ((p > 0.5) == (y > 0.5)).mean() > 0.9
