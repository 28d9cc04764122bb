"""Core operators against naive folds, golden values and edge cases."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from codexgrid.functions import blocks as B
from codexgrid.operators import diff as D
from codexgrid.operators import enrich, glossary, media, noise, ordered, proposals, references, report, segment, similarity, structure
from codexgrid.operators.snapshots import snapshot_changes
from codexgrid.sources import documents, pages

ROW = "regulation string, version string, pos int, type string, number string, level int, parent string, title string, text string, annex_id int, uid string, title_ja string, summary_ja string, translation string, status string"


def row(pos, number="", title="T", text="text", **k):
    d = {"regulation": "R1", "version": "v", "pos": pos, "type": "paragraph", "number": number, "level": number.count(".") + 1, "parent": number.rpartition(".")[0] or None, "title": title, "text": text, "annex_id": None, "uid": f"u{pos}", "title_ja": None, "summary_ja": None, "translation": None, "status": "untranslated"}
    return d | k


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in ROW.split(", ")) for r in rows], ROW)


def one(spark, expr, **cols):
    names = list(cols)
    return spark.createDataFrame([tuple(cols.values())], ", ".join(f"{n} string" for n in names)).select(expr(*[F.col(n) for n in names]).alias("x")).first().x


def test_scalars(spark):
    assert one(spark, B.uid, r="R1", t="a \n b　c") == one(spark, B.uid, r="R1", t="a b c")
    assert one(spark, B.level, n="5.1.2") == 3 and one(spark, B.parent, n="5.1.2") == "5.1" and one(spark, B.parent, n="5") is None
    assert one(spark, B.path, n="5.1") == [5, 1] and one(spark, B.path, n="A.1") is None
    assert one(spark, B.valid_number, n="0.7") is False and one(spark, B.valid_number, n="1.2") is True
    assert one(spark, B.clean_text, t="1) foot\n  a  b \n\n c ") == "foot a  b c"
    assert one(spark, B.strip_page_headers, t="x\nE/ECE/324\nRegulation No. 13\npage 4\ny") == "x\n\n\n\ny"
    assert one(spark, B.without_leader, t="Scope ..... 5") == "Scope"
    assert one(spark, B.strip_repeated_header, b="Annex 13 - Appendix 1 annex 13 - appendix 1: Symbols", h="Annex 13 - Appendix 1") == "Symbols"
    assert one(spark, B.inline_list, t="(a) x (b) y") == "(a) x <br>(b) y" and one(spark, B.inline_list, t="x (b) y") == "x (b) y"
    assert one(spark, B.short_summary, t="一。二。") == "一。" and one(spark, B.short_summary, t="一") == "一"
    assert one(spark, B.noise_title, t="Note by the secretariat") and one(spark, B.noise_title, t="ab 12") and not one(spark, B.noise_title, t="Place ........................ 16")
    assert one(spark, B.toc_overflow, t="for seats ......... 12") and not one(spark, B.toc_overflow, t="Signed: ........")
    assert one(spark, B.table_cell, t="Mass  kg  2")
    assert one(spark, B.escape_html, t='<a href="x">') == "&lt;a href=&quot;x&quot;&gt;"
    d = spark.createDataFrame([(29, 100), (0, 0)], "a int, b int").select(B.progress(F.col("a"), F.col("b")).alias("p"))
    assert [r.p for r in d.collect()] == [29 - 1, 0]  # 29/100 in doubles falls short of 29
    k = spark.createDataFrame([("R10",), ("R.E.3",), ("X",), ("R9",)], "r string").orderBy(B.document_rank(F.col("r")))
    assert [r.r for r in k.collect()] == ["R.E.3", "R9", "R10", "X"]


def test_running_over_chunks_equals_fold(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK", 3)
    rng = random.Random(1)
    vals = [rng.choice([None, 1, 2, 3, 4]) for _ in range(20)]
    df = spark.createDataFrame([("d", "v", i, v) for i, v in enumerate(vals)], "regulation string, version string, pos int, x int")
    got = ordered.running(df, {"m": ordered.Run("max", F.col("x")), "l": ordered.Run("last", F.col("x"), own=True), "g": ordered.Run("lag", F.col("x")), "s": ordered.Run("sum", F.col("x"))}).orderBy("pos").collect()
    for i, r in enumerate(got):
        before = [v for v in vals[:i] if v is not None]
        upto = [v for v in vals[: i + 1] if v is not None]
        assert r.m == (max(before) if before else None) and r.l == (upto[-1] if upto else None) and r.g == (vals[i - 1] if i else None) and r.s == sum(before)


def naive_monotone(numbers):
    out, last = [], None
    for n in numbers:
        t = tuple(map(int, n.split(".")))
        ok = last is None or t >= last or t[0] < last[0]
        out.append(ok)
        last = t if ok else last
    return out


def test_monotone_and_restarts_equal_folds(spark):
    rng = random.Random(7)
    for seed in range(3):
        nums = [".".join(str(rng.randint(1, 4)) for _ in range(rng.randint(1, 3))) for _ in range(40)]
        df = frame(spark, [row(i, n) for i, n in enumerate(nums)])
        assert [r.accepted for r in structure.monotone(df).orderBy("pos").collect()] == naive_monotone(nums)
        g, last, want = 0, None, []
        for n in nums:
            t = int(n.split(".")[0])
            g += last is not None and t < last and last > 1
            want.append(g)
            last = t
        assert [r.restart_group for r in structure.restart_groups(df).orderBy("pos").collect()] == want


def test_annexes(spark):
    nums = ["1", "1.1", "2", "3", "3.1", "4", "1", "1.1", "2", "1", "2"]
    df = frame(spark, [row(i, n, text="body " * 20) for i, n in enumerate(nums)] + [row(11, "", "Annex 10", annex_id=10, text="body " * 20), row(12, "1", text="body " * 20), row(13, type="image", annex_id=7)])
    a = structure.in_annex(df)
    assert [r.pos for r in a.filter("in_annex").orderBy("pos").collect()][0] == 6
    ids = {r.pos: r.annex for r in structure.annex_ids(a, last_chapter=4).collect()}
    assert ids[5] is None and ids[6] == 1 and ids[8] == 1 and ids[9] == 2 and ids[11] == 10 and ids[12] == 10 and ids[13] == 7
    parts = structure.annex_parts(structure.annex_ids(a, last_chapter=4)).filter("annex = 1").orderBy("pos").collect()
    assert [r.part_idx for r in parts] == [0] * len(parts) and parts[0].part_first


def test_last_chapter_of_each_document(spark):
    body = "body " * 20
    short = ["1", "1.1", "2", "3", "3.1", "1", "2", "3", "4", "5", "1", "2"]  # three chapters, annexes of five and two
    long = [x for i in range(1, 15) for x in (str(i), f"{i}.1")] + ["1", "2", "1", "2"]  # fourteen chapters, two annexes
    rows = [row(i, n, text=body) for i, n in enumerate(short)] + [row(i, n, text=body, regulation="R2") for i, n in enumerate(long)] + [row(0, "A", text=body, regulation="R3")]
    df = frame(spark, rows)
    assert {(r.regulation, r.last_chapter) for r in structure.last_chapters(df).collect()} == {("R1", 3), ("R2", 14)}
    last = structure.last_chapters(df)
    assert {r.regulation: r.body_end for r in structure.body_end(df, last).collect()} == {"R1": 7, "R2": 27}
    ids = {(r.regulation, r.pos): r.annex for r in structure.annex_ids(structure.in_annex(df), last).collect()}
    assert [ids["R1", i] for i in (8, 9, 10, 11)] == [1, 1, 2, 2]
    assert [ids["R2", i] for i in range(26, 32)] == [None, None, 1, 1, 2, 2]


def test_parts_by_letter_and_repetition(spark):
    base = [row(0, "A", "Part A", annex_id=3), row(1, "1", annex_id=3), row(2, "B", "Part B", annex_id=3), row(3, "1", annex_id=3), row(4, "1", annex_id=4), row(5, "2", annex_id=4), row(6, "1", annex_id=4)]
    df = frame(spark, base).withColumn("annex", F.col("annex_id")).withColumn("in_annex", F.lit(True))
    got = {r.pos: (r.part_idx, r.display_number) for r in structure.annex_parts(df).collect()}
    assert got[1] == (0, "A-1") and got[3] == (1, "B-1") and got[2] == (1, "B") and got[4][0] == 0 and got[6][0] == 1


def test_footnote_runs(spark):
    long = "x" * 70
    df = frame(spark, [row(0, "1", "Scope", annex_id=3), row(1, "5", long, annex_id=3), row(2, "6", long, annex_id=3), row(3, "103", "Annex 3", annex_id=3), row(4, "2", long, annex_id=3), row(5, "2.1", annex_id=3)]).withColumn("annex", F.col("annex_id"))
    assert {r.pos for r in structure.annex_page_noise(df).filter("nav_only_hidden").collect()} == {1, 2, 3}


def test_chapters_tree_gaps(spark):
    df = frame(spark, [row(0, "1", "Scope"), row(1, "2"), row(2, "99", "Annexes ........ 99", text="Annexes ........ 99"), row(3, "3"), row(4, "3.1"), row(5, "1"), row(6, "4")])
    ch = structure.chapters(df).orderBy("pos").collect()
    assert [(r.chapter, r.toc_row) for r in ch] == [("1", False), ("2", False), ("99", True), ("3", False)]
    assert [(r.pos, r.parent_pos) for r in structure.tree_edges(df).collect()] == [(4, 3)]
    body = frame(spark, [row(0, "5"), row(1, "7"), row(2, "6")])
    known = body.select("regulation", "version", F.col("number").alias("chapter"))
    assert [(r.pos, r.missing) for r in structure.chapter_gaps(body, known).collect()] == [(1, [6])]
    fo = structure.first_occurrence(frame(spark, [row(0, "1"), row(1, "1"), row(2, "")])).orderBy("pos").collect()
    assert [r.first_occ for r in fo] == [True, False, False]


def test_chapters_equal_their_definition(spark):
    rng = random.Random(11)
    for seed in range(4):
        nums = [rng.choice(["1", "2", "3", "4", "5", "A", ""]) for _ in range(rng.randint(3, 40))]
        toc = [rng.random() < 0.5 for _ in nums]
        ja = [rng.choice([None, "題"]) for _ in nums]
        df = frame(spark, [row(i, n, f"T{i}", text="T" if t else "body " * 20, title_ja=j, level=1) for i, (n, t, j) in enumerate(zip(nums, toc, ja))])
        after = lambda n, p: next((i for i in range(p + 1, len(nums)) if nums[i] == str(n)), None)
        chain, at = {}, -1
        while (p := after(len(chain) + 1, at)) is not None:
            chain[len(chain) + 1] = at = p
        closed = min((q for n, p in chain.items() if (q := after(n, p)) is not None), default=len(nums))
        want = set()
        for i, n in enumerate(nums[:closed]):
            taken = n.isdigit() and chain.get(int(n)) == i
            giver = next((q for q in range(i + 1, len(nums)) if nums[q] == n and ja[q]), None) if taken and not ja[i] else None
            if not n.isdigit() or taken:
                want.add((i, n, f"T{i if giver is None else giver}", ja[i] or ("題" if giver is not None else ""), False))
            elif toc[i]:
                want.add((i, n, f"T{i}", ja[i] or "", True))
        assert {(r.pos, r.chapter, r.title, r.title_ja, r.toc_row) for r in structure.chapters(df).collect()} == want, nums


def test_diff_equals_brute_force(spark):
    rng = random.Random(5)
    words = "brake lamp door valve relay shall resist release within the of a test".split()
    old_t = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 30))) for _ in range(25)]
    new_t = [t if rng.random() < 0.3 else " ".join(w for w in t.split() if rng.random() < 0.85) + rng.choice(["", " new words here"]) for t in old_t if rng.random() < 0.9] + ["something else entirely 123", ""]
    side = lambda ts: [("d", i, f"u{hash(t) % 10**9}", str(i), "t", t) for i, t in enumerate(ts)]
    s = "doc string, pos int, uid string, number string, title string, text string"
    old, new = side(old_t), side(new_t)
    last = {r[2]: r for r in old}
    got = {(r.type, r.pos, r.prev_uid, r.similarity) for r in D.diff(spark.createDataFrame(old, s), spark.createDataFrame(new, s), ["doc"]).collect()}
    want = {("UNCHANGED", r[1], r[2], None) for r in new if r[2] in last}
    rest_n, rest_o = [r for r in new if r[2] not in last], [r for r in last.values() if r[2] not in {x[2] for x in new}]
    pairs = sorted(((similarity.ratio(o[5], n[5]), n, o) for n in rest_n for o in rest_o), key=lambda p: (-p[0], p[1][1], p[2][1]))
    used = set()
    for r, n, o in pairs:
        if r >= 0.5 and ("n", n[1]) not in used and ("o", o[1]) not in used:
            used |= {("n", n[1]), ("o", o[1])}
            want.add(("SLID" if r >= 0.92 else "MODIFIED", n[1], o[2], round(r, 4)))
    want |= {("ADDED", n[1], None, None) for n in rest_n if ("n", n[1]) not in used} | {("DELETED", None, o[2], None) for o in rest_o if ("o", o[1]) not in used}
    assert got == want


def test_large_documents_are_matched_in_rounds(spark, monkeypatch):
    rng = random.Random(3)
    pairs = [("k", i, j, round(rng.random(), 1)) for i in range(8) for j in range(8) if rng.random() < 0.6]
    df = spark.createDataFrame(pairs, "k string, left_id long, right_id long, similarity double")
    small = {(r.left_id, r.right_id) for r in D.best_first(df, ["k"]).collect()}
    monkeypatch.setattr(D, "GATHERED", 3)
    assert {(r.left_id, r.right_id) for r in D.best_first(df, ["k"]).collect()} == small


def test_definitions_inside_paragraphs(spark):
    quote = "\u201d"
    cases = {
        'Terms;  2.7.  "Brake" means x; 2.8.   "Wheel" means y:\n': [("2", "t", "Terms"), ("2.7", '"Brake" means x', '"Brake" means x'), ("2.8", '"Wheel" means y', '"Wheel" means y')],
        f"2.1.  {quote}Door lock{quote} means {'z' * 100}": [("2.1", '"Door lock"', f"{quote}Door lock{quote} means {'z' * 100}")],
        "none here": [("2", "t", "none here")],
    }
    df = spark.createDataFrame([(i, "2", "t", t) for i, t in enumerate(cases)], "id int, number string, title string, text string")
    got = segment.split_definitions(df).orderBy("id", "part").collect()
    for i, want in enumerate(cases.values()):
        assert [(r.number, r.title, r.text) for r in got if r.id == i] == want
    many = " ".join(f'2.{k}.  "T{k}" x' for k in range(1, 1500))
    assert segment.split_definitions(spark.createDataFrame([(1, "2", "t", many)], "id int, number string, title string, text string")).count() == 1499


def test_captions_and_labels(spark):
    box = spark.createDataFrame([("d", 1, [0.0, 100.0, 50.0, 150.0]), ("d", 2, [0.0, 100.0, 50.0, 150.0])], "doc string, page int, bbox array<double>")
    text = spark.createDataFrame(
        [("d", 1, [0.0, 160.0, 40.0, 170.0], "Overview of"), ("d", 1, [0.0, 171.0, 40.0, 180.0], "the lamp, see Fig. 3"), ("d", 1, [0.0, 80.0, 40.0, 90.0], "as in Table 4.2 below"), ("d", 2, [0.0, 160.0, 40.0, 170.0], "plain text")],
        "doc string, page int, bbox array<double>, text string",
    )
    assert {r.page: r.near for r in media.near_text(box, text, below=True).collect()} == {1: "Overview of\nthe lamp, see Fig. 3", 2: None}
    assert {r.page: r.near for r in media.near_text(box, text, below=False).collect()} == {1: "Table 4.2", 2: None}


def test_insertions_keep_their_place(spark):
    p = spark.createDataFrame([(f"{a}-{k}", "R1", "ADDED", f"u{a}", "9", "t", str(k)) for a in (1, 8, 32, 33, 3188) for k in (1, 2)], "id string, regulation string, type string, anchor_uid string, number string, title string, source_date string")
    got = proposals.inserted(frame(spark, [row(i, str(i)) for i in range(0, 4000)]), p).orderBy("pos").collect()
    uids = [r.uid for r in got]
    for a in (1, 8, 32, 33, 3188):
        at = uids.index(f"u{a}")
        assert uids[at + 1 : at + 3] == [f"PROPOSAL-{a}-1", f"PROPOSAL-{a}-2"]
    assert [r.pos for r in got] == list(range(4010))


def test_diff_golden_and_quirks(spark):
    s = "doc string, pos int, uid string, number string, title string, text string"
    old = spark.createDataFrame([("d", 0, "a", "1", "t", "same"), ("d", 1, "b", "2", "t", "the quick brown fox jumps over the dog"), ("d", 2, "c", "3", "t", "completely different sentence here"), ("d", 3, "x", "4", "t", "abcdefgh")], s)
    new = spark.createDataFrame([("d", 0, "a", "1", "t", "same"), ("d", 1, "b2", "2", "t", "the quick brown fox jumped over the dog"), ("d", 2, "n", "5", "t", "0123456789"), ("d", 3, "x", "4", "t", "zzzzzzz")], s)
    e = {r.uid: r for r in D.diff(old, new, ["doc"]).collect()}
    assert e["a"].type == "UNCHANGED" and e["n"].type == "ADDED" and e["c"].type == "DELETED" and e["x"].type == "UNCHANGED"
    assert e["b2"].type == "SLID" and e["b2"].prev_uid == "b" and e["b2"].similarity == round(similarity.ratio("the quick brown fox jumps over the dog", "the quick brown fox jumped over the dog"), 4)
    rep = D.report(D.diff(old, new, ["doc"]), ["doc"]).first()
    assert rep.summary == {"UNCHANGED": 2, "ADDED": 1, "DELETED": 1, "SLID": 1} and len(rep.changes) == 3
    a = {r.uid: r for r in D.applied(new.withColumn("status", F.lit("done")), D.diff(old, new, ["doc"]), ["doc"]).collect()}
    assert a["b2"].modified and a["b2"].status == "done" and not a["a"].modified
    assert D.diff(old.limit(0), new.limit(0), ["doc"]).count() == 0


def test_best_first_equals_greedy(spark):
    rng = random.Random(3)
    pairs = [("k", i, j, round(rng.random(), 1)) for i in range(8) for j in range(8) if rng.random() < 0.6]
    left, right, want = set(), set(), set()
    for _, i, j, s in sorted(pairs, key=lambda p: (-p[3], p[1], p[2])):
        if i not in left and j not in right:
            want.add((i, j))
            left.add(i)
            right.add(j)
    df = spark.createDataFrame(pairs, "k string, left_id long, right_id long, similarity double")
    assert {(r.left_id, r.right_id) for r in D.best_first(df, ["k"]).collect()} == want


def test_bounds_leave_few_pairs_and_lose_none(monkeypatch):
    rng = random.Random(9)
    words = "brake lamp door valve relay shall resist release within the of a test Where fewer than 23 of 8.9 kPa, (see B7) marked at 'Quartz' 第一 制動".split()
    text = lambda n: " ".join(f"{rng.choice(words)}{rng.randint(0, 999) if rng.random() < 0.2 else ''}" for _ in range(n))
    old = [text(rng.choice([20, 60, 90])) for _ in range(40)] + ["", "e" * 250 + "x", "ab" * 120, "".join(chr(33 + k % 90) for k in range(260))]
    new = [" ".join(w for w in t.split() if rng.random() < 0.8) for t in old[:20]] + [text(rng.choice([20, 60, 90])) for _ in range(20)] + ["e" * 240, "ba" * 130, "".join(chr(33 + k % 89) for k in range(250)), old[3]]
    for t in (0.5, 0.9):
        want = sorted((i, j, r) for i, a in enumerate(old) for j, b in enumerate(new) if (r := similarity.ratio(a, b)) >= t)
        assert sorted(similarity.ratios_at_least(old, new, t)) == want
    compared = []
    exact = similarity._matched
    monkeypatch.setattr(similarity, "_matched", lambda *x: compared.append(x) or exact(*x))
    letters = "etaoinshrdlucmfwypvbgkjqxz"
    odd = ["".join(rng.choices(letters + " ", range(27, 0, -1), k=400)) for _ in range(40)]  # long texts without anything in common
    assert list(similarity.ratios_at_least(odd[:20], odd[20:], 0.5)) == [] and len(compared) < 40


def test_few_bytes_of_pairs_are_spread_over_tasks(spark):
    rng = random.Random(4)
    rows = spark.createDataFrame([(f"d{d}", i, " ".join(rng.choice("abcdefgh") * 3 for _ in range(9))) for d in range(9) for i in range(4)], "doc string, id long, text string")
    pairs = similarity.similar_texts(rows, rows, ["doc"], 0.5)
    assert pairs.rdd.getNumPartitions() >= 16
    assert D.best_first(pairs, ["doc"]).filter("similarity >= 0").rdd.getNumPartitions() >= 16


def test_matching_is_done_once(spark):
    s = "doc string, pos int, uid string, number string, title string, text string"
    old, new = (spark.createDataFrame([("d", i, f"{u}{i}", "1", "t", f"the quick brown fox {i}{u}") for i in range(3)], s) for u in "ab")
    d = D.summary(D.diff(old, new, ["doc"]), ["doc"])
    assert [(r.type, r.n) for r in d.collect()] == [("SLID", 3)]
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("MapInArrow", "FlatMapGroupsInPandas", "FlatMapCoGroups"))


def test_near_duplicates(spark):
    t = "a footnote that repeats on every page of the annex"
    df = spark.createDataFrame([("k", 1, t), ("k", 2, t + "."), ("k", 3, "other"), ("q", 4, t), ("k", 5, None), ("k", 6, None)], "k string, id long, text string")
    assert {r.id for r in similarity.near_duplicates(df, ["k"]).collect()} == {1, 2, 5, 6}


def test_noise(spark):
    df = frame(spark, [row(0, "1", "Scope ............ 5", text="Scope ............ 5"), row(1, "1", "Scope"), row(2, "2", "Place ............", text="Place ............"), row(3, "106", "Annex 9", text="Annex 9"), row(4, "106", "Annex 9", text="Annex 9"), row(5, "3", "E/ECE/324", text="x"), row(6, "3", "Mass  kg  2", text="x")])
    assert {r.pos for r in noise.marked(df).filter("nav_hidden").collect()} == {0, 3, 4, 5, 6}


def test_segmentation(spark):
    text = "Contents\n1. Scope ..... 3\nE/ECE/1\n1.\nScope\nThis applies.\n0.7 Label\n2. Terms\nmeans; 2.7.  \"Brake\" means x; 2.8.  \"Wheel\" means y\npage 4\n2.9. More\n2.5. Back inside\ntail\n[[ANNEX:3]]\nAnnex 3\nLead in\n[[IMG:i1]]\nlost\n1. General\nbody"
    df = spark.createDataFrame([(1, "R1", text), (2, "R1", None), (3, None, "")], "doc_id long, regulation string, text string")
    got = segment.paragraphs(df).orderBy("pos").collect()
    assert [r.doc_id for r in got] == [1] * len(got) and [r.pos for r in got] == list(range(len(got)))
    numbers = [r.number for r in got]
    assert "0.7" not in numbers and "2.7" in numbers and "2.8" in numbers and numbers[-1] == "1"
    assert got[-1].annex_id == 3 and any(r.type == "image" and r.uid == "i1" for r in got) and not any("lost" in (r.text or "") for r in got)
    assert any(r.number == "" and "Lead in" in (r.text or "") for r in got)


def test_annexes_of_raw_texts_are_filled_in(spark):
    text = "1 Scope ..... 3\nCONTENTS\n1. Scope\nApplies.\n2. Terms\nMeans.\n[[ANNEX:3]]\n1. General\n[[IMG:x]]\n1) a note\nbody\n2. More\nend"
    docs = spark.createDataFrame([(1, "R1", text), (2, "R2", None), (3, "R1", "")], "doc_id long, regulation string, text string")
    known = segment.annex_map(docs)
    uid = lambda t: spark.range(1).select(B.uid(F.lit("R1"), F.lit(t)).alias("u")).first().u
    assert {(r.uid, r.annex_id) for r in known.collect()} == {(uid("General 1) a note body"), 3), (uid("More end"), 3)}
    rows = frame(spark, [row(0, "1", uid=uid("General 1) a note body")), row(1, "1", uid=uid("Scope Applies."), annex_id=5), row(2, type="image", uid=uid("More end"), annex_id=7)])
    assert [r.annex_id for r in segment.annex_backfill(rows, known).orderBy("pos").collect()] == [3, 5, 7]


def test_references(spark):
    cases = {
        "paragraph 5.1. of Annex 4": [("5.1", 4)], "paragraph 5.2 of this Regulation": [("5.2", None)], "paragraphs 1.2., 1.3., and 1.4.": [("1.2", 9), ("1.3", 9), ("1.4", 9)],
        "paragraph 5": [], "paragraph 2.1 of Part A of Annex 3": [("2.1", 3)], "paragraph 5 of Annex 2": [("5", 2)], "paragraphs 5.1 and 5.2 of Annex 4": [("5.1", 9), ("5.2", 9)],
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", references.extracted(F.col("t"), F.lit(9)).alias("r"))
    for r in df.collect():
        assert [(x.number, x.annex) for x in r.r] == cases[r.t], r.t
    rows = frame(spark, [row(0, "5.1", summary_ja="要約。"), row(1, "6", text="see paragraph 5.1. above"), row(2, "7", text="see paragraph 9.9. above")])
    assert [(r.pos, r.target_uid) for r in references.resolved(rows).collect()] == [(1, "u0")]


def test_glossary(spark):
    assert glossary.spans("Brake lining of brake linings", ["brake", "brake lining"], True) == [(0, 12, "brake lining"), (16, 28, "brake lining")]
    g = spark.createDataFrame([("R1", "brake", "制動", None, "d", "1", ["b"]), ("R1", None, None, None, None, None, None)], "regulation string, term string, ja string, description string, definition_en string, paragraph_ref string, aliases array<string>")
    rows = spark.createDataFrame([(1, "R1", "a <Brake>"), (2, "R2", "brake"), (3, "R1", None)], "block_id long, regulation string, text string")
    m = glossary.matches(rows, glossary.english_terms(g)).collect()
    assert [(r.block_id, r.start, r.end) for r in m] == [(1, 3, 8)]
    x = rows.filter("block_id = 1").select(glossary.annotated(F.col("text"), F.array(F.struct(F.lit(3).alias("start"), F.lit(8).alias("end"), F.lit("brake").alias("term")))).alias("h")).first().h
    assert x == 'a &lt;<span class="term" data-term="brake">Brake</span>&gt;'
    assert "（別称: b）" in glossary.prompt_table(g).first().glossary_block


def test_proposals(spark):
    p = spark.createDataFrame(
        [("1", "R1", "MODIFIED", "u0", None, "1", "t", "n", "j", "2020-01-01", "s", datetime(2020, 1, 1)), ("2", "R1", "DELETED", "u0", None, "1", "t", "n", "j", "2021-01-01", "s", datetime(2020, 1, 1)), ("3", "R1", "ADDED", None, "u0", "1.9", "t", "n", "j", None, "s", datetime(2020, 1, 1)), ("3", "R1", "ADDED", None, "u0", "1.9", "late", "n", "j", None, "s", datetime(2021, 1, 1))],
        "id string, regulation string, type string, target_uid string, anchor_uid string, number string, title string, text_new string, justification string, source_date string, source_label string, loaded_at timestamp",
    )
    p = proposals.latest(p)
    rows = frame(spark, [row(0, "1"), row(1, "2")])
    assert [x.id for x in proposals.attached(rows, p).filter("uid = 'u0'").first().proposals] == ["2", "1"]
    got = proposals.inserted(rows, p).orderBy("pos").collect()
    assert [r.uid for r in got] == ["u0", "PROPOSAL-3", "u1"] and got[1].title == "late" and got[1].status == "proposal" and [r.pos for r in got] == [0, 1, 2]


def test_page_hides_contents_and_marks_japanese(spark):
    p = spark.createDataFrame([], "id string, regulation string, type string, target_uid string, anchor_uid string, number string, title string, text_new string, justification string, source_date string, source_label string, loaded_at timestamp")
    g = spark.createDataFrame([("R1", "brake", "制動", "", "")], "regulation string, term string, ja string, description string, paragraph_ref string")
    names = spark.createDataFrame([("R1", "v", {"5": ("Five", "")}), ("R2", "v", {"5": ("Five", "")})], "regulation string, version string, annex_titles map<string, struct<title string, title_ja string>>")
    titles = ["Scope", "Needs", "Annexes", "Form", "Marks", "Preamble", "Purpose", "Brakes"]
    doc = [row(i, n, t, t if i in (2, 3, 4) else f"{t} of the brake {'word ' * 20}", uid=f"u{i}") for i, (n, t) in enumerate(zip(["1", "2", "47", "1", "2", "3", "1", "1.1"], titles))]
    doc[7]["translation"] = "車両の<制動>"
    # the annex ids of the second document contradict its table of contents
    rows = frame(spark, doc + [d | {"regulation": "R2", "annex_id": 5 if d["pos"] == 6 else None} for d in doc]).withColumn("modified", F.lit(False))
    got = report.page_model(rows, p, g, names).collect()
    assert {(r.regulation, r.pos) for r in got if r.nav_hidden} == {("R1", 2), ("R1", 3), ("R1", 4), ("R2", 2)}
    assert {(r.regulation, r.annex) for r in structure.annex_tree(rows, names).collect()} == {("R1", 1), ("R1", 2), ("R1", 3), ("R2", 5)}
    assert {(r.pos, r.annex_title) for r in got if r.annex_title} <= {(r.pos, r.annex_title) for r in got if r.annex is not None} and {r.divider for r in got if r.divider} >= {"chapter 1", "chapter 2"}
    ja = {(r.regulation, r.pos): r.translation_annotated for r in got}
    assert ja["R1", 7] == '車両の&lt;<span class="term" data-term="制動">制動</span>&gt;' and ja["R1", 6] is None


def test_enrichment(spark):
    rows = frame(spark, [row(i, "1", text=f"t{i}") for i in range(25)])
    b = enrich.batches(enrich.body_targets(rows), 10).groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [r["count"] for r in b] == [10, 10, 5]

    def call(batch):
        if any(r["pos"] == 3 for r in batch):
            raise ValueError("no")
        return [{"translation": r["text"].upper()} for r in batch]

    got = enrich.enriched(rows.coalesce(1).orderBy("pos"), call, 5, ("translation",))
    back = enrich.written_back(rows, got, ("translation",))
    assert back.filter("status = 'error'").count() == 5 and back.filter("translation = 'T20' and status = 'done'").count() == 1
    waits, calls = [], []

    def throttled(_):
        calls.append(1)
        if len(calls) < 3:
            raise enrich.Throttled(1.0)
        return [{}]

    assert enrich.patient(throttled, pause=waits.append)([]) == [{}] and waits == [3.0, 3.0]
    with pytest.raises(enrich.Throttled):
        enrich.patient(lambda _: (_ for _ in ()).throw(enrich.Throttled(0)), retries=1, pause=lambda s: None)([])
    r = spark.createDataFrame([('```json\n{"a": " x "}\n```',), ("none",)], "t string").select(enrich.reply_json(F.col("t"), "a string").alias("j")).collect()
    assert r[0].j.a == "x" and r[1].j is None
    shown = enrich.preview(enrich.body_targets(rows), 4).collect()
    assert sorted(x.pos for x in shown) == [0, 1, 2, 3] and {x.n_more for x in shown} == {21}
    assert "| a |" in spark.createDataFrame([("| a |",)], "g string").select(enrich.system_prompt(F.col("g")).alias("p")).first().p
    tr = spark.createDataFrame([("1", "題", "訳")], "number string, title_ja string, translation string")
    assert enrich.mapped(rows, tr, 2, 4).filter("status = 'translated'").count() == 2


def test_media(spark):
    lines = spark.createDataFrame([("d", 1, 0.0, y, 100.0, y) for y in (0.0, 30.0, 60.0)] + [("d", 1, x, 0.0, x, 60.0) for x in (0.0, 50.0, 100.0)], "doc string, page int, x0 double, y0 double, x1 double, y1 double")
    t = media.table_boxes(lines)
    assert t.first().bbox == [0.0, 0.0, 100.0, 60.0]
    items = spark.createDataFrame([("d", 1, [90.0, 50.0, 120.0, 70.0], 1, "in"), ("d", 1, [0.0, 80.0, 50.0, 90.0], 2, "Figure 3 below"), ("d", 2, [0.0, 0.0, 5.0, 5.0], 3, "other page")], "doc string, page int, bbox array<double>, ordinal int, text string")
    out = media.outside(items, t, 2.0)
    assert {r.ordinal for r in out.collect()} == {2, 3}
    assert media.near_text(t, items, below=True).first().near == "Figure 3 below"
    batch = enrich.batches(frame(items.sparkSession, [row(i) for i in range(3)]), 2)
    assert sorted(r.batch_no for r in batch.collect()) == [0, 0, 1]
    order = media.reading_order(out, t.withColumn("ordinal", F.lit(9)).withColumn("uid", F.lit("i")))
    assert [r.body for r in order.filter("page = 1").orderBy("ord").collect()] == ["[[IMG:i]]", "Figure 3 below"]
    marks = media.annex_marks(spark.createDataFrame([("d", 1, None), ("d", 2, 3), ("d", 3, None), ("d", 4, 3), ("d", 5, 4)], "doc string, page int, annex int"))
    assert {(r.page, r.annex) for r in marks.collect()} == {(2, 3), (5, 4)}
    assert "[[IMG:i]]" in media.marked_text(order, marks).filter("page = 1").first().text
    pg = spark.createDataFrame([("E/ECE/1\npage 3\nRegulation No. 13\nAnnex 4\nx",), ("Annex 4",), ("E/ECE/1\nAnnex 4, paragraph 2",)], "t string").select(media.page_annex(F.col("t")).alias("a"))
    assert [r.a for r in pg.collect()] == [4, None, None]


def test_reports_and_sources(spark, tmp_path):
    rows = frame(spark, [row(0, "1", status="done"), row(1, "2"), row(2, type="image")])
    assert report.progress(rows).first().progress == 50
    v = spark.createDataFrame([("R1", "Rev9"), ("R1", "Rev10"), ("R1", "diff")], "regulation string, version string")
    assert report.latest_versions(v).first().version == "Rev9" and report.latest_versions(v, natural=True).first().version == "Rev10"
    docs = documents.nested(rows, spark.createDataFrame([("R1", "v", "2020-01-01", "t", None)], "regulation string, version string, source_date string, title string, annex_titles map<string, struct<title string, title_ja string>>"))
    documents.write_json(docs, f"{tmp_path}/out")
    back = documents.blocks(documents.documents(spark, f"{tmp_path}/out/*/*/*.json"))
    assert back.count() == 3 and back.filter("pos = 0").first().number == "1"
    assert documents.glossary(spark, f"{tmp_path}/absent.json").count() == 0 and documents.catalog(spark, f"{tmp_path}/absent").count() == 0
    idx = report.index_rows(rows.withColumn("version", F.lit("Rev9")), v)
    assert "R1 Rev9 1/2 50 %" in pages.index_page(idx).first().html


def test_stream_takes_late_rows_once(spark, tmp_path):
    from codexgrid.streaming import pending

    s = "block_id long, type string, status string, loaded_at timestamp"
    spark.createDataFrame([(1, None, "untranslated", datetime(2024, 1, 1)), (1, None, "untranslated", datetime(2024, 1, 2)), (2, None, "done", datetime(2024, 1, 1))], s).write.parquet(f"{tmp_path}/in")
    q = pending.enrich_stream(pending.pending(spark, f"{tmp_path}/in"), lambda b: b.withColumn("x", F.lit(1)), f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(120)
    assert [r.block_id for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [1]


SNAP = "regulation string, snap_no int, uid string, prev_uid string, text string, loaded_at timestamp, row_id long, kind string"


def test_snapshot_changes(spark):
    t = datetime(2024, 1, 1)
    rows = [
        ("R1", 1, "A", None, "x", t, 1, "k"), ("R1", 1, "B", None, "y", t, 2, "k"), ("R1", 1, "C", None, "z", t, 3, "k"), ("R1", 1, "G", None, "g", t, 3, "k"),
        ("R1", 3, " a ", None, "x  ", t, 4, "k"), ("R1", 3, "b", None, "y2", t, 5, "k"), ("R1", 3, "d", "c", "z2", t, 6, "k"), ("R1", 3, "d", "c", "z2", t, 7, "k"), ("R1", 3, None, None, "n", t, 8, "k"), ("R1", 3, "", None, None, t, 9, "k"),
        ("R1", 4, "g", None, "g", t, 10, "k"), (None, 4, "g", None, "g", t, 10, "k"),
    ]
    got = {(r.snap_no, r.uid, r.change_kind) for r in snapshot_changes(spark.createDataFrame(rows, SNAP)).collect()}
    assert got == {(3, "b", "changed"), (3, "d", "changed"), (3, "g", "removed"), (4, "g", "added"), (4, "a", "removed"), (4, "b", "removed"), (4, "d", "removed")}
    assert snapshot_changes(spark.createDataFrame([], SNAP)).count() == 0
