"""Registered queries of composed operators: chapters, annexes, references, enrichment, pages; with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from codexgrid.functions import blocks as B
from codexgrid.functions.text import WS
from codexgrid.operators import diff, enrich, glossary, proposals, references, report, segment, structure
from codexgrid.operators.ordered import DOC
from codexgrid.plans.materialize import scratch, written
from codexgrid.plans.registry import BLOCKS, COL, blocks, register, versions
from codexgrid.sources import documents, pages
from codexgrid.sources.tables import table

STRUCTURE = "regulation version pos type number level parent title title_ja text annex_id"


# what several twins share ---------------------------------------------------------------------------------------------


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{WS}+|{WS}+$', '', 'g')"


def without_leader(x: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({x}, ''), '(?s)\\s*\\.{{4,}}.*', ''), '[. ]+$', '')"


def bare(x: str) -> str:
    return strip(f"regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), '[.…]{{2,}}', ' ', 'g'), '\\s+\\d+\\s*$', ''), '\\s+', ' ', 'g')")


def toc_like(title: str = "title", text: str = "text") -> str:
    return f"length({bare(text)}) <= length({bare(title)}) + 20"


WORK = BLOCKS.replace("WITH b", "WITH RECURSIVE b", 1)
TOP = "try_cast(split_part(number, '.', 1) AS INT)"
IMAGE = "coalesce(type, 'paragraph') = 'image'"
ONE = "PARTITION BY regulation, version ORDER BY pos"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

CHAPTERS = f"""h AS (SELECT regulation, version, pos, number, {without_leader('title')} AS title, {without_leader('title_ja')} AS title_ja, {toc_like()} AS toc,
  CASE WHEN regexp_full_match(number, '\\d+') THEN try_cast(number AS INT) END AS n FROM b WHERE NOT {IMAGE} AND level = 1),
chain AS (SELECT regulation, version, 1 AS n, min(pos) AS pos FROM h WHERE n = 1 GROUP BY ALL
  UNION ALL SELECT c.regulation, c.version, c.n + 1, (SELECT min(h.pos) FROM h WHERE h.regulation = c.regulation AND h.version = c.version AND h.n = c.n + 1 AND h.pos > c.pos) FROM chain c WHERE c.pos IS NOT NULL),
closing AS (SELECT c.regulation, c.version, min(h.pos) AS closed FROM chain c JOIN h ON h.regulation = c.regulation AND h.version = c.version AND h.n = c.n AND h.pos > c.pos GROUP BY ALL),
taken AS (SELECT c.* FROM chain c LEFT JOIN closing k USING (regulation, version) WHERE c.pos IS NOT NULL AND (closed IS NULL OR c.pos < closed))"""

BOUNDARY = f"""bt AS (SELECT *, {TOP} AS top FROM b WHERE NOT {IMAGE} AND {TOP} > 0),
bb AS (SELECT *, max(CASE WHEN level >= 2 THEN 1 ELSE 0 END) OVER ({ONE}) AS body FROM bt),
bm AS (SELECT *, coalesce(max(CASE WHEN body = 1 THEN top END) OVER ({ONE} {BEFORE}), 0) AS most, coalesce(max(top) OVER ({ONE} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later FROM bb),
begun AS (SELECT regulation, version, min(pos) AS start FROM bm WHERE body = 1 AND most >= 2 AND top < most // 2 + 1 AND later <= most GROUP BY ALL)"""

ANNEXES = f"""{CHAPTERS}, {BOUNDARY},
last AS (SELECT regulation, version, max(n) AS last_chapter FROM taken GROUP BY ALL),
own AS (SELECT b.regulation, b.version, b.pos, {TOP} AS t FROM b LEFT JOIN last USING (regulation, version) WHERE NOT {IMAGE} AND {TOP} BETWEEN 1 AND coalesce(last_chapter, 12) AND NOT contains(coalesce(title, ''), '......') AND NOT contains(coalesce(text, ''), '......')
  AND NOT starts_with({strip('text')}, 'E/ECE/') AND NOT starts_with({strip('title')}, 'E/ECE/') AND NOT {toc_like()}),
ending AS (SELECT regulation, version, arg_max(p, t) AS body_end FROM (SELECT regulation, version, t, max(pos) AS p FROM own GROUP BY ALL) GROUP BY ALL),
a1 AS (SELECT b.*, body_end, coalesce(b.pos >= start AND NOT {IMAGE}, false) AS inside, try_cast(regexp_extract({strip('title')}, '(?i)^Annex\\s+(\\d+)\\b', 1) AS INT) AS named FROM b LEFT JOIN ending USING (regulation, version) LEFT JOIN begun USING (regulation, version)),
a2 AS (SELECT *, CASE WHEN pos > body_end AND NOT {IMAGE} AND coalesce(level, 1) = 1 AND named >= 10 AND (annex_id IS NULL OR annex_id >= named) THEN named END AS ten FROM a1),
a3 AS (SELECT *, min(CASE WHEN ten IS NOT NULL THEN pos END) OVER (PARTITION BY regulation, version) AS ten_from FROM a2),
a4 AS (SELECT *, coalesce(pos > body_end AND (ten_from IS NULL OR pos < ten_from), false) AS early FROM a3),
e1 AS (SELECT regulation, version, pos, {TOP} AS top FROM a4 WHERE early AND NOT {IMAGE} AND {TOP} > 0),
e2 AS (SELECT *, lag(top) OVER ({ONE}) AS before FROM e1),
e3 AS (SELECT regulation, version, pos, sum(CASE WHEN top < before AND before > 1 THEN 1 ELSE 0 END) OVER ({ONE}) AS g FROM e2),
a5 AS (SELECT a4.*, last_value(e3.g IGNORE NULLS) OVER (PARTITION BY a4.regulation, a4.version ORDER BY a4.pos) AS g, last_value(ten IGNORE NULLS) OVER (PARTITION BY a4.regulation, a4.version ORDER BY a4.pos) AS opened FROM a4 LEFT JOIN e3 USING (regulation, version, pos)),
a6 AS (SELECT * EXCLUDE (inside), CASE WHEN {IMAGE} THEN NULL WHEN early THEN CASE WHEN g + 1 > 9 THEN 9 ELSE g + 1 END ELSE opened END AS plain, inside FROM a5),
a7 AS (SELECT * EXCLUDE (inside), inside OR plain IS NOT NULL AS inside, NOT {IMAGE} AND (ten_from IS NULL OR pos < ten_from) AS counted FROM a6),
a8 AS (SELECT *, coalesce(sum(CASE WHEN counted THEN CASE WHEN inside THEN 0 ELSE 1 END END) OVER ({ONE}), 0) AS island FROM a7),
a9 AS (SELECT *, last_value(CASE WHEN counted AND inside AND annex_id IS NOT NULL THEN {{'i': island, 'a': annex_id}} END IGNORE NULLS) OVER ({ONE}) AS known FROM a8),
an AS (SELECT * EXCLUDE (inside), CAST(coalesce(CASE WHEN {IMAGE} AND body_end IS NOT NULL THEN annex_id END, CASE WHEN counted AND inside AND body_end IS NOT NULL AND known.i = island THEN known.a END, plain) AS INT) AS annex,
  inside OR coalesce({IMAGE} AND body_end IS NOT NULL AND annex_id IS NOT NULL, false) AS in_annex FROM a9)"""

HEADER = r"(?i)^Annex\s+\d+\s*(?:[-–—]\s*Appendix\s+(\d+)\s*)?$"
KIND = f"CASE WHEN NOT {IMAGE} AND regexp_full_match({strip('number')}, '\\d{{3,}}') AND regexp_matches({strip('title')}, '{HEADER}') THEN CASE WHEN regexp_extract({strip('title')}, '{HEADER}', 1) = '' THEN 0 ELSE try_cast(regexp_extract({strip('title')}, '{HEADER}', 1) AS INT) END END"


# chapters and annexes -------------------------------------------------------------------------------------------------


@register(
    "chapter_list",
    f"""{WORK}, {CHAPTERS},
given AS (SELECT t.regulation, t.version, t.pos, arg_min(h.title, h.pos) AS title, arg_min(h.title_ja, h.pos) AS title_ja FROM taken t JOIN h ON h.regulation = t.regulation AND h.version = t.version AND h.n = t.n AND h.pos > t.pos AND h.title_ja <> '' GROUP BY ALL)
SELECT h.regulation, h.version, h.pos, h.number AS chapter, CASE WHEN h.title_ja = '' AND g.title IS NOT NULL THEN g.title ELSE h.title END AS title, CASE WHEN h.title_ja = '' AND g.title IS NOT NULL THEN g.title_ja ELSE h.title_ja END AS title_ja, h.n IS NOT NULL AND t.n IS NULL AS toc_row
FROM h LEFT JOIN closing k USING (regulation, version) LEFT JOIN taken t ON t.regulation = h.regulation AND t.version = h.version AND t.pos = h.pos LEFT JOIN given g ON g.regulation = h.regulation AND g.version = h.version AND g.pos = h.pos
WHERE (closed IS NULL OR h.pos < closed) AND (h.n IS NULL OR t.n IS NOT NULL OR h.toc)""",
)
def chapter_list(spark, sf_dir):
    return structure.chapters(blocks(spark, sf_dir, STRUCTURE))


@register("annex_numbers", f"{WORK}, {ANNEXES} SELECT regulation, version, pos, annex, in_annex FROM an")
def annex_numbers(spark, sf_dir):
    d = written(blocks(spark, sf_dir, STRUCTURE), "annex-blocks")
    last = written(structure.last_chapters(d), "annex-chapters")
    return structure.annex_ids(structure.in_annex(d), last).select(*DOC, "pos", "annex", "in_annex")


@register(
    "annex_parts",
    f"""{WORK}, {ANNEXES},
p1 AS (SELECT *, coalesce(number, '') AS num, coalesce(level = 1 AND regexp_full_match(coalesce(number, ''), '[A-Ja-j]'), false) AS letter, CASE WHEN {KIND} > 0 THEN {KIND} END AS kind FROM an WHERE in_annex AND annex IS NOT NULL),
p2 AS (SELECT *, bool_or(letter) OVER (PARTITION BY regulation, version, annex) AS alpha, bool_or(kind IS NOT NULL) OVER (PARTITION BY regulation, version, annex) AS app, kind IS NOT NULL AND pos = min(pos) OVER (PARTITION BY regulation, version, annex, kind) AS heads FROM p1),
r1 AS (SELECT regulation, version, annex, pos, lag(pos) OVER (PARTITION BY regulation, version, annex, number ORDER BY pos) AS same FROM p2 WHERE NOT alpha AND NOT app AND level = 1 AND num <> ''),
r2 AS (SELECT regulation, version, annex, 0 AS k, min(pos) AS pos FROM r1 GROUP BY ALL UNION ALL SELECT s.regulation, s.version, s.annex, s.k + 1, (SELECT min(r1.pos) FROM r1 WHERE r1.regulation = s.regulation AND r1.version = s.version AND r1.annex = s.annex AND r1.same >= s.pos) FROM r2 s WHERE s.pos IS NOT NULL),
r3 AS (SELECT r1.regulation, r1.version, r1.annex, r1.pos, max(r2.k) AS k FROM r1 JOIN r2 ON r2.regulation = r1.regulation AND r2.version = r1.version AND r2.annex = r1.annex AND r2.pos <= r1.pos GROUP BY ALL),
p3 AS (SELECT p2.*, CASE WHEN alpha AND letter THEN ascii(upper(num)) - 65 WHEN NOT alpha AND app AND heads THEN kind ELSE r3.k END AS opens, CASE WHEN alpha THEN letter WHEN app THEN heads ELSE false END AS part_header FROM p2 LEFT JOIN r3 USING (regulation, version, annex, pos)),
p4 AS (SELECT *, coalesce(last_value(opens IGNORE NULLS) OVER (PARTITION BY regulation, version, annex ORDER BY pos), 0) AS part_idx FROM p3),
p5 AS (SELECT *, max(part_idx) OVER (PARTITION BY regulation, version, annex) > 0 AS multiple_parts, NOT alpha AND app AS by_app, min(CASE WHEN NOT {IMAGE} AND NOT coalesce(alpha AND level = 1 AND num = '', false) THEN pos END) OVER (PARTITION BY regulation, version, annex, part_idx) = pos AS begins FROM p4),
p6 AS (SELECT *, CASE WHEN by_app THEN CAST(part_idx AS VARCHAR) WHEN part_idx < 26 THEN chr(CAST(part_idx + 65 AS INT)) ELSE CAST(part_idx + 1 AS VARCHAR) END AS part_label FROM p5)
SELECT regulation, version, pos, CAST(part_idx AS INT) AS part_idx, part_label, CASE WHEN by_app THEN '追補' ELSE 'Part' END AS part_prefix, coalesce(begins, false) AS part_first, part_header, multiple_parts,
  CASE WHEN alpha AND multiple_parts AND num <> '' AND NOT part_header THEN part_label || '-' || num WHEN by_app AND part_header THEN '追補' || part_idx ELSE num END AS display_number FROM p6
UNION ALL SELECT regulation, version, pos, 0, '', 'Part', false, false, false, coalesce(number, '') FROM an WHERE NOT (in_annex AND annex IS NOT NULL)""",
)
def annex_parts(spark, sf_dir):
    d = written(blocks(spark, sf_dir, STRUCTURE), "annex-blocks")
    last = written(structure.last_chapters(d), "annex-chapters")
    d = structure.annex_ids(structure.in_annex(d), last)
    return structure.annex_parts(d).select(*DOC, "pos", "part_idx", "part_label", "part_prefix", "part_first", "part_header", "multiple_parts", "display_number")


@register(
    "annex_tree",
    f"""{WORK}, p AS (SELECT *, sum(CASE WHEN number = '1' THEN 1 ELSE 0 END) OVER ({ONE}) AS k, {without_leader(strip('title'))} AS clean, CASE WHEN regexp_full_match(coalesce(number, ''), '\\d+') THEN try_cast(number AS INT) END AS n FROM b WHERE NOT {IMAGE}),
found AS (SELECT regulation, version, n AS annex, arg_min(clean, pos) AS title, arg_min({without_leader('title_ja')}, pos) AS title_ja FROM p WHERE k = 2 AND n BETWEEN 1 AND 22 AND NOT starts_with(lower(clean), 'appendix') GROUP BY ALL),
ids AS (SELECT regulation, version, list_sort(list(DISTINCT CAST(annex_id AS INT))) AS ids FROM p WHERE annex_id IS NOT NULL GROUP BY ALL),
own AS (SELECT regulation, version, list_sort(list(DISTINCT annex)) AS own FROM found GROUP BY ALL),
state AS (SELECT v.regulation, v.version, ids, annex_titles FROM doc_versions v JOIN ids USING (regulation, version) LEFT JOIN own USING (regulation, version) WHERE cardinality(annex_titles) > 0 AND (own IS NULL OR own <> ids)),
other AS (SELECT regulation, version, unnest(ids) AS annex, annex_titles FROM state)
SELECT * FROM found WHERE NOT EXISTS (SELECT 1 FROM state s WHERE s.regulation = found.regulation AND s.version = found.version)
UNION ALL SELECT regulation, version, annex, {strip("annex_titles[CAST(annex AS VARCHAR)]['title']")}, {strip("annex_titles[CAST(annex AS VARCHAR)]['title_ja']")} FROM other""",
)
def annex_tree(spark, sf_dir):
    return structure.annex_tree(blocks(spark, sf_dir, STRUCTURE), versions(spark, sf_dir))


@register(
    "annex_restart_rows",
    f"""{BLOCKS}, p AS (SELECT *, {TOP} AS top, contains(coalesce(text, ''), '....') OR contains(coalesce(title, ''), '....') AS dotted FROM b WHERE coalesce(type, 'paragraph') = 'paragraph'),
e AS (SELECT regulation, version, max(pos) AS body_end FROM p WHERE top = 3 AND NOT dotted AND NOT starts_with({strip('text')}, 'E/ECE/') AND NOT starts_with({strip('title')}, 'E/ECE/') GROUP BY ALL),
d0 AS (SELECT p.*, min(CASE WHEN coalesce(level, 1) = 1 AND regexp_matches({strip('title')}, '^Annex\\s+1\\d\\b') THEN pos END) OVER (PARTITION BY regulation, version) AS stop FROM p JOIN e USING (regulation, version) WHERE pos > body_end),
d AS (SELECT *, coalesce(lag(top) OVER ({ONE}), 3) AS before FROM d0 WHERE (stop IS NULL OR pos < stop) AND top > 0),
g AS (SELECT *, sum(CASE WHEN top < before AND before > 1 THEN 1 ELSE 0 END) OVER ({ONE}) AS grp FROM d),
f AS (SELECT regulation, version, grp, row_number() OVER (PARTITION BY regulation, version ORDER BY min(pos)) AS rank FROM g GROUP BY regulation, version, grp HAVING avg(CASE WHEN contains(CASE WHEN coalesce(text, '') <> '' THEN text ELSE coalesce(title, '') END, '....') THEN 1.0 ELSE 0.0 END) < 0.4)
SELECT g.block_id, g.regulation, g.version, g.pos FROM g JOIN f USING (regulation, version, grp) WHERE rank = 1""",
)
def annex_restart_rows(spark, sf_dir):
    return structure.annex_rows(blocks(spark, sf_dir, STRUCTURE), 4, last_chapter=3).select("block_id", *DOC, "pos")


@register(
    "form_groups",
    f"""{BLOCKS}, t AS (SELECT *, {TOP} AS top FROM b WHERE NOT {IMAGE} AND {TOP} > 0), l AS (SELECT *, lag(top) OVER ({ONE}) AS before FROM t), g AS (SELECT *, sum(CASE WHEN top < before AND before > 1 THEN 1 ELSE 0 END) OVER ({ONE}) AS restart_group FROM l)
SELECT regulation, version, CAST(restart_group AS INT) AS restart_group, avg(CASE WHEN contains(CASE WHEN coalesce(text, '') <> '' THEN text ELSE coalesce(title, '') END, '....') THEN 1.0 ELSE 0.0 END) >= 0.4 AS form FROM g GROUP BY ALL""",
)
def form_groups(spark, sf_dir):
    d = structure.restart_groups(blocks(spark, sf_dir, "regulation version pos type number title text")).filter("restart_group is not null")
    return structure.form_groups(d)


@register(
    "immediate_children",
    f"""{BLOCKS}, l AS (SELECT block_id, {strip('number')} AS num, """
    + ", ".join(f"lead({{'t': coalesce(type, 'paragraph'), 'p': {strip('parent')}, 'l': level}}, {k}) OVER ({ONE}) AS x{k}" for k in (1, 2, 3))
    + """ FROM b) SELECT block_id, coalesce("""
    + "".join(f"CASE WHEN x{k} IS NOT NULL AND x{k}.t <> 'image' AND x{k}.p = num THEN true WHEN x{k} IS NOT NULL AND x{k}.t <> 'image' AND x{k}.l = 1 THEN false ELSE " for k in (1, 2, 3))
    + "false END END END, false) AS has_child FROM l",
)
def immediate_children(spark, sf_dir):
    return structure.immediate_child(blocks(spark, sf_dir, "regulation version pos type number parent level")).select("block_id", "has_child")


@register(
    "annex_selection",
    f"""{BLOCKS}, f AS (SELECT *, NOT {IMAGE} AND coalesce(number, '') <> '' AS vis FROM b WHERE annex_id = 2),
g AS (SELECT *, coalesce(number, '') = '' OR (vis AND pos = min(CASE WHEN vis THEN pos END) OVER (PARTITION BY regulation, version, number)) AS first FROM f) SELECT block_id, level > 3 AS collapsed FROM g WHERE first""",
)
def annex_selection(spark, sf_dir):
    d = blocks(spark, sf_dir, "regulation version pos type number level annex_id").withColumnRenamed("annex_id", "annex")
    return report.annex_selection(structure.first_occurrence(d), 2).select("block_id", "collapsed")


@register(
    "first_occurrence_annex",
    f"""{BLOCKS}, f AS (SELECT *, NOT {IMAGE} AND coalesce(number, '') <> '' AS vis FROM b)
SELECT block_id, annex_id IS NULL OR coalesce(number, '') = '' OR (vis AND pos = min(CASE WHEN vis THEN pos END) OVER (PARTITION BY regulation, version, annex_id, number)) AS first_occ_annex FROM f""",
)
def first_occurrence_annex(spark, sf_dir):
    d = blocks(spark, sf_dir, "regulation version pos type number annex_id").withColumnRenamed("annex_id", "annex")
    return structure.first_occurrence(d).select("block_id", "first_occ_annex")


@register(
    "row_marks",
    f"""{BLOCKS} SELECT block_id, length(coalesce(title, '')) < 50 AND regexp_matches(coalesce(title, ''), '\\s{{2,}}\\S+\\s{{2,}}\\d\\s*$') AS cell, {KIND} AS header_kind,
coalesce(NOT {IMAGE} AND level = 1 AND annex_id IS NOT NULL AND regexp_full_match({strip('number')}, '\\d{{1,2}}') AND length({strip('title')}) >= 60 AND NOT contains({strip('title')}, '......') AND NOT contains(coalesce(text, ''), '......') AND NOT regexp_matches({strip('title')}, '[:：]$'), false) AS footnote FROM b""",
)
def row_marks(spark, sf_dir):
    d = blocks(spark, sf_dir, "type number level title text annex_id")
    note = B.footnote_candidate(COL("type"), F.lit(False), COL("level"), COL("annex_id"), COL("number"), COL("title"), COL("text"))
    return d.select("block_id", B.table_cell(COL("title")).alias("cell"), B.page_header_kind(COL("type"), COL("number"), COL("title")).alias("header_kind"), F.coalesce(note, F.lit(False)).alias("footnote"))


@register("headers_stripped", f"""{BLOCKS} SELECT block_id, CASE WHEN coalesce(text, '') = '' OR {strip('title')} = '' THEN text ELSE {strip("regexp_replace(" + strip('text') + ", '(?i)^(?:' || regexp_escape(" + strip('title') + ") || '\\s*[-–—:：]?\\s*)+', '')")} END AS body FROM b WHERE text IS NOT NULL""")
def headers_stripped(spark, sf_dir):
    return blocks(spark, sf_dir, "title text").filter("text is not null").select("block_id", B.strip_repeated_header(COL("text"), COL("title")).alias("body"))


@register("escaped_texts", f"{BLOCKS} SELECT block_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS html FROM b WHERE text IS NOT NULL")
def escaped_texts(spark, sf_dir):
    return blocks(spark, sf_dir, "text").filter("text is not null").select("block_id", B.escape_html(COL("text")).alias("html"))


@register("part_labels", f"{BLOCKS} SELECT block_id, CASE WHEN pos < 26 THEN chr(pos + 65) ELSE CAST(pos + 1 AS VARCHAR) END AS label FROM b")
def part_labels(spark, sf_dir):
    return blocks(spark, sf_dir, "pos").select("block_id", B.part_label(COL("pos")).alias("label"))


@register("image_uids", f"""{BLOCKS} SELECT block_id, regulation || '-img-' || substr(sha256(regulation || ':img:p' || page || ':(' || array_to_string(list_transform(bbox, lambda v: CAST(v AS VARCHAR)), ', ') || '):' || coalesce(label, '')), 1, 8) AS made_uid FROM b WHERE type = 'image' AND bbox IS NOT NULL""")
def image_uids(spark, sf_dir):
    return blocks(spark, sf_dir, "regulation type page bbox label").filter("type = 'image' and bbox is not null").select("block_id", B.image_uid(COL("regulation"), COL("page"), COL("bbox"), COL("label")).alias("made_uid"))


# comparison of versions -----------------------------------------------------------------------------------------------


def _uid(text: str) -> str:
    return f"regulation || '-' || substr(sha256(regulation || ':' || trim(regexp_replace({text}, '{WS}+', ' ', 'g'))), 1, 8)"


_EDITED = "CASE WHEN pos % 5 = 1 THEN repeat('#', length(text)) WHEN pos % 5 = 2 THEN text || '!' WHEN pos % 5 = 3 THEN text || repeat('!', length(text)) ELSE text END"


@register(
    "diff_types",
    f"""{BLOCKS}, o AS (SELECT regulation, version, min(pos) AS pos, text FROM b WHERE NOT {IMAGE} AND length(text) BETWEEN 20 AND 95 AND NOT regexp_matches(text, '[#!]') GROUP BY ALL),
n AS (SELECT regulation, version, pos, text AS was, {_EDITED} AS text FROM o WHERE pos % 7 <> 3)
SELECT regulation, version, pos, {_uid('text')} AS uid, CASE pos % 5 WHEN 1 THEN 'ADDED' WHEN 2 THEN 'SLID' WHEN 3 THEN 'MODIFIED' ELSE 'UNCHANGED' END AS type, CASE WHEN pos % 5 <> 1 THEN {_uid('was')} END AS prev_uid,
  CASE pos % 5 WHEN 2 THEN round(2.0 * length(was) / (2 * length(was) + 1), 4) WHEN 3 THEN 0.6667 END AS similarity FROM n
UNION ALL SELECT regulation, version, NULL, {_uid('text')}, 'DELETED', {_uid('text')}, NULL FROM o WHERE pos % 7 = 3 OR pos % 5 = 1""",
)
def diff_types(spark, sf_dir):
    """Short texts against a made version of them: of every five one is replaced, one ends in a mark more, one is twice as long; of every seven one is gone."""
    d = blocks(spark, sf_dir, "regulation version pos type text").filter((B.kind(COL("type")) != "image") & F.length("text").between(20, 95) & ~COL("text").rlike("[#!]"))
    d = d.groupBy(*DOC, "text").agg(F.min("pos").alias("pos")).withColumns({"number": F.lit("1"), "title": F.lit("")})
    old = written(d.withColumn("uid", B.uid(COL("regulation"), COL("text"))), "diff-made")
    new = old.filter("pos % 7 <> 3").withColumn("text", F.expr(_EDITED)).withColumn("uid", B.uid(COL("regulation"), COL("text")))
    return diff.diff(old, new, list(DOC)).select(*DOC, "pos", "uid", "type", "prev_uid", "similarity")


# references and glossary ----------------------------------------------------------------------------------------------

_OF_ANNEX, _OF_THIS, _PLAIN = references.OF_ANNEX, references.OF_THIS, references.PLAIN
_BARE = lambda x: f"regexp_replace({x}, '\\.+$', '')"


@register(
    "references_resolved",
    f"""{BLOCKS}, t AS (SELECT regulation, version, pos, CAST(annex_id AS INT) AS annex_id, coalesce(text, '') AS t FROM b WHERE NOT {IMAGE}),
m AS (SELECT *, regexp_extract_all(t, '{_OF_ANNEX}', 1) AS an, regexp_extract_all(t, '{_OF_ANNEX}', 2) AS aa, regexp_extract_all(t, '{_OF_THIS}', 1) AS th, regexp_extract_all(regexp_replace(regexp_replace(t, '{_OF_ANNEX}', '#', 'g'), '{_OF_THIS}', '#', 'g'), '{_PLAIN}', 0) AS pl FROM t),
l AS (SELECT regulation, version, pos, list_concat(list_concat(list_transform(range(1, len(an) + 1), lambda i: {{'n': {_BARE('an[i]')}, 'a': CAST(aa[i] AS INT)}}), list_transform(th, lambda x: {{'n': {_BARE('x')}, 'a': CAST(NULL AS INT)}})),
  flatten(list_transform(pl, lambda q: list_transform(regexp_extract_all(q, '\\d+(?:\\.\\d+)+', 0), lambda x: {{'n': x, 'a': annex_id}})))) AS l FROM m),
u AS (SELECT regulation, version, pos, unnest(l) AS r, generate_subscripts(l, 1) AS i FROM l),
e AS (SELECT regulation, version, pos, r.n AS number, r.a AS annex, min(i) AS i FROM u WHERE r.n <> '' GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY regulation, version, pos ORDER BY i) - 1 AS INT) AS ref_no FROM e),
best AS (SELECT regulation, version, number, annex_id, arg_min(uid, pos) AS target_uid, arg_min({strip('summary_ja')}, pos) AS target_summary FROM b WHERE NOT {IMAGE} AND coalesce(number, '') <> '' GROUP BY ALL)
SELECT k.regulation, k.version, k.pos, k.ref_no, k.number, k.annex, best.target_uid, best.target_summary FROM k JOIN best ON best.regulation = k.regulation AND best.version = k.version AND best.number = k.number AND best.annex_id IS NOT DISTINCT FROM k.annex WHERE target_summary <> ''""",
)
def references_resolved(spark, sf_dir):
    return references.resolved(blocks(spark, sf_dir, "regulation version pos uid type number text annex_id summary_ja"))


# enrichment -----------------------------------------------------------------------------------------------------------


def _titled(rows: list[dict]) -> list[dict]:
    """A stand-in for a service that translates headings."""
    return [{"title_ja": f"[題] {r['title']}"} for r in rows]


def _summed(rows: list[dict]) -> list[dict]:
    """A stand-in for a service that summarises."""
    return [{"summary_ja": f"[要約] {r['number'] or ''}"} for r in rows]


@register("headings_written", f"{BLOCKS} SELECT block_id, CASE WHEN coalesce(type, 'paragraph') = 'paragraph' AND coalesce(title, '') <> '' AND coalesce(title_ja, '') = '' THEN {strip("'[題] ' || title")} ELSE title_ja END AS title_ja FROM b")
def headings_written(spark, sf_dir):
    d = written(blocks(spark, sf_dir, "regulation version pos type number title text title_ja"), "headings")
    got = enrich.enriched(enrich.heading_targets(d), _titled, enrich.HEADINGS, ("title_ja",))
    return enrich.written_back(d, got, ("title_ja",), status=False).select("block_id", "title_ja")


@register("summaries_written", f"{BLOCKS} SELECT block_id, CASE WHEN coalesce(type, 'paragraph') = 'paragraph' AND status IN ('done', 'translated') AND {strip('text')} <> '' THEN {strip("'[要約] ' || coalesce(number, '')")} ELSE summary_ja END AS summary_ja, status FROM b")
def summaries_written(spark, sf_dir):
    d = written(blocks(spark, sf_dir, "regulation version pos type number title text summary_ja status"), "summaries")
    got = enrich.enriched(enrich.summary_targets(d), _summed, enrich.SUMMARY, ("summary_ja",))
    return enrich.written_back(d, got, ("summary_ja",), status=False).select("block_id", "summary_ja", "status")


@register("run_counters", f"{BLOCKS} SELECT count(*) AS processed, count(*) AS done, CAST(0 AS BIGINT) AS errors FROM b WHERE coalesce(type, 'paragraph') = 'paragraph' AND coalesce(title, '') <> '' AND coalesce(title_ja, '') = ''")
def run_counters(spark, sf_dir):
    d = blocks(spark, sf_dir, "regulation version pos type number title text title_ja")
    return enrich.counters(enrich.enriched(enrich.heading_targets(d), _titled, enrich.HEADINGS, ("title_ja",)))


@register("run_preview", f"""{BLOCKS}, t AS (SELECT *, row_number() OVER (ORDER BY regulation, version, pos) AS k, count(*) OVER () AS n FROM b WHERE coalesce(type, 'paragraph') = 'paragraph' AND status = 'untranslated') SELECT block_id, greatest(n - 20, 0) AS n_more FROM t WHERE k <= 20""")
def run_preview(spark, sf_dir):
    return enrich.preview(enrich.body_targets(blocks(spark, sf_dir, "regulation version pos type status"))).select("block_id", "n_more")


@register("first_targets", f"""{BLOCKS} SELECT block_id FROM b WHERE coalesce(type, 'paragraph') = 'paragraph' AND status = 'untranslated' AND (number = '3' OR starts_with(coalesce(number, ''), '3.')) ORDER BY regulation, version, pos LIMIT 50""")
def first_targets(spark, sf_dir):
    return enrich.body_targets(blocks(spark, sf_dir, "regulation version pos type number status"), "3", 50).select("block_id")


@register("prompts", f"{BLOCKS} SELECT block_id, '段落番号: ' || coalesce(number, '') || chr(10) || 'タイトル: ' || coalesce(title, '') || chr(10) || '本文:' || chr(10) || coalesce(text, '') AS prompt FROM b")
def prompts(spark, sf_dir):
    return blocks(spark, sf_dir, "number title text").select("block_id", enrich.user_prompt(COL("number"), COL("title"), COL("text")).alias("prompt"))


@register("replies_parsed", f"""{BLOCKS} SELECT block_id, {strip('title')} AS title_ja FROM b WHERE title IS NOT NULL""")
def replies_parsed(spark, sf_dir):
    d = blocks(spark, sf_dir, "title").filter("title is not null")
    reply = F.concat(F.lit("Here it is:\n```json\n"), F.to_json(F.struct(F.concat(F.lit(" "), "title", F.lit("\n")).alias("title_ja"))), F.lit("\n```"))
    return d.select("block_id", enrich.reply_json(reply, "title_ja string").alias("r")).select("block_id", "r.title_ja")


@register("annexes_backfilled", f"""{BLOCKS}, k AS (SELECT regulation, uid, arg_max(annex_id, pos) AS a FROM b WHERE annex_id IS NOT NULL AND NOT {IMAGE} GROUP BY ALL), w AS (SELECT block_id, regulation, uid, type, CASE WHEN block_id % 2 = 0 THEN annex_id END AS annex_id FROM b)
SELECT block_id, CASE WHEN coalesce(w.type, 'paragraph') = 'paragraph' THEN coalesce(k.a, w.annex_id) ELSE w.annex_id END AS annex_id FROM w LEFT JOIN k USING (regulation, uid)""")
def annexes_backfilled(spark, sf_dir):
    d = blocks(spark, sf_dir, "regulation pos uid type annex_id").withColumn("type", B.kind(COL("type")))
    lost = d.withColumn("annex_id", F.when(COL("block_id") % 2 == 0, COL("annex_id")))  # every second annex id is lost before it is filled in again
    return segment.annex_backfill(lost, d.drop("block_id")).select("block_id", "annex_id")


@register("mapped_by_number", f"""{BLOCKS}, t AS (SELECT number, min({{'tj': title_ja, 'tr': translation}}) AS x FROM b WHERE number IS NOT NULL AND title_ja IS NOT NULL AND translation IS NOT NULL AND regulation = 'R913' GROUP BY number)
SELECT block_id, CASE WHEN x IS NOT NULL AND pos >= 5 AND pos < 60 THEN x.tj ELSE title_ja END AS title_ja, CASE WHEN x IS NOT NULL AND pos >= 5 AND pos < 60 THEN x.tr ELSE translation END AS translation, CASE WHEN x IS NOT NULL AND pos >= 5 AND pos < 60 THEN 'translated' ELSE status END AS status FROM b LEFT JOIN t USING (number)""")
def mapped_by_number(spark, sf_dir):
    d = blocks(spark, sf_dir, "regulation pos number title_ja translation status")
    table_ = d.filter("regulation = 'R913' and number is not null and title_ja is not null and translation is not null").select("number", "title_ja", "translation")
    return enrich.mapped(d, table_, 5, 60).select("block_id", "title_ja", "translation", "status")


# sources and pages ----------------------------------------------------------------------------------------------------


@register("json_round_trip", f"""{BLOCKS}, j AS (SELECT b.* FROM b JOIN doc_versions v USING (regulation, version)) SELECT regulation, version, CAST(row_number() OVER ({ONE}) - 1 AS INT) AS pos, coalesce(type, 'paragraph') AS type, number, title, text, level, annex_id, label FROM j""")
def json_round_trip(spark, sf_dir):
    d = blocks(spark, sf_dir, "regulation version pos type number title text level annex_id label")
    v = versions(spark, sf_dir).select(*DOC, "source_date", "title", "annex_titles").withColumnRenamed("title", "_t")
    docs = documents.nested(d, v).withColumnRenamed("_t", "title")
    path = scratch(spark, "json")
    documents.write_json(docs, path)
    return documents.blocks(documents.documents(spark, f"{path}/*/*/*.json")).select(*DOC, "pos", "type", "number", "title", "text", "level", "annex_id", "label")


@register("raw_publication", f"{BLOCKS} SELECT block_id, pos, uid, type, number, title, text, status, translation, summary_ja FROM b WHERE regulation = 'R913'")
def raw_publication(spark, sf_dir):
    return documents.published(blocks(spark, sf_dir), "R913").select("block_id", "pos", "uid", "type", "number", "title", "text", "status", "translation", "summary_ja")


def _html(x: str) -> str:
    return f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')"


@register(
    "index_html",
    f"""{BLOCKS}, v AS (SELECT regulation, arg_max(version, lower(version)) AS version FROM doc_versions WHERE version IS NOT NULL AND lower(version) <> 'diff' GROUP BY regulation),
r AS (SELECT regulation, version, count(*) AS total, count(*) FILTER (status IN ('done', 'translated')) AS translated FROM b JOIN v USING (regulation, version) WHERE coalesce(type, 'paragraph') = 'paragraph' GROUP BY ALL),
k AS (SELECT *, regexp_extract(regulation, '^R(\\d+)$', 1) AS n, '<li>' || {_html('regulation')} || ' ' || {_html('version')} || ' ' || translated || '/' || total || ' ' || CAST(trunc(translated / total * 100) AS INT) || ' %</li>' AS line FROM r)
SELECT '<ul>' || string_agg(line, chr(10) ORDER BY CASE WHEN regulation = 'R.E.3' THEN 0 WHEN n <> '' THEN 1 ELSE 2 END, coalesce(try_cast(n AS INT), 0), CASE WHEN n <> '' OR regulation = 'R.E.3' THEN '' ELSE regulation END, line) || '</ul>' AS html FROM k""",
)
def index_html(spark, sf_dir):
    return pages.index_page(report.index_rows(blocks(spark, sf_dir, "regulation version type status"), versions(spark, sf_dir)))


@register(
    "insertion_order",
    f"""{BLOCKS}, r AS (SELECT regulation, version, pos FROM b WHERE regulation = 'R913') SELECT regulation, version, CAST(row_number() OVER (PARTITION BY regulation, version ORDER BY pos, k) - 1 AS INT) AS pos, CASE k WHEN 0 THEN 'row ' || pos ELSE 'PROPOSAL-' || pos || '-' || k END AS uid FROM r, (SELECT unnest([0, 1, 2]) AS k)""",
)
def insertion_order(spark, sf_dir):
    """Two additions after every row of the largest document."""
    d = blocks(spark, sf_dir, "regulation version pos number title text level parent").filter("regulation = 'R913'").withColumn("uid", F.concat(F.lit("row "), COL("pos").cast("string")))
    p = d.select("regulation", F.col("uid").alias("anchor_uid"), F.explode(F.array(F.lit("1"), F.lit("2"))).alias("k"), "pos").distinct()
    p = p.select("regulation", "anchor_uid", F.concat_ws("-", COL("pos").cast("string"), "k").alias("id"), F.lit("ADDED").alias("type"), F.lit("9").alias("number"), F.lit("new").alias("title"), COL("k").alias("source_date"))
    return proposals.inserted(d, p).select(*DOC, "pos", "uid")


@register("glossary_prompts", """SELECT regulation, array_to_string(list(l ORDER BY t, l), chr(10)) AS glossary_block FROM (SELECT DISTINCT regulation, coalesce(term, '') AS t, '| ' || coalesce(term, '') || ' | ' || coalesce(ja, '') || ' | ' || coalesce(description, '') || CASE WHEN len(aliases) > 0 THEN '（別称: ' || array_to_string(aliases, ', ') || '）' ELSE '' END || ' |' AS l FROM glossary) GROUP BY regulation""")
def glossary_prompts(spark, sf_dir):
    return glossary.prompt_table(table(spark, sf_dir, "glossary"))
