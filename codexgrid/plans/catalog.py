"""Registered queries of single operators of the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexgrid.functions import blocks as B
from codexgrid.functions.text import WS
from codexgrid.operators import diff as D
from codexgrid.operators import enrich, glossary, noise, proposals, references, report, segment, structure
from codexgrid.operators.ordered import DOC
from codexgrid.operators.snapshots import snapshot_changes
from codexgrid.plans.materialize import written
from codexgrid.plans.registry import BLOCKS, COL, PARA, QUERIES, SNAPS, SQL, blocks, pending, register, snapshot_pairs, versions
from codexgrid.sources.tables import table


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_changes(table(spark, sf_dir, "structured_snapshots"))


QUERIES["p6_found"] = p6_found
SQL["p6_found"] = r"""
WITH given AS (
  SELECT regulation AS g, snap_no AS s, lower(regexp_replace(uid, '^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$', '', 'g')) AS k,
         lower(regexp_replace(prev_uid, '^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$', '', 'g')) AS p, loaded_at,
         trim(regexp_replace(coalesce(text, ''), '[\s\x1c-\x1f\x85\p{Z}]+', ' ', 'g')) AS t
  FROM structured_snapshots WHERE regulation IS NOT NULL AND snap_no IS NOT NULL),
rec AS (SELECT g, s, k, arg_max(t, loaded_at) AS t FROM given WHERE k <> '' GROUP BY g, s, k),
parents AS (SELECT DISTINCT g, s, k, p FROM given WHERE k <> '' AND p IS NOT NULL),
steps AS (SELECT g, s, lag(s) OVER (PARTITION BY g ORDER BY s) AS b FROM (SELECT DISTINCT g, s FROM given)),
cur AS (SELECT rec.*, b FROM rec JOIN steps USING (g, s) WHERE b IS NOT NULL),
was AS (SELECT steps.g, steps.s, rec.k, rec.t FROM steps JOIN rec ON rec.g = steps.g AND rec.s = steps.b),
edited AS (SELECT c.g, c.s, c.k, 'changed' AS kind FROM cur c JOIN was w ON c.g = w.g AND c.s = w.s AND c.k = w.k WHERE c.t <> w.t),
fresh AS (SELECT c.g, c.s, c.k FROM cur c WHERE NOT EXISTS (SELECT 1 FROM was w WHERE w.g = c.g AND w.s = c.s AND w.k = c.k)),
gone AS (SELECT w.g, w.s, w.k FROM was w WHERE NOT EXISTS (SELECT 1 FROM rec r WHERE r.g = w.g AND r.s = w.s AND r.k = w.k)),
link AS (SELECT DISTINCT f.g, f.s, f.k, o.k AS old FROM fresh f JOIN parents p ON p.g = f.g AND p.s = f.s AND p.k = f.k JOIN gone o ON o.g = f.g AND o.s = f.s AND o.k = p.p)
SELECT g AS regulation, s AS snap_no, k AS uid, kind AS change_kind FROM edited
UNION ALL SELECT f.g, f.s, f.k, CASE WHEN EXISTS (SELECT 1 FROM link l WHERE l.g = f.g AND l.s = f.s AND l.k = f.k) THEN 'changed' ELSE 'added' END FROM fresh f
UNION ALL SELECT o.g, o.s, o.k, 'removed' FROM gone o WHERE NOT EXISTS (SELECT 1 FROM link l WHERE l.g = o.g AND l.s = o.s AND l.old = o.k)
"""


@register("uid_projection", f"""{BLOCKS} SELECT block_id, regulation || '-' || substr(sha256(regulation || ':' || trim(regexp_replace(coalesce(text, ''), '[\\s\\x1c-\\x1f\\x85\\p{{Z}}]+', ' ', 'g'))), 1, 8) AS made_uid FROM b WHERE coalesce(type, '') <> 'image'""")
def uid_projection(spark, sf_dir):
    return blocks(spark, sf_dir, "type regulation text").filter(B.kind(COL("type")) != "image").select("block_id", B.uid(COL("regulation"), COL("text")).alias("made_uid"))


@register("level_parent", f"""{BLOCKS} SELECT block_id, length(number) - length(replace(number, '.', '')) + 1 AS made_level, CASE WHEN contains(number, '.') THEN regexp_extract(number, '^(.*)\\.[^.]*$', 1) END AS made_parent,
list_transform(string_split(number, '.'), lambda x: try_cast(x AS INT)) AS parts FROM b WHERE number <> ''""")
def level_parent(spark, sf_dir):
    n = COL("number")
    return blocks(spark, sf_dir, "number").filter("number <> ''").select("block_id", B.level(n).alias("made_level"), B.parent(n).alias("made_parent"), F.transform(F.split(n, r"\."), lambda x: x.try_cast("int")).alias("parts"))


@register("valid_numbers", f"{BLOCKS} SELECT block_id, coalesce(list_bool_and(list_transform(string_split(number, '.'), lambda x: coalesce(try_cast(x AS INT) >= 1, false))), false) AS valid FROM b WHERE number <> ''")
def valid_numbers(spark, sf_dir):
    return blocks(spark, sf_dir, "number").filter("number <> ''").select("block_id", B.valid_number(COL("number")).alias("valid"))


@register("clean_texts", f"""{BLOCKS} SELECT block_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(text, '(?m)^\\s*\\d+\\)\\s+', '', 'g'), chr(10)), lambda x: regexp_replace(x, '^[\\s\\x1c-\\x1f\\x85\\p{{Z}}]+|[\\s\\x1c-\\x1f\\x85\\p{{Z}}]+$', '', 'g')), lambda x: x <> ''), ' ') AS cleaned FROM b WHERE text IS NOT NULL""")
def clean_texts(spark, sf_dir):
    return blocks(spark, sf_dir, "text").filter("text is not null").select("block_id", B.clean_text(COL("text")).alias("cleaned"))


@register("page_headers_stripped", f"""{BLOCKS} SELECT block_id, regexp_replace(text, '(?mi)^(?:(?:E/)?ECE/[^\\n]*|(?:UN\\s+)?Regulation\\s+No\\.?\\s*\\d+\\s*|page\\s+\\d+\\s*)$', '', 'g') AS stripped FROM b WHERE text IS NOT NULL""")
def page_headers_stripped(spark, sf_dir):
    return blocks(spark, sf_dir, "text").filter("text is not null").select("block_id", B.strip_page_headers(COL("text")).alias("stripped"))


@register("titles_without_leader", f"{BLOCKS} SELECT block_id, regexp_replace(regexp_replace(coalesce(title, ''), '(?s)\\s*\\.{{4,}}.*', ''), '[. ]+$', '') AS heading FROM b")
def titles_without_leader(spark, sf_dir):
    return blocks(spark, sf_dir, "title").select("block_id", B.without_leader(COL("title")).alias("heading"))


@register("inline_lists", """SELECT doc_id, CASE WHEN contains(text, '(a)') AND regexp_matches(text, '\\([b-z]\\)') THEN regexp_replace(text, '([ 、。])\\(([b-z])\\)', '\\1<br>(\\2)', 'g') ELSE text END AS html FROM documents WHERE text IS NOT NULL""")
def inline_lists(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", B.inline_list(COL("text")).alias("html"))


@register("short_summaries", f"{BLOCKS} SELECT block_id, CASE WHEN instr(summary_ja, '。') > 0 THEN substr(summary_ja, 1, instr(summary_ja, '。')) ELSE summary_ja END AS short FROM b WHERE summary_ja IS NOT NULL")
def short_summaries(spark, sf_dir):
    return blocks(spark, sf_dir, "summary_ja").filter("summary_ja is not null").select("block_id", B.short_summary(COL("summary_ja")).alias("short"))


@register("noise_titles", f"""{BLOCKS} SELECT block_id, regexp_matches(coalesce(title, ''), '(?i)^Note by the secretariat\\b|(?:E/)?ECE/(?:TRANS/WP\\.29)?/\\S|TRANS/WP\\.29/\\S|^As defined in the Consolidated Resolution on the Construction of Vehicles\\b|^The distinguish(?:ing)? numbers? of the Contracting Parties\\b')
OR NOT regexp_matches(coalesce(title, ''), '[A-Za-z]{{3,}}') OR length(regexp_replace(regexp_replace(coalesce(title, ''), '(?s)\\s*\\.{{4,}}.*', ''), '[. ]+$', '')) > 100 AS noise FROM b WHERE coalesce(type, '') <> 'image'""")
def noise_titles(spark, sf_dir):
    return blocks(spark, sf_dir, "type title").filter(B.kind(COL("type")) != "image").select("block_id", B.noise_title(COL("title")).alias("noise"))


@register("toc_rows", f"""{BLOCKS} SELECT block_id, regexp_matches(coalesce(text, ''), '(?s)^[^:]*?\\.{{4,}}(?:\\s*\\d{{1,3}})?\\s*$') AS overflow,
length(trim(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '[.…]{{2,}}', ' ', 'g'), '\\s+\\d+\\s*$', ''), '\\s+', ' ', 'g'))) <= length(trim(regexp_replace(regexp_replace(regexp_replace(coalesce(title, ''), '[.…]{{2,}}', ' ', 'g'), '\\s+\\d+\\s*$', ''), '\\s+', ' ', 'g'))) + 20 AS toc_like
FROM b WHERE coalesce(type, '') <> 'image'""")
def toc_rows(spark, sf_dir):
    return blocks(spark, sf_dir, "type title text").filter(B.kind(COL("type")) != "image").select("block_id", B.toc_overflow(COL("text")).alias("overflow"), B.toc_like(COL("title"), COL("text")).alias("toc_like"))


@register("monotone_numbers", f"""{BLOCKS}, p AS (SELECT regulation, version, pos, list_transform(string_split(number, '.'), lambda x: try_cast(x AS INT)) AS num FROM b WHERE coalesce(type, '') <> 'image'),
q AS (SELECT * FROM p WHERE len(list_filter(num, lambda x: x IS NULL)) = 0), l AS (SELECT *, lag(num[1]) OVER w AS before FROM q WINDOW w AS (PARTITION BY regulation, version ORDER BY pos)),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR before <> num[1] THEN 1 ELSE 0 END) OVER (PARTITION BY regulation, version ORDER BY pos) AS island FROM l)
SELECT regulation, version, pos, coalesce(num >= max(num) OVER (PARTITION BY regulation, version, island ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS accepted FROM i""")
def monotone_numbers(spark, sf_dir):
    d = blocks(spark, sf_dir, "regulation version pos type number").filter(B.kind(COL("type")) != "image").select(*DOC, "pos", "number").filter(B.path(COL("number")).isNotNull())
    return structure.monotone(d).select(*DOC, "pos", "accepted")


@register("restart_groups", f"""{PARA}, t AS (SELECT * FROM p WHERE kind <> 'image' AND top > 0), l AS (SELECT *, lag(top) OVER (PARTITION BY regulation, version ORDER BY pos) AS before FROM t)
SELECT regulation, version, pos, CAST(sum(CASE WHEN top < before AND before > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY regulation, version ORDER BY pos) AS INT) AS restart_group FROM l""")
def restart_groups(spark, sf_dir):
    d = blocks(spark, sf_dir, "regulation version pos type number").select(*DOC, "pos", "type", "number")
    return structure.restart_groups(d).filter("restart_group is not null").select(*DOC, "pos", "restart_group")


@register("annex_boundary", f"""{PARA}, t AS (SELECT *, max(CASE WHEN level >= 2 THEN 1 ELSE 0 END) OVER (PARTITION BY regulation, version ORDER BY pos) AS body FROM p WHERE kind <> 'image' AND top > 0),
m AS (SELECT *, coalesce(max(CASE WHEN body = 1 THEN top END) OVER (PARTITION BY regulation, version ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS most, coalesce(max(top) OVER (PARTITION BY regulation, version ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later FROM t),
s AS (SELECT regulation, version, min(pos) AS start FROM m WHERE body = 1 AND most >= 2 AND top < most // 2 + 1 AND later <= most GROUP BY ALL)
SELECT p.regulation, p.version, p.pos, coalesce(p.pos >= s.start AND p.kind <> 'image', false) AS in_annex FROM p LEFT JOIN s USING (regulation, version)""")
def annex_boundary(spark, sf_dir):
    d = blocks(spark, sf_dir, "regulation version pos type number level").select(*DOC, "pos", "type", "number", "level")
    return structure.in_annex(d).select(*DOC, "pos", "in_annex")


@register("annex_page_noise")
def annex_page_noise(spark, sf_dir):
    d = blocks(spark, sf_dir, "regulation version pos type number level parent title text annex_id").withColumn("annex", COL("annex_id"))
    return structure.annex_page_noise(d).filter("nav_only_hidden").select("block_id", *DOC, "pos")


@register("tree_edges", f"""{BLOCKS}, p AS (SELECT regulation, version, pos, number, parent, level, uid FROM b WHERE coalesce(type, '') <> 'image'),
j AS (SELECT c.regulation, c.version, c.pos, c.number, c.uid, x.pos AS parent_pos, x.uid AS parent_uid, row_number() OVER (PARTITION BY c.regulation, c.version, c.pos ORDER BY x.pos DESC) AS r FROM p c JOIN p x ON x.regulation = c.regulation AND x.version = c.version AND x.number = c.parent AND x.pos < c.pos WHERE c.level > 1)
SELECT regulation, version, pos, number, uid, parent_pos, parent_uid FROM j WHERE r = 1""")
def tree_edges(spark, sf_dir):
    return structure.tree_edges(blocks(spark, sf_dir, "regulation version pos type number parent level uid"))


@register("first_occurrence", f"""{BLOCKS}, p AS (SELECT *, coalesce(type, '') <> 'image' AND coalesce(number, '') <> '' AS vis FROM b)
SELECT block_id, vis AND pos = min(CASE WHEN vis THEN pos END) OVER (PARTITION BY regulation, version, number) AS first_occ FROM p""")
def first_occurrence(spark, sf_dir):
    return structure.first_occurrence(blocks(spark, sf_dir, "regulation version pos type number").select("block_id", *DOC, "pos", "type", "number")).select("block_id", "first_occ")


@register("chapter_gaps", f"""{PARA}, k AS (SELECT regulation, version, unnest(range(1, 31)) AS top FROM (SELECT DISTINCT regulation, version FROM b)),
f AS (SELECT p.regulation, p.version, p.top, min(p.pos) AS pos FROM p JOIN k USING (regulation, version, top) WHERE p.kind <> 'image' GROUP BY ALL),
m AS (SELECT *, max(top) OVER (PARTITION BY regulation, version ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS most FROM f)
SELECT m.regulation, m.version, m.pos, m.top AS chapter, list_sort(list(CAST(k.top AS INT))) AS missing FROM m JOIN k ON k.regulation = m.regulation AND k.version = m.version AND k.top > m.most AND k.top < m.top GROUP BY ALL""")
def chapter_gaps(spark, sf_dir):
    """Which of thirty chapters, all taken as known, a document passes over."""
    d = blocks(spark, sf_dir, "regulation version pos type number")
    known = d.select(*DOC).distinct().withColumn("chapter", F.explode(F.sequence(F.lit(1), F.lit(30))))
    return structure.chapter_gaps(d, known)


@register("dividers", f"""{PARA}, d AS (SELECT block_id, regulation, version, pos, CASE WHEN annex_id IS NOT NULL THEN 'annex ' || annex_id ELSE 'chapter ' || top END AS divider FROM p WHERE kind <> 'image'),
l AS (SELECT *, last_value(divider IGNORE NULLS) OVER (PARTITION BY regulation, version ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM d)
SELECT block_id, divider FROM l WHERE divider IS NOT NULL AND divider IS DISTINCT FROM before""")
def dividers(spark, sf_dir):
    return structure.dividers(blocks(spark, sf_dir, "regulation version pos type number annex_id").withColumn("annex", COL("annex_id"))).select("block_id", "divider")


@register("toc_duplicates", f"""{BLOCKS}, t AS (SELECT * REPLACE (CASE WHEN pos % 3 = 0 THEN coalesce(title, '') || ' ........ 5' ELSE title END AS title) FROM b),
g AS (SELECT regulation, version, coalesce(annex_id, -1) AS a, trim(number) AS n, count(*) AS c, bool_or(NOT contains(coalesce(title, ''), '......')) AS clean FROM t WHERE coalesce(type, '') <> 'image' AND coalesce(level, 1) = 1 AND regexp_full_match(trim(number), '\\d{{1,2}}') GROUP BY ALL HAVING c >= 2 AND clean)
SELECT DISTINCT t.regulation, t.version, t.uid FROM t JOIN g ON g.regulation = t.regulation AND g.version = t.version AND g.a = coalesce(t.annex_id, -1) AND g.n = trim(t.number)
WHERE coalesce(type, '') <> 'image' AND coalesce(level, 1) = 1 AND (contains(coalesce(t.title, ''), '......') OR regexp_matches(coalesce(t.text, ''), '(?s)^[^:]*?\\.{{4,}}(?:\\s*\\d{{1,3}})?\\s*$'))""")
def toc_duplicates(spark, sf_dir):
    """Every third title gets the leader that the tables lack."""
    d = blocks(spark, sf_dir, "regulation version pos uid type number level title text annex_id")
    return noise.toc_duplicates(d.withColumn("title", F.when(COL("pos") % 3 == 0, F.concat(B.text0(COL("title")), F.lit(" ........ 5"))).otherwise(COL("title"))))


@register("repeated_footnotes")
def repeated_footnotes(spark, sf_dir):
    return noise.repeated_footnotes(blocks(spark, sf_dir, "regulation version pos type number level title text annex_id"))


@register("hidden_rows")
def hidden_rows(spark, sf_dir):
    return noise.marked(blocks(spark, sf_dir, "regulation version pos uid type number level title text annex_id")).filter("nav_hidden").select("block_id", *DOC, "pos")


@register("media_conflicts", f"""{BLOCKS}, i AS (SELECT * FROM b WHERE type = 'image' AND bbox IS NOT NULL AND page IS NOT NULL)
SELECT DISTINCT f.regulation, f.version, f.pos FROM i f JOIN i t ON t.regulation = f.regulation AND t.version = f.version AND t.page = f.page AND starts_with(t.label, 'Table')
WHERE NOT coalesce(starts_with(f.label, 'Table'), false) AND NOT (f.bbox[3] + 4 < t.bbox[1] OR t.bbox[3] + 4 < f.bbox[1] OR f.bbox[4] + 4 < t.bbox[2] OR t.bbox[4] + 4 < f.bbox[2])""")
def media_conflicts(spark, sf_dir):
    return noise.media_conflicts(blocks(spark, sf_dir, "regulation version pos type page bbox label"))


@register("media_labels", f"""{BLOCKS}, i AS (SELECT *, CASE WHEN starts_with(label, 'Table') THEN 'Table' ELSE 'Figure' END AS k FROM b WHERE type = 'image')
SELECT block_id, coalesce(CASE WHEN coalesce(label, '') <> '' THEN label END, caption, k || ' ' || row_number() OVER (PARTITION BY regulation, version, k ORDER BY page NULLS FIRST, bbox[2] NULLS FIRST, pos)) AS shown_label FROM i""")
def media_labels(spark, sf_dir):
    return noise.media_labels(blocks(spark, sf_dir, "regulation version pos type page bbox label caption")).select("block_id", "shown_label")


@register("diff_exact", f"""{SNAPS} SELECT n.regulation, n.snap_no, n.pos, n.uid, CASE WHEN o.uid IS NULL THEN 'ADDED' ELSE 'KEPT' END AS type FROM n LEFT JOIN o USING (regulation, snap_no, uid)
UNION ALL SELECT o.regulation, o.snap_no, NULL, o.uid, 'DELETED' FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.regulation = o.regulation AND n.snap_no = o.snap_no AND n.uid = o.uid)""")
def diff_exact(spark, sf_dir):
    old, new = snapshot_pairs(spark, sf_dir)
    e = D.diff(old, new, ["regulation", "snap_no"], fuzzy=False)
    return e.select("regulation", "snap_no", "pos", "uid", F.when(COL("type").isin("UNCHANGED", "MODIFIED"), "KEPT").otherwise(COL("type")).alias("type"))


@register("diff_entries")
def diff_entries(spark, sf_dir):
    old, new = snapshot_pairs(spark, sf_dir)
    return D.diff(old, new, ["regulation", "snap_no"]).select("regulation", "snap_no", "type", "uid", "prev_uid", "number", "similarity", "pos")


@register("diff_summary")
def diff_summary(spark, sf_dir):
    old, new = snapshot_pairs(spark, sf_dir)
    return D.summary(D.diff(old, new, ["regulation", "snap_no"]), ["regulation", "snap_no"])


@register("diff_applied")
def diff_applied(spark, sf_dir):
    old, new = snapshot_pairs(spark, sf_dir)
    keys = ["regulation", "snap_no"]
    return D.applied(new, D.diff(old, new, keys), keys).select(*keys, "pos", "uid", "modified", "prev_uid", "status")


@register("reference_edges", f"""{BLOCKS}, t AS (SELECT regulation, version, pos, annex_id, coalesce(text, '') AS t FROM b WHERE coalesce(type, '') <> 'image'),
r AS (SELECT *, regexp_replace(regexp_replace(t, '(?i)\\bparagraphs?\\s+([\\d.]+?\\.?)\\s+of\\s+(?:Part\\s+\\w+\\s+of\\s+)?Annex\\s+(\\d+)(?:\\s+to\\s+this\\s+Regulation)?', '#', 'g'), '(?i)\\bparagraphs?\\s+([\\d.]+?\\.?)\\s+of\\s+this\\s+Regulation', '#', 'g') AS rest FROM t),
e AS (SELECT regulation, version, pos, unnest(regexp_extract_all(t, '(?i)\\bparagraphs?\\s+([\\d.]+?\\.?)\\s+of\\s+(?:Part\\s+\\w+\\s+of\\s+)?Annex\\s+(\\d+)(?:\\s+to\\s+this\\s+Regulation)?', 1)) AS n, CAST(unnest(regexp_extract_all(t, '(?i)\\bparagraphs?\\s+([\\d.]+?\\.?)\\s+of\\s+(?:Part\\s+\\w+\\s+of\\s+)?Annex\\s+(\\d+)(?:\\s+to\\s+this\\s+Regulation)?', 2)) AS INT) AS annex FROM r
UNION ALL SELECT regulation, version, pos, unnest(regexp_extract_all(t, '(?i)\\bparagraphs?\\s+([\\d.]+?\\.?)\\s+of\\s+this\\s+Regulation', 1)), NULL FROM r
UNION ALL SELECT regulation, version, pos, unnest(regexp_extract_all(m, '\\d+(?:\\.\\d+)+')), annex_id FROM (SELECT regulation, version, pos, annex_id, unnest(regexp_extract_all(rest, '(?i)\\bparagraphs?\\s+\\d+(?:\\.\\d+)+\\.?(?:(?:\\s*,\\s*(?:and|or|to)?\\s+|\\s+(?:and|or|to)\\s+)\\d+(?:\\.\\d+)+\\.?)*')) AS m FROM r))
SELECT DISTINCT regulation, version, pos, regexp_replace(n, '\\.+$', '') AS number, annex FROM e WHERE regexp_replace(n, '\\.+$', '') <> ''""")
def reference_edges(spark, sf_dir):
    return references.edges(blocks(spark, sf_dir, "regulation version pos type text annex_id")).drop("ref_no")


@register("glossary_terms", """SELECT regulation, term, max(CASE WHEN coalesce(description, '') <> '' THEN description ELSE coalesce(ja, '') END) AS definition FROM glossary WHERE coalesce(term, '') <> '' GROUP BY ALL""")
def glossary_terms(spark, sf_dir):
    return glossary.english_terms(table(spark, sf_dir, "glossary")).select("regulation", "term", "definition")


def _spans_sql(term: str, text: str, low: str) -> str:
    """Longest terms first, no two overlapping: all places of all terms, taken one after the other."""
    return f"""WITH t AS (SELECT DISTINCT regulation, {term} AS t FROM glossary WHERE coalesce({term}, '') <> ''), d AS (SELECT DISTINCT block_id, regulation, {text} AS x FROM structured WHERE {text} IS NOT NULL),
m AS (SELECT block_id, x, t FROM d JOIN t USING (regulation) WHERE contains({low}(x), {low}(t))), p AS (SELECT *, unnest(range(1, length(x) - length(t) + 2)) AS i FROM m),
o AS (SELECT block_id, t, i - 1 AS a, i - 1 + length(t) AS b FROM p WHERE substr({low}(x), i, length(t)) = {low}(t)),
l AS (SELECT block_id, list([{{'a': a, 'b': b, 't': t}}] ORDER BY b - a DESC, t, a) AS l FROM o GROUP BY block_id),
k AS (SELECT block_id, unnest(list_reduce(l, lambda done, y: CASE WHEN len(list_filter(done, lambda z: z.a < y[1].b AND y[1].a < z.b)) = 0 THEN list_concat(done, y) ELSE done END)) AS r FROM l)
SELECT block_id, CAST(r.a AS INT) AS start, CAST(r.b AS INT) AS "end", r.t AS term FROM k"""


@register("glossary_matches", _spans_sql("term", "text", "lower"))
def glossary_matches(spark, sf_dir):
    return glossary.matches(table(spark, sf_dir, "structured"), glossary.english_terms(table(spark, sf_dir, "glossary")))


@register("glossary_matches_ja", _spans_sql(f"regexp_replace(ja, '^{WS}+|{WS}+$', '', 'g')", "translation", ""))
def glossary_matches_ja(spark, sf_dir):
    return glossary.matches(table(spark, sf_dir, "structured"), glossary.japanese_terms(table(spark, sf_dir, "glossary")), "translation", "ja", ignore_case=False)


@register("proposals_attached", f"""{BLOCKS}, p AS (SELECT * FROM proposals QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1)
SELECT b.block_id, list(p.id ORDER BY coalesce(p.source_date, '') DESC, p.id) AS ids FROM b JOIN p ON p.regulation = b.regulation AND p.target_uid = b.uid WHERE p.type <> 'ADDED' GROUP BY b.block_id""")
def proposals_attached(spark, sf_dir):
    d = proposals.attached(blocks(spark, sf_dir, "regulation uid"), pending(spark, sf_dir)).filter("proposals is not null")
    return d.select("block_id", F.transform("proposals", lambda x: x["id"]).alias("ids"))


@register("proposals_inserted", f"""{BLOCKS}, p AS (SELECT * FROM proposals QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1),
u AS (SELECT regulation, version, pos, uid, 0 AS k, '' AS d, '' AS id FROM b UNION ALL SELECT b.regulation, b.version, b.pos, 'PROPOSAL-' || p.id, 1, coalesce(p.source_date, ''), p.id FROM b JOIN p ON p.regulation = b.regulation AND p.anchor_uid = b.uid WHERE p.type = 'ADDED')
SELECT regulation, version, CAST(row_number() OVER (PARTITION BY regulation, version ORDER BY pos, k, d, id) - 1 AS INT) AS pos, uid, k = 1 AS proposal_only FROM u""")
def proposals_inserted(spark, sf_dir):
    return proposals.inserted(blocks(spark, sf_dir, "regulation version pos uid level parent number title"), pending(spark, sf_dir)).select(*DOC, "pos", "uid", "proposal_only")


@register("segments")
def segments(spark, sf_dir):
    return segment.paragraphs(table(spark, sf_dir, "documents")).select("doc_id", "pos", "uid", "type", "number", "title", "level", "parent")


@register("pending_batches", f"""{BLOCKS}, t AS (SELECT block_id, regulation, version, pos FROM b WHERE coalesce(type, 'paragraph') = 'paragraph' AND status = 'untranslated')
SELECT block_id, CAST((row_number() OVER (PARTITION BY regulation, version ORDER BY pos) - 1) // 10 AS INT) AS batch_no FROM t""")
def pending_batches(spark, sf_dir):
    return enrich.batches(enrich.body_targets(blocks(spark, sf_dir, "regulation version pos type status")), enrich.BODY).select("block_id", "batch_no")


@register("summary_targets", f"{BLOCKS} SELECT block_id FROM b WHERE coalesce(type, 'paragraph') = 'paragraph' AND status IN ('done', 'translated') AND trim(coalesce(text, '')) <> ''")
def summary_targets(spark, sf_dir):
    return enrich.summary_targets(blocks(spark, sf_dir, "type status text")).select("block_id")


@register("heading_targets", f"{BLOCKS} SELECT block_id FROM b WHERE coalesce(type, 'paragraph') = 'paragraph' AND coalesce(title, '') <> '' AND coalesce(title_ja, '') = ''")
def heading_targets(spark, sf_dir):
    return enrich.heading_targets(blocks(spark, sf_dir, "type title title_ja")).select("block_id")


def _echo(rows: list[dict]) -> list[dict]:
    """A stand-in for a translator: the text's own words, marked."""
    return [{"translation": f"[ja] {r['text'] or ''}"} for r in rows]


@register("enriched", f"{BLOCKS} SELECT block_id, CASE WHEN coalesce(type, 'paragraph') = 'paragraph' AND status = 'untranslated' THEN 'done' ELSE status END AS status, CASE WHEN coalesce(type, 'paragraph') = 'paragraph' AND status = 'untranslated' THEN regexp_replace('[ja] ' || coalesce(text, ''), '[\\s\\x1c-\\x1f\\x85\\p{{Z}}]+$', '') ELSE translation END AS translation FROM b")
def enriched(spark, sf_dir):
    d = written(blocks(spark, sf_dir, "regulation version pos type number title text status translation"), "enriched")
    got = enrich.enriched(enrich.body_targets(d), _echo, enrich.BODY, ("translation",))
    return enrich.written_back(d, got, ("translation",)).select("block_id", "status", "translation")


@register("progress", f"""{BLOCKS} SELECT regulation, count(*) AS total, count(*) FILTER (status IN ('done', 'translated')) AS translated, CAST(trunc(count(*) FILTER (status IN ('done', 'translated')) / count(*) * 100) AS INT) AS progress FROM b WHERE coalesce(type, 'paragraph') = 'paragraph' GROUP BY regulation""")
def progress(spark, sf_dir):
    return report.progress(blocks(spark, sf_dir, "regulation type status"))


@register("latest_versions", "SELECT regulation, arg_max(version, lower(version)) AS version FROM doc_versions WHERE version IS NOT NULL AND lower(version) <> 'diff' GROUP BY regulation")
def latest_versions(spark, sf_dir):
    return report.latest_versions(versions(spark, sf_dir))


@register("index_rows", f"""{BLOCKS}, v AS (SELECT regulation, arg_max(version, lower(version)) AS version FROM doc_versions WHERE version IS NOT NULL AND lower(version) <> 'diff' GROUP BY regulation)
SELECT regulation, version, count(*) AS total, count(*) FILTER (status IN ('done', 'translated')) AS translated FROM b JOIN v USING (regulation, version) WHERE coalesce(type, 'paragraph') = 'paragraph' GROUP BY ALL""")
def index_rows(spark, sf_dir):
    return report.index_rows(blocks(spark, sf_dir, "regulation version type status"), versions(spark, sf_dir)).select("regulation", "version", "total", "translated")


@register("chapter_selection", f"""{BLOCKS}, p AS (SELECT *, coalesce(type, '') <> 'image' AND number <> '' AND pos = min(CASE WHEN coalesce(type, '') <> 'image' AND number <> '' THEN pos END) OVER (PARTITION BY regulation, version, number) AS first_occ FROM b)
SELECT block_id, level > 3 AS collapsed FROM p WHERE (number = '3' OR parent = '3' OR starts_with(coalesce(parent, ''), '3.')) AND first_occ AND annex_id IS NULL""")
def chapter_selection(spark, sf_dir):
    return report.chapter_rows(structure.first_occurrence(blocks(spark, sf_dir, "regulation version pos type number parent level annex_id")), "3").select("block_id", "collapsed")


@register("rows_with_children", f"{BLOCKS} SELECT block_id FROM b WHERE number <> '' AND EXISTS (SELECT 1 FROM b c WHERE c.regulation = b.regulation AND c.version = b.version AND c.parent = b.number)")
def rows_with_children(spark, sf_dir):
    return report.with_children(blocks(spark, sf_dir, "regulation version number parent")).select("block_id")


@register("subtree", f"{BLOCKS} SELECT block_id FROM b WHERE starts_with(coalesce(number, ''), '2.3.')")
def subtree(spark, sf_dir):
    return report.subtree(blocks(spark, sf_dir, "number"), "2.3").select("block_id")


@register("page_model")
def page_model(spark, sf_dir):
    m = report.page_model(blocks(spark, sf_dir), pending(spark, sf_dir), table(spark, sf_dir, "glossary"), versions(spark, sf_dir))
    return m.select(*DOC, "pos", "uid", "display_number", "annex", "part_label", "nav_hidden", "nav_only_hidden", "first_occ", F.size(F.coalesce("refs", F.array())).alias("n_refs"), "text_annotated", "translation_annotated", "summary_ja_short")


from codexgrid.plans import composites  # noqa: E402, F401 (registers its queries)
