"""Scalar expressions and predicates on the rows of a document.

Every function takes and gives columns; nothing here leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codexgrid.functions.text import WS, strip

#: Boiler-plate that never is a heading.
NOISE_TITLE = (
    r"(?i)^Note by the secretariat\b|(?:E/)?ECE/(?:TRANS/WP\.29)?/\S|TRANS/WP\.29/\S"
    r"|^As defined in the Consolidated Resolution on the Construction of Vehicles\b|^The distinguish(?:ing)? numbers? of the Contracting Parties\b"
)
#: Fixed value: lines that repeat at the top of pages.
PAGE_HEADER = r"(?mdi)^(?:(?:E/)?ECE/[^\n]*|(?:UN\s+)?Regulation\s+No\.?\s*\d+\s*|page\s+\d+\s*)$"
#: Fixed value: the running header of an annex or appendix page.
ANNEX_PAGE = r"(?i)^Annex\s+\d+\s*(?:[-–—]\s*Appendix\s+(\d+)\s*)?$"


def text0(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# identity, numbering -----------------------------------------------------------------------------------------------


def uid(regulation: Column, text: Column, digits: int = 8) -> Column:
    """Content identity: regulation and the first hex digits of a hash of regulation and squashed text."""
    flat = F.trim(F.regexp_replace(text0(text), WS + "+", " "))
    return F.concat(regulation, F.lit("-"), F.substring(F.sha2(F.concat(regulation, F.lit(":"), flat), 256), 1, digits))


def image_uid(regulation: Column, page: Column, bbox: Column, label: Column, digits: int = 8) -> Column:
    """Identity of an image from its page, box (each bound with one decimal at least) and label."""
    box = F.concat(F.lit("("), F.array_join(F.transform(bbox, lambda v: v.cast("string")), ", "), F.lit(")"))
    body = F.concat(regulation, F.lit(":img:p"), page.cast("string"), F.lit(":"), box, F.lit(":"), text0(label))
    return F.concat(regulation, F.lit("-img-"), F.substring(F.sha2(body, 256), 1, digits))


def level(number: Column) -> Column:
    return F.length(number) - F.length(F.replace(number, F.lit("."), F.lit(""))) + 1


def parent(number: Column) -> Column:
    return F.when(F.instr(number, ".") > 0, F.regexp_extract(number, r"^(.*)\.[^.]*$", 1))


def path(number: Column) -> Column:
    """The numeric components; null if any isn't a number (arrays order like numbers of headings)."""
    parts = F.transform(F.split(number, r"\."), lambda x: x.try_cast("int"))
    return F.when(F.forall(parts, lambda x: x.isNotNull()), parts)


def top(number: Column) -> Column:
    """The first component as a number; null where it isn't one."""
    return F.split_part(number, F.lit("."), F.lit(1)).try_cast("int")


def valid_number(number: Column) -> Column:
    """Every component is a number of at least 1."""
    p = path(number)
    return F.coalesce(F.forall(p, lambda x: x >= 1), F.lit(False))


def document_rank(regulation: Column) -> Column:
    """Order of regulations: R.E.3 first, R<number> by number, then the rest by name."""
    n = F.regexp_extract(regulation, r"^R(\d+)$", 1)
    return F.when(regulation == "R.E.3", F.struct(F.lit(0).alias("k"), F.lit(0).alias("n"), F.lit("").alias("s"))).when(n != "", F.struct(F.lit(1).alias("k"), n.try_cast("int").alias("n"), F.lit("").alias("s"))).otherwise(
        F.struct(F.lit(2).alias("k"), F.lit(0).alias("n"), regulation.alias("s"))
    )


def natural_version(version: Column) -> Column:
    """Versions in the order people read them: Rev9 before Rev10."""
    return F.struct(F.lower(F.regexp_replace(version, r"\d+.*$", "")).alias("s"), F.regexp_extract(version, r"(\d+)", 1).try_cast("int").alias("n"), F.lower(version).alias("v"))


# text --------------------------------------------------------------------------------------------------------------


def clean_text(text: Column, footnotes: bool = True) -> Column:
    """Footnote marks off (if asked), each line stripped, blank lines dropped, the rest joined by single blanks."""
    lines = F.split(F.regexp_replace(text, r"(?md)^\s*\d+\)\s+", "") if footnotes else text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")
    return F.array_join(F.filter(F.transform(lines, strip), lambda x: x != ""), " ")


def strip_page_headers(text: Column) -> Column:
    return F.regexp_replace(text, PAGE_HEADER, "")


def without_leader(title: Column) -> Column:
    """A heading without dot leader and page number."""
    return F.regexp_replace(F.regexp_replace(text0(title), r"(?s)\s*\.{4,}.*", ""), r"[. ]+$", "")


def bare(text: Column) -> Column:
    """Without leaders of dots and a page number at the end, spaces collapsed."""
    t = F.regexp_replace(text0(text), r"[.…]{2,}", " ")
    return strip(F.regexp_replace(F.regexp_replace(t, r"\s+\d+\s*$", ""), r"\s+", " "))


def strip_repeated_header(body: Column, header: Column) -> Column:
    """``body`` without the header that begins it, however often, with or without a dash or colon between."""
    h = strip(text0(header))
    quoted = F.concat(F.lit(r"(?i)^(?:\Q"), F.replace(h, F.lit(r"\E"), F.lit("")), F.lit(r"\E\s*[-–—:：]?\s*)+"))
    return F.when((text0(body) == "") | (h == ""), body).otherwise(strip(F.regexp_replace(strip(text0(body)), quoted, F.lit(""))))


def inline_list(text: Column) -> Column:
    """A line break before (b), (c) ... of a running list that begins with (a)."""
    return F.when(F.contains(text, F.lit("(a)")) & text.rlike(r"\([b-z]\)"), F.regexp_replace(text, r"([ 、。])\(([b-z])\)", "$1<br>($2)")).otherwise(text)


def short_summary(text: Column) -> Column:
    """The first sentence with its 。; all where there is none."""
    return F.when(F.instr(text, "。") > 0, F.substring(text, F.lit(1), F.instr(text, "。"))).otherwise(text)


def progress(done: Column, total: Column) -> Column:
    """Per cent, truncated; 0 of nothing."""
    return F.when(total > 0, (done.cast("double") / total.cast("double") * 100).cast("int")).otherwise(0)


def part_label(index: Column) -> Column:
    return F.when(index < 26, F.char(index + 65)).otherwise((index + 1).cast("string"))


def escape_html(text: Column) -> Column:
    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


# predicates --------------------------------------------------------------------------------------------------------


def kind(type_: Column) -> Column:
    return F.coalesce(type_, F.lit("paragraph"))


def noise_title(title: Column) -> Column:
    """Not a heading: boiler-plate, no word of three letters, or over 100 characters without its leader."""
    t = text0(title)
    return t.rlike(NOISE_TITLE) | ~t.rlike("[A-Za-z]{3,}") | (F.length(without_leader(t)) > 100)


def toc_overflow(text: Column) -> Column:
    """A table-of-contents line whose leader ran into the text: text without colon, four dots or more, perhaps a page number."""
    return text0(text).rlike(r"(?s)^[^:]*?\.{4,}(?:\s*\d{1,3})?\s*$")


def toc_like(title: Column, text: Column) -> Column:
    """A row that holds no more than its heading, leader and page number."""
    return F.length(bare(text)) <= F.length(bare(title)) + 20


def has_leader(title: Column, text: Column) -> Column:
    return F.contains(text0(title), F.lit("......")) | F.contains(text0(text), F.lit("......"))


def page_header_kind(type_: Column, number: Column, title: Column) -> Column:
    """null: no running header; 0: of an annex; M: of its appendix M. Its number is a page number of three digits or more."""
    t = strip(text0(title))
    hit = (kind(type_) != "image") & strip(text0(number)).rlike(r"^\d{3,}$") & t.rlike(ANNEX_PAGE)
    m = F.regexp_extract(t, ANNEX_PAGE, 1)
    return F.when(hit, F.when(m == "", 0).otherwise(m.try_cast("int")))


def footnote_candidate(type_, hidden, level_, annex, number, title, text) -> Column:
    """A long numbered line of an annex that may be a footnote rather than a section."""
    t = strip(text0(title))
    return (kind(type_) != "image") & ~hidden & (level_ == 1) & annex.isNotNull() & strip(text0(number)).rlike(r"^\d{1,2}$") & (F.length(t) >= 60) & ~has_leader(t, text) & ~t.rlike("[:：]$")


def table_cell(title: Column) -> Column:
    """A short title that is a row of a table printed as text: words, a unit and a digit, widely spaced."""
    return (F.length(text0(title)) < 50) & text0(title).rlike(r"\s{2,}\S+\s{2,}\d\s*$")


def overlaps(a: Column, b: Column, margin: float) -> Column:
    """Boxes (x0, y0, x1, y1) that touch once either is widened by the margin."""
    return (a[0] - margin <= b[2]) & (b[0] - margin <= a[2]) & (a[1] - margin <= b[3]) & (b[1] - margin <= a[3])


def under(number: Column, parent_: Column, prefix: str) -> Column:
    """The chapter itself or anything below it."""
    return (number == prefix) | (parent_ == prefix) | F.startswith(text0(parent_), F.lit(prefix + "."))


def at_prefix(number: Column, prefix: str) -> Column:
    return (number == prefix) | F.startswith(text0(number), F.lit(prefix + "."))
