"""Text cut off by field limits (problem 5).

Length histograms per source and field, in characters and in bytes, are tested
for a spike at their maximum: values at a spike length without a closing mark
were cut by the field limit. Values that lost their end elsewhere (in transfer)
have no spike; they are found by their last words, which in the whole
collection are continued and never end a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexgrid.functions.text import WS
from codexgrid.plans.materialize import written

#: Marks after which a value of running text is complete.
CLOSED = r"[。．｡.!?！？）)」』】》:：;；]$"
#: A value of only such marks stands for no text.
BLANK = rf"^(?:{WS}|[-—–…・/]|(?i:n/?a|null|none))*$"
#: A page number at the end of a heading, with its leader.
LEADER = r"[\s.…]*[.…]{2,}[\s.…]*\d+$"
SPIKE_LEAST = 5  # values at the maximum
SPIKE_TIMES = 4.0  # times the mean of the lengths before it
SEEN_LEAST = 20  # occurrences after which a last word or word pair is judged
ENDS_SHARE = 0.02  # share of its occurrences at the end under which it doesn't end a value
SHARES = 1000  # an entry that a SHARES-th of all values meet is sent to them instead of being shuffled
PREFIX_TIMES = 20.0  # how much more frequent the longer word is than the fragment


def length_spikes(values: DataFrame) -> DataFrame:
    """The limit of each (source, field, unit) whose length histogram has a spike at its maximum.

    ``values`` has source, field, chars and bytes (the lengths; rows of length 0
    don't count). Columns: source, field, unit (``chars`` or ``bytes``), limit,
    at_limit (values at the limit) and slack (how far below it a cut value may
    lie: a stripped blank, a broken character).
    """
    h = values.filter("chars > 0").groupBy("source", "field", "chars", "bytes").count()
    unit = lambda name, slack: h.groupBy("source", "field", F.lit(name).alias("unit"), F.lit(slack).alias("slack"), F.col(name).alias("len")).agg(F.sum("count").alias("count"))
    h = unit("chars", 1).unionByName(unit("bytes", 2))
    top = Window.partitionBy("source", "field", "unit")  # lengths, not rows
    h = h.withColumn("limit", F.max("len").over(top))
    near = F.col("limit") - F.col("len")
    t = h.groupBy("source", "field", "unit", "slack", "limit").agg(
        F.sum(F.when(near <= F.col("slack"), F.col("count")).otherwise(0)).alias("at_limit"),
        (F.sum(F.when((near > F.col("slack")) & (near <= F.col("slack") + 10), F.col("count")).otherwise(0)) / 10.0).alias("before"),
    )
    return t.filter((F.col("at_limit") >= SPIKE_LEAST) & (F.col("at_limit") > SPIKE_TIMES * F.col("before") + 3)).drop("before")


def _tail(c: Column) -> Column:
    return F.regexp_replace(c, WS + "+$", "")


def _values(rows: DataFrame) -> DataFrame:
    """What the tests need of each value, written once: lengths, how it ends, and the text itself only of titles and of translations without a closing mark on either side."""
    one = lambda field: F.struct(F.lit(field).alias("field"), _tail(F.col(field)).alias("value"))
    v = rows.select(
        "block_id", F.coalesce("source", F.lit("")).alias("source"), _tail(F.coalesce("text", F.lit(""))).alias("text"), F.explode(F.array(one("title"), one("translation"))).alias("x")
    ).select("block_id", "source", "x.field", "x.value", "text").filter(F.col("value").isNotNull())
    title = F.col("field") == "title"
    value, text = F.col("value"), F.col("text")
    ends, going_on, colon = text.rlike(r"[.!?]$"), text.rlike(r"[;,]\s+(?:and|or)$"), text.rlike("[:;]$")
    open_ = ~title & ~ends & ~going_on & ~colon & (text != "")
    closed = value.rlike(CLOSED)
    went_on = value.rlike(r"(?:及び|または|又は|かつ|並びに|[;,；、]\s*(?:and|or))$")
    # its original ends and it doesn't, or it ends in a broken character
    lost = value.endswith("�") | ((ends | colon) & ~closed) | (going_on & ~went_on & ~value.rlike(r"[.!?。]$"))
    v = v.select(
        "block_id", "source", "field", F.length("value").alias("chars"), F.octet_length("value").alias("bytes"), closed.alias("closed"), (~title & value.rlike(BLANK)).alias("blank"), (~title & lost).alias("lost"),
        F.when(title | open_, value).alias("value"), F.when(open_, text).alias("text"),
    )
    return written(v, "truncation-values")


def _looked_up(rows: DataFrame, table: DataFrame, on: list[str], often: Column, how: str) -> DataFrame:
    """``rows`` joined with ``table``: entries that are ``often`` met (at most SHARES of them) go to the rows, the others in a shuffle."""
    hot, cold = F.broadcast(table.filter(often)), table.filter(~often)  # an entry met by a SHARES-th of all rows: SHARES entries at most
    rest = rows.join(hot.select(*on), on, "left_anti")
    return rows.join(hot, on, "left_semi" if how == "left_semi" else "inner").unionByName(rest.join(cold, on, how))


def _headings(titles: DataFrame, spikes: DataFrame) -> DataFrame:
    """Per last word pair of a heading: whether it ends headings (``pair_ends``) or shows a cut (``pair_cut``), from all headings below the limits; ``met``: the headings it ends."""
    words = F.split(F.lower(F.regexp_replace("value", LEADER, "")), r"[\s,]+")
    below = titles.join(spikes.filter("unit = 'chars'").select("source", "field", "limit"), ["source", "field"], "left").filter(F.col("limit").isNull() | (F.col("chars") < F.col("limit") - 1))
    # equal headings are cut into words once
    w = below.groupBy("value").agg(F.count("*").alias("times")).select(words.alias("w"), "times")
    n = F.size("w")
    at = F.posexplode(F.expr("transform(w, (x, i) -> struct(x as word, if(i > 0, concat(w[i-1], ' ', x), x) as pair, i = size(w)-1 as final))"))
    occ = w.filter(n > 0).select("times", at.alias("i", "x")).select("times", "x.*")
    pairs = occ.groupBy("word", "pair").agg(F.sum("times").alias("n"), F.sum(F.when(F.col("final"), F.col("times")).otherwise(0)).alias("e"))
    pairs = written(pairs, "truncation-pairs")
    by_word = pairs.groupBy("word").agg(F.sum("n").alias("wn"), F.sum("e").alias("we"))
    # fragments: words that a far more frequent word continues
    longer = by_word.filter(F.col("wn") >= SEEN_LEAST).select(F.explode(F.expr("transform(sequence(1, greatest(length(word) - 1, 1)), k -> substring(word, 1, k))")).alias("prefix"), F.col("wn").alias("ln"), F.length("word").alias("lw"))
    longer = longer.filter(F.length("prefix") < F.col("lw")).groupBy("prefix").agg(F.max("ln").alias("ln"))
    judged = pairs.join(by_word, "word").join(longer, by_word["word"] == F.col("prefix"), "left")
    enough = F.col("n") >= SEEN_LEAST
    never = lambda e, k: e < F.lit(ENDS_SHARE) * k
    cut = (
        F.when(enough, never(F.col("e"), F.col("n")))
        .when(F.col("wn") >= SEEN_LEAST, never(F.col("we"), F.col("wn")))
        .otherwise(F.lit(False))
        | F.coalesce(F.col("ln") >= F.lit(PREFIX_TIMES) * F.col("wn"), F.lit(False))
    )
    return judged.select("pair", cut.alias("pair_cut"), (F.col("e") >= F.lit(ENDS_SHARE) * F.col("n")).alias("pair_ends"), F.col("e").alias("met"))


def _limits(spikes: DataFrame) -> DataFrame:
    return spikes.groupBy("source", "field").agg(*(F.max(F.when(F.col("unit") == u, F.col("limit"))).alias(f"limit_{u}") for u in ("chars", "bytes")))


def _cut(v: DataFrame, spikes: DataFrame) -> DataFrame:
    """block_id, field, cut_by of the cut values of ``_values``."""
    total = v.count()
    often = F.col("met") * SHARES >= total
    v = v.join(_limits(spikes), ["source", "field"], "left")
    chars, byte = F.col("chars"), F.col("bytes")
    no = F.lit(False)

    t = v.filter("field = 'title' and chars > 0")
    words = F.split(F.lower(F.regexp_replace("value", LEADER, "")), r"[\s,]+")
    t = t.withColumn("w", words).withColumn("pair", F.expr("if(size(w) > 1, concat(w[size(w)-2], ' ', w[size(w)-1]), w[0])"))
    t = _looked_up(t, _headings(t.select("source", "field", "chars", "value"), spikes), ["pair"], often, "left")
    leader = F.col("value").rlike(LEADER)
    marked = F.col("value").rlike(r"[)\]）]$") | leader
    # a pair seen only at the limit is judged by its absence: it ends no heading
    full = F.coalesce(chars >= F.col("limit_chars"), no) & ~F.col("closed") & ~leader
    almost = F.coalesce(chars == F.col("limit_chars") - 1, no) & ~F.coalesce(F.col("pair_ends"), no) & ~F.col("closed") & ~leader
    # one closed by a mark lost its end all the same if no heading ends so
    stopped = F.coalesce(chars >= F.col("limit_chars"), no) & ~leader & ~F.coalesce(F.col("pair_ends"), no)
    titles = t.withColumn("cut_by", F.when(full | almost, "limit").when(stopped | (F.coalesce(F.col("pair_cut"), no) & ~marked), "transfer"))

    r = v.filter("field = 'translation' and not blank")
    at_limit = F.coalesce(chars >= F.col("limit_chars") - 1, no) | F.coalesce(byte >= F.col("limit_bytes") - 2, no)
    r = r.withColumn("cut_by", F.when(at_limit & ~F.col("closed"), "limit").when(F.col("lost"), "transfer"))
    # originals without a closing mark: the usual translation tells whether this one is whole
    counts = r.filter("text is not null").groupBy("text", "value").agg(F.count("*").alias("met"))
    usual = counts.groupBy("text").agg(F.max_by("value", F.struct("met", F.length("value"), "value")).alias("usual"))
    short = counts.join(usual, "text").filter((F.col("usual") != F.col("value")) & F.col("usual").startswith(F.col("value"))).select("text", "value", "met")
    short = _looked_up(r.filter("text is not null and cut_by is null"), short, ["text", "value"], often, "left_semi").withColumn("cut_by", F.lit("transfer"))
    found = titles.select("block_id", "field", "cut_by").unionByName(r.select("block_id", "field", "cut_by")).unionByName(short.select("block_id", "field", "cut_by"))
    return found.filter("cut_by is not null").groupBy("block_id", "field").agg(F.min("cut_by").alias("cut_by"))


def truncated_values(rows: DataFrame) -> DataFrame:
    """(block_id, field_name, cut_by) of the cut ``title`` and ``translation`` values.

    ``limit``: a value at a spike length of its source without a mark that
    closes it. ``transfer``: no spike tells; a title is cut if its last words
    never end a title, or its last word is a fragment of a frequent one; a
    translation is cut if its original ends with a mark and it doesn't, if it
    ends in a broken character, or if it is a proper beginning of the usual
    translation of the same unpunctuated original.

    Defined results: rows given again count once by ``block_id`` (null ids form
    one id; ``limit`` goes before ``transfer``); null, empty and placeholder
    values are not cut; a null source is a source of its own; an empty table
    yields no row; other columns are ignored.
    """
    v = _values(rows)
    return _cut(v, length_spikes(v)).withColumnRenamed("field", "field_name")


def truncation_report(rows: DataFrame) -> DataFrame:
    """Per source and field: values, cut values (by limit, in transfer), their share and the limit found (null without one)."""
    v = _values(rows)
    spikes = length_spikes(v)
    n = v.filter("chars > 0").select("block_id", "source", "field").distinct()
    t = n.join(_cut(v, spikes), ["block_id", "field"], "left").groupBy("source", "field").agg(F.count("*").alias("n_values"), F.count("cut_by").alias("n_cut"), F.count_if(F.col("cut_by") == "limit").alias("n_cut_by_limit"))
    t = t.join(_limits(spikes), ["source", "field"], "left")
    return t.select("source", F.col("field").alias("field_name"), "n_values", "n_cut", "n_cut_by_limit", (F.col("n_cut") / F.col("n_values")).alias("cut_share"), "limit_chars", "limit_bytes")
