"""Line dedup by a segment-partition edit join.

A line within tau edits of another keeps at least one of the other's tau + 1
segments whole, shifted by few places. Every line is indexed by its segments;
it probes with the substrings at the places that a segment of a line of each
near length can have moved to, so that a pair meets in an equi-join. Only keys
are dealt for all lines, with a hash of the line and not its text; where a key
belongs to a single line, its rows end there. The lines left are compared by
letter counts and banded edit distance in the join, so that no pair further
apart becomes a row. Equal lines have the same keys and hash, and are one there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearyard.functions.numbering import copies
from gearyard.llm.common import stored

EDITS = 2
# Shorter lines are only compared for equality: a few edits make another line of them.
LEAST_LENGTH = 24
# Lists of lines to verify up to this many rows (some dozen MB) are broadcast.
BROADCAST_ROWS = 500_000
# At most so many lines that come often are broadcast, so that each is dealt once.
OFTEN_ROWS = 100_000

# Letters counted one by one; an edit changes the counts by two in all at most.
_LETTERS = (("eé", "aá", "oó", "t", "nñ", "h", "rl", "su"), ("ií", "dq", "wk", "yj", "gx", "cz", "bv", "mfp"))
# A line with this is not blank.
_WORDED = r"[^\x20\x09-\x0D]"


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, t1, t2, copies): each different row once, with how often it comes.

    Only rows whose id and text hash come more than once are put together; the
    others keep where they lie.
    """
    keyed = docs.select("doc_id", "text", *[h(F.coalesce(F.col("text"), F.lit(""))).alias(k) for k, h in (("t1", F.xxhash64), ("t2", F.hash))])
    key = ["doc_id", "t1", "t2"]
    again = stored(keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key), "again")
    n = again.limit(BROADCAST_ROWS + 1).count()
    if not n:
        return keyed.withColumn("copies", F.lit(1).cast("long"))
    listed = (F.broadcast(again) if n <= BROADCAST_ROWS else again).alias("a")
    same = F.col("k.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("k.t1") == F.col("a.t1")) & (F.col("k.t2") == F.col("a.t2"))
    once = keyed.alias("k").join(listed, same, "left_anti").withColumn("copies", F.lit(1).cast("long"))
    more = keyed.alias("k").join(listed, same, "left_semi").withColumn("text", F.coalesce("text", F.lit("")))
    return once.unionByName(more.groupBy("doc_id", "text", "t1", "t2").agg(F.count(F.lit(1)).alias("copies")))


def line_rows(keyed: DataFrame, blank: bool = False) -> DataFrame:
    """(doc_id, t1, t2, copies, line_no, line): the lines with a word; a text without any has one row, of NULLs.

    No two rows share doc_id, t1, t2 and line_no; ``line_no`` counts all lines,
    from 0. With ``blank`` lines without a word are rows, too.
    """
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    lines = F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    worded = lines if blank else F.filter(lines, lambda x: x.line.rlike(_WORDED))
    return keyed.select("doc_id", "t1", "t2", "copies", F.explode_outer(worded).alias("l")).select(
        "doc_id", "t1", "t2", "copies", F.col("l.i").alias("line_no"), F.col("l.line").alias("line")
    )


def _segment(length: Column, index: Column, edits: int) -> tuple[Column, Column]:
    """(start, size) of a segment of a line of some length: even parts, the last ones one longer."""
    size, longer = F.floor(length / (edits + 1)), F.pmod(length, F.lit(edits + 1))
    first_longer = F.lit(edits + 1) - longer
    start = index * size + F.greatest(F.lit(0), index - first_longer)
    return start.cast("int"), (size + (index >= first_longer).cast("int")).cast("int")


def _probes(edits: int) -> list[tuple[int, int, int]]:
    """(segment, how much shorter the other line is, shift): where a segment can have moved to.

    Before segment i at most i edits are spent, after it at most edits - i.
    """
    return [
        (i, less, shift)
        for less in range(edits + 1) for i in range(edits + 1)
        for shift in range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1)
    ]


def _letter_counts(line: Column, classes: tuple[str, ...]) -> Column:
    """How often the letters of each class come, modulo 256, in a byte each."""
    counts = F.lit(0).cast("long")
    for k, letters in enumerate(classes):
        n = F.length(F.regexp_replace(F.lower(line), f"[^{letters}]+", "")).cast("long").bitwiseAND(255)
        counts = counts.bitwiseOR(F.shiftleft(n, 8 * k))
    return counts


def near_pairs(lines: DataFrame, edits: int) -> DataFrame:
    """(a1, a2, b1, b2): hashes of lines at edit distance 1 to ``edits``, from (h1, h2, line, n).

    Lines may come repeatedly. Keys are dealt with h1 alone; lines that share it
    are told apart by h2 when they are compared.
    """
    which = F.explode(F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in zip(("i", "less", "shift"), p)]) for p in _probes(edits)]))
    i = F.explode(F.sequence(F.lit(0), F.lit(edits)))
    start, size = _segment(F.col("n"), F.col("i"), edits)
    index = lines.select("h1", "n", "line", i.alias("i")).select(
        F.xxhash64("i", "n", F.substring(F.col("line"), start + 1, size)).alias("key"), "h1"
    )
    other = F.col("n") - F.col("p.less")
    start, size = _segment(other, F.col("p.i"), edits)
    place = start + F.col("p.shift")
    probe = lines.select("h1", "n", "line", which.alias("p")).filter((place >= 0) & (place + size <= F.col("n"))).select(
        F.xxhash64("p.i", other.cast("int"), F.substring(F.col("line"), place + 1, size)).alias("key"), "h1"
    )
    # what can meet another line than itself
    holders = index.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    asked = probe.join(holders, "key").filter((F.col("low") != F.col("h1")) | (F.col("high") != F.col("h1")))
    asked = stored(asked.select("key", "h1").distinct(), "asked")
    keys = asked.select("key").distinct()
    few = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    held = stored(index.join(F.broadcast(keys) if few else keys, "key", "left_semi").distinct(), "held")
    wanted = stored(asked.select("h1").union(held.select("h1")).distinct(), "wanted")
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    text = lines.join(F.broadcast(wanted) if few else wanted, "h1", "left_semi").select("h1", "h2", "n", "line").distinct()
    text = stored(text.select(
        "h1", "h2", "n", "line", *[_letter_counts(F.col("line"), classes).alias(f"counts{g}") for g, classes in enumerate(_LETTERS)]
    ), "compared")
    one, two = (side.join(text, "h1").select("key", *[F.col(c).alias(f"{c}_{x}") for c in text.columns])
                for side, x in ((held, "a"), (asked, "b")))
    # counts hold a letter in each byte, modulo 256: differences are taken byte by byte
    apart = sum(
        F.least(F.pmod(d, F.lit(256)), F.pmod(-d, F.lit(256)))
        for g, classes in enumerate(_LETTERS) for k in range(len(classes))
        for d in [F.shiftrightunsigned(f"counts{g}_a", 8 * k).bitwiseAND(255) - F.shiftrightunsigned(f"counts{g}_b", 8 * k).bitwiseAND(255)]
    )
    before = (F.col("h1_a") < F.col("h1_b")) | ((F.col("h1_a") == F.col("h1_b")) & (F.col("h2_a") < F.col("h2_b")))
    may = ((F.col("n_a") < F.col("n_b")) | before) & (apart <= 2 * edits)
    # with a threshold the edit distance is computed in a band around the diagonal; equal lines have 0
    near = F.when(may, F.levenshtein("line_a", "line_b", edits) >= 1)
    return one.join(two, "key").filter(near).select(
        F.col("h1_a").alias("a1"), F.col("h2_a").alias("a2"), F.col("h1_b").alias("b1"), F.col("h2_b").alias("b2")
    ).distinct()


def _decided(keyed: DataFrame, edits: int, least_length: int, blank: bool = False) -> DataFrame:
    """The rows of ``line_rows`` with (leads, near, links).

    ``leads``: the line is the first of its text, NULL for a blank one; ``near``,
    ``links``: what was found for that text.
    """
    rows = line_rows(keyed).withColumns({"h1": F.xxhash64("line"), "h2": F.hash("line")})
    # Unique for each line of a text: by doc_id, NULL last, then hash of the text, then line number.
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t1", "t2", "line_no")
    found = F.min(at).alias("first"), F.count(F.lit(1)).alias("n_rows")
    heads = stored(rows.filter("line is not null").groupBy("h1", "h2").agg(*found), "heads")
    # Of a line that comes often only the first is compared; there can't be more than OFTEN_ROWS of them.
    often = F.greatest(F.lit(1), F.lit(heads.agg(F.sum("n_rows")).first()[0] or 0) / OFTEN_ROWS)
    often = heads.filter(F.col("n_rows") > often).select("h1", "h2", F.col("first").alias("lone"))
    lines = rows.filter(F.length("line") >= least_length).join(F.broadcast(often), ["h1", "h2"], "left")
    lines = lines.filter(F.col("lone").isNull() | (at == F.col("lone")))
    lines = stored(lines.select("h1", "h2", "line", F.length("line").alias("n")), "lines")
    near = stored(near_pairs(lines, edits), "near")
    both = near.unionByName(near.select(*[F.col(x).alias(y) for x, y in (("b1", "a1"), ("b2", "a2"), ("a1", "b1"), ("a2", "b2"))]))
    when = heads.join(both.select(F.col("a1").alias("h1"), F.col("a2").alias("h2")).distinct(), ["h1", "h2"])
    when = stored(when.select("h1", "h2", "first"), "when")
    linked = both.join(when.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("first").alias("other")), ["b1", "b2"])
    linked = linked.groupBy(F.col("a1").alias("h1"), F.col("a2").alias("h2")).agg(
        F.count(F.lit(1)).alias("links"), F.min("other").alias("earliest")
    )
    decided = linked.join(when, ["h1", "h2"]).select("h1", "h2", "links", (F.col("earliest") < F.col("first")).alias("near"))
    heads = stored(heads.drop("n_rows").join(decided, ["h1", "h2"], "left"), "decided")
    if blank:
        worded = F.when(F.col("line").rlike(_WORDED), F.col("line"))
        rows = line_rows(keyed, True).withColumns({"h1": F.xxhash64(worded), "h2": F.hash(worded)})
    return rows.join(heads, ["h1", "h2"], "left").select(
        *rows.columns[:6], (at == F.col("first")).alias("leads"),
        F.coalesce("near", F.lit(False)).alias("near"), F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )


def line_decisions(docs: DataFrame, edits: int = EDITS, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, t1, t2, copies, line_no, line, decision, links): a row for each line of each different row.

    ``decision`` is ``keep``, ``equal`` or ``near``, as ``dedup_lines`` counts
    them; ``blank`` lines have no word and stay. ``t1`` and ``t2`` are hashes of the
    text. ``copies`` is how often the row comes: the decision is that of the
    first, all lines of the others but blank ones are equal to its lines.
    ``links`` counts the different lines within reach of the line's text. A NULL
    or empty text has one blank line.
    """
    told = _decided(_keyed(docs), edits, least_length, True)
    decision = F.when(F.col("leads").isNull(), "blank").when(~F.col("leads"), "equal").when(F.col("near"), "near").otherwise("keep")
    return told.select("doc_id", "t1", "t2", "copies", "line_no", "line", decision.alias("decision"), "links")


def clean_texts(docs: DataFrame, edits: int = EDITS, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, text): every row with the lines that stay, in order.

    Blank lines stay; a text of which no line with a word stays is empty, as a
    NULL one is. Of repeated rows the first has the kept lines, the others none.
    """
    stays = F.col("decision").isin("keep", "blank")
    line = F.when(stays, F.struct("line_no", "line"))
    whole = line_decisions(docs, edits, least_length).groupBy("doc_id", "t1", "t2").agg(
        F.max("copies").alias("copies"), F.max(F.col("decision") == "keep").alias("any"),
        F.array_sort(F.collect_list(line)).alias("lines"),
    )
    text = F.when(F.col("any"), F.array_join(F.transform("lines", lambda x: x.line), "\n")).otherwise("")
    numbered = copies(whole.select("doc_id", text.alias("text"), "copies"), F.lit(1).cast("long"), F.col("copies"), "copy")
    return numbered.select("doc_id", F.when(F.col("copy") == 1, F.col("text")).otherwise("").alias("text"))


def dedup_lines(docs: DataFrame, edits: int = EDITS, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, n_lines, n_equal, n_near, n_links, n_kept): one row per doc_id.

    Counts lines with a word. A line goes if an equal one comes before it
    (``n_equal``), by doc_id, NULL last, then hash of the text, then place; or
    else if one within ``edits`` edits does (``n_near``; both of
    ``least_length`` characters at least). All is judged on the input. Every
    line but one of an equal set goes, also where rows share an id or repeat.
    ``n_links`` counts the different lines within reach of the document's lines
    that are the first of their text. Rows of one doc_id are one document; NULL
    and empty texts have no lines.
    """
    told = _decided(_keyed(docs), edits, least_length)
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    counted = told.groupBy("doc_id").agg(
        total(F.when(F.col("leads").isNotNull(), F.col("copies"))).alias("n_lines"),
        total(F.col("copies") - F.col("leads").cast("int")).alias("n_equal"),
        F.count_if(F.col("leads") & F.col("near")).alias("n_near"),
        total(F.when(F.col("leads"), F.col("links"))).alias("n_links"),
    )
    return counted.withColumn("n_kept", F.col("n_lines") - F.col("n_equal") - F.col("n_near"))
