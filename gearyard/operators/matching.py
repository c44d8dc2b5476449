"""Matching of search texts and licence plates against the needs list.

All needs are matched, however many. Containment tests are
turned into equi-joins over a q-gram index: every substring of up to ``GRAM``
characters of a need's text, code and words goes into it, so its rows grow
linearly with the length. A search text or word looks up only its rarest gram
(itself, if shorter), and every hit is verified by ``contains``; a need word
inside a search word is keyed by its own rarest gram, which the search word
gives among all its short substrings. No search meets a need it shares nothing
with, and equal searches are matched once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearyard.functions.numbering import numbered_in_order
from gearyard.functions.skew import salted_join
from gearyard.functions.text import (
    has_text,
    normalize_text,
    plate_key,
    synonym_pairs,
    variants,
    words,
)
from gearyard.operators.needs import need_order
from gearyard.operators.views import DESCRIPTORS, folded_code
from gearyard.session import scratch_dir

# Points per kind of hit, and the shortest word that counts.
TEXT_POINTS, VARIANT_POINTS, WORD_POINTS, CODE_POINTS = 100, 50, 10, 200
SHORTEST_WORD = 2
# Grams of the containment index: every substring of up to this many characters.
GRAM = 3


def with_pieces(rows: DataFrame, word: str, longest: Column | None = None) -> DataFrame:
    """One row per distinct non-empty substring of ``word``, as ``piece``.

    A repeated substring is kept where it first occurs. ``longest`` bounds the
    length of pieces nothing longer can match.
    """
    length = F.length(word)
    sizes = F.sequence(F.lit(1), length if longest is None else F.least(length, longest))
    return (
        rows.filter(length > 0)
        .withColumn("_size", F.explode(sizes))
        .withColumn("_start", F.explode(F.sequence(F.lit(1), length - F.col("_size") + 1)))
        .withColumn("piece", F.substring(F.col(word), F.col("_start"), F.col("_size")))
        .filter(F.position("piece", word) == F.col("_start"))
        .drop("_size", "_start")
    )


def search_variants(searches: DataFrame) -> DataFrame:
    """(search_id, variant): distinct spellings; an empty text has none."""
    filled = searches.filter(F.col("text") != "")
    return filled.select("search_id", F.explode(variants(normalize_text(F.col("text")))).alias("variant"))


def synonym_hits(searches: DataFrame) -> DataFrame:
    """(term, word, n_searches): how many searches hold each synonym."""
    norm = normalize_text(F.col("text"))
    held = F.filter(synonym_pairs(), lambda pair: F.contains(norm, pair["word"]))
    return (
        searches.select(F.explode(held).alias("pair")).select("pair.term", "pair.word")
        .groupBy("term", "word").agg(F.count(F.lit(1)).alias("n_searches"))
    )


def ranked_needs(needs: DataFrame) -> DataFrame:
    """Needs with their place in the list, which settles equal scores. Stored, since matching reads them several times."""
    return numbered_in_order(needs, need_order(needs), "need_rank", f"{scratch_dir(needs.sparkSession)}/needs")


def _need_texts(needs: DataFrame) -> DataFrame:
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("code", *DESCRIPTORS)]
    return needs.select(
        "need_rank",
        normalize_text(F.concat_ws(" ", *fields)).alias("need_text"),
        F.coalesce(folded_code(), F.lit("")).alias("need_code"),
    )


def grams(text: Column, q: int = GRAM) -> Column:
    """Distinct substrings of ``text`` of at most ``q`` characters: at most ``q``
    for each character, so linear in the length."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    pieces = F.flatten(F.transform(places, lambda i: F.array(*(F.substring(text, i, k) for k in range(1, q + 1)))))
    return F.array_distinct(F.filter(pieces, lambda piece: piece != ""))


def _rarest(rows: DataFrame, text: str, keep: list[str], counts: DataFrame) -> DataFrame:
    """``rows`` (distinct on ``keep`` and ``text``) with ``key``: the text itself if
    shorter than ``GRAM``, else the gram of it that fewest index rows hold (ties:
    the smallest). Whatever contains the text holds that key."""
    short = rows.filter(F.length(text) < GRAM).select(*keep, text, F.col(text).alias("key"))
    places = F.sequence(F.lit(1), F.length(text) - GRAM + 1)
    every = rows.filter(F.length(text) >= GRAM).select(
        *keep, text, F.explode(F.array_distinct(F.transform(places, lambda i: F.substring(text, i, GRAM)))).alias("key")
    )
    counted = every.join(counts, "key", "left").select(
        *keep, text, F.struct(F.coalesce("n_index", F.lit(0)).alias("n"), F.col("key").alias("key")).alias("_best")
    )
    best = counted.groupBy(*keep, text).agg(F.min("_best").alias("_best")).select(*keep, text, F.col("_best.key").alias("key"))
    return short.unionByName(best)


def _counts(index: DataFrame) -> DataFrame:
    return index.groupBy("key").agg(F.count(F.lit(1)).alias("n_index"))


def _text_points(norms: DataFrame, texts: DataFrame) -> DataFrame:
    """(norm, need_rank, points) of the spellings of each search that a need's
    text or code holds: found by the rarest gram, then verified."""
    index = texts.select(
        "need_rank", F.explode(F.array_distinct(F.concat(grams(F.col("need_text")), grams(F.col("need_code"))))).alias("key")
    )
    probes = norms.select("norm", F.explode(variants(F.col("norm"))).alias("probe")).filter(F.col("probe") != "").distinct()
    hits = _rarest(probes, "probe", ["norm"], _counts(index)).join(index, "key").join(texts, "need_rank")
    in_text = F.contains(F.col("need_text"), F.col("probe"))
    in_code = F.contains(F.col("need_code"), F.col("probe"))
    own = F.col("probe") == F.col("norm")
    points = (
        F.when(in_text, VARIANT_POINTS).otherwise(0)
        + F.when(own & in_text, TEXT_POINTS).otherwise(0)
        + F.when(own & in_code, CODE_POINTS).otherwise(0)
    )
    return hits.select("norm", "need_rank", points.cast("long").alias("points"))


def _word_points(norms: DataFrame, texts: DataFrame) -> DataFrame:
    """(norm, need_rank, points): 10 for each pair of a search word (two
    characters or more) and a need text word of which one contains the other.

    A need word that contains the search word holds the search word's rarest
    gram; a need word inside the search word is keyed by its own rarest gram,
    which the search word, giving all its short substrings, then holds.
    """
    need_words = (
        texts.select("need_rank", F.explode(words(F.col("need_text"))).alias("need_word"))
        .groupBy("need_rank", "need_word").agg(F.count(F.lit(1)).alias("mult"))
    )
    index = need_words.select("need_rank", "need_word", "mult", F.explode(grams(F.col("need_word"))).alias("key"))
    counts = _counts(index)
    counted = (
        norms.select("norm", words(F.col("norm")).alias("all"))
        .select("norm", "all", F.explode(F.array_distinct("all")).alias("word"))
        .filter(F.length("word") >= SHORTEST_WORD)
        .select("norm", "word", F.size(F.filter("all", lambda w: w == F.col("word"))).alias("weight"))
    )
    around = (
        _rarest(counted, "word", ["norm", "weight"], counts).join(index, "key")
        .filter(F.contains(F.col("need_word"), F.col("word")))
    )
    keyed = _rarest(need_words, "need_word", ["need_rank", "mult"], counts)
    inside = (
        counted.select("norm", "word", "weight", F.explode(grams(F.col("word"))).alias("key"))
        .join(keyed, "key")
        .filter((F.col("need_word") != F.col("word")) & F.contains(F.col("word"), F.col("need_word")))
    )
    points = (WORD_POINTS * F.col("weight") * F.col("mult")).cast("long").alias("points")
    return around.select("norm", "need_rank", points).unionByName(inside.select("norm", "need_rank", points))


def smart_match(searches: DataFrame, needs: DataFrame) -> DataFrame:
    """Needs matching each search text, best score first.

    Score: 100 if the need's text contains the search, 50 per spelling variant
    it contains, 10 per pair of a search word and a need word of which one
    contains the other, 200 if the code contains the search. Needs without a
    point are left out; equal scores keep the order of the needs list. A blank
    search lists all needs, without a score.
    """
    ranked = ranked_needs(needs)
    texts = _need_texts(ranked)
    asked = searches.select("search_id", normalize_text(F.col("text")).alias("norm"))
    norms = asked.select("norm").distinct()

    blank = texts.select(F.lit("").alias("norm"), "need_rank", F.lit(0).cast("long").alias("points"))
    points = _text_points(norms, texts).unionByName(_word_points(norms, texts)).unionByName(
        blank.join(norms, "norm", "left_semi")
    )
    scored = (
        points.groupBy("norm", "need_rank").agg(F.sum("points").alias("score"))
        .filter((F.col("score") > 0) | (F.col("norm") == ""))
    )
    # A search text may match as many needs as there are: numbered over all texts, then from each text's first.
    order = [F.asc("norm"), F.desc("score"), F.asc("need_rank")]
    placed = numbered_in_order(scored, order, "_number", f"{scratch_dir(searches.sparkSession)}/scored")
    starts = placed.groupBy("norm").agg(F.min("_number").alias("_start"))
    placed = salted_join(placed, starts, ["norm"], "inner", spread=["need_rank"])
    matched = placed.withColumn("rank", (F.col("_number") - F.col("_start") + 1).cast("int")).join(ranked, "need_rank")
    return salted_join(asked, matched, ["norm"], "inner", spread=["search_id"]).select(
        "search_id", *needs.columns, "score", "rank"
    )


def plate_lookup(searches: DataFrame, plates: DataFrame) -> DataFrame:
    """First vehicle of each searched plate, spelled in any way.

    Equal plates are reduced to their first entry before the join, so that a
    plate stored very often is one row there.
    """
    fields = ["plate", "code", "brand", "model", "year", "energy"]
    vehicles = (
        plates.groupBy(plate_key(F.col("plate")).alias("_key"))
        .agg(F.min(F.struct(*fields)).alias("vehicle"))
    )
    asked = searches.filter(has_text(F.col("plate"))).select("search_id", plate_key(F.col("plate")).alias("_key"))
    return salted_join(asked, vehicles, ["_key"], "inner", spread=["search_id"]).select("search_id", *[F.col(f"vehicle.{f}").alias(f) for f in fields])


def needs_for_plate(plates: DataFrame, needs: DataFrame) -> DataFrame:
    """Needs of each plate's vehicle, from the first tier that has any.

    Tier 1: the exact code. Tier 2: needs whose brand and energy contain the
    vehicle's (a blank one passes, but not both). Tier 3: the whole list, which
    is not written out for each plate: one row without a need stands for it.
    """
    ranked = ranked_needs(needs)
    profile = ["_code", "_brand", "_energy"]

    def folded(column: str) -> Column:
        return F.upper(F.coalesce(F.col(column), F.lit("")))

    vehicles = plates.select(
        "plate", folded("code").alias("_code"), folded("brand").alias("_brand"), folded("energy").alias("_energy")
    )
    profiles = vehicles.select(*profile).distinct()
    listed = ranked.select(
        "need_rank", F.upper("code").alias("_need_code"),
        F.upper("brand").alias("_need_brand"), F.upper("energy").alias("_need_energy"),
    )

    coded = listed.filter(F.col("_need_code") != "").select("need_rank", F.col("_need_code").alias("_code"))
    by_code = profiles.join(coded, "_code").select(*profile, F.lit(1).alias("tier"), "need_rank")
    unmatched = profiles.join(coded.select("_code").distinct(), "_code", "left_anti")

    # A brand looks up brand pieces, a blank brand energy pieces; the empty piece is in every need.
    def pieces(field: str, column: str) -> DataFrame:
        found = with_pieces(listed, column).withColumnRenamed("piece", "_piece").unionByName(
            listed.withColumn("_piece", F.lit(""))
        )
        return found.select(F.lit(field).alias("_field"), "_piece", "need_rank", "_need_energy")

    has_brand = F.col("_brand") != ""
    blank = (F.col("_brand") == "") & (F.col("_energy") == "")
    asked = unmatched.filter(~blank).select(
        *profile,
        F.when(has_brand, "brand").otherwise("energy").alias("_asked_field"),
        F.when(has_brand, F.col("_brand")).otherwise(F.col("_energy")).alias("_asked_piece"),
    )
    index = pieces("brand", "_need_brand").unionByName(pieces("energy", "_need_energy"))
    contained = (
        (F.col("_field") == F.col("_asked_field"))
        & (F.col("_piece") == F.col("_asked_piece"))
        & (F.contains(F.col("_need_energy"), F.col("_energy")) | (F.col("_energy") == ""))
    )
    by_vehicle = asked.join(index, contained, "left").select(
        *profile, F.when(F.col("need_rank").isNull(), 3).otherwise(2).alias("tier"), "need_rank"
    )
    unknown = unmatched.filter(blank).select(
        *profile, F.lit(3).alias("tier"), F.lit(None).cast(listed.schema["need_rank"].dataType).alias("need_rank")
    )
    found = by_code.unionByName(by_vehicle).unionByName(unknown).join(ranked, "need_rank", "left")
    return salted_join(vehicles, found, profile, "inner", spread=["plate"]).select("plate", "tier", *needs.columns)
