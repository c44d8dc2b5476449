"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in expression over one row, so the verdict needs no
shuffle, no user function and no state, whatever the size of the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearyard.llm.common import words


@dataclass(frozen=True)
class Rule:
    """A document passes while ``low <= measure <= high``."""

    measure: str
    low: float | None = None
    high: float | None = None


# Frequent function words of the languages the rules expect.
STOP_WORDS = (
    "the of and to in is that it for as with on be at by this are was "
    "der die und das ist nicht ein eine zu den mit von auf für sich im des dem "
    "le la les de des et en un une du que est dans pour qui sur pas au avec "
    "el los las y del por con para su al lo se una"
).split()

# In running text, as a first word and in capitals: cheaper than folding every word.
_STOP_FORMS = sorted({form for word in STOP_WORDS for form in (word, word.capitalize(), word.upper())})

RULES = (
    Rule("n_words", low=50),
    Rule("repeat_ratio", high=0.5),
    Rule("mean_word_length", low=2, high=12),
    Rule("symbols_per_word", high=0.1),
    Rule("exclaiming_ratio", high=0.5),
    Rule("upper_ratio", high=0.5),
    Rule("stop_word_ratio", low=0.02),
    Rule("dup_line_ratio", high=0.5),
    Rule("bar_ratio", high=0.1),
)


def _windows(w: Column, n: int) -> Column:
    """All n-word windows as structs of their words: the array's shifted slices, zipped."""
    size = F.greatest(F.size(w) - (n - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(w, F.lit(k + 1), size).alias(f"w{k}") for k in range(n)])


def _covered(df: DataFrame) -> DataFrame:
    """n_repeat_words from ``_win``: words covered by 3-word windows found twice in the text.

    Exact: windows are sorted as (hash, words, place) structs, so that equal
    windows lie side by side, and neighbours are compared by their words. A text
    whose window hashes all differ repeats no window and is not sorted.
    """
    steps = {
        "_h": "transform(_win, x -> xxhash64(x))",
        # most texts repeat no window at all: nothing to sort then
        "_p": "sort_array(transform(if(size(array_distinct(_h)) = size(_h), slice(_win, 1, 0), _win),"
              " (x, i) -> named_struct('h', _h[i], 'w', x, 'i', i)))",
        # places of windows equal to their neighbour in sorted order, in text order
        "_d": "sort_array(transform(filter(_p, (p, i) ->"
              " coalesce(p.h = get(_p, i + 1).h and p.w = get(_p, i + 1).w, false)"
              " or coalesce(p.h = get(_p, i - 1).h and p.w = get(_p, i - 1).w, false)), p -> cast(p.i as long)))",
        # each window adds three words, less those the next flagged window adds anyway
        "n_repeat_words": "coalesce(aggregate(transform(_d, (p, i) -> least(3L, coalesce(get(_d, i + 1) - p, 3L))),"
                          " 0L, (a, x) -> a + x), 0L)",
    }
    used = {"_p": ["_h", "_win"], "_d": ["_p"], "n_repeat_words": ["_d"]}
    for name, step in steps.items():
        df = df.withColumn(name, F.expr(step)).drop(*used.get(name, []))
    return df


# The columns that ``apply_rules`` adds or replaces.
MEASURES = (
    "n_symbols", "n_bars", "n_exclaims", "n_upper", "n_words", "word_chars", "n_stop_words", "n_lines",
    "n_dup_lines", "n_repeat_words", "repeat_ratio", "mean_word_length", "symbols_per_word", "exclaiming_ratio",
    "upper_ratio", "stop_word_ratio", "dup_line_ratio", "bar_ratio", "base_failed", "kept",
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measures(docs: DataFrame) -> DataFrame:
    """The documents with the counts and ratios that the rules test.

    A NULL text counts as empty. Columns of the input with the name of a
    measure are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def only(characters: str, within: Column | str = "_marks") -> Column:
        return F.regexp_replace(within, f"[^{characters}]+", "")

    def count(characters: str) -> Column:
        return F.length(only(characters)).cast("long")

    # Wide arrays are dropped as soon as they are counted: each further
    # projection would copy them once more.
    counted = docs.withColumns({
        "_w": words(F.col("text")), "_lines": lines, "_marks": only(r"#*$%&|<>!?\p{Lu}", text),
    }).withColumns({
        "_win": _windows(F.col("_w"), 3),
        "n_symbols": count("#*$%&|<>"), "n_bars": count("|"), "n_exclaims": count("!?"), "n_upper": count(r"\p{Lu}"),
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_stop_words": F.size(F.filter("_w", lambda w: w.isin(_STOP_FORMS))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    }).drop("_w", "_lines", "_marks")
    n = F.col("n_words")
    return _covered(counted).withColumns({
        "repeat_ratio": _ratio(F.col("n_repeat_words"), n),
        "mean_word_length": _ratio(F.col("word_chars"), n),
        "symbols_per_word": _ratio(F.col("n_symbols"), n),
        "exclaiming_ratio": _ratio(F.col("n_exclaims"), n),
        "upper_ratio": _ratio(F.col("n_upper"), F.col("word_chars")),
        "stop_word_ratio": _ratio(F.col("n_stop_words"), n),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
        "bar_ratio": _ratio(F.col("n_bars"), n),
    })


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The rule table as one boolean expression."""
    passed = F.lit(True)
    for rule in rules:
        if rule.low is not None:
            passed = passed & (F.col(rule.measure) >= rule.low)
        if rule.high is not None:
            passed = passed & (F.col(rule.measure) <= rule.high)
    return passed


def base_failed() -> Column:
    """The part of the verdict that is fixed: too short, or half of it repeats."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Documents with their measures, ``base_failed`` and ``kept``.

    NULL and empty texts have no words, fail the base and are not kept. Each
    row is judged alone: repeated rows get equal verdicts. The new columns come
    out of a generator, a barrier that a filter on them is not pushed below, so
    the optimizer never writes the measures out again inside a filter.
    """
    measured = measures(docs).withColumn("base_failed", base_failed())
    measured = measured.withColumn("kept", ~F.col("base_failed") & verdict(rules))
    made = [c for c in measured.columns if c in MEASURES or c not in docs.columns]
    barrier = measured.select(
        *[c for c in measured.columns if c not in made], F.explode_outer(F.array(F.struct(*made))).alias("_made")
    )
    return barrier.select(*[F.col(f"_made.{c}").alias(c) if c in made else F.col(c) for c in measured.columns])


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Only the documents that pass, with the columns they came with.

    The verdict is filtered as a generated column: a plain filter would be
    pushed below the measures, and the optimizer would write them out in it
    over and over.
    """
    aside = {c: f"_in_{k}" for k, c in enumerate(docs.columns) if c != "text"}
    hidden = docs.withColumnsRenamed(aside)
    back = [F.col("text") if c == "text" else F.col(aside[c]).alias(c) for c in docs.columns]
    judged = apply_rules(hidden, rules).select("*", F.explode_outer(F.array("kept")).alias("_passed"))
    return judged.filter("_passed").select(*back)
