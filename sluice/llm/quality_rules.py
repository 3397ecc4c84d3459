"""Quality rules: a table of thresholds compiled into one projection of ratios, without user functions.

Counts are taken of whole texts. A word is a run of characters other than space
and U+0009 to U+000D; null reads as the empty text. Empty texts have all counts
0 and ratios 0, so they fail the base rule on length. Rows that repeat are
judged alike, each on its own; no row is moved between partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.work import making_room, unused

SEPARATORS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

# Frequent words of the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on this are from or an have not you".split(),
    "fr": "le la les de des du et en un une que qui dans pour par sur au avec est ne pas il se".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "es": "el la los las de que y en un una por con para del se su no al lo es como más".split(),
}


@dataclass(frozen=True)
class Rule:
    """Reject a text whose `numerator / denominator` is below `least` or above `most`; None leaves that side open."""

    name: str
    numerator: str
    denominator: str | None = None
    least: float | None = None
    most: float | None = None


BASE_RULES = (
    Rule("length", "n_words", least=50),
    Rule("repeats", "n_repeat_words", "n_words", most=0.5),
)
#: Looser than clean prose needs by a wide margin; see the README for how clean and poor texts fall.
RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.0, most=15.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.05),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.6),
)


def counted(docs: DataFrame, text: str, out: str) -> DataFrame:
    """`docs` with a struct column `out` of the counts that rules can name."""
    words, lines, windows, order, places = unused(docs, "words", "lines", "windows", "order", "places")
    whole = F.coalesce(F.col(text), F.lit(""))
    stop = sorted({w for group in STOP_WORDS.values() for w in group})

    def window(word: Column, i: Column) -> Column:
        """A window by 96 bits of hashes instead of its words: three times the text would be held otherwise."""
        each = [word, *[F.get(F.col(words), i + k) for k in range(1, WINDOW)]]
        return F.struct(F.struct(F.xxhash64(*each).alias("a"), F.hash(*each).alias("b")).alias("w"), i.alias("i"))

    def same(x: Column, i: Column) -> Column:
        near = [F.get(F.col(order), i + k).getField("w") == x["w"] for k in (-1, 1)]
        return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

    def covered(p: Column, k: Column) -> Column:
        return F.least(F.coalesce(F.get(F.col(places), k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))

    n = F.size(words)
    separators = removed(whole, SEPARATORS)
    distinct = F.size(F.array_distinct(F.transform(windows, lambda x: x["w"]["a"])))  # whole numbers: structs are compared pair by pair
    repeat_words = F.aggregate(F.transform(places, covered), F.lit(0), lambda a, x: a + x)
    return (
        docs.withColumn(words, F.array_remove(F.split(whole, r"[\x20\x09-\x0D]+"), ""))
        .withColumn(lines, F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
        .withColumn(windows, F.slice(F.transform(words, window), 1, F.greatest(n - (WINDOW - 1), F.lit(0))))
        .withColumn(order, F.when(distinct < F.size(windows), F.sort_array(windows)).otherwise(F.slice(windows, 1, 0)))
        .withColumn(places, F.sort_array(F.transform(F.filter(order, same), lambda x: x["i"])))
        .withColumn(
            out,
            F.struct(
                n.cast("long").alias("n_words"),
                (F.char_length(whole) - separators).cast("long").alias("word_chars"),
                removed(whole, SYMBOLS).cast("long").alias("n_symbols"),
                F.size(lines).cast("long").alias("n_lines"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                repeat_words.cast("long").alias("n_repeat_words"),
                F.size(F.filter(words, lambda w: w.isin(stop))).cast("long").alias("n_stop_words"),
            ),
        )
        .drop(words, lines, windows, order, places)
    )


def removed(text: Column, characters: str) -> Column:
    """How often the ASCII characters occur: the bytes that go when they are taken out."""
    each = [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c))) for c in characters]
    total = each[0]
    for n in each[1:]:
        total = total + n
    return total


def broken(rules: Sequence[Rule], counts: str) -> Column:
    """Names of the rules that a text breaks, in the table's order."""

    def name_if_broken(rule: Rule) -> Column:
        value = F.col(f"{counts}.{rule.numerator}").cast("double")
        if rule.denominator:
            value = value / F.greatest(F.col(f"{counts}.{rule.denominator}"), F.lit(1)).cast("double")
        sides = [value < rule.least] if rule.least is not None else []
        sides += [value > rule.most] if rule.most is not None else []
        wrong = sides[0]
        for side in sides[1:]:
            wrong = wrong | side
        return F.when(wrong, F.lit(rule.name))

    return F.array_compact(F.array(*[name_if_broken(rule) for rule in rules]).cast("array<string>"))


def judged(
    docs: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    base: Sequence[Rule] = BASE_RULES,
    out: str = "quality",
) -> DataFrame:
    """`docs` with a struct column `out`: the counts, base_failed, kept and failed (names of broken rules).

    A column of `docs` named as `out` is kept with `_` behind its name.
    """
    docs = making_room(docs, out)
    (counts,) = unused(docs, "counts")
    failed_base, failed = broken(base, counts), broken(rules, counts)
    verdict = F.struct(
        f"{counts}.*",
        (F.size(failed_base) > 0).alias("base_failed"),
        ((F.size(failed_base) == 0) & (F.size(failed) == 0)).alias("kept"),
        F.concat(failed_base, failed).alias("failed"),
    )
    # The row number makes the verdict one that is not worked out anew: a filter on it would otherwise be moved
    # below the projections that count, with all their expressions put in for each mention.
    once = F.when(F.monotonically_increasing_id() >= 0, verdict)
    return counted(docs, text, counts).withColumn(out, once).drop(counts)


def keep(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """The rows of `docs` that break no rule, with its own columns."""
    (quality,) = unused(docs, "quality")
    return judged(docs, text, rules, base, quality).where(f"{quality}.kept").drop(quality)
