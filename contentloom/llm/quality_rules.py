"""Quality rules in SQL expressions: base counts, and divergence from language references.

A document's histogram of character classes and its histogram of common words are compared with
those of its language by Jensen-Shannon distance. Short documents are not compared, because their
histograms say little.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, set_aside

SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_SIGNS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Frequent function words by language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf ist im ein nicht",
    "en": "the of and to in a is that for it with as was on be at",
    "es": "de la que el en y a los se del las un por con una su",
    "fr": "de la le et les des en un du que est pour dans qui par sur",
}


@dataclass(frozen=True)
class RuleSettings:
    """``base`` rules fail below ``least_words`` words, or if repeats exceed ``repeat_percent``.

    Distances run from 0 to 1. The class distance counts from ``classes_from`` word characters on
    and fails above ``most_classes``. The word distance counts from ``words_from`` words on and
    fails above ``most_words + spread / sqrt(words)``: a short text strays further by chance.
    ``common`` has the words that are compared, by language. ``window`` is a power of two.
    """

    least_words: int = 20
    window: int = 8
    repeat_percent: int = 30
    classes_from: int = 300
    words_from: int = 100
    most_classes: float = 0.26
    most_words: float = 0.1
    spread: float = 2.8
    common: dict[str, str] = field(default_factory=lambda: COMMON_WORDS)

    @property
    def bins(self) -> int:
        """Common words of a language and the rest; shorter lists leave bins empty."""
        return 1 + max((len(words.split()) for words in self.common.values()), default=0)


def let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once; Spark would copy it into every mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(windows: Column, width: int) -> Column:
    """Words inside windows whose hash occurs twice or more; windows are hashes by position."""

    def spread(places: Column) -> Column:
        gaps = F.transform(F.sequence(F.lit(1), F.size(places) - 1), lambda k: _gap(places, k, width))
        return F.aggregate(gaps, F.lit(width), lambda total, gap: total + gap)

    def twins(ordered: Column) -> Column:
        def place(k: Column) -> Column:
            own = F.get(ordered, k)
            same = (own["h"] == F.get(ordered, k - 1)["h"]) | (own["h"] == F.get(ordered, k + 1)["h"])
            return F.when(F.coalesce(same, F.lit(False)), own["i"])

        places = F.transform(F.sequence(F.lit(0), F.size(ordered) - 1), place)
        return let(F.sort_array(F.array_compact(places)), spread)

    def counted(hashes: Column) -> Column:
        rows = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeated, let(F.sort_array(rows), twins)).otherwise(0)

    return let(windows, counted)


def _gap(places: Column, k: Column, width: int) -> Column:
    return F.least(F.lit(width), F.get(places, k) - F.get(places, k - 1))


def repeated_words(words: Column, width: int) -> Column:
    """How many words lie in windows of ``width`` words that the text has twice or more.

    Hashes of single words join to hashes of two, four and more, so ``width`` is a power of two.
    """

    def doubled(hashes: Column, reach: int) -> Column:
        if reach == width:
            return _covered(hashes, width)
        later = F.slice(hashes, reach + 1, F.size(hashes))
        pairs = F.zip_with(F.slice(hashes, 1, F.size(hashes) - reach), later, lambda a, b: F.xxhash64(a, b))
        return let(pairs, lambda joined: doubled(joined, 2 * reach))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return (
        F.when(F.size(words) > width, let(hashed, lambda hashes: doubled(hashes, 1)))
        .otherwise(0)
        .cast("bigint")
    )


def _left(text: Column, drop: str) -> Column:
    """Characters of a text outside a class."""
    return F.char_length(F.regexp_replace(text, drop, "")).cast("bigint")


def _class_counts(text: Column, word_chars: Column) -> Column:
    """Upper case, digits, stops, loud signs, symbols, bytes beyond ASCII, blanks, and the rest."""
    chars = F.char_length(text).cast("bigint")
    counted = [
        _left(text, r"[^A-Z]+"),
        _left(text, r"[^0-9]+"),
        _left(text, r"[^.,;:]+"),
        _left(text, r"[^!?]+"),
        F.col("n_symbols"),
        F.octet_length(text) - chars,
        chars - word_chars,
    ]
    rest = chars
    for count in (*counted[:5], counted[6]):
        rest = rest - count
    return F.array(*counted, rest)


def _word_counts(words: Column, lang: Column, settings: RuleSettings) -> Column:
    """How often each common word of the language occurs, in lower case or with a capital; then all
    other words. NULL for a language without a list."""

    def tally(kept: Column, own: list[str]) -> Column:
        # Every word stands between blanks of its own, so a replacement counts it exactly.
        line = F.concat(F.lit(" "), F.lower(F.array_join(kept, "  ")), F.lit(" "))

        def each(joined: Column) -> Column:
            left = [
                F.char_length(joined) - F.char_length(F.replace(joined, F.lit(f" {w} "), F.lit("")))
                for w in own
            ]
            counts = [(n / len(w + "  ")).cast("bigint") for n, w in zip(left, own)]
            counts += [F.lit(0).cast("bigint")] * (settings.bins - 1 - len(own))
            return F.array(*counts)

        rest = (F.size(words) - F.size(kept)).cast("bigint")
        return F.concat(let(line, each), F.array(rest))

    def listed(own: list[str]) -> Column:
        forms = sorted({f for w in own for f in (w, w[0].upper() + w[1:])})
        found = F.filter(words, lambda w: w.isin(forms))
        return let(found, lambda kept: tally(kept, own))

    out = F.lit(None).cast("array<bigint>")
    for name, own in sorted(settings.common.items()):
        out = F.when(lang == name, listed(own.split())).otherwise(out)
    return out


def measures(docs: DataFrame, settings: RuleSettings) -> DataFrame:
    """doc_id, lang, the base counts, and the two histograms; from one pass over the texts."""
    frame = set_aside(docs)
    lang = F.lit(None).cast("string")
    if "lang" in docs.columns:
        lang = F.col(f"rest.c{docs.columns.index('lang')}").cast("string")
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_SIGNS)) != "")
    symbols = "[" + SYMBOLS + "]+"
    split = frame.select(
        "doc_id",
        lang.alias("lang"),
        text.alias("text"),
        F.array_remove(F.split(text, SPACE_CLASS + "+"), "").alias("words"),
    )
    counted = split.select(
        "doc_id",
        "lang",
        "text",
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.char_length("text") - _left(F.col("text"), symbols)).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words"), settings.window).alias("n_repeat_words"),
    )
    s = settings
    failed = (F.col("n_words") < s.least_words) | (
        100 * F.col("n_repeat_words") > s.repeat_percent * F.col("n_words")
    )
    return counted.select(
        "doc_id",
        "lang",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        _class_counts(F.col("text"), F.col("word_chars")).alias("classes"),
        _word_counts(F.col("words"), F.col("lang"), s).alias("common"),
    )


def _sums(settings: RuleSettings) -> list[Column]:
    """Both histograms of many documents; NULL in place of counts where there are none."""
    return [
        F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(size)]).alias(f"all_{column}")
        for column, size in (("classes", 8), ("common", settings.bins))
    ]


def references(measured: DataFrame, settings: RuleSettings) -> DataFrame:
    """One row per language: both histograms summed over all documents that pass the base rules."""
    passed = measured.where(~F.col("base_failed") & F.col("lang").isNotNull())
    return passed.groupBy("lang").agg(*_sums(settings))


def overall_classes(measured: DataFrame, settings: RuleSettings) -> Column:
    """The class histogram of all documents that pass the base rules, eight counts as a constant; NULL
    if none passes."""
    classes = _sums(settings)[0]
    found = measured.where(~F.col("base_failed")).agg(classes).first()[0]
    if found[0] is None:
        return F.lit(None).cast("array<bigint>")
    return F.array(*map(F.lit, found)).cast("array<bigint>")


def distance(own: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms, the root of their divergence in bits; from 0 to 1.

    0 if a histogram is NULL or empty.
    """

    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, n: a + n).cast("double")

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def both(sums: Column) -> Column:
        def term(a: Column, b: Column) -> Column:
            p, q = a / sums["a"], b / sums["b"]
            return part(p, (p + q) / 2) + part(q, (p + q) / 2)

        terms = F.zip_with(own, reference, term)
        value = F.aggregate(terms, F.lit(0.0), lambda total, x: total + x) / 2
        # Rounding can leave a divergence of equal histograms just below 0.
        value = F.sqrt(F.greatest(value, F.lit(0.0)))
        return F.when((sums["a"] > 0) & (sums["b"] > 0), value).otherwise(F.lit(0.0))

    return F.coalesce(let(F.struct(total(own).alias("a"), total(reference).alias("b")), both), F.lit(0.0))


def quality_rules(docs: DataFrame, settings: RuleSettings = RuleSettings()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, more): base counts, distances, the verdict.

    Columns: doc_id, n_words, word_chars (code points in words), n_symbols, n_dup_lines,
    n_repeat_words, base_failed, class_distance, word_distance, kept. Words stand between ASCII
    white space. kept is false if a base rule fails or a distance that counts is too large (see
    ``RuleSettings``). The references are those of ``lang``. If lang is NULL, absent from the
    table, or in no document that passes the base rules, the classes are compared with those of
    all documents; words are only compared where the language has a list.

    Where no document passes the base rules there is nothing to compare with, and all are rows with
    distances of 0. A NULL or empty text has no words and so fails. Rows with NULL or repeated ids are rows like
    others; other columns are ignored. An empty table gives no rows.
    """
    s = settings
    measured = cut_lineage(measures(docs, s))
    joined = measured.join(references(measured, s), "lang", "left")
    distances = joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        distance(F.col("classes"), F.coalesce("all_classes", overall_classes(measured, s))).alias(
            "class_distance"
        ),
        distance(F.col("common"), F.col("all_common")).alias("word_distance"),
    )
    limit = s.most_words + s.spread / F.sqrt(F.greatest("n_words", F.lit(1)))
    odd = (F.col("word_chars") >= s.classes_from) & (F.col("class_distance") > s.most_classes)
    odd |= (F.col("n_words") >= s.words_from) & (F.col("word_distance") > limit)
    return distances.withColumn("kept", ~F.col("base_failed") & ~odd)
