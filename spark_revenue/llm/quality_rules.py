"""Quality rules whose cut-offs adapt to each language and source.

Every document gets integer measures.  Their distribution per (language, source) over the documents that
pass the base rule is kept as a sketch of counts per bin, where a bin keeps the seven leading bits of a
value (relative error below 1/64).  Such sketches merge by adding counts: a group's own is blended with its
language's as if that held ``PRIOR`` documents more, and a language's with that of all documents, so a group's
cut-offs move smoothly from its parent's to its own as it grows.  A measure beyond the fences rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import Scratch, let, without, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# What the parent's sketch weighs in a group's, in documents.
PRIOR = 200
IQR_FACTOR = 3
# The tail beyond which a fence need not lie where the quartiles tell no spread, in parts of UNIT.
TAIL = 5_000
# Shares are integers, parts of this, so that every engine finds the same bins.
UNIT = 1_000_000
SYMBOLS = r"[#*$%&|<>]"
# Measure: (how far the tail may push a fence beyond its quartile, whether low values reject as well).
MEASURES = {
    "word_length": (400, True),      # hundredths of a character per word
    "symbol_rate": (40, False),      # symbols per thousand characters of words
    "dup_line_rate": (500, False),   # repeated lines per thousand lines with a word
    "repeat_rate": (300, False),     # words in repeated windows per thousand words
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(tokens: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur at least twice.

    Windows are compared by 64-bit hash.  Sorting the hashes of a text shows whether any repeats; only
    then are hashes sorted with their positions, and the lengths of the covered runs added up.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(p: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(p, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

        def length(starts: Column) -> Column:
            gap = lambda s, k: F.least(
                F.lit(window), F.coalesce(F.get(starts, k + 1) - s, F.lit(window))
            )
            return F.aggregate(F.transform(starts, gap), F.lit(0), lambda a, x: a + x)

        return let(let(placed, marked), length)

    def of(hashes: Column) -> Column:
        repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeated, covered(hashes)).otherwise(F.lit(0))

    def windows(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(h) - (window - 1)), lambda i: F.xxhash64(F.slice(h, i, window))
        )

    many = F.when(F.size(tokens) > window, let(let(F.transform(tokens, lambda w: F.xxhash64(w)), windows), of))
    return F.coalesce(many, F.lit(0)).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five counts of ``BASE`` and ``__n_lines``; a null text has no words."""
    whole = F.coalesce(F.col(text), F.lit(""))
    measured = docs.withColumn("__words", words(whole)).withColumn("__lines", _lines(whole))
    return measured.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.concat_ws("", "__words")).cast("long"),
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("__words")),
        "__n_lines": F.size("__lines").cast("long"),
    }).drop("__words", "__lines")


def _measures() -> dict[str, Column]:
    per = lambda a, b, k: F.when(F.col(b) > 0, F.floor(F.col(a) * k / F.col(b))).otherwise(0).cast("long")
    return {
        "word_length": per("word_chars", "n_words", 100),
        "symbol_rate": per("n_symbols", "word_chars", 1000),
        "dup_line_rate": per("n_dup_lines", "__n_lines", 1000),
        "repeat_rate": per("n_repeat_words", "n_words", 1000),
    }


def bin_of(value: Column) -> Column:
    """The value with all but its seven leading bits cleared."""
    shift = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    scale = F.pow(F.lit(2.0), shift).cast("long")
    return value - value % scale


def sketches(measured: DataFrame, lang: str, source: str) -> DataFrame:
    """Counts per (language, source, measure, bin): the mergeable sketch of each group."""
    entries = F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), bin_of(F.col(f"__{m}")).alias("bin")) for m in MEASURES
    ])).alias("e")
    return (
        measured.select(F.col(lang).alias("__lang"), F.col(source).alias("__source"), entries)
        .groupBy("__lang", "__source", "e.measure", "e.bin").agg(F.count(F.lit(1)).alias("n"))
    )


def _blended(sketch: DataFrame, keys: list[str], parent: DataFrame | None, parent_keys: list[str], prior: int) -> DataFrame:
    """Per group, measure and bin of the parent: ``upto`` of ``docs * UNIT`` lie in that bin or below.

    Own documents count ``UNIT``, and the parent's share is added as ``prior`` documents.  A sketch has some
    hundred bins, so this has that many rows for each group.
    """
    running = Window.partitionBy(*keys, "measure").orderBy("bin")
    counts = sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))
    if parent is None:
        every = Window.partitionBy(*keys, "measure")
        return counts.select(
            *keys, "measure", "bin", (F.sum("n").over(running) * UNIT).alias("upto"), F.sum("n").over(every).alias("docs")
        )
    above = parent.select(*[F.col(k).alias(f"p{k}") for k in parent_keys], F.col("measure").alias("pm"), "bin", F.expr("upto div docs").alias("share"))
    groups = counts.groupBy(*keys, "measure").agg((F.sum("n") + prior).alias("docs"))
    under = F.col("measure") == F.col("pm")
    for k in parent_keys:
        under = under & F.col(k).eqNullSafe(F.col(f"p{k}"))
    own = counts.select(*[F.col(k).alias(f"o{k}") for k in keys], F.col("measure").alias("om"), F.col("bin").alias("ob"), "n")
    same = (F.col("measure") == F.col("om")) & (F.col("bin") == F.col("ob"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"o{k}"))
    upto = F.sum(F.coalesce("n", F.lit(0))).over(running) * UNIT + F.col("share") * prior
    return groups.join(above, under).join(own, same, "left").select(*keys, "measure", "bin", upto.alias("upto"), "docs")


def thresholds(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """One row per (language, source) with the fences ``lo_<measure>`` and ``hi_<measure>``, which are bins.

    A fence lies three interquartile ranges from the quartile.  Where the quartiles are close or meet, as for
    rare symbols and repeats, it lies as far as the outermost ``TAIL`` of the group's documents begins, but not
    beyond the measure's limit: a group with more junk than that must not move its own fence.
    """
    whole = _blended(sketch, [], None, [], prior)
    by_lang = _blended(sketch, ["__lang"], whole, [], prior)
    own = _blended(sketch, ["__lang", "__source"], by_lang, ["__lang"], prior)
    at = lambda part: F.min(F.when(F.col("upto") >= F.col("docs") * part, F.col("bin")))
    found = own.groupBy("__lang", "__source", "measure").agg(
        at(TAIL).alias("low"), at(UNIT // 4).alias("q1"), at(UNIT * 3 // 4).alias("q3"), at(UNIT - TAIL).alias("high")
    )
    spread = (F.col("q3") - F.col("q1")) * IQR_FACTOR
    fences = []
    for m, (most, low) in MEASURES.items():
        of = lambda c, m=m: F.max(F.when(F.col("measure") == m, c))
        fences.append(of(F.col("q3") + F.greatest(spread, F.least(F.lit(most), F.col("high") - F.col("q3")))).alias(f"hi_{m}"))
        if low:
            fences.append(of(F.col("q1") - F.greatest(spread, F.least(F.lit(most), F.col("q1") - F.col("low")))).alias(f"lo_{m}"))
    return found.groupBy("__lang", "__source").agg(*fences)


def apply_rules(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
    carry: list[str] | None = None, prior: int = PRIOR,
) -> DataFrame:
    """The ``carry`` columns (default: all) of every row with ``BASE``, ``base_failed`` and ``kept``.

    Null and empty texts have no words and so fail the base rule; null languages and sources are groups
    of their own; repeated rows are judged alike, each in its own row; an empty table stays empty; a very long
    text is measured whole, in one row.  A value in the same bin as a fence passes.  Input columns named like an
    output are replaced.
    """
    scratch = Scratch(docs.sparkSession)
    outputs = [*BASE, "base_failed", "kept"]
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in outputs]
    clean = without(docs, *outputs)
    narrow = clean.select(
        *[f"`{c}`" for c in carry], F.col(text).alias("__text"),
        F.col(lang).alias("__lang"), F.col(source).alias("__source"),
    )
    counted = base_counts(narrow, "__text").drop("__text")
    measured = scratch.save(counted.withColumns({f"__{m}": c for m, c in _measures().items()}), "measured")
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    fences = scratch.save(thresholds(sketches(measured.filter(~failed), "__lang", "__source"), prior), "thresholds").select(
        F.col("__lang").alias("__fl"), F.col("__source").alias("__fs"),
        *[F.col(c) for m, (_, low) in MEASURES.items() for c in ([f"hi_{m}", f"lo_{m}"] if low else [f"hi_{m}"])],
    )
    beyond = F.lit(False)
    for m, (_, low) in MEASURES.items():
        beyond = beyond | (bin_of(F.col(f"__{m}")) > F.col(f"hi_{m}"))
        if low:
            beyond = beyond | (bin_of(F.col(f"__{m}")) < F.col(f"lo_{m}"))
    return (
        measured.join(
            fences, F.col("__lang").eqNullSafe(F.col("__fl")) & F.col("__source").eqNullSafe(F.col("__fs")), "left"
        )
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(beyond, F.lit(False)))
        .select(*[f"`{c}`" for c in carry], *outputs)
    )
