"""License scan with ordered signature rules.

A text is reduced to its words, each between single spaces.  Every rule has a label, a priority, a
keyword that its matches contain, and a regex over words; only texts with the keyword see the regex.
A version may be glued to some keywords ('gplv3'), which are then looked for as the beginning of a word.
A detection lying inside another of the same or a better priority is suppressed.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .shared import let, spans, without

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

# Label, keyword that every name of it contains (see GLUED), names as regexes over words.
FAMILIES = [
    ("agpl", "affero", ["gnu affero general public license", "affero general public license", "affero gpl"]),
    ("agpl", "agpl", ["agpl ?v?3?", "agpl 3 0( only| or later)?"]),
    ("apache", "apache", ["apache license", "apache software license", "apache 2 0", "apache license version 2 0"]),
    ("artistic", "artistic", ["artistic license", "artistic license 2 0", "perl artistic license"]),
    ("boost", "boost", ["boost software license", "boost software license version 1 0"]),
    ("bsd", "bsd", ["bsd license", "bsd [234] clause( license)?", "(new|simplified|modified|revised) bsd license"]),
    ("cc0", "cc0", ["cc0", "cc0 1 0( universal)?"]),
    ("cc-by-nc-nd", "cc by nc nd", ["cc by nc nd( [1-4] 0)?"]),
    ("cc-by-nc-sa", "cc by nc sa", ["cc by nc sa( [1-4] 0)?"]),
    ("cc-by-nc", "cc by nc", ["cc by nc( [1-4] 0)?"]),
    ("cc-by-nd", "cc by nd", ["cc by nd( [1-4] 0)?"]),
    ("cc-by-sa", "cc by sa", ["cc by sa( [1-4] 0)?"]),
    ("cc-by", "cc by", ["cc by( [1-4] 0)?"]),
    ("cc-by-sa", "commons", ["creative commons attribution share ?alike( [1-4] 0)?( international| unported)?"]),
    ("cc-by-nc", "commons", ["creative commons attribution non ?commercial( [1-4] 0)?( international| unported)?"]),
    ("cc-by-nd", "commons", ["creative commons attribution no ?deriv(ative)?s( [1-4] 0)?( international| unported)?"]),
    ("cc-by", "commons", ["creative commons attribution( license)?( [1-4] 0)?( international| unported)?"]),
    ("cddl", "cddl", ["cddl( 1 [01])?"]),
    ("cddl", "distribution license", ["common development and distribution license"]),
    ("epl", "eclipse", ["eclipse public license", "eclipse public license v?[12] 0"]),
    ("eupl", "eupl", ["eupl", "eupl 1 [12]"]),
    ("gfdl", "documentation license", ["gnu free documentation license", "free documentation license"]),
    ("lgpl", "lesser", ["gnu lesser general public license", "lesser general public license"]),
    ("lgpl", "lgpl", ["lgpl ?v?[23]?", "lgpl [23] [01]( only| or later)?"]),
    ("gpl", "gnu", ["gnu general public license", "gnu gpl", "gnu general public license (version|v) ?[123]"]),
    ("gpl", "gpl", ["gpl ?v?[123]", "gpl [123] 0( only| or later)?", "gpl license"]),
    ("isc", "isc", ["isc license", "isc licence"]),
    ("mit", "mit", ["mit license", "mit licence", "mit x11 license", "expat license mit"]),
    ("mpl", "mozilla", ["mozilla public license", "mozilla public license (version|v) ?[12] [01]"]),
    ("mpl", "mpl", ["mpl [12] [01]", "mpl ?v?2"]),
    ("ms-pl", "microsoft", ["microsoft public license", "microsoft reciprocal license"]),
    ("odbl", "database license", ["open database license", "open data commons open database license"]),
    ("ofl", "font license", ["sil open font license", "open font license"]),
    ("postgresql", "postgresql", ["postgresql license", "postgresql licence"]),
    ("python", "python", ["python software foundation license", "psf license python", "python license"]),
    ("public-domain", "public domain", ["public domain", "public domain dedication"]),
    ("proprietary", "rights reserved", ["all rights reserved", "rights reserved"]),
    ("unlicense", "unlicense", ["unlicense", "the unlicense"]),
    ("wtfpl", "wtfpl", ["wtfpl"]),
    ("zlib", "zlib", ["zlib license", "zlib libpng license"]),
]
# Keywords that are only the beginning of a word in some names.
GLUED = {"agpl", "gpl", "lgpl", "mpl"}
# How a name is introduced; a longer introduction is stronger evidence and has the better priority.
INTRODUCTIONS = [
    (1, "spdx license identifier "),
    (1, "licensed under (the )?(terms of )?(the )?"),
    (1, "(distributed|released|available) under (the )?(terms of )?(the )?"),
    (2, "(see|under|subject to) the "),
    (3, ""),
]


class Rule(NamedTuple):
    rule: int
    label: str
    priority: int
    keyword: str
    pattern: str


def spaced(pattern: str) -> str:
    """A word regex for texts in which each word stands between spaces of its own."""
    return " " + pattern.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?") + " "


def gate(keyword: str) -> str:
    """What every match of the rules with this keyword contains: the keyword, open at its end where names glue."""
    return keyword.rstrip() if keyword.strip() in GLUED else keyword


def any_gate(rules: list[Rule]) -> str:
    """A regex for the first words of all gates, which few texts have."""
    return "|".join(sorted({re.match(" [^ ]+ ?", gate(r.keyword))[0] for r in rules}))


def build_rules() -> list[Rule]:
    """One rule for each introduction and name, in order of priority, then as listed."""
    made = [
        (priority, label, keyword, spaced(intro + name))
        for priority, intro in INTRODUCTIONS for label, keyword, names in FAMILIES for name in names
    ]
    return [Rule(i, label, p, spaced(k), pattern) for i, (p, label, k, pattern) in enumerate(sorted(made, key=lambda x: x[0]))]


RULES = build_rules()
PRIORITIES = sorted({r.priority for r in RULES})
_FOUND = "array<struct<start:int,back:int,rank:int,end:int,label:string,priority:int>>"


def normalise(text: Column) -> Column:
    """The words of a text in lower case, each between spaces of its own; '' if it has none."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    joined = F.trim(F.regexp_replace(lowered, SEPARATORS, " "))
    return F.when(joined == "", "").otherwise(F.concat(F.lit(" "), F.replace(joined, F.lit(" "), F.lit("  ")), F.lit(" ")))


def _n_words(normal: Column) -> Column:
    """Words of a normalised text or of a piece of one that is cut between words."""
    return F.floor((F.length(normal) - F.length(F.replace(normal, F.lit(" "), F.lit("")))) / 2).cast("int")


def detections(normal: Column, rules: list[Rule] = RULES) -> Column:
    """Surviving detections, sorted by start, longest first, then by rule order."""
    by_keyword: dict[str, list[Rule]] = {}
    for r in rules:
        by_keyword.setdefault(gate(r.keyword), []).append(r)
    table = F.array(*[
        F.struct(F.lit(k).alias("keyword"), F.array(*[
            F.struct(F.lit(r.rule).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(r.pattern).alias("pattern"))
            for r in of
        ]).alias("rules")) for k, of in by_keyword.items()
    ])
    gated = F.flatten(F.transform(F.filter(table, lambda k: F.contains(normal, k["keyword"])), lambda k: k["rules"]))
    every = F.flatten(F.transform(gated, lambda r: F.transform(
        spans(normal, r["pattern"], _n_words),
        lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("back"), r["rule"].alias("rank"), s["end"].alias("end"),
            r["label"].alias("label"), r["priority"].alias("priority"),
        ),
    )))
    return let(F.sort_array(every), _unsuppressed)


def _unsuppressed(found: Column) -> Column:
    """Drops what lies inside an earlier detection (by start, longest first) of no worse priority."""
    def ends(priority: int) -> Column:
        return F.transform(found, lambda d: F.when(d["priority"] <= priority, d["end"]).otherwise(-1))

    reach = F.array(*[furthest_before(ends(p)) for p in PRIORITIES])
    # An identical interval of a better priority may sort after a worse one only by rank, and rules are
    # ranked by priority: so whatever suppresses a detection stands before it.
    return let(reach, lambda r: F.filter(
        found, lambda d, i: F.get(F.element_at(r, d["priority"]), i) < d["end"]
    ))


def furthest_before(ends: Column) -> Column:
    """For each element of an integer array, the largest element before it, -1 for the first."""
    largest = lambda a: F.coalesce(F.array_max(a), F.lit(-1))

    def blocked(v: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v))).cast("int"))

        def placed(w: Column) -> Column:
            starts = F.transform(F.sequence(F.lit(0), F.size(v), w), lambda k: largest(F.slice(v, F.lit(1), k)))
            return let(starts, lambda s: F.transform(v, lambda _, i: F.greatest(
                F.get(s, F.floor(i / w).cast("int")), largest(F.slice(v, i - i % w + 1, i % w))
            )))

        return let(width, placed)

    return let(ends, blocked)


def _places(normal: Column, label: str, phrase: str) -> Column:
    return F.transform(
        spans(normal, F.lit(spaced(phrase)), _n_words),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(label).alias("label")),
    )


def scan(docs: DataFrame, *, text: str = "text", carry: list[str] | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """The ``carry`` columns (default: all) of every row with its license detections.

    Adds ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` (share of
    words inside a detection) and ``found``.  A null or empty text has no words, no labels and score 0;
    repeated rows are scanned alike; an empty table stays empty; input columns named like an output are replaced.
    """
    outputs = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "found"]
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in outputs]
    none = F.array().cast("array<struct<start:int,end:int,label:string>>")
    normal = without(docs, *outputs).select(*[f"`{c}`" for c in carry], normalise(F.col(text)).alias("__normal"))
    # The second word of each phrase but one is in every base match: a cheap gate for all four.
    places = F.concat(*[_places(F.col("__normal"), label, phrase) for label, phrase in BASE])
    gate = F.col("__normal").contains(" license ") | F.col("__normal").contains(" cc ")
    any_keyword = F.rlike(F.col("__normal"), F.lit(any_gate(rules)))
    scanned = normal.withColumn("__base", F.when(gate, places).otherwise(none)).withColumn(
        "found", F.when(any_keyword, detections(F.col("__normal"), rules)).otherwise(F.array().cast(_FOUND))
    )
    label_of = lambda a: F.transform(a, lambda d: d["label"])
    joined = lambda a: F.array_join(F.sort_array(F.array_distinct(a)), ",")
    starts = F.transform("__base", lambda d: d["start"])
    covered = let(
        F.sort_array(F.concat(
            F.transform("found", lambda d: F.struct(d["start"].alias("s"), d["end"].alias("e"))),
            F.transform("__base", lambda d: F.struct(d["start"].alias("s"), d["end"].alias("e"))),
        )),
        lambda iv: F.aggregate(
            iv, F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
            lambda acc, d: F.struct(
                (acc["n"] + F.greatest(F.lit(0), d["e"] - F.greatest(d["s"], acc["upto"]))).alias("n"),
                F.greatest(acc["upto"], d["e"]).alias("upto"),
            ),
        )["n"],
    )
    n = _n_words(F.col("__normal"))
    return scanned.select(
        *[f"`{c}`" for c in carry],
        n.cast("long").alias("n_words"),
        F.size("__base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(label_of(F.col("__base"))).alias("base_labels"),
        joined(F.concat(label_of(F.col("__base")), label_of(F.col("found")))).alias("labels"),
        F.when(n > 0, covered.cast("double") / n).otherwise(0.0).alias("score"),
        "found",
    )
