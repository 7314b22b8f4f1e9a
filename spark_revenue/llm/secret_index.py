"""Secret scan over a trigram index.

Each rule's regex yields a Boolean query on trigrams: an AND of clauses, each an OR of strings that the
regex cannot do without.  The index holds postings (trigram, row) for the trigrams of those queries, in
lower case; intersecting them gives candidate rows, on which the regex is run.  A rule whose regex has
no mandatory trigram runs on every row.
"""

from __future__ import annotations

from functools import reduce
from re import _parser as regex_tree
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .shared import Scratch, spans, without


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules in their order.  Two are written with the least length inside the pattern:
# a run that is too short has no longer run starting inside it, so both forms find the same matches.
BASE_RULES = [
    Rule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2, least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
MORE_RULES = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("url_login", r"[a-z]{2,10}://[A-Za-z0-9_.-]{1,64}:[A-Za-z0-9_.%-]{6,64}@[A-Za-z0-9.-]+"),
]
RULES = [*BASE_RULES, *MORE_RULES]

MAX_STRINGS = 48
Clause = frozenset[frozenset[str]]


def _strings(tree) -> set[str] | None:
    """All strings a part of a regex can match, in lower case; None if there are too many."""
    found = {""}
    for kind, arg in tree:
        name = str(kind)
        if name == "LITERAL":
            part = {chr(arg).lower()}
        elif name == "IN" and all(str(k) == "LITERAL" for k, _ in arg):
            part = {chr(a).lower() for _, a in arg}
        elif name == "SUBPATTERN":
            part = _strings(arg[-1])
        elif name == "BRANCH":
            sides = [_strings(side) for side in arg[1]]
            part = None if None in sides else set().union(*sides)
        elif name == "MAX_REPEAT" and arg[1] <= 8:
            once = _strings(arg[2])
            part = None if once is None else set().union(
                *[reduce(lambda a, b: {x + y for x in a for y in b}, [once] * n, {""}) for n in range(arg[0], arg[1] + 1)]
            )
        else:
            part = None
        if part is None or len(found) * len(part) > MAX_STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


def trigram_query(pattern: str) -> list[Clause]:
    """The clauses of a regex: each a set of alternatives, each a set of trigrams that must all occur."""
    clauses: list[Clause] = []

    def close(strings: set[str]) -> None:
        if min(map(len, strings)) >= 3:
            grams = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
            clauses.append(frozenset(a for a in grams if not any(b < a for b in grams)))

    run = {""}
    for item in regex_tree.parse(pattern):
        part = _strings([item])
        if part is not None and len(run) * len(part) <= MAX_STRINGS:
            run = {a + b for a in run for b in part}
            continue
        close(run)
        run = part or {""}
    close(run)
    return clauses


def _query_table(rules: list[Rule]) -> list[tuple[str, int, int, int, int]]:
    """(trigram, rule, clause, alternative, trigrams of the alternative): fixed by the rules."""
    rows = []
    for r, rule in enumerate(rules):
        for c, clause in enumerate(trigram_query(rule.pattern)):
            for a, grams in enumerate(sorted(clause, key=sorted)):
                rows += [(g, r, c, a, len(grams)) for g in sorted(grams)]
    return rows


def build_index(docs: DataFrame, key: Column, text: Column, rules: list[Rule] = RULES) -> DataFrame:
    """Postings ``(gram, key)`` of the trigrams that the rules' queries name."""
    grams = F.array(*[F.lit(g) for g in sorted({row[0] for row in _query_table(rules)})])
    lowered = docs.select(key.alias("key"), F.lower(text).alias("low"))
    present = F.filter(grams, lambda g: F.contains(F.col("low"), g))
    return lowered.select("key", F.explode(present).alias("gram"))


def candidates(index: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``(key, mask)``: bit r is set where the row's postings satisfy the query of rule r."""
    rows = _query_table(rules)
    table = index.sparkSession.createDataFrame(rows, "gram string, rule int, clause int, alternative int, need int")
    clauses = {r: len(trigram_query(rule.pattern)) for r, rule in enumerate(rules)}
    needed = F.element_at(F.create_map(*[F.lit(x) for pair in clauses.items() for x in pair]), F.col("rule"))
    # The query table is as long as the rules are; all groups below hold one row's postings.
    hits = index.join(F.broadcast(table), "gram").repartition("key")
    met = hits.groupBy("key", "rule", "clause", "alternative", "need").agg(F.count(F.lit(1)).alias("n"))
    met = met.filter("n >= need").groupBy("key", "rule", "clause").agg(F.lit(1).alias("met"))
    whole = met.groupBy("key", "rule").agg(F.count(F.lit(1)).alias("met")).filter(F.col("met") == needed)
    bit = F.pow(F.lit(2.0), F.col("rule")).cast("long")
    return whole.groupBy("key").agg(F.sum(bit).alias("mask"))


def scan(
    docs: DataFrame, *, text: str = "text", ident: str = "doc_id", carry: list[str] | None = None,
    rules: list[Rule] = RULES, n_base: int = len(BASE_RULES),
) -> DataFrame:
    """The ``carry`` columns (default: all) of every row with its detections.

    Adds ``n_<kind>`` for the base kinds, ``found`` (array of start, rule, end, kind in code points, sorted),
    ``base_sha256`` and ``spans``.  Null texts count as empty, repeated rows are scanned alike, an empty
    table stays empty and input columns named like an output are replaced.
    """
    outputs = [*[f"n_{r.kind}" for r in rules[:n_base]], "base_sha256", "spans", "found"]
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in outputs]
    # Rows whose 64-bit keys meet only share candidates; the regex decides on the text itself.
    keyed = without(docs, *outputs).select(
        *[f"`{c}`" for c in carry], F.coalesce(F.col(text), F.lit("")).alias("__text"),
        F.xxhash64(F.col(ident), F.col(text)).alias("__key"),
    )
    scratch = Scratch(docs.sparkSession)
    index = build_index(keyed, F.col("__key"), F.col("__text"), rules)
    found_rows = scratch.save(candidates(index, rules), "candidates").withColumnRenamed("key", "__key")
    joined = keyed.join(found_rows, "__key", "left")

    def of_rule(r: int, rule: Rule) -> Column:
        matches = F.transform(
            spans(F.col("__text"), F.lit(rule.pattern), F.length, rule.group, rule.least),
            lambda s: F.struct(s["start"].alias("start"), F.lit(r).alias("rule"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")),
        )
        if not trigram_query(rule.pattern):
            return matches
        asked = F.coalesce(F.col("mask"), F.lit(0)).bitwiseAND(F.lit(1 << r)) != 0
        return F.when(asked, matches).otherwise(F.array().cast("array<struct<start:int,rule:int,end:int,kind:string>>"))

    located = joined.withColumn("found", F.sort_array(F.concat(*[of_rule(r, x) for r, x in enumerate(rules)])))
    told = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda r: F.size(F.filter("found", lambda s: s["rule"] == r)).cast("long")
    return located.select(
        *[f"`{c}`" for c in carry],
        *[count(r).alias(f"n_{x.kind}") for r, x in enumerate(rules[:n_base])],
        F.sha2(told(F.filter("found", lambda s: s["rule"] < n_base)), 256).alias("base_sha256"),
        told(F.col("found")).alias("spans"), "found",
    )

