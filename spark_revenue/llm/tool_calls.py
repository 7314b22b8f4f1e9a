"""Chat formatting of tool calls.

Calls and results are linked by identifier with a hash join, ordered so that a call comes after the call
it depends on, checked against the schema of their tool, and written as canonical JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import Scratch

# Type of an argument: the pattern its text must have, JSON's own with one form for each value: no leading
# zeros, no zeros at the end of a fraction, no minus zero, no line break after it.  Strings may be anything.
_INTEGER = r"0|-?[1-9][0-9]*"
TYPES = {
    "integer": rf"\A({_INTEGER})\z", "number": rf"\A({_INTEGER}|-?(0|[1-9][0-9]*)\.[0-9]*[1-9])\z", "boolean": r"\A(true|false)\z",
    "string": None,
}
Schema = dict[str, dict[str, tuple[str, bool]]]


def quoted(text: Column) -> Column:
    """A JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _typed(tool: Column, schemas: Schema) -> Column:
    """The argument types of a tool, as a map; an unknown tool has none."""
    empty = F.create_map().cast("map<string,string>")
    out = empty
    for name, arguments in schemas.items():
        pairs = [F.lit(x) for key, (kind, required) in sorted(arguments.items()) for x in (key, f"{kind}:{required}")]
        out = F.when(tool == name, F.create_map(*pairs) if pairs else empty).otherwise(out)
    return out


def problems(tool: Column, arguments: Column, schemas: Schema) -> Column:
    """What is wrong with the arguments, sorted: ``tool``, ``missing:<key>``, ``type:<key>``, ``unknown:<key>``."""
    kinds = _typed(tool, schemas)
    given = F.coalesce(arguments, F.create_map().cast("map<string,string>"))
    missing = F.transform(
        F.filter(F.map_entries(kinds), lambda e: e["value"].endswith(":True") & F.isnull(F.try_element_at(given, e["key"]))),
        lambda e: F.concat(F.lit("missing:"), e["key"]),
    )

    def wrong(entry: Column) -> Column:
        kind = F.split_part(F.try_element_at(kinds, entry["key"]), F.lit(":"), F.lit(1))
        bad = F.lit(False)
        for name, pattern in TYPES.items():
            if pattern:
                bad = bad | ((kind == name) & ~F.rlike(entry["value"], F.lit(pattern)))
        return F.coalesce(bad, F.lit(False))

    entries = F.map_entries(given)
    types = F.transform(F.filter(entries, wrong), lambda e: F.concat(F.lit("type:"), e["key"]))
    unknown = F.transform(
        F.filter(entries, lambda e: F.isnull(F.try_element_at(kinds, e["key"]))), lambda e: F.concat(F.lit("unknown:"), e["key"])
    )
    listed = F.sort_array(F.concat(missing, types, unknown))
    known = F.coalesce(tool.isin(list(schemas)), F.lit(False))
    return F.when(known, listed).otherwise(F.array(F.lit("tool")))


def canonical(tool: Column, arguments: Column, schemas: Schema) -> Column:
    """Arguments as JSON: keys sorted, no spaces, numbers and booleans bare where their text is JSON, else as strings."""
    kinds = _typed(tool, schemas)

    def value(entry: Column) -> Column:
        kind = F.split_part(F.try_element_at(kinds, entry["key"]), F.lit(":"), F.lit(1))
        out = quoted(entry["value"])
        for name, pattern in TYPES.items():
            if pattern:
                out = F.when((kind == name) & F.rlike(entry["value"], F.lit(pattern)), entry["value"]).otherwise(out)
        return F.when(entry["value"].isNull(), F.lit("null")).otherwise(out)

    entries = F.sort_array(F.map_entries(F.coalesce(arguments, F.create_map().cast("map<string,string>"))))
    members = F.transform(entries, lambda e: F.concat(quoted(e["key"]), F.lit(":"), value(e)))
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def levels(scratch: Scratch, calls: DataFrame) -> DataFrame:
    """``(call_id, level)``: how many calls come before it, one by one, in its chain; null in a cycle.

    Pointers are doubled: each round a call learns the level of the call it points at and takes over its
    pointer, so chains of n calls need log n rounds.  What still points somewhere once 2 ** rounds exceeds
    the number of calls is in a cycle or hangs on one.
    """
    parents = calls.select(F.col("call_id").alias("parent_id")).join(
        calls.select("call_id", F.col("parent_id")).filter("parent_id IS NOT NULL"), "parent_id"
    )
    start = calls.select("call_id").join(parents.select("call_id", F.col("parent_id").alias("to")), "call_id", "left")
    state = scratch.save(start.withColumn("level", F.col("to").isNotNull().cast("long")), "level0")
    limit, turn = max(1, state.count()).bit_length() + 1, 0
    while turn < limit and not state.filter("to IS NOT NULL").isEmpty():
        turn += 1
        ahead = state.select(F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("level").alias("more"))
        moved = state.filter("to IS NOT NULL").join(ahead, "to").select("call_id", F.col("next").alias("to"), (F.col("level") + F.col("more")).alias("level"))
        state = scratch.save(state.filter("to IS NULL").unionByName(moved), f"level{turn}")
        scratch.drop(f"level{turn - 1}")
    return state.select("call_id", F.when(F.col("to").isNull(), F.col("level")).alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: Schema) -> DataFrame:
    """One row for each identifier of ``calls (call_id, conv_id, parent_id, tool, arguments)`` or ``results
    (call_id, content)``, sorted by conversation, level and identifier.

    ``status`` is linked, no_result or no_call, and no_id for calls and results without identifier, which
    link with nothing.  Of repeated calls or results the smallest counts, and ``n_calls`` and ``n_results`` say
    how many there were.  A parent that is no call counts as none.  ``json`` holds call, problems and
    result; null texts are JSON null.  Empty tables give an empty result; further columns don't matter.
    """
    scratch = Scratch(calls.sparkSession)
    kinds = ["conv_id", "parent_id", "tool"]
    checked = calls.withColumn("__problems", problems(F.col("tool"), F.col("arguments"), schemas)).withColumn(
        "__json", canonical(F.col("tool"), F.col("arguments"), schemas)
    )
    flat = checked.select("call_id", *kinds, F.col("__json").alias("arguments"), F.col("__problems").alias("problems"))
    body = F.struct(*kinds, "arguments", "problems")
    named = flat.filter("call_id IS NOT NULL").groupBy("call_id").agg(F.min(body).alias("c"), F.count(F.lit(1)).alias("n_calls"))
    named = scratch.save(named.select("call_id", "c.*", "n_calls"), "calls")
    answers = results.filter("call_id IS NOT NULL").groupBy("call_id").agg(
        F.min("content").alias("content"), F.count(F.lit(1)).alias("n_results")
    )
    ordered = named.join(levels(scratch, named), "call_id")
    status = (
        F.when(F.col("n_calls").isNull(), "no_call").when(F.col("n_results").isNull(), "no_result").otherwise("linked")
    )
    linked = ordered.join(answers, "call_id", "full").withColumn("status", status)
    lost_calls = flat.filter("call_id IS NULL").withColumns({
        "n_calls": F.lit(1).cast("long"), "level": F.lit(None).cast("long"), "content": F.lit(None).cast("string"),
        "n_results": F.lit(0).cast("long"), "status": F.lit("no_id"),
    })
    lost_results = results.filter("call_id IS NULL").select("content").withColumns({
        "status": F.lit("no_id"), "n_results": F.lit(1).cast("long"), "n_calls": F.lit(0).cast("long"),
    })
    every = linked.unionByName(lost_calls).unionByName(lost_results, allowMissingColumns=True)
    text = lambda c: F.coalesce(quoted(F.col(c).cast("string")), F.lit("null"))
    json = F.concat(
        F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"id":'), text("call_id"),
        F.lit(',"problems":'), F.coalesce(F.to_json("problems"), F.lit("null")), F.lit(',"result":'), text("content"),
        F.lit(',"tool":'), text("tool"), F.lit("}"),
    )
    return every.select(
        "conv_id", "call_id", "parent_id", "level", "status", F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"), (F.size("problems") == 0).alias("valid"), json.alias("json"),
    ).orderBy(F.asc_nulls_last("conv_id"), F.asc_nulls_last("level"), "call_id")


# Arguments of the calls that plain conversations make.
CHAT_SCHEMAS: Schema = {
    "ask": {"text": ("string", True), "words": ("integer", True)},
    "look_up": {"text": ("string", True), "words": ("integer", True), "number": ("integer", True)},
}


def calls_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations ``(conv_id, turn, role, text)``.

    A user's turn is a call and the assistant's turn after it its result.  A call depends on the user's turn
    two before.  Texts with a digit look something up, by their first run of digits; others ask.
    """
    name = lambda step: F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - step).cast("string"))
    has = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    said = F.col("text").cast("string")
    number = F.regexp_extract(said, "[0-9]+", 0)
    common = [F.lit("text"), said, F.lit("words"), F.regexp_count(F.coalesce(said, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("string")]
    looks = F.coalesce(number != "", F.lit(False))
    arguments = F.when(looks, F.create_map(*common, F.lit("number"), number)).otherwise(F.create_map(*common))
    calls = turns.filter(F.col("role") == "user").select(
        F.when(has, name(0)).alias("call_id"), "conv_id", F.when(has, name(2)).alias("parent_id"),
        F.when(looks, "look_up").otherwise("ask").alias("tool"), arguments.alias("arguments"),
    )
    results = turns.filter(F.col("role") == "assistant").select(F.when(has, name(1)).alias("call_id"), said.alias("content"))
    return calls, results
