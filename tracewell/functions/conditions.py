"""Rule conditions: JSON ``term`` and ``range`` clauses as column predicates, or as columns of the rules."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Stored field names and the columns that hold them.
FIELDS = {
    "type": "type", "app": "app", "traceId": "trace_id", "createTime": "create_time",
    "children.duration": "duration", "children.name": "span_name", "children.id": "span_id",
    "span.duration": "duration", "span.name": "span_name", "span.id": "span_id",
}
_BOUNDS = {"from": "__ge__", "gte": "__ge__", "gt": "__gt__", "to": "__le__", "lte": "__le__", "lt": "__lt__"}


def _column(field: str) -> Column:
    name = field.removesuffix(".keyword")
    if name not in FIELDS:
        raise ValueError(f"unknown field in condition: {field}")
    return F.col(FIELDS[name])


def _clause(clause: dict) -> Column:
    (kind, body), = clause.items()
    (field, spec), = body.items()
    column = _column(field)
    if kind == "term":
        value = spec["value"] if isinstance(spec, dict) else spec
        return column == F.lit(value)
    if kind == "range":
        found = [getattr(column, _BOUNDS[b])(F.lit(v).cast("timestamp") if field == "createTime" else F.lit(v))
                 for b, v in spec.items() if b in _BOUNDS and v is not None]
        if not found:
            raise ValueError(f"range without a bound: {field}")
        result = found[0]
        for part in found[1:]:
            result = result & part
        return result
    raise ValueError(f"unknown clause in condition: {kind}")


def predicate(condition: str) -> Column:
    """All clauses of a comma-separated condition must hold."""
    clauses = [_clause(c) for c in json.loads(f"[{condition}]")]
    if not clauses:
        raise ValueError("empty condition")
    result = clauses[0]
    for clause in clauses[1:]:
        result = result & clause
    return F.coalesce(result, F.lit(False))


NUMERIC = ("duration", "create_time")
_JSON = "array<struct<term:map<string,string>,range:map<string,map<string,string>>>>"


def _number(column: Column, text: Column) -> Column:
    """A bound as a number; times as microseconds."""
    return F.when(column == "create_time", F.unix_micros(F.try_to_timestamp(text)).cast("double")).otherwise(text.try_cast("double"))


def parsed(rules: DataFrame) -> DataFrame:
    """Rules with their ``condition`` as columns: terms, ranges, and whether it is ``bad``.

    Bad are conditions that are no list of ``term`` and ``range`` clauses, name an unknown field or bound nothing; one bad
    rule does not hinder the others.
    """
    names = F.create_map(*[F.lit(x) for pair in FIELDS.items() for x in pair])
    clauses = F.from_json(F.concat(F.lit("["), "condition", F.lit("]")), _JSON)
    column = lambda field: F.element_at(names, F.regexp_replace(field, r"\.keyword$", ""))
    entries = lambda kind: F.flatten(F.transform(
        "_clauses", lambda c: F.coalesce(F.map_entries(c[kind]), F.map_entries(F.create_map()).cast(_entries[kind]))))
    _entries = {"term": "array<struct<key:string,value:string>>", "range": "array<struct<key:string,value:map<string,string>>>"}
    split = rules.withColumn("_clauses", clauses)
    split = split.withColumn("_terms", entries("term")).withColumn("_ranges", entries("range"))
    terms = F.transform("_terms", lambda e: F.struct(
        column(e["key"]).alias("column"), F.coalesce(F.get_json_object(e["value"], "$.value"), e["value"]).alias("value")))

    def bounds(e: Column) -> Column:
        of = lambda *keys: F.coalesce(*[_number(column(e["key"]), e["value"][k]) for k in keys])
        return F.struct(column(e["key"]).alias("column"), of("from", "gte").alias("at_least"), of("gt").alias("over"),
                        of("to", "lte").alias("at_most"), of("lt").alias("under"))
    done = split.withColumn("terms", terms).withColumn("ranges", F.transform("_ranges", bounds))
    unknown = F.exists("terms", lambda t: t["column"].isNull() | t["value"].isNull()) | F.exists(
        "ranges", lambda r: r["column"].isNull() | F.coalesce(r["at_least"], r["over"], r["at_most"], r["under"]).isNull())
    odd = F.exists("_clauses", lambda c: c["term"].isNull() & c["range"].isNull())
    empty = F.size("terms") + F.size("ranges") == 0
    return done.withColumn("bad", F.coalesce(unknown | odd | empty, F.lit(True))).drop("_clauses", "_terms", "_ranges")


# Under what a rule is filed, the most selective first: a value of one of its terms, or the cells that its range of durations meets.
_TERMS = ("trace_id", "span_id", "row_key", "app", "span_name")
OCTAVES = 65    # cells of the duration: the number of binary digits of its whole part


def _octave(value: Column) -> Column:
    """Cell of a number, negative ones below all others; ascending in the number."""
    size = F.least(F.floor(F.abs(value)), F.lit(float(1 << 62))).cast("long")
    digits = F.length(F.bin(size)) - F.when(size == 0, 1).otherwise(0)
    return F.when(value < 0, -digits - 1).when(value >= 0, digits)


def _key(form: str, key: Column) -> Column:
    return F.struct(F.lit(form).alias("form"), key.cast("string").alias("key"))


def filed_under() -> Column:
    """``(form, key)`` pairs of a parsed rule: a hit that satisfies it has exactly one of them.

    A rule is filed under a term; without one, under the cells of its range of durations, together with its type if it asks for one; else under its type; a rule
    that asks for none of these is met by all hits.
    """
    of = lambda name: F.get(F.filter("terms", lambda t: t["column"] == name), F.lit(0))["value"]
    ranges = F.filter("ranges", lambda r: r["column"] == "duration")
    low = F.array_max(F.transform(ranges, lambda r: F.greatest(r["at_least"], r["over"])))
    high = F.array_min(F.transform(ranges, lambda r: F.least(r["at_most"], r["under"])))
    first, last = F.coalesce(_octave(low), F.lit(-OCTAVES)), F.coalesce(_octave(high), F.lit(OCTAVES))
    cells = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    kind = of("type")
    by_cell = F.when(kind.isNull(), F.transform(cells, lambda c: _key("cell", c))).otherwise(
        F.transform(cells, lambda c: _key("type and cell", F.concat(kind, F.lit(" "), c.cast("string")))))
    return F.coalesce(*[F.when(of(t).isNotNull(), F.array(_key(t, of(t)))) for t in _TERMS],
                      F.when(F.size(ranges) > 0, by_cell), F.when(kind.isNotNull(), F.array(_key("type", kind))), F.array(_key("any", F.lit(""))))


def hit_keys(forms: Sequence[str]) -> Column:
    """The keys of a hit that are of these forms."""
    cell = _octave(F.col("duration").cast("double")).cast("string")
    made = {"any": F.lit(""), "type": F.col("type"), "cell": cell, "type and cell": F.concat("type", F.lit(" "), cell), **{t: F.col(t) for t in _TERMS}}
    return F.filter(F.array(*[_key(f, made[f]) for f in forms]), lambda k: k["key"].isNotNull())


def holds(fields: Column) -> Column:
    """Whether all terms and ranges hold; ``fields`` maps column names to texts, numbers included."""
    number = lambda name: F.element_at(fields, name).try_cast("double")
    term = lambda t: F.when(t["column"].isin(*NUMERIC), number(t["column"]) == _number(t["column"], t["value"])).otherwise(
        F.element_at(fields, t["column"]) == t["value"])

    def inside(r: Column) -> Column:
        v = number(r["column"])
        return (F.coalesce(v >= r["at_least"], r["at_least"].isNull()) & F.coalesce(v > r["over"], r["over"].isNull())
                & F.coalesce(v <= r["at_most"], r["at_most"].isNull()) & F.coalesce(v < r["under"], r["under"].isNull()) & v.isNotNull())
    return F.coalesce(F.forall("terms", term) & F.forall("ranges", inside), F.lit(False))
