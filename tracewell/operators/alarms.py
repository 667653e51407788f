"""Alarm rules: listing, matching, scheduling, throttling and actions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tracewell.functions import conditions
from tracewell.operators.search import newest


def enabled(rules: DataFrame, flag: bool | None = True) -> DataFrame:
    """Rules with the given enable flag; no flag means all."""
    return rules if flag is None else rules.where(F.col("enable") == flag)


def upsert(rules: DataFrame, version: str) -> DataFrame:
    """The last written version of each rule."""
    rest = [c for c in rules.columns if c != "id"]
    return rules.groupBy("id").agg(F.max_by(F.struct(*rest), version).alias("_r")).select("id", "_r.*")


def bad_rules(rules: DataFrame) -> DataFrame:
    """Enabled rules whose condition cannot be evaluated."""
    return conditions.parsed(enabled(rules)).where("bad").select("id", "condition")


def matching(hits: DataFrame, rules: DataFrame) -> DataFrame:
    """Hits with one output row per enabled rule they satisfy.

    Rules are filed under their most selective clause, a term or the cells of a range, and joined to the hits that have it; the other terms and the ranges are checked on the joined
    rows. Bad rules match nothing (see ``bad_rules``); without rules there are no rows.
    """
    fields = F.create_map(*[x for name in dict.fromkeys(conditions.FIELDS.values()) for x in (
        F.lit(name), (F.unix_micros(name) if name == "create_time" else F.col(name)).cast("string"))])
    asked = conditions.parsed(enabled(rules)).where("NOT bad").withColumn("_key", F.explode(conditions.filed_under())).select(
        "_key", F.col("id").alias("rule_id"), "frequency", "throttle", "threshold", "terms", "ranges")
    # a handful of forms, whatever the number of rules: hits get no key that no rule asks for
    forms = [r["form"] for r in asked.select("_key.form").distinct().orderBy("form").collect()]
    if not forms:
        return hits.join(asked.drop("_key", "terms", "ranges"), F.lit(False))
    keyed = hits.withColumn("_key", F.explode(conditions.hit_keys(forms)))
    return keyed.join(asked, "_key").where(conditions.holds(fields)).drop("_key", "terms", "ranges")


def match(hits: DataFrame, rules: DataFrame, now: str, size: int = 20) -> DataFrame:
    """The newest hits of each rule within its frequency before ``now``."""
    at = F.lit(now).cast("timestamp")
    recent = matching(hits, rules).where((F.col("create_time") >= at - F.make_dt_interval(secs=F.col("frequency")))
                                          & (F.col("create_time") <= at))
    order = [F.desc("create_time"), F.desc("duration"), F.asc("trace_id"), F.asc("span_id"), F.asc("row_key")]
    return newest(recent, ["rule_id"], order, size)


def match_ticks(hits: DataFrame, rules: DataFrame, start: str, tick: int = 60) -> DataFrame:
    """Evaluation times at which a rule runs and finds hits, with how many.

    A rule runs every ``frequency`` rounded up to whole ticks from ``start`` on and sees the hits of the
    last ``frequency`` seconds. Each hit is spread over the few runs that see it, then counted.
    """
    t = F.unix_seconds("create_time")
    origin = F.unix_seconds(F.lit(start).cast("timestamp"))
    period = F.ceil(F.col("frequency") / tick) * tick
    first = origin + F.ceil((t - origin) / period) * period
    seen = matching(hits, rules).withColumn("tick", F.explode(F.when(
        first <= t + F.col("frequency"), F.sequence(first, t + F.col("frequency"), period)).otherwise(
        F.array().cast("array<bigint>"))))
    return seen.groupBy("rule_id", "throttle", "threshold", "tick").agg(F.count("*").alias("matches"))


def _throttle_group(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("tick")
    opened, n, fired = None, 0, []
    for tick, throttle, threshold in zip(frame["tick"], frame["throttle"], frame["threshold"]):
        if opened is None or tick - opened >= throttle:
            opened, n = tick, 1
            fired.append(False)
        else:
            fired.append(bool(threshold <= n))
            n += 1
    return frame.assign(fired=fired)[["rule_id", "tick", "matches", "fired"]]


def throttle(matches: DataFrame) -> DataFrame:
    """Mark the matches that fire: a first match opens a window, the next ones fire from the threshold on.

    Groups hold one row per rule and evaluation time, whatever the number of hits.
    """
    return matches.groupBy("rule_id").applyInPandas(
        _throttle_group, "rule_id long, tick long, matches long, fired boolean")


def _schedule_group(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("tick")
    due, runs = None, []
    for tick, frequency, on in zip(frame["tick"], frame["frequency"], frame["on"]):
        if not on:
            due = None
            runs.append(False)
        else:
            runs.append(due is None or tick >= due)
            if runs[-1]:
                due = tick + frequency
    return frame.assign(runs=runs).loc[lambda f: f["runs"], ["rule_id", "tick"]]


def schedule(ticks: DataFrame) -> DataFrame:
    """Evaluation times at which each rule runs, from ``(rule_id, tick, frequency, on)`` rows.

    A rule runs when its frequency has passed since its last run; switching it off forgets the timer.
    """
    return ticks.groupBy("rule_id").applyInPandas(_schedule_group, "rule_id long, tick long")


def actions(fired: DataFrame, rules: DataFrame) -> DataFrame:
    """One outbox row per fired alarm and action."""
    outbox = rules.select(F.col("id").alias("rule_id"), "title", F.explode("actions").alias("a"))
    kind = F.upper("a.type")
    return fired.join(outbox, "rule_id").select(
        "rule_id", "title", "tick",
        F.when(kind.isin("EMAIL", "SMS", "WECHAT"), kind).otherwise("DEFAULT").alias("type"),
        F.col("a.name").alias("name"), F.col("a.from").alias("sender"), F.col("a.to").alias("receiver"),
        F.col("a.subject").alias("subject"), F.col("a.msg").alias("msg"))
