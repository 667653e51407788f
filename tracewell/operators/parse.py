"""Decoding of JSON and text records into columns. Bad records become null rows or quarantine rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tracewell import schemas
from tracewell.functions import expressions as E


def request_logs(raw: DataFrame, value: str = "value") -> DataFrame:
    """Envelope JSON to request columns; the ``message`` field is itself JSON text.

    Rows that do not parse keep null columns, so callers may quarantine them.
    """
    keep = [c for c in raw.columns if c != value]
    outer = raw.withColumn("_e", F.from_json(F.col(value), schemas.ENVELOPE))
    inner = outer.withColumn("_m", F.from_json(F.col("_e.message"), schemas.REQUEST_LOG))
    return inner.select(
        *keep, value,
        F.upper(F.col("_e.appname")).alias("app"),
        F.try_to_timestamp(F.col("_e.@timestamp")).alias("ts"),
        F.col("_m.uri").alias("uri"), F.col("_m.method").alias("method"),
        F.col("_m.httpCode").alias("http_code"),
        F.col("_m.outputParamMap").alias("output"),
        F.col("_m.startTime").alias("start_ms"), F.col("_m.endTime").alias("end_ms"),
        (F.col("_m.endTime") - F.col("_m.startTime")).alias("cost_ms"),
    )


def business_code(output: str | Column = "output") -> Column:
    """``code`` of the last non-null output entry, given as an object or as JSON text."""
    column = F.col(output) if isinstance(output, str) else output
    entries = F.filter(F.map_values(column), lambda v: v.isNotNull())
    return F.get_json_object(F.try_element_at(entries, F.lit(-1)), "$.code")


def access_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Whitespace-separated access lines to ``ip, ts``; lines without a valid time are dropped."""
    token = F.split(F.col(value), r"\s+")
    def at(i: int) -> Column:
        return F.try_element_at(token, F.lit(i))
    stamp = F.concat(F.regexp_replace(at(4), r"^\[", ""), F.lit(" "), F.regexp_replace(at(5), r"\]$", ""))
    return (lines.select(at(1).alias("ip"), F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"))
            .where(F.col("ts").isNotNull()))


def dimension_lines(lines: DataFrame, value: str = "value", separator: str = "-") -> DataFrame:
    """``key-value`` lines; any line that does not split in exactly two parts is dropped."""
    parts = F.split(F.col(value), separator)
    return lines.where(F.size(parts) == 2).select(
        parts.getItem(0).alias("key"), parts.getItem(1).alias("area"))


def _span_columns(span: str, keep: list[str]) -> list[Column]:
    def get(name: str) -> Column:
        return F.col(f"{span}.{name}")
    return [
        *[F.col(c) for c in keep],
        get("traceId").alias("trace_id"), get("id").alias("span_id"), get("parentId").alias("parent_id"),
        get("kind").alias("kind"), get("name").alias("name"), F.timestamp_micros(get("timestamp")).alias("ts"),
        get("duration").alias("duration"),
        get("localEndpoint.serviceName").alias("local_service"),
        get("remoteEndpoint.serviceName").alias("remote_service"), get("tags").alias("tags"),
        F.md5(F.to_json(F.col(span))).alias("row_key"),
    ]


_SPOILED = "_spoiled"  # what a span's text goes to if a field does not fit its type
_SPAN = T.StructType([*schemas.SPAN_JSON.fields, T.StructField(_SPOILED, T.StringType())])


def _decoded(texts: str) -> Column:
    """Elements of a list of JSON texts, each parsed once: ``s``, with its text again in ``_spoiled`` if a field does not fit its type."""
    return F.transform(texts, lambda t: F.struct(
        F.ltrim(t).startswith("{").alias("object"), F.from_json(t, _SPAN, {"columnNameOfCorruptRecord": _SPOILED}).alias("s")))


def _ok(element: Column) -> Column:
    return F.coalesce(element["object"] & element["s"].isNotNull() & element["s"][_SPOILED].isNull(), F.lit(False))


def _elements(raw: DataFrame, value: str, keep: list[str]) -> DataFrame:
    """``_value``, ``_texts`` (the array's elements but for nulls) and ``_d`` (the same decoded)."""
    texts = F.array_compact(F.from_json(F.col(value), "array<string>"))
    split = raw.select(*keep, F.col(value).alias("_value"), texts.alias("_texts"))
    return split.withColumn("_d", _decoded("_texts"))


def _given_out(df: DataFrame, keep: list[str], elements: Column) -> DataFrame:
    """One row per element, as ``_x``.

    An outer explode with a filter behind it: from a plain one the optimizer infers a filter in front, which decodes everything once more.
    """
    return df.select(*keep, elements.alias("_good")).select(*keep, F.explode_outer("_good").alias("_x")).where("_x IS NOT NULL")


def _spans(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.col("_x.s").dropFields(_SPOILED).alias("_s"))


def span_arrays(raw: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON span arrays to span rows, all or nothing: one bad element drops its whole array."""
    keep = keep or []
    whole = F.when(F.forall("_d", _ok), F.col("_d"))
    return _spans(_given_out(_elements(raw, value, keep), keep, whole), keep).select(*_span_columns("_s", keep))


def span_arrays_tolerant(raw: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON span arrays to span rows, element by element; bad elements and blank trace ids are dropped.

    Names and services are lower-cased, as the topology reader sees them.
    """
    keep = keep or []
    decoded = _spans(_given_out(_elements(raw, value, keep), keep, F.filter("_d", _ok)), keep)
    good = decoded.where(F.col("_s.id").isNotNull() & E.not_blank(F.col("_s.traceId")))
    return good.select(*_span_columns("_s", keep)).withColumns({
        c: F.lower(c) for c in ("name", "local_service", "remote_service")})


def quarantine(raw: DataFrame, value: str = "value") -> DataFrame:
    """Span messages that do not decode as a whole, with the reason."""
    reason = F.when(F.col("_value").isNull(), "null value").when(F.col("_texts").isNull(), "not a JSON array").when(
        ~F.forall("_d", _ok), "bad element")
    checked = _elements(raw, value, [c for c in raw.columns if c != value]).withColumn("_reasons", F.array(reason))
    # a filter on the reason itself would be copied below the decoding
    return checked.drop("_d", "_texts").withColumn("reason", F.explode_outer("_reasons")).where(F.col("reason").isNotNull()).select(
        *[F.col("_value").alias(value) if c == value else F.col(c) for c in raw.columns], "reason")


def change_records(raw: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Change-data JSON plus its message key; null values are dropped, lists and times are split."""
    def names(column: str) -> Column:
        return F.split(F.col(column), ",")
    decoded = raw.where(F.col(value).isNotNull()).select(
        F.col(key).alias("msg_key"), F.from_json(F.col(value), schemas.CDC).alias("r"))
    times = F.split(F.col("r.ts"), ",")
    return decoded.select(
        "msg_key", F.col("r.databaseName").alias("database"), F.col("r.tableName").alias("table_name"),
        F.col("r.actionType").alias("action"), names("r.primaryKeyName").alias("primary_key"),
        F.from_json(F.col("r.fields"), "map<string,string>").alias("fields"),
        names("r.updatedFields").alias("updated"),
        F.from_json(F.col("r.updatedOriginalFields"), "map<string,string>").alias("updated_original"),
        F.timestamp_millis(F.try_element_at(times, F.lit(1)).try_cast("bigint")).alias("executed"),
        F.timestamp_millis(F.try_element_at(times, F.lit(2)).try_cast("bigint")).alias("received"),
    )


def keyed_json(df: DataFrame, key: Column) -> DataFrame:
    """Rows as ``(key, value)`` with the whole row as JSON text."""
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
