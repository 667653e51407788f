"""Column expressions: names, rates, times and formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Separators, markers and tag names as they appear in the records.
SEPARATOR = "||"
NODE_LINE = "|"
NODE_TYPE = ":"
ROOT_PARENT = "-1"
SUCCESS = "200"
TAG_SQL = "sql.query"
TAG_PATH = "http.path"
TAG_ERROR = "error"
TAG_TYPE = "tracingtype"
DB_READ = "DB-READ"
DB_WRITE = "DB-WRITE"
UNKNOWN_AREA = "未知地域"


def tag(name: str, tags: str | Column = "tags") -> Column:
    column = F.col(tags) if isinstance(tags, str) else tags
    return column.getItem(name)


def has_tag(name: str, tags: str = "tags") -> Column:
    return F.coalesce(F.map_contains_key(F.col(tags), name), F.lit(False))


def not_blank(column: Column) -> Column:
    return F.coalesce(F.trim(column) != "", F.lit(False))


def endpoint_name(name: Column, tags: str = "tags") -> Column:
    """The ``http.path`` tag replaces the span name unless it is blank."""
    path = tag(TAG_PATH, tags)
    return F.when(not_blank(path), path).otherwise(name)


def metric_kind(parent_id: Column, kind: Column) -> Column:
    """Roots have no kind in their metric key; a missing kind elsewhere reads 'null'."""
    return F.when(parent_id.isNotNull(), F.coalesce(kind, F.lit("null")))


def error_rate(errors: Column, total: Column, empty: float | None = None) -> Column:
    return F.when(total > 0, errors * 100.0 / total).otherwise(F.lit(empty).cast("double"))


def is_failed(status: Column) -> Column:
    """An error tag counts as a failure when present and not '200'."""
    return F.coalesce(status != SUCCESS, F.lit(False))


def span_metric_name(app: Column, kind: Column, uri: Column, metric: Column | None = None) -> Column:
    """``app[||kind]||[metric]uri``."""
    metric = F.lit("") if metric is None else F.coalesce(metric, F.lit(""))
    return F.concat(app, F.when(kind.isNotNull(), F.concat(F.lit(SEPARATOR), kind)).otherwise(""),
                    F.lit(SEPARATOR), metric, uri)


def metric_name_parts(name: Column) -> tuple[Column, Column, Column]:
    """App, kind and uri of a span metric name; the kind is null for roots."""
    parts = F.split(name, r"\|\|")
    kind = F.when(F.size(parts) > 2, parts[1])
    return parts[0], kind, F.element_at(parts, -1)


def link_metric_name(parent: Column, child: Column, metric: Column | None = None) -> Column:
    """Name of a link's metric: ``[metric]parent||child``."""
    return F.concat(F.lit("") if metric is None else F.coalesce(metric, F.lit("")), parent, F.lit(SEPARATOR), child)


def request_metric_name(app: Column, uri: Column, prefix: Column | None = None) -> Column:
    """``app-[prefix]uri`` with prefixes such as ``HTTP-500-``, ``BIZ-CODE-7-``, ``COST-``."""
    return F.concat(app, F.lit("-"), F.lit("") if prefix is None else prefix, uri)


def topology_node(service: Column, name: Column, tags: str = "tags") -> Column:
    """``service|<tracing type>:<operation>``; database spans collapse to read or write."""
    lowered = F.lower(name)
    is_write = lowered.startswith("update") | lowered.startswith("insert") | lowered.startswith("delete")
    operation = F.when(~has_tag(TAG_SQL, tags), F.coalesce(name, F.lit("null"))).when(
        name.isNull(), "null").when(is_write, DB_WRITE).otherwise(DB_READ)
    full = F.concat(service, F.lit(NODE_LINE), F.coalesce(tag(TAG_TYPE, tags), F.lit("null")),
                    F.lit(NODE_TYPE), operation)
    return F.when(not_blank(service), full).otherwise(service)


def node_parts(node: Column) -> tuple[Column, Column, Column, Column]:
    """Split a topology node into ``(app, type, url, typed)``.

    A node without an url names itself; ``typed`` tells whether the url part carried a type.
    """
    parts = F.split(node, r"\|")
    app = parts.getItem(0)
    rest = F.coalesce(F.try_element_at(parts, F.lit(2)), app)
    typed = F.instr(rest, NODE_TYPE) > 0
    pieces = F.split(rest, NODE_TYPE)
    kind = F.when(typed, pieces.getItem(0))
    url = F.when(typed, F.try_element_at(pieces, F.lit(2))).otherwise(rest)
    return app, kind, url, typed


def epoch_micros_to_time(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def display_time(ts: Column, zone: str = "+08:00", pattern: str = "yyyy-MM-dd'T'HH:mm:ss.SSS") -> Column:
    """Text of ``ts`` in a fixed display zone, with the zone offset appended."""
    return F.concat(F.date_format(F.from_utc_timestamp(ts, zone), pattern), F.lit(zone.replace(":", "")))


def shift_time(ts: Column, hours: int = 0) -> Column:
    return ts + F.make_interval(hours=F.lit(hours))


def next_midnight(ts: Column) -> Column:
    return F.date_trunc("DAY", ts) + F.expr("INTERVAL 1 DAY")


def bucket_start(ts: Column, seconds: int) -> Column:
    """Start of the tumbling bucket of ``seconds`` holding ``ts`` (epoch aligned)."""
    width = seconds * 1_000_000
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(width)))


def key_count_line(key: Column, count: Column, separator: str = "\t") -> Column:
    return F.concat_ws(separator, key, count.cast("string"))
