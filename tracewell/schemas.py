"""Record schemas."""

from pyspark.sql import types as T

_s, _l, _i, _b, _d = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.DoubleType()
_ts = T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ENVELOPE = T.StructType([
    T.StructField("@timestamp", _s), T.StructField("message", _s), T.StructField("logger_name", _s),
    T.StructField("thread_name", _s), T.StructField("level", _s), T.StructField("level_value", _l),
    T.StructField("HOSTNAME", _s), T.StructField("appname", _s),
])

REQUEST_LOG = _struct(
    uri=_s, method=_s, httpCode=_i, inputParamMap=T.MapType(_s, _s), outputParamMap=T.MapType(_s, _s),
    startTime=_l, endTime=_l,
)

ENDPOINT = _struct(ipv4=_s, port=_i, serviceName=_s)

SPAN_JSON = _struct(
    traceId=_s, id=_s, parentId=_s, kind=_s, name=_s, timestamp=_l, duration=_l, shared=_b,
    localEndpoint=ENDPOINT, remoteEndpoint=ENDPOINT, tags=T.MapType(_s, _s),
)

SPAN = _struct(
    trace_id=_s, span_id=_s, parent_id=_s, kind=_s, name=_s, ts=_ts, duration=_l,
    local_service=_s, remote_service=_s, tags=T.MapType(_s, _s), row_key=_s,
)

METRIC_ROW = _struct(
    id=_l, pid=_l, appName=_s, name=_s, total=_l, qps=_d, qpsMax=_d, cost=_d, costTp99=_d, costTp95=_d,
    costMax=_l, errors=_l, errorRate=_d,
)

CDC = _struct(
    databaseName=_s, tableName=_s, actionType=_s, primaryKeyName=_s, fields=_s, updatedFields=_s,
    updatedOriginalFields=_s, ts=_s,
)

ALARM_ACTION = T.StructType([
    T.StructField(n, _s) for n in ("name", "type", "from", "to", "subject", "msg")
])

ALARM_RULE = T.StructType([
    T.StructField("id", _l), T.StructField("title", _s), T.StructField("description", _s),
    T.StructField("enable", _b), T.StructField("dataSourceType", _s), T.StructField("dataSource", _s),
    T.StructField("frequency", _l), T.StructField("throttle", _l), T.StructField("threshold", _l),
    T.StructField("condition", _s), T.StructField("actions", T.ArrayType(ALARM_ACTION)),
])

TOPIC = _struct(topic=_s, key=_s, value=_s, timestamp=_ts)
