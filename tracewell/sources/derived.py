"""Request logs, spans and change records derived row by row from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracewell.session import prepare

SPAN_START = "2024-02-29 22:30:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def access_columns(events: DataFrame) -> DataFrame:
    """One request per event row; also applies to a stream of events."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("app"), _text(F.col("user_id") % 5)).alias("app"),
        F.concat(F.lit("/"), "event_type", F.lit("/"), _text(F.col("user_id") % 7)).alias("uri"),
        F.floor("value").cast("long").alias("cost_ms"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("http_code"),
        F.when(k % 5 != 0, F.concat(F.lit("C"), _text(k % 4))).alias("biz_code"),
        "user_id",
    )


def access(spark: SparkSession, folder: str) -> DataFrame:
    return access_columns(table(spark, folder, "events"))


def envelopes(requests: DataFrame) -> DataFrame:
    """Requests as collector envelopes: ``value`` is JSON whose ``message`` is again JSON text."""
    code = F.concat(F.lit('{"code":"'), "biz_code", F.lit('"}'))
    body = F.when(F.col("biz_code").isNull(), '{"msg":"none"}').otherwise(code)
    # an object for odd users, JSON text for even ones
    payload = F.when(F.col("user_id") % 2 == 1, body).otherwise(
        F.concat(F.lit('"'), F.replace(body, F.lit('"'), F.lit('\\"')), F.lit('"')))
    start = F.unix_millis("ts")
    message = F.concat(
        F.lit('{"uri":"'), "uri", F.lit('","method":"GET","httpCode":'), _text(F.col("http_code")),
        F.lit(',"inputParamMap":{"user":"'), _text(F.col("user_id")),
        F.lit('"},"outputParamMap":{"Result":'), payload, F.lit(',"Void":null},"startTime":'), _text(start),
        F.lit(',"endTime":'), _text(start + F.col("cost_ms")), F.lit("}"))
    envelope = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("@timestamp"),
        message.alias("message"), F.lit("request").alias("logger_name"), F.lit("main").alias("thread_name"),
        F.lit("INFO").alias("level"), F.lit(20000).alias("level_value"), F.lit("host").alias("HOSTNAME"),
        F.col("app").alias("appname")))
    return requests.select("event_id", envelope.alias("value"))


def access_lines(requests: DataFrame) -> DataFrame:
    """Whitespace-separated access log lines; every seventh event yields a line without a valid time."""
    stamp = F.when(F.col("event_id") % 7 == 0, "[broken line]").otherwise(
        F.date_format("ts", "'['yyyy-MM-dd HH:mm:ss']'"))
    return requests.select(F.concat(
        F.lit("10.0.0."), _text(F.col("user_id")), F.lit(" - - "), stamp, F.lit(' "GET '), "uri",
        F.lit(' HTTP/1.1" '), _text(F.col("http_code")), F.lit(" "), _text(F.col("cost_ms"))).alias("value"))


def areas(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("ip_key"), F.col("n_name").alias("area"))


def _span_time() -> Column:
    """Orders start within three hours around a midnight; lines follow each other by seconds, a few by twenty minutes."""
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    seconds = (order * 7919) % 10_800 + 2 * line + part % 5 + F.when(part % 23 == 0, 1_200).otherwise(0)
    return F.timestamp_millis(F.unix_millis(F.lit(SPAN_START).cast("timestamp")) + seconds.cast("long") * 1_000 + part % 1_000)


def span_columns(lineitem: DataFrame) -> DataFrame:
    """One span per order line; also applies to a stream of order lines."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    def tag(name: str, when: Column, value: Column | str) -> Column:
        value = F.lit(value) if isinstance(value, str) else value
        return F.when(when, F.create_map(F.lit(name), value)).otherwise(F.create_map().cast("map<string,string>"))
    tags = F.map_concat(
        tag("sql.query", part % 11 == 0, "select 1"),
        tag("error", (F.col("l_linestatus") == "F") & (part % 13 == 0), F.when(part % 2 == 0, "200").otherwise("500")),
        tag("http.path", part % 4 == 0, F.concat(F.lit("/p"), _text(part % 5))),
        tag("tracingtype", supp % 3 != 2, F.when(supp % 3 == 0, "http").otherwise("grpc")))
    kinds = F.array(*map(F.lit, ("CLIENT", "SERVER", "PRODUCER", "CONSUMER")), F.lit(None).cast("string"))
    return lineitem.select(
        _text(F.col("l_orderkey")).alias("trace_id"), _text(F.col("l_linenumber")).alias("span_id"),
        F.when(F.col("l_linenumber") > 1, _text(F.floor(F.col("l_linenumber") / 2).cast("int"))).alias("parent_id"),
        kinds.getItem((supp % 5).cast("int")).alias("kind"),
        F.concat(F.lit("/"), _text(part % 7)).alias("name"),
        _span_time().alias("ts"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("duration"),
        F.concat(F.lit("svc"), _text(supp % 12)).alias("local_service"),
        F.when(part % 3 != 0, F.concat(F.lit("svc"), _text(part % 12))).alias("remote_service"),
        tags.alias("tags"),
        F.concat_ws("-", _text(part), _text(supp), _text(F.round(F.col("l_extendedprice") * 100).cast("long")),
                    F.date_format("l_shipdate", "yyyyMMdd"), "l_linestatus").alias("row_key"),
    )


def spans(spark: SparkSession, folder: str) -> DataFrame:
    return span_columns(table(spark, folder, "lineitem"))


def span_json(frame: DataFrame) -> DataFrame:
    """Spans as JSON objects in the wire shape."""
    def endpoint(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.struct(F.col(name).alias("serviceName")))
    wire = F.struct(
        F.col("trace_id").alias("traceId"), F.col("span_id").alias("id"), F.col("parent_id").alias("parentId"),
        "kind", "name", F.unix_micros("ts").alias("timestamp"), "duration",
        endpoint("local_service").alias("localEndpoint"), endpoint("remote_service").alias("remoteEndpoint"), "tags")
    return frame.withColumn("json", F.to_json(wire))


def span_messages(frame: DataFrame) -> DataFrame:
    """Topic values holding JSON span arrays, some of them damaged, chosen by the part number."""
    part = F.split("row_key", "-").getItem(0).cast("long")
    blank = F.regexp_replace("json", r'"traceId":"\d+"', '"traceId":" "')
    value = (F.when(part % 50 == 0, "not json")
             .when(part % 50 == 1, F.concat(F.lit('['), "json", F.lit(',{"traceId":"t","id":"x","timestamp":"soon"}]')))
             .when(part % 50 == 2, F.concat(F.lit("["), blank, F.lit("]")))
             .when(part % 50 == 3, F.concat(F.lit("[null,"), "json", F.lit("]")))
             .when(part % 50 == 4, F.concat(F.lit('[{"shared":"maybe",'), F.substr("json", F.lit(2)), F.lit("]")))
             .when(part % 50 == 5, F.concat(F.lit("["), F.replace("json", F.lit('"localEndpoint":{'), F.lit('"localEndpoint":{"port":"x",')),
                                            F.lit("]")))
             .when(part % 50 == 6, F.concat(F.lit("["), F.regexp_replace("json", r'"tags":\{[^}]*\}', '"tags":"oops"'), F.lit("]")))
             .otherwise(F.concat(F.lit("["), "json", F.lit("]"))))
    return span_json(frame).select("trace_id", "span_id", "row_key", value.alias("value"))


def cdc_messages(orders: DataFrame) -> DataFrame:
    """Orders as change records ``(key, value)``; a few values are null."""
    action = F.when(F.col("o_orderstatus") == "O", "INSERT").when(
        F.col("o_orderstatus") == "F", "UPDATE").otherwise("DELETE")
    fields = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus"))
    taken = _text(F.unix_millis(F.col("o_orderdate").cast("timestamp")))
    record = F.to_json(F.struct(
        F.lit("db").alias("databaseName"), F.lit("orders").alias("tableName"), action.alias("actionType"),
        F.lit("o_orderkey").alias("primaryKeyName"), fields.alias("fields"),
        F.when(F.col("o_orderstatus") == "F", "o_custkey,o_orderstatus").alias("updatedFields"),
        F.concat(taken, F.lit(","), taken).alias("ts")))
    return orders.select(_text(F.col("o_orderkey")).alias("key"),
                         F.when(F.col("o_orderkey") % 100 != 0, record).alias("value"))


def cdc(spark: SparkSession, folder: str) -> DataFrame:
    return cdc_messages(table(spark, folder, "orders"))


def rules(keys: DataFrame, key: str) -> DataFrame:
    """Alarm rules derived from an integer key column."""
    k = F.col(key).cast("long")
    error = F.lit('{"term":{"type.keyword":"ERROR"}}')
    slow = F.lit('{"range":{"span.duration":{"gte":3000000}}},{"term":{"type":"COST"}}')
    narrow = F.concat(F.lit('{"range":{"children.duration":{"gte":1000000,"lt":5000000}}},{"term":{"app.keyword":"svc'),
                      _text(k % 12), F.lit('"}}'))

    def action(name: str, kind: str, receiver: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), F.lit(None).cast("string").alias("from"),
                        receiver.alias("to"), F.lit("alarm").alias("subject"), F.lit("see traces").alias("msg"))
    both = F.array(action("mail", "Email", F.concat(F.lit("user"), _text(k), F.lit("@example.com"))),
                   action("text", "SMS", _text(k)))
    return keys.select(
        k.alias("id"), F.concat(F.lit("title-"), _text(k % 50)).alias("title"),
        F.when(k % 4 == 1, False).when(k % 4 != 0, True).alias("enable"),
        (60 * (k % 5 + 1)).alias("frequency"), (60 * (k % 8 + 7)).alias("throttle"), (k % 4).alias("threshold"),
        F.when(k % 3 == 0, error).when(k % 3 == 1, slow).otherwise(narrow).alias("condition"),
        F.when(k % 2 == 0, both).otherwise(F.array(action("push", "Push", _text(k)))).alias("actions"))
