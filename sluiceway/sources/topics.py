"""Topics: reader options, start positions and message decoding on an envelope DataFrame.

An envelope has columns topic, partition, offset, timestamp, key and value, as the
Kafka source delivers them.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Defaults of a topic read and the columns every message carries.
BATCH_SIZE = 100
BATCH_TIMEOUT = 5
ENVELOPE = ("offset", "partition", "timestamp", "key")
HEADER_PREFIX = "header:"


# ---- reading (needs Spark's Kafka package, which is the user's to add) -----------


def parse_start(start_from: str) -> tuple[str, int | None]:
    """`earliest`, `latest` or `timestamp:<epoch_ms>` as (kind, milliseconds)."""
    if start_from in ("earliest", "latest"):
        return start_from, None
    kind, _, value = start_from.partition(":")
    if kind == "timestamp" and value.lstrip("-").isdigit():
        return "timestamp", int(value)
    raise ValueError("start_from must be 'earliest', 'latest' or 'timestamp:<epoch_ms>'")


def reader_options(uri: str, topic: str, start_from: str = "earliest", batch_size: int | None = None) -> dict[str, str]:
    """Options of Spark's Kafka source for a broker URI."""
    parts = urlsplit(uri)
    if not parts.netloc:
        raise ValueError("the URI names no broker")
    params = {k: v[0] for k, v in parse_qs(parts.query).items()}
    options = {"kafka.bootstrap.servers": parts.netloc, "subscribe": topic, "includeHeaders": "false"}
    if params.get("group_id"):
        options["kafka.group.id"] = params["group_id"]
    protocol = params.get("security_protocol", "PLAINTEXT")
    if protocol != "PLAINTEXT":
        mechanism = params.get("sasl_mechanisms", "PLAIN")
        module = "plain.PlainLoginModule" if mechanism == "PLAIN" else "scram.ScramLoginModule"
        options["kafka.security.protocol"] = protocol
        options["kafka.sasl.mechanism"] = mechanism
        options["kafka.sasl.jaas.config"] = (
            f"org.apache.kafka.common.security.{module} required "
            f'username="{params.get("sasl_username", "")}" password="{params.get("sasl_password", "")}";'
        )
    kind, millis = parse_start(start_from)
    if kind == "timestamp":
        options["startingTimestamp"] = str(millis)
        options["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        options["startingOffsets"] = kind
    if batch_size:
        options["maxOffsetsPerTrigger"] = str(batch_size)
    return options


def read_topic(spark: SparkSession, uri: str, topic: str, start_from: str = "earliest") -> DataFrame:
    """A bounded read up to the offsets that exist now."""
    options = {k: v for k, v in reader_options(uri, topic, start_from).items() if k != "startingOffsetsByTimestampStrategy"}
    if options.get("startingOffsets") == "latest":
        raise ValueError("a bounded read from 'latest' is empty; use a stream with a checkpoint")
    return as_envelope(spark.read.format("kafka").options(**options, endingOffsets="latest").load())


def stream_topic(
    spark: SparkSession, uri: str, topic: str, start_from: str = "earliest", batch_size: int = BATCH_SIZE
) -> DataFrame:
    """The same as a stream; after the first run its checkpoint, not `start_from`, says where to go on."""
    return as_envelope(spark.readStream.format("kafka").options(**reader_options(uri, topic, start_from, batch_size)).load())


def as_envelope(messages: DataFrame) -> DataFrame:
    """Kafka's columns with the timestamp as epoch milliseconds."""
    return messages.select("topic", "partition", "offset", F.unix_millis("timestamp").alias("timestamp"), "key", "value")


# ---- start positions on an envelope ----------------------------------------------


def from_timestamp(envelope: DataFrame, epoch_ms: int) -> DataFrame:
    """Per partition, everything from the first offset whose time is not before `epoch_ms`.

    A partition without such an offset yields nothing. Start offsets are one row
    per topic partition, found with a map-side combine.
    """
    starts = envelope.filter(F.col("timestamp") >= epoch_ms).groupBy(
        F.col("topic").alias("__topic"), F.col("partition").alias("__partition")
    ).agg(F.min("offset").alias("__start"))
    return _from_offsets(envelope, starts)


def start_offsets(envelope: DataFrame, start_from: str) -> DataFrame | None:
    """Where a stream over archived messages starts, one row per topic partition; None is the beginning.

    From a time on: the first offset that is not before it, or else the end, as a broker does.
    """
    kind, millis = parse_start(start_from)
    if kind == "earliest":
        return None
    if kind == "latest":
        return high_watermarks(envelope)
    return envelope.groupBy(F.col("topic").alias("__topic"), F.col("partition").alias("__partition")).agg(
        F.coalesce(F.min(F.when(F.col("timestamp") >= millis, F.col("offset"))), F.max("offset") + 1).alias("__start")
    )


def spread(envelope: DataFrame) -> DataFrame:
    """Archived messages, dealt out evenly: one task reads a row group of a file, and to decode a message costs far more than to move it."""
    return envelope.hint("rebalance")


def high_watermarks(envelope: DataFrame) -> DataFrame:
    """The offset after the last one, per topic partition: where `latest` starts."""
    return envelope.groupBy(F.col("topic").alias("__topic"), F.col("partition").alias("__partition")).agg(
        (F.max("offset") + 1).alias("__start")
    )


def from_latest(envelope: DataFrame, watermarks: DataFrame) -> DataFrame:
    """What arrived after the watermarks were taken; a new partition is read from its beginning."""
    on = (F.col("topic") == F.col("__topic")) & (F.col("partition") == F.col("__partition"))
    joined = envelope.join(watermarks, on, "left")
    return joined.filter(F.col("offset") >= F.coalesce("__start", F.lit(0))).drop("__topic", "__partition", "__start")


def _from_offsets(envelope: DataFrame, starts: DataFrame) -> DataFrame:
    on = (F.col("topic") == F.col("__topic")) & (F.col("partition") == F.col("__partition"))
    joined = envelope.join(F.broadcast(starts), on, "inner").filter(F.col("offset") >= F.col("__start"))
    return joined.drop("__topic", "__partition", "__start")


# ---- decoding --------------------------------------------------------------------


def _text(col: Column) -> Column:
    """Bytes as UTF-8 text, bad bytes replaced; text stays."""
    return F.make_valid_utf8(col.cast("string"))


def _stripped(col: Column) -> Column:
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def classify(envelope: DataFrame) -> DataFrame:
    """Add `_m`: the kind of each message (json, csv, raw or rejected) and its parsed parts.

    A JSON object is decoded by field. Text that is not JSON is a CSV line when the
    key reads `header:a,b` and the counts agree, else raw text. JSON scalars,
    arrays and NULL values are rejected.
    """
    text, key = _text(F.col("value")), _text(F.col("key"))
    rows = envelope.withColumns({"_text": text, "_key": F.when(key != "", key)})
    rows = rows.withColumn("_json", F.try_parse_json("_text"))
    headers = F.split(F.replace(F.col("_key"), F.lit(HEADER_PREFIX), F.lit("")), ",")
    rows = rows.withColumn("_headers", F.when(F.col("_key").startswith(HEADER_PREFIX), headers))
    rows = rows.withColumn("_values", F.when(F.col("_headers").isNotNull(), F.split(_stripped(F.col("_text")), ",")))
    kind = (
        F.when(F.col("_text").isNull(), "rejected")
        .when(F.schema_of_variant("_json").startswith("OBJECT"), "json")
        .when(F.col("_json").isNotNull(), "rejected")
        .when(F.size("_headers") == F.size("_values"), "csv")
        .otherwise("raw")
    )
    parts = F.struct(kind.alias("kind"), F.col("_text").alias("text"), F.col("_key").alias("key"), F.col("_json").alias("json"),
                     F.col("_headers").alias("headers"), F.col("_values").alias("values"))
    # a one-element generator: filters on the outcome stay above it instead of being
    # pushed into the scan with a copy of the whole parse for every mention
    return rows.select(*envelope.columns, F.explode_outer(F.array(parts)).alias("_m"))


def _field(name: str, dtype: T.DataType) -> Column:
    """A payload field from either form; of repeated CSV headers the last one counts."""
    path = "$['" + name.replace("'", "\\'") + "']"
    from_json = F.try_variant_get(F.col("_m.json"), path, dtype.simpleString())
    from_end = F.array_position(F.reverse("_m.headers"), name)
    from_csv = F.when(from_end > 0, F.try_element_at(F.col("_m.values"), (-from_end).cast("int")))
    return F.when(F.col("_m.kind") == "json", from_json).when(F.col("_m.kind") == "csv", from_csv.try_cast(dtype))


def _mistyped(name: str, dtype: T.DataType) -> Column:
    """Whether a message has a value for the field that is not of its type; JSON null and an empty CSV value are none."""
    path = "$['" + name.replace("'", "\\'") + "']"
    typed = _field(name, dtype)
    given = F.try_variant_get(F.col("_m.json"), path, "variant")
    wrong = typed.isNull()
    if isinstance(dtype, T.IntegralType):  # 1.5 is no whole number
        number = F.try_variant_get(F.col("_m.json"), path, "double")
        wrong = wrong | F.coalesce(number != typed.cast("double"), F.lit(False))
    from_json = given.isNotNull() & ~F.coalesce(F.is_variant_null(given), F.lit(False)) & wrong
    text = _field(name, T.StringType())
    from_csv = text.isNotNull() & (text != "") & typed.isNull()
    return F.when(F.col("_m.kind") == "json", from_json).when(F.col("_m.kind") == "csv", from_csv).otherwise(F.lit(False))


def _declared(payload: T.StructType | str) -> tuple[T.StructType, list[T.StructField]]:
    """The schema of a payload, and its fields that become columns."""
    schema = T.StructType.fromDDL(payload) if isinstance(payload, str) else payload
    taken = set(ENVELOPE) | {"raw"}
    return schema, [f for f in schema.fields if f.name not in taken]


def _rest(fields: list[T.StructField], keep_mistyped: bool) -> Column:
    """The payload's other fields as one variant object, NULL if there are none."""
    held = F.array(*[F.when(~_mistyped(f.name, f.dataType) if keep_mistyped else F.lit(True), F.lit(f.name)) for f in fields]).cast("array<string>")
    held = F.array_compact(held)
    from_json = F.map_filter(F.try_variant_get(F.col("_m.json"), "$", "map<string,variant>"), lambda k, _: ~F.array_contains(held, k))
    pairs = F.arrays_zip(F.col("_m.headers").alias("k"), F.col("_m.values").alias("v"))
    last = F.filter(pairs, lambda x, i: ~F.array_contains(held, x["k"]) & ~F.array_contains(F.slice(F.col("_m.headers"), i + 2, F.size("_m.headers")), x["k"]))
    from_csv = F.map_from_entries(F.transform(last, lambda x: F.struct(x["k"], x["v"].cast("variant"))))
    found = F.when(F.col("_m.kind") == "json", from_json).when(F.col("_m.kind") == "csv", from_csv)
    return F.when(F.size(found) > 0, F.to_variant_object(found))


def decode(envelope: DataFrame, payload: T.StructType | str, rest: str | None = None, keep_mistyped: bool = False, mark: Sequence[str] = ()) -> DataFrame:
    """Payload fields, `raw` and the envelope columns of every readable message.

    The schema of the payload is declared, so nothing is inferred from data.
    Envelope columns win over payload fields of the same name. `rest` names a variant
    column for all fields that have no column. A message with a value of another type
    is left to `rejects`; with `keep_mistyped` it stays, and the value goes to `rest`.
    `mark` names three columns, for why a message is rejected, its text and its topic: all messages are returned.
    """
    if keep_mistyped and not rest:
        raise ValueError("keep_mistyped needs a rest column")
    schema, declared = _declared(payload)
    rows = classify(envelope)
    if not mark:
        rows = rows.filter(F.col("_m.kind") != "rejected")
        if not keep_mistyped:
            for f in declared:
                rows = rows.filter(~_mistyped(f.name, f.dataType))
    marks = [c.alias(n) for c, n in zip((_reason(None if keep_mistyped else payload), F.col("_m.text"), F.col("topic")), mark)]
    fields = [(F.when(~_mistyped(f.name, f.dataType), _field(f.name, f.dataType)) if keep_mistyped else _field(f.name, f.dataType)).alias(f.name) for f in declared]
    raw = F.when(F.col("_m.kind") == "raw", F.col("_m.text"))
    if "raw" in schema.names:
        raw = F.coalesce(raw, _field("raw", T.StringType()))
    others = [_rest(declared, keep_mistyped).alias(rest)] if rest else []
    return rows.select(*fields, *others, raw.alias("raw"), "offset", "partition", "timestamp", F.col("_m.key").alias("key"), *marks)


def _reason(payload: T.StructType | str | None) -> Column:
    """Why a classified message is rejected, NULL if it is not; values of another type need the payload's schema."""
    reason = F.when(F.col("_m.kind") == "rejected", F.when(F.col("_m.text").isNull(), "null value").otherwise("not an object"))
    if payload is not None:
        wrong = [F.when(_mistyped(f.name, f.dataType), F.lit(f"{f.name} is not {f.dataType.simpleString()}")) for f in _declared(payload)[1]]
        if wrong:
            said = F.concat_ws("; ", *wrong)
            reason = F.coalesce(reason, F.when(said != "", said))
    return reason


def rejects(envelope: DataFrame, payload: T.StructType | str | None = None) -> DataFrame:
    """The messages `decode` leaves out, with the reason; those with values of another type need the payload's schema."""
    rows = classify(envelope).withColumn("_reject_reason", _reason(payload)).filter(F.col("_reject_reason").isNotNull())
    return rows.select("topic", "partition", "offset", F.col("_m.text").alias("value"), "_reject_reason")


def decode_avro(envelope: DataFrame, avro_schema: str) -> DataFrame:
    """Avro values by a given schema; needs Spark's Avro package.

    Registry framing (one magic byte and a four-byte schema id) is skipped.
    """
    from pyspark.sql.avro.functions import from_avro

    body = F.expr("substring(value, 6, length(value) - 5)")
    rows = envelope.withColumn("_p", from_avro(body, avro_schema, {"mode": "PERMISSIVE"}))
    names = [f.name for f in rows.schema["_p"].dataType.fields if f.name not in ENVELOPE]
    payload = [F.col(f"_p.`{n}`").alias(n) for n in names]
    return rows.filter(F.col("_p").isNotNull()).select(*payload, "offset", "partition", "timestamp", _text(F.col("key")).alias("key"))
