"""The event stream: subscribing, decoding JSON, encoding JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.times import to_utc
from txnlake.schemas import EVENT_AMOUNT, EVENT_COLUMNS

DEFAULT_TOPIC = "transactions.raw"

_TEXT_FIELDS = (
    "transaction_id",
    "card_id",
    "merchant_name",
    "merchant_category",
    "currency",
    "country",
    "status",
)
_INTEGER_FIELDS = ("user_id", "merchant_id")

# Fixed value: text forms of a whole number.
_WHOLE_NUMBER = r"^\s*[+-]?\d+(\.0*)?\s*\z"


def read_events(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    schema: str | None = None,
    path: str | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Read keyed messages, from the earliest offset unless told otherwise.

    With Kafka, progress lives in the query's checkpoint, not in a consumer
    group. File formats need `path` and hold at least a `value` column.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        settings = {"subscribe": DEFAULT_TOPIC, "startingOffsets": "earliest"}
        given = options or {}
        if "assign" in given or "subscribePattern" in given:
            settings.pop("subscribe")
        return reader.format("kafka").options(**{**settings, **given}).load()
    reader = reader.format(fmt).schema(schema or "key string, value string")
    return reader.options(**(options or {})).load(path)


def _typed(name: str) -> Column:
    """The field as its column type; null when missing or ill-typed.

    Numbers and times may come as JSON numbers or strings; the text of any other
    JSON type fails their patterns and casts. Text must be a JSON string.
    """
    text = F.col(f"_text.{name}")
    if name in _TEXT_FIELDS:
        return F.when(F.col(f"_kind_{name}") == "STRING", text)
    if name in _INTEGER_FIELDS:
        return F.when(text.rlike(_WHOLE_NUMBER), F.split_part(text, F.lit("."), F.lit(1))).try_cast(
            "bigint"
        )
    if name == "amount":
        return text.try_cast(EVENT_AMOUNT)
    return to_utc(text)


def decode_events(df: DataFrame) -> DataFrame:
    """Parse `value` into the event fields without ever failing.

    Every body is parsed once, as a variant: that keeps numbers exact and tells
    a JSON string from a JSON number. `is_json` is false when the body is not
    one JSON object; fields of the wrong type are null. Other columns pass
    through.
    """
    # The parser stops at the closing brace, so what follows it is checked apart.
    trimmed = F.btrim("value", F.lit(" \t\r\n"))
    framed = F.startswith(trimmed, F.lit("{")) & F.endswith(trimmed, F.lit("}"))
    # Two descents over all fields: one lookup per field makes the generated
    # code too long for the JVM to compile, which doubled the run time.
    texts = "struct<" + ", ".join(f"{c}: string" for c in EVENT_COLUMNS) + ">"
    nodes = "struct<" + ", ".join(f"{c}: variant" for c in _TEXT_FIELDS) + ">"
    return (
        df.withColumn("value", F.col("value").cast("string"))
        .withColumn("_body", F.when(framed, F.try_parse_json("value")))
        .withColumns(
            {
                "is_json": F.col("_body").isNotNull(),
                "_text": F.try_variant_get("_body", "$", texts),
                "_node": F.try_variant_get("_body", "$", nodes),
            }
        )
        .withColumns(
            {f"_kind_{c}": F.schema_of_variant(F.col(f"_node.{c}")) for c in _TEXT_FIELDS}
        )
        .withColumns({c: _typed(c) for c in EVENT_COLUMNS})
        .drop("_body", "_text", "_node", *[f"_kind_{c}" for c in _TEXT_FIELDS])
    )


def to_keyed_json(df: DataFrame, *keep: str) -> DataFrame:
    """(key, value): the user id as text and the event as JSON.

    Amounts travel as text, so no reader turns them into doubles. `keep` names
    columns to carry beside the message, as a topic does with its timestamp.
    """
    # As text a timestamp has no fraction or a shortened one; it is sent with
    # none or six digits.
    text = F.col("event_time").cast("string")
    padded = F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)
    stamp = F.concat(F.translate(padded, " ", "T"), F.lit("Z"))
    wire = {"amount": F.col("amount").cast("string"), "event_time": stamp}
    fields = [wire.get(c, F.col(c)).alias(c) for c in EVENT_COLUMNS]
    return df.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        *keep,
    )


def publish_events(df: DataFrame, fmt: str = "kafka", options: dict[str, str] | None = None,
                   path: str | None = None) -> None:
    """Append the encoded events to a topic or to files."""
    writer = to_keyed_json(df).write.format(fmt)
    if fmt == "kafka":
        writer.options(**{"topic": DEFAULT_TOPIC, **(options or {})}).save()
    else:
        writer.options(**(options or {})).mode("append").save(path)
