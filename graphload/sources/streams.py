"""Message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shapes import project_json

# Where a message stream starts by default.
STARTING_OFFSETS = "latest"


def kafka_options(spec: dict) -> dict[str, str]:
    """Reader options of a Kafka source."""
    for key in ("server", "topic"):
        if not str(spec.get(key, "")).strip():
            raise ValueError(f"a Kafka source needs {key}")
    if int(spec.get("interval_seconds", 30)) < 0:
        raise ValueError("interval_seconds must not be negative")
    options = {
        "kafka.bootstrap.servers": spec["server"],
        "subscribe": spec["topic"],
        "startingOffsets": spec.get("starting_offsets", STARTING_OFFSETS),
    }
    if spec.get("max_offsets_per_trigger") is not None:
        options["maxOffsetsPerTrigger"] = str(spec["max_offsets_per_trigger"])
    if spec.get("security_protocol"):
        options["kafka.security.protocol"] = spec["security_protocol"]
    if spec.get("mechanism"):
        options["kafka.sasl.mechanism"] = spec["mechanism"]
    if spec.get("kerberos"):
        options["kafka.sasl.kerberos.service.name"] = spec["kerberos_service_name"]
    return options


def pulsar_options(spec: dict) -> dict[str, str]:
    """Reader options of a Pulsar source: exactly one way to name topics."""
    options = {str(k): str(v) for k, v in spec.get("options", {}).items()}
    for key, name in (("topic", "topic"), ("topics", "topics"), ("topics_pattern", "topicsPattern")):
        if spec.get(key):
            options[name] = spec[key]
    if len({"topic", "topics", "topicsPattern"} & set(options)) != 1:
        raise ValueError("give exactly one of topic, topics and topics_pattern")
    return {"service.url": spec["service_url"], "admin.url": spec["admin_url"], **options}


def read_stream(spark: SparkSession, spec: dict, fields: list[str] = ()) -> DataFrame:
    """Streaming rows. Kafka payloads are JSON objects, read as text columns ``fields``."""
    kind = spec["type"].lower()
    if kind == "kafka":
        raw = spark.readStream.format("kafka").options(**kafka_options(spec)).load()
        return project_json(raw.select(F.col("value").cast("string")), "value", fields)
    if kind == "pulsar":
        return spark.readStream.format("pulsar").options(**pulsar_options(spec)).load()
    # a folder that grows, with a known schema, or any other streaming connector
    reader = spark.readStream.format(spec.get("format", "parquet"))
    if spec.get("schema") is not None:
        reader = reader.schema(spec["schema"])
    if spec.get("max_files_per_trigger"):
        reader = reader.option("maxFilesPerTrigger", spec["max_files_per_trigger"])
    return reader.options(**spec.get("options", {})).load(spec.get("path"))
