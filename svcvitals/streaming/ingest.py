"""Streaming forms of the ingestion paths.

The reference's streams are append-only (message envelopes land in a raw table; warning
logs are routed to the dataset). Here each is ``readStream`` -> map-only transform ->
``writeStream`` in append mode with a checkpoint, so a restart resumes where the last
committed batch ended and does not re-append committed files. No state store is needed.
Duplicated messages are kept, as in the raw tables, unless ``stream_events`` is told for how
long a message may be delivered again; only then is there a state store, of message ids.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from svcvitals import schemas as S
from svcvitals.sources.tables import DATE_PARTITION, LOG_DATE_PARTITION
from svcvitals.operators import events as E, logs as L


def read_envelope_stream(spark: SparkSession, path: str, fmt: str = "json",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(S.EVENT_ENVELOPE).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def kafka_to_envelopes(records: DataFrame) -> DataFrame:
    """Kafka records (topic, key, value, partition, offset, timestamp, headers) -> message
    envelopes. Mapping: topic -> subscription_name; key (else partition-offset) ->
    message_id; record timestamp -> publish_time; value -> data; headers -> attributes
    (a JSON object of header name -> value; of headers with one name the last counts).
    Works on batch or streaming records."""
    given = F.transform(F.coalesce(F.col("headers"), F.array()),
                        lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")))
    last = F.filter(given, lambda h, i: ~F.exists(F.slice(given, i + F.lit(2), F.size(given)), lambda x: x["key"] == h["key"]))
    headers = F.map_from_entries(last)
    msg_id = F.coalesce(F.col("key").cast("string"),
                        F.concat_ws("-", F.col("partition").cast("string"), F.col("offset").cast("string")))
    return records.select(F.col("topic").alias("subscription_name"), msg_id.alias("message_id"),
                          F.col("timestamp").alias("publish_time"), F.col("value").cast("string").alias("data"),
                          F.to_json(headers).alias("attributes"))


def read_envelope_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
                        starting_offsets: str = "earliest") -> DataFrame:
    """Message envelopes streamed from a Kafka topic (needs the Spark Kafka connector on
    the classpath); see :func:`kafka_to_envelopes` for the mapping."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap_servers)
           .option("subscribe", topic)
           .option("startingOffsets", starting_offsets)
           .option("includeHeaders", "true")
           .load())
    return kafka_to_envelopes(raw)


#: Files that one day of a micro-batch is split over.
FILES_PER_DAY = 8


def _by_day(df: DataFrame, partition_by_day: bool, ts_col: str = "publish_time",
            partition_col: str = DATE_PARTITION, files_per_day: int = FILES_PER_DAY) -> tuple[DataFrame, list[str] | None]:
    """Add a day partition column (UTC day of ``ts_col``) when asked, and cluster each
    micro-batch by it. A live batch is mostly one day: a salt (a hash of the row) splits a
    day over ``files_per_day`` tasks, each writing one file per day."""
    if not partition_by_day:
        return df, None
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    salt = F.pmod(F.xxhash64(*hashable), F.lit(files_per_day))
    df = df.withColumn(partition_col, F.to_date(ts_col))
    return df.repartition(F.col(partition_col), salt), [partition_col]


def _sink(df: DataFrame, sink_path: str, checkpoint_path: str, available_now: bool,
          processing_time: str | None, partition_by: list[str] | None = None) -> StreamingQuery:
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", sink_path).option("checkpointLocation", checkpoint_path))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


MESSAGE_KEY = ["subscription_name", "message_id"]


def first_deliveries(messages: DataFrame, within: str) -> DataFrame:
    """A stream of messages without those delivered again ``within`` an interval (such as
    '7 days') of their first arrival.

    The watermark follows the time of arrival, not of publishing: a message is never late,
    so none is lost, and the state holds the ids of one interval. Messages of one id on
    two subscriptions are two messages; messages without an id are all kept. Spark's default
    store holds every id in executor memory: start the stream within :func:`state_on_disk`.
    """
    known = (messages.filter(F.col("message_id").isNotNull())
             .withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
             .dropDuplicatesWithinWatermark(MESSAGE_KEY).drop("_arrived"))
    return known.unionByName(messages.filter(F.col("message_id").isNull()))


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: State in RocksDB on executor disks, within a bounded memory, without a lookup more per row to count them.
_ON_DISK = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams that start in the block keep their state on disk, not in executor memory, unless
    the session names a provider of its own. A stream whose checkpoint was begun with another
    provider goes on with that one, which Spark reads from the checkpoint."""
    before = {k: spark.conf.get(k, None) for k in _ON_DISK}
    if before[_PROVIDER] is not None:
        yield
        return
    try:
        for k, v in _ON_DISK.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_events(spark: SparkSession, source_path: str, sink_path: str, checkpoint_path: str,
                  fmt: str = "json", available_now: bool = True,
                  processing_time: str | None = None, partition_by_day: bool = False,
                  max_files_per_trigger: int | None = None,
                  redelivered_within: str | None = None) -> StreamingQuery:
    """Append every message envelope (subscription, id, publish time, data, attributes)
    from ``source_path`` to the raw table at ``sink_path``. With ``partition_by_day`` the
    table is partitioned by publish day (for high-volume feeds; read it back with
    ``sources.tables.read_envelopes(path, since=...)`` to prune days). Unpartitioned by
    default, like the raw tables it mirrors: sparse feeds spread over years would
    otherwise write one small file per day. With ``redelivered_within`` (an interval),
    messages delivered again within it are left out (:func:`first_deliveries`), their ids
    kept on disk (:func:`state_on_disk`)."""
    df = read_envelope_stream(spark, source_path, fmt, max_files_per_trigger)
    if not redelivered_within:
        df, parts = _by_day(df, partition_by_day)
        return _sink(df, sink_path, checkpoint_path, available_now, processing_time, parts)
    df, parts = _by_day(first_deliveries(df, redelivered_within), partition_by_day)
    with state_on_disk(spark):
        return _sink(df, sink_path, checkpoint_path, available_now, processing_time, parts)


def stream_deployment_events(spark: SparkSession, builds_path: str, deploys_path: str,
                             sink_path: str, checkpoint_path: str, fmt: str = "json",
                             available_now: bool = True, partition_by_day: bool = False) -> StreamingQuery:
    """Normalised deployment events computed on the fly from both envelope streams,
    optionally partitioned by publish day (``sources.tables.read_deployment_events``)."""
    ev = E.deployment_events_raw(read_envelope_stream(spark, builds_path, fmt),
                                 read_envelope_stream(spark, deploys_path, fmt))
    ev, parts = _by_day(ev, partition_by_day)
    return _sink(ev, sink_path, checkpoint_path, available_now, None, parts)


def stream_route_logs(spark: SparkSession, source_path: str, sink_path: str, checkpoint_path: str,
                      fmt: str = "parquet", available_now: bool = True,
                      partition_by_day: bool = False) -> StreamingQuery:
    """Route warning-and-above service logs from a log stream into a table, optionally
    partitioned by log day (``sources.tables.read_routed_logs``)."""
    logs = spark.readStream.schema(S.LOG_ENTRIES).format(fmt).load(source_path)
    routed, parts = _by_day(L.route_logs(logs), partition_by_day, "ts", LOG_DATE_PARTITION)
    return _sink(routed, sink_path, checkpoint_path, available_now, None, parts)
