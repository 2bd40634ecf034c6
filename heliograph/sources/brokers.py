"""Message sources and sinks with one interface: a Kafka cluster, or a folder of message files.

Both speak `topic`, `key`, `value` rows. Jobs take either, so every job runs on files where there is no Kafka.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

MESSAGE = "topic STRING, key STRING, value STRING, timestamp TIMESTAMP, offset BIGINT"


@dataclass(frozen=True)
class Kafka:
    """Topics on a Kafka cluster. Needs Spark's Kafka package on the session."""

    servers: str
    starting: str = "latest"
    max_per_batch: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def read_options(self, topic: str, streaming: bool) -> dict[str, str]:
        starting = self.starting if streaming else "earliest"
        chosen = {"kafka.bootstrap.servers": self.servers, "subscribe": topic, "startingOffsets": starting}
        if streaming and self.max_per_batch:
            chosen["maxOffsetsPerTrigger"] = str(self.max_per_batch)
        return {**chosen, **self.options}

    def write_options(self, topic: str | None) -> dict[str, str]:
        chosen = {"kafka.bootstrap.servers": self.servers}
        return {**chosen, "topic": topic} if topic else chosen

    def stream(self, spark: SparkSession, topic: str) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.read_options(topic, True)).load()

    def history(self, spark: SparkSession, topic: str) -> DataFrame:
        return spark.read.format("kafka").options(**self.read_options(topic, False)).load()

    def write(self, messages: DataFrame, topic: str | None = None, batch_id: int | None = None) -> None:
        """Append messages; without `topic` the rows' own `topic` column routes them."""
        messages.write.format("kafka").options(**self.write_options(topic)).save()

    def start(self, messages: DataFrame, topic: str | None, checkpoint: str, **trigger) -> StreamingQuery:
        writer = messages.writeStream.format("kafka").options(**self.write_options(topic))
        writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()


# Messages of one compressed file, which a reader takes as a whole.
FILE_MESSAGES = 500_000


@dataclass(frozen=True)
class Folder:
    """Topics as folders of JSON-lines message files below `root`.

    With `compression`, such as gzip, the files written are compressed; readers tell by the names of the files.
    """

    root: str
    max_per_batch: int | None = None
    compression: str | None = None

    def _path(self, topic: str) -> str:
        return f"{self.root}/topic={topic}"

    def write_options(self) -> dict[str, str]:
        return {"compression": self.compression, "maxRecordsPerFile": str(FILE_MESSAGES)} if self.compression else {}

    def stream(self, spark: SparkSession, topic: str) -> DataFrame:
        reader = spark.readStream.schema("key STRING, value STRING")
        if self.max_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.max_per_batch)
        return reader.option("recursiveFileLookup", "true").json(self._path(topic)).withColumn("topic", F.lit(topic))

    def history(self, spark: SparkSession, topic: str) -> DataFrame:
        reader = spark.read.schema("key STRING, value STRING").option("recursiveFileLookup", "true")
        return reader.json(self._path(topic)).withColumn("topic", F.lit(topic))

    def write(self, messages: DataFrame, topic: str | None = None, batch_id: int | None = None) -> None:
        """Write messages; a `batch_id` makes a repeated micro-batch replace its own files only.

        Without `topic` the rows' own `topic` column chooses the folder.
        """
        mode, options = "append" if batch_id is None else "overwrite", self.write_options()
        if topic:
            part = "" if batch_id is None else f"/batch={batch_id}"
            messages.write.mode(mode).options(**options).json(self._path(topic) + part)
        elif batch_id is None:
            messages.write.mode("append").options(**options).partitionBy("topic").json(self.root)
        else:
            tagged = messages.withColumn("batch", F.lit(batch_id))
            writer = tagged.write.mode("overwrite").options(**options).option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("topic", "batch").json(self.root)

    def start(self, messages: DataFrame, topic: str | None, checkpoint: str, **trigger) -> StreamingQuery:
        if topic:
            writer = messages.writeStream.format("json").option("path", self._path(topic))
        else:
            writer = messages.writeStream.format("json").option("path", self.root).partitionBy("topic")
        writer = writer.options(**self.write_options()).outputMode("append").option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()


@dataclass(frozen=True)
class Console:
    """A sink for looking at messages: the first `rows` of each batch."""

    rows: int = 20

    def write(self, messages: DataFrame, topic: str | None = None, batch_id: int | None = None) -> None:
        messages.show(self.rows, truncate=False)

    def start(self, messages: DataFrame, topic: str | None, checkpoint: str, **trigger) -> StreamingQuery:
        writer = messages.writeStream.format("console").option("numRows", self.rows).option("truncate", "false")
        writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()
