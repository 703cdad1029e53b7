"""Resumable ingestion of landed series responses.

Each micro-batch writes its parsed rows to a folder of its own, so a replayed batch overwrites itself.
Reading keeps, per (entity, variable), the rows of the newest batch: the same result as deleting the
stored rows of a key and inserting the new ones, without rewriting the table. Within a batch the newest
response per key counts, by file time, then file name. Responses that cannot be read are stored apart.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eavcube.functions.numbers import normalised_difference
from eavcube.operators.ordered import checkpoint, numbered_by
from eavcube.operators.relational import latest_clear_rows
from eavcube.operators.skew import HOT_ROWS, skew_join
from eavcube.sources.keyed import KeyedTable
from eavcube.sources.responses import parse_matrix, parse_series, unreadable_series

RESPONSE = "entity_id string, body string"
BATCH = "batch"
_RECEIVED = "__received"


class SeriesLog:
    """Append-only series with latest-batch-wins reading."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ("entity_id", "variable")):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)

    def write_batch(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch}")

    def write_rejected(self, bodies: DataFrame, batch: int) -> None:
        bodies.write.mode("overwrite").parquet(f"{self.path}_rejected/{BATCH}={batch}")

    def read_rejected(self) -> DataFrame:
        """Responses that could not be read, with the batch they came in."""
        return self.spark.read.schema(f"{RESPONSE}, {BATCH} bigint").parquet(f"{self.path}_rejected")

    def read(self, hot_rows: int = HOT_ROWS) -> DataFrame:
        """Rows of the newest batch per key; only (key, batch) pairs are aggregated."""
        rows = self.spark.read.parquet(self.path)
        newest = rows.groupBy(*self.keys).agg(F.max(BATCH).alias(BATCH))
        return skew_join(rows, newest, [*self.keys, BATCH], "left_semi", hot_rows).drop(BATCH)

    def compact_to(self, path: str) -> SeriesLog:
        """Write the current rows as the first batch of a log elsewhere, without what was replaced."""
        compacted = SeriesLog(self.spark, path, self.keys)
        compacted.write_batch(self.read(), -1)
        return compacted


def newest_responses(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of the response that was received last, per key."""
    newest = rows.groupBy(*keys).agg(F.max(_RECEIVED).alias(_RECEIVED))
    return skew_join(rows, newest, [*keys, _RECEIVED], "left_semi", hot_rows).drop(_RECEIVED)


def start_ingest(spark: SparkSession, landing: str, log: SeriesLog, checkpoint: str,
                 max_files: int = 1000) -> StreamingQuery:
    """Process all responses that have landed since the last run, then stop."""
    landed = (
        spark.readStream.schema(RESPONSE).option("maxFilesPerTrigger", max_files).json(landing)
    )
    received = F.struct("_metadata.file_modification_time", "_metadata.file_name", F.xxhash64("body").alias("body"))

    def store(batch: DataFrame, number: int) -> None:
        # A response that is repeated in a file counts once.
        rows = parse_series(batch.dropDuplicates(["entity_id", _RECEIVED]), "body", ["entity_id", _RECEIVED])
        log.write_batch(newest_responses(rows, log.keys), number)
        log.write_rejected(unreadable_series(batch, "body").drop(_RECEIVED), number)

    return (
        landed.withColumn(_RECEIVED, received)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# ---- into a keyed table, with a ledger

LEDGER = "response string, entity_id string, rows bigint, last_id bigint, batch bigint"
# Buckets of a hash in which new rows are numbered.
_BUCKETS = 1024


class ResponseSink:
    """Takes landed responses into a stored series, each of them once.

    `rows_of` turns (entity_id, body, received) rows into (entity_id, variable, obs_date, value, received). The series
    is a table in parts by entity; `columns` names its number, variable, entity, date and value column. A response
    replaces all rows of the (entity, variable) pairs it brings; of two responses of one batch the later one counts.

    The ledger has a row for each response taken, by the file and the body it came with. It is written after the rows:
    a batch that failed in between is taken again and replaces its own rows; a response that is in the ledger is left
    out, whatever the state of the stream says. So neither a replay nor a lost stream state doubles or undoes anything.
    """

    def __init__(self, series: KeyedTable, ledger: KeyedTable, columns: Sequence[str], rows_of: Callable[[DataFrame], DataFrame]):
        self.series, self.ledger, self.columns, self.rows_of = series, ledger, list(columns), rows_of

    def take(self, batch: DataFrame, number: int) -> None:
        seen = batch.dropDuplicates(["response"])
        taken = self.ledger.read_for(seen).select("response")
        new = checkpoint(seen.join(taken, "response", "left_anti"))
        if new.isEmpty():
            return
        pairs = ["entity_id", "variable"]
        rows = checkpoint(newest_responses(self.rows_of(new.select("entity_id", "body", _RECEIVED)), pairs).dropDuplicates([*pairs, "obs_date"]))
        key = F.pmod(F.xxhash64(*pairs, "obs_date"), F.lit(_BUCKETS))
        named = checkpoint(numbered_by(rows, key, [*pairs, "obs_date"], "number", self._highest()).select(
            *[F.col(c).alias(n) for c, n in zip(("number", "variable", "entity_id", "obs_date", "value"), self.columns)]))
        number_, variable, entity = self.columns[:3]
        self.series.upsert(named, [entity, variable])
        counts = rows.groupBy("entity_id").agg(F.count(F.lit(1)).alias("rows"))
        (last,) = named.agg(F.max(number_)).first()
        lines = new.select("response", "entity_id").join(counts, "entity_id", "left")
        self.ledger.append(lines.withColumns({"rows": F.coalesce("rows", F.lit(0)), "last_id": F.lit(last), "batch": F.lit(number)}))

    def _highest(self) -> DataFrame:
        """The highest number given so far: the ledger's, or before its first entry the series' own."""
        if self.ledger.read().select("last_id").where("last_id is not null").isEmpty():
            return self.series.read().agg(F.max(self.columns[0]).alias("last_id"))
        return self.ledger.read().agg(F.max("last_id").alias("last_id"))


def series_rows(responses: DataFrame) -> DataFrame:
    """Rows of nested variable -> date -> value responses; those without a date are left out."""
    return parse_series(responses, "body", ["entity_id", _RECEIVED]).where("obs_date is not null")


def image_rows(indices: Sequence[str], clear: str, time: str = "time",
               bands: Mapping[str, Sequence[str]] | None = None) -> Callable[[DataFrame], DataFrame]:
    """Rows of header-and-rows responses of an image service: the indices of the newest clear day of each response.

    The responses have a column for each index, or the two `bands` it is the normalised difference of.
    """
    values = {n: normalised_difference(*[F.col(b) for b in bands[n]]) if bands else F.col(n) for n in indices}
    names = sorted({b for pair in bands.values() for b in pair}) if bands else list(indices)

    def rows_of(responses: DataFrame) -> DataFrame:
        parsed = parse_matrix(responses, "body", ["entity_id", _RECEIVED], {time: "epoch_ms", **{n: "double" for n in names}})
        return latest_clear_rows(parsed, ["entity_id", _RECEIVED], time, values, clear)

    return rows_of


def start_taking(spark: SparkSession, landing: str, sink: ResponseSink, checkpoint_folder: str, max_files: int = 1000) -> StreamingQuery:
    """Take all responses that have landed since the last run, then stop."""
    landed = spark.readStream.schema(RESPONSE).option("maxFilesPerTrigger", max_files).json(landing)
    received = F.struct("_metadata.file_modification_time", "_metadata.file_name", F.xxhash64("body").alias("body"))
    response = F.sha2(F.concat_ws("\n", "_metadata.file_path", "entity_id", "body"), 256)
    return (
        landed.withColumns({_RECEIVED: received, "response": response})
        .writeStream.foreachBatch(sink.take)
        .option("checkpointLocation", checkpoint_folder)
        .trigger(availableNow=True)
        .start()
    )
