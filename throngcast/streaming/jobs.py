"""The live path: staging, delay signal, scoring, conditions, counters, escalations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from throngcast.plans.live import enrich_vehicles, parse_trip_updates, parse_vehicles, trip_delays
from throngcast.plans.scoring import current_bucket, score
from throngcast.plans.serving import RECENCY, latest_per_station, newly_severe
from throngcast.plans.signal import delay_signal_stream
from throngcast.schemas import CURRENT_CONDITION, DELAY_SIGNAL, SCORED, TRIP_DELAYS, VEHICLE_POSITIONS, WINDOW_COUNT
from throngcast.sources.readers import file_stream
from throngcast.sources.documents import CommitLedger, write_documents_once
from throngcast.sources.keyed import KeyedTable
from throngcast.sources.writers import append_batch, merge_batch, publish_batch, read_snapshot, write_documents
from throngcast.streaming.runner import EVERY_30_SECONDS, for_each_batch, to_parquet
from throngcast.streaming.state import escalation_stream


def stage_vehicles(
    messages: DataFrame, bridge: DataFrame, path: str, checkpoint: str, *, trigger: dict = EVERY_30_SECONDS
) -> StreamingQuery:
    """Vehicle messages to enriched positions, partitioned by event date."""
    positions = enrich_vehicles(parse_vehicles(messages), bridge)
    return to_parquet(positions, path, checkpoint, partition_by=["event_date"], trigger=trigger)


def stage_trip_delays(
    messages: DataFrame,
    full: DataFrame | None,
    prefix: DataFrame | None,
    path: str,
    checkpoint: str,
    *,
    trigger: dict = EVERY_30_SECONDS,
    **service_day,
) -> StreamingQuery:
    """Trip-update messages to delays per stop, partitioned by event date."""
    delays = trip_delays(parse_trip_updates(messages), full, prefix, **service_day)
    return to_parquet(delays, path, checkpoint, partition_by=["event_date"], trigger=trigger)


def stage_vehicles_reloading(
    messages: DataFrame,
    load_bridge: Callable[[SparkSession], DataFrame],
    path: str,
    checkpoint: str,
    *,
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """``stage_vehicles`` with the bridge loaded for every batch: a rebuilt one counts from the next trigger on.

    Each batch is published once as a folder of ``path``, which ``file_stream`` and ``batch_table`` read.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        publish_batch(enrich_vehicles(parse_vehicles(batch), load_bridge(batch.sparkSession)), batch_id, path)

    return for_each_batch(messages, handle, checkpoint, trigger=trigger)


def stage_trip_delays_reloading(
    messages: DataFrame,
    load_schedule: Callable[[SparkSession], tuple[DataFrame | None, DataFrame | None]],
    path: str,
    checkpoint: str,
    *,
    trigger: dict = EVERY_30_SECONDS,
    **service_day,
) -> StreamingQuery:
    """``stage_trip_delays`` with both schedule lookups loaded for every batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        full, prefix = load_schedule(batch.sparkSession)
        publish_batch(trip_delays(parse_trip_updates(batch), full, prefix, **service_day), batch_id, path)

    return for_each_batch(messages, handle, checkpoint, trigger=trigger)


def stage_delay_signal(
    spark: SparkSession,
    vehicles: str,
    delays: str,
    path: str,
    checkpoint: str,
    *,
    trigger: dict = EVERY_30_SECONDS,
    slots: bool = False,
    **source,
) -> StreamingQuery:
    """Staged vehicles and delays to the rolling delay per station.

    A trigger that reads far more than a few minutes of the feed needs ``slots``, see
    ``delay_pairs_stream``. The choice belongs to the checkpoint.
    """
    signal = delay_signal_stream(
        file_stream(spark, vehicles, VEHICLE_POSITIONS, **source),
        file_stream(spark, delays, TRIP_DELAYS, **source),
        slots=slots,
    )
    return to_parquet(signal, path, checkpoint, trigger=trigger)


def score_signal(
    signal: DataFrame,
    load_views: Callable[[SparkSession], tuple[DataFrame, DataFrame, DataFrame]],
    path: str | None,
    checkpoint: str,
    *,
    weather_bucket: Callable[[SparkSession], str | Column],
    inserted_at: Column | None = None,
    sink: str = "parquet",
    trigger: dict = EVERY_30_SECONDS,
    **options: str,
) -> StreamingQuery:
    """Score every micro-batch of the signal into a sink.

    The Parquet sink gives each batch its own partition of ``path``, which a retry replaces. In a
    document store, or ``documents`` below ``path`` in its place, a retried batch replaces its
    documents, and a batch the ledger beside the checkpoint holds is not written again. The console
    shows the rows.

    Baseline, maxima and bridge are loaded per batch, so a rebuilt table is picked
    up by the next trigger, and the plan inside a batch is adaptive.
    """

    ledger = CommitLedger(f"{checkpoint}/documents", checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        baseline, maxima, bridge = load_views(session)
        scored = score(
            batch,
            baseline,
            maxima,
            bridge,
            weather_bucket=weather_bucket(session),
            inserted_at=inserted_at,
        )
        if sink == "parquet":
            append_batch(scored, batch_id, path)
        elif sink == "console":
            write_documents(scored, sink)
        else:
            write_documents_once(scored, batch_id, sink, ledger, path=path, **options)

    return for_each_batch(signal, handle, checkpoint, trigger=trigger)


def conditions_table(path: str) -> KeyedTable:
    """The newest condition per scope."""
    return KeyedTable(path, CURRENT_CONDITION, ["scope"], ["updated_at"])


def upsert_conditions(
    conditions: DataFrame, path: str, checkpoint: str, *, trigger: dict = EVERY_30_SECONDS
) -> StreamingQuery:
    """Keep the newest condition per scope; read it back with ``current_conditions``."""
    table = conditions_table(path)
    return for_each_batch(conditions, table.upsert, checkpoint, trigger=trigger)


def current_conditions(spark: SparkSession, path: str) -> DataFrame:
    return conditions_table(path).read(spark)


def stored_condition(path: str, as_of: Column, **choice: str) -> Callable[[SparkSession], Column]:
    """The weather bucket for ``score_signal`` from the table that ``upsert_conditions`` keeps."""

    def load(spark: SparkSession) -> Column:
        return current_bucket(current_conditions(spark, path), as_of, **choice).select("weather_bucket").scalar()

    return load


def windowed_counts(df: DataFrame, time: str, *, width: str = "10 seconds", lateness: str = "30 seconds") -> DataFrame:
    """Rows per tumbling window."""
    return (
        df.withWatermark(time, lateness)
        .groupBy(F.window(time, width).alias("window"))
        .agg(F.count(F.lit(1)).alias("msg_count"))
        .select("window.start", "window.end", "msg_count")
    )


def counts_table(path: str) -> KeyedTable:
    """Counts per window, in one part per day: days that no late row touches are not written again."""
    return KeyedTable(path, WINDOW_COUNT, ["start", "end"], part=F.date_format("start", "yyyy-MM-dd"))


def keep_counts(counts: DataFrame, path: str, checkpoint: str, *, trigger: dict = EVERY_30_SECONDS) -> StreamingQuery:
    """Maintain updated window counts; read them back with ``current_counts``."""
    table = counts_table(path)
    return for_each_batch(counts, table.upsert, checkpoint, output_mode="update", trigger=trigger)


def current_counts(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """All counts, or those of some days, which reads the files of these only."""
    return counts_table(path).read(spark, days)


def watch_escalations(
    scored: DataFrame, state: str, path: str, checkpoint: str, *, trigger: dict = EVERY_30_SECONDS
) -> StreamingQuery:
    """Stations that turned SEVERE since the snapshot of the batch before.

    The snapshot below ``state`` is one row per station, and a batch reads only the one before
    it: a trigger costs as much after a year as at the start.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = merge_batch(latest_per_station(batch), batch_id, state, ["station_complex_id"], RECENCY)
        current = read_snapshot(session, state, batch.schema, batch_id)
        append_batch(newly_severe(before, current), batch_id, path)

    return for_each_batch(scored, handle, checkpoint, trigger=trigger)


def track_escalations(
    scored: DataFrame, path: str, checkpoint: str, *, trigger: dict = EVERY_30_SECONDS, **tracking
) -> StreamingQuery:
    """Every row on which a station turns SEVERE, in event order, also several in one trigger.

    ``watch_escalations`` compares a station's newest rows of two triggers, at once; this one waits
    for the watermark and misses no change.
    """
    return to_parquet(escalation_stream(scored, **tracking), path, checkpoint, trigger=trigger)
