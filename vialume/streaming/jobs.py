"""Streams of detections: classify, window, score, alert.

Groups lie in Spark's own state store, and all closing follows its watermark. Rows are first
aggregated by camera and a short span of time, which splits hot cameras and bounds every group by the
rate of one camera; what leaves a span is a few samples, or the rows where a value changes. Windows
are then two more aggregations. Alerts and unchanged frames also need the last value of each camera:
a table of one row for each, which every micro-batch compares its first rows with and replaces.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vialume.config import COLAPSO, COLAPSO_FIN, COLAPSO_INICIO, SLIDE_SECONDS, WINDOW_SECONDS
from vialume.functions.calendar import epoch_us, is_peak_hour, with_calendar
from vialume.functions.states import congestion_score, dominant_state, state_counts, threshold_class
from vialume.operators.history import newest_snapshots
from vialume.operators.ml import load_version, published_version, score
from vialume.operators.ordered import with_previous
from vialume.operators.windows import N_STATES, merged_columns, pane_seconds, sample_columns, window_columns
from vialume.sources.tables import batch_sink, is_new, live_sink, scan_live, write_alerts, write_windows

SAMPLE_SECONDS = 30
CHANGE_SECONDS = 5
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DELAY_SECONDS = 60
DELAY = f"{DELAY_SECONDS} seconds"


def with_event_time(df: DataFrame, ts: str = "ts", delay: str = DELAY) -> DataFrame:
    """Event time with a watermark; rows later than ``delay`` are dropped by stateful operators."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_window_stats(
    events: DataFrame,
    duration: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    delay: str = DELAY,
    ts: str = "ts",
) -> DataFrame:
    """Mean, maximum, samples and dominant state of the windows of a stream, in append mode.

    Panes are closed first, then combined, so that a row is counted once and not once per window.
    """
    pane = pane_seconds(duration, slide)
    panes = with_event_time(events, ts, delay).groupBy("camera_id", F.window(ts, f"{pane} seconds").alias("pane")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("vehicle_count").alias("total"),
        F.max("vehicle_count").alias("peak"),
        *[c.alias(name) for name, c in state_counts(F.col("estado")).items()],
    )
    timed = panes.withColumn("at", F.window_time("pane"))
    merged = timed.groupBy("camera_id", F.window("at", f"{duration} seconds", f"{slide} seconds").alias("w")).agg(
        F.sum("n").alias("n_samples"),
        F.sum("total").alias("total"),
        F.max("peak").alias("max_vehicles"),
        *[F.sum(name).alias(name) for name in N_STATES],
    )
    return merged.select(
        "camera_id",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        (F.col("total") / F.col("n_samples")).alias("avg_vehicles"),
        "max_vehicles",
        dominant_state({name: F.col(name) for name in N_STATES}).alias("estado_ventana"),
        "n_samples",
    )


def closed_windows(
    events: DataFrame,
    duration: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    delay: str = DELAY,
    order: Sequence[str] = ("ts", "event_id"),
    last_sample: Sequence[str] = (),
) -> DataFrame:
    """Full window rows of a stream, in append mode, each once when the watermark has passed its end.

    Spans of some seconds that tile a pane are closed first, then panes, if these are longer, then windows. Each holds sums and
    six samples, however many rows it has; a span is given what one camera sends in ``SAMPLE_SECONDS``
    at most. ``last_sample`` names columns of the newest row, carried in struct ``newest``.
    """
    pane = pane_seconds(duration, slide)
    span = max(s for s in range(1, SAMPLE_SECONDS + 1) if pane % s == 0)
    ts, tie = order
    extra = bool(last_sample)
    at = F.struct(epoch_us(ts).alias("us"), F.col(tie).cast("long").alias("tie"))
    sample = F.struct(at["us"].alias("us"), at["tie"].alias("tie"), "vehicle_count")
    spans = with_event_time(events, ts, delay).groupBy("camera_id", F.window(ts, f"{span} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("vehicle_count").alias("total"),
        F.max("vehicle_count").alias("peak"),
        *[c.alias(name) for name, c in state_counts(F.col("estado")).items()],
        *sample_columns(F.collect_list(sample), F.collect_list(sample)),
        *[F.max_by(F.struct(*last_sample), at).alias("newest"), F.max(at).alias("newest_at")] * extra,
    )

    def regrouped(parts: DataFrame, *widths: str) -> DataFrame:
        timed = parts.withColumn("at", F.window_time("w")).drop("w")
        return timed.groupBy("camera_id", F.window("at", *widths).alias("w")).agg(*merged_columns(extra))

    panes = spans if span == pane else regrouped(spans, f"{pane} seconds")
    merged = regrouped(panes, f"{duration} seconds", f"{slide} seconds")
    named = merged.withColumnsRenamed({"n": "n_samples", "peak": "max_vehicles"})
    return named.select(
        "camera_id",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *window_columns(),
        *["newest"] * extra,
    )


def stream_windows(
    events: DataFrame,
    out: str,
    checkpoint: str,
    duration: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    delay_seconds: int = DELAY_SECONDS,
    order: Sequence[str] = ("ts", "event_id"),
    last_sample: Sequence[str] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Store the rows of :func:`closed_windows`. ``finish`` may change them before they are stored.

    :func:`late_rows` tells how many rows came too late.
    """
    closed = closed_windows(events, duration, slide, f"{delay_seconds} seconds", order, last_sample)
    store = write_windows(out)

    def run(batch: DataFrame, batch_id: int) -> None:
        store(finish(batch) if finish else batch, batch_id)

    return start_stream(closed, run, f"{checkpoint}/query", every)


def with_arrival(events: DataFrame, name: str = "arrival") -> DataFrame:
    """A stream with the time of arrival of each row.

    Spark fixes the time of a micro-batch in the checkpoint before it runs, so a batch that is run again has the same stamps.
    """
    return events.withColumn(name, F.current_timestamp())


def stream_windows_on_arrival(
    events: DataFrame,
    out: str,
    checkpoint: str,
    duration: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    arrival: str | None = None,
    tie: str = "event_id",
    every: str | None = None,
) -> StreamingQuery:
    """Windows by the time of arrival: ``arrival`` names a column of stamps, else rows are stamped as they come in.

    Rows cannot be late on this clock, so windows close as soon as a later row has arrived.
    """
    stamped = events if arrival else with_arrival(events)
    return stream_windows(stamped, out, checkpoint, duration, slide, 0, (arrival or "arrival", tie), every=every)


def with_end(events: DataFrame, folder: str) -> DataFrame:
    """A stream that :func:`end_feed` can end, so that its last windows close too.

    The mark is a row without any value but a time after all others. It opens groups of its own, which never close.
    """
    spark = events.sparkSession
    spark.createDataFrame([], events.schema).write.mode("append").parquet(folder)
    return events.unionByName(spark.readStream.schema(events.schema).parquet(folder))


def end_feed(events: DataFrame, folder: str, ts: str = "ts", at: str = "9999-01-01") -> None:
    """Mark a feed as ended: the next micro-batch moves the watermark behind all windows. Later rows are late."""
    kind = events.schema[ts].dataType
    row = [F.lit(at).cast(kind).alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema]
    events.sparkSession.range(1).select(*row).write.mode("append").parquet(folder)


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int | None:
    """The watermark, in milliseconds, that Spark fixed for a micro-batch in its checkpoint before running it; none before the first row."""
    lines = spark.read.text(f"{checkpoint}/offsets/{batch_id}").where(F.col("value").contains("batchWatermarkMs"))
    ms = lines.select(F.get_json_object("value", "$.batchWatermarkMs").cast("long")).first()[0]
    return ms or None


def split_late(
    events: DataFrame,
    out: str,
    checkpoint: str,
    delay_seconds: int = DELAY_SECONDS,
    ts: str = "ts",
    every: str | None = None,
) -> StreamingQuery:
    """Store every row of a stream with the column ``late``: whether it lay behind the watermark of its micro-batch.

    Nothing is dropped: rows in time and late rows together are the input, once each, also after a restart. Rows without a time are
    not late.
    """
    marked = events.withColumn("__at", F.col(ts).cast("timestamp")).withWatermark("__at", f"{delay_seconds} seconds")
    store = batch_sink(out, ts)

    def run(batch: DataFrame, batch_id: int) -> None:
        ms = batch_watermark(batch.sparkSession, f"{checkpoint}/query", batch_id)
        late = F.lit(False) if ms is None else F.coalesce(epoch_us("__at") < ms * 1000, F.lit(False))
        store(batch.withColumn("late", late).drop("__at"), batch_id)

    return start_stream(marked, run, f"{checkpoint}/query", every)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query left out as too late, over the progress it still remembers.

    Spark counts after a partial aggregation: rows of one camera and span count once.
    """
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def score_last(windows: DataFrame, model: PipelineModel | None, count: str = "vehicle_count") -> DataFrame:
    """Add ``estado_modelo``: the model's state for the newest sample of each window.

    ``windows`` carries the samples in ``newest``. ``estado_predicho`` stays the dominant state.
    """
    columns = [c for c in windows.columns if c != "newest"]
    scored = score(windows.select(*columns, "newest.*"), model, count=count)
    return scored.select(*columns, F.col("estado").alias("estado_modelo"))


def versioned_scorer(root: str, count: str = "vehicle_count") -> Callable[[DataFrame], DataFrame]:
    """A ``finish`` function for :func:`stream_windows`: :func:`score_last` with the published model, and its ``modelo_version``.

    The version is read for every micro-batch, so a model published meanwhile answers from the next one on without a restart.
    """
    held: dict[int, PipelineModel] = {}

    def finish(rows: DataFrame) -> DataFrame:
        version = published_version(rows.sparkSession, root)
        if version not in held:
            held.clear()
            held[version] = load_version(root, version)
        return score_last(rows, held[version], count).withColumn("modelo_version", F.lit(version))

    return finish


def classify_events(counts: DataFrame, ts: str = "ts", tz: str | None = None) -> DataFrame:
    """Detections of raw counts: calendar, hour features, state, confidence and method.

    Row by row, so it serves batches and streams alike.
    """
    dated = with_calendar(counts, ts, tz)
    classed = dated.withColumns({
        "congestion_hour_score": congestion_score(F.col("hour")),
        "is_peak_hour": is_peak_hour(F.col("hour")),
        "__class": threshold_class(F.col("vehicle_count")),
    })
    return classed.select(*[c for c in classed.columns if c != "__class"], "__class.*")


def start_stream(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = f"{SLIDE_SECONDS} seconds",
    mode: str = "append",
) -> StreamingQuery:
    """Run ``sink`` on every micro-batch, each ``every``; ``None`` takes what is there and stops."""
    writer = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.outputMode(mode).trigger(**trigger).start()


def start_keyed_stream(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, every: str | None) -> StreamingQuery:
    """As :func:`start_stream`, for streams whose state holds whole rows: it lies in RocksDB, outside the heap.

    A query keeps the store it was started with, so the session gets its own setting back at once.
    """
    conf = df.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKSDB)
    try:
        return start_stream(df, sink, checkpoint, every)
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)


def classify_stream(counts: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Classify a stream of counts and store the detections."""
    return start_stream(classify_events(counts), batch_sink(path, "ts"), checkpoint, every)


def stream_latest_status(
    detections: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("camera_id",),
    order: Sequence[str] = ("ts", "event_id"),
    every: str | None = None,
) -> StreamingQuery:
    """Keep the newest snapshot of each camera in a table; :func:`vialume.operators.history.status_rows` reads it as a status.

    Spark's state and the table hold one row for each camera. A batch hands on only the cameras it changes.
    """
    newest = newest_snapshots(detections, keys, order)
    return start_stream(newest, live_sink(path, keys), checkpoint, every, "update")


def span_edges(
    df: DataFrame, mark: Column, keys: Sequence[str], order: Sequence[str], delay: str = DELAY, seconds: int = CHANGE_SECONDS
) -> DataFrame:
    """First and last row of each key and span of ``seconds``, and the rows between whose text ``mark`` differs from that of the row before.

    In append mode: rows leave when the watermark passes the end of their span; they may arrive in any order until then. A span
    holds what one key sends in that time. ``__at`` is the place of a row in its key, ``__mark`` its mark.
    """
    ts, tie = order
    timed = with_event_time(df, ts, delay)
    item = F.struct(
        epoch_us(ts).alias("us"), F.coalesce(F.col(tie).cast("long"), F.lit(0)).alias("tie"), mark.alias("mark"), F.struct(*df.columns).alias("row"))
    spans = timed.groupBy(*keys, F.window(ts, f"{seconds} seconds").alias("span")).agg(F.array_sort(F.collect_list(item)).alias("s"))
    s = F.col("s")
    kept = F.filter(s, lambda x, i: (i == 0) | (i == F.size(s) - 1) | ~x["mark"].eqNullSafe(F.get(s, i - 1)["mark"]))
    edges = spans.select(F.posexplode(kept).alias("pos", "e"))
    at = F.struct(F.col("e.us").alias("us"), F.col("e.tie").alias("tie"), "pos")
    return edges.select("e.row.*", at.alias("__at"), F.col("e.mark").alias("__mark"))


def stream_changes(
    df: DataFrame,
    mark: Column,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    every: str | None = None,
    delay: str = DELAY,
    seconds: int = CHANGE_SECONDS,
) -> StreamingQuery:
    """Hand ``sink`` the rows whose text ``mark`` differs from that of the row before with the same key, also in an earlier micro-batch.

    The first row of a key is among them, with ``opens`` true. The last row of each key is kept in a small table beside the checkpoint
    and taken as the row before a micro-batch; it is replaced after the sink has committed, so a batch that is run again finds the same one.
    Within a batch rows are compared by key and slice of time, so no task holds a whole key.
    """
    edges = span_edges(df, mark, keys, order, delay, seconds)
    names, last = list(df.columns), f"{checkpoint}/last"
    keep = live_sink(last, keys, "__at")

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = batch.withColumn("__known", F.lit(False))
            if not is_new(batch.sparkSession, last):
                rows = rows.unionByName(scan_live(batch.sparkSession, last).withColumn("__known", F.lit(True)), allowMissingColumns=True)
            changed = with_previous(
                rows, keys, [order[0], "__at"], "__mark", "__before", only=lambda b: b.isNull() | ~b["v"].eqNullSafe(F.col("__mark")))
            sink(changed.filter(~F.col("__known")).select(*names, F.col("__before").isNull().alias("opens")), batch_id)
            keep(batch.select(*dict.fromkeys([*keys, order[0]]), "__at", "__mark"), batch_id)
        finally:
            batch.unpersist()

    return start_keyed_stream(edges, run, f"{checkpoint}/query", every)


def _in_collapse() -> Column:
    return F.coalesce(F.col("estado") == COLAPSO, F.lit(False))


def stream_collapse_starts(
    detections: DataFrame,
    out: str,
    checkpoint: str,
    keys: Sequence[str] = ("camera_id",),
    order: Sequence[str] = ("ts", "event_id"),
    every: str | None = None,
    delay: str = DELAY,
) -> StreamingQuery:
    """Store the rows that start a collapse, also when the row before came in an earlier batch."""
    store = batch_sink(out, order[0])

    def sink(changes: DataFrame, batch_id: int) -> None:
        store(changes.filter(_in_collapse()).drop("opens"), batch_id)

    return stream_changes(detections, _in_collapse().cast("string"), sink, checkpoint, keys, order, every, delay)


def stream_alerts(
    detections: DataFrame,
    out: str,
    checkpoint: str,
    keys: Sequence[str] = ("camera_id",),
    order: Sequence[str] = ("ts", "event_id"),
    every: str | None = None,
    delay: str = DELAY,
) -> StreamingQuery:
    """Store an alert row for each start and each end of a collapse.

    The length of an episode is found from the stored rows: :func:`vialume.operators.alerts.alert_lengths`.
    """
    store = write_alerts(out)

    def sink(changes: DataFrame, batch_id: int) -> None:
        rows = changes.filter(_in_collapse() | ~F.col("opens")).select(
            *keys,
            F.col(order[0]).alias("ts"),
            F.when(_in_collapse(), COLAPSO_INICIO).otherwise(COLAPSO_FIN).alias("tipo"),
            F.lit(None).cast("int").alias("duracion_min"),
            F.lit(False).alias("notificado"),
        )
        store(rows, batch_id)

    return stream_changes(detections, _in_collapse().cast("string"), sink, checkpoint, keys, order, every, delay)


def stream_drop_unchanged(
    frames: DataFrame,
    out: str,
    checkpoint: str,
    keys: Sequence[str] = ("camera_id",),
    order: Sequence[str] = ("ts", "frame_id"),
    md5: str = "md5",
    every: str | None = None,
    delay: str = DELAY,
) -> StreamingQuery:
    """Store the frames that differ from the one before, across batches."""
    store = batch_sink(out, order[0])

    def sink(changes: DataFrame, batch_id: int) -> None:
        store(changes.drop("opens"), batch_id)

    return stream_changes(frames, F.col(md5), sink, checkpoint, keys, order, every, delay)
