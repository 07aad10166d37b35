"""Detection, window and alert tables in Parquet, partitioned by day."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vialume.config import Zone, ZONES
from vialume.operators.history import as_day, same_type
from vialume.session import remove_path

_DAY = "stored_day"
_MANIFEST = "query string, batch long, folder string, dated boolean, days array<string>, fields string, replaces array<string>"


def write_detections(df: DataFrame, path: str, ts: str = "ts", mode: str = "append") -> None:
    """Append detections, partitioned by day. The rebalance lets adaptive execution split a full
    day over several files and merge small ones."""
    dated = df.withColumn("fecha", F.to_date(ts)).hint("rebalance", "fecha")
    dated.write.partitionBy("fecha").mode(mode).parquet(path)


def scan_detections(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    desde: dt.date | str | None = None,
    hasta: dt.date | str | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Detections of a span of days; the span prunes day partitions and reaches the row groups."""
    df = spark.read.parquet(path)
    if desde is not None:
        first = as_day(desde)
        df = df.filter((F.col("fecha") >= F.lit(first.date())) & (F.col(ts) >= same_type(df, ts, first)))
    if hasta is not None:
        end = as_day(hasta) + dt.timedelta(days=1)
        df = df.filter((F.col("fecha") < F.lit(end.date())) & (F.col(ts) < same_type(df, ts, end)))
    return df.select(*columns) if columns else df.drop("fecha")


def batch_sink(path: str, ts: str | None = None, query: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores each micro-batch once, partitioned by the day of ``ts`` if given.

    A batch is first written to a folder of its own under ``data`` and then committed by one line in ``manifest`` under the
    id of its query and its number. Readers follow the manifest. What a failed attempt left is never read, and a batch
    that is committed is not written again. So several queries, or one with a new checkpoint, may share a path.
    ``query`` names the writer outside of streams; a stream is known by its own id.
    """
    checked: set[str] = set()

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = query or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        line = f"{path}/manifest/query={writer}/batch={batch_id}"
        if writer not in checked and _committed(spark, line):
            return  # only the first batch after a start can be one that was committed before
        checked.add(writer)
        folder = f"{writer}-{batch_id}-{uuid.uuid4().hex}"
        out = f"{path}/data/folder={folder}"
        if ts is None:
            batch.write.parquet(out)
            days = []
        else:
            batch.withColumn(_DAY, F.to_date(ts)).write.partitionBy(_DAY).parquet(out)
            files = spark.read.schema(batch.schema).parquet(out).inputFiles()  # of one micro-batch
            days = sorted({found[1] for f in files if (found := re.search(rf"/{_DAY}=([^/]+)/", f))})
        row = [(folder, ts is not None, days, batch.schema.json())]
        spark.createDataFrame(row, "folder string, dated boolean, days array<string>, fields string").coalesce(1).write.mode("overwrite").json(line)

    return write


def _committed(spark: SparkSession, line: str) -> bool:
    try:
        return not spark.read.schema("folder string").json(line).isEmpty()
    except AnalysisException:  # no such folder
        return False


def write_windows(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for closed windows, by the day of their end."""
    return batch_sink(path, "window_end")


def write_alerts(path: str, ts: str = "ts") -> Callable[[DataFrame, int], None]:
    """Sink for alert rows, by day."""
    return batch_sink(path, ts)


def _committed_days(spark: SparkSession, path: str, desde: dt.date | None, hasta: dt.date | None) -> tuple[StructType, DataFrame]:
    """The columns of the table, and a row (folder, day) for each committed part that no compaction replaces; day is null without days."""
    manifest = spark.read.schema(_MANIFEST).json(f"{path}/manifest")
    fields = manifest.agg(F.max_by("fields", "batch")).first()[0]
    if fields is None:
        raise ValueError(f"no committed batch under {path}")
    rows = manifest.select("folder", "dated", F.explode_outer(F.when(F.col("dated"), F.col("days"))).alias("day"))
    rows = rows.where(~F.col("dated") | F.col("day").isNotNull())
    if desde is not None:
        rows = rows.where(~F.col("dated") | (F.col("day") >= str(desde)))
    if hasta is not None:
        rows = rows.where(~F.col("dated") | (F.col("day") <= str(hasta)))
    gone = manifest.select(F.explode("replaces").alias("folder"), "days").select("folder", F.explode("days").alias("day"))
    return StructType.fromJson(json.loads(fields)), rows.select("folder", "day").join(gone, ["folder", "day"], "left_anti")


def _part(path: str, folder: str, day: str | None) -> str:
    return f"{path}/data/folder={folder}" + (f"/{_DAY}={day}" if day else "")


def scan_batches(spark: SparkSession, path: str, desde: dt.date | None = None, hasta: dt.date | None = None) -> DataFrame:
    """All rows that :func:`batch_sink` committed, or those of a span of days; only folders of these days are opened."""
    schema, rows = _committed_days(spark, path, desde, hasta)
    parts = [_part(path, *r) for r in rows.toLocalIterator()]  # one short line for each batch and day
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*parts).select(*schema.names)


def compact_batches(spark: SparkSession, path: str, hasta: dt.date) -> int:
    """Put the many small files of all days up to ``hasta`` into few large ones; returns the number of folders that were replaced.

    The rows are written beside the old files and take over by one line of the manifest, so readers see all rows once at any time.
    The replaced files stay for readers that have begun; run it when no stream writes to these days any more.
    """
    schema, rows = _committed_days(spark, path, None, hasta)
    small = rows.where("day IS NOT NULL").groupBy("day").agg(F.collect_set("folder").alias("folders")).where(F.size("folders") > 1).collect()
    if not small:
        return 0
    days, old = sorted(r["day"] for r in small), sorted({f for r in small for f in r["folders"]})
    folder = f"compacted-{uuid.uuid4().hex}"
    parts = None
    for r in small:  # a day is a plan of its own, so that its name does not have to be found again in the rows
        part = spark.read.schema(schema).parquet(*[_part(path, f, r["day"]) for f in r["folders"]]).withColumn(_DAY, F.lit(r["day"]))
        parts = part if parts is None else parts.unionByName(part)
    parts.hint("rebalance", _DAY).write.partitionBy(_DAY).parquet(f"{path}/data/folder={folder}")
    line = [(folder, True, days, schema.json(), old)]
    kinds = "folder string, dated boolean, days array<string>, fields string, replaces array<string>"
    spark.createDataFrame(line, kinds).coalesce(1).write.json(f"{path}/manifest/query={folder}/batch=-1")
    return len(old)


def scan_windows(spark: SparkSession, path: str, since: dt.datetime | None = None) -> DataFrame:
    """Window rows, all or from a moment on."""
    if since is None:
        return scan_batches(spark, path)
    df = scan_batches(spark, path, since.date())
    return df.filter(F.col("window_end") >= same_type(df, "window_end", since))


_POINTER = "seq long, writer string, batch long, folder string"


def live_sink(path: str, keys: Sequence[str], newer: str = "at", query: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps one row for each key: rows of a batch replace older ones by ``newer``.

    The table is written anew beside the old one and then taken over by a line that names it, so a reader sees the state
    after one batch or after the next. A batch that was taken over is not applied again. The last two states are kept.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = query or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        known = _pointers(spark, path)
        if any((r["writer"], r["batch"]) == (writer, batch_id) for r in known):
            return
        rows = batch if not known else batch.unionByName(spark.read.parquet(f"{path}/{known[-1]['folder']}"))
        others = [c for c in batch.columns if c not in (*keys, newer)]
        best = rows.groupBy(*keys).agg(F.max_by(F.struct(newer, *others), newer).alias("r")).select(*keys, "r.*")
        folder = f"state/{uuid.uuid4().hex}"
        best.select(*batch.columns).write.parquet(f"{path}/{folder}")
        seq = known[-1]["seq"] + 1 if known else 0
        line = spark.createDataFrame([(seq, writer, batch_id, folder)], _POINTER).coalesce(1)
        line.write.mode("overwrite").json(f"{path}/pointer/n={seq}")
        for old in known[:-1]:
            remove_path(spark, f"{path}/{old['folder']}")
            if old["writer"] != writer or old["batch"] < batch_id - 1:
                remove_path(spark, f"{path}/pointer/n={old['seq']}")

    return write


def _pointers(spark: SparkSession, path: str) -> list[Row]:
    try:
        return spark.read.schema(_POINTER).json(f"{path}/pointer").orderBy("seq").collect()  # a few lines
    except AnalysisException:  # no such folder
        return []


def is_new(spark: SparkSession, path: str) -> bool:
    """Whether :func:`live_sink` has taken over no state under ``path`` yet."""
    return not _pointers(spark, path)


def scan_live(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest state that :func:`live_sink` took over."""
    return spark.read.parquet(f"{path}/{_pointers(spark, path)[-1]['folder']}")


def zones_df(spark: SparkSession, zones: Sequence[Zone] = ZONES) -> DataFrame:
    """The zones as a table of a few rows."""
    return spark.createDataFrame(list(zones), "ord int, zone string, x1 int, y1 int, x2 int, y2 int")
