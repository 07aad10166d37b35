"""Detection events: newline JSON, read as a stream, checked and typed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.config import STATES

# The fields of a message.
EVENT_SCHEMA = (
    "camera_id bigint, event_id bigint, timestamp string, vehicle_count int, estado string, "
    "hour int, weekday int, is_rush_hour int"
)
REQUIRED = ("timestamp", "vehicle_count", "estado")
_BAD = "_corrupt"
DEFAULT_CAMERA = 0


def read_event_stream(
    spark: SparkSession, path: str, max_files: int | None = None, fmt: str = "text", **options: str
) -> DataFrame:
    """Lines of JSON as a stream with one column ``value``.

    ``text`` follows a folder of files, which can be replayed. Another format, such as ``kafka``
    or ``socket`` with its options, gives the same column.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "text":
        return reader.load().select(F.col("value").cast("string"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("value")


def _typed(lines: DataFrame, schema: str, camera: int) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = F.from_json("value", f"{schema}, {_BAD} string", options)
    typed = lines.select("value", parsed.alias("e")).select("value", "e.*")
    defaults = {"camera_id": F.lit(camera).cast("long"), "event_id": F.xxhash64("value")}
    typed = typed.withColumns({c: F.coalesce(c, default) for c, default in defaults.items() if c in typed.columns})
    return typed.withColumn("ts", F.try_to_timestamp("timestamp"))


def parse_events(lines: DataFrame, schema: str = EVENT_SCHEMA, camera: int = DEFAULT_CAMERA) -> DataFrame:
    """Typed events of the well-formed lines; malformed lines are dropped.

    A message without a camera comes from ``camera``. One without a number gets a hash of its line,
    so that a repeated line has the same number.
    """
    well_formed = F.col(_BAD).isNull() & F.coalesce(*[F.col(c).cast("string") for c in REQUIRED]).isNotNull()
    return _typed(lines, schema, camera).filter(well_formed).drop("value", _BAD)


def split_invalid(
    lines: DataFrame, schema: str = EVENT_SCHEMA, camera: int = DEFAULT_CAMERA
) -> tuple[DataFrame, DataFrame]:
    """(usable events, rejected lines): malformed lines and lines without a required field are
    set aside with the reason instead of failing the job. Defaults as in :func:`parse_events`."""
    typed = _typed(lines, schema, camera)
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in ("ts", *REQUIRED[1:])]))
    reason = (
        F.when(F.col(_BAD).isNotNull(), "malformed")
        .when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ",")))
        .when(~F.col("estado").isin(*STATES), "unknown state")
    )
    judged = typed.withColumn("reason", reason)
    ok = judged.filter(F.col("reason").isNull()).drop("value", _BAD, "reason")
    return ok, judged.filter(F.col("reason").isNotNull()).select("value", "reason")
