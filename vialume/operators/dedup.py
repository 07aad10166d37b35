"""Unchanged and repeated frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vialume.operators.ordered import SLICE_SECONDS, with_previous

COPY_SALTS = 64


def with_md5(frames: DataFrame, content: str = "content", out: str = "md5") -> DataFrame:
    """Add the hash of the content and drop the content, so that no shuffle carries bytes."""
    return frames.withColumn(out, F.md5(content)).drop(content)


def store_md5(frames: DataFrame, path: str, content: str = "content") -> DataFrame:
    """Hashes of all frames as a stored table, so that later steps never read the contents again."""
    with_md5(frames, content).write.parquet(path)
    return frames.sparkSession.read.parquet(path)


def drop_unchanged(
    frames: DataFrame,
    keys: Sequence[str] = ("camera_id",),
    order: Sequence[str] = ("ts", "frame_id"),
    md5: str = "md5",
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Drop a frame whose hash equals that of the frame just before it on the same camera."""
    def changed(before):
        return before.isNull() | ~before["v"].eqNullSafe(F.col(md5))

    return with_previous(frames, keys, order, md5, "__before", seconds, only=changed).select(*frames.columns)


def dedup_content(frames: DataFrame, day: str = "fecha", md5: str = "md5", name: str = "filename",
                  salts: int = COPY_SALTS) -> DataFrame:
    """Mark copies within a day: ``kept_name`` is the first name with the content.

    ``is_duplicate`` is false for the kept frame. One content may be copied into a third of all
    rows, so the first name is found per salted part of a group, then over the parts (``salts``
    rows per group at most), and is brought back to the rows by the salted key. A frame without a
    hash is a copy of nothing.
    """
    salted = frames.withColumn("__salt", F.pmod(F.xxhash64(name), F.lit(salts)))
    part = [day, md5, "__salt"]
    firsts = salted.groupBy(*part).agg(F.min(name).alias("__first"))
    overall = F.min("__first").over(Window.partitionBy(day, md5))
    kept = firsts.select(*part, overall.alias("kept_name"))
    marked = salted.join(kept, part, "left").withColumn("kept_name", F.coalesce("kept_name", name))
    return marked.drop("__salt").withColumn("is_duplicate", F.col(name) != F.col("kept_name"))


def unique_frames(frames: DataFrame, day: str = "fecha", md5: str = "md5", name: str = "filename") -> DataFrame:
    """The first frame by name of each content and day; rows combine before the shuffle."""
    rest = [c for c in frames.columns if c not in (day, md5)]
    first = frames.groupBy(day, md5).agg(F.min_by(F.struct(*rest), name).alias("f"))
    return first.select(*[F.col(f"f.{c}").alias(c) if c in rest else F.col(c) for c in frames.columns])


def dedup_report(frames: DataFrame, day: str = "fecha", md5: str = "md5") -> DataFrame:
    """Contents and surplus copies of each day."""
    contents = frames.groupBy(day, md5).agg(F.count(F.lit(1)).alias("n"))
    return contents.groupBy(day).agg(
        F.count(F.lit(1)).alias("n_unique"), (F.sum("n") - F.count(F.lit(1))).alias("n_duplicates")
    )
