"""Greedy non-maximum suppression per frame and class.

Rounds run over all groups at once: the best ``BLOCK`` undecided boxes of each group are picked before the
shuffle (a group limit, so a crowded frame sends that many from each task) and folded in order of priority.
Only groups that filled their block can have more boxes. Of these, every box behind the block is dropped, on all
executors, when a kept box covers it; of exact copies that are left only the best can survive. The rounds end
when no group fills its block, after the first one in normal frames, and the result is that of one long fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialume.config import NMS_IOU
from vialume.functions.geometry import iou, rect
from vialume.session import ensure_checkpoint_dir

BLOCK = 1000  # window group limits are pushed below the shuffle up to this rank
BROADCAST_GROUPS = 2000  # at the corners of BLOCK kept boxes each, some 100 MB at the very most
SPREAD = 256

_KEEP = "__kept"


def _covers(threshold: float, variant: str):
    return lambda kept, box: iou(rect(kept), rect(box), variant) > threshold


def _rank(conf: str) -> Column:
    """Highest confidence first, boxes without one last."""
    return F.coalesce(-F.col(conf).cast("double"), F.lit(float("inf")))


def _fold(group, threshold: float, variant: str, item: Column, kind: str, *more: Column) -> DataFrame:
    """Kept boxes of each group, as an array in order of priority, and ``more`` aggregates."""
    covers = _covers(threshold, variant)

    def step(kept: Column, box: Column) -> Column:
        return F.when(F.exists(kept, lambda k: covers(k, box)), kept).otherwise(F.array_append(kept, box))

    ranked = F.array_sort(F.collect_list(item))
    return group.agg(F.aggregate(ranked, F.array().cast(f"array<{kind}>"), step).alias(_KEEP), *more)


def nms(
    boxes: DataFrame,
    threshold: float = NMS_IOU,
    variant: str = "live",
    keys: Sequence[str] = ("frame_id", "cls"),
    conf: str = "conf",
    tie: str = "box_id",
    block: int = BLOCK,
) -> DataFrame:
    """Boxes that survive: in falling confidence, drop a box that overlaps a kept one too much.

    Equal confidence is settled by the lower ``tie``, which is unique within a group; boxes without one come last.
    """
    keys = list(keys)
    ensure_checkpoint_dir(boxes.sparkSession)
    covers = _covers(threshold, variant)
    priority = Window.partitionBy(*keys).orderBy(_rank(conf), F.asc(tie))
    at = F.struct(_rank(conf).alias("p"), F.col(tie).alias("t"))
    item, kind, rest = _item(boxes, keys, conf, tie)
    left, kept = boxes, []
    while True:
        best = left.withColumn("__r", F.row_number().over(priority)).filter(F.col("__r") <= block).drop("__r")
        step = _fold(best.groupBy(*keys), threshold, variant, item, kind, F.max(at).alias("__end"), F.count(F.lit(1)).alias("__n")).checkpoint()
        kept.append(step.select(*keys, F.explode(_KEEP).alias("b")))
        more = step.filter(F.col("__n") == block)  # only these groups can have boxes beyond the block
        if more.isEmpty():
            break
        left = _undecided(left, more, covers, keys, tie, at)
        left = (_without_copies(left, covers, keys, conf, tie) if len(kept) == 1 else left).checkpoint()
    flat = reduce(DataFrame.unionByName, kept)
    return flat.select(*[F.col(c) if c in keys else F.col(f"b.{c}") for c in boxes.columns])


def _undecided(left: DataFrame, step: DataFrame, covers, keys: list[str], tie: str, at: Column) -> DataFrame:
    """Boxes behind the block of their group that no kept box covers."""
    corners = F.transform(_KEEP, lambda k: F.struct(*[k[c].alias(c) for c in ("x1", "y1", "x2", "y2")])).alias(_KEEP)
    free = ~F.coalesce(F.exists(_KEEP, lambda k: covers(k, F.struct("x1", "y1", "x2", "y2"))), F.lit(False))
    met = _meet(left, step.select(*keys, corners, "__end"), keys, tie, "inner")
    return met.filter((at > F.col("__end")) & free).select(*left.columns)


def _item(df: DataFrame, keys: list[str], conf: str, tie: str) -> tuple[Column, str, list[str]]:
    """The struct that sorts by priority, its type, and the columns to bring back."""
    rest = [c for c in df.columns if c not in keys]
    item = F.struct(_rank(conf).alias("__p"), F.col(tie).alias("__t"), *rest)
    kind = df.select(item.alias("i")).schema["i"].dataType.simpleString()
    return item, kind, rest


def _without_copies(df: DataFrame, covers, keys: list[str], conf: str, tie: str) -> DataFrame:
    """Best of the boxes with equal corners. A box that does not even cover itself drops no copy."""
    box = F.struct("x1", "y1", "x2", "y2")
    flat = F.when(~F.coalesce(covers(box, box), F.lit(False)), F.col(tie))
    corners = ["x1", "y1", "x2", "y2"]
    rest = [c for c in df.columns if c not in (*keys, *corners)]
    best = df.groupBy(*keys, *corners, flat.alias("__flat")).agg(
        F.min_by(F.struct(*rest), F.struct(_rank(conf).alias("p"), F.col(tie))).alias("b")
    )
    return best.select(*[F.col(f"b.{c}") if c in rest else F.col(c) for c in df.columns])


def _meet(rows: DataFrame, groups: DataFrame, keys: list[str], tie: str, how: str) -> DataFrame:
    """Join rows with stored group rows: a broadcast while the groups are few, else a join on a
    salted key, so that the rows of one group meet in many tasks."""
    groups = groups.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])  # null is a group too
    if groups.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), same, how)
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(tie), F.lit(SPREAD)))
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))
    salts = groups.withColumn("__other", F.explode(salts))
    return salted.join(salts, same & (F.col("__salt") == F.col("__other")), how).drop("__salt", "__other")
