"""Queries over boxes, zones, polygons and frame geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialume.config import MASK_POLYGON, ZONES
from vialume.functions.geometry import adapt_polygon, adapt_zone, letterbox_params, overlap_ratio, rect, zone_rect
from vialume.operators import boxes as ops
from vialume.operators.imaging import add_new_features, features_of, pixel_zone_stats, spread_pictures, zone_image_features
from vialume.operators.nms import nms
from vialume.plans.registry import query
from vialume.plans.standins import (
    BOXES, CENTER_IN, CROWDED, DENSE, EDGES_SQL, RATIO, ZONES_SQL, box_frames, boxes, crowded_boxes, dense_boxes, frames, table,
)
from vialume.session import scratch_path
from vialume.sources.tables import zones_df

VEHICLE = "cls IN (2, 3, 5, 7)"
NAMES = [z.name for z in ZONES]


# ---- filters

@query("B6", f"WITH {BOXES} SELECT frame_id, box_id, cls FROM boxes WHERE {VEHICLE}")
def vehicles_only(spark, sf_dir):
    return ops.vehicles_only(boxes(spark, sf_dir)).select("frame_id", "box_id", "cls")


@query("B7", f"WITH {BOXES} SELECT frame_id, box_id, conf FROM boxes WHERE conf >= 0.20::DOUBLE")
def min_conf(spark, sf_dir):
    return ops.min_conf(boxes(spark, sf_dir)).select("frame_id", "box_id", "conf")


INSIDE = """(SELECT count(*) FROM edges WHERE ay <> ey AND cy >= least(ay, ey) AND cy < greatest(ay, ey)
  AND cx < CAST(ex - ax AS DOUBLE) * (cy - ay) / CAST(ey - ay AS DOUBLE) + ax) % 2 = 1"""


@query("C11", f"""WITH {BOXES}, {EDGES_SQL}, c AS (SELECT *, CAST(x1 + x2 AS DOUBLE) / 2 AS cx, CAST(y1 + y2 AS DOUBLE) / 2 AS cy FROM boxes),
  p AS (SELECT DISTINCT cx, cy FROM c), i AS (SELECT cx, cy, {INSIDE} AS inside FROM p)
  SELECT frame_id, box_id FROM c JOIN i USING (cx, cy) WHERE inside""")
def boxes_in_mask(spark, sf_dir):
    return ops.in_mask(boxes(spark, sf_dir)).select("frame_id", "box_id")


# ---- geometry

FRAME_SIZES = """siz AS (SELECT doc_id, w, h, least(640::DOUBLE / w, 480::DOUBLE / h) AS scale
  FROM (SELECT doc_id, CAST(320 + n_chars % 1600 AS INTEGER) AS w, CAST(240 + doc_id % 900 AS INTEGER) AS h FROM documents)),
box AS (SELECT *, CAST(floor(w * scale) AS INTEGER) AS new_w, CAST(floor(h * scale) AS INTEGER) AS new_h FROM siz),
lbx AS (SELECT *, (640 - new_w) // 2 AS pad_x, (480 - new_h) // 2 AS pad_y FROM box)"""


def _letterboxed(spark, sf_dir):
    sizes = table(spark, sf_dir, "documents").select(
        "doc_id", (F.lit(320) + F.col("n_chars") % 1600).cast("int").alias("w"), (F.lit(240) + F.col("doc_id") % 900).cast("int").alias("h")
    )
    return sizes.select("doc_id", letterbox_params(F.col("w"), F.col("h")).alias("lb"))


@query("B14", f"WITH {FRAME_SIZES} SELECT doc_id, w, h, scale, new_w, new_h, CAST(pad_x AS INTEGER) AS pad_x, CAST(pad_y AS INTEGER) AS pad_y FROM lbx")
def letterbox(spark, sf_dir):
    return _letterboxed(spark, sf_dir).select("doc_id", "lb.*")


def _fit(value: str, axis: str) -> str:
    side, target = ("w", 640) if axis == "x" else ("h", 480)
    return f"CAST(trunc({value} * ({side} / {target}::DOUBLE) * scale + pad_{axis}) AS INTEGER)"


@query("B15", f"""WITH {FRAME_SIZES}, {ZONES_SQL} SELECT doc_id, zone, greatest(0, {_fit('zx1', 'x')}) AS x1, greatest(0, {_fit('zy1', 'y')}) AS y1,
  least(639, {_fit('zx2', 'x')}) AS x2, least(479, {_fit('zy2', 'y')}) AS y2 FROM lbx, zones""")
def adapted_zones(spark, sf_dir):
    fitted = F.array(*[
        F.struct(F.lit(z.name).alias("zone"), *[c.alias(n) for n, c in adapt_zone(z, F.col("lb"))._asdict().items()])
        for z in ZONES
    ])
    return _letterboxed(spark, sf_dir).select("doc_id", F.inline(fitted))


def _corner(value: str, axis: str) -> str:
    side, target = ("w", 640) if axis == "x" else ("h", 480)
    placed = f"CAST({value} AS FLOAT) * CAST({side} / {target}::DOUBLE AS FLOAT) * CAST(scale AS FLOAT) + CAST(pad_{axis} AS FLOAT)"
    return f"CAST(trunc(least(greatest({placed}, 0::FLOAT), {target - 1}::FLOAT)) AS INTEGER)"


_POINTS = "pts(corner, px, py) AS (VALUES " + ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(MASK_POLYGON)) + ")"


@query("B15 M11", f"WITH {FRAME_SIZES}, {_POINTS} SELECT doc_id, corner, {_corner('px', 'x')} AS x, {_corner('py', 'y')} AS y FROM lbx, pts")
def adapted_polygon(spark, sf_dir):
    corners = _letterboxed(spark, sf_dir).select("doc_id", F.posexplode(adapt_polygon(F.col("lb"))).alias("corner", "p"))
    return corners.select("doc_id", "corner", "p.x", "p.y")


# ---- zones

@query("A12 D9", f"WITH {BOXES}, {ZONES_SQL} SELECT ord, zone, count(frame_id) AS n_boxes FROM zones LEFT JOIN boxes ON {CENTER_IN} GROUP BY ord, zone")
def zone_table_counts(spark, sf_dir):
    """Boxes of each zone of the zone table, which has a row for each zone."""
    zones = zones_df(spark)
    centre = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    found = boxes(spark, sf_dir).select(centre[0].alias("cx"), centre[1].alias("cy"))
    inside = F.col("cx").between(F.col("z.x1"), F.col("z.x2")) & F.col("cy").between(F.col("z.y1"), F.col("z.y2"))
    hits = found.join(F.broadcast(zones.alias("z")), inside).groupBy("zone").agg(F.count(F.lit(1)).alias("n"))
    return zones.join(hits, "zone", "left").select("ord", "zone", F.coalesce("n", F.lit(0)).alias("n_boxes"))


@query("C6", f"WITH {BOXES}, {ZONES_SQL} SELECT frame_id, box_id, zone FROM boxes JOIN zones ON {CENTER_IN}")
def boxes_in_zones(spark, sf_dir):
    return ops.boxes_in_zones(boxes(spark, sf_dir)).select("frame_id", "box_id", "zone")


@query("C6", f"""WITH {BOXES}, {ZONES_SQL}, {FRAME_SIZES.replace('doc_id', 'o_orderkey').replace('documents', 'orders').replace('n_chars', 'o_custkey')},
  fit AS (SELECT o_orderkey, zone, greatest(0, {_fit('zx1', 'x')}) AS zx1, greatest(0, {_fit('zy1', 'y')}) AS zy1,
    least(639, {_fit('zx2', 'x')}) AS zx2, least(479, {_fit('zy2', 'y')}) AS zy2 FROM lbx, zones)
  SELECT frame_id, box_id, zone FROM boxes JOIN fit ON frame_id = o_orderkey AND {CENTER_IN}""")
def boxes_in_adapted_zones(spark, sf_dir):
    sizes = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("frame_id"),
        letterbox_params((F.lit(320) + F.col("o_custkey") % 1600).cast("int"), (F.lit(240) + F.col("o_orderkey") % 900).cast("int")).alias("lb"),
    )
    sized = boxes(spark, sf_dir).join(sizes, "frame_id")
    return ops.boxes_in_zones(sized, letterbox=F.col("lb")).select("frame_id", "box_id", "zone")


@query("C6 D9", f"""WITH {BOXES}, {ZONES_SQL}, f AS (SELECT DISTINCT frame_id FROM boxes),
  h AS (SELECT frame_id, zone, count(*) AS n FROM boxes JOIN zones ON {CENTER_IN} GROUP BY frame_id, zone)
  SELECT f.frame_id, zones.zone, coalesce(n, 0) AS n FROM f CROSS JOIN zones LEFT JOIN h ON h.frame_id = f.frame_id AND h.zone = zones.zone""")
def count_in_zones(spark, sf_dir):
    return ops.count_in_zones(boxes(spark, sf_dir))


_TALLY = ", ".join(
    f"CAST(count(box_id) FILTER ({CENTER_IN.replace('zx1', str(z.x1)).replace('zx2', str(z.x2)).replace('zy1', str(z.y1)).replace('zy2', str(z.y2))}) AS INTEGER) AS {z.name}"
    for z in ZONES
)


@query("D9", f"""WITH {BOXES}, t AS (SELECT o_orderkey AS frame_id, {_TALLY} FROM orders LEFT JOIN boxes ON frame_id = o_orderkey GROUP BY o_orderkey)
  SELECT *, {' + '.join(NAMES)} AS vehicle_count FROM t""")
def zone_counts(spark, sf_dir):
    rows = ops.zone_counts(boxes(spark, sf_dir), box_frames(spark, sf_dir))
    return rows.select("frame_id", *[F.col("roi_counts")[n].alias(n) for n in NAMES], "vehicle_count")


@query("C7", f"WITH {BOXES}, {ZONES_SQL} SELECT frame_id, box_id, zone, {RATIO} AS overlap FROM boxes, zones WHERE {RATIO} > 0")
def overlap_ratios(spark, sf_dir):
    ratios = F.array(*[
        F.struct(F.lit(z.name).alias("zone"), overlap_ratio(rect(), zone_rect(z)).alias("overlap")) for z in ZONES
    ])
    return boxes(spark, sf_dir).select("frame_id", "box_id", F.inline(F.filter(ratios, lambda r: r["overlap"] > 0)))


# Two lines of an order may be alike in all their columns, so each row gets a number of its own.
BEST = f"""num AS MATERIALIZED (SELECT *, row_number() OVER () AS row FROM boxes),
rat AS (SELECT *, {RATIO} AS overlap FROM num, zones),
best AS (SELECT * FROM rat QUALIFY row_number() OVER (PARTITION BY row ORDER BY overlap DESC, ord) = 1)"""


@query("C8", f"WITH {BOXES}, {ZONES_SQL}, {BEST} SELECT frame_id, box_id, zone, overlap FROM best WHERE overlap >= 0.25::DOUBLE")
def assign_best_zone(spark, sf_dir):
    return ops.assign_best_zone(boxes(spark, sf_dir)).select("frame_id", "box_id", "zone", "overlap")


@query("C9", f"""WITH {BOXES}, {ZONES_SQL}, num AS MATERIALIZED (SELECT *, row_number() OVER () AS row FROM boxes)
  SELECT frame_id, count(*) FILTER (hit) AS vehicle_count FROM
  (SELECT frame_id, row, bool_or({RATIO} >= 0.5::DOUBLE) AS hit FROM num, zones GROUP BY frame_id, row) GROUP BY frame_id""")
def count_overlapping(spark, sf_dir):
    return ops.count_overlapping(boxes(spark, sf_dir))


# ---- suppression

def nms_sql(source: str, shared: str) -> str:
    """Box by box in order of confidence, as a recursive query; ``shared`` is the measure that
    must stay at or below 0.45."""
    return f"""rnk AS (SELECT *, row_number() OVER (PARTITION BY frame_id, cls ORDER BY conf DESC NULLS LAST, box_id) AS rn FROM {source}),
stp(frame_id, cls, rn, kept) AS (
  SELECT DISTINCT frame_id, cls, CAST(0 AS BIGINT), CAST([] AS STRUCT(id BIGINT, x1 INTEGER, y1 INTEGER, x2 INTEGER, y2 INTEGER)[]) FROM rnk
  UNION ALL
  SELECT b.frame_id, b.cls, b.rn, CASE WHEN len(list_filter(kept, lambda o: {shared} > 0.45::DOUBLE)) > 0 THEN kept
    ELSE list_append(kept, struct_pack(id := b.box_id, x1 := b.x1, y1 := b.y1, x2 := b.x2, y2 := b.y2)) END
  FROM stp JOIN rnk b ON b.frame_id = stp.frame_id AND b.cls = stp.cls AND b.rn = stp.rn + 1),
fin AS (SELECT frame_id, cls, arg_max(kept, rn) AS kept FROM stp GROUP BY frame_id, cls),
nms AS (SELECT frame_id, cls, unnest(list_transform(kept, lambda o: o.id)) AS box_id FROM fin)"""


_W = "(least(o.x2, b.x2) - greatest(o.x1, b.x1))"
_H = "(least(o.y2, b.y2) - greatest(o.y1, b.y1))"
_AREAS = "(o.x2 - o.x1) * (o.y2 - o.y1)", "(b.x2 - b.x1) * (b.y2 - b.y1)"
LIVE = f"""(CASE WHEN {_W} > 0 AND {_H} > 0 THEN CAST({_W} * {_H} AS DOUBLE)
  / (greatest({_AREAS[0]}, 1) + greatest({_AREAS[1]}, 1) - CAST({_W} * {_H} AS DOUBLE)) ELSE 0 END)"""
OFFLINE = f"""(CASE WHEN {_W} > 0 AND {_H} > 0 THEN CAST({_W} * {_H} AS DOUBLE)
  / ({_AREAS[0]} + {_AREAS[1]} - CAST({_W} * {_H} AS DOUBLE) + 1e-6) ELSE 0 END)"""


@query("C10", f"WITH RECURSIVE {DENSE}, {nms_sql('dense', LIVE)} SELECT frame_id, cls, box_id FROM nms")
def suppress_overlaps(spark, sf_dir):
    return nms(dense_boxes(spark, sf_dir)).select("frame_id", "cls", "box_id")


@query("C10", f"WITH RECURSIVE {DENSE}, {nms_sql('dense', OFFLINE)} SELECT frame_id, cls, box_id FROM nms")
def suppress_overlaps_offline(spark, sf_dir):
    return nms(dense_boxes(spark, sf_dir), variant="offline").select("frame_id", "cls", "box_id")


@query("C10", f"WITH RECURSIVE {CROWDED}, {nms_sql('crowded', LIVE)} SELECT frame_id, cls, box_id FROM nms")
def suppress_crowded(spark, sf_dir):
    """Groups of more boxes than one block, some without confidence."""
    return nms(crowded_boxes(spark, sf_dir)).select("frame_id", "cls", "box_id")


@query("B6 B7 C10 C6 D9", f"""WITH RECURSIVE {BOXES}, use AS (SELECT * FROM boxes WHERE {VEHICLE} AND conf >= 0.20::DOUBLE), {nms_sql('use', LIVE)},
  kep AS (SELECT use.* FROM use JOIN nms USING (frame_id, cls, box_id)),
  t AS (SELECT o_orderkey AS frame_id, {_TALLY} FROM orders LEFT JOIN kep ON frame_id = o_orderkey GROUP BY o_orderkey)
  SELECT *, {' + '.join(NAMES)} AS vehicle_count FROM t""")
def count_vehicles(spark, sf_dir):
    usable = ops.min_conf(ops.vehicles_only(boxes(spark, sf_dir)))
    rows = ops.zone_counts(nms(usable), box_frames(spark, sf_dir))
    return rows.select("frame_id", *[F.col("roi_counts")[n].alias(n) for n in NAMES], "vehicle_count")


# ---- reports

REPORT = f"""rep AS (SELECT frame_id, count(*) AS n_boxes, count(*) FILTER ({VEHICLE}) AS n_vehicles, count(*) FILTER (NOT {VEHICLE}) AS n_others,
    count(*) FILTER ({VEHICLE} AND overlap < 0.25::DOUBLE) AS n_outside,
    {', '.join(f"count(*) FILTER ({VEHICLE} AND overlap >= 0.25::DOUBLE AND zone = '{n}') AS {n}" for n in NAMES)},
    count(*) FILTER ({VEHICLE} AND overlap >= 0.25::DOUBLE) AS total FROM best GROUP BY frame_id)"""


@query("D15", f"WITH {BOXES}, {ZONES_SQL}, {BEST}, {REPORT} SELECT * FROM rep")
def detection_report(spark, sf_dir):
    return ops.detection_report(boxes(spark, sf_dir))


@query("D16", f"WITH {BOXES} SELECT cls, count(*) AS n FROM boxes WHERE NOT {VEHICLE} GROUP BY cls")
def ignored_classes(spark, sf_dir):
    return ops.ignored_classes(boxes(spark, sf_dir))


@query("D17", f"WITH {BOXES}, {ZONES_SQL}, {BEST}, {REPORT} SELECT CAST(sum(total) AS DOUBLE) / greatest(count(*), 1) AS mean_vehicles FROM rep")
def mean_vehicles(spark, sf_dir):
    return ops.mean_vehicles(ops.detection_report(boxes(spark, sf_dir)))


@query("F6", "SELECT doc_id, printf('frame_%010d.jpg', doc_id) AS filename FROM documents ORDER BY filename LIMIT 10")
def first_images(spark, sf_dir):
    return ops.first_images(frames(spark, sf_dir)).select("doc_id", "filename")


# ---- images

PIXELS = """pix AS (SELECT vec_id AS frame_id, i - 1 AS idx, (i - 1) * 9 + 20 AS x, 170 + ((i - 1) * 29) % 200 AS y,
    CAST(floor(abs(embedding[i]) * 1000) AS INTEGER) AS e FROM embeddings, range(1, 65) r(i)),
val AS (SELECT *, e % 256 AS v, (e * 3) % 256 AS s, (e * 5) % 256 AS gray, CASE WHEN e % 2 = 0 THEN 255 ELSE 0 END AS edge,
    CAST(x AS DOUBLE) AS cx, CAST(y AS DOUBLE) AS cy FROM pix)"""


@query("D13", f"""WITH {PIXELS}, {EDGES_SQL}, {ZONES_SQL}, p AS (SELECT DISTINCT cx, cy FROM val), i AS (SELECT cx, cy, {INSIDE} AS inside FROM p),
  m AS (SELECT val.*, zone, inside FROM val JOIN i USING (cx, cy) JOIN zones ON x >= zx1 AND x < zx2 AND y >= zy1 AND y < zy2)
  SELECT frame_id, zone, round(CAST(sum(v) FILTER (inside) AS DOUBLE) / (count(*) FILTER (inside) + 1), 6) AS brightness_mean,
    round(coalesce(stddev_pop(v) FILTER (inside), 0), 6) AS brightness_std, round(CAST(sum(s) FILTER (inside) AS DOUBLE) / (count(*) FILTER (inside) + 1), 6) AS saturation_mean,
    round(CAST(sum(edge) FILTER (inside) AS DOUBLE) / (count(*) FILTER (inside) + 1) / 255, 6) AS edge_density, round(coalesce(stddev_pop(gray) FILTER (inside), 0), 6) AS gray_contrast
  FROM m GROUP BY frame_id, zone HAVING count(*) FILTER (inside) > 0""")
def pixel_stats(spark, sf_dir):
    e = F.floor(F.abs("value") * 1000).cast("int")
    cells = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame_id"), F.posexplode("embedding").alias("idx", "value"))
    pixels = cells.select(
        "frame_id",
        (F.col("idx") * 9 + 20).alias("x"),
        (F.lit(170) + (F.col("idx") * 29) % 200).alias("y"),
        (e % 256).alias("v"),
        ((e * 3) % 256).alias("s"),
        ((e * 5) % 256).alias("gray"),
        F.when(e % 2 == 0, 255).otherwise(0).alias("edge"),
    )
    stats = pixel_zone_stats(pixels)
    return stats.select("frame_id", "zone", *[F.round(c, 6).alias(c) for c in stats.columns[2:]])


def painted(embedding="embedding"):
    """A small picture, eight by eight pixels."""
    shade = F.transform(embedding, lambda x: F.floor(F.abs(x) * 1000).cast("int") % 256)
    two_digits = F.transform(shade, lambda v: F.lpad(F.hex(v), 2, "0"))
    bgr = F.transform(two_digits, lambda t: F.concat(t, F.reverse(t), F.lit("80")))
    return F.struct(
        F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(3).alias("nChannels"), F.unhex(F.array_join(bgr, "")).alias("data")
    )


SHADES = "list_transform(embedding, lambda x: CAST(floor(abs(x) * 1000::FLOAT) AS INTEGER) % 256)"


@query("J9 E2", f"""WITH pic AS (SELECT vec_id, {SHADES} AS p FROM embeddings), early AS (SELECT DISTINCT p FROM pic WHERE vec_id % 3 = 0)
  SELECT 1 AS run, (SELECT count(*) FROM early) AS n_computed, (SELECT count(*) FROM pic WHERE vec_id % 3 = 0) AS n_frames
  UNION ALL SELECT 2, (SELECT count(DISTINCT p) FROM pic) - (SELECT count(*) FROM early), (SELECT count(*) FROM pic) UNION ALL SELECT 3, 0, (SELECT count(*) FROM pic)""")
def features_by_content(spark, sf_dir):
    """A third of the frames, then all, then all again: only contents that were not seen are computed."""
    frames = spread_pictures(table(spark, sf_dir, "embeddings")).select(F.lit("d").alias("fecha"), F.col("vec_id").alias("filename"), painted().alias("image"))
    path = scratch_path(spark, "pictures")
    frames.withColumn("md5", F.md5("image.data")).write.parquet(f"{path}/frames")
    frames = spark.read.parquet(f"{path}/frames")
    out = []
    for run, rows in enumerate((frames.where("filename % 3 = 0"), frames, frames), 1):
        n = add_new_features(rows, f"{path}/features").count()
        out.append((run, n, features_of(rows, f"{path}/features").count()))
    return spark.createDataFrame(out, "run int, n_computed long, n_frames long")


@query("D13 J9")
def image_features(spark, sf_dir):
    """Features of small pictures painted from the embeddings."""
    image = painted()
    frames = spread_pictures(table(spark, sf_dir, "embeddings")).select(F.col("vec_id").alias("frame_id"), image.alias("image"))
    return zone_image_features(frames, ["frame_id"])


@query("D13", """WITH c AS (SELECT vec_id AS frame_id, CAST(floor(abs(embedding[1]) * 1000::FLOAT) AS INTEGER) % 256 AS b,
    CAST(floor(abs(embedding[2]) * 1000::FLOAT) AS INTEGER) % 256 AS g, CAST(floor(abs(embedding[3]) * 1000::FLOAT) AS INTEGER) % 256 AS r FROM embeddings),
  m AS (SELECT frame_id, greatest(b, g, r) AS v, least(b, g, r) AS l FROM c)
  SELECT frame_id, v, CAST(round_even(255.0 * (v - l) / greatest(v, 1), 0) AS INTEGER) AS s, true AS even FROM m""")
def uniform_pictures(spark, sf_dir):
    """Pictures of one colour: brightness and saturation are the colour's in every zone, nothing spreads and there is no edge.

    A zone's mean divides by its pixels plus one, so the two are compared through their ratio to a white one.
    """
    shade = F.transform(F.slice("embedding", 1, 3), lambda x: F.floor(F.abs(x) * 1000).cast("int") % 256)
    pixel = F.array_join(F.transform(shade, lambda v: F.lpad(F.hex(v), 2, "0")), "")
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame_id"), pixel.alias("pixel"))
    one = rows.limit(1).select(F.lit(-1).cast("long").alias("frame_id"), F.lit("FFFFFF").alias("pixel"))  # white, to know the share of each zone
    image = F.struct(F.lit(36).alias("height"), F.lit(64).alias("width"), F.lit(3).alias("nChannels"), F.unhex(F.repeat("pixel", 36 * 64)).alias("data"))
    found = zone_image_features(spread_pictures(rows.unionByName(one)).select("frame_id", image.alias("image")), ["frame_id"])
    bright = [c for c in found.columns if c.endswith("brightness_mean")]
    white = found.where("frame_id = -1").select(*[(F.col(c) / 255).alias(f"w_{c}") for c in bright])
    near = found.where("frame_id >= 0").join(F.broadcast(white))  # one row
    zones = {c: c.removesuffix("brightness_mean") for c in bright}
    flat = [F.col(f"{z}{m}") == 0 for z in zones.values() for m in ("brightness_std", "edge_density", "gray_contrast")]
    values = [F.round(F.col(c) / F.col(f"w_{c}")).cast("int") for c in bright]
    shades = [F.round(F.col(f"{z}saturation_mean") / F.col(f"w_{c}")).cast("int") for c, z in zones.items()]
    same = [x == y[0] for y in (values, shades) for x in y[1:]]
    even = flat[0]
    for fact in (*flat[1:], *same):
        even = even & fact
    return near.select("frame_id", values[0].alias("v"), shades[0].alias("s"), even.alias("even"))
