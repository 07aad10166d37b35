"""Label files, count maps and frame metadata of day folders.

Readers accept both ``<root>/<YYYYMMDD>/<file>`` and Spark's own ``<root>/fecha=<YYYYMMDD>/...``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.config import LABEL_FIELDS
from vialume.operators.catalog import apply_relabels
from vialume.session import scratch_path

# Layout of the folders.
DAY_PATTERN = r"/(?:fecha=)?(\d{8})/"
META_SCHEMA = "timestamp string, weekday int, weekday_name string, hour int, minute int, is_rush_hour boolean"
LABEL_SCHEMA = ", ".join(f"{c} string" for c in LABEL_FIELDS)


def _day() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), DAY_PATTERN, 1)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with content, and the file that each comes from."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    return lines.filter(F.trim("value") != "")


def _cells(value: Column | str, n: int) -> Column:
    """The fields of a line as an array of ``n`` texts; missing ones are null."""
    names = [f"c{i}" for i in range(n)]
    parsed = F.from_csv(value, ", ".join(f"{c} string" for c in names))
    return F.array(*[parsed[c] for c in names])


def read_labels(spark: SparkSession, root: str, pattern: str = "*/labels.csv") -> DataFrame:
    """All label rows as text, with ``fecha``; ``vehicle_count`` is an int, 0 where a day lacks it.

    Files may have unlike headers: every line is joined to the header of its own file, and its fields are placed by name.
    Only the headers that differ reach the driver, one line each, never the files. A null field stays null.
    """
    lines = _lines(spark, f"{root}/{pattern}")
    headers = lines.filter(F.col("block") == 0).groupBy("file").agg(F.min_by("value", "at").alias("header"))
    unlike = headers.groupBy("header").agg(F.min("file").alias("sample")).collect()
    if not unlike:
        return spark.createDataFrame([], LABEL_SCHEMA.replace("vehicle_count string", "vehicle_count int") + ", fecha string")
    found: dict[str, list[str]] = {}
    for header, sample in unlike:
        names = [n.strip().strip('"') for n in header.lstrip("\ufeff").split(",")]
        if missing := {"filename", "estado"} - set(names):
            raise ValueError(f"label files without {sorted(missing)}, such as {sample}")
        found[header] = names
    others = sorted({n for names in found.values() for n in names} - set(LABEL_FIELDS))
    places = {header: {n: i for i, n in reversed(list(enumerate(names)))} for header, names in found.items()}
    named = spark.createDataFrame([(h, [places[h].get(n, -1) for n in (*LABEL_FIELDS, *others)]) for h in found], "header string, places array<int>")
    rows = lines.select("value", "file").join(headers, "file").join(F.broadcast(named), "header").filter(F.col("value") != F.col("header"))
    cells = rows.select(_cells("value", max(map(len, found.values()))).alias("cells"), "places", F.regexp_extract("file", DAY_PATTERN, 1).alias("fecha"))
    fields = {n: F.get("cells", F.get("places", F.lit(i))) for i, n in enumerate((*LABEL_FIELDS, *others))}
    fields["vehicle_count"] = F.coalesce(fields["vehicle_count"].try_cast("int"), F.lit(0))
    return cells.select(*[fields[n].alias(n) for n in LABEL_FIELDS], *([] if "fecha" in others else ["fecha"]), *[fields[n].alias(n) for n in others])


def write_labels(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Label rows with the columns in their fixed order, one folder per day.

    Write to a new path and switch over afterwards; Spark cannot overwrite what it still reads.
    """
    rows = df.select("fecha", *LABEL_FIELDS).hint("rebalance", "fecha")
    writer = rows.write.partitionBy("fecha").mode(mode)
    writer.csv(path, header=True) if fmt == "csv" else writer.json(path)


def rewrite_days(labels: DataFrame, root: str) -> None:
    """Replace the days of ``labels`` in the two copies under ``root``, ``csv`` and ``json``; other days are not touched.

    Each copy is written aside and its days are swapped in by rename at the end. Both come from the same stored rows,
    so a run that stopped between them is mended by running it again.
    """
    rows = labels.select("fecha", *LABEL_FIELDS).hint("rebalance", "fecha")
    for fmt in ("json", "csv"):
        writer = rows.write.partitionBy("fecha").mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.json(f"{root}/json") if fmt == "json" else writer.csv(f"{root}/csv", header=True)


def relabel_in_place(spark: SparkSession, root: str, changes: DataFrame, order: str = "seq") -> None:
    """Apply new states to the label tables under ``root``: only days in which a state changes are written again.

    ``changes`` has fecha, filename, estado and an order; of several changes to a file the last one wins.
    """
    old = read_labels(spark, f"{root}/csv", "fecha=*/*.csv")
    new = apply_relabels(old.withColumn("__was", F.col("estado")), changes, order)
    days = [r[0] for r in new.filter(~F.col("estado").eqNullSafe(F.col("__was"))).select("fecha").distinct().collect()]  # bounded by the calendar
    if not days:
        return
    path = scratch_path(spark, "relabelled")  # the tables cannot be overwritten while they are read
    new.filter(F.col("fecha").isin(days)).select("fecha", *LABEL_FIELDS).write.parquet(path)
    rewrite_days(spark.read.parquet(path), root)


def read_counts(spark: SparkSession, root: str, pattern: str = "*/yolo/counts.json", lines: bool = False) -> DataFrame:
    """(fecha, filename, vehicle_count) of count maps; one JSON object per file, or per line."""
    text = spark.read.text(f"{root}/{pattern}", wholetext=not lines).select("value", _day().alias("fecha"))
    return text.select("fecha", F.explode(F.from_json("value", "map<string,int>")).alias("filename", "vehicle_count"))


def write_counts(df: DataFrame, path: str, per_object: int = 250) -> None:
    """Count maps, one object of about ``per_object`` entries per line, so that no day has to fit
    into one row."""
    parts = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / per_object))
    sizes = df.groupBy("fecha").agg(parts.alias("__parts"))
    placed = df.join(F.broadcast(sizes), "fecha").withColumn("__part", F.pmod(F.xxhash64("filename"), F.col("__parts")))
    entry = F.struct(F.col("filename").alias("key"), F.col("vehicle_count").cast("int").alias("value"))
    maps = placed.groupBy("fecha", "__part").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    maps.select("fecha", "value").hint("rebalance", "fecha").write.partitionBy("fecha").text(path)


def read_labels_json(spark: SparkSession, root: str, pattern: str = "*/labels.json", lines: bool = False) -> DataFrame:
    """Label rows of JSON copies: a list of objects (or one per line), or one object file -> state.

    The file name stands in ``filename`` or else in ``image``.
    """
    text = spark.read.text(f"{root}/{pattern}", wholetext=not lines).select(
        F.trim("value").alias("value"), _day().alias("fecha")
    )
    names = [*LABEL_FIELDS, "image"]
    kind = f"array<struct<{', '.join(f'{n}:string' for n in names)}>>"
    value = F.col("value")
    one = F.from_json(F.concat(F.lit("["), value, F.lit("]")), kind)

    def pair(entry: Column) -> Column:
        filled = {c: entry[f] for c, f in (("filename", "key"), ("estado", "value"))}
        return F.struct(*[filled.get(n, F.lit(None).cast("string")).alias(n) for n in names])

    is_row = F.coalesce(one[0]["filename"], one[0]["image"]).isNotNull()
    pairs = F.transform(F.map_entries(F.from_json(value, "map<string,string>")), pair)
    items = F.when(value.startswith("["), F.from_json(value, kind)).when(value.startswith("{"), F.when(is_row, one).otherwise(pairs))
    rows = text.select("fecha", F.inline(items))
    return rows.withColumn("filename", F.coalesce("filename", "image")).drop("image")


def parse_meta(texts: DataFrame, value: str = "value") -> DataFrame:
    """Metadata fields of JSON text; text that is no JSON object gives nulls."""
    parsed = texts.withColumn("__m", F.from_json(value, META_SCHEMA, {"mode": "PERMISSIVE"}))
    return parsed.select(*[c for c in texts.columns if c != value], "__m.*")


def read_frame_meta(spark: SparkSession, root: str, pattern: str = "*/meta/*.json") -> DataFrame:
    """Metadata of frames, keyed by day and by file stem; all fields may be null."""
    text = spark.read.text(f"{root}/{pattern}", wholetext=True).select(
        _day().alias("fecha"),
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1).alias("stem"),
        "value",
    )
    return parse_meta(text)
