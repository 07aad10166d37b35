import hashlib
import json

import pytest
from pyspark.sql import functions as F

from vialume.operators import catalog, history
from vialume.plans import labels as plans
from vialume.sources import frames as frame_files
from vialume.sources import labels as files


@pytest.fixture
def root(tmp_path):
    """Day folders as the label tools leave them."""
    full = "filename,timestamp,weekday,weekday_name,hour,minute,is_rush_hour,estado,vehicle_count\n"
    short = "estado,filename,timestamp,weekday,weekday_name,hour,minute,is_rush_hour\n"
    d1, d2, d3 = (tmp_path / d for d in ("20240101", "20240102", "20240103"))
    for d in (d1, d2, d3):
        (d / "frames").mkdir(parents=True)
        (d / "meta").mkdir()
        (d / "yolo").mkdir()
    (d1 / "labels.csv").write_text(full + "a.jpg,t1,0,lunes,8,30,True,FLUIDO,9\nb.jpg,t2,0,lunes,,5,False,DENSO,\n")
    (d2 / "labels.csv").write_text(short + "COLAPSO,c.jpg,t3,1,martes,NaN,0,1\n")
    (d1 / "yolo" / "counts.json").write_text(json.dumps({"a.jpg": 3}, indent=2))
    (d3 / "yolo" / "counts.json").write_text("{}")
    (d1 / "meta" / "a.json").write_text(json.dumps({"timestamp": "T", "hour": 8, "is_rush_hour": True}, indent=1))
    (d1 / "meta" / "b.json").write_text("{broken")
    (d1 / "labels.json").write_text(json.dumps([{"filename": "a.jpg", "estado": "FLUIDO"}, {"image": "b.jpg", "estado": "DENSO"}], indent=2))
    (d2 / "labels.json").write_text(json.dumps({"c.jpg": "COLAPSO"}))
    for d, name, data in ((d1, "a.jpg", b"one"), (d1, "b.jpg", b"one"), (d2, "c.jpg", b"two")):
        (d / "frames" / name).write_bytes(data)
    (d1 / "frames" / "notes.txt").write_text("x")
    return str(tmp_path)


def test_labels_with_unlike_headers(spark, root):
    got = {r.filename: r for r in files.read_labels(spark, root).collect()}
    assert set(got) == {"a.jpg", "b.jpg", "c.jpg"}
    assert [got[f].estado for f in ("a.jpg", "b.jpg", "c.jpg")] == ["FLUIDO", "DENSO", "COLAPSO"]
    assert [got[f].vehicle_count for f in ("a.jpg", "b.jpg", "c.jpg")] == [9, 0, 0]
    assert got["c.jpg"].fecha == "20240102"


def test_no_label_files(spark, tmp_path):
    (tmp_path / "20240101").mkdir()
    (tmp_path / "20240101" / "labels.csv").write_text("")
    assert files.read_labels(spark, str(tmp_path)).count() == 0


def test_catalog_cleans_numbers(spark, root):
    frames = frame_files.list_frames(spark, root)
    rows = {r.filename: r for r in catalog.build_catalog(files.read_labels(spark, root), frames).collect()}
    assert (rows["a.jpg"].hour, rows["a.jpg"].is_rush_hour, rows["a.jpg"].congestion_hour_score) == (8, 1, 0.203)
    assert (rows["b.jpg"].hour, rows["b.jpg"].is_rush_hour, rows["b.jpg"].congestion_hour_score) == (0, 0, 0.15)
    assert (rows["c.jpg"].hour, rows["c.jpg"].is_rush_hour) == (0, 1)


def test_counts_meta_and_json(spark, root):
    assert [tuple(r) for r in files.read_counts(spark, root).collect()] == [("20240101", "a.jpg", 3)]
    meta = {r.stem: r for r in files.read_frame_meta(spark, root).collect()}
    assert (meta["a"].timestamp, meta["a"].hour, meta["a"].is_rush_hour, meta["a"].minute) == ("T", 8, True, None)
    assert meta["b"].timestamp is None and meta["b"].hour is None
    copies = {(r.fecha, r.filename): r.estado for r in files.read_labels_json(spark, root).collect()}
    assert copies == {("20240101", "a.jpg"): "FLUIDO", ("20240101", "b.jpg"): "DENSO", ("20240102", "c.jpg"): "COLAPSO"}


def test_enrichment_keeps_days_without_counts(spark, root):
    labels = files.read_labels(spark, root)
    got = {r.filename: r.vehicle_count for r in catalog.enrich_counts(labels, files.read_counts(spark, root)).collect()}
    assert got == {"a.jpg": 3, "b.jpg": 0, "c.jpg": 0}
    bare = labels.drop("vehicle_count")
    got = {r.filename: r.vehicle_count for r in catalog.enrich_counts(bare, files.read_counts(spark, root)).collect()}
    assert got == {"a.jpg": 3, "b.jpg": 0, "c.jpg": None}
    summary = {r.fecha: r for r in history.enrich_summary(bare.withColumn("vehicle_count", F.lit(2))).collect()}
    assert (summary["20240101"].n_rows, summary["20240101"].n_errors, summary["20240101"].avg_vehicles) == (2, 0, 2.0)


def test_frames_and_label_rows(spark, root):
    frames = frame_files.read_frames(spark, root)
    assert {(r.fecha, r.filename, bytes(r.content)) for r in frames.collect()} == {
        ("20240101", "a.jpg", b"one"), ("20240101", "b.jpg", b"one"), ("20240102", "c.jpg", b"two"),
    }
    listed = frame_files.list_frames(spark, root)
    rows = {r.filename: r for r in catalog.label_rows(listed, files.read_frame_meta(spark, root), F.lit("DENSO")).collect()}
    assert (rows["a.jpg"].timestamp, rows["a.jpg"].hour, rows["a.jpg"].minute) == ("T", "8", "")
    assert (rows["b.jpg"].timestamp, rows["c.jpg"].timestamp) == ("b", "c")


def test_relabels_last_change_wins(spark, root):
    labels = files.read_labels(spark, root)
    changes = spark.createDataFrame(
        [("20240101", "a.jpg", "DENSO", 1), ("20240101", "a.jpg", "COLAPSO", 2), ("20240102", "a.jpg", "DENSO", 3)],
        "fecha string, filename string, estado string, seq int",
    )
    got = {r.filename: r.estado for r in catalog.apply_relabels(labels, changes).collect()}
    assert got == {"a.jpg": "COLAPSO", "b.jpg": "DENSO", "c.jpg": "COLAPSO"}
    assert [r.filename for r in catalog.suspicious_labels(labels).collect()] == ["a.jpg"]
    assert catalog.suspicious_labels(labels, 10).count() == 0


def test_round_trip_of_labels(spark, root, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out") / "labels")
    labels = files.read_labels(spark, root)
    files.write_labels(labels, out)
    back = files.read_labels(spark, out, "fecha=*/*.csv")
    assert back.columns == labels.columns
    assert sorted((r.fecha, r.filename, r.vehicle_count) for r in back.collect()) == sorted(
        (r.fecha, r.filename, r.vehicle_count) for r in labels.collect()
    )


def test_count_maps_are_split_into_small_objects(spark, tmp_path):
    df = spark.range(1000).select(
        F.lit("20240101").alias("fecha"), F.format_string("f%04d.jpg", "id").alias("filename"), (F.col("id") % 9).cast("int").alias("vehicle_count")
    )
    out = str(tmp_path / "maps")
    files.write_counts(df, out, per_object=50)
    sizes = [len(json.loads(r.value)) for r in spark.read.text(out).collect()]
    assert sum(sizes) == 1000 and max(sizes) < 120
    back = files.read_counts(spark, out, "fecha=*/*.txt", lines=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_broken_metadata_gives_nulls(spark):
    texts = spark.createDataFrame([("a", '{"hour": 5}'), ("b", "nothing"), ("c", None), ("d", '{"hour": "x", "minute": 3}')], "stem string, value string")
    got = {r.stem: r.hour for r in files.parse_meta(texts).collect()}
    assert got == {"a": 5, "b": None, "c": None, "d": None}


def test_label_file_with_foreign_header_is_an_error(spark, root):
    from pathlib import Path

    found = next(Path(root).glob("*/labels.csv"))
    found.write_text("filename,state\nz.jpg,FLUIDO\n")
    with pytest.raises(ValueError, match="estado"):
        files.read_labels(spark, str(root))


def test_relabelling_touches_only_the_changed_days(spark, tmp_path):
    """Both copies of the changed days are new, all other files keep their time."""
    root = str(tmp_path / "labels")
    rows = [(f"2024010{d}", f"f{i}.jpg", "FLUIDO", str(i), i) for d in range(1, 6) for i in range(4)]
    labels = spark.createDataFrame(rows, "fecha string, filename string, estado string, hour string, vehicle_count int")
    labels = labels.withColumns({c: F.lit("") for c in ("timestamp", "weekday", "weekday_name", "minute", "is_rush_hour")})
    files.rewrite_days(labels, root)

    def stamps():
        return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in (tmp_path / "labels").rglob("part-*")}

    before = stamps()
    changes = spark.createDataFrame(
        [("20240102", "f1.jpg", "DENSO", 1), ("20240102", "f1.jpg", "COLAPSO", 2), ("20240104", "f0.jpg", "DENSO", 1),
         ("20240105", "f0.jpg", "FLUIDO", 1), ("20240109", "f0.jpg", "DENSO", 1)],
        "fecha string, filename string, estado string, seq int")
    files.relabel_in_place(spark, root, changes)
    after = stamps()
    touched = {"20240102", "20240104"}
    assert {f for f in before if before[f] == after.get(f)} == {f for f in before if f.split("fecha=")[1][:8] not in touched}
    assert {f.split("fecha=")[1][:8] for f in set(after) - set(before)} == touched
    want = {(d, f): s for d, f, s, _, _ in rows} | {("20240102", "f1.jpg"): "COLAPSO", ("20240104", "f0.jpg"): "DENSO"}
    csv = files.read_labels(spark, f"{root}/csv", "fecha=*/*.csv")
    lines = files.read_labels_json(spark, f"{root}/json", "fecha=*/*.json", lines=True)
    for copy in (csv, lines):
        assert {(r.fecha, r.filename): r.estado for r in copy.collect()} == want
    files.relabel_in_place(spark, root, changes.limit(0))
    assert stamps() == after


def test_headers_in_any_order_with_quotes_marks_and_more_columns(spark, tmp_path):
    """Fields are placed by the names of their own file; cells may hold commas, lines may be short or long."""
    for day, text in (
        ("20240101", '\ufefffilename,estado,hour\n"a,1.jpg",FLUIDO,5\n\nb.jpg,DENSO\n'),
        ("20240102", '"estado","note","filename"\nCOLAPSO,"x, y",c.jpg,spare\n'),
        ("20240103", "filename,estado,hour\n"),
        ("20240104", ""),
    ):
        (tmp_path / day).mkdir()
        (tmp_path / day / "labels.csv").write_text(text)
    got = {r.filename: r for r in files.read_labels(spark, str(tmp_path)).collect()}
    assert {f: (r.estado, r.hour, r.note, r.fecha) for f, r in got.items()} == {
        "a,1.jpg": ("FLUIDO", "5", None, "20240101"), "b.jpg": ("DENSO", None, None, "20240101"), "c.jpg": ("COLAPSO", None, "x, y", "20240102")}


def test_frames_lie_in_their_day_folders(spark, tmp_path):
    """One file for each name, whatever the number of rows with it, and no folder for each frame."""
    rows = [(f"2024010{1 + i % 3}", f"f{i:04d}.jpg", bytes([i % 256]) * (i + 1)) for i in range(300)] + [("20240101", "twice.jpg", b"a\n")] * 3
    df = spark.createDataFrame(rows, "fecha string, filename string, content binary")
    for root in (str(tmp_path / "plain"), f"file://{tmp_path}/uri"):
        for _ in range(2):  # a second attempt leaves the same files
            assert frame_files.write_frames(df.repartition(7), root) == 301
        found = {(r.fecha, r.filename): bytes(r.content) for r in frame_files.read_frames(spark, root).collect()}
        assert found == {(d, n): c for d, n, c in rows[:300]} | {("20240101", "twice.jpg"): b"a\n" * 3}
        assert frame_files.list_frames(spark, root).count() == 301
    assert sorted(p.relative_to(tmp_path / "uri").as_posix() for p in (tmp_path / "uri").rglob("*") if p.is_dir()) == [
        x for d in "123" for x in (f"2024010{d}", f"2024010{d}/frames")]
    assert len([p for p in (tmp_path / "uri").rglob("*") if p.is_file()]) == 301
    assert frame_files.write_frames(df.limit(0), str(tmp_path / "none")) == 0


def test_frame_files_makes_a_folder_for_a_day_not_for_a_frame(spark, tmp_path, monkeypatch):
    """Null texts, repeated numbers and numbers that are missing."""
    spark.createDataFrame([(1, "x"), (2, None), (2, None), (31, "y\nz"), (None, "w")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(plans, "scratch_path", lambda *_: str(tmp_path / "frames"))
    got = {(r.fecha, r.filename, r.md5, r.even) for r in plans.frame_files(spark, str(tmp_path)).collect()}
    hashed = lambda text: hashlib.md5(text).hexdigest()
    assert got == {("20240102", "frame_0000000001.jpg", hashed(b"x\n"), False), ("20240103", "frame_0000000002.jpg", hashed(b"\n" * 4), True),
                   ("20240104", "frame_0000000031.jpg", hashed(b"y\nz\n"), False)}
    assert len([p for p in (tmp_path / "frames").rglob("*") if p.is_dir()]) == 6
