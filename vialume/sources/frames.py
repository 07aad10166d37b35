"""Frame files: bytes for hashing, pixels for features."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.sources.labels import DAY_PATTERN


#: The name of a frame is the last part of its path.
NAME = r"([^/]+)$"


def _named(df: DataFrame, path: str, name: str) -> DataFrame:
    return df.withColumns({
        "fecha": F.regexp_extract(path, DAY_PATTERN, 1),
        "filename": F.regexp_extract(path, name, 1),
    })


def read_frames(spark: SparkSession, root: str, decode: bool = False, pattern: str = "*/frames", glob: str = "*.jpg", name: str = NAME) -> DataFrame:
    """Frames of all day folders.

    Without ``decode``: (fecha, filename, content). With it: (fecha, filename, image), where
    ``image`` holds height, width, channels and the pixels; unreadable files are left out. ``name`` finds the name in a path.
    """
    where = f"{root}/{pattern}"
    if not decode:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(where)
        return _named(files, "path", name).select("fecha", "filename", "content")
    images = spark.read.format("image").option("dropInvalid", True).option("pathGlobFilter", glob).load(where)
    return _named(images, "image.origin", name).select("fecha", "filename", "image")


def write_frames(df: DataFrame, root: str) -> int:
    """Store (fecha, filename, content) as ``root/fecha/frames/filename``; returns the number of files.

    Rows of one name make one file. Every task writes its files into the day folders itself, each under another name first, so
    that nobody reads half a file and a second attempt replaces what the first one left. The folder is one that Arrow reaches
    from all executors: mounted, or in a store it knows. Spark's own writers choose the names of their files, so they
    would need a folder for each frame.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = FileSystem.from_uri(root)
        known, n, key, out, path, part = set(), 0, None, None, "", ""
        for batch in batches:
            for *found, content in zip(*(c.to_pylist() for c in batch.columns)):
                if found != key:
                    if out:
                        out.close()
                        store.move(part, path)
                    key, folder = found, f"{top}/{found[0]}/frames"
                    if folder not in known:
                        store.create_dir(folder)
                        known.add(folder)
                    path, part = f"{folder}/{found[1]}", f"{folder}/.{uuid.uuid4().hex}"
                    out, n = store.open_output_stream(part), n + 1
                out.write(content)
        if out:
            out.close()
            store.move(part, path)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    rows = df.select("fecha", "filename", "content").repartition("fecha", "filename").sortWithinPartitions("fecha", "filename")
    return rows.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def list_frames(spark: SparkSession, root: str, pattern: str = "*/frames", glob: str = "*.jpg", name: str = NAME) -> DataFrame:
    """(fecha, filename) of all frames; the contents are not read."""
    return read_frames(spark, root, False, pattern, glob, name).select("fecha", "filename")
