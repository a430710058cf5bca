"""Documents at exactly their paths, in two phases.

First every task writes its documents under names of their own into a staging folder, and
Spark commits what succeeded as a table, the manifest. Only when that is complete are the staged
files renamed to their paths, by tasks again. A failed task or run so leaves
nothing at any path, a repeated one puts the same documents there, and
neither documents nor their names pass the driver.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlab.session import ship

MANIFEST = "path string, staged string, bytes long, sha256 string"
_MANIFEST = pa.schema([("path", pa.string()), ("staged", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string())])


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and its path there: a local path or an address that pyarrow knows."""
    if "://" not in folder:
        return fs.LocalFileSystem(), re.sub("^file:", "", folder)
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))


def stager(staging: str):
    """Write each document of a task to a name that no other attempt uses."""
    def run(batches):
        store, root = opened(staging)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for i in range(batch.num_rows):
                body = batch.column("body")[i].as_buffer().to_pybytes()
                name = f"{root}/{uuid.uuid4().hex}"
                with store.open_output_stream(name) as out:
                    out.write(body)
                row = [batch.column("path")[i].as_py(), name, len(body), hashlib.sha256(body).hexdigest()]
                yield pa.record_batch([pa.array([x], t) for x, t in zip(row, _MANIFEST.types)], schema=_MANIFEST)
    return run


def mover(folder: str):
    """Rename staged documents; one that an earlier attempt has moved must be at its path already."""
    def run(batches):
        store, root = opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                target = f"{root}/{row['path']}"
                if store.get_file_info(row["staged"]).type == fs.FileType.File:
                    store.create_dir(target.rpartition("/")[0], recursive=True)
                    if store.type_name == "hdfs" and store.get_file_info(target).type == fs.FileType.File:
                        store.delete_file(target)
                    store.move(row["staged"], target)
                else:
                    with store.open_input_stream(target) as there:
                        if hashlib.sha256(there.read()).hexdigest() != row["sha256"]:
                            raise OSError(f"neither staged nor in place: {row['path']}")
            yield batch
    return run


def latest(documents: DataFrame, text: str) -> DataFrame:
    """Of documents with one path that of the last run; only paths and times are grouped."""
    last = documents.where("path is not null").groupBy(F.col("path").alias("_path")).agg(F.max("run_at").alias("_last"))
    found = documents.join(last, (F.col("path") == F.col("_path")) & (F.col("run_at") == F.col("_last")))
    return found.select("path", F.col(text).cast("binary").alias("body"))


def write_at_paths(documents: DataFrame, folder: str, run_id: str, text: str = "full_html") -> DataFrame:
    """Put each document (path, run_at, ``text``) at ``folder/path``; returns path, bytes and sha256 of what was put there.

    ``folder`` is a path or address that pyarrow opens on every machine. The
    manifest stays at ``folder/_manifests/run_id=...``; readers of Spark pass names with an underscore.
    """
    spark = documents.sparkSession
    ship(spark)
    staging, manifest = f"{folder}/_staging/{run_id}", f"{folder}/_manifests/run_id={run_id}"
    store, root = opened(staging)

    def clear():
        if store.get_file_info(root).type == fs.FileType.Directory:
            store.delete_dir(root)
    clear()
    try:
        latest(documents, text).mapInArrow(stager(staging), MANIFEST).write.mode("overwrite").parquet(manifest)
        staged = spark.read.schema(MANIFEST).parquet(manifest)
        staged.mapInArrow(mover(folder), MANIFEST).write.format("noop").mode("overwrite").save()
    finally:
        clear()
    return staged.select("path", "bytes", "sha256")
