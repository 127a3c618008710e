"""Session helpers: the shared scratch folder and SQL quoting."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Read from the session. Only a session whose executors run inside the
    driver (``local[...]``, as in tests) may get a folder of its own where
    none is set; on a cluster a machine-local folder would lose data, so that
    is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
        if root:
            root = root.rsplit("/", 1)[0]
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tessera-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder name under the shared root (not created)."""
    return f"{shared_root(spark)}/tessera/{label}-{uuid.uuid4().hex[:12]}"


def unique_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:10]}"


def quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quote_table(name: str) -> str:
    """Quote each dot-separated part of a table name."""
    return ".".join(quote_ident(p) for p in name.split("."))


def sql_string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# ------------------------------------------------------------- shared folders

def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can reach it; a missing one is fine."""
    hadoop, fs = _filesystem(spark, path)
    fs.delete(hadoop, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _filesystem(spark, path)
    return fs.exists(hadoop)


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _filesystem(spark, path)
    return fs.exists(hadoop) and fs.getFileStatus(hadoop).isDirectory()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store, without a closing slash."""
    hadoop, fs = _filesystem(spark, path)
    return fs.makeQualified(hadoop).toString().rstrip("/")


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; a missing one has none."""
    hadoop, fs = _filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def first_file(spark: SparkSession, uris: Sequence[str]) -> str | None:
    """A data file under the URIs (which may hold wildcards); the listing ends at the first one."""
    for uri in uris:
        hadoop, fs = _filesystem(spark, uri)
        for status in fs.globStatus(hadoop) or []:
            found = fs.listFiles(status.getPath(), True)
            while found.hasNext():
                path = found.next().getPath()
                if not path.getName().startswith(("_", ".")):
                    return path.toString()
    return None


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    hadoop, fs = _filesystem(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole small text file in place unless the name is taken; says whether it did.

    Atomic where the store's rename without overwrite is (HDFS, ABFS); a local
    folder, whose rename overwrites, takes a hard link instead.
    """
    target, fs = _filesystem(spark, path)
    fs.mkdirs(target.getParent())
    draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.draft"
    write_text(spark, draft, text)
    jvm = spark.sparkContext._jvm
    try:
        if fs.getUri().getScheme() == "file":
            local = lambda p: jvm.org.apache.hadoop.fs.Path(p).toUri().getPath()
            try:
                os.link(local(draft), local(path))
            except FileExistsError:
                return False
            return True
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(jvm.org.apache.hadoop.fs.Path(draft), target, none)
        except Exception:
            if fs.exists(target):
                return False
            raise
        return True
    finally:
        delete_folder(spark, draft)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small text file; an existing one is an error."""
    hadoop, fs = _filesystem(spark, path)
    out = fs.create(hadoop, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
