"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# Folders handed out by new_folder and not removed yet.
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder named in ``spark.checkpoint.dir``.

    Only a session in local mode may leave it unset; it then gets a fresh
    temporary folder.
    """
    folder = spark.conf.get(SETTING, None)
    context = spark.sparkContext
    if not folder and context.getCheckpointDir():
        return context.getCheckpointDir()
    if not folder:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="joinwright-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession) -> str:
    """Path in the shared folder that nothing else uses."""
    folder = f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def made_folders() -> list[str]:
    """Folders handed out so far that :func:`remove_made_folders` would remove."""
    return list(_made)


def remove_made_folders(spark: SparkSession, folders: list[str] | None = None) -> None:
    """Remove the folders, by default all of :func:`made_folders`.

    Call it when no frame that reads them is in use any more; a lazy frame is read
    after the query that made it has returned, so the library cannot tell.
    """
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in made_folders() if folders is None else folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(configuration).delete(path, True)
        if folder in _made:
            _made.remove(folder)


def cut(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
