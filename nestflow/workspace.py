"""Folders for tables written on the way, where all executors can reach them."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path
from threading import Lock

from pyspark.sql import SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where Spark runs in one process."""
    folder = spark.conf.get(SHARED_FOLDER, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_FOLDER} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="nestflow-")
    return _local[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a folder that nothing else uses; the first write makes it."""
    return f"{shared_folder(spark)}/nestflow/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``new_folder``."""
    if not path.startswith(f"{shared_folder(spark)}/nestflow/"):
        raise ValueError(f"{path} was not made by new_folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_shipped: set[str] = set()
_shipping = Lock()


def ship_library(spark: SparkSession) -> None:
    """Give this library to the executors' Python, wherever they are started."""
    context = spark.sparkContext
    with _shipping:
        if context.applicationId in _shipped:
            return
        library = Path(__file__).resolve().parent
        # Executors fetch it from here as long as the application runs.
        folder = Path(tempfile.mkdtemp(prefix="nestflow-"))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = folder / f"{library.name}.zip"
        with zipfile.ZipFile(archive, "w") as file:
            for source in sorted(library.rglob("*.py")):
                file.write(source, source.relative_to(library.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
