"""What a session needs before Python stages of this package run on executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    A cluster then needs no copy of it on its workers; executors that start
    later, or replace a lost one, fetch it from the driver as well.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    home = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tracewell-ship-")
    atexit.register(shutil.rmtree, folder, True)
    name = os.path.join(folder, "tracewell_package.zip")
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(home.rglob("*.py")):
            z.write(path, path.relative_to(home.parent))
    spark.sparkContext.addPyFile(name)
