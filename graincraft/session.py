"""Sessions: the settings the operators expect, and shipping this package to the executors' Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    b = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as Python workers import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = Path(__file__).resolve().parent
    at = os.path.join(tempfile.mkdtemp(prefix="graincraft_"), "graincraft.zip")
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, Path("graincraft") / p.relative_to(here))
    spark.sparkContext.addPyFile(at)
    _shipped.add(app)
