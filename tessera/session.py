"""Session helpers: a tuned local session, and shipping this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tessera")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors this package's source, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    home = Path(__file__).parent
    to = Path(tempfile.mkdtemp(prefix="tessera-")) / "tessera_source.zip"
    with zipfile.ZipFile(to, "w") as z:
        for path in sorted(home.rglob("*.py")):
            z.write(path, os.path.join("tessera", path.relative_to(home)))
    spark.sparkContext.addPyFile(str(to))
    _SHIPPED.add(app)
