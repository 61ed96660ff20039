"""Send this package to the executors, for sessions whose executors don't have it installed."""

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Once per application: the sources, as one small zip file that Spark hands out."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    path = Path(tempfile.mkdtemp(prefix="gridclimate-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(PACKAGE.rglob("*.py")):
            archive.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(path))
    _sent.add(context.applicationId)
