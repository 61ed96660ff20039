"""Where intermediate tables go."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder the cluster shares, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting and gets a temporary folder of this machine.
    On a cluster each executor would write to its own disk, so there a missing setting raises.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/gridclimate-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="gridclimate-")
    raise ValueError(f"set spark.checkpoint.dir to a folder that all of {master} share")
