"""Conversion in passes, and what each asks of the cluster.

What a pass has made is written, and the next one sees only the rows it is for: documents that ran out of
an accelerator's memory wait for a pass of plain tasks instead of holding that accelerator.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ..functions.settings import DEVICES, PRECISIONS, named


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that driver and executors share (``spark.checkpoint.dir``), if the session names one."""
    return spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that its rows are made once; ``df`` itself where no folder is named."""
    place = shared_folder(df.sparkSession)
    if not place:
        return df
    path = f"{place.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- resources ------------------------------------------------------------------------

#: Settings of a session: names as in ``functions.settings``, and numbers for a task of a conversion.
DEVICE_KEY, PRECISION_KEY, ACCELERATORS_KEY, CORES_KEY = "docengine.device", "docengine.precision", "docengine.accelerators", "docengine.cores"
#: Spark's name of the resource that accelerators are.
RESOURCE = "gpu"


@dataclass(frozen=True)
class Resources:
    """What a task of a conversion asks of the cluster, and what its backend is built with."""

    device: str | None = None
    precision: str | None = None
    accelerators: float = 0
    cores: int = 1

    def profile(self, spark: SparkSession):
        """The profile of the stages that convert, or None where they need no other than the session's.

        A local session has no executors to choose from, so it runs them as they are.
        """
        if (not self.accelerators and self.cores == 1) or spark.sparkContext.master.startswith("local"):
            return None
        from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

        asked = TaskResourceRequests().cpus(self.cores)
        return ResourceProfileBuilder().require(asked.resource(RESOURCE, self.accelerators) if self.accelerators else asked).build

    def on_cpu(self) -> Resources:
        return Resources("cpu", self.precision, 0, self.cores)


def session_resources(spark: SparkSession) -> Resources:
    """Resources of the session's settings; names and numbers that are none are errors before any job."""
    get = lambda k: (spark.conf.get(k, None) or "").strip()
    device, precision = named(get(DEVICE_KEY), DEVICES, "device"), named(get(PRECISION_KEY), {p: p for p in PRECISIONS}, "precision")
    accelerators, cores = float(get(ACCELERATORS_KEY) or 0), int(get(CORES_KEY) or 1)
    if accelerators < 0 or cores < 1:
        raise ValueError(f"{ACCELERATORS_KEY} must not be below 0, {CORES_KEY} not below 1")
    return Resources(None if device == DEVICES["auto"] else device, precision, accelerators, cores)


def task_device(device: str | None) -> str | None:
    """The device of the running task: the accelerator that Spark has given to it, where it has given one and none but that kind is asked for."""
    context = TaskContext.get()
    given = context.resources().get(RESOURCE) if context else None
    if given is None or not given.addresses or device not in (None, DEVICES["cuda"]):
        return device
    return f"{DEVICES['cuda']}:{given.addresses[0]}"
