"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# What results depend on.
_MEANING = {
    # Every timestamp in the feeds is UTC; a zone-dependent session would move service days.
    "spark.sql.session.timeZone": "UTC",
    # Strict casts fail; the lenient ones say so with try_cast.
    "spark.sql.ansi.enabled": "true",
}

# What only plans depend on: defaults of a session built here, the caller's own business elsewhere.
_PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Exploding and parsing cost more than their few input bytes suggest: keep smaller tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # File sizes are of compressed columns; only what is small even unpacked is broadcast on that
    # estimate. Sizes measured at run time are trusted further: a city's trip ids are tens of MB.
    "spark.sql.autoBroadcastJoinThreshold": "2m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # Hot trips, NULL trip ids and busy snapshots are split at run time, even where the rows
    # then have to be shuffled once more for the grouping that follows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to a session somebody else created."""
    for key, value in _MEANING.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "fleetgauge", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        # Recording the caller of every column expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**_MEANING, **_PLANNING, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own; a cluster session
    without it is refused, since a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="fleetgauge-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What the steps return. They run side by side, since the jobs of one alone leave cores idle at their ends.

    Their jobs belong to whatever the caller's jobs belong to. All have ended when an error of one is raised.
    """

    def own(step: Callable[[], object]) -> Callable[[], object]:
        # With a copy of the caller's properties for each; where threads are not pinned, the session itself comes back.
        wrap = inheritable_thread_target(spark)
        return step if wrap is spark else wrap(step)

    with ThreadPoolExecutor(len(steps)) as pool:
        begun = [pool.submit(own(step)) for step in steps]
    return [step.result() for step in begun]
