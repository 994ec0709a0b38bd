"""Session defaults and the one place that knows where scratch state may live."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Sizes are per task and hold at any cluster size; the number of shuffle partitions is a
# start value that AQE coalesces, so it is set high on a cluster and low in tests.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # The typed projection generates one method of about 29 kB. The JVM never compiles a
    # method above 8 kB, so it would run interpreted; below this limit Spark falls back to
    # its split projection instead, which is four times as fast here.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# settings that change a plan and may still be set on a session that is already running
_RUNTIME = ("spark.sql.codegen.hugeMethodLimit",)


def build_session(app: str, master: str | None = None, **overrides: object) -> SparkSession:
    """A session with the defaults above; ``overrides`` use ``__`` for dots in keys."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): str(v) for k, v in overrides.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key in _RUNTIME:
        spark.conf.set(key, DEFAULTS[key])
    return spark


_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster for state that must outlive an executor.

    Only a session on one machine, as in tests, may do without: it gets a temporary folder
    of its own. A cluster has to name one.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"name a folder that all executors share in {CHECKPOINT_KEY}")
    if context.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="millrace-scratch-")
    return _LOCAL_SCRATCH[context.applicationId]
