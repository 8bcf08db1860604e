"""Session helpers: the configuration every tillguard job assumes."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

#: Settings the operators rely on.  Timestamps are UTC instants; ANSI mode
#: stays on (so division guards are explicit); AQE re-plans shuffles.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # wide single-pass aggregates (e.g. all feature-pair correlations) keep
    # whole-stage codegen; Spark still falls back if the code gets too big
    "spark.sql.codegen.maxFields": "400",
}


def builder(master: str | None = None, shuffle_partitions: int | None = None,
            app_name: str = "tillguard") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.ui.enabled", "false")
    # reliable checkpoints of dropped DataFrames are deleted by the cleaner
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    b = b.config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b


def local_session(cores: int = 8, shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """Session for tests and local benchmarks."""
    spark = (builder(f"local[{cores}]", shuffle_partitions)
             .config("spark.driver.memory", driver_memory)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of ENGINE_CONF to an existing session."""
    for k, v in ENGINE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked conf: keep the cluster's value
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to a shared file system and is
    used as is.  Only when it is unset (tests, local runs) do we set one.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = os.path.join(tempfile.gettempdir(), "tillguard-checkpoints")
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that
    Python tasks can import it whatever their working directory."""
    sc = spark.sparkContext
    if getattr(sc, "_tillguard_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tillguard-"), "tillguard"), "zip",
                                  os.path.dirname(root), os.path.basename(root))
    sc.addPyFile(archive)
    sc._tillguard_shipped = True


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir (for written intermediate tables
    and streaming checkpoints)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df):
    """Reliable checkpoint (lineage cut, files in the shared checkpoint dir)
    computed once: persisted first, so the checkpoint write does not
    recompute the plan, then unpersisted."""
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def hash_sample(df, fraction: float, seed: int, cols=None):
    """Deterministic Bernoulli sample: a row is kept by a hash of its values,
    so a recomputed partition (e.g. after executor loss) keeps the same rows
    whatever their order."""
    from pyspark.sql import functions as F

    if fraction >= 1.0:
        return df
    cols = list(cols or df.columns)
    u = F.pmod(F.xxhash64(*[F.col(c) for c in cols], F.lit(seed)), F.lit(1 << 30)).cast("double") / float(1 << 30)
    return df.filter(u < F.lit(float(fraction)))
