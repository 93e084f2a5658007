"""Session construction for tests/bench and the shared scratch location.

Library code never builds its own session; it receives one.  The helpers here
are used by tests, ``bench.py`` and the sinks that need a folder every
executor can see.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "weekcast") -> SparkSession:
    """A local session configured like a small cluster (AQE + skew join on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local tables are small: let AQE keep CPU-heavy but byte-light shuffle
        # stages (series windows, packing) on several cores instead of one
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    ship_package(spark)
    return spark


def scale_conf(shuffle_bytes: float, cores: int, partition_bytes: int = 256 << 20,
               broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Session settings sized for the largest shuffle and the cluster.

    ``shuffle_bytes`` is the volume of the biggest exchange, not the input:
    scans prune columns and partial aggregation shrinks most stages.  For
    the weekly table the big exchange is lineitem pruned to 3 of its 11
    columns for the join with part; 100 TB of input gives about 12 TB.

    * shuffle partitions = shuffle_bytes / 256 MB (at least 2 per core); AQE
      coalesces smaller stages at run time.  Sizing from the input instead
      would give ~400k reducers and ~10^10 shuffle blocks to track;
    * file splits of 256 MB keep scan tasks large but within executor memory;
    * AQE skew join splits any shuffle partition 5x over the median and over
      256 MB (a key holding a third of the rows);
    * the broadcast threshold is the size check behind every implicit
      broadcast: above it Catalyst plans a shuffle join instead;
    * Arrow batches of 2,048 rows: a packed series row carries a few
      hundred weeks of values (~10-15 KB), so the default 10,000-row batch
      would hand each Python worker ~130 MB at once.

    For 12 TB of shuffle on 1,000 executors x 8 cores: 49,152 partitions.
    """
    shuffle = max(2 * cores, int(-(-shuffle_bytes // partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    }


def _context(spark: SparkSession):
    """The SparkContext of a classic session; ``None`` under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def shared_dir(spark: SparkSession) -> str:
    """Folder visible to the whole cluster, taken from ``spark.checkpoint.dir``.

    The cluster names the folder; we only read it.  Only a local-mode session
    with nothing configured (tests) gets a fresh folder of its own.
    """
    sc = _context(spark)
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="weekcast-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str, unique: bool = False) -> str:
    """A path below the shared folder for written intermediates and sinks."""
    base = f"{shared_dir(spark)}/weekcast"
    return f"{base}/{name}-{uuid.uuid4().hex[:8]}" if unique else f"{base}/{name}"


def unique_name(name: str) -> str:
    """A table or view name that no other run uses."""
    return f"weekcast_{name}_{uuid.uuid4().hex[:8]}"


def checkpoint(df):
    """Reliable, eager checkpoint into the shared folder (cuts lineage; a lost
    executor does not send the job back to the source scan)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Make ``weekcast`` importable in the executors' Python workers.

    The same as ``--py-files``: zip the package once per driver process and
    ``addPyFile`` it once per application, so functions in Python stages
    unpickle wherever the job was launched from.
    """
    sc = _context(spark)
    app = sc.applicationId if sc is not None else f"connect-{spark.conf.get('spark.app.name', '')}-{id(spark)}"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="weekcast-pkg-"), "weekcast.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED[app] = out
