"""Session helpers.

Library code never hard-codes cluster sizing.  ``session()`` is a
convenience for tests, the bench and local runs: it sets only what is unset,
so a cluster's own configuration (shuffle partitions, adaptive execution,
checkpoint folder, state store) wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every query in this package relies on.
REQUIRED_CONF = {
    # Kickoff parsing and epoch conversions are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
}

# Sensible defaults applied only when the key is unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, app: str = "pricefold", conf: dict | None = None) -> SparkSession:
    """A session with ``conf`` and, for keys that neither it, the submitted
    configuration nor a running session sets, ``DEFAULT_CONF``.  Only the
    session time zone is always set: the date rules are defined in UTC."""
    from pyspark import SparkConf

    active = SparkSession.getActiveSession()
    known = {**dict(SparkConf().getAll()), **(dict(active.sparkContext.getConf().getAll()) if active else {})}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**{k: v for k, v in DEFAULT_CONF.items() if k not in known}, **REQUIRED_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setLogLevel("ERROR")
        checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared filesystem path): unset, it raises.
    On a local master, as in unit tests, a fresh local folder is made for it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        d = tempfile.mkdtemp(prefix="pricefold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def run_dir(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared checkpoint folder for one run.

    Fresh runs never delete anything: each run id gets its own folder.
    """
    import uuid
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pricefold`` importable in executor Python workers.

    Needed only by the paths that run Python on executors (the streaming
    state processor).  The package is zipped once per application on the
    driver and registered with ``addPyFile`` (the same mechanism as
    ``--py-files``), so it reaches every executor, including replacements.
    The zip is a code artifact on the driver that Spark's file server hands
    out; no data is ever written to a machine-local folder.  Deployments
    that submit the package with ``--py-files`` do not need this.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="pricefold-pyfiles-"), "pricefold.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            if "__pycache__" in d:
                continue
            for f in files:
                if f.endswith(".py"):
                    p = os.path.join(d, f)
                    z.write(p, os.path.relpath(p, root))
    sc.addPyFile(out)
    # The driver-side helper process of transformWithState takes PYTHONPATH
    # from the function environment rather than from the added files.
    prev = sc.environment.get("PYTHONPATH")
    sc.environment["PYTHONPATH"] = out if not prev else out + os.pathsep + prev
    _SHIPPED.add(app)
