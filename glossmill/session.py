"""Session defaults, table access and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "glossmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` overrides by key."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
    }
    return b.config(map={**base, **conf}).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A table's rows over all cores, where its files are fewer: for what costs more per row than moving it.

    Only for scans with filters and projections, whose partitions are known
    without running anything; tables of many files stay as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan._jdf.queryExecution().toRdd().getNumPartitions() >= cores else scan.repartition(cores)


#: Batches have 10,000 rows at most by default; of long texts that alone is no bound.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application, and bound their Arrow batches by bytes."""
    sc = spark.sparkContext
    if sc.getConf().get(BATCH_BYTES) is None:
        spark.conf.set(BATCH_BYTES, "64m")
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = pathlib.Path(__file__).resolve().parent
    to = pathlib.Path(tempfile.mkdtemp(prefix="glossmill-")) / "glossmill_package.zip"
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"glossmill/{f.relative_to(root)}")
    sc.addPyFile(str(to))


_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset a folder of this machine is used in local mode; on a cluster
    that is an error, since its executors could not share one.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="glossmill-"))
    return _LOCAL[0]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed with all that is in it when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage with files that outlive any executor; the table is removed
    when the driver ends.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
