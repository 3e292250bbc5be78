"""Session helpers: sensible settings, code shipping and durable lineage cuts."""

from __future__ import annotations

import contextlib
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

PACKAGE_DIR = pathlib.Path(__file__).resolve().parent


def local_session(cores: int | str = 8, app: str = "parcelweave") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers, whatever path the driver loaded it from."""
    sc = spark.sparkContext
    if getattr(sc, "_parcelweave_shipped", False):
        return spark
    target = pathlib.Path(tempfile.mkdtemp(prefix="spark-")) / "parcelweave.zip"
    with zipfile.ZipFile(target, "w") as bundle:
        for path in sorted(PACKAGE_DIR.rglob("*.py")):
            bundle.write(path, pathlib.Path("parcelweave") / path.relative_to(PACKAGE_DIR))
    sc.addPyFile(str(target))
    sc._parcelweave_shipped = True
    # The JIT leaves methods above 8000 bytes of bytecode interpreted; wide geometry stages do
    # better without whole-stage fusion than inside one such method.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # Walks along parents visit as many rows as there are features.
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it; a fresh local one where unset and the
    master is a single machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # Unset, as in tests on one machine.  The setting is fixed at start-up, so remember ours here.
    if not hasattr(sc, "_parcelweave_shared"):
        sc._parcelweave_shared = tempfile.mkdtemp(prefix="spark-")
    return sc._parcelweave_shared


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Writes started inside leave no shuffle files behind.  For frames that are written once: what else is
    built on them is planned anew anyway, so the files would only fill the executors' disks until the driver's
    next garbage collection."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut_lineage(df: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that loops keep flat plans and a
    lost executor costs no recomputation.

    ``replaces`` is an earlier result of this function that is no longer needed: its files go away
    once the new ones are complete.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/parcelweave-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    written = _scratch_paths(spark)
    written.append(path)
    if replaces is not None and getattr(replaces, "_scratch_path", None) in written:
        _delete(spark, replaces._scratch_path)
        written.remove(replaces._scratch_path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that :func:`drop_scratch` deletes; ``name`` must be unused."""
    path = f"{shared_dir(spark).rstrip('/')}/parcelweave-{name}"
    _scratch_paths(spark).append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete every table this session wrote through :func:`cut_lineage` (results built on them
    must have been written by then)."""
    for path in _scratch_paths(spark):
        _delete(spark, path)
    _scratch_paths(spark).clear()


def _scratch_paths(spark: SparkSession) -> list[str]:
    sc = spark.sparkContext
    if not hasattr(sc, "_parcelweave_scratch"):
        sc._parcelweave_scratch = []
    return sc._parcelweave_scratch


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Redistribute rows after a fan-out (one area exploded into many cells), so that the kernel work
    of one huge input row is shared by all tasks instead of staying where the row was read."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
