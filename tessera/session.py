"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only by a local master whose session names no folder of its own (tests, a laptop).
LOCAL_SCRATCH = "file:///tmp/checkpoints"


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tessera")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a folder under /tmp only where that is unset and all tasks run in this process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (shared or LOCAL_SCRATCH).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{scratch_root(spark)}/tessera/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors. ``options`` are the writer's."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def counted(df: DataFrame, name: str, *columns: str, **options: str) -> tuple[DataFrame, int, int | None]:
    """``materialize`` with the number of rows and an order-free checksum of some columns, taken while they are written."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    sums = [F.count(F.lit(1)).alias("n"), *([F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("s")] if columns else [])]
    table = materialize(df.observe(seen, *sums), name, **options)
    return table, seen.get["n"], seen.get.get("s")


def drop_table(*tables: DataFrame) -> None:
    """Delete the folders of frames that materialize() returned, once nothing reads them any more."""
    for df in tables:
        folder = getattr(df, "_scratch", None)
        if folder is not None:
            context = df.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless they find it on their own path."""
    import os
    import pathlib
    import tempfile
    import zipfile

    root = pathlib.Path(__file__).resolve().parent.parent
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    context = spark.sparkContext
    if str(root) in {os.path.realpath(p) for p in known if p} or getattr(context, "_tessera_shipped", False):
        return
    archive = pathlib.Path(tempfile.mkdtemp()) / "tessera.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "tessera").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    context._tessera_shipped = True
