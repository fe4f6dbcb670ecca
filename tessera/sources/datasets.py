"""Named datasets in one folder: chunk tables with their attributes (voxel size, box, chunk size, value type).

A dataset is ``<folder>/<name>/chunks``, partitioned by bz, by, bx, and one row of attributes beside it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.geometry import AXES, Roi
from tessera.sources import volumes

ATTRIBUTES = "voxel array<int>, begin array<bigint>, end array<bigint>, size array<int>, dtype string, channels int"


@dataclass(frozen=True)
class Dataset:
    """A chunk table and what its numbers mean. ``roi`` is in world units, chunk places are in voxels."""

    path: str
    chunks: DataFrame
    voxel: tuple[int, int, int]
    roi: Roi
    size: tuple[int, int, int]
    dtype: str
    channels: int = 1

    def in_box(self, box: Roi) -> DataFrame:
        """Voxel rows of a box in world units."""
        inner = Roi(tuple(b // v for b, v in zip(box.begin, self.voxel)), tuple(-(-e // v) for e, v in zip(box.end, self.voxel)))
        return volumes.read_roi(self.chunks, inner, self.size)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def create(spark: SparkSession, folder: str, name: str, roi: Roi, voxel: tuple[int, int, int], size: tuple[int, int, int], dtype: str = "uint8", channels: int = 1, delete: bool = False) -> Dataset:
    """An empty dataset, or the one that is there if its attributes are the same (else an error); ``delete`` starts anew."""
    path, row = f"{folder.rstrip('/')}/{name}", (list(voxel), list(roi.begin), list(roi.end), list(size), dtype, channels)
    if _exists(spark, f"{path}/attributes") and not delete:
        found = open_dataset(spark, folder, name)
        if (found.voxel, found.size, found.dtype, found.channels) != (voxel, size, dtype, channels) or found.roi.union(roi) != found.roi:
            raise ValueError(f"{path} has other attributes")
        return found
    layout = volumes.CHUNKS + (", channel int" if channels > 1 else "")
    spark.createDataFrame([], layout).write.mode("overwrite").partitionBy("bz", "by", "bx").parquet(f"{path}/chunks")
    spark.createDataFrame([row], ATTRIBUTES).coalesce(1).write.mode("overwrite").parquet(f"{path}/attributes")
    return open_dataset(spark, folder, name)


def open_dataset(spark: SparkSession, folder: str, name: str) -> Dataset:
    """Open by name; a missing dataset is an error."""
    path = f"{folder.rstrip('/')}/{name}"
    if not _exists(spark, f"{path}/attributes"):
        raise FileNotFoundError(path)
    a = spark.read.schema(ATTRIBUTES).parquet(f"{path}/attributes").first()
    layout = volumes.CHUNKS + (", channel int" if a["channels"] > 1 else "")
    chunks = spark.read.schema(layout).parquet(f"{path}/chunks")
    return Dataset(path, chunks, tuple(a["voxel"]), Roi(tuple(a["begin"]), tuple(a["end"])), tuple(a["size"]), a["dtype"], a["channels"])


def write(dataset: Dataset, chunks: DataFrame) -> None:
    """Replace the blocks that ``chunks`` has; others stay."""
    chunks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bz", "by", "bx").parquet(f"{dataset.path}/chunks")


def copy(source: Dataset, spark: SparkSession, folder: str, name: str, channel: int | None = None) -> Dataset:
    """All chunks, or those of one channel, under another name or in another folder."""
    out = create(spark, folder, name, source.roi, source.voxel, source.size, source.dtype, 1 if channel is not None else source.channels, delete=True)
    chunks = source.chunks
    if source.channels > 1 and channel is not None:
        chunks = chunks.filter(F.col("channel") == channel).drop("channel")
    write(out, chunks)
    return open_dataset(spark, folder, name)


def exported(dataset: Dataset) -> DataFrame:
    """Chunks with what an exchange format keeps beside them: resolution and offset in world units."""
    resolution = F.array(*[F.lit(v) for v in dataset.voxel])
    offset = F.array(*[(F.col(a) * v).cast("bigint") for a, v in zip(AXES, dataset.voxel)])
    return dataset.chunks.withColumns({"resolution": resolution, "offset": offset})
