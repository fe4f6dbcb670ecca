"""Sinks: look-up tables, synapse exchange rows, edge files, error reports, tile images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.geometry import Roi, threshold_key

#: Databases that are never dropped.
PROTECTED = ("default", "information_schema", "sys")


def write_lut(lut: DataFrame, path: str, kind: str, merge_fn: str, threshold: float) -> None:
    """(block_id, src, dst) under kind / merge_fn / threshold / block partitions; those partitions are replaced."""
    rows = lut.select(F.lit(kind).alias("kind"), F.lit(merge_fn).alias("merge_fn"), F.lit(threshold_key(threshold)).alias("threshold"), "block_id", "src", "dst")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("kind", "merge_fn", "threshold", "block_id").parquet(path)


def read_lut(spark: SparkSession, path: str, kind: str, merge_fn: str, threshold: float, blocks: list[int] | None = None) -> DataFrame:
    """A table written by ``write_lut``; kind, function, threshold and blocks prune partitions. Blocks or a folder that are not there give no rows."""
    from tessera.sources.datasets import _exists

    if not _exists(spark, path):
        return spark.createDataFrame([], "block_id bigint, src bigint, dst bigint")
    rows = spark.read.parquet(path).filter((F.col("kind") == kind) & (F.col("merge_fn") == merge_fn) & (F.col("threshold") == threshold_key(threshold)))
    return (rows if blocks is None else rows.filter(F.col("block_id").isin(blocks))).select("block_id", "src", "dst")


def write_block(voxels: DataFrame, path: str, write: Roi, size: tuple[int, int, int]) -> None:
    """Crop read boxes to the write box and replace its blocks."""
    keys = [F.floor(F.col(a) / F.lit(n)).cast("bigint").alias(f"b{a}") for a, n in zip("zyx", size)]
    cropped = voxels.filter(write.contains()).select("*", *keys)
    cropped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bz", "by", "bx").parquet(path)


def exchange_rows(synapses: DataFrame) -> DataFrame:
    """(site_id, partner_id, type, z, y, x): two rows a synapse, presynaptic 2 i and postsynaptic 2 i + 1, i by id order from 0."""
    from tessera.operators.relabel import compact_labels

    numbered = synapses.join(compact_labels(synapses, "id", 0).withColumnRenamed("label", "id"), "id")
    ends = F.array(*[F.struct(F.lit(t).alias("type"), *[F.col(f"{p}_{a}").alias(a) for a in "zyx"]) for t, p in (("presynaptic_site", "pre"), ("postsynaptic_site", "post"))])
    sites = numbered.select("compact", F.posexplode(ends).alias("k", "s"))
    return sites.select((F.col("compact") * 2 + F.col("k")).alias("site_id"), (F.col("compact") * 2 + 1 - F.col("k")).alias("partner_id"), "s.type", "s.z", "s.y", "s.x")


def write_edges_csv(edges: DataFrame, path: str) -> None:
    """Edge rows with arrays as JSON text."""
    text = [F.to_json(c).alias(c) if t.startswith("array") else F.col(c) for c, t in edges.dtypes]
    edges.select(*text).write.mode("overwrite").option("header", True).csv(path)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def graph_json(edges: DataFrame) -> DataFrame:
    """One JSON text a row."""
    return edges.select(F.to_json(F.struct("*")).alias("value"))


def error_report(splits: DataFrame, merges: DataFrame) -> DataFrame:
    """Split errors (u, v, error_type) and merge sites (a, b) in one table of lines."""
    return splits.select("error_type", F.col("u").alias("node_a"), F.col("v").alias("node_b")).union(merges.select(F.lit("merge"), "a", "b"))


def write_error_report(splits: DataFrame, merges: DataFrame, path: str) -> None:
    """The error table as CSV under ``csv`` and as lines of text under ``txt``."""
    rows = error_report(splits, merges)
    rows.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    line = F.concat_ws(" ", "error_type", F.lit("between"), "node_a", F.lit("and"), "node_b")
    rows.select(line.alias("value")).write.mode("overwrite").text(f"{path}/txt")


def match_lists(truth: DataFrame, found: DataFrame, met: DataFrame) -> DataFrame:
    """(kind, u, v, pre_label, post_label, matches): a line for each true site (tp with its predictions, fn) and each prediction that nothing met (fp)."""
    hits = met.groupBy(F.col("gt_u").alias("u"), F.col("gt_v").alias("v")).agg(F.sort_array(F.collect_set(F.struct("pred_u", "pred_v"))).alias("matches"))
    keys = ["u", "v", "pre_label", "post_label"]
    of_truth = truth.select(*keys).join(hits, ["u", "v"], "left").select(F.when(F.col("matches").isNull(), "fn").otherwise("tp").alias("kind"), *keys, F.to_json("matches").alias("matches"))
    used = met.select(F.col("pred_u").alias("u"), F.col("pred_v").alias("v")).distinct()
    return of_truth.union(found.select(*keys).join(used, ["u", "v"], "left_anti").select(F.lit("fp"), *keys, F.lit(None).cast("string")))


def problem_fragments(fragments: DataFrame, path: str, column: str = "id") -> None:
    """Distinct fragment ids as JSON rows with the id as text."""
    fragments.select(F.col(column).cast("string").alias("id")).distinct().write.mode("overwrite").json(path)


def match_report(truth: DataFrame, found: DataFrame, met: DataFrame) -> DataFrame:
    """(pre_label, post_label, n_gt, n_tp, n_fn, n_fp): one line a cell pair."""
    hit = truth.join(met.select(F.col("gt_u").alias("u"), F.col("gt_v").alias("v")).distinct().withColumn("hit", F.lit(1)), ["u", "v"], "left")
    used = found.join(met.select(F.col("pred_u").alias("u"), F.col("pred_v").alias("v")).distinct(), ["u", "v"], "left_anti")
    keys = ["pre_label", "post_label"]
    of_truth = hit.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_gt"), F.count("hit").alias("n_tp"))
    of_found = used.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_fp"))
    both = of_truth.join(of_found, keys, "full_outer").fillna(0, ["n_gt", "n_tp", "n_fp"])
    return both.select(*keys, "n_gt", "n_tp", (F.col("n_gt") - F.col("n_tp")).alias("n_fn"), "n_fp")


def mesh_blobs(faces: DataFrame, least: int = 1) -> DataFrame:
    """(label, n_faces, vertices, triangles): the open voxel faces of each label as float32 and uint32 bytes, two triangles a face."""
    import numpy as np

    def run(rows):
        import pandas as pd

        axis = rows.axis.map({"z": 0, "y": 1, "x": 2}).to_numpy()
        base = rows[["z", "y", "x"]].to_numpy(np.float32)
        high = (rows.side == "high").to_numpy()
        base[np.arange(len(rows)), axis] += high
        corners = np.repeat(base[:, None, :], 4, axis=1)
        one, two = (axis + 1) % 3, (axis + 2) % 3
        every = np.arange(len(rows))
        for k, (a, b) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1))):
            corners[every, k, one] += a
            corners[every, k, two] += b
        quads = np.arange(4 * len(rows), dtype=np.uint32).reshape(-1, 4)
        quads = np.where(high[:, None], quads, quads[:, ::-1])
        triangles = np.concatenate([quads[:, [0, 1, 2]], quads[:, [0, 2, 3]]], axis=1)
        return pd.DataFrame([[int(rows.label.iloc[0]), len(rows), corners.astype("<f4").tobytes(), triangles.astype("<u4").tobytes()]], columns=["label", "n_faces", "vertices", "triangles"])

    enough = faces.groupBy("label").count().filter(F.col("count") >= least).select("label")
    return faces.join(enough, "label", "left_semi").groupBy("label").applyInPandas(run, "label bigint, n_faces bigint, vertices binary, triangles binary")


def mesh_obj(blobs: DataFrame, base: int = 10, digits: int = 3) -> DataFrame:
    """(label, path, obj): each mesh as OBJ text, and a folder path by the digits of its label."""
    import numpy as np

    from tessera.geometry import base_path

    def run(stream):
        for rows in stream:
            texts = []
            for v, t in zip(rows.vertices, rows.triangles):
                points, corners = np.frombuffer(v, "<f4").reshape(-1, 3), np.frombuffer(t, "<u4").reshape(-1, 3) + 1
                texts.append("\n".join([*(f"v {x:g} {y:g} {z:g}" for z, y, x in points), *(f"f {a} {b} {c}" for a, b, c in corners), ""]))
            yield rows[["label", "path"]].assign(obj=texts)

    return blobs.select("label", base_path(F.col("label"), base, digits).alias("path"), "vertices", "triangles").mapInPandas(run, "label bigint, path string, obj string")


def tiff(values) -> bytes:
    """Grey pixels of 8 or 16 bits as a baseline TIFF of one strip."""
    import struct

    height, width = values.shape
    data = values.astype("<u2" if values.dtype.itemsize == 2 else "u1").tobytes()
    tags = [(256, 4, width), (257, 4, height), (258, 3, 8 * len(data) // max(1, values.size)), (259, 3, 1), (262, 3, 1), (273, 4, 8), (277, 3, 1), (278, 4, height), (279, 4, len(data))]
    table_ = struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", tag, kind, 1, value) for tag, kind, value in tags) + struct.pack("<I", 0)
    pad = b"\0" * (len(data) % 2)
    return b"II" + struct.pack("<HI", 42, 8 + len(data) + len(pad)) + data + pad + table_


def tile_images(voxels: DataFrame, tile: int, form: str = "pgm", plane: str = "xy") -> DataFrame:
    """(z, row, column, image): sections cut to tile x tile grey images, as ``pgm`` or ``tiff``.

    ``plane`` xz or yz cuts along another axis: the rows' z is then the place on that axis.
    """
    import numpy as np

    depth, down, across = {"xy": ("z", "y", "x"), "xz": ("y", "z", "x"), "yz": ("x", "z", "y")}[plane]
    voxels = voxels.select(F.col(depth).alias("z"), F.col(down).alias("y"), F.col(across).alias("x"), "value")

    def run(key, rows):
        import pandas as pd

        z, row, column = (int(k) for k in key)
        data = np.zeros((tile, tile), np.uint8)
        data[(rows.y - row * tile).to_numpy(), (rows.x - column * tile).to_numpy()] = rows.value.to_numpy()
        image = tiff(data) if form == "tiff" else b"P5 %d %d 255\n" % (tile, tile) + data.tobytes()
        return pd.DataFrame([[z, row, column, image]], columns=["z", "row", "column", "image"])

    keys = [F.floor(F.col(a) / F.lit(tile)).cast("bigint").alias(n) for a, n in (("y", "row"), ("x", "column"))]
    return voxels.select("z", "y", "x", "value", *keys).groupBy("z", "row", "column").applyInPandas(run, "z bigint, row bigint, column bigint, image binary")


def databases(spark: SparkSession, pattern: str = "*") -> DataFrame:
    """(name): the databases of the catalogue."""
    return spark.sql(f"SHOW DATABASES LIKE '{pattern}'").toDF("name")


def drop_database(spark: SparkSession, name: str, protected: tuple[str, ...] = PROTECTED) -> None:
    """Drop a database of tables unless it is protected."""
    if name in protected:
        raise ValueError(f"{name} is protected")
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
