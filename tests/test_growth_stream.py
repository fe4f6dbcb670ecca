"""The growth server against the batch loop, with crashes."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import rag
from tessera.streaming import growth

pytest.importorskip("google.protobuf")


@pytest.fixture(scope="module")
def graph(spark):
    rng = random.Random(4)
    nodes = spark.createDataFrame([(k, rng.randrange(6)) for k in range(150)], "id bigint, block_id bigint")
    edges = spark.createDataFrame(sorted({(a, b, rng.choice([0.1, 0.2, 0.9])) for a, b in (sorted(rng.sample(range(150), 2)) for _ in range(170))}), "u bigint, v bigint, merge_score double")
    seeds = spark.createDataFrame([(3,), (50,), (149,)], "id bigint")
    want = {r.id for r in rag.grow_loop(nodes, edges, seeds, 0.3).collect()}
    lut, cross = rag.block_segments(nodes, edges, 0.3)
    block = lut.groupBy(F.col("dst").alias("b")).agg(F.first("block_id").alias("block"))
    steps = cross.join(block, "b").select("a", "block", F.col("b").alias("segment"))
    entries = seeds.join(lut, F.col("id") == F.col("src")).select(F.col("block_id").alias("block"), F.col("dst").alias("segment")).distinct()
    return lut, steps, entries, want


def reached(spark, folder, lut):
    found = growth.done(spark, folder)
    assert found.count() == found.select("segment").distinct().count()  # each segment once
    return {r.src for r in lut.join(found.select(F.col("segment").alias("dst")), "dst").select("src").collect()}


def test_server_equals_the_batch_loop(spark, graph, tmp_path):
    lut, steps, entries, want = graph
    folder = f"file://{tmp_path}/a"
    growth.put(entries, folder)
    growth.put(entries, folder)  # entries that come twice
    rounds = growth.drained(spark, folder, steps)
    assert rounds > 2 and reached(spark, folder, lut) == want and len(want) > 30
    assert growth.drained(spark, folder, steps) == 0


def test_a_stream_that_dies_goes_on_where_it_was(spark, graph, tmp_path, monkeypatch):
    """Batches fail before, between and after their two writes; what they wrote is replaced, nothing is done twice or left out."""
    lut, steps, entries, want = graph
    folder = f"file://{tmp_path}/b"
    growth.put(entries, folder)

    class Failing:
        def __init__(self, df, after):
            self.df, self.after = df, after

        def join(self, *a):
            if self.after == 0:
                raise RuntimeError("died")
            self.after -= 1
            return self.df.join(*a)

    deaths = 0
    for k in (0, 0, 1, 0):
        query = growth.server(spark, folder, Failing(steps, k))
        try:
            query.awaitTermination()
        except Exception:
            deaths += 1
    assert deaths >= 2
    growth.drained(spark, folder, steps)
    assert reached(spark, folder, lut) == want
