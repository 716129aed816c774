"""Contacts within rows and by the join, tasks of bounded rows, a report that looks for faults once."""

import random

import pytest
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators import contacts, joins, layers, noding, repair, validity
from tests.layer_cases import BOWTIE, SQUARE


def path(rng, n):
    return [(rng.randint(0, 6), rng.randint(0, 6)) for _ in range(n)]


def contacts_of(df):
    return sorted({tuple(r) for r in df.collect()})


@pytest.mark.parametrize("repeated", [False, True])
def test_contacts_in_rows_are_those_of_the_join(make_layer, repeated):
    rng = random.Random(5)
    rows = [(f, "MultiLineString", [[path(rng, rng.randint(2, 7))] for _ in range(rng.randint(1, 3))]) for f in range(40)]
    rows += [(40, "LineString", [[path(rng, 60)]]), (41, "Polygon", [[BOWTIE, SQUARE]])]
    # The two rows of one key meet each other, as they did.
    rows += [(42, "LineString", [[[(0, 0), (2, 2)]]]), (42, "LineString", [[[(5, 5), (0, 2), (2, 0)]]])] * repeated
    df = make_layer(rows).df
    want = contacts_of(contacts.self_contacts(G.explode_segments(df, ["fid"])))
    assert contacts_of(contacts.feature_contacts(df, "fid")) == want and len(want) > 100


def test_short_features_are_not_joined(make_layer):
    layer = make_layer([(1, "LineString", [[[(0, 0), (2, 2), (2, 0), (0, 2)]]]), (2, "LineString", [[[(0, 0), (1, 0)]]])])
    faults = validity.line_faults(layer)
    assert {r["fid"]: r["simple"] for r in faults.collect()} == {1: False, 2: True}
    assert "Join" not in faults._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_a_task_do_not_grow(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    points = spark.range(4000).select(F.floor(F.col("id") / 4).alias("fid"), (F.col("id") % 4).alias("k"))
    shape = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in [(0, 0), (2, 2), (2, 0), (0, 2)]])
    points = points.withColumn("_v", F.get(shape, F.col("k"))).select("fid", "k", "_v.x", "_v.y")
    numbered = layers.path_vertices(points, "fid", ["k"])
    tasks = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) > 30 and sum(tasks) == 4000
    runs, _ = noding.noded_runs(layers.Layer("lines", layers.assemble_paths(numbered), 4326, ("fid", "seq"), frozenset({"line"})))
    tasks = [r["count"] for r in runs.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) > 30 and sum(tasks) == 3000


def test_the_report_looks_for_faults_once(make_layer, monkeypatch):
    calls = []
    monkeypatch.setattr(repair, "with_validity", lambda layer: calls.append(1) or validity.with_validity(layer))
    layer = make_layer([(1, "Polygon", [[BOWTIE]]), (2, "Polygon", [[SQUARE]]), (3, "Polygon", None), (4, "Polygon", []),
                        (5, "LineString", [[[(0, 0), (2, 2), (2, 0), (0, 2)]]])])
    row = repair.repair_report(layer).first()
    assert tuple(row) == ("test", 5, 2, 1, 1, 1.0) and len(calls) == 1
