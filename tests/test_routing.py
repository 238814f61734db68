import random

import pytest
from pyspark.sql import functions as F

from eclusa.operators import routing
from eclusa.operators.routing import route

SCHEMA = "prefixo string, dataset_id string, ordem struct<arquivo: string, linha: bigint>"
WAYS = [
    {"inline": 1000},
    {"inline": -1},
    {"inline": -1, "collect_bytes": -1},
    {"inline": -1, "collect_bytes": -1, "broadcast_bytes": -1},
]


def control_of(spark, prefixes):
    rows = [(p, f"d{i}", ("c.csv", i)) for i, p in enumerate(prefixes)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute_force(key, prefixes):
    if key is None:
        return None
    return next((f"d{i}" for i, p in enumerate(prefixes) if p in key), None)


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("blank", [False, True])
def test_equals_brute_force(spark, way, blank):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("ab/é%_\\'") for _ in range(n))
    prefixes = [text(rng.randint(2, 6)) for _ in range(80)]
    prefixes += prefixes[:10]
    if blank:
        prefixes.insert(40, "")
    keys = [text(rng.randint(0, 12)) for _ in range(600)] + [None, "", "ab"] * 20
    arrivals = spark.createDataFrame(list(enumerate(keys)), "id int, key string")
    found = route(arrivals, control_of(spark, prefixes), **way)
    assert found.columns == ["id", "key", "dataset_id", "prefixo"]
    got = {r["id"]: r["dataset_id"] for r in found.collect()}
    assert got == {i: brute_force(k, prefixes) for i, k in enumerate(keys)}
    assert None in got.values() and len(set(got.values())) > 10


@pytest.mark.parametrize("way", WAYS)
def test_hot_key_keeps_every_arrival(spark, way):
    arrivals = spark.range(9000).selectExpr(
        "id", "if(id < 3000, 'in/hot/x', concat('in/', id, '/x')) as key"
    )
    found = route(arrivals, control_of(spark, ["/hot/", "/8", "zz"]), **way)
    assert found.count() == 9000
    assert found.filter("dataset_id = 'd0'").count() == 3000
    starts_with_8 = sum(1 for i in range(3000, 9000) if str(i).startswith("8"))
    assert found.filter("dataset_id = 'd1'").count() == starts_with_8


@pytest.mark.parametrize("way", WAYS)
def test_empty_control(spark, way):
    arrivals = spark.createDataFrame([("a",)], "key string")
    assert route(arrivals, control_of(spark, []), **way).head()["dataset_id"] is None


@pytest.mark.parametrize("way", WAYS)
def test_only_a_blank_prefix(spark, way):
    arrivals = spark.createDataFrame([("a",), (None,)], "key string")
    found = route(arrivals, control_of(spark, [""]), **way)
    assert {r["key"]: r["dataset_id"] for r in found.collect()} == {"a": "d0", None: None}


def plan_of(capsys, df):
    df.explain()
    return capsys.readouterr().out


def test_plans(spark, capsys):
    arrivals = spark.range(10).selectExpr("cast(id as string) as key")
    control = control_of(spark, ["1", "2"])
    inline, collected, broadcast, shuffled = (plan_of(capsys, route(arrivals, control, **way)) for way in WAYS)
    assert "Join" not in inline and "Exchange" not in inline
    assert "Python" not in inline + broadcast + shuffled
    # One shuffle of the arrivals, before their pieces are made; none of the hits.
    assert collected.count("Exchange hashpartitioning") == 1 and "hashpartitioning(_numero" in collected
    for plan in (collected, broadcast):
        assert "BroadcastHashJoin [xxhash64(" in plan
    assert "SortMergeJoin [xxhash64(" in shuffled
    assert "NestedLoop" not in collected + broadcast + shuffled


def test_prefixes_that_begin_or_end_alike(spark):
    """Their pieces are those that tell them apart, so that a key meets few of them."""
    prefixes = [f"landing/area/{i:04}" for i in range(300)] + [f"{i:04}/daily/full" for i in range(300)]
    control = control_of(spark, prefixes)
    for index in (routing._index(control), routing._collected_index(spark, [(p, "d") for p in prefixes])):
        most = index.groupBy("size", "piece").count().agg({"count": "max"}).head()[0]
        assert index.count() == 600 and most <= 1


def test_large_control_shuffles_few_pieces(spark, capsys):
    days = [f"dt={y}-{m:02}-{d:02}/" for y in (2021, 2022) for m in range(1, 13) for d in range(1, 29)]
    keys = [f"landing/{i % 5}-LOW/{days[i % 600]}{i}" for i in range(2000) if i % 600 < len(days)]
    arrivals = spark.createDataFrame([(k, k.encode()) for k in keys], "_key string, _bytes binary")
    index = routing._index(control_of(spark, days))
    pieces = routing._pieces(arrivals, [8]).withColumn("_piece", routing._piece(F.col("_bytes"), F.col("_at"), F.lit(8)))
    likely = routing._likely(pieces, index, len(days)).select("_key", "_piece").collect()
    there = {r[0] for r in index.select("piece").collect()}
    assert sum(r[1] in there for r in likely) == pieces.join(index, F.col("_piece") == F.col("piece"), "semi").count()
    assert len({r[0] for r in likely if r[1] in there}) == len(keys)
    assert len(likely) < 3 * len(keys) < pieces.count() / 8
    route(arrivals.selectExpr("_key as key"), control_of(spark, days), "key", -1, -1, -1).explain()
    plan = capsys.readouterr().out
    assert plan.index("LeftSemi") > plan.index("SortMergeJoin [xxhash64(")


@pytest.mark.parametrize("spans", [0, 1024])
def test_a_full_filter_loses_nothing(spark, monkeypatch, spans):
    monkeypatch.setattr(routing, "FILTER_BYTES", spans)
    monkeypatch.setattr(routing, "FILTER_BITS", 1)
    prefixes = [f"/{i:04}/" for i in range(3000)]
    keys = [f"in/{i:04}/x" for i in range(4000)]
    arrivals = spark.createDataFrame([(k,) for k in keys], "key string")
    found = route(arrivals, control_of(spark, prefixes), inline=-1, collect_bytes=-1, broadcast_bytes=-1)
    got = {r["key"]: r["dataset_id"] for r in found.collect()}
    assert got == {k: f"d{i}" if i < 3000 else None for i, k in enumerate(keys)}
