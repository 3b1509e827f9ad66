"""Shapes of plans and arrays that keep a query within its limits when its tables grow."""

import re

import numpy as np
from pyspark.sql import functions as F

from peakloom.operators import links, nulls, regulons


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrichment_null_broadcasts_no_list(spark):
    items = spark.range(60).selectExpr("id as item", "cast(id % 7 as double) as weight")
    got = nulls.enrichment_null(items, items.selectExpr("item % 3 as set", "item"), 4)
    assert not re.search(r"BroadcastHashJoin \[(item|weight)#", _plan(got))
    assert got.count() == 3


def test_anchors_look_at_starts_near_by(spark):
    """Transcripts of one start are one site, and the nearest of many starts, in clusters and far apart, is found."""
    starts = [(f"t{t}", i, s) for t in range(3) for i, s in enumerate([*range(0, 3000, 37), 10**6, 10**6, 10**6 + 5, 2 * 10**6, *[500] * 40])]
    sites = spark.createDataFrame(starts, "target string, row_idx int, tss bigint")
    assert max(r["n"] for r in links._grid(sites).select(F.size("_sites").alias("n")).collect()) == 86  # not 125
    rows = [(f"t{i % 4}", f"chr1:{i * 7919 % 2_100_000}-{i * 7919 % 2_100_000 + 501}", f"[{i * 104_729 % 900_000 - 450_000}]") for i in range(300)]
    got = links.anchors(spark.createDataFrame(rows, "target string, region string, distance string"), sites).collect()
    assert len(got) == 300
    want = {}
    for t, region, d in rows:
        mid, d = int(region.split(":")[1].split("-")[0]) + 250, abs(int(d[1:-1]))
        want[t, region] = min(((abs(abs(s - mid) - d), i, s) for u, i, s in starts if u == t), default=(None, None, mid - d))
    assert all((r["err"], r["anchor"]) == (want[r["target"], r["region"]][0], want[r["target"], r["region"]][2]) for r in got)


def test_interact_export_anchors_its_rows_only(spark):
    from peakloom import catalog_guards

    plan = _plan(catalog_guards.interact_export(spark, "/root/testdata/sf0.001"))
    assert plan.count("lineitem.parquet") == 1  # links are made once, and only those that are written get an anchor


def test_search_space_of_sites_that_share_a_span(spark, tmp_path):
    """Sites 6000 apart share chromosome and start: each has its peaks once."""
    from peakloom import catalog

    spark.createDataFrame([(k,) for k in (1, 6001, 12001)], "s_suppkey bigint").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(5, 37, 24, 1), (7, 38, 24, 1)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int").selectExpr("l_orderkey", "l_partkey", "l_suppkey + 1 as l_suppkey", "l_linenumber").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted((r["site_id"], r["start"]) for r in catalog.search_space(spark, str(tmp_path)).collect())
    assert got == [(k, s) for k in (1, 6001, 12001) for s in (37005, 38007)]


def test_differential_of_equal_scores_is_undefined(spark):
    scores = [("flat", r, 5.0) for r in range(40)] + [("some", r, float(r % 20)) for r in range(40)]
    sets = spark.createDataFrame([(0, r) for r in range(0, 40, 2)], "set int, region int")
    regions = spark.createDataFrame([(r, r % 3 == 0) for r in range(40)], "region int, is_promoter boolean")
    got = {x["motif"]: x for x in regulons.differential(spark.createDataFrame(scores, "motif string, region int, score double"), sets, regions, 20).collect()}
    flat, some = got["flat"], got["some"]
    assert str(flat["z"]) == str(flat["p"]) == "nan" and flat["q"] == 1
    assert abs(some["q"] - min(1, 2 * some["p"])) < 1e-12  # of two tests


def test_cistromes_multiply_hits_last(spark):
    """A factor of several motifs has a region once, and no row of factors is shuffled."""
    df = spark.createDataFrame
    hits = df([("a", 1), ("b", 1), ("b", 2), ("b", 2), ("c", 3)], "motif string, region int")
    named = df([(m, tf, "direct", 0.0, 0.0) for m, tf in (("a", "x"), ("b", "x"), ("b", "x"), ("b", "y"), ("c", "z"))], "motif string, tf string, kind string, fdr double, identity double")
    x = regulons.cistromes(hits, named, df([("x",), ("y",)], "tf string"))
    assert sorted((r["tf"], r["region"]) for r in x.collect()) == [("x", 1), ("x", 2), ("y", 1), ("y", 2)]
    assert not re.search(r"hashpartitioning\(tf#\d+, kind#\d+, region", _plan(x))
    links = df([("t1", 1, "+"), ("t2", 1, "+"), ("t1", 2, "+"), ("t1", 2, "-")], "target string, region int, sign string")
    got = {(r["tf"], r["sign"]): (r["n_regions"], r["n_targets"]) for r in regulons.assemble(x, links, 1).collect()}
    assert got == {("x", "+"): (2, 2), ("x", "-"): (1, 1), ("y", "+"): (2, 2), ("y", "-"): (1, 1)}


def test_three_spellings_in_one_pass(spark):
    from peakloom.sources import tables

    names = ["chr1:5-9", "chr-1-5-9", "chr1:5:9", "HLA-DRB1-5-9", "gene5", "chr1:5", "a:b:1-2", "a\n1\n2", "x\ny:1-2", ":1-2", "chr1:5-99999999999999999999", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = df.select(tables.three_spellings(F.col("name")).alias("p"))
    assert _plan(got).count("regexp_extract") == 0
    want = [("chr1", 5, 9), ("chr-1", 5, 9), ("chr1", 5, 9), ("HLA-DRB1", 5, 9), None, None, None, None, ("x\ny", 1, 2), None, ("chr1", 5, None), None]
    assert [r["p"] and tuple(r["p"]) for r in got.collect()] == want


def test_decoy_sums_are_dealt_first(spark):
    """No task sums, before a shuffle, rows that sets have multiplied."""
    from peakloom import catalog

    assert "REPARTITION_BY_COL" in _plan(catalog.decoy_null(spark, "/root/testdata/sf0.001"))


def test_nearest_in_blocks(spark):
    """Blocks are few anchors by few references, and what they leave is what all pairs give: ties by id, no numbers last."""
    from peakloom.operators import pairing

    rows = [(g, i, [float((i * 7 + g) % 11 - 5), float(i * 13 % 7 - 3), 1.0]) for g in (1, 2) for i in range(200)]
    odd = [(1, 200, None), (1, 201, [1.0, None, 2.0]), (1, 202, [1.0, 2.0]), (1, 203, [float("nan"), 0.0, 1.0]), (1, 204, [0.0, 0.0, 0.0]), (3, 300, [1.0, 0.0, 0.0]), (3, 301, None)]
    z = spark.createDataFrame(rows + odd, "grp int, obs_id bigint, z array<double>")
    for k, most in ((5, (3, 17)), (5, (1024, 4096)), (300, (3, 17))):
        got = [(r["grp"], r["anchor"], r["rank"], r["obs_id"], r["dist"]) for r in pairing.nearest(z.where("obs_id % 10 = 0"), z, k, *most).collect()]
        want = []
        for g, a, u in rows + odd:
            if a % 10:
                continue
            far = []
            for h, i, v in rows + odd:
                if h == g:
                    if u is None or v is None or None in v or len(u) != len(v):
                        far.append((4, i, None))
                        continue
                    norm = (sum(x * x for x in u) or 1) ** 0.5 * (sum(x * x for x in v) or 1) ** 0.5
                    d = round(1 - sum(x * y for x, y in zip(u, v, strict=True)) / norm, 9) + 0.0
                    far.append((3, i, "nan") if d != d else (d, i, d))
            want += [(g, a, n + 1, i, d) for n, (_, i, d) in enumerate(sorted(far, key=lambda x: x[:2])[:k])]
        assert sorted((*x[:4], "nan" if x[4] != x[4] else x[4]) for x in got if x[4] is not None) == sorted(x for x in want if x[4] is not None)
        assert sorted(x[:4] for x in got) == sorted(x[:4] for x in want)


def test_pairing_diagnostics_search_once(spark):
    from peakloom import catalog

    plan = _plan(catalog.pairing_diag(spark, "/root/testdata/sf0.001"))
    assert plan.count("FlatMapGroupsInArrow") == 1 and not re.search(r"zip_with", plan)


def test_worst_groups_sorts_no_pairs(spark):
    from peakloom import catalog_profiles

    plan = _plan(catalog_profiles.worst_groups(spark, "/root/testdata/sf0.001"))
    assert "FlatMapGroupsInArrow" in plan and not re.search(r"zip_with", plan)


def _most_memory(spark, run) -> int:
    """Bytes of execution memory of the largest task that run() starts."""
    sc, jvm = spark.sparkContext._jsc.sc(), spark.sparkContext._jvm
    stages = lambda: sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    sc.listenerBus().waitUntilEmpty()
    before, most = max((s.stageId() for s in _items(stages())), default=-1), 0
    run()
    sc.listenerBus().waitUntilEmpty()
    for s in _items(stages()):
        if s.stageId() > before:
            done = [t.taskMetrics() for t in _items(sc.statusStore().taskList(s.stageId(), s.attemptId(), 10**6))]
            most = max([most, *(m.get().peakExecutionMemory() for m in done if m.isDefined())])
    return most


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def test_worst_groups_memory_of_one_task(spark, tmp_path):
    """A group of 10,240,000 pairs is searched once, and no task holds more than a few blocks of its rows."""
    from peakloom import catalog_profiles

    n = 32_000
    spark.range(n).selectExpr("id as vec_id", "array(cast(sin(id) as float), cast(cos(id * 3) as float), 1f) as embedding", "1 as label").write.parquet(f"{tmp_path}/embeddings.parquet")
    df, got = catalog_profiles.worst_groups(spark, str(tmp_path)), []
    most = _most_memory(spark, lambda: got.extend(df.collect()))
    assert most < 150 * 2**20
    assert _plan(df).split("Initial Plan")[0].count("FlatMapGroupsInArrow") == 1
    i = np.arange(n)
    z = np.stack([np.sin(i), np.cos(i * 3), np.ones(n)], axis=1).astype(np.float32).astype(float)
    z /= np.sqrt((z * z).sum(axis=1, keepdims=True))
    near = np.partition(np.round(1 - z[::100] @ z.T, 9), 4)[:, :5]
    assert [tuple(r) for r in got] == [(1, round(float(np.quantile(near, 0.95)), 6), n // 100, n // 100)]


def test_topic_metrics_make_cells_once(spark):
    """The matrix is derived once, however many models are fitted to it and however often they pass over it."""
    from peakloom.operators import topic_metrics

    made = spark.sparkContext.accumulator(0)
    rows = spark.sparkContext.parallelize([(o, f"v{v}") for o in range(40) for v in range(12) if (o * 5 + v * 3) % 4 < 2], 2)
    cells = rows.map(lambda x: made.add(1) or x).toDF("obs_id bigint, var_id string")
    got = topic_metrics.model_metrics(cells, [2, 3], 4, iterations=2)
    assert sorted(got) == [2, 3] and made.value == rows.count()
