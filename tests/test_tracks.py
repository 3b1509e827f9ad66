"""Files of groups, fragments with an index, and matching in parts."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from peakloom.operators import controls
from peakloom.sources import tables, text, tracks


def lines_of(folder, gz=False):
    """The lines of a folder's parts in name order."""
    parts = sorted(p for p in folder.glob("part-*") if not p.name.endswith(".crc"))
    return [x for p in parts for x in (gzip.open(p, "rt").read() if gz else p.read_text()).splitlines()]


def test_region_sets_with_odd_names(spark, tmp_path):
    regions = spark.createDataFrame([("a b/c", "chr2", 1000, 1001), ("a b/c", "chr2", 200, 204), (None, "chr1", 5, 9)], "grp string, chrom string, start int, end int")
    groups = spark.createDataFrame([("a b/c",), (None,), ("empty/one",)], "grp string")
    assert tracks.write_region_sets(regions, groups, f"{tmp_path}/s") == {"a b/c": 2, None: 1, "empty/one": 0}
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["grp=a_b-c", "grp=empty-one", "grp=none"]
    assert lines_of(tmp_path / "s/grp=a_b-c") == ["chr2\t200\t204", "chr2\t1000\t1001"] and lines_of(tmp_path / "s/grp=empty-one") == []
    with pytest.raises(ValueError, match="a/b"):
        tracks.folders(spark.createDataFrame([("a/b",), ("a-b",)], "grp string"), "grp")


def test_groups_and_bedgraph_in_order_of_place(spark, tmp_path):
    r = random.Random(5)
    rows = list({(f"g {i % 2}", f"chr{r.randint(1, 3)}", s := r.randint(1, 100_000), s + 10, r.uniform(-1, 3)) for i in range(800)})
    df = spark.createDataFrame(rows, "grp string, chrom string, start bigint, end bigint, eff double").repartition(6)
    text.write_groups(text.bed6(df), f"{tmp_path}/bed")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one task
    try:
        tracks.write_bedgraph(df, f"{tmp_path}/bg", "eff")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for g in (0, 1):
        want = sorted((c, s, e, v) for name, c, s, e, v in rows if name == f"g {g}")
        assert [tuple(x.split("\t")[:3]) for x in lines_of(tmp_path / f"bed/grp=g_{g}")] == [(c, str(s), str(e)) for c, s, e, _ in want]
        assert lines_of(tmp_path / f"bg/grp=g_{g}") == [f"{c}\t{s}\t{e}\t{v:.5f}" for c, s, e, v in want if v > 0]
        assert len(list((tmp_path / f"bg/grp=g_{g}").glob("part-*"))) > 1  # a group is several tasks


def test_link_tracks(spark, tmp_path):
    r = random.Random(9)
    rows = [(f"t{i}", f"chr{r.randint(1, 2)}:{s}-{s + 50}", r.choice(["B cell", "T/x"]), float(r.randint(1, 9)), r.choice([0.5, -0.25, None])) for i in range(60) for s in [r.randint(1, 20) * 1000]]
    links = spark.createDataFrame(rows, "target string, region string, grp string, z double, rho double")
    anchored = links.select("target", "region", F.lit(4000).cast("bigint").alias("anchor"))
    interact = tables.interact_rows(links, anchored, "grp", "z")
    counts = tracks.write_link_tracks(interact, str(tmp_path), "z >= 3")
    assert counts == {name: sum(x[2] == g for x in rows) for g, name in (("B cell", "B_cell"), ("T/x", "T-x"))}
    for name, n in counts.items():
        head, *body = lines_of(tmp_path / f"interact/exp={name}")
        assert head.startswith(f'track type=interact name="{name} links" description="z >= 3" ')
        cells = [x.split("\t") for x in body]
        assert len(cells) == n and {len(x) for x in cells} == {18}
        assert [(x[0], int(x[1])) for x in cells] == sorted((x[0], int(x[1])) for x in cells)
        assert all("rho=" in x[3] for x in cells)
        peaks = [x.split("\t") for x in lines_of(tmp_path / f"peaks/exp={name}")]
        own = {tuple(x[8:11]) for x in cells}
        assert [(x[0], int(x[1])) for x in peaks] == sorted((c, int(s)) for c, s, _ in own) and len(peaks) == len(own)
        assert len(lines_of(tmp_path / f"bedpe/exp={name}")) == n


def test_fragments(spark, tmp_path):
    r = random.Random(2)
    rows = [(r.choice(["A", "B b"]), r.choice(["s1", "s2"]), f"chr{r.randint(1, 2)}", s := r.randint(0, 300_000), s + r.choice([40, 40_000]), f"c{i}", 1 + i % 3) for i in range(900)]
    df = spark.createDataFrame(rows, "grp string, sample string, chrom string, start bigint, end bigint, barcode string, n bigint")
    tracks.write_fragments(df, str(tmp_path), rows=50)
    every = 0
    for g in ("A", "B_b"):
        for s in ("s1", "s2"):
            folder = tmp_path / f"data/grp={g}/sample={s}"
            got = [x.split("\t") for x in lines_of(folder, True)]
            assert [(x[0], int(x[1]), int(x[2]), x[3]) for x in got] == sorted((x[2], x[3], x[4], x[5]) for x in rows if (x[0].replace(" ", "_"), x[1]) == (g, s))
            every += len(list(folder.glob("part-*.gz")))
    for chrom, start, end in (("chr1", 100_000, 120_000), ("chr2", 0, 50), ("chr2", 299_999, 400_000), ("chr9", 0, 10)):
        out = tracks.read_fragments(spark, str(tmp_path), chrom, start, end, "sample = 's1'")
        want = sorted((x[0].replace(" ", "_"), *x[1:]) for x in rows if x[1] == "s1" and x[2] == chrom and x[3] < end and x[4] > start)
        assert sorted((x["grp"], x["sample"], x["chrom"], x["start"], x["end"], x["barcode"], x["n"]) for x in out.collect()) == want
        assert len([f for f in out.inputFiles() if "/data/" in f]) < every / 2


def sequential(rows, tol, window):
    """The rule as it is, over a whole stratum."""
    import hashlib

    out = set()
    for s in {r[0] for r in rows}:
        kept = sorted((x, i) for t, i, x, d in rows if t == s and not d)
        lost = sorted((hashlib.md5(str(i).encode()).hexdigest(), i, x) for t, i, x, d in rows if t == s and d)
        used = set()
        for _, i, x in lost:
            at = sum(k < x for k, _ in kept)
            near = [(abs(kept[c][0] - x), c) for c in range(max(0, at - window), min(len(kept), at + window)) if c not in used]
            if near and (x <= 0 or min(near)[0] <= tol * x):
                used.add(min(near)[1])
                out.add((s, i, kept[min(near)[1]][1]))
    return out


@pytest.mark.parametrize("window", [3, 40])
def test_matching_in_parts_is_the_sequential_rule(spark, window):
    r = random.Random(window)
    rows = [(i % 3, i, r.choice([0.0, -1.0]) if i % 3 == 1 and r.random() < 0.1 else 10 ** r.uniform(-3, 0) if r.random() < 0.5 else r.choice([0.1, 0.2, 0.3]) * r.uniform(0.97, 1.03), r.random() < 0.4) for i in range(400)]
    df = spark.createDataFrame(rows, "stratum int, id bigint, x double, is_dropped boolean")
    parts = controls.components_by_gap(df, 0.02, window)
    assert parts.select("stratum", "part").distinct().count() > 20
    assert {tuple(x) for x in controls.greedy_pairs(df, 0.02, window).collect()} == sequential(rows, 0.02, window)


def test_matched_effect_needs_pairs(spark):
    rows = [(s, s * 10_000 + i, 1 + i // 2 * 1.0, i % 2 == 0, float(i % 2) + i % 7) for s, n in ((1, 60), (2, 20)) for i in range(n)]
    got = controls.matched_effect(spark.createDataFrame(rows, "stratum int, id bigint, x double, is_dropped boolean, y double"), least=20).collect()
    assert [(x["stratum"], x["n_pairs"], x["x_ratio"]) for x in got] == [(1, 30, 1.0)] and got[0]["effect"] < 0
