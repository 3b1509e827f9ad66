"""Checks with examples, reports, named matrices, tables by prefix, layers, and tests without a p."""

import json

import pytest
from pyspark.sql import functions as F

from peakloom.operators import links, matrix, regulons, validate
from peakloom.sources import reports, text


def test_paired_checks(spark):
    a = spark.createDataFrame([(0, 5), (1, 6), (2, 6), (3, 8)], "place int, obs_id int")
    b = spark.createDataFrame([(0, 5), (1, 7), (2, 6)], "place int, obs_id int")
    genes = spark.createDataFrame([("G",), ("G",), (" H",), ("NaN",), (None,)], "name string")
    regions = spark.createDataFrame([("chr1:1-5",), ("chr1:5-5",), ("x:1-5",), ("chr1-1-5",), ("chr1:-1-5",), ("chr1:a-5",), ("chr1:9-5",)], "name string")
    values = spark.createDataFrame([(1, float("nan")), (2, 1.0), (2, float("inf"))], "obs_id int, value double")
    got = {r["check"]: (r["n"], r["examples"]) for r in validate.paired_checks(a, b, genes, regions, values, 2).collect()}
    assert got == {
        "obs_only_first": (1, "8"), "obs_only_second": (1, "7"), "obs_order": (2, "1 | 3"), "obs_repeated": (1, "6"), "gene_repeated": (1, "G"), "gene_placeholder": (2, "NaN | null"), "gene_padded": (1, " H"),
        "region_repeated": (0, ""), "region_no_colon": (1, "chr1-1-5"), "region_unparsed": (1, "chr1:a-5"), "region_negative": (1, "chr1:-1-5"), "region_inverted": (2, "chr1:5-5 | chr1:9-5"), "region_no_chr": (1, "x:1-5"),
        "value_not_finite": (2, "1 | 2"), "obs_without_value": (1, "1"),
    }


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("b", 3, 0.5, "x|y"), ("a", 2, None, "1,2")], "grp string, n_metacells int, gap double, note string")
    out = reports.write_diagnostics(df, f"{tmp_path}/d", {"k": 5}, {"c": 1})
    assert out == json.loads((tmp_path / "d.json").read_text())
    assert (out["n_metacells_total"], out["groups_used"], out["groups_dropped"], out["per_group"]["a"]["gap"]) == (5, ["a", "b"], {"c": 1}, None)
    assert (tmp_path / "d.csv").read_text() == 'grp,n_metacells,gap,note\na,2,,"1,2"\nb,3,0.5,x|y\n'
    reports.write_profile(spark, f"{tmp_path}/p", "Shapes", {"groups": df, "faults": df.limit(0)})
    page = (tmp_path / "p.md").read_text()
    assert page.startswith("# Shapes\n\n## groups\n\n| grp | n_metacells | gap | note |\n|---|---|---|---|\n| b | 3 | 0.5 | x\\|y |") and "nothing to report" in page
    assert len(json.loads((tmp_path / "p.json").read_text())["groups"]) == 2
    with pytest.raises(ValueError, match="no report"):
        reports.markdown("x", {"all": spark.range(reports.PAGE + 1)})


def test_named_matrix(spark, tmp_path):
    (tmp_path / "m.mtx").write_text("%%MatrixMarket matrix coordinate real general\n%x\n3 2 3\n1 1 5\n3 2 7\n2 1 1.5\n")
    (tmp_path / "r.tsv").write_text("r1\tmore\nr2\tx\nr3\ty\n")
    (tmp_path / "c.txt").write_text("c1\nc2\n")
    got = text.read_named_matrix(spark, f"{tmp_path}/m.mtx", f"{tmp_path}/r.tsv", f"{tmp_path}/c.txt")
    assert sorted(map(tuple, got.collect())) == [("r1", "c1", 5.0), ("r2", "c1", 1.5), ("r3", "c2", 7.0)]
    (tmp_path / "two.txt").write_text("a\na\n")
    (tmp_path / "three.txt").write_text("a\nb\nc\n")
    (tmp_path / "out.mtx").write_text("%%MatrixMarket\n3 2 1\n4 1 5\n")
    for m, c, message in (("m", "two", "repeat"), ("m", "three", "2 columns"), ("out", "c", "outside")):
        with pytest.raises(ValueError, match=message):
            text.read_named_matrix(spark, f"{tmp_path}/{m}.mtx", f"{tmp_path}/r.tsv", f"{tmp_path}/{c}.txt")


def test_read_until(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\trho__b\n1\t0.5\n")
    (tmp_path / "b.txt").write_text("x\ty,rho__b\n1,0.5\n")
    (tmp_path / "c.txt").write_text("x,y\n1,2\n")
    assert text.read_until(spark, f"{tmp_path}/a.txt").columns == ["x", "rho__b"]
    assert text.read_until(spark, f"{tmp_path}/b.txt").columns[1] == "rho__b"
    with pytest.raises(ValueError, match="rho__"):
        text.read_until(spark, f"{tmp_path}/c.txt")


def test_layers_are_folders(spark, tmp_path):
    t = regulons.layers({n: spark.createDataFrame([(1, "f", v), (2, "g", v)], "obs_id int, feature string, value int") for n, v in (("counts", 3), ("areas", 4))})
    assert regulons.write_layers(t, f"{tmp_path}/l") == ["areas", "counts"]
    assert {r["value"] for r in spark.read.parquet(f"{tmp_path}/l/layer=counts").collect()} == {3.0}


def test_links_without_partners(spark):
    l = spark.createDataFrame([("t", "r", 3.0, 0.5, "[7]"), ("t", "r2", float("nan"), 0.5, "[7]"), ("t", "r3", 3.0, -0.5, ""), ("u", "r", 3.0, float("nan"), "[1]")], "target string, region string, z double, rho double, distance string")
    assert [r["region"] for r in links.specific(l, "z", "rho", "distance", 3, 0.3).collect()] == ["r"]
    assert links.present(l, l.select("region"), l.select("target").where("target = 't'")).count() == 3
    with pytest.raises(ValueError, match="no link"):
        links.present(l, l.select("region"), spark.createDataFrame([("x",)], "target string"))


def test_nan_is_no_test(spark):
    p = spark.createDataFrame([(1, 0.01), (1, 0.02), (1, 0.02), (1, 1.0), (1, float("nan")), (1, None)], "g int, p double")
    q = sorted((r["q"] for r in matrix.benjamini_hochberg(p, "p", ["g"]).where("q is not null").collect()))
    assert q == pytest.approx([0.08 / 3] * 3 + [1.0])
