"""Footers of Arrow files, block matrices, sets with manifests, chunks with a pinned axis."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from peakloom.sources import files, footers, matrices


def write_arrow(path, table):
    with pa.OSFile(str(path), "wb") as f, pa.ipc.new_file(f, table.schema) as w:
        w.write_table(table, 50)


def test_footer_is_all_that_is_read(spark, tmp_path):
    """A database a hundred times as long costs the same bytes."""
    names = [f"chr{i % 3 + 1}:{i * 100}-{i * 100 + 60}" for i in range(200)]
    read = []
    for n in (10, 1000):
        write_arrow(tmp_path / f"{n}.feather", pa.table({name: pa.array(range(n), pa.int32()) for name in names} | {"motifs": [f"m{i}" for i in range(n)]}))
        f = files.StoredFile(spark, str(tmp_path / f"{n}.feather"))
        assert footers.arrow_schema(f).names[:-1] == names
        read.append((f.bytes_read, f.length))
        got = footers.read_database_regions(spark, str(tmp_path / f"{n}.feather"), 200)
        assert sorted(r["region"] for r in got.collect()) == sorted(names)
    (small, _), (large, length) = read
    assert large < 3 * small and large < length / 10


def test_database_layouts(spark, tmp_path):
    rows = pa.table({"m1": pa.array(range(300), pa.float32()), "m2": pa.array([0.5] * 300, pa.float64()), "regions": [f"db__chr2:{i * 10}-{i * 10 + 5}" for i in range(299)] + ["db__chr2:0-5"]})
    write_arrow(tmp_path / "rows.feather", rows)
    got = footers.read_database_regions(spark, str(tmp_path / "rows.feather"), 299).collect()
    assert sorted((r["chrom"], r["start"], r["end"]) for r in got) == [("chr2", i * 10, i * 10 + 5) for i in range(299)]
    write_arrow(tmp_path / "odd.feather", pa.table({"chr1:1-5": [1], "chr1:7-9": [1], "GATA1": [2], "tracks": ["t"]}))
    write_arrow(tmp_path / "genes.feather", pa.table({"m1": [1], "genes": ["GATA1"]}))
    (tmp_path / "old.feather").write_bytes(b"FEA1" + b"\0" * 40)
    (tmp_path / "none.feather").write_bytes(b"hello, world")
    for name, message in (("odd", "GATA1"), ("genes", "genes"), ("old", "version 1"), ("none", "no Arrow"), ("rows", "not 7")):
        with pytest.raises(ValueError, match=message):
            footers.read_database_regions(spark, str(tmp_path / f"{name}.feather"), 7)


def matrix(spark, seed, n_obs=60, n_var=40):
    r = random.Random(seed)
    e = {(i, f"v{j:02d}"): float(r.randint(1, 9)) for i in range(n_obs) for j in range(n_var) if r.random() < 0.15}
    obs = spark.createDataFrame([(i, f"g{i % 3}") for i in range(n_obs)], "obs_id bigint, grp string")
    var = spark.createDataFrame([(f"v{j:02d}",) for j in range(n_var)], "var_id string")
    return e, spark.createDataFrame([(i, v, x) for (i, v), x in e.items()] + [(999, "v00", 1.0), (0, "none", 1.0), (0, "v00", 0.0)], "obs_id bigint, var_id string, value double"), obs, var


def test_matrix_blocks(spark, tmp_path):
    e, entries, obs, var = matrix(spark, 1)
    path = str(tmp_path / "m")
    matrices.write_matrix(entries, obs, var, path, rows=16, columns=8)
    back = lambda df: {(r["obs_id"], r["var_id"]): r["value"] for r in df.collect()}
    assert back(matrices.read_matrix(spark, path)) == e
    assert matrices.read_axis(spark, path, "obs").columns == ["obs_id", "grp"]
    some = matrices.read_matrix(spark, path, ["v03", "v17"])
    assert back(some) == {k: x for k, x in e.items() if k[1] in ("v03", "v17")}
    assert back(matrices.read_matrix(spark, path, ["v03"], [5, 6, 7])) == {k: x for k, x in e.items() if k[1] == "v03" and k[0] in (5, 6, 7)}
    wide = {r["obs_id"]: (r["v03"], r["v17"]) for r in matrices.read_columns(spark, path, ["v03", "v17"]).collect()}
    assert wide == {i: (e.get((i, "v03"), 0.0), e.get((i, "v17"), 0.0)) for i in range(60)}
    with pytest.raises(ValueError, match="nope"):
        matrices.read_columns(spark, path, ["v03", "nope"])
    # Blocks of other variables are never opened: reading two works with all others spoilt.
    own = {r["var_block"] for r in spark.read.parquet(f"{path}/var").where("var_id in ('v03', 'v17')").collect()}
    spoilt = [f for f in (tmp_path / "m" / "blocks").glob("var_block=*/*.parquet") if int(f.parent.name.split("=")[1]) not in own]
    for f in spoilt:
        f.write_bytes(b"spoilt")
        (f.parent / f".{f.name}.crc").unlink()
    assert len(own) <= 2 < len(spoilt)
    assert back(matrices.read_matrix(spark, path, ["v03", "v17"])) == {k: x for k, x in e.items() if k[1] in ("v03", "v17")}
    with pytest.raises(Exception, match="not a Parquet file|spoilt|Parquet"):
        matrices.read_matrix(spark, path).collect()


def test_set_is_committed_by_its_manifest(spark, tmp_path):
    path = str(tmp_path / "pair")
    e1, entries1, obs, var1 = matrix(spark, 1)
    e2, entries2, _, var2 = matrix(spark, 2, n_var=12)
    with pytest.raises(FileNotFoundError):
        matrices.read_manifest(spark, path)
    parts = {"rna": (entries1, obs, var1), "atac": (entries2, obs, var2)}
    assert matrices.write_set(path, parts, {"method": "knn", "k": 10}) == 1
    broken = entries2.withColumn("value", F.when(F.col("obs_id") == 30, F.raise_error(F.lit("killed")).cast("double")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="killed"):  # between the first and the second part
        matrices.write_set(path, {"rna": (entries2, obs, var2), "atac": (broken, obs, var2)}, {"method": "new"})
    m = matrices.read_manifest(spark, path)
    assert (m["number"], m["provenance"]) == (1, {"method": "knn", "k": 10})
    for name, e in (("rna", e1), ("atac", e2)):
        assert {(r["obs_id"], r["var_id"]): r["value"] for r in matrices.read_matrix(spark, m["parts"][name]).collect()} == e
    with pytest.raises(ValueError, match="observations"):
        matrices.write_set(path, {"rna": (entries1, obs, var1), "atac": (entries2, obs.where("obs_id > 0"), var2)}, {})
    assert matrices.write_set(path, parts, {}) == 2 and matrices.read_manifest(spark, path)["number"] == 2


def test_chunks_pin_their_axis(spark, tmp_path):
    path = str(tmp_path / "export")
    names = ["b", "a", "c", "d"]
    axis = lambda names: spark.createDataFrame(list(enumerate(names)), "place int, var_id string")
    part = lambda lo: spark.createDataFrame([(i, v, float(i)) for i in range(lo, lo + 3) for v in "abd"], "obs_id bigint, var_id string, value double")
    matrices.write_chunk(part(1), axis(names), path, "000")
    matrices.write_chunk(part(4), axis(names).repartition(3), path, "001")
    for bad in (["a", "b", "c", "d"], ["b", "a", "c"], ["b", "a", "c", "x"]):
        with pytest.raises(ValueError, match="another axis"):
            matrices.write_chunk(part(7), axis(bad), path, "002")
    with pytest.raises(ValueError, match="unique"):
        matrices.write_chunk(part(7), axis(["b", "a", "c", "c"]), path, "002")
    with pytest.raises(FileExistsError):
        matrices.write_chunk(part(7), axis(names), path, "001")
    got = sorted(map(tuple, matrices.read_chunks(spark, path).select("obs_id", "var_id", "value").collect()))
    assert got == [(i, v, float(i)) for i in range(1, 7) for v in "abd"]
