"""Engine queries against DuckDB and brute force."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from peakloom import catalog
from peakloom.functions import stats
from peakloom.operators import controls, draws, guards, intervals, labels, links, matrix, pairing, profiles, regulons, runs, topics
from peakloom.sources import footers, tables, text, tracks
from peakloom.streaming import sums

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, sf, duck, name):
    df = catalog.queries()[name](spark, sf)
    q = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in q.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((repr(r) for r in q.fetchall()))
    assert sorted(repr(tuple(r[n] for n in names)) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_other_queries_run(spark, sf, name):
    catalog.queries()[name](spark, sf).collect()


def test_overlaps_brute_force(spark):
    r = random.Random(1)
    for trial in range(3):
        make = lambda n, w: list({(f"chr{r.randint(1, 3)}", s := r.randint(0, 20000), s + r.randint(1, w)) for _ in range(n)})
        left, right = make(80, 600), make(60, 400) + [("chr1", 10, 9000), ("chr9", 1, 5)]
        schema = "chrom string, start bigint, end bigint"
        got = {tuple(x) for x in intervals.overlaps(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), 256).collect()}
        want = {(*a, b[1], b[2], min(a[2], b[2]) - max(a[1], b[1])) for a in left for b in right if a[0] == b[0] and a[1] < b[2] and b[1] < a[2]}
        assert got == want


def test_wide_regions_meet_narrow_ones(spark):
    """Widths that vary ten-thousandfold: every pair, none twice, and a wide interval in a few rows only."""
    r = random.Random(21)
    make = lambda n: list({("chr1", s := r.randint(0, 2_000_000), s + int(10 ** r.uniform(0, 6))) for _ in range(n)})
    left, right = make(120), make(120)
    a, b = (spark.createDataFrame(x, "chrom string, start bigint, end bigint") for x in (left, right))
    want = sorted((*x, y[1], y[2], min(x[2], y[2]) - max(x[1], y[1])) for x in left for y in right if x[1] < y[2] and y[1] < x[2])
    assert sorted(tuple(x) for x in intervals.overlaps(a, b, 64).collect()) == want
    hit = {x[:3] for x in want}
    assert sorted(tuple(x) for x in intervals.outside(a, b).collect()) == sorted(x for x in left if x not in hit)
    assert intervals._binned(a, 64, b).count() <= 120 * 2 * 16
    assert {(x["start"], x["end"]): x["n_overlapping"] for x in intervals.audit(a, b).collect()} == {x[1:]: sum(y[:3] == x for y in want) for x in left}


def test_false_discovery_control_brute_force(spark):
    r = random.Random(22)
    rows = [(g, i, r.choice([0.0, 1.0, 1e-300, 0.05, None, 10 ** r.uniform(-9, 0)])) for g in range(3) for i in range(80)]
    got = {(x["g"], x["i"]): x["q"] for x in matrix.benjamini_hochberg(spark.createDataFrame(rows, "g int, i int, p double"), "p", ["g"]).collect()}
    assert len(got) == len(rows)
    for g in range(3):
        p = sorted(x[2] for x in rows if x[0] == g and x[2] is not None)
        for _, i, mine in (x for x in rows if x[0] == g):
            want = None if mine is None else min(1.0, min(v * len(p) / sum(u <= v for u in p) for v in p if v >= mine))
            assert got[g, i] == want or abs(got[g, i] - want) < 1e-15


def test_tails_of_distributions(spark):
    cases = [0.0, 1.959963985, -1.0, 8.0, 2.82842, 2.82843, 2.9, -9.0, 30.0]
    got = [x[0] for x in spark.createDataFrame([(z,) for z in cases], "z double").select(stats.norm_sf("z")).collect()]
    assert all(abs(a - math.erfc(z / math.sqrt(2)) / 2) <= 1e-9 * a for a, z in zip(got, cases))
    t = [(12.706204736432095, 1, 0.05), (4.302652729911275, 2, 0.05), (2.2281388519649385, 10, 0.05), (2.0345152974493383, 33, 0.05), (3.39049, 100, 0.0010)]
    got = [x[0] for x in spark.createDataFrame(t, "t double, n int, p double").select(stats.student_p(F.col("t"), F.col("n"))).collect()]
    assert all(abs(a - p) < 2e-6 for a, (_, _, p) in zip(got, t))


def test_guards_refuse(spark):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    left = df([(i, i * 2, f"n{i}", i / 3) for i in range(9)], "row_idx int, a int, b string, c double")
    good = df([(i, str(i * 2), f"n{i}", i / 3 + 1e-9, "x") for i in range(9)], "row_idx int, a string, b string, c double, label string")
    assert guards.positional_merge(left, good).columns == ["row_idx", "a", "b", "c", "label"]
    with pytest.raises(ValueError, match="disagree"):
        guards.positional_merge(left, good.withColumn("b", F.lit("n1")))
    with pytest.raises(ValueError, match="do not pair"):
        guards.positional_merge(left, good.where("row_idx < 8"))
    with pytest.raises(ValueError, match="needed"):
        guards.positional_merge(left, good.drop("a"))
    sizes = df([("a", 500), ("b", 10)], "grp string, n int")
    assert [x[0] for x in guards.usable_groups(sizes, df([("a",)], "grp string")).collect()] == ["a"]
    with pytest.raises(ValueError, match="not scored"):
        guards.usable_groups(sizes, df([("b",)], "grp string"))
    with pytest.raises(ValueError, match="no group"):
        guards.usable_groups(sizes, sizes, 900)
    with pytest.raises(ValueError, match="without a latent"):
        guards.latents_for(df([(1,), (2,)], "id int"), df([(1, 0.5)], "id int, z double"), "id")
    with pytest.raises(ValueError, match="absent"):
        tables.chromsizes(df([("chr1", 5)], "chrom string, length int"), ["chr1", "chrM"])
    with pytest.raises(Exception, match="start below 1"):
        df([(0,)], "s bigint").select(guards.zero_based(F.col("s"))).collect()


def test_catalogs_of_all_kinds(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.feather

    want = [("chr1", 5, 9), ("chr2", 1, 4)]
    (tmp_path / "a.csv").write_text("Chrom,start,END\nchr1,5,9\nchr2,1,4\n")
    (tmp_path / "b.tsv").write_text("chrom\tstart\tend\tmore\nchr1\t5\t9\tx\nchr2\t1\t4\ty\n")
    (tmp_path / "c.txt").write_text("chr1:5-9\n\nnothing\nchr2:1-4\n")
    (tmp_path / "d.bed").write_text("chr1\t5\t9\nchr2\t1\t4\n")
    spark.createDataFrame(want, "chrom string, start int, end int").write.parquet(f"{tmp_path}/e.parquet")
    for name in ("a.csv", "b.tsv", "c.txt", "d.bed", "e.parquet"):
        assert sorted(tuple(x) for x in tables.read_catalog(spark, f"{tmp_path}/{name}").collect()) == want, name
    (tmp_path / "none.txt").write_text("x\n")
    with pytest.raises(ValueError, match="no regions"):
        tables.read_catalog(spark, f"{tmp_path}/none.txt")
    (tmp_path / "l.tsv").write_text("target\tregion\timportance\trho\ng\tchr1:5-9\t0.5\tnan?\n")
    assert [tuple(x) for x in tables.read_links(spark, f"{tmp_path}/l.tsv").collect()] == [("g", "chr1:5-9", 0.5, None)]
    (tmp_path / "m.tsv").write_text("target\tregion\ng\tchr1:5-9\n")
    with pytest.raises(ValueError, match="importance"):
        tables.read_links(spark, f"{tmp_path}/m.tsv")
    pyarrow.feather.write_feather(pa.table({"db__chr1:5-9": [1], "chr2:1-4": [2], "motifs": ["m"]}), f"{tmp_path}/wide.feather", compression="uncompressed")
    pyarrow.feather.write_feather(pa.table({"m1": [1, 2], "regions": ["chr1:5-9", "chr2:1-4"]}), f"{tmp_path}/long.feather", compression="uncompressed")
    pyarrow.feather.write_feather(pa.table({"GATA1": [1], "TP53": [2], "motifs": ["m"]}), f"{tmp_path}/genes.feather", compression="uncompressed")
    for name in ("wide", "long"):
        assert [x[0] for x in footers.read_database_regions(spark, f"{tmp_path}/{name}.feather").orderBy("region").collect()] == ["chr1:5-9", "chr2:1-4"]
    with pytest.raises(ValueError, match="no regions"):
        footers.read_database_regions(spark, f"{tmp_path}/genes.feather")


def test_sinks(spark, tmp_path):
    regions = spark.createDataFrame([("a", "chr2", 1, 4), ("a", "chr1", 5, 9)], "grp string, chrom string, start int, end int")
    counts = tracks.write_region_sets(regions, spark.createDataFrame([("a",), ("b",)], "grp string"), f"{tmp_path}/sets")
    assert counts == {"a": 2, "b": 0}
    assert [x.read_text() for x in (tmp_path / "sets/grp=b").glob("*.txt")] == [""]
    assert "".join(x.read_text() for x in (tmp_path / "sets/grp=a").glob("*.txt")) == "chr1\t5\t9\nchr2\t1\t4\n"
    peaks = spark.createDataFrame([("chr1", 0, 10), ("chr2", 0, 10)], "chrom string, start bigint, end bigint")
    one = tables.write_audit(intervals.audit(peaks, peaks.where("chrom = 'chr1'")), f"{tmp_path}/x")
    assert one == {"n_peaks": 2, "n_representable": 1, "n_regions": 1}
    assert spark.read.csv(f"{tmp_path}/x.per_peak.csv", header=True).where("best_db_region = 'NA'").count() == 1
    assert spark.read.parquet(tables.write_table(peaks, str(tmp_path), "t")).count() == 2
    links_ = spark.createDataFrame([("g1", "chr1:100-200", "B cell/x", 2.0, -0.5), ("g2", "chr1:100-200", "B cell/x", 1.0, 0.25)], "target string, region string, grp string, z double, rho double")
    rows = tables.interact_rows(links_, spark.createDataFrame([("g1", "chr1:100-200", 50), ("g2", "chr1:100-200", 500)], "target string, region string, anchor bigint"), "grp", "z").orderBy("name").collect()
    assert len(rows[0]) == 18 and [r["name"] for r in rows] == ["g1|z=2.0|rho=-0.50", "g2|z=1.0|rho=+0.25"]
    assert [(r["chromStart"], r["chromEnd"], r["score"], r["exp"], r["color"]) for r in rows] == [(50, 151, 1000, "B_cell-x", "201,97,31"), (150, 501, 500, "B_cell-x", "31,111,180")]
    assert tables.peak_rows(tables.interact_rows(links_, links_.select("target", "region", F.lit(5).cast("bigint").alias("anchor")), "grp", "z")).count() == 1


def test_every_variable_has_a_place_in_topics(spark, monkeypatch):
    """More variables than a vectorizer keeps by itself are all kept, and names meet their topics by a join."""
    seen = []
    init = topics.CountVectorizer.__init__
    monkeypatch.setattr(topics.CountVectorizer, "__init__", lambda self, **k: seen.append(k["vocabSize"]) or init(self, **k))
    cells = spark.createDataFrame([(o, f"v{o % 7}_{k}") for o in range(30) for k in range(5)], "obs_id int, var_id string")
    words, model, _ = topics.fit_topics(cells, 2, iterations=2)
    assert seen == [35] and len(words.vocabulary) == 35
    top = topics.heaviest(model, words, 3).collect()
    want = {t["topic"]: [words.vocabulary[i] for i in t["termIndices"]] for t in model.describeTopics(3).collect()}
    assert {t["topic"]: t["vars"] for t in top} == want


def test_bad_region_is_fatal(spark):
    df = spark.createDataFrame([("chr1:5-9",), ("x",)], "r string")
    with pytest.raises(Exception, match="bad region"):
        df.select(intervals.strict(F.col("r"))).collect()


def test_anchors_are_farthest(spark):
    rows = [(1, i, [math.cos(i), math.sin(i)]) for i in range(12)]
    got = pairing.maximin_anchors(spark.createDataFrame(rows, "grp int, obs_id bigint, z array<float>"), 4).orderBy("anchor_no").collect()
    chosen = [0]
    while len(chosen) < 4:
        far = {i: round(min((rows[i][2][0] - rows[j][2][0]) ** 2 + (rows[i][2][1] - rows[j][2][1]) ** 2 for j in chosen), 5) for i in range(12) if i not in chosen}
        chosen.append(max(far, key=lambda i: (far[i], -i)))
    assert [x["obs_id"] for x in got] == chosen


def test_statistics(spark):
    df = spark.createDataFrame([(0.0, 3, 10, 0.5), (1.959963985, 0, 4, 0.1)], "z double, k int, n int, p double")
    a, b = df.select(stats.norm_sf("z").alias("sf"), stats.binomial_tail("k", "n", "p").alias("t")).collect()
    assert abs(a["sf"] - 0.5) < 1e-12 and abs(b["sf"] - 0.025) < 1e-9
    assert abs(a["t"] - sum(math.comb(10, i) for i in range(3, 11)) / 1024) < 1e-12 and b["t"] == 1.0


def test_strict_merge_needs_every_id(spark):
    df, side = spark.range(3).withColumnRenamed("id", "k"), spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, v string")
    with pytest.raises(Exception, match="no single label"):
        labels.merge_strict(df, side, "k").collect()


def test_constant_has_no_correlation(spark):
    obs = spark.createDataFrame([(i, 0) for i in range(5)], "obs_id bigint, grp int")
    entries = spark.createDataFrame([(i, "a", 2.0) for i in range(5)] + [(i, "b", float(i + 1)) for i in range(5)], "obs_id bigint, var_id string, value double")
    pairs = spark.createDataFrame([("a", "b"), ("b", "b")], "a string, b string")
    got = {r["a"]: r["rho"] for r in matrix.spearman(pairs, entries, obs).collect()}
    assert got["a"] is None and abs(got["b"] - 1) < 1e-12


def test_files(spark, tmp_path):
    (tmp_path / "m.mtx").write_text("%%MatrixMarket\n2 3 2\n1 2 5\n2 3 7\n")
    assert {tuple(r) for r in text.read_matrix_market(spark, f"{tmp_path}/m.mtx").collect()} == {(1, 2, 5.0), (2, 3, 7.0)}
    (tmp_path / "a.bed").write_text("#c\nchr1\t5\t9\nchr1 9 5\nchr2 1 4 x\n")
    assert text.read_bed(spark, f"{tmp_path}/a.bed").count() == 2
    (tmp_path / "s.tsv").write_text("cell\tlabel\nc1\tT\nc1\tB\n")
    with pytest.raises(ValueError):
        text.read_sidecar(spark, f"{tmp_path}/s.tsv", "cell")
    lines = text.bed6(spark.createDataFrame([("a b", "chr1", 5, 9, 0.5)], "grp string, chrom string, start bigint, end bigint, eff double"))
    text.write_groups(lines, f"{tmp_path}/out")
    assert spark.read.text(f"{tmp_path}/out").first()["value"] == "chr1\t5\t9\ta_b_1\t0.5000\t."


def test_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").repartition(3)
    events.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = sums.daily_sums(stream, "4000 days").writeStream.format("memory").queryName("sums").outputMode("complete").option("checkpointLocation", f"{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    key = lambda df: sorted((r["day"], r["event_type"], r["n"], round(r["total"], 2)) for r in df.collect())
    assert key(spark.table("sums")) == key(sums.daily_sums(events))


def test_distance_and_names(spark):
    df = spark.createDataFrame([("[-12]", "a_+/+"), ("", "b_x"), (None, "c")], "d string, n string")
    got = df.select(links.unwrap(F.col("d")), links.sign_of_name(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(-12, "+/+"), (None, "?"), (None, "?")]


def test_greedy_pairs_are_near_and_used_once(spark):
    r = random.Random(3)
    rows = [(i % 2, i, r.choice([0.0, None, r.uniform(1, 3), r.uniform(1, 3)]), r.random() < 0.4) for i in range(300)]
    got = controls.greedy_pairs(spark.createDataFrame(rows, "stratum int, id bigint, x double, is_dropped boolean"), window=300).collect()
    of = {i: (s, x, d) for s, i, x, d in rows}
    assert got and len({p["kept"] for p in got}) == len({p["dropped"] for p in got}) == len(got)
    for p in got:
        (s, x, d), (t, y, e) = of[p["dropped"]], of[p["kept"]]
        assert s == t == p["stratum"] and d and not e and (x == 0 or abs(x - y) <= 0.02 * x)
    used = {p["dropped"] for p in got} | {p["kept"] for p in got}
    left = [(s, x) for i, (s, x, d) in of.items() if d and x and i not in used]
    free = [(s, x) for i, (s, x, d) in of.items() if not d and x is not None and i not in used]
    assert not any(s == t and abs(x - y) <= 0.02 * x for s, x in left for t, y in free)


def test_decoy_null_finds_the_linked_marker(spark):
    r = random.Random(8)
    y = [r.randint(0, 20) for _ in range(60)]
    entries = [(o, f"near{k}", float(y[o] + r.randint(0, 3))) for o in range(60) for k in range(3)]
    entries += [(o, f"far{k}", float(r.randint(0, 23))) for o in range(60) for k in range(40)]
    entries = [e for e in entries if e[2]]
    features = [(f"near{k}", "chr1", 100 + k) for k in range(3)] + [(f"far{k}", "chr2", k) for k in range(40)]
    markers = [("linked", "chr1", 100), ("alone", "chr3", 5)]
    df = spark.createDataFrame
    rows = controls.decoy_null(df(markers, "marker string, chrom string, tss bigint"), df(features, "var_id string, chrom string, mid bigint"), df(entries, "obs_id int, var_id string, value double"), df([("linked", o, float(v)) for o, v in enumerate(y)], "marker string, obs_id int, y double"), df([(o,) for o in range(60)], "obs_id int"), 50).collect()
    assert [x["marker"] for x in rows] == ["linked"] and rows[0]["n_near"] == 3
    assert rows[0]["rho_true"] > 0.9 and (rows[0]["n_null"] == 0 or rows[0]["beats"])


def test_more_files(spark, tmp_path):
    (tmp_path / "names.txt").write_text("chr1:1-2\n\nchr2 3 9\nchr3\t4\t5\tmine\n")
    assert {r["region"] for r in text.read_region_names(spark, f"{tmp_path}/names.txt").collect()} == {"chr1:1-2", "chr2:3-9", "mine"}
    (tmp_path / "wide.tsv").write_text("a\tb\nr1\t1\t2\nr2\t3\t\n")
    assert [tuple(r) for r in text.read_positional(spark, f"{tmp_path}/wide.tsv").orderBy("row_idx").collect()] == [(0, "r1", "1", "2"), (1, "r2", "3", "")]
    codes = spark.createDataFrame([(0,), (-1,), (None,), (1,)], "c int")
    got = text.decode(codes, "c", spark.createDataFrame([(0, "x"), (1, "y")], "code int, label string"), "NA")
    assert sorted(r["c"] for r in got.collect()) == ["NA", "NA", "x", "y"]
    assert {tuple(r) for r in text.line_counts(spark, f"{tmp_path}/*.*").collect()} == {("names.txt", 4), ("wide.tsv", 3)}


def test_config_and_claims(spark):
    assert runs.config_gaps({"a": {"b": 1, "c": "CHANGE_ME/x"}, "d": ""}, ["a.b", "a.c", "d", "e.f"]) == {"a.c": "placeholder", "d": "missing", "e.f": "missing"}
    rows = [("good", 1, 2, 3, 1, 3, 4, 25.0), ("bad", 1, 9, 3, 1, 2, 4, 30.0), ("silent", *[None] * 7)]
    got = runs.claims(spark.createDataFrame(rows, "name string, least int, median int, most int, part int, rest int, whole int, percent double")).collect()
    assert sorted(tuple(r) for r in got) == [("bad", "median out of range"), ("bad", "parts do not sum"), ("bad", "percentage off")]


def test_running_enrichment_brute_force(spark):
    r = random.Random(5)
    items = [(i, r.choice([-2.0, -1.0, 0.5, 3.0, r.uniform(-4, 4)])) for i in range(60)]
    sets = [(s, i) for s in range(4) for i in range(60) if r.random() < 0.2]
    got = {x["set"]: x["score"] for x in regulons.running_enrichment(spark.createDataFrame(items, "item int, weight double"), spark.createDataFrame(sets, "set int, item int")).collect()}
    for s in range(4):
        inside = {i for t, i in sets if t == s}
        order = sorted(items, key=lambda x: (-x[1], x[0]))
        total, at, steps = sum(abs(w) for i, w in items if i in inside), 0.0, []
        for i, w in order:
            at += abs(w) / total if i in inside else -1 / (60 - len(inside))
            steps.append(at)
        want = max(steps) if max(steps) >= -min(steps) else min(steps)
        assert abs(got[s] - want) < 1e-9


def test_model_choice_and_topics(spark):
    assert topics.choose_model({5: {"perplexity": 9.0, "c": 0.1}, 10: {"perplexity": 2.0, "c": 0.4}, 20: {"perplexity": 1.9, "c": 0.0}}) == 10
    assert topics.choose_model({7: {"c": 1.0}}) == 7
    with pytest.raises(ValueError):
        topics.choose_model({})
    cells = spark.createDataFrame([(o, f"{'ab'[o % 2]}{k}") for o in range(40) for k in range(6)], "obs_id int, var_id string")
    words, model, _ = topics.fit_topics(cells, 2)
    tops = [{words.vocabulary[i][0] for i in t["termIndices"]} for t in model.describeTopics(6).collect()]
    assert sorted(map(sorted, tops)) == [["a"], ["b"]]


def test_otsu_splits_two_clumps(spark):
    rows = [("t", i, 1.0 + i % 5 / 10) for i in range(50)] + [("t", 50 + i, 9.0 + i % 5 / 10) for i in range(10)] + [("flat", i, 2.0) for i in range(5)]
    got = topics.otsu(spark.createDataFrame(rows, "topic string, region int, weight double")).collect()
    assert [x["topic"] for x in got] == ["t"] and 1.4 < got[0]["threshold"] < 9


def test_label_random_draws_are_distinct(spark):
    cells = spark.createDataFrame([("g", m, i) for m in (0, 1) for i in range(7 if m else 3)], "grp string, modality int, obs_id int")
    got = draws.label_random(cells, spark.createDataFrame([("g", k) for k in range(6)], "grp string, metacell int"), 5).collect()
    for k in range(6):
        for m, n in ((0, 3), (1, 5)):
            own = [x["obs_id"] for x in got if x["metacell"] == k and x["modality"] == m]
            assert len(own) == len(set(own)) == n


def test_linkage_verdict(spark):
    null = lambda k, n: spark.createDataFrame([(20, i < k) for i in range(n)] + [(0, True)], "n_null int, beats boolean")
    assert [controls.linkage_verdict(null(k, 40)).first()["verdict"] for k in (2, 6, 20)] == ["fail", "warn", "pass"]
    assert controls.linkage_verdict(null(0, 0)).first()["verdict"] == "fail"


def test_numeric_ids_are_scores(spark):
    df = spark.createDataFrame([(f"c{i}", f"{i}.5", "T") for i in range(20)], "barcode string, cell_score string, celltype string")
    assert {r["column"]: r["role"] for r in profiles.column_roles(df).collect()} == {"barcode": "id", "cell_score": "score", "celltype": "label"}
    assert profiles.column_roles(df.select(F.lit(1).alias("z"))).count() == 0
