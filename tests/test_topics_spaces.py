"""Permutation nulls, topic metrics and thresholds, reduced products and search spaces against plain loops."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest

from peakloom.operators import nulls, products, search_space, topic_metrics, topics


def plain_score(hits, n):
    """hits: (place, weight); the largest deviation, by a walk over every place."""
    of, total = dict(hits), sum(abs(w) for _, w in hits)
    up = down = best_hi = best_lo = 0.0
    for place in range(1, n + 1):
        best_lo = min(best_lo, up - down) if place in of else best_lo
        if place in of:
            up += abs(of[place]) / total
            best_hi = max(best_hi, up - down)
        else:
            down += 1 / (n - len(of))
    return best_hi if best_hi >= -best_lo else best_lo


@pytest.mark.parametrize("n_items", [40, 900])
def test_enrichment_null(spark, n_items):
    r = random.Random(4)
    items = [(i, float(r.randint(1, 50))) for i in range(n_items)]
    place = {i: k for k, (i, _) in enumerate(sorted(items, key=lambda x: (-x[1], x[0])), 1)}
    weight = dict(items)
    members = {s: r.sample(range(n_items), k) for s, k in (("a", 5), ("b", 5), ("c", 12), ("d", 1))}
    sets = spark.createDataFrame([(s, i) for s, x in members.items() for i in x] + [("a", 10**6), ("none", -1)], "set string, item bigint")
    got = {x["set"]: x for x in nulls.enrichment_null(spark.createDataFrame(items, "item bigint, weight double"), sets, 30).collect()}
    assert set(got) == set(members)
    for s, x in members.items():
        score = plain_score([(place[i], weight[i]) for i in x], n_items)
        drawn = []
        for d in range(30):
            order = sorted(range(n_items), key=lambda i: hashlib.md5(f"{d}_{i}".encode()).hexdigest())[: len(x)]
            drawn.append(plain_score([(place[i], weight[i]) for i in order], n_items))
        same = [v for v in drawn if (v >= 0) == (score >= 0)]
        beyond = sum(abs(v) >= abs(score) - 1e-12 for v in same)
        assert got[s]["score"] == pytest.approx(score) and (got[s]["n_null"], got[s]["n_beyond"]) == (len(same), beyond)
        assert got[s]["p"] == (pytest.approx(beyond / len(same)) if same else None)
        assert got[s]["normalised"] == (pytest.approx(score / np.mean(np.abs(same))) if same else None)
    assert nulls.enrichment_null(spark.createDataFrame(items, "item bigint, weight double"), sets.where("false"), 5).count() == 0


def test_draws_that_come_short_are_drawn_again(spark, monkeypatch):
    """With a cut that is far too low, sets have their sizes all the same."""
    monkeypatch.setattr(nulls.math, "sqrt", lambda x: -(x + 45) / 7)
    items = spark.range(400).withColumnRenamed("id", "item")
    got = collections.defaultdict(set)
    for x in nulls.drawn_hits(items, 400, [20, 3], 6).collect():
        got[x["size"], x["draw"]].add(x["item"])
    want = {(h, d): set(sorted(range(400), key=lambda i: hashlib.md5(f"{d}_{i}".encode()).hexdigest())[:h]) for h in (3, 20) for d in range(6)}
    assert got == want


def weights_of(spark, values):
    return spark.createDataFrame([(t, f"r{i:03d}", float(w)) for t, x in values.items() for i, w in enumerate(x)], "topic string, region string, weight double")


def test_gram_density_divergence(spark):
    r = np.random.default_rng(2)
    m = r.random((4, 60)) * (r.random((4, 60)) < 0.5)
    w = weights_of(spark, {f"t{k}": m[k] for k in range(4)}).where("weight > 0")
    g = topic_metrics.gram(w.repartition(5))
    held = {(x["i"], x["j"]): x["value"] for x in g.collect()}
    assert all(held[f"t{i}", f"t{j}"] == pytest.approx(float(m[i] @ m[j])) for i in range(4) for j in range(i, 4))
    cosine = [m[i] @ m[j] / np.linalg.norm(m[i]) / np.linalg.norm(m[j]) for i in range(4) for j in range(i + 1, 4)]
    assert topic_metrics.density(g).first() == (4, pytest.approx(np.mean(cosine)))
    shares, lengths = r.dirichlet(np.ones(4), 25), r.integers(1, 50, 25)
    s = spark.createDataFrame([(i, f"t{k}", float(shares[i, k])) for i in range(25) for k in range(4)], "obs_id bigint, topic string, weight double")
    one, two = np.linalg.svd(m, compute_uv=False), np.sort(lengths @ shares)[::-1]
    p, q = one / one.sum(), two / two.sum()
    want = float((p * np.log(p / q)).sum() + (q * np.log(q / p)).sum())
    assert topic_metrics.divergence(g, s, spark.createDataFrame(list(enumerate(lengths.tolist())), "obs_id bigint, n bigint")) == pytest.approx(want)
    assert topic_metrics.density(topic_metrics.gram(w.where("topic = 't1'"))).first() == (1, None)


def test_select_topics():
    q = {5: {"coherence": -2.0, "perplexity": 9.0}, 10: {"coherence": -1.0, "perplexity": 8.0}, 3: {"coherence": 0.0, "perplexity": 8.5}}
    assert topic_metrics.select_topics(q) == 10  # the coherence of three topics does not count
    assert topic_metrics.select_topics(q, 3) == 3
    for bad in (lambda: topic_metrics.select_topics(q, 4), lambda: topic_metrics.select_topics({9: {}}), lambda: topic_metrics.select_topics({3: {"coherence": 1.0}, 4: {"coherence": 2.0}})):
        with pytest.raises(ValueError):
            bad()


def test_li_and_mixture(spark):
    r = np.random.default_rng(8)
    two = np.concatenate([r.normal(10, 1, 3000), r.normal(30, 2, 1000)])
    one = r.normal(50, 3, 4000)
    w = weights_of(spark, {"two": two, "one": one, "flat": np.full(20, 3.0)})
    li = {x["topic"]: x["threshold"] for x in topic_metrics.li(w).collect()}
    assert set(li) == {"one", "two"}
    for name, x in (("two", two), ("one", one)):
        width = (x.max() - x.min()) / 100
        mids = np.minimum(np.floor((x - x.min()) / (x.max() - x.min()) * 100), 99) + 0.5
        t = mids.mean()
        for _ in range(60):
            a, b = mids[mids <= t].mean(), mids[mids > t].mean()
            t = (a - b) / (np.log(a) - np.log(b))
        assert li[name] == pytest.approx(x.min() + t * width)
    mixture = {x["topic"]: x for x in topic_metrics.mixture(w).collect()}
    assert mixture["two"]["two"] and 13 < mixture["two"]["threshold"] < 24
    assert not mixture["one"]["two"] and mixture["one"]["threshold"] == pytest.approx(56, abs=0.7)
    assert "flat" not in mixture


@pytest.mark.parametrize("blocks", [(2048, 4096), (7, 5)])
def test_reduced_product(spark, monkeypatch, blocks):
    monkeypatch.setattr(products, "OBS_BLOCK", blocks[0])
    monkeypatch.setattr(products, "VAR_BLOCK", blocks[1])
    r = np.random.default_rng(6)
    a, b = r.integers(0, 4, (30, 3)), r.integers(0, 3, (3, 40))
    a[3] = 0
    left = spark.createDataFrame([(i, k, float(a[i, k])) for i in range(30) for k in range(3)], "obs_id bigint, topic int, weight double")
    right = spark.createDataFrame([(j, k, float(b[k, j])) for j in range(40) for k in range(3)] + [(99, 7, 5.0)], "var_id bigint, topic int, weight double")
    got = collections.defaultdict(list)
    for x in products.reduced_product(left, right, 6, 2.0).collect():
        got[x["obs_id"]].append((-x["value"], x["var_id"]))
    dense = a @ b * 2
    want = {i: sorted((-float(v), j) for j, v in enumerate(row) if v > 0)[:6] for i, row in enumerate(dense) if row.any()}
    assert {i: sorted(x) for i, x in got.items()} == want
    with pytest.raises(MemoryError, match="dense"):
        products.reduced_product(left, right, 6, max_gb=1e-9)


def brute_space(peaks, genes, up, down, boundaries):
    out = set()
    for name, chrom, s, e, strand in genes:
        before = [g for g in genes if g[1] == chrom and (g[2], g[3], g[0]) < (s, e, name)]
        after = [g for g in genes if g[1] == chrom and (g[2], g[3], g[0]) > (s, e, name)]
        reach = max((g[3] for g in before), default=None)
        left, right = (up, down) if strand == "+" else (down, up)
        room_l = math.inf if reach is None else max(0, s - reach)
        room_r = 0 if reach is not None and reach > e else max(0, min((g[2] for g in after), default=math.inf) - e)
        lo = s - (max(left[0], min(left[1], room_l)) if boundaries else left[1])
        hi = e + (max(right[0], min(right[1], room_r)) if boundaries else right[1])
        for c, a, b in peaks:
            if c == chrom and a < hi and lo < b:
                mid = (a + b) // 2
                d = min(0, mid - s) + max(0, mid - e)
                tss = (s - 10, s + 20) if strand == "+" else (e - 20, e + 10)
                out.add((name, c, a, b, d if strand == "+" else -d, a < tss[1] and tss[0] < b))
    return out


@pytest.mark.parametrize("boundaries", [True, False])
def test_search_space(spark, monkeypatch, boundaries):
    r = random.Random(11)
    peaks = [(f"chr{r.randint(1, 2)}", s := r.randint(0, 40_000), s + r.randint(50, 600)) for _ in range(150)]
    genes = [(f"g{i:02d}", f"chr{r.randint(1, 2)}", s := r.randint(0, 40_000), s + int(10 ** r.uniform(2, 4)), r.choice("+-")) for i in range(50)]
    genes += [("x1", "chr1", 900, 1000, "+"), ("x2", "chr1", 900, 1000, "-"), ("alone", "chr7", 5, 9, "+")]
    g = spark.createDataFrame(genes, "gene string, chrom string, start bigint, end bigint, strand string")
    p = spark.createDataFrame(peaks, "chrom string, start bigint, end bigint")
    got = search_space.search_space(p, g, (100, 3000), (200, 1500), (10, 20), boundaries)
    assert sorted(map(tuple, got.collect())) == sorted(brute_space(peaks, genes, (100, 3000), (200, 1500), boundaries))
    one = {tuple(x) for x in search_space.neighbours(g).collect()}
    assert {tuple(x) for x in search_space.neighbours(g, 700).collect()} == one  # whatever the stripes


def test_each_pass_counts_every_entry(spark):
    """A topic's weights are sums over all cells, so a variable's sum over topics is the number of cells that have it."""
    rows = [(o, f"v{v}") for o in range(60) for v in range(15) if (o * 7 + v * 5) % 11 < 4 or (o, v) == (59, 14)]
    words, model, _ = topics.fit_topics(spark.createDataFrame(rows, "obs_id int, var_id string"), 3, iterations=3)
    have = collections.Counter(v for _, v in rows)
    assert dict(zip(words.vocabulary, model.topicsMatrix().toArray().sum(axis=1), strict=True)) == pytest.approx(have)


def test_topic_choice_finds_planted_topics(spark, tmp_path):
    """Three kinds of users, of events of their own: three topics share nothing, and they are chosen."""
    from peakloom import catalog_topics

    e = spark.range(90).selectExpr("id as user_id", "explode(sequence(1, 8)) as d").selectExpr("user_id", "make_timestamp(2024, 1, d, 0, 0, 0) as ts", "concat('kind', user_id % 3) as event_type", "9.0D as value")
    e.write.parquet(f"{tmp_path}/events.parquet")
    got = {x["n_topics"]: x for x in catalog_topics.topic_choice(spark, str(tmp_path)).collect()}
    assert got[3]["density"] < 0.05 and got[3]["perplexity"] < got[6]["perplexity"] and got[3]["chosen"]
