"""Signatures, near duplicates and fingerprints against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from peakloom.llm import bag_minhash, fingerprints, near_dedup, neardup
from peakloom.llm.common import words
from tests.llm.data import TEXTS, documents, plain


def test_bag_minhash_is_unbiased():
    r = np.random.default_rng(1)
    e = np.sort(r.integers(0, 2**63, 300).astype(np.uint64))
    one, two = r.integers(1, 9, 300), r.integers(1, 9, 300)
    keep = r.random(300) < 0.9
    true = bag_minhash.multiset_likeness((e, one), (e[keep], two[keep]))
    same = bag_minhash.signature(e, one, 4096) == bag_minhash.signature(e[keep], two[keep], 4096)
    assert abs(same.mean() - true) < 4 * (true * (1 - true) / 4096) ** 0.5


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 560)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["key"]: r["root"] for r in neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked if find(x) != x} | {x: x for x in got if find(x) == x}
    assert neardup.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def bag(t):
    w = words(t)
    k = min(5, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def brute_classes(rows):
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = bags[i], bags[j]
            least = sum((a & b).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or (least and least / (sum(a.values()) + sum(b.values()) - least) >= 0.8):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def near_texts():
    r = random.Random(8)
    word = lambda: "".join(r.choices("abcdefgh", k=4))
    out = []
    for _ in range(12):
        base = [word() for _ in range(r.choice([6, 40, 120]))]
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    out += ["la " * 30, "la " * 31, "la " * 60]
    return out


def check_classes(docs, one=True):
    """near_duplicates and keep_one against all pairs; rows are told apart by the column `row`."""
    rows = [(r["row"], r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute_classes([(i, t) for _, i, t in rows])
    members: dict = {}
    for (_, i, t), c in zip(rows, want):
        members.setdefault(c, []).append((i is None, i or 0, hashlib.md5((t or "").encode()).digest()))
    got = near_dedup.near_duplicates(docs).collect()
    low = {c: min(m) for c, m in members.items()}
    found: dict = {}
    for r in got:
        found.setdefault(r["class_key"], []).append((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["key"])))
        assert r["kept"] == (found[r["class_key"]][-1] in low.values())
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, members.values()))
    least = {k: min((i for none, i, _ in m if not none), default=None) for k, m in found.items()}
    assert all((r["class_id"], r["class_size"]) == (least[r["class_key"]], len(found[r["class_key"]])) for r in got)
    if not one:
        return None
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, hashlib.md5((r["text"] or "").encode()).digest()) for r in kept) == sorted(low.values())
    return kept


def test_near_duplicates(spark):
    docs = documents(spark, near_texts() + TEXTS).withColumn("row", F.lit(1))
    check_classes(docs)
    assert near_dedup.keep_one(docs.where("false")).count() == 0


def test_unlike_rows_without_ids_or_with_one_id_all_stay(spark):
    texts = [f"this is document number {k} and it says {'x' * k} at some length to be unlike" for k in range(12)]
    rows = [(k, None if k < 5 else 7, t) for k, t in enumerate(texts)] + [(20, None, texts[0]), (21, 7, texts[6]), (22, 3, texts[6]), (23, 3, texts[6])]
    docs = spark.createDataFrame(rows, "row int, doc_id bigint, text string")
    assert len(check_classes(docs)) == 12


def test_blocks_and_hot_leaders(spark, monkeypatch):
    """Families that meet in few bands, cut into many small blocks and dealt to many parts, are classed alike."""
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 3)
    monkeypatch.setattr(neardup, "HOT_SHARE", 4)
    r = random.Random(15)
    word = lambda: "".join(r.choices("abcdefgh", k=4))
    texts = []
    for _ in range(6):
        base = [word() for _ in range(60)]
        for _ in range(14):  # a chain: neighbours are alike, far ones are not
            base = list(base)
            for _ in range(2):
                base[r.randrange(len(base))] = word()
            texts.append(" ".join(base))
    check_classes(spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "row int, doc_id bigint, text string"), one=False)


def test_fingerprints(spark):
    texts = near_texts()[:20] + TEXTS
    docs = documents(spark, texts)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect() if r["doc_id"] is not None and r["doc_id"] != 4), key=lambda x: -x[0])
    docs = docs.where("doc_id is not null and doc_id <> 4").repartition(5)
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    assert len(got) == len(rows)
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        k = len(t) // 3
        new = t[: len(t) - k] + n[:k]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        for name, other in (("near_edited", new), ("near_next", n)):
            a, b = set(bag(t)), set(bag(other))
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(got[i][name] - true) < 0.2
            which = name.removeprefix("near_")
            assert got[i][f"jaccard_{which}"] == (true if got[i][f"bands_{which}"] or not a or not b else 0.0)
            assert 0 <= got[i][f"bands_{which}"] <= fingerprints.BANDS and (got[i][f"bands_{which}"] or true < 0.8 or not a)
    assert len({r["fingerprint"] for r in got.values() if texts[r["doc_id"]] in (None, "", " \n\t ", "!!! ??? ...")}) == 1
    assert fingerprints.fingerprints(docs.where("false")).count() == 0
    assert fingerprints.fingerprints(docs.where("doc_id = 3")).collect()[0]["near_next"] == 1.0
    assert fingerprints.fingerprints(documents(spark, texts)).count() == len(texts) + 3


def test_fingerprint_ranges(spark, monkeypatch):
    """Many ranges, some of them empty, give the same as one."""
    docs = spark.createDataFrame([(i * i % 1009, f"text {i} " + "w " * i) for i in range(200)], "doc_id bigint, text string").dropDuplicates(["doc_id"])
    one = plain(fingerprints.fingerprints(docs).collect())
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 500)
    assert plain(fingerprints.fingerprints(docs).collect()) == one


def test_fingerprints_of_any_ids(spark, monkeypatch):
    """Text ids, fractions, nulls, repeated ids and rows, in one range and in many, against rows in descending order."""
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 60)
    texts = [f"row {i} says " + "w " * (i % 5) for i in range(40)]
    kinds = {"string": [f"id{i % 13:02d}" for i in range(36)] + [None] * 4, "double": [i / 7 for i in range(38)] + [None] * 2, "bigint": [(1 << 60) + i // 3 for i in range(39)] + [None], "int": [None] * 40}
    for kind, ids in kinds.items():
        rows = list(zip(ids, texts)) + [(ids[0], texts[0]), (ids[-1], texts[-1])]
        docs = spark.createDataFrame(rows, f"doc_id {kind}, text string")
        tie = {r["text"]: r["h"] for r in docs.withColumn("h", F.xxhash64("text")).collect()}
        order = sorted(rows, key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, tie[x[1]]), reverse=True)
        want = sorted((repr(i), hashlib.sha256(fingerprints.edited(t, n).encode()).hexdigest()) for (i, t), (_, n) in zip(order, order[1:] + order[:1]))
        assert sorted((repr(r["doc_id"]), r["edited_sha256"]) for r in fingerprints.fingerprints(docs).collect()) == want


def test_linked_fingerprints(spark):
    texts = near_texts()
    docs = documents(spark, texts, clash=False).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = {i: set(bag(t)) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in sets:
        for j in sets:
            if i != j and (both := len(sets[i] & sets[j])) and both / len(sets[i] | sets[j]) >= 0.8:
                root[max(find(i), find(j))] = min(find(i), find(j))
    got = {r["doc_id"]: r["class_id"] for r in fingerprints.link_fingerprints(docs.withColumn("key", F.lit(1))).collect()}
    assert got == {i: find(i) for i in sets}


def test_spread_join_splits_hot_keys_and_keeps_all_rows(spark):
    from peakloom.llm.neardup import spread_join

    rows = [(i, 0 if i % 3 else i) for i in range(9000)]
    big = spark.createDataFrame(rows, "i int, k int")
    small = spark.createDataFrame([(k, k * 2) for k in range(0, 9000, 2)], "k int, v int")
    counts = big.groupBy("k").count().withColumnRenamed("count", "n")
    have = set(range(0, 9000, 2))
    assert sorted(tuple(r) for r in spread_join(big, small, "k", counts).select("i", "k", "v").collect()) == sorted((i, k, 2 * k) for i, k in rows if k in have)
    assert sorted(tuple(r) for r in spread_join(big, small, "k", counts, "left").select("i", "v").collect() if r["v"] is None) == sorted((i, None) for i, k in rows if k not in have)
    assert spread_join(big.where("false"), small, "k", counts.where("false")).count() == 0


def test_hashes_of_words_keep_nothing():
    """Hashes are those of xxh3, no word is remembered, and distinct values are those of numpy."""
    import numpy as np
    import xxhash

    from peakloom.llm.common import WordHashes, distinct

    hashes = WordHashes()
    tokens = [b"a", b"\xc3\xa9", b"a", b"x" * 300]
    assert hashes.of(tokens).tolist() == [xxhash.xxh3_64_intdigest(t) for t in tokens] and hashes.of([]).dtype == np.uint64
    assert not isinstance(hashes, dict) and not vars(hashes)
    for x in (np.array([], np.uint64), np.array([2**64 - 1, 3, 3, 0], np.uint64)):
        assert distinct(x).tolist() == np.unique(x).tolist() and distinct(x).dtype == np.uint64
