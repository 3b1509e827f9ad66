"""Tokenizer, decontamination, quality, line dedup, chat repair."""

import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from peakloom.llm import bpe, chat_repair, decontaminate, line_dedup, quality_mil
from peakloom.llm.common import words
from tests.llm.data import TEXTS, documents, plain

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_bpe_equals_the_library(spark, sf):
    ranks = bpe.read_ranks(PATH)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(ranks), special_tokens={})
    odd = ["aaaa" * 200, "abab" * 300, "  \n\n  x \t", "<|endoftext|>", "é" * 500, "".join(random.Random(1).choices("abcdefghij", k=4000))]
    docs = documents(spark, TEXTS + odd).withColumns({c: F.lit("clash") for c in ("n_tokens", "ids_sha256", "ids")})
    docs = docs.unionByName(spark.read.parquet(f"{sf}/documents.parquet"), allowMissingColumns=True)
    texts = {hashlib.sha256((r["text"] or "").encode()).hexdigest(): r["text"] or "" for r in docs.collect()}
    rows = bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN).collect()
    for r in rows:
        ids = library.encode_ordinary(texts[r["decoded_sha256"]])  # the decoded bytes are the text's
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    assert bpe.encode_decode(documents(spark, []), ranks, public_tokenizers.PATTERN).count() == 0


def brute_hits(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        q = words(t)
        n = min(13, len(q))
        for j in range(len(q) - n + 1 if q else 0):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == q[j : j + n]:
                    hit.update(range(i, i + n))
                    found.add(item)
    return hit, sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination(spark, sf, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    r = random.Random(5)
    items = [(str(i), " ".join(r.choices("alpha beta gamma delta".split(), k=k))) for i, k in enumerate([1, 2, 3, 12, 13, 14, 20, 30])]
    items[0] = ("0", "Omega!")
    items += [("8", "..."), ("9", TEXTS[4]), ("9", TEXTS[4])]
    texts = [" ".join(r.choices("alpha beta gamma delta omega".split(), k=60)) for _ in range(20)] + [f"x {t} y {t}" for _, t in items] + TEXTS
    docs = documents(spark, texts)
    bench = spark.createDataFrame([*[(int(i), t) for i, t in items], (99, None), (98, "")], "item_id bigint, text string").withColumn("spans", F.lit(1))
    rows = decontaminate.decontaminate(docs, bench).where("doc_id is not null").dropDuplicates(["doc_id"]).collect()
    assert len(rows) == len(texts)
    for row in rows:
        t = texts[row["doc_id"]]
        hit, found = brute_hits(t, items)
        n = len(words(t))
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n, len(hit), len(found))
        assert row["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert row["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= n)
        spans = set(itertools.chain.from_iterable(range(a, b) for a, b in zip(row["spans"][::2], row["spans"][1::2])))
        assert spans == hit
        left = decontaminate.excise(t, row["spans"])
        assert len(words(left)) == n - len(hit)
    kept = decontaminate.clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == decontaminate.decontaminate(docs, bench).where("not contaminated").count()
    none = bench.where("false")
    assert decontaminate.decontaminate(docs, none).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs.where("false"), bench).count() == 0


def test_fm_index_against_scan():
    r = np.random.default_rng(2)
    for _ in range(30):
        segments = [r.integers(1, 4, r.integers(1, 12)) for _ in range(6)]
        text = np.concatenate([x for s in segments for x in ([0], s)] + [[0]])
        index = decontaminate.FMIndex(text, np.flatnonzero(text == 0))
        patterns = r.integers(1, 5, (10, 3))
        number, lo, hi = index.search(patterns)
        got = {int(k): sorted(index.locate(np.arange(a, b)).tolist()) for k, a, b in zip(number, lo, hi)}
        for k, p in enumerate(patterns):
            where = [i for i in range(len(text) - 2) if (text[i : i + 3] == p).all()]
            assert got.get(k, []) == where


def test_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumn("text", F.lit("clash"))
    model = quality_mil.train(docs, labels)
    scored = quality_mil.score_quality(docs, model).join(labels.select("doc_id", "quality"), "doc_id").where("held_out").collect()
    assert len(scored) > 50
    assert sum(r["predicted"] == r["quality"] for r in scored) / len(scored) >= 0.95
    odd = documents(spark)
    rows = quality_mil.score_quality(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_mil.accepted(odd, model).columns == odd.columns
    empty = quality_mil.train(odd, labels.where("false"))
    assert {r["score"] for r in quality_mil.score_quality(odd, empty).collect()} == {0.5}
    assert quality_mil.score_quality(odd.where("false"), model).count() == 0


def test_quality_training_is_bounded(spark, monkeypatch):
    """Repeated ids train once, whichever row comes first, and long documents give so many passages at most."""
    seen = []
    monkeypatch.setattr(quality_mil, "TRAIN_PASSAGES", 5)
    monkeypatch.setattr(quality_mil.Model, "fit", lambda self, bags, labels, rng: seen.append((bags, labels)) or self)
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(TEXTS))] + [(10, 1), (10, 0), (None, 1), (3, None)], "doc_id bigint, quality int")
    for d in (docs, docs.unionByName(docs).repartition(3), docs.unionByName(docs.withColumn("text", F.lit("other"))).orderBy(F.desc("text"))):
        quality_mil.train(d, labels)
    ids = docs.select("doc_id").where(f"doc_id is not null and doc_id < {len(TEXTS)}").distinct().where(~quality_mil.held_out("doc_id")).count()
    assert [len(bags) for bags, _ in seen] == [ids] * 3 and max(len(b) for bags, _ in seen for b in bags) == 5
    assert all((a == b).all() for a, b in zip(seen[0][0], seen[1][0]))


def test_quality_gradients():
    r = np.random.default_rng(0)
    m = quality_mil.Model(r)
    x, at, y = r.standard_normal((7, quality_mil.N_FEATURES)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])
    loss = lambda: -np.mean(y * np.log(m.forward(x, at)["y"]) + (1 - y) * np.log(1 - m.forward(x, at)["y"]))
    grad = m.gradients(x, at, y)
    for k, v in m.p.items():
        i = tuple(int(r.integers(n)) for n in v.shape)
        v[i] += 1e-5
        up = loss()
        v[i] -= 2e-5
        down = loss()
        v[i] += 1e-5
        assert abs((up - down) / 2e-5 - grad[k][i]) < 1e-6


@pytest.mark.parametrize("broadcast_bytes", [line_dedup.BROADCAST_BYTES, -1])
def test_line_dedup(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", broadcast_bytes)
    r = random.Random(9)
    texts = ["\n".join([r.choice(["menu", " menu\t", "home | about"])] * r.randint(0, 2) + [f"body {i}", "", r.choice(["x", "y"])]) for i in range(60)] + TEXTS
    docs = documents(spark, texts).withColumns({c: F.lit(1) for c in ("_bad", "_lines", "_n_lines", "n_lines", "n_dropped", "row", "_host", "_key", "_text")})
    host = F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("h"), (F.col("doc_id") % 3).cast("string")))
    rows = docs.withColumn("h", host).collect()
    per: dict = {}
    for x in rows:
        per.setdefault(x["h"] or "", []).append({s for s in (y.strip(" \t\r") for y in (x["text"] or "").split("\n")) if s})
    bad = {h: {s for s in set().union(*p) if (n := sum(s in q for q in p)) >= line_dedup.MIN_PAGES and n > line_dedup.RATIO * len(p)} for h, p in per.items()}
    want = []
    for x in rows:
        ls = x["text"].split("\n") if x["text"] is not None else []
        kept = [y for y in ls if y.strip(" \t\r") not in bad[x["h"] or ""]]
        want.append((x["doc_id"], "\n".join(kept) if x["text"] is not None else None, len(ls), len(ls) - len(kept)))
    got = line_dedup.drop_boilerplate(docs, host)
    assert got.columns == ["row", "n_lines", "n_dropped"] and got.select("row.*").columns == docs.columns
    assert plain(got.select("row.doc_id", "row.text", "n_lines", "n_dropped").collect()) == plain(want)
    assert any(w[3] for w in want)
    assert line_dedup.drop_boilerplate(docs.where("false"), host).count() == 0


def brute_cost(roles):
    """Least (cost, turns) over all repairs, by search over states and insertions."""
    names = chat_repair.STATES
    best = {"start": (0, 0)}

    def spread(b):
        b = dict(b)
        for _ in range(6):
            for s, (c, n) in list(b.items()):
                for t in chat_repair.MOVES[s]:
                    x = (c + chat_repair.INSERT, n + 1)
                    if x < b.get(t, (1e9, 0)):
                        b[t] = x
        return b

    for r in roles:
        new: dict = {}
        wide = spread(best)
        for t in names[1:]:
            base = 0 if t == r else chat_repair.RELABEL
            options = [(c + base, n + 1) for s, (c, n) in wide.items() if t in chat_repair.MOVES[s]]
            options += [(c + base + chat_repair.MERGE, n) for s, (c, n) in best.items() if s == t]
            if options:
                new[t] = min(options)
        best = new
    return spread(best).get(chat_repair.FINAL)


def test_chat_repair(spark):
    r = random.Random(4)
    rows, want = [], {}
    for conv in range(80):
        roles = [r.choice(["user", "assistant", "system", "tool", None, " User", "bot"]) for _ in range(r.randint(1, 7))]
        rows += [(conv, i, x, r.choice(["hi", "", None, "line\nline"])) for i, x in enumerate(roles)]
        want[conv] = brute_cost([chat_repair._role(x) for x in roles])
    hot = [(1000, i, ("user", "assistant", "user")[i % 3], f"t{i}") for i in range(900)]
    want[1000] = brute_cost([x[2] for x in hot])
    rows += hot + [(None, 0, "user", "q"), (None, 0, "user", "q"), (None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(7).withColumn("seq", F.lit("clash"))
    got: dict = {}
    for x in chat_repair.repair_chats(turns).collect():
        got.setdefault(x["conv_id"], []).append(x)
    assert sum(map(len, got.values())) == len(rows)
    for conv, c in want.items():
        part = sorted(got[conv], key=lambda x: x["turn"])
        assert sum(x["cost"] for x in part) == c[0]
        text = "".join(x["rendered"] for x in part)
        heads = re.findall(r"<\|(system|user|assistant|tool)\|>", text)
        assert len(heads) == c[1] == part[-1]["seq"] + part[-1]["inserted_after"]
        state = "start"
        for h in heads:
            assert h in chat_repair.MOVES[state]
            state = h
        assert state == chat_repair.FINAL
        assert text.count("<|end|>\n") == len(heads)
    good = [x for x in got[1000] if x["action"] == "keep"]
    assert good and chat_repair.repair_chats(turns.where("false")).count() == 0
