"""Sharding, chat rotation and top-k search."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercadia.llm.catalog import op9_rendezvous_sharding
from mercadia.llm.chat import assemble, rotate_perspectives
from mercadia.llm.rendezvous import rendezvous_shard, shard_records
from mercadia.llm.topk import search_block, top_k_inner_product


def check_slots(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_sharding_query(spark, small_docs):
    _, texts = small_docs
    rows = op9_rendezvous_sharding(spark, "/root/testdata/sf0.001").collect()
    check_slots(rows)
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts.items()}
    assert all(r.law == "key" and (r.grown_shard == r.shard or r.grown_shard == 16) for r in rows)


def test_weights_shares_and_moves(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    n = Counter(r.s for r in df.select(rendezvous_shard(F.col("k"), [1, 2, 0, 5]).alias("s")).collect())
    assert n[2] == 0 and all(abs(n[i] / 20_000 - w / 8) < 0.02 for i, w in ((0, 1), (1, 2), (3, 5)))
    with pytest.raises(ValueError):
        rendezvous_shard(F.col("k"), [0.0])


def test_sharding_of_odd_rows(docs_of):
    docs = docs_of([(None, None), (None, "a"), (5, "a"), (5, "a"), (6, "")])
    rows = shard_records(docs, "doc_id", [1.0] * 3, rows_per_block=1).collect()
    check_slots(rows)
    assert len(rows) == 5 and len({r.shard for r in rows if r.doc_id is None}) == 1 and len({r.shard for r in rows if r.doc_id == 5}) == 1
    assert shard_records(docs.where(F.lit(False)), "doc_id", [1.0]).collect() == []


def test_rotation(spark):
    turns = [(1, 0, "system", "rules"), (1, 1, "ann", "hi"), (1, 2, "bob", "héllo"), (1, 2, "bob", "héllo"), (1, 3, None, None),
             (2, 0, "system", "only"), (None, 0, "cat", "x"), (3, None, "dan", "first"), (3, 200, "dan", "last")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("name", F.lit("clash"))
    pieces = rotate_perspectives(df, turns_per_block=2)
    whole = {(r.conv_id, r.speaker): r for r in assemble(pieces).collect()}
    assert whole.keys() == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "cat"), (3, "dan")}
    bob = whole[1, "bob"]
    assert bob.rendered == ("<|im_start|>system\nrules<|im_end|>\n<|im_start|>user name=ann\nhi<|im_end|>\n"
                            "<|im_start|>assistant\nhéllo<|im_end|>\n<|im_start|>assistant\nhéllo<|im_end|>\n<|im_start|>user name=unknown\n<|im_end|>\n")
    assert [bob.rendered[a:b] for a, b in bob.masks] == ["héllo<|im_end|>"] * 2
    assert [whole[3, "dan"].rendered[a:b] for a, b in whole[3, "dan"].masks] == ["first<|im_end|>", "last<|im_end|>"]
    by = defaultdict(list)
    for r in pieces.collect():
        by[r.conv_id, r.speaker].append(r)
    for rows in by.values():
        at = 0
        for i, r in enumerate(sorted(rows, key=lambda r: r.seq)):
            assert (r.seq, r.start_at, r.end_at) == (i, at, at + len(r.rendered))
            at = r.end_at
    assert rotate_perspectives(df.where(F.lit(False))).collect() == []
    assert not any("Python" in x for x in pieces._jdf.queryExecution().executedPlan().toString().split())


def brute_top_k(vectors, queries, k, scale=64.0):
    whole = [(i, np.floor(scale * np.array(v, float))) for i, v in vectors
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, qv in whole:
        if q in queries:
            scored = sorted((-int(qv @ v), i) for i, v in whole if i != q and len(v) == len(qv))[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)}
    return out


def test_top_k_with_odd_vectors(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rnd.normal(size=20)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 20), (403, [float("inf")] * 20), (None, rows[1][1]), (405, []), (406, []), (407, [2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(5)
    got = top_k_inner_product(df, df.where("vec_id % 20 = 0 OR vec_id > 400"), 7)
    assert {tuple(r) for r in got.collect()} == brute_top_k(rows, {i for i, _ in rows if i is not None and (i % 20 == 0 or i > 400)}, 7)
    assert top_k_inner_product(df.where(F.lit(False)), df, 7).collect() == [] == top_k_inner_product(df, df.where(F.lit(False)), 7).collect()


def test_pruning_keeps_the_best():
    rnd = np.random.default_rng(2)
    q, c = np.floor(rnd.normal(size=(64, 3)) * 9), np.floor(rnd.normal(size=(64, 5000)) * 9)
    best = [(np.zeros(0), np.zeros(0, "i8"))] * 3
    for at in range(0, 5000, 700):
        search_block(np.array([-1, -2, 5]), q, np.arange(at, min(5000, at + 700)), c[:, at:at + 700], 20, best, 8)
    for j, own in enumerate((-1, -2, 5)):
        s = q[:, j] @ c
        want = [i for i in np.lexsort((np.arange(5000), -s)) if i != own][:20]
        assert best[j][1].tolist() == want
