"""The corpus pipeline, stage by stage, against brute force on planted documents."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from mercadia.llm.pii_crf import base_spans
from tests.llm.test_texts import brute_base, brute_components, brute_removed

SYLLABLES = ["an", "ter", "lo", "mi", "sen", "ra", "tu", "vel", "ko", "bi", "é"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    clean = [text(rnd.randint(60, 150)) for _ in range(60)]
    passage = text(70)
    rows = {i: t for i, t in enumerate(clean)}
    rows |= {100: clean[0], 101: clean[0].encode().upper().decode(), 102: clean[1] + " " + text(3), 103: text(60) + " " + passage, 104: passage + " " + text(60),
             105: text(60) + " mail ann.b@example.org or +1 (443) 555-5793 from 10.0.0.1 with 4111 1111 1111 1111 " + text(10),
             106: "too short", 107: "same thing again " * 60, 108: None, 109: ""}
    data = [(i, t, "xx", f"s{i % 3}", len(t or "")) for i, t in rows.items()]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path_factory.mktemp("corpus"))
    df.write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def test_stages(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "suffix_array_dedup", "skip_chain_pii", "best_fit_packing"]
    for name, stage in pipeline.STAGES:
        docs = pipeline.cut_lineage(stage(spark, docs, folder), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
            seen[name] = {r.doc_id: r for r in docs.collect()}
    quality, near, passages, private = ({i: r.text for i, r in own.items()} for own in seen.values())

    failed = {i for i, t in rows.items() if (c := brute_base(t or ""))[0] < 50 or 2 * c[4] > c[0]}
    assert failed == {106, 107, 108, 109} and quality == {i: t for i, t in rows.items() if i not in failed}  # noise apart, all text is kept
    components = brute_components(quality, 5, 80)
    assert near == {i: t for i, t in quality.items() if components[i][1] == i} and not {100, 101, 102} & near.keys()
    cover = brute_removed(sorted((i, t.encode()) for i, t in near.items()), 100)
    want = {i: bytes(c for c, m in zip(t.encode(), cover[i], strict=True) if not m).decode("utf-8", "ignore") for i, t in near.items()}
    assert passages == want and len(passages[104]) < len(near[104])
    assert all(t == private[i] for i, t in passages.items() if not any(base_spans(t)))
    assert not any(any(base_spans(t)) for t in private.values())
    assert "[EMAIL] or [PHONE] from [IP] with [CARD]" in private[105]
    assert all(r.n_chars == len(r.text) and r.source == f"s{i % 3}" for i, r in seen["skip_chain_pii"].items())

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = docs.collect()
    assert sum(p.length for p in pieces) == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in private.values())
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert all(sum(n for _, n in s) <= 2048 for s in by.values())

    again = {(p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pipeline.run(spark, folder).collect()}
    assert again == {(p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces}


def test_odd_rows(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.unionByName(docs.where("doc_id IN (3, 4)")).unionByName(docs.where("doc_id IN (5, 7)").withColumn("doc_id", F.lit(None).cast("long")))
    odd = odd.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang"))).withColumn("source", F.lit(None).cast("string")).withColumn("label", F.lit(1))
    for name, stage in pipeline.STAGES:
        odd = pipeline.cut_lineage(stage(spark, odd, folder), name)
        if name == "ngram_jaccard_join":
            ids = [r.doc_id for r in odd.select("doc_id").collect()]
            assert len(ids) == len(set(ids)) and None not in ids and {3, 4, 5, 7} <= set(ids)
    assert odd.count() > 0
    empty = docs.where(F.lit(False))
    for _, stage in pipeline.STAGES:
        empty = stage(spark, empty, folder)
    assert empty.collect() == []


def test_near_duplicates_of_shared_and_missing_ids(spark, docs_of):
    rnd = random.Random(14)
    text = lambda: " ".join("".join(rnd.choices(SYLLABLES, k=3)) for _ in range(80))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(1, a), (None, a), (None, b), (None, None), (None, ""), (3, c), (7, c + " more"), (7, d), (7, d), (None, e), (None, e + " more"), (None, e)]
    got = sorted(((r.doc_id or 0, r.text) for r in pipeline.near_duplicates(spark, docs_of(rows), "").collect()), key=str)
    assert [r for r in got if not (r[1] or "").startswith(e)] == sorted([(1, a), (0, b), (0, None), (0, ""), (3, c), (7, d)], key=str)
    assert len([r for r in got if (r[1] or "").startswith(e)]) == 1
