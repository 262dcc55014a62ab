"""Encoding, counting and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mercadia.llm.bpe import Encoder, coder, decode_documents, encode_documents, encoding_digests
from mercadia.llm.packing import pack_documents, pack_pieces, plan_sequences
from mercadia.llm.token_counts import count_tokens, counter
from mercadia.llm.vocabulary import vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_every_token_encodes_to_itself():
    voc = vocabulary(PATH)
    encoder = Encoder(voc)
    assert all(encoder.encode_bytes(b) == [i] for b, i in voc.ids.items())


def test_random_texts_equal_the_library():
    voc, memo, decoder = coder(PATH)
    _, counts = counter(PATH)
    rnd = random.Random(3)
    for k in range(1500):
        text = "".join(rnd.choice("aeiouthsn rAB01   '\n.é漢 ՘\U0003fc3b") for _ in range(rnd.randint(0, 40)))
        text += "<|endoftext|>" + text if k % 7 == 0 else ""
        units = voc.units(text)
        memo.cover([units])
        counts.cover([units])
        mine = [i for u in units for i in memo[u]]
        assert mine == ids_of(text) and sum(counts[u] for u in units) == len(mine)
        assert decoder.decode(np.array(mine, np.int64)) == LIBRARY.decode(mine, skip_special_tokens=False)


def test_a_word_is_encoded_once_whatever_mark_follows(monkeypatch):
    from mercadia.llm import bpe
    voc, memo, _ = coder(PATH)
    encoded, encode = [], Encoder.encode_bytes
    monkeypatch.setattr(bpe.Encoder, "encode_bytes", lambda self, data: encoded.append(data) or encode(self, data))
    text = "so ghqwertzuiopé ghqwertzuiopé, ghqwertzuiopé. ghqwertzuiopé: ghqwertzuiopé!? ghqwertzuiopé"
    units = voc.units(text)
    memo.cover([units])
    assert [i for u in units for i in memo[u]] == ids_of(text)
    assert "".join(memo[u].decimal for u in units) == "".join(f"{i}," for i in ids_of(text))
    # once on its own, once in the unit with two marks, which is split as a whole
    assert encoded.count(" ghqwertzuiopé".encode()) <= 2


def test_a_full_memo_of_units_keeps_giving_ids():
    from mercadia.llm.bpe import UnitMemo
    memo = UnitMemo(Encoder(vocabulary(PATH)), 5)
    text = " ".join(f"wörd{i % 13}, thing{i % 7}. the{i % 3}xq" for i in range(100))
    for _ in range(2):
        assert [i for u in vocabulary(PATH).units(text) for i in memo[u]] == ids_of(text)
        assert len(memo) <= 5 and len(memo.older) <= 5


def test_digests_and_counts_of_odd_texts(docs_of, odd_texts):
    docs = docs_of([*enumerate(odd_texts), (None, "no id"), (3, "repeated id")])
    want = sorted((i if i is None else int(i), t or "") for i, t in [*enumerate(odd_texts), (None, "no id"), (3, "repeated id")] if i is not None)
    rows = [r for r in encoding_digests(docs, PATH).collect() if r.doc_id is not None]
    assert len(rows) == len(want)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(
        (i, len(ids_of(t)), digest(",".join(map(str, ids_of(t)))), digest(LIBRARY.decode(ids_of(t), skip_special_tokens=False))) for i, t in want)
    counted = [r for r in count_tokens(docs, PATH, limit=2).collect() if r.doc_id is not None]
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in counted) == sorted(
        (i, len(t.encode()), len(ids_of(t)), len(ids_of(t)) > 2) for i, t in want)


def test_round_trip(small_docs):
    df, texts = small_docs
    back = {r.doc_id: r.text for r in decode_documents(encode_documents(df, PATH), PATH).collect()}
    assert back == texts


def test_empty_tables(docs_of):
    empty = docs_of([(1, "x")]).where(F.lit(False))
    for df in (encoding_digests(empty, PATH), count_tokens(empty, PATH, 5), encode_documents(empty, PATH), pack_documents(empty, PATH, 16)):
        assert df.collect() == []


@pytest.mark.parametrize("seed", range(40))
def test_plans_are_packings(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([1, 2, 6, 20, 100, 2048])
    counts = {}
    for _ in range(rnd.randint(0, 300)):
        n = rnd.randint(1, max(1, capacity // rnd.choice([1, 2, 3])))
        counts[n] = counts.get(n, 0) + rnd.choice([1, 1, 2, 3, 50])
    plan = plan_sequences(counts, capacity)
    place, seen = {}, dict.fromkeys(counts, 0)
    for n, first, last, each, sequence, offset in plan.runs:
        assert first == seen[n]
        seen[n] = last
        for i in range(last - first):
            place.setdefault(sequence + i // each, []).append((offset + (i % each) * n, n))
    assert seen == counts and sorted(place) == list(range(plan.sequences))
    for spans in place.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in spans) <= 2
    # no two sequences of small pieces could be one
    assert plan.sequences <= 2 * -(-sum(n * c for n, c in counts.items()) // capacity) + 1


def test_large_items_are_matched_best():
    plan = plan_sequences({60: 2, 50: 3, 40: 2}, 100)  # 60+40 twice, 50+50, 50
    assert plan.sequences == 4


@pytest.mark.parametrize("capacity", [7, 64])
def test_packing_of_documents(docs_of, odd_texts, capacity):
    texts = dict(enumerate(odd_texts))
    rows = pack_documents(docs_of(list(texts.items())), PATH, capacity, keep_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == texts.keys()
    for doc, pieces in by_doc.items():
        ids, at = [*ids_of(texts[doc]), 0], 0
        for i, p in enumerate(sorted(pieces, key=lambda p: p.piece)):
            own = ids[at:at + p.length]
            assert (p.piece, p.start, p.ids) == (i, at, own) and (i == 0 or p.length == capacity)
            assert p.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for spans in by_sequence.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= capacity


def test_repeated_pieces_each_have_a_place(spark):
    pieces = spark.createDataFrame([(1, 0, 0, 3)] * 5 + [(None, 0, 0, 3)] * 2, "doc_id long, piece int, start long, length long")
    rows = pack_pieces(pieces, 7).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 7 and len({r.sequence_id for r in rows}) == 4


def test_long_white_space_and_long_words():
    """tiktoken's pattern ends at about a million spaces; a word's memory grows with its tokens alone."""
    import tracemalloc

    from mercadia.llm.bpe import Encoder
    from mercadia.llm.packing import LONG_GAP, text_ids
    from mercadia.llm.vocabulary import vocabulary
    library = Tokenizer.from_file(PATH)
    ids = text_ids(PATH)
    want = lambda t: library.encode(t, add_special_tokens=False).ids
    special = next(iter(vocabulary(PATH).specials))
    for n in (LONG_GAP, LONG_GAP + 1, 1_000_000):
        for t in ("x" + " " * n + "word", " " * n, "\n" * n + "a", " " * n + special + "\n" * n, "a" + " \t" * (n // 2) + "c's " + "\n" * n):
            assert ids(t).tolist() == want(t), (n, t[:4])
    encoder = Encoder(vocabulary(PATH))
    word = "theingqux" * 100_000
    tracemalloc.start()
    got = encoder.encode_bytes(word.encode())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == want(word) and peak < 20 * len(word)
