"""Suffix-array dedup, Jaccard join, personal data and quality rules against brute force."""

import functools
import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadia.llm import jaccard_join, pii_crf, suffix_dedup
from mercadia.llm.jaccard_join import connected_components, jaccard_components, shingle_sets
from mercadia.llm.perplexity import GramCounts, base_counts, perplexity_quality
from mercadia.llm.pii_crf import KINDS, OTHER, Field, base_spans, edges, find_spans, label_counts, luhn, mentions, personal_data, redact
from mercadia.llm.suffix_dedup import _spans, dedup_digests, remove_repeats


# --- suffix-array dedup

def brute_removed(texts, length):
    """Covered bytes of each (key, bytes), in order."""
    seen, out = set(), {}
    for key, b in texts:
        cover = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                cover[p:p + length] = b"\x01" * length
            else:
                seen.add(w)
        out[key] = cover
    return out


def check_dedup(rows, texts, length=100):
    want = brute_removed(texts, length)
    assert len(rows) == len(texts)
    for r in rows:
        b, cover = dict(texts)[r.doc_id], want[r.doc_id]
        kept = bytes(c for c, m in zip(b, cover, strict=True) if not m)
        runs = sum(1 for k, _ in itertools.groupby(cover) if k)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), sum(cover), runs, hashlib.sha256(kept).hexdigest()), r


def passages(rnd, n):
    words = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    return [" ".join(rnd.choices(words, k=60)) for _ in range(n)]


def test_dedup_of_odd_documents(spark, docs_of):
    rnd = random.Random(1)
    p = passages(rnd, 12)
    texts = [None, "", "short", p[0], p[0], p[0][:99], p[0][:100], "a" * 1000, "ab" * 600, "é" * 300, p[1] + p[0][5:180] + p[2],
             p[3][:90] + p[1][40:] + p[3], "a" * 350, p[4] + p[4], " " * 500, p[5] + "x" + p[5][:140], *p[6:]]
    texts += [p[6][:i] + rnd.choice("xyz") + p[6][i + 1:] for i in range(20, 300, 13)]  # near copies
    docs = docs_of(list(enumerate(texts))).repartition(7)
    check_dedup(dedup_digests(docs).collect(), [(i, (t or "").encode()) for i, t in enumerate(texts)])
    for length, gram in ((40, 8), (33, 32)):
        check_dedup(dedup_digests(docs, length=length, gram=gram).collect(), [(i, (t or "").encode()) for i, t in enumerate(texts)], length)
    same = docs.where(F.lit(False))
    assert dedup_digests(same).collect() == [] == remove_repeats(same).collect()


def test_dedup_of_long_texts(docs_of):
    rnd = random.Random(2)
    base = "".join(rnd.choices("abcdefgh ", k=1_200_000))  # longer than what is hashed at a time
    texts = [base[400_000:400_400], base, "y" + base[1_048_500:1_048_900], base[:300] + "|" + base[-300:]]
    check_dedup(dedup_digests(docs_of(list(enumerate(texts)))).collect(), [(i, t.encode()) for i, t in enumerate(texts)])


def test_dedup_of_a_frequent_gram(docs_of):
    rnd = random.Random(3)
    line = "Licensed to nobody in particular, version 2.0, all of it"  # shared by all, in other contexts each
    texts = ["".join(rnd.choices("abcdefgh ", k=150)) + line + "".join(rnd.choices("abcdefgh ", k=150)) for _ in range(300)]
    texts += [t[60:260] for t in texts[:40]]
    check_dedup(dedup_digests(docs_of(list(enumerate(texts)))).collect(), [(i, t.encode()) for i, t in enumerate(texts)])


def test_dedup_of_a_gram_that_is_frequent_in_one_partition(docs_of):
    rnd = random.Random(12)
    line = "Licensed to nobody in particular, version 2.0, all of it"
    texts = ["".join(rnd.choices("abcdefgh ", k=150)) + line + "".join(rnd.choices("abcdefgh ", k=150)) for _ in range(300)]
    cuts = [(rnd.randint(60, 150), rnd.randint(100, 160)) for _ in range(60)]
    copies = [t[a:a + n] for t, (a, n) in zip(texts, cuts, strict=False)]
    rows = list(enumerate(texts + copies))
    parts = [rows[:300], *(rows[at:at + 20] for at in range(300, 360, 20))]  # the gram is frequent in the first alone
    docs = functools.reduce(DataFrame.unionByName, [docs_of(p).coalesce(1) for p in parts])
    check_dedup(dedup_digests(docs).collect(), [(i, t.encode()) for i, t in rows])


def test_dedup_asks_long_windows_in_chunks():
    rnd = random.Random(13)
    text = rnd.randbytes(8_000_000)
    ask = np.arange(8000) * 900 << 16 | 400  # 8000 stretches of 1400 bytes, more than the places of one chunk
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text], pa.binary()), pa.array([ask.tolist()])],
                                       ["_doc", "_tag", "_bytes", "asked"])
    grams, starts = [], []
    for row in suffix_dedup._index_contexts(1000, 32, 1)([batch]):
        for data in row.column("data").to_pylist():
            c = suffix_dedup.Contexts.unpacked(data, 2 * len(suffix_dedup._context_widths(1000, 32)))
            grams += c["gram"].tolist()
            starts += (c["place"]["start"] + c["ahead"]).tolist()
    assert len(grams) == len(ask)
    h = suffix_dedup.gram_hashes(np.frombuffer(text, np.uint8), 32)
    assert h[starts].tolist() == grams


def test_dedup_of_small_table(small_docs):
    df, texts = small_docs
    check_dedup(dedup_digests(df).collect(), sorted((k, t.encode()) for k, t in texts.items()))


def test_repeated_ids_and_removal(docs_of):
    p = passages(random.Random(4), 3)
    docs = docs_of([(1, p[0]), (1, p[1]), (1, p[1]), (None, p[2]), (7, "é" + p[0] + "é"), (8, p[2]), (9, None)])
    rows = [r for r in dedup_digests(docs).collect()]
    assert [r.n_removed for r in rows if r.doc_id == 1] == [0, 0, 0] and [r.n_removed for r in rows if r.doc_id is None] == [0]
    got = sorted((r.doc_id or 0, r.text) for r in remove_repeats(docs).collect() if r.text is not None)
    assert got == sorted([(0, p[2]), (1, p[0]), (1, p[1]), (1, p[1]), (7, "éé"), (8, "")])
    assert remove_repeats(docs).columns == docs.columns


def test_spans_merge():
    pack = lambda *w: np.array([s << 16 | m for s, m in w])
    assert _spans(pack((50, 0), (0, 3), (4, 0), (30, 0)), 10) == [(0, 14), (30, 40), (50, 60)]
    assert _spans(None, 10) == []


# --- Jaccard join

def brute_components(texts, words, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = set(zip(*[w[k:] for k in range(words)], strict=False)) if len(w) >= words else {tuple(w)} if w else set()
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_shingles_of_whole_texts(odd_texts):
    for t in odd_texts:
        for words in (1, 4, 5):
            w = (t or "").encode().lower().split()
            n = len(set(zip(*[w[k:] for k in range(words)], strict=False))) if len(w) >= words else int(bool(w))
            assert len(shingle_sets([(t or "").encode()], words)[0]) == n


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80), (2, 30)])
def test_jaccard_against_brute_force(docs_of, odd_texts, words, percent):
    rnd = random.Random(words)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = list(odd_texts)
    line = rnd.choices(vocabulary, k=25)
    for size in (6, 20, 21, 40, 90):
        base = rnd.choices(vocabulary, k=size)
        for k in range(14):  # copies at growing distance, some in other case
            own = list(base)
            for _ in range(k // 2):
                own[rnd.randrange(size)] = rnd.choice(vocabulary)
            texts.append((" " if k % 2 else "\n").join(own).upper() if k % 3 == 0 else " ".join(own[: size - k // 4]))
    texts += [" ".join(line + rnd.choices(vocabulary, k=rnd.randint(0, 30))) for _ in range(80)]  # a common passage
    own = dict(enumerate(texts))
    rows = jaccard_components(docs_of(list(own.items())).repartition(5), words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(own, words, percent)


@pytest.mark.parametrize("dense", [0, 1 << 60])
def test_jaccard_recursion(docs_of, monkeypatch, dense):
    """Many members to a region, few to a leaf: pivots, cells and windows decide."""
    monkeypatch.setattr(jaccard_join, "BUNDLE", 2)
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
    monkeypatch.setattr(jaccard_join, "DENSE_MEETINGS", dense)
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(40)]
    own = {}
    for i in range(90):
        words = list(base)
        for _ in range(rnd.randint(0, 8)):
            words[rnd.randrange(40)] = f"x{rnd.randrange(60)}"
        own[i] = " ".join(words)
    rows = jaccard_components(docs_of(list(own.items())), 2, 80).collect()
    want = brute_components(own, 2, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want and 2 < len({c for _, c in want.values()}) < 90


def test_sets_are_shuffled_to_their_bundles_only(docs_of, monkeypatch):
    plans, similar = [], jaccard_join._Compare.similar

    def seen(self, pairs):
        out = similar(self, pairs)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out
    monkeypatch.setattr(jaccard_join._Compare, "similar", seen)
    base = [f"w{i}" for i in range(60)]
    docs = docs_of([(k, " ".join(base[:50 + k % 3] + [f"x{k}"])) for k in range(9)] + [(9, "of its own it is")])
    rows = sorted((r.doc_id, r.component_id) for r in jaccard_components(docs, 2, 80).collect())
    assert rows == [(k, 0) for k in range(9)] + [(9, 9)]
    assert plans and not any("(cls#" in line for plan in plans for line in plan.splitlines() if "Join " in line)


def test_marked_keys_are_looked_up_alone(monkeypatch):
    rnd = np.random.default_rng(5)
    sets = [np.unique(rnd.integers(0, 1 << 64, n, np.uint64)) for n in (1, 2, 7, 40, 900)]
    common = np.unique(np.concatenate([jaccard_join._keys(s, 64)[::3] for s in sets]))
    often = np.arange(len(common), dtype=np.int32) % 9 + 4
    for bits in (2, 12, 23):
        monkeypatch.setattr(jaccard_join, "MARK_BITS", bits, raising=False)
        for held in ((common, often), (common[:0], often[:0])):
            marks = jaccard_join._marks(held[0])
            for s in sets:
                assert np.array_equal(jaccard_join.first_shingles(s, 80, *held, 64, marks), jaccard_join.first_shingles(s, 80, *held, 64))


def test_members_meet_cells_by_blocks_of_numbers(docs_of, monkeypatch):
    """A member's meetings come as arrays of longs, whose distinct ones Spark finds by hash (of
    structs, by comparing each with all others), and are the same however regions are cut into blocks."""
    plans, written = [], jaccard_join.cut_lineage

    def seen(df, name):
        if name == "met":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            out = written(df, name)
            rows = [tuple(r) for r in out.select("a", "b", "alone").collect()]
            assert len(rows) == len(set(rows))
            met.append(set(rows))
            return out
        return written(df, name)
    monkeypatch.setattr(jaccard_join, "cut_lineage", seen)
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    own = {}
    for i in range(120):
        words = list(base)
        for _ in range(rnd.randint(0, 9)):
            words[rnd.randrange(60)] = f"x{rnd.randrange(400)}"
        own[i] = " ".join(words)
    met, want = [], brute_components(own, 2, 80)
    for block in (1 << 30, 3):
        monkeypatch.setattr(jaccard_join, "BLOCK", block, raising=False)
        rows = jaccard_components(docs_of(list(own.items())), 2, 80).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert 2 < len({c for _, c in want.values()}) < 120 and met[0] == met[1] and len(met[0]) > 100
    assert len(plans) == 2 and not any("lambda" in plan for plan in plans)


@pytest.mark.parametrize(("size", "meetings"), [(1, 1), (5, 7), (1000, 1 << 20)])
def test_meetings_of_parts_in_any_batches(monkeypatch, size, meetings):
    monkeypatch.setattr(jaccard_join, "MEETINGS", meetings)
    rnd = random.Random(size)
    rows = [(region, part, head, rnd.randrange(1 << 62), rnd.randint(0, 1), rnd.randrange(5), rnd.randint(1, 3), rnd.randint(80, 100), rnd.randint(95, 105))
            for region in range(12) for part in range(rnd.randint(1, 3)) for head in (0, 1) for _ in range(rnd.randint(0, 8))]
    want = sorted((a[3], h[3], bool(h[4])) for a in rows for h in rows if a[:2] == h[:2] and not a[2] and h[2]
                  and h[6:4:-1] > a[6:4:-1] and 185 * min(a[7], h[7]) >= 85 * (a[8] + h[8]))
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[k:k + size], strict=True)], list(jaccard_join._MEETING))
               for k in range(0, len(rows), size)]
    got = sorted((a, m, alone) for out in jaccard_join._meet(85)(batches)
                 for a, alone, met in zip(*(c.to_pylist() for c in out.columns), strict=True) for m in met)
    assert got == want and len(want) > 5


def test_few_texts_with_many_places_are_shuffled_alone(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 3)
    texts = spark.createDataFrame([(i, i * 7, f"text {i}") for i in range(50)], "_doc long, _hash long, text string")
    few = spark.createDataFrame([(i, i * 7, [(k, 0) for k in range(9)]) for i in (4, 30)], "_doc long, _hash long, places array<struct<k:long,part:long>>")
    found = jaccard_join._Compare._picked(texts, few, ["_doc", "_hash"])
    assert sorted((r._doc, r.text, len(r.places)) for r in found.collect()) == [(4, "text 4", 9), (30, "text 30", 9)]
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def test_jaccard_of_odd_ids(docs_of):
    docs = docs_of([(None, "a b c d e f"), (4, "A b c d e f"), (4, "other words than those here"), (9, "a  b c d e f"), (None, ""), (2, None)])
    rows = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_components(docs, 4, 85).collect())
    assert rows == sorted([("None", 3, 4), ("4", 3, 4), ("4", 2, 4), ("9", 3, 4), ("None", 0, None), ("2", 0, 2)])
    assert jaccard_components(docs.where(F.lit(False)), 4, 85).collect() == []


def test_components_of_graphs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 3), (3, 9), (9, 5), (None, 4), (7, 7)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), 3: 3, 5: 3, 9: 3, 7: 7}


# --- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    return [[m.span() for m in EMAIL.finditer(t)],
            [m.span() for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))],
            [m.span() for m in CARD.finditer(t) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
            [m.span() for m in PHONE.finditer(t) if 9 <= len(digits(m[0])) <= 15]]


def test_base_spans_of_random_texts():
    rnd = random.Random(5)
    for _ in range(20_000):
        t = "".join(rnd.choice(rnd.choice(["ab@.", "0123 -.", "+1() .-9", "@a.-_%+", "x1 2\n", "٣1²"])) for _ in range(rnd.randint(0, 40)))
        assert base_spans(t) == brute_spans(t), t


def test_long_texts_take_linear_time():
    for t in ("1" * 200_000, "a" * 200_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "1 " * 100_000, "a.b@c" * 50_000):
        find_spans(t, Field({}))


@pytest.fixture(scope="module")
def field(spark):
    total = Counter()
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect():
        total.update(label_counts(mentions(r.text or "", base_spans(r.text or ""))))
    return Field(total)


def test_field_labels_repeated_mentions(field):
    t = "call +1 (443) 555-5793 now, or (443) 555-5793. card 4111 1111 1111 1111, in 2025 4111 1111 1111 1111 again"
    base, added = find_spans(t, field)
    assert {(KINDS[k], t[a:b]) for k, a, b in base} == {("phone", "+1 (443) 555-5793"), ("card", "4111 1111 1111 1111")}
    assert ("phone", "(443) 555-5793") in {(KINDS[k], t[a:b]) for k, a, b in added}
    far = t[:23] + "word " * 3000 + "and (443) 555-5793"
    assert ("phone", "(443) 555-5793") in {(KINDS[k], far[a:b]) for k, a, b in find_spans(far, field)[1]}


def test_field_finds_mentions_inside_long_runs(field):
    card, phone = "4111 1111 1111 1111", "+1 (443) 555-5793"
    for t, want in ((f"card {card}, then 1234 {card}", ("card", card)), (f"card {card}, then 98 7654 {card} 2025 12 31", ("card", card)),
                    (f"call {phone}, or 443 555 5793 212 555 0199 now", ("phone", "443 555 5793"))):
        base, added = find_spans(t, field)
        assert want in {(KINDS[k], t[a:b]) for k, a, b in added}, t
    clean = "table 10 20 30 40 50 60 70 80 90 100 110 120"
    assert find_spans(f"card {card} {clean}", field)[1] == []
    find_spans(card + " x " + "4111 1111 1111 1111 " * 20_000, Field({}))


def test_field_leaves_clean_texts_alone(field):
    for t in ("order 4111111111111112 of 2020-01-02 12:30", "version 2.0.1.300 and 1234567", "x@ y@z @home", "sha 186661156f3f9905942d708"):
        assert find_spans(t, field)[1] == [], t


def test_beliefs_are_exact_without_loops(field):
    t = "a +1 (443) 555-5793 b 8290493294200 c x@y d 12345678"
    nodes = mentions(t, base_spans(t))
    assert len(nodes) == 4
    by_kind = edges(nodes)
    score = np.zeros((OTHER + 1,) * len(nodes))
    for y in itertools.product(range(OTHER + 1), repeat=len(nodes)):
        score[y] = math.exp(sum(field._node(m)[k] for m, k in zip(nodes, y, strict=True))
                            + sum(field.edge[kind][y[i], y[j]] for kind, ps in by_kind.items() for i, j in ps))
    want = np.array([score.sum(axis=tuple(j for j in range(len(nodes)) if j != i)) for i in range(len(nodes))]) / score.sum()
    assert np.allclose(field.beliefs(nodes), want, atol=1e-3)


def test_personal_data_rows(docs_of, odd_texts, small_docs):
    df, texts = small_docs
    for docs, own in ((docs_of(list(enumerate(odd_texts))), dict(enumerate(odd_texts))), (df, texts)):
        rows = {r.doc_id: r for r in personal_data(docs).collect()}
        assert rows.keys() == own.keys()
        for i, t in own.items():
            spans = brute_spans(t or "")
            told = [f"{KINDS[k]}:{a}:{b}" for k, s in enumerate(spans) for a, b in s]
            r = rows[i]
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(len, spans))
            assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
            assert set(told) <= set(r.spans.split(",")) | {""} and len(told) + r.n_added == len([s for s in r.spans.split(",") if s])
    assert personal_data(df.where(F.lit(False))).collect() == []


def test_redaction(docs_of):
    docs = docs_of([(1, "mail a.b@c.de, 1.2.3.4"), (2, None), (3, "nothing 5"), (None, "+1 (443) 555-5793")])
    assert {r.doc_id: r.text for r in redact(docs).collect()} == {1: "mail [EMAIL], [IP]", 2: None, 3: "nothing 5", None: "[PHONE]"}
    assert redact(docs).columns == docs.columns


# --- quality rules

def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {i + d for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def test_base_counts(odd_texts, small_docs):
    rnd = random.Random(6)
    some = ["".join(rnd.choice("ab c\n#*|  \x0b\xa0\x1c") for _ in range(rnd.randint(0, 120))) for _ in range(3000)]
    for t in [*some, *(t or "" for t in odd_texts), *small_docs[1].values()]:
        assert base_counts(t) == brute_base(t), t


class PlainKneserNey:
    """Modified Kneser-Ney over the n-grams of marked words, with dictionaries."""

    def __init__(self, words, order):
        self.order, raw = order, defaultdict(Counter)
        for w, n in words.items():
            marked = "\x02" + w + "\x03"
            for j in range(1, len(marked)):
                for k in range(1, min(order, j + 1) + 1):
                    raw[k][marked[j - k + 1:j + 1]] += n
        self.p, self.back = [{} for _ in range(order + 1)], [{} for _ in range(order + 1)]
        lower = None
        for k in range(1, order + 1):
            ways = Counter(g[1:] for g in raw[k + 1])
            c = {g: n if k == order or (g[0] == "\x02") else ways.get(g, n) for g, n in raw[k].items()}
            of = Counter(c.values())
            y = of[1] / (of[1] + 2 * of[2]) if of[1] + 2 * of[2] else 0.0
            d = [min(0.95 * i, max(0.05, i - (i + 1) * y * of[i + 1] / of[i] if of[i] else 0.5 * i)) for i in (1, 2, 3)]
            own = {g: n - d[min(n, 3) - 1] for g, n in c.items()}
            total, mass, types = Counter(), Counter(), Counter()
            for g, n in c.items():
                total[g[:-1]] += n
                types[g[:-1]] += 1
            for g, n in own.items():
                mass[g[:-1]] += n
            self.back[k] = {h: max(1e-9, 1 - mass[h] / total[h]) for h in total}
            if k == 1:
                self.unseen = self.back[1][""] / (types[""] + 1)
                self.p[1] = {g: n / total[""] + self.unseen for g, n in own.items()}
            else:
                self.p[k] = {g: n / total[g[:-1]] + self.back[k][g[:-1]] * lower[g[1:]] for g, n in own.items()}
            lower = self.p[k]

    def log(self, w):
        marked, out = "\x02" + w + "\x03", 0.0
        for j in range(1, len(marked)):
            for k in range(min(self.order, j + 1), 0, -1):
                g = marked[j - k + 1:j + 1]
                if g in self.p[k]:
                    out += math.log(self.p[k][g])
                    break
                out += math.log(self.unseen) if k == 1 else math.log(self.back[k].get(g[:-1], 1.0))
        return out


def test_perplexities_equal_a_plain_model(spark, small_docs):
    df, _ = small_docs
    rows = perplexity_quality(df).collect()
    own = {r.doc_id: r for r in df.collect()}
    models = {}
    for lang in {r.lang for r in own.values()}:
        models[lang] = PlainKneserNey(Counter(w for r in own.values() if r.lang == lang for w in r.text.split()), 5)
    assert len(rows) == len(own)
    for r in rows:
        words = own[r.doc_id].text.split()
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_base(own[r.doc_id].text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        if words:
            want = -sum(map(models[r.lang].log, words)) / sum(len(w) + 1 for w in words)
            assert r.log_perplexity == pytest.approx(want, rel=1e-4)
        assert r.kept == (not r.base_failed and r.lower <= r.log_perplexity <= r.upper)


def test_quality_rejects_noise_and_keeps_text(docs_of):
    rnd = random.Random(7)
    syllables = ["an", "ter", "lo", "mi", "sen", "ra", "tu", "vel", "ko", "bi"]
    text = lambda n: " ".join("".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(n))
    rows = [(i, text(rnd.randint(60, 200)), "xx") for i in range(120)]
    noise = "".join(chr(rnd.randint(0x21, 0x2ff)) if rnd.random() < 0.85 else " " for _ in range(900))
    rows += [(500, noise, "xx"), (501, "an " * 40 + "terlo " * 40, "xx"), (502, None, "xx"), (503, "", None), (504, text(80), None), (None, text(80), "xx"), (505, "q", "yy")]
    got = {r.doc_id: r for r in perplexity_quality(docs_of(rows)).collect()}
    assert all(got[i].kept for i in range(120)) and got[None].kept and got[504].kept
    assert not any(got[i].kept for i in (500, 501, 502, 503, 505)) and not got[500].base_failed
    assert got[504].lang is None and got[502].log_perplexity is None
    assert perplexity_quality(docs_of(rows).where(F.lit(False))).collect() == []


def test_counts_of_marked_and_odd_characters():
    g = GramCounts("en", 3)
    assert list(g.add(Counter({b"ab": 2, "é\x00\x02".encode(): 1}))) == list(g.add(Counter({b"ab": 1, b"b": 4}))) == []
    rows = {r["gram"]: r["raw"] for b in g.rows() for r in b.to_pylist()}
    assert rows["\x02ab"] == 3 and rows["b\x03"] == 7 and rows["\x02é�"] == 1 and rows["\x03"] == 8


def test_counts_are_held_to_a_bound(monkeypatch):
    """A long text without spaces is one word; its n-grams are given out in parts that add up."""
    from mercadia.llm import perplexity
    rnd = random.Random(11)
    words = Counter({"".join(chr(rnd.randint(0x4e00, 0x5000)) for _ in range(rnd.randint(1, 300))).encode(): rnd.randint(1, 3) for _ in range(60)})
    totals = []
    for symbols, held in ((1 << 20, 3_000_000), (500, 2000)):
        monkeypatch.setattr(perplexity, "COUNT_SYMBOLS", symbols)
        monkeypatch.setattr(perplexity, "HELD_GRAMS", held)
        g, total = GramCounts("zh", 4), Counter()
        batches = [*g.add(words), *g.rows()]
        for b in batches:
            total.update({r["gram"]: r["raw"] for r in b.to_pylist()})
        totals.append(total)
        assert len(batches) > 4 or held > 2000
    assert totals[0] == totals[1]


def test_parts_of_a_model_score_as_the_whole(small_docs):
    df, _ = small_docs
    df = df.union(df.where("doc_id % 7 = 0")).withColumn("lang", F.when(F.col("doc_id") % 11 != 0, F.col("lang")))
    rows = lambda **k: sorted((tuple(r) for r in perplexity_quality(df, **k).select(
        "doc_id", "lang", "text_crc32", "n_words", "n_repeat_words", "base_failed", F.round("log_perplexity", 4), "kept").collect()), key=str)
    assert rows(part_entries=15_000) == rows()


def test_kinds_are_in_order():
    assert pii_crf.KINDS == ("email", "ip", "card", "phone")


# --- inputs that ended a job once

def test_dedup_tells_texts_of_one_crc_apart(docs_of):
    """Two texts with one CRC-32 under one id, one of which repeats itself."""
    import zlib
    tail = {}
    rnd = random.Random(12)
    pair = None
    while pair is None:  # some 100,000 tries
        t = "".join(rnd.choices("abcdefghij", k=8))
        other = tail.setdefault(zlib.crc32(t.encode()), t)
        if other != t:
            pair = other, t
    # equal CRCs stay equal when the same text follows
    body = "".join(rnd.choices("klmnop ", k=400))
    texts = [pair[0] + body + body, pair[1] + body + body]
    assert zlib.crc32(texts[0].encode()) == zlib.crc32(texts[1].encode())
    for key in (7, None):
        rows = dedup_digests(docs_of([(key, t) for t in texts])).collect()
        assert sorted(r.n_bytes for r in rows) == [808, 808] and all(r.doc_id == key for r in rows)
        # of the four copies of the body but one goes, whichever text comes first
        assert sorted(r.n_removed for r in rows) == [400, 800]
        assert len(remove_repeats(docs_of([(key, t) for t in texts])).collect()) == 2


def test_addresses_with_long_parts():
    assert base_spans("0" * 5000 + ".1.2.3")[KINDS.index("ip")] == [(0, 5006)]
    assert base_spans("9" * 5000 + ".1.2.3")[KINDS.index("ip")] == []


def repeats_field():
    """A field as a corpus of phone and card numbers trains it."""
    n = Counter()
    for i in range(400):
        text = f"call +1 (443) 55{i % 10}-57{i:02d} or +1 (443) 55{i % 10}-57{i:02d} and mail a{i}@corp.example a{i}@corp.example item 12345{i:03d}"
        n.update(label_counts(mentions(text, base_spans(text))))
    return Field(n)


@pytest.mark.parametrize("n", [1, 2, 10, 60])
def test_all_repeats_of_a_look_alike_get_its_label(n):
    field = repeats_field()
    rule, alike = "+1 (443) 555-5793", "(443) 555-5793"
    for before in (0, n // 2, n):
        text = " then ".join([alike] * before + [rule] + [alike] * (n - before)) + " and order 88812345"
        base, added = find_spans(text, field)
        assert [text[a:b] for k, a, b in base] == [rule]
        assert [text[a:b] for k, a, b in sorted(added, key=lambda s: s[1])] == [alike] * n and {KINDS[k] for k, _, _ in added} == {"phone"}
    # without a rule span the field adds nothing
    assert find_spans(" then ".join([alike] * n), field) == ([], [])


def test_an_indexing_task_deals_out_bounded_batches():
    text = random.Random(21).randbytes(8_000_000)  # some 230,000 entries
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text], pa.binary())], ["_doc", "_tag", "_bytes"])
    sizes = [sum(suffix_dedup.Entries.unpacked(d).size for d in b.column("data").to_pylist()) for b in suffix_dedup._index_texts(100, 32, 4)([batch])]
    assert sum(sizes) > 200_000 and max(sizes) < 150_000


def test_model_keys_are_asked_in_order(monkeypatch):
    from mercadia.llm import perplexity
    model = perplexity.HashModel.__new__(perplexity.HashModel)
    model.keys, model.values = np.arange(0, 2000, 2), np.arange(1000.0)
    asked = np.random.default_rng(1).integers(-10, 2010, 500)
    search, seen = np.searchsorted, []
    with monkeypatch.context() as m:
        m.setattr(perplexity.np, "searchsorted", lambda a, v: seen.append(np.array(v)) or search(a, v))
        found, value = model._value(asked)
    assert (np.diff(seen[0]) >= 0).all()
    assert found.tolist() == [0 <= k < 2000 and k % 2 == 0 for k in asked.tolist()]
    assert value[found].tolist() == [k / 2 for k in asked[found].tolist()]


def test_a_task_gets_one_bucket(spark):
    """By a hash of their numbers, several buckets met in one task while others had none."""
    numbers = [b | f for b in range(51) for f in (0, suffix_dedup._OFTEN)]
    dealt = spark.createDataFrame([(n, b"") for n in numbers], suffix_dedup._DEALT)
    placed = suffix_dedup._to_buckets(dealt, 51).select(F.spark_partition_id().alias("p"), F.col("bucket").bitwiseAND(F.lit(~suffix_dedup._OFTEN)).alias("b"))
    pairs = {tuple(r) for r in placed.collect()}
    assert len(pairs) == len({p for p, _ in pairs}) == 51
