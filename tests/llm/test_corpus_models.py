"""Language identification, the Merkle manifest and spelling variants against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercadia.llm import language, merkle, spelling
from mercadia.llm.catalog import op11_hashed_ngram_language, op12_merkle_manifest
from mercadia.llm.language import BUCKETS, ORDER, SMOOTHING, UNKNOWN, identify_languages, text_grams
from mercadia.llm.merkle import COLUMNS, Parent, merkle_manifest
from mercadia.llm.spelling import Acceptor, near_words, spelling_variants


# --- language

def brute_grams(text):
    t = "\0" + text.lower() + "\0"
    for n in range(1, ORDER + 1):
        for i in range(len(t) - n + 1):
            g = t[i:i + n]
            if all(c.isalpha() for c in g[1:-1]) and any(c.isalpha() for c in g):
                yield tuple(ord(c) if c.isalpha() else 0 for c in g)


def brute_bucket(gram):
    word = 1 << 64
    h = sum((c + 1) * pow(0x9E3779B97F4A7C15, j, word) for j, c in enumerate(reversed(gram)))
    spread = 0xD1B54A32D192ED03
    return (h * spread + len(gram) * 0x9E3779B97F4A7C15) * spread % word >> (64 - int(math.log2(BUCKETS)))


def brute_languages(rows):
    """(prediction, probability) of each text of (doc_id, text, lang)."""
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 0 for k, _, _ in rows]
    grams, docs = defaultdict(Counter), Counter()
    for (_, text, lang), out in zip(rows, held, strict=True):
        if not out and lang is not None and text is not None:
            grams[lang].update(map(brute_bucket, brute_grams(text)))
            docs[lang] += 1
    langs = sorted(x for x in grams if grams[x])
    total = {x: sum(grams[x].values()) + SMOOTHING * BUCKETS for x in langs}
    prior = {x: math.log(docs[x] / sum(docs[y] for y in langs)) for x in langs}
    out = []
    for _, text, _ in rows:
        if text is None or not any(map(str.isalpha, text)) or not langs:
            out.append((UNKNOWN, 0.0))
            continue
        own = Counter(map(brute_bucket, brute_grams(text)))
        score = [prior[x] + sum(n * math.log((grams[x][b] + SMOOTHING) / total[x]) for b, n in own.items()) for x in langs]
        best = int(np.argmax(score))
        out.append((langs[best], 1 / sum(math.exp(s - score[best]) for s in score)))
    return held, out


def check_languages(df, rows):
    held, want = brute_languages(rows)
    got = identify_languages(df).collect()
    assert [(r.doc_id, r.held_out, r.lang_pred) for r in got] == [(k, h, p) for (k, _, _), h, (p, _) in zip(rows, held, want, strict=True)]
    assert all(abs(r.score - s) < 1e-3 and 0 <= r.score <= 1 for r, (_, s) in zip(got, want, strict=True))


def test_languages_of_odd_documents(docs_of, odd_texts):
    rnd = random.Random(2)
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["çela", "était", "où"], "cc": ["漢字", "仮名"]}
    rows = [(i, " ".join(rnd.choices(words[lang], k=rnd.randint(1, 12))), lang) for i, lang in enumerate(rnd.choices(list(words), k=120))]
    rows += [(200 + i, t, rnd.choice(["aa", "bb"])) for i, t in enumerate(odd_texts)]
    rows += [(None, "lorem", "dd"), (7, "ipsum", None), (8, None, "ee"), (9, "...", "ff"), (9, "...", "ff"), (11, "x", "aa"), (12, "İ ß ﬁ", "bb")]
    check_languages(docs_of(rows).coalesce(1), rows)
    none = docs_of(rows).where(F.lit(False))
    assert identify_languages(none).collect() == []
    one = [(0, "nothing to learn from", None), (5, "a", None)]
    assert {(r.lang_pred, r.score) for r in identify_languages(docs_of(one)).collect()} == {(UNKNOWN, 0.0)}


def test_long_texts_are_read_in_pieces(monkeypatch):
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("ab cé漢", k=n)) for n in (1000, 3, 0, 257, 64)]
    whole = [Counter(), Counter()]
    for i, piece in enumerate((1 << 19, 16)):
        monkeypatch.setattr(language, "PIECE", piece)
        for owner, found in text_grams(texts):
            assert (np.diff(owner) >= 0).all() or i == 0 or len(set(owner.tolist())) <= len(texts)
            whole[i].update(zip(owner.tolist(), found.tolist(), strict=True))
    assert whole[0] == whole[1] == Counter((i, brute_bucket(g)) for i, t in enumerate(texts) for g in brute_grams(t))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in op11_hashed_ngram_language(spark, folder).collect() if r.held_out]
    assert len(rows) > 150 and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.98 * len(rows)


def test_labels_that_are_no_languages_are_an_error(docs_of, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    docs = docs_of([(i, "abc", f"l{i % 9}") for i in range(60)])
    with pytest.raises(ValueError, match="more than 3 languages"):
        identify_languages(docs)


# --- the manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_levels(nodes):
    """Node lists of a tree, from its leaves to the last node."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def brute_path(levels, at):
    """(before, after) siblings of a leaf, from below."""
    out = []
    for nodes in levels[:-1]:
        run = at - at % 8
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 8])))
        at //= 8
    return out


def brute_leaf(row, text):
    values = [text if c == "text" else row[c] for c in COLUMNS]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_manifest(rows, tampered):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r, r["text"]), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    top = brute_levels([trees[g][-1][0] for g in order])
    out = []
    for j, g in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = brute_path(trees[g], i) + brute_path(top, j)
            node = leaf
            if tampered(r["doc_id"]) and r["text"] is not None:
                node = brute_leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]))
            for a, b in path:
                node = H(a, node, b)
            out.append((r["doc_id"], leaf, trees[g][-1][0], top[-1][0], H(*[x for s in path for x in s]), node, node == top[-1][0]))
    return sorted(out, key=str)


def in_third(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0


def check_manifest(df):
    rows = [r.asDict() for r in df.select(*COLUMNS).collect()]
    got = merkle_manifest(df, tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_manifest(rows, in_third)


def manifest_rows(rnd, counts):
    out = []
    for lang, n in counts.items():
        out += [(rnd.randint(0, 10 ** 6), rnd.choice(["Some Text", "some text", "", None, "É" * 5]), lang) for _ in range(n)]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("counts", [{"en": 1}, {"en": 8, None: 9}, {"en": 65, "": 1, "é": 2, "z": 64, None: 7}])
def test_manifest_of_small_trees(docs_of, counts):
    check_manifest(docs_of(manifest_rows(random.Random(len(counts)), counts)).repartition(4))


def test_manifest_over_several_subtrees_and_rows_of_one_id(docs_of):
    rnd = random.Random(9)
    rows = manifest_rows(rnd, {"en": 1200, "de": merkle.BLOCK, "fr": merkle.BLOCK + 1})
    rows += [(None, "A", "en"), (None, "B", "en"), (5, "same", "en"), (5, "same", "en"), (5, "Other", "en"), (6, "L" * 100_000, None)]
    docs = docs_of(rows).withColumn("digest", F.lit("clash")).withColumn("pos", F.lit(3)).repartition(6)
    check_manifest(docs)


def test_manifest_of_many_groups_and_of_none(docs_of):
    rows = [(i, f"Text {i}", f"l{i:03d}") for i in range(70)]
    check_manifest(docs_of(rows))
    assert merkle_manifest(docs_of(rows).where(F.lit(False))).collect() == []
    assert all(r.verified for r in merkle_manifest(docs_of(rows)).collect())  # nothing was tampered with


def test_manifest_query_finds_what_changed(spark, small_docs):
    docs, texts = small_docs
    for r in op12_merkle_manifest(spark, "/root/testdata/sf0.001").collect():
        assert r.verified == (not in_third(r.doc_id) or not re.search("[A-Z]", texts[r.doc_id]))


def test_a_parent_resumes_its_states():
    children = [H(str(i)) for i in range(8)]
    parent = Parent(children)
    for i in range(8):
        changed = [*children[:i], H("new"), *children[i + 1:]]
        assert parent.replaced(i, H("new")) == H(*changed) and parent.replaced(i, children[i]) == parent.digest == H(*children)


# --- spelling variants

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_the_composition_finds_all_pairs():
    rnd = random.Random(1)
    for t in range(400):
        letters = "ab" if t % 2 else "abcé"
        words = sorted({"".join(rnd.choices(letters, k=rnd.randint(0, 6))) for _ in range(rnd.randint(1, 40))})
        got = [tuple(sorted(p)) for p in Acceptor(words).near()]
        want = {(i, j) for j in range(len(words)) for i in range(j) if one_edit(words[i], words[j])}
        assert len(got) == len(set(got)) and set(got) == want


def test_the_acceptor_is_minimal():
    words = sorted(a + b + c for a in "abc" for b in ("er", "ing", "s") for c in ("", "x"))
    a = Acceptor(words)
    assert [a.place(a.start, w) for w in words] == list(range(len(words))) and a.place(a.start, "as!") is None
    right = set()  # the sets of words to come, one state for each
    for w in words:
        for i in range(len(w) + 1):
            right.add(frozenset(x[i:] for x in words if x[:i] == w[:i]))
    reached = {a.start}
    queue = [a.start]
    while queue:
        for s, _ in a.arcs[queue.pop()].values():
            if s not in reached:
                reached.add(s)
                queue.append(s)
    assert len(reached) <= len(right) and len(reached) == len(a.final)


def vocabulary_of(rnd, n):
    parts = ["er", "ing", "tion", "é", "a", "b", "ou", "st"]
    out = set()
    while len(out) < n:
        w = "".join(rnd.choices(parts, k=rnd.randint(3, 6)))
        for _ in range(rnd.randint(0, 2)):
            i = rnd.randrange(len(w))
            w = rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice("abé") + w[i:], w[:i] + rnd.choice("abé") + w[i + 1:]])
        if len(w) >= 7:
            out.add(w)
    return {w: rnd.choice([2, 2, 3, 5, 30, 400]) for w in out}


@pytest.mark.parametrize("group_words", [20_000, 4, 1])
def test_near_words_with_and_without_split_states(spark, group_words):
    """Hot states are split at their branchings; the smallest bound splits all of them."""
    counts = vocabulary_of(random.Random(6), 260)
    counts |= {"x" * 300 + c: 2 for c in "abc"} | {"x" * 301: 9, "x" * 299: 2, "aaaaaaaa": 3, "aaaaaaa": 4, "aaaaaaab": 2}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = {r.word: (r.n_near, r.best_n, r.best) for r in near_words(df, group_words).collect()}
    want = {}
    for w in counts:
        near = [x for x in counts if one_edit(w, x)]
        if near:
            best = min(near, key=lambda x: (-counts[x], x))
            want[w] = (len(near), counts[best], best)
    assert got == want


def brute_variants(rows):
    words = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def test_variants_of_odd_documents(docs_of, odd_texts):
    rnd = random.Random(8)
    base = [w for w in vocabulary_of(rnd, 40)]
    rows = [(i, " ".join(rnd.choices(base, k=30)) + rnd.choice([".", "\n", "×÷", "1Letters2"])) for i in range(90)]
    rows += [(300 + i, t) for i, t in enumerate(odd_texts)]
    # a chain of forms: each ten times as frequent as the one before
    rows += [(400, "between " * 300), (401, "betwean " * 25), (402, "Betwaan betwaan"), (403, "ÉCOLIÈRE écolière Écolière"), (None, "abcdefgh abcdefgh"), (404, None), (404, "abcdefgi " * 40)]
    docs = docs_of(rows).withColumn("word", F.lit("clash")).withColumn("n", F.lit(1)).repartition(5)
    got = {tuple(r) for r in spelling_variants(docs).collect()}
    want = brute_variants(rows)
    assert got == want and any(f and r != f for _, f, r, *_ in want)
    assert spelling_variants(docs.where(F.lit(False))).collect() == []


def test_counts_are_given_out_in_time(docs_of, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    rows = [(i, "alphabet betagamma deltaeps zetaetath") for i in range(20)]
    assert {tuple(r) for r in spelling_variants(docs_of(rows)).collect()} == brute_variants(rows)
