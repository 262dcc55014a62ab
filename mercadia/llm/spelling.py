"""Spelling variants: words one edit apart, found by composing automata.

The vocabulary is an acceptor A, and E a transducer that copies a word with exactly one
character inserted, deleted or replaced. The composition A o E o A accepts the pairs of
words one edit apart. Its states are (p, e, q): p and q states of A, and e whether the edit
is done. Before the edit both sides have read the same, so p = q.

Spark deals the composition by initial states. Two words of which the shorter has m
characters, or both have m + 1, and which are one edit apart, share their first
h = ceil(m / 2) characters or their last h. So each word starts in the state that its
first h characters lead to in A, and in that of its last h in the reversed A, for m its own
length and one less: four rows a word. A task builds the minimal acceptor of what the words
of such a state go on with, composes it, and gives each word's number of near words and its
best one; pairs are never rows.

A state with more than ``GROUP_WORDS`` words is split at its next branching: what goes on
without an edit starts in the states that follow, as partitions of their own; where the
edit is made there, the rests must be equal, and words with equal rests meet by them
(at most one word for each letter, and one for none).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercadia.llm.common import crc32_sql, id_text, slices
from mercadia.session import cut_lineage

#: Words of one initial state that a task composes at most; larger ones are split.
GROUP_WORDS = 20_000
#: Distinct words that a counting task holds before it gives out their counts.
HELD_WORDS = 300_000

# The letters of a run, how a run loses one, and which words count.
LETTERS = "A-Za-zÀ-ÿ"
LOSES_ONE_IN, LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 31, 7, 2, 10


class Acceptor:
    """The minimal acyclic acceptor of some words, which come sorted and without repeats.

    States are numbers; those of the same words to come are the same. ``arcs`` lead by a
    character to a state and to how many words come before by way of this state, so a
    word's place among the sorted ones adds up along its path. A state with one word to
    come holds it as its ``tail`` instead.
    """

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.tail: list[str | None] = []
        self.size: list[int] = []
        known: dict[object, int] = {}
        shared = [0]  # characters that a word shares with the one before
        for a, b in zip(words, words[1:], strict=False):
            k, most = 0, min(len(a), len(b))
            while k < most and a[k] == b[k]:
                k += 1
            shared.append(k)
        shared.append(0)

        def tail(rest):
            s = known.get(rest)
            if s is None:
                s = known[rest] = self._new(False, {}, rest, 1)
            return s

        def close(node):
            final, arcs = node
            key = (final, *((c, s) for c, (s, _) in arcs.items()))
            s = known.get(key)
            if s is None:
                s = known[key] = self._new(final, arcs, None, final + sum(self.size[t] for t, _ in arcs.values()))
            return s

        if len(words) == 1:
            self.start = tail(words[0])
            return
        path: list[tuple[str, list]] = [("", [False, {}])]  # open states from the start on

        def pop():
            c, node = path.pop()
            up = path[-1][1]
            up[1][c] = (close(node), self._before(up))

        for i, w in enumerate(words):
            branch = max(shared[i], shared[i + 1])  # beyond, the word is alone
            while len(path) > shared[i] + 1:
                pop()
            for c in w[len(path) - 1:branch]:
                path.append((c, [False, {}]))
            node = path[-1][1]
            if len(w) == branch:
                node[0] = True
            else:
                node[1][w[branch]] = (tail(w[branch + 1:]), self._before(node))
        while len(path) > 1:
            pop()
        self.start = close(path[0][1])

    def _before(self, node) -> int:
        final, arcs = node
        if not arcs:
            return int(final)
        s, at = arcs[next(reversed(arcs))]
        return at + self.size[s]

    def _new(self, final, arcs, tail, size) -> int:
        self.final.append(final)
        self.arcs.append(arcs)
        self.tail.append(tail)
        self.size.append(size)
        return len(self.final) - 1

    def place(self, state: int, word: str) -> int | None:
        """Place of a word among those to come from a state."""
        at = 0
        for k, c in enumerate(word):
            if self.tail[state] is not None:
                return at if self.tail[state] == word[k:] else None
            arc = self.arcs[state].get(c)
            if arc is None:
                return None
            state, at = arc[0], at + arc[1]
        if self.tail[state] is not None:
            return at if self.tail[state] == "" else None
        return at if self.final[state] else None

    def both(self, p: int, q: int, without: str | None = None) -> list[tuple[int, int]]:
        """Places of the words that come from p and from q too (by no arc ``without`` of q)."""
        out = []
        if self.tail[p] is not None or self.tail[q] is not None:
            word = self.tail[p] if self.tail[p] is not None else self.tail[q]
            if word[:1] == without:
                return out
            i, j = self.place(p, word), self.place(q, word)
            return [(i, j)] if i is not None and j is not None else out
        open_ = [(p, q, 0, 0, without)]
        while open_:
            p, q, i, j, skip = open_.pop()
            if p == q and skip is None:
                out += zip(range(i, i + self.size[p]), range(j, j + self.size[p]), strict=True)
                continue
            if self.tail[p] is not None or self.tail[q] is not None:
                out += [(i + a, j + b) for a, b in self.both(p, q)]
                continue
            if self.final[p] and self.final[q]:
                out.append((i, j))
            mine, other = self.arcs[p], self.arcs[q]
            for c in (mine if len(mine) <= len(other) else other):
                if c != skip and c in mine and c in other:
                    (s, a), (t, b) = mine[c], other[c]
                    open_.append((s, t, i + a, j + b, None))
        return out

    def near(self) -> list[tuple[int, int]]:
        """Places of all pairs one edit apart, each once: the composition with the edit
        at the first character where the two differ. States are numbered from below."""
        by_state: list[list[tuple[int, int]]] = []
        for s, arcs in enumerate(self.arcs):
            own: list[tuple[int, int]] = []
            order = list(arcs.items())
            for k, (c, (t, a)) in enumerate(order):
                own += [(a + i, a + j) for i, j in by_state[t]]                      # no edit yet
                for _, (u, b) in order[:k]:
                    own += [(a + i, b + j) for i, j in self.both(t, u)]              # replaced
                own += [(a + i, j) for i, j in self.both(t, s, without=c)]           # inserted or deleted
            by_state.append(own)
        return by_state[self.start]


def _shared(a: str, b: str) -> int:
    k, most = 0, min(len(a), len(b))
    while k < most and a[k] == b[k]:
        k += 1
    return k


def _count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of (doc_id, text): the words of all texts, counted."""
    def count(batches):
        run = re.compile("[%s]{%d,}" % (LETTERS, LEAST_LENGTH))
        held: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for part in slices(batches):
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(run.findall(text.encode().lower().decode())).items():  # of bytes: A-Z only
                    h = zlib.crc32(word.encode(), start)
                    if h % LOSES_ONE_IN == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < LEAST_LENGTH:
                            continue
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield rows()
                    held = Counter()
        yield rows()

    return (docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


def initial_states(words: DataFrame) -> DataFrame:
    """Four rows a word of (word, n): (side, m, state, read, word, n). ``read`` is the word from the
    side that it is read from, ``state`` the part of it that leads to the initial state."""
    m = F.explode(F.array(F.char_length("word") - 1, F.char_length("word")))
    side = F.explode(F.array(F.lit(0), F.lit(1)))
    rows = words.select("word", "n", m.alias("m")).select("*", side.alias("side"))
    read = F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word"))
    return rows.select("side", "m", F.substring(read, F.lit(1), F.floor((F.col("m") + 1) / 2).cast("int")).alias("state"), read.alias("read"), "word", "n")


def _near_in(side: int, m: int, words: list[str], pairs) -> list[tuple[int, int]]:
    """Of pairs of places, those that this partition is to find: not both of m characters
    (m - 1 has these), and, of the reversed ones, none with the same first h."""
    h = (m + 1) // 2
    return [(i, j) for i, j in pairs
            if len(words[i]) + len(words[j]) > 2 * m and not (side and _shared(words[i], words[j]) >= h)]


def _found(words: list[str], counts: list[int], pairs, out) -> None:
    n_near: Counter = Counter()
    best: dict[int, tuple[int, str]] = {}
    for i, j in pairs:
        for a, b in ((i, j), (j, i)):
            n_near[a] += 1
            other = (-counts[b], words[b])
            if a not in best or other < best[a]:
                best[a] = other
    for a, n in n_near.items():
        out.append((words[a], n, -best[a][0], best[a][1]))


_NEAR = "word string, n_near long, best_n long, best string"


def _near_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["word", "n_near", "best_n", "best"])


def _members() -> Column:
    return F.sort_array(F.collect_list(F.struct("read", "word", "n"))).alias("members")


def _composed(states: DataFrame) -> DataFrame:
    """Near words of each initial state with two words or more."""
    def compose(batches):
        for part in slices(batches, rows=256):
            out: list[tuple] = []
            for side, m, members in zip(*(part.column(c).to_pylist() for c in ("side", "m", "members")), strict=True):
                reads, words, counts = ([x[k] for x in members] for k in ("read", "word", "n"))
                shared = _shared(reads[0], reads[-1])  # they are sorted, by bytes of UTF-8 and so by code points
                pairs = Acceptor([r[shared:] for r in reads]).near()
                _found(words, counts, _near_in(side, m, words, pairs), out)
            yield _near_batch(out)

    grouped = states.groupBy("side", "m", "state").agg(F.count(F.lit(1)).alias("held"), _members()).where("held > 1")
    return grouped.select("side", "m", "members").mapInArrow(compose, _NEAR)


def _edited_at(hot: DataFrame) -> DataFrame:
    """Near words of split states whose edit is at the branching: (.., read, at, word, n) with
    ``at`` characters read before it. Equal rests meet; the letter before them tells how."""
    tagged = hot.select("side", "m", "state", "word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"), "read", "at").select(
        "side", "m", "state", "word", "n", F.expr("substring(read, at + 1, k)").alias("tag"), F.expr("substring(read, at + 1 + k)").alias("rest"), "k",
        (F.char_length("read") - F.col("at")).alias("left")).where("left >= k")

    def compare(batches):
        for part in slices(batches, rows=4096):
            out: list[tuple] = []
            for side, m, rest, members in zip(*(part.column(c).to_pylist() for c in ("side", "m", "rest", "members")), strict=True):
                tags, words, counts = ([x[k] for x in members] for k in ("tag", "word", "n"))
                # replaced; or one has no letter there, and then the other's is not that one's next: these differ later on
                pairs = [(i, j) for i in range(len(tags)) for j in range(i)
                         if (tags[i] and tags[j]) or (tags[i] or tags[j]) != rest[:1]]
                _found(words, counts, _near_in(side, m, words, pairs), out)
            yield _near_batch(out)

    return (tagged.groupBy("side", "m", "state", "rest").agg(F.count(F.lit(1)).alias("held"), F.collect_list(F.struct("tag", "word", "n")).alias("members"))
            .where("held > 1").select("side", "m", "rest", "members").mapInArrow(compare, _NEAR))


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of those of (word, n), all distinct, that have a near word:
    how many, and the one with the largest n (ties: the first by code points)."""
    states = initial_states(words)
    found = []
    while True:
        key = ["side", "m", "state"]
        hot = cut_lineage(states.groupBy(*key).agg(F.count(F.lit(1)).alias("held"), F.min("read").alias("first"), F.max("read").alias("last"))
                          .where(F.col("held") > group_words), "hot_states")
        if hot.isEmpty():
            break
        shared = F.expr("size(filter(sequence(1, least(char_length(first), char_length(last))), i -> substring(first, 1, i) = substring(last, 1, i)))")
        at = hot.select(*key, shared.alias("at"))
        split = cut_lineage(states.join(at, key), "split_states")
        found.append(_edited_at(split))
        longer = split.where(F.char_length("read") > F.col("at")).withColumn("state", F.expr("substring(read, 1, at + 1)")).select(*states.columns)
        states = cut_lineage(states.join(at.select(*key), key, "left_anti").unionByName(longer), "states")
    found.append(_composed(states))
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return (reduce(DataFrame.unionByName, found).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
            .select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form), a forest: the last form that forms lead to. Each round
    doubles the steps; counts grow tenfold with a step, so there are few."""
    reach = cut_lineage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = cut_lineage(reach.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "forms")
        if step.where("_moved").isEmpty():
            return step.drop("_moved")
        reach = step.drop("_moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = FORM_FACTOR,
                      group_words: int = GROUP_WORDS) -> DataFrame:
    """One row per word of the vocabulary: word, form, root (strings), n, n_near, form_n.

    Words come from the longest runs of letters of all texts, with A-Z lower-cased; a run loses
    a character where the CRC-32 of id and run says so. The vocabulary has those
    of 7 characters and 2 occurrences at least. n_near: words one edit apart; form: the one of
    them with the largest n (ties: first by code points) if that is ``factor`` times the word's
    n or more; form_n its n; root: the end of the chain of forms, the word itself without one.

    Cases: null and empty texts have no words; a null id counts as an empty one; very long
    runs are words like others; repeated rows each count; an empty table gives none;
    other columns are left behind.
    """
    words = cut_lineage(_count_words(id_text(docs, id_col, text_col)), "words")
    near = near_words(words, group_words)
    all_ = cut_lineage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("best_n") >= factor * F.col("n"), F.struct("best", "best_n")).alias("f"))
        .select("word", "n", "n_near", F.col("f.best").alias("form"), F.col("f.best_n").alias("form_n")), "variants")
    roots = _roots(all_.where("form IS NOT NULL"))
    return all_.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _variants_sql() -> str:
    upper = "".join(map(chr, range(65, 91)))
    return f"""WITH RECURSIVE runs AS (
SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[{LETTERS}]{{{LEAST_LENGTH},}}')) AS run FROM documents),
hashed AS (SELECT run, {crc32_sql("COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs),
lost AS (SELECT if(h % {LOSES_ONE_IN} = 0, run[: h % length(run)] || run[h % length(run) + 2 :], run) AS word FROM hashed),
words AS (SELECT word, COUNT(*) AS n FROM lost WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING COUNT(*) >= {LEAST_COUNT}),
cuts AS (SELECT word, i, word[: i] || word[i + 2 :] AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, w.word FROM cuts a JOIN words w ON w.word = a.rest
  UNION SELECT w.word, a.word FROM cuts a JOIN words w ON w.word = a.rest),
best AS (SELECT x.word, COUNT(*) AS n_near, MAX(o.n) AS best_n, MIN(struct_pack(n := -o.n, word := x.other)).word AS best
  FROM near x JOIN words o ON o.word = x.other GROUP BY x.word),
variants AS (SELECT w.word, w.n, COALESCE(b.n_near, 0) AS n_near, if(b.best_n >= {FORM_FACTOR} * w.n, b.best, NULL) AS form,
  if(b.best_n >= {FORM_FACTOR} * w.n, b.best_n, NULL) AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (SELECT word, word AS root, 0 AS steps FROM variants UNION ALL SELECT c.word, v.form, c.steps + 1 FROM chain c JOIN variants v ON v.word = c.root WHERE v.form IS NOT NULL)
SELECT v.word, v.form, r.root, CAST(v.n AS BIGINT) AS n, CAST(v.n_near AS BIGINT) AS n_near, CAST(v.form_n AS BIGINT) AS form_n
FROM variants v JOIN (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word) r ON r.word = v.word"""


VARIANTS_SQL = _variants_sql()
