"""Quality rules: n-gram perplexity under a modified Kneser-Ney model of the corpus.

Spark counts, for each language, the character n-grams of all words of all
documents (a word with a mark before and one after it), and turns the counts into
modified Kneser-Ney probabilities by joins on n-gram hashes. The model is kept as
sorted hash arrays. A document's perplexity is that of its words; each language
has a lower and an upper bound of perplexity, and documents outside are rejected:
above are those that read like no text of their language, below those that say
little in many words.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadia.llm.common import give_back, slices, small_batches
from mercadia.session import cut_lineage

ORDER = 5
#: Entries of a part of the model that is broadcast at a time (12 bytes each); a larger model is scored in
#: several passes, one for each part.
PART_ENTRIES = 2_000_000
#: Distinct words that a counting task gathers, symbols of words that it looks at together, n-grams
#: that it holds before it gives them out; words that a scoring worker remembers.
COUNT_WORDS, COUNT_SYMBOLS, HELD_GRAMS, MEMO_WORDS = 150_000, 1 << 20, 3_000_000, 250_000
#: Languages whose few figures are broadcast; more are shuffled.
FEW_LANGUAGES = 10_000
#: A bound lies this many times as far from a language's median log-perplexity as its
#: quartile on that side.
LOWER_SPREAD, UPPER_SPREAD = 8.0, 8.0
#: And so far at least, in natural logarithms: the upper one at twice the median perplexity,
#: as good documents quote passages of other languages.
LOWER_WIDTH, UPPER_WIDTH = 0.35, 0.7

# Symbols before and after a word, and one that arrays of strings cannot end in: words hold none of them.
MARKS = "\x02\x03\x00"

# What the base rules count and reject.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 50, 50, 3

# Multipliers of the hashes; odd 64-bit numbers
_BASE, _STEP, _WORD = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 1 << 64


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _seed(lang: str) -> np.uint64:
    return _mixed(np.array([reduce(lambda h, b: (h * 257 + b + 1) % (1 << 63), lang.encode(), 7)], np.uint64))[0]


class WordGrams:
    """n-gram hashes of words: for order k, those that end at each predicted symbol."""

    def __init__(self, words: list[bytes], lang: str, order: int):
        text = [w.decode("utf-8", "replace") for w in words]
        if any(c in whole for whole in ["".join(text)] for c in MARKS):
            text = [t.translate(dict.fromkeys(map(ord, MARKS), "\ufffd")) for t in text]
        size = np.fromiter(map(len, text), np.int64, len(text)) + 2
        marked = "\x02" + "\x03\x02".join(text) + "\x03" if text else ""
        flat = np.frombuffer(marked.encode("utf-32-le"), np.uint32)
        self.word = np.repeat(np.arange(len(text)), size)
        self.place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        self.lang, self.symbols = int(_seed(lang)), flat
        self.code = flat.astype(np.uint64) + np.uint64(0x10001)
        self.raw = [np.zeros(len(flat), np.uint64), self.code]
        while len(self.raw) <= order:
            self.raw.append(self.longer(self.raw[-1], len(self.raw)))

    def longer(self, h: np.ndarray, k: int) -> np.ndarray:
        """Sums for the k symbols that end at each place, from those for k - 1."""
        h = h.copy()
        h[k - 1:] += self.code[: max(0, len(h) - k + 1)] * np.uint64(pow(_BASE, k - 1, _WORD))
        return h

    def key(self, k: int, at: np.ndarray, raw: np.ndarray | None = None) -> np.ndarray:
        """Hash of the k symbols that end at each of ``at``; of no symbol for k = 0."""
        return _mixed((self.raw[k] if raw is None else raw)[at] + np.uint64((k * _STEP + self.lang) % _WORD)).astype(np.int64)

    def ends(self, k: int) -> np.ndarray:
        """Places of predicted symbols (not the opening mark) with k symbols of their word up to there."""
        return np.flatnonzero(self.place >= max(1, k - 1))


def gram_keys(grams: list[str], n: int, lang: str) -> np.ndarray:
    """The hashes that WordGrams gives to n-grams of a language."""
    h = np.zeros(len(grams), np.uint64)
    if n:
        symbols = np.array(grams, f"<U{n}").view(np.uint32).reshape(len(grams), n).astype(np.uint64) + np.uint64(0x10001)
        for i in range(n):
            h = h * np.uint64(_BASE) + symbols[:, i]
    return _mixed(h + np.uint64((n * _STEP + int(_seed(lang))) % _WORD)).astype(np.int64)


class GramCounts:
    """Distinct n-grams of a language and their counts, one set of arrays for each order."""

    def __init__(self, lang: str, order: int):
        self.lang, self.order = lang, order
        self.held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, k), np.uint32)) for k in range(1, order + 1)]

    @property
    def size(self) -> int:
        return sum(len(keys) for keys, _, _ in self.held)

    def add(self, words: Counter):
        """Count words, and give out the n-grams held whenever they are too many."""
        own: Counter = Counter()
        size = 0
        for w, n in words.items():
            own[w] = n
            size += len(w)
            if size >= COUNT_SYMBOLS:
                self._add(own)
                own, size = Counter(), 0
                if self.size >= HELD_GRAMS:
                    yield from self.rows()
                    self.__init__(self.lang, self.order)
        if own:
            self._add(own)

    def _add(self, words: Counter) -> None:
        grams = WordGrams(list(words), self.lang, 1)
        raw = grams.raw[1]
        weight = np.fromiter(words.values(), np.int64, len(words))
        for k in range(1, self.order + 1):
            at = grams.ends(k)
            keys, counts, symbols = self.held[k - 1]
            raw = raw if k == 1 else grams.longer(raw, k)
            own = grams.key(k, at, raw)
            codes, keys = pd.factorize(np.concatenate([keys, own]))
            counts = np.bincount(codes, np.concatenate([counts, weight[grams.word[at]]]), len(keys)).astype(np.int64)
            fresh = codes[len(codes) - len(own):] >= len(symbols)
            first = np.zeros(len(keys) - len(symbols), np.int64)
            first[codes[len(codes) - len(own):][fresh][::-1] - len(symbols)] = at[fresh][::-1]
            self.held[k - 1] = keys, counts, np.concatenate([symbols, grams.symbols[first[:, None] + np.arange(1 - k, 1)]])

    def rows(self):
        for k, (keys, counts, symbols) in enumerate(self.held, 1):
            if len(keys):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([self.lang] * len(keys), pa.string()), pa.array(np.ascontiguousarray(symbols).view(f"<U{k}").ravel().tolist(), pa.string()),
                     pa.array(counts)], ["lang", "gram", "raw"])


def count_grams(docs: DataFrame, order: int) -> DataFrame:
    """(lang, gram, raw) of (lang, text): the character n-grams, n up to ``order``, of all words
    of each language, and their counts. Tasks add up their own before the shuffle."""
    def count(batches):
        words: dict[str, Counter] = {}
        grams: dict[str, GramCounts] = {}
        for part in slices(batches):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                own = words.setdefault(lang, Counter())
                own.update(text.encode().split())
                if len(own) >= COUNT_WORDS:
                    yield from grams.setdefault(lang, GramCounts(lang, order)).add(words.pop(lang))
        for lang, own in words.items():
            if own:
                yield from grams.setdefault(lang, GramCounts(lang, order)).add(own)
        for g in grams.values():
            yield from g.rows()

    return (docs.select("lang", "text").mapInArrow(count, "lang string, gram string, raw long")
            .groupBy("lang", "gram").agg(F.sum("raw").alias("raw")))


def _few(by_language: DataFrame, name: str) -> DataFrame:
    """Some rows for each language, written once; for broadcast if the languages are few, as they should be."""
    by_language = cut_lineage(by_language, name)
    return F.broadcast(by_language) if by_language.count() <= FEW_LANGUAGES * 5 else by_language


def kneser_ney(grams: DataFrame, order: int) -> DataFrame:
    """(lang, gram, back, value): natural logarithm of each n-gram's probability and, with
    ``back``, of its back-off weight as a context.

    Orders below the highest count in how many ways an n-gram continues (what stands
    before it), except those that open a word. Discounts come from the counts of
    counts of each language and order. All n-grams stay, however many.
    """
    grams = grams.select("lang", "gram", "raw", F.char_length("gram").alias("n"))
    tail = lambda c: F.substring(c, 2, order)
    ways = grams.where("n > 1").groupBy("lang", tail("gram").alias("gram")).agg(F.count(F.lit(1)).alias("ways"))
    opens = F.col("gram").startswith(MARKS[0])
    c = (grams.join(ways, ["lang", "gram"], "left")
         .withColumn("c", F.when((F.col("n") == order) | opens, F.col("raw")).otherwise(F.coalesce("ways", "raw")))
         .withColumn("context", F.expr("substring(gram, 1, n - 1)")))
    of = lambda k: F.count(F.when(F.col("c") == k, 1)).cast("double")
    n = c.groupBy("lang", "n").agg(*[of(k).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.coalesce(F.col("n1") / F.nullif(F.col("n1") + 2 * F.col("n2"), F.lit(0.0)), F.lit(0.0))
    discount = lambda k: F.least(F.lit(0.95 * k), F.greatest(F.lit(0.05), F.coalesce(
        k - (k + 1) * y * F.col(f"n{k + 1}") / F.nullif(F.col(f"n{k}"), F.lit(0.0)), F.lit(0.5 * k)))).alias(f"d{k}")
    d = _few(n.select("lang", "n", *[discount(k) for k in (1, 2, 3)]), "discounts")
    total = c.groupBy("lang", "n", "context").agg(F.sum("c").alias("total"))
    kept = (c.join(total, ["lang", "n", "context"])
            .join(d, ["lang", "n"])
            .withColumn("own", (F.col("c") - F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2"))
                                .otherwise(F.col("d3"))) / F.col("total")))
    kept = cut_lineage(kept.select("lang", "n", "gram", "context", "own"), "kneser_ney")
    back = (kept.groupBy("lang", "n", "context").agg(F.sum("own").alias("own"), F.count(F.lit(1)).alias("types"))
            .select("lang", "n", "context", "types", F.greatest(F.lit(1e-9), 1 - F.col("own")).alias("back")))
    back = cut_lineage(back, "back_off")
    unseen = F.col("back") / (F.col("types") + 1)  # what a symbol has that was never seen
    lower = back.where("n = 1").select("lang", F.lit("").alias("gram"), unseen.alias("p"))
    out = [lower.select("lang", "gram", F.lit(True).alias("back"), F.ln("p").alias("value"))]
    for k in range(1, order + 1):
        weight = F.lit(1.0) if k == 1 else F.col("back")
        p = (kept.where(F.col("n") == k).withColumn("_suffix", tail("gram"))
             .join(lower.select("lang", F.col("gram").alias("_suffix"), F.col("p").alias("_lower")), ["lang", "_suffix"])
             .join(back.where(F.col("n") == k).select("lang", "context", "back"), ["lang", "context"])
             .select("lang", "gram", (F.col("own") + weight * F.col("_lower")).alias("p")))
        lower = cut_lineage(p, "probabilities")
        out.append(lower.select("lang", "gram", F.lit(False).alias("back"), F.ln("p").alias("value")))
        if k > 1:
            out.append(back.where(F.col("n") == k).select("lang", F.col("context").alias("gram"), F.lit(True).alias("back"), F.ln("back").alias("value")))
    return reduce(DataFrame.unionByName, out)


def _before() -> F.Column:
    """The symbol before the predicted one that an entry is looked up for: the second last of an n-gram,
    the last of a context; none ('') of single symbols and of the empty context."""
    n = F.char_length("gram")
    return F.when(F.col("back"), F.substring("gram", -1, 1)).otherwise(F.when(n > 1, F.expr("substring(gram, -2, 1)")).otherwise(F.lit("")))


def model_parts(model: DataFrame, entries: int) -> list[dict[tuple[str, str], int]]:
    """The parts of a model: (language, symbol) pairs whose entries are looked up after that symbol,
    with ``entries`` of them together at most, or one pair with more. All that predicts one
    symbol of a text depends on the symbol before it, so a text's loss is the sum of
    what the parts make of it. The pairs are bounded by the letters of the languages."""
    sizes = {(r["lang"], r["before"]): r["count"] for r in model.groupBy("lang", _before().alias("before")).count().collect()}
    parts: list[dict[tuple[str, str], int]] = [{}]
    room = entries
    for pair, n in sorted(sizes.items()):
        if pair[1] == "":
            continue
        if n > room and parts[-1]:
            parts.append({})
            room = entries
        parts[-1][pair] = n
        room -= n
    return parts


class HashModel:
    """The model's keys, sorted, and their values; with ``pairs``, a part of it, which scores only
    what follows these (language, symbol) pairs."""

    def __init__(self, model: pa.Table, order: int, pairs: dict[tuple[str, str], int] | None = None):
        """Of the rows of ``kneser_ney``. A context's key is the complement of its hash."""
        self.after: dict[str, np.ndarray] | None = None
        if pairs is not None:
            own: dict[str, list[int]] = {}
            for lang, symbol in pairs:
                own.setdefault(lang, []).append(ord(symbol))
            self.after = {lang: np.array(codes, np.uint32) for lang, codes in own.items()}
        keys, values = [np.zeros(0, np.int64)], [np.zeros(0)]
        size = pc.utf8_length(model["gram"])
        for lang in pc.unique(model["lang"]).to_pylist():
            for k in range(order + 1):
                for back in (False, True):
                    part = model.filter(pc.and_(pc.and_(pc.equal(model["lang"], lang), pc.equal(size, k)), pc.equal(model["back"], back)))
                    if part.num_rows:
                        hashed = gram_keys(part["gram"].to_pylist(), k, lang)
                        keys.append(~hashed if back else hashed)
                        values.append(part["value"].to_numpy())
        keys, values = np.concatenate(keys), np.concatenate(values)
        o = np.argsort(keys)
        self.keys, self.values, self.order = keys[o], values[o].astype(np.float32), order

    def _value(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        o = np.argsort(keys)  # asked in order: the search goes through memory once, not at random
        at = np.empty(len(keys), np.int64)
        at[o] = np.searchsorted(self.keys, keys[o])
        at = np.minimum(at, len(self.keys) - 1)
        return self.keys[at] == keys, self.values[at].astype(np.float64)

    def score(self, words: list[bytes], lang: str) -> np.ndarray:
        """Log-probability of each word, its closing mark included."""
        grams = WordGrams(words, lang, self.order)
        open_at = grams.ends(1)
        if self.after is not None:
            open_at = open_at[np.isin(grams.symbols[open_at - 1], self.after.get(lang, np.zeros(0, np.uint32)))]
        total = np.zeros(len(grams.place))
        for k in range(self.order, 0, -1):
            now = open_at if k == 1 else open_at[grams.place[open_at] >= k - 1]
            found, value = self._value(grams.key(k, now))
            total[now[found]] += value[found]
            missed = now[~found]
            has, back = self._value(~grams.key(k - 1, missed - 1))
            total[missed] += np.where(has, back, -20.0 if k == 1 else 0.0)
            done = np.zeros(len(grams.place), bool)
            done[now[found]] = True
            open_at = open_at[~done[open_at]]
        return np.bincount(grams.word, total, len(words))


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    data = text.encode()
    words = data.split()  # of bytes: at the six ASCII spaces only
    lines = [x for x in data.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        covered = 0  # words before this are counted already
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + WINDOW - max(covered, i)
                covered = i + WINDOW
    return (len(words), len(text) - (len(data) - len(data.translate(None, SPACES))),
            len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated)


def perplexity_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       order: int = ORDER, lower_spread: float = LOWER_SPREAD, upper_spread: float = UPPER_SPREAD,
                       part_entries: int = PART_ENTRIES) -> DataFrame:
    """One row per document: doc_id, lang, text_crc32, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, log_perplexity (double, null without words), lower,
    upper (its language's bounds), kept.

    base_failed: fewer than 50 words, or more than half of them in repeated 3-word
    windows. kept: not base_failed and log_perplexity within the bounds. The bounds
    come from the quartiles of the language's documents that pass the base rules;
    a language with none has null bounds, and none to keep.

    Cases: a null or empty text has no words and fails; a null language is a
    language of its own; very long texts are scored whole; repeated rows each count
    and each get a row; an empty table gives none; other columns are left behind.
    The model grows with the corpus and is a table in the shared folder. Of it, parts of about
    ``part_entries`` entries are broadcast, one after the other: one pass over the texts
    counts, and one scores for each part. Parts add up exactly; with one part, which does for
    most alphabets, there are two passes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    d = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                    F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).isNull().alias("no_lang"))
    d = d.withColumn("text_crc32", F.crc32(F.col("text").cast("binary"))).withColumn("_hash", F.xxhash64(F.col("text").cast("binary")))
    grams = cut_lineage(count_grams(d, order), "gram_counts")
    model = cut_lineage(kneser_ney(grams, order), "model")
    parts = model_parts(model, part_entries)
    own = ["doc_id", "lang", "no_lang", "text_crc32", "_hash"]
    text_key = ["lang", "text_crc32", "_hash"]

    def scorer(part: dict[tuple[str, str], int] | None, with_counts: bool):
        rows = model
        if part is not None:
            pairs = spark.createDataFrame(list(part), "lang string, _before string")
            rows = model.withColumn("_before", _before())
            rows = rows.where("_before = ''").unionByName(rows.join(F.broadcast(pairs), ["lang", "_before"]).select(*rows.columns)).drop("_before")
        held = spark.sparkContext.broadcast(HashModel(rows.toArrow(), order, part))
        give_back()

        def score(batches):
            lm, memo = held.value, {}
            for part in slices(batches):
                langs, texts = part.column("lang").to_pylist(), part.column("text").to_pylist()
                words = [t.encode().split() for t in texts]
                by_lang: dict[str, set] = {}
                for lang, w in zip(langs, words, strict=True):
                    by_lang.setdefault(lang, set()).update(w)
                if sum(map(len, memo.values())) > MEMO_WORDS:
                    memo = {}
                for lang, seen in by_lang.items():
                    known = memo.setdefault(lang, {})
                    unseen = [w for w in seen if w not in known]
                    if unseen:
                        known.update(zip(unseen, lm.score(unseen, lang).tolist(), strict=True))
                loss = pa.array([-sum(map(memo[lang].__getitem__, w)) for lang, w in zip(langs, words, strict=True)], pa.float64())
                if with_counts:
                    base = np.array([base_counts(t) for t in texts], np.int64).reshape(-1, 5).T
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), *map(pa.array, base), loss],
                                                     [*own, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_loss"])
                else:
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in text_key), loss], [*text_key, "_loss"])
        return score

    scored = d.mapInArrow(scorer(parts[0] if len(parts) > 1 else None, True), "doc_id long, lang string, no_lang boolean, text_crc32 long, _hash long, "
                          "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, _loss double")
    for part in parts[1:]:
        # rows of one text and language have one loss
        loss = (d.mapInArrow(scorer(part, False), "lang string, text_crc32 long, _hash long, _loss double")
                .groupBy(*text_key).agg(F.first("_loss").alias("_more")))
        scored = cut_lineage(scored, "losses").join(cut_lineage(loss, "losses"), text_key).withColumn("_loss", F.col("_loss") + F.col("_more")).drop("_more")
    scored = scored.withColumn("log_perplexity", F.when(F.col("n_words") > 0, F.col("_loss") / (F.col("word_chars") + F.col("n_words")))).drop("_loss", "_hash")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    scored = cut_lineage(scored.withColumn("base_failed", failed), "perplexity")
    q = (scored.where(~F.col("base_failed")).groupBy("lang")
         .agg(F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10_000).alias("q")))
    median, off = F.col("q")[1], lambda side: F.abs(F.col("q")[1] - F.col("q")[side])
    bands = _few(q.select("lang", (median - F.greatest(F.lit(LOWER_WIDTH), lower_spread * off(0))).alias("lower"),
                     (median + F.greatest(F.lit(UPPER_WIDTH), upper_spread * off(2))).alias("upper")), "bands")
    within = F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    return (scored.join(bands, "lang", "left")
            .select("doc_id", F.when(~F.col("no_lang"), F.col("lang")).alias("lang"), "text_crc32", "n_words", "word_chars", "n_symbols",
                    "n_dup_lines", "n_repeat_words", "base_failed", "log_perplexity", "lower", "upper",
                    (~F.col("base_failed") & F.coalesce(within, F.lit(False))).alias("kept")))
