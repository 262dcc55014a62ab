"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased; its n-grams are 1 to ``ORDER`` characters in a row of which at
most the first and the last are no letters (all of these count as the same mark, as do
the ends of the text). Each is hashed into one of ``BUCKETS``. Spark counts (language,
bucket) over the documents to learn from; tasks add up their own first, so what is
shuffled is bounded by languages times buckets a task. The matrix of log-probabilities
is broadcast, and batches of documents are scored in numpy: the weights of all n-grams
of a batch are gathered and added up by document.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercadia.llm.common import id_text, slices, small_batches
from mercadia.session import cut_lineage

ORDER = 4
BUCKETS = 1 << 16
#: Pseudo-count of every bucket in every language.
SMOOTHING = 0.5
#: Languages of a model at most: it is broadcast (256 KB a language). More of them are an error, not left out.
MOST_LANGUAGES = 400
#: Languages whose counts a task holds at a time (512 KB each).
HELD_LANGUAGES = 64
#: Characters that are turned into n-grams at a time; longer texts come in pieces.
PIECE = 1 << 19

UNKNOWN = "und"

# Multipliers of the hash; odd 64-bit numbers
_BASE, _SPREAD, _WORD = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 1 << 64


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _pieces(texts: list[str]) -> Iterator[list[tuple[int, str, int]]]:
    """Groups of (index of the text, a piece of it with marks at its ends, characters at its
    start that the piece before has shown already), of ``PIECE`` characters or so."""
    group, size = [], 0
    for i, text in enumerate(texts):
        marked = "\x00" + text.lower() + "\x00"
        for at in range(0, len(marked), PIECE):
            seen = min(at, ORDER - 1)
            group.append((i, marked[at - seen:at + PIECE], seen))
            size += len(group[-1][1])
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def text_grams(texts: list[str], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of arrays: the index of the text (ascending in each) and the bucket of an n-gram."""
    letters = _letters()
    for group in _pieces(texts):
        codes = np.frombuffer("".join(p for _, p, _ in group).encode("utf-32-le", "replace"), np.uint32)
        size = np.array([len(p) for _, p, _ in group])
        start = np.cumsum(size) - size
        place = np.arange(len(codes)) - np.repeat(start, size)
        fresh = place >= np.repeat(np.array([s for _, _, s in group]), size)  # where n-grams may end
        owner = np.repeat(np.array([i for i, _, _ in group]), size)
        letter = letters[codes]
        code = np.where(letter, codes, 0).astype(np.uint64) + np.uint64(1)
        h, inner, edges = code.copy(), np.ones(len(codes), bool), letter.copy()
        shift = np.uint64(64 - int(buckets).bit_length() + 1)
        where, found = [], []
        for n in range(1, ORDER + 1):
            if n > 1:  # one character more to the left
                h[n - 1:] += code[:len(code) - n + 1] * np.uint64(pow(_BASE, n - 1, _WORD))
            if n > 2:
                inner[n - 1:] &= letter[1:len(letter) - n + 2]
            if n == 2:
                edges[1:] = letter[1:] | letter[:-1]
            ok = fresh & (place >= n - 1) & (edges if n <= 2 else inner)
            at = np.flatnonzero(ok)
            where.append(owner[at])
            found.append(((h[at] * np.uint64(_SPREAD) + np.uint64(n * _BASE % _WORD)) * np.uint64(_SPREAD) >> shift).astype(np.int64))
        yield np.concatenate(where), np.concatenate(found)


def learnt_rows(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(lang, bucket, n) of (lang, text): counts of the n-grams, and as bucket -1 of the documents."""
    def count(batches):
        held: dict[str, np.ndarray] = {}
        for part in slices(batches):
            by: dict[str, list[str]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                if lang not in held and len(held) >= HELD_LANGUAGES:  # labels that are no languages: give out what there is
                    yield from map(rows, held.items())
                    held = {}
                n = held.setdefault(lang, np.zeros(buckets + 1, np.int64))
                n[buckets] += len(texts)
                for _, found in text_grams(texts, buckets):
                    n[:buckets] += np.bincount(found, minlength=buckets)
        yield from map(rows, held.items())

    def rows(own):
        lang, n = own
        at = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(np.where(at == buckets, -1, at).astype(np.int32)), pa.array(n[at])],
                                          ["lang", "bucket", "n"])

    return docs.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Log-probabilities of the buckets for each language, and of the languages."""

    def __init__(self, counts: pa.Table, buckets: int = BUCKETS, smoothing: float = SMOOTHING):
        coded = counts["lang"].combine_chunks().dictionary_encode()
        names, row = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        at, n = counts["bucket"].to_numpy(), counts["n"].to_numpy()
        docs = np.zeros(len(names))
        docs[row[at < 0]] = n[at < 0]
        # of languages without n-grams there is nothing to learn
        order = sorted(set(row[at >= 0].tolist()), key=names.__getitem__)
        self.langs = [names[i] for i in order]
        self.weights = np.zeros((len(order), buckets), np.float32)
        for k, i in enumerate(order):
            own = np.full(buckets, smoothing)
            mine = (row == i) & (at >= 0)
            own[at[mine]] += n[mine]
            self.weights[k] = np.log(own / own.sum())
        self.prior = np.log(docs[order] / docs[order].sum()) if order else np.zeros(0)
        self.buckets = buckets

    def score(self, texts: list[str]) -> np.ndarray:
        """Logarithms of the joint probability of each text (rows) with each language; nan without n-grams."""
        total = np.zeros((len(texts), len(self.langs)))
        seen = np.zeros(len(texts), bool)
        for owner, found in text_grams(texts, self.buckets):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
            if len(starts):
                seen[owner[starts]] = True
                for k in range(len(self.langs)):
                    np.add.at(total[:, k], owner[starts], np.add.reduceat(self.weights[k][found], starts, dtype=np.float64))
        total += self.prior
        total[~seen] = np.nan
        return total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The most probable language of each text (ties: the first by name) and its probability."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total = self.score(texts)
        known = ~np.isnan(total[:, 0])
        total[~known] = 0.0
        best = total.argmax(axis=1)
        sure = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, sure, 0.0)


def train(docs: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> LanguageModel:
    """A model of (lang, text); rows where either is null teach nothing. All rows are
    counted; the driver gets the counts of the model only."""
    counts = cut_lineage(learnt_rows(docs.where("lang IS NOT NULL AND text IS NOT NULL"), buckets), "language_counts")
    langs = counts.select("lang").distinct().limit(MOST_LANGUAGES + 1).count()
    if langs > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn; are these labels languages?")
    return LanguageModel(counts.toArrow(), buckets, smoothing)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Documents to learn nothing from: CRC-32 of the id's decimal text divisible by ``folds``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(folds) == 0


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       folds: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (posterior probability of the
    prediction; the n-grams of a text count as independent, so it is near 1 for all but short texts).

    Learns from text and non-null language of the documents that are not held out, and
    predicts for all. ``und`` with score 0: null texts, texts without a letter, and all texts if
    nothing could be learnt. Cases: a null id has the empty text as its decimal text, whose
    CRC-32 is 0, so it is held out; a null language teaches nothing and is predicted as any
    other; very long texts are read whole, in pieces; repeated rows each count and each
    get a row; equal probabilities go to the language first by name; an empty table
    gives none; other columns are left behind. More than ``MOST_LANGUAGES`` languages are an error.
    """
    spark = docs.sparkSession
    small_batches(spark)
    held = held_out(id_col, folds)
    learn = docs.where(~held).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    model = spark.sparkContext.broadcast(train(learn))

    def predict(batches):
        lm = model.value
        for part in slices(batches):
            langs, scores = lm.predict(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    texts = id_text(docs, id_col, text_col).withColumn("held_out", held_out("doc_id", folds))
    return texts.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")
