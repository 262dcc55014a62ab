"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a slice of texts are held as one flat array of symbol
ids with the start of each sequence. A round looks up the rank of every adjacent
pair, takes each sequence's lowest rank and applies that pair throughout the
sequence, all sequences at once. A sequence without a mergeable pair is done, and
its surviving symbols are its tokens.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mercadia.llm.common import id_text, slices
from mercadia.llm.vocabulary import Memo, Vocabulary, memo_of_units, vocabulary

#: Pre-tokens, and units of text, whose count a worker keeps, and bytes of pre-tokens merged at a time.
MEMO_ENTRIES, MERGE_BYTES = 300_000, 4 << 20


class RankMerger:
    def __init__(self, voc: Vocabulary):
        self.voc = voc
        self.byte_ids = np.array(voc.byte_ids, np.int64)
        self.width = len(voc.token_bytes)
        first: dict[int, tuple[int, int]] = {}
        for r, (a, b, c) in enumerate(voc.merges):
            first.setdefault(a * self.width + b, (r, c))
        keys = np.array(sorted(first), np.int64)
        self.none = len(voc.merges)
        self.keys = np.concatenate([keys, [np.iinfo(np.int64).max]])
        self.ranks = np.array([*(first[k][0] for k in keys.tolist()), self.none], np.int32)
        self.merged = np.array([m[2] for m in voc.merges] + [0], np.int64)
        # ranks of pairs of single bytes, which the first round asks for, in a table of their own
        a, b = np.meshgrid(self.byte_ids, self.byte_ids, indexing="ij")
        self.of_bytes = self._look_up(a.ravel() * self.width + b.ravel()).reshape(256, 256)

    def _look_up(self, pairs: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, pairs)
        return np.where(self.keys[at] == pairs, self.ranks[at], np.int32(self.none))

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left of each sequence after all merges; none of an empty one."""
        out = np.zeros(len(sequences), np.int64)
        size = np.array([len(s) for s in sequences], np.int64)
        which = np.flatnonzero(size)
        raw = np.frombuffer(b"".join(sequences), np.uint8)
        size = size[which]
        symbols = self.byte_ids[raw]
        ranks = np.full(len(raw), self.none, np.int32)
        if len(raw) > 1:
            ranks[:-1] = self.of_bytes[raw[:-1], raw[1:]]
        while len(which):
            starts = np.cumsum(size) - size
            ranks[starts + size - 1] = self.none  # a sequence's last symbol starts no pair
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == self.none
            if done.any():
                out[which[done]] = size[done]
                live = np.repeat(~done, size)
                symbols, ranks = symbols[live], ranks[live]
                which, size, lowest = which[~done], size[~done], lowest[~done]
                if not len(which):
                    break
                starts = np.cumsum(size) - size
            hit = np.flatnonzero(ranks == np.repeat(lowest, size))
            # of hits in a row (a pair of equal symbols) every second, from the left, applies
            new_run = np.concatenate([[True], np.diff(hit) > 1])
            run_at = np.flatnonzero(new_run)
            hit = hit[(np.arange(len(hit)) - run_at[np.cumsum(new_run) - 1]) % 2 == 0]
            symbols[hit] = self.merged[ranks[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            gone = np.cumsum(~keep)
            ends = starts + size - 1
            size = size - (gone[ends] - np.concatenate([[0], gone[ends[:-1]]]))
            at = hit - (gone[hit])  # where the merged symbols stand afterwards
            symbols, ranks = symbols[keep], ranks[keep]
            # only pairs next to a merged symbol have changed
            touched = np.concatenate([at, at[at > 0] - 1])
            touched = touched[touched + 1 < len(symbols)]
            ranks[touched] = self._look_up(symbols[touched] * self.width + symbols[touched + 1])
        return out

    def count_pretokens(self, pretokens: list[str]) -> list[int]:
        raw = [b"" if p in self.voc.specials else p.encode() for p in pretokens]
        out, at = [], 0
        while at < len(raw):  # in bounded arrays
            upto, held = at, 0
            while upto < len(raw) and (held < MERGE_BYTES or upto == at):
                held += len(raw[upto])
                upto += 1
            out += self.count(raw[at:upto]).tolist()
            at = upto
        return [1 if p in self.voc.specials else n for p, n in zip(pretokens, out, strict=True)]


@functools.lru_cache(maxsize=2)
def counter(path: str) -> tuple[Vocabulary, Memo]:
    voc = vocabulary(path)
    return voc, memo_of_units(voc, Memo(RankMerger(voc).count_pretokens, MEMO_ENTRIES), sum, MEMO_ENTRIES)


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): UTF-8 bytes and tokens of every whole
    text under the byte-level BPE file at ``path``; over_limit: more than ``limit``.

    A null or empty text has 0 of both; a special token's text counts as one token.
    One row out for each row in (repeats, null ids and other columns are let be),
    without a shuffle. Workers hold a slice of texts and a memo of bounded size.
    """
    def count(batches):
        voc, memo = counter(path)
        for part in slices(batches):
            texts = part.column(1).to_pylist()
            split = [voc.units(t) for t in texts]
            memo.cover(split)
            n = [sum(map(memo.__getitem__, s)) for s in split]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return id_text(docs, id_col, text_col).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
