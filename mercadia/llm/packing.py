"""Best-fit packing of token sequences with large-item matching.

Pieces longer than a third of the capacity fit at most two to a sequence: from
the longest on, each is paired with the longest other one that still fits.
Shorter pieces then go, longest first, where the remaining gap is smallest, and
open a new sequence where none is wide enough.

Where a piece goes depends on its length alone, so the plan is made from the
count of each length (no more rows than the capacity, whatever the input) in
runs: so many pieces of a length into so many like sequences. Pieces look up
their run by their number among the pieces of their length.
"""

from __future__ import annotations

import bisect
import functools
import os
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mercadia.llm.common import id_text, numbered, slices
from mercadia.llm.vocabulary import vocabulary
from mercadia.session import cut_lineage

#: Runs of more white space than this go round tiktoken's pattern.
LONG_GAP = 100_000
_GAP = regex.compile(r"\s+")


class SequencePlan:
    """runs: (length, first rank, end rank, pieces per sequence, first sequence, offset)."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences, self.runs = capacity, 0, []
        self.gaps: list[int] = []                       # sorted
        self.open: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, sequences)

    def _leave(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in self.open:
                bisect.insort(self.gaps, gap)
            self.open.setdefault(gap, []).append((first, count))

    def _take(self, gap: int) -> tuple[int, int]:
        run = self.open[gap].pop()
        if not self.open[gap]:
            del self.open[gap]
            self.gaps.remove(gap)
        return run

    def _new(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def match_large(self, counts: dict[int, int]) -> None:
        left = {n: c for n, c in counts.items() if 3 * n > self.capacity and c}
        rank = dict.fromkeys(left, 0)
        lengths = sorted(left)
        while lengths:
            n = lengths[-1]
            at = bisect.bisect_right(lengths, self.capacity - n) - 1
            partner = lengths[at] if at >= 0 else None
            if partner is None or (partner == n and left[n] == 1):
                # alone: of the longest and a partner of its own length with one piece, or with none
                if partner == n and at > 0:
                    partner = lengths[at - 1]
                else:
                    first = self._new(left[n])
                    self.runs.append((n, rank[n], rank[n] + left[n], 1, first, 0))
                    self._leave(self.capacity - n, first, left[n])
                    lengths.pop()
                    continue
            pairs = left[n] // 2 if partner == n else min(left[n], left[partner])
            first = self._new(pairs)
            if partner == n:
                self.runs.append((n, rank[n], rank[n] + 2 * pairs, 2, first, 0))
                rank[n] += 2 * pairs
                left[n] -= 2 * pairs
            else:
                for length, offset in ((n, 0), (partner, n)):
                    self.runs.append((length, rank[length], rank[length] + pairs, 1, first, offset))
                    rank[length] += pairs
                    left[length] -= pairs
            self._leave(self.capacity - n - partner, first, pairs)
            lengths = [x for x in lengths if left[x]]

    def fit_small(self, counts: dict[int, int]) -> None:
        for n in sorted((n for n, c in counts.items() if 3 * n <= self.capacity and c), reverse=True):
            left, rank = counts[n], 0
            while left:
                at = bisect.bisect_left(self.gaps, n)
                if at == len(self.gaps):
                    count = -(-left // (self.capacity // n))
                    self._leave(self.capacity, self._new(count), count)
                    continue
                gap = self.gaps[at]
                first, count = self._take(gap)
                # best fit fills a sequence as far as the length goes before it turns to another of that gap
                each = min(gap // n, left)
                used = min(count, left // each)
                self.runs.append((n, rank, rank + used * each, each, first, self.capacity - gap))
                rank, left = rank + used * each, left - used * each
                self._leave(gap - each * n, first, used)
                self._leave(gap, first + used, count - used)


def plan_sequences(counts: dict[int, int], capacity: int) -> SequencePlan:
    """The packing of ``counts`` (pieces by length, 1 to ``capacity``)."""
    plan = SequencePlan(capacity)
    plan.match_large(counts)
    plan.fit_small(counts)
    return plan


def _around_long_gaps(text: str, specials: dict[str, int]) -> list[tuple[str, bool]]:
    """The parts of a text and whether each is one pre-token, a run of more than LONG_GAP spaces:
    tiktoken's pattern engine gives up on runs of about a million.

    The pattern takes a run whole at the end of the text and before a special token, and else
    without its last character, which goes with what follows or stands alone. Neither
    side of such a cut looks across it."""
    out, done = [], 0
    for m in _GAP.finditer(text):
        a, b = m.span()
        if b - a <= LONG_GAP:
            continue
        end = b if b == len(text) or any(text.startswith(s, b) for s in specials) else b - 1
        if a > done:
            out.append((text[done:a], False))
        out.append((text[a:end], True))
        done = end
    if done < len(text) or not out:
        out.append((text[done:], False))
    return out


@functools.lru_cache(maxsize=2)
def text_ids(path: str) -> Callable[[str], np.ndarray]:
    """Ids of a text, special tokens' texts in it included, as the tokenizers library gives them.

    Where ids stand in the order of the merges, a vocabulary is a table of ranks, which
    tiktoken encodes several times as fast; the library itself does the others."""
    voc = vocabulary(path)
    made = [c for _, _, c in voc.merges]
    if all(a < b for a, b in zip(made, made[1:], strict=False)) and max(voc.byte_ids) < min(made):
        ranks = {b: i for b, i in voc.ids.items()}
        encoding = tiktoken.Encoding("ranks", pat_str=voc.PATTERN, mergeable_ranks=ranks, special_tokens=voc.specials)

        def ids(text: str) -> np.ndarray:
            parts = _around_long_gaps(text, voc.specials) if len(text) > LONG_GAP else [(text, False)]
            got = [np.array(encoding._encode_single_piece(p.encode()), "<u4") if gap else encoding.encode_to_numpy(p, allowed_special="all") for p, gap in parts]
            return got[0] if len(got) == 1 else np.concatenate([np.zeros(0, "<u4"), *got])
        return ids
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return lambda text: np.array(library.encode(text, add_special_tokens=False).ids, "<u4")


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0, keep_ids: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the pieces of each document's
    ids under the tokenizer file at ``path``, ``end_id`` appended.

    Longer documents than ``capacity`` are cut into full pieces, the first of which
    has what is left over. A null or empty text has ``end_id`` alone.
    """
    def cut(batches):
        encode = text_ids(path)
        end = np.array([end_id], "<u4").tobytes()
        for part in slices(batches):
            rows, crc, kept = [], [], []
            for doc, text in enumerate(part.column(1).to_pylist()):
                ids = encode(text).astype("<u4").tobytes() + end
                n = len(ids) // 4
                at, size = 0, n % capacity or capacity
                piece = 0
                while at < n:
                    data = ids[4 * at:4 * (at + size)]
                    rows.append((doc, piece, at, size))
                    crc.append(zlib.crc32(data))
                    if keep_ids:
                        kept.append(np.frombuffer(data, "<u4").astype("int32"))
                    at, size, piece = at + size, capacity, piece + 1
            doc, piece, start, length = np.array(rows, np.int64).reshape(-1, 4).T
            cols = [part.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                cols, names = [*cols, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)
    return id_text(docs, id_col, text_col).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with sequence_id (long, from 0) and offset (long): each piece's place.

    ``pieces`` has doc_id, piece, start and length (1 to ``capacity``; others raise)
    and must give the same rows when read again. Pieces do not overlap and leave no
    gap before them. Equal pieces of one document and repeated documents each have a
    place. An empty table gives none. Only the count of each length meets in one
    task, and the plan made of it is broadcast: both are bounded by ``capacity``.
    """
    def plan(batches):
        counts: dict[int, int] = {}
        for pdf in batches:
            counts.update(zip(pdf["length"].tolist(), pdf["n"].tolist(), strict=True))
        if counts and not 1 <= min(counts) <= max(counts) <= capacity:
            raise ValueError(f"piece lengths must be 1 to {capacity}")
        yield pd.DataFrame(plan_sequences(counts, capacity).runs,
                           columns=["length", "rank_from", "rank_to", "each", "sequence_from", "offset_from"])

    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    runs = counts.coalesce(1).mapInPandas(plan, "length long, rank_from long, rank_to long, each long, sequence_from long, offset_from long")
    ranked = numbered(pieces, ["length"], [F.xxhash64(*pieces.columns)], [F.col("doc_id"), F.col("piece"), F.col("start")], "_rank").alias("p")
    run = F.broadcast(runs).alias("r")
    inside = F.col("_rank") - F.col("r.rank_from")
    return (ranked.join(run, (F.col("p.length") == F.col("r.length")) & (F.col("_rank") >= F.col("r.rank_from"))
                        & (F.col("_rank") < F.col("r.rank_to")))
            .select(*[F.col(f"p.{c}") for c in pieces.columns],
                    (F.col("sequence_from") + F.floor(inside / F.col("each"))).cast("long").alias("sequence_id"),
                    (F.col("offset_from") + F.pmod(inside, F.col("each")) * F.col("p.length")).cast("long").alias("offset")))


def pack_documents(docs: DataFrame, path: str, capacity: int, end_id: int = 0, keep_ids: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """token_pieces placed by pack_pieces: doc_id, piece, start, length, ids_crc32
    [, ids], sequence_id, offset. The pieces are written once to the shared folder
    (runs a job), so texts are tokenized once. Null ids and repeated rows stay."""
    pieces = token_pieces(docs, path, capacity, end_id, keep_ids, id_col, text_col)
    return pack_pieces(cut_lineage(pieces, "token_pieces"), capacity)
