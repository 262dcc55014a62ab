"""BPE encoding by backtracking over longest matches, decoding by an offset table.

An Aho-Corasick automaton gives the longest token that starts at a position, and a
table the next shorter one that the same bytes start with. The encoder appends the
longest token that is compatible with the one before, falls back to the next
shorter token, and steps back where none fits; positions known to lead nowhere
are marked, so each is tried once. Two tokens are compatible if merging their
joint bytes would keep the boundary between them; answers are kept in a table.
The result is that of applying the merges by rank, in time linear in the length.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mercadia.llm.common import id_text, slices
from mercadia.llm.vocabulary import Memo, Vocabulary, vocabulary

#: Units of text, and pre-tokens of units with several, whose ids a worker keeps, and pairs whose answer it keeps.
MEMO_ENTRIES, PAIR_ENTRIES = 300_000, 1_000_000
#: Letters below this are letters in every version of Unicode that matters.
LATIN_END = "\u0250"
#: Characters that the automaton scans to the end; of longer texts it gets what a token can reach.
SHORT = 64


class Ids(array):
    """The ids of a unit, and ``decimal``, the same as decimals with a comma after each."""

    __slots__ = ("decimal",)


class Encoder:
    def __init__(self, voc: Vocabulary):
        self.voc = voc
        self.size = [len(b) for b in voc.token_bytes]
        # Moments: a merge of rank r comes at 2 r on the left side of a boundary, at 2 r + 2 on its right, and at
        # 2 r + 1 across it, so after the left side's of that rank and before the right side's.
        self.across = {}                     # (left, right) -> moment of the merge across
        self.made = [-1] * len(self.size)    # id -> 2 r of the merge that makes it; bytes: before all merges
        self.halves = {}                     # id -> (left, right)
        for r, (a, b, c) in enumerate(voc.merges):
            self.across[a, b] = 2 * r + 1
            if self.made[c] < 0:
                self.made[c], self.halves[c] = 2 * r, (a, b)
        # left id -> {id: the longest token, of it and the shorter ones, that fits after left; -1 if none}
        self.fitting: defaultdict[int, dict[int, int]] = defaultdict(dict)
        self.answers = 0
        self.known: dict[str, tuple[int, ...]] = {}
        self.decimal = [f"{i}," for i in range(len(voc.token_bytes))]
        self.marks = {c: voc.ids[c.encode()] for c in ",.;:!?"}
        self.most = max(map(len, voc.ids), default=1)
        self.shorter = [-1] * len(self.size)  # id -> the longest token that the id's bytes start with, but for itself
        self.automaton = ahocorasick.Automaton()
        for b, i in voc.ids.items():
            if b:
                self.automaton.add_word(b.decode("latin-1"), i)
                self.shorter[i] = next((voc.ids[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in voc.ids), -1)
        self.automaton.make_automaton()

    def pair_fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens by rank ends with just these two.

        Undo the merges that made the tokens, latest first, looking at the pair of
        symbols at the boundary: a merge across it that ranks before the merge just
        undone would have come first and removed the boundary. Of two merges of one
        rank (equal tokens on both sides), the left one is applied first.
        """
        # merges across the boundary that come before this moment break it
        across, made, halves = self.across, self.made, self.halves
        limit = 2 * len(self.voc.merges)
        while across.get((left, right), limit) >= limit:
            undo_left, undo_right = made[left], made[right]
            if undo_left > undo_right:
                limit, left = undo_left, halves[left][1]
            elif undo_right >= 0:
                limit, right = undo_right + 2, halves[right][0]
            else:
                return True
        return False

    def _fitting(self, left: int, token: int) -> int:
        """Of a token and the shorter ones it starts with, the longest that fits after ``left``; -1 if none."""
        if self.answers >= PAIR_ENTRIES:
            self.fitting.clear()
            self.answers = 0
        of_left, tried, answer = self.fitting[left], [], -1
        while token >= 0:
            answer = of_left.get(token, -2)
            if answer != -2:
                break
            tried.append(token)
            answer = token if self.pair_fits(left, token) else -1
            if answer >= 0:
                break
            token = self.shorter[token]
        of_left.update(dict.fromkeys(tried, answer))
        self.answers += len(tried)
        return answer

    def _longest(self, text: str, at: int, ahead: dict[int, int]) -> int:
        """The longest token that starts at a place. ``ahead`` keeps those that follow one another
        from there on, which the automaton finds in the same scan, of short texts."""
        size = self.size
        if len(text) > SHORT:
            last, token = next(self.automaton.iter_long(text[at:at + self.most]), (-1, 0))
            if last + 1 != size[token]:
                raise ValueError("no encoding: the vocabulary lacks a byte")
            return token
        for last, token in self.automaton.iter_long(text, at):
            place = last + 1 - size[token]
            if place in ahead:
                break
            ahead[place] = token
        if at not in ahead:
            raise ValueError("no encoding: the vocabulary lacks a byte")
        return ahead[at]

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of a pre-token's bytes."""
        whole = self.voc.ids.get(data)
        if whole is not None:
            return [whole]
        text, n = data.decode("latin-1"), len(data)
        fitting, size, shorter, longest = self.fitting, self.size, self.shorter, self._longest
        out: list[int] = []
        dead = bytearray(n + 1)
        at, left, ahead = 0, -1, {}
        token = longest(text, 0, ahead) if n else -1
        of_left: dict[int, int] = {}  # answers for the token before
        while at < n:
            while token >= 0:
                if left >= 0:
                    fit = of_left.get(token, -2)
                    token = self._fitting(left, token) if fit == -2 else fit
                    if token < 0:
                        break
                end = at + size[token]
                if not dead[end]:
                    break
                token = shorter[token]
            if token < 0:
                dead[at] = 1
                if not out:
                    raise ValueError("no encoding")
                token = out.pop()
                at -= size[token]
                token = shorter[token]
                left = out[-1] if out else -1
                of_left = fitting[left]
                continue
            out.append(token)
            at, left = end, token
            if at < n:
                of_left = fitting[token]
                token = ahead.get(at, -1)
                if token < 0:
                    token = longest(text, at, ahead)
        return out

    def encode_unit(self, unit: str | tuple[str], memo: dict) -> Ids:
        """Ids of a unit of a text (as ``Vocabulary.units`` cuts it). ``memo`` has those of units seen
        before: a word with a mark after it is the word's ids and the mark's."""
        voc, known = self.voc, self.known
        if isinstance(unit, str):
            mark = self.marks.get(unit[-1:])
            if mark is not None and _is_word(unit[:-1]):  # the mark is a pre-token of its own
                word = memo[unit[:-1]]
                out = Ids("i", word)
                out.append(mark)
                out.decimal = word.decimal + self.decimal[mark]
                return out
        if isinstance(unit, str) and _is_word(unit):  # one pre-token
            ids = self.encode_bytes(b" " + unit.encode())
        else:
            ids = []
            for p in voc.unit_pretokens(unit):
                own = known.get(p)
                if own is None:
                    if len(known) >= MEMO_ENTRIES:
                        known.clear()
                    own = known[p] = (voc.specials[p],) if p in voc.specials else tuple(self.encode_bytes(p.encode()))
                ids += own
        out = Ids("i", ids)
        out.decimal = "".join(map(self.decimal.__getitem__, ids))
        return out


def _is_word(unit: str) -> bool:
    return unit.isalpha() and (unit.isascii() or max(unit) < LATIN_END)


class UnitMemo(Memo):
    """``Ids`` by unit, each found when it is first asked for."""

    def __init__(self, encoder: Encoder, entries: int):
        super().__init__(lambda units: [self[u] for u in units], entries)
        self.encoder = encoder

    def __missing__(self, unit: str | tuple[str]) -> Ids:
        ids = self.older.get(unit)
        if ids is None:
            ids = self.encoder.encode_unit(unit, self)
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[unit] = ids
        return ids


class Decoder:
    """All tokens' bytes in one buffer; a token is the stretch between two offsets."""

    def __init__(self, voc: Vocabulary):
        self.blob = np.frombuffer(b"".join(voc.token_bytes), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in voc.token_bytes])]).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD."""
        if not len(ids):
            return ""
        lo = self.offsets[ids]
        n = self.offsets[ids + 1] - lo
        ends = np.cumsum(n)
        place = np.arange(ends[-1]) + np.repeat(lo - (ends - n), n)
        return self.blob[place].tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def coder(path: str) -> tuple[Vocabulary, Memo, Decoder]:
    """Automaton, tables and memo of a vocabulary, built once in each Python worker."""
    voc = vocabulary(path)
    return voc, UnitMemo(Encoder(voc), MEMO_ENTRIES), Decoder(voc)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): token ids of every whole text under the vocabulary at
    ``path`` (a byte-level BPE file present on every machine).

    A null or empty text has no ids; special tokens' texts inside a text become
    their ids. Repeated rows and ids, null ids and other columns are let be: one
    row out for each row in, without a shuffle. A worker holds a slice of texts
    and a bounded memo, so texts of any length and number are fine.
    """
    def encode(batches):
        voc, memo, _ = coder(path)
        for part in slices(batches):
            split = [voc.units(t) for t in part.column(1).to_pylist()]
            ids = [np.frombuffer(b"".join([memo[u] for u in s]), "i4") for s in split]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), values)], ["doc_id", "ids"])
    return id_text(docs, id_col, text_col).mapInArrow(encode, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null or empty ids give an empty text."""
    def decode(batches):
        _, _, dec = coder(path)
        for part in slices(batches):
            ids = (np.asarray(x if x is not None else [], np.int64) for x in part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([dec.decode(x) for x in ids], pa.string())], ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def encoding_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded and decoded
    again in one pass; ids as decimals joined by commas. Cases as in encode_documents."""
    def digest(batches):
        voc, memo, dec = coder(path)
        for part in slices(batches):
            split = [voc.units(t) for t in part.column(1).to_pylist()]
            n, ids_hex, text_hex = [], [], []
            for s in split:
                coded = [memo[u] for u in s]
                ids = np.frombuffer(b"".join(coded), "i4")
                n.append(len(ids))
                ids_hex.append(hashlib.sha256("".join([c.decimal for c in coded])[:-1].encode()).hexdigest())
                text_hex.append(hashlib.sha256(dec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()),
                                              pa.array(text_hex, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return id_text(docs, id_col, text_col).mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
