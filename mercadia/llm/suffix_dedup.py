"""Suffix-array dedup with a logarithmic family of indexes.

Every byte covered by a string of LENGTH bytes that also starts earlier in the
corpus is found exactly. Suffixes are sampled: of the GRAM-byte strings in each
LENGTH-byte window the one with the least hash (the leftmost of equals) is the
window's anchor, so equal windows have their anchor at the same place. A suffix
entry stands for the stretch of text that covers all windows of one anchor, and
carries two fingerprints: of the anchor's gram and of the whole stretch.

A batch of entries, sorted by stretch, is its suffix array. The suffix space is
split into buckets by gram; a bucket takes batches one after the other, scans
each against its levels (sorted arrays without a common stretch), and keeps what
is new as a level of its own, merging levels of like size, so that there are
logarithmically many. A stretch that is met again is a repeat as a whole, but for
its first place. Stretches that share only a gram may share some of their windows:
comparing the contexts of the gram bounds which, and those windows go, each an entry
by itself, through a second family of the same kind. Together this covers every window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadia.llm.common import give_back, slices, small_batches
from mercadia.session import cut_lineage

LENGTH, GRAM = 100, 32
#: Bytes of text hashed at a time; entries a task gathers before it deals them out.
CHUNK_BYTES, BATCH_ENTRIES = 1 << 18, 100_000
#: Bytes of an Arrow batch, of which a task's JVM and its Python process hold several at once.
ARROW_BYTES = 4 << 20
#: A gram with more stretches than this in one batch is frequent: its bucket hears of it by two
#: of them, and the windows of the others are asked at once. Those that the bucket has of such a
#: gram, from any batch, are asked for their windows too, as their contexts meet only a part.
FREQUENT_GRAM = 64
#: Bytes between the places, before and after a gram, up to which its contexts are told apart.
CONTEXT_STEP = 12
_PLACES = 1 << 23

_RNG = np.random.default_rng(20_240_611)
_GRAM_BYTES, _TEXT_BYTES, _TEXT_BYTES_2 = (_RNG.integers(0, 1 << 64, 256, np.uint64) for _ in range(3))
_GRAM_BASE, _TEXT_BASE, _TEXT_BASE_2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5
_WORD = 1 << 64
# Order of columns of an entry: two fingerprints; place (document, its text's tag, start); further windows after start.
_FIELDS = (("gram", "<u8"), ("stretch", "<u8"), ("doc", "<i8"), ("tag", "<i8"), ("start", "<u4"), ("more", "<u2"))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class StretchHash:
    """Fingerprints of any stretches of a buffer, from prefix sums of a polynomial."""

    def __init__(self, buffer: np.ndarray, table: np.ndarray, base: int):
        self.to_start = np.uint64(pow(base, -len(buffer), _WORD))
        self.power = np.full(len(buffer) + 1, base, np.uint64)
        self.power[0] = 1
        np.cumprod(self.power, out=self.power)
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(table[buffer] * self.power[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        last = len(self.power) - 1
        value = (self.sums[end] - self.sums[start]) * self.power[last - start] * self.to_start
        return _mixed(value + (end - start).astype(np.uint64))


def gram_hashes(buffer: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from each place of the buffer on."""
    h, span = _GRAM_BYTES[buffer], 1
    while span < gram:
        h = h[:-span] * np.uint64(pow(_GRAM_BASE, span, _WORD)) + h[span:]
        span *= 2
    return _mixed(h)


def stretches(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """(start, further windows, gram hash, stretch hash) of the entries of texts that
    lie at [starts, ends) of the buffer."""
    fits = ends - starts >= length
    if not fits.any():
        return [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)] * 2
    h = gram_hashes(buffer, gram)
    low = np.uint64(_PLACES - 1)  # a hash's low bits make room for its place, so that the leftmost of equals is least
    assert len(h) <= _PLACES
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    width, have = length - gram + 1, 1
    while have < width:  # least of the `have` grams from each place on; then of `width`
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    inside = np.zeros(len(buffer) + 2, np.int32)
    np.add.at(inside, starts[fits], 1)
    np.add.at(inside, ends[fits] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(inside)[: len(least)])
    anchor = (least[at] & low).astype(np.int64)
    new = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(at) != 1)])
    first = np.flatnonzero(new)
    more = np.diff(np.concatenate([first, [len(at)]])) - 1
    start = at[first]
    whole = StretchHash(buffer, _TEXT_BYTES, _TEXT_BASE).of(start, start + more + length)
    return start, more, h[anchor[first]], whole


class Entries(dict):
    """Columns of equal length by name, as in _FIELDS."""

    @classmethod
    def of(cls, *columns: np.ndarray) -> Entries:
        return cls({n: c.astype(t) for (n, t), c in zip(_FIELDS, columns, strict=True)})

    @classmethod
    def joined(cls, parts: list[Entries]) -> Entries:
        return cls({n: np.concatenate([p[n] for p in parts]) if parts else np.zeros(0, t) for n, t in _FIELDS})

    @property
    def size(self) -> int:
        return len(self["gram"])

    def take(self, at) -> Entries:
        return Entries({n: c[at] for n, c in self.items()})

    def packed(self) -> bytes:
        """Columns one after the other, each byte by byte, which compresses best."""
        return b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(-1, c.itemsize).T).tobytes() for c in self.values())

    @classmethod
    def unpacked(cls, data: bytes) -> Entries:
        width = sum(np.dtype(t).itemsize for _, t in _FIELDS)
        n, at, out = len(data) // width, 0, cls()
        for name, t in _FIELDS:
            size = np.dtype(t).itemsize
            out[name] = np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T).view(t).reshape(n)
            at += n * size
        return out


def _earlier(a: Entries, b: Entries) -> np.ndarray:
    """Whether each place of ``a`` comes before that of ``b``."""
    same_doc, same_tag = a["doc"] == b["doc"], a["tag"] == b["tag"]
    return (a["doc"] < b["doc"]) | (same_doc & ((a["tag"] < b["tag"]) | (same_tag & (a["start"] < b["start"]))))


def _later_places(a: Entries, b: Entries) -> Entries:
    """Of places with the same stretch, the later of each two that differ."""
    first = _earlier(a, b)
    return Entries.joined([b.take(first), a.take(_earlier(b, a))])


class IndexFamily:
    """Levels of sorted entries; a stretch is in one level at most, at its first place so far."""

    def __init__(self):
        self.levels: list[Entries] = []

    def add(self, batch: Entries) -> Entries:
        """Index a batch; the places that are found to repeat an earlier one."""
        o = np.lexsort((batch["start"], batch["tag"], batch["doc"], batch["gram"], batch["stretch"]))
        batch = batch.take(o)
        again = np.zeros(batch.size, bool)
        again[1:] = (batch["stretch"][1:] == batch["stretch"][:-1]) & (batch["gram"][1:] == batch["gram"][:-1])
        # the same place twice (a repeated row) is no repeat
        lead = np.maximum.accumulate(np.where(again, 0, np.arange(batch.size)))[again] if again.any() else np.zeros(0, np.int64)
        repeats = [_later_places(batch.take(lead), batch.take(again))]
        batch = batch.take(~again)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level["stretch"], batch["stretch"]), level.size - 1)
            hit = (level["stretch"][at] == batch["stretch"]) & (level["gram"][at] == batch["gram"])
            if hit.any():
                old, new, at = level.take(at[hit]), batch.take(hit), at[hit]
                repeats.append(_later_places(old, new))
                sooner = _earlier(new, old)
                for name in ("doc", "tag", "start"):
                    level[name][at[sooner]] = new[name][sooner]
                batch = batch.take(~hit)
        if batch.size:
            self.levels.append(batch)
        while len(self.levels) > 1 and self.levels[-2].size < 2 * self.levels[-1].size:
            self._merge(2)
        return Entries.joined(repeats)

    def _merge(self, last: int) -> None:
        both = Entries.joined(self.levels[-last:])
        self.levels[-last:] = [both.take(np.argsort(both["stretch"], kind="stable"))]

    def all(self) -> Entries:
        if len(self.levels) > 1:
            self._merge(len(self.levels))
        return self.levels[0] if self.levels else Entries.joined([])


_DEALT = "bucket int, data binary"
# What a dealt row holds, by the bucket's number: entries of a bucket; with this bit, entries of
# it whose grams are frequent; from here on repeats and windows to ask that are known already
# and only pass through, spread by document.
_OFTEN, _REPEATS, _ASKED = 1 << 27, 1 << 28, 1 << 29


def _dealt(parts: list[tuple[int, np.ndarray, object]]) -> pa.RecordBatch:
    """(first number, bucket of each entry, entries with ``take`` and ``packed``) as rows."""
    rows: list[tuple[int, bytes]] = []
    for base, bucket, entries in parts:
        o = np.argsort(bucket, kind="stable")
        entries, bucket = entries.take(o), bucket[o]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
            if b > a:
                rows.append((base + int(bucket[a]), entries.take(slice(a, b)).packed()))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "data"])


def _deal(entries: Entries, repeats: list[Entries], buckets: int, frequent: int | None = None) -> Iterator[pa.RecordBatch]:
    """Entries by gram; what is known already by document."""
    number = lambda p, by: (_mixed(p[by].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    known = Entries.joined(repeats)
    parts = [(_REPEATS, number(known, "doc"), known)]
    if frequent is not None and entries.size:
        entries = entries.take(np.argsort(entries["gram"], kind="stable"))
        first = np.flatnonzero(np.concatenate([[True], entries["gram"][1:] != entries["gram"][:-1]]))
        size = np.diff(np.concatenate([first, [entries.size]]))
        at_once = (np.arange(entries.size) - np.repeat(first, size) >= 2) & np.repeat(size > frequent, size)
        often = np.repeat(size > frequent, size) & ~at_once
        asked, told, entries = entries.take(at_once), entries.take(often), entries.take(~at_once & ~often)
        parts += [(_ASKED, number(asked, "doc"), asked), (_OFTEN, number(told, "gram"), told)]
    yield _dealt([*parts, (0, number(entries, "gram"), entries)])


def _chunks(texts: Iterator[tuple[int, int, bytes]], length: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Texts gathered to about CHUNK_BYTES; longer ones in pieces that overlap by length - 1."""
    held, size = [], 0
    for doc, tag, text in texts:
        for at in range(0, max(1, len(text) - length + 1), CHUNK_BYTES):
            piece = text[at:at + CHUNK_BYTES + length - 1]
            if len(piece) < length:
                continue
            held.append((doc, tag, at, piece))
            size += len(piece)
            if size >= CHUNK_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _rows(batches, names: tuple[str, ...]) -> Iterator[tuple]:
    give_back()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def _index_texts(length: int, gram: int, buckets: int):
    frequent = FREQUENT_GRAM

    def index(batches):
        family, repeats, new = IndexFamily(), [], 0
        for held in _chunks(_rows(batches, ("_doc", "_tag", "_bytes")), length):
            size = np.array([len(h[3]) for h in held])
            ends = np.cumsum(size)
            buffer = np.frombuffer(b"".join(h[3] for h in held), np.uint8)
            start, more, g, whole = stretches(buffer, ends - size, ends, length, gram)
            which = np.searchsorted(ends, start, side="right")
            doc, tag, base = (np.array([h[i] for h in held], np.int64) for i in range(3))
            repeats.append(family.add(Entries.of(g, whole, doc[which], tag[which], start - (ends - size)[which] + base[which], more)))
            new += len(start)
            if new >= BATCH_ENTRIES:
                yield from _deal(family.all(), repeats, buckets, frequent)
                family, repeats, new = IndexFamily(), [], 0
        yield from _deal(family.all(), repeats, buckets, frequent)
    return index


def _listed(part: pa.RecordBatch, name: str) -> list[np.ndarray]:
    """The lists of a column as arrays; none of a null."""
    column = part.column(name)
    values, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1]) if len(ends) else []


def _asked(batches, length: int) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Document, tag, text and asked stretches (start, further windows) of each text, in
    chunks of stretches of CHUNK_BYTES together, or of one more than that."""
    give_back()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            for doc, tag, text, asked in zip(*(part.column(n).to_pylist() for n in ("_doc", "_tag", "_bytes")), _listed(part, "asked"), strict=True):
                ask = np.stack([asked >> _MORE_BITS, asked & ((1 << _MORE_BITS) - 1)], axis=1)
                before = np.cumsum(ask[:, 1] + length) - (ask[:, 1] + length)
                for chunk in np.split(ask, np.flatnonzero(np.diff(before // CHUNK_BYTES)) + 1):
                    if len(chunk):
                        yield doc, tag, text, chunk


class Contexts(dict):
    """What stands before and after a gram: its place in windows, and hashes of its contexts by width."""

    def __init__(self, gram, place, ahead, hashes):
        super().__init__(gram=gram, place=place, ahead=ahead, hashes=hashes)

    def take(self, at) -> Contexts:
        return Contexts(*(c[at] for c in self.values()))

    def packed(self) -> bytes:
        return b"".join(np.ascontiguousarray(c).tobytes() for c in self.values())

    @classmethod
    def unpacked(cls, data: bytes, width: int) -> Contexts:
        n = len(data) // (8 + _PLACE.itemsize + 2 + 4 * width)
        at, out = 0, []
        for t, shape in (("<u8", (n,)), (_PLACE, (n,)), ("<u2", (n,)), ("<u4", (n, width))):
            size = int(np.prod(shape))
            out.append(np.frombuffer(data, t, size, at).reshape(shape))
            at += size * np.dtype(t).itemsize
        return cls(*out)


_PLACE = np.dtype([("doc", "<i8"), ("tag", "<i8"), ("start", "<u4"), ("more", "<u4")])


def _context_widths(length: int, gram: int) -> np.ndarray:
    return np.arange(CONTEXT_STEP, length - gram + 1, CONTEXT_STEP)


def _index_contexts(length: int, gram: int, buckets: int):
    """Contexts of the grams of asked stretches. A width beyond the stretch has hash 0."""
    widths = _context_widths(length, gram)

    def index(batches):
        held, size = [], 0
        for doc, tag, text, ask in _asked(batches, length):
            start, more = ask.T
            span = more + length
            flat = np.frombuffer(b"".join(text[s:s + n] for s, n in zip(start.tolist(), span.tolist(), strict=True)), np.uint8)
            lead = np.cumsum(span) - span
            # the anchor is in every window: the least gram of those that all of them hold
            h = gram_hashes(flat, gram)
            assert len(h) <= _PLACES
            first, count = lead + more, length - gram + 1 - more
            within = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            least = (h[within] & ~np.uint64(_PLACES - 1)) | within.astype(np.uint64)
            anchor = (np.minimum.reduceat(least, np.cumsum(count) - count) & np.uint64(_PLACES - 1)).astype(np.int64)
            whole = StretchHash(flat, _TEXT_BYTES_2, _TEXT_BASE_2)
            before, after = anchor - lead, lead + span - anchor - gram
            cols = []
            for w in widths:
                cols.append(np.where(before >= w, whole.of(np.maximum(anchor - w, 0), anchor + gram) | np.uint64(1), np.uint64(0)))
            for w in widths:
                cols.append(np.where(after >= w, whole.of(anchor, np.minimum(anchor + gram + w, len(flat))) | np.uint64(1), np.uint64(0)))
            place = np.zeros(len(ask), _PLACE)
            place["doc"], place["tag"], place["start"], place["more"] = doc, tag, start, more
            held.append(Contexts(h[anchor], place, before.astype("<u2"), np.array(cols, np.uint64).reshape(2 * len(widths), len(ask)).T.astype("<u4")))
            size += len(ask)
            if size >= BATCH_ENTRIES // 4:
                both = Contexts(*(np.concatenate([c[n] for c in held]) for n in ("gram", "place", "ahead", "hashes")))
                yield _dealt([(0, (both["gram"] % np.uint64(buckets)).astype(np.int64), both)])
                held, size = [], 0
        if held:
            both = Contexts(*(np.concatenate([c[n] for c in held]) for n in ("gram", "place", "ahead", "hashes")))
            yield _dealt([(0, (both["gram"] % np.uint64(buckets)).astype(np.int64), both)])
    return index


def _bound_contexts(length: int, gram: int):
    """The windows of each stretch that another one with its gram can have too."""
    widths = _context_widths(length, gram)
    room = length - gram

    def bound(batches):
        by: dict[int, list[Contexts]] = {}
        for bucket, data in _rows(batches, ("bucket", "data")):
            by.setdefault(bucket, []).append(Contexts.unpacked(data, 2 * len(widths)))
        for bucket in list(by):
            parts = by.pop(bucket)
            gram_of, place, ahead, hashes = (np.concatenate([c[n] for c in parts]) for n in ("gram", "place", "ahead", "hashes"))
            reach = []
            for side in range(2):
                most = np.full(len(gram_of), widths[0] - 1 if len(widths) else room)
                for i, w in enumerate(widths):
                    h = hashes[:, side * len(widths) + i].astype(np.uint64)
                    both = _mixed(gram_of + h * np.uint64(_GRAM_BASE))
                    _, inverse, count = np.unique(both, return_inverse=True, return_counts=True)
                    shared = (h > 0) & (count[inverse] > 1)
                    most[shared] = widths[i + 1] - 1 if i + 1 < len(widths) else room
                reach.append(most)
            # a window has `left` bytes before the gram and room - left after it
            left_most = np.minimum(ahead.astype(np.int64), reach[0])
            left_least = np.maximum(ahead.astype(np.int64) - place["more"], room - reach[1])
            some = left_most >= left_least
            start = (place["start"].astype(np.int64) + ahead - left_most)[some]
            more = (left_most - left_least)[some]
            yield pa.RecordBatch.from_arrays([pa.array(place["doc"][some]), pa.array(place["tag"][some].astype(np.int64)), pa.array(start), pa.array(more),
                                              pa.array(np.full(len(start), _ASK_WINDOWS, np.int32))], ["_doc", "_tag", "start", "more", "kind"])
    return bound


def _index_windows(length: int, buckets: int):
    """The single windows of the asked stretches of a text as entries."""
    frequent = None

    def index(batches):
        family, repeats, new = IndexFamily(), [], 0
        for doc, tag, text, ask in _asked(batches, length):
            n = ask[:, 1] + 1
            flat = np.frombuffer(b"".join(text[s:s + m + length] for s, m in ask.tolist()), np.uint8)
            lead = np.cumsum(ask[:, 1] + length) - (ask[:, 1] + length)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at, start = np.repeat(lead, n) + step, np.repeat(ask[:, 0], n) + step
            one = StretchHash(flat, _TEXT_BYTES, _TEXT_BASE).of(at, at + length)
            two = StretchHash(flat, _TEXT_BYTES_2, _TEXT_BASE_2).of(at, at + length)
            place = np.full(len(at), doc, np.int64), np.full(len(at), tag, np.int64)
            repeats.append(family.add(Entries.of(two, one, *place, start, np.zeros(len(at)))))
            new += len(at)
            if new >= BATCH_ENTRIES:
                yield from _deal(family.all(), repeats, buckets, frequent)
                family, repeats, new = IndexFamily(), [], 0
        yield from _deal(family.all(), repeats, buckets, frequent)
    return index


# Kinds of what is found: a repeat; a stretch whose contexts, one whose windows have to be compared.
_FOUND, _REPEAT, _ASK_CONTEXT, _ASK_WINDOWS = "_doc long, _tag long, start long, more long, kind int", 0, 1, 2


def _to_buckets(dealt: DataFrame, buckets: int) -> DataFrame:
    """All rows of a bucket, those of frequent grams among them, in one partition, which has no
    other bucket (by a hash of its number, up to four would meet in one task's memory)."""
    return dealt.repartitionById(buckets, F.pmod(F.col("bucket").bitwiseAND(F.lit(~_OFTEN)), F.lit(buckets)).cast("int"))


def _merge_scan(batches):
    """Buckets of entries to repeats and, where stretches share only a gram, stretches to ask:
    for their windows if some of the gram's were asked at once, for their contexts if none was."""
    def told(e: Entries, kind: int) -> Iterator[pa.RecordBatch]:
        for at in range(0, e.size, 100_000):
            p = e.take(slice(at, at + 100_000))
            yield pa.RecordBatch.from_arrays([pa.array(p[n].astype(np.int64)) for n in ("doc", "tag", "start", "more")]
                                             + [pa.array(np.full(p.size, kind, np.int32))], ["_doc", "_tag", "start", "more", "kind"])

    families: dict[int, IndexFamily] = {}
    frequent: dict[int, list[np.ndarray]] = {}
    for bucket, data in _rows(batches, ("bucket", "data")):
        entries = Entries.unpacked(data)
        if bucket >= _REPEATS:
            yield from told(entries, _ASK_WINDOWS if bucket >= _ASKED else _REPEAT)
        else:
            if bucket & _OFTEN:
                bucket &= ~_OFTEN
                frequent.setdefault(bucket, []).append(np.unique(entries["gram"]))
            yield from told(families.setdefault(bucket, IndexFamily()).add(entries), _REPEAT)
    for bucket in list(families):
        e = families.pop(bucket).all()
        e = e.take(np.argsort(e["gram"], kind="stable"))
        same = e["gram"][1:] == e["gram"][:-1]
        if e.size:
            often = np.isin(e["gram"], np.concatenate(frequent.pop(bucket, [np.zeros(0, "<u8")])))
            yield from told(e.take(often), _ASK_WINDOWS)
            yield from told(e.take((np.concatenate([same, [False]]) | np.concatenate([[False], same])) & ~often), _ASK_CONTEXT)


def _identified(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """_doc (a null id comes first), _tag (tells texts of one id apart), _bytes, and the columns asked for."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63))).alias("_doc"),
                       F.xxhash64(text).alias("_tag"), text.alias("_bytes"), *[F.col(f"`{c}`") for c in more])


_MORE_BITS = 16


def _by_text(found: DataFrame, name: str) -> DataFrame:
    """(_doc, _tag, name): the stretches of each text, each as one number: start, then further windows."""
    both = F.shiftleft(F.col("start"), _MORE_BITS).bitwiseOR(F.col("more"))
    return found.groupBy("_doc", "_tag").agg(F.collect_list(both).alias(name))


def _repeats(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(_doc, _tag, removed): the repeated windows of each text that has some, as _by_text gives them."""
    if not gram < length <= 1 << _MORE_BITS or gram & (gram - 1):
        raise ValueError("gram: a power of two below length; length: 65536 at most")
    spark = texts.sparkSession
    small_batches(spark, ARROW_BYTES)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = texts.select("_doc", "_tag", "_bytes")
    dealt = slim.where(F.length("_bytes") >= length).mapInArrow(_index_texts(length, gram, buckets), _DEALT)
    found = cut_lineage(_to_buckets(dealt, buckets).mapInArrow(_merge_scan, _FOUND), "stretches")
    kind = lambda df, k: df.where(F.col("kind") == k)
    asking = lambda df: slim.join(_by_text(df, "asked"), ["_doc", "_tag"])
    contexts = asking(kind(found, _ASK_CONTEXT)).mapInArrow(_index_contexts(length, gram, buckets), _DEALT)
    narrowed = _to_buckets(contexts, buckets).mapInArrow(_bound_contexts(length, gram), _FOUND)
    windows = asking(kind(found, _ASK_WINDOWS).unionByName(narrowed)).mapInArrow(_index_windows(length, buckets), _DEALT)
    asked = _to_buckets(windows, buckets).mapInArrow(_merge_scan, _FOUND)
    return _by_text(kind(found.unionByName(asked), _REPEAT), "removed")


def _spans(removed: np.ndarray | None, length: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the repeated windows cover."""
    if removed is None or not len(removed):
        return []
    removed = np.sort(np.asarray(removed, np.int64))
    start = removed >> _MORE_BITS
    end = np.maximum.accumulate(start + (removed & ((1 << _MORE_BITS) - 1)) + length)
    first = np.concatenate([[True], start[1:] > end[:-1]])
    return list(zip(start[first].tolist(), end[np.concatenate([first[1:], [True]])].tolist(), strict=True))


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    if not spans:
        return text
    at = [0, *(x for s in spans for x in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(at[::2], at[1::2], strict=True))


def dedup_digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 (of the remaining bytes), over the UTF-8 bytes of whole texts.

    A byte goes if a ``length``-byte string that covers it also starts earlier: in
    a document with a smaller doc_id, or earlier in its own. Strings are judged on
    the input and never cross documents. ``gram`` is a power of two below ``length``.
    Cases: a null or empty text, or one shorter than ``length``, loses nothing; a null
    doc_id comes first; different texts under one id are told apart (the one with the
    smaller 64-bit hash comes first), equal rows get equal results; texts of any length are
    read in pieces; an empty table gives no rows; other columns are left behind.
    """
    texts = _identified(docs, id_col, text_col)

    def digest(batches):
        for batch in batches:
            cols = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for part in slices([batch], 64):
                for doc, text, removed in zip(part.column("_doc").to_pylist(), part.column("_bytes").to_pylist(), _listed(part, "removed"), strict=True):
                    spans = _spans(removed, length)
                    for k, v in (("doc_id", doc if doc != -(1 << 63) else None), ("n_bytes", len(text)), ("n_removed", sum(b - a for a, b in spans)),
                                 ("n_spans", len(spans)), ("kept_sha256", hashlib.sha256(_kept(text, spans)).hexdigest())):
                        cols[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k == "kept_sha256" else pa.int64()) for k, v in cols.items()], list(cols))

    return (texts.join(_repeats(texts, length, gram), ["_doc", "_tag"], "left").select("_doc", "_bytes", "removed")
            .mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes (as in dedup_digests) taken out of ``text_col``;
    a character that is cut in part goes as a whole. Texts without repeats, null ones
    among them, stay as they are; all rows and columns are kept."""
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    names = {c: f"_c{i}" for i, c in enumerate([id_col, text_col, *rest])}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    texts = _identified(own, "_c0", "_c1", *names.values())

    @F.pandas_udf("string")
    def cut(text: pd.Series, removed: pd.Series) -> pd.Series:
        return text.combine(removed, lambda t, r: _kept(bytes(t), _spans(r, length)).decode("utf-8", "ignore"))

    joined = texts.join(_repeats(texts, length, gram), ["_doc", "_tag"], "left")
    new = F.when(F.col("removed").isNull(), F.col("_c1")).otherwise(cut("_bytes", "removed"))
    return joined.select(*[(new if c == text_col else F.col(names[c])).alias(c) for c in docs.columns])
