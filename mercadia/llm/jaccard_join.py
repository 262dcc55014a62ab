"""N-gram Jaccard join in the metric space of shingle sets.

Jaccard distance 1 - |x & y| / |x | y| is a metric, so a pivot p bounds every other
distance: |d(x,p) - d(y,p)| <= d(x,y). Documents are placed in regions around
pivots, copied into every region whose window they touch, and each region is joined
on its own.

Level 0 has the one-shingle sets as pivots. A document is nearest to those of its
own shingles (all others are at distance 1), and a document within distance r of it
lacks at most r of them: so it is enough to enter the regions of its first
floor(r * n) + 1 shingles in one order common to all documents. In that order
shingles that stand first in many documents come last, the most frequent at the very
end, which keeps regions small.

Level 1 takes the member of each region whose shingle stands first as a pivot, and
computes the members' distances to it. Members within r are linked through it and need
no comparison among themselves. Level 2 joins the regions that then still have several
components: the linked members of a pivot are its Voronoi cell; a member of another
component is compared with the pivot, goes into the cell if it is within 2 r of it
(the triangle inequality's window), and meets those members there whose distances to
the pivot differ from its own by r at most. Every distance that decides a link is
computed on whole sets, so the result is exact.

Equal sets are one class; a class is compared, its documents are not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercadia.llm.common import give_back, slices, small_batches
from mercadia.llm.suffix_dedup import ARROW_BYTES, StretchHash
from mercadia.session import cut_lineage

#: Shingles that come late in the common order, by frequency: those that stand first in more
#: documents than COMMON_OVER; COMMON_KEPT of them at most (the most frequent), which bounds the broadcast.
COMMON_OVER, COMMON_KEPT = 3, 2_000_000
#: Low bits of a key by which one that is not common is mostly told without a search.
MARK_BITS = 23
#: Members of one part of a region that stands under a very frequent shingle.
PART_MEMBERS = 200_000
#: Rows of document ids that may be broadcast to pick the documents to compare; more are shuffled.
BROADCAST_IDS = 500_000
#: Sets that others are compared with go around in bundles of about so many.
BUNDLE = 32
#: Members of an open region meet its cells in blocks of about so many of either; a task
#: looks at so many meetings at a time.
BLOCK, MEETINGS = 2048, 1 << 20
#: Open regions are dense where members by cells, over all regions, are more than so many. Then
#: they are joined in place, by a broadcast of so many rows and shingles of their sets at most;
#: sparse or larger ones are shuffled to their cells.
DENSE_MEETINGS, LEAF_ROWS, LEAF_SHINGLES = 5_000_000, 400_000, 4_000_000
CHUNK_BYTES, BATCH_ENTRIES = 1 << 18, 400_000

_WORD_TABLE = np.random.default_rng(20_240_615).integers(0, 1 << 64, 256, np.uint64)
_WORD_BASE, _SHINGLE_BASE = 0xD1342543DE82EF95, 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True
_LOW = np.uint64(0xFFFFFFFF)
_NO_ID = (1 << 63) - 1  # stands for a null doc_id, after all others


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of a lower-cased text, read in pieces cut at spaces."""
    hashes, firsts, at = [], [], 0
    while at < len(text):
        upto = min(at + CHUNK_BYTES, len(text))
        while upto < len(text) and not _SPACE[text[upto]]:
            upto += 1
        buffer = np.frombuffer(text, np.uint8, upto - at, at)
        space = np.concatenate([[True], _SPACE[buffer], [True]])
        edge = np.flatnonzero(space[1:] != space[:-1])
        first, end = edge[::2], edge[1::2]
        hashes.append(StretchHash(buffer, _WORD_TABLE, _WORD_BASE).of(first, end))
        firsts.append(first + at)
        at = upto
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(hashes) if hashes else empty), (np.concatenate(firsts) if firsts else empty.astype(np.int64))


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``words``-word shingles; of the whole word
    sequence where a text has fewer words, of nothing where it has none."""
    size = np.array([len(t) for t in texts], np.int64)
    word, first = _word_hashes(b"\n".join(texts).lower())
    ends = np.cumsum(size + 1)  # one past the separator
    upto = np.searchsorted(first, ends)
    shingle = word[: max(0, len(word) - words + 1)].copy()
    for k in range(1, words):
        shingle = shingle * np.uint64(_SHINGLE_BASE) + word[k: k + len(shingle)]
    shingle = _mixed(shingle + np.uint64(words))
    out, start = [], 0
    for end in upto.tolist():
        n = end - start
        if n >= words:
            out.append(np.unique(shingle[start:end - words + 1]))
        elif n:
            h = 0
            for w in word[start:end].tolist():
                h = (h * _SHINGLE_BASE + w) % (1 << 64)
            out.append(_mixed(np.array([(h + n) % (1 << 64)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        start = end
    return out


def set_class(shingles: np.ndarray) -> int:
    """Class of a set: a 64-bit hash of its members and size, as a signed number."""
    h = _mixed(np.array([int(shingles.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(shingles, initial=np.uint64(0)))], np.uint64))
    return int(_mixed(h[:1] + h[1:] * np.uint64(3) + np.uint64(len(shingles)))[0].astype(np.int64))


def _least_shared(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _keys(shingles: np.ndarray, buckets: int) -> np.ndarray:
    """A shingle's key: its bucket in the upper, 32 further bits in the lower half."""
    return ((shingles >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (shingles & _LOW)


def _marks(common: np.ndarray) -> np.ndarray:
    """Whether some common key ends in these MARK_BITS bits: most keys are told by that not to be common."""
    marks = np.zeros(1 << MARK_BITS, bool)
    marks[common & np.uint64(len(marks) - 1)] = True
    return marks


def first_shingles(shingles: np.ndarray, percent: int, common: np.ndarray, often: np.ndarray, buckets: int, marks: np.ndarray | None = None) -> np.ndarray:
    """Keys of the shingles one of which any set linked to this one has: its first
    n - ceil(n * percent / 100) + 1 in the order of (frequency among the ``common`` keys
    of which ``often`` has the counts, hash). ``marks``: as of ``_marks``, to look up few keys."""
    need = len(shingles) - _least_shared(len(shingles), percent) + 1 if len(shingles) else 0
    upto = min(2 * need, len(shingles))
    while True:
        keys = _keys(shingles[:upto], buckets)
        count = np.zeros(upto, np.int64)
        if len(common):
            able = slice(None) if marks is None else np.flatnonzero(marks[keys & np.uint64(len(marks) - 1)])
            at = np.minimum(np.searchsorted(common, keys[able]), len(common) - 1)
            count[able] = np.where(common[at] == keys[able], often[at], 0)
        if upto == len(shingles) or (count == 0).sum() >= need:
            first = keys[np.argsort(count, kind="stable")][:need]
            _, once = np.unique(first, return_index=True)
            return first if len(once) == len(first) else first[np.sort(once)]
        upto = len(shingles)


_DEALT = "bucket int, data binary"


def _dealt(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "data"])


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal numbers of a sorted array."""
    if len(bucket):
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)], strict=True):
            yield int(bucket[a]), slice(a, b)


def _texts(batches, name: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for part in slices(batches, size=CHUNK_BYTES):
        yield part, part.column(name).to_pylist()


def _deal_first(words: int, percent: int, buckets: int):
    """Keys of the first shingles by hash, and by bucket: a row's data are the lower halves."""
    def deal(batches):
        held, size = [], 0
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def flush():
            keys = np.sort(np.concatenate(held))
            yield _dealt([(b, (keys[at] & _LOW).astype("<u4").tobytes()) for b, at in _by_bucket(keys >> np.uint64(32))])

        for _, texts in _texts(batches):
            seen = {set_class(s): s for s in shingle_sets(texts, words) if len(s)}
            held += [first_shingles(s, percent, *none, buckets) for s in seen.values()]
            size += sum(map(len, held[-len(seen):])) if seen else 0
            if size >= BATCH_ENTRIES:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()
    return deal


def _count_first(batches):
    """Keys of a bucket and how often they came, where that is more than COMMON_OVER."""
    by: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
            by.setdefault(bucket, []).append(np.frombuffer(data, "<u4"))
    for bucket, parts in by.items():
        low, n = np.unique(np.concatenate(parts), return_counts=True)
        low, n = low[n > COMMON_OVER], n[n > COMMON_OVER]
        yield pa.RecordBatch.from_arrays([pa.array((np.int64(bucket) << 32) | low.astype(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])


def _describe(words: int, percent: int, buckets: int, held_common):
    """(_doc, _hash, _class, n, first) of each text: its class, the size of its set, the keys of its first shingles."""
    def describe(batches):
        common, often = held_common.value
        marks = _marks(common)
        for part, texts in _texts(batches):
            sets = shingle_sets(texts, words)
            first = [first_shingles(s, percent, common, often, buckets, marks).astype(np.int64) for s in sets]
            ends = np.concatenate([[0], np.cumsum([len(f) for f in first])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("_doc"), part.column("_hash"), pa.array([set_class(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(first), pa.int64()))], ["_doc", "_hash", "_class", "n", "first"])
    return describe


# An entry of a class in a region: the rest of the shingle's key, the set's size, the place of
# the shingle in the set's order, and the class.
_ENTRY = (("low", np.dtype("<u4")), ("n", np.dtype("<u4")), ("place", np.dtype("<u4")), ("cls", np.dtype("<i8")))


def _deal_regions(buckets: int, held_common):
    """Each class's entries in its regions, by bucket, as columns one after the other. A
    region under a very frequent shingle is cut into parts by class, which go to
    buckets of their own (part number in the upper half)."""
    def deal(batches):
        common, often = held_common.value
        seen: set[int] = set()
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush():
            key, n, place, cls = (np.concatenate([h[i] for h in held]) for i in range(4))
            bucket = (key >> np.uint64(32)).astype(np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(common, key), len(common) - 1)
                of = np.where(common[at] == key, -(-often[at] // PART_MEMBERS), 1)
                part = 1 + (_mixed(cls.astype(np.uint64)) % of.astype(np.uint64)).astype(np.int64)
                bucket = np.where(of > 1, (part << 32) | bucket, bucket)
            o = np.argsort(bucket, kind="stable")
            columns = [c[o].astype(t) for c, (_, t) in zip((key & _LOW, n, place, cls), _ENTRY, strict=True)]
            runs = list(_by_bucket(bucket[o]))
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in runs], pa.int64()),
                                              pa.array([b"".join(c[at].tobytes() for c in columns) for _, at in runs], pa.binary())], ["bucket", "data"])

        for part in slices(batches):
            cls, n = (part.column(c).to_numpy() for c in ("_class", "n"))
            first = part.column("first")
            keys, count = first.flatten().to_numpy().astype(np.uint64), first.value_lengths().to_numpy()
            new = np.array([not (c in seen or seen.add(c)) for c in cls.tolist()], bool)  # copies near each other count once
            mine = np.repeat(new, count)
            place = np.arange(len(keys)) - np.repeat(np.cumsum(count) - count, count)
            held.append((keys[mine], np.repeat(n, count)[mine], place[mine], np.repeat(cls, count)[mine]))
            size += int(mine.sum())
            if size >= BATCH_ENTRIES:
                yield from flush()
                held, size, seen = [], 0, set()
        if size:
            yield from flush()
    return deal


def _entries(data: bytes) -> list[np.ndarray]:
    n, at, out = len(data) // sum(t.itemsize for _, t in _ENTRY), 0, []
    for _, t in _ENTRY:
        out.append(np.frombuffer(data, t, n, at))
        at += n * t.itemsize
    return out


_MEMBERS = "region long, cls long, n long, tail long, pivot long, pivot_n long, pivot_tail long, members long"


def _form_regions(percent: int):
    """Members of each region with more than one class, and the pivot: the member whose shingle
    stands first, so that it has most in common with the others.

    ``tail`` is how many shingles a member has from the region's on. A pair is to be
    decided in the region of the first shingle that it shares, where both tails must
    hold the overlap that a link needs; members that no other fits in this way are left
    out. A part of a region has a pivot of its own and is told even with one member.
    """
    def form(batches):
        by: dict[int, list] = {}
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
                by.setdefault(bucket, []).append(_entries(data))
        for bucket in list(by):
            low, n, place, cls = (np.concatenate(c) for c in zip(*by.pop(bucket), strict=True))
            n, place = n.astype(np.int64), place.astype(np.int64)
            o = np.lexsort((cls, low))
            once = np.ones(len(o), bool)
            once[1:] = (low[o][1:] != low[o][:-1]) | (cls[o][1:] != cls[o][:-1])
            low, n, place, cls = (c[o][once] for c in (low, n, place, cls))
            part = bucket >> 32
            if not part:
                fits = _fitting(low, n, n - place, percent)
                low, n, place, cls = (c[fits] for c in (low, n, place, cls))
            o = np.lexsort((cls, place / np.maximum(n, 1), low))
            low, n, place, cls = (c[o] for c in (low, n, place, cls))
            if not len(low):
                continue
            first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
            size = np.diff(np.concatenate([first, [len(low)]]))
            lead, size = np.repeat(first, size), np.repeat(size, size)
            region = ((bucket & 0xFFFFFFFF) << 32) | low.astype(np.int64)
            keep = np.flatnonzero((size > 1) | (part > 0))
            for at in np.array_split(keep, max(1, len(keep) // 100_000)):
                to = lead[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (region[at], cls[at], n[at], (n - place)[at], cls[to], n[to], (n - place)[to],
                                           np.where(part > 0, 1 << 40, size[at]).astype(np.int64))],
                    ["region", "cls", "n", "tail", "pivot", "pivot_n", "pivot_tail", "members"])
    return form


def _fitting(low: np.ndarray, n: np.ndarray, tail: np.ndarray, percent: int) -> np.ndarray:
    """Members (sorted by ``low``) for whom the sizes and tails of some other in the region leave room for a link."""
    most = tail * (100 + percent) // percent - n  # the largest partner that this tail allows
    if not len(low):
        return np.zeros(0, bool)
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    size = np.diff(np.concatenate([first, [len(low)]]))

    def least_other(value: np.ndarray) -> np.ndarray:
        o = np.lexsort((value, low))
        own, second = value[o][first], value[o][np.minimum(first + 1, first + size - 1)]
        out = np.repeat(own, size)
        out[o[first]] = second
        return out
    return (np.repeat(size, size) > 1) & (least_other(n) <= most) & (-least_other(-most) >= n)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each component of the graph with edges (a, b)
    (longs, null ones left out). Labels are spread along edges and then halve their own
    paths, so that the rounds grow with the logarithm of a component's width."""
    both = edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = cut_lineage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")

    def spread(label: DataFrame) -> DataFrame:
        near = (both.join(label.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        least = label.join(near, "node").select("node", "was", F.least("label", "near").alias("now"))
        up = label.select(F.col("node").alias("now"), F.col("label").alias("up"))
        return least.join(up, "now").select("node", "was", F.least("now", "up").alias("label"))

    while True:
        label = cut_lineage(spread(spread(label.select("node", "label", F.col("label").alias("was")))), "labels")
        if label.where("label < was").isEmpty():
            return label.select("node", "label")


class _Compare:
    """Decides pairs of classes: first by their first shingles, then by their whole sets."""

    def __init__(self, texts: DataFrame, described: DataFrame, words: int, percent: int):
        self.texts, self.described, self.words, self.percent = texts, described, words, percent
        rep = F.min(F.struct("_doc", "_hash")).alias("m")
        self.reps = cut_lineage(described.where("n > 0").groupBy(F.col("_class").alias("cls")).agg(rep).select("cls", "m._doc", "m._hash"), "representatives")
        #: whether some rows share id and text, so that a representative may be several rows
        self.repeated = not described.groupBy("_doc", "_hash").count().where("count > 1").isEmpty()

    @staticmethod
    def _picked(big: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
        """Inner join of documents with some of them: few of a checked size are broadcast, more are shuffled."""
        few = cut_lineage(few, "picked")
        ids = rows = few.count()
        if "places" in few.columns and rows <= BROADCAST_IDS:  # a class has several, with the classes asked for there
            asked = F.size("places")
            if "others" in few.schema["places"].dataType.elementType.names:
                asked += F.aggregate("places.others", F.lit(0), lambda n, o: n + F.size(o))
            rows = few.agg(F.coalesce(F.sum(asked), F.lit(0))).first()[0]
        if rows <= BROADCAST_IDS:
            return big.join(F.broadcast(few), on)
        if ids <= BROADCAST_IDS:  # many places, but only the documents asked for are shuffled to them
            big = big.join(F.broadcast(few.select(*on)), on, "left_semi")
        return big.join(few, on)

    def possible(self, pairs: DataFrame) -> DataFrame:
        """(a, b, alike) of those distinct pairs (a, b) that can be linked by what their first shingles share.

        With n members of which p come first, and a needed overlap o: of the set whose
        first shingles end sooner, those that the other has are among the other's
        first, and so are o - (n - p) at least."""
        pairs = cut_lineage(pairs, "pairs")
        needed = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
        first = cut_lineage(self._picked(self.described.select("_doc", F.col("_class").alias("cls"), "n", "first"),
                                         self.reps.join(needed, "cls").drop("_hash"), ["_doc", "cls"]).dropDuplicates(["cls"]), "first_shingles")
        side = lambda c: first.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("first").alias(f"first_{c}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b").where(
            F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent)
        overlap = F.ceil((F.col("n_a") + F.col("n_b")) * self.percent / F.lit(100 + self.percent))
        least = F.least(*[overlap - F.col(f"n_{c}") + F.size(f"first_{c}") for c in "ab"])
        alike = F.size(F.array_intersect("first_a", "first_b"))
        able = both.select("a", "b", alike.alias("alike"), least.alias("least")).where("alike >= least").select("a", "b", "alike")
        return cut_lineage(able, "possible")  # it is read more than once

    def _gathered(self, few: DataFrame) -> DataFrame:
        """(cls, shingles, what else ``few`` has): the sets of the classes in ``few`` (a row each), from a text of each."""
        words, more = self.words, [f for f in few.schema.fields if f.name != "cls"]
        names, typed = [f.name for f in more], "".join(f", {f.name} {f.dataType.simpleString()}" for f in more)

        def gather(batches):
            for part, own in _texts(batches):
                sets = shingle_sets(own, words)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = pa.array(np.concatenate(sets).astype(np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([set_class(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), values),
                                                  *[part.column(c) for c in ("cls", *names)]], ["own", "shingles", "cls", *names])
        sets = (self._picked(self.texts, self.reps.join(few, "cls"), ["_doc", "_hash"]).select("text", "cls", *names)
                .mapInArrow(gather, f"own long, shingles array<long>, cls long{typed}")
                .where("own = cls").drop("own"))  # another text of the same hash is no member of the class
        return sets.dropDuplicates(["cls"]) if self.repeated else sets

    def similar(self, pairs: DataFrame) -> DataFrame:
        """(a, b, shared, total) of pairs of classes (a, b): sizes of intersection and union.

        Classes near each other have mostly the same partners. Those with the same least
        partner form a group, whose partners' sets travel as one row for BUNDLE of them;
        a set of ``a`` moves once for each such bundle, not for each pair."""
        pairs = pairs.select("a", "b")
        group = pairs.groupBy("a").agg(F.min("b").alias("k"))
        pairs = pairs.join(group, "a")
        size = pairs.groupBy("k").agg(F.approx_count_distinct("b").alias("n"))
        pairs = cut_lineage(pairs.join(size, "k").select(
            "a", "b", "k", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / F.lit(BUNDLE))).alias("part")), "pairs")
        asked = pairs.groupBy(F.col("a").alias("cls"), "k", "part").agg(F.collect_set("b").alias("others"))
        asking = pairs.select(F.col("b").alias("cls"), "k", "part").distinct()
        # a class goes to its text with all its bundles, so that a set is shuffled to these only
        x, y = (self._gathered(side.groupBy("cls").agg(F.collect_list(F.struct(*[c for c in side.columns if c != "cls"])).alias("places")))
                .select("cls", "shingles", F.explode("places").alias("p")).select("cls", "shingles", "p.*") for side in (asked, asking))
        bundles = (y.groupBy("k", "part").agg(F.collect_list(F.struct(F.col("cls").alias("b"), F.col("shingles").alias("y"))).alias("bundle")))
        found = F.transform(F.filter("bundle", lambda o: F.array_contains("others", o["b"])), lambda o: F.struct(
            o["b"].alias("b"), (F.size("shingles") + F.size(o["y"])).alias("both"), F.size(F.array_intersect("shingles", o["y"])).alias("shared")))
        return (x.join(bundles, ["k", "part"]).select(F.col("cls").alias("a"), F.explode(found).alias("f"))
                .select("a", "f.b", "f.shared", (F.col("f.both") - F.col("f.shared")).alias("total")))


def jaccard_components(docs: DataFrame, words: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are the runs of other bytes than the six ASCII spaces, A-Z lower-cased; a
    document's set are its distinct ``words``-word shingles, or its whole word sequence
    as one shingle where it has fewer. Documents link where 100 * |x & y| >= percent *
    |x | y|; component_id is the least doc_id that links reach, the own one included.

    Cases: a null or empty text, or one without words, has an empty set and links with
    nothing; equal texts link; repeated rows each get a row; a null doc_id gets the
    least id of its component, or null; texts of any length are read whole; an empty
    table gives none; other columns are left behind. Shingles are told apart by 64-bit
    hashes. Runs jobs; intermediate tables are written to the shared folder.
    """
    groups = _groups(docs, words, percent, id_col, text_col)
    known = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    least = groups.where("n > 0").groupBy("_group").agg(F.min("_doc").alias("_least"))
    return (groups.join(least, "_group", "left")
            .select(known("_doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, known("_least")).otherwise(known("_doc")).alias("component_id")))


def jaccard_rows(docs: DataFrame, words: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash (as of ``text_hash``), component: a number that
    equals that of the documents which links reach, as in jaccard_components, whatever
    their ids; null for an empty set. Ids and texts together tell rows apart."""
    return (_groups(docs, words, percent, id_col, text_col)
            .select(F.when(F.col("_doc") != _NO_ID, F.col("_doc")).alias("doc_id"), F.col("_hash").alias("text_hash"),
                    F.when(F.col("n") > 0, F.col("_group")).alias("component")))


def text_hash(text_col: str = "text") -> Column:
    """A 64-bit hash of a text's bytes; a null text is empty."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))


def _groups(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: _doc, _hash, _class, n, _group: its component's number."""
    spark = docs.sparkSession
    small_batches(spark, ARROW_BYTES)
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("_doc"), text.alias("text"))

    # shingles that stand first in many documents
    first = texts.mapInArrow(_deal_first(words, percent, buckets), _DEALT).repartition(buckets, "bucket")
    common = cut_lineage(first.mapInArrow(_count_first, "key long, n long"), "common")
    steps = [COMMON_OVER, *(1 << i for i in range(2, 60))]
    sizes = common.agg(*[F.count(F.when(F.col("n") > s, 1)).alias(f"s{s}") for s in steps]).first()
    common = common.where(F.col("n") > next(s for s in steps if sizes[f"s{s}"] <= COMMON_KEPT)).toArrow().sort_by("key")
    held = spark.sparkContext.broadcast((common["key"].to_numpy().astype(np.uint64), common["n"].to_numpy().clip(max=(1 << 31) - 1).astype(np.int32)))
    del common
    give_back()

    described = cut_lineage(texts.withColumn("_hash", text_hash()).mapInArrow(_describe(words, percent, buckets, held),
                                             "_doc long, _hash long, _class long, n long, first array<long>"), "described")
    dealt = described.where("n > 0").select("_class", "n", "first").mapInArrow(_deal_regions(buckets, held), "bucket long, data binary")
    regions = cut_lineage(dealt.repartition(buckets, "bucket").mapInArrow(_form_regions(percent), _MEMBERS), "regions")

    to_col = lambda c: F.col(c) if isinstance(c, str) else c
    compare = _Compare(texts.withColumn("_hash", text_hash()), described, words, percent)
    linked = lambda df: df.where(F.col("shared") * 100 >= F.col("total") * percent).select("a", "b")

    def fit(n_a, tail_a, n_b, tail_b) -> Column:
        """Whether both tails hold the overlap that two sets need to be linked."""
        return F.least(to_col(tail_a), to_col(tail_b)) * (100 + percent) >= (to_col(n_a) + to_col(n_b)) * percent

    # members against the pivots of their regions, as pairs (member, pivot): the member's set moves to its pivot's
    stars = (regions.where("cls <> pivot").where(fit("n", "tail", "pivot_n", "pivot_tail"))
             .select(F.col("cls").alias("a"), F.col("pivot").alias("b")).distinct())
    near = cut_lineage(compare.similar(compare.possible(stars)), "distances")
    label = connected_components(linked(near))

    # what the pivots left open: members of regions of several components (regions of two are decided),
    # each in the Voronoi cell of the nearest pivot it is linked to, or in a cell of its own
    distance = 1 - F.col("shared") / F.col("total")

    def left_open() -> DataFrame:
        cell = (near.where(F.col("shared") * 100 >= F.col("total") * percent).groupBy(F.col("a").alias("cls"))
                .agg(F.min(F.struct(distance.alias("d"), F.col("b").alias("pivot"))).alias("m")).select("cls", "m.d", "m.pivot"))
        centres = cell.select(F.col("pivot").alias("centre"), F.lit(False).alias("alone")).distinct()
        size = label.groupBy(F.col("label").alias("of_cls")).agg(F.count(F.lit(1)).alias("size"))
        own = labelled(label, regions.where("members > 2").select("region", "cls", "n", "tail"), "cls")
        mixed = (own.groupBy("region").agg(F.min("of_cls").alias("lo"), F.max("of_cls").alias("hi"), F.count(F.lit(1)).alias("members"))
                 .where("lo <> hi").select("region", "members"))
        own = (own.join(mixed, "region").join(size, "of_cls", "left").join(cell, "cls", "left")
               .select("region", "cls", "n", "tail", "members", "of_cls", F.coalesce("size", F.lit(1)).alias("size"),
                       F.coalesce("pivot", "cls").alias("centre"), F.coalesce("d", F.lit(0.0)).alias("d"))
               .join(centres, "centre", "left").withColumn("alone", F.coalesce("alone", F.lit(True))))
        return cut_lineage(own, "open_regions")

    own = left_open()
    leaf = _leaf_join(compare, own, percent)
    if leaf is not None:
        label = connected_components(linked(near).unionByName(cut_lineage(leaf, "links")))
    else:
        label = _window_join(compare, own, near, linked, fit, percent)

    return (described.select("_doc", "_hash", "_class", "n").join(label.select(F.col("node").alias("_class"), "label"), "_class", "left")
            .withColumn("_group", F.coalesce("label", "_class")))


def labelled(label: DataFrame, df: DataFrame, *cols: str) -> DataFrame:
    """``df`` with the component of each class column as ``of_<column>``."""
    for c in cols:
        own = label.select(F.col("node").alias(c), F.col("label").alias("_l"))
        df = df.join(own, c, "left").withColumn(f"of_{c}", F.coalesce("_l", c)).drop("_l")
    return df


def _leaf_join(compare: _Compare, own: DataFrame, percent: int) -> DataFrame | None:
    """Links (a, b) between components of the open regions, enough to join all that are linked;
    None where the regions are sparse, or the members and their sets too large to be broadcast.

    Every task has all open members and takes some of them as ``a``: each meets the
    members of its regions in other components whose sizes and tails fit, by arrays."""
    by_region = own.groupBy("region").agg(F.count(F.lit(1)).alias("m"), F.count_distinct("centre").alias("c"))
    sizes = by_region.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("m") * F.col("c")), F.lit(0)).alias("meetings")).first()
    if sizes["meetings"] < DENSE_MEETINGS or sizes["rows"] > LEAF_ROWS:
        return None
    classes = own.select("cls", "n").distinct()
    if classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] > LEAF_SHINGLES:
        return None
    spark = own.sparkSession
    rows = own.select("region", "cls", "n", "tail", "of_cls").toArrow()
    sets = compare._gathered(classes.select("cls")).dropDuplicates(["cls"]).toArrow()
    held = spark.sparkContext.broadcast(_Leaf(rows, sets, percent))

    def join(batches):
        leaf = held.value
        for batch in batches:
            a, b = leaf.links(batch.column("id").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
    tasks = max(1, min(len(sets), spark.sparkContext.defaultParallelism * 2))
    return spark.range(0, len(sets), 1, tasks).mapInArrow(join, "a long, b long")


class _Leaf:
    """Open members by region, their sets as numbers of shingles, and who links with whom."""

    def __init__(self, rows: pa.Table, sets: pa.Table, percent: int):
        self.percent = percent
        self.cls = sets["cls"].to_numpy()
        o = np.argsort(self.cls)
        self.cls = self.cls[o]
        lists = sets["shingles"].combine_chunks()
        size = lists.value_lengths().to_numpy() if len(lists) else np.zeros(0, np.int64)
        start = np.cumsum(size) - size
        flat = lists.flatten().to_numpy() if len(lists) else np.zeros(0, np.int64)
        flat = np.concatenate([flat[start[i]:start[i] + size[i]] for i in o]) if len(o) else flat
        self.size = size[o].astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        vocabulary, self.flat = np.unique(flat, return_inverse=True)
        self.flat, self.width = self.flat.astype(np.int32), len(vocabulary)
        region, cls, n, tail, of = (rows[c].to_numpy() for c in ("region", "cls", "n", "tail", "of_cls"))
        o = np.argsort(region, kind="stable")
        self.member, self.n, self.tail = np.searchsorted(self.cls, cls[o]), n[o], tail[o]
        self.of = np.zeros(len(self.cls), np.int64)
        self.of[self.member] = of[o]
        edge = np.flatnonzero(np.concatenate([[True], np.diff(region[o]) != 0, [True]])) if len(o) else np.zeros(1, np.int64)
        self.from_, self.to = np.repeat(edge[:-1], np.diff(edge)), np.repeat(edge[1:], np.diff(edge))
        by = np.argsort(self.member, kind="stable")
        self.places, self.first = by, np.searchsorted(self.member[by], np.arange(len(self.cls) + 1))

    def links(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links of the members ``some`` that join what they have not joined yet."""
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = x = parent.get(up, up)
            return x
        out = []
        mark = np.zeros(self.width, bool)
        for a in some.tolist():
            met = []
            for p in self.places[self.first[a]:self.first[a + 1]].tolist():
                at = slice(self.from_[p], self.to[p])
                fits = np.minimum(self.tail[at], self.tail[p]) * (100 + self.percent) >= (self.n[at] + self.n[p]) * self.percent
                met.append(self.member[at][fits])
            met = np.unique(np.concatenate(met)) if met else np.zeros(0, np.int64)
            met = met[(met > a) & (self.of[met] != self.of[a])]
            if not len(met):
                continue
            own = self.flat[self.start[a]:self.start[a] + self.size[a]]
            mark[own] = True
            size = self.size[met]
            ends = np.cumsum(size)
            place = np.repeat(self.start[met] - (ends - size), size) + np.arange(ends[-1])
            shared = np.add.reduceat(mark[self.flat[place]].astype(np.int64), ends - size)
            mark[own] = False
            for b in met[shared * 100 >= (size + len(own) - shared) * self.percent].tolist():
                x, y = find(int(self.of[a])), find(int(self.of[b]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((self.cls[a], self.cls[b]))
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return a, b


_MEETING = ("region", "part", "head", "key", "alone", "of_cls", "size", "tail", "n")


def _dealt_blocks(own: DataFrame) -> DataFrame:
    """Rows as in _MEETING, all longs, of the members of open regions and of the cells there
    (heads: the centre, with the most that a member's tail and size allow), sorted by part. A region
    of many members is cut into blocks of members and of cells, a part for each pair of them."""
    heads = (own.groupBy("region", "centre", "alone", "of_cls", "size", "members").agg(F.max("tail").alias("tail"), F.min("n").alias("n"))
             .select("region", "members", F.lit(1).alias("head"), F.col("centre").alias("key"), "alone", "of_cls", "size", "tail", "n"))
    rows = own.select("region", "members", F.lit(0).alias("head"), F.col("cls").alias("key"), "alone", "of_cls", "size", "tail", "n").unionByName(heads)
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("long")
    rows = (rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumn("part", F.when(F.col("head") == 0, F.col("block") * F.col("blocks") + F.col("other"))
                        .otherwise(F.col("other") * F.col("blocks") + F.col("block"))))
    buckets = max(64, int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (rows.select(*[F.col(c).cast("long").alias(c) for c in _MEETING])
            .repartition(buckets, "region", "part").sortWithinPartitions("region", "part", "head"))


def _meet(percent: int):
    """(a, alone, met) of rows as in _MEETING sorted by part: which centres, those alone in their
    cells or others, of larger components a member meets in a part, if sizes and tails leave room for a link."""
    def of_parts(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = np.cumsum(np.concatenate([[False], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)]))
        head = rows[2] == 1
        own, heads = rows[:, ~head], rows[:, head]
        first, last = (np.searchsorted(part[head], part[~head], side) for side in ("left", "right"))
        ends, at = np.cumsum(last - first), 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + MEETINGS, "right")))
            n = (last - first)[at:upto]
            x = np.repeat(np.arange(at, upto), n)
            y = np.arange(len(x)) + np.repeat(first[at:upto] - (ends[at:upto] - n - before), n)
            (_, _, _, cls, _, of, size, tail, count), (_, _, _, centre, alone, of_y, size_y, tail_y, count_y) = own, heads
            larger = (size_y[y] > size[x]) | ((size_y[y] == size[x]) & (of_y[y] > of[x]))
            fits = np.minimum(tail[x], tail_y[y]) * (100 + percent) >= (count[x] + count_y[y]) * percent
            x, y = x[larger & fits], y[larger & fits]
            for kind in (False, True):
                mine = (alone[y] == 1) == kind
                who, cuts = np.unique(x[mine], return_index=True)
                if len(who):
                    lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, mine.sum()).astype(np.int32)), pa.array(centre[y[mine]]))
                    yield pa.RecordBatch.from_arrays([pa.array(cls[who]), pa.array(np.full(len(who), kind)), lists], ["a", "alone", "met"])
            at = upto

    def meet(batches):
        rest = np.zeros((len(_MEETING), 0), np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = np.concatenate([rest, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
                last = int(np.flatnonzero(np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)]))[-1])
                rest = rows[:, last:]  # the last part may go on in the next batch
                if last:
                    yield from of_parts(rows[:, :last])
        if rest.shape[1]:
            yield from of_parts(rest)
    return meet


def _window_join(compare: _Compare, own: DataFrame, near: DataFrame, linked, fit, percent: int) -> DataFrame:
    """Components after joining the open regions by Voronoi cells and windows, shuffled."""
    # a member against the centres of the larger components in its regions, each centre once whatever regions they share
    met = (_dealt_blocks(own).mapInArrow(_meet(percent), "a long, alone boolean, met array<long>")
           .groupBy("a", "alone").agg(F.array_distinct(F.flatten(F.collect_list("met"))).alias("met"))
           .select("a", F.explode("met").alias("b"), "alone"))
    met = cut_lineage(met, "met")
    found = cut_lineage(compare.similar(met.where(~F.col("alone"))), "distances")
    near = near.unionByName(found)
    label = connected_components(linked(near))
    distance = 1 - F.col("shared") / F.col("total")

    # windows: a member can only be linked to those of a cell whose centre is within 2 r of it, and
    # whose distances from the centre differ from its own by r at most
    r, slack = 1 - percent / 100, 1e-9
    inside = own.select(F.col("centre").alias("b"), F.col("cls").alias("x"), F.col("d").alias("dx"), F.col("n").alias("nx")).distinct()
    sizes = own.select(F.col("cls").alias("a"), "n").distinct()
    windows = (labelled(label, found.select("a", "b", distance.alias("d")).where(F.col("d") <= 2 * r + slack), "a", "b").where("of_a <> of_b")
               .join(sizes, "a").join(inside, "b")
               .where((F.abs(F.col("d") - F.col("dx")) <= r + slack) & (F.col("a") != F.col("x"))
                      & (F.least("n", "nx") * 100 >= F.greatest("n", "nx") * percent))
               .select("a", F.col("x").alias("b")))
    pairs = labelled(label, windows.unionByName(met.where("alone").select("a", "b")).distinct(), "a", "b").where("of_a <> of_b")
    near = near.unionByName(cut_lineage(compare.similar(compare.possible(pairs.select("a", "b"))), "distances"))
    return connected_components(linked(near))
