"""A Merkle manifest of a dataset, folded by retained hash states.

Every row is a leaf. The leaves of a group (a language) stand in order of their id;
runs of ``FAN_OUT`` nodes become the hash of their digests, level by level, until
one node, the group's subroot, remains. The subroots in order of their groups are
the leaves of one more tree, whose last node is the root of the dataset.

A parent's hash is that of its children's digests one after another. While it is
computed, a copy of the hash state is kept before each child's slot; to fold a
replaced child, the state of its slot is resumed and takes in the replacement and
the siblings to the right only.

Subtrees of ``BLOCK_LEVELS`` levels are a task's group: their leaves are numbered in
an order that Spark sorts, and the roots of the subtrees are the leaves of the next
round. What lies above a subtree comes back to it as a path (the siblings to the
left and right on each level), once a subtree and not once a row.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mercadia.llm.common import crc32_sql
from mercadia.session import cut_lineage

FAN_OUT = 8
#: Levels, and so FAN_OUT ** BLOCK_LEVELS leaves, that one task folds as one group.
BLOCK_LEVELS = 3
BLOCK = FAN_OUT ** BLOCK_LEVELS
#: Group paths that may be broadcast to the subtrees (under 2 KB each); more are shuffled with them.
BROADCAST_GROUPS = 1000

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"
_NODE = "key string, pos long, n long, digest string"


def digest(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


class Parent:
    """A run of child digests: its hash, and the hash states before each child's slot."""

    def __init__(self, children: list[str]):
        state = hashlib.sha256()
        self.children, self.states = children, []
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()
        self.after = ["".join(children[i + 1:]).encode() for i in range(len(children))]

    def replaced(self, slot: int, child: str) -> str:
        """The hash with another digest in a slot."""
        state = self.states[slot].copy()
        state.update(child.encode())
        state.update(self.after[slot])
        return state.hexdigest()

    def siblings(self, slot: int) -> tuple[str, str]:
        return "".join(self.children[:slot]), "".join(self.children[slot + 1:])


def levels_of(n: int, most: int) -> int:
    """Levels above ``n`` nodes until one remains, ``most`` at most."""
    k = 0
    while n > 1 and k < most:
        n, k = -(-n // FAN_OUT), k + 1
    return k


def subtree(leaves: list[str], levels: int) -> list[list[Parent]]:
    """The parents of each level over the leaves of a subtree."""
    out, nodes = [], leaves
    for _ in range(levels):
        parents = [Parent(nodes[i:i + FAN_OUT]) for i in range(0, len(nodes), FAN_OUT)]
        out.append(parents)
        nodes = [p.digest for p in parents]
    return out


def _fold(tree: list[list[Parent]], at: int, leaf: str) -> str:
    for parents in tree:
        at, slot = divmod(at, FAN_OUT)
        leaf = parents[at].replaced(slot, leaf)
    return leaf


def _siblings(tree: list[list[Parent]], at: int) -> list[tuple[str, str]]:
    out = []
    for parents in tree:
        at, slot = divmod(at, FAN_OUT)
        out.append(parents[at].siblings(slot))
    return out


def _in_order(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows with ``key`` (string) as a table, with ``pos`` (gapless from 0 in each key, in the
    order given) and ``n`` (rows of the key). Rows are sorted by ranges, numbered inside a
    range as they stream by, and moved on by what the ranges before hold. Equal rows are
    set apart by where they were read, so they don't have to share a range."""
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = ["key", *order, "_row"]
    ranged = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(width, *sort).sortWithinPartitions(*sort).drop("_row")

    def number(batches):
        from pyspark import TaskContext
        part, last, at = TaskContext.get().partitionId(), None, 0
        for b in batches:
            places = []
            for key in b.column("key").to_pylist():
                at = at + 1 if key == last else 0
                last = key
                places.append(at)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(places, pa.int64())],
                                             [*b.schema.names, "_part", "_at"])

    fields = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    placed = cut_lineage(ranged.mapInArrow(number, f"{fields}, _part int, _at long"), name)
    held = placed.groupBy("key", "_part").agg(F.count(F.lit(1)).alias("_held"))
    own = Window.partitionBy("key")
    starts = held.select("key", "_part", F.sum("_held").over(own).alias("n"),
                         F.coalesce(F.sum("_held").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return placed.join(starts, ["key", "_part"]).withColumn("pos", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def _block() -> Column:
    return F.floor(F.col("pos") / F.lit(BLOCK)).cast("long").alias("_block")


def _sorted(t: pa.Table) -> pa.Table:
    return t.sort_by("pos")


def _roots(nodes: DataFrame) -> DataFrame:
    """(key, pos, n, digest) of the roots of the subtrees over such nodes."""
    def root(t: pa.Table) -> pa.Table:
        t = _sorted(t)
        n = t["n"][0].as_py()
        leaves = t["digest"].to_pylist()
        tree = subtree(leaves, levels_of(n, BLOCK_LEVELS))
        top = tree[-1][0].digest if tree else leaves[0]
        return pa.table({"key": [t["key"][0].as_py()], "pos": [t["pos"][0].as_py() // BLOCK], "n": [-(-n // BLOCK)], "digest": [top]},
                        schema=pa.schema([("key", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]))

    return nodes.select("key", "pos", "n", "digest").groupBy("key", _block()).applyInArrow(root, _NODE)


def _paths(nodes: DataFrame) -> DataFrame:
    """(key, pos, top, path) of nodes: the last node above each of them, and the siblings
    on every level up to it, from below."""
    if nodes.where("n > 1").isEmpty():
        return nodes.select("key", "pos", F.col("digest").alias("top"), F.array().cast(_PATH).alias("path"))
    above = _paths(cut_lineage(_roots(nodes), "merkle_roots"))

    def extend(own: pa.Table, up: pa.Table) -> pa.Table:
        own = _sorted(own)
        tree = subtree(own["digest"].to_pylist(), levels_of(own["n"][0].as_py(), BLOCK_LEVELS))
        top, rest = up["top"][0].as_py(), up["path"][0].as_py()
        path = [[{"before": a, "after": b} for a, b in _siblings(tree, i)] + rest for i in range(own.num_rows)]
        return pa.table([own["key"], own["pos"], pa.array([top] * own.num_rows, pa.string()),
                         pa.array(path, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))], ["key", "pos", "top", "path"])

    return cut_lineage(nodes.select("key", "pos", "n", "digest").groupBy("key", _block()).cogroup(above.groupBy("key", F.col("pos").alias("_block")))
                       .applyInArrow(extend, f"key string, pos long, top string, path {_PATH}"), "merkle_paths")


def _framed(c: Column) -> Column:
    """A value with its size before it, or ``-``."""
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def merkle_manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang",
                    text_col: str = "text", tampered: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256 (all as the table is),
    folded_root (its leaf folded up with its siblings), verified (that is the root).

    A leaf is the SHA-256 of the row's ``columns``, each with its size in bytes before it, or
    ``-`` if null. ``tampered`` (a condition, false where null) marks rows whose text gets its
    A-Z lower-cased before the fold, after the manifest was made: those that hold one must not
    verify. Without it the fold is of the leaves as they are.

    Cases: a null group is a group of its own and comes first; a null id comes first in
    its group; rows of one id stand in order of their leaves; equal rows each have a place; a group
    of one row is its own subroot, without siblings there; texts are hashed whole where they are
    read, and only digests move; an empty table gives none; other columns are left behind.
    """
    text = F.col(text_col)
    leaf = lambda text: F.sha2(F.concat(*[_framed(text if c == text_col else F.col(c)) for c in columns]).cast("binary"), 256)
    upper = "".join(map(chr, range(65, 91)))
    changed = (F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))) & text.isNotNull()
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = docs.select(group.alias("key"), F.col(id_col).alias("id"), leaf(text).alias("digest"),
                         F.when(changed, leaf(F.translate(text, upper, upper.lower()))).alias("other"))
    # written before they are sorted: a sort by ranges reads its input twice, and that would be all texts
    nodes = cut_lineage(_in_order(cut_lineage(leaves, "merkle_digests"), ["id", "digest"], "merkle_leaves"), "merkle_nodes")
    trees = _paths(cut_lineage(_roots(nodes), "merkle_roots"))
    subroots = trees.where("pos = 0").select(F.lit("").alias("key"), F.col("key").alias("group"), F.col("top").alias("digest"))
    ranked = cut_lineage(_in_order(subroots, ["group"], "merkle_groups"), "merkle_subroots")
    whole = (_paths(ranked).select("pos", F.col("top").alias("root"), F.col("path").alias("_rest"))
             .join(ranked.select("pos", F.col("group").alias("key")), "pos").drop("pos"))
    whole = F.broadcast(whole) if ranked.count() <= BROADCAST_GROUPS else whole
    above = trees.join(whole, "key").select("key", "pos", F.col("top").alias("subroot"), "root", F.concat("path", "_rest").alias("path"))
    id_type = docs.select(id_col).dtypes[0][1]

    def fold(own: pa.Table, up: pa.Table) -> pa.Table:
        own = _sorted(own)
        leaves = own["digest"].to_pylist()
        tree = subtree(leaves, levels_of(own["n"][0].as_py(), BLOCK_LEVELS))
        path = up["path"][0].as_py()
        over = "".join(s["before"] + s["after"] for s in path)
        states = [(hashlib.sha256(s["before"].encode()), s["after"].encode()) for s in path]  # before this subtree's slot on each level
        proofs, roots = [], []
        for i, (leaf, other) in enumerate(zip(leaves, own["other"].to_pylist(), strict=True)):
            proofs.append(digest("".join(a + b for a, b in _siblings(tree, i)) + over))
            node = _fold(tree, i, leaf if other is None else other)
            for before, after in states:
                state = before.copy()
                state.update(node.encode())
                state.update(after)
                node = state.hexdigest()
            roots.append(node)
        subroot, root = up["subroot"][0].as_py(), up["root"][0].as_py()
        same = lambda x: pa.array([x] * own.num_rows, pa.string())
        return pa.table([own["id"], own["digest"], same(subroot), same(root), pa.array(proofs, pa.string()), pa.array(roots, pa.string()),
                         pa.array([r == root for r in roots], pa.bool_())],
                        ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return (nodes.groupBy("key", _block()).cogroup(above.groupBy("key", F.col("pos").alias("_block")))
            .applyInArrow(fold, f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"))


def _levels_sql(tree: str, levels: int) -> str:
    """CTEs of a tree's levels: ``<tree>_0`` has key, pos, digest; each level adds the siblings
    (before, after) of its nodes, and stays as it is where one node remains."""
    out = []
    for k in range(levels):
        run = "PARTITION BY key, pos // 8"
        out.append(f"""{tree}_s{k} AS (
SELECT key, pos, digest, COUNT(*) OVER (PARTITION BY key) AS n,
  COALESCE(string_agg(digest, '') OVER ({run} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
  COALESCE(string_agg(digest, '') OVER ({run} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
FROM {tree}_{k})""")
        out.append(f"""{tree}_{k + 1} AS (
SELECT key, pos // 8 AS pos, if(ANY_VALUE(n) = 1, ANY_VALUE(digest), sha256(string_agg(digest, '' ORDER BY pos))) AS digest FROM {tree}_s{k} GROUP BY key, pos // 8)""")
    return ",\n".join(out)


def _climb_sql(tree: str, source: str, levels: int) -> str:
    """CTEs that fold each row of ``source`` (key, pos, node, proof) up a tree."""
    out = [f"{tree}_c0 AS (SELECT * FROM {source})"]
    for k in range(levels):
        out.append(f"""{tree}_c{k + 1} AS (
SELECT c.* REPLACE (c.pos // 8 AS pos, if(s.n = 1, c.node, sha256(s.before || c.node || s.after)) AS node, c.proof || s.before || s.after AS proof)
FROM {tree}_c{k} c JOIN {tree}_s{k} s ON s.key = c.key AND s.pos = c.pos)""")
    return ",\n".join(out)


LEVELS = 10


def _manifest_sql() -> str:
    def framed(c):
        return f"COALESCE(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(framed(text if c == "text" else c) for c in COLUMNS) + ")"
    upper = "".join(map(chr, range(65, 91)))
    return f"""WITH leaves AS (
SELECT doc_id, COALESCE('=' || lang, '') AS key, {leaf('text')} AS leaf,
  if({crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0, {leaf(f"translate(text, '{upper}', '{upper.lower()}')")}, {leaf('text')}) AS other
FROM documents),
placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
t_0 AS (SELECT key, pos, leaf AS digest FROM placed),
{_levels_sql('t', LEVELS)},
u_0 AS (SELECT '' AS key, ROW_NUMBER() OVER (ORDER BY encode(key)) - 1 AS pos, digest, key AS own FROM t_{LEVELS}),
{_levels_sql('u', LEVELS)},
up AS (SELECT doc_id, leaf, key, pos, COALESCE(other, leaf) AS node, '' AS proof FROM placed),
{_climb_sql('t', 'up', LEVELS)},
over AS (SELECT c.doc_id, c.leaf, '' AS key, u.pos, c.node, c.proof, u.digest AS subroot FROM t_c{LEVELS} c JOIN u_0 u ON u.own = c.key),
{_climb_sql('u', 'over', LEVELS)}
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = digest AS verified FROM u_c{LEVELS}, u_{LEVELS}"""


MANIFEST_SQL = _manifest_sql()
