"""Exact top-k search by columnar branch and bound.

Vectors are held in vertical layout: a block is a matrix of dimensions by
vectors. A block of queries meets a block of candidates dimension block by
dimension block; after each, a candidate whose partial product plus the largest
product its remaining dimensions could still add (Cauchy-Schwarz on the mass
that remains on both sides) stays below the query's k-th best score so far is
dropped, and the survivors are compacted. Results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Candidates and queries of a block, and dimensions added up between two prunings.
CANDIDATE_ROWS, QUERY_ROWS, DIM_BLOCK = 4096, 512, 16
# Candidate blocks that one group of a query block scans in turn, sharing its k-th best scores.
BLOCKS_PER_SLAB = 16

_PACK = "id_bytes binary, vec_bytes binary, dims int, rows int"


def _pack(rows: int, by_block: bool = False):
    """mapInPandas function: (vec_id, vec) rows to matrices of up to ``rows`` vectors of
    equal length and, with ``by_block``, of one ``block`` (by which the rows are sorted)."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}
        now = 0

        def flush(key: tuple) -> pd.DataFrame:
            ids, vecs = zip(*held.pop(key), strict=True)
            block, dims = key
            mat = np.stack(vecs).T.astype("<f8") if dims else np.zeros((0, len(ids)))
            return pd.DataFrame({"id_bytes": [np.array(ids, "<i8").tobytes()],
                                 "vec_bytes": [np.ascontiguousarray(mat).tobytes()], "dims": [dims], "rows": [len(ids)], "block": [block]})

        for pdf in batches:
            for vid, vec, block in zip(pdf["vec_id"], pdf["vec"], pdf["block"] if by_block else [0] * len(pdf), strict=True):
                if block != now:
                    for key in list(held):
                        yield flush(key)
                    now = block
                group = held.setdefault((block, len(vec)), [])
                group.append((vid, np.asarray(vec, dtype=np.float64)))
                if len(group) == rows:
                    yield flush((block, len(vec)))
        for key in list(held):
            yield flush(key)
    return pack


def search_block(q_ids, q, c_ids, c, k: int, best, dim_block: int = DIM_BLOCK):
    """Merge the candidates of one block into ``best``.

    q: dims x queries, c: dims x candidates (whole numbers as doubles, products
    exact below 2**53). best: per query (scores, ids), scores descending, ties by
    smaller id, at most k. A candidate with the query's own id is left out.
    """
    dims = q.shape[0]
    cuts = list(range(0, dims, dim_block)) + [dims]
    rest = lambda m: [np.sqrt((m[a:] ** 2).sum(axis=0)) for a in cuts[1:]]
    q_rest, c_rest = rest(q), rest(c)
    first = q[: cuts[1] if len(cuts) > 1 else 0].T @ c[: cuts[1] if len(cuts) > 1 else 0]
    for j in range(len(q_ids)):
        scores, ids = best[j]
        floor = scores[-1] if len(scores) == k else -np.inf
        alive = np.flatnonzero(c_ids != q_ids[j])
        part = first[j, alive]
        for b in range(len(cuts) - 1):
            if b:
                part = part + q[cuts[b]:cuts[b + 1], j] @ c[cuts[b]:cuts[b + 1], alive]
            if np.isfinite(floor):
                # equal to the k-th best may still win its tie; the slack covers rounding of the roots
                keep = part + q_rest[b][j] * c_rest[b][alive] * (1 + 1e-9) + 1e-6 >= floor
                if not keep.all():
                    alive, part = alive[keep], part[keep]
            elif b == 0 and len(alive) > k:  # no k-th best yet: the exact scores of a first few set one
                lead = alive[np.argpartition(-part, k - 1)[:k]]
                floor = (q[:, j] @ c[:, lead]).min()
            if not len(alive):
                break
        if not len(alive):
            continue
        if len(alive) > k:  # of the exact scores, those at or above the k-th
            keep = part >= np.partition(part, len(part) - k)[len(part) - k]
            alive, part = alive[keep], part[keep]
        scores, ids = np.concatenate([scores, part]), np.concatenate([ids, c_ids[alive]])
        o = np.lexsort((ids, -scores))[:k]
        best[j] = (scores[o], ids[o])


def _search(k: int, dim_block: int):
    """mapInPandas function over (query matrix, candidate matrix) rows sorted by query matrix."""
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, q_ids, q, best = None, None, None, None

        def emit() -> pd.DataFrame:
            n = [len(s) for s, _ in best]
            return pd.DataFrame({"query_id": np.repeat(q_ids, n),
                                 "vec_id": np.concatenate([i for _, i in best]).astype("int64"),
                                 "score": np.concatenate([s for s, _ in best]).astype("int64")})

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.query_part != at:
                    if at is not None:
                        yield emit()
                    at, q_ids = r.query_part, np.frombuffer(r.q_ids, "<i8")
                    q = np.frombuffer(r.q_vecs, "<f8").reshape(r.dims, len(q_ids))
                    best = [(np.zeros(0), np.zeros(0, "i8"))] * len(q_ids)
                c_ids = np.frombuffer(r.id_bytes, "<i8")
                search_block(q_ids, q, c_ids, np.frombuffer(r.vec_bytes, "<f8").reshape(r.dims, len(c_ids)), k, best, dim_block)
        if at is not None:
            yield emit()
    return search


def top_k_inner_product(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
                        vector_col: str = "embedding", scale: float = 64.0, dim_block: int = DIM_BLOCK) -> DataFrame:
    """The k candidates with the highest inner product for each query, exactly.

    Both tables have an id and an array of numbers; a component x counts as
    ``floor(scale * x)``, x as double. Returns query_id, rank (int, from 1),
    vec_id, score (long): all candidates where there are fewer than k, ties to
    the smaller vec_id, never a row with the query's own id. Cases: a row whose
    id or vector is null, or whose vector holds a null or a non-finite component,
    takes no part; vectors meet only vectors of the same length (an empty one
    scores 0); repeated candidate rows count each; repeated query rows are one
    query; empty tables give no rows. Other columns are ignored.

    Queries and candidates meet block against block by an equi-join on the query
    block; per-slab results (k rows a query) are merged by a ranking per query.
    """
    def usable(df: DataFrame) -> DataFrame:
        v = F.col(vector_col).cast("array<double>")
        good = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        return (df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("_v"))
                .where(F.col("vec_id").isNotNull() & F.col("_v").isNotNull()).where(good)
                .select("vec_id", F.transform("_v", lambda x: F.floor(x * F.lit(scale)).cast("double")).alias("vec")))

    cand = usable(vectors).mapInPandas(_pack(CANDIDATE_ROWS), _PACK + ", block long")
    slabs = cand.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCKS_PER_SLAB)).alias("_slabs"))
    asked = usable(queries).groupBy("vec_id").agg(F.min("vec").alias("vec")).withColumn("dims", F.size("vec"))
    blocks = asked.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERY_ROWS)).alias("_blocks"))
    # one row a vector length: a bounded number of lengths is the rule of an embedding table
    q = (asked.join(blocks, "dims").select(F.pmod(F.xxhash64("vec_id"), F.col("_blocks")).alias("block"), "vec_id", "vec")
         .repartition("block").sortWithinPartitions("block", "vec_id")
         .mapInPandas(_pack(QUERY_ROWS, by_block=True), _PACK + ", block long")
         .select(F.col("block").alias("query_block"), "dims", F.col("id_bytes").alias("q_ids"),
                 F.col("vec_bytes").alias("q_vecs"), F.xxhash64("id_bytes").alias("query_part")))
    pairs = (cand.join(blocks, "dims").join(slabs, "dims")
             .select("id_bytes", "vec_bytes", "dims", F.pmod(F.xxhash64("id_bytes"), F.col("_slabs")).alias("slab"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("query_block"))
             .join(q, ["query_block", "dims"]))
    found = (pairs.repartition("query_part", "slab").sortWithinPartitions("query_part", "slab", "id_bytes")
             .mapInPandas(_search(k, dim_block), "query_id long, vec_id long, score long"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


# DuckDB: the query over `embeddings`.
TOP_K_SQL = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
