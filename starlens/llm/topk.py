"""Exact top-k inner products by columnar branch and bound.

Vectors are quantised to integers and packed into blocks, one row per block, in vertical layout: the
values of one dimension lie together. A block of queries meets every block of candidates once. Partial
products are summed over a few dimensions at a time; after each step a candidate stays only if its
partial product plus the most that the remaining dimensions can add (the product of both remaining norms)
reaches the query's k-th best known product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors to a block of candidates and of queries.
CANDIDATES = 8_192
QUERIES = 1_024
#: Tasks, at most, among which the blocks of candidates are dealt.
TASKS = 10_000
#: Dimensions added between two prunings.
STEP = 8
#: Quantised components are held within this bound either way, so that products fit 64 bits.
LARGEST = 1 << 27


def quantised(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(key, v): floor(scale * x) of each component as integers, one row per different pair.

    Vectors that are null, empty or hold a null or non-finite component, and null keys, are left out; values
    beyond 2^27 count as 2^27 of their sign.
    """
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    usable = F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    limit = float(LARGEST)
    v = F.transform(x, lambda e: F.least(F.greatest(F.floor(F.least(F.greatest(e * scale, F.lit(-limit)), F.lit(limit))), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int"))
    return vectors.where(usable).select(F.col(key).cast("long").alias("key"), v.alias("v")).dropDuplicates()


def packed(rows: DataFrame, size: int, name: str, count: int) -> DataFrame:
    """One row per block of about ``size`` vectors of one width: (block, width, keys, values), values by dimension.

    Blocks come from a hash of the key, so they have even sizes and the plan needs no order.
    """
    blocks = max(1, -(-count // size))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", F.lit(name)), F.lit(blocks)).cast("int")).repartition(blocks, "block").sortWithinPartitions("block", "key")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            ids = batch["block"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for low, high in zip(edges, edges[1:], strict=False):
                if low == high:
                    continue
                if last is not None and ids[low] != last:
                    yield from block_rows(last, held)
                    held = []
                last = ids[low]
                held.append(batch.slice(low, high - low))
        if held:
            yield from block_rows(last, held)

    return dealt.mapInArrow(pack, "block int, width int, keys binary, vals binary")


def block_rows(block: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(parts).combine_chunks()
    keys = table["key"].to_numpy()
    vectors = table["v"].combine_chunks()
    width = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    first = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        columns = np.ascontiguousarray(values[first[mine][:, None] + np.arange(w)].T.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(block)], pa.int32()), pa.array([int(w)], pa.int32()), pa.array([keys[mine].astype(np.int64).tobytes()], pa.binary()), pa.array([columns.tobytes()], pa.binary())],
            names=["block", "width", "keys", "vals"],
        )


def search(query_keys: np.ndarray, queries: np.ndarray, keys: np.ndarray, columns: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, product) of each query's best ``k`` in one block; both sides hold dimensions as rows.

    Ties go to smaller keys; rows with the query's own key take no part.
    """
    width = len(columns)
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(columns).max(initial=0)) * width
    kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64
    order = np.argsort(-(columns.astype(np.float64) ** 2).sum(axis=1), kind="stable")  # the heaviest dimensions first
    c, q = columns[order].astype(kind), queries[order].astype(kind)
    starts = list(range(0, width, STEP))
    tail = lambda x: np.sqrt(np.cumsum((x.astype(np.float64) ** 2)[::-1], axis=0)[::-1])
    rest_c, rest_q = tail(c), tail(q)
    rest_c, rest_q = (np.vstack([rest[starts[1:]], np.zeros(rest.shape[1])]) for rest in (rest_c, rest_q))
    first = q[:STEP].T @ c[:STEP]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(len(query_keys)):
        part, alive = first[i], np.flatnonzero(keys != query_keys[i])
        if not len(alive):
            continue
        part = part[alive]
        if len(alive) > 4 * k and width > STEP:  # full products of the most promising give a bound to prune by
            seed = alive[np.argpartition(-part, 4 * k - 1)[: 4 * k]]
            floor = np.partition((q[:, i] @ c[:, seed]).astype(np.float64), 3 * k)[3 * k]
            slack = 1e-6 * (abs(floor) + 1)
            for s, at in enumerate(starts[1:], start=1):
                stay = part + rest_q[s - 1, i] * rest_c[s - 1, alive] >= floor - slack
                alive, part = alive[stay], part[stay]
                part = part + q[at : at + STEP, i] @ c[at : at + STEP, alive]
        elif width > STEP:
            part = q[:, i] @ c[:, alive]
        if len(alive) > k:
            least = np.partition(part, len(part) - k)[len(part) - k]
            tied = part >= least
            alive, part = alive[tied], part[tied]
        top = np.lexsort((keys[alive], -part))[:k]
        found.append((np.full(len(top), query_keys[i]), keys[alive[top]], part[top].astype(np.int64)))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0, candidates: int = CANDIDATES, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer inner products of each query, all if fewer.

    ``is_query`` is a condition on ``key``. Every row but those with the query's key is a candidate; ties go to the smaller
    id. Vectors of another width than the query's have no product. Repeated rows count once; if one id has several
    vectors, its best product counts. An empty table gives no row.
    """
    from starlens.session import stage

    rows = stage(quantised(vectors, key, vector, scale), "vectors")
    asked = rows.withColumnRenamed("key", key).where(is_query).withColumnRenamed(key, "key")
    n, m = rows.count(), asked.count()
    blocks = stage(packed(rows, candidates, "candidates", n), "candidate-blocks")
    against = -(-n // candidates) or 1
    # every block of queries goes once to each block of candidates
    sides = packed(asked, queries, "queries", m).select(
        F.col("width").alias("q_width"), F.col("keys").alias("q_keys"), F.col("vals").alias("q_vals"), F.explode(F.sequence(F.lit(0), F.lit(against - 1))).alias("q_block")
    )
    tasks = min(against, TASKS)  # a given number, because the work hangs on the pairs of blocks and not on their bytes
    sides, blocks = sides.repartition(tasks, "q_block"), blocks.repartition(tasks, "block")
    pairs = sides.join(blocks, (sides["q_block"] == blocks["block"]) & (sides["q_width"] == blocks["width"])).select("width", "q_keys", "q_vals", "keys", "vals")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                width = batch["width"][i].as_py()
                unpack = lambda name, kind: np.frombuffer(batch[name][i].as_buffer(), dtype=kind)  # noqa: B023, E731
                q, ids, scores = search(unpack("q_keys", np.int64), unpack("q_vals", np.int32).reshape(width, -1), unpack("keys", np.int64), unpack("vals", np.int32).reshape(width, -1), k)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score long").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
