"""Approximate nearest neighbours: one hierarchical small-world graph per shard, results of all shards merged.

Equal vectors are one node with the few smallest of their ids, which are all that a list of k nearest can name.  A shard
is a hash range of nodes of fixed expected size, so shards grow in number, not in size.  Its graph is built in bulk: the
candidates for a node's links come from matrix products within the shard, are thinned so that links point in different
directions, and are made mutual; each higher level does so for a sixteenth of the nodes.  Levels are flat arrays of
neighbours.  Queries run down the levels with a beam, all queries of a batch at once; what the beam holds at the end is
measured again in double precision.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldbook.session import stage


@dataclass(frozen=True)
class Settings:
    shard_rows: int = 8192
    links: int = 16  # per node on upper levels, twice as many on the lowest
    candidates: int = 48
    top_rows: int = 512  # a level of so many nodes is the highest; queries look at all of it
    beam: int = 128
    query_batch: int = 128


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _combined(most: int):
    """Per task: each distinct vector with the smallest ``most`` of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).sort_by("vec_id")
            ids = table.column("vec_id").to_pylist()
            raw = table.column("vector").to_pylist()
            found: dict[bytes, list[int]] = {}
            for i, v in zip(ids, raw, strict=True):
                have = found.setdefault(v, [])
                if len(have) < most and (not have or have[-1] != i):
                    have.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.list_(pa.int64()))], ["vector", "ids"])

    return run


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of 32-bit floats, or of 64-bit ones where the table holds these."""
    for batch in batches:
        column = batch.column("embedding")
        offs = column.offsets.to_numpy()
        flat = column.values.to_numpy(zero_copy_only=False) + 0.0  # one zero only
        vectors = [flat[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(vectors, pa.binary())], ["vec_id", "vector"])


def nearest_within(unit: np.ndarray, of: np.ndarray, k: int) -> np.ndarray:
    """For each row of ``unit[of]`` the k nearest others of them, nearest first (positions in ``of``)."""
    v = unit[of]
    out = np.empty((len(v), k), dtype=np.int32)
    for lo in range(0, len(v), 512):
        sims = v[lo : lo + 512] @ v.T
        sims[np.arange(len(sims)), np.arange(lo, lo + len(sims))] = -np.inf
        top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(sims, top, axis=1), axis=1, kind="stable")
        out[lo : lo + 512] = np.take_along_axis(top, order, axis=1)
    return out


def _thinned(unit: np.ndarray, of: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """Of each node's candidates those that are nearer to it than to any link chosen before, filled up with the nearest others."""
    out = np.full((len(of), links), -1, dtype=np.int32)
    v = unit[of]
    for lo in range(0, len(of), 256):
        part = near[lo : lo + 256]
        c = v[part]
        own = np.einsum("bcd,bd->bc", c, v[lo : lo + len(part)])
        mutual = np.matmul(c, c.transpose(0, 2, 1))
        closest = np.full(part.shape, -np.inf, dtype=np.float32)
        chosen = np.zeros(part.shape, dtype=bool)
        for j in range(part.shape[1]):
            take = (own[:, j] > closest[:, j]) & (chosen.sum(axis=1) < links)
            chosen[:, j] = take
            closest = np.where(take[:, None], np.maximum(closest, mutual[:, j]), closest)
        rank = np.where(chosen, 0, part.shape[1]) + np.arange(part.shape[1])
        pick = np.argsort(rank, axis=1)[:, :links]
        out[lo : lo + len(part)] = np.take_along_axis(part, pick, axis=1)
    return out


def _mutual(links: np.ndarray, most: int, unit: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Own links first, then the nearest of the nodes that link here, up to ``most``; -1 where there are fewer."""
    n, k = links.shape
    src, dst = np.repeat(np.arange(n), k), links.ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    sims = np.einsum("ij,ij->i", unit[of[src]], unit[of[dst]])
    a, b = np.concatenate((src, dst)), np.concatenate((dst, src))
    back = np.concatenate((np.zeros(len(src)), np.ones(len(src))))
    pairs, first = np.unique(a.astype(np.int64) * n + b, return_index=True)
    a, b, back, sims = a[first], b[first], back[first], np.concatenate((sims, sims))[first]
    order = np.lexsort((-sims, back, a))
    a, b = a[order], b[order]
    count = np.bincount(a, minlength=n)
    place = np.arange(len(a)) - (np.cumsum(count) - count)[a]
    out = np.full((n, most), -1, dtype=np.int32)
    out[a[place < most], place[place < most]] = b[place < most]
    return out


def _even(vectors: np.ndarray) -> np.ndarray:
    """Doubles, each vector scaled by a power of two so that its largest component is about one: exact, and no square overflows."""
    wide = vectors.astype(np.float64)
    _, exponent = np.frexp(np.abs(wide).max(axis=1, initial=0))
    half = exponent // 2  # in two steps, as the power itself may be out of range
    return np.ldexp(np.ldexp(wide, -half[:, None]), (half - exponent)[:, None])


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = _even(vectors)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def build(vectors: np.ndarray, s: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the lowest: positions of its nodes and their neighbours (positions in the level, -1 for none).

    Rows are taken to be in random order: a level has the first sixteenth of the one below.
    """
    unit = _unit(vectors)
    levels, n = [], len(unit)
    while True:
        of = np.arange(n)
        links = s.links * (1 if levels else 2)
        k = min(n - 1, s.candidates)
        near = nearest_within(unit, of, k) if k else np.zeros((n, 0), dtype=np.int32)
        thin = _thinned(unit, of, near, min(s.links, k)) if k else near
        levels.append((of, _mutual(thin, links, unit, of)))
        if n <= s.top_rows:
            return levels
        n = max(2, n // 16)


def search(vectors: np.ndarray, levels: list, queries: np.ndarray, s: Settings) -> np.ndarray:
    """Positions of the beam of each query at the end; -1 where it holds fewer."""
    unit = _unit(vectors)
    q = _unit(queries)
    rows = np.arange(len(q))[:, None]
    top = len(levels[-1][0])
    whole = q @ unit[:top].T
    beam = np.argsort(-whole, axis=1, kind="stable")[:, : s.beam]
    sims = np.take_along_axis(whole, beam, axis=1)
    for depth in range(len(levels) - (2 if len(levels) > 1 else 1), -1, -1):
        of, near = levels[depth]
        width = s.beam
        seen = np.zeros((len(q), len(of)), dtype=bool)
        seen[rows, np.maximum(beam, 0)] |= beam >= 0
        done = np.zeros(beam.shape, dtype=bool)
        while True:
            open_ = np.where(done | (beam < 0), -np.inf, sims)
            best = open_.argmax(axis=1)
            live = np.flatnonzero(np.isfinite(open_[np.arange(len(q)), best]))
            if not len(live):
                break
            done[live, best[live]] = True
            new = near[beam[live, best[live]]]
            fresh = (new >= 0) & ~seen[live[:, None], np.maximum(new, 0)]
            seen[live[:, None], np.where(fresh, new, beam[live, best[live]][:, None])] = True
            got = np.where(fresh, np.einsum("bkd,bd->bk", unit[np.maximum(new, 0)], q[live]), -np.inf)
            ids = np.concatenate((beam[live], np.where(fresh, new, -1)), axis=1)
            val = np.concatenate((np.where(beam[live] >= 0, sims[live], -np.inf), got), axis=1)
            was = np.concatenate((done[live], np.zeros(new.shape, dtype=bool)), axis=1)
            if beam.shape[1] < width:
                grow = width - beam.shape[1]
                beam = np.concatenate((beam, np.full((len(q), grow), -1)), axis=1)
                sims = np.concatenate((sims, np.full((len(q), grow), -np.inf, dtype=sims.dtype)), axis=1)
                done = np.concatenate((done, np.zeros((len(q), grow), dtype=bool)), axis=1)
            keep = np.argsort(-val, axis=1, kind="stable")[:, : beam.shape[1]]
            missing = beam.shape[1] - keep.shape[1]
            take = lambda x, fill: np.pad(np.take_along_axis(x, keep, axis=1), ((0, 0), (0, missing)), constant_values=fill)  # noqa: E731, B023
            beam[live], sims[live], done[live] = take(ids, -1), take(val, -np.inf), take(was, False)
            beam[live] = np.where(np.isfinite(sims[live]), beam[live], -1)
    return beam


def _indexed(s: Settings):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("vector", "ascending")])
        kind = np.float64 if table.column("wide")[0].as_py() else np.float32
        vectors = np.frombuffer(b"".join(table.column("vector").to_pylist()), dtype=kind).reshape(table.num_rows, -1)
        sink = io.BytesIO()
        levels = build(vectors, s)
        np.savez(sink, vectors=vectors, **{f"near{i}": near for i, (_, near) in enumerate(levels)})
        ids = table.column("ids").to_pylist()
        offs = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
        blob = np.array([i for x in ids for i in x], dtype=np.int64)
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()), "graph": pa.array([sink.getvalue()], pa.binary()), "offsets": pa.array([offs.astype(np.int64).tobytes()], pa.binary()), "ids": pa.array([blob.tobytes()], pa.binary())})

    return run


def nodes(vectors: DataFrame, k: int) -> DataFrame:
    """``vector, ids, dim, wide``: distinct usable vectors (bytes) with their k + 1 smallest ids."""
    wide = vectors.schema["embedding"].dataType.elementType.simpleString() != "float"
    cast = "array<double>" if wide else "array<float>"
    rows = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select("vec_id", F.col("embedding").cast(cast).alias("embedding"))
    raw = rows.mapInArrow(_raw, "vec_id long, vector binary")
    few = raw.mapInArrow(_combined(k + 1), "vector binary, ids array<bigint>")
    merged = few.groupBy("vector").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))
    return merged.select("vector", "ids", (F.octet_length("vector") / (8 if wide else 4)).cast("int").alias("dim"), F.lit(wide).alias("wide"))


def index(vectors: DataFrame, k: int = 5, settings: Settings | None = None) -> DataFrame:
    """One row per shard: ``dim, shard, graph, offsets, ids``, stored in the shared folder."""
    s = settings or Settings()
    found = stage(nodes(vectors, k), "nodes")
    shards = max(1, -(-found.count() // s.shard_rows))
    h = F.xxhash64("vector")
    placed = found.withColumn("shard", F.pmod(h, F.lit(shards)).cast("int")).withColumn("order", F.xxhash64(h))
    built = placed.groupBy("dim", "shard").applyInArrow(_indexed(s), "dim int, shard int, graph binary, offsets binary, ids binary")
    return stage(built, "index")


def _searched(k: int, s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = vectors = levels = offs = ids = None
        waiting: list[tuple[int, bytes]] = []

        def answer() -> Iterator[pa.RecordBatch]:
            if not waiting:
                return
            q = np.frombuffer(b"".join(v for _, v in waiting), dtype=vectors.dtype).reshape(len(waiting), -1)
            beam = search(vectors, levels, q, s)
            wide = _even(vectors)
            norms = np.linalg.norm(wide, axis=1)
            rows = []
            for (own, _), v, b in zip(waiting, _even(q), beam, strict=True):
                b = b[b >= 0]
                # one dot product at a time, so that equal pairs get equal scores whatever else is looked at
                score = np.array([np.dot(wide[i], v) for i in b]) / (norms[b] * np.sqrt(np.dot(v, v)))
                found = [(-x, i) for x, node in zip(score.tolist(), b.tolist(), strict=True) for i in ids[offs[node] : offs[node + 1]].tolist() if i != own]
                rows += [(own, i, -x) for x, i in sorted(found)[:k]]
            waiting.clear()
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["query_id"] is None:  # a shard's graph comes before its queries
                    yield from answer()
                    key = (row["dim"], row["shard"])
                    data = np.load(io.BytesIO(row["graph"]))
                    vectors = data["vectors"]
                    near = [data[f"near{i}"] for i in range(len(data.files) - 1)]
                    levels = [(np.arange(len(x)), x) for x in near]
                    offs, ids = (np.frombuffer(row[c], dtype=np.int64) for c in ("offsets", "ids"))
                elif key == (row["dim"], row["shard"]):
                    waiting.append((row["query_id"], row["vector"]))
                    if len(waiting) >= s.query_batch:
                        yield from answer()
        yield from answer()

    return run


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, settings: Settings | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: for rows of ``vectors(vec_id, embedding)`` with an id divisible by ``every``, the k nearest others by cosine.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without an id.
    All others have a finite cosine, however large or small their components are.  Vectors meet only vectors of their own length.  Ties go to the smaller id; equal vectors are found together.
    Repeated rows count once; a query with fewer than k others gets all of them.  Empty tables give empty tables; other
    columns are ignored.
    """
    s = settings or Settings()
    graphs = index(vectors, k, s)
    wide = vectors.schema["embedding"].dataType.elementType.simpleString() != "float"
    asked = vectors.where((F.col("vec_id") % every == 0) & usable(F.col("embedding"))).select("vec_id", F.col("embedding").cast("array<double>" if wide else "array<float>").alias("embedding"))
    asked = asked.mapInArrow(_raw, "vec_id long, vector binary").distinct().withColumn("dim", (F.octet_length("vector") / (8 if wide else 4)).cast("int"))
    per_dim = graphs.groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    sent = asked.join(per_dim, "dim").select("dim", F.explode("shards").alias("shard"), F.col("vec_id").alias("query_id"), "vector")
    none = lambda *names: [F.lit(None).cast("binary").alias(x) for x in names]
    rows = graphs.select("dim", "shard", F.lit(None).cast("bigint").alias("query_id"), *none("vector"), "graph", "offsets", "ids")
    both = rows.union(sent.select("dim", "shard", "query_id", "vector", *none("graph", "offsets", "ids")))
    found = both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", F.col("query_id").asc_nulls_first()).mapInArrow(_searched(k, s), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
