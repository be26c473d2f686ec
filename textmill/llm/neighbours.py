"""Approximate nearest neighbours by cosine: a robust-pruned directed graph per shard.

Equal vectors are one node that keeps their ``k + 1`` least ids, which are all that can be
among the nearest of anything, as they tie. Nodes are dealt into shards of ``SHARD_ROWS`` by
a hash of the vector, and each shard gets a graph (Subramanya et al., "DiskANN", 2019):
starting from random links, every node is searched for greedily; the nodes met propose its
neighbours; relaxed pruning then keeps the closest proposal and drops those that are nearer
to it, by ``ALPHA``, than to the node, and so on, so edges stay diverse and few (``DEGREE``);
links are made both ways and overfull nodes pruned again. Searches of ``BATCH`` nodes run
side by side in arrays. A search starts from the best of ``ENTRIES`` nodes; a node that no
link path reaches from them is made an entry, so every row can be found.

The index is a table: shard, node, ids, vector, links. A query is sent to every shard of its
dimension and walks the shard's graph with a beam of ``QUERY_BEAM`` nodes; shards are read once,
queries stream past, and the best of all shards are ranked by exact cosine on the original
vectors in double precision. Work is (queries x shards) walks, each of a length that grows
with the logarithm of the shard: no query is compared with all rows.

Defined cases: null, empty or zero vectors, and those with null or non-finite components,
take no part; vectors of different dimensions never meet; ties go to the smaller id; a
repeated id counts once per different vector and never answers itself; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import materialize

NEAREST = 5
SHARD_ROWS = 1 << 14
DEGREE = 24
BEAM = 48
#: Of queries, which are fewer than the rows that the graph is built from.
QUERY_BEAM = 128
ALPHA = 1.2
BATCH = 1024
ENTRIES = 64
_INDEX = "dim int, shard int, node int, ids array<bigint>, vector array<double>, links array<int>, entry boolean"
_FOUND = "query_id bigint, vec_id bigint, score double"


class Graph:
    """Links of the nodes of one shard; ``-1`` where a node has fewer than ``DEGREE``."""

    def __init__(self, unit: np.ndarray, links: np.ndarray | None = None, entries: np.ndarray | None = None):
        self.unit, self.n = unit, len(unit)
        if links is None:
            self.entries = np.arange(min(ENTRIES, self.n))
            self._grow(np.random.default_rng(self.n))
        else:
            self.links, self.entries = links, entries

    def search(self, points: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes found for each point, and their squared distances:
        the nearest node of the beam that was not yet gone out from is gone out from, until
        there is none. Missing ones are ``-1`` at infinite distance."""
        n_points, rows = len(points), np.arange(len(points))
        first = 2 - 2 * points @ self.unit[self.entries].T
        keep = np.argsort(first, axis=1)[:, :beam]
        ids, far = self.entries[keep], np.take_along_axis(first, keep, 1)
        if ids.shape[1] < beam:
            pad = ((0, 0), (0, beam - ids.shape[1]))
            ids, far = np.pad(ids, pad, constant_values=-1), np.pad(far, pad, constant_values=np.inf)
        met = np.zeros((n_points, self.n + 1), bool)
        met[:, -1] = True
        met[rows[:, None], ids] = True
        done = ids < 0
        live = rows
        while len(live):
            open_far = np.where(done[live], np.inf, far[live])
            at = open_far.argmin(axis=1)
            going = np.isfinite(open_far[np.arange(len(live)), at])
            live, at = live[going], at[going]
            if not len(live):
                break
            done[live, at] = True
            near = self.links[ids[live, at]]
            fresh = ~met[live[:, None], near]
            met[live[:, None], near] = True
            gaps = 2 - 2 * np.einsum("bkd,bd->bk", self.unit[near], points[live])
            gaps[~fresh] = np.inf
            all_far = np.concatenate([far[live], gaps], axis=1)
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            far[live] = np.take_along_axis(all_far, best, 1)
            got = np.take_along_axis(np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1), best, 1)
            ids[live] = got
            was = np.concatenate([done[live], ~fresh], axis=1)
            done[live] = np.take_along_axis(was, best, 1)
        order = np.argsort(far, axis=1)
        return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)

    def _pruned(self, nodes: np.ndarray, proposed: np.ndarray, alpha: float) -> np.ndarray:
        """Up to ``DEGREE`` diverse links for each node, out of its row of proposals."""
        proposed = np.sort(proposed, axis=1)
        again = np.zeros(proposed.shape, bool)
        again[:, 1:] = proposed[:, 1:] == proposed[:, :-1]
        out = again | (proposed < 0) | (proposed == nodes[:, None])
        vectors = self.unit[proposed]
        far = 2 - 2 * np.einsum("bkd,bd->bk", vectors, self.unit[nodes])
        left = np.where(out, np.inf, far)
        links = np.full((len(nodes), DEGREE), -1, np.int32)
        rows = np.arange(len(nodes))
        for place in range(DEGREE):
            at = left.argmin(axis=1)
            some = np.isfinite(left[rows, at])
            if not some.any():
                break
            links[some, place] = proposed[rows, at][some]
            between = 2 - 2 * np.einsum("bkd,bd->bk", vectors, vectors[rows, at])
            left[(alpha * alpha * between <= far) & some[:, None]] = np.inf
            left[rows[some], at[some]] = np.inf
        return links

    def _link_back(self, nodes: np.ndarray, alpha: float) -> None:
        source = np.repeat(nodes, DEGREE)
        target = self.links[nodes].ravel()
        new = (target >= 0) & ~(self.links[target] == source[:, None]).any(axis=1)
        source, target = source[new], target[new]
        if not len(source):
            return
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        starts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        nth = np.arange(len(target)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(target)]])))
        # A node that many point to takes the proposals in several rounds.
        for lo in range(0, int(nth.max()) + 1, DEGREE):
            now = (nth >= lo) & (nth < lo + DEGREE)
            touched, row = np.unique(target[now], return_inverse=True)
            extra = np.full((len(touched), DEGREE), -1, np.int32)
            extra[row, nth[now] - lo] = source[now]
            both = np.concatenate([self.links[touched], extra], axis=1)
            crowded = (both >= 0).sum(axis=1) > DEGREE
            room = touched[~crowded]
            self.links[room] = -np.sort(-both[~crowded], axis=1)[:, :DEGREE]
            for at in range(0, int(crowded.sum()), BATCH):
                some = np.flatnonzero(crowded)[at : at + BATCH]
                self.links[touched[some]] = self._pruned(touched[some], both[some], alpha)

    def _grow(self, rng: np.random.Generator) -> None:
        n = self.n
        self.links = np.full((n + 1, DEGREE), -1, np.int32)
        if n > 1:
            some = rng.integers(0, n - 1, (n, min(DEGREE // 2, n - 1)), dtype=np.int32)
            some += some >= np.arange(n)[:, None]  # any node but itself
            self.links[:n, : some.shape[1]] = self._pruned(np.arange(n), some, 1.0)[:, : some.shape[1]]
        for alpha in (1.0, ALPHA):
            order = rng.permutation(n)
            for lo in range(0, n, BATCH):
                nodes = order[lo : lo + BATCH]
                met, _ = self.search(self.unit[nodes])
                self.links[nodes] = self._pruned(nodes, np.concatenate([met, self.links[nodes]], axis=1), alpha)
                self._link_back(nodes, alpha)
        reached = np.zeros(n + 1, bool)
        reached[-1] = True
        front = self.entries
        while len(front):
            reached[front] = True
            front = np.unique(self.links[front])
            front = front[(front >= 0) & ~reached[front]]
        self.entries = np.concatenate([self.entries, np.flatnonzero(~reached)])


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Directions in single precision; scaled first, so that nothing overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _built(rows: pa.Table) -> pa.Table:
    graph = Graph(_unit(_matrix(rows.column("vector"))))
    n = graph.n
    entry = np.zeros(n, bool)
    entry[graph.entries] = True
    links = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * DEGREE, graph.links[:n].ravel())
    columns = [rows.column(c) for c in ("dim", "shard")] + [pa.array(np.arange(n, dtype=np.int32))]
    columns += [rows.column("ids"), rows.column("vector"), links, pa.array(entry)]
    return pa.table(columns, names=["dim", "shard", "node", "ids", "vector", "links", "entry"])


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), vector.alias("vector"))
    return rows.where(usable(F.col("vector")) & F.col("vec_id").isNotNull())


def build_index(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST) -> DataFrame:
    """The stored index of all usable vectors; for searches of up to ``k`` neighbours."""
    rows = _vectors(df, id_col, vector_col).distinct()
    # The ranking is cut before its shuffle, so copies of a vector do not meet in one task.
    least = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("copy", F.row_number().over(least)).where(F.col("copy") <= k + 1)
    nodes = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = materialize(nodes.withColumn("dim", F.size("vector")), "ann-nodes")
    shards = F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards")
    sizes = materialize(nodes.groupBy("dim").agg(shards), "ann-shards")
    dealt = nodes.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("vector"), "shards").cast("int"))
    dealt = dealt.select("dim", "shard", "ids", "vector")
    return materialize(dealt.groupBy("dim", "shard").applyInArrow(_built, _INDEX), "ann-index")


def _walk(k: int):
    """Rows come by shard, the nodes of a shard in order and before its queries."""

    def found(nodes: pa.Table, graph: Graph, vectors: np.ndarray, queries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        asked, points = queries.column("query_id").to_numpy(), _matrix(queries.column("vector"))
        ids = nodes.column("ids").combine_chunks()
        for lo in range(0, len(asked), BATCH):
            own, some = asked[lo : lo + BATCH], points[lo : lo + BATCH]
            met, _ = graph.search(_unit(some), QUERY_BEAM)
            scores = cosine(vectors[met], some[:, None, :])
            scores[met < 0] = -np.inf
            row = np.repeat(np.arange(len(own)), met.shape[1])[(met >= 0).ravel()]
            met, scores = met[met >= 0], scores[met >= 0]
            names = ids.take(pa.array(met))
            copies = np.diff(names.offsets.to_numpy())
            row, scores, name = np.repeat(row, copies), np.repeat(scores, copies), names.flatten().to_numpy()
            other = name != own[row]
            row, scores, name = row[other], scores[other], name[other]
            order = np.lexsort((name, -scores, row))
            row, scores, name = row[order], scores[order], name[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            top = place < k
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[row[top]]), pa.array(name[top]), pa.array(scores[top])], names=["query_id", "vec_id", "score"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, graph, nodes, vectors, current = [], None, None, None, None
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "kind")])
            cuts = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if lo == hi:
                    continue
                part, shard, is_query = batch.slice(lo, hi - lo), tuple(place[:2, lo]), place[2, lo]
                if shard != current:
                    held, graph, current = [], None, shard
                if not is_query:
                    held.append(part)
                    continue
                if graph is None:
                    nodes = pa.Table.from_batches(held)
                    vectors = _matrix(nodes.column("vector"))
                    links = np.concatenate([_matrix(nodes.column("links")), np.full((1, DEGREE), -1, np.int32)])
                    graph = Graph(_unit(vectors), links, np.flatnonzero(nodes.column("entry").to_numpy()))
                    held = []
                yield from found(nodes, graph, vectors, part)

    return run


def nearest(
    index: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest vectors found for each query,
    none of the query's own id."""
    shards = index.select("dim", "shard").distinct()
    asked = _vectors(queries, id_col, vector_col).distinct().withColumnRenamed("vec_id", "query_id")
    asked = asked.withColumn("dim", F.size("vector")).join(shards, "dim").withColumn("kind", F.lit(1))
    both = index.withColumn("kind", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    dealt = both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind", "node")
    found = dealt.mapInArrow(_walk(k), _FOUND)
    # An id with several vectors is one query.
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_report(embeddings: DataFrame, every: int = 50) -> DataFrame:
    """Neighbours of every vector whose id is divisible by ``every``, among all vectors."""
    return nearest(build_index(embeddings), embeddings.where(F.col("vec_id") % every == 0))
