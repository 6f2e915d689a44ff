"""Approximate nearest neighbours: NN-descent builds the graph, queries walk it greedily.

Every distinct vector is a node with its `degree` best neighbours found so far. They start from blocks: the vectors are
sorted by the sides of random hyperplanes they lie on and cut into runs of equal size, several times, and each block is
compared within itself; the number of planes follows that of the nodes. Then rounds of NN-descent until few neighbours change: each node brings its neighbours and a sample of the nodes it is a
neighbour of together, as neighbours of neighbours of each other; what beats a member's worst neighbour goes back to
that member. All of this is joins and groups of bounded size: a block, or a cell of nodes chosen by hash.

A search keeps, for each query, the best `beam` nodes seen. In each hop it sends the ones not yet expanded to the cells
that hold them, where each node lies with the vectors of its neighbours, and takes back those neighbours that beat its worst one.
It ends when no beam has a node left to expand. Vectors travel in half precision, each with a scale of its own; the best found are scored again in double precision on
the original vectors. A query that is itself a node starts there; any other starts at a few fixed nodes.

Defined cases: vectors that are NULL, zero, of another length than most, or hold a NULL or non-finite component take no
part, as query or candidate; equal vectors are one node, of which a query gets the smallest ids it needs, so any
number of copies costs one node; rows that repeat a vec_id count once; with fewer candidates than `k` all that are found come back;
ties go to the smaller id; without valid vectors the result is empty.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import rank_rows
from ..session import cut_lineage, remove_cut
from .shingles import mix

_GRAPH = "id bigint, vec binary, near binary, scores binary"


@dataclass(frozen=True)
class GraphSettings:
    """`planes` is the least number of planes; rounds end when at most the share `settled` of the neighbours is new."""

    degree: int = 20
    sampled: int = 20
    trees: int = 6
    planes: int = 6
    block: int = 500
    settled: float = 0.01
    sent: int = 8
    cell: int = 1000
    beam: int = 300
    starts: int = 16
    seed: int = 17


def valid(vector: str, size: int | None = None) -> Column:
    """Whether a vector takes part."""
    v = F.col(vector)
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(fine if size is None else fine & (F.size(v) == size), F.lit(False))


def _cells_of(n: int, size: int) -> int:
    """How many cells of about `size` rows n rows make."""
    return n // size + 1


def _cell(ids: np.ndarray, cells: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(cells)).astype(np.int64)


def _matrix(column: pa.Array | pa.ChunkedArray, kind) -> np.ndarray:
    """Binary values of equal length as the rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(rows)
    return pa.array([r.tobytes() for r in data], pa.binary())


def _best(owner: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each owner 0..n-1 its k best distinct ids, best first; -1 and -inf where there are fewer."""
    order = np.lexsort((-scores, ids, owner))
    owner, ids, scores = owner[order], ids[order], scores[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])
    owner, ids, scores = owner[new], ids[new], scores[new]
    order = np.lexsort((ids, -scores, owner))
    owner, ids, scores = owner[order], ids[order], scores[order]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    keep = place < k
    near, best = np.full((n, k), -1, dtype=np.int64), np.full((n, k), -np.inf, dtype=np.float32)
    near[owner[keep], place[keep]], best[owner[keep], place[keep]] = ids[keep], scores[keep]
    return near, best


#: Lengths of vectors beside the middle one, so that products of two stay within single precision. A vector beyond counts
#: as this short or long during the search; its direction stays.
_SHORTEST, _LONGEST = 1e-16, 1e16


def _unit(v: np.ndarray, middle: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to a largest component of one, and what that is beside the `middle` of all rows."""
    own = np.abs(v).max(axis=1, keepdims=True)
    return v / own, np.clip(own / middle, _SHORTEST, _LONGEST).astype(np.float32)


def _decode(raw: np.ndarray) -> np.ndarray:
    """Vectors of the rows of bytes that `_nodes` makes."""
    scale = np.ascontiguousarray(raw[:, :4]).view(np.float32)
    return np.ascontiguousarray(raw[:, 4:]).view(np.float16).astype(np.float32) * scale


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return _decode(_matrix(column, np.uint8)) if len(column) else np.zeros((0, 1), np.float32)


def middle_length(vectors: DataFrame) -> float:
    """Half way, in orders of magnitude, between the vectors of the smallest and of the largest greatest component."""
    most = F.log(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))
    row = vectors.agg(F.min(most).alias("least"), F.max(most).alias("most")).first()  # two numbers
    return 1.0 if row.least is None else math.exp((row.least + row.most) / 2)


def _nodes(vectors: DataFrame, middle: float) -> DataFrame:
    """(id, vec) of (id, embedding): a scale for the row in single precision, then its components in half precision.

    Half precision alone would lose vectors of components over 65,504 or under a millionth.
    """

    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            if len(column):
                v, scale = _unit(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1), middle)
                rows = np.concatenate([scale.view(np.uint8), v.astype(np.float16).view(np.uint8)], axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("id"), _binary(rows)], ["id", "vec"])

    return vectors.mapInArrow(run, "id bigint, vec binary")


def planes_for(n: int, s: GraphSettings) -> int:
    """Planes that split n nodes into cells of no more than a block on average."""
    return max(s.planes, (max(1, -(-n // s.block)) - 1).bit_length())


def _blocks(nodes: DataFrame, s: GraphSettings, n: int) -> DataFrame:
    """(id, vec, block): each node once a tree, in blocks of nodes on the same sides of that tree's planes."""

    planes_used = planes_for(n, s)

    def run(batches):
        for batch in batches:
            v = _vectors(batch.column("vec"))
            rng = np.random.default_rng(s.seed)
            for tree in range(s.trees):
                planes = rng.normal(size=(v.shape[1], planes_used + 1)).astype(np.float32)
                side = v @ planes
                code = (side[:, :planes_used] > 0) @ (1 << np.arange(planes_used))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("vec"), pa.array(np.full(len(v), tree)), pa.array(code.astype(np.int64)), pa.array(side[:, -1].astype(np.float64))],
                    ["id", "vec", "tree", "code", "side"],
                )

    sides = nodes.mapInArrow(run, "id bigint, vec binary, tree bigint, code bigint, side double")
    ranked = rank_rows(sides, ["tree", "code", "side", "id"], "place", "total")
    return ranked.select("id", "vec", F.expr(f"(place - 1) div {s.block}").alias("block"))


def _first_graph(nodes: DataFrame, s: GraphSettings, n: int) -> DataFrame:
    def inside(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        v = _vectors(table.column("vec"))
        scores = v @ v.T
        scores[ids[:, None] == ids[None, :]] = -np.inf
        k = min(s.degree, len(ids))
        top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        best = np.take_along_axis(scores, top, axis=1)
        near = np.where(np.isfinite(best), ids[top], -1)
        return pa.table({"id": ids, "vec": table.column("vec"), "near": _binary(near), "scores": _binary(best)})

    return _merged(_blocks(nodes, s, n).groupBy("block").applyInArrow(inside, _GRAPH), s, n)


def _merged(parts: DataFrame, s: GraphSettings, n: int) -> DataFrame:
    """One row a node from rows (id, vec or NULL, near, scores): the best of all of them."""

    def run(table: pa.Table) -> pa.Table:
        ids, row = np.unique(table.column("id").to_numpy(), return_inverse=True)
        vec, lists, values = [None] * len(ids), table.column("near").to_pylist(), table.column("scores").to_pylist()
        for r, v in zip(row, table.column("vec").to_pylist()):
            vec[r] = v if v is not None else vec[r]
        near = np.frombuffer(b"".join(lists), dtype=np.int64)
        best = np.frombuffer(b"".join(values), dtype=np.float32)
        owner = np.repeat(row, [len(x) // 8 for x in lists])
        fine = np.isfinite(best)
        near, best = _best(owner[fine], near[fine], best[fine], len(ids), s.degree)
        return pa.table({"id": ids, "vec": pa.array(vec, pa.binary()), "near": _binary(near), "scores": _binary(best)})

    cells = F.pmod(F.xxhash64("id"), F.lit(_cells_of(n, s.cell)))
    return parts.groupBy(cells.alias("cell")).applyInArrow(run, _GRAPH)


def _links(graph: DataFrame) -> DataFrame:
    """(id, other) of the graph's neighbour lists."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            near = _matrix(batch.column("near"), np.int64)
            row, place = np.nonzero(np.isfinite(_matrix(batch.column("scores"), np.float32)))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), pa.array(near[row, place])], ["id", "other"])

    return graph.select("id", "near", "scores").mapInArrow(run, "id bigint, other bigint")


def both_ways(graph: DataFrame, s: GraphSettings, salt: int) -> DataFrame:
    """(id, other): each node's neighbours, and a sample of the nodes that have it as theirs."""
    forward = _links(graph)
    drawn = Window.partitionBy("id").orderBy(F.xxhash64("id", "other", F.lit(salt)), "other")
    back = forward.select(F.col("other").alias("id"), F.col("id").alias("other"))
    sampled = back.withColumn("place", F.row_number().over(drawn)).where(F.col("place") <= s.sampled).drop("place")
    return forward.unionByName(sampled).distinct()


def _descend(graph: DataFrame, s: GraphSettings, salt: int, n: int) -> DataFrame:
    """One round: neighbours of neighbours meet at the node between them."""

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("center")
        center, ids = table.column("center").to_numpy(), table.column("id").to_numpy()
        v, worst = _vectors(table.column("vec")), table.column("worst").to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], center[1:] != center[:-1], [True]]))
        out_ids, out_near, out_scores = [], [], []
        for a, b in zip(edges[:-1], edges[1:]):
            scores = v[a:b] @ v[a:b].T
            scores[scores <= worst[a:b, None]] = -np.inf
            np.fill_diagonal(scores, -np.inf)
            k = min(s.sent, b - a)
            top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            best = np.take_along_axis(scores, top, axis=1)
            hit = np.isfinite(best).any(axis=1)
            out_ids.append(ids[a:b][hit])
            full = np.full((hit.sum(), s.sent), -1, dtype=np.int64), np.full((hit.sum(), s.sent), -np.inf, dtype=np.float32)
            full[0][:, :k], full[1][:, :k] = np.where(np.isfinite(best), ids[a:b][top], -1)[hit], best[hit]
            out_near.append(full[0])
            out_scores.append(full[1])
        told = np.concatenate(out_ids)
        return pa.table({"id": told, "vec": pa.nulls(len(told), pa.binary()), "near": _binary(np.concatenate(out_near)), "scores": _binary(np.concatenate(out_scores))})

    def worst_of(batches):
        for batch in batches:
            scores = _matrix(batch.column("scores"), np.float32) if len(batch) else np.zeros((0, 1), np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), pa.array(scores[:, -1])], ["id", "vec", "worst"])

    members = graph.select("id", "vec", "scores").mapInArrow(worst_of, "id bigint, vec binary, worst float")
    pairs = both_ways(graph, s, salt).select(F.col("id").alias("center"), F.col("other").alias("id"))
    cells = F.pmod(F.xxhash64("center"), F.lit(_cells_of(n, s.cell // 5))).alias("cell")
    met = pairs.join(members, "id").groupBy(cells).applyInArrow(meet, _GRAPH)
    return _merged(graph.unionByName(met), s, n)


def build_graph(vectors: DataFrame, middle: float, s: GraphSettings = GraphSettings()) -> DataFrame:
    """(id, vec, near, scores) of distinct vectors (id, embedding)."""
    nodes = cut_lineage(_nodes(vectors, middle), "nodes")
    n = nodes.count()
    graph = cut_lineage(_first_graph(nodes, s, n), "graph")
    # neighbours only get better, so the rounds end
    for round_number in count():
        better = cut_lineage(_descend(graph, s, round_number, n), "graph")
        new = _links(better).join(_links(graph), ["id", "other"], "left_anti").count()
        remove_cut(graph)
        graph = better
        if new <= s.settled * s.degree * n:
            return graph


_STATE = "query bigint, vec binary, ids binary, scores binary, done binary, open bigint"


def _rows(graph: DataFrame, s: GraphSettings, cells: int) -> DataFrame:
    """(cell, id, ids, vecs): each node with the ids and vectors of its neighbours, by cell."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, other, v = table.column("id").to_numpy(), table.column("other").to_numpy(), _matrix(table.column("vec"), np.uint8)
        edges = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1], [True]]))
        runs = list(zip(edges[:-1], edges[1:]))
        own = ids[edges[:-1]]
        return pa.table(
            {
                "cell": _cell(own, cells), "id": own, "ids": pa.array([other[a:b].tobytes() for a, b in runs], pa.binary()),
                "vecs": pa.array([v[a:b].tobytes() for a, b in runs], pa.binary()),
            }
        )

    linked = both_ways(graph, s, -1).join(graph.select(F.col("id").alias("other"), "vec"), "other")
    parts = F.pmod(F.xxhash64("id"), F.lit(cells)).alias("part")
    return linked.groupBy(parts).applyInArrow(pack, "cell bigint, id bigint, ids binary, vecs binary")


def _started(queries: DataFrame, starts: list[int], middle: float) -> DataFrame:
    """First states of (query, embedding, node): the query's own node, or the fixed ones.

    A query is scaled to a largest component of one, which leaves the order of its candidates as it is.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for query, vector, node in zip(*(batch.column(c).to_pylist() for c in ("query", "embedding", "node"))):
                (v,), ((scale,),) = _unit(np.array([vector], dtype=np.float64), middle)
                ids = np.array(starts if node is None else [node], dtype=np.int64)
                scores = np.full(len(ids), -np.inf if node is None else float(v @ v) * scale, dtype=np.float32)
                rows.append((query, v.astype(np.float32).tobytes(), ids.tobytes(), scores.tobytes(), bytes(len(ids)), len(ids)))
            columns = zip(*rows) if rows else [[]] * 6
            kinds = [pa.int64(), *[pa.binary()] * 4, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["query", "vec", "ids", "scores", "done", "open"])

    return queries.select("query", "embedding", "node").mapInArrow(run, _STATE)


def _asked(states: DataFrame, cells: int, beam: int) -> DataFrame:
    """(cell, query, vec, worst, ids): the nodes that each query wants expanded, by the cell that holds them."""

    def run(batches):
        for batch in batches:
            rows = []
            for query, vec, ids, scores, done in zip(*(batch.column(c).to_pylist() for c in ("query", "vec", "ids", "scores", "done"))):
                wanted = np.frombuffer(ids, np.int64)[np.frombuffer(done, np.uint8) == 0]
                values = np.frombuffer(scores, np.float32)
                worst = float(values.min()) if len(values) >= beam else -np.inf
                cell = _cell(wanted, cells)
                for c in np.unique(cell):
                    rows.append((int(c), query, vec, worst, wanted[cell == c].tobytes()))
            columns = zip(*rows) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.float32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["cell", "query", "vec", "worst", "ids"])

    return states.where("open > 0").mapInArrow(run, "cell bigint, query bigint, vec binary, worst float, ids binary")


def _expand(beam: int):
    def run(nodes: pa.Table, asked: pa.Table) -> pa.Table:
        place = {i: k for k, i in enumerate(nodes.column("id").to_pylist())} if len(nodes) else {}
        lists = [np.frombuffer(x, np.int64) for x in nodes.column("ids").to_pylist()] if place else []
        packed = [np.frombuffer(x, np.uint8) for x in nodes.column("vecs").to_pylist()] if place else []
        vectors = [_decode(v.reshape(len(i), -1)) for i, v in zip(lists, packed)]
        queries, out_ids, out_scores = [], [], []
        columns = [asked.column(c).to_pylist() for c in ("query", "vec", "worst", "ids")] if len(asked) else [[]] * 4
        for query, vec, worst, wanted in zip(*columns):
            at = [place[i] for i in np.frombuffer(wanted, np.int64).tolist() if i in place]
            if not at:
                continue
            ids = np.concatenate([lists[k] for k in at])
            scores = np.concatenate([vectors[k] for k in at]) @ np.frombuffer(vec, np.float32)
            fine = scores > worst
            near, best = _best(np.zeros(fine.sum(), np.int64), ids[fine], scores[fine], 1, min(beam, max(1, int(fine.sum()))))
            queries.append(query)
            out_ids.append(near[0][np.isfinite(best[0])].tobytes())
            out_scores.append(best[0][np.isfinite(best[0])].tobytes())
        return pa.table({"query": pa.array(queries, pa.int64()), "ids": pa.array(out_ids, pa.binary()), "scores": pa.array(out_scores, pa.binary())})

    return run


def _advance(beam: int):
    """States from the old ones (all of whose nodes are expanded by now) and what the cells have found."""

    def run(table: pa.Table) -> pa.Table:
        queries, row = np.unique(table.column("query").to_numpy(), return_inverse=True)
        ids, scores, old = (table.column(c).to_pylist() for c in ("ids", "scores", "vec"))
        sizes = [len(x) // 8 for x in ids]
        owner, flat, values = np.repeat(row, sizes), np.frombuffer(b"".join(ids), np.int64), np.frombuffer(b"".join(scores), np.float32)
        known = np.repeat([v is not None for v in old], sizes)
        vec = {r: v for r, v in zip(row, old) if v is not None}
        # a node seen before has the same id in the old state
        order = np.lexsort((-values, ~known, flat, owner))
        owner, flat, values, known = owner[order], flat[order], values[order], known[order]
        new = np.ones(len(owner), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (flat[1:] != flat[:-1])
        first = np.flatnonzero(new)
        top = np.maximum.reduceat(values, first) if len(first) else values[:0]
        owner, flat, known = owner[first], flat[first], known[first]
        order = np.lexsort((flat, -top, owner))
        owner, flat, top, known = owner[order], flat[order], top[order], known[order]
        keep = np.arange(len(owner)) - np.searchsorted(owner, owner) < beam
        owner, flat, top, known = owner[keep], flat[keep], top[keep], known[keep]
        edges = np.searchsorted(owner, np.arange(len(queries) + 1))
        runs = list(zip(edges[:-1], edges[1:]))
        done = known.astype(np.uint8)
        return pa.table(
            {
                "query": queries, "vec": pa.array([vec[r] for r in range(len(queries))], pa.binary()),
                "ids": pa.array([flat[a:b].tobytes() for a, b in runs], pa.binary()),
                "scores": pa.array([top[a:b].astype(np.float32).tobytes() for a, b in runs], pa.binary()),
                "done": pa.array([done[a:b].tobytes() for a, b in runs], pa.binary()),
                "open": np.array([int((done[a:b] == 0).sum()) for a, b in runs], dtype=np.int64),
            }
        )

    return run


def search(graph: DataFrame, queries: DataFrame, middle: float, s: GraphSettings = GraphSettings(), top: int = 40) -> DataFrame:
    """(query, id) of the `top` best nodes found for each of (query, embedding, node); node: where it starts, or NULL."""
    n = graph.count()
    cells = _cells_of(n, s.cell)
    starts = [r.id for r in graph.select("id").orderBy(F.xxhash64("id"), "id").limit(s.starts).collect()]
    rows = cut_lineage(_rows(graph, s, cells), "rows").repartition(cells, "cell").persist()
    states = cut_lineage(_started(queries, starts, middle), "states")
    parts = F.pmod(F.xxhash64("query"), F.lit(_cells_of(queries.count(), s.cell // 10))).alias("part")
    # a node that has left a beam does not come back, so the hops end
    while not states.where("open > 0").isEmpty():
        asked = _asked(states, cells, s.beam)
        found = rows.groupBy("cell").cogroup(asked.groupBy("cell")).applyInArrow(_expand(s.beam), "query bigint, ids binary, scores binary")
        both = states.select("query", "vec", "ids", "scores").unionByName(found, allowMissingColumns=True)
        moved = cut_lineage(both.groupBy(parts).applyInArrow(_advance(s.beam), _STATE), "states")
        remove_cut(states)
        states = moved
    rows.unpersist()

    def listed(batches):
        for batch in batches:
            for query, ids in zip(batch.column("query").to_pylist(), batch.column("ids").to_pylist()):
                found = np.frombuffer(ids, np.int64)[:top]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), query)), pa.array(found)], ["query", "id"])

    return states.select("query", "ids").mapInArrow(listed, "query bigint, id bigint")


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, id: str = "vec_id", embedding: str = "embedding", s: GraphSettings = GraphSettings(),
) -> DataFrame:
    """For each row of `vectors` for which `queries` holds, its k nearest other rows by inner product.

    Returns query_id, rank (from 1), vec_id, score.
    """
    rows = vectors.where(valid(embedding) & F.col(id).isNotNull())
    common = rows.groupBy(F.size(embedding).alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.select(F.col(id).cast("bigint").alias("vec_id"), F.col(embedding).alias("embedding"), queries.alias("asks"))
    rows = rows.where(F.size("embedding") == (common.n if common else 0))
    classes = cut_lineage(rows.groupBy("embedding").agg(F.min("vec_id").alias("id")), "classes")
    middle = middle_length(classes)
    graph = build_graph(classes, middle, s)
    members = cut_lineage(rows.join(classes, "embedding").select("id", "vec_id", "asks").distinct(), "members")
    exact = classes.select("id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    asked = members.where("asks").select(F.col("vec_id").alias("query"), F.col("id").alias("node")).join(
        classes.select(F.col("id").alias("node"), "embedding"), "node"
    )
    found = search(graph, asked.select("query", "embedding", "node"), middle, s, max(2 * k, k + 10))
    pairs = found.join(exact.select("id", F.col("v").alias("b")), "id").join(
        asked.select("query", F.transform("embedding", lambda x: x.cast("double")).alias("a")), "query"
    )
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    scored = pairs.select("query", "id", product.alias("score"))
    # of equal vectors no query can need more than its k smallest ids besides its own
    smallest = Window.partitionBy("id").orderBy("vec_id")
    few = members.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1)
    ranked = scored.join(few.select("id", "vec_id"), "id").where("vec_id != query")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
