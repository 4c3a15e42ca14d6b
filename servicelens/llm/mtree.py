"""Exact top-k inner products by best-first search of M-trees.

With one more coordinate that brings all vectors to the same length, the
largest inner product is the smallest distance. Vectors are dealt over trees of
bounded size; each tree is built in a task and stored as its pages: routing
entries with covering radii and distances to their parent. A task takes a block
of queries and loads some trees one after the other, so that the bounds found
in one hold in the next; the best of all tasks are merged. Trees and blocks are
files below the shared checkpoint folder, of which the driver has the names.
"""

from __future__ import annotations

import heapq
import pickle
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from servicelens.llm.common import materialise
from servicelens.llm.token_files import storage
from servicelens.session import ensure_checkpoint_dir

SLACK = 1e-6
#: Pairs of a block and some trees are dealt over at most so many tasks.
TASKS = 4096


@dataclass(frozen=True)
class TreeParams:
    scale: int = 64
    vectors_a_tree: int = 8192
    queries_a_block: int = 512
    #: Trees that a task's block of queries meets.
    trees_a_task: int = 32
    #: Vectors of a leaf page; a page is computed as one small matrix product.
    page: int = 768
    fanout: int = 16


@dataclass
class Node:
    """A page. An inner page has routing entries, a leaf has vectors; ``to_parent`` holds
    each entry's distance to the page's own routing object, ``radius`` covers an entry's subtree."""

    leaf: bool
    entries: np.ndarray
    to_parent: np.ndarray
    radius: np.ndarray | None = None
    children: list[int] = field(default_factory=list)


class Best:
    """The k best (score, vec_id) of each query of a block so far, ties to the smaller id.

    ``own`` names the queries, whose own vectors take no place. Places not yet
    taken have the score -inf.
    """

    def __init__(self, own: np.ndarray, k: int):
        self.own, self.k = own, k
        self.scores = np.full((len(own), k), -np.inf)
        self.ids = np.full((len(own), k), np.iinfo(np.int64).max)

    @property
    def least(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Vectors ``ids`` with their scores for the queries at the positions ``at``."""
        least = self.least[at]
        better = (ids != self.own[at]) & ((scores > least) | (scores == least) & (ids < self.ids[at, -1]))
        if not better.any():
            return
        which, group = np.unique(at[better], return_inverse=True)
        scores = np.concatenate([self.scores[which].ravel(), scores[better]])
        ids = np.concatenate([self.ids[which].ravel(), ids[better]])
        order = np.lexsort((ids, -scores, np.concatenate([np.repeat(np.arange(len(which)), self.k), group])))
        sizes = self.k + np.bincount(group)
        take = order[(np.cumsum(sizes) - sizes)[:, None] + np.arange(self.k)]
        self.scores[which], self.ids[which] = scores[take], ids[take]

    def rows(self) -> tuple[list[int], list[int], list[int]]:
        """(query ids, vec_ids, scores) of the places that are taken."""
        q, place = np.nonzero(self.scores > -np.inf)
        return self.own[q].tolist(), self.ids[q, place].tolist(), [int(x) for x in self.scores[q, place].tolist()]


class MTree:
    """An M-tree over integer vectors with unique positions; ``ids`` names them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, p: TreeParams):
        self.ids, self.vectors = ids, vectors
        lengths = (vectors * vectors).sum(axis=1)
        self.most = float(lengths.max()) if len(ids) else 0.0
        self.points = np.column_stack([vectors, np.sqrt(np.maximum(self.most - lengths, 0.0))])
        self.nodes: list[Node] = []
        if len(ids):
            self.root_pivot = 0
            self.root = self._build(np.arange(len(ids)), 0, p)
            self._lay_out()

    def _lay_out(self) -> None:
        """Number the vectors in the order of the leaves, so that a leaf's are next to each other."""
        order = np.concatenate([n.entries for n in self.nodes if n.leaf])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ids, self.vectors, self.points = self.ids[order], self.vectors[order], self.points[order]
        self.root_pivot = int(place[self.root_pivot])
        for n in self.nodes:
            n.entries = place[n.entries]

    def _to(self, pivot: int, own: np.ndarray) -> np.ndarray:
        diff = self.points[own] - self.points[pivot]
        return np.sqrt(np.einsum("ij,ij->i", diff, diff))

    def _build(self, own: np.ndarray, pivot: int, p: TreeParams) -> int:
        far = self._to(pivot, own)
        if len(own) <= p.page:
            self.nodes.append(Node(True, own, far))
            return len(self.nodes) - 1
        if far.max() == 0:  # equal vectors: as many full pages as they need
            groups = [(pivot, own[i : i + p.page]) for i in range(0, len(own), p.page)]
        else:  # routing objects far from each other, each vector to the nearest
            pivots, near = [int(own[far.argmax()])], None
            nearest, whose = np.full(len(own), np.inf), np.zeros(len(own), np.int64)
            while True:
                near = self._to(pivots[-1], own)
                closer = near < nearest
                nearest[closer], whose[closer] = near[closer], len(pivots) - 1
                if len(pivots) == p.fanout or nearest.max() == 0:
                    break
                pivots.append(int(own[nearest.argmax()]))
            groups = [(v, own[whose == i]) for i, v in enumerate(pivots)]
        children = [self._build(members, v, p) for v, members in groups if len(members)]
        kept = [(v, members) for v, members in groups if len(members)]
        routing = np.array([v for v, _ in kept])
        radius = np.array([self._to(v, members).max() for v, members in kept])
        self.nodes.append(Node(False, routing, self._to(pivot, routing), radius, children))
        return len(self.nodes) - 1

    def __getstate__(self) -> dict:
        """Vectors as small integers; the points are made again from them."""
        return {k: v for k, v in self.__dict__.items() if k != "points"} | {"vectors": _small(self.vectors)}

    def search(self, query: np.ndarray, own_id: int, k: int) -> tuple[list[tuple[int, int]], int]:
        """The k best (score, vec_id), ties to the smaller id, and the distances computed."""
        best = Best(np.array([own_id]), k)
        computed = self.meet(query[None], best)
        _, ids, scores = best.rows()
        return list(zip(scores, ids)), computed

    def meet(self, queries: np.ndarray, best: Best) -> int:
        """Put this tree's vectors into the best of a block of queries; the distances computed.

        A page is opened for those queries that it may still hold one of the k
        best for, by the bounds of all trees that the block has met.
        """
        if not self.nodes or not len(queries):
            return 0
        width = max(self.vectors.shape[1], queries.shape[1])
        vectors, queries = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (self.vectors, queries.astype(float)))
        lengths = (queries * queries).sum(axis=1) + self.most
        # no sum of products reaches 2**24 then
        kind = np.float32 if (lengths.max() - self.most) * self.most < 2**48 else np.float64
        vectors, factors = vectors.astype(kind, copy=False), queries.astype(kind)
        targets = np.column_stack([queries, np.zeros(len(queries))])

        def distances(who: np.ndarray, entries: np.ndarray) -> np.ndarray:
            out = np.empty((len(who), len(entries)))
            for j, v in enumerate(vectors[entries].astype(float)):
                diff = targets[who] - np.append(v, np.sqrt(max(self.most - (v * v).sum(), 0.0)))
                out[:, j] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            return out

        who = np.arange(len(queries))
        computed, pushed = len(who), 0
        # nearest page first, with its queries, their bounds and their distances to its routing object
        heap = [(0.0, pushed, self.root, who, np.zeros(len(who)), distances(who, np.array([self.root_pivot]))[:, 0])]
        while heap:
            _, _, at, who, low, to_pivot = heapq.heappop(heap)
            # no vector beyond this distance can be among the k best
            reach = np.sqrt(np.maximum(lengths[who] - 2 * best.least[who], 0.0) + SLACK) + SLACK
            near = low <= reach
            if not near.any():
                continue
            who, to_pivot, reach = who[near], to_pivot[near], reach[near]
            node = self.nodes[at]
            if node.leaf:
                inside = (node.to_parent >= (to_pivot - reach).min()) & (node.to_parent <= (to_pivot + reach).max())
                open_ = node.entries[inside]
                if not len(open_):
                    continue
                computed += len(open_) * len(who)
                page = vectors[open_[0] : open_[-1] + 1] if inside.all() else vectors[open_]
                scores, ids = factors[who] @ page.T, self.ids[open_]
                least = best.least[who].astype(kind)
                fresh = np.flatnonzero(np.isneginf(least))
                if len(fresh) and len(ids) > best.k:  # those that tie with the k-th of this page stay
                    others = np.where(ids == best.own[who[fresh], None], -np.inf, scores[fresh])
                    least[fresh] = np.partition(others, len(ids) - best.k, axis=1)[:, len(ids) - best.k]
                hold = np.flatnonzero(scores >= least[:, None])
                row, col = np.divmod(hold, len(ids))
                best.add(who[row], scores.ravel()[hold].astype(float), ids[col])
            else:
                gap = np.abs(to_pivot[:, None] - node.to_parent)
                open_ = np.flatnonzero((gap - node.radius <= reach[:, None]).any(axis=0))
                computed += len(open_) * len(who)
                d = distances(who, node.entries[open_])
                lows = np.maximum(d - node.radius[open_] - SLACK, 0.0)
                for j, child in enumerate(open_.tolist()):
                    near = lows[:, j] <= reach
                    if near.any():
                        pushed += 1
                        heapq.heappush(heap, (float(lows[near, j].min()), pushed, node.children[child], who[near], lows[near, j], d[near, j]))
        return computed


def _small(x: np.ndarray) -> np.ndarray:
    """Integers that are held as float, in the smallest integer type that has them all."""
    low, high = x.min(initial=0), x.max(initial=0)
    kinds = (t for t in (np.int8, np.int16, np.int32) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return x.astype(next(kinds, x.dtype))


def _put(folder: str, thing: object) -> str:
    """The name of a new file of the shared folder with ``thing``; a task that runs again writes a file of its own."""
    path = f"{folder}/{uuid.uuid4().hex}"
    system, name = storage(path)
    with system.open_output_stream(name) as f:
        f.write(pickle.dumps(thing, pickle.HIGHEST_PROTOCOL))
    return path


def _get(path: str):
    system, name = storage(path)
    with system.open_input_stream(name) as f:
        return pickle.loads(f.read())


def _padded(rows: list[list[float]], scale: int, width: int = 0) -> np.ndarray:
    width = max([width, *map(len, rows)])
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return np.floor(out * scale)


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, repeated rows once."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad).distinct()


def top_k(vectors: DataFrame, k: int = 20, query_mod: int = 20, params: TreeParams | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query.

    Queries are the rows whose vec_id is divisible by ``query_mod``, candidates
    all rows of another vec_id. Components are floor(scale * x); a shorter
    vector counts as filled up with zeros. Rows with a NULL vec_id, a NULL
    vector, or a NULL or non-finite component take no part; rows repeated with
    id and vector count once; of several vectors with one id each is a
    candidate and a query, whose results are ranked together. Ties go to the
    smaller vec_id. An empty table gives no rows. Other columns are not read.
    Scores are exact up to 2**53.
    """
    p = params or TreeParams()
    rows = materialise(_usable(vectors))
    n = rows.count()
    is_query = F.pmod("vec_id", F.lit(query_mod)) == 0
    trees = max(1, -(-n // p.vectors_a_tree))
    blocks = max(1, -(-rows.where(is_query).count() // p.queries_a_block))

    folder = f"{ensure_checkpoint_dir(rows.sparkSession)}/{uuid.uuid4().hex}"
    system, root = storage(folder)
    system.create_dir(root, recursive=True)

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("vec_id")
        tree = MTree(t.column("vec_id").to_numpy(), _padded(t.column("v").to_pylist(), p.scale), p)
        return pa.table({"part": t.column("part").slice(0, 1), "path": pa.array([_put(folder, tree)], pa.string())})

    def pack(t: pa.Table) -> pa.Table:
        block = t.column("vec_id").to_numpy(), _small(_padded(t.column("v").to_pylist(), p.scale))
        return pa.table({"part": t.column("part").slice(0, 1), "path": pa.array([_put(folder, block)], pa.string())})

    def files(df: DataFrame, parts: int, write) -> list[str]:
        part = F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int")  # by the vector too: one id may have any number of them
        return [r.path for r in sorted(df.withColumn("part", part).groupBy("part").applyInArrow(write, "part int, path string").collect())]

    forest, asked = files(rows, trees, build), files(rows.where(is_query), blocks, pack)
    steps = -(-len(forest) // p.trees_a_task)
    pairs = len(asked) * steps

    def search(batches):
        for b in batches:
            for pair in b.column("id").to_pylist():
                block, step = divmod(pair, steps)
                ids, queries = _get(asked[block])
                best = Best(ids, k)
                for path in forest[step * p.trees_a_task : (step + 1) * p.trees_a_task]:
                    _get(path).meet(queries, best)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in best.rows()], names=["query_id", "vec_id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        rows.sparkSession.range(0, pairs, 1, max(1, min(pairs, TASKS)))
        .mapInArrow(search, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
