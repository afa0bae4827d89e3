"""Exact top-k by inner product with M-trees.

Vectors are cut to integers; largest inner product becomes least distance by one more coordinate,
sqrt(M**2 - |x|**2) with M the greatest norm of all vectors (0 for a query): |q - x|**2 = |q|**2 + M**2 - 2 q.x.

The vectors are split over bounded M-trees: routing objects drawn from a bounded sample attract the vectors
near them, and each such region is cut into trees of at most ``tree_rows`` vectors (equal vectors included, so a
vector repeated any number of times fills many trees, not one).  A tree has pages of at most ``page_rows``
entries; every page keeps its routing object, its covering radius and its distance from the tree's root object,
every entry its distance from the page's object.

Blocks of queries meet every tree.  Within a tree a query visits pages in the order of their lower bounds
(best first) and stops when the bound passes its k-th best; pages whose distance to the root object already rules
them out are not measured, and entries whose distance from the page's object rules them out are not multiplied.
Bounds carry slack for rounding; scores are exact integer products, in Python's integers where a long could overflow.

Rows: vectors that are NULL, empty or hold NULL or non-finite components take no part.  Components and scores that
leave the range of a long stand at its end (scores there tie); vectors of another length than the query's do
not meet it; repeated vectors tie
and the smaller vec_id wins; of rows that repeat a query's id the smallest vector asks, and none of
them answers; an empty table gives no rows.  Extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import Stored, per_batch


NONE = np.iinfo(np.int64).min + 1  # score of an empty place; its negative is still a number
LEAST, MOST = NONE + 1, np.iinfo(np.int64).max  # scores beyond stand here


@dataclass(frozen=True)
class TreeSettings:
    k: int = 5
    scale: float = 256.0
    every: int = 50  # rows whose id it divides are queries
    routing: int = 64  # regions at most; they are drawn from 32 times as many vectors
    tree_rows: int = 2048
    page_rows: int = 64
    block_rows: int = 1024  # queries that meet a tree together


def integral(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id and v = floor(scale * component) as array of long, without unusable vectors."""
    x = F.transform("embedding", lambda c: c.cast("double") * scale)
    usable = (F.size("embedding") > 0) & F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable).select(
        "vec_id", F.transform(x, lambda c: F.greatest(F.least(F.floor(F.greatest(F.least(c, F.lit(2.0**63)), F.lit(-(2.0**63)))), F.lit(MOST)), F.lit(-MOST))).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; in doubles while they are exact there."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return np.clip(a.astype(object) @ b.astype(object).T, LEAST, MOST).astype(np.int64)


class Tree:
    """An M-tree of two levels over augmented vectors: a root object, pages, entries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, limit: float, page_rows: int):
        extra = np.sqrt(np.maximum(limit**2 - (vectors.astype(np.float64) ** 2).sum(axis=1), 0))
        points = np.column_stack([vectors.astype(np.float64), extra])
        order, parents, sizes = self._pages(points, page_rows)
        self.ids, self.vectors, points = ids[order], vectors[order], points[order]
        self.starts = np.append(0, np.cumsum(sizes))
        self.objects = parents
        page_of = np.repeat(np.arange(len(sizes)), sizes)
        self.to_page = np.sqrt(((points - parents[page_of]) ** 2).sum(axis=1))  # entries' parent distances
        self.radius = np.maximum.reduceat(self.to_page, self.starts[:-1])
        self.root = points.mean(axis=0)
        self.to_root = np.sqrt(((parents - self.root) ** 2).sum(axis=1))  # pages' parent distances
        self.limit = limit
        self.slack = 1e-7 * (1 + limit)  # roots of differences of squares lose half their digits

    @staticmethod
    def _pages(points: np.ndarray, page_rows: int):
        """Order of the entries, the routing object and the size of every page: objects far from each other are
        promoted, entries go to the nearest one, and what exceeds a page opens another with the same object."""
        n = len(points)
        wanted = max(1, -(-n // page_rows))
        chosen = [0]
        distance = ((points - points[0]) ** 2).sum(axis=1)
        nearest = np.zeros(n, np.int64)
        for i in range(1, wanted):
            far = int(distance.argmax())
            if distance[far] == 0:
                break
            chosen.append(far)
            own = ((points - points[far]) ** 2).sum(axis=1)
            closer = own < distance
            nearest[closer], distance[closer] = i, own[closer]
        order = np.lexsort((distance, nearest))
        parents, sizes = [], []
        for i, size in enumerate(np.bincount(nearest, minlength=len(chosen)).tolist()):
            while size > 0:
                parents.append(points[chosen[i]])
                sizes.append(min(size, page_rows))
                size -= page_rows
        return order, np.array(parents), np.array(sizes)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """vec_id and score of the k best entries of every query (its own id left out), best first, ties to the
        smaller id; places without an entry have score NONE."""
        count, pages = len(queries), len(self.objects)
        points = np.column_stack([queries.astype(np.float64), np.zeros(count)])
        squares = (points**2).sum(axis=1)
        best = np.full((count, k), NONE, np.int64), np.full((count, k), np.iinfo(np.int64).max)
        kth = np.full(count, np.inf)
        to_object = np.sqrt(np.maximum(squares[:, None] + (self.objects**2).sum(axis=1) - 2 * points @ self.objects.T, 0))
        # what the stored distances alone say of a page
        to_root = np.sqrt(((points - self.root) ** 2).sum(axis=1))
        lower = np.maximum(np.maximum(np.abs(to_root[:, None] - self.to_root), to_object) - self.radius, 0)
        order = np.argsort(lower, axis=1, kind="stable")
        active = np.arange(count)
        for turn in range(pages):
            page = order[active, turn]
            still = lower[active, page] <= kth[active] + self.slack  # later pages have no lower bound
            active, page = active[still], page[still]
            if not len(active):
                break
            for number in np.unique(page).tolist():
                rows = active[page == number]
                entries = slice(self.starts[number], self.starts[number + 1])
                near = np.abs(to_object[rows, number, None] - self.to_page[entries]) <= kth[rows, None] + self.slack
                some = near.any(axis=0)  # entries that their parent distance leaves open for a query of the group
                if not some.any():
                    continue
                ids, scores = self.ids[entries][some], _products(queries[rows], self.vectors[entries][some])
                scores = np.where(near[:, some] & (ids != query_ids[rows, None]), scores, NONE)
                scores = np.concatenate([best[0][rows], scores], axis=1)
                ids = np.concatenate([best[1][rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
                first = np.lexsort((ids, -scores), axis=1)[:, :k]
                best[0][rows], best[1][rows] = (np.take_along_axis(x, first, axis=1) for x in (scores, ids))
                worst = best[0][rows, -1]
                kth[rows] = np.where(worst <= LEAST, np.inf, np.sqrt(np.maximum(squares[rows] + self.limit**2 - 2.0 * worst, 0)))
        return best[1], best[0]


def _routing(vectors: DataFrame, of: TreeSettings, rows: int) -> tuple[int, np.ndarray]:
    """Length of most vectors of a bounded sample, and routing objects far from each other drawn from it."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(32 * of.routing).select("v").collect()
    lengths = [len(r[0]) for r in sample]
    length = max(set(lengths), key=lengths.count)
    points = np.array([r[0] for r in sample if len(r[0]) == length], np.float64)
    wanted, chosen = max(1, min(of.routing, rows // of.tree_rows)), [0]
    distance = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < wanted and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return length, points[chosen]


def _regions(vectors: DataFrame, length: int, objects: np.ndarray) -> DataFrame:
    """row, vec_id, v and the nearest routing object; vectors of another length form regions of their own."""
    squares = (objects**2).sum(axis=1)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = batch["v"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        region = -sizes
        usual = np.flatnonzero(sizes == length)
        if len(usual):
            region[usual] = (squares - 2 * _matrix(batch["v"].take(pa.array(usual))).astype(np.float64) @ objects.T).argmin(axis=1)
        return pa.RecordBatch.from_arrays([batch["row"], batch["vec_id"], batch["v"], pa.array(region)],
                                          names=["row", "vec_id", "v", "region"])

    return vectors.mapInArrow(per_batch(work), "row long, vec_id long, v array<long>, region long")


def top_k(vectors: DataFrame, of: TreeSettings = TreeSettings()) -> DataFrame:
    """query_id, rank, vec_id and score: the k highest integer inner products of every query row."""
    store = Stored(vectors.sparkSession, "trees")
    stored = store.save(integral(vectors, of.scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    limit, rows = stored.agg(F.sqrt(F.max(square)), F.count("*")).first()
    if not rows:
        return stored.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    length, objects = _routing(stored, of, rows)
    placed = store.save(_regions(stored, length, objects), "placed")
    sizes = placed.groupBy("region").agg((F.count("*") * 2 / of.tree_rows + 1).cast("long").alias("trees"))
    upto = Window.orderBy("region").rowsBetween(Window.unboundedPreceding, -1)  # a row per routing object
    sizes = store.save(sizes.withColumn("first", F.coalesce(F.sum("trees").over(upto), F.lit(0))).coalesce(1), "sizes")
    n_trees = sizes.agg(F.sum("trees")).first()[0]
    # a region's rows are dealt to its trees by row, so that no repeated vector or id makes a tree large
    entries = placed.join(sizes, "region").select(
        (F.col("first") + F.pmod(F.xxhash64("row"), "trees")).alias("tree"), "vec_id", "v")
    again = vectors.sparkSession.read.schema(placed.schema).parquet(f"{store.root}/placed")  # the two sides share no columns
    queries = again.where(F.col("vec_id") % of.every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    n_blocks = max(1, -(-rows // of.every // of.block_rows))
    # every block of queries meets every tree once
    left = entries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).select("tree", "block", "vec_id", "v")
    right = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")).withColumn(
        "tree", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_trees - 1).cast("long")))).select("tree", "block", "vec_id", "v")
    nothing = pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})

    def work(entries: pa.Table, asked: pa.Table) -> pa.Table:
        if not entries.num_rows or not asked.num_rows:
            return nothing
        entries, asked = entries.combine_chunks(), asked.combine_chunks()
        size = len(entries["v"][0])
        asked = asked.filter(pc.equal(pc.list_value_length(asked["v"]), size))
        if not asked.num_rows:
            return nothing
        tree = Tree(entries["vec_id"].to_numpy(), _matrix(entries["v"].combine_chunks()), limit, of.page_rows)
        names = asked["vec_id"].to_numpy()
        ids, scores = tree.search(names, _matrix(asked["v"].combine_chunks()), of.k)
        found = scores > NONE
        return pa.table({"query_id": np.repeat(names, of.k).reshape(found.shape)[found], "vec_id": ids[found], "score": scores[found]})

    found = left.groupBy("tree", "block").cogroup(right.groupBy("tree", "block")).applyInArrow(
        work, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= of.k).select(
        "query_id", "rank", "vec_id", "score")
