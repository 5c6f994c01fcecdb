"""Nearest neighbours by inner product: hierarchical k-means tree with
best-bin-first traversal.

The tree is fitted on at most ``SAMPLE`` rows (the first by a hash of their id)
and has at most about ``MAX_LEAVES`` leaves, so it is small and goes to every
task; every row is put into one leaf. A query walks the tree with a priority
queue, best expected product first, and visits leaves in that order. How many
it visits is calibrated: for ``CALIBRATION`` queries the exact neighbours among
all rows are found, and visits widen until their recall reaches ``RECALL``.

Rows and queries meet by leaf, in steps: the first leaves that a query visits
give it a floor, its ``k``-th best score so far, and from the leaves of the next
step only rows that reach the floor come back. A large leaf is split into chunks of its rows
and of its queries, so no task depends on the size of a leaf; each chunk gives
its best ``k`` for each query and a window keeps the best of those. Scores are
products of the original vectors in double precision, summed in one fixed order.

Defined results: vectors that are null, zero, of another than the most common
length, or hold null or non-finite components take no part; so do rows without
an id. An id that occurs with several vectors is one query, with the smallest;
as candidates each vector counts, repeated rows once. No other row of the
query's id is a candidate. A query with fewer than ``k`` candidates in the
leaves it visits gets those. Ties go to the smaller id. Empty tables give an
empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from practica.llm.common import map_batches
from practica.session import materialize

SAMPLE = 20_000
BRANCH = 16
LEAF_ROWS = 256
MAX_LEAVES = 4096
CALIBRATION = 96
RECALL = 0.95
STEPS = (2, 16)             # visits at which the floors rise
CHUNK_ROWS, CHUNK_QUERIES = 2048, 2048
SEED = 11


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part."""
    v = F.col("vec")
    rows = (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vec"))
            .filter("vec_id is not null and vec is not null")
            .filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .filter(F.exists(v, lambda x: x != 0)))
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (common["n"] if common else 0))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, nearest centroid of each row); may return fewer centroids."""
    centers = np.unique(x[rng.choice(len(x), min(k, len(x)), replace=False)], axis=0)
    for _ in range(rounds):
        near = (-2 * x @ centers.T + (centers ** 2).sum(1)).argmin(1)
        counts = np.bincount(near, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        centers = sums[counts > 0] / counts[counts > 0, None]
    return centers, (-2 * x @ centers.T + (centers ** 2).sum(1)).argmin(1)


class Tree:
    """Nodes in one table: centroid, spread of its rows, children; leaves have
    numbers of their own."""

    def __init__(self, sample: np.ndarray, leaf_sample: int, branch: int = BRANCH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.centers, self.spread = [sample.mean(0)], [0.0]
        self.children: list[list[int]] = [[]]
        open_ = [(0, sample)]
        while open_:
            node, x = open_.pop()
            if len(x) <= leaf_sample or (x == x[0]).all():
                continue
            centers, near = k_means(x, min(branch, -(-len(x) // leaf_sample) + 1), rng)
            if len(centers) < 2:
                continue
            for c, center in enumerate(centers):
                part = x[near == c]
                if not len(part):
                    continue
                self.children[node].append(len(self.centers))
                self.centers.append(center)
                self.spread.append(float(np.sqrt(((part - center) ** 2).sum(1).mean() / x.shape[1])))
                self.children.append([])
                open_.append((len(self.centers) - 1, part))
        self.centers, self.spread = np.array(self.centers), np.array(self.spread)
        self.leaf_of = {n: i for i, n in enumerate(n for n, c in enumerate(self.children) if not c)}

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: nearest child at each level."""
        leaf = np.zeros(len(x), np.int32)
        open_ = [(0, np.arange(len(x)))]
        while open_:
            node, at = open_.pop()
            kids = self.children[node]
            if not kids:
                leaf[at] = self.leaf_of[node]
                continue
            c = self.centers[kids]
            near = (-2 * x[at] @ c.T + (c ** 2).sum(1)).argmin(1)
            open_ += [(kid, at[near == i]) for i, kid in enumerate(kids) if (near == i).any()]
        return leaf

    def visit(self, queries: np.ndarray, visits: int) -> list[list[int]]:
        """For each query its first ``visits`` leaves, best bin first. A node's
        bin: its centroid's product plus two spreads along the query."""
        bins = queries @ self.centers.T + 2 * np.linalg.norm(queries, axis=1)[:, None] * self.spread
        out = []
        for row in bins.tolist():
            queue, leaves = [(0.0, 0)], []
            while queue and len(leaves) < visits:
                _, node = heapq.heappop(queue)
                if not self.children[node]:
                    leaves.append(self.leaf_of[node])
                for kid in self.children[node]:
                    heapq.heappush(queue, (-row[kid], kid))
            out.append(leaves)
        return out


def best_pairs(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray,
               k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's best k rows, without those below its
    floor. A matrix product finds
    them up to rounding; the products that matter are summed again, in one order
    for every pair, so equal vectors have equal scores."""
    rough = queries @ rows.T
    rough[query_ids[:, None] == row_ids[None, :]] = -np.inf
    found: list[tuple] = []
    slack = 1e-9 * (np.abs(rough[np.isfinite(rough)]).max(initial=0.0) + 1.0)
    for q in range(len(queries)):
        line = rough[q]
        least = np.partition(line, -k)[-k] if len(line) > k else -np.inf
        if floor is not None:
            least = max(least, floor[q])
        near = np.nonzero(np.isfinite(line) & (line >= least - slack))[0]
        score = (rows[near] * queries[q]).sum(axis=1)
        if floor is not None:
            near, score = near[score >= floor[q]], score[score >= floor[q]]
        keep = np.lexsort((row_ids[near], -score))[:k]
        found.append((np.full(len(keep), q), near[keep], score[keep]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def _once(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without repeated rows."""
    if len(np.unique(ids)) == len(ids):
        return ids, x
    keep = sorted({(int(i), r.tobytes()): n for n, (i, r) in enumerate(zip(ids, x))}.values())
    return ids[keep], x[keep]


def build_tree(rows: DataFrame, n_rows: int) -> Tree:
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(SAMPLE).select("vec").toArrow()
    x = matrix(sample.column("vec"))
    leaves = max(1, min(MAX_LEAVES, n_rows // LEAF_ROWS))
    return Tree(x, max(1, len(x) // leaves))


def calibrate(placed: DataFrame, queries: DataFrame, tree: Tree, k: int, recall: float = RECALL) -> int:
    """Leaf visits at which the sampled queries find ``recall`` of their exact
    neighbours among all rows."""
    some = queries.orderBy(F.xxhash64("query_id", F.lit(SEED + 1)), "query_id").limit(CALIBRATION).toArrow()
    ids, q = some.column("query_id").to_numpy(), matrix(some.column("vec"))

    def run(batch: pa.RecordBatch) -> dict:
        rows, row_ids = matrix(batch.column("vec")), batch.column("vec_id").to_numpy()
        leaf = batch.column("leaf").to_numpy()
        a, b, score = best_pairs(q, ids, rows, row_ids, k)
        return {"query": pa.array(a, pa.int64()), "vec_id": pa.array(row_ids[b]), "leaf": pa.array(leaf[b]),
                "score": pa.array(score)}

    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    exact = (map_batches(placed, run, "query long, vec_id long, leaf int, score double")
             .withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).select("query", "leaf").collect())
    order = [{leaf: i + 1 for i, leaf in enumerate(v)} for v in tree.visit(q, len(tree.leaf_of))]
    need = sorted(order[r["query"]][r["leaf"]] for r in exact)
    visits = 1
    while need and sum(n <= visits for n in need) < recall * len(need):
        visits += 1
    return visits


def nearest(df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score of each query's nearest rows found;
    ``is_query``: which ids are queries (a condition on ``vec_id``)."""
    rows = materialize(usable(df, id_col, vector_col), "ann_rows")
    n_rows = rows.count()
    ranked = "query_id long, rank int, vec_id long, score double"
    if not n_rows:
        return df.sparkSession.createDataFrame([], ranked)
    tree = build_tree(rows, n_rows)

    def put(batch: pa.RecordBatch) -> dict:
        leaf = tree.assign(matrix(batch.column("vec")))
        return {"vec_id": batch.column("vec_id"), "vec": batch.column("vec"), "leaf": pa.array(leaf)}

    kind = rows.schema["vec"].dataType.simpleString()
    placed = materialize(map_batches(rows, put, f"vec_id long, vec {kind}, leaf int"), "ann_leaves")
    queries = materialize(placed.filter(is_query).groupBy(F.col("vec_id").alias("query_id"))
                          .agg(F.min("vec").alias("vec")), "ann_queries")
    if queries.isEmpty():
        return df.sparkSession.createDataFrame([], ranked)
    visits = calibrate(placed, queries, tree, k, recall)

    def walk(batch: pa.RecordBatch) -> dict:
        seen = tree.visit(matrix(batch.column("vec")), visits)
        at = pa.array([i for i, v in enumerate(seen) for _ in v], pa.int64())
        return {"query_id": batch.column("query_id").take(at),
                "leaf": pa.array([leaf for v in seen for leaf in v], pa.int32()),
                "nth": pa.array([n for v in seen for n in range(len(v))], pa.int32())}

    walks = materialize(map_batches(queries, walk, "query_id long, leaf int, nth int"), "ann_walks")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = df.sparkSession.createDataFrame([], ranked).select("query_id", "vec_id", "score", "rank")
    edges = [0, *[s for s in STEPS if s < visits], visits]
    for a, b in zip(edges, edges[1:]):
        floors = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
        floored = queries.join(floors, "query_id", "left").withColumn(
            "floor", F.coalesce("floor", F.lit(float("-inf"))))
        step = walks.filter((F.col("nth") >= a) & (F.col("nth") < b))
        pairs = best.drop("rank").unionByName(meetings(placed, step, floored, k))
        best = materialize(pairs.withColumn("rank", F.row_number().over(w).cast("int"))
                           .filter(F.col("rank") <= k), "ann_best")
    return best.select("query_id", "rank", "vec_id", "score")


def meetings(placed: DataFrame, walks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): from each chunk of a visited leaf the best k
    rows that reach the query's floor."""
    # Chunks of a leaf's rows and queries: at most one row for each leaf.
    def parts(sizes: DataFrame, per: int, name: str) -> DataFrame:
        return sizes.groupBy("leaf").agg(F.ceil(F.count("*") / per).cast("int").alias(name))
    chunks = F.broadcast(parts(placed, CHUNK_ROWS, "row_chunks")
                         .join(parts(walks, CHUNK_QUERIES, "query_chunks"), "leaf"))
    left = (placed.join(chunks, "leaf")
            .withColumn("row_chunk", F.pmod(F.xxhash64("vec_id"), "row_chunks").cast("int"))
            .withColumn("query_chunk", F.explode(F.sequence(F.lit(0), F.col("query_chunks") - 1)))
            .select("leaf", "row_chunk", "query_chunk", "vec_id", "vec"))
    right = (walks.join(chunks, "leaf").join(queries, "query_id")
             .withColumn("query_chunk", F.pmod(F.xxhash64("query_id"), "query_chunks").cast("int"))
             .withColumn("row_chunk", F.explode(F.sequence(F.lit(0), F.col("row_chunks") - 1)))
             .select("leaf", "row_chunk", "query_chunk", "query_id", "vec", "floor"))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        row_ids, x = _once(a.column("vec_id").to_numpy(), matrix(a.column("vec")))
        query_ids, floor = b.column("query_id").to_numpy(), b.column("floor").to_numpy()
        q, r, score = best_pairs(matrix(b.column("vec")), query_ids, x, row_ids, k, floor)
        return pa.table({"query_id": pa.array(query_ids[q]), "vec_id": pa.array(row_ids[r]),
                         "score": pa.array(score)})

    keys = ["leaf", "row_chunk", "query_chunk"]
    return (left.groupBy(*keys).cogroup(right.groupBy(*keys))
            .applyInArrow(meet, "query_id long, vec_id long, score double"))
