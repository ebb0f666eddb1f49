"""Approximate nearest neighbours by a hierarchical k-means tree.

A tree of k-means splits is fitted on a bounded sample of vectors (``SAMPLE``), and
every vector is indexed under its leaf.  Leaves that hold more than twice ``LEAF``
vectors are split further by trees of their own, fitted side by side on at most
``LEAF_SAMPLE`` vectors of each, so that leaves stay small as vectors grow; only past
``LEAVES`` leaves in all, which bounds the tree that tasks hold, they grow again.

A query walks the tree best bin first: a priority queue holds the nodes seen so far by
their inner product with the query, and the best one is opened next, until enough
leaves have been visited.  How many are enough is calibrated: a bounded number of
queries (``PROBES``) is held against all vectors by brute force, and visits are widened
until the mean recall reaches the target.

Leaves share blocks, and those with many vectors are cut into blocks by a hash of the
row; the queries that visit a block likewise, so that a task compares one block with one
block.  Scores are sums over the dimensions in order, in double precision, so equal
vectors have equal scores.

Defined cases: vectors that are null, zero, or hold null or non-finite components take
no part, nor do rows with a null id, which the result couldn't name; vectors of different
lengths have no product, so those of a length other than the most common one are held
against all of their own length; rows that repeat an id are queries and candidates of
their own, so a repeated query id has a ranking for each of its rows, and another row of
its own id among the nearest; ties go to the smaller id, then to the first row; with few
candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm.runtime import Scratch, workers

SAMPLE = 20_000
BRANCH = 8
LEAF = 64
LEAF_SAMPLE = 4096
LEAVES = 1 << 16
PROBES = 200
RECALL = 0.97
BLOCK = 4096
#: Leaves of vectors of a length that is not the usual one are numbered from here by length.
OTHER = 1 << 40


@dataclass
class Tree:
    """Inner nodes by number: centres of their children, and the children's numbers; leaves are -1 - leaf."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0

    def graft(self, under: dict[int, Tree]) -> None:
        """Puts trees in the place of leaves; their own leaves get new numbers."""
        where = {-1 - child: (node, k) for node, children in enumerate(self.children) for k, child in enumerate(children) if child < 0}
        for leaf, tree in sorted(under.items()):
            node, k = where[leaf]
            base = len(self.centres)
            self.children[node][k] = base
            self.centres += tree.centres
            self.children += [[base + c if c >= 0 else c - self.leaves for c in children] for children in tree.children]
            self.leaves += tree.leaves

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row of ``x``, by the nearest centre at each level."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                near = _nearest(x[rows], self.centres[node])
                todo += [(child, rows[near == k]) for k, child in enumerate(self.children[node])]
        return out

    def visits(self, query: np.ndarray, most: int, sizes: dict[int, int], least: int) -> list[int]:
        """Leaves, best bin first: ``most`` of them, or more until they hold ``least`` vectors."""
        queue, out, held = [(0.0, 0)], [], 0
        while queue and (len(out) < most or held < least):
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                held += sizes.get(-1 - node, 0)
                continue
            for score, child in zip((self.centres[node] @ query).tolist(), self.children[node], strict=True):
                heapq.heappush(queue, (-score, child))
        return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1) - 2 * (x @ centres.T), axis=1)


def fit(x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 7) -> Tree:
    """Splits ``x`` by k-means until a node has ``leaf`` rows at most, or equal ones only."""
    rng, tree = np.random.default_rng(seed), Tree()

    def grown(rows: np.ndarray, root: bool) -> int:
        distinct = np.unique(rows, axis=0) if len(rows) > (0 if root else leaf) else rows[:1]
        if len(distinct) < 2 and not root:
            tree.leaves += 1
            return -tree.leaves
        node = len(tree.centres)
        k = min(branch, max(1, len(distinct)))
        centres = distinct[rng.choice(len(distinct), k, replace=False)] if len(distinct) else np.zeros((1, x.shape[1]))
        for _ in range(12):
            near = _nearest(rows, centres)
            moved = np.array([rows[near == c].mean(0) if (near == c).any() else centres[c] for c in range(k)])
            if np.allclose(moved, centres):
                break
            centres = moved
        near = _nearest(rows, centres)
        keep = [c for c in range(k) if (near == c).any()] or [0]
        tree.centres.append(centres[keep])
        tree.children.append([])
        stuck = len(keep) == 1
        for c in keep:
            if stuck:
                tree.leaves += 1
                tree.children[node].append(-tree.leaves)
            else:
                tree.children[node].append(grown(rows[near == c], False))
        return node

    grown(x, True)
    return tree


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of the rows of both, side by side, summed over the dimensions in order."""
    out = np.zeros(len(queries))
    for j in range(queries.shape[1]):
        out += queries[:, j] * vectors[:, j]
    return out


FOUND = "query_row long, query_id long, vec_row long, vec_id long, score double"


def best(queries: pd.DataFrame, vectors: pd.DataFrame, k: int, step: int = 256, sparse: float = 1 / 16) -> pd.DataFrame:
    """Nearest ``k`` of ``vectors`` (row, id, vec, leaf) for each of ``queries`` (row, id, vec, leaves), but for its own row.

    A query sees the vectors of its ``leaves`` only; without that column, all.  A
    matrix product finds what may be among the nearest, for all vectors at once, or
    leaf by leaf if queries see less than the share ``sparse`` of them; the scores
    of those alone are then summed in order.  Ties go by id, then by row.
    """
    vectors = vectors.sort_values(["id", "row"], ignore_index=True)
    x, rows = np.stack(vectors["vec"].to_numpy()).astype(np.float64), vectors["row"].to_numpy()
    q, own = np.stack(queries["vec"].to_numpy()).astype(np.float64), queries["row"].to_numpy()
    slack = 1e-15 * (q.shape[1] + 2) * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()  # of either way to sum
    meets, leaf_of, allowed = [(np.arange(len(q)), np.arange(len(x)))], None, None
    if "leaves" in queries:
        names, leaf_of, counts = np.unique(vectors["leaf"].to_numpy(), return_inverse=True, return_counts=True)
        allowed = np.zeros((len(q), len(names)), bool)
        for r, seen in enumerate(queries["leaves"]):
            at = np.minimum(np.searchsorted(names, seen), len(names) - 1)
            allowed[r, at[names[at] == seen]] = True
        if (allowed @ counts).sum() < sparse * len(q) * len(x):
            columns = np.split(np.argsort(leaf_of, kind="stable"), np.cumsum(counts)[:-1])  # within a leaf still by id
            meets = [(np.flatnonzero(allowed[:, n]), own_columns) for n, own_columns in enumerate(columns)]
    found = [np.zeros((3, 0))]
    for some, columns in meets:
        for s in range(0, len(some), step):
            part = some[s : s + step]
            near = q[part] @ x[columns].T
            if allowed is not None:
                near[~allowed[part][:, leaf_of[columns]]] = -np.inf
            near[own[part][:, None] == rows[columns][None, :]] = -np.inf
            width = near.shape[1]
            cut = np.partition(near, width - k, axis=1)[:, width - k] if width > k else np.full(len(near), -np.inf)
            least = cut - slack[part]
            least[np.isnan(least)] = -np.inf  # products that overflow
            r, c = np.nonzero((near >= least[:, None]) & (near > -np.inf))
            found.append(_first(part[r], columns[c], scores(q[part[r]], x[columns[c]]), k))
    r, c, value = _first(*np.concatenate(found, axis=1), k)
    r, c = r.astype(np.int64), c.astype(np.int64)
    return pd.DataFrame({"query_row": own[r], "query_id": queries["id"].to_numpy()[r], "vec_row": rows[c], "vec_id": vectors["id"].to_numpy()[c], "score": value})


def _first(r: np.ndarray, c: np.ndarray, value: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest values of each r, ties by c."""
    by = np.lexsort((c, -value, r))
    keep = by[np.arange(len(r)) - np.searchsorted(r[by], r[by]) < k]
    return np.stack((r[keep], c[keep], value[keep]))


def usable(vec: Column) -> Column:
    """Not null, all components finite, some of them not zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _top(df: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row"))
    return df.withColumn("rank", place).where(F.col("rank") <= k)


def grown(index: DataFrame, tree: Tree, most: int, scratch: Scratch, leaf: int = LEAF, sample: int = LEAF_SAMPLE) -> tuple[DataFrame, Tree, dict[int, int]]:
    """The index under trees in the place of crowded leaves, the whole tree, and vectors per leaf."""
    spark = index.sparkSession
    sizes = {r.leaf: r.n for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # a row per leaf and per length
    usual = {n: size for n, size in sizes.items() if n < OTHER}
    target = max(leaf, -(-sum(usual.values()) // most))  # vectors of a leaf, so that there aren't too many
    crowded = [(n, size) for n, size in sorted(usual.items()) if size > 2 * target]
    if not crowded:
        return index, tree, sizes
    wide = F.broadcast(spark.createDataFrame(crowded, "leaf long, n long"))
    place = F.row_number().over(Window.partitionBy("leaf").orderBy(F.xxhash64("row"), "row"))
    drawn = index.select("leaf", "row", "vec").join(wide, "leaf").withColumn("place", place).where(F.col("place") <= sample)

    def split(part: pd.DataFrame) -> pd.DataFrame:
        share = len(part) / part["n"].iloc[0]
        made = fit(np.stack(part.sort_values("place")["vec"].to_numpy()), leaf=max(2, int(target * share)))
        return pd.DataFrame({"leaf": part["leaf"].iloc[:1], "tree": [pickle.dumps(made)]})

    parts = drawn.select("leaf", "vec", "n", "place").groupBy("leaf").applyInPandas(split, "leaf long, tree binary").collect()  # about ``most`` centres in all
    tree.graft({r.leaf: pickle.loads(r.tree) for r in parts})
    index = scratch.save(indexed(index.drop("leaf"), tree), "regrown")
    return index, tree, {r.leaf: r.n for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect()}


def indexed(rows: DataFrame, tree: Tree) -> DataFrame:
    """``rows`` (row, id, vec, asked, usual) with the leaf of each."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def found(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            leaf = OTHER + part["vec"].map(len).to_numpy(np.int64)
            if (own := part["usual"].to_numpy(bool)).any():
                leaf[own] = shared.value.leaf_of(np.stack(part["vec"].to_numpy()[own]))
            yield part.assign(leaf=leaf)

    return rows.mapInPandas(found, "row long, id long, vec array<double>, asked boolean, usual boolean, leaf long")


def search(
    df: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    recall: float = RECALL,
    sample: int = SAMPLE,
    probes: int = PROBES,
    block: int = BLOCK,
    leaves: int = LEAVES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row that ``queries`` marks."""
    spark = df.sparkSession
    workers(spark)
    scratch = Scratch(spark, "ann")
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(queries, F.lit(False)).alias("asked"))
    rows = scratch.save(rows.where(usable(F.col("vec")) & F.col("id").isNotNull()), "rows")
    usual = rows.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if usual is None:
        return none
    rows = rows.withColumn("usual", F.size("vec") == usual.dims)
    drawn = rows.where("usual").select("vec").orderBy(F.xxhash64("row"), "row").limit(sample).toPandas()  # at most ``sample`` vectors
    index = scratch.save(indexed(rows, tree := fit(np.stack(drawn["vec"].to_numpy()))), "index")
    del drawn
    index, tree, sizes = grown(index, tree, leaves, scratch)
    asked = index.where("asked").select("row", "id", "vec", "usual")
    if not asked.head(1):
        return none

    visits = 1
    tests = asked.where("usual").orderBy(F.xxhash64("row", F.lit(1)), "row").limit(probes).toPandas()  # at most ``probes`` vectors
    if len(tests):

        def exact(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                if len(part):
                    yield best(tests, part, k).merge(part[["row", "leaf"]].rename(columns={"row": "vec_row"}), on="vec_row")

        true = _top(index.where("usual").drop("asked", "usual").mapInPandas(exact, FOUND + ", leaf long"), k).select("query_row", "leaf").toPandas()
        order = {i: {leaf: n for n, leaf in enumerate(tree.visits(v, tree.leaves, sizes, 0))} for i, v in zip(tests["row"], tests["vec"], strict=True)}
        needed = np.array([order[q][leaf] + 1 for q, leaf in zip(true["query_row"], true["leaf"], strict=True)], np.int64)
        while len(needed) and (needed <= visits).mean() < recall:  # a query's misses count one by one
            visits = min(tree.leaves, max(visits + 1, visits * 5 // 4))

    first, cuts, n_blocks, room = {}, {}, 0, 0  # leaves in the tree's order share blocks; those above a block, or of another length, have their own
    for leaf, n in sorted(sizes.items()):
        if n > block or leaf >= OTHER:
            first[leaf], cuts[leaf], room = n_blocks, -(-n // block), 0
            n_blocks += cuts[leaf]
        else:
            if n > room:
                n_blocks, room = n_blocks + 1, block
            first[leaf], cuts[leaf], room = n_blocks - 1, 1, room - n
    shared = spark.sparkContext.broadcast((tree, sizes, first, cuts))

    def walked(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, sizes, first, cuts = shared.value
        for part in parts:
            rows = []
            for row, name, vec, is_usual in zip(part["row"], part["id"], part["vec"], part["usual"], strict=True):
                seen: dict[int, list[int]] = {}
                for leaf in tree.visits(np.asarray(vec), visits, sizes, k + 1) if is_usual else [OTHER + len(vec)]:
                    for b in range(first[leaf], first[leaf] + cuts[leaf]) if leaf in first else ():
                        seen.setdefault(b, []).append(leaf)
                rows += [(row, name, vec, b, leaves) for b, leaves in seen.items()]
            yield pd.DataFrame(rows, columns=["row", "id", "vec", "block", "leaves"])

    walks = scratch.save(asked.mapInPandas(walked, "row long, id long, vec array<double>, block long, leaves array<long>"), "walks")
    load = walks.groupBy("block").agg(F.ceil(F.count("*") / block).cast("long").alias("parts"))
    load = F.broadcast(spark.createDataFrame(load.collect(), "block long, parts long"))  # a row per block
    where = F.broadcast(spark.createDataFrame([(int(x), int(first[x]), int(cuts[x])) for x in first], "leaf long, first long, cuts long"))  # a row per leaf
    stored = (
        index.join(where, "leaf")
        .select("row", "id", "vec", "leaf", (F.col("first") + F.pmod(F.xxhash64("row"), "cuts")).alias("block"))
        .join(load, "block")
        .select("row", "id", "vec", "leaf", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    )
    walks = walks.join(load, "block").select("row", "id", "vec", "leaves", "block", F.pmod(F.xxhash64("row"), "parts").alias("part"))

    def met(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c.split()[0]: [] for c in FOUND.split(", ")})
        return best(left, right, k)

    near = walks.groupBy("block", "part").cogroup(stored.groupBy("block", "part")).applyInPandas(met, FOUND)
    return _top(near, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
