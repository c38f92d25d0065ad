"""Random forests of small tables, and all their depths from one fit.

A tree of unlimited depth has up to two nodes per row it is grown on, and the nodes of Spark's
forests travel with the tasks. They serve tables of up to `FIT_ROWS` labelled rows, fitted whole;
forests on more rows are grown by `trees`, on all of them. Callers may still ask for a bounded
number of rows (`max_rows`): each class in its share, the rows with the least digests of their
key. No query does.

The trees of a forest are grown in batches side by side; a row's score is the mean of its
trees' class shares, as in one forest. `DepthForest` holds a forest's nodes as arrays and
scores rows as if the forest had been grown to a smaller depth: a tree is grown level by level,
so its upper levels do not depend on how far it goes on.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from plumbline import constants as C
from plumbline.functions import hash_text
from plumbline.operators.ordered import cut_digests
from plumbline.session import scratch_folder, stage

FIT_ROWS = 600  # tables of up to so many rows are grown by Spark's estimator, larger ones by `trees`
MAX_DEPTH = 30  # deepest tree Spark grows
BATCH = 50  # trees grown by one fit
WIDTH = 8  # fits at a time
NODES_MB = 1024  # statistics of the nodes split at a time; enough for whole levels at FIT_ROWS
PAIRED = 128  # entries of a table over several features
STEP = 64  # rows scored at a time: their open leaves stay in the cache
WEIGHT = "class_weight"


def fit_rows(
    df: DataFrame,
    counts: Mapping[int, int],
    max_rows: int | None = None,
    key: str = "row_id",
    seed: int = C.SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """`y`, `features` and the kept columns of all rows, or of at most `max_rows` (and one of each class).

    Written to one file in digest order, so a refit meets the same rows in the same order. One
    pass finds the cut digest of each class, another keeps what is not above it. Rows without
    the key are numbered in a written copy.
    """
    total = sum(counts.values())
    columns = ["y", "features", *keep]
    if max_rows is None or total <= max_rows:
        order = [key] if key in df.columns else []
        rows = df.select(*columns, *[c for c in order if c not in columns])
    else:
        if key not in df.columns:
            df = stage(df.select(*columns, F.monotonically_increasing_id().alias(key)), "numbered_rows")
        digest = hash_text(f"fit|{seed}", F.col(key))
        quota = F.greatest(F.lit(1), F.floor(F.col("stratum_n") * F.lit(max_rows / total))).cast("long")
        cuts = cut_digests(df, digest, ["y"], {"cut": quota}).collect()  # a row per class
        test = reduce(lambda a, b: a | b, [(F.col("y") == r["y"]) & (digest <= r["cut"]) for r in cuts])
        rows, order = df.where(test).select(*columns, digest.alias("__digest")), ["__digest"]
    one = rows.repartition(1)
    one = one.sortWithinPartitions(*order) if order else one
    return stage(one.select(*columns), "fit_rows")


class Forest:
    """Fitted batches of trees; scores are means over all trees."""

    def __init__(self, parts: Sequence, trees: Sequence[int]):
        self.parts, self.trees = list(parts), list(trees)
        self.nodes: DepthForest | None = None

    @property
    def importances(self) -> np.ndarray:
        total = sum(n * p.featureImportances.toArray() for p, n in zip(self.parts, self.trees))
        return total / total.sum() if total.sum() else total

    def depths(self, df: DataFrame, limits: Sequence[int | None], keep: Sequence[str]) -> DataFrame:
        return DepthForest(self, df.sparkSession).scored(df, limits, keep)

    def scored(self, df: DataFrame) -> DataFrame:
        """Rows with score (share of class 1) and predicted."""
        if self.nodes is None:
            self.nodes = DepthForest(self, df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast(self.nodes.tables([None]))

        @F.arrow_udf("double")
        def share(cells: pa.Array) -> pa.Array:
            tables, shares = shared.value
            ((a, b),) = shares_of(matrix(cells), tables, shares)
            return pa.array(b / (a + b))

        out = df.withColumn("score", share(vector_to_array("features")))
        return out.withColumn("predicted", (F.col("score") > 0.5).cast("int"))


def fit_forest(
    rows: DataFrame,
    *,
    n_trees: int = 100,
    max_depth: int | None = None,
    min_samples_leaf: int = 1,
    weighted: bool = False,
    seed: int = C.SEED,
    batch: int | None = BATCH,
    width: int = WIDTH,
) -> Forest:
    """A forest on all of `rows` (features, y and, if weighted, class_weight), which should come from `fit_rows`."""
    size = n_trees if batch is None else batch
    trees = [min(size, n_trees - start) for start in range(0, n_trees, size)]

    def grow(job: tuple[int, int]):
        i, n = job
        estimator = RandomForestClassifier(
            featuresCol="features",
            labelCol="y",
            numTrees=n,
            maxDepth=MAX_DEPTH if max_depth is None else max_depth,
            minInstancesPerNode=min_samples_leaf,
            featureSubsetStrategy="sqrt",
            seed=seed + 7919 * i,
            # rows remember their node: the trees grown so far stay on the driver
            cacheNodeIds=True,
            maxMemoryInMB=NODES_MB,
        )
        return (estimator.setWeightCol(WEIGHT) if weighted else estimator).fit(rows)

    with ThreadPoolExecutor(max(1, min(width, len(trees)))) as pool:
        return Forest(pool.map(grow, enumerate(trees)), trees)


# --- all depths of a forest ---------------------------------------------------------


class DepthForest:
    """Nodes of a forest as arrays: at most 2 x fitted rows x trees of them."""

    def __init__(self, forest: Forest, spark):

        def table_of(part) -> pd.DataFrame:
            path = scratch_folder(spark, "forest")
            part.write().save(path)
            saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
            flat = saved.select(
                "treeID", "id", "prediction", "leftChild", "rightChild", "split.featureIndex", "split.numCategories",
                F.get("impurityStats", 0).alias("class0"), F.get("impurityStats", 1).alias("class1"),
                F.get("split.leftCategoriesOrThreshold", 0).alias("cut"), F.size("split.leftCategoriesOrThreshold").alias("n_left"),
            )
            return flat.toPandas()

        with ThreadPoolExecutor(WIDTH) as pool:
            tables = list(pool.map(table_of, forest.parts))
        for i, table in enumerate(tables):
            table["treeID"] += sum(forest.trees[:i])
        nodes = pd.concat(tables).sort_values(["treeID", "id"], ignore_index=True)
        self.roots = np.flatnonzero(nodes["id"].to_numpy() == 0)
        base = self.roots[np.cumsum(nodes["id"].to_numpy() == 0) - 1]
        inner = nodes["leftChild"].to_numpy() >= 0
        at = np.arange(len(nodes))
        left = np.where(inner, base + nodes["leftChild"], at)
        right = np.where(inner, base + nodes["rightChild"], at)
        flag = inner & (nodes["numCategories"].to_numpy() >= 0)  # 0 or 1 goes left
        if (flag & ~((nodes["numCategories"] == 2) & (nodes["n_left"] == 1)).to_numpy()).any():
            raise ValueError("splits of more than two categories are not supported")
        cut = nodes["cut"].fillna(0.0).to_numpy()
        swap = flag & (cut == 1.0)
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        self.feature = np.where(inner, nodes["featureIndex"].to_numpy(), 0)
        self.threshold = np.where(flag, 0.5, np.where(inner, cut, 0.0))
        stats = nodes[["class0", "class1"]].to_numpy()
        self.shares = stats / stats.sum(1, keepdims=True)
        self.left, self.right, self.inner = left.astype(np.int64), right.astype(np.int64), inner
        self.label = nodes["prediction"].to_numpy()
        self.depth = np.zeros(len(nodes), np.int64)
        level = self.roots
        while len(level := level[self.inner[level]]):
            for child in (self.left[level], self.right[level]):
                self.depth[child] = self.depth[level] + 1
            level = np.concatenate([self.left[level], self.right[level]])

    def ends(self, limit: int) -> np.ndarray:
        """Which nodes are leaves if trees stop at depth `limit`; leaves that agree become one, as Spark prunes."""
        leaf = ~self.inner | (self.depth >= limit)
        for d in range(min(limit, int(self.depth.max(initial=0))) - 1, -1, -1):
            own = np.flatnonzero((self.depth == d) & ~leaf)
            a, b = self.left[own], self.right[own]
            leaf[own[leaf[a] & leaf[b] & (self.label[a] == self.label[b])]] = True
        return leaf

    def masks(self) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]:
        """Per feature the sorted thresholds and, per interval between them, the leaves still open.

        A set of leaves is a row of 64-bit words per tree. A leaf is where a row ends if no
        feature's value closes it, so the sets of all features have one leaf in common.
        """
        trees = len(self.roots)
        tree = np.searchsorted(self.roots, np.arange(len(self.left)), "right") - 1
        # Leaves are numbered from left to right, so the ones below a node are a range.
        first, last = np.zeros(len(self.left), np.int64), np.zeros(len(self.left), np.int64)
        number = np.zeros(trees, np.int64)
        size = np.where(self.inner, 0, 1)
        for d in range(int(self.depth.max(initial=0)) - 1, -1, -1):
            own = np.flatnonzero((self.depth == d) & self.inner)
            size[own] = size[self.left[own]] + size[self.right[own]]
        number[:] = size[self.roots]
        last[self.roots] = number
        for d in range(int(self.depth.max(initial=0))):
            own = np.flatnonzero((self.depth == d) & self.inner)
            a, b = self.left[own], self.right[own]
            first[a], last[a] = first[own], first[own] + size[a]
            first[b], last[b] = last[a], last[own]
        words = int(number.max(initial=1) + 63) // 64
        leaves = np.zeros((trees, words * 64), np.int64)
        ends = np.flatnonzero(~self.inner)
        leaves[tree[ends], first[ends]] = ends

        def ranges(nodes: np.ndarray) -> np.ndarray:
            places = np.arange(words * 64)
            flags = (places >= first[nodes][:, None]) & (places < last[nodes][:, None])
            return np.packbits(flags, axis=1, bitorder="little").view("<u8")

        tables = []
        for f in np.unique(self.feature[self.inner]):
            own = np.flatnonzero(self.inner & (self.feature == f))
            cuts = np.unique(self.threshold[own])
            open_ = np.tile(ranges(self.roots), (len(cuts) + 1, 1, 1))
            place = np.searchsorted(cuts, self.threshold[own])
            lefts, rights = ~ranges(self.left[own]), ~ranges(self.right[own])
            for i in range(len(cuts) + 1):
                # interval i: values in (cuts[i - 1], cuts[i]] go left where the threshold is cuts[i] or more
                closed = np.where((place >= i)[:, None], rights, lefts)
                np.bitwise_and.at(open_[i], tree[own], closed)
            tables.append((int(f), cuts, open_))
        return tables, leaves

    def ancestors(self, leaf: np.ndarray) -> np.ndarray:
        """For every node the first node on its way from the root at which a row stops."""
        stop = np.arange(len(self.left))
        for d in range(int(self.depth.max(initial=0))):
            own = np.flatnonzero((self.depth == d) & self.inner)
            for child in (self.left[own], self.right[own]):
                up = stop[own]
                stop[child] = np.where(leaf[up], up, child)
        return stop

    def tables(self, limits: Sequence[int | None]) -> tuple:
        """What tasks need: open leaves by feature, and class shares of every leaf's stopping node per limit."""
        opened, leaves = self.masks()
        shares = []
        for d in limits:
            stop = self.ancestors(self.ends(MAX_DEPTH if d is None else d))
            shares.append(self.shares[stop[leaves]])
        # with few features a table over pairs of small ones saves a pass over all trees
        opened.sort(key=lambda t: len(t[1]))
        merged: list[tuple[list[tuple[int, np.ndarray]], np.ndarray]] = []
        for f, cuts, open_ in opened:
            if merged and len(merged[-1][1]) * len(open_) <= PAIRED:
                parts, before = merged[-1]
                both = before[:, None] & open_[None]
                merged[-1] = ([*parts, (f, cuts)], both.reshape(-1, *open_.shape[1:]))
            else:
                merged.append(([(f, cuts)], open_))
        return merged, shares

    def scored(self, df: DataFrame, limits: Sequence[int | None], keep: Sequence[str]) -> DataFrame:
        """The kept columns with depth_no, score and predicted, once per depth limit (None: no limit)."""
        shared = df.sparkSession.sparkContext.broadcast(self.tables(limits))
        rows = df.select(*keep, vector_to_array("features").alias("__x"))
        kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables, shares = shared.value
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                sums = shares_of(matrix(batch.column(batch.num_columns - 1)), tables, shares)
                for i in range(len(shares)):
                    total = sums[i][0] + sums[i][1]
                    made = [sums[i][1] / total, (sums[i][1] > sums[i][0]).astype("int32")]
                    columns = [*batch.columns[:-1], pa.array(np.full(n, i, np.int32)), *map(pa.array, made)]
                    yield pa.RecordBatch.from_arrays(columns, [*keep, "depth_no", "score", "predicted"])

        return rows.mapInArrow(run, f"{kinds}, depth_no int, score double, predicted int")


def matrix(cells: pa.Array) -> np.ndarray:
    """Rows x features of an array column."""
    return np.asarray(cells.flatten()).reshape(len(cells), -1) if len(cells) else np.empty((0, 0))


def shares_of(x: np.ndarray, tables: Sequence, shares: Sequence[np.ndarray]) -> list[list[np.ndarray]]:
    """Summed class shares of all trees, per depth limit, for rows of features."""
    n = len(x)
    if not n:
        return [[np.empty(0), np.empty(0)] for _ in shares]
    sums = [[np.empty(n), np.empty(n)] for _ in shares]
    codes = []
    for parts, open_ in tables:
        code = np.zeros(n, np.int64)
        for f, cuts in parts:
            code = code * (len(cuts) + 1) + np.searchsorted(cuts, x[:, f], "left")
        codes.append(code)
    trees, places = shares[0].shape[:2]
    flat = [[np.ascontiguousarray(s[:, :, k]).ravel() for k in (0, 1)] for s in shares]
    base = np.arange(trees) * places
    words = tables[0][1].shape[2] if tables else 0
    left, more = np.empty((2, STEP, trees, words), np.uint64)
    number, taken = np.empty((STEP, trees, words)), np.empty((STEP, trees))
    for start in range(0, n, STEP):
        part = slice(start, min(start + STEP, n))
        m = part.stop - start
        at = np.broadcast_to(base, (m, trees)).copy()
        for j, (code, (_, open_)) in enumerate(zip(codes, tables)):
            np.take(open_, code[part], axis=0, out=more[:m] if j else left[:m], mode="clip")
            if j:
                np.bitwise_and(left[:m], more[:m], out=left[:m])
        if tables:
            # one bit is left in one of the words; its place is the exponent of the word as a number
            number[:m] = left[:m]
            exponent = number[:m].view(np.int64) >> 52
            for w in range(words):
                own = exponent[:, :, w]
                at += (own + (64 * w - 1023)) * (own > 0)
        for i, pair in enumerate(flat):
            for k in (0, 1):
                np.take(pair[k], at, out=taken[:m], mode="clip")
                taken[:m].sum(1, out=sums[i][k][part])
    return sums


def deepest(depths: Sequence[int | None]) -> int | None:
    return None if None in depths else max(depths)


def without_depth(params: Mapping[str, Any]) -> dict[str, Any]:
    return {k: v for k, v in params.items() if k != "max_depth"}
