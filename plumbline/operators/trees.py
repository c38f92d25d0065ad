"""Random forests on all labelled rows: one task grows whole trees, on every row and every threshold.

The rows lie in a written table of the shared folder. A task reads it, keeps the ranks of each
feature's values, and grows its trees one after the other; nodes are written as they are done, so
neither the driver nor a broadcast ever holds a forest. A node of up to `LOCAL_CELLS` numbers is grown
level by level in memory. Larger ones are split by counts of their values, piece by piece, and the
ranks lie in a file of the task's temporary folder, so memory does not follow the table. Both ways
look at the same splits: every boundary between two values of the node's drawn features.

Row weights are Poisson(1) draws by (row key, seed, tree) and features are drawn by (seed, tree,
place in the tree). Neither depends on the order of rows, and a forest of a smaller depth is the
upper part of a deeper one.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline import constants as C
from plumbline.session import stage

LOCAL_CELLS = 8_000_000  # numbers (rows x features) of a node grown in memory
PIECE = 1 << 20  # rows, or values, of a larger node looked at together
CELLS = 2_000_000  # numbers of rows scored together: a tree is read once for them
GROUPS = 3  # tasks per core: each reads the rows once for all its trees
GOLD = 0x9E3779B97F4A7C15
DRAWS = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(15)])  # Poisson(1)


@dataclass(frozen=True)
class TreeRows:
    """A written table of h (digest of the row key), y, x and, if kept, fold."""

    sparkSession: SparkSession
    files: tuple[str, ...]
    width: int
    held: int | None = None

    def without(self, fold: int) -> TreeRows:
        return replace(self, held=fold)


def tree_rows(df: DataFrame, key: str = "row_id", fold: str | None = None) -> TreeRows:
    """All rows of a frame with features and y, written once for all trees."""
    own = F.col(key) if key in df.columns else F.monotonically_increasing_id()
    cells = [F.xxhash64(own).alias("h"), (F.col("y") == 1).alias("y"), vector_to_array("features").alias("x")]
    if fold is not None:
        cells.append(F.col(fold).cast("long").alias("fold"))
    rows = stage(df.select(*cells), "tree_rows")
    first = rows.select(F.size("x")).first()
    return TreeRows(df.sparkSession, tuple(sorted(rows.inputFiles())), first[0] if first else 0)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def mixed(h: np.ndarray) -> np.ndarray:
    """64 bits of which each depends on all of the argument's."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def start_of(seed: int, tree: int) -> np.ndarray:
    return mixed(np.array([(seed * GOLD + tree * 0xD1B54A32D192ED03 + 1) % 2**64], np.uint64))


class Ranks:
    """Rows inside a task: digests, labels, and per feature its sorted values and each row's rank among them."""

    def __init__(self, files: Sequence[str], width: int, held: int | None = None, cells: int = LOCAL_CELLS):
        self.local, self.folders = max(1, cells // max(1, width)), {}
        parts = list(self.read(files, ["h", "y"], held))
        self.digests = np.concatenate([np.asarray(b.column(0)).view(np.uint64) for b in parts])
        self.label = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in parts]).astype(np.uint8)
        n = len(self.digests)
        numbers = self.room("numbers", (width, n), np.float64)
        at = 0
        for batch in self.read(files, ["x"], held):
            x = np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, width)
            numbers[:, at : at + len(x)] = x.T
            at += len(x)
        self.codes = self.room("codes", (width, n), np.int32)
        self.values = []
        for f in range(width):
            values = np.unique(numbers[f])
            for start in range(0, n, PIECE):
                part = slice(start, start + PIECE)
                self.codes[f, part] = np.searchsorted(values, numbers[f, part])
            self.values.append(self.kept(f"values{f}", values))
        del numbers
        self.folders.pop("numbers", None)

    @staticmethod
    def read(files: Sequence[str], columns: list[str], held: int | None) -> Iterator[pa.RecordBatch]:
        for uri in files:
            system, path = opened(uri)
            with system.open_input_file(path) as source:
                for batch in pq.ParquetFile(source).iter_batches(65_536, columns=columns if held is None else [*columns, "fold"]):
                    yield batch.select(columns) if held is None else batch.filter(pc.field("fold") != held).select(columns)

    def room(self, name: str, shape: tuple[int, int], kind: type) -> np.ndarray:
        """An array in memory, or in a file of the task's temporary folder if there are many rows."""
        if shape[1] <= self.local:
            return np.empty(shape, kind)
        self.folders[name] = tempfile.TemporaryDirectory(prefix="plumbline-")  # goes with this object
        return np.memmap(f"{self.folders[name].name}/{name}", kind, "w+", shape=shape)

    def kept(self, name: str, values: np.ndarray) -> np.ndarray:
        if len(values) <= self.local:
            return values
        out = self.room(name, (1, len(values)), values.dtype)
        out[0] = values
        return out[0]


class Tree:
    """Grows one tree on ranked rows: `feature`, `left` (-1: leaf; the right child follows), `value`, `share` and `gains`."""

    def __init__(
        self, rows: Ranks, seed: int, tree: int, weights: tuple[float, float] = (1.0, 1.0), max_depth: int | None = None, min_leaf: int = 1
    ):
        self.rows, self.weights, self.min_leaf = rows, weights, max(1, min_leaf)
        self.max_depth = np.inf if max_depth is None else max_depth
        self.width = len(rows.codes)
        self.drawn = max(1, math.ceil(math.sqrt(self.width)))
        self.gains = np.zeros(self.width)
        start = start_of(seed, tree)
        count = np.empty(len(rows.digests), np.uint8)
        for at in range(0, len(count), PIECE):
            part = slice(at, at + PIECE)
            uniform = (mixed(rows.digests[part] + start) >> np.uint64(11)) / 2.0**53
            count[part] = np.searchsorted(DRAWS, uniform, "right")
        self.payload = count << 1 | rows.label
        self.grow(np.flatnonzero(count).astype(np.int32 if len(count) < 2**31 else np.int64), mixed(start + np.uint64(1)))

    def grow(self, own: np.ndarray, path: np.ndarray) -> None:
        top = [[-1, -1, 0.0, 0.0]]
        cells, open_ = [], [(0, own, 0, path)]
        while open_:
            place, own, depth, path = open_.pop()
            if len(own) <= self.rows.local:
                cells.append((place, own, depth, path))
                continue
            split = self.split_large(own, depth, path, top[place])
            if split is not None:
                top[place][1] = len(top)
                for side, part in enumerate(split):
                    open_.append((len(top), part, depth + 1, mixed(path + np.uint64(side + 1))))
                    top.append([-1, -1, 0.0, 0.0])
        blocks, base = [], len(top)
        for place, own, depth, path in cells:
            made = self.subtree(own, depth, path)
            made[1][made[1] >= 0] += base - 1
            top[place] = [column[0] for column in made]
            blocks.append([column[1:] for column in made])
            base += len(made[0]) - 1
        kinds = (np.int32, np.int32, np.float64, np.float64)
        upper = [np.array(column, kind) for column, kind in zip(zip(*top), kinds)]
        self.feature, self.left, self.value, self.share = (np.concatenate([u, *[b[i] for b in blocks]]) for i, u in enumerate(upper))

    def chosen(self, paths: np.ndarray) -> np.ndarray:
        """The features drawn for each node."""
        out = np.empty((len(paths), self.drawn), np.int64)
        numbers = (np.arange(1, self.width + 1, dtype=np.uint64) * np.uint64(GOLD))[None]
        step = max(1, CELLS // self.width)
        for start in range(0, len(paths), step):
            part = slice(start, start + step)
            out[part] = np.argsort(mixed(paths[part, None] + numbers), axis=1, kind="stable")[:, : self.drawn]
        return out

    def worth(self, ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
        """Weight less Gini impurity of a side of counted rows; what a split adds to it is its gain."""
        a, b = ones * self.weights[1], zeros * self.weights[0]
        return (a * a + b * b) / (a + b)

    def shares(self, ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
        a, b = ones * self.weights[1], zeros * self.weights[0]
        return a / np.where(a + b > 0, a + b, 1.0)

    def between(self, feature: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Thresholds halfway between two ranks' values; the lower value where no number lies between."""
        a, b = self.rows.values[feature][low], self.rows.values[feature][high]
        with np.errstate(invalid="ignore", over="ignore"):
            half = a + (b - a) / 2
            return np.where((half >= a) & (half < b), half, a)

    def split_large(self, own: np.ndarray, depth: int, path: np.ndarray, node: list) -> tuple[np.ndarray, np.ndarray] | None:
        """The best split of a node too large to be sorted: values are counted in pieces of their ranks."""
        pieces = [own[at : at + PIECE] for at in range(0, len(own), PIECE)]
        total = ones = 0
        for part in pieces:
            cell = self.payload[part]
            total += int((cell >> 1).sum(dtype=np.int64))
            ones += int(((cell >> 1) * (cell & 1)).sum(dtype=np.int64))
        node[3] = float(self.shares(np.array(ones), np.array(total - ones)))
        if not 0 < ones < total or depth >= self.max_depth or total < 2 * self.min_leaf:
            return None
        parent = float(self.worth(np.array(ones), np.array(total - ones)))
        best, cut = parent * (1 + 1e-12), None
        for f in self.chosen(path)[0]:
            before = np.zeros((2, 1), np.int64)
            for low in range(0, len(self.rows.values[f]), PIECE):
                found = np.zeros((2, PIECE), np.int64)
                for part in pieces:
                    code = self.rows.codes[f, part] - low
                    inside = (code >= 0) & (code < PIECE)
                    cell, code = self.payload[part][inside], code[inside]
                    for label in (0, 1):
                        times = np.where(cell & 1 == label, cell >> 1, 0)
                        found[label] += np.bincount(code, times, PIECE).astype(np.int64)
                sums = before + np.cumsum(found, axis=1)
                before = sums[:, -1:]
                left = sums.sum(0)
                place = np.flatnonzero(found.any(0) & (left >= self.min_leaf) & (total - left >= self.min_leaf))
                if len(place):
                    l0, l1 = sums[:, place]
                    score = self.worth(l1, l0) + self.worth(ones - l1, total - ones - l0)
                    if score.max() > best:
                        best, cut = float(score.max()), (f, low + place[score.argmax()])
        if cut is None:
            return None
        f, low = cut
        sides, high = ([], []), len(self.rows.values[f])
        for part in pieces:
            code = self.rows.codes[f, part]
            right = code > low
            high = min(high, int(code[right].min(initial=high)))
            sides[0].append(part[~right])
            sides[1].append(part[right])
        node[0], node[2] = int(f), float(self.between(f, np.array(low), np.array(high)))
        self.gains[f] += best - parent
        return np.concatenate(sides[0]), np.concatenate(sides[1])

    def subtree(self, own: np.ndarray, depth: int, path: np.ndarray) -> list[np.ndarray]:
        """feature, left, value and share of the nodes below a node, level by level; left counts from the node as 0.

        The rows of a level are sorted by (node, rank of the node's feature), with their label and
        number of draws in the lowest bits.
        """
        m = len(own)
        codes = np.concatenate([column[own] for column in self.rows.codes])
        payload = self.payload[own].astype(np.int64)
        bits = max(1, max(len(v) for v in self.rows.values).bit_length())
        row, node = np.arange(m), np.zeros(m, np.int64)
        count = np.array([(payload >> 1).sum()])
        ones = np.array([((payload >> 1) * (payload & 1)).sum()])
        paths, levels, made = path, [], 1
        while True:
            zeros = count - ones
            level = [np.full(len(count), -1, np.int32), np.full(len(count), -1, np.int32), np.zeros(len(count)), self.shares(ones, zeros)]
            levels.append(level)
            live = (ones > 0) & (zeros > 0) & (count >= 2 * self.min_leaf) & (depth < self.max_depth)
            keep = live[node]
            row, node = row[keep], (np.cumsum(live) - 1)[node[keep]]
            if not len(row):
                break
            ids, total, total1, paths = np.flatnonzero(live), count[live], ones[live], paths[live]
            drawn = self.chosen(paths)
            parent = self.worth(total1, total - total1)
            best, feature = parent * (1 + 1e-12), np.full(len(ids), -1)
            low, high = np.zeros((2, len(ids)), np.int64)
            starts = np.concatenate([[0], np.cumsum(np.bincount(node, minlength=len(ids)))[:-1]])
            packed = node << (bits + 5) | payload[row]
            for slot in range(self.drawn):
                key = codes[drawn[node, slot] * m + row].astype(np.int64)
                key <<= 5
                key |= packed
                key.sort()
                times = key >> 1 & 15
                sums = np.concatenate([[0], np.cumsum(times)])
                sums1 = np.concatenate([[0], np.cumsum(times * (key & 1))])
                key >>= 5
                place = np.flatnonzero(key[1:] != key[:-1])
                at = key[place] >> bits
                same = key[place + 1] >> bits == at
                place, at = place[same], at[same]
                left, left1 = sums[place + 1] - sums[starts[at]], sums1[place + 1] - sums1[starts[at]]
                if self.min_leaf > 1:
                    enough = (left >= self.min_leaf) & (total[at] - left >= self.min_leaf)
                    place, at, left, left1 = place[enough], at[enough], left[enough], left1[enough]
                if not len(place):
                    continue
                right, right1 = total[at] - left, total1[at] - left1
                score = self.worth(left1, left - left1) + self.worth(right1, right - right1)
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                most = np.maximum.reduceat(score, first)
                hits = np.flatnonzero(score == np.repeat(most, np.diff(np.append(first, len(at)))))
                hits = hits[np.concatenate([[True], at[hits][1:] != at[hits][:-1]])]
                better = most > best[at[first]]
                hits = hits[better]
                won = at[hits]
                best[won], feature[won] = score[hits], drawn[won, slot]
                mask = (1 << bits) - 1
                low[won], high[won] = key[place[hits]] & mask, key[place[hits] + 1] & mask
            split = feature >= 0
            rank = np.cumsum(split) - 1
            for f in np.unique(feature[split]):
                mine = feature == f
                level[2][ids[mine]] = self.between(f, low[mine], high[mine])
                self.gains[f] += (best[mine] - parent[mine]).sum()
            level[0][ids[split]] = feature[split]
            level[1][ids[split]] = made + 2 * rank[split]
            made += 2 * int(split.sum())
            keep = split[node]
            row, node = row[keep], node[keep]
            if not len(row):
                break
            node = 2 * rank[node] + (codes[feature[node] * m + row] > low[node])
            cell = payload[row]
            size = 2 * int(split.sum())
            count = np.bincount(node, cell >> 1, size).astype(np.int64)
            ones = np.bincount(node, (cell >> 1) * (cell & 1), size).astype(np.int64)
            paths = mixed(np.repeat(paths[split], 2) + np.tile(np.array([1, 2], np.uint64), size // 2))
            depth += 1
        return [np.concatenate(column) for column in zip(*levels)]

    def packed(self) -> bytes:
        """The nodes as written: four columns one after the other, 24 bytes a node."""
        columns = (self.feature.astype("<i4"), self.left.astype("<i4"), self.value.astype("<f8"), self.share.astype("<f8"))
        return b"".join(column.tobytes() for column in columns)


def read_tree(uri: str, offset: int, nodes: int) -> tuple[np.ndarray, ...]:
    """feature, left, value and share of a written tree."""
    system, path = opened(uri)
    with system.open_input_file(path) as source:
        cells = source.read_at(24 * nodes, offset)
    kinds, sizes = ("<i4", "<i4", "<f8", "<f8"), (4, 4, 8, 8)
    return tuple(np.frombuffer(cells, kind, nodes, nodes * sum(sizes[:i])) for i, kind in enumerate(kinds))


def walk(tree: Sequence[np.ndarray], x: np.ndarray, limits: Sequence[int | None], sums: np.ndarray) -> None:
    """Add each row's share of class 1 at its leaf, per depth limit."""
    feature, left, value, share = tree
    at, open_ = np.zeros(len(x), np.int32), np.arange(len(x))
    depth, waiting = 0, set(range(len(limits)))
    while waiting:
        for i in [i for i in waiting if limits[i] == depth]:
            sums[i] += share[at]
            waiting.remove(i)
        if not waiting:
            break
        now = at[open_]
        inner = left[now] >= 0
        open_, now = open_[inner], now[inner]
        if not len(open_):
            for i in waiting:
                sums[i] += share[at]
            break
        at[open_] = left[now] + ~(x[open_, feature[now]] <= value[now])
        depth += 1


def summed(trees: Sequence[tuple[str, int, int]], x: np.ndarray, limits: Sequence[int | None]) -> np.ndarray:
    """Mean share of class 1 over the trees, limits x rows."""
    sums = np.zeros((len(limits), len(x)))
    for tree in trees:
        walk(read_tree(*tree), x, limits, sums)
    return sums / len(trees)


def gathered(parts: Iterator, cells: Callable) -> Iterator[tuple[list, np.ndarray]]:
    """Batches in lists of up to about `CELLS` numbers, with their features as one matrix."""
    held, xs, size = [], [], 0
    for part in parts:
        array = cells(part)
        held.append(part)
        if len(array):
            xs.append(np.asarray(array.flatten()).reshape(len(array), -1))
            size += xs[-1].size
        if size >= CELLS:
            yield held, np.concatenate(xs)
            held, xs, size = [], [], 0
    if held:
        yield held, np.concatenate(xs) if xs else np.empty((0, 0))


class WholeForest:
    """A forest whose trees lie in the shared folder; scores are means over all trees."""

    def __init__(self, trees: Sequence[tuple[str, int, int]], gains: np.ndarray):
        self.trees, self.gains = list(trees), gains

    @property
    def importances(self) -> np.ndarray:
        sums = self.gains.sum(1, keepdims=True)
        total = (self.gains / np.where(sums > 0, sums, 1.0)).sum(0)
        return total / total.sum() if total.sum() else total

    def scored(self, df: DataFrame) -> DataFrame:
        """Rows with score (share of class 1) and predicted."""
        trees = self.trees

        @F.arrow_udf("double")
        def share(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for held, x in gathered(parts, lambda part: part):
                scores, at = summed(trees, x, [None])[0], 0
                for part in held:
                    yield pa.array(scores[at : at + len(part)])
                    at += len(part)

        out = df.withColumn("score", share(vector_to_array("features")))
        return out.withColumn("predicted", (F.col("score") > 0.5).cast("int"))

    def depths(self, df: DataFrame, limits: Sequence[int | None], keep: Sequence[str]) -> DataFrame:
        """The kept columns with depth_no, score and predicted, once per depth limit (None: no limit)."""
        trees, limits, keep = self.trees, list(limits), list(keep)
        rows = df.select(*keep, vector_to_array("features").alias("__x"))
        kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for held, x in gathered(batches, lambda batch: batch.column(batch.num_columns - 1)):
                scores, at = summed(trees, x, limits), 0
                for batch in held:
                    n = batch.num_rows
                    for i in range(len(limits)):
                        own = scores[i, at : at + n]
                        columns = [*batch.columns[:-1], pa.array(np.full(n, i, np.int32)), pa.array(own), pa.array((own > 0.5).astype("int32"))]
                        yield pa.RecordBatch.from_arrays(columns, [*keep, "depth_no", "score", "predicted"])
                    at += n

        return rows.mapInArrow(run, f"{kinds}, depth_no int, score double, predicted int")


def grow_forest(
    rows: TreeRows,
    *,
    n_trees: int = 100,
    max_depth: int | None = None,
    min_samples_leaf: int = 1,
    weights: Mapping[int, float] | None = None,
    seed: int = C.SEED,
) -> WholeForest:
    """A forest on all of `rows`, its trees dealt to tasks. `weights` are those of classes 0 and 1."""
    files, width, held = list(rows.files), rows.width, rows.held
    folder = files[0].rsplit("/", 2)[0]
    by_class = (1.0, 1.0) if weights is None else (float(weights.get(0, 1.0)), float(weights.get(1, 1.0)))
    cells = LOCAL_CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = [no for batch in batches for no in batch.column(0).to_pylist()]
        if not numbers:
            return
        ranks = Ranks(files, width, held, cells)
        uri, offset = f"{folder}/trees-{uuid.uuid4().hex}", 0
        system, path = opened(uri)
        made = []
        with system.open_output_stream(path) as out:
            for no in numbers:
                tree = Tree(ranks, seed, no, by_class, max_depth, min_samples_leaf)
                out.write(tree.packed())
                made.append((no, uri, offset, len(tree.left), tree.gains.tolist()))
                offset += 24 * len(tree.left)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], ["tree", "uri", "offset", "nodes", "gains"])

    tasks = min(n_trees, GROUPS * rows.sparkSession.sparkContext.defaultParallelism)
    jobs = rows.sparkSession.range(0, n_trees, 1, tasks).mapInArrow(run, "tree long, uri string, offset long, nodes long, gains array<double>")
    done = sorted(jobs.collect(), key=lambda r: r["tree"])
    return WholeForest([(r["uri"], r["offset"], r["nodes"]) for r in done], np.array([r["gains"] for r in done]))
