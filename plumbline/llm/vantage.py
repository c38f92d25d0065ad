"""Centroid clustering with a vantage-point tree over the centroids.

Each round the centroids (a fixed number) are put in a vantage-point tree, which goes to the
tasks with the function. Every vector searches it best first: its frontier of subtrees is kept
with a lower bound of their distance, the nearest is opened next, and the search ends when no
subtree is left whose bound is within the best distance. The bound counts as within when it is
equal, and carries a margin for the rounding of square roots, so every centroid that could tie
is met; the distances compared are exact integers, and equal ones go to the smaller number.
The searches of a batch run side by side on arrays, each with its own frontier.

Tasks add up counts and component sums per centroid; what reaches the driver is one row per
centroid and component. Vectors are turned to integers once, in a written table that each round
reads; nothing is shuffled but the sums.

Edge cases: a vector that is null, has another length, or has a null or non-finite component is
left out. So is one with a component of 2**19 (524,288) or more in size, as squared distances of
such vectors do not fit a long. Vectors without an id are clustered but do not start a
centroid; of rows with equal ids the smaller vector comes first. Fewer vectors than centroids
give as many centroids as there are. An empty table has no rows. Sums beyond a long are null.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.catalogue import query
from plumbline.session import stage

LARGEST = 1 << 27  # of an integer component: 64 squares of differences stay below 2**63
FAR = np.iinfo(np.int64).max


@dataclass
class Node:
    """A ball around a vantage centroid, or a leaf; `low` and `high` bound its points' distances from the parent's vantage."""

    low: float
    high: float
    vantage: int = -1
    children: tuple[int, ...] = ()
    members: tuple[int, ...] = ()


def squared(rows: np.ndarray, center: np.ndarray) -> np.ndarray:
    gap = rows - center
    return np.einsum("ij,ij->i", gap, gap)


class VantageTree:
    """Nearest centroid by exact squared distance; ties go to the smaller number."""

    def __init__(self, centers: np.ndarray, leaf: int = 3):
        self.centers, self.nodes = centers, []
        self._grow(list(range(len(centers))), 0.0, np.inf, leaf)

    def _grow(self, own: list[int], low: float, high: float, leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(low, high))
        if len(own) <= leaf:
            self.nodes[at].members = tuple(own)
            return at
        # the point farthest from the first one: it sees the others at unlike distances
        vantage = own[int(np.argmax(squared(self.centers[own], self.centers[own[0]])))]
        rest = [i for i in own if i != vantage]
        gaps = np.sqrt(squared(self.centers[rest], self.centers[vantage]).astype(float))
        order = np.argsort(gaps, kind="stable")
        halves = [order[: len(order) // 2], order[len(order) // 2 :]]
        children = tuple(self._grow([rest[i] for i in h], float(gaps[h].min()), float(gaps[h].max()), leaf) for h in halves)
        self.nodes[at].vantage, self.nodes[at].children = vantage, children
        return at

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the centroid, squared distance) per row."""
        n = len(rows)
        best, found = np.full(n, FAR), np.full(n, -1)
        bounds = np.full((n, len(self.nodes)), np.inf)  # of the subtrees in each row's frontier
        bounds[:, 0] = 0.0

        def meet(who: np.ndarray, center: int) -> np.ndarray:
            gap = squared(rows[who], self.centers[center])
            better = (gap < best[who]) | ((gap == best[who]) & (center < found[who]))
            best[who[better]], found[who[better]] = gap[better], center
            return gap

        active = np.arange(n)
        while len(active):
            turn = bounds[active].argmin(1)
            # the margin keeps subtrees whose bound only seems beyond the best by rounding
            within = bounds[active, turn] * (1 - 1e-9) - 1e-6 <= np.sqrt(best[active].astype(float))
            within &= np.isfinite(bounds[active, turn])
            active, turn = active[within], turn[within]
            for k in np.unique(turn):
                who, node = active[turn == k], self.nodes[k]
                own = bounds[who, k]
                bounds[who, k] = np.inf
                for center in node.members:
                    meet(who, center)
                if node.children:
                    gap = np.sqrt(meet(who, node.vantage).astype(float))
                    for child in node.children:
                        ball = self.nodes[child]
                        bounds[who, child] = np.maximum(own, np.maximum(gap - ball.high, ball.low - gap))
        return found, best


def _batches(frames: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in frames:
        if batch.num_rows:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            yield batch, flat.astype(np.int64).reshape(-1, width)


def integer_vectors(table: DataFrame, width: int, scale: int, *, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, v): the vectors of `width` finite components as integers floor(scale * x)."""
    values = F.transform(column, lambda x: x.cast("double"))
    rows = table.select(F.col(key), F.when(F.size(column) == width, values).alias("v"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / scale)
    return rows.where(F.forall("v", fine)).select(key, F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("v"))


def first_centers(vectors: DataFrame, k: int, salt: str, *, key: str = "vec_id") -> np.ndarray:
    """The k vectors whose salted ids have the smallest SHA-256, in that order."""
    mark = F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256)
    rows = vectors.where(F.col(key).isNotNull()).select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()
    return np.array([r.v for r in rows], dtype=np.int64)


def moved(vectors: DataFrame, centers: np.ndarray) -> np.ndarray:
    """Floor of the mean of each centroid's vectors; those without any stay."""
    k, width = centers.shape
    tree = VantageTree(centers)

    def sums(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for _, rows in _batches(frames, width):
            own, _ = tree.nearest(rows)
            count += np.bincount(own, minlength=k)
            for c in np.unique(own):
                total[c] += rows[own == c].sum(0)
        used = np.flatnonzero(count)
        table = np.hstack([count[used, None], total[used]])
        slots = [np.repeat(used, width + 1), np.tile(np.arange(width + 1), len(used)), table.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(s, pa.int64()) for s in slots], ["c", "slot", "value"])

    parts = vectors.select("v").mapInArrow(sums, "c long, slot long, value long")
    out = centers.copy()
    table: dict[int, dict[int, int]] = {}
    for r in parts.groupBy("c", "slot").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        table.setdefault(r.c, {})[r.slot] = int(r.value)
    for c, own in table.items():
        out[c] = [own[i + 1] // own[0] for i in range(width)]
    return out


def assigned(vectors: DataFrame, centers: np.ndarray, *, key: str = "vec_id") -> DataFrame:
    """(key, cluster, distance) of every vector."""
    tree, width = VantageTree(centers), centers.shape[1]

    def search(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in _batches(frames, width):
            own, gap = tree.nearest(rows)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(own, pa.int32()), pa.array(gap, pa.int64())], [key, "cluster", "distance"])

    return vectors.select(key, "v").mapInArrow(search, f"{key} {dict(vectors.dtypes)[key]}, cluster int, distance long")


def cluster(
    table: DataFrame, *, k: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, salt: str = "2:", key: str = "vec_id", column: str = "embedding"
) -> tuple[DataFrame, np.ndarray]:
    """Rows (key, cluster, distance) and the final centroids, k x width integers."""
    vectors = stage(integer_vectors(table, width, scale, key=key, column=column), "integer_vectors")
    centers = first_centers(vectors, k, salt, key=key)
    if not len(centers):
        none = vectors.where(F.lit(False))
        return none.select(key, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centers.reshape(0, width)
    for _ in range(rounds):
        centers = moved(vectors, centers)
    return assigned(vectors, centers, key=key), centers


def center_digest(center: Sequence[int]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in center).encode()).hexdigest()


_ROUND = """
d{n} AS (SELECT v.row, v.vec_id, c.c, list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance FROM v, c{n} c),
a{n} AS (SELECT row, arg_min(c, distance * 64 + c) AS c FROM d{n} GROUP BY row),
m{n} AS (SELECT a.c, i, CAST(sum(v.v[i]) AS HUGEINT) AS s, count(*) AS n FROM a{n} a JOIN v USING (row), range(1, 65) r(i) GROUP BY a.c, i),
c{next} AS (
  SELECT c.c, coalesce(f.v, c.v) AS v FROM c{n} c
  LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM m{n} GROUP BY c) f ON f.c = c.c),
"""
SQL = (
    """
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x) < 524288)) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY mark, v) - 1 AS c, v
  FROM (SELECT v, sha256('2:' || vec_id) AS mark FROM v WHERE vec_id IS NOT NULL ORDER BY mark, v LIMIT 40)),
"""
    + "".join(_ROUND.format(n=n, next=n + 1) for n in range(5))
    + """
d5 AS (SELECT v.row, v.vec_id, c.c, list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance FROM v, c5 c),
a5 AS (SELECT row, any_value(vec_id) AS vec_id, arg_min(c, distance * 64 + c) AS c, min(distance) AS distance FROM d5 GROUP BY row)
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
  CAST(sum(a.distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a5 a JOIN c5 c ON c.c = a.c
"""
)


@query("op13_centroid_clusters", SQL)
def op13_centroid_clusters(t) -> DataFrame:
    rows, centers = cluster(t("embeddings"))
    rows = stage(rows, "clusters")
    exact = F.col("distance").cast("decimal(38,0)")
    sums = {r.cluster: r.total for r in rows.groupBy("cluster").agg(F.sum(exact).alias("total")).collect()}  # one row per centroid
    long = lambda n: None if n is None or n > FAR else int(n)
    every = long(sum(sums.values()) if sums else 0)
    table = [(c, long(n), every, center_digest(centers[c])) for c, n in sums.items()]
    facts = rows.sparkSession.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # at most one row per centroid
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
