"""Merkle manifest of a dataset, with proofs by pointer jumping.

Every row of the table is a leaf; each tree (one per language) pairs neighbours level by
level, and a tree over the subroots gives the root. A proof of a leaf is the list of
sibling digests on its way up. Nodes start with a segment of one sibling, towards their
parent. A self-join appends to each node's segment the one of the ancestor it has reached,
which doubles the distance; of the nodes only those at levels that later steps start from
are kept. After log2(height) joins every leaf holds its siblings up to the subroot, and one
more join appends those from there to the root.

Only digests are shuffled, never texts. Positions come from a range partitioning and the
row number inside each range, so a large tree is not sorted in one task. Nodes are hashed in
blocks of 64 neighbours, six levels at a time. An ancestor that many nodes meet is repeated
once per 64 of them, so no join key has more rows than that, whatever the tree's size. The
driver gets one number, the size of the largest tree.

Edge cases: a null language is a tree of its own and the first; a null value hashes as `-`.
Leaves of equal id stand in the order of their digests (null ids first), so repeated rows
are leaves of their own. An empty table has no rows. A tree of one leaf has that leaf as its
subroot, and an empty proof hashes the empty string. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plumbline.llm.catalogue import query
from plumbline.session import stage

BITS = 6  # levels hashed at a time; 2 ** BITS nodes meet one copy of an ancestor
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def digest(value: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(value, 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_text(values: Sequence[Column]) -> Column:
    """Values as `byte count:value`, or `-` for null, without anything between."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _shift(value: Column, bits: int) -> Column:
    return F.shiftright(value, bits)


def _spread(df: DataFrame, last: Column, name: str) -> DataFrame:
    """A copy of each row for every number from 0 to `last`."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), last)))


def placed(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """Leaves (tree, h, ...) with `pos` (from 0) in their tree and `size`, the tree's leaves.

    A range partitioning by (tree, order, digest) and a row number inside each range; rows equal
    in all of these are told apart by their place in the input, so that they split too.
    """
    keys = ["tree", *order, "h", "_place"]
    width = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = leaves.withColumn("_place", F.monotonically_increasing_id())
    ranged = marked.repartitionByRange(width, *keys).sortWithinPartitions(*keys).drop("_place")
    rows = stage(ranged.withColumn("_row", F.monotonically_increasing_id()), "merkle_order")
    part, row = _shift(F.col("_row"), ROW_BITS), F.col("_row").bitwiseAND((1 << ROW_BITS) - 1)
    rows = rows.withColumns({"_part": part, "_row": row, "_slot": _shift(row, BITS)})
    parts = rows.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.max("_row").alias("_last"))
    count = F.col("_last") - F.col("_first") + 1
    whole = W.partitionBy("tree")  # one row per tree and range
    before = whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumns({"size": F.sum(count).over(whole), "_before": F.coalesce(F.sum(count).over(before), F.lit(0)) - F.col("_first")})
    slots = F.sequence(_shift(F.col("_first"), BITS), _shift(F.col("_last"), BITS))
    parts = parts.select("tree", "_part", "size", "_before", F.explode(slots).alias("_slot"))
    joined = rows.join(parts, ["tree", "_part", "_slot"])
    return joined.withColumn("pos", F.col("_row") + F.col("_before")).drop("_part", "_row", "_slot", "_before")


def _levels(digests: Column, count: Column) -> Column:
    """Digests of a block and of the levels above it, up to BITS levels or the tree's top."""
    pair = lambda own: F.transform(
        F.sequence(F.lit(0), _shift(F.size(own) - 1, 1)),
        lambda i: digest(F.concat(hex_text(F.get(own, 2 * i)), F.coalesce(hex_text(F.get(own, 2 * i + 1)), F.lit("")))),
    )
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(BITS)]), lambda below: count > below)
    return F.aggregate(steps, F.array(digests), lambda done, _: F.concat(done, F.array(pair(F.element_at(done, -1)))))


def _hashed(nodes: DataFrame, base: int, kept: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Blocks of neighbours hashed up: nodes with their sibling, and what remains above."""
    item = F.struct("pos", "h", *kept)
    blocks = nodes.groupBy("tree", "count", "size", _shift(F.col("pos"), BITS).alias("block")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    blocks = stage(blocks.withColumn("levels", _levels(F.col("items.h"), F.col("count"))), "merkle_blocks")
    below = blocks.where(F.size("levels") > 1)
    sibling = F.coalesce(F.get("own", F.col("i").bitwiseXOR(1)), F.lit(b"")).alias("segment")
    if kept:
        rows = below.select("tree", "size", "block", F.col("items.h").alias("own"), F.posexplode("items").alias("i", "item"))
        first = rows.select("tree", "size", F.lit(base).alias("level"), "item.pos", sibling, "item.h", *[f"item.{c}" for c in kept])
    levels = below.select("tree", "size", "block", F.posexplode(F.slice("levels", 1, F.size("levels") - 1)).alias("k", "own"))
    inner = levels.where(F.col("k") > 0) if kept else levels
    inner = inner.select("tree", "size", "block", "k", "own", F.posexplode("own").alias("i", "h"))
    place = F.col("block") * F.element_at(F.array(*[F.lit(1 << (BITS - k)) for k in range(BITS)]), F.col("k") + 1) + F.col("i")
    inner = inner.select("tree", "size", (F.col("k") + base).alias("level"), place.alias("pos"), sibling)
    found = first.unionByName(inner, allowMissingColumns=True) if kept else inner
    above = F.ceil(F.col("count") / (1 << BITS)).cast("long")
    tops = blocks.select("tree", "size", F.col("block").alias("pos"), F.get(F.element_at("levels", -1), 0).alias("h"), above.alias("count"))
    if kept:
        lone = blocks.where(F.size("levels") == 1).select("tree", "size", F.lit(base).alias("level"), F.explode("items").alias("item"))
        alone = lone.select("tree", "size", "level", "item.pos", F.lit(b"").alias("segment"), "item.h", *[f"item.{c}" for c in kept])
        found = found.unionByName(alone, allowMissingColumns=True)
    return found, tops


def _jump(nodes: DataFrame, distance: int) -> DataFrame:
    """Segments of twice the distance, for the nodes at every second level of those left."""
    fine = min(BITS, distance)
    left = nodes.where(F.col("level") % (2 * distance) == 0)
    right = nodes.where(F.col("level") % (2 * distance) == distance)
    right = right.select("tree", (F.col("level") - distance).alias("level"), "pos", F.col("segment").alias("more"))
    copies = 1 << (distance - fine)
    right = _spread(right, F.lit(copies - 1).cast("long"), "copy")
    right = right.select("tree", "level", (F.col("pos") * copies + F.col("copy")).alias("meet"), "more")
    joined = left.withColumn("meet", _shift(F.col("pos"), fine)).join(right, ["tree", "level", "meet"], "left")
    segment = F.concat("segment", F.coalesce("more", F.lit(b"")))
    return joined.withColumn("segment", segment).drop("meet", "more")


def proofs(leaves: DataFrame, order: Sequence[str], kept: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Leaves (tree, size, pos, h, segment, *kept) and trees (tree, size, top).

    `leaves` has tree (string, not null), h (32 bytes), the order's columns and the kept ones;
    `segment` is the siblings' digests, bottom first.
    """
    nodes = placed(leaves, order).select("tree", "size", "pos", "h", *kept)
    nodes = nodes.withColumn("count", F.col("size"))
    found, tops, base = None, [], 0
    while True:
        level, above = _hashed(nodes, base, kept if base == 0 else [])
        found = level if found is None else found.unionByName(level, allowMissingColumns=True)
        tops.append(above.where(F.col("count") == 1).select("tree", "size", F.col("h").alias("top")))
        nodes = above.where(F.col("count") > 1)
        base += BITS
        if nodes.isEmpty():
            break
    trees = tops[0]
    for more in tops[1:]:
        trees = trees.unionByName(more)
    height = (trees.agg(F.max("size")).first()[0] or 1) - 1
    distance = 1
    while distance < height.bit_length():
        found = stage(_jump(found, distance), "merkle_jump")
        distance *= 2
    return found.where(F.col("level") == 0).select("tree", "size", "pos", "h", "segment", *kept), trees


def _path(pos: Column, size: Column) -> Column:
    """Per level of a tree: has the node a sibling, and does that stand on its left."""
    height = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda k: size > F.call_function("shiftleft", F.lit(1).cast("long"), k))
    at = lambda k: F.call_function("shiftright", pos, k)
    last = lambda k: F.call_function("shiftright", size - 1, k)
    return F.transform(height, lambda k: F.struct((at(k) % 2 == 1).alias("left"), ((at(k) % 2 == 1) | (at(k) < last(k))).alias("has")))


def fold(leaf: Column, siblings: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give (hex texts)."""
    start = F.struct(leaf.alias("own"), F.lit(1).alias("at"))

    def step(done: Column, turn: Column) -> Column:
        other = F.substring(siblings, done["at"], F.lit(64))
        both = F.when(~turn["has"], done["own"]).when(turn["left"], F.concat(other, done["own"])).otherwise(F.concat(done["own"], other))
        return F.struct(F.sha2(both, 256).alias("own"), (done["at"] + F.when(turn["has"], 64).otherwise(0)).alias("at"))

    return F.aggregate(path, start, step, lambda done: done["own"])


def manifest(leaves: DataFrame, order: Sequence[str], kept: Sequence[str] = ()) -> DataFrame:
    """Leaves of several trees (tree, h, ...) with leaf, subroot, root, siblings (all hex) and path.

    `path` tells per level whether the node has a sibling and on which side; `fold` takes it.
    """
    rows, trees = proofs(leaves, order, list(kept))
    trees = stage(trees, "merkle_trees")
    one = trees.select(F.lit("").alias("tree"), F.col("top").alias("h"), F.col("tree").alias("own"), F.col("size").alias("own_size"))
    upper, top = proofs(one, ["own"], ["own", "own_size"])
    upper = upper.join(F.broadcast(top.select("tree", F.col("top").alias("root"))), "tree")  # one row: that of all trees
    upper = upper.select(F.col("own").alias("tree"), F.col("h").alias("subroot"), "root", F.col("segment").alias("more"), _path(F.col("pos"), F.col("size")).alias("path_up"), "own_size")
    upper = _spread(upper, _shift(F.col("own_size") - 1, BITS), "meet").drop("own_size")
    joined = rows.withColumn("meet", _shift(F.col("pos"), BITS)).join(upper, ["tree", "meet"])
    return joined.select(
        *kept,
        hex_text(F.col("h")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"),
        hex_text(F.concat("segment", "more")).alias("siblings"),
        F.concat(_path(F.col("pos"), F.col("size")), F.col("path_up")).alias("path"),
    )


def document_leaves(docs: DataFrame) -> DataFrame:
    """(tree, h, doc_id, other): digests of the rows, and of the tampered row where 7 divides the id's crc32."""
    asked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = [F.col(c) if c != "n_chars" else F.col(c).cast("decimal(38,0)") + 1 for c in FIELDS]
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"),
        digest(leaf_text([F.col(c) for c in FIELDS])).alias("h"),
        F.when(asked, digest(leaf_text(changed))).alias("other"),
    )


SQL = """
WITH RECURSIVE
bits AS (
  SELECT doc_id, (xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
      lambda i: [ascii(CAST(doc_id AS VARCHAR)[i]), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END))) % 7 = 0 AS asked
  FROM (SELECT DISTINCT doc_id FROM documents)),
parts AS (
  SELECT d.doc_id, d.lang, coalesce(b.asked, false) AS asked,
    coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS own, coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS other,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents d LEFT JOIN bits b ON d.doc_id IS NOT DISTINCT FROM b.doc_id),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS size
  FROM (SELECT doc_id, coalesce('=' || lang, '-') AS tree, sha256(head || own || tail) AS leaf, sha256(head || CASE WHEN asked THEN other ELSE own END || tail) AS start FROM parts)),
low AS (
  SELECT tree, 0 AS k, list(leaf ORDER BY pos) AS own FROM leaves GROUP BY tree
  UNION ALL
  SELECT tree, k + 1, list_transform(range(0, (len(own) + 1) // 2), lambda i: sha256(own[2 * i + 1] || coalesce(own[2 * i + 2], ''))) FROM low WHERE len(own) > 1),
tops AS (SELECT tree, k AS height, own[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM low WHERE len(own) = 1),
high AS (
  SELECT 0 AS k, list(subroot ORDER BY place) AS own FROM tops
  UNION ALL
  SELECT k + 1, list_transform(range(0, (len(own) + 1) // 2), lambda i: sha256(own[2 * i + 1] || coalesce(own[2 * i + 2], ''))) FROM high WHERE len(own) > 1),
steps AS (
  SELECT l.tree, l.pos, n.k, (l.pos >> n.k) % 2 = 1 AS is_left, n.own[xor(l.pos >> n.k, 1) + 1] AS sibling
  FROM leaves l JOIN low n ON n.tree = l.tree JOIN tops t ON t.tree = l.tree WHERE n.k < t.height
  UNION ALL
  SELECT l.tree, l.pos, t.height + n.k, (t.place >> n.k) % 2 = 1, n.own[xor(t.place >> n.k, 1) + 1]
  FROM leaves l JOIN tops t ON t.tree = l.tree JOIN high n ON len(n.own) > 1),
walk AS (
  SELECT tree, pos, 0 AS k, start AS own FROM leaves
  UNION ALL
  SELECT w.tree, w.pos, w.k + 1, sha256(CASE WHEN s.sibling IS NULL THEN w.own WHEN s.is_left THEN s.sibling || w.own ELSE w.own || s.sibling END)
  FROM walk w JOIN steps s ON s.tree = w.tree AND s.pos = w.pos AND s.k = w.k),
ends AS (SELECT tree, pos, arg_max(own, k) AS folded_root FROM walk GROUP BY tree, pos),
lists AS (SELECT tree, pos, string_agg(sibling, '' ORDER BY k) AS siblings FROM steps GROUP BY tree, pos),
summit AS (SELECT own[1] AS root FROM high WHERE len(own) = 1)
SELECT l.doc_id, l.leaf, t.subroot, r.root, sha256(coalesce(p.siblings, '')) AS proof_sha256, e.folded_root, e.folded_root = r.root AS verified
FROM leaves l JOIN tops t ON t.tree = l.tree JOIN ends e ON e.tree = l.tree AND e.pos = l.pos
LEFT JOIN lists p ON p.tree = l.tree AND p.pos = l.pos CROSS JOIN summit r
"""


@query("op12_merkle_manifest", SQL)
def op12_merkle_manifest(t) -> DataFrame:
    leaves = stage(document_leaves(t("documents")), "merkle_leaves")
    rows = manifest(leaves, ["doc_id"], ["doc_id", "other"])
    start = F.coalesce(hex_text(F.col("other")), F.col("leaf"))
    rows = rows.withColumn("folded_root", fold(start, F.col("siblings"), F.col("path")))
    proof = F.sha2("siblings", 256).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
