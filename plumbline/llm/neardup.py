"""Near-duplicate classes by consistent weighted sampling over TF-IDF word shingles.

A shingle is five consecutive words (a shorter text is one shingle). Its weight is its
count in the text times the mean damped inverse document frequency of its words, 1 for a
word in every document up to 2 for one in at most a hundredth of them. So the words with
a frequency of their own number at most 100 x (mean distinct words per document): a
bound that does not grow with the corpus, and the reason they may be broadcast.

Improved consistent weighted sampling draws `bands` x `rows` samples (shingle, level)
per text; equal samples have the probability of the weighted Jaccard similarity. Texts
that agree on all rows of a band share a bucket. Then:
1. exact copies are one class from the start (hash of the text, with its least doc_id);
2. each bucket's member with the least doc_id is compared with the others (a star, linear in the members);
3. in buckets that still hold several classes, members of different classes are compared
   in blocks of bounded size: first by their samples alone, which leaves the members
   with a partner that may reach the threshold, then those by their texts. A block
   returns members or the links that join its classes, never its pairs. The largest
   class of a bucket meets the other classes only, never itself;
4. a bucket with very many members outside its largest class is banded again: each member
   goes to narrower buckets by triples of its other samples, and again until they are
   small enough. Of pairs at 0.8, fewer than one in a million share no narrower bucket.
Every link is verified by the exact weighted Jaccard similarity of the whole texts;
connected components of the links are the classes.

Edge cases: null and empty texts are one class of exact copies; texts without words
link to nothing else; repeated rows fall in one class, extra columns are ignored.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.arrow import chunks, mapped, sorted_groups
from plumbline.llm.catalogue import query
from plumbline.llm.components import components
from plumbline.session import stage

SHINGLE, BANDS, ROWS = 5, 16, 4
FREQUENT = 0.01
THRESHOLD = 0.8
BUCKET = ["band", "bucket"]
GROUP = [*BUCKET, "lo", "hi"]
TRIPLE = 3
NARROWER = (BANDS - 1) * ROWS // TRIPLE  # narrower buckets per member
LEVELS = 3  # how often a bucket is banded again
MIX_1, MIX_2, STEP = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def text_key(text: Column) -> Column:
    """128 bits of the SHA-256 of a text (null: empty) in hex."""
    return F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32)


def frequent_words(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """Damped idf of the words in more than a hundredth of the documents; all others have 2."""
    total = max(1, docs.count())
    words = F.explode(F.array_distinct(F.split(F.coalesce(F.col(text), F.lit("")), r"[ \t-\r]+")))
    counts = docs.select(words.alias("word")).groupBy("word").count().where(F.col("count") > FREQUENT * total)
    rows = counts.where(F.col("word") != "").collect()
    return {r["word"]: float(1 + np.log(total / r["count"]) / np.log(1 / FREQUENT)) for r in rows}


def weights(text: str | None, idf: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order, and their weights."""
    words = list(filter(None, (text or "").replace("\v", " ").replace("\f", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ")))
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), np.empty(0)
    size = min(SHINGLE, n)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    worth = np.fromiter(map(idf.get, words, itertools.repeat(2.0)), np.float64, n)
    count = n - size + 1
    total, mean = np.zeros(count, np.uint64), np.zeros(count)
    for i in range(size):
        total = total * STEP + codes[i : i + count]
        mean += worth[i : i + count]
    total ^= total >> np.uint64(31)
    total *= MIX_1
    order = total.argsort()  # equal shingles have equal means, so any order of them will do
    total = total[order]
    start = np.flatnonzero(np.concatenate(([True], total[1:] != total[:-1])))
    return total[start], np.diff(start, append=count) * mean[order[start]] / size


@functools.lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1) by 16 bits (in a fixed shuffled order), their logs, and the seeds."""
    rng = np.random.default_rng(7)
    gamma = rng.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
    seeds = rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)
    return gamma, np.log(rng.permutation(gamma)), seeds


@functools.lru_cache(maxsize=1)
def _buffers(cells: int) -> tuple[np.ndarray, ...]:
    """Arrays that `samples` fills again and again: new ones of this size would be mapped and cleared each time."""
    return tuple(np.empty(cells, kind) for kind in (np.uint64, np.uint64, np.float32, np.float32, np.float32, np.float32))


def samples(shingles: np.ndarray, weight: np.ndarray, part: int = 512) -> np.ndarray:
    """One 32-bit sample (of shingle and level) per seed; `part` shingles at a time stay in the processor's cache."""
    gamma, log_gamma, seeds = _draws()
    lanes = len(seeds)
    best = np.full(lanes, np.inf, np.float32)
    out = np.zeros(lanes, np.uint64)
    log_w = np.log(weight).astype(np.float32)
    lane = np.arange(lanes)
    low = np.uint64(0xFFFF)
    for at in range(0, len(shingles), part):
        some = shingles[at : at + part]
        x, bits, r, rank, level, beta = (b[: lanes * len(some)].reshape(lanes, -1) for b in _buffers(lanes * part))
        places = bits.view(np.int64)
        np.bitwise_xor(seeds[:, None], some, out=x)
        x *= MIX_2
        x ^= np.right_shift(x, np.uint64(32), out=bits)
        x *= MIX_1
        x ^= np.right_shift(x, np.uint64(29), out=bits)
        np.bitwise_and(x, low, out=bits)
        gamma.take(places, out=r, mode="wrap")  # 16 bits are always in range, and this mode does not look
        np.right_shift(x, np.uint64(16), out=bits)
        bits &= low
        log_gamma.take(places, out=rank, mode="wrap")
        np.right_shift(x, np.uint64(40), out=bits)
        beta[:] = places
        beta *= np.float32(2.0**-24)
        np.divide(log_w[at : at + part], r, out=level)
        level += beta
        np.floor(level, out=level)
        np.subtract(level, beta, out=beta)
        beta += np.float32(1)
        beta *= r
        rank -= beta
        pick = rank.argmin(1)
        value = rank[lane, pick]
        better = value < best
        best[better] = value[better]
        chosen = some[pick] + level[lane, pick].astype(np.int64).astype(np.uint64) * STEP
        out[better] = chosen[better]
    out ^= out >> np.uint64(32)
    return ((out * MIX_2) >> np.uint64(32)).astype(np.uint32)


def _sketches(docs: DataFrame, idf) -> DataFrame:
    """(k, id, bands, samples) once per distinct text; texts without words have no bands."""

    def work(part: pa.RecordBatch) -> list:
        bands, binary = [], []
        for text in part.column("text").to_pylist():
            shingles, weight = weights(text, idf.value)
            if len(shingles):
                s = samples(shingles, weight)
                bands.append([xxhash.xxh3_64_intdigest(row.tobytes(), seed=i) - (1 << 63) for i, row in enumerate(s.reshape(BANDS, ROWS))])
                binary.append(s.tobytes())
            else:
                bands.append([])
                binary.append(b"")
        return [part.column("k"), part.column("id"), part.column("size"), pa.array(bands, pa.list_(pa.int64())), pa.array(binary, pa.binary())]

    kind = dict(docs.dtypes)["id"]
    sized = docs.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    made = sized.mapInArrow(mapped(["k", "id", "size", "bands", "samples"], work), f"k string, id {kind}, size long, bands array<long>, samples binary")
    return made.groupBy("k").agg(F.min("id").alias("id"), F.any_value("size").alias("size"), F.any_value("bands").alias("bands"), F.any_value("samples").alias("samples"))


def _likely(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs (a, a_id, b, b_id) of which at least a share `least` of the samples agree: their texts are worth sending."""
    for side in "ab":
        pairs = pairs.join(sketches.select(F.col("k").alias(side), F.col("samples").alias(f"{side}_samples")), side)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(f"{s}_samples").to_pylist()), np.uint32).reshape(batch.num_rows, -1) for s in "ab")
                yield batch.filter(pa.array((x == y).mean(1) >= least)).select(["a", "a_id", "b", "b_id"])

    names = ["a", "a_id", "b", "b_id"]
    kinds = dict(pairs.dtypes)
    return pairs.select(*names, "a_samples", "b_samples").mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n in names))


def _verified(pairs: DataFrame, docs: DataFrame, idf, threshold: float) -> DataFrame:
    """Pairs (a, a_id, b, b_id) whose whole texts reach the threshold, with the similarity."""
    for side in "ab":
        texts = docs.select(F.col("k").alias(f"{side}_k"), F.col("id").alias(f"{side}_doc"), F.col("text").alias(f"{side}_text"))
        pairs = pairs.join(texts, (F.col(side) == F.col(f"{side}_k")) & F.col(f"{side}_id").eqNullSafe(F.col(f"{side}_doc")))

    def run(batches):
        for part in chunks(batches, "b_text", 4_000_000):
            last, known, values = None, None, []
            for a, x, y in zip(part.column("a").to_pylist(), part.column("a_text").to_pylist(), part.column("b_text").to_pylist()):
                if a != last:
                    last, known = a, weights(x, idf.value)
                values.append(_jaccard(known, weights(y, idf.value)))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(values)], ["a", "b", "similarity"])

    checked = pairs.select("a", "b", "a_text", "b_text").mapInArrow(run, "a string, b string, similarity double")
    return checked.where(F.col("similarity") >= threshold).distinct()


def _jaccard(x, y) -> float:
    shared = 0.0
    if len(x[0]):
        at = np.minimum(x[0].searchsorted(y[0]), len(x[0]) - 1)
        both = x[0][at] == y[0]
        shared = np.minimum(x[1][at[both]], y[1][both]).sum()
    whole = x[1].sum() + y[1].sum() - shared
    return float(shared / whole) if whole else 0.0


def _dealt(members: DataFrame, block: int, block_bytes: int | None = None) -> DataFrame:
    """Per bucket with several classes: its largest class and the blocks for the others (p) and for that class (q).

    A bucket of one block is left whole (p 1, q 0).
    """
    size = F.lit(0) if block_bytes is None else F.col("size")
    blocks = lambda n, size: F.greatest(F.ceil(n / block), F.ceil(size / (block_bytes or 1))).cast("int")
    counts = [F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")]
    mixed = members.groupBy(*BUCKET).agg(*counts, F.min("root").alias("r0"), F.max("root").alias("r1")).where(F.col("r0") != F.col("r1"))
    mixed = stage(mixed.select(*BUCKET, "n", "bytes"), "mixed")
    large = mixed.where(blocks(F.col("n"), F.col("bytes")) > 1)
    whole = {"major": F.lit(None).cast("string"), "p": F.lit(1), "q": F.lit(0)}
    if large.isEmpty():
        return mixed.select(*BUCKET, *[c.alias(name) for name, c in whole.items()])
    classes = members.join(large.select(*BUCKET), BUCKET).groupBy(*BUCKET, "root").agg(*counts)
    most = classes.groupBy(*BUCKET).agg(F.max(F.struct("n", "bytes", "root")).alias("most"))
    split = {
        "major": F.col("most.root"),
        "p": blocks(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")),
        "q": blocks(F.col("most.n"), F.col("most.bytes")),
    }
    columns = [F.when(F.col("most").isNull(), whole[name]).otherwise(split[name]).alias(name) for name in whole]
    return stage(mixed.join(most, BUCKET, "left").select(*BUCKET, *columns), "dealt")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows dealt so that any two of a bucket, but two of its largest class, meet in one group, sorted by it.

    Blocks 0 to p - 1 hold the other classes, the next q the largest one.
    """
    apart = (F.col("q") > 0) & F.col("root").eqNullSafe(F.col("major"))
    code = F.xxhash64("k")
    own = F.when(apart, F.col("p") + F.pmod(code, F.greatest("q", F.lit(1)))).otherwise(F.pmod(code, "p")).cast("int")
    last = F.when(apart, F.col("p") - 1).otherwise(F.col("p") + F.col("q") - 1)
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    dealt = dealt.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other", "major", "p", "q")
    return dealt.repartition(*GROUP).sortWithinPartitions(*GROUP)


@functools.lru_cache(maxsize=LEVELS)
def _triples(level: int) -> np.ndarray:
    """Places of the samples in each narrower bucket, by band: all but the band's own."""
    order = np.random.default_rng(101 + level).permutation(BANDS * ROWS)
    return np.stack([order[order // ROWS != band].reshape(NARROWER, TRIPLE) for band in range(BANDS)])


def _narrower(rows: DataFrame, level: int) -> DataFrame:
    """Members (with samples) in the narrower buckets of their bucket."""
    names = [*BUCKET, "k", "id", "size", "root"]

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            places = _triples(level)[batch.column("band").to_numpy()]
            values = _marks(batch)[np.arange(n)[:, None, None], places].astype(np.uint64)
            code = batch.column("bucket").to_numpy().astype(np.uint64)[:, None] * STEP + np.arange(NARROWER, dtype=np.uint64) * MIX_1
            for i in range(TRIPLE):
                code = (code ^ values[:, :, i]) * MIX_2
                code ^= code >> np.uint64(32)
            out = batch.select(names).take(pa.array(np.repeat(np.arange(n), NARROWER)))
            yield out.set_column(1, "bucket", pa.array(code.reshape(-1).view(np.int64)))

    kinds = dict(rows.dtypes)
    return rows.select(*names, "samples").mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names))


def _near(table: pa.Table, start: int, end: int, marks: np.ndarray, roots: list, least: float):
    """(i, places of likely partners of another class, their agreements) for the rows of one group."""
    own, lo, hi = (table.column(c).to_numpy() for c in ("own", "lo", "hi"))
    across = lo[start] != hi[start]
    codes = np.unique(np.array(roots[start:end]), return_inverse=True)[1]
    for i in range(start, end - 1):
        other = codes[i - start + 1 :] != codes[i - start]
        if across:
            other &= own[i + 1 : end] != own[i]
        places = np.flatnonzero(other) + i + 1
        if len(places):
            equal = marks[places] == marks[i]
            likely = equal.mean(1) >= least
            if likely.any():
                yield i, places[likely], equal[likely]


def _marks(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("samples").to_pylist()), np.uint32).reshape(table.num_rows, -1)


def _undecided(members: DataFrame, sketches: DataFrame, block: int, least: float, narrow: int = NARROWER) -> DataFrame:
    """Members (band, bucket, k, id, size, root) with a likely partner of another class in their bucket.

    Buckets with over `narrow` blocks outside their largest class are replaced by narrower ones.
    """
    names = [*BUCKET, "k", "id", "size", "root"]
    members, marks_of = members.select(*names), sketches.select("k", "samples")
    dealt = _dealt(members, block)
    for level in range(LEVELS):
        wide = dealt.where(F.col("p") > narrow).select(*BUCKET)
        if wide.isEmpty():
            break
        inside = _narrower(members.join(wide, BUCKET).join(marks_of, "k"), level)
        rest = members.join(dealt.where(F.col("p") <= narrow).select(*BUCKET), BUCKET)
        members = stage(rest.select(*names).union(inside), "narrower")
        dealt = _dealt(members, block)
    rows = members.join(dealt, BUCKET).join(marks_of, "k")
    rows = _in_blocks(rows).select(*GROUP, "own", "k", "id", "size", "root", "samples")

    def run(batches):
        for table, bounds in sorted_groups(batches, GROUP):
            marks, roots, found = _marks(table), table.column("root").to_pylist(), set()
            for start, end in zip(bounds, bounds[1:]):
                for i, places, _ in _near(table, start, end, marks, roots, least):
                    found.add(i)
                    found.update(places.tolist())
            yield from table.take(pa.array(sorted(found), pa.int64())).select(names).combine_chunks().to_batches()

    kind = dict(members.dtypes)["id"]
    return rows.mapInArrow(run, f"band int, bucket long, k string, id {kind}, size long, root string").distinct()


def _block_links(undecided: DataFrame, sketches: DataFrame, docs: DataFrame, idf, block: int, block_bytes: int, least: float, threshold: float) -> DataFrame:
    """Verified links (a, b) that join the classes of undecided members; each pair is tried in its first common band."""
    bands = undecided.groupBy("k").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("band"))).alias("in_bands"))
    texts = docs.select(F.col("k").alias("t_k"), F.col("id").alias("t_id"), "text")
    rows = undecided.join(_dealt(undecided, block, block_bytes), BUCKET).join(bands, "k").join(sketches.select("k", "samples"), "k")
    rows = rows.join(texts, (F.col("k") == F.col("t_k")) & F.col("id").eqNullSafe(F.col("t_id"))).dropDuplicates(["band", "bucket", "k"])
    rows = _in_blocks(rows).select(*GROUP, "own", "k", "root", "in_bands", "samples", "text")

    def run(batches):
        for table, bounds in sorted_groups(batches, GROUP):
            marks, k, roots = _marks(table), table.column("k").to_pylist(), table.column("root").to_pylist()
            band, in_bands = table.column("band").to_numpy(), table.column("in_bands").to_numpy()
            links = []
            for start, end in zip(bounds, bounds[1:]):
                vectors = [weights(t, idf.value) for t in table.column("text").slice(start, end - start).to_pylist()]
                total = np.array([v[1].sum() for v in vectors])
                parent = {r: r for r in roots[start:end]}

                def find(r):
                    while parent[r] != r:
                        parent[r] = r = parent[parent[r]]
                    return r

                for i, places, equal in _near(table, start, end, marks, roots, least):
                    shared = equal.reshape(-1, BANDS, ROWS).all(2)
                    both = (in_bands[places] & in_bands[i])[:, None] >> np.arange(BANDS) & 1
                    here = (shared & (both > 0)).argmax(1) == band[i]
                    near = np.minimum(total[places - start], total[i - start]) >= threshold * np.maximum(total[places - start], total[i - start])
                    for j in places[here & near]:
                        x, y = find(roots[i]), find(roots[j])
                        if x != y and _jaccard(vectors[i - start], vectors[j - start]) >= threshold:
                            parent[x] = y
                            links.append((k[i], k[j]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.string()), pa.array([y for _, y in links], pa.string())], ["a", "b"])

    return rows.mapInArrow(run, "a string, b string")


def near_duplicates(docs: DataFrame, *, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text", block: int = 1024, block_bytes: int = 1 << 24, narrow: int = NARROWER) -> DataFrame:
    """(k, class_id, keeper) per distinct text: k is `text_key`, class_id the least doc_id of its class,
    keeper the key of that document's text."""
    spark = docs.sparkSession
    rows = docs.select(text_key(F.col(text)).alias("k"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    idf = spark.sparkContext.broadcast(frequent_words(docs, text))
    # six deviations of the samples below the threshold: fewer than 2 pairs at it in 100 million fall below
    least = threshold - 6 * float(np.sqrt(threshold * (1 - threshold) / (BANDS * ROWS)))
    sketches = stage(_sketches(rows, idf), "sketches")
    members = sketches.select("k", "id", "size", F.posexplode("bands").alias("band", "bucket"))
    heads = members.groupBy("band", "bucket").agg(F.min(F.struct("id", "k")).alias("head"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    stars = stage(
        members.join(heads, ["band", "bucket"]).select("band", "bucket", "k", "id", "size", F.col("head.k").alias("a"), F.col("head.id").alias("a_id")), "stars"
    )
    first = stars.where(F.col("a") != F.col("k")).select("a", "a_id", F.col("k").alias("b"), F.col("id").alias("b_id")).distinct()
    links = stage(_verified(_likely(first, sketches, least), rows, idf, threshold).select("a", "b"), "links")
    roots = components(links)
    rooted = lambda df: df.join(roots.select(F.col("node").alias("k"), F.col("root").alias("_r")), "k", "left").withColumn("root", F.coalesce("_r", "k")).drop("_r")
    undecided = stage(_undecided(stage(rooted(stars), "rooted"), sketches, block, least, narrow), "undecided")
    if not undecided.isEmpty():
        more = stage(_block_links(undecided, sketches, rows, idf, block, block_bytes, least, threshold), "more")
        roots = components(links.union(more))
    classes = rooted(sketches.select("k", "id"))
    keepers = classes.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "k")).alias("w"))
    return classes.join(keepers, "root").select("k", F.col("w.id").alias("class_id"), F.col("w.k").alias("keeper"))


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class: the one with the least doc_id; columns unchanged."""
    classes = near_duplicates(docs, doc_id=doc_id, text=text, **options)
    keep = classes.where(F.col("k") == F.col("keeper")).select(F.col("k").alias("_k"), F.col("class_id").alias("_keep"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), text_key(F.col(text)).alias("_key"), F.col(doc_id).alias("_id"))
    kept = keyed.join(keep, (F.col("_key") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_keep")))
    return kept.dropDuplicates(["_k", "_keep"]).select("row.*")


@query("op2_near_duplicates")
def op2_near_duplicates(t) -> DataFrame:
    docs = t("documents")
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("k"))
    return keyed.join(near_duplicates(docs), "k").select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
