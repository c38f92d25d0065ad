import random
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from samples import prose

from plumbline.llm import neardup as N
from plumbline.llm.components import components


def brute(docs, idf, threshold=0.8):
    """Least doc_id of each connected class by comparing all pairs."""
    vectors = [N.weights(t, idf) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            same = (docs[i][1] or "") == (docs[j][1] or "")
            if same or N._jaccard(vectors[i], vectors[j]) >= threshold:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((str(doc), str(least.get(find(i)))) for i, (doc, _) in enumerate(docs))


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else f"edit{rng.randrange(999)}" for w in text.split())


def found(docs):
    keyed = docs.select("doc_id", N.text_key(F.col("text")).alias("key"))
    classes = N.near_duplicates(docs)
    return sorted((str(r.doc_id), str(r.class_id)) for r in keyed.join(classes, F.col("key") == F.col("k")).collect())


def test_classes_equal_all_pairs(spark, edge_docs, texts_of):
    assert found(edge_docs) == brute(texts_of(edge_docs), N.frequent_words(edge_docs))


def test_copies_edits_and_a_shared_passage(spark):
    base, passage = prose(50, 150), prose(60, 80)
    rows = [(i, edited(base, 0.004, i)) for i in range(30)]
    rows += [(100 + i, passage + " " + prose(200 + i, 60)) for i in range(40)]
    rows += [(200 + i, edited(prose(70 + i % 5, 120), 0.01, i)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(docs) == brute(rows, N.frequent_words(docs))


def classes_of(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        root[find(i)] = find(j)
    return [min(j for j in range(n) if find(j) == find(i)) for i in range(n)]


def test_blocks_join_all_classes_of_a_bucket(spark):
    """Members unlike their bucket's head but like each other; blocks of five rows, texts split by bytes too."""
    base = prose(80, 150)
    rows = [(i, edited(base, 0.01, i) + " " + prose(90 + i // 4, 25) + f" last{i}") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    idf = N.frequent_words(docs)
    keyed = docs.select(N.text_key(F.col("text")).alias("k"), F.col("doc_id").alias("id"), "text")
    shared = spark.sparkContext.broadcast(idf)
    sketches = N._sketches(keyed, shared).cache()
    members = sketches.select("k", "id", "size", F.posexplode("bands").alias("band", "bucket"), F.col("k").alias("root"))
    undecided = N._undecided(members, sketches, 5, 0.5)
    narrowed = N._undecided(members, sketches, 5, 0.5, narrow=1).cache()
    number = {r.k: r.id for r in sketches.collect()}
    pairs = lambda rows: [(number[r.a], number[r.b]) for r in N._block_links(rows, sketches, keyed, shared, 5, 3000, 0.5, 0.8).collect()]
    links, narrow_links = pairs(undecided), pairs(narrowed)
    vectors = [N.weights(t, idf) for _, t in rows]
    exact = [(i, j) for i in range(24) for j in range(i) if N._jaccard(vectors[i], vectors[j]) >= 0.8]
    assert all((max(x), min(x)) in exact for x in links + narrow_links)
    assert classes_of(24, links) == classes_of(24, narrow_links) == classes_of(24, exact)
    wide = {(r.band, r.bucket) for r in undecided.collect()}
    assert wide and not wide <= {(r.band, r.bucket) for r in narrowed.collect()}  # some buckets were banded again


def test_rows_of_hot_buckets_grow_in_proportion(spark):
    """A large class beside a few others is dealt once per block of the others; unlike members go to narrower buckets."""
    for n in (200, 400):
        rows = [(0, 5, f"k{i}", i, 10, "one") for i in range(n)] + [(0, 5, f"other{i}", n + i, 10, f"r{i}") for i in range(3)]
        members = spark.createDataFrame(rows, "band int, bucket long, k string, id long, size long, root string")
        dealt = N._in_blocks(members.join(N._dealt(members, 10), N.BUCKET)).collect()
        assert len(dealt) == n + 3 * (1 + n // 10)
        groups = {}
        for r in dealt:
            groups.setdefault((r.lo, r.hi), set()).add(r.k)
        assert all(any({f"k{i}", f"other{j}"} <= g for g in groups.values()) for i in range(n) for j in range(3))
        assert any({"other0", "other1", "other2"} <= g for g in groups.values())
    rng = random.Random(4)
    for n in (300, 600):
        marks = [np.array([rng.randrange(1 << 32) for _ in range(64)], np.uint32) for _ in range(n)]
        for m in marks:
            m[:4] = 7
        marks[n - 1] = marks[0].copy()
        marks[n - 1][10:20] = 1
        members = spark.createDataFrame([(0, 5, f"k{i}", i, 10, f"k{i}") for i in range(n)], "band int, bucket long, k string, id long, size long, root string")
        sketches = spark.createDataFrame([(f"k{i}", m.tobytes()) for i, m in enumerate(marks)], "k string, samples binary")
        found = N._undecided(members, sketches, 10, 0.5, narrow=5).collect()
        assert {r.k for r in found} == {"k0", f"k{n - 1}"} and 5 not in {r.bucket for r in found}


def test_one_document_of_each_class_stays(spark, edge_docs):
    kept = N.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["0", "2", "3", "4", "5", "8", "9", "10", "11", "12", "None"])
    assert N.drop_near_duplicates(edge_docs.limit(0)).count() == 0


def test_samples_agree_as_often_as_weighted_jaccard():
    a, b = prose(1, 400), edited(prose(1, 400), 0.03, 5)
    x, y = N.weights(a, {}), N.weights(b, {})
    share = (N.samples(*x) == N.samples(*y)).mean()
    assert abs(share - N._jaccard(x, y)) < 0.2


def test_components_of_chains_and_stars(spark):
    links = [(f"c{i}", f"c{i + 1}") for i in range(40)] + [("hub", f"s{i}") for i in range(50)] + [("z", "z")]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert {roots[f"c{i}"] for i in range(41)} == {"c0"}
    assert {roots[f"s{i}"] for i in range(50)} | {roots["hub"]} == {"hub"}


def test_measured_recall_at_planted_similarities(spark):
    """Pairs with words of their own, at similarities just above 0.80, 0.85 and 0.90: at least 99 in 100 are joined."""
    rng, rows, planted = random.Random(9), [], {}
    for edits, n in ((4, 150), (3, 100), (2, 100)):
        for _ in range(n):
            i = len(rows)
            words = [f"w{i}x{j}" for j in range(200)]
            other = list(words)
            for k, place in enumerate(rng.sample(range(5, 195, 6), edits)):
                other[place] = f"e{i}x{k}"
            rows += [(i, " ".join(words)), (i + 1, " ".join(other))]
            planted[i] = edits
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    idf = N.frequent_words(docs)
    texts = dict(rows)
    levels = {e: [N._jaccard(N.weights(texts[i], idf), N.weights(texts[i + 1], idf)) for i in planted if planted[i] == e] for e in (4, 3, 2)}
    assert all(low <= min(levels[e]) and max(levels[e]) < low + 0.05 for e, low in ((4, 0.8), (3, 0.85), (2, 0.9)))
    keyed = docs.select("doc_id", N.text_key(F.col("text")).alias("k"))
    classes = {r.doc_id: r.class_id for r in keyed.join(N.near_duplicates(docs), "k").collect()}
    for edits, found in levels.items():
        own = [i for i in planted if planted[i] == edits]
        assert sum(classes[i + 1] == i for i in own) >= 0.99 * len(own)
    assert len(set(classes.values())) >= len(planted)


def test_sketches_equal_a_plain_computation_and_reuse_their_arrays():
    rng = np.random.default_rng(5)
    pool = [f"w{i}" for i in range(12)]
    idf = {"w0": 1.1, "w3": 1.7}
    vectors = []
    for n in (1, 4, 5, 700, 3000):
        words = [pool[i] for i in rng.integers(0, len(pool) if n < 1000 else 4, n)]
        size = min(5, n)
        grams = [tuple(words[i : i + size]) for i in range(n - size + 1)]
        shingles, weight = N.weights(" \t" + "\n".join(words), idf)
        plain = {g: k * sum(idf.get(w, 2.0) for w in g) / size for g, k in Counter(grams).items()}
        assert (np.diff(shingles.astype(object)) > 0).all() and np.allclose(sorted(weight), sorted(plain.values()))
        vectors.append((shingles, weight))
        assert (N.samples(shingles, weight) == N.samples(shingles, weight, part=7)).all()
    for x in vectors + [N.weights(None, idf)]:
        for y in vectors:
            p, q = (dict(zip(v[0].tolist(), v[1])) for v in (x, y))
            least, most = (sum(f(p.get(k, 0.0), q.get(k, 0.0)) for k in p | q) for f in (min, max))
            assert abs(N._jaccard(x, y) - least / most) < 1e-12
    shingles, weight = rng.integers(0, 1 << 63, 512, dtype=np.uint64), np.full(512, 2.0)
    N.samples(shingles, weight)
    tracemalloc.start()
    try:
        N.samples(shingles, weight)
        assert tracemalloc.get_traced_memory()[1] < 64 * 512 * 8  # less than one new array of draws
    finally:
        tracemalloc.stop()
