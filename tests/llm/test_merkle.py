import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import merkle
from plumbline.llm.merkle import op12_merkle_manifest

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(rows):
    """The contract in plain Python: rows (doc_id, source, lang, n_chars, text) to sorted results."""
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    trees = {}
    for doc, source, lang, n, body in rows:
        leaf = H(*map(text, (doc, source, lang, n, body)))
        changed = leaf
        if doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and n is not None:
            changed = H(*map(text, (doc, source, lang, n + 1, body)))
        trees.setdefault(lang, []).append((doc is not None, doc or 0, leaf, changed, doc))

    def climb(level):
        """(top, per start node its steps (sibling, on the left))."""
        paths, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for path, place in zip(paths, at):
                if (place ^ 1) < len(level):
                    path.append((level[place ^ 1], place % 2 == 1))
                else:
                    path.append(None)
            at = [place // 2 for place in at]
            level = [H(*level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0], paths

    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    lower = {}
    for lang in order:
        trees[lang].sort()
        lower[lang] = climb([x[2] for x in trees[lang]])
    root, upper = climb([lower[k][0] for k in order]) if order else (None, [])
    out = []
    for lang, more in zip(order, upper):
        top, paths = lower[lang]
        for (_, _, leaf, changed, doc), path in zip(trees[lang], paths):
            own = changed
            for step in [*path, *more]:
                own = H(own) if step is None else H(step[0], own) if step[1] else H(own, step[0])
            proof = H(*[s[0] for s in [*path, *more] if s])
            out.append((doc, leaf, top, root, proof, own, own == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [6, 1])
def test_equals_plain_python(spark, edge_docs, tmp_path, bits, monkeypatch):
    monkeypatch.setattr(merkle, "BITS", bits)
    base = edge_docs.withColumn("n_chars", F.length("text").cast("long"))
    many = spark.range(100, 100 + 333).select(
        F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 300).alias("doc_id"),
        F.concat(F.lit("é"), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 > 0, F.lit("en")).when(F.col("id") % 30 == 0, F.lit("日本")).otherwise(F.lit("z")).alias("lang"),
        F.lit("s").alias("source"),
        F.when(F.col("id") % 4 > 0, F.col("id")).alias("n_chars"),
    )
    docs = base.unionByName(many, allowMissingColumns=True).withColumns({c: F.lit("clash") for c in ("tree", "h", "pos", "level", "size")}).cache()
    got = sorted([tuple(r) for r in op12_merkle_manifest(lambda name: docs).collect()], key=str)
    want = plain([tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    assert got == want
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_small_and_empty_tables(spark, edge_docs):
    docs = edge_docs.withColumn("n_chars", F.lit(None).cast("long"))
    one = docs.where("doc_id = 5")
    got = [tuple(r) for r in op12_merkle_manifest(lambda name: one).collect()]
    assert got == plain([tuple(r) for r in one.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == H("")
    assert op12_merkle_manifest(lambda name: docs.limit(0)).count() == 0
