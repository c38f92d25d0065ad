import zlib

import numpy as np
import pytest

from plumbline.llm import packing as P

pytest.importorskip("public_tokenizers")


def test_pieces_equal_the_tokenizer_and_places_have_no_gaps(spark, edge_docs, texts_of):
    from tokenizers import Tokenizer

    out = P.packed_documents(edge_docs, P.tokenizer_path(), block_rows=4).toPandas()
    full = Tokenizer.from_file(P.tokenizer_path())
    expected = []
    for doc, text in texts_of(edge_docs):
        ids = np.array(full.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for n, at in enumerate(range(0, len(ids), 4096)):
            piece = ids[at : at + 4096]
            expected.append((-1 if doc is None else doc, n, at, len(piece), zlib.crc32(piece.tobytes())))
    got = out.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]].astype("int64")
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(expected)
    for _, own in out.sort_values("offset").groupby("sequence_id"):
        assert own["length"].sum() <= 4096
        assert (own["offset"] == own["length"].cumsum() - own["length"]).all()
    assert P.packed_documents(edge_docs.limit(0), P.tokenizer_path()).count() == 0


def test_words_one_by_one_equal_whole_texts():
    from tokenizers import Tokenizer

    full, ids = Tokenizer.from_file(P.tokenizer_path()), P.word_ids(P.tokenizer_path())
    texts = [
        "It's the dogs' 'tis we'll\tgo\r\n x2y3 A.B, (c)", "ÀÉîœ Œuvre İstanbul ΣΑΣ Straße ẞ K Å", "áb ́x", "日本語 😀😀",
        "<|endoftext|> a<|startoftext|>b", "x y z\x1cq\x85", "~!@#$%^&*()_+`-={}[]|\\:\";'<>?,./", "don't'S'RE",
    ]
    for text in texts:
        assert np.frombuffer(ids.encode(text), "<u4").tolist() == full.encode(text, add_special_tokens=False).ids, text


def check(packing, lengths, capacity=4096):
    number, loads = packing
    assert number.min() == 0 and len(np.unique(number)) == len(loads)
    assert np.bincount(number, lengths).tolist() == loads and max(loads) <= capacity


def test_evolution_keeps_every_piece():
    rng = np.random.default_rng(0)
    lengths = rng.integers(200, 2300, 300)
    start = P.best_fit(rng.permutation(300), lengths, 4096)
    best = P.evolve(lengths, [], 4096, rng, 4, 40)
    again = P.evolve(lengths, [best, start], 4096, rng, 4, 5)
    for packing in (start, best, again, P._cross(best, start, lengths, 4096, rng), P._mutate(start, lengths, 4096, rng)):
        check(packing, lengths)
    assert len(again[1]) <= len(best[1]) < len(start[1])


def test_islands_reach_fewer_bins_than_best_fit_decreasing():
    """Triplets that fill bins exactly: best-fit-decreasing misses the bound by more than evolution does."""
    for seed in range(5):
        rng = np.random.default_rng(seed)
        pairs = rng.integers(900, 1900, (40, 2))
        lengths = rng.permutation(np.hstack([pairs, 4096 - pairs.sum(1, keepdims=True)]).ravel())
        plain = P.best_fit(np.argsort(-lengths, kind="stable"), lengths, 4096)
        best = P.evolve(lengths, [], 4096, rng, 6, 400)
        check(best, lengths)
        assert 40 <= len(best[1]) < len(plain[1])
        assert len(P.settled(best, lengths, 4096)[1]) == len(best[1])


def test_blocks_lose_less_than_a_sequence_each(spark):
    from pyspark.sql import functions as F

    pieces = spark.range(3000).select(F.col("id").alias("row"), (F.pmod(F.xxhash64("id"), F.lit(1500)) + 1).alias("length")).cache()
    bound = -(-pieces.agg(F.sum("length")).first()[0] // 4096)
    for block_rows in (4000, 300):
        out = P.pack(pieces, block_rows=block_rows)
        made = out.select("sequence_id").distinct().count()
        assert out.count() == 3000 and bound <= made <= bound + 3000 // block_rows + 1
