import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from samples import prose

from plumbline.llm import substrings as S, tokencount as K, warc as Wc

# --- WARC ---------------------------------------------------------------------------


def pages(spark):
    rows = [(i, f"http://x.example/{i}\n", f"<p>{prose(i % 7, 50)}é</p>") for i in range(60)]
    rows += [(60, None, None), (61, "u", ""), (None, "u", ""), (62, "u", "same"), (62, "u", "same"), (63, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "u", "only null")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("chosen", F.lit("clash")).withColumn("k", F.lit(0))


def expected(rows):
    groups = {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for raw, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        sha1 = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out += [(i, len(raw), sha1, "response" if best is None or i == best else "revisit", None if best is None or i == best else best) for i in ids]
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    table = pages(spark)
    rows = [tuple(r) for r in table.select("page_id", "url", "html").collect()]
    got = sorted(map(tuple, Wc.op3_warc_bundles(lambda name: table).collect()), key=str)
    assert got == expected(rows)
    assert Wc.op3_warc_bundles(lambda name: table.limit(0)).count() == 0


def test_seek_table_index_and_single_reads(spark):
    table = pages(spark).where("page_id is not null").dropDuplicates(["page_id"])
    index = Wc.write_bundles(table, frame_bytes=700, bundle_bytes=3000)
    assert index.select("bundle").distinct().count() > 1 and index.agg(F.max("frame")).first()[0] > 1
    asked = index.where("page_id % 5 = 0")
    bodies = {r.page_id: r.html or "" for r in table.collect()}
    got = {r.record_id: r.payload for r in Wc.fetch(asked).collect()}
    for r in asked.collect():
        payload = got[r.record_id]
        assert payload is None if r.record_type == "revisit" else bytes(payload) == bodies[r.page_id].encode()
    reader = Wc.Reader(index.first().bundle)
    assert sum(p for p, _ in reader.sizes) + 8 + 8 * len(reader) + 9 == reader.file.size()


# --- token counts ---------------------------------------------------------------------


@pytest.mark.parametrize("fallback", [True, False])
def test_counts_equal_the_unigram_tokenizer(fallback):
    tokenizers = pytest.importorskip("tokenizers")
    pytest.importorskip("public_tokenizers")
    pieces = K.vocabulary(K.vocabulary_path())
    if not fallback:
        pieces = [(p, s) for p, s in pieces if not p.startswith("<0x")]
    full = tokenizers.Tokenizer(tokenizers.models.Unigram(pieces, unk_id=0, byte_fallback=fallback))
    full.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement=K.MARK, prepend_scheme="always", split=True)
    own, rng = K.Counter(pieces), random.Random(3)
    texts = ["", " ", "  a", " a  b ", "a ▁b", "▁▁", "日本語 テスト", "😀😀 x", "<0x41> a", "\n\n a\tb", "a" * 500, "</s>", prose(1, 200)]
    texts += ["".join(rng.choice("ab ▁é日\n<0x41>the") for _ in range(30)) for _ in range(500)]
    for text in texts:
        assert own.tokens(text) == len(full.encode(text, add_special_tokens=False).ids), text


def test_ties_go_to_the_longest_piece():
    tokenizers = pytest.importorskip("tokenizers")
    pieces = [("<unk>", 0.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.0), ("ab", -2.0), ("▁", 0.0), ("▁a", -1.0)]
    full = tokenizers.Tokenizer(tokenizers.models.Unigram(pieces, unk_id=0))
    full.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement=K.MARK, prepend_scheme="always", split=True)
    own, rng = K.Counter(pieces), random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice("aaabc ") for _ in range(rng.randrange(12)))
        assert own.tokens(text) == len(full.encode(text, add_special_tokens=False).ids), text


def test_token_count_column(spark, edge_docs):
    pytest.importorskip("public_tokenizers")
    out = K.with_token_count(edge_docs, K.vocabulary_path())
    assert out.count() == edge_docs.count() and out.where("text is null or text = ''").agg(F.max("n_tokens")).first()[0] == 0
    assert K.with_token_count(edge_docs.limit(0), K.vocabulary_path()).count() == 0


# --- repeated passages ------------------------------------------------------------------


def brute(docs, span=20):
    import re

    texts = [(S.LAST_ID if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, w in texts:
        for s in range(len(w) - span + 1):
            key = tuple(w[s : s + span])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for (i, w), (doc, _) in zip(texts, docs):
        gone = set()
        for s in range(len(w) - span + 1):
            if (i, s) > first[tuple(w[s : s + span])]:
                gone |= set(range(s, s + span))
        out.append((doc, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [S.HOT, 1])
def test_passages_equal_brute_force(spark, edge_docs, texts_of, hot):
    got = sorted(map(tuple, S.remove_repeated_passages(edge_docs, hot=hot).collect()), key=str)
    assert got == brute(texts_of(edge_docs))


def test_windows_of_equal_hash_are_compared_by_their_words(monkeypatch):
    """With four hash values nearly all windows clash; the words decide which are equal."""
    import numpy as np
    import pyarrow as pa

    rng, whole = random.Random(3), S.span_hashes
    texts = [" ".join(rng.choice("abc") for _ in range(60)) for _ in range(30)]
    monkeypatch.setattr(S, "span_hashes", lambda codes, span: whole(codes, span) & np.uint64(3))
    ids, hashes, begin, row, inside = S._windows(pa.table({"packed": texts}), 4)
    order, head = S._first_of_each(ids, (inside, row, hashes, np.zeros(len(row), np.int64)), begin, 4)
    words = [tuple(texts[r].split()[i : i + 4]) for r, i in zip(row, inside)]
    first = {}
    for i in sorted(range(len(words)), key=lambda i: (row[i], inside[i])):
        first.setdefault(words[i], i)
    assert {i: h for i, h in zip(order.tolist(), head.tolist())} == {i: first[w] for i, w in enumerate(words)}


def test_groups_are_worked_through_in_bounded_parts():
    import numpy as np

    assert S._parts([0, 2, 3, 7], np.array([4, 4, 9, 1, 1, 1, 1]), 10) == [(0, 2), (2, 3), (3, 7)]
    assert S._parts([0, 2, 3, 7], np.array([4, 4, 1, 1, 1, 1, 1]), 100) == [(0, 7)]
    assert S._parts([0, 5], np.full(5, 99), 10) == [(0, 5)]


def test_largest_id_and_null_id(spark):
    text = prose(5, 50)
    rows = [(S.LAST_ID, text), (None, text), (3, text), (None, "short"), (S.LAST_ID, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, S.remove_repeated_passages(docs).collect()), key=str)
    assert got == brute(rows)


def test_passages_shared_shifted_and_periodic(spark):
    shared = prose(900, 60).split()
    rows = [(i, prose(i, 30) + " " + " ".join(shared[i % 7 : 60 - i % 5]) + "  " + prose(1000 + i, 25)) for i in range(40)]
    rows += [(100 + i, "one two three four five six seven " * (3 + i)) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, S.remove_repeated_passages(docs).collect()), key=str)
    assert got == brute(rows)
    assert S.remove_repeated_passages(docs.limit(0)).count() == 0
