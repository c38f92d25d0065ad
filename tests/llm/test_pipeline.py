"""The five stages beside plain Python on a small corpus."""

import zlib

import numpy as np
import pytest
from samples import prose
from test_decontaminate import words
from test_neardup import edited
from test_secrets import HEX

import corpus_pipeline as CP
from plumbline.llm import neardup as N, quality as Q

pytest.importorskip("public_tokenizers")


SECRET = f"token = {HEX}zz"


def write_tables(spark, folder):
    rows = []
    for i in range(60):
        text = prose(i, 90) + (f" {SECRET} x" if i % 3 == 1 else "") if i % 4 else " ".join(w.upper() + "!!###" for w in prose(i, 80).split())
        rows.append((i, text, "en", "s0", len(text)))
    rows += [(60 + i, edited(prose(5, 90), 0.002 * i, i), "en", "s1", 1) for i in range(6)]
    rows += [(70, rows[7][1], "en", "s1", 1), (71, prose(300, 60) + f" {SECRET} " + prose(301, 30), "en", "s1", 1)]
    rows += [(72, prose(302, 40) + " " + prose(900, 15) + " " + prose(303, 40), "en", "s1", 1), (73, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 4 > 0), 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    items = [(0, prose(900, 15)), (1, prose(901, 15))]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    return items


def windows(text):
    w = words(text)
    return {tuple(w[s : s + 10]) for s in range(len(w) - 9)}


def test_stages_and_run_equal_plain_python(spark, tmp_path):
    from tokenizers import Tokenizer

    from plumbline.llm.packing import tokenizer_path

    folder = str(tmp_path)
    items = write_tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}

    model = Q.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = {i for i, t in texts.items() if model.score(np.array([Q.statistics(t or "")]))[0] >= Q.KEEP}
    assert {i for i in range(60) if i % 4} <= good and not {i for i in range(60) if i % 4 == 0} & good

    idf = N.frequent_words(docs.where(docs.doc_id.isin(*good)))
    vectors = {i: N.weights(texts[i], idf) for i in good}
    parent = {i: i for i in good}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in good:
        for j in good:
            if i > j and ((texts[i] or "") == (texts[j] or "") or N._jaccard(vectors[i], vectors[j]) >= N.THRESHOLD):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    single = {i for i in good if find(i) == i}
    assert 70 not in single and len({60, 61, 62, 63, 64, 65} & single) < 6

    leaked = {w for _, t in items for w in windows(t)}
    clean = {i for i in single if not windows(texts[i] or "") & leaked}
    assert 72 not in clean

    stages = docs
    for _, work in CP.STAGES[:-1]:
        stages = work(spark, stages, folder)
        assert stages.columns == docs.columns
    final = {r.doc_id: r for r in stages.collect()}
    assert set(final) == clean
    redacted = {i: texts[i] and texts[i].replace(SECRET, "[secret]") for i in clean}
    assert {i: r.text for i, r in final.items()} == redacted
    assert 71 in redacted and final[71].n_chars == len(redacted[71])

    full = Tokenizer.from_file(tokenizer_path())
    expected = []
    for i, t in redacted.items():
        ids = np.array(full.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        expected.append((i, 0, 0, len(ids), zlib.crc32(ids.tobytes())))
    packed = CP.run(spark, folder).toPandas()
    got = packed[["doc_id", "piece", "start", "length", "ids_crc32"]].astype("int64").to_numpy().tolist()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096
    assert packed["sequence_id"].nunique() == -(-packed["length"].sum() // 4096)
