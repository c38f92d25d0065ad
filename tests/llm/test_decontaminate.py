import re

from pyspark.sql import functions as F
from samples import prose

from plumbline.llm import decontaminate as D


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(10, len(w))
        for s in range(len(w) - m + 1 if w else 0):
            windows.setdefault(tuple(w[s : s + m]), set()).add(item)
    out = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for m in range(1, 11):
            for s in range(len(w) - m + 1):
                if tuple(w[s : s + m]) in windows:
                    hit |= set(range(s, s + m))
                    found |= windows[tuple(w[s : s + m])]
        out.append((len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return sorted(out)


def measured(docs, items, **options):
    base, spans, found = D.contamination(docs, items, **options)
    ids = found.groupBy(*D.KEY).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    rows = D._attach(D._attach(base, D.covered(spans)), ids).collect()
    return sorted((r.n_words, r.n_hit or 0, tuple(r.ids or ())) for r in rows)


def items(spark):
    passage = prose(1, 6000).split()
    return spark.createDataFrame(
        [
            (1, " ".join(passage[500:530])),
            (2, " ".join(passage[515:540]).upper()),
            (3, "echo echo echo echo echo echo echo echo echo echo echo"),
            (4, "été 日本"),
            (5, "ÉTÉ"),
            (6, None),
            (7, "..."),
            (None, prose(2, 200)),
            (8, prose(2, 12)),
            (8, prose(2, 12)),
            (9, "zebra " * 12),
        ],
        "item_id long, text string",
    )


def test_hits_equal_brute_force_on_both_paths(spark, edge_docs, texts_of):
    bench = items(spark)
    expected = brute(texts_of(edge_docs), [(r.item_id, r.text) for r in bench.collect()])
    assert measured(edge_docs, bench) == expected
    assert measured(edge_docs, bench, broadcast_rows=0) == expected


def test_empty_tables(spark, edge_docs):
    bench = items(spark)
    assert all(h == 0 for _, h, _ in measured(edge_docs, bench.limit(0)))
    assert measured(edge_docs.limit(0), bench) == []


def test_clean_documents_stay_with_their_columns(spark, edge_docs):
    bench = items(spark).where("item_id in (1, 9)")
    kept = D.decontaminate(edge_docs, bench)
    assert kept.columns == edge_docs.columns
    assert kept.count() == edge_docs.count() - 1 and kept.where("doc_id = 4").count() == 0


def test_words_are_those_of_the_pattern_without_extracting_each_match(spark):
    texts = [None, "", " ", "...", "A", " a", "a ", "-a-", "a\x00b\x7fc", "\u00c9T\u00c9 \u65e5\u672c, X\u0130", "\U0001f600b\n\n\u00a0C", "x" * 5000, "A1 b2\t" * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", D.item_words(F.col("text")).alias("w"))
    assert {r.i: r.w for r in df.collect()} == {i: words(t) for i, t in enumerate(texts)}
    assert "regexp_extract_all" not in df._jdf.queryExecution().optimizedPlan().toString()
