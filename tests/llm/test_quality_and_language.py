import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F
from samples import prose

from plumbline.llm import langid as L, quality as Q, rules as R

FR = "le la les une des pour avec dans maison fenêtre jardin lettre marché hiver été soirée rivière pierre pont".split()


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def corpus(spark, n=160):
    rows = []
    for i in range(n):
        good = i % 3 > 0
        text = prose(i, 90 + i % 40) if good else " ".join(w.upper() + "!!###" for w in prose(i, 80).split())
        rows.append((i, text, "en" if i % 2 else "fr", int(good)))
        if i % 2 == 0:
            rows[-1] = (i, prose(i, 90 + i % 40, FR) if good else rows[-1][1], "fr" if good else None, int(good))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    return df.select("doc_id", "text", "lang"), df.select("doc_id", "quality")


def test_quality_on_held_out_rows(spark):
    docs, labels = corpus(spark)
    out = Q.op4_quality_classifier({"documents": docs, "labels": labels}.get).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (out["held_out"] == out["doc_id"].map(held)).all() and out["held_out"].any()
    tested = out[out["held_out"]]
    assert (tested["predicted"] == tested["quality"]).mean() > 0.95
    assert out["score"].between(0, 1).all()


def test_quality_edges(spark, edge_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.learn(edge_docs, labels)
    scored = Q.with_quality(edge_docs, model, column="new_score")
    assert scored.columns == [*edge_docs.columns, "new_score"]
    assert {r.new_score for r in scored.collect()} == {1.0}
    some = spark.createDataFrame([(4, 1), (4, 0), (10, 0), (5, 1), (7, None), (3, 0), (8, 1)], "doc_id long, quality int")
    fitted = Q.with_quality(edge_docs, Q.learn(edge_docs, some), column="s").select("s").collect()
    assert all(0 <= r.s <= 1 for r in fitted) and len(fitted) == edge_docs.count()
    assert Q.with_quality(edge_docs.limit(0), model).count() == 0


def test_rules_are_learned_and_base_counts_are_exact(spark, edge_docs, texts_of):
    docs, labels = corpus(spark)
    out = R.op5_quality_rules({"documents": docs, "labels": labels}.get).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (out["kept"] == (out["quality"] == 1)).mean() > 0.97
    stats = R.text_statistics(edge_docs)
    assert stats.count() == edge_docs.count() and stats.where("label = 'clash' and n_words is not null").count() == edge_docs.count()
    judged, rules = R.judge(stats, labels.limit(0))
    assert rules == [] and judged.where("kept = base_failed").count() == 0
    assert R.judge(stats.limit(0), labels)[0].count() == 0


def brute_counts(text):
    import collections
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def test_text_statistics_equal_brute_force(spark):
    texts = [None, "", "a", "a b c a b c", "x\nx\n\n \n y\n x\nx", "é日😀 #1 <b>|$%&*  z q", "q " * 500, "a b c d " * 40 + "a b", "t\tt\x0bt\x0ct\rt t t"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in R.text_statistics(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(texts[r.doc_id]), texts[r.doc_id]


def test_language_on_held_out_rows(spark):
    docs, _ = corpus(spark, 240)
    out = L.op9_language_id({"documents": docs}.get).toPandas().merge(docs.toPandas(), on="doc_id")
    tested = out[out["held_out"] & out["lang"].notna()]
    assert len(tested) > 20 and (tested["lang_pred"] == tested["lang"]).mean() > 0.95
    assert out["score"].between(0, 1).all()


def test_language_edges(spark, edge_docs):
    models = L.learn(edge_docs)
    got = L.with_language(edge_docs, models).select("doc_id", "text", "language.*").collect()
    for r in got:
        assert (r.lang == "und") == (r.text is None or not any(c.isalpha() for c in r.text)), r
        assert r.score >= 0 and (r.lang != "und" or (r.score == 0 and r.rejected))
    nothing = L.learn(edge_docs.limit(0))
    assert {r.lang for r in L.with_language(edge_docs, nothing).select("language.lang").collect()} == {"und"}
    assert L.with_language(edge_docs.limit(0), models).count() == 0


def test_kneser_ney_by_hand():
    """Probabilities of a tiny model, written out by the interpolated formula."""
    import collections
    import math

    import numpy as np
    import pyarrow as pa

    words = ["abab", "abba", "ab"]
    packed, _ = L.grams(pa.array(words))
    keys, counts = np.unique(packed, return_counts=True)
    model = L.LanguageModels(pd.DataFrame({"lang": "x", "gram": keys, "n": counts}))
    tuples = [tuple(g >> L.BITS * k & 4095 for k in reversed(range(L.ORDER))) for g in packed.tolist()]
    tables = {L.ORDER: collections.Counter(tuples)}
    for order in range(L.ORDER - 1, 0, -1):
        tables[order] = collections.Counter(g[1:] for g in tables[order + 1])

    def p(gram):
        if not gram:
            return 2.0**-L.BITS
        own = {g: n for g, n in tables[len(gram)].items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        total = sum(own.values())
        return max(own.get(gram, 0) - L.DISCOUNT, 0) / total + L.DISCOUNT * len(own) / total * p(gram[1:])

    asked, _ = L.grams(pa.array(["abc", "bab", "ab", "zz"]))
    for g, value in zip(asked.tolist(), model.log_probability(asked, 0)):
        gram = tuple(g >> L.BITS * k & 4095 for k in reversed(range(L.ORDER)))
        assert value == pytest.approx(math.log2(p(gram)), rel=1e-5)


def test_crc_split_matches_python(spark):
    rows = spark.range(50).select("id", Q.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == held(r.id) for r in rows)


def test_stored_models_keep_every_gram(spark):
    """A gram seen once among many, and tables cut in many ranges, give the probabilities of the whole counts."""
    import numpy as np
    import pyarrow as pa

    docs = spark.createDataFrame([(0, "abab abba " * 20_000, "x"), (1, "qrstu", "x"), (2, "vwxyz", "y")], "doc_id long, text string, lang string")
    counted = L.count_grams(docs)
    whole = L.LanguageModels(counted.toPandas())
    asked, _ = L.grams(pa.array(["abab", "qrstu", "vwxyz", "qrab", "zz", "日本"]))
    for models in (L.learn(docs), L.LanguageModels.at(L.stored(L.kneser_ney(counted), limit=3))):
        assert models.names == whole.names == ["x", "y"]
        for m in range(2):
            assert np.allclose(models.log_probability(asked, m), whole.log_probability(asked, m), rtol=1e-12)


def test_rejection_is_calibrated_on_texts_not_learned(spark):
    """Held-out rows are rejected no more often than training rows, beyond sampling error; other languages are."""
    rows = [(i, prose(i, 60 + i % 50), "en") for i in range(300)] + [(1000 + i, prose(i, 60, FR), "fr") for i in range(100)] + [(2000, "rara avis in terris nigroque simillima cycno", "la")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = L.op9_language_id({"documents": docs}.get).toPandas()
    tested, learned = out[out["held_out"]], out[~out["held_out"]]
    assert len(tested) > 60 and tested["rejected"].mean() <= learned["rejected"].mean() + 3 * (0.01 / len(tested)) ** 0.5
    models = L.learn(docs.where("lang <> 'la'"))
    foreign = spark.createDataFrame([(0, "zxq vvkk wqjx " * 20), (1, "щука и рак " * 20), (2, prose(900, 80))], "doc_id long, text string")
    assert [r.language.rejected for r in L.with_language(foreign, models).orderBy("doc_id").collect()] == [True, True, False]
    assert set(L.learn(docs).typical) == {"en", "fr", "la"}  # one text of a language: it takes what holds for all


def test_no_two_characters_share_codes():
    import numpy as np
    import pyarrow as pa

    words = ["a", "\u077f", "\u0780", "日", "本", "語", "한", "국", "\U0010ffff", "😀", "日本", "é日", "日é", "a日b本"]
    packed, sizes = L.grams(pa.array(words))
    assert sizes.tolist() == [2, 2, 3, 3, 3, 3, 3, 3, 3, 3, 5, 4, 4, 7]
    ends = np.cumsum(sizes)
    codes = [tuple(int(g) & 4095 for g in packed[end - n : end]) for n, end in zip(sizes, ends)]
    assert len(set(codes)) == len(words) and all(c[-1] == 0 and 0 not in c[:-1] for c in codes)
    wide = np.arange(0x780, 0x110000)
    high, low = L.HIGH + (wide >> L.LOW_BITS), L.LOW + (wide & 1023)
    assert high.min() >= L.NARROW and high.max() < L.LOW <= low.min() and low.max() < 1 << L.BITS
    assert len(np.unique(high << 12 | low)) == len(wide)


def test_languages_of_wide_characters(spark):
    import random

    rng = random.Random(1)
    ja, ko = "日本語文章言葉山川田中東京大阪新聞電車学校先生", "한국어문장말산강서울부산신문기차학교선생님사람"
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(3)) for _ in range(40))
    rows = [(i, make(ja if i % 2 else ko), "ja" if i % 2 else "ko") for i in range(80)]
    out = L.op9_language_id({"documents": spark.createDataFrame(rows, "doc_id long, text string, lang string")}.get).collect()
    assert all(r.lang_pred == rows[r.doc_id][2] for r in out if r.held_out)


def test_repeated_windows_do_not_depend_on_hash_bits(spark):
    """With four or two hash bits nearly all windows clash; the words decide."""
    from samples import prose

    texts = [None, "", "a b c", "a b c a b c", "a b c d " * 10 + "a b", prose(1, 300), prose(2, 100) + " " + prose(3, 50) + " " + prose(2, 100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for bits in (60, 62):
        for r in R.text_statistics(docs, place_bits=bits).collect():
            assert r.n_repeat_words == brute_counts(texts[r.doc_id])[4], (bits, texts[r.doc_id])


def test_filters_do_not_repeat_the_statistics(spark):
    """A filter on a count stays above the statistics instead of repeating their expressions."""
    docs = spark.createDataFrame([(0, prose(1, 6000)), (1, "a b")], "doc_id long, text string")
    plan = R.text_statistics(docs).where(~R.base_failed()).where("n_lines > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 4 and len(plan) < 20_000
    assert R.text_statistics(docs).where(~R.base_failed()).count() == 1


def plain_rules(rows, candidates=40, max_rules=10, max_terms=3, precision=0.9, support=5):
    """Sequential covering in plain Python over rows (key, counts, label); thresholds as in the operator."""
    import math

    names = list(R.RATIOS)
    value = lambda c, n: float(c[R.RATIOS[n][0]]) if R.RATIOS[n][1] is None else c[R.RATIOS[n][0]] / c[R.RATIOS[n][1]] if c[R.RATIOS[n][1]] else 0.0
    data = [([value(c, n) for n in names], label == 0, zlib.crc32(str(key).encode()) % 3 == 0) for key, c, label in rows]
    shares = [i / candidates for i in range(1, candidates)]
    cuts = []
    for i in range(len(names)):
        found = set()
        for some in (data, [d for d in data if d[1]]):
            own = sorted(d[0][i] for d in some)
            found |= {own[max(0, math.ceil(s * len(own) - 1e-9) - 1)] for s in shares} if own else set()
        cuts.append(sorted(found))
    holds = lambda d, rule: all((d[0][i] > t) == above for i, above, t in rule)
    tally = lambda some: (sum(d[1] for d in some), sum(not d[1] for d in some))
    rules, rest = [], data
    while len(rules) < max_rules:
        rule, grown = [], [d for d in rest if not d[2]]
        while len(rule) < max_terms:
            own = [d for d in grown if holds(d, rule)]
            p0, n0 = tally(own)
            best, gain = None, 1e-9
            for i in range(len(names)) if p0 and n0 else ():
                for t in cuts[i]:
                    for above in (True, False):
                        p, n = tally([d for d in own if (d[0][i] > t) == above])
                        if p and p + n < p0 + n0 and (g := p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))) > gain:
                            best, gain = (i, above, t), g
            if best is None:
                break
            rule.append(best)
        scored = []
        for k in range(1, len(rule) + 1):
            p, n = tally([d for d in rest if d[2] and holds(d, rule[:k])])
            if p + n:
                scored.append(((p - n) / (p + n), -k, k, p, n))
        if not scored or (best := max(scored))[3] < support or best[3] / (best[3] + best[4]) < precision:
            break
        rule = rule[: best[2]]
        moved = []
        for i, above, t in rule:
            outside = [d[0][i] for d in rest if (d[0][i] > t) != above]
            inside = [d[0][i] for d in rest if (d[0][i] > t) == above and d[1]]
            edge = (max if above else min, min if above else max)
            moved.append((names[i], above, (edge[0](outside) + edge[1](inside)) / 2 if outside and inside else t))
        rules.append(moved)
        rest = [d for d in rest if not holds(d, rule)]
    return rules


def test_learned_rules_equal_plain_covering(spark):
    import random

    rng = random.Random(5)
    rows = []
    for i in range(400):
        words = rng.randrange(100, 140)
        bad = rng.random() < 0.3
        counts = dict(n_words=words, word_chars=words * 5, n_symbols=rng.randrange(60, 90) if bad and i % 2 else rng.randrange(30), n_dup_lines=0, n_repeat_words=rng.randrange(60), n_lines=9)
        counts |= dict(n_upper=rng.randrange(200, 400) if bad and i % 2 == 0 else rng.randrange(100), n_marks=rng.randrange(9), n_distinct=rng.randrange(20, words))
        rows.append((i, counts, int(not bad) if rng.random() < 0.99 else 1))
    table = spark.createDataFrame([(k, *[c[n] for n in R.COUNTS], y) for k, c, y in rows], "doc_id long, " + ", ".join(f"{n} long" for n in R.COUNTS) + ", label int")
    learned = [[(t.name, t.above, pytest.approx(t.threshold)) for t in rule] for rule in R.learn_rules(table)]
    assert learned and learned == plain_rules(rows)


def test_quality_scores_equal_a_plain_discriminant(spark):
    """Means, covariances, shrinkage, densities and the calibrated cut, written out in numpy on the same rows."""
    import numpy as np

    docs, labels = corpus(spark)
    texts, known = ({r[0]: r[1] for r in df.collect()} for df in (docs, labels))
    x = {i: np.array(Q.statistics(t)) for i, t in texts.items()}
    taught = [i for i in texts if not held(i)]
    own = [np.array([x[i] for i in taught if known[i] == c]) for c in (0, 1)]
    every = np.vstack(own)
    center, scale = every.mean(0), np.sqrt(np.maximum((every**2).mean(0) - every.mean(0) ** 2, 1e-9))
    parts = []
    for rows in own:
        z = (rows - center) / scale
        cov = np.cov(z.T, bias=True)
        cov = 0.9 * cov + 0.1 * max(np.trace(cov) / len(cov), 1e-3) * np.eye(len(cov))
        parts.append((z.mean(0), np.linalg.inv(cov), np.log(len(rows) / len(every)) - 0.5 * np.linalg.slogdet(cov)[1]))

    def evidence(v):
        z = (v - center) / scale
        logs = [const - 0.5 * (z - mean) @ inverse @ (z - mean) for mean, inverse, const in parts]
        return np.arcsinh(logs[1] - logs[0])

    steps = {i: np.floor(evidence(x[i]) / Q.STEP) for i in taught}
    edges = sorted(set(steps.values()))
    edges.append(edges[-1] + 1)
    wrong = [sum((known[i] == 1 and steps[i] < e) or (known[i] == 0 and steps[i] >= e) for i in taught) for e in edges]
    best = int(np.argmin(wrong))
    below = edges[best - 1] + 1 if best else edges[0]
    offset = np.log(Q.KEEP / (1 - Q.KEEP)) - Q.STEP * (below + edges[best]) / 2
    for r in Q.op4_quality_classifier({"documents": docs, "labels": labels}.get).collect():
        assert r.score == pytest.approx(1 / (1 + np.exp(-evidence(x[r.doc_id]) - offset)), abs=1e-6)
        assert r.predicted == int(r.score >= 0.7)


def test_equal_texts_have_equal_scores(spark):
    docs, labels = corpus(spark, 60)
    twice = docs.unionByName(docs.withColumn("doc_id", docs.doc_id + 10_000))
    scores = {}
    for r in Q.with_quality(twice, Q.learn(docs, labels)).collect():
        assert scores.setdefault(r.text, r.score) == r.score
