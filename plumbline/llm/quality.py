"""Quality classifier: a regularised quadratic discriminant over document statistics.

Every whole text gives a vector of transformed statistics (lengths, shares of letter
kinds, repetition). Per class the cluster sums the moments of the labelled rows; the
driver gets one mean vector and one matrix per class, shrinks the covariance towards a
multiple of the identity, and keeps its Cholesky factor. A text's score is the logistic
of the asinh-compressed log-density difference (Mahalanobis terms, log determinants and
class shares), so it keeps its order where a plain logistic would round to 0 or 1.

Edge cases: a null text counts as empty and is scored; several labels of a document
count by their largest; without labels of both classes the score is the share of label 1
(1 without any label, so that nothing is rejected unlearned). Repeated rows are scored
alike; extra columns pass through `with_quality`.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.catalogue import query
from plumbline.session import stage

KEEP = 0.7
STEP = 0.1
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#*$%&|<>{}[]=~^\\_@"
MARKS = b"!?.,;:"
STATISTICS = (
    "log_words log_mean_word log_mean_line upper letters digits symbols marks "
    "top_word distinct repeated_lines repeated_triples bare_words shouts doubled_words"
).split()


def statistics(text: str) -> list[float]:
    """Transformed statistics of one text; shares enter as square roots."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    raw = text.encode("utf-8", "surrogatepass")
    size = len(raw)
    share = lambda chars: (size - len(raw.translate(None, chars))) / size
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    triples = max(1, n - 2)
    values = (
        np.log(n + 20),
        np.log(size / n + 2),
        np.log(size / len(lines) + 20),
        share(UPPER) ** 0.5,
        share(LETTERS) ** 0.5,
        share(DIGITS) ** 0.5,
        share(SYMBOLS) ** 0.5,
        share(MARKS) ** 0.5,
        (max(counts.values()) / n) ** 0.5,
        np.log(len(counts) + 9) / np.log(n + 9),
        ((len(lines) - len(set(lines))) / len(lines)) ** 0.5,
        (1 - len(set(zip(words, words[1:], words[2:]))) / triples if n > 2 else 0.0) ** 0.5,
        (sum(not w.strip("#*$%&|<>!?.,;:-_=") for w in counts) / len(counts)) ** 0.5,
        (raw.count(b"!") / n) ** 0.5,
        (sum(map(eq, words, words[1:])) / n) ** 0.5,
    )
    return [float(v) for v in values]


def vectors(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t or "") for t in texts]).reshape(len(texts), len(STATISTICS))


class Discriminant:
    """Means, Cholesky factors and log shares of the two classes."""

    def __init__(self, count, total, product, shrinkage: float):
        self.share = count[1] / max(1, count.sum()) if count.sum() else 1.0
        self.ready, self.offset = bool((count > 1).all()), 0.0
        if not self.ready:
            return
        pooled = total.sum(0) / count.sum()
        spread = np.sqrt(np.maximum(np.diag(product.sum(0)) / count.sum() - pooled**2, 1e-9))
        self.center, self.scale, self.classes = pooled, spread, []
        d = len(pooled)
        for c in (0, 1):
            mean = total[c] / count[c]
            cov = (product[c] / count[c] - np.outer(mean, mean)) / np.outer(spread, spread)
            cov = (1 - shrinkage) * cov + shrinkage * max(np.trace(cov) / d, 1e-3) * np.eye(d)
            factor = np.linalg.cholesky(cov)
            constant = np.log(count[c] / count.sum()) - np.log(np.diag(factor)).sum()
            self.classes.append(((mean - pooled) / spread, np.linalg.inv(factor), constant))

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Compressed log-density difference of the classes."""
        z = (x - self.center) / self.scale
        logs = [const - 0.5 * (((z - mean) @ inverse.T) ** 2).sum(1) for mean, inverse, const in self.classes]
        return np.arcsinh(logs[1] - logs[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.ready:
            return np.full(len(x), float(self.share))
        return 1 / (1 + np.exp(-self.evidence(x) - self.offset))

    def calibrate(self, steps: np.ndarray, good: np.ndarray, bad: np.ndarray, width: float) -> None:
        """Shift scores so that `KEEP` is where the fewest labelled rows are on the wrong side.

        `good` and `bad` count the rows whose evidence lies in step x width and above, up to the next.
        """
        order = np.argsort(steps)
        edges = np.append(steps[order], steps.max() + 1)
        wrong = np.append(0, np.cumsum(good[order])) + np.append(np.cumsum(bad[order][::-1])[::-1], 0)
        best = np.flatnonzero(wrong == wrong.min())[0]
        below = edges[best - 1] + 1 if best else edges[0]
        self.offset = float(np.log(KEEP / (1 - KEEP)) - width * (below + edges[best]) / 2)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 when divided by 4 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, *, shrinkage: float = 0.1) -> Discriminant:
    """Fit on the rows of `docs` that have a quality label and are not held out.

    Only statistics meet the labels: texts are not shuffled. The labelled vectors are
    written once. Moments are summed in the cluster and 2 x (1 + d + d x d) numbers come
    back; for the calibration, counts by step of evidence do.
    """
    d = len(STATISTICS)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "x": list(vectors(frame["text"]))})

    kind = dict(docs.dtypes)["doc_id"]
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("label"))
    measured = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text").mapInPandas(measure, f"doc_id {kind}, x array<double>")
    labelled = stage(measured.join(known, "doc_id").select("x", "label"), "labelled")

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, 1 + d + d * d))
        for frame in frames:
            if len(frame):
                x, y = np.stack(frame["x"].to_numpy()), frame["label"].to_numpy()
                for c in (0, 1):
                    own = x[y == c]
                    sums[c] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        slots = np.tile(np.arange(sums.shape[1]), 2)
        yield pd.DataFrame({"c": np.repeat([0, 1], sums.shape[1]), "slot": slots, "value": sums.ravel()})

    summed = labelled.select("x", "label").mapInPandas(moments, "c int, slot int, value double")
    sums = np.zeros((2, 1 + d + d * d))
    for r in summed.groupBy("c", "slot").agg(F.sum("value").alias("value")).collect():
        sums[r.c, r.slot] = r.value
    model = Discriminant(sums[:, 0], sums[:, 1 : 1 + d], sums[:, 1 + d :].reshape(2, d, d), shrinkage)
    if model.ready:

        @F.pandas_udf("long")
        def step(x: pd.Series) -> pd.Series:
            return pd.Series(np.floor(model.evidence(np.stack(x.to_numpy())) / STEP).astype("int64"))

        tally = labelled.groupBy(step("x").alias("step")).agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")).toPandas()
        model.calibrate(*(tally[c].to_numpy() for c in ("step", "good", "bad")), STEP)
    return model


def with_quality(docs: DataFrame, model: Discriminant, *, text: str = "text", column: str = "score") -> DataFrame:
    """The documents with a score between 0 and 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(vectors(texts)))

    return docs.withColumn(column, score(F.col(text)))


@query("op4_quality_classifier")
def op4_quality_classifier(t) -> DataFrame:
    docs = t("documents")
    model = learn(docs, t("labels"))
    scored = with_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= KEEP).cast("int").alias("predicted"),
    )
