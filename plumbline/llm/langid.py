"""Language identification by interpolated Kneser-Ney character models.

Words (lower case, between white space) are padded with boundary marks and cut to
5-grams of 12-bit codes, packed in one long. A character below U+0780 is one code, any other
one two (its high and low bits, in code ranges of their own), so no two characters share
codes. The cluster counts the grams per language over all training texts and keeps every one; continuation counts, and totals
and kinds of contexts, are aggregates of all grams too. Those tables lie in the shared
folder as sorted arrays per language, order and key range. Tasks look grams up there by
binary search and read the ranges they need; only the list of ranges is broadcast.

A text gets the language with the lowest cross-entropy per symbol; ties go to the first
language in order. Rejection is calibrated on texts that a model has not learned: the training
texts are halved by a hash of the text, so that copies stay together, each half has models of
its own, and every text is measured by the other half's model of its language. These
cross-entropies give each language's mean and deviation (a language that one half lacks takes
those of all); a text more than `reject` deviations above the mean is marked rejected and its
score falls. Whole texts are scored, distinct words of a batch once.

Edge cases: null texts and texts without a letter are `und` with score 0, and so is
everything if nothing can be learned; null languages are not learned; repeated rows and
extra columns change nothing.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.arrow import chunks
from plumbline.llm.catalogue import query
from plumbline.llm.warc import opened
from plumbline.session import default_buckets, scratch_folder, stage

ORDER, BITS = 5, 12
NARROW, LOW_BITS = 0x780, 10  # characters of one code; bits in the second code of others
HIGH, LOW = NARROW, NARROW + (0x110000 >> LOW_BITS)  # where the codes of high and low bits begin
WHOLE, HALVES = "\x01*", ("\x010", "\x011")  # model name suffixes: all training texts, and halves of them
RANGE = 1 << 17  # rows of a sorted array
HELD = 1 << 27  # bytes of arrays that a task keeps of a folder that cannot be mapped
DISCOUNT = 0.75
NONE = "und"


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 when divided by 4 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def split_words(texts: pa.Array) -> pa.ListArray:
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    return lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists


def grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed grams of padded words, and the number of grams of each word (codes + 1)."""
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    pad = "\0" * (ORDER - 1)
    text = pad.join(["", *words.to_pylist()])
    codes = np.frombuffer((text + pad).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    wide = codes >= NARROW
    if wide.any():
        place = np.repeat(np.arange(len(sizes)), sizes + ORDER - 1)  # padding stands before each word
        sizes = sizes + np.bincount(place, wide[: len(place)], len(sizes)).astype(np.int64)
        twice, second = np.repeat(codes, 1 + wide), np.cumsum(1 + wide)[wide] - 1
        twice[second - 1] = HIGH + (codes[wide] >> LOW_BITS)
        twice[second] = LOW + (codes[wide] & ((1 << LOW_BITS) - 1))
        codes = twice
    packed = np.zeros(len(codes) - ORDER + 1, np.int64)
    for i in range(ORDER):
        packed = packed << BITS | codes[i : i + len(packed)]
    # a word's grams start at its padding; the next word's padding follows its end
    starts = np.cumsum(sizes + ORDER - 1) - sizes - (ORDER - 1)
    index = np.repeat(starts - np.append(0, np.cumsum(sizes + 1)[:-1]), sizes + 1) + np.arange((sizes + 1).sum())
    return packed[index], sizes + 1


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n) over whole texts."""

    def run(batches):
        for part in chunks(batches, "text", 4_000_000):
            for value in pc.unique(part.column("lang")):
                own = part.column("text").filter(pc.equal(part.column("lang"), value))
                counted = split_words(own).flatten().value_counts()
                if not len(counted):
                    continue
                packed, sizes = grams(counted.field("values"))
                keys, back = np.unique(packed, return_inverse=True)
                n = np.bincount(back, np.repeat(counted.field("counts").to_numpy(), sizes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([value.as_py()] * len(keys), pa.string()), pa.array(keys), pa.array(n)], ["lang", "gram", "n"])

    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counted: DataFrame) -> DataFrame:
    """(lang, part, key, a, b) of all grams: part 2k has the grams of order k with their count
    (order 5) or continuation count in a, part 2k + 1 their contexts with total and kinds."""
    own = counted.select("lang", F.col("gram").alias("key"), "n")
    out = []
    for order in range(ORDER, 0, -1):
        out.append(own.select("lang", F.lit(2 * order).alias("part"), "key", F.col("n").alias("a"), F.lit(0).cast("long").alias("b")))
        contexts = own.groupBy("lang", F.shiftright("key", BITS).alias("key")).agg(F.sum("n").alias("a"), F.count(F.lit(1)).alias("b"))
        out.append(contexts.select("lang", F.lit(2 * order + 1).alias("part"), "key", "a", "b"))
        rest = F.col("key").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1).cast("long"))
        own = own.groupBy("lang", rest.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return reduce(DataFrame.unionAll, out)


def stored(tables: DataFrame, limit: int = RANGE) -> pd.DataFrame:
    """Writes the tables as sorted arrays (key, a and, for contexts, b) of up to `limit` rows; returns where they are."""
    spark = tables.sparkSession
    folder = scratch_folder(spark, "ngrams")

    def run(batches):
        filesystem, base = opened(folder)
        filesystem.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.bin"  # an attempt that fails leaves a file that nothing lists
        found, held, of, size = [], [], None, 0
        with filesystem.open_output_stream(f"{base}/{name}") as out:

            def flush():
                nonlocal held, size
                if size:
                    rows = [np.concatenate(x) for x in zip(*held)][: 2 + of[1] % 2]
                    found.append((*of, int(rows[0][0]), f"{folder}/{name}", out.tell(), size))
                    for x in rows:
                        out.write(np.ascontiguousarray(x, np.int64).tobytes())
                held, size = [], 0

            for batch in batches:
                n = batch.num_rows
                lang, part = batch.column("lang"), batch.column("part")
                new = pc.or_(pc.not_equal(lang.slice(1), lang.slice(0, max(n - 1, 0))), pc.not_equal(part.slice(1), part.slice(0, max(n - 1, 0))))
                cuts = [0, *(np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1), n] if n else []
                columns = [batch.column(c).to_numpy() for c in ("key", "a", "b")]
                for start, end in zip(cuts, cuts[1:]):
                    now = (lang[int(start)].as_py(), part[int(start)].as_py())
                    if now != of:
                        flush()
                        of = now
                    while start < end:
                        stop = min(end, start + limit - size)
                        held.append([c[start:stop] for c in columns])
                        size, start = size + int(stop - start), stop
                        if size == limit:
                            flush()
            flush()
        yield pa.RecordBatch.from_pylist([dict(zip(("lang", "part", "lo", "path", "offset", "n"), row)) for row in found], pa.schema([("lang", pa.string()), ("part", pa.int32()), ("lo", pa.int64()), ("path", pa.string()), ("offset", pa.int64()), ("n", pa.int64())]))

    keys = ["lang", "part", "key"]
    dealt = tables.repartitionByRange(default_buckets(spark), *keys).sortWithinPartitions(*keys)
    rows = dealt.mapInArrow(run, "lang string, part int, lo long, path string, offset long, n long").collect()
    return pd.DataFrame([r.asDict() for r in rows], columns=["lang", "part", "lo", "path", "offset", "n"])


_maps: dict[str, np.ndarray] = {}
_held: OrderedDict[tuple[str, int], np.ndarray] = OrderedDict()


def _array(path: str, offset: int, n: int, width: int) -> np.ndarray:
    """`width` rows of n longs of a file: mapped where the folder is a local one, else read and held up to HELD bytes."""
    if path not in _maps and (path, offset) not in _held:
        filesystem, name = opened(path)
        if filesystem.type_name == "local":
            _maps[path] = np.memmap(name, np.int64, "r")
        else:
            with filesystem.open_input_file(name) as file:
                _held[path, offset] = np.frombuffer(file.read_at(8 * n * width, offset), np.int64).reshape(width, n)
            while len(_held) > 1 and sum(x.nbytes for x in _held.values()) > HELD:
                _held.popitem(last=False)
    if path in _maps:
        return _maps[path][offset // 8 : offset // 8 + n * width].reshape(width, n)
    _held.move_to_end((path, offset))
    return _held[path, offset]


class SortedTable:
    """Rows of longs found by key, in ranges of ascending keys; a range is an array or its place (path, offset, n)."""

    def __init__(self, width: int, lows: list[int], ranges: list):
        self.width, self.lows, self.ranges = width, np.array(lows, np.int64), ranges

    def __call__(self, asked: np.ndarray) -> np.ndarray:
        """The values of the keys asked for, zeros where a key is missing."""
        out = np.zeros((self.width - 1, len(asked)))
        place = np.searchsorted(self.lows, asked, "right") - 1
        by_place = np.argsort(place, kind="stable")
        found, starts = np.unique(place[by_place], return_index=True)
        for k, rows in zip(found, np.split(by_place, starts[1:])):
            if k < 0:
                continue
            table = self.ranges[k] if isinstance(self.ranges[k], np.ndarray) else _array(*self.ranges[k], self.width)
            at = np.searchsorted(table[0], asked[rows]).clip(max=table.shape[1] - 1)
            hit = table[0][at] == asked[rows]
            out[:, rows[hit]] = table[1:, at[hit]]
        return out


def _orders(keys: np.ndarray, counts: np.ndarray) -> list[tuple[SortedTable, SortedTable]]:
    """Per order from 1: the grams with their counts, the contexts with total and kinds."""
    out = []
    for order in range(ORDER, 0, -1):
        context, where = np.unique(keys >> BITS, return_inverse=True)
        own = SortedTable(2, keys[:1], [np.stack([keys, counts.astype(np.int64)])])
        out.append((own, SortedTable(3, context[:1], [np.stack([context, np.bincount(where, counts).astype(np.int64), np.bincount(where)])])))
        keys, counts = np.unique(keys & ((1 << BITS * (order - 1)) - 1), return_counts=True)  # continuation counts
    return out[::-1]


class LanguageModels:
    """Sorted tables of grams and contexts by language, with the calibration of rejection."""

    def __init__(self, counts: pd.DataFrame):
        self.names = sorted(counts["lang"].unique())
        self.models, self.typical = [], {}
        for name in self.names:
            own = counts[counts["lang"] == name].sort_values("gram")
            self.models.append(_orders(own["gram"].to_numpy(), own["n"].to_numpy().astype(float)))

    @classmethod
    def at(cls, places: pd.DataFrame, suffix: str = "") -> LanguageModels:
        """Models whose tables lie in the shared folder, from what `stored` returns; of those with a suffix, which they lose."""
        places = places[places["lang"].str.endswith(suffix)] if len(places) else places
        places = places.assign(lang=places["lang"].str.slice(0, -len(suffix))) if suffix and len(places) else places
        out = cls(pd.DataFrame({"lang": [], "gram": [], "n": []}))
        out.names = sorted(places["lang"].unique())
        by_part = {key: rows.sort_values("lo") for key, rows in places.groupby(["lang", "part"])}

        def table(name, part):
            rows = by_part[name, part]
            return SortedTable(2 + part % 2, rows["lo"].tolist(), list(zip(rows["path"], rows["offset"].tolist(), rows["n"].tolist())))

        out.models = [[(table(name, 2 * k), table(name, 2 * k + 1)) for k in range(1, ORDER + 1)] for name in out.names]
        return out

    def log_probability(self, asked: np.ndarray, model: int) -> np.ndarray:
        p = np.full(len(asked), 2.0**-BITS)
        for order, (own, contexts) in enumerate(self.models[model], 1):
            key = asked & ((1 << BITS * order) - 1)
            contexts_of, back = np.unique(key >> BITS, return_inverse=True)
            total, kinds = contexts(contexts_of)[:, back]
            seen = total > 0
            p = np.where(seen, ((own(key)[0] - DISCOUNT).clip(0) + DISCOUNT * kinds * p) / np.where(seen, total, 1), p)
        return np.log2(p)

    def entropies(self, texts: pa.Array, only: list[int] | None = None) -> np.ndarray:
        """Bits per symbol, a row per text and a column per language (or one of `only`); nan without words."""
        models = range(len(self.names)) if only is None else only
        lists = split_words(texts)
        coded = lists.flatten().dictionary_encode()
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        out = np.full((len(texts), len(models)), np.nan)
        if not len(coded):
            return out
        words = coded.indices.to_numpy()
        packed, sizes = grams(coded.dictionary)
        keys, back = np.unique(packed, return_inverse=True)
        word_of = np.repeat(np.arange(len(sizes)), sizes)
        empty = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False) == 0
        sums = lambda per_word: np.diff(np.append(0.0, np.cumsum(np.where(empty, 0.0, per_word)[words]))[bounds])
        symbols = sums(sizes)
        for place, m in enumerate(models):
            bits = np.bincount(word_of, -self.log_probability(keys, m)[back], len(sizes))
            with np.errstate(invalid="ignore", divide="ignore"):
                out[:, place] = sums(bits) / np.where(symbols > 0, symbols, np.nan)
        return out

    def predict(self, texts: pa.Array, reject: float) -> tuple[list, np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected, by text."""
        n = len(texts)
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.names:
            return [NONE] * n, np.zeros(n), np.ones(n, bool)
        x = self.entropies(texts)
        known = letters & ~np.isnan(x[:, 0])
        x = np.where(known[:, None], x, 0.0)
        best = x.argmin(1)
        low = x[np.arange(n), best]
        share = 1 / np.exp2(4 * (low[:, None] - x)).sum(1)
        mean, deviation = (np.array([self.typical.get(name, (0.0, 1e9))[k] for name in self.names])[best] for k in (0, 1))
        z = (low - mean) / deviation
        score = np.where(known, share / (1 + np.exp((z - reject).clip(-50, 50))), 0.0)
        return [self.names[b] if k else NONE for b, k in zip(best, known)], score, ~known | (z > reject)


def learn(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> LanguageModels:
    """Models of the languages in `docs`, which should be the training rows only."""
    taught = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    half = F.pmod(F.xxhash64("text"), F.lit(2))
    label = F.concat("lang", F.when(half == 0, F.lit(HALVES[0])).otherwise(F.lit(HALVES[1])))
    halves = stage(count_grams(taught.withColumn("lang", label)), "grams")
    whole = halves.groupBy(F.concat(F.expr(f"left(lang, length(lang) - {len(WHOLE)})"), F.lit(WHOLE)).alias("lang"), "gram").agg(F.sum("n").alias("n"))
    places = stored(kneser_ney(halves.unionByName(whole)))
    models = LanguageModels.at(places, WHOLE)
    if models.names:
        others = [LanguageModels.at(places, suffix) for suffix in reversed(HALVES)]  # of the other half
        shared = docs.sparkSession.sparkContext.broadcast(others)

        def own(batches):
            for part in chunks(batches, "text", 4_000_000):
                for k, other in enumerate(shared.value):
                    at = {name: i for i, name in enumerate(other.names)}
                    mine = part.filter(pc.equal(part.column("half"), k))
                    for value in pc.unique(mine.column("lang")).to_pylist():
                        if value in at:
                            texts = mine.column("text").filter(pc.equal(mine.column("lang"), value))
                            x = other.entropies(texts, [at[value]])[:, 0]
                            yield pa.RecordBatch.from_arrays([pa.array([value] * len(x), pa.string()), pa.array(x, from_pandas=True)], ["lang", "x"])

        seen = taught.select("text", "lang", half.alias("half")).mapInArrow(own, "lang string, x double").where(F.col("x").isNotNull())
        facts = [F.count("x"), F.sum("x"), F.sum(F.col("x") * F.col("x"))]
        found = {r[0]: np.array(r[1:]) for r in seen.groupBy("lang").agg(*facts).collect()}
        if found:
            every = sum(found.values())
            for name in models.names:
                n, total, squares = found.get(name, every)
                models.typical[name] = (total / n, max(max(squares / n - (total / n) ** 2, 0.0) ** 0.5, 0.05))
    return models


def with_language(docs: DataFrame, models: LanguageModels, *, text: str = "text", reject: float = 4.0) -> DataFrame:
    """The documents with a struct `language` of lang, score and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            whole = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], ["text"])
            parts = [shared.value.predict(p.column("text"), reject) for p in chunks(iter([whole]), "text", 4_000_000)]
            columns = [np.concatenate([np.asarray(p[i], dtype=object if i == 0 else None) for p in parts]) if parts else [] for i in range(3)]
            yield pd.DataFrame(dict(zip(("lang", "score", "rejected"), columns)))

    return docs.withColumn("language", predict(F.col(text)))


@query("op9_language_id")
def op9_language_id(t) -> DataFrame:
    docs = t("documents").select("doc_id", "text", "lang")
    models = learn(docs.where(~held_out(F.col("doc_id"))))
    named = with_language(docs.select("doc_id", "text"), models)
    return named.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.rejected").alias("rejected"),
    )
