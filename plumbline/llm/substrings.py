"""Exact removal of repeated passages by super-k-mer partitioning.

A window is `span` consecutive words; its minimiser is the least hash of its `gram`-word
grams. Consecutive windows with one minimiser form a super-k-mer. First only their
minimisers are counted: a window can repeat only if its minimiser does (or lies twice in
one super-k-mer), so the other super-k-mers, most of a corpus, go no further. The rest
travel as one packed string each (their words, overlapping the next by span - 1) to
their minimiser's bucket. There the windows are sorted, equal ones stand together, and
all but the earliest are marked. Marks return as word intervals, one per run of windows.

Windows of a bucket are sorted by a hash and then compared word by word with the first of
equal hash; where any differ, those are told apart by their words. A bucket's tables are
worked through in parts of a bounded number of windows. A minimiser with more than `hot`
windows is not gathered in one bucket: its windows are dealt by (minimiser, 128-bit hash of
the words), their earliest places come from a map-side aggregate, and a join brings those
back. All windows are judged either way.

Edge cases: a null text has no words; a null doc_id counts as the largest; rows that
share a doc_id have the same places, so a window is not earlier than its own copy there;
extra columns are ignored.
"""

from __future__ import annotations

from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.arrow import chunks, sorted_groups
from plumbline.llm.catalogue import query
from plumbline.session import stage

SPAN, GRAM = 20, 5
HOT = 200_000  # windows of a minimiser that one task sorts
PART = 500_000  # windows worked on at a time
LONGEST_RUN = 4096
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
LAST_ID = (1 << 63) - 1
KEY = ["pid", "th"]


def words_of(text: str | None) -> list[str]:
    """Runs of characters other than space, tab, line feed, vertical tab, form feed and return."""
    text = text or ""
    for space in "\t\n\v\f\r":
        text = text.replace(space, " ")
    words = text.split(" ")
    return [w for w in words if w] if "" in words else words


class Codes(dict):
    """64-bit hash of a word, kept for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


CODES = Codes()


class Numbers(dict):
    """0, 1, 2, ... for words in order of appearance: equal numbers mean equal words."""

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self)
        return found


def coded(words: list[str]) -> np.ndarray:
    return np.fromiter(map(CODES.__getitem__, words), np.uint64, len(words))


def span_hashes(codes: np.ndarray, span: int) -> np.ndarray:
    """Polynomial hash of every `span` consecutive codes, by doubling."""
    if len(codes) < span:
        return np.empty(0, np.uint64)
    done, out, block, width, power = 0, None, codes, 1, np.array([BASE])  # arrays wrap around silently
    left = span
    while left:
        if left & 1:
            part = block[done : done + len(codes) - span + 1]
            out = part if out is None else out * power + part
            done += width
        left >>= 1
        if left:
            block = block[: len(block) - width] * power + block[width:]
            power = power * power
            width *= 2
    out = out ^ (out >> np.uint64(29))
    return out * MIX


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest value (np.minimum, np.maximum) of every `width` neighbours, by doubling."""
    out, reach = values, 1
    while reach * 2 <= width:
        out = pick(out[: len(out) - reach], out[reach:])
        reach *= 2
    n = len(values) - width + 1
    return pick(out[:n], out[width - reach : width - reach + n])


def super_kmers(codes: np.ndarray, sizes: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, start, windows, minimiser, repeats inside) of the texts laid end to end in `codes`.

    `repeats inside` holds wherever a minimiser lies twice in its super-k-mer: the two are
    then neighbours among the grams that are least in some window.
    """
    empty = np.empty(0, np.int64)
    nothing = (empty, empty, empty, empty, empty.astype(bool))
    if len(codes) < span:
        return nothing
    hashes = span_hashes(codes, gram)
    width = span - gram + 1
    least = _sliding(hashes, width, np.minimum)
    text_of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    at = np.flatnonzero(text_of[: len(least)] == text_of[span - 1 :])  # windows inside one text
    if not len(at):
        return nothing
    value = least[at]
    new = np.append(True, (np.diff(at) != 1) | (value[1:] != value[:-1]) | (np.diff(text_of[at]) != 0))
    run = np.cumsum(new) - 1
    new |= (np.arange(len(at)) - np.flatnonzero(new)[run]) % LONGEST_RUN == 0
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(at)))
    # a gram is least somewhere if it equals the greatest of its windows' least values
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero(_sliding(padded, width, np.maximum) == hashes)
    same = np.flatnonzero(hashes[chosen[1:]] == hashes[chosen[:-1]])
    begins, ends = chosen[same], chosen[same + 1]
    from_head = len(begins) - np.searchsorted(begins, at[heads])
    beyond = len(ends) - np.searchsorted(ends, at[heads] + count + width - 2, side="right")
    text = text_of[at[heads]].astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    return text, at[heads] - begin[text], count, value[heads].view(np.int64), from_head > beyond


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    pid = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID))
    th = F.when(F.col(doc_id).isNull(), _null_mark(F.col(text))).otherwise(F.xxhash64(text))
    return docs.select(pid.alias("pid"), th.alias("th"), F.col(text).alias("text"))


def _null_mark(text: Column) -> Column:
    """Hash of the text of a row without an id, unlike that of a row with the largest id."""
    return F.xxhash64(F.lit("no id"), text)


def _partition(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """Super-k-mers without their words."""

    def run(batches):
        for part in chunks(batches, "text", 2_000_000):
            words = [words_of(t) for t in part.column("text").to_pylist()]
            sizes = np.array([len(w) for w in words], np.int64)
            codes = coded(list(chain.from_iterable(words)))
            text, start, count, least, twice = super_kmers(codes, sizes, span, gram)
            arrays = [part.column("pid").take(pa.array(text)), part.column("th").take(pa.array(text)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(least), pa.array(twice)]
            yield pa.RecordBatch.from_arrays(arrays, [*KEY, "start", "windows", "mini", "twice"])

    return docs.select(*KEY, "text").mapInArrow(run, "pid long, th long, start int, windows int, mini long, twice boolean")


def _packed(docs: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """The words of wanted super-k-mers as one string each."""
    names = [*KEY, "start", "windows", "mini", "n", "packed"]

    def run(batches):
        for part in chunks(batches, "text", 2_000_000):
            lists, pieces = part.column("parts"), []
            start, windows, mini, n = lists.flatten().flatten()
            ends = (start.to_numpy() + windows.to_numpy() + span - 1).tolist()
            each, sizes = zip(start.to_pylist(), ends), lists.value_lengths().to_numpy()
            for text, size in zip(part.column("text").to_pylist(), sizes.tolist()):
                words = words_of(text)
                pieces += [" ".join(words[begin:end]) for begin, end in islice(each, size)]
            row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            keys = [part.column(c).take(row) for c in KEY]
            yield pa.RecordBatch.from_arrays([*keys, start, windows, mini, n, pa.array(pieces, pa.string())], names)

    joined = docs.join(wanted, KEY).select(*KEY, "text", "parts")
    return joined.mapInArrow(run, "pid long, th long, start int, windows int, mini long, n long, packed string")


def _windows(table, span: int) -> tuple[np.ndarray, ...]:
    """Of packed strings laid end to end: numbers of their words (equal only for equal words), and per
    window its hash, where its words begin, its row and its place in the row."""
    number = Numbers()
    words = " ".join(table.column("packed").to_pylist()).split(" ")
    ids = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
    sizes = pc.count_substring(table.column("packed"), " ").to_numpy().astype(np.int64) + 1
    counts = sizes - span + 1
    hashes = span_hashes(coded(list(number))[ids], span)
    row = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.repeat(np.cumsum(sizes) - sizes, counts) + inside
    return ids, hashes[begin], begin, row, inside


def _parts(bounds: list[int], windows: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Runs of whole groups with at most `limit` windows together (one group at least)."""
    total = np.append(0, np.cumsum(windows))
    cuts, start = [], bounds[0]
    for left, right in zip(bounds, bounds[1:]):
        if total[right] - total[start] > limit and left > start:
            cuts.append((start, left))
            start = left
    return [*cuts, (start, bounds[-1])]


def _first_of_each(ids: np.ndarray, keys: tuple[np.ndarray, ...], begin: np.ndarray, span: int, in_order: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows (keys: place, document, hash, ...) and for each in it the first with its words.

    The minimiser is one of a window's own grams, so equal words have equal minimisers and
    nothing beyond the hash is needed as a key. `in_order`: windows of one minimiser already
    stand by document and place, so that a stable sort by hash keeps the earliest first.
    """
    place, doc, hashes, *_ = keys
    extra = None
    while True:
        if extra is not None:
            order = np.lexsort((place, doc, extra, hashes))
        else:
            order = np.argsort(hashes, kind="stable") if in_order else np.lexsort((place, doc, hashes))
        sorted_hashes = hashes[order]
        new = np.append(True, sorted_hashes[1:] != sorted_hashes[:-1])
        if extra is not None:
            new[1:] |= np.diff(extra[order]) != 0
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        # only windows that follow another of their hash have words to compare
        at = np.flatnonzero(~new)
        own, first = begin[order[at]], begin[head[at]]
        unlike = np.zeros(len(at), bool)
        for k in range(span):
            unlike |= ids[own + k] != ids[first + k]
        if not unlike.any():
            return order, head
        # windows of one hash but other words: numbered by their words
        clash = np.isin(head, head[at[unlike]])
        seen: dict[bytes, int] = {}
        extra = np.zeros(len(begin), np.int64) if extra is None else extra
        for i in order[clash]:
            extra[i] = seen.setdefault(ids[begin[i] : begin[i] + span].tobytes(), len(seen))


def _in_order(table: pa.Table) -> bool:
    """Whether windows of a minimiser stand by document and place: sorted rows that do not overlap.

    Rows of different texts under one id may overlap.
    """
    mini, pid, start, windows = (table.column(c).to_numpy() for c in ("mini", "pid", "start", "windows"))
    same = mini[1:] == mini[:-1]
    back = (pid[1:] < pid[:-1]) | ((pid[1:] == pid[:-1]) & (start[1:] < start[:-1] + windows[:-1]))
    return not (same & back).any()


def _bucket_marks(packed: DataFrame, span: int) -> DataFrame:
    """(key, lo, hi) of words covered by repeated windows; a bucket's windows are sorted in one place."""

    def marks(table: pa.Table) -> pa.RecordBatch:
        ids, hashes, begin, row, inside = _windows(table, span)
        pid, th = (table.column(c).to_numpy() for c in KEY)
        place = table.column("start").to_numpy().astype(np.int64)[row] + inside
        order, head = _first_of_each(ids, (place, pid[row], hashes), begin, span, _in_order(table))
        late = np.zeros(len(order), bool)
        late[order] = (pid[row[order]] != pid[row[head]]) | (place[order] != place[head])
        at = np.flatnonzero(late)
        begins = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(row[at]) != 0))) if len(at) else at
        ends = np.append(begins[1:], len(at)) - 1 if len(at) else at
        own = row[at[begins]]
        lo, hi = place[at[begins]], place[at[ends]] + span
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (pid[own], th[own], lo, hi)], [*KEY, "lo", "hi"])

    def run(batches):
        for table, bounds in sorted_groups(batches, ["mini"]):
            for start, end in _parts(bounds, table.column("windows").to_numpy(), PART):
                if end > start:
                    yield marks(table.slice(start, end - start))

    dealt = packed.select(*KEY, "start", "windows", "mini", "packed").repartition("mini").sortWithinPartitions("mini", "pid", "start")
    return dealt.mapInArrow(run, "pid long, th long, lo long, hi long")


def _hot_marks(packed: DataFrame, span: int) -> DataFrame:
    """The same for minimisers with very many windows: aggregate and join instead of one bucket."""

    def run(batches):
        for part in chunks(batches, "packed", 2_000_000):
            ids, _, begin, row, inside = _windows(pa.Table.from_batches([part]), span)
            texts = [p.split(" ") for p in part.column("packed").to_pylist()]
            digests = [xxhash.xxh3_128_digest(" ".join(texts[r][i : i + span])) for r, i in zip(row.tolist(), inside.tolist())]
            pid, th, mini = (part.column(c).to_numpy()[row] for c in (*KEY, "mini"))
            place = part.column("start").to_numpy().astype(np.int64)[row] + inside
            columns = [pa.array(pid), pa.array(th), pa.array(mini), pa.array(digests, pa.binary()), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, [*KEY, "mini", "window", "place"])

    rows = packed.mapInArrow(run, "pid long, th long, mini long, window binary, place long")
    first = rows.groupBy("mini", "window").agg(F.min(F.struct("pid", "place")).alias("first"))
    late = rows.join(first, ["mini", "window"]).where(F.struct("pid", "place") > F.col("first"))
    return late.select(*KEY, F.col("place").alias("lo"), (F.col("place") + span).alias("hi"))


def repeated_passages(docs: DataFrame, *, span: int = SPAN, gram: int = GRAM, hot: int = HOT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(pid, th, cuts): per text with repeats, the word intervals to remove (they may overlap)."""
    rows = _keyed(docs, doc_id, text)
    parts = _partition(rows, span, gram)
    facts = [F.count(F.lit(1)).alias("pieces"), F.sum("windows").alias("n"), F.max("twice").alias("any_twice")]
    counted = parts.groupBy("mini").agg(*facts).where((F.col("pieces") > 1) | F.col("any_twice"))
    wanted = parts.join(counted.select("mini", "n"), "mini").groupBy(*KEY).agg(F.collect_set(F.struct("start", "windows", "mini", "n")).alias("parts"))
    packed = _packed(rows, stage(wanted, "parts"), span)
    marks = _bucket_marks(packed.where(F.col("n") <= hot), span).union(_hot_marks(packed.where(F.col("n") > hot), span))
    return marks.groupBy(*KEY).agg(F.collect_set(F.struct("lo", "hi")).alias("cuts"))


def _kept(words: list[str], cuts: list[dict] | None) -> list[str]:
    if not cuts:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, [c["lo"] for c in cuts], 1)
    np.add.at(edge, [c["hi"] for c in cuts], -1)
    return list(compress(words, (np.cumsum(edge) == 0).tolist()))


def remove_repeated_passages(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): `kept` has the remaining words joined by spaces.

    Ids are whole numbers. Texts meet their super-k-mers and their cuts by the same key
    and columns, so that one exchange of the texts serves both joins.
    """
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    rows = _keyed(docs, doc_id, text)
    kind = dict(docs.dtypes)[doc_id]

    def run(batches):
        for part in chunks(batches, "text", 4_000_000):
            all_words, kept = [], []
            for value, cuts in zip(part.column("text").to_pylist(), part.column("cuts").to_pylist()):
                words = words_of(value)
                left = _kept(words, cuts)
                all_words.append(len(words))
                kept.append((len(words) - len(left), " ".join(left)))
            arrays = [part.column("pid"), pa.array(all_words, pa.int64()), pa.array([k for k, _ in kept], pa.int64()), pa.array([k for _, k in kept], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept"])

    nameless = (F.col("pid") == LAST_ID) & (F.col("th") == _null_mark(F.col("text")))
    joined = rows.join(repeated_passages(docs, **options), KEY, "left").select(F.when(~nameless, F.col("pid")).alias("pid"), "text", "cuts")
    out = joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20),
g AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 19], ' ')) AS k FROM s),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM g) WHERE n > 1),
c AS (SELECT DISTINCT doc_id, p + j AS q FROM (SELECT doc_id, p, unnest(range(0, 20)) AS j FROM r)),
e AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS q FROM d),
x AS (SELECT e.doc_id, count(*) AS n_kept, string_agg(w[e.q], ' ' ORDER BY e.q) AS t FROM e ANTI JOIN c ON c.doc_id = e.doc_id AND c.q = e.q GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN x ON x.doc_id = d.doc_id"""


@query("op8_substring_dedup", SQL)
def op8_substring_dedup(t) -> DataFrame:
    cleaned = remove_repeated_passages(t("documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
