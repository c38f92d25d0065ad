"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. An item's
windows are its spans of `span` consecutive words; a shorter item is one window. From
every window both sides keep the minimum hash of its `gram`-word grams, the last on a
tie. Equal windows keep equal grams at equal offsets, so joining the kept grams finds at
least one anchor inside every shared window. Anchors are extended word by word to both
sides; what grows to `span` words or more is a hit, so no hash collision remains.

Edge cases: a null or empty text has no words. Items without words match nothing; items
with a null id count as hits but are not listed. Repeated documents give repeated rows;
rows that share a doc_id are told apart by their text. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plumbline.llm.catalogue import query

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what is not in a word of a lower-cased text
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["_id", "_text_hash"]


def item_words(text: Column) -> Column:
    """Words of a text; ASCII texts take the faster lower-casing.

    What lies between words becomes one space each; extracting match by match takes many times longer.
    """
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.regexp_replace(lowered, BETWEEN, " "), " "), "")


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("codes", F.transform("words", lambda w: F.xxhash64(w)))


def _gram_hash(start: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get("codes", start + i) for i in range(length)])


def _picks(df: DataFrame, span: int, gram: int) -> DataFrame:
    """(at, print): the kept gram of every window of `span` words; repeats of a pick included."""
    width = span - gram + 1
    bits = max(1, (width - 1).bit_length())
    mask = (1 << bits) - 1
    starts = df.where(F.size("codes") >= span).withColumn("s", F.explode(F.sequence(F.lit(0), F.size("codes") - span)))
    hashes = starts.withColumns({f"h{i}": _gram_hash(F.col("s"), gram) if i == 0 else _gram_hash(F.col("s") + i, gram) for i in range(width)})
    # the low bits hold the offset from the right, so that the last minimum wins
    ranked = [F.col(f"h{i}").bitwiseAND(F.lit(~mask)).bitwiseOR(F.lit(width - 1 - i)) for i in range(width)]
    low = hashes.withColumn("low", F.least(*ranked) if width > 1 else ranked[0])
    return low.withColumns(
        {"at": F.col("s") + (width - 1) - F.col("low").bitwiseAND(F.lit(mask)).cast("int"), "print": F.shiftright("low", bits)}
    ).drop("low", "s", *[f"h{i}" for i in range(width)])


def _context(df: DataFrame, gram: int, reach: int) -> DataFrame:
    """Words before (nearest first), inside and after a gram, `reach` on each side."""
    at = F.col("at")
    before = F.slice("words", F.greatest(at - reach, F.lit(0)) + 1, F.least(at, F.lit(reach)))
    return df.withColumns(
        {
            "before": F.reverse(before),
            "inside": F.array_join(F.slice("words", at + 1, F.lit(gram)), " "),
            "after": F.slice("words", at + gram + 1, F.lit(reach)),
        }
    )


def _common(a: str, b: str, reach: int) -> Column:
    """Length of the common prefix of two short arrays."""
    same = [F.coalesce(F.get(a, F.lit(i)) == F.get(b, F.lit(i)), F.lit(False)) for i in range(reach)]
    total, going = F.lit(0), F.lit(True)
    for flag in same:
        going = going & flag
        total = total + going.cast("int")
    return total


def _matches(docs: DataFrame, items: DataFrame, span: int, gram: int, broadcast_rows: int) -> tuple[DataFrame, DataFrame]:
    """(document key, lo, hi) of hit spans, and (document key, item_id) of the items in them."""
    reach = span - gram
    item_side = _context(_picks(items, span, gram), gram, reach)
    shape = F.sha2(F.concat_ws("|", F.array_join("before", " "), "inside", F.array_join("after", " ")), 256)
    item_side = item_side.select("item_id", "print", "before", "inside", "after", shape.alias("shape")).distinct()
    prints = item_side.select("print").distinct()
    picks = _picks(docs, span, gram)
    if prints.count() <= broadcast_rows:
        anchors = _context(picks.join(F.broadcast(prints), "print", "left_semi"), gram, reach).drop("words", "codes").distinct()
    else:  # many items: narrow rows are shuffled, and only documents with anchors are read again
        narrow = picks.select(*KEY, "at", "print").distinct().join(prints, "print", "left_semi")
        again = _attach(docs.drop("codes").dropDuplicates(KEY), narrow, "inner")
        anchors = _context(again, gram, reach).drop("words")
    shapes = item_side.select("print", F.col("inside").alias("i_inside"), F.col("before").alias("i_before"), F.col("after").alias("i_after"), "shape").distinct()
    grown = (
        anchors.join(shapes, "print")
        .where(F.col("inside") == F.col("i_inside"))
        .withColumns({"left": _common("before", "i_before", reach), "right": _common("after", "i_after", reach)})
        .where(F.col("left") + gram + F.col("right") >= span)
    )
    spans = grown.select(*KEY, (F.col("at") - F.col("left")).alias("lo"), (F.col("at") + gram + F.col("right")).alias("hi"))
    found = grown.select(*KEY, "shape").distinct().join(item_side.select("shape", "item_id").distinct(), "shape")
    return spans, found.select(*KEY, "item_id")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = 10,
    gram: int = 5,
    broadcast_rows: int = 500_000,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with word counts, hit spans (distinct), and (document, item) pairs.

    Keys are `_id` and `_text_hash` (a hash of the text). The item side's kept hashes are
    broadcast only if there are at most `broadcast_rows` of them (8 bytes each).
    """
    base = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_text_hash"), item_words(F.col(text)).alias("words"))
    hashed = _hashed(base)
    known = _hashed(items.select(F.col(item_id).alias("item_id"), item_words(F.col(item_text)).alias("words")).where(F.size("words") > 0))
    parts = [_matches(hashed, known.where(F.size("words") >= span), span, gram, broadcast_rows)]
    short = known.where(F.size("words") < span)
    lengths = sorted(r.n for r in short.select(F.size("words").alias("n")).distinct().collect())  # at most span - 1 values
    parts += [_matches(hashed, short.where(F.size("words") == n), n, n, broadcast_rows) for n in lengths]
    spans = reduce(DataFrame.union, [p[0] for p in parts]).distinct()
    found = reduce(DataFrame.union, [p[1] for p in parts]).distinct()
    return base.select(*KEY, F.size("words").alias("n_words")), spans, found


def _attach(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on the document key; null ids are equal to each other."""
    right = right.withColumnsRenamed({k: f"r{k}" for k in KEY})
    on = F.col("_id").eqNullSafe(F.col("r_id")) & (F.col("_text_hash") == F.col("r_text_hash"))
    joined = left.join(right, on, how)
    return joined if how == "left_anti" else joined.drop("r_id", "r_text_hash")


def covered(spans: DataFrame) -> DataFrame:
    """Number of words inside the union of each document's spans."""
    earlier = W.partitionBy(*KEY).orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("hi") - F.greatest("lo", F.coalesce(F.max("hi").over(earlier), F.lit(0))))
    return spans.withColumn("fresh", fresh).groupBy(*KEY).agg(F.sum("fresh").alias("n_hit"))


def decontaminate(docs: DataFrame, items: DataFrame, max_hit: int = 0, **options) -> DataFrame:
    """Documents without more than `max_hit` hit words; columns unchanged."""
    _, spans, _ = contamination(docs, items, **options)
    bad = covered(spans).where(F.col("n_hit") > max_hit)
    ident, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(ident).alias("_id"), F.xxhash64(text).alias("_text_hash"))
    return _attach(rows, bad.select(*KEY), "left_anti").select("row.*")


SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS g FROM starts),
sizes AS (SELECT DISTINCT m FROM win),
ds AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, sizes WHERE len(w) >= m),
dw AS (SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS g FROM ds),
hit AS (SELECT DISTINCT doc_id, item_id, m, s FROM dw JOIN win USING (m, g)),
pos AS (SELECT DISTINCT doc_id, s + j AS p FROM (SELECT doc_id, s, unnest(range(0, m)) AS j FROM hit)),
n AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id"""


@query("op1_decontamination", SQL)
def op1_decontamination(t) -> DataFrame:
    base, spans, found = contamination(t("documents"), t("benchmark"))
    listed = found.groupBy(*KEY).agg(F.array_join(F.array_sort(F.collect_set(F.col("item_id").cast("string"))), ",").alias("ids"), F.countDistinct("item_id").alias("n_items"))
    joined = _attach(_attach(base, covered(spans)), listed)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        F.col("_id").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
