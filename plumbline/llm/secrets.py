"""Secret scan with multipart credential linking, in DataFrame operations only.

Base kinds (assign, access, hex) are reported wherever they match. Weak kinds are only
candidates: `ident` (an assigned user or client id), `key` (a long mixed token) and
`endpoint` (a URL). A weak candidate is reported when complementary parts stand at most
`scope` characters beside it (from the end of one to the start of the other; less when they
overlap) in the same document: an ident needs a secret (assign, hex, key), a key needs an
identifier (access, ident), an endpoint needs both. Candidates that overlap a base span are
dropped before that.

Places of matches come from the text between them: `split` gives the pieces, so starts
are running sums of lengths, in code points. The scope join is an interval join: every part
is entered in each cell of `scope` characters that it touches, every candidate asks the cells
that it touches when widened by `scope`, and the intervals themselves decide. Matches of a
kind do not overlap, so cells and pairs grow with the text's length, not its square.

Edge cases: a null text is empty and has no spans; repeated rows give repeated results;
rows sharing a doc_id are told apart by their text; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plumbline.llm.catalogue import query

KEY = ["_id", "_text_hash"]


def _any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


JOINT = r"""["']?\x20*[:=]\x20*["']?"""
# kind -> (pattern, group that must be long, its least length, role); the order is the order of equal starts
PARTS = {
    "assign": (f"({_any_case('password|passwd|secret|token|api_?key')}){JOINT}([A-Za-z0-9+/_.=-]+)", 2, 6, "secret"),
    "access": ("AKIA[A-Z0-9]{16,}", 0, 20, "identifier"),
    "hex": ("[0-9a-f]{24,}", 0, 24, "secret"),
    "ident": (f"({_any_case('client_?id|user_?name|user|login|account')}){JOINT}([A-Za-z0-9_.@-]+)", 2, 4, "identifier"),
    "key": ("[A-Za-z0-9+/_-]{20,}", 0, 20, "secret"),
    "endpoint": (r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9_./?=&%#-]*)?", 0, 10, "endpoint"),
}
BASE = ("assign", "access", "hex")
RANK = {kind: i for i, kind in enumerate(PARTS)}


def _lengths(matches: Column) -> Column:
    return F.transform(matches, lambda m: F.length(m))


def parts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(document key, kind, rank, role, lo, hi) of every base span and weak candidate."""
    rows = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_text_hash"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    found = rows
    for kind, (pattern, group, _, _) in PARTS.items():
        found = found.withColumn(f"m_{kind}", F.regexp_extract_all("body", F.lit(pattern), F.lit(0)))
    none = F.array().cast("array<int>")
    lists = []
    for kind, (pattern, group, _, _) in PARTS.items():
        some = F.size(f"m_{kind}") > 0
        whole = _lengths(F.col(f"m_{kind}"))
        part = F.when(some, _lengths(F.regexp_extract_all("body", F.lit(pattern), F.lit(group)))).otherwise(none) if group else whole
        gaps = F.when(some, _lengths(F.split("body", pattern, -1))).otherwise(none)
        mixed = F.transform(f"m_{kind}", lambda m: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]") if kind == "key" else F.lit(True))
        lists.append(F.struct(F.lit(kind).alias("kind"), F.slice(F.arrays_zip(gaps.alias("gap"), whole.alias("len"), part.alias("part"), mixed.alias("fit")), 1, F.size(f"m_{kind}")).alias("hits")))
    listed = found.where(sum((F.size(f"m_{k}") for k in PARTS), F.lit(0)) > 0).select(*KEY, F.inline(F.array(*lists)))
    each = listed.select(*KEY, "kind", F.posexplode("hits").alias("n", "h")).select(*KEY, "kind", "n", F.col("h.*"))
    each = each.dropDuplicates([*KEY, "kind", "n"])  # repeated documents
    order = W.partitionBy(*KEY, "kind").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    placed = each.withColumn("hi", F.sum(F.col("gap") + F.col("len")).over(order)).withColumn("lo", F.col("hi") - F.col("len"))
    least = F.create_map(*[F.lit(x) for k, v in PARTS.items() for x in (k, v[2])])
    role = F.create_map(*[F.lit(x) for k, v in PARTS.items() for x in (k, v[3])])
    rank = F.create_map(*[F.lit(x) for k in PARTS for x in (k, RANK[k])])
    kept = placed.where((F.col("part") >= least[F.col("kind")]) & F.col("fit"))
    return kept.select(*KEY, "kind", rank[F.col("kind")].alias("rank"), role[F.col("kind")].alias("role"), "lo", "hi")


def linked_spans(docs: DataFrame, *, scope: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(document key, kind, rank, lo, hi) of base spans and of weak candidates with their complements."""
    every = parts(docs, doc_id, text)
    is_base = F.col("kind").isin(*BASE)
    by_place = W.partitionBy(*KEY).orderBy("lo", "rank")
    before = F.max(F.when(is_base, F.col("hi"))).over(by_place.rowsBetween(W.unboundedPreceding, 0))
    backwards = W.partitionBy(*KEY).orderBy(F.desc("lo"), F.desc("rank"))  # running minimum, linear in the parts
    after = F.min(F.when(is_base, F.col("lo"))).over(backwards.rowsBetween(W.unboundedPreceding, 0))
    hidden = ~is_base & (F.coalesce(before > F.col("lo"), F.lit(False)) | F.coalesce(after < F.col("hi"), F.lit(False)))
    usable = every.withColumn("hidden", hidden).where(~F.col("hidden")).drop("hidden")
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope))).alias("cell")
    lo, hi = F.col("lo"), F.col("hi")
    others = usable.select(*KEY, cells(lo, hi - 1), F.col("role").alias("o_role"), lo.alias("o_lo"), hi.alias("o_hi"))
    weak = usable.where(~is_base).select("*", cells(lo - scope, hi + scope))
    others = others.withColumnsRenamed({"_id": "o_id", "_text_hash": "o_text_hash", "cell": "o_cell"})
    near = weak.join(
        others,
        F.col("_id").eqNullSafe(F.col("o_id")) & (F.col("_text_hash") == F.col("o_text_hash")) & (F.col("cell") == F.col("o_cell")),
    ).where(F.greatest(lo, F.col("o_lo")) - F.least(hi, F.col("o_hi")) <= scope)
    has = lambda r: F.max(F.col("o_role") == r)
    seen = near.groupBy(*KEY, "kind", "rank", "role", "lo", "hi").agg(has("identifier").alias("with_id"), has("secret").alias("with_secret"))
    needs_id = (F.col("role") == "identifier") | F.col("with_id")
    needs_secret = (F.col("role") == "secret") | F.col("with_secret")
    linked = seen.where(needs_id & needs_secret)
    columns = [*KEY, "kind", "rank", "lo", "hi"]
    return every.where(is_base).select(*columns).union(linked.select(*columns))


def redact_secrets(docs: DataFrame, *, mark: str = "[secret]", scope: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every reported span replaced by `mark`; overlapping spans become one mark."""
    spans = linked_spans(docs, scope=scope, doc_id=doc_id, text=text)
    earlier = W.partitionBy(*KEY).orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, -1)
    heads = spans.withColumn("reach", F.coalesce(F.max("hi").over(earlier), F.lit(0)))
    merged = heads.withColumn("run", F.sum((F.col("lo") >= F.col("reach")).cast("int")).over(W.partitionBy(*KEY).orderBy("lo", "hi")))
    merged = merged.groupBy(*KEY, "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    cuts = merged.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("_cuts")).withColumnsRenamed({"_id": "c_id", "_text_hash": "c_text_hash"})
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_text_hash"))
    joined = rows.join(cuts, F.col("_id").eqNullSafe(F.col("c_id")) & (F.col("_text_hash") == F.col("c_text_hash")), "left")
    body = F.col("row").getField(text)
    starts = F.concat(F.array(F.lit(0)).cast("array<bigint>"), F.col("_cuts.hi"))
    ends = F.concat(F.col("_cuts.lo"), F.array(F.length(body).cast("bigint")))
    piece = lambda a, b: F.substring(body, (a + 1).cast("int"), (b - a).cast("int"))
    clean = F.when(F.col("_cuts").isNull(), body).otherwise(F.array_join(F.zip_with(starts, ends, piece), mark))
    return joined.select(*[clean.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])


def _sql() -> str:
    kinds = []
    for kind, (pattern, group, least, role) in PARTS.items():
        p = "'" + pattern.replace("'", "''") + "'"
        kinds.append(
            f"SELECT id, t, '{kind}' AS kind, {RANK[kind]} AS rank, '{role}' AS role, {least} AS least, regexp_extract_all(t, {p}) AS m, "
            f"regexp_extract_all(t, {p}, {group}) AS g, string_split_regex(t, {p}) AS s FROM d"
        )
    return f"""
WITH d AS (SELECT doc_id AS id, coalesce(text, '') AS t FROM documents),
k AS ({' UNION ALL '.join(kinds)}),
e AS (SELECT id, kind, rank, role, least, unnest(range(1, len(m) + 1)) AS n, m, g, s FROM k WHERE len(m) > 0),
l AS (SELECT id, kind, rank, role, n, length(m[n]) AS w, length(s[n]) AS gap,
             length(g[n]) >= least AND (kind <> 'key' OR (regexp_matches(m[n], '[0-9]') AND regexp_matches(m[n], '[a-z]') AND regexp_matches(m[n], '[A-Z]'))) AS fit FROM e),
c AS (SELECT *, CAST(sum(w + gap) OVER (PARTITION BY id, kind ORDER BY n) AS BIGINT) AS hi FROM l),
p AS (SELECT id, kind, rank, role, hi - w AS lo, hi, kind IN ('assign', 'access', 'hex') AS base FROM c WHERE fit),
u AS (SELECT * FROM p WHERE base OR NOT EXISTS (SELECT 1 FROM p b WHERE b.base AND b.id = p.id AND b.lo < p.hi AND p.lo < b.hi)),
w AS (SELECT a.id, a.kind, a.rank, a.lo, a.hi FROM u a WHERE NOT a.base
      AND (a.role = 'identifier' OR EXISTS (SELECT 1 FROM u b WHERE b.id = a.id AND b.role = 'identifier' AND greatest(a.lo, b.lo) - least(a.hi, b.hi) <= 200))
      AND (a.role = 'secret' OR EXISTS (SELECT 1 FROM u b WHERE b.id = a.id AND b.role = 'secret' AND greatest(a.lo, b.lo) - least(a.hi, b.hi) <= 200))),
x AS (SELECT id, kind, rank, lo, hi, base FROM p WHERE base UNION ALL SELECT id, kind, rank, lo, hi, false FROM w),
a AS (SELECT id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || lo || ':' || hi, ',' ORDER BY lo, rank) FILTER (base) AS base,
             string_agg(kind || ':' || lo || ':' || hi, ',' ORDER BY lo, rank) AS spans FROM x GROUP BY id)
SELECT d.id AS doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON a.id = d.id"""


@query("op6_secret_scan", _sql())
def op6_secret_scan(t) -> DataFrame:
    docs = t("documents")
    spans = linked_spans(docs)
    text = F.concat_ws(":", "kind", "lo", "hi")
    listed = F.array_sort(F.collect_list(F.struct("lo", "rank", text.alias("text"))))
    base = F.array_sort(F.collect_list(F.when(F.col("kind").isin(*BASE), F.struct("lo", "rank", text.alias("text")))))
    tally = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE]
    by_doc = spans.groupBy(*KEY).agg(*tally, F.array_join(F.transform(base, lambda s: s["text"]), ",").alias("base"), F.array_join(F.transform(listed, lambda s: s["text"]), ",").alias("spans"))
    keys = docs.select(F.col("doc_id"), F.xxhash64("text").alias("t_hash"))
    joined = keys.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t_hash") == F.col("_text_hash")), "left")
    return joined.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
