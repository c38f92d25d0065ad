"""Quality rules: a decision list learned by sequential covering, in DataFrame operations only.

`text_statistics` measures whole texts with built-in functions; repeated three-word
windows are found inside the row by sorting (window hash, place) packed into one long,
with as many hash bits as the places leave free. Neighbours of equal hash bits are
compared word by word; a text in which any differ is sorted again by the words
themselves, so the count is exact at any length. The learner then works on that narrow table: it grows a conjunction of
thresholds by FOIL gain on two thirds of the labelled rows, prunes it on the rest, takes
the rows it covers out and starts again, until no rule is precise enough. Each step is
one aggregation to (statistic, bin) counts; candidates are quantiles, so what comes back
does not grow. The list is emitted as one ordered conditional expression.

Edge cases: a null text has no words; several labels of a document count by their
largest; no labels give an empty list, which keeps everything the base checks keep.
Repeated rows are judged alike; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.catalogue import query
from plumbline.session import stage

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_distinct")
RATIOS = {
    "words": ("n_words", None),
    "mean_word": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "mark_share": ("n_marks", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
}


def text_statistics(docs: DataFrame, text: str = "text", place_bits: int = 0) -> DataFrame:
    """Adds the counts in COUNTS (long), in place of columns of those names; others pass through.

    At least `place_bits` bits of a packed long are left to places; results do not depend on it.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), body.alias("_body"))
    rows = rows.withColumns({"_words": F.regexp_extract_all("_body", F.lit(WORD), F.lit(0))})
    lines = F.filter(F.split("_body", "\n", -1), lambda x: x.rlike(WORD))
    rows = rows.withColumns({"_lines": lines, "_codes": F.transform("_words", lambda w: F.xxhash64(w)), "_n": F.size("_words")})
    rows = rows.withColumn("_bits", F.greatest(F.ceil(F.log2(F.col("_n") + 2)).cast("int"), F.lit(place_bits)))
    window = lambda i: F.xxhash64(*[F.get("_codes", i + k) for k in range(3)])
    shift = lambda x: F.call_function("shiftleft", x, F.col("_bits"))
    packed = F.transform(F.sequence(F.lit(0), F.col("_n") - 3), lambda i: shift(window(i)).bitwiseOR(i.cast("long")))
    rows = rows.withColumn("_sorted", F.when(F.col("_n") >= 3, F.sort_array(packed)).otherwise(F.array().cast("array<bigint>")))
    top = lambda x: F.call_function("shiftrightunsigned", x, F.col("_bits"))
    twins = F.zip_with("_sorted", F.slice("_sorted", 2, F.greatest(F.size("_sorted"), F.lit(1))), lambda a, b: F.when(top(a) == top(b), F.array(a, b)))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1
    word = lambda x, k: F.get("_words", x.bitwiseAND(mask).cast("int") + k)
    differs = lambda t: reduce(lambda x, y: x | y, [word(F.get(t, 0), k) != word(F.get(t, 1), k) for k in range(3)])
    rows = rows.withColumn("_twins", F.filter(twins, lambda t: t.isNotNull()))
    # equal hash bits of different windows stand side by side somewhere in their run
    in_words = F.transform(F.sequence(F.lit(0), F.col("_n") - 3), lambda i: F.struct(F.slice("_words", i + 1, F.lit(3)).alias("w"), i.cast("long").alias("place")))
    rows = rows.withColumn("_clash", F.exists("_twins", differs))
    rows = rows.withColumn("_exact", F.when(F.col("_clash"), F.sort_array(in_words)).otherwise(F.array().cast("array<struct<w:array<string>,place:bigint>>")))
    exact = F.zip_with("_exact", F.slice("_exact", 2, F.greatest(F.size("_exact"), F.lit(1))), lambda a, b: F.when(a["w"] == b["w"], F.array(a["place"], b["place"])))
    packed_places = F.transform(F.flatten("_twins"), lambda x: x.bitwiseAND(mask))
    places = F.when(F.col("_clash"), F.flatten(F.filter(exact, lambda t: t.isNotNull()))).otherwise(packed_places)
    rows = rows.withColumn("_places", F.sort_array(F.array_distinct(places)))
    steps = F.zip_with("_places", F.slice("_places", 2, F.greatest(F.size("_places"), F.lit(1))), lambda a, b: F.least(F.lit(3).cast("long"), F.coalesce(b - a, F.lit(3).cast("long"))))
    counted = rows.withColumns(
        {
            "n_words": F.col("_n").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count("_body", F.lit("[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x),
            "n_lines": F.size("_lines").cast("long"),
            "n_upper": F.regexp_count("_body", F.lit("[A-Z]")).cast("long"),
            "n_marks": F.regexp_count("_body", F.lit("[!?]")).cast("long"),
            "n_distinct": F.size(F.array_distinct("_codes")).cast("long"),
        }
    )
    # A filter on a count stays above the generator; pushed below, it would repeat all of these expressions.
    done = counted.select("_row", F.inline(F.array(F.struct(*COUNTS))))
    return done.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in COUNTS], *COUNTS)


def ratio(name: str) -> Column:
    top, bottom = RATIOS[name]
    if bottom is None:
        return F.col(top).cast("double")
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0)).cast("double")


@dataclass(frozen=True)
class Term:
    """`name` above (or not above) a threshold; `bin` is the threshold's place among the candidates."""

    name: str
    above: bool
    threshold: float
    bin: int

    def column(self) -> Column:
        value = ratio(self.name)
        return value > self.threshold if self.above else value <= self.threshold

    def binned(self) -> Column:
        place = F.get("bins", F.lit(list(RATIOS).index(self.name)))
        return place > self.bin if self.above else place <= self.bin

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = list[Term]


def _all(terms: Rule, binned: bool) -> Column:
    return reduce(lambda a, b: a & b, [t.binned() if binned else t.column() for t in terms], F.lit(True))


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; null if none does."""
    verdict = F.when(F.lit(False), F.lit(0))
    for number, terms in enumerate(rules, 1):
        verdict = verdict.when(_all(terms, False), F.lit(number))
    return verdict


def learn_rules(
    labelled: DataFrame,
    *,
    key: str = "doc_id",
    label: str = "label",
    candidates: int = 40,
    max_rules: int = 10,
    max_terms: int = 3,
    precision: float = 0.9,
    support: int = 5,
) -> list[Rule]:
    """Rules that reject label 0, from a table with COUNTS, a key and a 0/1 label."""
    names = list(RATIOS)
    shares = [i / candidates for i in range(1, candidates)]
    rows = labelled.where(F.col(label).isin(0, 1))
    values = rows.select(*[ratio(n).alias(n) for n in names], (F.col(label) == 0).alias("bad"), F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 0, F.lit(False)).alias("prune"))
    asked = [F.percentile_approx(F.when(c, F.col(n)), F.array(*map(F.lit, shares)), 10_000).alias(f"{n}_{k}") for n in names for k, c in (("all", F.lit(True)), ("bad", F.col("bad")))]
    found = values.agg(*asked).first()
    cuts = {n: sorted({v for k in ("all", "bad") for v in (found[f"{n}_{k}"] or [])}) for n in names}
    place = lambda n: F.size(F.filter(F.array(*map(F.lit, cuts[n])).cast("array<double>"), lambda t: t < F.col(n)))
    data = stage(values.select("bad", "prune", F.array(*[place(n) for n in names]).alias("bins"), F.array(*names).alias("values")), "binned")

    rules: list[Rule] = []
    rest = F.lit(True)
    while len(rules) < max_rules:
        rule = _grow(data.where(rest & ~F.col("prune")), names, cuts, max_terms, precision)
        rule = _prune(data.where(rest & F.col("prune")), rule, precision, support)
        if not rule:
            break
        rules.append(_centred(data.where(rest), rule, names))
        rest = rest & ~_all(rule, True)
    return rules


def _centred(data: DataFrame, rule: Rule, names: list[str]) -> Rule:
    """Thresholds moved to the middle between the values left outside and the nearest bad value inside."""
    asked = []
    for i, t in enumerate(rule):
        value = F.get("values", F.lit(names.index(t.name)))
        outside, inside = F.when(~t.binned(), value), F.when(t.binned() & F.col("bad"), value)
        asked += [(F.max if t.above else F.min)(outside).alias(f"o{i}"), (F.min if t.above else F.max)(inside).alias(f"i{i}")]
    found = data.agg(*asked).first()
    middle = lambda i, t: t if found[f"o{i}"] is None or found[f"i{i}"] is None else replace(t, threshold=(found[f"o{i}"] + found[f"i{i}"]) / 2)
    return [middle(i, t) for i, t in enumerate(rule)]


def _grow(data: DataFrame, names: list[str], cuts: dict, max_terms: int, precision: float) -> Rule:
    """Add the term with the best FOIL gain until the rule is pure or long enough."""
    rule: Rule = []
    while len(rule) < max_terms:
        each = data.where(_all(rule, True)).select("bad", F.posexplode("bins").alias("f", "bin"))
        counted = each.groupBy("f", "bin").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
        p0 = sum(r.p for r in counted if r.f == 0)
        n0 = sum(r.n for r in counted if r.f == 0)
        if not p0 or not n0:
            break
        best, best_gain = None, 1e-9
        for f, name in enumerate(names):
            own = sorted((r.bin, r.p, r.n) for r in counted if r.f == f)
            p_low = n_low = 0
            at = 0
            for j, cut in enumerate(cuts[name]):
                while at < len(own) and own[at][0] <= j:
                    p_low, n_low, at = p_low + own[at][1], n_low + own[at][2], at + 1
                for above, p, n in ((True, p0 - p_low, n0 - n_low), (False, p_low, n_low)):
                    if p and p + n < p0 + n0:
                        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                        if gain > best_gain:
                            best, best_gain = Term(name, above, cut, j), gain
        if best is None:
            break
        rule.append(best)
    return rule


def _prune(data: DataFrame, rule: Rule, precision: float, support: int) -> Rule:
    """The prefix with the best (p - n) / (p + n) on unseen rows; none if it is not precise."""
    if not rule:
        return []
    asked = []
    for i in range(1, len(rule) + 1):
        holds = _all(rule[:i], True)
        asked += [F.count_if(holds & F.col("bad")).alias(f"p{i}"), F.count_if(holds & ~F.col("bad")).alias(f"n{i}")]
    found = data.agg(*asked).first()
    scored = [((p - n) / (p + n), -i, i, p, n) for i in range(1, len(rule) + 1) if (p := found[f"p{i}"]) + (n := found[f"n{i}"]) > 0]
    if not scored:
        return []
    _, _, length, p, n = max(scored)
    return rule[:length] if p >= support and p / (p + n) >= precision else []


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(stats: DataFrame, labels: DataFrame, **options) -> tuple[DataFrame, list[Rule]]:
    """`stats` (rows with COUNTS and doc_id) with base_failed, rule (number or null) and kept; written once."""
    stats = stage(stats, "statistics")
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("label"))
    rules = learn_rules(stats.where(~base_failed()).select("doc_id", *COUNTS).join(known, "doc_id"), **options)
    judged = stats.withColumns({"base_failed": base_failed(), "rule": decision(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules


@query("op5_quality_rules")
def op5_quality_rules(t) -> DataFrame:
    judged, _ = judge(text_statistics(t("documents").select("doc_id", "text")).drop("text"), t("labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
