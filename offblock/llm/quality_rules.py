"""Operator 13, quality rules: a decision list learned by sequential covering, built-in functions only.

Every document's statistics are computed from its whole text. Rules for bad
documents (label 0) are learned one after another from labelled documents: a
rule grows by the condition (statistic, side, threshold) of the highest
information gain on two thirds of the rows that no earlier rule covers, loses
those last conditions that do not help on the other third, and is kept while it
is right often enough there. The list becomes one ordered Spark conditional:
the first rule that fits a document decides, and a document that none fits stays.

Each step of growth is one aggregate of counts by statistic and bin; at most
len(FEATURES) * (BINS + 1) rows reach the driver. Learning reads at most about
SAMPLE labelled rows, chosen by a hash of the id (the documented bound of the
fit); the statistics and verdicts cover all documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offblock.llm.common import BLANKS, written

WINDOW = 5
FEATURES = ["n_words", "mean_word", "symbol_share", "upper_share", "digit_share", "mark_share", "dup_line_share",
            "repeat_share", "variety", "line_words"]
#: Labelled rows that are learned from, about.
SAMPLE = 100_000
#: Thresholds of a statistic are its quantiles in so many parts.
BINS = 32
MAX_RULES, MAX_CONDITIONS = 12, 4
#: A rule is kept if at least so many pruning rows fit it, of which this share is bad.
LEAST_ROWS, LEAST_PRECISION = 3, 0.9


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value > threshold; else value <= threshold
    threshold: float

    def column(self) -> Column:
        x = F.col(self.feature)
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def text_stats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base counts, and FEATURES (doubles) of every row's whole text.

    Words are runs of other characters than blanks, as they are. n_repeat_words:
    hashes of all five-word windows are sorted with their places; the places that
    share a hash are sorted again, and the words they cover are counted. Arrays
    are sorted inside the row, nothing is shuffled.
    """
    blank = F.lit("[\\x20\\x09-\\x0D]+")
    d = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    body = F.btrim(F.col("t"), F.lit(BLANKS))
    none = F.array().cast("array<string>")
    d = d.select("doc_id", "t", F.when(body == "", none).otherwise(F.split(body, "[\\x20\\x09-\\x0D]+")).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"))
    count = lambda cls: F.regexp_count("t", F.lit(cls)).cast("long")
    d = d.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        count("[A-Z]").alias("n_upper"), count("[0-9]").alias("n_digits"), count("[!?]").alias("n_marks"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("w"))

    def paired(c: str, e: str, skip: int) -> Column:
        return F.zip_with(c, F.slice(e, skip + 1, F.greatest(F.size(e) - skip, F.lit(0))), lambda x, y: F.xxhash64(x, y))

    keep = [c for c in d.columns if c != "w"]
    d = d.select(*keep, "w", F.size(F.array_distinct("w")).cast("long").alias("n_distinct"), paired("w", "w", 1).alias("h2"))
    keep.append("n_distinct")
    d = d.select(*keep, "w", paired("h2", "h2", 2).alias("h4"))
    # windows that reach past the end are cut off
    d = d.select(*keep, F.slice(paired("h4", "w", WINDOW - 1), 1, F.greatest(F.size("w") - (WINDOW - 1), F.lit(0))).alias("h"))
    seen = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    d = d.select(*keep, F.when(F.size(F.array_distinct("h")) < F.size("h"), seen).alias("s"))
    after = lambda c: F.slice(c, 2, F.greatest(F.size(c), F.lit(0)))
    d = d.select(*keep, "s", F.zip_with("s", after("s"), lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))).alias("e"))
    marked = F.zip_with("s", "e", lambda x, b: F.struct(x["i"].alias("i"), b.alias("b")))
    places = F.zip_with(F.concat(F.array(F.lit(False)), "e"), marked, lambda prev, q: F.when(prev | q["b"], q["i"]))
    d = d.select(*keep, F.sort_array(F.array_compact(places)).alias("p"))
    cover = F.zip_with("p", after("p"), lambda x, y: F.least(F.lit(WINDOW), F.coalesce(y - x, F.lit(WINDOW))))
    n_repeat = F.when(F.col("p").isNull(), F.lit(0)).otherwise(F.aggregate(cover, F.lit(0), lambda s, x: s + x)).cast("long")
    d = d.select(*keep, n_repeat.alias("n_repeat_words"))
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    # the exponent of distinct words by words, which falls much less with a text's length than their share
    variety = F.coalesce(F.log("n_distinct") / F.nullif(F.log("n_words"), F.lit(0.0)), F.lit(1.0))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word"), share("n_symbols", "n_words").alias("symbol_share"),
        share("n_upper", "word_chars").alias("upper_share"), share("n_digits", "word_chars").alias("digit_share"),
        share("n_marks", "n_words").alias("mark_share"), share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"), variety.alias("variety"),
        share("n_words", "n_lines").alias("line_words"))


def labelled(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """FEATURES, bad (0/1) and fold (2: pruning) of about `sample` labelled rows of stats.

    Labels other than 0 and 1 are left out; an id with both counts as bad.
    Rows without an id have no label.
    """
    y = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    y = y.groupBy("doc_id").agg((1 - F.min("y")).alias("bad"))
    n = y.count()
    key = F.xxhash64("doc_id")
    if n > sample:
        y = y.where(F.pmod(key, F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    rows = stats.select("doc_id", *FEATURES).join(y, "doc_id")
    return rows.select(*[F.col(c).cast("double").alias(c) for c in FEATURES], "bad", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)).alias("fold"))


def gain(p0: int, n0: int, p1: int, n1: int) -> float:
    """Information gain of a condition that leaves p1 bad and n1 good of p0 and n0 rows."""
    if not p1:
        return 0.0
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))


def best_condition(counts: dict[tuple[int, int], tuple[int, int]], cuts: list[list[float]]) -> tuple[float, int, bool, int] | None:
    """(gain, feature, above, cut) of the best condition by counts {(feature, bin): (bad, good)}; earliest of equals."""
    p0, n0 = (sum(v[k] for (f, _), v in counts.items() if f == 0) for k in (0, 1))
    best = None
    for f, at in enumerate(cuts):
        p = n = 0
        for b in range(len(at)):  # bins 0..b hold the values <= cut b
            p, n = p + counts.get((f, b), (0, 0))[0], n + counts.get((f, b), (0, 0))[1]
            for above, x, y in ((False, p, n), (True, p0 - p, n0 - n)):
                g = gain(p0, n0, x, y)
                if g > 1e-9 and (best is None or g > best[0] + 1e-9):
                    best = (g, f, above, b)
    return best


def tightest(rule: list[tuple[int, bool, int]]) -> list[tuple[int, bool, int]]:
    """rule with one condition a statistic and side: the one that implies the others."""
    bound: dict[tuple[int, bool], int] = {}
    for f, above, b in rule:
        bound[f, above] = (max if above else min)(b, bound.get((f, above), b))
    return [(f, above, b) for (f, above), b in bound.items()]


def learn_rules(rows: DataFrame) -> list[Rule]:
    """The decision list of labelled rows (FEATURES, bad, fold); empty without bad or without rows."""
    quantiles = [i / BINS for i in range(1, BINS)]
    found = rows.agg(*[F.percentile(c, F.lit(quantiles)).alias(c) for c in FEATURES]).first()
    cuts = [sorted(set(found[c] or [])) for c in FEATURES]

    def bin_of(c: str, at: list[float]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(x) for x in at]), lambda x: x < F.col(c))) if at else F.lit(0)

    bins = [bin_of(c, at).alias(c) for c, at in zip(FEATURES, cuts, strict=True)]
    # one row for each set of bins: what learning reads does not grow with copies
    cells = written(rows.select(*bins, "bad", F.when(F.col("fold") == 2, 1).otherwise(0).alias("fold")).groupBy(*FEATURES, "fold").agg(
        F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).coalesce(1), "labelled")

    def fits(rule: list[tuple[int, bool, int]]) -> Column:
        tests = [F.col(FEATURES[f]) > b if above else F.col(FEATURES[f]) <= b for f, above, b in rule]
        return reduce(lambda x, y: x & y, tests, F.lit(True))

    rules: list[list[tuple[int, bool, int]]] = []
    left = cells
    for _ in range(MAX_RULES):
        grow, rule = left.where("fold = 0"), []
        while len(rule) < MAX_CONDITIONS:
            each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(c).alias("b")) for f, c in enumerate(FEATURES)]))
            sums = grow.where(fits(rule)).select(each.alias("x"), "p", "n").groupBy("x.f", "x.b").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
            counts = {(r["f"], r["b"]): (r["p"], r["n"]) for r in sums.collect()}
            if not sum(v[0] for v in counts.values()) or not sum(v[1] for v in counts.values()):
                break
            best = best_condition(counts, cuts)
            if best is None:
                break
            rule.append(best[1:])
        if not rule:
            break
        prefixes = [fits(rule[: k + 1]) for k in range(len(rule))]
        sums = [F.coalesce(F.sum(F.when(x, F.col(c))), F.lit(0)).alias(f"{c}{k}") for k, x in enumerate(prefixes) for c in "pn"]
        r = left.where("fold = 1").agg(*sums).first()
        worth = [((r[f"p{k}"] - r[f"n{k}"]) / (r[f"p{k}"] + r[f"n{k}"]) if r[f"p{k}"] + r[f"n{k}"] else -1.0) for k in range(len(rule))]
        k = max(range(len(rule)), key=lambda k: (worth[k], -k))
        rule = rule[: k + 1]
        p, n = r[f"p{k}"], r[f"n{k}"]
        if p + n < LEAST_ROWS or p < LEAST_PRECISION * (p + n):
            break
        rules.append(rule)
        left = left.where(~fits(rule))
    return [tuple(Condition(FEATURES[f], above, cuts[f][b]) for f, above, b in tightest(rule)) for rule in rules]


def fired(rules: list[Rule]) -> Column:
    """The text of the first rule that fits a row, null if none does: one ordered conditional."""
    out = None
    for rule in rules:
        test = reduce(lambda x, y: x & y, (c.column() for c in rule))
        name = F.lit(" and ".join(map(str, rule)))
        out = F.when(test, name) if out is None else out.when(test, name)
    return F.lit(None).cast("string") if out is None else out


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """stats with base_failed, kept and rule (that speaks against the document, if any)."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    d = stats.withColumn("base_failed", failed).withColumn("rule", fired(rules))
    return d.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op13_quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and rule for every row of documents.

    A null text has no words and fails the base test, as an empty one does.
    Repeated rows and ids are judged each by themselves; rows without an id are
    judged, not learned from. Empty tables give an empty result; without usable
    labels no rule is learned, and only the base test rejects. Equal gains are
    decided by the order of FEATURES, then of the thresholds. Other columns are not read.
    """
    stats = written(text_stats(documents), "stats")
    rules = learn_rules(labelled(stats, labels))
    return judge(stats, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept", "rule")
