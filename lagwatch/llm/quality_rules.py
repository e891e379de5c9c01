"""Learned decision lists over text statistics; DataFrame functions only.

``statistics`` computes each text's numbers with built-in functions. ``learn`` runs sequential covering
on the labelled rows: a rule for "reject" grows by the threshold condition of highest information gain
on two thirds of the rows, is pruned on the other third, and the rows it covers leave; this repeats
until no rule is precise enough. Every step is one distributed count over quantile
bins, of which only (features x bins) rows reach the driver, so all labelled rows take part.
The list becomes one ordered conditional expression.

Nulls: a null text has no words and fails the base rule. Null labels are not learnt from. With no
labelled rows, or labels of one kind only, the list is empty and keeps everything.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwatch.llm.common import held_out, stage

SPACE = " \t\n\x0b\f\r"
BINS = 24
MOST_RULES = 12
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.9
LEAST_ROWS = 4

#: Features of the learner: name and expression over the columns of ``statistics``.
FEATURES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "echo_share": "n_echoes / greatest(n_words, 1)",
    "words": "cast(n_words as double)",
}


@dataclass(frozen=True)
class Condition:
    """``feature <= limit`` or, if ``above``, ``feature > limit``."""

    feature: str
    limit: float
    above: bool

    def column(self) -> Column:
        value = F.col(f"f_{self.feature}")
        return value > self.limit if self.above else value <= self.limit

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.limit:.6g}"


Rule = tuple[Condition, ...]


def statistics(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and the numbers that base rules and features read."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.btrim("t", F.lit(SPACE))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t")).select(
        "doc_id",
        "t",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \t-\r]+")).alias("w"),
        F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("lines"),
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("w") - 3),
        lambda i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")),
    )
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    counted = base.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        (F.length("t") - F.regexp_count("t", F.lit("[ \t-\r]"))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit("!")).cast("long").alias("n_marks"),
        F.regexp_count("t", F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda x, i: x == F.get("w", i - 1))).cast("long").alias("n_echoes"),
        F.sort_array(F.when(F.size("w") >= 3, windows).otherwise(empty)).alias("s"),
    )
    twice = F.filter(
        "s",
        lambda x, i: F.coalesce(F.get("s", i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("s", i + 1)["h"] == x["h"], F.lit(False)),
    )
    at = counted.withColumn("p", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("s")
    # each repeated window adds the words up to the next one, three at most
    added = F.transform("p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - x, F.lit(3))))
    total = F.aggregate(added, F.lit(0).cast("long"), lambda a, x: a + x)
    return at.withColumn("n_repeat_words", total).drop("p")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def with_features(stats: DataFrame) -> DataFrame:
    return stats.withColumns({f"f_{k}": F.expr(v).cast("double") for k, v in FEATURES.items()})


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one conditional expression; true keeps."""
    if not rules:
        return F.lit(True)
    out = None
    for rule in rules:
        test = _all(rule)
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return out.otherwise(F.lit(True))


def _with_middles(cuts: list[float]) -> list[float]:
    return sorted({*cuts, *((a + b) / 2 for a, b in zip(cuts, cuts[1:], strict=False))})


def _cuts_below(column: str, cuts: list[float]) -> Column:
    limits = F.array(*map(F.lit, cuts)).cast("array<double>")
    return F.size(F.filter(limits, lambda x: x < F.col(column)))


def _all(rule: Rule) -> Column:
    test = F.lit(True)
    for condition in rule:
        test = test & condition.column()
    return test


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    """Information gain of going from (p0, n0) to (p, n) covered rows."""
    if p == 0:
        return -math.inf
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn(stats: DataFrame, labels: DataFrame, name: str = "rules") -> list[Rule]:
    """Rules that tell rejected rows (label quality 0) by their statistics, most general first."""
    chosen = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    chosen = chosen.groupBy("doc_id").agg((F.max("quality") == 0).cast("int").alias("bad"))
    rows = with_features(stats.filter(~base_failed())).join(chosen, "doc_id")
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0
    names = [f"f_{k}" for k in FEATURES]
    rows = stage(rows.select("bad", part.alias("prune"), *names), f"{name}-rows")
    shares = [i / BINS for i in range(1, BINS)]
    found = rows.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in names]).first()
    bad = rows.filter("bad = 1").agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in names]).first()
    cuts = {c: _with_middles(sorted({*(found[c] or []), *(bad[c] or [])})) for c in names}
    cells = [
        F.struct(
            F.lit(i).alias("f"),  # feature, and the number of its cuts below the value
            _cuts_below(c, cuts[c]).alias("b"),
        )
        for i, c in enumerate(names)
    ]
    rows = stage(rows.withColumn("cells", F.array(*cells)), f"{name}-cells")

    def counts(open_rows: DataFrame) -> list[tuple[int, int, int, int]]:
        cell = open_rows.select("bad", F.explode("cells").alias("c"))
        got = cell.groupBy("c.f", "c.b").agg(F.sum("bad").alias("p"), F.count(F.lit(1)).alias("n")).collect()
        return [(r["f"], r["b"], int(r["p"]), int(r["n"] - r["p"])) for r in got]

    rules: list[Rule] = []
    for _ in range(MOST_RULES):
        left = rows.filter(verdict(rules))
        rule: Rule = ()
        while len(rule) < MOST_CONDITIONS:
            got = counts(left.filter(~F.col("prune")).filter(_all(rule)))
            p0 = sum(p for f, _, p, _ in got if f == 0)
            n0 = sum(n for f, _, _, n in got if f == 0)
            if not p0 or not n0:
                break
            best, top = None, 1e-9
            for f, column in enumerate(names):
                p = n = 0
                by_bin = {b: (x, y) for g, b, x, y in got if g == f}
                for b, cut in enumerate(cuts[column]):
                    x, y = by_bin.get(b, (0, 0))
                    p, n = p + x, n + y
                    for above, (pp, nn) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        gain = _gain(pp, nn, p0, n0)
                        # of equal gains the condition that rejects least: values nobody has seen are kept
                        if pp >= LEAST_ROWS and (gain > top or above and best and gain == top and best.feature == column[2:]):
                            best, top = Condition(column[2:], float(cut), above), gain
            if best is None:
                break
            rule += (best,)
        if not rule:
            break
        # prune: the shortest beginning of the rule that is best on the rows kept back
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        sums = [F.sum(_all(r).cast("int") * F.col(x)).alias(f"{x}{i}") for i, r in enumerate(prefixes) for x in ("bad", "good")]
        held = left.withColumn("good", 1 - F.col("bad")).groupBy("prune").agg(*sums).collect()
        total = {bool(h["prune"]): h for h in held}
        scored = []
        for i, prefix in enumerate(prefixes):
            p, n = ((total[True][f"{x}{i}"] or 0) if True in total else 0 for x in ("bad", "good"))
            pg, ng = (total[False][f"{x}{i}"] or 0 for x in ("bad", "good"))
            scored.append(((p - n) / (p + n) if p + n else -1.0, -i, prefix, p + pg, n + ng))
        _, _, rule, p, n = max(scored, key=lambda s: s[:2])
        if p < LEAST_ROWS or p < LEAST_PRECISION * (p + n):
            break
        rules.append(rule)
    return rules


def judge(docs: DataFrame, labels: DataFrame, name: str = "rules") -> tuple[DataFrame, list[Rule]]:
    """Statistics, base_failed and kept for every row of ``docs``, and the learnt list."""
    stats = stage(statistics(docs), f"{name}-statistics")
    rules = learn(stats, labels, name)
    kept = F.when(base_failed(), F.lit(False)).otherwise(verdict(rules))
    judged = with_features(stats).withColumn("base_failed", base_failed()).withColumn("kept", kept)
    return judged, rules
