"""Quality rules: a decision list learned by sequential covering, emitted as one ordered Spark conditional.

Each document is reduced to counts over its whole text; whole-number features (mostly shares in thousandths) are
derived from them. A rule is a conjunction of thresholds that marks bad documents. It is grown on two thirds of the
labelled documents by information gain over exact value counts, then its last conditions are pruned on the other
third; covered documents leave, and the next rule is learned. Learning stops when a rule is not precise enough. The
value counts of a step are one small aggregate over the labelled statistics; only they reach the driver.

Only DataFrame functions are used. Defined results: a NULL or empty text has no words and fails the base rule. A
label row without document, or a document without label, does not take part in learning; a document labelled more
than once counts as bad if any label says so. Without labels of both kinds no rule is learned, and the base rule
alone decides. Repeated rows are judged alike; columns of the input named like a result are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.arrow import quoted
from clientele.sources.storage import store

SPACES = "[\\x20\\x09-\\x0D]+"
MIN_WORDS = 50
POSITION_BITS = 24  # of a packed window; the other 40 bits hold its hash. Longer texts have structs instead
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_exclaims", "n_digits", "n_distinct_words")


def text_counts(docs: DataFrame) -> DataFrame:
    """Add the counts of ``BASE`` and ``MORE`` to each document.

    Repeated three-word windows: packed (window hash, position) values are sorted, neighbours with equal hashes
    are candidates, and those are compared by their words, so hash collisions change nothing. Texts of too many words
    for a packed position have structs of hash and position.
    """

    def kept_length(pattern: str) -> Column:
        return F.length(F.regexp_replace("_text", pattern, "")).cast("long")

    def window(i: Column) -> list[Column]:
        return [F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)]

    def bits(x: Column) -> Column:
        return F.shiftright(x, POSITION_BITS)

    def same(array: str, i: Column, part: Callable[[Column], Column]) -> Column:
        x = F.get(array, i)
        return F.coalesce(part(F.get(array, i - 1)) == part(x), F.lit(False)) | F.coalesce(
            part(F.get(array, i + 1)) == part(x), F.lit(False)
        )

    def empty(kind: str) -> Column:
        return F.array().cast(f"array<{kind}>")

    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    found = docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    found = found.withColumns({"_words": F.array_remove(F.split("_text", SPACES), ""), "_lines": lines})
    starts = F.sequence(F.lit(0), F.size("_words") - 3)
    packable = F.size("_words") <= 1 << POSITION_BITS
    pairs = F.transform(starts, lambda i: F.struct(F.xxhash64(*window(i)).alias("hash"), i.alias("at")))
    packed = F.transform(
        starts,
        lambda i: F.shiftleft(F.xxhash64(*window(i)), POSITION_BITS).bitwiseOR(i.cast("long")),
    )
    found = found.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": kept_length("[^#*$%&|<>]+"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_upper": kept_length("[^\\p{Lu}]+"),
        "n_exclaims": kept_length("[^!]+"),
        "n_digits": kept_length("[^0-9]+"),
        "n_distinct_words": F.size(F.array_distinct("_words")).cast("long"),
        "_packed": F.when((F.size("_words") >= 3) & packable, F.sort_array(packed)).otherwise(empty("bigint")),
        "_pairs": F.when((F.size("_words") >= 3) & ~packable, F.sort_array(pairs)).otherwise(empty("struct<hash:bigint,at:int>")),
    })
    position = (1 << POSITION_BITS) - 1
    candidates = F.filter("_packed", lambda x, i: same("_packed", i, bits))
    paired = F.filter("_pairs", lambda x, i: same("_pairs", i, lambda p: p["hash"]))
    found = found.withColumn("_candidates", F.when(
        packable, F.transform(candidates, lambda x: x.bitwiseAND(position).cast("int"))
    ).otherwise(F.transform(paired, lambda p: p["at"])))
    spelled = F.transform("_candidates", lambda x: F.struct(
        *[w.alias(f"w{k}") for k, w in enumerate(window(x))], x.alias("at"),
    ))
    found = found.withColumn("_windows", F.sort_array(spelled))
    equal = F.filter("_windows", lambda x, i: same("_windows", i, lambda w: F.struct(w["w0"], w["w1"], w["w2"])))
    found = found.withColumn("_at", F.sort_array(F.transform(equal, lambda w: w["at"])))
    covered = F.aggregate(
        F.transform("_at", lambda a, i: F.least(F.lit(3), F.coalesce(F.get("_at", i + 1) - a, F.lit(3))).cast("long")),
        F.lit(0).cast("long"), lambda total, n: total + n,
    )
    helpers = ("_text", "_words", "_lines", "_packed", "_pairs", "_candidates", "_windows", "_at")
    return found.withColumn("n_repeat_words", covered).drop(*helpers)


def features() -> dict[str, Column]:
    """Whole numbers from 0 to 1000, so that exact value counts stay small."""

    def share(part: str, whole: str, scale: int = 1000) -> Column:
        value = F.floor(F.col(part) * scale / F.greatest(F.col(whole), F.lit(1)))
        return F.least(value, F.lit(1000)).cast("int")

    return {
        "symbols_per_1000_chars": share("n_symbols", "word_chars"),
        "repeats_per_1000_words": share("n_repeat_words", "n_words"),
        "dup_lines_per_1000": share("n_dup_lines", "n_lines"),
        "upper_per_1000_chars": share("n_upper", "word_chars"),
        "exclaims_per_1000_words": share("n_exclaims", "n_words"),
        "digits_per_1000_chars": share("n_digits", "word_chars"),
        "distinct_per_1000_words": share("n_distinct_words", "n_words"),
        "tenths_of_mean_word": share("word_chars", "n_words", 10),
        "words_up_to_1000": F.least(F.col("n_words"), F.lit(1000)).cast("int"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: int

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.at_least else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold}"


Rule = tuple[Condition, ...]


def matches(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in rule], F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rejected_by(rules: list[Rule]) -> Column:
    """Text of the first rule that a document meets; NULL if it meets none."""
    first = F.lit(None).cast("string")
    for rule in reversed(rules):
        first = F.when(matches(rule), F.lit(" and ".join(map(str, rule)))).otherwise(first)
    return first


def labelled(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of labelled documents with ``bad`` and ``grow`` (false for the pruning third)."""
    judged = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    kept = counts.filter("doc_id is not null").select("doc_id", *BASE, *MORE).join(judged, "doc_id")
    return kept.withColumn("grow", F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0)


def _gain(p: int, n: int, all_p: int, all_n: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n))) if p else 0.0


def _best_condition(rows: DataFrame) -> Condition | None:
    """The threshold that gains most on the growing part of ``rows``; None if none gains."""
    names = list(features())
    counts = (
        rows.filter("grow").select("bad", F.posexplode(F.array(*features().values())).alias("f", "value"))
        .groupBy("f", "value").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
    )
    best: tuple[float, int, bool, int] | None = None
    for f in range(len(names)):
        values = sorted((r["value"], r["p"], r["n"]) for r in counts if r["f"] == f)
        all_p, all_n = sum(v[1] for v in values), sum(v[2] for v in values)
        if not all_p or not all_n:
            return None
        for at_least in (True, False):
            p = n = 0
            for value, dp, dn in reversed(values) if at_least else values:
                p, n = p + dp, n + dn
                if p + n < all_p + all_n and (gain := _gain(p, n, all_p, all_n)) > (best[0] if best else 1e-9):
                    best = (gain, f, at_least, value)
    return Condition(names[best[1]], best[2], best[3]) if best else None


def learn(
    examples: DataFrame, max_rules: int = 12, max_conditions: int = 4, min_precision: float = 0.9, min_covered: int = 5
) -> list[Rule]:
    """The ordered rules that mark bad documents; see the module text."""
    rules: list[Rule] = []
    remaining = examples
    while len(rules) < max_rules:
        rule: Rule = ()
        rows = remaining
        while len(rule) < max_conditions and (condition := _best_condition(rows)):
            rule = (*rule, condition)
            rows = rows.filter(condition.column())
        if not rule:
            break
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        counts = remaining.agg(*[
            F.count_if(matches(r) & (F.col("bad") == bad) & (F.col("grow") == grow)).alias(f"c{k}_{bad:d}{grow:d}")
            for k, r in enumerate(prefixes) for bad in (True, False) for grow in (True, False)
        ]).first()

        def worth(k: int, counts: dict = counts) -> float:
            p, n = counts[f"c{k}_10"], counts[f"c{k}_00"]
            return (p - n) / (p + n) if p + n else -1.0

        k = max(range(len(prefixes)), key=lambda k: (worth(k), -k))
        p, n = (counts[f"c{k}_{b}0"] + counts[f"c{k}_{b}1"] for b in (1, 0))
        if p < min_covered or p / (p + n) < min_precision:
            break
        rules.append(prefixes[k])
        remaining = remaining.filter(~matches(prefixes[k]))
    return rules


def judged(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``base_failed``, ``rejected_by`` and ``kept`` to documents with counts."""
    return counts.withColumns({"base_failed": base_failed(), "rejected_by": rejected_by(rules)}).withColumn(
        "kept", ~F.col("base_failed") & F.col("rejected_by").isNull()
    )


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of each document; the text is read once."""
    counts = store(text_counts(docs.select("doc_id", "text")).drop("text"), "text_counts")
    return judged(counts, learn(store(labelled(counts, labels), "labelled_counts")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns; learned from those of them that are labelled."""
    examples = store(labelled(text_counts(docs.select("doc_id", "text")).drop("text"), labels), "labelled_counts")
    body = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row")
    judged_rows = judged(text_counts(docs.select(body, F.col("text"))), learn(examples))
    # a filter that moved below the counts would compute them anew for each use: one on the task's number stays above
    passed = judged_rows.withColumn("_task", F.spark_partition_id()).filter("kept and _task >= 0")
    return passed.select("_row.*")
