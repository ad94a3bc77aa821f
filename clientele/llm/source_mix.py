"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words: its share of the whole corpus by weight, at most ``MOST_COPIES`` times its own
words, the excess reshared by weight. Inside a source a document's expected copies are proportional to the share of
its words that are distinct, in quarters, again at most ``MOST_COPIES``: texts that repeat themselves are repeated
less. The whole part of the expected copies is certain. The rest is the inclusion probability p of one more copy:
documents are ranked by the odds of a random number over the odds of p, and the first ones whose words fit the
words left are taken. One that no longer fits is passed over and the rest of the ranking goes on with what is left, at
most ``ROUNDS`` times or until under ``TOLERANCE`` of the target is open, so a source ends just below its target.

The random number is a hash of seed, id and text, so reruns agree on any cluster. Only columns of a few bytes are
ranked: counts per 1/4096 of the ranking tell in which one the words run out, and only its documents are ordered.

Defined results: a NULL or empty text has size 0 and is never taken; a NULL source is a source like the others,
the last one. Rows equal in id and text have equal ranks and are taken together or not at all. An empty table gives
an empty result. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.arrow import quoted
from clientele.sources.storage import store

MOST_COPIES = 3
LEVELS = 4  # classes of the share of distinct words
ROUNDS = 8
TOLERANCE = 0.0005
RANK_BITS, RANGE_BITS = 52, 12

RESULTS = ("size", "source_size", "target", "taken")
_SPACES = r"[\x20\x09-\x0D]+"
_BEYOND = 1 << 62


def _levelled(docs: DataFrame, text: str) -> DataFrame:
    """Add ``_size`` (words) and ``_level`` (quarter of distinct words, 1 to 4)."""
    words = F.array_remove(F.split(F.coalesce(F.col(quoted(text)), F.lit("")), _SPACES), "")
    sized = docs.withColumn("_words", words).withColumn("_size", F.size("_words").cast("long"))
    share = F.size(F.array_distinct("_words")) * LEVELS / F.col("_size")
    return sized.withColumn("_level", F.when(F.col("_size") > 0, F.ceil(share).cast("int")).otherwise(LEVELS)).drop("_words")


def filled(items: DataFrame, by: Sequence[str], weight: str, most: str, total: str) -> DataFrame:
    """Add ``share``: ``total`` dealt by ``weight`` inside each group, nobody above ``most``, the excess reshared.

    Items are ordered by the level at which they are full; those before an item are full at its level, so its level
    is what they leave over the weights that remain. The water stands at the highest of these levels.
    """
    order = F.col(most) / F.col(weight), F.col(weight)
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col(total) - F.coalesce(F.sum(most).over(before), F.lit(0))) / F.sum(weight).over(onward)
    levels = items.withColumn("_water", level)
    water = F.max("_water").over(Window.partitionBy(*by))
    return levels.withColumn("share", F.least(F.col(most).cast("double"), water * F.col(weight))).drop("_water")


def targets(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``target`` of each (``_source``, ``source_size``): one row a source reaches the window, whatever the corpus."""
    number = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    dealt = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    numbered = sources.withColumns({"_weight": dealt, "_most": F.col("source_size") * MOST_COPIES, "_one": F.lit(1)})
    whole = numbered.withColumn("_total", F.sum("source_size").over(Window.partitionBy("_one")))
    return filled(whole, ["_one"], "_weight", "_most", "_total").select("_source", "source_size", F.col("share").alias("target"))


def _expected(measured: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Per source: words, target, certain copies and inclusion probability of each level, words left to the sample."""
    classes = store(measured.groupBy("_source", "_level").agg(F.sum("_size").alias("_class_size")), "mix_classes")
    aims = targets(classes.groupBy("_source").agg(F.sum("_class_size").alias("source_size")), weights)
    names = aims.withColumnRenamed("_source", "_name")
    joined = classes.join(names, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name").filter("_class_size > 0")
    joined = joined.withColumns({"_weight": F.col("_level") * F.col("_class_size"), "_most": F.col("_class_size") * MOST_COPIES})
    copies = F.col("share") / F.col("_class_size")
    whole = F.floor(copies + 1e-9)
    chance = F.when(copies - whole > 1e-9, copies - whole).otherwise(0.0)
    dealt = filled(joined, ["_source"], "_weight", "_most", "target").select(
        "_source", "_level", "_class_size", whole.alias("whole"), chance.alias("chance"),
    )
    by_level = F.map_from_entries(F.collect_list(F.struct("_level", F.struct("whole", "chance"))))  # at most LEVELS entries
    of_source = dealt.groupBy("_source").agg(by_level.alias("copies"), F.sum(F.col("whole") * F.col("_class_size")).alias("certain"))
    same = F.col("_source").eqNullSafe(F.col("_name"))
    plan = names.join(of_source, same, "left").drop("_source").withColumnRenamed("_name", "_source")
    left = F.greatest(F.floor(F.col("target") + 1e-6) - F.coalesce("certain", F.lit(0)), F.lit(0))
    return plan.select("_source", "source_size", "target", "copies", left.cast("long").alias("left"))


def _chance() -> Column:
    return F.coalesce(F.col("copies")[F.col("_level")]["chance"], F.lit(0.0))


def _rank(uniform: Column, chance: Column) -> Column:
    """Odds of the random number over the odds of inclusion, mapped from (0, inf) to ``RANK_BITS`` bits."""
    below, above = uniform * (1 - chance), (1 - uniform) * chance
    return F.floor(below / (below + above) * float(1 << RANK_BITS)).cast("long")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    named = plan.withColumnRenamed("_source", "_name")
    return rows.join(named, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")


def _ranked(measured: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents with a chance of one more copy: ``_source``, ``_size``, ``_rank``."""
    rows = _with_plan(measured.filter("_size > 0"), plan).filter((_chance() > 0) & (F.col("left") > 0))
    return rows.select("_source", "_size", _rank(F.col("_uniform"), _chance()).alias("_rank"))


def _next_round(ranked: DataFrame, state: DataFrame) -> DataFrame:
    """Per open source: where in the ranking its words run out now, and what is left then."""
    open_rows = _with_plan(ranked, state.filter("open").select("_source", "left", "low"))
    fitting = open_rows.filter((F.col("_rank") > F.col("low")) & (F.col("_size") <= F.col("left")))
    fitting = fitting.withColumn("_range", F.shiftright("_rank", RANK_BITS - RANGE_BITS))
    ordered = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (
        fitting.groupBy("_source", "_range").agg(F.sum("_size").alias("_in"), F.any_value("left").alias("left"))
        .withColumn("_upto", F.sum("_in").over(ordered))
    )
    full = F.col("_upto") > F.col("left")
    crossing = ranges.groupBy("_source").agg(
        F.min(F.when(full, F.col("_range"))).alias("_crossing"), F.max(F.when(~full, F.col("_upto"))).alias("_below"),
    ).withColumn("_below", F.coalesce("_below", F.lit(0)))
    inside = _with_plan(fitting, crossing).filter("_range = _crossing").groupBy("_source", "_rank").agg(
        F.sum("_size").alias("_in"), F.any_value("left").alias("left"), F.any_value("_below").alias("_below")
    )
    by_rank = Window.partitionBy("_source").orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = inside.withColumn("_upto", F.col("_below") + F.sum("_in").over(by_rank))
    stop = upto.filter("_upto > left").groupBy("_source").agg(
        F.min("_rank").alias("_high"), F.min_by(F.col("_upto") - F.col("_in"), "_rank").alias("_used")
    )
    found = crossing.withColumnRenamed("_source", "_s").join(stop, F.col("_s").eqNullSafe(F.col("_source")), "left").drop("_source")
    now = state.join(found, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
    high = F.coalesce("_high", F.lit(_BEYOND))
    used = F.coalesce("_used", "_below", F.lit(0))
    cut = F.when(F.col("open"), F.array(F.struct("low", high.alias("high"), F.col("left").alias("limit"))))
    rest = F.col("left") - F.when(F.col("open"), used).otherwise(0)
    still = F.col("open") & F.col("_high").isNotNull() & (rest > F.col("target") * TOLERANCE)
    return now.select(
        "_source", "target", F.concat("cuts", F.coalesce(cut, F.expr("slice(cuts, 1, 0)"))).alias("cuts"), rest.alias("left"),
        F.when(F.col("open"), high).otherwise(F.col("low")).alias("low"), still.alias("open"),
    )


def _cuts(ranked: DataFrame, plan: DataFrame) -> DataFrame:
    none = F.expr("slice(array(struct(0L AS low, 0L AS high, 0L AS limit)), 1, 0)")
    state = plan.select("_source", "target", none.alias("cuts"), "left", F.lit(-1).cast("long").alias("low"), (F.col("left") > 0).alias("open"))
    for _ in range(ROUNDS):
        state = store(_next_round(ranked, state), "mix_round")
        if state.filter("open").isEmpty():
            break
    return state.select("_source", "cuts")


def mix(
    docs: DataFrame, weights: Sequence[float], id_column: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0
) -> DataFrame:
    """``docs`` without the text, with ``size``, ``source_size``, ``target``, ``taken`` (words) and ``copies`` of each row."""
    kept = [c for c in docs.columns if c not in (*RESULTS, "copies", text)]
    row = F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)], F.lit(0).alias("none")).alias("_row")
    own = F.coalesce(F.col(quoted(text)), F.lit(""))
    number = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(quoted(id_column)), own), 11)
    uniform = ((number + 0.5) / float(1 << 53)).alias("_uniform")
    levelled = _levelled(docs.select(row, F.col(quoted(source)).alias("_source"), uniform, own.alias("_text")), "_text").drop("_text")
    measured = store(levelled, "mix_measured")
    plan = store(_expected(measured, weights), "mix_plan")
    ranked = store(_ranked(measured, plan), "mix_ranked")
    cuts = _cuts(ranked, plan).withColumnRenamed("_source", "_name")
    whole = plan.join(cuts, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")
    joined = _with_plan(measured, whole)
    rank, size = _rank(F.col("_uniform"), _chance()), F.col("_size")
    one_more = (_chance() > 0) & F.exists("cuts", lambda c: (rank > c["low"]) & (rank < c["high"]) & (size <= c["limit"]))
    copies = F.when(size > 0, F.col("copies")[F.col("_level")]["whole"] + one_more.cast("long")).otherwise(0)
    # in two steps: inside a lambda, a name of this select would hide the column of the input
    decided = joined.select("_row", size.alias("size"), "source_size", "target", (copies * size).alias("taken"), copies.alias("copies"))
    return decided.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(kept)], *RESULTS, "copies")


def mixture(
    docs: DataFrame, weights: Sequence[float], id_column: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0
) -> DataFrame:
    """The mix itself: the rows of ``docs`` with their own columns, each as often as it is taken."""
    whole = F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("whole")
    parts = [F.col(quoted(c)).alias(n) for c, n in ((id_column, "id"), (source, "from"), (text, "text"))]
    mixed = mix(docs.select(whole, *parts), weights, "id", "from", "text", seed).filter("copies > 0")
    copied = mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copied.select(*[F.col(f"whole.c{i}").alias(c) for i, c in enumerate(docs.columns)])
