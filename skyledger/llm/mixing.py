"""Mixing sources to target weights by entropy balancing.

Every document starts with rate 1. Among all rates whose words add up to the source's target, those
nearest to 1 in relative entropy are exponential tilts ``exp(lambda * size / mean size)``, cut at the
largest number of repeats. The one multiplier per source solves a convex dual; Newton steps on all
sources at once find it, each step one aggregate over (source, size) counts. Rates become whole copies by
one threshold per source on a hash of the document, found by narrowing a histogram, not by sorting. Rows
that share id, text and source are told apart by their number, so they need not flip together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.common import WORD, carried, hash60, key_text, saved

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
# Newton stops when every source's words are this near to its target, as a share; rounding does the rest.
TOLERANCE = 1e-6
MAX_STEPS = 60
# exp(-this) is 0 in double precision.
LOWEST_LOG_RATE = 750.0
# Each narrowing splits the interval of thresholds into so many bins; four leave less than a hash's own step.
BINS = 4096
NARROWINGS = 4
# Rows that share id, text and source are numbered in blocks of so many.
COPY_BLOCK_BITS = 12
ADDED = ["_size", "_source_size", "_target", "_copies"]


def n_words(text: str) -> Column:
    """Words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target from rows (source, source_size).

    Sources weigh ``weights`` in turn, by code point, NULL last. ``target`` is min(cap, level * weight),
    with the level at which all targets add up to all words: sources reach their cap in order of cap /
    weight, so the level follows from running sums in that order. One row per source is sorted here.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    capped = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeats)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    filled = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    levels = capped.withColumns({
        "level": (F.sum("source_size").over(everything) - filled) / open_weight, "place": F.row_number().over(by_ratio)
    })
    # The first level at which its own source, the next one to fill, stays within its cap.
    place = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("place"))
    found = levels.withColumn("level", F.min_by("level", place).over(everything))
    return found.select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")
    )


def _rate(x: Column, multiplier: Column, max_repeats: int) -> Column:
    return F.when(multiplier * x >= math.log(max_repeats), F.lit(float(max_repeats))).otherwise(F.exp(multiplier * x))


def solve_rates(counts: DataFrame, targets: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: source, source_size, target, mean_size, multiplier. ``counts``: source, size, n, of size > 0.

    Safeguarded Newton: a step that leaves the bracket of the root is replaced by its middle. A target at
    the cap has no finite multiplier; there the upper end of the bracket, at which every rate is cut, is it.
    """
    means = counts.groupBy(F.col("source").alias("_source")).agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean_size"), F.min("size").alias("least")
    )
    state = saved(
        targets.join(means, F.col("source").eqNullSafe(F.col("_source"))).select(
            "source", "source_size", "target", "mean_size",
            F.lit(0.0).alias("multiplier"),
            (F.lit(-LOWEST_LOG_RATE) * F.col("mean_size") / F.col("least")).alias("lo"),
            (F.lit(math.log(max_repeats)) * F.col("mean_size") / F.col("least")).alias("hi"),
            F.lit(False).alias("done"),
        )
    )
    for _ in range(MAX_STEPS):
        x = F.col("size") / F.col("mean_size")
        rate = _rate(x, F.col("multiplier"), max_repeats)
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < max_repeats, words * x).otherwise(0.0)
        sums = (
            counts.select(F.col("source").alias("_source"), "size", "n")
            .join(state.select("source", "mean_size", "multiplier"), F.col("source").eqNullSafe(F.col("_source")))
            .groupBy("_source")
            .agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        )
        gap = F.col("words") - F.col("target")
        lo = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("hi"))
        newton = F.col("multiplier") - gap / F.col("slope")
        middle = (lo + hi) / 2
        done = (F.abs(gap) <= TOLERANCE * F.col("target")) | (hi - lo <= 1e-12 * (1 + F.abs(lo)))
        step = F.when(F.col("target") >= max_repeats * F.col("source_size"), F.col("hi")).otherwise(
            F.when((F.col("slope") > 0) & (newton > lo) & (newton < hi), newton).otherwise(middle)
        )
        state = saved(
            state.join(sums, F.col("source").eqNullSafe(F.col("_source"))).select(
                "source", "source_size", "target", "mean_size",
                F.when(done, F.col("multiplier")).otherwise(step).alias("multiplier"), lo.alias("lo"), hi.alias("hi"), done.alias("done"),
            )
        )
        if state.filter("NOT done").isEmpty():
            break
    else:
        raise ArithmeticError(f"rates of some sources do not meet their targets after {MAX_STEPS} steps")
    return state.select("source", "source_size", "target", "mean_size", "multiplier")


def _narrow(flips: DataFrame, bounds: DataFrame) -> DataFrame:
    """The bin of thresholds in which each source's words pass its target.

    ``flips``: source, at (the threshold from which the document has one copy more), size. ``bounds``:
    source, target, low, width, below (words of the flips before ``low``).
    """
    at = F.floor((F.col("at") - F.col("low")) / F.col("width") * BINS)
    sums = (
        flips.join(bounds.select(F.col("source").alias("_source"), "low", "width"), F.col("source").eqNullSafe(F.col("_source")))
        .filter((F.col("at") >= F.col("low")) & (F.col("at") < F.col("low") + F.col("width")))
        .groupBy("source", F.greatest(F.least(at, F.lit(BINS - 1)), F.lit(0)).alias("bin"))
        .agg(F.sum("size").alias("words"))
    )
    order = Window.partitionBy("source").orderBy("bin")
    running = sums.withColumn("upto", F.sum("words").over(order)).select(
        F.col("source").alias("_source"), "bin", (F.col("upto") - F.col("words")).alias("before")
    )
    # The last bin whose start is still within the target.
    joined = bounds.join(running, F.col("source").eqNullSafe(F.col("_source")), "left")
    inside = joined.filter(F.col("bin").isNull() | (F.col("below") + F.col("before") <= F.col("target")))
    last = inside.groupBy("source").agg(F.max_by(F.struct("bin", "before"), "bin").alias("last"), *[
        F.first(c).alias(c) for c in ("source_size", "target", "mean_size", "multiplier", "low", "width", "below")
    ])
    return last.select(
        "source", "source_size", "target", "mean_size", "multiplier",
        (F.col("low") + F.coalesce(F.col("last.bin"), F.lit(0)) * F.col("width") / BINS).alias("low"),
        (F.col("width") / BINS).alias("width"),
        (F.col("below") + F.coalesce(F.col("last.before"), F.lit(0))).alias("below"),
    )


def _uniform(id_column: str, text_column: str) -> Column:
    """A number in [0, 1) from id and text, so that rows without an id are told apart by their texts."""
    text = F.md5(F.coalesce(F.col(text_column).cast("string"), F.lit("")))
    return hash60(F.concat(key_text(id_column), F.lit(":"), text)) / F.lit(float(1 << 60))


def _uniform_of_copy(number: Column) -> Column:
    """A number in [0, 1) of one of the rows that share ``uniform``; ``number`` counts from 1."""
    return hash60(F.concat_ws(":", F.col("uniform").cast("string"), number.cast("string"))) / F.lit(float(1 << 60))


def _sized(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    return docs.select(
        F.col(source_column).cast("string").alias("source"), n_words(text_column).alias("size"), _uniform(id_column, text_column).alias("uniform"),
        carried(docs.columns, ADDED),
    )


def _repeated(sized: DataFrame) -> DataFrame:
    """often: each ``uniform`` that several rows with words share."""
    counted = sized.filter("size > 0").groupBy("uniform").agg(F.count("*").alias("n"))
    return saved(counted.filter("n > 1").select(F.col("uniform").alias("often")))


def _sizes_apart(sized: DataFrame, often: DataFrame) -> DataFrame:
    """source, size, uniform, where rows that share all three have a ``uniform`` of their own each.

    As such rows are alike, they are counted and their numbers dealt out again in blocks.
    """
    if often.isEmpty():
        return sized
    shares = F.col("uniform") == F.col("often")
    counted = sized.join(often, shares, "left_semi").groupBy("source", "size", "uniform").agg(F.count("*").alias("n"))
    last = F.shiftright(F.col("n") - 1, COPY_BLOCK_BITS)
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    first = F.col("block") * (1 << COPY_BLOCK_BITS)
    numbers = F.sequence(first + 1, F.least(first + (1 << COPY_BLOCK_BITS), F.col("n")))
    dealt = blocks.repartition("uniform", "block").withColumn("number", F.explode(numbers))
    return sized.join(often, shares, "left_anti").unionByName(dealt.select("source", "size", _uniform_of_copy(F.col("number")).alias("uniform")))


def _rows_apart(rows: DataFrame, often: DataFrame) -> DataFrame:
    """source, size, uniform, _keep, numbered as in :func:`_sizes_apart`.

    Which of several rows that are alike bears which number does not matter, so they are written once and numbered by
    their places there: first the rows of blocks of places are counted, then a window runs inside each block.
    """
    if often.isEmpty():
        return rows
    shares = F.col("uniform") == F.col("often")
    written = saved(rows.join(often, shares, "left_semi").withColumn("place", F.monotonically_increasing_id()))
    alike, block = F.struct("source", "size", "uniform").alias("alike"), F.shiftright("place", COPY_BLOCK_BITS).alias("block")
    placed = written.select("*", alike, block)
    before = F.sum("n").over(Window.partitionBy("alike").orderBy("block")) - F.col("n")
    blocks = placed.groupBy("alike", "block").agg(F.count("*").alias("n")).select("alike", "block", before.alias("before"))
    number = F.row_number().over(Window.partitionBy("alike", "block").orderBy("place")) + F.col("before")
    numbered = placed.join(blocks, ["alike", "block"]).withColumn("number", number)
    return rows.join(often, shares, "left_anti").unionByName(
        numbered.select("source", "size", _uniform_of_copy(F.col("number")).alias("uniform"), "_keep")
    )


def _flip(k: int | Column, size: str, multiplier: str, mean_size: str, uniform: Column, max_repeats: int) -> Column:
    """The threshold from which on a document has its k-th copy."""
    return k - _rate(F.col(size) / F.col(mean_size), F.col(multiplier), max_repeats) - uniform


def mixing_plan(docs: DataFrame, id_column="doc_id", text_column="text", source_column="source",
                weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source with all that decides about its documents' copies.

    source, source_size, target, mean_size, multiplier, threshold, and extra_size, extra_at: one document
    of that size and hash gets one copy more, the one that brings the source nearest to its target.
    """
    sized = saved(_sized(docs, id_column, text_column, source_column).drop("_keep"))
    return _plan(sized, _repeated(sized), weights, max_repeats)


def _plan(sized: DataFrame, often: DataFrame, weights, max_repeats: int) -> DataFrame:
    counts = saved(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    totals = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = saved(source_targets(totals, weights, max_repeats))
    solved = solve_rates(counts.filter("size > 0"), targets, max_repeats)

    rated = _sizes_apart(sized, often).filter("size > 0").join(
        solved.select(F.col("source").alias("_source"), "mean_size", "multiplier"), F.col("source").eqNullSafe(F.col("_source"))
    )
    flips = saved(rated.select(
        "source", "size", "uniform",
        F.explode(F.array(*[
            _flip(F.lit(k), "size", "multiplier", "mean_size", F.col("uniform"), max_repeats) for k in range(1, max_repeats + 1)
        ])).alias("at"),
    ))
    bounds = solved.select("*", F.lit(-float(max_repeats + 1)).alias("low"), F.lit(2.0 * max_repeats + 2).alias("width"), F.lit(0).cast("long").alias("below"))
    for _ in range(NARROWINGS):
        bounds = saved(_narrow(flips, bounds))
    # What flips from here on is left out; of that, one flip may still fill the rest of the target.
    left = F.col("target") - F.col("below")
    extra = (
        flips.join(bounds.select(F.col("source").alias("_source"), "low", "target", "below"), F.col("source").eqNullSafe(F.col("_source")))
        .filter((F.col("at") >= F.col("low")) & (F.abs(left - F.col("size")) < left))
        .groupBy("source")
        .agg(F.min_by(F.struct("size", "uniform"), F.struct(F.abs(left - F.col("size")), "at", "uniform")).alias("extra"))
    )
    plan = bounds.withColumnRenamed("low", "threshold").join(
        extra.select(F.col("source").alias("_source"), "extra"), F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    solved_part = plan.select("source", "mean_size", "multiplier", "threshold", F.col("extra.size").alias("extra_size"), F.col("extra.uniform").alias("extra_at"))
    # Sources without words have no multiplier; their documents get no copies.
    return saved(
        targets.join(solved_part.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    )


def with_copies(docs: DataFrame, plan: DataFrame, id_column="doc_id", text_column="text", source_column="source",
                max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The input columns, and _size, _source_size, _target, _copies of each row; ``plan``: :func:`mixing_plan` of the same rows.

    Each decision is a function of the row and its source's row in the plan, so text is never shuffled
    while the plan is small enough for Spark to broadcast it, but that of rows which share id and text. Reruns agree, as hashes
    replace random numbers; among rows that share id, text and source it is their number that counts, so as many of them have
    one copy more in every run, whatever the file layout. NULL and empty texts have size 0 and no copies; a NULL
    source is a source like any other. Input columns named like the added ones are replaced, all others may have any names.
    """
    sized = _sized(docs, id_column, text_column, source_column)
    return _take(sized, plan, _repeated(sized), max_repeats)


def _take(rows: DataFrame, plan: DataFrame, often: DataFrame, max_repeats: int) -> DataFrame:
    p = plan.withColumnsRenamed({c: f"_plan_{c}" for c in plan.columns})
    joined = _rows_apart(rows, often).join(p, F.col("source").eqNullSafe(F.col("_plan_source")), "left")
    uniform = F.col("uniform")
    whole = sum(
        F.when(_flip(F.lit(k), "size", "_plan_multiplier", "_plan_mean_size", uniform, max_repeats) < F.col("_plan_threshold"), 1).otherwise(0)
        for k in range(1, max_repeats + 1)
    )
    extra = F.when((F.col("size") == F.col("_plan_extra_size")) & (uniform == F.col("_plan_extra_at")), 1).otherwise(0)
    copies = F.when(F.col("size") > 0, F.least(whole + extra, F.lit(max_repeats))).otherwise(0).cast("int")
    return joined.select(
        "_keep.*", F.col("size").alias("_size"), F.col("_plan_source_size").alias("_source_size"), F.col("_plan_target").alias("_target"),
        F.coalesce(copies, F.lit(0)).alias("_copies"),
    )


def mixed(docs: DataFrame, id_column="doc_id", text_column="text", source_column="source",
          weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """:func:`with_copies` by the plan of the same documents, which are searched for repeated rows once."""
    rows = _sized(docs, id_column, text_column, source_column)
    sized = saved(rows.drop("_keep"))
    often = _repeated(sized)
    return _take(rows, _plan(sized, often, weights, max_repeats), often, max_repeats)


def mix(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it."""
    taken = mixed(docs).filter("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
    return taken.select(*docs.columns)
