"""Scaled copies of a table, by percent of its rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def subset_label(percent: int) -> str:
    """``pct_025`` for 25 percent."""
    return f"pct_{percent:03d}"


def make_subset(table: DataFrame, percent: int, seed: int = 42) -> DataFrame:
    """``percent`` of the rows: a random sample below 100, whole copies at its multiples.

    Copies come from repeating each row, so that a table of any size is read once, where a union with
    itself reads it once per copy. The sample depends on how the rows lie in files; see
    :func:`hashed_subset` for one that does not.
    """
    copies, rest = divmod(percent, 100)
    if percent <= 0 or (copies and rest):
        raise ValueError(f"percent must be between 1 and 100, or a multiple of 100: {percent}")
    if rest:
        return table.sample(withReplacement=False, fraction=percent / 100, seed=seed)
    if copies == 1:
        return table
    copy_numbers = F.array(*[F.lit(i) for i in range(copies)])
    return table.select("*", F.explode(copy_numbers).alias("_copy")).drop("_copy")


# The copies of one row are dealt out in blocks of so many.
COPY_BLOCK = 4096


def _row_text(table: DataFrame, row: str | None = None) -> Column:
    """The columns as text, or those of a struct ``row`` of them."""
    columns = [F.col(c) if row is None else F.col(row)[c] for c in table.columns]
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("<null>")) for c in columns])


def _stays(text: Column, percent: int) -> Column:
    """The first 32 bits of the text's MD5 are below the share."""
    first_bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return first_bits * 100 < percent * (1 << 32)


def _lost_text(table: DataFrame) -> Column:
    """The row's text if grouping would lose it, else NULL: a group's zeros have no sign, and values inside others are not looked at."""
    zeros = [F.col(f.name) for f in table.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    nested = any(isinstance(f.dataType, (T.ArrayType, T.StructType, T.VariantType)) for f in table.schema)
    lost = reduce(lambda a, b: a | b, [z.eqNullSafe(0) & z.cast("string").startswith("-") for z in zeros], F.lit(nested))
    return F.when(lost, _row_text(table))


def numbered_subset(table: DataFrame, percent: int) -> DataFrame:
    """``percent`` of the rows, copies treated apart, the same ones whatever the file layout or cluster size.

    Copies of a row are told apart by a number, and a row stays by the hash of its text and number. A window
    would number them in one task per distinct row; as copies are alike, they are counted instead, partly before the
    shuffle. Up to a block of copies of a row are judged where they were counted; of a row with more, the blocks are
    dealt out again, so one with a third of the table is no more than any other. The text is made where it is
    hashed and not shuffled. No column may be a map, which Spark cannot group by.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be between 1 and 100: {percent}")
    row = F.struct(*[F.col(c) for c in table.columns])
    counted = table.select(row.alias("row"), _lost_text(table).alias("lost")).groupBy("row", "lost").agg(F.count("*").alias("n"))
    text = F.coalesce("lost", _row_text(table, "row"))
    many, one = F.col("n") > COPY_BLOCK, F.lit(1).cast("long")
    firsts = F.explode(F.sequence(one, F.col("n"), F.when(many, F.lit(COPY_BLOCK).cast("long")).otherwise(one)))
    blocks = counted.select("row", "lost", "n", firsts.alias("first"))
    left = blocks.filter(many | _stays(F.concat_ws("|", text, "first"), percent)).repartition("row", "first")
    last = F.when(many, F.least(F.col("first") + (COPY_BLOCK - 1), F.col("n"))).otherwise(F.col("first"))
    copies = left.select("row", "lost", "n", F.explode(F.sequence("first", last)).alias("number"))
    return copies.filter(~many | _stays(F.concat_ws("|", text, "number"), percent)).select("row.*")


def hashed_subset(table: DataFrame, percent: int) -> DataFrame:
    """``percent`` of the distinct rows by a hash of all columns, with all copies of each.

    The same rows come out whatever the file layout or cluster size, and in any engine that has MD5: a row
    stays if the first 32 bits of its columns' text, separated and with NULL marked, are below the share.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be between 1 and 100: {percent}")
    return table.filter(_stays(_row_text(table), percent))
