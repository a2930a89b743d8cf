"""What several operators share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.session import scratch_dir

BATCH_ROWS = 1000
# Fixed by the query contracts: a word is a run of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"
# A bitmap that tells wanted keys apart has at least so many bits for each, and is of at most 16 MB; keys that it lets through
# in vain, which beyond some ten million wanted ones become more, drop out at a join.
WANTED_FACTOR = 8
MOST_BITS = 1 << 27


def saved(table: DataFrame) -> DataFrame:
    """The table, written to the shared folder and read back.

    This ends its lineage: a lost executor costs the tasks that ran on it, not the steps before, and
    whoever reads the result twice does not compute it twice.
    """
    path = scratch_dir(table.sparkSession)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def in_small_batches(table: DataFrame) -> DataFrame:
    """The table, for a function over Arrow batches, in a session that makes batches of :data:`BATCH_ROWS` rows.

    Spark's own default is ten times as many, which for whole texts is tens of megabytes, held by the executor
    and by Python at once in every task. A session whose setting is not the default stays as it is. However long
    its texts, Spark ends a batch at ``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB unless set otherwise.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if table.sparkSession.conf.get(name) == "10000":
        table.sparkSession.conf.set(name, str(BATCH_ROWS))
    return table


def carried(keep: list[str], added: list[str]) -> Column:
    """The columns of ``keep`` as one struct ``_keep``, in which their names clash with no working column.

    ``_keep.*`` gives them back. A column that is named like one of ``added`` is replaced by it, whatever the case.
    """
    taken = {name.lower() for name in added}
    return F.struct(*[F.col(c) for c in dict.fromkeys(keep) if c.lower() not in taken]).alias("_keep")


def key_text(column: str) -> Column:
    """An id as text, NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def hash60(text: Column) -> Column:
    """The first 60 bits of the MD5 of a text, a number that other engines compute alike."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def flags(wanted: DataFrame, number: Column) -> np.ndarray:
    """A bitmap of the wanted rows' hashes (long), for :func:`is_flagged`."""
    bits = min(MOST_BITS, max(1 << 15, 1 << (WANTED_FACTOR * wanted.count()).bit_length()))
    slot = F.pmod(number, F.lit(bits)) + 1  # bitmaps begin at 1
    rows = (
        wanted.groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bitmap")).collect()
    )
    table = np.zeros(bits // 8, dtype=np.uint8)
    for row in rows:
        first = (row.bucket - 1) * 4096
        table[first : first + 4096] = np.frombuffer(bytes(row.bitmap), dtype=np.uint8)
    return table


def is_flagged(table: np.ndarray, number: int | np.ndarray) -> int | np.ndarray:
    """1 for hashes of wanted rows, and for few others; else 0."""
    at = number % (8 * len(table))
    return table[at >> 3] >> (at & 7) & 1


def flagged(number: Column, wanted: DataFrame, wanted_number: Column) -> Column:
    """Whether a hash (long) may be one of the wanted rows'; true for all that are, and for few others."""
    shared = wanted.sparkSession.sparkContext.broadcast(flags(wanted, wanted_number))

    @F.pandas_udf("boolean")
    def told(numbers: pd.Series) -> pd.Series:
        return pd.Series(is_flagged(shared.value, numbers.to_numpy()) == 1)

    return told(number)
