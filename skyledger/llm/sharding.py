"""Shards of bounded bytes by extendible hashing.

The directory is indexed by the leading bits of a 60-bit hash of the document's id. A bucket over the
byte limit splits on one bit more, any other bucket stays as it is. The sizes behind eight further bits
come from one aggregate at a time, so the number of jobs is the logarithm, to base 256, of the number of
shards. Rows of one id, which no bit of its hash parts, go on splitting by the bits of a hash of the row's number.

Text is read twice, to measure and to return it. The directory is sent to where the texts are while it has at most
:data:`DIRECTORY_ENTRIES`; beyond that, texts are shuffled once, to meet the depths of their ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.common import carried, hash60, key_text, saved

SHARD_BYTES = 16 << 20
HASH_BITS = 60
ROUND_BITS = 8
# After so many bits a bucket holds only rows of one id, or of ids whose hashes agree in 56 bits.
LAST_BITS = 56
# Some 100 bytes an entry: at 16 MB a shard as many as 8 TB of text have at most, at 1 GB a shard 500 TB.
DIRECTORY_ENTRIES = 1 << 20
ADDED = ["_shard", "_depth", "_bytes"]


def _prefix(bits: int) -> Column:
    """The leading bits of the hash."""
    return F.shiftright("_key", HASH_BITS - bits)


def _leaves(sizes: DataFrame, known: int) -> DataFrame:
    """For each slot of ``known + 8`` bits: the bits after which its bucket fits, NULL if even the slot does not.

    Input: group, slot, n_docs, n_bytes of the slots below buckets that did not fit at ``known`` bits. A bucket
    fits if it is within the limit or holds a single document.
    """
    fits = []
    for bits in range(known, known + ROUND_BITS + 1):
        bucket = Window.partitionBy("group", F.shiftright("slot", known + ROUND_BITS - bits))
        inside = (F.sum("n_bytes").over(bucket) <= F.col("limit")) | (F.sum("n_docs").over(bucket) == 1)
        fits.append(F.when(inside, F.lit(bits)))
    return sizes.select("group", "slot", F.coalesce(*fits).alias("depth"))


def shard_directory(documents: DataFrame, limit: int) -> list[DataFrame]:
    """The directory over rows (_group, _key, _bytes), by rounds: group, slot, depth. Each group has one of its own.

    A document of round r finds its entry under its first 8 * r bits. ``depth`` is NULL for buckets of the next round
    and, in the last, for those that no further bit splits.
    """
    rounds: list[DataFrame] = []
    rest = documents
    for bits in range(ROUND_BITS, LAST_BITS + 1, ROUND_BITS):
        sizes = (
            rest.groupBy(F.col("_group").alias("group"), _prefix(bits).alias("slot"))
            .agg(F.count("*").alias("n_docs"), F.sum("_bytes").alias("n_bytes"))
            .withColumn("limit", F.lit(limit))
        )
        rounds.append(saved(_leaves(sizes, bits - ROUND_BITS)))
        over = rounds[-1].filter("depth IS NULL").drop("depth")
        if over.isEmpty():
            break
        rest = rest.join(over, (F.col("_group") == F.col("group")) & (_prefix(bits) == F.col("slot")), "left_semi")
    return rounds


def _placed(rows: DataFrame, rounds: list[DataFrame], near: bool) -> DataFrame:
    """``rows`` with _depth, NULL where no bit was enough. ``near``: the directory goes to the rows."""
    for number, entries in enumerate(rounds, 1):
        entries = entries.toDF(*[f"_{c}{number}" for c in entries.columns])
        found = (F.col("_group") == F.col(f"_group{number}")) & (_prefix(number * ROUND_BITS) == F.col(f"_slot{number}"))
        rows = rows.join(F.broadcast(entries) if near else entries, found, "left")
    numbers = range(1, len(rounds) + 1)
    return rows.withColumn("_depth", F.coalesce(*[F.col(f"_depth{n}") for n in numbers])).drop(
        *[f"_{c}{n}" for n in numbers for c in ("group", "slot", "depth")]
    )


def _split(rows: DataFrame, slim: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """``rows`` with _depth, and whether some have none; ``slim`` are their _group, _key and _bytes, saved."""
    rounds = shard_directory(slim, limit)
    if sum(entries.count() for entries in rounds) <= DIRECTORY_ENTRIES:
        placed = _placed(rows, rounds, near=True)
    else:
        depths = saved(_placed(slim.select("_group", "_key").distinct(), rounds, near=False))
        placed = rows.join(depths, ["_group", "_key"], "left")
    return placed, len(rounds) * ROUND_BITS == LAST_BITS and not rounds[-1].filter("depth IS NULL").isEmpty()


def _bits(depth: Column) -> Column:
    return F.substring(F.lpad(F.bin("_key"), HASH_BITS, "0"), F.lit(1), depth)


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The input columns, and _shard (text), _depth, _bytes of each row.

    ``_shard`` is ``s`` (so that no reader takes it for a number) and the bucket's bits; then, only where no bit can split an
    oversized bucket, ``-`` and bits of the row's number. Such a bucket holds rows of one id (repeated rows, or NULL ids,
    which hash as the empty text), of which any may lie in any of its pieces; they are written once, so that their numbers
    last. Every shard is within the limit, but for a single document that is larger than it, which gets a shard of its own.
    A NULL text has 0 bytes. Input columns named like the added ones are replaced; other columns pass through, whatever
    their names. No rows, no shards.
    """
    rows = docs.select(
        carried(docs.columns, ADDED), F.lit(0).cast("long").alias("_group"), hash60(key_text(id_column)).alias("_key"),
        F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long").alias("_bytes"),
    )
    added = ["_keep.*", "_shard", "_depth", "_bytes"]
    placed, stuck = _split(rows, saved(rows.drop("_keep")), limit)
    whole = placed.filter("_depth IS NOT NULL").withColumn("_shard", F.concat(F.lit("s"), _bits(F.col("_depth")))).select(*added)
    if not stuck:
        return whole
    numbered = saved(placed.filter("_depth IS NULL").select(
        "_keep", "_bytes", _prefix(LAST_BITS).alias("_group"), F.monotonically_increasing_id().alias("_row")
    )).withColumn("_key", hash60(F.col("_row").cast("string")))
    pieces, _ = _split(numbered, saved(numbered.select("_group", "_key", "_bytes")), limit)
    bucket = F.substring(F.lpad(F.bin("_group"), LAST_BITS, "0"), 1, LAST_BITS)
    cut = pieces.withColumn("_shard", F.concat(F.lit("s"), bucket, F.lit("-"), _bits(F.coalesce("_depth", F.lit(LAST_BITS)))))
    return whole.unionByName(cut.withColumn("_depth", F.lit(LAST_BITS)).select(*added))


def write_shards(docs: DataFrame, path: str, files_at_once: int, **options) -> None:
    """One folder of Parquet files per shard; rows of a shard meet in one task, whose size the limit bounds."""
    sharded = assign_shards(docs, **options)
    sharded.repartition(files_at_once, "_shard").write.partitionBy("_shard").parquet(path)
