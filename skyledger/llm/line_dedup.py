"""Lines that many documents share, removed by levelled sorted runs of line hashes.

Documents come in batches. A batch's lines are counted per key, anti-joined with the runs, whose frequent
keys need no more counting, and added as a run of its own. A run is a table sorted and bucketed by
hash, so that runs meet each other and a batch in merge joins, without a shuffle of what is stored. When
a level holds two runs, they are merged into one of the next level; an entry is so rewritten once per
level, a number that grows with the logarithm of the batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import saved
from skyledger.session import scratch_dir

LEAST_DOCUMENTS = 10
# Fixed by the query contract: what is stripped at both ends of a line.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
# A batch's count of a key known as frequent is still stored if it is so large, so that stored counts tell
# the most frequent keys from the others.
STORED_AGAIN = 1024
# Keys with at least this share of all lines, so at most as many, are broadcast; no other key is hot.
HOT_KEYS = 1 << 14
# The same for rows that are repeated as a whole.
HOT_ROWS = 1 << 10


def lines_of(text: Column) -> Column:
    """The lines of a text; NULL and the empty text are one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def keys_of(text: Column) -> Column:
    """A text for each line, in order, that tells its key: stripped at both ends, A-Z lower-cased.

    The text's UTF-8 bytes are read as Latin-1, where ``lower`` is many times faster than ``translate``. Beside A-Z it
    changes the first bytes of some longer characters, C0-DE to E0-FE. Characters of two bytes stay apart from
    those of more, as fewer continuation bytes follow, so two lines have one such text only if they have one key.
    """
    lowered = F.lower(F.decode(F.encode(text.cast("string"), "UTF-8"), "ISO-8859-1"))
    return F.transform(lines_of(lowered), lambda line: F.btrim(line, F.lit(BLANKS)))


def _long_enough(key: Column, least_chars: int) -> Column:
    """The key has so many code points, continuation bytes not counted."""
    if least_chars <= 1:
        return F.char_length(key) >= least_chars
    return F.char_length(F.regexp_replace(key, "[\\x80-\\xBF]", "")) >= least_chars


def _hashed(key: str) -> list[Column]:
    """128 bits that stand for a key."""
    return [F.xxhash64(key).alias("hi"), F.xxhash64(F.lit(1), key).alias("lo")]


class LineRuns:
    """The runs: for each level a list of tables (hi, lo, n), where n counts documents.

    Tables live in a database of their own in the shared folder, in as many buckets as the session has shuffle
    partitions. A run that was merged into another is dropped with its files.
    """

    def __init__(self, spark: SparkSession, least_documents: int = LEAST_DOCUMENTS, least_chars: int = 1) -> None:
        self.spark = spark
        self.least_documents = least_documents
        self.least_chars = least_chars
        self.levels: list[list[str]] = []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.database = f"lines_{uuid.uuid4().hex}"
        place = scratch_dir(spark).replace("'", "\\'")
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{place}'")

    def _write(self, entries: DataFrame) -> str:
        name = f"{self.database}.run_{uuid.uuid4().hex}"
        entries.write.bucketBy(self.buckets, "hi", "lo").sortBy("hi", "lo").saveAsTable(name)
        return name

    def _merged(self, names: Sequence[str]) -> DataFrame:
        """The counts of several runs, added.

        Joins, as Spark 4.1 plans an aggregate over a union of bucketed tables without the shuffle that it needs.
        """
        entries = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).withColumnRenamed("n", "m").hint("merge")
            n = F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))
            entries = entries.join(other, ["hi", "lo"], "full_outer").select("hi", "lo", n.alias("n"))
        return entries

    def _names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def entries(self) -> DataFrame:
        """hi, lo, n of every key in any run."""
        if not self._names():
            return self.spark.createDataFrame([], "hi long, lo long, n long")
        return self._merged(self._names())

    def add(self, docs: DataFrame, text_column: str = "text") -> None:
        """A further batch of documents, of which each row is one."""
        keys = F.filter(F.array_distinct(keys_of(F.col(text_column))), lambda key: _long_enough(key, self.least_chars))
        counts = docs.select(F.explode(keys).alias("key")).select(*_hashed("key")).groupBy("hi", "lo").agg(F.count("*").alias("n"))
        for name in self._names():
            known = self.spark.table(name).filter(F.col("n") >= self.least_documents)
            known = known.select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo")).hint("merge")
            same = (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo")) & (F.col("n") < STORED_AGAIN)
            counts = counts.join(known, same, "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(counts))
        self._compact()

    def _compact(self) -> None:
        """Merge the two runs of every level that has so many into one of the next."""
        for number, level in enumerate(self.levels):
            if len(level) < 2:
                return
            if number + 1 == len(self.levels):
                self.levels.append([])
            self.levels[number + 1].append(self._write(self._merged(level)))
            for name in level:
                self.spark.sql(f"DROP TABLE {name}")
            level.clear()

    def frequent(self) -> tuple[DataFrame, DataFrame]:
        """hi, lo of the frequent keys: those that are hot, at most ``HOT_KEYS``, and the others."""
        merged = saved(self.entries().filter(F.col("n") >= self.least_documents))
        total = self.entries().agg(F.sum("n")).first()[0] or 0
        hot = F.col("n") * HOT_KEYS >= total
        return merged.filter(hot).select("hi", "lo"), merged.filter(~hot).select("hi", "lo")

    def drop(self) -> None:
        """Remove the runs and their files."""
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")
        self.levels = []


def _row_reference(docs: DataFrame) -> list[Column]:
    """128 bits that stand for a row's id and text. Rows that share them lose the same lines."""
    return [F.xxhash64("_id", "_text").alias("r1"), F.xxhash64(F.lit(1), "_text", "_id").alias("r2")]


def _hits(rows: DataFrame, frequent: tuple[DataFrame, DataFrame], least_chars: int) -> DataFrame:
    """r1, r2, dropped (places of the lines that go), copies (of the row) for rows that lose lines.

    A hot key meets its few rows in a broadcast join. Its lines then travel on under their row's reference,
    which meets no key, so no task gets more lines than a key has that is not hot.
    """
    hot, others = frequent
    lines = rows.select(*_row_reference(rows), F.posexplode(keys_of(F.col("_text"))).alias("place", "key"))
    lines = lines.filter(_long_enough(F.col("key"), least_chars)).select("r1", "r2", "place", *_hashed("key"))
    marked = lines.join(F.broadcast(hot.withColumn("hot", F.lit(True))), ["hi", "lo"], "left")
    moved = {"hi": F.when(F.col("hot"), F.col("r1")).otherwise(F.col("hi")), "lo": F.when(F.col("hot"), F.col("r2")).otherwise(F.col("lo"))}
    met = marked.withColumns(moved).join(others.withColumn("met", F.lit(True)), ["hi", "lo"], "left").filter("hot OR met")
    places = F.collect_set("place")
    found = met.groupBy("r1", "r2").agg(F.sort_array(places).alias("dropped"), F.count("*").alias("n"))
    return found.select("r1", "r2", "dropped", F.expr("n div size(dropped)").alias("copies"))


def _kept(lines: Column, dropped: Column) -> Column:
    """The lines but those at the places in ``dropped``, joined: what lies between each two of them."""
    ends = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))
    between = F.transform(
        F.sequence(F.lit(1), F.size(dropped) + 1),
        lambda k: F.slice(lines, F.get(ends, k - 1) + 2, F.get(ends, k) - F.get(ends, k - 1) - 1),
    )
    return F.array_join(F.flatten(between), "\n")


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: Sequence[str] = ("doc_id",),
    batches: Sequence[DataFrame] | None = None,
    least_documents: int = LEAST_DOCUMENTS,
    least_chars: int = 1,
) -> DataFrame:
    """The ``keep`` columns, and _n_lines, _n_dropped, _kept (the text that is left) of every row.

    Lines whose key is found in ``least_documents`` rows or more go from every row. ``batches`` are the rows of
    ``docs`` in parts that are read one after the other; without them all rows are one batch. Each row is a
    document, repeated rows and rows without an id too. NULL and empty texts are one empty line; a key of fewer
    than ``least_chars`` characters never goes, so empty lines stay. A text all of whose lines go becomes
    empty. Input columns named like the added ones are replaced, others may have any name. No rows, no result.
    """
    spark = docs.sparkSession
    runs = LineRuns(spark, least_documents, least_chars)
    for batch in batches if batches is not None else [docs]:
        runs.add(batch, text_column)
    frequent = runs.frequent()
    runs.drop()

    row = F.struct(*[F.col(c) for c in keep if c not in ("_n_lines", "_n_dropped", "_kept")]).alias("_row")
    rows = docs.select(row, F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text"))
    hits = saved(_hits(rows, frequent, least_chars))
    # Rows that are repeated so often that one task should not hold them are dealt over several.
    spread = F.ceil(F.col("copies") / max(1024, docs.count() // HOT_ROWS)).cast("int")
    hits = hits.withColumn("spread", spread)
    often = hits.filter("spread > 1").select("r1", "r2", "spread")
    # Rows without a key lose nothing, so they may meet nothing, wherever they go.
    number = F.monotonically_increasing_id()
    blank = F.btrim(F.coalesce("_text", F.lit("")), F.lit(BLANKS)) == ""
    turn = F.when(blank & F.lit(least_chars > 0), -1 - number).otherwise(F.pmod(number, F.coalesce("spread", F.lit(1)).cast("long")))
    dealt = rows.select("*", *_row_reference(rows)).join(F.broadcast(often), ["r1", "r2"], "left").withColumn("turn", turn).drop("spread")
    places = hits.select("r1", "r2", "dropped", F.explode(F.sequence(F.lit(0), F.col("spread") - 1).cast("array<long>")).alias("turn"))
    joined = dealt.join(places, ["r1", "r2", "turn"], "left")
    lines, dropped = lines_of(F.col("_text")), F.coalesce("dropped", F.array().cast("array<int>"))
    found = joined.select(
        "_row",
        F.size(lines).cast("long").alias("_n_lines"),
        F.size(dropped).cast("long").alias("_n_dropped"),
        F.when(F.col("dropped").isNull(), F.coalesce("_text", F.lit(""))).otherwise(_kept(lines, dropped)).alias("_kept"),
    )
    return found.select("_row.*", "_n_lines", "_n_dropped", "_kept")


def file_batches(docs: DataFrame, batches: int) -> list[DataFrame]:
    """A Parquet table's rows in at most ``batches`` parts, by whole files, so that each file is read by one of them."""
    files = sorted(docs.inputFiles())
    size = -(-len(files) // batches)
    return [docs.sparkSession.read.schema(docs.schema).parquet(*files[at : at + size]) for at in range(0, len(files), size)]
