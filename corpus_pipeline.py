"""Training data from raw documents, in stages that are each written and read again.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of
``documents``; the last adds what it decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import decontamination, jaccard_join, language, mixing, sharding
from skyledger.llm.common import flagged, saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go; the others carry the language it found."""
    found = language.identify(_documents(docs), language.fit(docs))
    return found.filter("NOT _rejected").withColumn("lang", F.col("_lang")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays, and one row of it.

    A row is told by its id and its text, so unlike texts under one id are judged apart. Among rows of the
    smallest id the text of the smallest MD5 stays; rows without an id come after all others. Documents without words are
    no one's duplicates and stay as they are, repeated rows too.
    """
    rows = _documents(docs).withColumn("_row", _row_name())
    found = saved(jaccard_join.similar_documents(rows, "_row"))
    # A component bears its smallest row, so all others go.
    by_row = found.groupBy(F.col("_id").alias("_row")).agg(
        F.bool_or(F.col("_id") != F.col("_component")).alias("gone"), (F.min("_n_shingles") > 0).alias("has_words"), F.count("*").alias("n")
    )
    marks = saved(by_row.filter("gone OR has_words AND n > 1").select("_row", "gone"))
    clear, asked = _parted(rows, marks)
    stay = asked.join(marks, "_row", "left").filter("gone IS NULL OR NOT gone")
    kept = clear.unionByName(stay.filter("gone IS NULL").select(*clear.columns))
    if not marks.filter("NOT gone").isEmpty():
        kept = kept.unionByName(stay.filter("NOT gone").dropDuplicates(["_row"]).select(*clear.columns))
    return kept.select(*COLUMNS)


def _parted(rows: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``_row`` is surely not in ``marks``, and the others, by a bitmap: only these need to meet the marks with their text."""
    told = rows.withColumn("_flagged", flagged(F.xxhash64("_row"), marks, F.xxhash64("_row")))
    return told.filter("NOT _flagged").drop("_flagged"), told.filter("_flagged").drop("_flagged")


def _row_name() -> Column:
    """A text that rows of one id and text share, in the order of ids (NULL last), then of the texts' MD5."""
    # Hexadecimal digits of a negative number begin with f, so the sign comes first.
    place = F.concat(F.when(F.col("doc_id") < 0, "0").otherwise("1"), F.lpad(F.hex("doc_id"), 16, "0"))
    return F.concat(F.coalesce(place, F.lit("2")), F.lit(" "), F.md5(F.coalesce("text", F.lit(""))))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_contamination(_documents(docs), benchmark, COLUMNS)
    return found.filter("NOT _contaminated").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(_documents(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents and shard."""
    return sharding.assign_shards(_documents(docs)).select(*COLUMNS, F.col("_shard").alias("shard"))


STAGES = [
    ("language identification", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix_sources),
    ("sharding", shard),
]

# A fitted model decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents; each but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
