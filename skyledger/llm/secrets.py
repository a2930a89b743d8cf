"""Secret scan with corpus-wide ownership.

Regular expressions find candidates in every text, with their places in code points. Their values, hashed,
are then counted over the whole corpus, by distinct owners and by distinct repositories: what many owners
or many repositories have is an example that people copy, what few have looks live. Candidates of the base kinds are always
reported; the further kinds, which match looser, only if their ownership makes them look live.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.common import carried, saved

# A value of so many distinct owners, or of so many distinct repositories, whoever owns them, is an example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 10


@dataclass(frozen=True)
class Kind:
    """``value`` is the group of ``regex`` that holds the secret; ``least`` its smallest length."""

    name: str
    regex: str
    value: int = 0
    least: int = 0
    base: bool = True


# The first three are fixed by the query contract. Where a shorter match would be dropped anyway, and can
# neither hide nor cut a longer one, the least length stands in the expression.
KINDS = [
    Kind("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Kind("access", "AKIA[A-Z0-9]{14,}"),
    Kind("hex", "[0-9a-f]{16,}"),
    Kind("vendor", "(?:gh[oprsu]_|sk-|xox[abprs]-|AIza)[A-Za-z0-9_-]{20,}", base=False),
    Kind("jwt", "eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}", base=False),
    Kind("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----\\s+[A-Za-z0-9+/=\\s]{20,}", base=False),
]


# The columns that :func:`scan_secrets` adds.
NUMBERS = [*[f"_n_{k.name}" for k in KINDS[:3]], "_n_live", "_n_example", "_owners", "_repositories"]
ADDED = [*NUMBERS, "_base", "_spans"]


def _found(text: Column, kind: Kind) -> Column:
    """Per match in order: characters since the last one, its characters, its value; empty if there is none.

    Cutting the text at the matches leaves what lies between them, so that both lists together give all places.
    """
    between = F.transform(F.split(text, kind.regex, -1), lambda t: F.char_length(t))
    matches = F.regexp_extract_all(text, F.lit(kind.regex), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(kind.regex), F.lit(kind.value)) if kind.value else matches
    each = F.transform(
        F.arrays_zip(matches.alias("match"), values.alias("value")),
        lambda m, i: F.struct(
            i.alias("place"), F.get(between, i).alias("gap"), F.char_length(m["match"]).alias("length"), m["value"].alias("value")
        ),
    )
    return F.when(text.rlike(kind.regex), each)


def _placed(matches: DataFrame) -> DataFrame:
    """Running sums of gaps and matches, within one row and kind, are the places."""
    order = Window.partitionBy("_row", "kind").orderBy("place")
    least = F.element_at(F.array(*[F.lit(k.least) for k in KINDS]), F.col("kind") + 1)
    return (
        matches.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(order).cast("long"))
        .withColumn("start", F.col("end") - F.col("length"))
        .filter(F.char_length("value") >= least)
        .select("_row", "_owner", "_repository", "kind", "start", "end", F.sha2("value", 256).alias("hash"))
    )


def ownership(found: DataFrame) -> DataFrame:
    """hash, owners, repositories: how many distinct ones have a value. A NULL is one owner, or repository, more.

    Distinct repositories are counted before owners, each step with partial sums, so a value that a third of
    all rows hold is no hot key.
    """
    repositories = found.groupBy("hash", "_owner", "_repository").agg(F.lit(1).alias("one"))
    owners = repositories.groupBy("hash", "_owner").agg(F.count("*").alias("n"))
    return owners.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def _joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of their starts."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.concat_ws(",", F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    ))


def scan_secrets(docs: DataFrame, keep: list[str], text_column: str = "text", owner_column: str = "source",
                 repository_column: str = "doc_id") -> DataFrame:
    """``keep`` columns of every row, and what was found in its text.

    _n_assign, _n_access, _n_hex, _base and _spans (kind:start:end, comma-joined, all and base kinds only),
    _n_live and _n_example (spans of _spans by ownership of their value), _owners and _repositories (the most of a
    value). NULL and empty texts have none; repeated rows are rows of one repository; a NULL owner is an owner. No rows give
    no rows. ``keep`` may have any names; one like an added column's is replaced by that.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), carried(keep, ADDED), F.col(owner_column).cast("string").alias("_owner"),
        F.col(repository_column).cast("string").alias("_repository"), F.col(text_column).cast("string").alias("_text"),
    )
    kinds = F.array(*[
        F.struct(F.lit(k).alias("kind"), _found(F.col("_text"), kind).alias("found")) for k, kind in enumerate(KINDS)
    ])
    # One pass over the texts; what follows reads only what they held.
    scanned = saved(rows.withColumn("_kinds", F.filter(kinds, lambda k: k["found"].isNotNull())).drop("_text"))
    matches = scanned.select("_row", "_owner", "_repository", F.inline("_kinds")).select(
        "_row", "_owner", "_repository", "kind", F.inline("found")
    )
    found = saved(_placed(matches))
    known = found.join(ownership(found), "hash").withColumn(
        "live", (F.col("owners") < EXAMPLE_OWNERS) & (F.col("repositories") < EXAMPLE_REPOSITORIES)
    )
    base = F.array(*[F.lit(k.base) for k in KINDS])
    known = known.withColumn("base", F.element_at(base, F.col("kind") + 1)).filter("base OR live")
    span = F.struct("start", "kind", "end")
    per_row = known.groupBy(F.col("_row").alias("_of")).agg(
        *[F.count_if(F.col("kind") == k).alias(f"_n_{KINDS[k].name}") for k in range(3)],
        F.collect_list(F.when(F.col("base"), span)).alias("_base"),
        F.collect_list(span).alias("_spans"),
        F.count_if("live").alias("_n_live"),
        F.count_if(~F.col("live")).alias("_n_example"),
        F.max("owners").alias("_owners"),
        F.max("repositories").alias("_repositories"),
    ).withColumns({"_base": _joined(F.col("_base")), "_spans": _joined(F.col("_spans"))})
    joined = scanned.select("_row", "_keep").join(per_row, F.col("_row") == F.col("_of"), "left")
    return joined.select(
        "_keep.*", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in NUMBERS],
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("_base", "_spans")],
    )
