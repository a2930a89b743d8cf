"""The queries of this package, each over its whole tables, and the SQL that must agree with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import conversations, decontamination, html_extraction, jaccard_join, language, line_dedup, merkle, mixing, secrets, sharding, toxicity, url_filter, vector_search

# The documents are read in so many batches, by files.
LINE_BATCHES = 8


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern of every page."""
    found = url_filter.filter_urls(_read(spark, sf_dir, "pages"), ["page_id"])
    return found.toDF("page_id", "host", "path", "rule", "pattern", "verdict")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example of every document."""
    found = secrets.scan_secrets(_read(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "doc_id",
        *[F.col(f"_{c}").alias(c) for c in ("n_assign", "n_access", "n_hex")],
        F.sha2("_base", 256).alias("base_sha256"),
        *[F.col(f"_{c}").alias(c) for c in ("spans", "n_live", "n_example")],
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    docs = _read(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select(
        "doc_id",
        language.held_out("doc_id").alias("held_out"),
        F.col("_lang").alias("lang_pred"),
        F.col("_score").alias("score"),
        F.col("_rejected").alias("rejected"),
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    found = html_extraction.extract_main_text(_read(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.select("page_id", "url", F.col("_text").alias("text"), F.char_length("_text").cast("long").alias("n_chars"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    found = jaccard_join.similar_documents(_read(spark, sf_dir, "documents"))
    return found.toDF("doc_id", "n_shingles", "component_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = decontamination.find_contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"),
        F.col("_contaminated").alias("contaminated"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, shard, depth of every document."""
    return sharding.assign_shards(_read(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_bytes").alias("n_bytes"), F.col("_shard").alias("shard"), F.col("_depth").alias("depth")
    )


def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: 20 nearest vectors of every vector whose id is divisible by 20."""
    return vector_search.nearest(_read(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every document."""
    return mixing.mixed(_read(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
        F.col("_copies").alias("copies"),
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    docs = _read(spark, sf_dir, "documents")
    found = line_dedup.dedup_lines(docs, batches=line_dedup.file_batches(docs, LINE_BATCHES))
    return found.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("_kept", 256).alias("kept_sha256")
    )


def damaged_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of conversations with faults, chosen by a checksum of conversation and turn; dropped ones are not ``kept``."""
    table = _read(spark, sf_dir, "conversations")
    blank = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    text = F.coalesce(F.col("text"), blank)
    kind = F.col("kind")
    damaged = table.withColumn("kind", F.crc32(place) % 20).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role"), blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("kept"),
        F.explode(F.array_repeat(F.lit(True), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return damaged.drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    rows = conversations.conversation_rows(damaged_conversations(spark, sf_dir), present=F.col("kept"))
    found = conversations.repair_conversations(rows)
    return found.toDF("conv_id", *[c[1:] for c in found.columns[1:-1]], "repaired_sha256")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document."""
    more = merkle.leaf_hash("doc_id", "source", "lang", F.col("n_chars") + 1, "text")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, more)
    found = merkle.merkle_manifest(_read(spark, sf_dir, "documents"), tampered=tampered)
    names = ("leaf", "subroot", "root", "proof_sha256")
    return found.select("doc_id", *[F.col(f"_{c}").alias(c) for c in names], F.col("_folded").alias("folded_root"), F.col("_verified").alias("verified"))


def _values(rows: list[tuple]) -> str:
    quoted = [", ".join("'" + str(v).replace("'", "''") + "'" for v in row) for row in rows]
    return ", ".join(f"({row})" for row in quoted)


# Every host rule and every pattern tried on every page, without an index.
URL_SQL = f"""
WITH rules(rule_host, rule_path, action) AS (VALUES {_values(url_filter.HOST_RULES)}),
patterns(name, regex) AS (VALUES {_values([(p.name, p.regex) for p in url_filter.PATTERNS])}),
rest AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), fitting AS (
  SELECT page_id, rule_host || rule_path AS rule, action FROM parts, rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
), best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM fitting GROUP BY page_id),
matched AS (
  SELECT page_id, MIN(name) AS pattern FROM parts, patterns
  WHERE regexp_matches(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), regex) GROUP BY page_id
)
SELECT page_id, host, path, rule, pattern,
       COALESCE(action, CASE WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN best USING (page_id) LEFT JOIN matched USING (page_id)
"""

_SECRET_KINDS = [
    (0, "assign", "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    (1, "access", "AKIA[A-Z0-9]+", 0, 18),
    (2, "hex", "[0-9a-f]+", 0, 16),
    *[(k, kind.name, kind.regex, kind.value, kind.least) for k, kind in enumerate(secrets.KINDS) if k > 2],
]


def _matches_sql(kind: int, regex: str, group: int, least: int) -> str:
    quoted = regex.replace("'", "''")
    return f"""
    SELECT doc_id, source, {kind} AS kind, n, value, sum(gap + size) OVER (PARTITION BY doc_id ORDER BY n) AS stop, size, {least} AS least
    FROM (SELECT doc_id, source, n, m[n] AS value0, v[n] AS value, length(m[n]) AS size, length(gaps[n]) AS gap
          FROM (SELECT *, unnest(range(1, len(m) + 1)) AS n
                FROM (SELECT doc_id, source, string_split_regex(text, '{quoted}') AS gaps, regexp_extract_all(text, '{quoted}') AS m,
                             regexp_extract_all(text, '{quoted}', {group}) AS v FROM documents)))"""


# The base kinds as the contract writes them, short matches and all.
SECRETS_SQL = f"""
WITH matches AS ({" UNION ALL ".join(_matches_sql(k, r, g, n) for k, _, r, g, n in _SECRET_KINDS)}),
found AS (SELECT doc_id, source, kind, stop - size AS start, stop, value FROM matches WHERE length(value) >= least),
owned AS (
  SELECT value, COUNT(DISTINCT source) + MAX(CASE WHEN source IS NULL THEN 1 ELSE 0 END) < {secrets.EXAMPLE_OWNERS}
                AND COUNT(DISTINCT doc_id) < {secrets.EXAMPLE_REPOSITORIES} AS live
  FROM found GROUP BY value
), known AS (
  SELECT f.*, live, name || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span
  FROM found f JOIN owned USING (value) JOIN (VALUES {", ".join(f"({k}, '{n}')" for k, n, *_ in _SECRET_KINDS)}) names(kind, name) USING (kind)
  WHERE f.kind < 3 OR live
), sums AS (
  SELECT doc_id, COUNT(*) FILTER (kind = 0) AS n_assign, COUNT(*) FILTER (kind = 1) AS n_access, COUNT(*) FILTER (kind = 2) AS n_hex,
         string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans,
         COUNT(*) FILTER (live) AS n_live, COUNT(*) FILTER (NOT live) AS n_example
  FROM known GROUP BY doc_id
)
SELECT doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex,
       sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans,
       COALESCE(n_live, 0) AS n_live, COALESCE(n_example, 0) AS n_example
FROM documents LEFT JOIN sums USING (doc_id)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CONTENT_WORDS = f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# Word windows of the documents joined with those of the items, without an automaton.
DECONTAMINATION_SQL = f"""
WITH items AS (
  SELECT item_id, w, LEAST(10, len(w)) AS width FROM (SELECT item_id, {_CONTENT_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), item_windows AS (
  SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS i FROM items)
), docs AS (SELECT doc_id, COALESCE({_CONTENT_WORDS}, []) AS w FROM documents),
doc_windows AS (
  SELECT doc_id, width, i, array_to_string(w[i:i + width - 1], ' ') AS win
  FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
        FROM docs, (SELECT DISTINCT width FROM items) WHERE len(w) >= width)
), hits AS (SELECT doc_id, i, d.width, item_id FROM doc_windows d JOIN item_windows USING (width, win)),
hit_words AS (
  SELECT doc_id, COUNT(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + width)) AS k FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       sha256(COALESCE(names, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, toxic, p_toxic, low_quality, p_low_quality of every document."""
    docs = _read(spark, sf_dir, "documents")
    labels = _read(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = toxicity.learn(docs, labels, ["low_quality", "toxic"])
    return toxicity.score(docs.select("doc_id", "text"), chain).select(
        "doc_id",
        F.col("_is_toxic").alias("toxic"),
        F.col("_p_toxic").alias("p_toxic"),
        F.col("_is_low_quality").alias("low_quality"),
        F.col("_p_low_quality").alias("p_low_quality"),
    )


# Buckets of all depths, then the shallowest that fits. Ids are unique in the given tables, so that no
# bucket needs pieces.
SHARDING_SQL = f"""
WITH keyed AS (
  SELECT doc_id, COALESCE(strlen(text), 0) AS n_bytes,
         CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k
  FROM documents
), levels AS (SELECT k, n_bytes, depth, k >> (60 - depth) AS bucket FROM keyed, range(0, 57) r(depth)),
sizes AS (SELECT depth, bucket, SUM(n_bytes) AS total, COUNT(*) AS n FROM levels GROUP BY depth, bucket),
fitting AS (
  SELECT l.k, MIN(l.depth) AS depth FROM levels l JOIN sizes s ON l.depth = s.depth AND l.bucket = s.bucket
  WHERE s.total <= {sharding.SHARD_BYTES} OR s.n = 1 GROUP BY l.k
)
SELECT doc_id, n_bytes, depth,
       's' || substr(lpad(CAST(CAST(k AS BIT) AS VARCHAR)[-60:], 60, '0'), 1, depth) AS shard
FROM keyed JOIN fitting USING (k)
"""

# Lines of all documents counted at once.
LINE_SQL = f"""
WITH texts AS (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place,
  FROM texts
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM lines
), frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING COUNT(DISTINCT doc_id) >= {line_dedup.LEAST_DOCUMENTS})
SELECT doc_id, COUNT(*) AS n_lines, COUNT(f.key) AS n_dropped,
       sha256(COALESCE(string_agg(line, chr(10) ORDER BY place) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f USING (key) GROUP BY doc_id
"""


def _field_sql(value: str) -> str:
    return f"COALESCE(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# CRC-32 of a text of ASCII characters, bit by bit.
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda sum, byte: list_reduce(list_prepend(xor(sum, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda bits, _: CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, 3988292384) ELSE bits >> 1 END)), 4294967295)"""

# Leaves sorted, trees level by level, and each leaf folded with its siblings one by one. Ids are unique in the given tables.
MERKLE_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, {_leaf_sql("n_chars + 1")} AS more, {_CRC_SQL} % 7 = 0 AS tampered,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS slot, COUNT(*) OVER (PARTITION BY lang) AS n
  FROM documents
), nodes AS (
  SELECT 0 AS level, lang, slot, leaf AS node, n FROM docs
  UNION ALL
  SELECT level + 1, lang, slot // 2, sha256(string_agg(node, '' ORDER BY slot)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY level, lang, slot // 2, n
), subroots AS (
  SELECT lang, level AS height, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS slot, COUNT(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, slot, subroot AS node, n FROM subroots
  UNION ALL
  SELECT level + 1, slot // 2, sha256(string_agg(node, '' ORDER BY slot)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, slot // 2, n
), ends AS (SELECT level AS top_height, node AS root FROM tops WHERE n = 1),
places AS (
  SELECT doc_id, d.lang, l AS step, l AS level, d.slot >> l AS slot, false AS top
  FROM docs d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang, unnest(range(height)) r(l)
  UNION ALL
  SELECT doc_id, d.lang, height + l, l, s.slot >> l, true
  FROM docs d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang, ends, unnest(range(top_height)) r(l)
), steps AS (
  SELECT doc_id, step, p.slot, COALESCE(a.node, b.node) AS sibling
  FROM places p LEFT JOIN nodes a ON NOT top AND a.level = p.level AND a.lang IS NOT DISTINCT FROM p.lang AND a.slot = xor(p.slot, 1)
  LEFT JOIN tops b ON top AND b.level = p.level AND b.slot = xor(p.slot, 1)
), folds AS (
  SELECT doc_id, 0 AS step, CASE WHEN tampered THEN more ELSE leaf END AS node FROM docs
  UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(CASE WHEN sibling IS NULL THEN node WHEN slot % 2 = 1 THEN sibling || node ELSE node || sibling END)
  FROM folds f JOIN steps s ON f.doc_id = s.doc_id AND f.step = s.step
), proofs AS (SELECT doc_id, string_agg(sibling, '' ORDER BY step) AS proof FROM steps GROUP BY doc_id)
SELECT d.doc_id, leaf, subroot, root, sha256(COALESCE(proof, '')) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM docs d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang CROSS JOIN ends
JOIN folds f ON f.doc_id = d.doc_id AND f.step = height + top_height LEFT JOIN proofs p ON p.doc_id = d.doc_id
"""

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_secrets": op2_secrets,
    "op3_language": op3_language,
    "op4_html_extraction": op4_html_extraction,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_vector_search": op8_vector_search,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_line_dedup": op11_line_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE_SQL = {
    "op1_url_filter": URL_SQL,
    "op2_secrets": SECRETS_SQL,
    "op6_decontamination": DECONTAMINATION_SQL,
    "op7_sharding": SHARDING_SQL,
    "op11_line_dedup": LINE_SQL,
    "op13_merkle_manifest": MERKLE_SQL,
}
