import hashlib
from collections import Counter

from pyspark.sql import functions as F

from skyledger.llm import line_dedup
from tests.llm.support import LOWER, ODD_ROWS, documents

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def plain(texts, least, chars=1):
    keys = [[line.strip(BLANKS).translate(LOWER) for line in (t or "").split("\n")] for t in texts]
    seen = Counter(key for found in keys for key in set(found))
    drop = {k for k, n in seen.items() if n >= least and len(k) >= chars}
    return [
        (len(found), sum(k in drop for k in found), "\n".join(line for line, k in zip((t or "").split("\n"), found) if k not in drop))
        for t, found in zip(texts, keys)
    ]


def found(table):
    return sorted((r._n_lines, r._n_dropped, r._kept) for r in table.collect())


def texts_with_shared_lines():
    texts = []
    for k in range(60):
        lines = [f"own line {k} {j}" for j in range(k % 5)] + ["Licence text", "  licence TEXT\t", "", f"group {k % 7}", f"rare {k // 9}", "ÀÉ", "àé" if k % 2 else "Àé"]
        texts.append("\n".join(lines[k % 4 :] + lines[: k % 4]))
    return texts


def test_shared_lines_go_and_others_stay_as_they_were(spark):
    texts = texts_with_shared_lines()
    docs = documents(spark, [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)])
    for least in (1, 2, 9, 10, 31):
        assert found(line_dedup.dedup_lines(docs, least_documents=least)) == sorted(plain(texts, least))
    assert found(line_dedup.dedup_lines(docs, least_documents=2, least_chars=3)) == sorted(plain(texts, 2, 3))


def test_batches_give_what_one_batch_gives(spark):
    texts = texts_with_shared_lines()
    docs = documents(spark, [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)])
    parts = [docs.filter(F.col("doc_id") % 11 == k) for k in range(11)]
    assert found(line_dedup.dedup_lines(docs, batches=parts, least_documents=8)) == sorted(plain(texts, 8))


def test_runs_are_compacted_by_level_and_known_keys_are_not_added_again(spark):
    runs = line_dedup.LineRuns(spark, least_documents=2)
    for number in range(9):
        texts = [(number * 10 + k, f"always\nnumber {number}\nfirst" if number == 0 else f"always\nnumber {number}", None, None, None) for k in range(3)]
        runs.add(documents(spark, texts))
        assert all(len(level) < 2 for level in runs.levels)
    assert [len(level) for level in runs.levels] == [1, 0, 0, 1]
    counts = sorted(r.n for r in runs.entries().collect())
    # "always" is known as frequent after the first batch of each run, and its later counts are not stored.
    assert counts == [3] * 11
    assert spark.sql(f"SHOW TABLES IN {runs.database}").count() == 2
    runs.drop()
    assert not spark.sql(f"SHOW DATABASES LIKE '{runs.database}'").count()


def test_runs_merge_without_a_shuffle(spark):
    runs = line_dedup.LineRuns(spark, least_documents=2)
    for number in range(2):
        runs.add(documents(spark, [(k, f"line {k}\nother {number}", None, None, None) for k in range(50)]))
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {runs.database}").collect()]
    assert len(tables) == 1
    runs.add(documents(spark, [(k, f"line {k}", None, None, None) for k in range(50)]))
    plan = runs.entries()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    runs.drop()


def test_odd_rows_have_defined_results(spark):
    rows = [r for r in ODD_ROWS] * 2
    docs = documents(spark, rows, hi="x", r1=3, turn=2, _text="t", _row=1, dropped="d", key="k")
    result = line_dedup.dedup_lines(docs, keep=docs.columns, least_documents=2)
    assert result.columns == [*docs.columns, "_n_lines", "_n_dropped", "_kept"]
    assert found(result) == sorted(plain([r[1] for r in rows], 2))
    assert line_dedup.dedup_lines(docs.filter("false")).collect() == []


def test_many_copies_of_one_row_are_dealt_over_tasks(spark):
    copies = [(None, "same line\nand another", None, None, None)] * 5000
    docs = documents(spark, copies + [(k, f"own {k}", None, None, None) for k in range(2000)]).repartition(4)
    result = line_dedup.dedup_lines(docs)
    counts = Counter((r._n_lines, r._n_dropped, r._kept != "") for r in result.collect())
    assert counts == {(2, 2, False): 5000, (1, 0, True): 2000}


def test_query_hashes_what_is_kept(spark, sf_dir):
    from skyledger.llm.queries import op11_line_dedup

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    expected = dict(zip(texts, plain(texts.values(), 10)))
    rows = op11_line_dedup(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        lines, dropped, kept = expected[r.doc_id]
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == (lines, dropped, hashlib.sha256(kept.encode()).hexdigest())
