"""The pipeline stage by stage, and every query over the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from arbolytics.llm import decontaminate as D
from arbolytics.llm.queries import QUERIES, SQL
from tests.llm.test_pairs_and_passages import brute_classes, brute_lines
from tests.llm.test_texts_and_files import best_distance, text_in
from tools.check_queries import TABLES, compare

FOLDER = "/root/testdata/sf0.001"


def test_stages(docs, spark, tmp_path):
    langs = ("aa", "bb", "cc")
    rows = [(i, text_in(langs[i % 3], 60, i) + "\n" + text_in(langs[i % 3], 12, i % 7), langs[i % 3], "s", 1) for i in range(150)]
    rows += [(200 + i, rows[i][1].replace(" ", " x ", 1), rows[i][2], "s", 1) for i in range(10)]  # near copies
    item = text_in("bb", 15, "item")
    rows += [(300, text_in("bb", 40, 300) + " " + item + " " + text_in("bb", 30, 301), "bb", "s", 1), (301, None, "aa", "s", 1), (302, "--", "aa", "s", 1),
             (303, rows[0][1], "aa", "s", 1)]
    df = docs(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = df
    for name, function in P.STAGES[:-1]:
        before = {r.doc_id: r for r in kept.collect()}
        function(spark, kept, str(tmp_path)).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in kept.collect()}
        assert kept.columns == df.columns and set(after) <= set(before)
        texts = [(d, r.text) for d, r in before.items()]
        if name == "language_id":
            assert set(before) - set(after) == {301, 302}
        elif name == "line_dedup":
            want = brute_lines(texts, 1)
            assert {d: r.text for d, r in after.items()} == {d: t for d, t in want.items() if t == before[d].text or t.strip()}
            assert 303 not in after
        elif name == "near_duplicates":
            assert set(after) == {d for d, _, c in brute_classes(texts, 5, 80, 100) if d == c}
        else:
            assert set(before) - set(after) == {d for d, t in texts if best_distance(item, " ".join(t.lower().split())) <= D.budget(len(item))} == {300}
    assert P.STAGES[-1][1](spark, kept, str(tmp_path)).count() == kept.count()


def test_pipeline_runs_over_documents(spark):
    got = P.run(spark, FOLDER)
    total = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert 0.5 * total < got.count() < total and got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, FOLDER)
    if name in SQL:
        db = duckdb.connect()
        for t in TABLES:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
        assert compare(got.toPandas(), db.execute(SQL[name]).fetchdf()) == ""
    else:
        source = "embeddings" if name.startswith("op3") else "pages" if name.startswith("op5") else "documents"
        rows = spark.read.parquet(f"{FOLDER}/{source}.parquet")
        assert got.count() == (rows.filter(F.col("vec_id") % 20 == 0).count() * 20 if source == "embeddings" else rows.count())
