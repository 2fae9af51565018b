"""Every registered query of the reference's operators against DuckDB over the same tables."""

import duckdb
import pytest

from millrace import plans
from oracle import assert_same, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert_same(plans.queries()[name](spark, SF), connect(SF), plans.oracle_sql()[name])


def test_passages_without_a_whole_word_are_found(spark, tmp_path):
    texts = ["one wordy passage of many", "prefix unbroken suffix", "das 日本語の文章です end", "alpha beta gamma delta omega", "", "an unbrokenly kept twofold ending here"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items = ["unbroken", "の文章", "wordy pass", "twofold end", "a", "wordy passage of", "nowhere", "", "this opening has more than forty characters of text"]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert_same(plans.queries()["citation_form"](spark, str(tmp_path)), con, plans.oracle_sql()["citation_form"])
    got = {r["item_id"]: (r["n_docs"], r["first_doc"]) for r in plans.queries()["quote_check"](spark, str(tmp_path)).collect()}
    assert got == {i: (sum(q in t for t in texts), min((k for k, t in enumerate(texts) if q in t), default=-1)) if q else (0, -1) for i, q in enumerate(items)}
    spark.createDataFrame([(1, "beta...omega"), (2, "gamma delta...alpha")], "item_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/benchmark.parquet")
    assert {r["item_id"]: r["n_docs"] for r in plans.queries()["quote_check"](spark, str(tmp_path)).collect()} == {1: 1, 2: 0}


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_other_queries_have_rows(spark, name):
    assert plans.queries()[name](spark, SF).count() > 0
