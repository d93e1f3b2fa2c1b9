"""Shapes of physical plans: what must reach the scan, and what must not appear."""

import os

import pytest

from corpusengine.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
#: Queries that join a table of one row.
ONE_ROW = {"validate_counts"}


def plan(spark, name):
    return catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in ONE_ROW])
def test_no_nested_loops(spark, name):
    text = plan(spark, name)
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text


def test_columns_are_pruned(spark):
    text = plan(spark, "daily_metrics")
    assert "props" not in text and "event_id" not in text
    assert "text" not in plan(spark, "anti_not_exists")


def test_filters_reach_the_scan(spark):
    assert "GreaterThanOrEqual(p_size,40)" in plan(spark, "semi_in_chain")
    assert "EqualTo(o_orderstatus,F)" in plan(spark, "anti_not_in")


@pytest.mark.parametrize("name", ["top5_revenue", "topk_cosine", "unnest_topk", "doc_freq"])
def test_top_k_never_sorts_everything(spark, name):
    text = plan(spark, name)
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_first_rows_of_groups_are_limited_early(spark):
    assert "WindowGroupLimit" in plan(spark, "earliest_per_user_type")


def test_stars_aggregate_before_they_join(spark):
    assert "Expand" not in plan(spark, "star_distinct_filter")


def test_outer_join_becomes_inner(spark):
    assert "LeftOuter" not in plan(spark, "left_is_not_null") and "Inner" in plan(spark, "left_is_not_null")


def test_weights_are_of_the_whole_vocabulary(spark, tmp_path, monkeypatch):
    import math

    from corpusengine.operators import vectors
    from corpusengine.plans import catalog

    texts = [" ".join(f"term{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200) if k % (i + 1) == 0) for i in range(4)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = {}
    for t in texts:
        for w in set(vectors.words(t)):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(5 / (1 + n)) + 1 for w, n in df.items() if n >= 2}
    assert len(idf) > 100
    assert {r["term"]: r["idf"] for r in catalog.QUERIES["idf_table"](spark, str(tmp_path)).collect()} == pytest.approx(idf, abs=1e-6)
    got = {(r["doc_id"], r["term"]): r["weight"] for r in catalog.QUERIES["term_weights"](spark, str(tmp_path)).collect()}
    assert got == pytest.approx({(i, w): math.log(2) * idf[w] for i, t in enumerate(texts) for w in vectors.words(t) if w in idf}, abs=1e-6)
    asked = []
    monkeypatch.setattr(vectors, "fit", lambda docs, text, dims=128, **k: asked.append(dims) or vectors.Lsa({}, None, None))
    with pytest.raises(Exception):
        catalog.QUERIES["lsa_rank"](spark, str(tmp_path))
    assert asked == [128]


def test_trials_are_read_once(spark):
    from corpusengine.plans.standin import Frames

    text = Frames(spark, SF).read("link_drug_trial")._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet [o_orderkey") == 1


def test_profile_counts_names_that_proteins_share(spark, tmp_path):
    """Tables twice, with shifted keys: each supplier's name is the name of two proteins."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t, keys in {"part": ["p_partkey"], "supplier": ["s_suppkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"]}.items():
        shifted = ", ".join(f"CAST({k} + n * 1000000 AS BIGINT) AS {k}" for k in keys)
        con.execute(f"COPY (SELECT t.* REPLACE ({shifted}) FROM '{SF}/{t}.parquet' t, range(2) r(n)) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = sorted(tuple(r) for r in catalog.QUERIES["kb_drug_profile"](spark, str(tmp_path)).collect())
    assert got == sorted(con.execute(catalog.SQL["kb_drug_profile"]).fetchall())
    assert {r[0] for r in got} == {"name", "condition", "protein"}
