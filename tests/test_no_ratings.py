"""Tables in which no line meets an order, or lines have no quantity, so that ratings are missing: the trained models' queries return what SQL does."""

import duckdb
import oracle
import pytest

import __spark_entry__ as entry_point
from palate.operators import als, evaluate

NAMES = sorted(n for n in entry_point.queries() if n.startswith("als_"))
#: Rows of the queries that have no SQL counterpart; the others list or predict something, and have none.
ROWS = {"als_test_rmse": [(0, None)], "als_final_rmse": [("train+validation", 0, None), ("all ratings", 0, None)]}


def write(spark, folder, order_keys, lines=4):
    """Lines on orders of the same key, and orders with the keys given."""
    spark.range(lines).selectExpr("id AS l_orderkey", "id AS l_partkey", "IF(id > 4 AND id % 3 = 0, NULL, id % 5 * 10.0D + 1) AS l_quantity",
                              "TIMESTAMP_NTZ '1995-01-01' AS l_shipdate").write.parquet(f"{folder}/lineitem.parquet")
    keys = ", ".join(f"({k})" for k in order_keys)
    spark.sql(f"SELECT CAST(col1 AS BIGINT) AS o_orderkey, CAST(42 AS BIGINT) AS o_custkey FROM VALUES {keys}").write.parquet(f"{folder}/orders.parquet")
    spark.range(4).selectExpr("id AS p_partkey", "'part' AS p_name", "'ECONOMY' AS p_type", "'Brand#1' AS p_brand").write.parquet(f"{folder}/part.parquet")
    con = duckdb.connect()
    for name in ("lineitem", "orders", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return folder, con


@pytest.fixture(scope="module")
def unrated(spark, tmp_path_factory):
    return write(spark, str(tmp_path_factory.mktemp("unrated")), (100, 101))


@pytest.fixture(scope="module")
def rated_once(spark, tmp_path_factory):
    return write(spark, str(tmp_path_factory.mktemp("rated-once")), (3, 101))


@pytest.mark.parametrize("name", NAMES)
def test_a_query_without_ratings_returns_what_sql_does(spark, unrated, name):
    folder, con = unrated
    got = entry_point.queries()[name](spark, folder)
    if name in entry_point.oracle_sql():
        assert oracle.difference(got, con, entry_point.oracle_sql()[name]) is None
    elif name == "als_grid_search":
        assert [(r.n_scored, r.is_best) for r in got.collect()] == [(0, False)] * 42
    else:
        assert [tuple(r) for r in got.collect()] == ROWS.get(name, [])


@pytest.mark.parametrize("name", ["als_prediction_counts", "als_rmse_checks", "als_fit_residuals", "als_factor_counts", "als_cold_start_audit",
                                  "als_topn_user_checks", "als_topn_all_users_checks", "als_save_load_roundtrip"])
def test_a_query_with_a_single_rating_returns_what_sql_does(spark, rated_once, name):
    """Two parts of the split are empty, and the one user has seen the one item that a model knows."""
    folder, con = rated_once
    assert oracle.difference(entry_point.queries()[name](spark, folder), con, entry_point.oracle_sql()[name]) is None


def test_errors_leave_out_rows_without_a_rating(spark, tmp_path):
    folder, _ = write(spark, str(tmp_path), range(60), lines=60)
    rows = entry_point.queries()["als_rmse_checks"](spark, folder).collect()
    assert [r.mode for r in rows] == ["train", "train+validation", "all ratings"] and rows[2].n_scored > 0
    assert all(r.as_evaluator and r.as_factor_product for r in rows)


def test_a_fit_without_rows_has_the_settings_and_no_factors(spark, frame):
    model = als.fit(frame([(None, 1, 3.0), (1, None, 3.0), (1, 1, None)]), rank=3)
    assert (model.rank, model.userFactors.count(), model.itemFactors.count()) == (3, 0, 0)
    assert evaluate.rmse(model.transform(frame([(0, 0, 1.0)]))).first() == (0, None)


def test_a_search_that_need_not_choose_marks_none(frame):
    rows = frame([(u, i, 1.0 + u) for u in range(3) for i in range(3)])
    search = als.grid_search(rows, rows.limit(0), (1,), (0.1, 1.0), max_iter=1, keep_models=True, must_choose=False)
    assert (search.model, search.rank, search.reg_param) == (None, None, None) and sorted(search.paths) == [0, 1]
    assert [(r.n_scored, r.is_best) for r in search.metrics.collect()] == [(0, False)] * 2
