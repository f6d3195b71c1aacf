import oracle
import pytest

from hypercell.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_against_sql(spark, name):
    df = catalogue.queries()[name](spark, oracle.SF)
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert df.collect()
    else:
        oracle.same(df, sql, oracle.SF)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_row_count_is_not_capped(spark, tmp_path):
    from hypercell.plans import catalogue

    spark.range(3).selectExpr("id AS c_custkey", *[f"'x' AS c{k}" for k in range(6)]).write.parquet(str(tmp_path / "customer.parquet"))
    assert tuple(catalogue.queries()["row_count"](spark, str(tmp_path)).first()) == (3, 7)
