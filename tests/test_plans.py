"""Physical-plan properties the operators rely on at scale."""

from tessera.plans import billing, elt, tables, warehouse

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + \
        df._jdf.queryExecution().optimizedPlan().toString()


def test_dedup_uses_partial_window_group_limit(spark):
    p = plan(elt.elt_clean_dedup(spark, SF))
    assert "WindowGroupLimit" in p


def test_cost_by_activity_pushes_filters_and_preaggregates(spark):
    df = billing.cost_by_activity(spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in p and "l_shipdate" in p
    # partial aggregation of lineitem by part key happens before the join
    assert p.count("HashAggregate") >= 4


def test_scan_prunes_columns(spark):
    p = tables.scan_parquet(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint," \
           "l_quantity:double,l_extendedprice:double>" in p


def test_nested_field_prunes_nested_columns(spark):
    p = billing.nested_field(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "sku:struct<description:string>" in p


def test_partition_day_prunes_partitions(spark):
    files = tables.partition_day(spark, SF).inputFiles()
    assert files and all(f"dt={tables.DAY}" in f for f in files)


def test_topk_is_take_ordered(spark):
    p = warehouse.usage_by_user(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in p
