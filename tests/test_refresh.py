"""Full refresh: every dataset materialised as a table, downstream reads tables."""

from conftest import SF_SMALL
from hearthlake.plans.medallion import DATASETS
from hearthlake.plans.queries import graph
from hearthlake.sources.sinks import ensure_schema


def test_refresh_writes_every_dataset(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS refresh_test LOCATION '{tmp_path / 'db'}'")
    ensure_schema(spark, "refresh_test", comment="curated retail datasets")
    g = graph(spark, SF_SMALL)
    written = g.refresh(spark, database="refresh_test")
    assert written == [f"refresh_test.{name}" for name in DATASETS]
    tables = {t.name for t in spark.catalog.listTables("refresh_test")}
    assert tables == set(DATASETS)
    lazy = graph(spark, SF_SMALL)
    for name in ("silver_pos_transactions", "gold_daily_franchise_health", "gold_store_scorecard"):
        assert spark.table(f"refresh_test.{name}").count() == lazy[name].count()
    comment = [r for r in spark.sql("DESCRIBE TABLE EXTENDED refresh_test.gold_customer_360").collect()
               if r.col_name == "Comment"]
    assert comment and comment[0].data_type == DATASETS["gold_customer_360"][1]
    checks = spark.table("refresh_test.gold_test_daily_franchise_health_quality").collect()
    assert {r.test_name: r.failed_records for r in checks}["aggregation_mismatch_vs_silver"] == 0
    from hearthlake.plans.medallion import stored_check_report
    report = stored_check_report(spark, "refresh_test").collect()
    assert len(report) == 8 + 5 + 3 + 4 + 4 + 3 + 3
    failing = [(r.dataset, r.test_name) for r in report if not r.test_passed]
    assert report[:len(failing)] == [r for r in report if not r.test_passed]  # failures listed first
    assert ("silver_test_foundation_quality", "unmasked_email_patterns") in failing  # the planted email leaks
    import contextlib
    import io
    from hearthlake.__main__ import main
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        assert main(["checks", "--database", "refresh_test"]) == 0
    assert "unmasked_email_patterns" in out.getvalue()
    spark.sql("DROP DATABASE refresh_test CASCADE")


def test_datasets_as_sql_views(spark):
    g = graph(spark, SF_SMALL)
    assert g.register_views(["gold_customer_360", "silver_pos_transactions"]) == [
        "silver_pos_transactions", "gold_customer_360"]
    n = spark.sql("""SELECT count(*) AS n FROM gold_customer_360 c
                     JOIN (SELECT DISTINCT customer_id FROM silver_pos_transactions) t USING (customer_id)""").first().n
    assert n == g["gold_customer_360"].count()


def test_catalog_sources_give_the_same_datasets(spark, tmp_path):
    from hearthlake.plans.medallion import Medallion
    from hearthlake.sources import TableReader, catalog_sources, stage_sources
    spark.sql(f"CREATE DATABASE IF NOT EXISTS src_test LOCATION '{tmp_path / 'src'}'")
    staged = stage_sources(TableReader(spark, SF_SMALL))
    for name in ("customers", "franchises", "suppliers", "transactions", "reviews"):
        getattr(staged, name).write.mode("overwrite").saveAsTable(f"src_test.{name}")
    from_catalog = Medallion(catalog_sources(TableReader(spark, database="src_test")))
    from_staging = Medallion(staged)
    for dataset in ("gold_daily_franchise_health", "gold_customer_360", "gold_store_sentiment_trends"):
        a = from_catalog[dataset]
        b = from_staging[dataset]
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, dataset
    spark.sql("DROP DATABASE src_test CASCADE")


def test_group_refresh_reads_upstream_tables(spark, tmp_path):
    from pyspark.sql import functions as F
    from hearthlake.plans.medallion import REFRESH_GROUPS
    assert sorted(n for names in REFRESH_GROUPS.values() for n in names) == sorted(DATASETS)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS group_test LOCATION '{tmp_path / 'db'}'")
    graph(spark, SF_SMALL).refresh(spark, database="group_test", group="foundation")
    # change the stored silver transactions: keep one store only
    from hearthlake.sources.sinks import table_path, write_table
    kept = spark.table("group_test.silver_pos_transactions").where(F.col("store_id") == "1")
    write_table(kept, "group_test.tx_store_1", path=table_path(spark, "group_test", "tx_store_1"))
    write_table(spark.table("group_test.tx_store_1"), "group_test.silver_pos_transactions",
                path=table_path(spark, "group_test", "silver_pos_transactions"))
    written = graph(spark, SF_SMALL).refresh(spark, database="group_test", group="daily_health")
    assert written == ["group_test.gold_daily_franchise_health", "group_test.gold_test_daily_franchise_health_quality"]
    stores = {r.store_id for r in spark.table("group_test.gold_daily_franchise_health").collect()}
    assert stores == {"1"}  # built from the stored table, not recomputed from the sources
    checks = {r.test_name: r.failed_records for r in
              spark.table("group_test.gold_test_daily_franchise_health_quality").collect()}
    assert checks["aggregation_mismatch_vs_silver"] == 0
    spark.sql("DROP DATABASE group_test CASCADE")


def test_group_refresh_needs_its_inputs_and_real_errors_are_raised(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException
    from hearthlake.plans.medallion import GROUP_INPUTS, REFRESH_GROUPS
    from hearthlake.sources import sinks
    assert GROUP_INPUTS.keys() == REFRESH_GROUPS.keys()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS missing_test LOCATION '{tmp_path / 'db'}'")
    with pytest.raises(ValueError, match="silver_pos_transactions"):
        graph(spark, SF_SMALL).refresh(spark, database="missing_test", group="daily_health")
    broken = tmp_path / "db" / "bronze_supply_chain"
    broken.mkdir(parents=True)
    assert sinks.attach_tables(spark, "missing_test", ["bronze_supply_chain"]) == []  # an empty folder: no table
    (broken / "part-0.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception) as error:
        sinks.attach_tables(spark, "missing_test", ["bronze_supply_chain"])
    assert not isinstance(error.value, AnalysisException) or error.value.getCondition() not in sinks.MISSING
    spark.sql("DROP DATABASE missing_test CASCADE")


def test_a_new_session_catalog_can_reattach_and_rewrite(spark, tmp_path):
    """Simulates a later run whose catalog forgot the tables: the table
    entries are dropped (external data stays), re-attached, and rewritten."""
    from hearthlake.sources.sinks import attach_tables
    spark.sql(f"CREATE DATABASE IF NOT EXISTS attach_test LOCATION '{tmp_path / 'db'}'")
    g = graph(spark, SF_SMALL)
    g.refresh(spark, database="attach_test", names=["bronze_supply_chain", "silver_supply_chain"])
    for name in ("bronze_supply_chain", "silver_supply_chain"):
        spark.sql(f"DROP TABLE attach_test.{name}")
    assert attach_tables(spark, "attach_test", ["bronze_supply_chain", "silver_supply_chain", "never_written"]) == [
        "bronze_supply_chain", "silver_supply_chain"]
    expected = graph(spark, SF_SMALL)["silver_supply_chain"].count()
    assert spark.table("attach_test.silver_supply_chain").count() == expected
    graph(spark, SF_SMALL).refresh(spark, database="attach_test", names=["silver_supply_chain"])
    assert spark.table("attach_test.silver_supply_chain").count() == expected
    spark.sql("DROP DATABASE attach_test CASCADE")
