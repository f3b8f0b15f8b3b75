"""Table contract and catalog: 100 declared tables build, views register."""
from pyspark.sql import functions as F

from switchboard.operators.tables import scratch_path
from switchboard.plans.catalog import MATERIALIZED, VIEW_NAMES, register_views
from switchboard.sources import schemas
from switchboard.sources.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def test_hundred_tables_with_declared_layout(spark):
    assert len(schemas.COLUMNS) == 100 and set(schemas.COLUMNS) == set(schemas.LAYOUT)
    layers = [schemas.layer_of(t) for t in schemas.COLUMNS]
    assert (layers.count("staging"), layers.count("ods"), layers.count("dm")) == (45, 30, 25)
    for t in schemas.COLUMNS:
        sch = schemas.schema(t)
        part = schemas.LAYOUT[t][0]
        if part is not None:
            assert part[0] in sch.fieldNames(), t
        for c in schemas.LAYOUT[t][1]:
            assert c in sch.fieldNames(), (t, c)


def test_tables_create_and_read_back_with_declared_schema(spark):
    """All 100 tables: created empty in their layout, then a schema-only
    (LIMIT 0) scan of each returns the declared columns in order."""
    root = scratch_path(spark, "ddl")
    every = list(schemas.COLUMNS)
    schemas.create_tables(spark, root, every)
    wh = Warehouse.from_root(spark, root)
    for t in every:
        df = wh[t]
        assert df.limit(0).count() == 0
        assert df.schema.fieldNames()[:len(schemas.schema(t))] == schemas.schema(t).fieldNames()


def test_views_register_and_answer_sql(spark):
    wh = Warehouse.fixtures(spark, SF)
    names = register_views(spark, wh)
    assert len(names) == 16 and len(MATERIALIZED) == 3
    for n in VIEW_NAMES:
        assert spark.sql(f"SELECT * FROM {n} LIMIT 0").count() == 0
    assert spark.sql("SELECT COUNT(*) AS n FROM vw_repeat_contact_window").first()["n"] > 0


def test_databases_created(spark):
    names = schemas.create_databases(spark, prefix="sbtest_")
    have = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    assert set(names) <= have


def test_column_descriptions_are_kept_by_the_tables(spark, tmp_path):
    from collections import Counter
    told = Counter(f.metadata["comment"] for t in schemas.COLUMNS for f in schemas.schema(t) if "comment" in f.metadata)
    assert told == {schemas.SECONDS: 34, schemas.MILLIS: 28, schemas.NOT_SECONDS: 2, schemas.ORACLE_TEXT: 4}
    def written(table):
        one = spark.createDataFrame([tuple([None] * len(schemas.schema(table)))], schemas.schema(table))
        one.write.parquet(f"{tmp_path}/{table}")
        return spark.read.parquet(f"{tmp_path}/{table}")
    back = written("stg_fin_invoice")
    assert back.schema["issued_ts_sec"].metadata["comment"] == schemas.NOT_SECONDS and "comment" not in back.schema["invoice_id"].metadata
    assert written("stg_crm_contract").schema["start_dt"].metadata["comment"] == schemas.ORACLE_TEXT
    assert not any(f.metadata for f in written("dim_agent").schema)
    back.createOrReplaceTempView("described")
    shown = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE described").collect()}
    assert shown["due_ts_sec"] == schemas.NOT_SECONDS


def test_views_run_nothing_until_they_are_read(spark):
    import inspect
    wh = Warehouse.fixtures(spark, SF)
    for view in VIEW_NAMES.values():
        for p in inspect.signature(view).parameters.values():
            if p.default is inspect.Parameter.empty:
                wh[p.name]  # reading the files' schemas is the warehouse's, not the views'
    spark.sparkContext.setJobGroup("register", "views")
    register_views(spark, wh)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("register")
    spark.sparkContext.setJobGroup("", "")
