import re

from pyspark.sql import functions as F

from meterlake.operators.anomaly import STATISTICS
from meterlake.plans import events
from meterlake.session import Measured
from workload import proxies, queries

HOTSPOT_LIMIT = 8_000


def measured(spark, schema):
    return Measured(spark.createDataFrame([], schema), 1)


def test_steps_of_events_are_compiled(spark, tmp_path, plan):
    """No generated method is so large that HotSpot would interpret it, and rows and columns stay as derived."""
    raw = spark.range(300).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("view", "click", "purchase"))), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        (F.col("id") / 3).alias("value"),
        F.format_string('{"k": %d}', "id").alias("props"),
    )
    raw.write.parquet(str(tmp_path / "events.parquet"))
    bronze = proxies.bronze_events(spark, str(tmp_path))
    orgs = "org_id string, org_name string, org_industry string, org_plan_tier string, org_hq_region string, org_is_enterprise boolean, org_user_count long, org_active_user_count long"
    known = events.Dimensions(
        measured(spark, orgs), measured(spark, "resource_id string, resource_service string, resource_region string")
    )
    kept = measured(spark, "event_id string, _keep_row_file long, _keep_row_number long")
    statistics = ", ".join(f"{c} double" for c in STATISTICS)
    profile = measured(spark, f"org_id string, service string, {statistics}")
    stocked = events.with_resource(bronze, known)
    marked = events.with_surplus(stocked, kept, ["event_id"])
    rows = events.classify(events.with_org(events.with_flags(marked, profile), known))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (stocked, rows):
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan(df, "codegen"))]
            assert sizes and max(sizes) < HOTSPOT_LIMIT
        narrow = plan(bronze.select("org_id", "cost_usd_increment"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert "props" not in re.search(r"ReadSchema: .*", narrow).group()
    assert bronze.count() == 300 and rows.count() == 300


TABLES = {
    "region": (5, "int(id) r_regionkey, concat('REGION ', id) r_name"),
    "nation": (25, "int(id) n_nationkey, concat('NATION ', id) n_name, int(id % 5) n_regionkey"),
    "customer": (30, "id c_custkey, concat('Customer', id) c_name, int(id % 25) c_nationkey, 'AUTO' c_mktsegment"),
    "part": (40, "id p_partkey, 'STEEL' p_type, 'Brand' p_brand, int(id % 50) p_size"),
    "orders": (
        200,
        "id o_orderkey, id % 30 o_custkey, 'F' o_orderstatus, '2-HIGH' o_orderpriority, "
        "cast(date_add(date'2024-01-01', int(id % 90)) as timestamp_ntz) o_orderdate",
    ),
    "lineitem": (
        800,
        "id % 200 l_orderkey, int(id % 7) l_linenumber, id % 40 l_partkey, id % 10 l_suppkey, "
        "double(id) l_extendedprice, 0.05D l_discount, 0.01D l_tax",
    ),
    "events": (
        600,
        "id event_id, cast(timestamp_seconds(1704067200 + id * 60) as timestamp_ntz) ts, id % 30 user_id, "
        "element_at(array('view', 'click', 'purchase'), int(id % 3 + 1)) event_type, double(id % 50) value, "
        "format_string('{\"k\": %d}', id % 90) props",
    ),
}


def test_customers_are_derived_once_for_all_marts(spark, tmp_path, monkeypatch):
    for name, (n, columns) in TABLES.items():
        spark.sql(f"SELECT {columns} FROM range({n})").write.parquet(str(tmp_path / f"{name}.parquet"))
    derived = []
    real = proxies.landed
    monkeypatch.setattr(proxies, "landed", lambda s, sf, name: derived.append(name) or real(s, sf, name))
    checks = queries.reconcile_measures(spark, str(tmp_path)).collect()
    assert len(checks) == 7 and all(c["ok"] for c in checks) and any(c["expected"] for c in checks)
    assert derived.count("customers_orgs") == 1
