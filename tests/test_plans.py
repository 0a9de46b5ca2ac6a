"""Physical-plan shape: what must hold at scale, checked on every registered query."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from wattlake import registry
from wattlake.operators import aggregates as G
from wattlake.sources import adapters as A

from .conftest import SF_SMALL

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_udf_or_cross_join(spark, name, monkeypatch):
    """Neither the query's plan nor that of any table it stages on the way."""
    from wattlake.sinks import writers as W
    staged, stage = [], W.stage
    monkeypatch.setattr(W, "stage", lambda s, df, n: (staged.append(plan_of(df)), stage(s, df, n))[1])
    for plan in [plan_of(E.queries()[name](spark, SF_SMALL)), *staged]:
        assert not [f for f in FORBIDDEN if f in plan], name


def test_power_fact_prunes_event_columns(spark):
    plan = plan_of(E.queries()["power_fact_unstored"](spark, SF_SMALL))
    schemas = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema") and "user_id" in ln]
    assert schemas and all("props" not in ln and "event_id" not in ln for ln in schemas)


def test_keep_first_combines_before_shuffle(spark):
    c = A.consumption(spark, SF_SMALL)
    plan = plan_of(G.keep_first(c, ["date"], ["value_acquired"]))
    # a partial (map-side) aggregate is planned below the exchange on the key
    body = plan.split("\n\n")[0]
    assert "Aggregate" in body and "Exchange" in body
    assert "Partial" in plan or "partial_min" in plan


def test_silver_day_read_prunes_partitions(spark, scratch):
    from pyspark.sql import functions as F
    from wattlake.sinks import writers as W
    from wattlake.sources import silver as SV
    W.replace_days(A.humidity(spark, SF_SMALL), f"{scratch}/humidity")
    plan = plan_of(SV.read_feed(spark, scratch, "humidity", "2024-01-03", "2024-01-03"))
    assert "PartitionFilters: [isnotnull(date" in plan
    assert SV.read_feed(spark, scratch, "humidity", "2024-01-03", "2024-01-03").select(
        F.countDistinct("date")).first()[0] == 1


def test_salted_join_spreads_a_hot_key(spark):
    """A key holding a third of the rows: a plain join hashes it to one task; salted, it is split."""
    from pyspark.sql import functions as F
    from wattlake.operators.joins import salted_join
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("k"),
            F.col("id").alias("v"))
        stats = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        hot = 10000
        assert "hashpartitioning(k#" in plan_of(rows.join(stats, ["k"], "left")).replace(" ", "")
        tagged = salted_join(rows, stats, ["k"], "left", buckets=8).withColumn("p", F.spark_partition_id())
        per_task = [r["count"] for r in tagged.where("k = 'hot'").groupBy("p").count().collect()]
        assert sum(per_task) == hot and len(per_task) >= 4 and max(per_task) < hot / 2
        assert sorted(salted_join(rows, stats, ["k"]).collect()) == sorted(rows.join(stats, ["k"], "left").collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_fk_check_counts_ids_map_side_without_salt(spark):
    """V2: ids are counted before any shuffle, and nothing is replicated per salt."""
    from wattlake.plans import quality
    ids = lambda n: spark.range(100).selectExpr(f"cast(id % 3 as string) as {n}")
    tables = {"Power_FactTable": spark.range(100).selectExpr(*[f"cast(id % 3 as string) as {c}" for c in
                                                              ["TimeID", "ConsumptionID", "InverterKey", "ErrorID"]]),
              "DimTime": ids("TimeID"), "DimConsumption": ids("ConsumptionID"),
              "DimInverter": ids("InverterKey"), "DimErrors": ids("ErrorID")}
    plan = plan_of(quality.fk_orphans(tables))
    assert "partial_count" in plan
    assert "_salt" not in plan and "sequence(" not in plan


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_issue_is_one_aggregate(spark):
    """No join, one shuffle after a map-side aggregate."""
    plan = plan_of(E.queries()["most_recent_forecast"](spark, SF_SMALL))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") <= 2 and "partial_max" in plan


def test_checks_read_stored_tables(spark):
    """V1-V3 read the written feeds column by column: Parquet scans, no checkpointed rows."""
    for name in ("pk_duplicates", "fk_orphans", "not_null_counts"):
        plan = plan_of(E.queries()[name](spark, SF_SMALL))
        assert "Scan parquet" in plan and "ExistingRDD" not in plan, name


def test_power_export_joins_stored_tables(spark):
    """The dimensions are small files, so no fact row is shuffled for them."""
    from wattlake.plans import marts
    from wattlake.sinks import writers as W
    from wattlake.plans import dims, facts
    p, c = A.production(spark, SF_SMALL), A.consumption(spark, SF_SMALL)
    star = [W.stage(spark, t, "test-star") for t in (facts.power_fact(p, c), dims.dim_time(dims.collect_times(production=p)),
                                                      dims.dim_inverter(p), dims.dim_profile(c, "consumption"), dims.dim_errors(p))]
    plan = final_plan(marts.power_export(*star))
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_booking_load_scans_one_export(spark, scratch):
    """Only the latest export is read, under its own header."""
    from wattlake.sources import drops as DR
    from wattlake.sources import raw
    b = A.booking(spark, SF_SMALL)
    for k, header in ((1, list(reversed(DR.BOOKING_HEADER))), (2, DR.BOOKING_HEADER)):
        DR.write_lines(DR.booking_lines(b, order=header), f"{scratch}/export={k}", header, "\t", partition_col=None)
    df = raw.read_booking(spark, scratch, latest="dir")
    assert all("export=2" in f for f in df.inputFiles()) and df.first().room_id.strip('"').startswith("R")


def test_shared_dir_has_no_local_fallback_on_a_cluster():
    """On a non-local master with no spark.checkpoint.dir, a driver-local folder is refused."""
    from wattlake.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

        def set(self, key, value):
            raise AssertionError("must not pick a folder")

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
