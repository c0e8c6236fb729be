"""Logical views of a catalog database: fresh for every session, equal to the stack, pruned."""

import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from svcvitals.plans import catalog as CAT, queries as Q
from svcvitals.session import shared_dir
from svcvitals.sources import adapters as A

DB = "vitals_views"


@pytest.fixture(scope="module")
def database(spark):
    Q.fill_catalog(spark, SF_SMALL, DB)
    CAT.create_views(spark, DB, A.AS_OF, A.EPOCH)
    yield DB
    spark.sql(f"DROP DATABASE {DB} CASCADE")


def rows(df):
    """Rows by column name; doubles to 12 digits (sums may be associated differently)."""
    cell = lambda v: float(f"{v:.12g}") if isinstance(v, float) else v
    return sorted((tuple(cell(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)


def test_views_are_the_stack(spark, database):
    stack = Q._stack(spark, SF_SMALL)
    want = {"deployment_events_raw": stack.deployment_events(), "service_performance_scores": stack.performance(), "observability_scores": stack.observability(),
            "pipeline_robustness_scores": stack.pipeline(), "composite_health_scores": stack.composite()}
    for name, df in want.items():
        view = spark.table(f"{database}.{name}")
        assert set(view.dtypes) == set(df.dtypes), name
        assert rows(view) == rows(df), name


def test_a_second_session_sees_new_input_without_a_run(spark, database):
    other = spark.newSession()
    view = lambda s: s.table(f"{database}.composite_health_scores").filter("service_name = 'cloudrun--new-prod'")
    assert view(other).count() == 0
    row = {"timestamp": dt.datetime(2024, 2, 1), "target_date": "2024-01-31", "project_id": "p", "service_name": "cloudrun--new-prod", "archetype": "sync",
           "availability_ratio": None, "total_requests": 100, "error_5xx_requests": 0, "error_4xx_requests": 0, "total_errors": 0, "latency_p50_ms": 1.0, "latency_p95_ms": 2.0}
    schema, _ = CAT.TABLES["raw_metrics"]
    CAT.append_rows(spark.createDataFrame([tuple(row[f.name] for f in schema)], schema), database, "raw_metrics")
    deployed = spark.createDataFrame([("s", "m1", dt.datetime(2001, 7, 20), '{"status":"SUCCESS","tags":["cloudrun::new-prod"],"buildTriggerId":"t"}', "{}")],
                                     CAT.TABLES["cloud_builds_raw"][0])
    CAT.append_rows(deployed, database, "cloud_builds_raw")
    for session in (spark.newSession(), spark):
        got = view(session).collect()
        assert [(r.environment, round(r.cat1_performance_score, 9), r.total_deployments_in_window, r.days_since_last_deploy) for r in got] == [("Prod", 100.0, 1, 12)]
    other.sql(f"REFRESH TABLE {database}.raw_metrics")  # a session that has read the files before lists them anew
    other.sql(f"REFRESH TABLE {database}.cloud_builds_raw")
    assert view(other).count() == 1


def test_days_are_pruned_through_the_view(spark, database):
    plan = spark.table(f"{database}.service_performance_scores").filter("target_date = '2024-01-05'").select("performance_score")
    text = plan._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "target_date" in scan.split("PartitionFilters")[1].split("]")[0] and "project_id" not in scan.split("ReadSchema")[1]
    assert {r.target_date for r in spark.table(f"{database}.service_performance_scores").filter("target_date = '2024-01-05'").select("target_date").collect()} == {"2024-01-05"}


def test_payloads_as_the_columns_read_them(spark):
    """Nested values are no scalars, strings that look nested are; NULL and broken payloads."""
    db = "vitals_odd"
    CAT.create_tables(spark, db, shared_dir(spark, db))
    CAT.create_views(spark, db)
    t = dt.datetime(2026, 1, 1)
    builds = ['{"status":"SUCCESS","tags":["{x}"]}', '{"status":"SUCCESS","tags":[{"a":1}]}', '{"status":"TIMEOUT","tags":["a::b"],"buildTriggerId":7}', "{broken", None,
              '{"status":"FAILURE","tags":[]}', '{"status":"FAILURE"}', '{"status":"SUCCESS","tags":["cloud-deploy-x"]}', '{"status":"SUCCESS","tags":["z"],"buildTriggerId":"cloud-deploy-project-1"}']
    deploys = ['{"Action":"Succeed","ResourceType":"Rollout","TargetId":"mixer-prod"}', '{"Action":"FAILED","ResourceType":"Rollout"}', None,
               '{"Action":"succeed","ResourceType":"Rollout","TargetId":"t","RollbackOfRollout":{"a":1}}', '{"Action":"Succeed","ResourceType":"Rollout","TargetId":"[t]","RollbackOfRollout":"r"}']
    schema = CAT.TABLES["cloud_builds_raw"][0]
    b = spark.createDataFrame([("s", str(k), t, x, None) for k, x in enumerate(builds)], schema)
    d = spark.createDataFrame([("s", str(k), t, None, x) for k, x in enumerate(deploys)], schema)
    CAT.append_rows(b, db, "cloud_builds_raw")
    CAT.append_rows(d, db, "cloud_deploy_raw")
    from svcvitals.operators import events as E
    assert rows(spark.table(f"{db}.deployment_events_raw")) == rows(E.deployment_events_raw(b, d))
    for empty in ("composite_health_scores", "final_service_health_scores"):
        assert spark.table(f"{db}.{empty}").count() == 0
    with pytest.raises(ValueError):
        CAT.append_rows(b.withColumn("more", F.lit(1)), db, "cloud_builds_raw")
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_documents_are_not_parsed_a_second_time_for_every_row(spark):
    """No parse is among what the fields of a row have in common, which Spark computes always."""
    from svcvitals.operators import events as E
    db = "vitals_once"
    CAT.create_tables(spark, db, shared_dir(spark, db))
    CAT.create_views(spark, db)
    b, d = spark.table(f"{db}.cloud_builds_raw"), spark.table(f"{db}.cloud_deploy_raw")
    jvm = spark._jvm.org.apache.spark.sql.catalyst

    def common(plan) -> str:
        found = ""
        if plan.getClass().getSimpleName() == "Project":
            seen = jvm.expressions.EquivalentExpressions(False)
            for k in range(plan.projectList().size()):
                seen.addExprTree(plan.projectList().apply(k), getattr(seen, "addExprTree$default$2")())
            found = seen.getCommonSubexpressions().toString()
        return found + "".join(common(plan.children().apply(k)) for k in range(plan.children().size()))

    for df in (spark.table(f"{db}.deployment_events_raw"), E.build_events(b), E.deploy_events(d)):
        plan = df._jdf.queryExecution().optimizedPlan()
        assert "parseJson" in plan.toString() and "parseJson" not in common(plan)
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_checksum_codes_each_label_once(spark):
    import hashlib
    code = lambda x: 0 if x is None else int(hashlib.md5(x.encode()).hexdigest()[:7], 16)
    data = [(s, v, m, t) for s in ("OK", "FAILED", None) for v in ("a", "b", None) for m in ("m1", None) for t in (1.5, None)] * 2
    schema = "status string, service_name string, message string, x double"
    df = spark.createDataFrame(data, schema)
    want = sum(code(m) + 2 * code(v) + 3 * code(s) + 4 * (0 if t is None else 1500) for s, v, m, t in data)
    assert [tuple(r) for r in Q.view_checksum(df).collect()] == [(len(data), want)]
    assert [tuple(r) for r in Q.view_checksum(df.limit(0)).collect()] == [(0, 0)]
    assert [tuple(r) for r in Q.view_checksum(df.select("message")).collect()] == [(len(data), sum(code(r[2]) for r in data))]
    assert [tuple(r) for r in Q.view_checksum(df.select("message").limit(0)).collect()] == [(0, 0)]
    over_rows = Q.view_checksum(spark.createDataFrame(data, schema))._jdf.queryExecution().optimizedPlan().children().apply(0).toString()
    assert "md5(cast(message" in over_rows and "md5(cast(status" not in over_rows
