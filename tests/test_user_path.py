"""The README quick start, end to end, on tables stored the way the library writes them."""

import os

from conftest import SF_SMALL

from svcvitals.operators import events as E, metrics as M, scores as SC, survey as SV
from svcvitals.sources import adapters as A
from svcvitals.sources.survey_sheet import read_survey, write_survey
from svcvitals.sources.tables import read_envelopes, read_raw_metrics
from svcvitals.streaming.ingest import stream_events


def test_quick_start(spark, tmp_dir):
    d = tmp_dir
    A.metric_points(spark, SF_SMALL).write.parquet(os.path.join(d, "points"))
    for name, df in (("builds", A.cloud_builds_raw(spark, SF_SMALL)), ("deploys", A.cloud_deploy_raw(spark, SF_SMALL))):
        df.write.json(os.path.join(d, "landing", name))
        stream_events(spark, os.path.join(d, "landing", name), os.path.join(d, name),
                      os.path.join(d, "ckpt", name)).awaitTermination()
    write_survey(A.survey(spark, SF_SMALL), os.path.join(d, "survey"))

    points = spark.read.parquet(os.path.join(d, "points"))
    for as_of in ("2024-01-11", "2024-01-12", "2024-01-13"):
        M.append_raw_metrics(M.ingest_day(points, None, as_of=as_of), os.path.join(d, "raw_metrics"))
    perf = SC.service_performance_scores(read_raw_metrics(spark, os.path.join(d, "raw_metrics")))
    since = "2001-02-01"
    events = E.deployment_events_raw(read_envelopes(spark, os.path.join(d, "builds"), since),
                                     read_envelopes(spark, os.path.join(d, "deploys"), since))
    pipe = SC.pipeline_robustness_scores(perf, events, as_of="2001-08-01", epoch="2001-03-01")
    obs = SV.observability_scores(read_survey(spark, os.path.join(d, "survey")))
    composite = SC.composite_health_scores(perf, obs, pipe)

    n_perf = perf.count()
    assert n_perf > 0
    assert composite.count() == n_perf  # one archetype per service here: no doubling
    assert composite.filter("composite_service_health_score IS NULL").count() == 0
    assert sorted(r.target_date for r in perf.select("target_date").distinct().collect()) == \
        ["2024-01-10", "2024-01-11", "2024-01-12"]
