"""The full health stack composed from input tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from svcvitals import config as C
from svcvitals.operators import events as E, scores as SC, survey as SV
from svcvitals.sources.tables import materialize  # noqa: F401  (re-exported)


@dataclass
class HealthStack:
    """The view stack over four inputs. ``as_of``/``epoch`` fix "today" and the
    cadence epoch; ``fanout`` keeps the as-written per-row multiplication of counts."""

    raw_metrics: DataFrame
    builds_raw: DataFrame
    deploys_raw: DataFrame
    survey: DataFrame | None = None
    as_of: object = None
    epoch: object = C.DEFAULT_EPOCH
    fanout: bool = True

    def deployment_events(self) -> DataFrame:
        return E.deployment_events_raw(self.builds_raw, self.deploys_raw)

    def performance(self) -> DataFrame:
        return SC.service_performance_scores(self.raw_metrics)

    def observability(self) -> DataFrame | None:
        return None if self.survey is None else SV.observability_scores(self.survey)

    def pipeline(self) -> DataFrame:
        return SC.pipeline_robustness_scores(self.performance(), self.deployment_events(),
                                             self.as_of, self.epoch, self.fanout)

    def composite(self) -> DataFrame:
        return SC.composite_health_scores(self.performance(), self.observability(), self.pipeline())
