"""All registered queries in one place."""
from __future__ import annotations

from tideline.plans.registry import Registry


def everything() -> Registry:
    from tideline.plans.climate_queries import climate
    from tideline.plans.core_queries import core
    from tideline.plans.report_queries import report
    from tideline.plans.metric_queries import metric
    from tideline.plans.stat_queries import stat
    from tideline.plans.learning_queries import learn
    from tideline.plans.geo_queries import geo
    from tideline.plans.lake_queries import stored
    from tideline.plans.stream_queries import stream
    return Registry().merge(core, climate, report, metric, stat, learn, stream, geo, stored)
