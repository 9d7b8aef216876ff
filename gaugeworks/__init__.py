"""Ingest, enrich, audit and repair sensor and event data with Spark."""

import sys

from pyspark import cloudpickle

from gaugeworks.operators.constraints import require_rows, summarise, validate
from gaugeworks.operators.dedupe import first_per_key
from gaugeworks.operators.lookup import lookup_join
from gaugeworks.operators.merge import absent_rows, insert_if_absent, to_target, upsert
from gaugeworks.operators.nearest import nearest_site
from gaugeworks.operators.quality import audit, repair, repair_actions
from gaugeworks.operators.reports import event_rate, latest, profile_columns, stage_counts
from gaugeworks.plans.flows import clean_events, load_inventory, loadable_events, quality_run

# Functions of this package travel to the workers whole, so workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "absent_rows",
    "audit",
    "clean_events",
    "event_rate",
    "first_per_key",
    "insert_if_absent",
    "latest",
    "load_inventory",
    "loadable_events",
    "lookup_join",
    "nearest_site",
    "profile_columns",
    "quality_run",
    "repair",
    "repair_actions",
    "require_rows",
    "stage_counts",
    "summarise",
    "to_target",
    "upsert",
    "validate",
]
