"""Named queries over the driver tables. Importing this package registers all of them."""

from churnwatch.plans import (  # noqa: F401
    clean_plans,
    contract_plans,
    drift_plans,
    eval_plans,
    feature_plans,
    jobs,
    ml_plans,
    monitor_plans,
    profile_plans,
    quality_plans,
    series_plans,
    stream_plans,
)
from churnwatch.plans.registry import ORACLE, QUERIES  # noqa: F401
