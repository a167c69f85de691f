"""Registered queries: each runs on whole tables and, where SQL can say it, has an equivalent SQL text."""

from gable.plans.registry import QUERIES, SQL, Query  # noqa: F401
from gable.plans import (  # noqa: F401  (importing registers the queries)
    features_q,
    metrics_q,
    models_q,
    relational_q,
    splits_q,
    streaming_q,
    valuation_q,
)
