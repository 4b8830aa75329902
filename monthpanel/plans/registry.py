"""All registered queries: name -> (query, SQL or None)."""

from __future__ import annotations

from monthpanel.operators.baselines import baseline_forecasts, score_forecasts
from monthpanel.operators.features import add_lags, add_rolling
from monthpanel.operators.panel import month_spine
from monthpanel.plans import (
    queries_choice, queries_clean, queries_features, queries_forecast, queries_learn, queries_long, queries_panel, queries_quality,
    queries_reshape, queries_store,
)
from monthpanel.plans.views import nation_month

ALL = {
    **queries_panel.QUERIES, **queries_clean.QUERIES, **queries_features.QUERIES, **queries_forecast.QUERIES,
    **queries_reshape.QUERIES, **queries_quality.QUERIES, **queries_learn.QUERIES,
    **queries_choice.QUERIES, **queries_long.QUERIES, **queries_store.QUERIES,
}


def flagship(spark, sf_dir):
    """One row per nation: six-month-average forecast errors on a complete, featured panel."""
    months = nation_month(spark, sf_dir).select("nation", "date", "revenue")
    spine = month_spine(months, keys=["nation"])
    featured = add_rolling(add_lags(spine, ["revenue"], [1, 12], ["nation"]), ["revenue"], [3], ["nation"])
    forecasts = baseline_forecasts(featured, "revenue", 12, ["nation"], {"moving_average_6": 6})
    return score_forecasts(forecasts, ["nation"])
