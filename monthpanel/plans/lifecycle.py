"""The three end-to-end plans: build a dataset, build a strict panel, run the forecast contest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from monthpanel.fixed import PROXY_TARGET
from monthpanel.operators.baselines import baseline_forecasts, baseline_predictions, compare_models
from monthpanel.operators.blocks import activity_series
from monthpanel.operators.clean import keep_rows_with_target, trade_by_product
from monthpanel.operators.diagnose import improvements, lag_correlations
from monthpanel.operators.features import composite_target, supervised_strict
from monthpanel.operators.fit_keys import keyed_contest
from monthpanel.operators.learn import lagged_contest
from monthpanel.operators.panel import merge_monthly, strict_panel
from monthpanel.operators.reshape import construction_records, material_index, two_row_header, year_matrix_cells
from monthpanel.operators.targets import default_target, validate_target
from monthpanel.sources.cells import sheet_cells, table_from_cells

ACTIVITY_SERIES = [
    f"imae_{part}_{suffix}"
    for part in ("construction", "general") for suffix in ("index", "yoy", "trend_index", "trend_yoy")
]


def _activity(cells: DataFrame, sheet: str | None, header_row: int | None, on_collision: str = "suffix") -> DataFrame:
    """All sheets take part; ``sheet`` is the name preferred for the older layout."""
    given = {k: v for k, v in (("preferred", sheet), ("header_row", header_row)) if v is not None}
    long = activity_series(cells, on_collision=on_collision, **given)
    # The names are fixed, with a suffix for each of the sheets that may share one.
    found = {r["series"] for r in long.select("series").distinct().collect()}
    names = [s + tail for s in ACTIVITY_SERIES for tail in ("", "_x", "_y") if s + tail in found]
    return long.groupBy("path", "date").pivot("series", names or ACTIVITY_SERIES).max("value")


def _remittances(cells: DataFrame, sheet: str | None, header_row: int | None) -> DataFrame:
    rows = 9 if header_row is None else header_row
    return year_matrix_cells(sheet_cells(cells, sheet), "remittances_usd_millions", rows)


def _trade(cells: DataFrame, sheet: str | None, header_row: int | None) -> DataFrame:
    table = table_from_cells(cells, 7 if header_row is None else header_row, sheet)
    return trade_by_product(table.drop("sheet", "row"), keys=["path"])


def _construction(cells: DataFrame, sheet: str | None, header_row: int | None) -> DataFrame:
    table = table_from_cells(cells, header_row or 0, sheet)
    return construction_records(table.drop("sheet", "row"), keys=["path"])


def _materials(cells: DataFrame, sheet: str | None, header_row: int | None) -> DataFrame:
    return material_index(two_row_header(sheet_cells(cells, sheet), header_row or 0))


# Source kinds and their readers: cells of workbooks in, ``path, date`` and value columns out.
PARSERS: dict[str, Callable[[DataFrame, str | None, int | None], DataFrame]] = {
    "activity_index": _activity,
    "remittances": _remittances,
    "trade_by_product": _trade,
    "construction": _construction,
    "material_index": _materials,
}


# Kinds that must give an observation; tables of the others may be empty and are then left out.
REQUIRED = ("activity_index", "remittances", "material_index")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame, or an error if it has no row (one small job)."""
    if df.isEmpty():
        raise ValueError(f"{what} gave no monthly observation; check sheet, header row and layout")
    return df


def build_dataset(sources: list[tuple], keys: list[str] = (), target: str | None = PROXY_TARGET,
                  min_observed: int = 1, interpolate: bool = False, drop_missing_target: bool = False,
                  parsers: dict[str, Callable] = PARSERS, on_collision: str = "suffix") -> DataFrame:
    """Parse every source, merge by month, add the composite target.

    A source is ``(kind, cells[, sheet[, header_row]])``. With ``keys=["path"]``
    workbooks of one path are merged and each path is a series of its own; with
    ``keys=[]`` each source is one workbook. ``target=None`` skips the composite.
    ``on_collision`` says what happens to a series that several sheets or sources
    give. A source of a ``REQUIRED`` kind without observations is an error, other
    empty sources are left out, and so is having none left.
    """
    if not sources:
        raise ValueError("No sources provided")
    if target is None and drop_missing_target:
        raise ValueError("drop_missing_target requires the composite target")
    frames = []
    for kind, cells, *options in sources:
        if kind not in parsers:
            raise ValueError(f"Unknown parser {kind!r}. Valid parsers: {', '.join(sorted(parsers))}")
        sheet, header_row = (*options, None, None)[:2]
        rule = {"on_collision": on_collision} if parsers[kind] is _activity else {}
        frame = parsers[kind](cells, sheet, header_row, **rule)
        if kind in REQUIRED:
            require_rows(frame, f"Source {kind!r}")
        frames.append(frame if "path" in keys else frame.drop("path"))
    merged = merge_monthly(frames, keys, skip_empty=True, on_collision=on_collision)
    if target is None:
        return merged
    modeled = composite_target(merged, target=target, min_observed=min_observed, interpolate=interpolate, keys=keys)
    return keep_rows_with_target(modeled, target) if drop_missing_target else modeled


def build_panel(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Strict panel and its report."""
    return strict_panel(df, **options)


def forecast_contest(panel: DataFrame, target: str | None = None, test_size: int = 12, keys: list[str] = (),
                     exogenous: list[str] | None = None, models: list[str] | None = None,
                     folder: str | None = None, per_key: bool = False, features: list[str] | None = None,
                     options: dict[str, dict] | None = None) -> dict[str, DataFrame]:
    """Baselines and lagged regressions on one target, their comparison and lag correlations.

    With ``per_key`` every key has models of its own (:func:`keyed_contest`, whose ``options`` these are), else one model serves all keys. ``features``
    chooses some of the supervised frame. With a ``folder`` the supervised frame is stored there for the fits.
    """
    target = target or default_target(panel, keys)
    validate_target(panel, target, keys=keys)
    forecasts = baseline_forecasts(panel, target, test_size, keys)
    baselines = compare_models(forecasts, keys)
    frame = supervised_strict(panel, target, exogenous=exogenous, keys=keys)
    features = features or [c for c in frame.columns if c not in ("date", "__target__", *keys)]
    if per_key:
        chosen = models or ["ridge_lagged", "elasticnet_lagged", "random_forest", "gradient_boosting"]
        comparison, predictions = keyed_contest(frame, target, features, test_size, keys, chosen, panel=panel, options=options, folder=folder)
    else:
        comparison, predictions = lagged_contest(frame, target, features, test_size, keys, models, folder=folder)
    return {
        "baselines": baselines,
        "comparison": comparison,
        "predictions": baseline_predictions(forecasts).unionByName(predictions),
        "improvement": improvements(comparison, baselines, keys),
        "lag_correlations": lag_correlations(panel, target, keys=keys),
    }
