"""Scoring pipelines: fixed weights (H9) and searched weights (H10), with
step counters (H11).

load -> select present columns (B1) -> defaults for absent ones (B2) ->
complete rows (B3) -> min-max scale (H1) -> components (H3) -> [search by
moments (H6/H7)] -> weighted score (H4) -> best row (F1), top-k (F2),
preview (A5). Fitted statistics (scaler min/max, the 15 moments, the chosen
four weights) are single rows; everything per row stays distributed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions._util import literal_rows
from cellscope.operators.clean import complete_cases, default_missing, select_present
from cellscope.operators.rank import best_row, preview, top_k
from cellscope.operators.scale import component_scores, min_max_scale, weighted_score
from cellscope.operators.search import (best_candidate, evaluate_candidates, fit_inputs, grid_candidates, random_candidates,
                                        search_history)

SEARCH_METHODS = ("grid_search", "random_search")


def observe_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A row counter filled in by whatever job runs the plan (no extra scan)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def prepare_features(df: DataFrame, on_missing: str = "default",
                     count_steps: bool = False, with_moments: bool = False):
    """Steps B1-B3, H1, H3: ``(featured, counters)``; with ``count_steps`` the
    two counters (rows loaded, rows valid), with ``with_moments`` a third
    result: the score moments, fitted together with the ranges in one pass.

    Counters are off by default: one over the scan keeps filters from it.

    ``on_missing='default'`` adds absent inputs as 0.0 (target 1);
    ``'raise'`` fails with a clear message instead.
    """
    missing = [c for c in K.SCORE_REQUIRED_COLUMNS if c not in df.columns]
    if missing and on_missing == "raise":
        raise ValueError(f"missing required columns: {missing}")
    counters = {}
    if count_steps:
        df, counters["rows_loaded"] = observe_count(df, "rows_loaded")
    present = select_present(df, K.SCORE_REQUIRED_COLUMNS)
    valid = complete_cases(default_missing(present, [c for c in K.SCORE_REQUIRED_COLUMNS if c != "id"]))
    ranges, moments = fit_inputs(valid) if with_moments else (None, None)
    scaled = min_max_scale(valid, K.SCORE_INPUT_COLUMNS, ranges=ranges)
    if count_steps:
        scaled, counters["rows_valid"] = observe_count(scaled, "rows_valid")
    featured = component_scores(scaled)
    return (featured, counters, moments) if with_moments else (featured, counters)


@dataclass
class RoutingResult:
    scored: DataFrame
    best: DataFrame
    top: DataFrame
    shown: DataFrame
    preview_rows: int
    weights: DataFrame
    history: DataFrame | None
    counters: dict[str, Observation]

    @property
    def preview(self) -> DataFrame:
        """A5: fitted when it is asked for."""
        return preview(self.shown, self.preview_rows)

    def weights_dict(self) -> dict[str, float]:
        """The chosen weights (one row) as a mapping."""
        row = self.weights.first()
        return {c: float(row[c]) for c in K.WEIGHT_NAMES}


DISPLAY_COLUMNS = ["id", *K.COMPONENT_COLUMNS, K.SCORE_COLUMN]


def score_fixed(df: DataFrame, weights: Mapping[str, float] | None = None, top: int = K.TOP_K,
                preview_rows: int = K.PREVIEW_ROWS, on_missing: str = "default", normalise: bool = False,
                count_steps: bool = False) -> RoutingResult:
    """H9: score with given weights (default 0.4/0.2/0.1/0.3), divided by a positive sum with ``normalise``."""
    w = dict(weights or K.DEFAULT_WEIGHTS)
    total = sum(w.values())
    if normalise and total > 0:
        w = {k: v / total for k, v in w.items()}
    featured, counters = prepare_features(df, on_missing, count_steps)
    scored = weighted_score(featured, w)
    shown = scored.select(*[c for c in DISPLAY_COLUMNS if c in scored.columns])
    wdf = literal_rows(df.sparkSession, [[float(w[c]) for c in K.WEIGHT_NAMES]], ", ".join(f"{c} double" for c in K.WEIGHT_NAMES))
    return RoutingResult(scored, best_row(scored), top_k(shown, top), shown, preview_rows, wdf, None,
                         counters)


def score_searched(df: DataFrame, method: str = "grid_search", n_points: int = K.GRID_POINTS_DEFAULT,
                   n_iterations: int = K.RANDOM_ITER_DEFAULT, seed: int = K.SAMPLE_SEED, top: int = K.TOP_K,
                   preview_rows: int = K.PREVIEW_ROWS, on_missing: str = "default", count_steps: bool = False) -> RoutingResult:
    """Search the weights that best correlate the score with the target,
    then score with them. ``method`` is ``grid_search`` or ``random_search``."""
    if method not in SEARCH_METHODS:
        raise ValueError(f"method must be one of {SEARCH_METHODS}, not {method!r}")
    featured, counters, moments = prepare_features(df, on_missing, count_steps, with_moments=True)
    spark = df.sparkSession
    cands = (grid_candidates(spark, n_points) if method == "grid_search"
             else random_candidates(spark, n_iterations, seed))
    evaluated = evaluate_candidates(cands, moments)
    history = search_history(evaluated)
    best_row_ = best_candidate(evaluated).select("candidate_id", *K.WEIGHT_NAMES, "correlation").first()
    best = literal_rows(spark, [best_row_], "candidate_id bigint, w_signal double, w_mobility double, "
                                            "w_env double, w_congestion double, correlation double")
    scored = weighted_score(featured, {c: float(best_row_[c]) for c in K.WEIGHT_NAMES})
    shown = scored.select(*[c for c in DISPLAY_COLUMNS if c in scored.columns])
    return RoutingResult(scored, best_row(scored), top_k(shown, top), shown, preview_rows, best, history,
                         counters)
