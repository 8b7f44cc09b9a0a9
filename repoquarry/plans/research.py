"""Issue-resolution-time classifier."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from ..functions.timing import RESOLUTION_LABELS
from ..operators.features import ISSUE_FEATURES, closed_issues, issue_features, life_span_report
from ..operators.joins import sampled_issues
from ..session import materialize
from ..sources.tables import read_sample
from .evaluate import Evaluation, fit_and_evaluate

KEY = ["provider", "repo", "issue_number"]


def predict_resolution_times(
    issues: DataFrame,
    commits: DataFrame,
    sample_csv: str | None = None,
    issue_limit: int | None = None,
    model_type: str = "decision_tree",
    max_depth: int | None = None,
) -> Evaluation | None:
    """Train on closed issues, those of a sample file only when there is one.

    ``skipped`` of the result counts the closed issues without a usable life span, which are not learned.
    """
    sample = read_sample(issues.sparkSession, sample_csv)
    chosen = closed_issues(sampled_issues(issues, sample), KEY, issue_limit)
    rows = materialize(issue_features(chosen, commits, KEY))
    result = fit_and_evaluate(rows, KEY, ISSUE_FEATURES, RESOLUTION_LABELS, "RQ MODEL REPORT", model_type, max_depth)
    return result and replace(result, skipped=life_span_report(chosen))
