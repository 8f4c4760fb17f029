"""Entry C of the reference as one call: fairness, drift, monitoring, governance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from riskframe.operators import drift, fairness, reports
from riskframe.operators.features import demographic_proxies
from riskframe.operators.metrics import apply_threshold, quick_evaluation
from riskframe.schema import GROUPINGS


def audit(scored: DataFrame, reference: DataFrame, current: DataFrame, features: Sequence[str],
          model_name: str, model_version: str, label: str = "label", score: str = "score",
          threshold: float = 0.5) -> dict[str, DataFrame]:
    """``scored`` carries raw (un-encoded) columns plus label and score;
    ``reference``/``current`` are the two populations compared for drift."""
    prox = apply_threshold(demographic_proxies(scored), score, threshold)
    gm = fairness.group_metrics(prox, GROUPINGS, label, score, threshold=threshold)
    gaps = fairness.parity_gaps(gm)
    summary = fairness.fairness_summary(gaps)
    psi = drift.drift_metrics(reference, current, features)
    ref_metrics = quick_evaluation(reference, label, score).select("roc_auc", "pr_auc")
    monitor = drift.performance_monitor(current, ref_metrics, label, score)
    present = [g for g in GROUPINGS if g in prox.columns]
    return {"group_metrics": gm, "parity_gaps": gaps, "fairness_summary": summary,
            "threshold_sweep": fairness.threshold_sweep(prox, present, label, score),
            "drift": psi, "monitor": monitor,
            "governance": reports.governance_report(psi, summary, monitor, model_name, model_version,
                                                    len(present))}
