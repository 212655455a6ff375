"""The training job: check the panel, search, judge on unseen weeks, and release.

Everything up to the gate only reads; the run log gets its rows in one write at
the end, and the released model, its version, snapshot and reports are written
only when the gate passes.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.operators import runlog as RL
from tillpanel.operators import segments as G
from tillpanel.operators.evaluate import evaluate_all, naive_baseline
from tillpanel.operators.features import with_inputs
from tillpanel.operators.snapshot import latest_per_store, write_snapshot
from tillpanel.operators.split import holdout_split, rolling_origin_folds
from tillpanel.operators.validate import raise_if_failed, validate_panel
from tillpanel.plans import attribution as A
from tillpanel.plans.model import ForecastModel, best_of, candidates, cv_score, gain_importance, score_in_sales_space
from tillpanel.plans.physical import cut_lineage
from tillpanel.plans.reports import segment_summary_json, write_report_tables

METRICS = ("rmsle", "mae", "rmse")
# Prefixes of the run log's metric names.
HOLDOUT, ALL_WEEKS = "test_", "holdout_"


@dataclass
class Runs:
    """Rows of the run log that one job collects."""

    model_name: str
    tags: dict
    rows: list[dict] = field(default_factory=list)

    def add(self, run_name: str, model_type: str, params: dict, metrics: dict, **tags: str) -> str:
        run_id = uuid.uuid4().hex
        self.rows.append({
            "run_id": run_id, "run_name": run_name, "model_name": self.model_name, "model_type": model_type,
            "params": {k: str(v) for k, v in params.items()},
            "metrics": {k: float(v) for k, v in metrics.items() if v is not None},
            "tags": {k: str(v) for k, v in (self.tags | tags).items()},
            "started_at": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)})
        return run_id


@dataclass
class Result:
    """What a training job found and where it wrote it."""

    points: list[dict]
    scores: DataFrame
    best: dict
    cv_rmsle: float
    holdout: dict
    baseline: dict
    incumbent: float | None
    promoted: bool
    evaluated: DataFrame
    pool: DataFrame
    features: DataFrame
    judged: object
    released: object | None = None
    run_id: str | None = None
    reports: dict[str, str] = field(default_factory=dict)


def _named(row_frame: DataFrame, prefix: str) -> dict:
    row = row_frame.first()
    return {prefix + m: row[m] for m in METRICS}


def incumbent_score(spark: SparkSession, out: str, model_name: str) -> float | None:
    """Holdout score of the version now in production; None where there is none yet."""
    try:
        versions, runs = RL.read_versions(spark, f"{out}/versions"), RL.read_runs(spark, f"{out}/runs")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    row = RL.incumbent_of(versions, runs).filter(F.col("model_name") == model_name).first()
    return None if row is None else row["incumbent_test_rmsle"]


def passes(score: float | None, incumbent: float | None) -> bool:
    """Without an incumbent every score passes; a NaN on either side, or a worse score, does not."""
    return incumbent is None or (score is not None and score <= incumbent)


def search_and_judge(features: DataFrame, out: str, runs: Runs, points: list[dict], n_splits: int, test_weeks: int,
                     register: bool, parallelism: int, fitter) -> Result:
    """Cross-validated search on the pool, then one look at the holdout weeks."""
    spark = features.sparkSession
    features = cut_lineage(features)  # every fit reads it
    pool, test = holdout_split(features, test_weeks)
    baseline = _named(naive_baseline(test), HOLDOUT)
    runs.add("persistence", "baseline", {}, _named(naive_baseline(features), ALL_WEEKS) | baseline)

    scores = cv_score(pool, rolling_origin_folds(pool, n_splits), points, parallelism, fitter)
    scores.write.parquet(f"{out}/search/{uuid.uuid4().hex}")
    by_point: dict[int, list] = {}
    for r in scores.collect():  # candidates x folds rows
        by_point.setdefault(r["candidate"], []).append(r)
    for i, rows in sorted(by_point.items()):
        per_fold = {f"fold{r['fold']}_{m}": r[m] for r in rows for m in METRICS}
        runs.add(f"search-{i}", "gbt", points[i], per_fold | {"cv_mean_rmsle": sum(r["rmsle"] for r in rows) / len(rows)})
    best, cv_rmsle = best_of(scores)

    incumbent = incumbent_score(spark, out, runs.model_name) if register else None
    with ThreadPoolExecutor(max_workers=2) as both:
        # without an incumbent the gate cannot fail, so the refit on all weeks need not wait for it
        refit = both.submit(fitter, features, points[best]) if incumbent is None else None
        judged = fitter(pool, points[best])
    evaluated = cut_lineage(score_in_sales_space(judged, test))
    holdout = _named(evaluate_all(evaluated), HOLDOUT)
    promoted = passes(holdout["test_rmsle"], incumbent)
    runs.add("holdout", "gbt_holdout", points[best] | {"test_weeks": test_weeks},
             holdout | {f"baseline_{k}": v for k, v in baseline.items()} | {"incumbent_test_rmsle": incumbent},
             quality_gate="pass" if promoted else "fail")
    return Result(points, scores, points[best], cv_rmsle, holdout, baseline, incumbent, promoted, evaluated, pool, features, judged,
                  refit.result() if refit else None)


def write_reports(result: Result, out: str) -> dict[str, str]:
    """Segment metrics and summary, importances and the worst store's example of a judged model; each is worked out
    in a driver thread of its own, since its jobs are small and wait for each other."""
    test = result.evaluated.drop("prediction", "log_prediction")

    def segments():
        report = G.fairness_report(result.evaluated, result.pool)
        return report, segment_summary_json(report, result.evaluated)

    def worst():
        row = G.worst_segment_row(result.evaluated, evaluate_all(result.evaluated, by=["store_nbr"]))
        return A.local_explanation(result.judged, row.select(*test.columns))

    of_trees = {"gain": lambda: gain_importance(result.judged), "top_attr": lambda: A.global_attribution(result.judged, result.features),
                "permutation": lambda: A.permutation_importance(result.judged, test), "local_json": worst}
    with ThreadPoolExecutor(max_workers=1 + len(of_trees)) as pool:
        found = {k: pool.submit(f) for k, f in of_trees.items()} if isinstance(result.judged, ForecastModel) else {}
        report, summary = segments()
        return write_report_tables(f"{out}/reports", report, summary, **{k: f.result() for k, f in found.items()})


def release(result: Result, out: str, runs: Runs, test_weeks: int, fitter) -> None:
    """Refits on all weeks, saves the model, writes snapshot and reports."""
    spark = result.features.sparkSession
    with ThreadPoolExecutor(max_workers=2) as both:  # the reports need the judged model only
        reports = both.submit(write_reports, result, out)
        result.released = result.released or fitter(result.features, result.best)
        result.reports = reports.result()
    disparity = {f"fairness_disparity_ratio_{r['segment_dimension']}": r["disparity_ratio"]
                 for r in G.disparity_summary(G.segment_report(G.add_segments(result.evaluated, result.pool))).collect()}
    result.run_id = runs.add("release", "gbt_final", result.best | {"test_weeks": test_weeks},
                             {"cv_mean_rmsle": result.cv_rmsle} | result.holdout | disparity, quality_gate="pass")
    result.released.save(f"{out}/models/{result.run_id}")
    write_snapshot(latest_per_store(result.features), f"{out}/snapshot")


def run_training(spark: SparkSession, panel: DataFrame, out_dir: str, points: list[dict] | None = None, n_splits: int = 3,
                 test_weeks: int = 8, register: bool = True, parallelism: int = 8, model_name: str = "tillpanel-gbt",
                 alias: str = "production", lineage: dict | None = None, fitter=ForecastModel.fit) -> Result:
    """The whole job below ``out_dir``. ``lineage`` are tags that runs and versions carry beside the panel's own
    (such as the SHA-256 of the source files)."""
    raise_if_failed(validate_panel(panel))
    out = out_dir.rstrip("/")
    runs = Runs(model_name, RL.panel_fingerprint(panel) | (lineage or {}))
    result = search_and_judge(with_inputs(panel), out, runs, points or candidates(), n_splits, test_weeks, register, parallelism, fitter)
    if result.promoted:
        release(result, out, runs, test_weeks, fitter)
    RL.append_run(spark, f"{out}/runs", runs.rows)
    if result.promoted and register:  # last: whoever sees the version finds its run, model and snapshot
        RL.append_version(spark, f"{out}/versions", [{
            "model_name": model_name, "version": RL.claim_version(spark, f"{out}/versions", model_name), "alias": alias,
            "run_id": result.run_id, "created_at": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
            "tags": {k: str(v) for k, v in runs.tags.items()}}])
    return result
