"""Report artifacts written with Spark writers: flattened segment metrics
(CSV), segment summary (JSON), importances (CSV) and one local explanation
(JSON). All inputs are aggregated tables, so each file is small."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpanel.operators.explore import evaluation_window


def segment_summary_json(report: DataFrame, evaluated: DataFrame, threshold: float = 1.5) -> DataFrame:
    """One JSON document: evaluation window + per-dimension ratio and flag.

    NaN ratios are written as JSON null."""
    dims = report.groupBy("segment_dimension").agg(
        F.first("disparity_ratio").alias("disparity_ratio"), F.first("flagged").alias("flagged"))
    seg = dims.agg(F.map_from_entries(F.collect_list(F.struct(
        "segment_dimension", F.struct(F.nanvl("disparity_ratio", F.lit(None).cast("double")).alias("disparity_ratio"),
                                      "flagged")))).alias("segments"))
    w = evaluation_window(evaluated).first()  # four scalars
    rec = F.struct(
        F.lit("chronological_holdout").alias("evaluation_protocol"),
        F.lit(str(w["start_date"])).alias("evaluation_start_date"),
        F.lit(str(w["end_date"])).alias("evaluation_end_date"),
        F.lit(w["n_weeks"]).alias("evaluation_weeks"), F.lit(w["n_rows"]).alias("evaluation_rows"),
        F.lit(threshold).alias("disparity_flag_threshold"), F.col("segments"))
    return seg.select(F.to_json(rec).alias("json"))


def write_report_tables(out_dir: str, report: DataFrame, summary_json: DataFrame,
                        gain: DataFrame | None = None, top_attr: DataFrame | None = None,
                        permutation: DataFrame | None = None, local_json: DataFrame | None = None) -> dict:
    """Write each artifact as a single small file, side by side; returns name → path."""
    out = out_dir.rstrip("/")

    def csv(df, path):
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)

    def text(df, path):
        df.coalesce(1).write.mode("overwrite").text(path)

    def falling(df, column):
        return None if df is None else df.orderBy(F.desc(column))

    artifacts = [("fairness_metrics", csv, report.orderBy("segment_dimension", F.desc("rmsle"))),
                 ("fairness_summary", text, summary_json),
                 ("native_gain_importance", csv, falling(gain, "gain")),
                 ("attribution_top_features", csv, top_attr),
                 ("permutation_importance_holdout", csv, falling(permutation, "importance_mean")),
                 ("local_example", text, local_json)]
    wanted = [(name, write, df) for name, write, df in artifacts if df is not None]
    with ThreadPoolExecutor(max_workers=len(wanted)) as pool:
        for done in [pool.submit(write, df, f"{out}/{name}") for name, write, df in wanted]:
            done.result()
    return {name: f"{out}/{name}" for name, _, _ in wanted}
