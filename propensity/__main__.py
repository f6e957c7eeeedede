"""Command line: ``python -m propensity <command> --help``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from propensity.operators import audience, cleaning, quality
from propensity.plans import checking, rfm, scoring, training
from propensity.plans.user_row import user_row
from propensity.session import use_utc
from propensity.sources.csv_files import read_csv_directory, write_predictions

# Names as the log patterns expect them.
_LOG_NAMES = {
    "accuracy": "Accuracy",
    "precision": "Precision",
    "recall": "Recall",
    "f1": "F1 Score",
    "auc": "ROC AUC",
}


def _print_metrics(metrics: DataFrame) -> None:
    row = metrics.first().asDict()
    for name, title in _LOG_NAMES.items():
        print(f"{title}: {row[name]:.4f}")
    if row.get("is_suspicious"):
        print("All scores are perfect: look for a leak.")


def features(spark: SparkSession, args) -> None:
    rows = user_row(
        spark.read.parquet(args.traffic),
        spark.read.parquet(args.conversions),
        args.at,
        as_of=args.as_of,
        sample_percent=args.sample_percent,
    )
    rows.write.mode("overwrite").parquet(args.output)


def value(spark: SparkSession, args) -> None:
    tables = (args.conversions, args.impressions, args.clicks)
    rfm.rfm_row(*map(spark.read.parquet, tables), args.today).write.mode("overwrite").parquet(args.output)


def check(spark: SparkSession, args) -> None:
    df = read_csv_directory(spark, args.input)
    checks = quality.data_checks(df, args.label, args.drop)
    for name, report in checks.items():
        if name != "data":
            print(f"== {name}")
            report.show(truncate=False)
    result = checking.validate(checks["data"], args.label, drop=())
    result.folds.show()
    print(f"Mean F1: {result.mean_f1:.4f}")
    _print_metrics(result.metrics)


def train(spark: SparkSession, args) -> None:
    df = read_csv_directory(spark, args.input)
    drop = (*cleaning.NOT_FEATURES, *args.drop)
    result = training.train(
        df, args.label, drop=drop, balancing=args.balancing, trees=args.trees, save_to=args.model
    )
    _print_metrics(result.metrics)


def score(spark: SparkSession, args) -> None:
    states = scoring.score_files(spark, args.input, args.model, args.output)
    for name, state in states.items():
        if state != "matched":
            print(f"{state} feature: {name}")


def select(spark: SparkSession, args) -> None:
    scored = read_csv_directory(spark, args.input, {"prediction": "int", "probability": "double"})
    if args.top_n is not None:
        chosen = audience.top_n(scored, args.top_n)
    elif args.top_percent is not None:
        chosen = audience.top_percent(scored, args.top_percent)
    else:
        chosen = audience.above(scored, args.threshold)
    write_predictions(chosen, args.output)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="propensity")
    commands = parser.add_subparsers(required=True)

    def command(run, *options: str, help: str):
        sub = commands.add_parser(run.__name__, help=help)
        sub.set_defaults(run=run)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    sub = command(features, "traffic", "conversions", "at", "output", help="feature row per user")
    sub.add_argument("--as-of", action="store_true", help="no events after the cut-off in any feature")
    sub.add_argument("--sample-percent", type=float)
    command(
        value, "conversions", "impressions", "clicks", "today", "output",
        help="recency, frequency and value per buyer",
    )
    sub = command(check, "input", "label", help="quality and leakage checks, validated forest")
    sub.add_argument("--drop", nargs="*", default=[], help="known leaks")
    sub = command(train, "input", "model", help="fit, evaluate and save boosted trees")
    sub.add_argument("--label", default="target_col")
    sub.add_argument("--drop", nargs="*", default=[])
    sub.add_argument("--balancing", choices=["oversample", "weights", "none"], default="oversample")
    sub.add_argument("--trees", type=int, default=100)
    command(score, "input", "model", "output", help="score CSV files with a saved model")
    sub = command(select, "input", "output", help="choose an audience from scored users")
    rule = sub.add_mutually_exclusive_group(required=True)
    rule.add_argument("--top-n", type=int)
    rule.add_argument("--top-percent", type=float)
    rule.add_argument("--threshold", type=float)
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    args.run(use_utc(SparkSession.builder.appName("propensity").getOrCreate()), args)


if __name__ == "__main__":
    main()
