"""Command line for spark-submit: run, preprocess, profile, train, score.

    python -m staylens run        --input bookings.csv --out OUT [--model Auto|RandomForest|...] [--fit-rows N]
    python -m staylens score      --model OUT/models/best_model --input records.json --out OUT/scored

``run`` is the first two of these in one:

    python -m staylens preprocess --input bookings.csv --out OUT [--target is_canceled] [--drop a b]
    python -m staylens train      --train OUT/train_processed --test OUT/test_processed
                                  --preprocessor OUT/preprocessor --out OUT/models
    python -m staylens profile    --input bookings.csv --out OUT
"""

from __future__ import annotations

import argparse

from .operators.train import SearchConfig
from .plans import jobs
from .session import build_session

FORMATS = ["csv", "json", "parquet"]


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="staylens")
    sub = ap.add_subparsers(dest="cmd", required=True)

    def command(name: str, *parts) -> None:
        p = sub.add_parser(name)
        p.add_argument("--out", required=True)
        for part in parts:
            part(p)

    def source(p):
        p.add_argument("--input", required=True)
        p.add_argument("--format", choices=FORMATS, help="of the input; told by its suffix unless given")

    def label(p):
        p.add_argument("--target", default="is_canceled")
        p.add_argument("--seed", type=int, default=42)

    def preparation(p):
        p.add_argument("--test-size", type=float, default=0.3)
        p.add_argument("--scale", default="minmax", choices=["minmax", "standard"])
        p.add_argument("--drop", nargs="*", default=[], help="columns that are no features; the default list unless given")

    def search(p):
        p.add_argument("--model", default="Auto")
        p.add_argument("--n-iter", type=int, default=10)
        p.add_argument("--cv", type=int, default=5)
        p.add_argument("--fit-rows", type=int, default=None, help="labelled rows of a fit, about, at most")

    def tables(p):
        p.add_argument("--train", required=True)
        p.add_argument("--test", required=True)
        p.add_argument("--preprocessor", help="the saved preprocessor that made them; then models score raw records")
        p.add_argument("--table-format", default="parquet", choices=["csv", "parquet"])

    def processed(p):
        p.add_argument("--table-format", default="parquet", choices=["csv", "parquet"])

    def scoring(p):
        p.add_argument("--model", required=True)
        p.add_argument("--processed", action="store_true")
        p.add_argument("--keep", nargs="*", default=[])

    command("run", source, label, preparation, search)
    command("preprocess", source, label, preparation, processed)
    command("train", tables, label, search)
    command("profile", source)
    command("score", source, scoring)
    return ap


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    raw = jobs.read_input(spark, args.input, args.format) if "input" in args else None
    if args.cmd in ("run", "train"):
        cfg = SearchConfig(n_iter=args.n_iter, folds=args.cv, seed=args.seed, fit_rows=args.fit_rows)
    if args.cmd == "run":
        jobs.run_job(spark, raw, args.out, args.target, args.model, cfg, args.test_size, args.scale,
                     args.drop).show(truncate=False)
    elif args.cmd == "preprocess":
        print(jobs.preprocess_job(spark, raw, args.out, args.target, args.test_size, args.seed, args.scale,
                                  fmt=args.table_format, drop=args.drop))
    elif args.cmd == "train":
        jobs.train_job(spark, args.train, args.test, args.out, args.target, args.model, cfg, args.table_format,
                       args.preprocessor).show(truncate=False)
    elif args.cmd == "profile":
        print(jobs.profile_job(spark, raw, args.out))
    elif args.cmd == "score":
        print(jobs.score_job(spark, args.model, raw, args.out, args.processed, args.keep))


if __name__ == "__main__":
    main()
