"""Command line: ``python -m reviewgrove INPUT [OUTPUT] [options]``."""

from __future__ import annotations

import argparse

from reviewgrove.plans.job import run
from reviewgrove.plans.tuning import GRIDS
from reviewgrove.session import create_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="reviewgrove", description="Learn ratings from review text.")
    parser.add_argument("input", help="reviews as JSON lines or Parquet; a glob is fine")
    parser.add_argument("output", nargs="?", help="folder for the best parameters as CSV")
    parser.add_argument("--format", choices=["json", "parquet"], default="json", help="format of the input")
    parser.add_argument("--base-path", help="folder above the partition folders of a Parquet input")
    parser.add_argument("--infer-schema", action="store_true", help="infer the schema of a JSON input")
    parser.add_argument("--local", action="store_true", help="small local session, report to the console")
    parser.add_argument("--test", action="store_true", help="use 100 reviews only")
    parser.add_argument("--with-indexers", action="store_true", help="index labels and features")
    parser.add_argument("--grid", choices=sorted(GRIDS), help="named parameter grid")
    parser.add_argument("--min-df", type=float, default=10.0)
    parser.add_argument("--max-df", type=float)
    parser.add_argument("--vocab-size", type=int, default=1 << 18)
    parser.add_argument("--bad-lines", help="folder for lines of a JSON input that are no records")
    parser.add_argument("--ledger", help="folder for finished models, from which a second start goes on")
    parser.add_argument("--parallelism", type=int, default=4, help="models trained at a time")
    args = parser.parse_args()
    if not args.local and args.output is None:
        parser.error("OUTPUT is needed unless --local is given")
    spark = create_session(args.local)
    result = run(
        spark,
        args.input,
        args.output,
        with_indexers=args.with_indexers,
        is_test=args.test,
        is_local=args.local,
        input_format=args.format,
        base_path=args.base_path,
        infer=args.infer_schema,
        grid=GRIDS[args.grid] if args.grid else None,
        min_df=args.min_df,
        max_df=args.max_df,
        vocab_size=args.vocab_size,
        parallelism=args.parallelism,
        bad_lines=args.bad_lines,
        ledger=args.ledger,
    )
    if result.n_dropped or result.n_left_out or result.n_bad_lines:
        print(
            f"{result.n_terms} terms; {result.n_dropped} more were cut off by the size of the vocabulary, "
            f"{result.n_left_out} were not given to the forest, {result.n_bad_lines} lines were no records"
        )
    result.close()


if __name__ == "__main__":
    main()
