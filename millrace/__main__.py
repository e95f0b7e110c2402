"""Command line: build, evaluate, publish. Exit code 2 for errors raised on purpose."""

from __future__ import annotations

import argparse
import json
import sys

from millrace.plans.pipeline import BuildSettings, build, evaluate
from millrace.runtime import session
from millrace.sources.errors import EngineError
from millrace.sources.readers import read_settings, read_texts
from millrace.sources.writers import copy_publication, write_json, write_json_lines


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    commands = top.add_subparsers(dest="command", required=True)
    b = commands.add_parser("build", help="curate a file of records")
    b.add_argument("--input", required=True)
    b.add_argument("--output", required=True)
    b.add_argument("--config", required=True)
    b.add_argument("--approval", default="none", help="version of the approval, kept in the lineage columns")
    e = commands.add_parser("evaluate", help="score generated texts")
    for name in ("generated", "reference", "training", "output"):
        e.add_argument(f"--{name}", required=True)
    e.add_argument("--config", help="settings with the thresholds")
    p = commands.add_parser("publish", help="copy a built corpus to an empty prefix, the manifest last")
    p.add_argument("--source", required=True)
    p.add_argument("--target", required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session()
    try:
        if args.command == "build":
            print(json.dumps(build(spark, args.input, args.output, BuildSettings.from_toml(args.config), args.approval), indent=2))
        elif args.command == "evaluate":
            limits = {}
            if args.config:
                raw = read_settings(args.config)
                m = raw["memorization"]
                limits = {"span": int(m["longest_common_token_span"]), "jaccard": float(m["fivegram_jaccard"]), "flagged_rate": float(m["max_flagged_rate"]), "distance": float(raw["style"]["max_distance_from_reference"]), "distinct_2": float(raw["diversity"]["min_distinct_2"])}
            report = evaluate(*[read_texts(spark, getattr(args, n)) for n in ("generated", "reference", "training")], **limits)
            write_json_lines(report.pop("flagged"), args.output + ".flagged", ["gen"], single=False)
            write_json(spark, args.output, report)
            print(json.dumps(report, ensure_ascii=False, indent=2))
        else:
            print("\n".join(copy_publication(spark, args.source, args.target)))
    except EngineError as error:
        print(f"ERROR: {error}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
