"""Command line: ``python -m clickmart build|refresh|silver|gold --root R [--landing L]``.

``build`` loads every landed file and builds all tables; ``refresh`` runs one
chained incremental refresh (nothing after bronze runs if no new rows
arrived and none are left from a failed run). ``silver`` and ``gold`` run one
layer of the run under way, for instance after a failure. Prints the row counts
of the run as JSON. Meant to be called by the cluster's scheduler.
"""

from __future__ import annotations

import argparse
import json

from clickmart.plans import refresh
from clickmart.session import build_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="clickmart")
    ap.add_argument("command", choices=["build", "refresh", "silver", "gold"])
    ap.add_argument("--root", required=True, help="folder holding the tables")
    ap.add_argument("--landing", help="folder the JSON files land in (build, refresh)")
    ap.add_argument("--load-ts", default=None, help="load stamp (default: now, UTC)")
    ap.add_argument("--no-prune", action="store_true", help="window all sessions")
    ap.add_argument("--max-files-per-trigger", type=int, default=None,
                    help="cut a backlog of files into micro-batches of this many files")
    ap.add_argument("--archive", default=None, help="folder that loaded files are moved to")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    if args.command in ("build", "refresh") and not args.landing:
        ap.error(f"{args.command} needs --landing")
    spark = build_session(args.master)
    if args.command == "build":
        counts = refresh.initial_build(spark, args.root, args.landing, args.load_ts,
                                       args.max_files_per_trigger, args.archive)
    elif args.command == "silver":
        refresh.refresh_silver(spark, args.root, args.load_ts)
        counts = {"silver": 1}
    elif args.command == "gold":
        refresh.refresh_gold(spark, args.root, prune=not args.no_prune)
        counts = {"gold": 1}
    else:
        counts = refresh.run_increment(spark, args.root, args.landing, args.load_ts,
                                       prune=not args.no_prune,
                                       max_files_per_trigger=args.max_files_per_trigger,
                                       archive=args.archive)
    print(json.dumps(counts))


if __name__ == "__main__":
    main()
