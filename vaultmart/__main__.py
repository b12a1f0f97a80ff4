"""Command line: load batches, build marts, run the quality gate.

    python -m vaultmart --sf-dir <tables> [--root <run folder>] \\
        [--batches 1 2 3] [--marts] [--quality] [--replay] [--publish BATCH] [--prefix NAME_]

(or ``spark-submit vaultmart/__main__.py ...`` with the package on the path).

``--root`` continues an existing run (a later day's job); ``--quality``
builds the marts of the last batch, runs the 56 tests and exits non-zero
when any fails, so a scheduler stops the day there.

The views ``<prefix>bronze|silver|gold|mart.<table>`` show the last batch after every load.  ``--replay`` loads
the given batches again although later ones were loaded, and those after them; a replay that an earlier call
left broken off is brought to its end first.  ``--publish`` shows an earlier batch instead.
"""

from __future__ import annotations

import argparse
import json
import sys

from vaultmart.plans.pipeline import Pipeline
from vaultmart.session import get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="vaultmart", description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", required=True, help="folder of the source tables")
    ap.add_argument("--root", help="run folder (default: a new one in spark.checkpoint.dir)")
    ap.add_argument("--batches", type=int, nargs="+", help="default: 1 2 3")
    ap.add_argument("--feed", type=int, help="fixture batch to derive the sources from")
    ap.add_argument("--marts", action="store_true", help="build the marts of the last batch")
    ap.add_argument("--quality", action="store_true", help="run the tests; exit 1 on a failure")
    ap.add_argument("--replay", action="store_true", help="load batches again that others were loaded after")
    ap.add_argument("--publish", type=int, help="show this batch in the views (with no --batches: only that)")
    ap.add_argument("--prefix", default="", help="of the databases of the views")
    args = ap.parse_args(argv)

    spark = get_session()
    run = Pipeline(spark, args.sf_dir, root=args.root, prefix=args.prefix)
    resumed = run.resume_replay()
    batches = args.batches or ([] if args.publish is not None else [1, 2, 3])
    last = batches[-1] if batches else max(run.store.marked("finished"), default=0)
    for b in batches:
        run.run_batch(b, with_marts=(args.marts or args.quality) and b == last, feed=args.feed, replay=args.replay)
    if args.publish is not None:
        run.publish(args.publish)
    print(json.dumps({"root": run.root, "batches": batches, "resumed": resumed, "shown": run.published.shown(),
                      "load_report": {f"{t}@{b}": v for (t, b), v in run.load_report.items()}}))
    if not args.quality:
        return 0
    failed = run.quality(last).where("violations > 0").collect()   # at most 56 rows
    for r in failed:
        print(f"FAIL {r.layer}.{r.table_name}.{r.column_name} {r.test}: {r.violations}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
