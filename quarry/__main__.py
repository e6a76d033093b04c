"""Command line: ``python -m quarry <job> --param value ... [--out DIR]``.

Runs one of ``quarry.plans.file_jobs.JOBS`` on the given files.  With
``--out`` every result is written as ``DIR/<result>`` (parquet, or CSV with
``--format csv``); without it a preview of each result is shown.
"""

from __future__ import annotations

import argparse
import inspect
import sys

from quarry.operators.lineage import scratch_scope
from quarry.plans.file_jobs import JOBS


def _parser(job: str) -> argparse.ArgumentParser:
    fn = JOBS[job]
    p = argparse.ArgumentParser(prog=f"python -m quarry {job}", description=fn.__doc__)
    for name, prm in list(inspect.signature(fn).parameters.items())[1:]:
        flag = "--" + name.replace("_", "-")
        ann = str(prm.annotation)
        required = prm.default is inspect.Parameter.empty
        if ann == "bool":
            p.add_argument(flag, dest=name, action=argparse.BooleanOptionalAction,
                           default=prm.default)
            continue
        typ = int if ann.startswith("int") else float if ann.startswith("float") else str
        p.add_argument(flag, dest=name, type=typ, required=required,
                       default=None if required else prm.default)
    p.add_argument("--out", default=None, help="output folder (shared file system on a cluster)")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--show", type=int, default=20, help="rows to preview without --out")
    return p


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if not argv or argv[0] not in JOBS:
        print("usage: python -m quarry <job> [options]\njobs: " + ", ".join(JOBS))
        return 2
    job = argv[0]
    args = vars(_parser(job).parse_args(argv[1:]))
    out, fmt, show = args.pop("out"), args.pop("format"), args.pop("show")
    from quarry.session import get_session
    spark = get_session(app_name=f"quarry-{job}")
    with scratch_scope(spark):  # the results are consumed inside; intermediate tables go then
        for name, df in JOBS[job](spark, **args).items():
            if out:
                writer = df.write.mode("overwrite")
                path = f"{out.rstrip('/')}/{name}"
                (writer.option("header", "true").csv(path) if fmt == "csv" else writer.parquet(path))
            else:
                print(f"== {name}")
                df.show(show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
