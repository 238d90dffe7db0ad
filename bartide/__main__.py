"""python -m bartide COMMAND ROOT DATASET ...: load, validate, audit, gaps, latest, prune, normalise over a lake."""

from __future__ import annotations

import argparse
import json

from bartide import validate
from bartide.api import Reader
from bartide.operators import gaps
from bartide.registry import dataset
from bartide.session import session
from bartide.sources import lake, sinks


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="bartide", description=__doc__)
    p.add_argument("command", choices=["load", "validate", "audit", "gaps", "latest", "prune", "normalise"])
    p.add_argument("root")
    p.add_argument("dataset")
    p.add_argument("--symbols", nargs="*")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--limit", type=int, default=20)
    p.add_argument("--feature")
    p.add_argument("--order", default="close_time", help="normalise: the column that tells which of two rows came later")
    p.add_argument("--keep-from", help="prune: the earliest time to keep")
    a = p.parse_args(args)
    spark, ds = session(), dataset(a.dataset)
    if a.command == "load":
        Reader(spark, a.root).load(a.dataset, a.symbols, a.start, a.end, a.limit, a.feature).show(a.limit, truncate=False)
    elif a.command == "validate":
        print(json.dumps(validate.report(Reader(spark, a.root).load(a.dataset, a.symbols, a.start, a.end, feature=a.feature), a.dataset), indent=1, default=str))
    elif a.command == "gaps":
        gaps.ranges(lake.scan(spark, a.root, ds, a.symbols), ds.step_s or 60, time=ds.time).orderBy("symbol", "prev").show(a.limit, truncate=False)
    elif a.command == "audit":
        validate.audit(lake.scan(spark, a.root, ds, a.symbols), ds.step_s or 60, a.start).orderBy("symbol").show(a.limit, truncate=False)
    elif a.command == "normalise":
        print(json.dumps(sinks.normalise(spark, f"{a.root}/{ds.path}", a.order, ds.floor_s or 60)))
    elif a.command == "latest":
        lake.latest(spark, a.root, ds).orderBy("symbol").show(a.limit, truncate=False)
    else:
        print(json.dumps(sinks.prune(spark, f"{a.root}/{ds.path}", a.keep_from, ds.time)))


if __name__ == "__main__":
    main()
