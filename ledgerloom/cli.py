"""python -m ledgerloom.cli MODE KIND --root FOLDER --account NUMBER"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import date
from logging.handlers import TimedRotatingFileHandler

from pyspark.sql import SparkSession

from ledgerloom.config import Config
from ledgerloom.plans.engine import KINDS, MODES, Engine, default_root


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("mode", choices=MODES)
    p.add_argument("kind", choices=KINDS)
    p.add_argument("--root", default=default_root())
    p.add_argument("--account", required=True)
    p.add_argument("--forzar", action="store_true", help="read files again that have been read")
    p.add_argument("--confirmar", action="store_true", help="ask before manual records move")
    d = Config(account="")
    p.add_argument("--recogniser", default=d.recogniser, help="module:factory of what reads message files")
    p.add_argument("--own-codes", default="", help="codes of one's own bank, with commas between")
    p.add_argument("--path-in-id", action="store_true", help="equal names in different folders have ids of their own")
    p.add_argument("--overwrite", action="store_true", help="extracted tables hold the last run's files only")
    p.add_argument("--year", type=int, default=d.year, help="the year of month and day folders")
    p.add_argument("--cutover", type=date.fromisoformat, default=d.cutover, help="first day of the second layout")
    p.add_argument("--waiting", action="store_true", help="only show the files that a run would read")
    p.add_argument("--export", metavar="FOLDER", help="write the complete records and the upload there as CSV, too")
    p.add_argument("--workbook", metavar="FILE", help="write them as sheets of this workbook (.xlsx), whose other sheets stay")
    p.add_argument("--log", help="a log file, rotated daily")
    return p


def config_of(args: argparse.Namespace) -> Config:
    codes = tuple(c.strip() for c in args.own_codes.split(",") if c.strip())
    return Config(
        account=args.account, root=args.root, recogniser=args.recogniser, own_codes=codes, path_in_id=args.path_in_id, overwrite=args.overwrite, year=args.year, cutover=args.cutover
    )


def ask(n: int) -> bool:
    return input(f"{n} manual records move to the complete ones. Go on? [y/n] ").strip().lower() in ("y", "yes", "s", "si", "sí")


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if args.log:
        handlers.append(TimedRotatingFileHandler(args.log, when="midnight", backupCount=30, encoding="utf-8"))
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(name)s: %(message)s", handlers=handlers)
    spark = SparkSession.builder.appName("ledgerloom").getOrCreate()
    engine = Engine(spark, config_of(args))
    if args.waiting:
        for r in engine.waiting(args.kind).toLocalIterator():
            print(r["file_date"], r["version"], r["path"])
        return 0
    result = engine.run(args.mode, args.kind, args.forzar, ask if args.confirmar else None)
    print(result.summary())
    for name in ("complete", "template"):
        if engine.table(name, args.kind) is None:
            continue
        if args.export:
            engine.export(name, args.kind, f"{args.export}/{args.kind}-{name}")
        if args.workbook:
            engine.export(name, args.kind, args.workbook, "xlsx")
    return 1 if result.warnings else 0


if __name__ == "__main__":
    sys.exit(main())
