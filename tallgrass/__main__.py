"""Command line: ``python -m tallgrass PROGRAM ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tallgrass.programs import PROGRAMS
from tallgrass.session import local_session, ship_package


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tallgrass")
    sub = out.add_subparsers(dest="command", required=True)
    for name, function, positional, options in PROGRAMS:
        one = sub.add_parser(name, help=(function.__doc__ or "").split("\n")[0])
        one.set_defaults(run=function)
        for argument in positional:
            one.add_argument(argument)
        for option, value in options.items():
            flag = "--" + option.replace("_", "-")
            if value is False:
                one.add_argument(flag, action="store_true")
            elif isinstance(value, type):
                one.add_argument(flag, type=value)
            elif isinstance(value, list):
                one.add_argument(flag, type=value[0], nargs="+")
            else:
                one.add_argument(flag, type=type(value), default=value)
    return out


def main(argv: Sequence[str] | None = None, spark=None) -> None:
    args = parser().parse_args(argv)
    spark = spark or local_session()
    ship_package(spark)
    args.run(spark, args)


if __name__ == "__main__":
    main()
