"""Job: refresh the Silver and Gold tables from Bronze."""

from __future__ import annotations

import argparse

from millsight.plans.gold import build_gold
from millsight.plans.silver import build_silver
from millsight.session import build_session
from millsight.sources.catalog import Lake


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--prefix", default="")
    parser.add_argument("--iso-year", action="store_true", help="pair ISO weeks with ISO years")
    parser.add_argument("--source-order", action="store_true", help="normalize text last")
    options = parser.parse_args(arguments)

    lake = Lake(build_session("millsight-models"), options.prefix)
    lake.bootstrap()
    build_silver(lake, normalize_first=not options.source_order)
    build_gold(lake, iso_year=options.iso_year)
    print("Silver and Gold refreshed")


if __name__ == "__main__":
    main()
