"""Job: run the acceptance suite over Gold and fail unless every check passes."""

from __future__ import annotations

import argparse

from millsight.plans.checks import Acceptance, acceptance_report, enforce
from millsight.plans.gold import GOLD_TABLES
from millsight.session import build_session
from millsight.sources.catalog import Lake


def main(arguments: list[str] | None = None, spec: Acceptance | None = None) -> list[dict]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--prefix", default="")
    parser.add_argument("--spec", default="", help="windows, entities and limits as JSON, or a file of it")
    options = parser.parse_args(arguments)

    lake = Lake(build_session("millsight-acceptance"), options.prefix)
    if options.spec:
        text = options.spec
        if not text.lstrip().startswith("{"):
            text = lake.spark.read.text(text, wholetext=True).first().value
        spec = Acceptance.from_json(text)
    gold = {name: lake.table("gold", name) for name in GOLD_TABLES}
    return enforce(acceptance_report(gold, lake.inventory(("gold",)), spec))


if __name__ == "__main__":
    main()
