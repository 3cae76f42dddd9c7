"""Job: load new landing files into Bronze."""

from __future__ import annotations

import argparse
import json
from datetime import date

from millsight.contracts import Horizon
from millsight.plans.bronze import Ingestion
from millsight.session import build_session
from millsight.sources.catalog import Lake
from millsight.streaming.incremental import ingest_available


def main(arguments: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source-path", required=True)
    parser.add_argument("--prefix", default="", help="prefix of the layer databases")
    parser.add_argument("--batch-id", default="")
    parser.add_argument("--first-date", type=date.fromisoformat, default=Horizon.first)
    parser.add_argument("--last-date", type=date.fromisoformat, default=Horizon.last)
    parser.add_argument("--incremental", action="store_true", help="use the streaming file source")
    options = parser.parse_args(arguments)

    lake = Lake(build_session("millsight-ingest"), options.prefix)
    horizon = Horizon(options.first_date, options.last_date)
    ingestion = Ingestion(lake, options.source_path, options.batch_id, horizon)
    print(json.dumps({"event": "ingestion_started", "batch_id": ingestion.batch_id}))
    tables = ingest_available(ingestion) if options.incremental else ingestion.run()
    event = {"event": "ingestion_completed", "batch_id": ingestion.batch_id, "tables": tables}
    print(json.dumps(event))
    return tables


if __name__ == "__main__":
    main()
