"""Incremental ingestion with the streaming file source.

The source's checkpoint remembers which files were read, so a trigger lists and loads only new
ones, all in one micro-batch: what is a copied key inside a batch must not depend on where a limit
would have cut it. The micro-batch runs through the same checks, staging and audit as a batch run.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsight.contracts import LOAD_ORDER
from millsight.plans.bronze import Ingestion
from millsight.session import work_folder
from millsight.sources.landing import scan_files


def ingest_available(
    ingestion: Ingestion, checkpoint: str | None = None
) -> dict[str, list[dict[str, int]]]:
    """Load every file that arrived since the last call, parents first; summaries by table."""
    spark = ingestion.spark
    checkpoint = (checkpoint or f"{work_folder(spark)}/landing").rstrip("/")
    ingestion.lake.bootstrap()
    done: dict[str, list[dict[str, int]]] = {name: [] for name in LOAD_ORDER}
    for name in LOAD_ORDER:
        schema = scan_files(spark, ingestion.source, name).drop("_source_file").schema
        files = (
            spark.readStream.schema(schema)
            .parquet(f"{ingestion.source.rstrip('/')}/{name}*.parquet")
            .withColumn("_source_file", F.col("_metadata.file_path"))
        )

        def load(rows: DataFrame, number: int, name: str = name) -> None:
            # A repeated micro-batch gets the same id and replaces its own rows.
            part = replace(ingestion, batch_id=f"{ingestion.batch_id}-{number}")
            done[name].append(part.load(name, rows))

        query = (
            files.writeStream.foreachBatch(load)
            .option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return done
