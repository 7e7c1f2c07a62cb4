"""Daily increments: load the files that are new since the last run, each exactly once.

A file stream with an available-now trigger keeps the list of seen files in its checkpoint.
Every micro-batch becomes one appended bronze load with its own audit row.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.config import RunContext, TableSpec
from tidemark.plans import audit
from tidemark.plans.bronze import AUDIT_TABLE, read_audit, with_load_metadata
from tidemark.sources.files import CSV_DIALECT, TableStore
from tidemark.sources.schemas import source_schema


def _already_logged(store: TableStore, table: str, load_id: str) -> bool:
    if not store.exists("audit", AUDIT_TABLE):
        return False
    return not read_audit(store).where((F.col("table_name") == table) & (F.col("load_id") == load_id)).isEmpty()


def _query_id(store: TableStore, checkpoint: str) -> str:
    """The id that the checkpoint gives its query; another checkpoint has another one."""
    return json.loads(store.spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def load_new_files(
    store: TableStore, spec: TableSpec, folder: str, ctx: RunContext, checkpoint: str, files_per_batch: int = 1000
) -> int:
    """Append the files in ``folder`` that no earlier call has loaded. Returns the batches run.

    A file whose header differs from the declared columns stops the stream. A batch that is
    replayed after a failure rewrites its own load and is logged once. Load ids hold the checkpoint's
    query id, so several checkpoints can feed one table.
    """
    source = (
        store.spark.readStream.options(**CSV_DIALECT)
        .option("multiLine", str(spec.multiline).lower())
        .option("enforceSchema", "false")
        .option("maxFilesPerTrigger", str(files_per_batch))
        .schema(source_schema(spec.name))
        .csv(folder)
    )
    done: list[int] = []

    def load(batch: DataFrame, number: int) -> None:
        load_id, counts = f"stream-{_query_id(store, checkpoint)}-{number}", Observation()
        loaded = with_load_metadata(batch, folder.rstrip("/").rsplit("/", 1)[-1], ctx.as_of, ctx.pipeline_version)
        store.write_load(loaded.observe(counts, F.count(F.lit(1)).alias("rows")), spec.bronze, load_id)
        if not _already_logged(store, spec.bronze, load_id):
            row = audit.audit_row(
                store.spark, ctx, spec, "SUCCESS", load_id, "append", folder, counts.get["rows"]
            )
            store.append(row.coalesce(1), "audit", AUDIT_TABLE)
        done.append(number)

    query = (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(done)
