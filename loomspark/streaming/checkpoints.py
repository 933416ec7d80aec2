"""A running incremental build in an object store: published with its mark last, restored only with it; progress of a query."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from loomspark.config import PipelineConfig, config_hash
from loomspark.report import source_line
from loomspark.sources.objects import download_prefix, get_json, put_json, upload_directory

READY = "READY.json"


def partial_metadata(config: PipelineConfig, entries: list[dict]) -> dict:
    """What the committed batches hold so far."""
    shards = [s | {"path": f"batch={e['batch']:08d}/{s['path']}"} for e in entries for s in e["shards"]]
    rejected: dict[str, int] = {}
    for e in entries:
        for reason, n in e["rejected"].items():
            rejected[reason] = rejected.get(reason, 0) + n
    return {
        "project": config.project_name,
        "output_mode": config.output_mode,
        "target_tokens": config.target_tokens,
        "total_tokens": sum(s["tokens"] for s in shards),
        **{f"{split}_tokens": sum(s["tokens"] for s in shards if s["split"] == split) for split in ("train", "val")},
        "processed_rows": sum(e["rows"] for e in entries),
        "deduplicated_count": sum(e["duplicates"] for e in entries),
        "rejected_counts": rejected,
        "shards": shards,
        "completed": bool(entries) and entries[-1]["completed"],
    }


def publish_checkpoint(spark: SparkSession, config: PipelineConfig, uri: str) -> None:
    """Shards, seen hashes and ledger of the committed batches, then the metadata so far, then the mark."""
    uri = uri.rstrip("/")
    entries = [json.loads(p.read_text()) for p in sorted((Path(config.work_dir) / "ledger").glob("batch-*.json"))]
    upload_directory(spark, config.output_dir, f"{uri}/output", [f"batch={e['batch']:08d}/" for e in entries])
    upload_directory(spark, config.work_dir, f"{uri}/work", ["ledger/", *(f"seen/batch={e['batch']}/" for e in entries)])
    put_json(spark, f"{uri}/metadata.partial.json", partial_metadata(config, entries))
    put_json(spark, f"{uri}/{READY}", {"config_hash": config_hash(config), "batches": [e["batch"] for e in entries]})


def restore_checkpoint(spark: SparkSession, config: PipelineConfig, uri: str, mark: str | None = None) -> bool:
    """Brings a published build back, if there is no local one and the store has the mark of this configuration."""
    uri = uri.rstrip("/")
    if any((Path(config.work_dir) / "ledger").glob("batch-*.json")):
        return False
    ready = get_json(spark, f"{uri}/{READY}")
    if ready is None:
        return False
    if ready["config_hash"] != (mark or config_hash(config)):
        raise ValueError("the checkpoint belongs to another configuration")
    download_prefix(spark, f"{uri}/output", config.output_dir)
    download_prefix(spark, f"{uri}/work", config.work_dir)
    return True


class ProgressListener(StreamingQueryListener):
    """Prints a line for each micro-batch: rows so far, rates and, where tokens are told, how far the source is."""

    def __init__(self, name: str, limit: int, show: Callable[[str], None] = print, tokens: Callable[[], int] = lambda: 0):
        self.name, self.limit, self.show, self.tokens = name, limit, show, tokens
        self.rows, self.seconds = 0, 0.0

    def report(self, tokens: int, rows: int, seconds: float) -> None:
        self.show(source_line(self.name, tokens, self.limit, rows, seconds))

    def onQueryStarted(self, event) -> None:
        self.show(f"{self.name} started")

    def onQueryProgress(self, event) -> None:
        self.rows += event.progress.numInputRows
        self.seconds += event.progress.batchDuration / 1000
        self.report(self.tokens(), self.rows, self.seconds)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.show(f"{self.name} ended")
