"""Incremental builds: new files go through Structured Streaming, each micro-batch is all or nothing.

Shards are immutable and lie in a folder of their batch. The ledger, written last, is the commit: a batch
without an entry is made again from the same files and overwrites what it left. The tokens behind the last full
sequence are kept and begin the next batch, so nothing is lost between runs.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomspark.config import PipelineConfig, SourceConfig, config_hash
from loomspark.operators.budget import apply_budgets
from loomspark.operators.dedup import SeenTable, marked_duplicates
from loomspark.operators.normalize import is_record
from loomspark.operators.pack import pack_sequences
from loomspark.operators.split import split_of, with_shards
from loomspark.operators.tokenizers import Tokenizer, dtype_of
from loomspark.plans.pipeline import PLACE, hashed, judged, shard_table, staged, tokenized
from loomspark.sinks.shards import write_bin
from loomspark.sources.files import number_stream
from loomspark.streaming.checkpoints import ProgressListener


class Ledger:
    """One JSON file for each committed batch."""

    def __init__(self, folder: str, mark: str):
        self.folder, self.mark = Path(folder), mark
        self.folder.mkdir(parents=True, exist_ok=True)
        for entry in self.entries():
            if entry["config_hash"] != mark:
                raise ValueError("the ledger belongs to another configuration")

    def entries(self) -> list[dict]:
        return [json.loads(p.read_text()) for p in sorted(self.folder.glob("batch-*.json"))]

    def committed(self, before: int) -> list[dict]:
        return [e for e in self.entries() if e["batch"] < before]

    def commit(self, entry: dict) -> None:
        path = self.folder / f"batch-{entry['batch']:08d}.json"
        beside = path.with_suffix(".new")
        beside.write_text(json.dumps(entry | {"config_hash": self.mark}, sort_keys=True))
        beside.rename(path)


class IncrementalBuild:
    """Pretraining shards from a folder to which files are added."""

    def __init__(self, spark: SparkSession, config: PipelineConfig, source: SourceConfig, tokenizer: Tokenizer):
        self.spark, self.config, self.source, self.tokenizer = spark, config, source, tokenizer
        self.ledger = Ledger(f"{config.work_dir}/ledger", config_hash(config))
        self.seen = SeenTable(spark, f"{config.work_dir}/seen")

    def batch(self, raw: DataFrame, number: int) -> None:
        """One micro-batch; called again with the same rows after a failure, with the same result."""
        before = self.ledger.committed(number)
        if any(e["batch"] == number for e in self.ledger.entries()):
            return
        sequences = sum(e["sequences"] for e in before)
        tail = before[-1]["tail"] if before else []
        length = self.config.sample_length
        done_tokens = sum(e["tokens"] for e in before)
        if done_tokens // length * length >= self.config.target_tokens or done_tokens >= self.source.target_tokens:
            self.ledger.commit({"batch": number, "rows": 0, "tokens": 0, "sequences": 0, "tail": tail, "duplicates": 0, "rejected": {}, "shards": [], "completed": True})
            return
        seen = self.seen.load([e["batch"] for e in before])
        folder = f"{self.config.work_dir}/batches/{number:08d}"
        records = staged(hashed(judged(number_stream(raw), self.source, 0, self.config.output_mode, self.config.system_prompt)), f"{folder}-judged")
        rows = staged(tokenized(marked_duplicates(records, PLACE, seen), self.tokenizer, self.config.output_mode), folder)
        # The budgets of the source and of the build cut inside a batch, as they do in a build in one run.
        narrow = apply_budgets(rows.select(*PLACE, "n_tokens"), PLACE, source_limit=self.source.target_tokens - done_tokens, target=self.config.target_tokens, before=done_tokens, block=length)
        cut = narrow.where("processed").agg(F.max(F.struct(*PLACE)).alias("x")).first()["x"]
        taken = rows.where(F.struct(*PLACE) <= F.struct(F.lit(cut[0]), F.lit(cut[1]).cast("bigint"))) if cut else rows.where(F.lit(False))
        accepted = taken.where("n_tokens > 0")
        counts = taken.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_dup").cast("bigint")).alias("dups"), F.sum("n_tokens").alias("tokens")).collect()
        tokens = sum(r["tokens"] or 0 for r in counts)

        head = self.spark.createDataFrame([(-1, 0, tail)], "file_index int, row_offset bigint, tokens array<int>")
        stream = accepted.select(*PLACE, "tokens").unionByName(head)
        packed = staged(pack_sequences(stream, PLACE, length).withColumn("seq_index", F.col("seq_index") + sequences), f"{folder}-packed")
        made = with_shards(packed.withColumn("split", split_of(F.col("seq_index"), self.config.seed, self.config.val_ratio)), "seq_index", self.config.shard_sequences)
        made = staged(made, f"{folder}-sequences")
        shards = shard_table(made, "sequences", F.size("ids").cast("bigint"), "bin")
        write_bin(made, f"{self.config.output_dir}/batch={number:08d}", dtype_of(self.tokenizer.vocab_size))
        self.seen.append(accepted, number)
        left = (len(tail) + tokens) % length
        self.ledger.commit({
            "batch": number,
            "rows": sum(r["n"] for r in counts),
            "tokens": tokens,
            "sequences": (len(tail) + tokens) // length,
            "tail": self._tail(stream, left),
            "duplicates": sum(r["dups"] or 0 for r in counts),
            "rejected": {r["reject_reason"]: r["n"] for r in counts if r["reject_reason"]},
            "shards": shards,
            "completed": False,
        })

    @staticmethod
    def _tail(stream: DataFrame, left: int) -> list[int]:
        """The last left tokens (fewer than a sequence), from the last documents that hold them."""
        if not left:
            return []
        rows = stream.where(F.size("tokens") > 0).orderBy(F.desc("file_index"), F.desc("row_offset")).select(F.slice("tokens", F.greatest(F.lit(1), F.size("tokens") - left + 1), F.lit(left)).alias("t")).limit(left)
        out: list[int] = []
        for r in rows.toLocalIterator():
            out = list(r["t"]) + out
            if len(out) >= left:
                break
        return out[-left:]

    def run(self, folder: str, schema: StructType, reader: str = "parquet", files_per_batch: int = 100, show: Callable[[str], None] | None = None) -> list[dict]:
        """Takes in all files that are there now, then stops. Returns the ledger. show gets a line after each batch."""
        listener = ProgressListener(self.source.name, self.source.target_tokens, show, lambda: sum(e["tokens"] for e in self.ledger.entries())) if show else None
        if listener:
            self.spark.streams.addListener(listener)
        try:
            return self._run(folder, schema, reader, files_per_batch)
        finally:
            if listener:
                self.spark.streams.removeListener(listener)

    def _run(self, folder: str, schema: StructType, reader: str, files_per_batch: int) -> list[dict]:
        stream = self.spark.readStream.format(reader).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(folder)
        query = stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", f"{self.config.work_dir}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        return self.ledger.entries()


def kept_stream(stream: DataFrame, source: SourceConfig) -> DataFrame:
    """Records of a stream that pass the cascade; stateless, so any sink and mode will do."""
    judged_ = judged(stream.withColumns({"file_index": F.lit(0), "row_offset": F.lit(0).cast("bigint")}), source, 0, "pretrain", "")
    return judged_.where(is_record() & F.col("reject_reason").isNull()).drop("rendered", "reject_reason")
