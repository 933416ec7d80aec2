"""The build: sources to packed token shards or instruction samples.

Row order decides everything: which copy stays, where a budget cuts, how documents are packed, what is
validation. Each source is one plan over explicit ordinals, written once to the work folder with its
tokens; budgets then cut it at one ordinal, so what is left is a filter. Sources follow each other because a row
that one source's budget cuts must not suppress its copy in the next.
"""

from __future__ import annotations

import tempfile
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark import report
from loomspark.config import BASE, PRETRAIN, PipelineConfig, SourceConfig, config_hash, source_included
from loomspark.operators.budget import apply_budgets
from loomspark.operators.dedup import canonical_hash, marked_duplicates
from loomspark.operators.normalize import is_record, normalize, render
from loomspark.operators.ordinal import with_rank
from loomspark.operators.pack import pack_sequences
from loomspark.operators.quality import reject_reason
from loomspark.operators.split import split_of, with_shards
from loomspark.operators.tokenizers import Tokenizer, copy_tokenizer, count_with_eos, dtype_of, encode_with_eos, load_tokenizer
from loomspark.schema import EMPTY_TOKENS, NORMALIZE_FAILED, ORDINAL
from loomspark.scratch import remove
from loomspark.sinks.shards import bytes_per_split, remove_outputs, validate_shards, write_bin, write_jsonl
from loomspark.sources.files import exists, resolve_source
from loomspark.sources.objects import get_json, put_json, upload_directory

PLACE = ["file_index", "row_offset"]


def judged(raw: DataFrame, source: SourceConfig, index: int, mode: str, system_prompt: str) -> DataFrame:
    """Records of a source with their rendered text and reject reason."""
    records = normalize(raw.withColumn("source_index", F.lit(index)), source.name, source.type, language=source.language, system_prompt=system_prompt)
    usable = is_record() if mode == PRETRAIN else is_record() & (F.col("type") != BASE)
    rendered = records.withColumn("rendered", render())
    reason = F.when(~usable, NORMALIZE_FAILED).otherwise(reject_reason(F.col("rendered"), F.col("language"), F.col("path")))
    return rendered.withColumn("reject_reason", reason)


def hashed(df: DataFrame) -> DataFrame:
    """judged rows with the hash of what was not rejected."""
    return df.withColumn("hash", F.when(F.col("reject_reason").isNull(), canonical_hash(F.col("rendered"))))


def staged(df: DataFrame, folder: str) -> DataFrame:
    """df written to folder and read from there."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def tokenized(df: DataFrame, tokenizer: Tokenizer, mode: str) -> DataFrame:
    """df with tokens (pretrain) or n_tokens, in one pass; only what was kept and is no copy reaches the tokenizer, the rest as empty texts."""
    wanted = F.col("reject_reason").isNull() & ~F.col("is_dup")
    text = F.when(wanted, F.col("rendered"))
    if mode == PRETRAIN:
        made = df.withColumn("tokens", F.when(wanted, encode_with_eos(tokenizer, text)))
        return made.withColumn("n_tokens", F.when(wanted, F.size("tokens")).otherwise(0).cast("bigint")).drop("rendered", "text", "messages")
    made = df.withColumn("n__", F.when(wanted, count_with_eos(tokenizer, text)))
    made = made.withColumn("reject_reason", F.when(F.col("n__") <= 1, EMPTY_TOKENS).otherwise(F.col("reject_reason")))
    return made.withColumn("n_tokens", F.when(F.col("n__") > 1, F.col("n__")).otherwise(0).cast("bigint")).drop("n__", "rendered", "text")


@dataclass
class SourceResult:
    """What became of one source. folder and last: its staged rows, and the place of the last that was processed."""

    source: SourceConfig
    accepted: DataFrame
    processed: int
    tokens: int
    normalized: int
    filtered: int
    duplicates: int
    rejected: dict[str, int] = field(default_factory=dict)
    folder: str = ""
    last: list[int] | None = None

    def entry(self) -> dict:
        """As the progress file holds it."""
        return {k: getattr(self, k) for k in ("processed", "tokens", "normalized", "filtered", "duplicates", "rejected", "folder", "last")}


def accepted_rows(spark: SparkSession, folder: str, last: list[int] | None) -> DataFrame:
    rows = spark.read.parquet(folder).where("n_tokens > 0")
    return rows.where(F.struct(*PLACE) <= F.struct(F.lit(last[0]), F.lit(last[1]).cast("bigint"))) if last else rows.where(F.lit(False))


def build_source(spark: SparkSession, config: PipelineConfig, source: SourceConfig, index: int, tokenizer: Tokenizer, seen: DataFrame | None, accepted_before: int, streams: dict[str, DataFrame] | None = None, max_rows: int | None = None) -> SourceResult:
    mode, block = config.output_mode, config.sample_length if config.output_mode == PRETRAIN else 1
    folder, first = config.work("tokenized", f"{index:04d}-{source.name}"), config.work("judged", f"{index:04d}-{source.name}")
    # Each text goes through the cascade and the hash once.
    records = staged(hashed(judged(resolve_source(spark, source, streams), source, index, mode, config.system_prompt)), first)
    intermediate = config.write_intermediate_jsonl and mode == PRETRAIN
    if intermediate:
        write_intermediate(config, source, records)
    rows = staged(tokenized(marked_duplicates(records, PLACE, seen), tokenizer, mode), folder)
    remove(spark, first)

    narrow = apply_budgets(rows.select(*PLACE, "reject_reason", "is_dup", "n_tokens"), PLACE, source_limit=source.target_tokens, target=config.target_tokens, before=accepted_before, block=block, max_rows=max_rows)
    by = narrow.where("processed").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_dup").cast("bigint")).alias("dups"), F.sum("n_tokens").alias("tokens"), F.max(F.struct(*PLACE)).alias("last")).collect()
    last = list(max((tuple(r["last"]) for r in by), default=())) or None
    counts = {r["reject_reason"]: r for r in by}
    kept = counts.get(None)
    processed, dups = sum(r["n"] for r in by), kept["dups"] if kept else 0
    rejected = {k: r["n"] for k, r in counts.items() if k is not None}
    normalized = processed - rejected.get(NORMALIZE_FAILED, 0) if intermediate else 0
    filtered = (kept["n"] - dups if kept else 0) if intermediate else 0
    return SourceResult(source, accepted_rows(spark, folder, last), processed, kept["tokens"] or 0 if kept else 0, normalized, filtered, dups, rejected, folder, last)


def write_intermediate(config: PipelineConfig, source: SourceConfig, judged_rows: DataFrame) -> None:
    """Normalized and kept records of a source as JSON lines."""
    records = judged_rows.drop("rendered", "hash", *ORDINAL)
    for folder, rows in (("normalized", records.where(is_record())), ("filtered", records.where("reject_reason is null"))):
        rows.drop("reject_reason").write.mode("overwrite").json(config.work(folder, source.name))


def sources_report(config: PipelineConfig, results: list[SourceResult]) -> list[dict]:
    """One entry for each configured source, zeros for one that was not reached."""
    found = {r.source.name: r for r in results}
    out = []
    for s in config.sources:
        r = found.get(s.name)
        counts = (r.processed, r.tokens, r.normalized, r.filtered) if r else (0, 0, 0, 0)
        out.append({"name": s.name, "type": s.type, "mix_role": s.mix_role, "target_tokens": s.target_tokens} | dict(zip(("processed_samples", "accepted_tokens", "normalized_count", "filtered_count"), counts)))
    return out


def shard_table(df: DataFrame, unit: str, tokens, ending: str) -> list[dict]:
    """One dict per shard, from df with split and shard; the last shard of a split is still open."""
    rows = df.groupBy("split", "shard").agg(F.sum(tokens).alias("tokens"), F.count(F.lit(1)).alias("n")).collect()
    last = {}
    for r in rows:
        last[r["split"]] = max(last.get(r["split"], 0), r["shard"])
    made = [{"split": r["split"], "index": r["shard"], "path": f"{r['split']}-{r['shard']:05d}.{ending}", "tokens": r["tokens"], unit: r["n"], "closed": r["shard"] < last[r["split"]]} for r in rows]
    return sorted(made, key=lambda s: (s["split"], s["index"]))


def union_accepted(results: list[SourceResult]) -> DataFrame:
    out = results[0].accepted
    for r in results[1:]:
        out = out.unionByName(r.accepted)
    return out


def pretrain_sequences(accepted: DataFrame, config: PipelineConfig) -> DataFrame:
    """seq_index, ids, split, shard of all full sequences. They are packed once, into the work folder."""
    packed = staged(pack_sequences(accepted, ORDINAL, config.sample_length), config.work("packed"))
    return with_shards(packed.withColumn("split", split_of(F.col("seq_index"), config.seed, config.val_ratio)), "seq_index", config.shard_sequences)


def sft_samples(accepted: DataFrame, config: PipelineConfig) -> DataFrame:
    """sample_index, messages, source, n_tokens, split, shard of all samples."""
    ranked = staged(with_rank(accepted.select(*ORDINAL, "messages", "source", "n_tokens"), ORDINAL, "sample_index"), config.work("ranked"))
    split = split_of(F.col("sample_index"), config.seed, config.val_ratio, samples=True)
    return with_shards(ranked.withColumn("split", split), "sample_index", config.sft_samples_per_shard).drop(*ORDINAL)


def run_pipeline(spark: SparkSession, config: PipelineConfig, *, resume: bool = True, skip_upload: bool = False, max_samples_per_source: int | None = None, streams: dict[str, DataFrame] | None = None, tokenizer: Tokenizer | None = None) -> dict:
    """Builds the dataset and returns its metadata.

    A completed run of the same configuration is not repeated; another configuration's progress is an error. After each
    source the progress file (and the store, if there is one) tells what became of it, so a run that broke off goes on
    with the next source. A run whose sources did not reach the target is not completed: the next one begins anew.
    """
    mark = config_hash(config)
    before = get_json(spark, config.progress_path) if resume else None
    if before is not None:
        if before["config_hash"] != mark:
            raise ValueError("the progress file belongs to another configuration")
        if before.get("completed") and (metadata := get_json(spark, config.output("metadata.json"))) is not None:
            return metadata
    done = dict(before.get("sources_done", {})) if before and before.get("max_samples_per_source") == max_samples_per_source else {}
    remove_outputs(config.output_dir)
    log, began = report.ProgressLine(), time.time()
    for name in config.without_effect():
        log.log(f"{name} has no effect; the mix follows target_tokens of the sources, and Spark's settings its tasks")
    tokenizer = tokenizer or load_tokenizer(config.tokenizer_path, config.fallback_tokenizer)
    pretrain, block = config.output_mode == PRETRAIN, config.sample_length if config.output_mode == PRETRAIN else 1
    state = {"config_hash": mark, "completed": False, "max_samples_per_source": max_samples_per_source}
    upload = config.s3_output and not skip_upload

    results: list[SourceResult] = []
    total, seen = 0, None
    for index, source in enumerate(config.sources):
        if not source_included(source, config.output_mode):
            continue
        if total // block * block >= config.target_tokens:
            break
        old = done.get(source.name)
        if old and exists(spark, f"{old['folder']}/_SUCCESS"):
            result = SourceResult(source, accepted_rows(spark, old["folder"], old["last"]), **old)
        else:
            done.clear()  # what came after it was cut by other budgets
            result = build_source(spark, config, source, index, tokenizer, seen, total, streams, max_samples_per_source)
        results.append(result)
        total += result.tokens
        hashes = result.accepted.select("hash")
        seen = hashes if seen is None else seen.union(hashes)
        state |= {"sources_done": {r.source.name: r.entry() for r in results}, "accepted_tokens": total}
        put_json(spark, config.progress_path, state)
        if upload:
            put_json(spark, f"{config.s3_output.rstrip('/')}/metadata.partial.json", {k: state[k] for k in ("config_hash", "completed", "accepted_tokens")} | {"sources": sources_report(config, results)})
        log.log(report.source_line(source.name, result.tokens, source.target_tokens, result.processed, time.time() - began))

    rejected: dict[str, int] = {}
    for r in results:
        for reason, n in r.rejected.items():
            rejected[reason] = rejected.get(reason, 0) + n
    sources = sources_report(config, results)
    unit, ending = ("sequences", "bin") if pretrain else ("samples", "jsonl")
    totals = report.Totals(unit)
    if results:
        made = staged((pretrain_sequences if pretrain else sft_samples)(union_accepted(results), config), config.work(unit))
        totals.shards = shard_table(made, unit, F.size("ids").cast("bigint") if pretrain else F.col("n_tokens"), ending)
        if pretrain:
            totals.dropped_remainder_tokens = total % block
            write_bin(made, config.output_dir, dtype_of(tokenizer.vocab_size))
        else:
            write_jsonl(made, config.output_dir)
    if pretrain:
        with tempfile.TemporaryDirectory() as own:  # small files of the driver's, copied to where the output lies
            copy_tokenizer(config.tokenizer_path, own, tokenizer)
            upload_directory(spark, f"file://{own}/tokenizer", config.output("tokenizer"))
        dtype = dtype_of(tokenizer.vocab_size)
        if not validate_shards(config.output_dir, totals.shards, dtype, block)[1]:
            raise RuntimeError("the shards written don't match the sequences made")
        put_json(spark, config.output("manifest.json"), report.pretrain_manifest(config, totals, dtype))
        metadata = report.pretrain_metadata(config, totals, sources, vocab_size=tokenizer.vocab_size, dtype=dtype, tokenizer_source=tokenizer.source)
    else:
        put_json(spark, config.output("manifest.json"), report.sft_manifest(config, totals))
        metadata = report.sft_metadata(config, totals, sources)
    put_json(spark, config.output("metadata.json"), metadata)
    files = [config.output(f.rstrip("/")) for f in metadata["output_files"]]
    duplicates = sum(r.duplicates for r in results)
    put_json(spark, config.report_path, report.dataset_report(config, totals, sources, filtered=sum(rejected.values()), deduplicated=duplicates, output_files=files))
    reached = total // block * block >= config.target_tokens
    sizes = bytes_per_split(config.output_dir, totals.written())
    put_json(spark, config.progress_path, {"config_hash": mark, "completed": reached, "target_reached": reached, "rejected_counts": rejected, "deduplicated_count": duplicates, "actual_tokens": totals.total_tokens} | {f"{k}_bytes": v for k, v in sizes.items()})
    if upload:
        names = [s["path"] for s in totals.written()]
        upload_directory(spark, config.output_dir, config.s3_output, names)
        upload_directory(spark, config.output_dir, config.s3_output, ["manifest.json", "metadata.json", "tokenizer/"], skip_unchanged=False)
    return metadata
