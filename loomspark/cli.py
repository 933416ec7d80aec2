"""Command line: build a dataset, or run one stage over files."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.config import BASE, INSTRUCT, PRETRAIN, config_hash, load_config
from loomspark.operators.dedup import exact_dedup
from loomspark.operators.normalize import is_record, normalize, render
from loomspark.operators.ordinal import first_rows
from loomspark.operators.pack import pack_sequences
from loomspark.operators.quality import reject_reason
from loomspark.operators.split import split_of, with_shards
from loomspark.operators.tokenizers import encode_with_eos, load_tokenizer
from loomspark.plans.pipeline import run_pipeline
from loomspark.schema import MESSAGES
from loomspark.sinks.shards import write_bin
from loomspark.sources.files import _fs, load_files, number_stream, read_jsonl, resolve_source
from loomspark.sources.objects import get_json, upload_directory
from loomspark.streaming.checkpoints import partial_metadata, publish_checkpoint, restore_checkpoint
from loomspark.streaming.incremental import IncrementalBuild

PLACE = ["file_index", "row_offset"]


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a file in order; of a folder that a stage wrote, by its own ordinals."""
    fs, at = _fs(spark, path)
    if path.lower().endswith((".parquet", ".jsonl", ".json")) and fs.exists(at) and fs.getFileStatus(at).isFile():
        return load_files(spark, [path])
    return number_stream(read_jsonl(spark, path))


def _whole(df: DataFrame) -> DataFrame:
    """Records read back: columns that JSON left out are null again."""
    for name, kind in (("text", "string"), ("language", "string"), ("path", "string"), ("messages", MESSAGES)):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def build(spark, args) -> None:
    config = load_config(args.config)
    names = ("target_tokens", "output_dir", "sequence_length", "work_dir", "progress_path", "report_path", "num_workers", "worker_batch_size", "worker_start_method", "log_interval_seconds")
    config = config.with_overrides(**{n: getattr(args, n) for n in names})
    metadata = run_pipeline(spark, config, resume=args.resume, skip_upload=args.skip_upload, max_samples_per_source=args.max_samples_per_source)
    print(json.dumps(metadata, indent=2, sort_keys=True))


def build_incremental(spark, args) -> None:
    """Takes in the files that were added to a folder; with a store, what it holds comes first and is published after."""
    config = load_config(args.config)
    if config.output_mode != PRETRAIN:
        raise ValueError("incremental builds are for pretraining")
    source = next(s for s in config.sources if s.name == args.source)
    store = config.s3_output
    if store and not args.skip_upload:
        restore_checkpoint(spark, config, store)
    build = IncrementalBuild(spark, config, source, load_tokenizer(config.tokenizer_path, config.fallback_tokenizer))
    schema = spark.read.format(args.reader).load(args.input).schema
    entries = build.run(args.input, schema, args.reader, args.files_per_batch, show=lambda line: print(line, file=sys.stderr))
    if store and not args.skip_upload:
        publish_checkpoint(spark, config, store)
    print(json.dumps(partial_metadata(config, entries), indent=2, sort_keys=True))


def normalize_stage(spark, args) -> None:
    _write(normalize(_rows(spark, args.input), args.name, args.command.removeprefix("normalize-"), language=args.language).where(is_record()), args.output)


def filters(spark, args) -> None:
    df = _whole(_rows(spark, args.input))
    _write(df.where(reject_reason(render(), F.col("language"), F.col("path")).isNull()), args.output)


def dedup(spark, args) -> None:
    marked = exact_dedup(_whole(_rows(spark, args.input)), render(), PLACE)
    _write(marked.where(~F.col("is_dup")).drop("is_dup", "hash"), args.output)


def tokenize(spark, args) -> None:
    tokenizer = load_tokenizer(args.tokenizer)
    _write(_whole(_rows(spark, args.input)).select(*PLACE, encode_with_eos(tokenizer, render()).alias("tokens")), args.output)


def pack(spark, args) -> None:
    sequences = pack_sequences(_rows(spark, args.input).withColumn("tokens", F.col("tokens").cast("array<int>")), PLACE, args.sequence_length)
    sequences = with_shards(sequences.withColumn("split", split_of(F.col("seq_index"), args.seed, args.val_ratio)), "seq_index", args.shard_sequences)
    write_bin(sequences, args.output, args.dtype)


def show_report(spark, args) -> None:
    print(json.dumps(get_json(spark, args.input), indent=2, sort_keys=True))


def upload(spark, args) -> None:
    print(json.dumps(upload_directory(spark, args.input, args.output)))


def preview(spark, args) -> None:
    config = load_config(args.config)
    source = next(s for s in config.sources if s.name == args.source)
    for row in first_rows(resolve_source(spark, source), PLACE, args.limit).toJSON().toLocalIterator():
        print(row)


def show_hash(spark, args) -> None:
    print(config_hash(load_config(args.config)))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="loomspark", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, *, files: bool = True) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        p.set_defaults(run=run)
        if files:
            p.add_argument("--input", required=True)
            p.add_argument("--output", required=True)
        return p

    p = command("build", build, files=False)
    p.add_argument("--config", required=True)
    for flag in ("--target-tokens", "--sequence-length", "--num-workers", "--worker-batch-size", "--log-interval-seconds", "--max-samples-per-source"):
        p.add_argument(flag, type=int)
    for flag in ("--output-dir", "--work-dir", "--progress-path", "--report-path", "--worker-start-method"):
        p.add_argument(flag)
    p.add_argument("--skip-upload", action="store_true")
    p.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)
    p = command("build-incremental", build_incremental, files=False)
    for flag in ("--config", "--source", "--input"):
        p.add_argument(flag, required=True)
    p.add_argument("--reader", default="parquet", choices=("parquet", "json"))
    p.add_argument("--files-per-batch", type=int, default=100)
    p.add_argument("--skip-upload", action="store_true")
    for kind in (BASE, INSTRUCT):
        p = command(f"normalize-{kind}", normalize_stage)
        p.add_argument("--name", required=True)
        p.add_argument("--language")
    command("filters", filters)
    command("dedup", dedup)
    command("tokenize", tokenize).add_argument("--tokenizer", required=True)
    p = command("pack", pack)
    p.add_argument("--sequence-length", type=int, required=True)
    p.add_argument("--dtype", default="uint16")
    p.add_argument("--val-ratio", type=float, default=0.0)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--shard-sequences", type=int, default=100_000)
    command("report", show_report, files=False).add_argument("--input", required=True)
    command("upload", upload)
    p = command("preview", preview, files=False)
    p.add_argument("--config", required=True)
    p.add_argument("--source", required=True)
    p.add_argument("--limit", type=int, default=5)
    command("config-hash", show_hash, files=False).add_argument("--config", required=True)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    args.run(spark or SparkSession.builder.appName("loomspark").getOrCreate(), args)
    return 0



if __name__ == "__main__":
    sys.exit(main())
