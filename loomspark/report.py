"""Manifests, metadata and reports as JSON, and short forms of numbers for logs."""

from __future__ import annotations

import json
import math
import shutil
import sys
from dataclasses import dataclass, field
from pathlib import Path

from loomspark.config import PipelineConfig


@dataclass
class Totals:
    """What a run wrote; unit is sequences or samples. shards: dicts of split, index, path, tokens, unit, closed."""

    unit: str
    shards: list[dict] = field(default_factory=list)
    dropped_remainder_tokens: int = 0

    def _sum(self, what: str, split: str | None = None) -> int:
        return sum(s[what] for s in self.shards if split in (None, s["split"]))

    def of(self, split: str) -> dict[str, int]:
        return {f"{split}_tokens": self._sum("tokens", split), f"{split}_{self.unit}": self._sum(self.unit, split)}

    @property
    def total_tokens(self) -> int:
        return self._sum("tokens")

    @property
    def total_samples(self) -> int:
        return self._sum(self.unit)

    def written(self) -> list[dict]:
        return [s for s in self.shards if s[self.unit] > 0]


def pretrain_manifest(config: PipelineConfig, totals: Totals, dtype: str) -> dict:
    tokens = {f"{s}_tokens": totals.of(s)[f"{s}_tokens"] for s in ("train", "val")}
    return {"sequence_length": config.sample_length, "dtype": dtype, "shard_sequences": config.shard_sequences, "total_tokens": totals.total_tokens, "shards": totals.written(), **tokens}


def sft_manifest(config: PipelineConfig, totals: Totals) -> dict:
    both = totals.of("train") | totals.of("val")
    return {"format": "jsonl_messages", "samples_per_shard": config.sft_samples_per_shard, "total_samples": totals.total_samples, "total_tokens": totals.total_tokens, "shards": totals.written(), **both}


def pretrain_metadata(config: PipelineConfig, totals: Totals, sources: list[dict], *, vocab_size: int, dtype: str, tokenizer_source: str) -> dict:
    return {
        "vocab_size": vocab_size,
        "dtype": dtype,
        "sequence_length": config.sequence_length,
        "tokens_per_sample": config.sample_length,
        "loss_shift": config.loss_shift,
        "output_mode": config.output_mode,
        "total_tokens": totals.total_tokens,
        **totals.of("train"),
        **totals.of("val"),
        "dropped_remainder_tokens": totals.dropped_remainder_tokens,
        "tokenizer_source": tokenizer_source,
        "sources": sources,
        "shards": totals.written(),
        "output_files": [*(s["path"] for s in totals.written()), "manifest.json", "metadata.json", "tokenizer/"],
    }


def sft_metadata(config: PipelineConfig, totals: Totals, sources: list[dict]) -> dict:
    return {
        "project": config.project_name,
        "output_mode": config.output_mode,
        "artifact_format": config.artifact_format or "jsonl_messages",
        "target_tokens": config.target_tokens,
        "actual_tokens": totals.total_tokens,
        **totals.of("train"),
        **totals.of("val"),
        "total_samples": totals.total_samples,
        "sft_samples_per_shard": config.sft_samples_per_shard,
        "sources": sources,
        "shards": totals.written(),
        "output_files": [*(s["path"] for s in totals.written()), "manifest.json", "metadata.json"],
    }


def dataset_report(config: PipelineConfig, totals: Totals, sources: list[dict], *, filtered: int, deduplicated: int, output_files: list[str]) -> dict:
    report = {
        "project": config.project_name,
        "target_tokens": config.target_tokens,
        "actual_tokens": totals.total_tokens,
        "output_mode": config.output_mode,
        "sources": sources,
        "filtered_count": filtered,
        "deduplicated_count": deduplicated,
        "output_files": output_files,
        **{f"{s}_tokens": totals.of(s)[f"{s}_tokens"] for s in ("train", "val")},
    }
    return report | ({"sequence_length": config.sequence_length} if totals.unit == "sequences" else {})


def format_count(value: float) -> str:
    """1.5k, 2.0M, 3.1B; below a thousand the whole number."""
    sign, size = "-" if value < 0 else "", abs(float(value))
    for letter, unit in (("B", 1e9), ("M", 1e6), ("k", 1e3)):
        if size >= unit:
            return f"{sign}{size / unit:.1f}{letter}"
    return f"{sign}{int(size)}"


def format_rate(amount: float, seconds: float, unit: str) -> str:
    return f"{format_count(amount / seconds) if seconds > 0 else 0} {unit}"


def format_pct(part: float, whole: float) -> str:
    return f"{part / whole * 100:.2f}%" if whole > 0 else "0.0%"


def format_duration(seconds: float | None) -> str:
    if seconds is None or not math.isfinite(seconds) or seconds < 0:
        return "n/a"
    hours, rest = divmod(int(seconds), 3600)
    if hours:
        return f"{hours}h{rest // 60:02d}m"
    return f"{rest // 60}m{rest % 60:02d}s" if rest >= 60 else f"{rest}s"


def progress_bar(done: float, whole: float, width: int = 24) -> str:
    share = min(1.0, max(0.0, done / whole)) if whole > 0 else 0.0
    full = round(width * share)
    return f"[{'#' * full}{'-' * (width - full)}] {share * 100:5.1f}%"


def fit_terminal(line: str) -> str:
    most = max(40, shutil.get_terminal_size((120, 20)).columns - 1)
    return line if len(line) <= most else line[: most - 3] + "..."


class ProgressLine:
    """One line on a terminal that is written over; plain lines elsewhere."""

    def __init__(self, out=sys.stdout):
        self.out, self.width = out, 0

    def emit(self, text: str) -> None:
        if not self.out.isatty():
            print(text, file=self.out, flush=True)
            return
        line = fit_terminal(text)
        self.out.write("\r" + line.ljust(self.width))
        self.out.flush()
        self.width = len(line)

    def clear(self) -> None:
        if self.width and self.out.isatty():
            self.out.write("\r" + " " * self.width + "\r")
            self.out.flush()
        self.width = 0

    def log(self, text: str) -> None:
        self.clear()
        print(text, file=self.out, flush=True)


def source_line(name: str, tokens: int, limit: int, rows: int, seconds: float) -> str:
    """A source's progress: bar, tokens, rates and time left."""
    left = (limit - tokens) * seconds / tokens if tokens and limit > tokens else 0 if tokens else None
    return f"{name} {progress_bar(tokens, limit)} {format_count(tokens)}/{format_count(limit)} {format_rate(tokens, seconds, 'tok/s')} {format_rate(rows, seconds, 'row/s')} {format_duration(left)}"
