"""Tokenizers: a protocol, a character tokenizer in plain Column functions, and byte-pair files by Arrow."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Iterator
from pathlib import Path
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspark.functions.text import code_points

CHAT_TEMPLATE = "{% for message in messages %}<|{{ message['role'] }}|>\n{{ message['content'] }}\n{% endfor %}{% if add_generation_prompt %}<|assistant|>\n{% endif %}"
LEAST_MODEL_LENGTH = 8192


class Tokenizer(Protocol):
    """What a pipeline needs of a tokenizer. A new one implements these; nothing else changes."""

    source: str
    vocab_size: int
    eos_token_id: int

    def encode(self, text: Column) -> Column:
        """array<int> of ids, without special tokens."""

    def count(self, text: Column) -> Column:
        """bigint: how many ids encode gives."""

    def save(self, folder: str) -> None: ...


def dtype_of(vocab_size: int) -> str:
    return "uint16" if vocab_size < 65_536 else "uint32"


def encode_with_eos(tokenizer: Tokenizer, text: Column) -> Column:
    return F.concat(tokenizer.encode(text), F.array(F.lit(required_eos(tokenizer))))


def count_with_eos(tokenizer: Tokenizer, text: Column) -> Column:
    required_eos(tokenizer)
    return tokenizer.count(text) + F.lit(1).cast("bigint")


def required_eos(tokenizer: Tokenizer) -> int:
    if tokenizer.eos_token_id is None:
        raise ValueError("the tokenizer has no end-of-sequence token")
    return int(tokenizer.eos_token_id)


class CharTokenizer:
    """One token per character: its code point modulo 200, plus 2. Runs inside the JVM."""

    source, vocab_size, eos_token_id = "char", 256, 1

    def encode(self, text: Column) -> Column:
        return F.transform(code_points(text), lambda p: (p % 200 + 2).cast("int"))

    def count(self, text: Column) -> Column:
        return F.length(text).cast("bigint")

    def save(self, folder: str) -> None:
        Path(folder).mkdir(parents=True, exist_ok=True)
        (Path(folder) / "tokenizer.json").write_text(json.dumps({"kind": self.source, "vocab_size": self.vocab_size}))


_LOADED: dict[str, object] = {}


def _model(path: str):
    """One model in each Python worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Model

        _LOADED[path] = Model.from_file(path)
    return _LOADED[path]


class FileTokenizer:
    """A tokenizer.json file, or a folder that holds one, through the tokenizers library."""

    def __init__(self, path: str):
        file = os.path.join(path, "tokenizer.json") if os.path.isdir(path) else path
        self.source, self.file = path, file
        model = _model(file)
        self.vocab_size = model.get_vocab_size(with_added_tokens=True)
        settings = {}
        beside = os.path.join(os.path.dirname(file), "tokenizer_config.json")
        if os.path.isdir(path) and os.path.exists(beside):
            settings = json.loads(Path(beside).read_text())
        names = [settings.get(k) for k in ("eos_token", "sep_token", "pad_token")]
        names = [n["content"] if isinstance(n, dict) else n for n in names]
        found = [model.token_to_id(n) for n in [*names, "<|endoftext|>", "</s>"] if n]
        self.eos_token_id = next((i for i in found if i is not None), None)
        required_eos(self)
        self.pad_token_id = next((i for i in [model.token_to_id(names[2])] if i is not None), self.eos_token_id) if names[2] else self.eos_token_id
        self.chat_template = settings.get("chat_template") or CHAT_TEMPLATE
        self.model_max_length = max(LEAST_MODEL_LENGTH, min(int(settings.get("model_max_length", 0)), 1 << 30))

    def encode(self, text: Column) -> Column:
        file = self.file

        @F.arrow_udf("array<int>")
        def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = _model(file)
            for batch in batches:
                yield pa.array([x.ids for x in model.encode_batch_fast(batch.to_pylist(), add_special_tokens=False)], pa.list_(pa.int32()))

        return ids(F.coalesce(text, F.lit("")))

    def count(self, text: Column) -> Column:
        file = self.file

        @F.arrow_udf("bigint")
        def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = _model(file)
            for batch in batches:
                yield pa.array([len(x.ids) for x in model.encode_batch_fast(batch.to_pylist(), add_special_tokens=False)], pa.int64())

        return counts(F.coalesce(text, F.lit("")))

    def save(self, folder: str) -> None:
        Path(folder).mkdir(parents=True, exist_ok=True)
        _model(self.file).save(os.path.join(folder, "tokenizer.json"))


def load_tokenizer(path: str, fallback: str | None = None) -> Tokenizer:
    """path, else fallback; the name char is the character tokenizer."""
    for place in (path, fallback):
        if place == CharTokenizer.source:
            return CharTokenizer()
        if place and os.path.exists(place):
            return FileTokenizer(place)
    raise FileNotFoundError(f"there is no tokenizer at {path}, and no fallback")


def copy_tokenizer(path: str, folder: str, tokenizer: Tokenizer) -> str:
    """folder/tokenizer made anew (folder on the driver's disk): the tokenizer's folder as it is, or else saved."""
    target = Path(folder) / "tokenizer"
    if target.exists():
        shutil.rmtree(target)
    if os.path.isdir(path):
        shutil.copytree(path, target)
    else:
        tokenizer.save(str(target))
    return str(target)
