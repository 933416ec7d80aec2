"""Token counts: batch encoding inside an Arrow function that returns lengths only.

Batches are balanced by bytes, not rows. A text above ``piece_bytes`` is split at ASCII white
space, if the caller says by ``split_long`` that this is safe: it is for tokenizers whose pre-tokenizer drops
white space: no token, merge, added token or canonical composition then reaches across it. A long
run without white space stays whole.

Without ``split_long`` each text is encoded whole.

Null or empty texts count 0 tokens. Repeated rows are counted one by one. An empty table gives an
empty table. An input column with the name of the output column is replaced.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import bounded_batches, table, text_or_empty, tokenizer_path, without

_LOADED: dict[str, object] = {}


def _load(path: str):
    """One tokenizer for each Python worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def lengths(path: str, texts: list[str]) -> list[int]:
    """Tokens of each text, without begin, end or padding tokens."""
    model = _load(path)
    if path.endswith(".model"):
        return [len(x) for x in model.encode(texts, num_threads=1)]
    return [len(x.ids) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


_SPACE = re.compile(r"[ \t\r\n]")


def pieces(text: str, most: int) -> Iterator[str]:
    """text cut before white space into pieces of about most characters; joined they give text again."""
    start = 0
    while len(text) - start > most:
        if not (m := _SPACE.search(text, start + most)):
            break
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


def count_tokens(df: DataFrame, path: str, text_col: str = "text", out_col: str = "n_tokens", *, batch_bytes: int = 1 << 20, piece_bytes: int = 1 << 16, split_long: bool = False) -> DataFrame:
    """df with out_col: the number of tokens the library for the file at path gives the whole text."""

    bounded_batches(df.sparkSession)

    @F.arrow_udf("bigint")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            counts = [0] * len(batch)
            rows: list[int] = []
            parts: list[str] = []
            size = 0
            for i, value in enumerate(batch):
                text = value.as_py()
                for part in pieces(text, piece_bytes) if split_long else (text,):
                    rows.append(i)
                    parts.append(part)
                    size += len(part) if part.isascii() else len(part.encode("utf-8", "replace"))
                    if size >= batch_bytes:
                        for row, n in zip(rows, lengths(path, parts)):
                            counts[row] += n
                        rows, parts, size = [], [], 0
            if parts:
                for row, n in zip(rows, lengths(path, parts)):
                    counts[row] += n
            yield pa.array(counts, pa.int64())

    counted = without(df, out_col) if text_col.lower() != out_col.lower() else df
    return counted.withColumn(out_col, n_tokens(text_or_empty(text_col)))


def op1_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # This tokenizer drops white space before it merges.
    return count_tokens(docs, tokenizer_path("word_bpe_49k.json"), split_long=True).select(
        "doc_id",
        F.octet_length(text_or_empty()).cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 2048).alias("over_limit"),
    )
