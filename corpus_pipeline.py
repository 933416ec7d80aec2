"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of docs. Documents with a null text or
without a letter go in the first stage, no others. Rows with the same id are one document: in the second stage the one with the
least text stays (of equal texts, the least by the other columns, which must be orderable). Rows with a null id are never
grouped and all pass the second stage. Long texts go through whole. An empty table passes as an empty table; extra
columns are carried with their values, whatever their names, to the last stage, which names its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm import language_id, minhash, mixing, pii, sentencepiece_viterbi
from loomspark.llm.common import Stored, free_name, table, tokenizer_path

def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: texts without a language go; a null lang becomes the predicted one."""
    names = [f"`{c}`" for c in docs.columns]
    model = language_id.fit(docs)
    lang = free_name(docs.columns, "lang_pred__")
    found = language_id.identify(docs, model, lang_out=lang, score_out=free_name([*docs.columns, lang], "score__"))
    found = found.where(F.col(lang) != language_id.UNDETERMINED)
    return found.withColumn("lang", F.coalesce("lang", lang)).select(*names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: the document with the smallest id of each group stays; of rows with the same id the least, by text
    and then by the other columns. Rows with a null id stay, each of them."""
    names = [f"`{c}`" for c in docs.columns]
    gone = minhash.near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id").distinct()
    repeated = Stored(docs.groupBy("doc_id").count().where("doc_id is not null and count > 1").select("doc_id"), "pipeline-repeated").df()
    left = docs.join(gone, "doc_id", "left_anti")
    once = left.join(repeated, "doc_id", "left_anti").select(*names)
    # An aggregate combines before the shuffle, so an id with any share of the rows is no burden.
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = F.struct(F.col("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    least = left.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(row).alias("x"))
    least = least.select("doc_id", F.col("x.text").alias("text"), *[F.col(f"x.c{i}").alias(c) for i, c in enumerate(rest)])
    return once.unionByName(least)


def replace_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: texts with pseudonyms in place of personal data; n_chars follows the text."""
    names = [f"`{c}`" for c in docs.columns]
    done = pii.pseudonymize(docs, pii.default_key(), count_prefix=None)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*names)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: no toxic tokens, the other domains at the shares they have; what has a rate below a half goes."""
    names = [f"`{c}`" for c in docs.columns]
    domains = mixing.quality_domains(table(spark, sf_dir, "labels"))
    prefix = "mix__"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    rated = mixing.mix(docs, domains, None, floor={"toxic": 0.0}, carry=docs.columns, prefix=prefix)
    return rated.where(F.col(f"{prefix}rate") >= 0.5).select(*names)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: ids of each whole text, and whether decoding gives the text back."""
    coded = sentencepiece_viterbi.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path("piece_bpe_32k.model"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_ids"), "ids", "round_trip")


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", drop_near_duplicates),
    ("pii", replace_private_data),
    ("mixing", mix_domains),
    ("sentencepiece", encode_pieces),
]
#: Stages of DataFrame and SQL operations only, their result's files included.
NATIVE = ("mixing",)
#: Learned models, hashing and tokenizers aren't SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        done = Stored(stage(spark, docs, sf_dir), f"pipeline-{name}", native=name in NATIVE)
        if last is not None:
            last.drop()
        docs, last = done.df(), done
    return docs
