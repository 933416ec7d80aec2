"""Views that make every rule fire, derived from the test tables alike in Spark and in SQL, over all their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.schema import MESSAGES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as code: doc_id, source, text, path; the id decides what is done to a text."""
    docs = table(spark, sf_dir, "documents")
    i, t = F.col("doc_id"), F.col("text")
    size = F.greatest(F.length(t), F.lit(1))
    text = (
        F.when(i % 20 == 3, F.replace(t, F.lit("\n"), F.lit(" ")))
        .when(i % 20 == 5, F.concat(t, F.lit("\npassword = hunter2")))
        .when(i % 20 == 7, F.concat(t, F.repeat(F.lit("\x01"), F.floor(F.length(t) / 10).cast("int") + 1)))
        .when(i % 20 == 9, F.regexp_replace(F.base64(F.encode(t, "UTF-8")), "[\r\n]", ""))
        .when(i % 20 == 15, F.repeat(F.lit(" "), F.lit(60)))
        .when(i % 100 == 19, F.repeat(F.concat(t, F.lit("\n")), F.floor(200001 / size).cast("int") + 1))
        .otherwise(t)
    )
    name = i.cast("string")
    path = (
        F.when(i % 20 == 3, F.concat(F.lit("web/app_"), name, F.lit(".min.js")))
        .when(i % 20 == 11, F.lit("pkg/package-lock.json"))
        .when(i % 20 == 17, F.concat(F.lit("src/m"), name, F.lit(".py")))
        .when((i % 20).isin(1, 13), F.concat(F.lit("src/m"), name, F.lit(".ts")))
    )
    return docs.select("doc_id", "source", text.alias("text"), path.alias("path"))


CODE_DOCS = """code_docs AS (
  SELECT doc_id, source,
    CASE WHEN doc_id % 20 = 3 THEN replace(text, chr(10), ' ')
         WHEN doc_id % 20 = 5 THEN text || chr(10) || 'password = hunter2'
         WHEN doc_id % 20 = 7 THEN text || repeat(chr(1), length(text) // 10 + 1)
         WHEN doc_id % 20 = 9 THEN to_base64(encode(text))
         WHEN doc_id % 20 = 15 THEN repeat(' ', 60)
         WHEN doc_id % 100 = 19 THEN repeat(text || chr(10), 200001 // greatest(length(text), 1) + 1)
         ELSE text END AS text,
    CASE WHEN doc_id % 20 = 3 THEN 'web/app_' || doc_id || '.min.js'
         WHEN doc_id % 20 = 11 THEN 'pkg/package-lock.json'
         WHEN doc_id % 20 = 17 THEN 'src/m' || doc_id || '.py'
         WHEN doc_id % 20 IN (1, 13) THEN 'src/m' || doc_id || '.ts' END AS path
  FROM documents)"""


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as rows of messages in turn order: conv_id, messages."""
    turns = table(spark, sf_dir, "conversations")
    item = F.struct("turn", F.col("role"), F.col("text").alias("content"))
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("xs"))
    return rows.select("conv_id", F.transform("xs", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).cast(MESSAGES).alias("messages"))


def raw_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as raw instruction rows: keys come and go with the id, some values are blank or empty."""
    docs = table(spark, sf_dir, "documents")
    i, t = F.col("doc_id"), F.col("text")
    return docs.select(
        "doc_id",
        F.when(i % 5 == 0, F.lit(" \t")).when(i % 5 == 1, t).alias("instruction"),
        F.when(i % 5 != 4, F.concat(F.lit("Q: "), F.substring(t, 1, 40))).alias("prompt"),
        F.when(i % 3 == 0, F.lit("")).when(i % 3 == 1, F.concat(F.lit("A: "), t)).alias("output"),
        F.when(i % 7 != 6, F.concat(F.lit("R: "), F.substring(t, 1, 60))).alias("response"),
        F.when(i % 4 != 3, F.concat(F.lit("def f():\n    return "), i.cast("string"))).alias("code"),
        F.when(i % 4 == 0, F.array().cast("array<string>")).when(i % 4 == 1, F.array(F.concat(F.lit("assert f() == "), i.cast("string")), F.lit("assert f()"))).alias("test_list"),
        F.when(i % 6 == 0, F.concat(F.lit('["'), i.cast("string"), F.lit('", "b"]')))
        .when(i % 6 == 1, F.lit("[]"))
        .when(i % 6 == 2, F.lit("print(1)"))
        .when(i % 6 == 3, F.lit("  "))
        .alias("solutions"),
        F.when(i % 6 != 4, F.concat(F.lit("S"), i.cast("string"))).alias("solution"),
    )


RAW_INSTRUCTIONS = """raw AS (
  SELECT doc_id,
    CASE WHEN doc_id % 5 = 0 THEN ' ' || chr(9) WHEN doc_id % 5 = 1 THEN text END AS instruction,
    CASE WHEN doc_id % 5 <> 4 THEN 'Q: ' || substr(text, 1, 40) END AS prompt,
    CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN 'A: ' || text END AS output,
    CASE WHEN doc_id % 7 <> 6 THEN 'R: ' || substr(text, 1, 60) END AS response,
    CASE WHEN doc_id % 4 <> 3 THEN 'def f():' || chr(10) || '    return ' || doc_id END AS code,
    CASE WHEN doc_id % 4 = 0 THEN []::VARCHAR[] WHEN doc_id % 4 = 1 THEN ['assert f() == ' || doc_id, 'assert f()'] END AS test_list,
    CASE WHEN doc_id % 6 = 0 THEN '["' || doc_id || '", "b"]' WHEN doc_id % 6 = 1 THEN '[]'
         WHEN doc_id % 6 = 2 THEN 'print(1)' WHEN doc_id % 6 = 3 THEN '  ' END AS solutions,
    CASE WHEN doc_id % 6 <> 4 THEN 'S' || doc_id END AS solution
  FROM documents)"""
