"""Branches of the normalizers and of the cascade, on rows written by hand."""

import hashlib
import json
import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspark.functions.text import entropy, lines, not_blank, rstrip, strip
from loomspark.operators import normalize as N
from loomspark.operators.dedup import canonical_hash, exact_dedup
from loomspark.operators.quality import reject_reason

ITEM = "array<struct<role:string,`from`:string,content:string,value:string>>"


def one(df):
    return df.collect()[0]


def reason(spark, text, path=None, language=None):
    df = spark.createDataFrame([(text, path, language)], "t string, p string, l string")
    return one(df.select(reject_reason(F.col("t"), F.col("l"), F.col("p"))))[0]


WORDS = "def add(a, b):\n    return a + b\n\n\nprint(add(1, 2))\n" * 3


@pytest.mark.parametrize(
    "text, path, language, want",
    [
        ("", None, None, "empty"),
        ("  \t　 \n", None, None, "empty"),
        ("a" * 49, None, None, "too_short"),
        ("ab cd" * 10, None, None, None),
        ("ab cd" * 40_000, None, None, None),
        ("ab cd" * 40_000 + "x", None, None, "too_long"),
        (WORDS, "a/yarn.lock", None, "lock_file"),
        (WORDS, "a/Yarn.lock", None, None),
        ("var a=1;" * 60, "x/app.JS", None, "minified"),
        ("var a=1;" * 60, "x/app.ts", None, None),
        ("var a=1;" * 60, None, "TypeScript", "minified"),
        (("var a=1;\n" * 20) + "y" * 501 + "\n", "a.css", None, None),
        (WORDS + "\x01" * 10, None, None, "weird_chars"),
        (WORDS + "😀" * 10, None, None, "weird_chars"),
        (WORDS + "\x00", None, None, "binary_or_base64"),
        ("".join(chr(65 + i % 26) + chr(97 + i * 7 % 26) + str(i % 10) for i in range(200)), None, None, "binary_or_base64"),
        ("abcd" * 100, None, None, None),
        (WORDS + "PassWord\xa0 = 'x'", None, None, "secret"),
        (WORDS + "-----BEGIN RSA PRIVATE KEY", None, None, "secret"),
        (WORDS + "paſsword=1", None, None, "secret"),
        (WORDS + "passwords = 1", None, None, None),
    ],
)
def test_reasons(spark, text, path, language, want):
    assert reason(spark, text, path, language) == want


def instruct(spark, schema, row, name="any"):
    df = spark.createDataFrame([row], schema)
    m = one(N.normalize(df, name, "instruct")).messages
    return None if m is None else [(x.role, x.content) for x in m]


def test_existing_messages(spark):
    S = ("system", N.SYSTEM_PROMPT)
    chat = [("user", None, "hi", None), (None, " GPT ", None, "yo"), ("tool", None, "x", None), ("user", None, "  ", None), ("system", None, "late", None)]
    assert instruct(spark, f"messages {ITEM}", (chat,)) == [S, ("user", "hi"), ("assistant", "yo"), ("system", "late")]
    assert instruct(spark, f"messages {ITEM}, conversations {ITEM}", ([], chat))[1] == ("user", "hi")
    assert instruct(spark, f"messages {ITEM}", ([("system", None, "s", None), ("human", None, "q", None), ("model", None, "a", None)],)) == [("system", "s"), ("user", "q"), ("assistant", "a")]
    assert instruct(spark, f"messages {ITEM}", ([("user", None, "q", None)],)) is None
    assert instruct(spark, f"messages {ITEM}, prompt string, answer string", ([("user", None, "q", None)], "p", "a")) == [S, ("user", "p"), ("assistant", "a")]


def test_mbpp_and_taco(spark):
    def answer(schema, row, name):
        m = instruct(spark, schema, row, name)
        return m and m[2][1]

    mbpp = "text string, code string, test_list array<string>"
    assert answer(mbpp, ("p", "c", ["t1", "t2"]), "MBPP") == "c\n\nTests:\nt1\nt2"
    assert answer(mbpp, ("p", "c", []), "mbpp") == "c\n\nTests:"
    assert answer(mbpp, ("p", None, ["t"]), "mbpp") == "t\n\nTests:\nt"
    assert answer(mbpp, ("p", "c ", None), "mbpp") == "c "
    taco = "question string, solutions string, solution string"
    assert answer(taco, ("q", '["one", "two"]', None), "taco") == "one"
    assert answer(taco, ("q", "[]", "s"), "Taco") == "[]"
    assert answer(taco, ("q", "print(1", None), "taco") == "print(1"
    assert answer(taco, ("q", " ", "s"), "taco") == "s"
    assert answer(taco, ("q", None, None), "taco") is None
    assert answer("prompt string, solutions array<string>", ("q", ["x", "y"]), "taco") == "x"


def test_base_rows(spark):
    schema = "content string, code array<string>, text string, language string, path string, file_name string"
    rows = [(" ", ["a", None, "b"], "t", "", "", "x/y.JSX"), (None, [], "t ", "Go", "p", None), (None, None, " ", None, None, None)]
    got = N.normalize(spark.createDataFrame(rows, schema), "s", "base").collect()
    assert [(r.text, r.language, r.path) for r in got] == [("a\nb", "javascript", "x/y.JSX"), ("t ", "Go", "p"), (None, None, None)]
    assert one(N.normalize(spark.createDataFrame([("t",)], "text string"), "lang_python", "base")).language == "python"
    with pytest.raises(ValueError):
        N.normalize(spark.createDataFrame([("t",)], "text string"), "s", "other")


def py_hash(text):
    return hashlib.sha256("\n".join(x.rstrip() for x in text.strip().splitlines()).encode()).hexdigest()


def py_entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values()) if text else 0.0


TEXTS = st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(" \t\n\r\x0b\x0c\x1c\x85\xa0   　"), max_size=40)


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXTS, min_size=40, max_size=60))
def test_unicode_like_python(spark, texts):
    t = F.col("t")
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    got = df.select("t", strip(t).alias("s"), rstrip(t).alias("r"), not_blank(t).alias("b"), canonical_hash(t).alias("h"), entropy(t).alias("e"), lines(t).alias("l")).collect()
    for r in got:
        assert (r.s, r.r, r.b, r.h) == (r.t.strip(), r.t.rstrip(), bool(r.t.strip()), py_hash(r.t))
        assert abs(r.e - py_entropy(r.t)) < 1e-9
        assert [x for x in r.l if x] == [x for x in r.t.splitlines() if x]


def test_dedup_against_seen(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a "), (3, "b"), (4, None)], "i int, t string")
    seen = spark.createDataFrame([(py_hash("b"),)], "hash string")
    got = {r.i: r.is_dup for r in exact_dedup(df, F.col("t"), ["i"], seen).collect()}
    assert got[1] is False and got[2] is True and got[3] is True


def test_json_line(spark):
    from loomspark.sinks.shards import json_line

    df = spark.createDataFrame([([("user", "é/\"")], "s")], "messages array<struct<role:string,content:string>>, source string")
    line = one(df.select(json_line().alias("x"))).x
    assert line == json.dumps({"messages": [{"role": "user", "content": 'é/"'}], "source": "s"}, ensure_ascii=False, separators=(",", ":"))
