"""Raw rows of any schema to records: base texts and chat messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.functions.text import not_blank, strip
from loomspark.schema import MESSAGES, ORDINAL

# In which columns of a raw row a text is looked for, first match first.
BASE_KEYS = ["content", "code", "func_code_string", "whole_func_string", "text"]
PATH_KEYS = ["path", "file_name", "repo_name"]
PROMPT_KEYS = ["instruction", "prompt", "question", "input", "problem", "query", "user", "task"]
ANSWER_KEYS = ["output", "response", "answer", "completion", "solution", "assistant", "accepted_solution"]
MBPP_PROMPT_KEYS = ["text", "prompt", "task"]
MBPP_ANSWER_KEYS = ["code", "canonical_solution", "test_list"]
TACO_PROMPT_KEYS = ["question", "prompt", "statement"]
TACO_SOLUTION_KEYS = ["solutions", "solution", "answer", "output"]
ROLES = {"system": ["system"], "user": ["human", "user", "instruction", "prompt"], "assistant": ["gpt", "assistant", "model", "response", "output"]}
LANGUAGES = [("python", "_python", [".py"]), ("javascript", "_javascript", [".js", ".jsx"]), ("typescript", "_typescript", [".ts", ".tsx"])]

SYSTEM_PROMPT = "You are a helpful coding assistant."


def _fields(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _is_text_list(kind: T.DataType | None) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StringType, T.IntegralType, T.BooleanType))


def _joined(c: Column, sep: str = "\n") -> Column:
    return F.array_join(c.cast("array<string>"), sep)


def first_text(fields: dict[str, T.DataType], keys: list[str]) -> Column:
    """The first column of keys with a text that isn't blank, as it is; lists are joined by line breaks."""
    found = []
    for key in keys:
        kind, c = fields.get(key), F.col(f"`{key}`")
        if isinstance(kind, T.StringType):
            found.append(F.when(not_blank(c), c))
        elif _is_text_list(kind):
            found.append(F.when(not_blank(_joined(c)), _joined(c)))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def first_true(fields: dict[str, T.DataType], keys: list[str]) -> Column:
    """The first text of keys that is neither null nor empty."""
    found = [F.nullif(F.col(f"`{k}`"), F.lit("")) for k in keys if isinstance(fields.get(k), T.StringType)]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def infer_language(name: str, path: Column) -> Column:
    """By the ending of the source's name or of the path."""
    low = F.lower(F.coalesce(path, F.lit("")))
    case = None
    for language, ending, extensions in LANGUAGES:
        hit = F.lit(name.endswith(ending))
        for e in extensions:
            hit = hit | low.endswith(e)
        case = F.when(hit, language) if case is None else case.when(hit, language)
    return case


def normalize_role(role: Column) -> Column:
    """system, user or assistant; null for any other role."""
    low, case = F.lower(strip(role)), None
    for name, spellings in ROLES.items():
        hit = low.isin(spellings)
        case = F.when(hit, name) if case is None else case.when(hit, name)
    return case


def messages_record(prompt: Column, answer: Column, system_prompt: str = SYSTEM_PROMPT) -> Column:
    """Three messages, or null unless prompt and answer have text."""
    pairs = [("system", F.lit(system_prompt)), ("user", prompt), ("assistant", answer)]
    made = F.array(*[F.struct(F.lit(role).alias("role"), content.alias("content")) for role, content in pairs]).cast(MESSAGES)
    return F.when((F.coalesce(prompt, F.lit("")) != "") & (F.coalesce(answer, F.lit("")) != ""), made)


def _message(inner: dict[str, T.DataType]) -> Callable[[Column], Column]:
    """An item of a list of messages as role and content, whichever names its fields have."""

    def pick(item: Column, names: tuple[str, str]) -> Column:
        own = [F.nullif(item[n], F.lit("")) for n in names if isinstance(inner.get(n), T.StringType)]
        return F.coalesce(*own) if own else F.lit(None).cast("string")

    return lambda item: F.struct(normalize_role(pick(item, ("role", "from"))).alias("role"), pick(item, ("content", "value")).alias("content"))


def existing_messages(fields: dict[str, T.DataType], system_prompt: str = SYSTEM_PROMPT) -> Column:
    """The row's own messages or conversations with known roles and text; null without a user and an assistant."""
    lists = []
    for key in ("messages", "conversations"):
        kind = fields.get(key)
        if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)):
            continue
        inner = {f.name: f.dataType for f in kind.elementType.fields}

        c = F.col(f"`{key}`")
        kept = F.filter(F.transform(c, _message(inner)), lambda m: m["role"].isNotNull() & not_blank(m["content"]))
        lists.append(F.when(F.size(c) > 0, kept))
    if not lists:
        return F.lit(None).cast(MESSAGES)
    found = F.coalesce(*lists).cast(MESSAGES)
    system = F.array(F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content"))).cast(MESSAGES)
    led = F.when(F.get(found, F.lit(0))["role"] == "system", found).otherwise(F.concat(system, found))
    both = F.exists(found, lambda m: m["role"] == "user") & F.exists(found, lambda m: m["role"] == "assistant")
    return F.when(both, led)


def mbpp_messages(fields: dict[str, T.DataType], system_prompt: str = SYSTEM_PROMPT) -> Column:
    """A list of tests is put after the answer, even an empty one."""
    prompt, answer = first_text(fields, MBPP_PROMPT_KEYS), first_text(fields, MBPP_ANSWER_KEYS)
    if _is_text_list(fields.get("test_list")):
        tests = F.col("test_list")
        shown = F.array_join(tests.cast("array<string>"), "\n", "None")
        answer = F.when(tests.isNotNull(), strip(F.concat(F.coalesce(answer, F.lit("")), F.lit("\n\nTests:\n"), shown))).otherwise(answer)
    return messages_record(prompt, answer, system_prompt)


def first_solution(fields: dict[str, T.DataType], keys: list[str] | None = None) -> Column:
    """The first item of a list, or of a text that is a JSON list; any other text as it is."""
    found = []
    for key in keys or TACO_SOLUTION_KEYS:
        kind, c = fields.get(key), F.col(f"`{key}`")
        if isinstance(kind, T.StringType):
            found.append(F.when(not_blank(c), F.coalesce(F.get(F.from_json(c, "array<string>"), F.lit(0)), c)))
        elif _is_text_list(kind):
            found.append(F.when(F.size(c) > 0, F.coalesce(F.get(c.cast("array<string>"), F.lit(0)), F.lit("None"))))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def instruct_messages(fields: dict[str, T.DataType], name: str, system_prompt: str = SYSTEM_PROMPT) -> Column:
    """Existing messages, else the rule of the source's name, else prompt and answer columns."""
    if name.lower() == "mbpp":
        made = mbpp_messages(fields, system_prompt)
    elif name.lower() == "taco":
        made = messages_record(first_text(fields, TACO_PROMPT_KEYS), first_solution(fields), system_prompt)
    else:
        made = messages_record(first_text(fields, PROMPT_KEYS), first_text(fields, ANSWER_KEYS), system_prompt)
    return F.coalesce(existing_messages(fields, system_prompt), made)


def normalize(raw: DataFrame, name: str, kind: str, *, language: str | None = None, system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
    """Records of a source, with raw's ordinal columns; all of text and messages null where a row has none."""
    fields = _fields(raw)
    nothing, none_messages = F.lit(None).cast("string"), F.lit(None).cast(MESSAGES)
    if kind == "base":
        own = [F.lit(language)] if language else []
        own += [F.nullif(F.col("language"), F.lit(""))] if isinstance(fields.get("language"), T.StringType) else []
        inferred = infer_language(name, first_true(fields, PATH_KEYS[:2]))
        text, messages, path = first_text(fields, BASE_KEYS), none_messages, first_true(fields, PATH_KEYS)
        spoken = F.coalesce(*own, inferred)
    elif kind == "instruct":
        text, messages, path, spoken = nothing, instruct_messages(fields, name, system_prompt), nothing, nothing
    else:
        raise ValueError(f"unknown type {kind!r} of source {name}")
    ordinals = [F.col(c) for c in ORDINAL if c in fields]
    return raw.select(*ordinals, F.lit(kind).alias("type"), F.lit(name).alias("source"), text.alias("text"), spoken.cast("string").alias("language"), path.alias("path"), messages.alias("messages"))


def is_record() -> Column:
    """False for rows that could not be normalized."""
    return F.col("text").isNotNull() | F.col("messages").isNotNull()


def render(text: Column | None = None, messages: Column | None = None) -> Column:
    """The text that is filtered, hashed and tokenized: a base text, or marked messages one under the other."""
    text = F.col("text") if text is None else text
    messages = F.col("messages") if messages is None else messages
    parts = F.transform(messages, lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), m["content"]))
    return F.coalesce(text, F.array_join(parts, "\n"))


def public_sft(df: DataFrame) -> DataFrame:
    """What an instruction sample shows: messages and source."""
    return df.select("messages", "source")


