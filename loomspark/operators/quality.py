"""The quality cascade: the first rule that a rendered text breaks is its reject reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspark.functions.text import WS, base_name, entropy, lines, not_blank

# Limits, names and patterns on which results depend.
MIN_CHARS, MAX_CHARS = 50, 200_000
LOCK_FILES = ["package-lock.json", "yarn.lock", "pnpm-lock.yaml"]
MINIFIED_LANGUAGES = ["javascript", "typescript", "css"]
MINIFIED_ENDINGS = [".js", ".css"]
MAX_MEAN_LINE, LONG_LINE, MAX_LONG_SHARE = 300, 500, 0.2
MAX_WEIRD_SHARE = 0.02
SAMPLE_CHARS, LEAST_COMPACT, MAX_BASE64_SHARE, MAX_ENTROPY = 8192, 256, 0.97, 4.5
SECRETS = ["AWS_SECRET_ACCESS_KEY", "PRIVATE KEY", f"api_key[{WS}]*=", f"password[{WS}]*="]

WEIRD = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x{10000}-\x{10ffff}]"
BASE64 = r"[\p{L}\p{N}+/=]"


def weird_share(text: Column) -> Column:
    """Share of control characters and of characters beyond U+FFFF; 1 for the empty text."""
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(WEIRD)) / F.length(text)).otherwise(1.0)


def is_weird(text: Column) -> Column:
    return weird_share(text) > MAX_WEIRD_SHARE


def line_stats(text: Column) -> tuple[Column, Column, Column]:
    """Of the lines that aren't blank: how many, their mean length, the share of long ones."""
    sizes = F.transform(F.filter(lines(text), not_blank), lambda x: F.length(x).cast("bigint"))
    n = F.size(sizes)
    total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x)
    long_ = F.size(F.filter(sizes, lambda x: x > LONG_LINE))
    return n, F.when(n > 0, total / n).otherwise(0.0), F.when(n > 0, long_ / n).otherwise(0.0)


def is_minified(text: Column, language: Column, path: Column) -> Column:
    low = F.lower(F.coalesce(path, F.lit("")))
    ending = F.lit(False)
    for e in MINIFIED_ENDINGS:
        ending = ending | low.endswith(e)
    meant = F.lower(F.coalesce(language, F.lit(""))).isin(MINIFIED_LANGUAGES) | ending
    n, mean, share = line_stats(text)
    return F.when(meant, (n > 0) & ((mean > MAX_MEAN_LINE) | (share > MAX_LONG_SHARE))).otherwise(False)


def compact_sample(text: Column) -> Column:
    return F.regexp_replace(F.substring(text, 1, SAMPLE_CHARS), f"[{WS}]+", "")


def base64_share(compact: Column) -> Column:
    return F.when(F.length(compact) > 0, F.regexp_count(compact, F.lit(BASE64)) / F.length(compact)).otherwise(0.0)


def is_binary_or_base64(text: Column) -> Column:
    """A NUL in the sample, or nearly only base64 characters that are spread widely. Entropy comes last: it costs most."""
    compact = compact_sample(text)
    nul = F.instr(F.substring(text, 1, SAMPLE_CHARS), "\0") > 0
    packed = F.when((F.length(compact) >= LEAST_COMPACT) & (base64_share(compact) > MAX_BASE64_SHARE), entropy(compact) > MAX_ENTROPY).otherwise(False)
    return F.when(nul, True).otherwise(packed)


def has_secret(text: Column) -> Column:
    return text.rlike("(?iu)" + "|".join(SECRETS))


def reject_reason(text: Column, language: Column, path: Column) -> Column:
    """Null for a text to keep. Cheap rules come first, and a CASE stops at the first that holds."""
    return (
        F.when(~not_blank(text), "empty")
        .when(F.length(text) < MIN_CHARS, "too_short")
        .when(F.length(text) > MAX_CHARS, "too_long")
        .when(base_name(F.coalesce(path, F.lit(""))).isin(LOCK_FILES), "lock_file")
        .when(is_minified(text, language, path), "minified")
        .when(is_weird(text), "weird_chars")
        .when(is_binary_or_base64(text), "binary_or_base64")
        .when(has_secret(text), "secret")
    )
