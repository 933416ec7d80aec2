"""Language identification in two steps: the family first, then the languages within it.

Features are the Hellinger-scaled counts of hashed byte trigrams of the lower-cased whole text, white
space for everything in ASCII that isn't a letter. Linear support vector machines (squared hinge,
trained here) decide between each two families by vote, then between each two languages of the winning
family. Their margins give the score.

The machines are fitted on the driver on a bounded sample: of each language the ``per_language``
labelled rows with the least hash of their id (all of them if there are fewer); only sparse feature
counts travel there. Ids pick the sample and are no input of a prediction.

A null text, or one without a letter, is ``und`` with score 0 and is never learned from. Rows with a null
language are only predicted. Without any labelled row all texts are ``und``; with one language each text with a letter
is that language. Repeated rows are predicted alike. Output columns replace input columns of the same
name; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import bounded_batches, free_name, table, text_or_empty, without

#: Fixed: languages by family. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "celtic": "ga gd cy br",
    "turkic": "tr az kk uz ky tk tt",
    "indo_aryan": "hi ur bn mr gu pa ne si",
    "semitic": "ar he mt am",
    "dravidian": "ta te kn ml",
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}
UNDETERMINED = "und"
SIZE = 1 << 13
CHUNK = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_A, _B, _C = (np.uint32(x) for x in (2654435761, 2246822519, 3266489917))
_SHIFT = np.uint32(19)


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


def features(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Numbers and scaled counts of the features that occur; None without a letter."""
    if not _LETTER.search(text):
        return None
    counts = np.zeros(SIZE)
    for at in range(0, len(text), CHUNK):  # two characters more, so that no trigram is lost at an edge
        b = _FOLD[np.frombuffer(f" {text[max(0, at - 2) : at + CHUNK]} ".lower().encode("utf-8", "replace"), np.uint8)]
        counts += np.bincount((b[:-2] * _A + b[1:-1] * _B + b[2:] * _C) >> _SHIFT, minlength=SIZE)
    at = np.flatnonzero(counts)
    return at, np.sqrt(counts[at] / counts.sum())


def fit_machine(x: np.ndarray, positive: np.ndarray, penalty: float = 1e-4, steps: int = 120) -> np.ndarray:
    """Weights (the last is the bias) by accelerated gradient descent on the squared hinge; classes weigh the same."""
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())).astype(np.float32)
    w, ahead, rate = (np.zeros(SIZE + 1, np.float32) for _ in range(3))
    rate = 1 / (2 * (2.0 + penalty))  # rows have norm 1 and a bias of 1
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead[:-1] + ahead[-1]))
        pull = share * y * slack
        step = ahead.copy()
        step[:-1] += rate * (2 * (pull @ x) - 2 * penalty * ahead[:-1])
        step[-1] += rate * 2 * pull.sum()
        w, ahead = step, step + (k / (k + 3)) * (step - w)
    return w.astype(np.float64)


class Model:
    """Machines between each two families, and between each two languages of a family."""

    def __init__(self, langs: list[str], x: np.ndarray, labels: np.ndarray):
        self.families: dict[str, list[str]] = {}
        for lang in sorted(langs):
            self.families.setdefault(family(lang), []).append(lang)
        kin = np.array([family(lang) for lang in labels])
        self.machines = {}
        for names, of in [(sorted(self.families), kin), *((members, labels) for members in self.families.values())]:
            for a, b in combinations(names, 2):
                rows = (of == a) | (of == b)
                self.machines[a, b] = fit_machine(x[rows], of[rows] == a)

    def _vote(self, names: list[str], at: np.ndarray, value: np.ndarray) -> tuple[str, float]:
        """The name with most votes, then the largest sum of margins, then the first; its least probability in a duel."""
        votes, sums, least = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, 1.0)
        for a, b in combinations(names, 2):
            w = self.machines[a, b]
            m = float(value @ w[at] + w[-1])
            votes[a if m >= 0 else b] += 1
            for name, own in ((a, m), (b, -m)):
                sums[name] += own
                least[name] = min(least[name], 1 / (1 + math.exp(-max(-30.0, min(30.0, 3 * own)))))
        best = max(names, key=lambda n: (votes[n], sums[n]))
        return best, least[best]

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text) if text and self.families else None
        if found is None:
            return UNDETERMINED, 0.0
        kin, sure = self._vote(sorted(self.families), *found)
        lang, inside = self._vote(self.families[kin], *found)
        return lang, sure * inside


def _sparse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.struct([("at", pa.binary()), ("value", pa.binary())])
    for batch in batches:
        found = [features(x.as_py()) for x in batch]
        yield pa.array([f and {"at": f[0].astype(np.uint16).tobytes(), "value": f[1].astype(np.float32).tobytes()} for f in found], kind)


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 800) -> Model:
    """A model from the rows of labelled whose language isn't null: at most per_language of each, so 4 * per_language * SIZE
    bytes a language on the driver (26 MB with the defaults)."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 40)).alias("h"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = F.lit(False)
    for lang, n in counts.items():  # a share that holds the wanted number with ease; the surplus goes below
        chosen = chosen | ((F.col("lang") == lang) & (F.col("h") < int((1 << 40) * min(1.0, (1.2 * per_language + 40) / n))))
    found = rows.where(chosen).select("h", "lang", F.arrow_udf(_sparse, "struct<at:binary,value:binary>").asNondeterministic()("text").alias("x")).where("x is not null").collect()
    taken: dict[str, list] = {}
    for r in sorted(found, key=lambda r: (r["lang"], r["h"], r["x"]["at"], r["x"]["value"])):
        if len(own := taken.setdefault(r["lang"], [])) < per_language:
            own.append(r["x"])
    x = np.zeros((sum(map(len, taken.values())), SIZE), np.float32)
    for row, f in zip(x, (f for own in taken.values() for f in own)):
        row[np.frombuffer(f["at"], np.uint16)] = np.frombuffer(f["value"], np.float32)
    return Model(list(taken), x, np.array([lang for lang, own in taken.items() for _ in own], dtype=object))


def identify(df: DataFrame, model: Model, text_col: str = "text", *, lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """df with the predicted language and its score."""
    bounded_batches(df.sparkSession)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([dict(zip(("lang", "score"), model.predict(x.as_py()))) for x in batch], kind)

    # Not deterministic to the optimizer, else a filter on the result would run it a second time.
    guess = F.arrow_udf(predicted, "struct<lang:string,score:double>").asNondeterministic()(text_or_empty(text_col))
    kept = without(df, lang_out, score_out)
    names = [f"`{c}`" for c in kept.columns]
    own = free_name(df.columns, "guess__")
    return df.select(*names, guess.alias(own)).select(*names, F.col(f"{own}.lang").alias(lang_out), F.col(f"{own}.score").alias(score_out))


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
