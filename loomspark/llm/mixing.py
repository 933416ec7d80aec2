"""Mixing to target weights by soft membership: DataFrame and SQL functions only.

1. A classifier is fitted on a labelled table: whole words, and beginnings of words, that a domain's documents surely hold
   far more often than the others' in the same language form that domain's lexicons in that language, by document
   frequency. A word counts by itself if it is in a lexicon, else by its beginning, in documents of its language; without a
   known language (or without the column) the lexicons of all languages count. Of marks, capitals and digits only the density counts,
   in few steps. A naive Bayes model, multinomial over the kinds of words and categorical over the steps, gives each
   document's posterior probability of each domain. The fit reads at most about ``sample`` labelled rows (chosen by a hash of their id);
   the lexicons hold at most ``lexicon`` words and as many beginnings a domain and language, so all that is carried into the plan is bounded.
2. Each document has a rate, how often it shall be used, at first 1. Projected gradient descent fits
   nonnegative rates so that the expected tokens of each domain (rate x tokens x posterior) match the targets:
   least squares, in the metric that the domains' own spread gives, documents weighted by length. An
   iteration is one aggregate over a narrow stored table; the rate is an expression of the few
   gradients so far, so nothing per document is kept between iterations.

Tokens are white-space-separated words. Null or empty texts have no tokens, the prior as posterior and the
rate of that. Null ids are allowed (they are never labelled). Repeated rows are documents of their own; a document with several
labels counts once for each. A target for a domain without labelled rows is an error. Without any labelled row
all rates are 1. An empty table gives an empty table. Input columns with the name of an output column are replaced.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.llm.common import Stored, table, text_or_empty, without

#: What separates words here: in ASCII all but letters and digits.
_BREAK = r"[\x00-/:-@\[-`{-\x7f]+"
#: A domain's lexicon in tiers, by how many times as often its documents hold a word as the others do.
TIERS = (4.0, 16.0, 64.0)
#: Letters of a beginning, which is written with a star, and how sure (in standard errors) an entry's odds must be.
BEGINNING, SURE = 5, 1.64
#: Patterns that count by their matches a word, and the steps of that after 0; a last step is open.
STEPS = (0.01, 0.1)
_PATTERNS = {"marks": r"[#$%&*|!<>{}=]", "capitals": r"[A-Z]{3}", "digits": r"[0-9]+"}


def n_tokens(text: Column) -> Column:
    return F.when(F.trim(text) == "", 0).otherwise(F.regexp_count(text, F.lit(r"\S+"))).cast("bigint")


def _words(text: Column) -> Column:
    return F.split(F.lower(text), _BREAK)


def _lang(df: DataFrame) -> Column:
    return F.col("lang").cast("string") if "lang" in df.columns else F.lit(None).cast("string")


def _start(word: Column) -> Column:
    return F.substring(word, 1, BEGINNING)


def _forms(words: Column) -> Column:
    """Words and their beginnings, each once."""
    return F.array_distinct(F.concat(words, F.transform(F.filter(words, lambda w: F.length(w) >= BEGINNING), lambda w: F.concat(_start(w), F.lit("*")))))


def _entries(hits: Column, entries: set[str]) -> Column:
    """What counts of hits: the word, if it is an entry, else its beginning."""
    words, starts = sorted(e for e in entries if not e.endswith("*")), sorted(e[:-1] for e in entries if e.endswith("*"))
    entry = lambda w: F.when(w.isin(words), w).when(_start(w).isin(starts), F.concat(_start(w), F.lit("*")))
    return F.filter(F.transform(hits, entry), lambda e: e.isNotNull())


def _kinds(df: DataFrame, text: Column, lexicons: dict[str, dict[str, list[str]]]) -> DataFrame:
    """df with kinds__: counts of lexicon entries by kind, of the other words, and a 1 at each pattern's step."""
    of: dict[str, set[str]] = {}
    for by_lang in lexicons.values():
        for lang, own in by_lang.items():
            of.setdefault(lang, set()).update(own)
    known = set().union(*of.values())
    words, starts = sorted(e for e in known if not e.endswith("*")), sorted(e[:-1] for e in known if e.endswith("*"))
    df = df.withColumn("words__", _words(text)).withColumn("total__", F.size("words__"))
    df = df.withColumn("hits__", F.filter("words__", lambda w: w.isin(words) | _start(w).isin(starts)) if known else F.array().cast("array<string>"))
    per = F.greatest(F.col("total__"), F.lit(1))
    for name, p in _PATTERNS.items():
        df = df.withColumn(f"{name}__", F.regexp_count(text, F.lit(p)) / per)
    df = df.drop("words__")

    def by_language(made) -> Column:
        found = F.when(F.lit(False), made(None))
        for lang in sorted(of):
            found = found.when(_lang(df) == lang, made(lang))
        return found.otherwise(made(None))

    df = df.withColumn("hits__", by_language(lambda lang: _entries(F.col("hits__"), known if lang is None else of[lang])))
    among = lambda own: F.size(F.filter("hits__", lambda e: e.isin(own))) if own else F.lit(0)
    counts = [by_language(lambda lang, b=b: among(sorted(set().union(*b.values()) if lang is None else b.get(lang, [])))) for b in lexicons.values()]
    steps = []
    for name in _PATTERNS:
        step = F.when(F.col(f"{name}__") == 0, 0)
        for i, most in enumerate(STEPS):
            step = step.when(F.col(f"{name}__") <= most, i + 1)
        steps += [step.otherwise(len(STEPS) + 1) == i for i in range(len(STEPS) + 2)]
    other = F.col("total__") - F.size("hits__")
    made = df.withColumn("kinds__", F.array(*[c.cast("double") for c in (*counts, other, *steps)]))
    return made.drop("total__", "hits__", *(f"{name}__" for name in _PATTERNS))


class Classifier:
    """Lexicons and log probabilities: plain numbers that become literals of a plan."""

    def __init__(self, domains: list[str], lexicons: dict[str, dict[str, list[str]]], log_prior: list[float], log_share: list[list[float]]):
        self.domains, self.lexicons, self.log_prior, self.log_share = domains, lexicons, log_prior, log_share

    @classmethod
    def fit(cls, df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", sample: int = 6000, lexicon: int = 160, least_docs: int = 8) -> Classifier:
        """labels: (id_col, domain_col). The chosen labels, at most about sample, are broadcast to the texts."""
        rows = labels.select(F.col(id_col).alias("id"), F.col(domain_col).alias("domain")).where("id is not null and domain is not null").distinct()
        count = {r["d"]: r["n"] for r in rows.groupBy(F.col("domain").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
        domains = sorted(count)
        if not domains:
            return cls([], {}, [], [])
        each = sample / max(1, len(domains))
        place = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
        take = F.lit(False)
        for d in domains:
            take = take | ((F.col("domain") == d) & (place < int((1 << 40) * min(1.0, each / count[d]))))
        texts = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), F.coalesce(_lang(df), F.lit("")).alias("lang"))
        some = Stored(texts.join(F.broadcast(rows.where(take)), "id").select("text", "domain", "lang"), "mixing-sample", native=True)
        inside = [F.sum((F.col("domain") == d).cast("bigint")) for d in domains]
        docs = some.df().groupBy("lang").agg(*[x.alias(f"of{i}") for i, x in enumerate(inside)])  # a row for each language of the sample
        seen = some.df().select("lang", "domain", F.explode(_forms(_words(F.col("text")))).alias("word")).where("word <> ''")
        by_word = seen.groupBy("lang", "word").agg(*[x.alias(f"in{i}") for i, x in enumerate(inside)])
        by_word = Stored(by_word.where(F.greatest(*[F.col(f"in{i}") for i in range(len(domains))], F.lit(0)) >= least_docs).join(F.broadcast(docs), "lang"), "mixing-words", native=True)
        lexicons: dict[str, dict[str, list[str]]] = {f"{d}/{j}{star}": {} for star in ("", "*") for d in domains for j in range(len(TIERS))}
        rest = lambda what, i: sum((F.col(f"{what}{k}") for k in range(len(domains)) if k != i), F.lit(0))
        found = []
        for i, d in enumerate(domains):
            share = (F.col(f"in{i}") + 0.5) / (F.col(f"of{i}") + 1.0)
            odds = F.log(share / ((rest("in", i) + 0.5) / (rest("of", i) + 1.0))) - SURE * F.sqrt(1 / (F.col(f"in{i}") + 0.5) + 1 / (rest("in", i) + 0.5))
            own = by_word.df().where(F.col(f"in{i}") >= least_docs).select("lang", "word", F.lit(d).alias("domain"), odds.alias("odds"), (odds * share).alias("worth"))
            found.append(own.where(F.col("odds") >= math.log(TIERS[0])).withColumn("star", F.when(F.col("word").endswith("*"), "*").otherwise("")))
        best = Window.partitionBy("lang", "domain", "star").orderBy(F.desc("worth"), "word")  # no more words than the sample has
        for row in functools.reduce(DataFrame.union, found).withColumn("place", F.row_number().over(best)).where(F.col("place") <= lexicon).orderBy("lang", "domain", "star", "place").collect():
            tier = sum(row["odds"] >= math.log(t) for t in TIERS) - 1
            lexicons[f"{row['domain']}/{tier}{row['star']}"].setdefault(row["lang"], []).append(row["word"])
        kinds = _kinds(some.df(), F.col("text"), lexicons)
        sizes = [len(lexicons) + 1, *[len(STEPS) + 2] * len(_PATTERNS)]
        sums = {r["domain"]: [r[f"k{j}"] for j in range(sum(sizes))] for r in kinds.groupBy("domain").agg(*[F.sum(F.col("kinds__")[j]).alias(f"k{j}") for j in range(sum(sizes))]).collect()}
        shares = []
        for d in domains:
            own = iter(x + 0.5 for x in sums.get(d, [0.0] * sum(sizes)))
            groups = [[next(own) for _ in range(n)] for n in sizes]  # words, then each pattern: in each the shares add up to 1
            shares.append([math.log(x / sum(g)) for g in groups for x in g])
        all_rows = sum(count.values())
        some.drop()
        by_word.drop()
        return cls(domains, lexicons, [math.log(count[d] / all_rows) for d in domains], shares)

    def posteriors(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """df with posterior__: an array with the probability of each domain."""
        df = _kinds(df, text_or_empty(text_col), self.lexicons)
        logs = [F.lit(p) + sum((F.col("kinds__")[j] * F.lit(w) for j, w in enumerate(ws)), F.lit(0.0)) for p, ws in zip(self.log_prior, self.log_share)]
        df = df.withColumn("logs__", F.array(*logs)).withColumn("top__", F.array_max("logs__"))
        df = df.withColumn("exp__", F.array(*[F.exp(F.col("logs__")[i] - F.col("top__")) for i in range(len(logs))]))
        total = sum((F.col("exp__")[i] for i in range(len(logs))), F.lit(0.0))
        return df.withColumn("posterior__", F.array(*[F.col("exp__")[i] / total for i in range(len(logs))])).drop("kinds__", "logs__", "top__", "exp__")


def _solve(a: list[list[float]], b: list[float]) -> list[float]:
    """x with a x = b, for the few domains there are; a tiny ridge keeps a domain without tokens harmless."""
    n = len(b)
    ridge = 1e-9 * max([a[i][i] for i in range(n)], default=0.0) + 1e-12
    m = [[*(x + (ridge if i == j else 0.0) for j, x in enumerate(row)), b[i]] for i, row in enumerate(a)]
    for i in range(n):
        p = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[p] = m[p], m[i]
        for r in range(n):
            if r != i:
                f = m[r][i] / m[i][i]
                m[r] = [x - f * y for x, y in zip(m[r], m[i])]
    return [m[i][n] / m[i][i] for i in range(n)]


def rate_column(steps: list[list[float]], posterior: Column) -> Column:
    """The rate after these gradients: from 1, each a step and a projection onto the nonnegative numbers."""
    rate = F.lit(1.0)
    for step in steps:
        rate = F.greatest(F.lit(0.0), rate + sum((posterior[i] * F.lit(x) for i, x in enumerate(step)), F.lit(0.0)))
    return rate


def fit_rates(scored: DataFrame, domains: list[str], weights: dict[str, float] | None, *, tokens: float | None = None, floor: dict[str, float] | None = None, rounds: int = 24, tolerance: float = 1e-4) -> tuple[list[list[float]], dict]:
    """Gradients for rate_column, and a report. scored: n__ (tokens) and posterior__.

    weights: share of the tokens for each domain; None keeps the shares that the documents have, less
    the domains that floor sets to something else. tokens: total to reach; by default what is there in
    domains with a positive weight.
    """
    k = len(domains)
    p = [F.col("posterior__")[i] for i in range(k)]
    n = F.col("n__").cast("double")
    spread = scored.agg(*[F.sum(n * p[i]).alias(f"t{i}") for i in range(k)], *[F.sum(n * p[i] * p[j]).alias(f"s{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    have = [spread[f"t{i}"] or 0.0 for i in range(k)]
    if weights is None:
        weights = {d: (floor or {}).get(d, x) for d, x in zip(domains, have)}
    if unknown := {d for d, w in weights.items() if w and d not in domains}:
        raise ValueError(f"no labelled rows of {sorted(unknown)}")
    share = [max(0.0, weights.get(d, 0.0)) for d in domains]
    if tokens is None:
        tokens = sum(x for x, w in zip(have, share) if w > 0)
    target = [tokens * w / (sum(share) or 1.0) for w in share]
    metric = [[spread[f"s{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)]
    steps: list[list[float]] = []
    reached = have
    for _ in range(rounds):
        if sum(abs(t - r) for t, r in zip(target, reached)) <= tolerance * max(1.0, sum(target)):
            break
        steps.append(_solve(metric, [t - r for t, r in zip(target, reached)]))
        rate = rate_column(steps, F.col("posterior__"))
        sums = scored.select("n__", "posterior__", rate.alias("rate__")).agg(*[F.sum(n * p[i] * F.col("rate__")).alias(f"t{i}") for i in range(k)]).first()
        reached = [sums[f"t{i}"] or 0.0 for i in range(k)]
    return steps, {"domains": domains, "have": have, "target": target, "reached": reached, "rounds": len(steps)}


def mix(df: DataFrame, labels: DataFrame, weights: dict[str, float] | None, *, floor: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", tokens: float | None = None, carry: list[str] | None = None, prefix: str = "", **fit: int) -> DataFrame:
    """df (columns carry, by default all but the text) with n_tokens, p_<domain>, rate and copies, each name behind prefix.

    copies is the rate rounded down or up, by a hash of id and tokens, so that its expectation is the rate.
    """
    model = Classifier.fit(df, labels, id_col=id_col, text_col=text_col, **fit)
    out = [f"{prefix}{x}".lower() for x in ("n_tokens", *(f"p_{d}" for d in model.domains), "rate", "copies")]
    carry = [c for c in (carry or [c for c in df.columns if c != text_col]) if c.lower() not in out]
    slim = df.select(*[F.col(f"`{c}`").alias(f"own__{i}") for i, c in enumerate(carry)], text_or_empty(text_col).alias("text"), F.col(f"`{id_col}`").alias("id__"), _lang(df).alias("lang"))
    slim = slim.withColumn("n__", n_tokens(F.col("text")))
    steps: list[list[float]] = []
    if model.domains:
        scored = Stored(model.posteriors(slim, "text").drop("text", "lang"), "mixing-scored", native=True).df()
        steps, _ = fit_rates(scored, model.domains, weights, tokens=tokens, floor=floor)
    else:
        scored = slim.drop("text", "lang").withColumn("posterior__", F.array().cast("array<double>"))
    dice = F.pmod(F.xxhash64("id__", "n__"), F.lit(1 << 30)) / float(1 << 30)
    rated = scored.withColumn("rate__", rate_column(steps, F.col("posterior__")))
    return rated.select(
        *[F.col(f"own__{i}").alias(c) for i, c in enumerate(carry)],
        F.col("n__").alias(f"{prefix}n_tokens"),
        *[F.col("posterior__")[i].alias(f"{prefix}p_{d}") for i, d in enumerate(model.domains)],
        F.col("rate__").alias(f"{prefix}rate"),
        F.floor(F.col("rate__") + dice).cast("bigint").alias(f"{prefix}copies"),
    )


def quality_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a table of labels: toxic, or else high or low by quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain"))


def op9_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text", "lang")
    return mix(docs, quality_domains(table(spark, sf_dir, "labels")), {"high": 0.8, "low": 0.2, "toxic": 0.0}, carry=["doc_id", "source"])
