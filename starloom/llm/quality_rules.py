"""Quality rules with risk-controlled thresholds.

Each rule rejects documents on one side of a cutoff of one rate. The cutoffs are
not set by hand: per stratum (the language) labelled good documents decide. A fifth
of them, by a hash of the key, puts the steps of all rules' grids into one
sequence: those first that reject the fewest of this fifth, lenient ones before strict ones.
The other four fifths test the sequence: step after step is taken while an exact binomial
test shows that all rules together reject at most ``risk`` of the good documents. The
order does not depend on the documents that test it, so the tests of a stratum share one
error level; strata divide ``error`` (Bonferroni). Hence, with probability
``1 - error``, no stratum loses more than ``risk`` of its good documents to the rules. A stratum with
too few labels gets no cutoff, and its documents pass: with 4 strata it takes 217
labelled good documents to test (some 271 in all), with 10 strata 263 (329), with 100 377 (471).

Labels are counted per stratum and first rejecting cutoffs before anything is gathered:
a stratum has at most as many rows as there are combinations of cutoffs. Cases: a null or empty text has zero counts and fails the base
rules; a null stratum is a stratum of its own; a document labelled more than once
is good only if all its labels say so; repeated documents are judged, and counted
as labelled rows, one by one; columns of the input named like ours are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import Tables, fresh_name, release
from .text import measures

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _measured(text: Column) -> Column:
    @F.pandas_udf(", ".join(f"{c} long" for c in MEASURES))
    def each(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release()
        for batch in texts:
            yield pd.DataFrame([measures(t) for t in batch], columns=MEASURES, dtype="int64")
        release()

    return each(text)


@dataclass(frozen=True)
class Rule:
    """Reject if ``part`` exceeds ``cutoff * whole`` (``below``: falls short of it)."""

    name: str
    part: str
    whole: str
    cutoffs: tuple[float, ...]  # from lenient to strict
    below: bool = False

    def rejects(self, cutoff: Column | float, of: str) -> Column:
        part, bound = F.col(f"{of}.{self.part}"), F.col(f"{of}.{self.whole}") * cutoff
        return part < bound if self.below else part > bound


RULES = (
    Rule("symbols", "n_symbols", "n_words",
         (3.0, 2.5, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05)),
    Rule("dup_lines", "n_dup_lines", "n_lines",
         (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("repeats", "n_repeat_words", "n_words",
         (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("long_words", "word_chars", "n_words",
         (40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0, 7.0)),
    Rule("short_words", "word_chars", "n_words",
         (1.1, 1.3, 1.5, 1.75, 2.0, 2.25, 2.5, 2.75, 3.0, 3.25, 3.5), below=True),
)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p); sums from k down until terms no longer count."""
    if k < 0:
        return 0.0
    if k >= n:
        return 1.0
    log_term = (
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
        + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    total, ratio, i = 0.0, 1.0, k
    while i >= 0 and (ratio > 1e-17 * total or ratio >= 1):
        total += ratio
        ratio *= i * (1 - p) / ((n - i + 1) * p)
        i -= 1
    return min(1.0, math.exp(log_term) * total)


def choose_cutoff(cutoffs, rejected, n: int, risk: float, error: float) -> float | None:
    """The strictest cutoff that the tests in sequence accept, or None."""
    chosen = None
    for cutoff, k in zip(cutoffs, rejected, strict=True):
        # far above the risk no test can pass, and its sum would be long
        if k > risk * n or binomial_cdf(int(k), int(n), risk) > error:
            break
        chosen = cutoff
    return chosen


def choose_together(lengths, firsts, counts, orders, risk: float, error: float) -> list[int]:
    """How many cutoffs of each rule are taken, so that together they keep the risk.

    ``firsts`` has, per row, the first cutoff of each rule that rejects (its length: none does),
    ``counts`` the documents of the row, ``orders`` whether they order or test.
    """
    steps = sorted(
        (int(counts[orders & (firsts[:, r] <= i)].sum()), i, r)
        for r, length in enumerate(lengths)
        for i in range(length)
    )
    at = [np.full(length + 1, len(steps)) for length in lengths]
    for k, (_, i, r) in enumerate(steps):
        at[r][i] = k
    first = np.min([of[firsts[:, r]] for r, of in enumerate(at)], axis=0)
    tests = ~orders
    rejected = np.bincount(first[tests], counts[tests], len(steps) + 1)[:-1].cumsum().round().astype(int)
    last = choose_cutoff(range(len(steps)), rejected, int(counts[tests].sum()), risk, error)
    taken = [0] * len(lengths)
    for _, i, r in steps[: 0 if last is None else last + 1]:
        taken[r] = i + 1
    return taken


def fit_cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    stratum: str = "lang",
    label: str = "quality",
    risk: float = 0.02,
    error: float = 0.05,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """One row per stratum: ``stratum, n_good`` and a cutoff (or null) per rule.

    ``measured`` has the key, the stratum, a struct ``_m`` and ``base_failed``.
    """
    good = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(label).alias("_good"))
        .where("_good = 1")
    )
    names = [rule.name for rule in rules]
    # the cutoffs that do not reject; the next one is the first that does
    levels = [
        sum(F.when(rule.rejects(cutoff, "_m"), 0).otherwise(1) for cutoff in rule.cutoffs).alias(rule.name)
        for rule in rules
    ]
    orders = F.pmod(F.xxhash64(good["_key"].cast("string")), F.lit(5)) == 0
    counted = (
        measured.where(~F.col("base_failed"))
        .join(good, measured[key] == good["_key"])
        .select(
            F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), orders.alias("orders"), *levels
        )
        .groupBy("stratum", "orders", *names)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = Tables(measured.sparkSession).write(counted, "quality-counts")
    level = error / max(1, counted.select("stratum").distinct().count())

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        chosen = choose_together(
            [len(rule.cutoffs) for rule in rules], rows[names].to_numpy(), rows["n"].to_numpy(),
            rows["orders"].to_numpy(bool), risk, level,
        )
        out = {"stratum": rows["stratum"].iloc[0], "n_good": rows["n"].sum()}
        for rule, taken in zip(rules, chosen, strict=True):
            out[rule.name] = rule.cutoffs[taken - 1] if taken else np.nan
        return pd.DataFrame([out])

    schema = "stratum string, n_good long, " + ", ".join(f"{r.name} double" for r in rules)
    chosen = counted.groupBy("stratum").applyInPandas(decide, schema)
    return chosen.withColumns({r.name: F.nanvl(r.name, F.lit(None)) for r in rules})


def measure(
    docs: DataFrame,
    *,
    text: str = "text",
    min_words: int = 50,
    max_repeat: int = 50,
    as_: str = "_m",
) -> DataFrame:
    """Adds the struct of ``MEASURES`` and ``base_failed``."""
    m = F.col(as_)
    return docs.withColumn(as_, _measured(F.col(text))).withColumn(
        "base_failed",
        (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeat * m["n_words"]),
    )


def judge(measured: DataFrame, cutoffs: DataFrame, *, stratum: str = "lang",
          rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``kept`` to a measured frame. One cutoff row per stratum, so the join is small."""
    own = cutoffs.select(
        F.col("stratum").alias("_stratum"), F.struct(*[r.name for r in rules]).alias("_cut")
    )
    by = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    rejected = F.lit(False)
    for rule in rules:
        # no cutoff, no rejection
        rejected = rejected | F.coalesce(
            rule.rejects(F.col(f"_cut.{rule.name}"), "_m"), F.lit(False)
        )
    return (
        measured.join(own, by == F.col("_stratum"), "left")
        .withColumn("kept", ~F.col("base_failed") & ~rejected)
        .drop("_stratum", "_cut")
    )


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
    risk: float = 0.02,
    error: float = 0.05,
) -> DataFrame:
    """Per document ``key``, its stratum, the measures, ``base_failed`` and ``kept``."""
    narrow = docs.select(F.col(key), F.col(text), F.col(stratum))
    measured = measure(narrow, text=text).drop(text)
    measured = Tables(docs.sparkSession).write(measured, "quality-measures")
    cutoffs = fit_cutoffs(measured, labels, key=key, stratum=stratum, label=label, risk=risk,
                          error=error)
    judged = judge(measured, Tables(docs.sparkSession).write(cutoffs, "cutoffs"), stratum=stratum)
    return judged.select(key, stratum, "_m.*", "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
              stratum: str = "lang", **options) -> DataFrame:
    """The documents that pass, with the columns they have. Measures texts twice
    rather than write them in between."""
    narrow = docs.select(F.col(key), F.col(text), F.col(stratum))
    cutoffs = fit_cutoffs(measure(narrow, text=text), labels, key=key, stratum=stratum, **options)
    cutoffs = Tables(docs.sparkSession).write(cutoffs, "cutoffs")
    # names that no column of the documents has
    renamed = {c: fresh_name(docs.columns, f"kept_{c}") for c in docs.columns}
    inner = docs.withColumnsRenamed(renamed)
    judged = judge(measure(inner, text=renamed[text]), cutoffs, stratum=renamed[stratum])
    passed = judged.where("kept").select(*renamed.values())
    return passed.withColumnsRenamed({v: k for k, v in renamed.items()})
