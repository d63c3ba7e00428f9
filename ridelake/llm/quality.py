"""Quality rules: robust multivariate outliers.

Base statistics of a whole text, and two base rules (too few words, too many
repeated windows).  Of the documents that pass them, each statistic vector
(mean word length, symbols per word, duplicate lines per line, repeated words
per word; transformed) is held against a minimum-covariance-determinant
estimate of its language and source: from medians and absolute deviations,
concentration steps re-estimate mean and covariance on the ``SUPPORT`` share
of smallest Mahalanobis distances.  All rows count, in aggregations that
combine before they shuffle; an estimate is one row per group, inverted in
Arrow batches of groups.  Rows beyond the chi-squared ``CUTOFF`` are rejected.

Clean statistics are often constant (no symbols at all), so a floor
(``SPREAD``) is added to each variance: in a group where a statistic is constant,
a document is rejected by it alone from ``REJECTING`` off the centre on.  Groups
with fewer than ``LEAST_ROWS`` usable documents take the estimate of their
language, or of all documents; with fewer than that in all, none is rejected.

Defined results: a null text has no words and fails the base rules; null
languages and sources are groups of their own; repeated rows each count; an
empty table gives no rows; other columns, whatever their names, are ignored by
``quality`` and kept by ``keep_clean``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..plans.broadcast import broadcast_if_small
from .common import written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SUPPORT = 0.55
STEPS = 4
LEAST_ROWS = 100
CUTOFF = 0.999999
# Deviation of each transformed statistic that rejects alone where clean
# documents do not differ: a character per word, a symbol per ten words, 30 %
# of the lines, 30 % of the words.
REJECTING = (1.0, math.log1p(10 * 0.1), 0.3, 0.3)

_P = len(REJECTING)
_SPACE = " \t\n\r\x0b\x0c"
_SYMBOLS = "#*$%&|<>"
_STATS = ("n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
          "n_repeat_words long")
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(map(text.count, _SPACE))
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    repeated = 0
    if n > 3:
        seen: dict[bytes, int] = {}
        ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
        pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
        windows, count = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)[1:]
        found = np.flatnonzero(count[windows] > 1)
        mark = np.zeros(n, bool)
        for k in range(3):
            mark[found + k] = True
        repeated = int(mark.sum())
    return n, chars, sum(map(text.count, _SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated


def stats(text: Column) -> Column:
    @pandas_udf(_STATS)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in _STATS.split(", ")]
        for texts in batches:
            yield pd.DataFrame(np.array([text_stats(t) for t in texts], np.int64).reshape(-1, len(names)),
                               columns=names)

    return of(text)


def base_failed(s: str) -> Column:
    n = F.col(f"{s}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{s}.n_repeat_words") > MAX_REPEAT_PERCENT * n)


def _vector(s: str) -> list[Column]:
    """The transformed statistics; zero where there are no words."""
    words = F.greatest(F.col(f"{s}.n_words"), F.lit(1))
    return [F.col(f"{s}.word_chars") / words,
            F.log1p(10 * F.col(f"{s}.n_symbols") / words),
            F.col(f"{s}.n_dup_lines") / F.greatest(F.col(f"{s}.n_lines"), F.lit(1)),
            F.col(f"{s}.n_repeat_words") / words]


def _chi2(x: float, dof: int) -> float:
    """Distribution function of chi-squared with an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def _chi2_point(p: float, dof: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2(mid, dof) < p else (lo, mid)
    return hi


# Floor of each statistic's deviation.
SPREAD = tuple(r / math.sqrt(_chi2_point(CUTOFF, _P)) for r in REJECTING)


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. from the estimate m0.., q00.."""
    d = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(_P)]
    terms = [(1 if i == j else 2) * F.col(f"q{i}{j}") * d[i] * d[j] for i, j in _PAIRS]
    return sum(terms[1:], terms[0])


def _inverted(moments: DataFrame, scale: float) -> DataFrame:
    """Mean and inverse covariance of each group's moments: ``scale`` times
    the covariance, with the squared spreads on its diagonal."""
    names = [f"m{i}" for i in range(_P)]
    out = ["level", "lang", "source", "n", *names, *(f"q{i}{j}" for i, j in _PAIRS)]

    def invert(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            cov = np.zeros((len(f), _P, _P))
            for i, j in _PAIRS:
                c = f[f"c{i}{j}"].to_numpy() - f[f"m{i}"].to_numpy() * f[f"m{j}"].to_numpy()
                cov[:, i, j] = cov[:, j, i] = scale * c
            cov[:, range(_P), range(_P)] = np.maximum(cov[:, range(_P), range(_P)], 0) + np.square(SPREAD)
            inverse = np.linalg.inv(cov)
            yield f.assign(**{f"q{i}{j}": inverse[:, i, j] for i, j in _PAIRS})[out]

    schema = "level int, lang string, source string, n long, " + ", ".join(f"{c} double" for c in out[4:])
    return moments.mapInPandas(invert, schema)


_KEY = ["level", "lang", "source"]
# Estimates are broadcast up to so many groups (at most 200 bytes each).
_SMALL = 50_000


def _groups_table(df: DataFrame, name: str) -> DataFrame:
    """One row per group, written; broadcast if their counted number allows,
    else left to a shuffle join, whose hot groups Spark splits."""
    return broadcast_if_small(written(df, name), _SMALL)


def estimates(rows: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimates of ``rows`` (lang, source,
    x0..) by language and source (level 0), language (1) and over all (2)."""
    none = F.lit("")
    levels = F.array(F.struct(F.lit(0).alias("level"), F.col("lang"), F.col("source")),
                     F.struct(F.lit(1).alias("level"), F.col("lang"), none.alias("source")),
                     F.struct(F.lit(2).alias("level"), none.alias("lang"), none.alias("source")))
    xs = [f"x{i}" for i in range(_P)]
    x = rows.select(F.explode(levels).alias("g"), *xs).select("g.*", *xs)
    middle = _groups_table(x.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), *[
        F.percentile_approx(f"x{i}", F.lit(0.5), F.lit(1000)).alias(f"m{i}") for i in range(_P)]), "medians")
    spread = x.join(middle, _KEY).groupBy(*_KEY).agg(
        F.first("n").alias("n"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(_P)],
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), F.lit(0.5), F.lit(1000)).alias(f"s{i}")
          for i in range(_P)])
    start = [(F.col(f"m{i}") * F.col(f"m{j}") + (F.pow(1.4826 * F.col(f"s{i}"), 2) if i == j else 0)
              ).alias(f"c{i}{j}") for i, j in _PAIRS]
    est = _groups_table(_inverted(spread.select(*_KEY, "n", *[f"m{i}" for i in range(_P)], *start), 1.0), "mcd")
    share = _chi2_point(SUPPORT, _P)
    scale = SUPPORT / _chi2(share, _P + 2)
    for _ in range(STEPS):
        near = x.join(est, _KEY).select(*_KEY, "n", *xs, _distance().alias("d"))
        limit = near.groupBy(*_KEY).agg(F.percentile_approx("d", F.lit(SUPPORT), F.lit(1000)).alias("limit"))
        half = near.join(_groups_table(limit, "limits"), _KEY).where("d <= limit")
        moments = half.groupBy(*_KEY).agg(
            F.first("n").alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(_P)],
            *[F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"c{i}{j}") for i, j in _PAIRS])
        est = _groups_table(_inverted(moments, scale), "mcd")
    return est


def _verdicts(rows: DataFrame) -> DataFrame:
    """``rows`` (written; with a struct ``_s`` of statistics and the group
    names ``_lang`` and ``_source``) with ``_base`` and ``_kept``."""
    xs = [v.alias(f"x{i}") for i, v in enumerate(_vector("_s"))]
    est = estimates(rows.where(~base_failed("_s"))
                    .select(F.col("_lang").alias("lang"), F.col("_source").alias("source"), *xs))
    cells = [c for c in est.columns if c not in _KEY]
    # one row per language and source, with the finest estimate it may use
    none = F.lit("")
    tries = F.array(F.struct(F.lit(0).alias("level"), F.col("lang"), F.col("source")),
                    F.struct(F.lit(1).alias("level"), F.col("lang"), none.alias("source")),
                    F.struct(F.lit(2).alias("level"), none.alias("lang"), none.alias("source")))
    chosen = (est.where("level = 0").select(F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                                            F.explode(tries).alias("g")).select("_lang", "_source", "g.*")
              .join(est.where(F.col("n") >= LEAST_ROWS), _KEY)
              .groupBy("_lang", "_source").agg(F.min_by(F.struct(*cells), "level").alias("e"))
              .select("_lang", "_source", "e.*"))
    cutoff = _chi2_point(CUTOFF, _P)
    scored = rows.join(_groups_table(chosen, "chosen"), ["_lang", "_source"], "left")
    for i, v in enumerate(_vector("_s")):
        scored = scored.withColumn(f"x{i}", v)
    failed = base_failed("_s")
    return scored.withColumn("_base", failed).withColumn(
        "_kept", ~failed & F.coalesce(_distance() <= cutoff, F.lit(True)))


def _groups() -> list[Column]:
    return [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")).alias(f"_{c}")
            for c in ("lang", "source")]


def quality(docs: DataFrame) -> DataFrame:
    """Statistics and verdict of every document (``doc_id``, ``text``,
    ``lang``, ``source``)."""
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_groups(),
                               stats(F.col("text")).alias("_s")), "stats")
    return _verdicts(rows).select(
        "doc_id", "_s.n_words", "_s.word_chars", "_s.n_symbols", "_s.n_dup_lines", "_s.n_repeat_words",
        F.col("_base").alias("base_failed"), F.col("_kept").alias("kept"))


def keep_clean(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that pass."""
    rows = written(docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), *_groups(),
                               stats(F.col("text")).alias("_s")), "stats")
    return _verdicts(rows).where("_kept").select("_row.*")
