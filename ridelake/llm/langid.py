"""Language identification by hierarchical discrimination.

A linear support vector machine per family (one against the rest) names the
language family of a text; inside the family, one-versus-one machines separate
its languages, each pair voting with its margin.  Features are hashed letter
n-grams of whole texts, however long (counted a stretch at a time).  The
machines are trained here on a bounded sample of labelled rows:
``SAMPLE_PER_LANGUAGE`` distinct texts of each language, those of smallest text
hash, each with two short passages of it so that short texts are known too;
more than ``MOST_LANGUAGES`` labels are an error.  Only text and label are
learned from; a prediction reads only the text.

Defined results: a null text or one without letters is ``und`` with score 0,
and so is every text if there are no labelled rows; one learned language has
score 1; rows without a label are not learned from; repeated rows count once
in training and are predicted alike; an empty table gives no rows; equal
margins go to the family, then the language, that sorts first; other columns,
whatever their names, are ignored by ``identify`` and kept by
``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..plans.broadcast import has_at_most

SAMPLE_PER_LANGUAGE = 250
# Distinct labels a model is trained for; more are refused.
MOST_LANGUAGES = 200
FEATURES = 4096
UNKNOWN = "und"
# Below this score a pipeline rejects a document's language.
LEAST_SCORE = 0.25
_COST, _ROUNDS = 10.0, 200
_CHUNK = 1 << 20

# Family of a language, by its ISO 639-1 code; another label is
# a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic",
    "no": "germanic", "nb": "germanic", "nn": "germanic", "is": "germanic", "af": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance",
    "ca": "romance", "gl": "romance",
    "ru": "slavic", "uk": "slavic", "be": "slavic", "bg": "slavic", "pl": "slavic", "cs": "slavic",
    "sk": "slavic", "sl": "slavic", "hr": "slavic", "sr": "slavic", "mk": "slavic",
    "fi": "uralic", "et": "uralic", "hu": "uralic",
    "tr": "turkic", "az": "turkic", "kk": "turkic",
    "hi": "indic", "bn": "indic", "ur": "indic", "mr": "indic",
    "ar": "semitic", "he": "semitic",
}

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter; built once per Python worker."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def features(text: str | None) -> np.ndarray | None:
    """Unit vector of the square roots of hashed 1- to 3-gram frequencies of
    letters, words padded by one space; None if there is no letter."""
    counts = np.zeros(FEATURES)
    text = text or ""
    for at in range(0, len(text), _CHUNK):  # bounded memory for very long texts
        codes = np.frombuffer(text[at:at + _CHUNK].lower().encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[codes]
        if not letter.any():
            continue
        codes = np.where(letter, codes, 32).astype(np.uint64)
        keep = letter | np.concatenate([[True], letter[:-1]])
        codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint64)
        for n, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9)):
            gram = np.zeros(len(codes) - n + 1, np.uint64)
            for k in range(n):
                gram = gram * np.uint64(0x100000001B3) + codes[k:len(codes) - n + 1 + k]
            slot = (gram * np.uint64(salt)) >> np.uint64(64 - FEATURES.bit_length() + 1)
            counts += np.bincount(slot.astype(np.int64), minlength=FEATURES)
    if not counts.any():
        return None
    root = np.sqrt(counts)
    return (root / np.linalg.norm(root)).astype(np.float32)


def _passages(text: str) -> list[str]:
    """The text and two short passages at places set by its length."""
    n = len(text)
    return [text] + [text[at:at + size] for size, at in ((40, n // 3), (150, n // 2)) if n > 2 * size]


def _machine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Linear support vector machine with squared hinge loss (last weight:
    bias), classes weighted equally, by accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    y = y.astype(x.dtype)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * _COST * 100
    weight = weight.astype(x.dtype)
    w = v = np.zeros(x.shape[1], x.dtype)
    step, t = x.dtype.type(1 / (1 + 4 * weight.sum())), 1.0
    for _ in range(_ROUNDS):
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v - step * (v - 2 * (x.T @ (weight * y * slack)))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, w, t = new + x.dtype.type((t - 1) / t2) * (new - w), new, t2
    return w


@dataclass
class Model:
    """``family[i]``: machine of ``families[i]`` against the rest;
    ``pairs[a, b]``: machine of language ``a`` against ``b``."""

    families: list[str]
    members: dict[str, list[str]]
    family: np.ndarray
    pairs: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row of ``x``."""
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
        if len(self.families) > 1:
            odds = np.exp(np.clip(4 * (x @ self.family.T), -30, 30))
            odds /= odds.sum(axis=1, keepdims=True)
        else:
            odds = np.ones((len(x), 1))
        best = odds.argmax(axis=1)
        lang, score = np.empty(len(x), object), np.empty(len(x))
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(best == f)
            names = self.members[name]
            votes = np.zeros((len(rows), len(names)))
            for (a, b), w in self.pairs.items():
                if a in names and b in names:
                    p = 1 / (1 + np.exp(-np.clip(4 * (x[rows] @ w), -30, 30)))
                    votes[:, names.index(a)] += p
                    votes[:, names.index(b)] += 1 - p
            won = votes.argmax(axis=1)
            share = votes.max(axis=1) / (len(names) - 1) if len(names) > 1 else np.ones(len(rows))
            lang[rows] = np.array(names, object)[won]
            score[rows] = odds[rows, f] * share
        return lang, np.clip(score, 0, 1)


def train(labelled: DataFrame, families: dict[str, str] | None = None) -> Model | None:
    """A model of ``labelled`` (``text``, ``lang``); None without rows."""
    families = FAMILIES if families is None else families
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang"),
                           F.xxhash64("text").alias("h")).where("text is not null and lang is not null")
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    if not has_at_most(counts, MOST_LANGUAGES):
        raise ValueError(f"more than {MOST_LANGUAGES} language labels: one machine is trained for each pair in a family")
    # the share of hashes to look at holds a tenth more texts than wanted; the
    # rows stay where they are (a join by language would gather a common one)
    place = F.shiftrightunsigned("h", 1) / F.lit(float(1 << 63))
    near = (rows.select("lang", "h").join(F.broadcast(counts), "lang")
            .where(place * F.col("n") <= 1.1 * SAMPLE_PER_LANGUAGE + 10).groupBy("lang", "h").agg(F.lit(1).alias("one")))
    # bounded: about 285 distinct hashes per language reach the window
    first = Window.partitionBy("lang").orderBy("h")
    keys = (near.withColumn("n", F.row_number().over(first))
            .where(F.col("n") <= SAMPLE_PER_LANGUAGE).select("lang", "h"))
    # bounded: SAMPLE_PER_LANGUAGE keys of 16 bytes per language
    sample = (rows.join(F.broadcast(keys), ["lang", "h"]).groupBy("lang", "h")
              .agg(F.first("text").alias("text")).select("lang", "text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(lang, v.tobytes()) for lang, text in zip(*(c.to_pylist() for c in batch.columns))
                   for v in map(features, _passages(text)) if v is not None]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()),
                                              pa.array([o[1] for o in out], pa.binary())], ["lang", "x"])

    # bounded: three vectors of 16 kB per sampled text
    got = sorted(map(tuple, sample.mapInArrow(vectors, "lang string, x binary").collect()))
    if not got:
        return None
    lang = np.array([g[0] for g in got], object)
    x = np.stack([np.frombuffer(g[1], np.float32) for g in got])
    family = np.array([families.get(code, code) for code in lang], object)
    names = sorted(set(family))
    members = {f: sorted(set(lang[family == f])) for f in names}
    top = np.stack([_machine(x, np.where(family == f, 1.0, -1.0)) if len(names) > 1
                    else np.zeros(x.shape[1] + 1) for f in names])
    pairs = {}
    for group in members.values():
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                rows_of = (lang == a) | (lang == b)
                pairs[a, b] = _machine(x[rows_of], np.where(lang[rows_of] == a, 1.0, -1.0))
    return Model(names, members, top.astype(np.float32), {k: w.astype(np.float32) for k, w in pairs.items()})


def predicted(text: Column, model: Model | None) -> Column:
    """Struct ``lang_pred``, ``score`` of a text column."""
    @pandas_udf("lang_pred string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            for at in range(0, len(texts) if model else 0, 256):
                found = [(at + i, v) for i, v in enumerate(map(features, texts.iloc[at:at + 256])) if v is not None]
                if found:
                    rows = [f[0] for f in found]
                    lang[rows], score[rows] = model.predict(np.stack([f[1] for f in found]))
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return of(text)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training; a null id is neither held out nor
    learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row,
    learned from the labelled rows that are not held out."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                       predicted(F.col("text"), model).alias("p")).select("doc_id", "held_out", "p.*")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with at
    least ``LEAST_SCORE``."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row")
    return (docs.select(row, predicted(F.col("text"), model).alias("_p"))
            .where((F.col("_p.lang_pred") != UNKNOWN) & (F.col("_p.score") >= LEAST_SCORE)).select("_row.*"))
