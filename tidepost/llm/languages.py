"""Language identification by mixtures of languages.

Each language is a distribution over hashed character n-grams (lengths 1 to 3), counted over all
labelled training texts. A text is cut into short segments; expectation-maximisation estimates
the shares of the languages from the likelihoods of the segments' n-grams, and the set of
languages is grown one at a time as long as a likelihood penalised by the number of languages
(Bayesian information criterion) gains.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import map_rows

UNKNOWN = "und"
#: Cells per n-gram length; the model has 3 * CELLS numbers per language, whatever the corpus.
CELLS = 1 << 14
SEGMENT = 48
ROUNDS = 25
SLICE_CHARS = 1 << 18
LETTER = re.compile(r"[^\W\d_]")
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@dataclass
class Model:
    languages: list[str]
    log_likelihood: np.ndarray  # (3 * CELLS, languages)


def cells(codes: np.ndarray) -> Iterator[np.ndarray]:
    """For each n the cell of the n-gram that ends at each code point; equal lengths."""
    mixed = np.zeros(len(codes), np.uint32)
    shift = np.uint32(32 - CELLS.bit_length() + 1)
    for n in range(3):
        mixed = mixed + np.concatenate([np.zeros(n, np.uint32), codes[: len(codes) - n]])[: len(codes)] * MULTIPLIERS[n]
        spread = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        yield (spread >> shift).astype(np.int64) + n * CELLS


def code_points(text: str) -> np.ndarray:
    """Lower-case code points; white space is one kind of character."""
    return np.frombuffer(" ".join(["", *text.lower().split(), ""]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)


def slices(text: str) -> Iterator[str]:
    for at in range(0, len(text), SLICE_CHARS):
        yield text[at : at + SLICE_CHARS]


def has_letter(text: str | None) -> bool:
    return bool(text) and LETTER.search(text) is not None


def count_cells(rows: DataFrame) -> DataFrame:
    """Counts per language and cell over all rows of ``text, lang``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                held = counts.setdefault(lang.as_py(), np.zeros(3 * CELLS, np.int64))
                for part in slices(text.as_py() or ""):
                    for found in cells(code_points(part)):
                        held += np.bincount(found, minlength=3 * CELLS)
        for lang, held in counts.items():
            used = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(held[used])], ["lang", "cell", "n"]
            )

    return map_rows(rows.select("text", "lang"), "lang string, cell int, n bigint", work).groupBy("lang", "cell").agg(
        F.sum("n").alias("n")
    )


def fit(rows: DataFrame) -> Model:
    """The model of all rows of ``text, lang`` with a language and a text.

    What reaches the driver is one number per language and cell, so its size is bounded by the
    number of languages. Rows with a null language or text are left out.
    """
    counts = count_cells(rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())).collect()
    languages = sorted({r["lang"] for r in counts})
    number = {lang: i for i, lang in enumerate(languages)}
    table = np.zeros((3 * CELLS, len(languages)))
    for r in counts:
        table[r["cell"], number[r["lang"]]] += r["n"]
    by_length = (table + 0.5).reshape(3, CELLS, -1)
    log_likelihood = np.log(by_length / by_length.sum(1, keepdims=True)).reshape(3 * CELLS, -1)
    return Model(languages, (log_likelihood / 3).astype(np.float32))


def segment_scores(text: str, model: Model) -> np.ndarray:
    """Log-likelihood of each segment in each language; segments cover the whole text."""
    parts = []
    for part in slices(text):
        codes = code_points(part)
        scores = sum(model.log_likelihood[found] for found in cells(codes))
        parts.append(np.add.reduceat(scores, np.arange(0, len(codes), SEGMENT), axis=0))
    return np.concatenate(parts).astype(np.float64)


def shares(scores: np.ndarray, chosen: list[int]) -> tuple[np.ndarray, float]:
    """Shares of the chosen languages by expectation-maximisation, and the log-likelihood."""
    part = scores[:, chosen]
    top = part.max(1, keepdims=True)
    likelihood = np.exp(part - top)
    weight = np.full(len(chosen), 1 / len(chosen))
    for _ in range(ROUNDS if len(chosen) > 1 else 0):
        responsibility = likelihood * weight
        responsibility /= np.maximum(responsibility.sum(1, keepdims=True), 1e-300)
        weight = responsibility.mean(0)
    return weight, float((np.log(np.maximum(likelihood @ weight, 1e-300)) + top[:, 0]).sum())


def mixture(scores: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The languages of a text and their shares, chosen by penalised likelihood."""
    chosen = [int(scores.sum(0).argmax())]
    weight, best = shares(scores, chosen)
    penalty = 0.5 * np.log(len(scores) + 1) + 3.0
    while len(chosen) < scores.shape[1]:
        # The language that explains most of what the chosen ones leave is tried next.
        held = scores[:, chosen].max(1, keepdims=True)
        gain = np.maximum(scores - held, 0).sum(0)
        gain[chosen] = -1
        candidate = [*chosen, int(gain.argmax())]
        if gain.max() <= penalty:
            break
        tried, value = shares(scores, candidate)
        if value - best <= penalty:
            break
        chosen, weight, best = candidate, tried, value
    return chosen, weight


def predict_text(text: str | None, model: Model) -> tuple[str, float, dict[str, float]]:
    """Language, its share in 0..1, and the share of each language of the mixture."""
    if not model.languages or not has_letter(text):
        return UNKNOWN, 0.0, {}
    scores = segment_scores(text, model)
    chosen, weight = mixture(scores)
    order = sorted(zip(weight.tolist(), chosen, strict=True), key=lambda x: (-x[0], x[1]))
    found = {model.languages[i]: w for w, i in order}
    first = next(iter(found))
    return first, min(1.0, max(0.0, found[first])), found


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``lang_shares`` to documents.

    A null text, an empty one, one without a letter, and any text under a model without
    languages is ``und`` with score 0. Equal likelihoods go to the first language by name.
    Columns of these names are replaced; all other columns and all rows stay.
    """
    names = ("lang_pred", "score", "lang_shares")
    kept = docs.select(*[c for c in docs.columns if c not in names])
    held = docs.sparkSession.sparkContext.broadcast(model)
    at, out = kept.columns.index("text"), [*kept.columns, *names]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.float64(), pa.map_(pa.string(), pa.float64()))
        for batch in batches:
            found = [predict_text(t.as_py(), held.value) for t in batch.column(at)]
            columns = [
                pa.array([f[0] for f in found], kinds[0]),
                pa.array([f[1] for f in found], kinds[1]),
                pa.array([list(f[2].items()) for f in found], kinds[2]),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], out)

    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes)
    return map_rows(kept, f"{schema}, lang_pred string, score double, lang_shares map<string,double>", work)


def fold() -> Column:
    """The remainder by 4 of the crc32 of the id as text; null ids are in fold 0."""
    return F.pmod(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)), F.lit(4))


def identify(docs: DataFrame) -> DataFrame:
    """Fits on documents outside fold 2 and predicts for all: adds ``held_out`` and the columns of
    :func:`predict`. An empty table gives no rows."""
    model = fit(docs.where(fold() != 2).select("text", "lang"))
    return predict(docs.withColumn("held_out", fold() == 2), model)
