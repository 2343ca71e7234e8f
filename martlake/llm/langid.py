"""Language of a text by the nearest of several centroids per language.

A text becomes a vector of character n-grams (1 to 3 lower-case letters, any other run of characters as one space),
hashed to ``DIMENSIONS`` places, weighted by (1 + log count) and inverse document frequency, and of length 1.  Each
language has ``CENTROIDS`` centroids, found by spherical k-means; a text takes the language of the centroid with the
largest cosine.  It is rejected if that cosine is below the language's limit: ``SLACK`` times a low quantile of the
cosines of the language's own texts, less for texts of few n-grams.

Document frequencies are counted over all training rows.  The centroids are fitted on at most about ``FIT_ROWS``
rows a language, chosen by a hash of doc_id (the share is FIT_ROWS / 1.2 / rows of the language, so that the expected
number stays under the bound by many standard deviations).

Defined results: a text that is null or has no letter is ``und`` with score 0, and rejected; so is every text when
there is no training row.  Equal cosines go to the smaller language name.  Rows without lang, text or doc_id are not
trained on.  Repeated rows are rows of their own; other columns pass through.  A very long text is one vector of all its
n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.llm.common import map_arrow

DIMENSIONS = 1 << 13
CENTROIDS = 4
FIT_ROWS = 1200
QUANTILE, SLACK, FULL_GRAMS = 0.005, 0.5, 600
SPACE = 32

_letter: np.ndarray | None = None


def letters(text: str) -> np.ndarray:
    """Code points of lower-case letters; runs of anything else are one space; a space at either end."""
    global _letter
    if _letter is None:
        _letter = np.full(0x110000, SPACE, np.uint32)
        for c in filter(lambda c: chr(c).isalpha(), range(0x110000)):
            _letter[c] = ord(chr(c).lower()[0])
    c = _letter[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    c = np.concatenate([[SPACE], c, [SPACE]]).astype(np.uint32)
    return c[(c != SPACE) | (np.concatenate([[0], c[:-1]]) != SPACE)]


def counts(c: np.ndarray, dimensions: int) -> np.ndarray:
    """How often the n-grams of each place occur."""
    shift = np.uint32(32 - int(dimensions).bit_length() + 1)
    one = c * np.uint32(2654435761) + np.uint32(97)
    two = one[:-1] * np.uint32(40503) + c[1:] * np.uint32(2246822519)
    three = two[:-1] * np.uint32(69069) + c[2:] * np.uint32(3266489917)
    place = np.concatenate([one, two * np.uint32(2654435761), three * np.uint32(2654435761)]) >> shift
    return np.bincount(place, minlength=dimensions)


def vectors(texts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), len(idf)), np.float32)
    for row, c in zip(out, texts):
        n = counts(c, len(idf))
        at = np.flatnonzero(n)
        row[at] = (1 + np.log(n[at])) * idf[at]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray  # a row each, of length 1
    langs: list[str]  # of each row
    limits: np.ndarray  # of each row's language


def _document_frequencies(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(dimensions, np.int64), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                total += counts(letters(text), dimensions) > 0
                rows += 1
        places = np.arange(-1, dimensions)  # place -1: the number of rows
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.concatenate([[rows], total]))], ["place", "n"])

    return run


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, from rows far from one another."""
    chosen = [int(np.argmax(x @ x.sum(0)))]
    near = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        spread = np.random.default_rng(len(chosen)).random(len(x)) * np.maximum(1 - near, 0)
        chosen.append(int(np.argmax(spread)))
        near = np.maximum(near, x @ x[chosen[-1]])
    centres = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, 1)
        sums = np.stack([x[own == j].sum(0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def _fit_language(idf: np.ndarray, k: int):
    def run(rows: pa.Table) -> pa.Table:
        texts = [letters(t) for t in rows.column("text").to_pylist()]
        x = vectors(texts, idf)
        centres = cluster(x, k)
        best = (x @ centres.T).max(1) / np.sqrt([min(1, len(t) / FULL_GRAMS) for t in texts])
        limit = SLACK * float(np.quantile(best, QUANTILE))
        return pa.table({"lang": pa.array([rows.column("lang")[0].as_py()] * len(centres), pa.string()),
                         "centroid": pa.array([c.astype("<f4").tobytes() for c in centres], pa.binary()),
                         "limit": pa.array([limit] * len(centres), pa.float64())})

    return run


def fit(rows: DataFrame, dimensions: int = DIMENSIONS, centroids: int = CENTROIDS, fit_rows: int = FIT_ROWS) -> Model:
    """``rows``: doc_id, text, lang; all of them are training rows."""
    rows = rows.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    seen = (map_arrow(rows.select("text"), _document_frequencies(dimensions), "place long, n long")
            .groupBy("place").agg(F.sum("n").alias("n")).collect())  # a row a place
    df = {r["place"]: r["n"] for r in seen}
    n = df.get(-1, 0)
    idf = np.array([np.log((1 + n) / (1 + df.get(p, 0))) + 1 for p in range(dimensions)], np.float32)

    per = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row a language
    if not per:
        return Model(idf, np.zeros((0, dimensions), np.float32), [], np.zeros(0))
    share = F.create_map(*[F.lit(x) for lang, c in per.items() for x in (lang, min(1.0, fit_rows / 1.2 / c) if c > fit_rows else 1.0)])
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 53)) / float(1 << 53)
    sample = rows.where(spread < share[F.col("lang")]).select("lang", "text")
    found = sample.groupBy("lang").applyInArrow(_fit_language(idf, centroids),
                                                "lang string, centroid binary, limit double").collect()
    found.sort(key=lambda r: r["lang"])
    return Model(idf, np.stack([np.frombuffer(r["centroid"], "<f4") for r in found]), [r["lang"] for r in found],
                 np.array([r["limit"] for r in found]))


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                b = batch.slice(s, 256)
                texts = [letters(t or "") for t in b.column(0).to_pylist()]
                known = [k for k, t in enumerate(texts) if len(t) > 1 and model.langs]
                lang, score, rejected = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
                if known:
                    near = vectors([texts[k] for k in known], model.idf) @ model.centroids.T
                    for k, j, c in zip(known, near.argmax(1).tolist(), near.max(1).tolist()):
                        lang[k], score[k] = model.langs[j], min(1.0, max(0.0, c))
                        rejected[k] = c < model.limits[j] * np.sqrt(min(1, len(texts[k]) / FULL_GRAMS))
                yield pa.RecordBatch.from_arrays(
                    [b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array([bool(x) for x in rejected], pa.bool_())], ["row", "lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: Model, row: Column | None = None) -> DataFrame:
    """row (all columns of the document, or the given value), lang_pred, score, rejected."""
    rows = docs.select(F.col("text"), (F.struct("*") if row is None else row).alias("row"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return map_arrow(rows, _predict(model), schema)


def held_out(doc_id: Column) -> Column:
    """Never trained on: a quarter of the documents, by a checksum of their id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
