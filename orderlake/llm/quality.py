"""A quality classifier from compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
text. A text is compressed in windows with each; how much smaller it gets with
the good one, as a part of both sizes, and its compressed size as a part of its
length (repetition compresses with any dictionary) become a score by a logistic
curve, fitted on labelled texts that the dictionaries were not built from.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import only


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and curve; all that a task needs, below 200 kB."""

    good: bytes
    bad: bytes
    window: int
    level: int
    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]  # the first is the constant


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    fit_docs: int = 8000,
    dictionary_windows: int = 4000,
    window: int = 512,
    dictionary_bytes: int = 65536,
    level: int = 3,
) -> QualityModel:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality 0 or 1).

    A sample bounded by parameters: at most ``fit_docs`` labelled documents of
    each class, by the hash of their id; half of them give at most
    ``dictionary_windows`` windows a class for the dictionaries, half the points
    of the curve. Nothing else is learned from. Null labels and ids are left
    out; of contradicting labels of one document the lower counts. If a class
    has no text, the score is the share of good ones (0.5 without any).
    """
    labelled = only(labels, "doc_id", "quality").filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    labelled = labelled.groupBy("doc_id").agg(F.min("quality").alias("quality")).withColumn("h", F.xxhash64("doc_id"))
    picked = [labelled.filter(F.col("quality") == q).orderBy("h", "doc_id").limit(fit_docs) for q in (0, 1)]
    # bounded by 2 * fit_docs rows
    sample = only(docs, "doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    sample = sample.withColumn("text", F.coalesce("text", F.lit("")))

    texts = sample.filter(F.pmod(F.shiftright("h", 8), F.lit(2)) == 0).filter(F.length("text") > 0)
    starts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / window).cast("int"))
    windows = texts.select("quality", "h", "text", F.explode(starts).alias("i"))
    windows = windows.select("quality", F.xxhash64("h", "i").alias("h"), F.substring("text", F.col("i") * window + 1, F.lit(window)).alias("w"))
    sides = []
    for q in (0, 1):
        rows = windows.filter(F.col("quality") == q).orderBy("h", "w").limit(dictionary_windows).collect()
        sides.append([r.w.encode("utf-8") for r in rows])
    flat = ((0.0, 0.0), (1.0, 1.0))
    if not sides[0] or not sides[1]:
        counts = {r.quality: r["count"] for r in labelled.groupBy("quality").count().collect()}
        share = min(max(counts.get(1, 0) / sum(counts.values()), 0.01), 0.99) if counts else 0.5
        return QualityModel(b"x", b"x", window, level, *flat, (_log_odds(share), 0.0, 0.0))
    good, bad = (_dictionary(sides[q], dictionary_bytes) for q in (1, 0))
    model = QualityModel(good, bad, window, level, *flat, (0.0, 0.0, 0.0))

    rest = sample.filter(F.pmod(F.shiftright("h", 8), F.lit(2)) == 1)
    points = rest.select("quality", "text").mapInArrow(_measure(model, 1, True), "quality int, x double, y double").collect()
    return QualityModel(good, bad, window, level, *_curve([(r.x, r.y) for r in points], [r.quality for r in points]))


def score_quality(docs: DataFrame, model: QualityModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: likelier good) of every whole text, null as empty; no shuffle.

    All columns stay; one named ``score`` is replaced.
    """
    names = [c for c in docs.columns if c.lower() != "score"]
    docs = only(docs, *names)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(_measure(model, names.index(text_column), False), schema)


def _log_odds(share: float) -> float:
    import math

    return math.log(share / (1 - share))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their text itself
        return b"\n".join(samples)[-size:]


def _curve(points: list[tuple[float, float]], labels: list[int]):
    """Means, scales and weights of a logistic curve, by Newton's steps."""
    import numpy as np

    if len(set(labels)) < 2:
        share = (sum(labels) + 1) / (len(labels) + 2)
        return (0.0, 0.0), (1.0, 1.0), (_log_odds(share), 0.0, 0.0)
    x, y = np.array(points), np.array(labels, float)
    means, scales = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - means) / scales]
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        slope = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(len(w))
        w = w + np.linalg.solve(slope, z.T @ (y - p) - 1e-3 * w)
    return tuple(map(float, means)), tuple(map(float, scales)), tuple(map(float, w))


def _measure(model: QualityModel, text_at: int, points: bool):
    """Per row the label (first column) and the two measures, or all columns and the score."""

    def run(batches):
        import math

        import pyarrow as pa
        import zstandard

        def compressor(data):
            kind = zstandard.DICT_TYPE_AUTO
            dictionary = zstandard.ZstdCompressionDict(data, dict_type=kind)
            dictionary.precompute_compress(level=model.level)
            return zstandard.ZstdCompressor(
                level=model.level, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
            ).compress

        good, bad, width = compressor(model.good), compressor(model.bad), model.window
        constant, *weights = model.weights
        for batch in batches:
            xs, ys = [], []
            for text in batch.column(text_at):
                data = (text.as_py() or "").encode("utf-8")
                parts = [data[i : i + width] for i in range(0, len(data), width)] or [b""]
                g, b = sum([len(good(p)) for p in parts]), sum([len(bad(p)) for p in parts])
                xs.append((b - g) / (b + g))
                ys.append(math.log((g + b) / (len(data) + 16 * len(parts))))
            if points:
                arrays, names = [batch.column(0).cast(pa.int32()), pa.array(xs, pa.float64()), pa.array(ys, pa.float64())], ["quality", "x", "y"]
            else:
                scores = []
                for pair in zip(xs, ys):
                    at = constant + sum(w * (v - m) / s for w, v, m, s in zip(weights, pair, model.means, model.scales))
                    scores.append(1 / (1 + math.exp(-min(max(at, -500), 500))))
                arrays, names = [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run
