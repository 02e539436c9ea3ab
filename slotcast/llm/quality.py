"""Quality classifier: random Fourier features, ridge by partition-summed normal equations,
isotonic calibration.

Every text becomes a vector of document statistics (``STATS``). Standardised vectors pass
through random Fourier features that approximate a Gaussian kernel. Each partition sums the
normal equations of its labelled rows per fold; the driver adds those fixed-size sums and
solves the ridge system. Scores of rows by the model that left their fold out are calibrated by
isotonic regression over score bins.

Training bound (documented): at most about ``max_rows`` labelled rows, chosen by hash, in
``FIT_PARTS`` partitions; the driver receives FIT_PARTS x FOLDS blocks of (features+1)^2 numbers.

Defined results: null texts are scored like empty ones; labels without document or with null
quality teach nothing; several labels of one document count as their mean; without any label all
scores are 0.5; one class only gives that class's constant. Equal texts get equal scores, so ties
and repeated rows are kept as they are. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from slotcast.session import cut_lineage, ship_package

STATS = ["log_bytes", "log_words", "mean_word", "sd_word", "upper", "digit", "space", "high", "punct",
         "exclaim", "bar", "hash_at", "symbol", "brace", "stop_end", "distinct_words", "top_word", "repeat_grams",
         "log_lines", "mean_line", "dup_lines", "short_lines", "links", "caps_words", "long_words"]
FEATURES = 192
FOLDS = 5
FIT_PARTS = 16
SEED = 20240501
RIDGE = 1e-3
BINS = 1000

_CLASS = {"upper": range(65, 91), "digit": range(48, 58), "space": [9, 10, 11, 12, 13, 32],
          "high": range(128, 256), "exclaim": [33, 63], "bar": [124], "hash_at": [35, 64],
          "symbol": [36, 37, 38, 42, 43, 60, 61, 62, 94, 95, 126, 92, 47], "brace": [40, 41, 91, 93, 123, 125],
          "punct": [33, 34, 39, 44, 45, 46, 58, 59, 63], "stop_end": [46]}
_CLASS_ROWS = np.zeros((len(_CLASS), 256))
for _i, _codes in enumerate(_CLASS.values()):
    _CLASS_ROWS[_i, list(_codes)] = 1.0


def text_stats(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of ``STATS``."""
    raw = (text or "").encode("utf-8", "replace")
    n = max(1, len(raw))
    share = dict(zip(_CLASS, _CLASS_ROWS @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / n))
    words = raw.split()
    m = max(1, len(words))
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    grams = len(set(zip(words, words[1:], words[2:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    line_len = np.fromiter(map(len, lines), float, len(lines)) if lines else np.zeros(1)
    own = {
        "log_bytes": np.log1p(len(raw)), "log_words": np.log1p(len(words)), "mean_word": lengths.mean(),
        "sd_word": lengths.std(), "distinct_words": len(counts) / m,
        "top_word": max(counts.values(), default=0) / m,
        "repeat_grams": 1.0 - grams / max(1, len(words) - 2) if len(words) > 2 else 0.0,
        "log_lines": np.log1p(len(lines)), "mean_line": np.log1p(line_len.mean()),
        "dup_lines": 1.0 - len(set(lines)) / k, "short_lines": float((line_len < 20).mean()),
        "links": (raw.count(b"http") + raw.count(b"www.")) / m,
        "caps_words": sum(c for w, c in counts.items() if w.isupper()) / m,
        "long_words": float((lengths > 25).mean()),
    }
    both = share | own
    return [float(both[s]) for s in STATS]


def stats_matrix(texts) -> np.ndarray:
    return np.array([text_stats(t if isinstance(t, str) else None) for t in texts], dtype=float) \
        .reshape(-1, len(STATS))


@dataclass
class QualityModel:
    """Fitted classifier; ``score_column`` applies it to a text column."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    xs: np.ndarray          # isotonic knots
    ys: np.ndarray
    threshold: float = 0.5

    def features(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale)

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(self.xs):
            return np.full(len(stats), 0.5)
        return np.interp(self.features(stats) @ self.weights, self.xs, self.ys)

    def score_column(self, spark, text: Column) -> Column:
        ship_package(spark)
        model = self

        @F.pandas_udf(T.DoubleType())
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(model.score(stats_matrix(texts)))

        return run(text.cast("string"))


def fourier(x: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised rows, with a constant column."""
    rng = np.random.default_rng(SEED)
    w = rng.standard_normal((len(STATS), FEATURES)) / np.sqrt(len(STATS))
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.sqrt(2.0 / FEATURES) * np.cos(np.clip(x, -8, 8) @ w + b)
    return np.hstack([z, np.ones((len(x), 1))])


def isotonic(x: np.ndarray, total: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins sorted by x: (block centres, block means)."""
    blocks: list[list[float]] = []          # sum, count, sum of x * count
    for xi, s, c in zip(x, total, count):
        blocks.append([s, c, xi * c])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def fit(docs: DataFrame, labels: DataFrame, where: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality",
        max_rows: int = 400_000, threshold: float = 0.5) -> QualityModel:
    """Fit on the labelled rows of ``docs`` that satisfy ``where`` (a column over ``docs``)."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = (docs if where is None else docs.where(where)).select(
        docs[id_col].alias("__id"), docs[text_col].cast("string").alias("__text")).where("__id is not null")

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"__id": frame["__id"], "x": list(stats_matrix(frame["__text"]))})

    schema = T.StructType([T.StructField("__id", docs.schema[id_col].dataType),
                           T.StructField("x", T.ArrayType(T.DoubleType()))])
    truth = (labels.select(labels[label_id].alias("__id"), labels[label_col].cast("double").alias("__y"))
             .where("__id is not null and __y is not null").groupBy("__id").agg(F.avg("__y").alias("y")))
    key = F.xxhash64(F.col("__id").cast("string"), F.lit(SEED))
    # ids meet their labels first; only the rows of the sample, a broadcast of about ``max_rows``, are measured
    labelled = cut_lineage(rows.select("__id").join(truth, "__id").select(
        "__id", "y", F.pmod(key, F.lit(FOLDS)).cast("int").alias("fold"),
        F.pmod(F.shiftright(key, 8), F.lit(1_000_000)).alias("pick")))
    n = labelled.count()
    picked = labelled if n <= max_rows else labelled.where(F.col("pick") < int(1e6 * max_rows / n))
    picked = picked.dropDuplicates(["__id"])        # repeated documents are measured each
    sample = cut_lineage(rows.join(F.broadcast(picked.select("__id")), "__id", "left_semi").mapInPandas(measure, schema)
                         .join(F.broadcast(picked), "__id").select("x", "y", "fold", "pick"))
    width = len(STATS)
    empty = np.zeros(0)
    if n == 0:
        return QualityModel(np.zeros(width), np.ones(width), None, empty, empty, threshold)
    row = sample.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(width)],
                     *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(width)]).first()
    mean = np.array([row[f"m{i}"] for i in range(width)])
    scale = np.array([row[f"s{i}"] for i in range(width)])
    scale[~(scale > 1e-9)] = 1.0
    d = FEATURES + 1

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[int, np.ndarray] = {}
        for frame in frames:
            z = fourier((np.vstack(frame["x"].to_numpy()) - mean) / scale)
            y, folds = frame["y"].to_numpy(), frame["fold"].to_numpy()
            for f in np.unique(folds):
                at = folds == f
                acc[f] = acc.get(f, 0.0) + np.column_stack([z[at].T @ z[at], z[at].T @ y[at]])
        if acc:
            yield pd.DataFrame({"fold": [int(f) for f in acc], "block": [a.tobytes() for a in acc.values()]})

    dealt = sample.repartition(FIT_PARTS, "pick")
    total = np.zeros((FOLDS, d, d + 1))
    for r in dealt.mapInPandas(sums, "fold int, block binary").toLocalIterator():
        total[r["fold"]] += np.frombuffer(r["block"]).reshape(d, d + 1)

    def solve(block: np.ndarray) -> np.ndarray:
        ridge = np.full(d, RIDGE * max(1.0, block[-1, d - 1]) / d)
        ridge[-1] = 1e-9
        return np.linalg.solve(block[:, :d] + np.diag(ridge), block[:, d])

    full = total.sum(axis=0)
    weights = solve(full)
    left_out = [solve(full - total[f]) if full[-1, d - 1] > total[f][-1, d - 1] else weights for f in range(FOLDS)]

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = np.vstack(left_out)
        for frame in frames:
            z = fourier((np.vstack(frame["x"].to_numpy()) - mean) / scale)
            s = (z * w[frame["fold"].to_numpy()]).sum(axis=1)
            yield pd.DataFrame({"bin": np.rint(np.clip(s, -0.5, 1.5) * BINS / 2).astype("int64"), "y": frame["y"]})

    bins = (sample.mapInPandas(scored, "bin long, y double").groupBy("bin")
            .agg(F.sum("y").alias("s"), F.count("*").alias("c")).orderBy("bin").collect())   # at most BINS + 1 rows
    xs, ys = isotonic(np.array([r["bin"] * 2 / BINS for r in bins]), np.array([r["s"] for r in bins]),
                      np.array([float(r["c"]) for r in bins]))
    return QualityModel(mean, scale, weights, xs, ys, threshold)


def classify(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score, predicted (1 where score reaches the threshold)."""
    scored = docs.select(docs[id_col].alias("__id"),
                         model.score_column(docs.sparkSession, docs[text_col]).alias("score"))
    return scored.select(F.col("__id").alias(id_col), "score",
                         (F.col("score") >= model.threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject."""
    return docs.where(model.score_column(docs.sparkSession, docs[text_col]) >= model.threshold)
