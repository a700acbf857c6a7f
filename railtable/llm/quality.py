"""Quality by compression: zstandard dictionaries of good and bad text, and a calibrated size difference."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtable.llm import vectext
from railtable.llm.common import bounded_ids, crc_mod

#: Bytes of text that are compressed at once: about a dictionary's reach, so long texts are judged all along.
PIECE = 2048
LEVEL = 3
DICTIONARY = 112_640
#: Bounds of what is fitted on: labelled texts of each class for the dictionaries, pieces of each class (from all along those
#: texts, those with the smallest hashes), and labelled texts for the calibration. The scores themselves are of all texts, whole.
DICTIONARY_TEXTS, PIECES, CALIBRATION_TEXTS = 3000, 12_000, 6000
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and a logistic curve over the standardised size features. Without both classes: `constant`."""

    good: bytes
    bad: bytes
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None
    constant: float = 1.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(_terms(x, self.mean, self.spread) @ self.weights, -30, 30)))


def _terms(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / spread, -6, 6)
    return np.column_stack([np.ones(len(z)), z, z * z, z[:, 0] * z[:, 1], z[:, 0] * z[:, 2], z[:, 1] * z[:, 2]])


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps with halving."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = _terms(x, mean, spread)
    w = np.zeros(a.shape[1])

    def loss(w: np.ndarray) -> float:
        m = np.clip(a @ w, -60, 60)
        return float(np.sum(np.logaddexp(0, m) - y * m) + ridge * w @ w / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -60, 60)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (y - p) - ridge * w)
        rate, old = 1.0, loss(w)
        while rate > 1e-6 and loss(w + rate * step) > old:
            rate /= 2
        w = w + rate * step
        if np.abs(rate * step).max() < 1e-7:
            break
    return mean, spread, w


def _compressors(model: Model) -> list[zstandard.ZstdCompressor]:
    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    return [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d) if d else None, **plain) for d in (model.good, model.bad, b"")]


def _features(texts: pa.Array, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """For each text, over all its pieces: (bad - good) / plain, (bad - good) / length, log(plain / length)."""
    data, off = vectext.buffer_of(texts)
    view = memoryview(np.ascontiguousarray(data))
    out = np.zeros((len(off) - 1, 3))
    for k, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        good, bad, plain = (sum(len(c.compress(view[i : min(b, i + PIECE)])) for i in range(a, b, PIECE)) for c in compressors)
        out[k] = (bad - good) / max(1, plain), (bad - good) / max(1, b - a), np.log((plain + 1) / (b - a + 1))
    return out


def _dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary; where there are too few pieces to train one, as many of them whole as fit."""
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(1024, sum(map(len, pieces)) // 8)), pieces).as_bytes()
    except zstandard.ZstdError:
        sizes = np.cumsum([len(p) for p in pieces])
        return b"".join(pieces[: max(1, int(np.searchsorted(sizes, DICTIONARY, "right")))])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fits on labelled rows outside the held-out fold. The dictionaries come from up to DICTIONARY_TEXTS texts of each
    class (up to PIECES pieces of them), the calibration from up to CALIBRATION_TEXTS others, those with the smallest
    hashes: a class's pieces, 25 MB at most, are one task's, and its dictionary and a few numbers a text reach the driver. Null labels and ids, and null texts, are left out; of
    several labels of an id the smallest counts; repeated rows of an id teach as often as they stand there. With one class only the
    score is a constant: that class's label; without labels it is 1."""
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
    known = known.where(crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT).groupBy("doc_id").agg(F.min("y").alias("y"))
    half = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(2))
    for_dictionary = bounded_ids(known.where(half == 0), "doc_id", DICTIONARY_TEXTS, by=["y"])
    for_curve = known.where(half == 1).join(bounded_ids(known.where(half == 1), "doc_id", CALIBRATION_TEXTS), "doc_id", "left_semi")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = t.as_buffer()
                out += [(y, raw[at : at + PIECE].to_pybytes()) for at in range(0, max(1, raw.size), PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in out], pa.int32()), pa.array([p for _, p in out], pa.binary())], names=["y", "piece"])

    every = rows.join(F.broadcast(for_dictionary), "doc_id").select("y", "text").mapInArrow(cut, "y int, piece binary")
    few = [every.where(F.col("y") == y).orderBy(F.xxhash64("piece"), "piece").limit(PIECES) for y in (0, 1)]

    def fit(pieces: pa.Table) -> pa.Table:
        made = _dictionary(sorted(p.as_buffer().to_pybytes() for p in pieces.column("piece").combine_chunks()))
        return pa.table({"y": pa.array([pieces.column("y")[0].as_py()], pa.int32()), "d": pa.array([made], pa.binary())})

    # training takes many times the pieces' own memory: a task for each class, and only the dictionaries come to the driver
    made = {r["y"]: bytes(r["d"]) for r in few[0].unionByName(few[1]).groupBy("y").applyInArrow(fit, "y int, d binary").collect()}
    if len(made) < 2:
        return Model(b"", b"", constant=0.0 if 0 in made else 1.0)
    draft = Model(made[1], made[0])
    sent = spark.sparkContext.broadcast(draft)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _compressors(sent.value)
        for batch in batches:
            x = _features(batch.column(1), c)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x[:, k]) for k in range(3))], names=["y", "a", "b", "c"])

    got: pd.DataFrame = rows.join(F.broadcast(for_curve), "doc_id").select("y", "text").mapInArrow(measure, "y int, a double, b double, c double").toArrow().to_pandas().sort_values(["y", "a", "b", "c"])
    if got["y"].nunique() < 2:
        return Model(draft.good, draft.bad, constant=1.0)
    return Model(draft.good, draft.bad, *_fit(got[["a", "b", "c"]].to_numpy(), got["y"].to_numpy(float)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, held_out, score, predicted. Every whole text is compressed with both
    dictionaries; the score reads nothing but the text. Null texts count as empty; a null id is held out null.
    Repeated rows score alike; no rows: no rows."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _compressors(sent.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sent.value.scores(_features(batch.column(2), c)))], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), (crc_mod(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    out = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns untouched, whose text scores THRESHOLD or more. Null texts count as empty; each row is judged by its
    own text, whatever its id, so repeated rows go or stay together. No shuffle; no rows: no rows."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _compressors(sent.value)
        for batch in batches:
            yield batch.filter(pa.array(sent.value.scores(_features(batch.column(at).cast(pa.string()), c)) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
