"""Language ID: n-gram presence kernels, Nyström landmarks, one-versus-rest kernel ridge regression."""

from __future__ import annotations

import pickle
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, table

DIM = 1 << 13  # of hashed n-gram presence
GRAMS = (1, 2, 3)  # bytes; the blended spectrum
SAMPLE = 600  # labelled texts of a language that the model is fitted on, as expected from a hashed share of them
TEXTS = 256 * SAMPLE  # that the model is fitted on in all; with more labels than 256, each has fewer than SAMPLE
LANDMARKS = 160
JUDGES = 30  # texts at least that say what evidence is usual
RIDGE = 1e-2
SEED = 5
UNKNOWN = "und"
BLOCK = 1 << 20  # bytes of a text worked on at once
#: ASCII other than letters counts as a space.
FOLD = bytes(i if i > 127 or chr(i).isalpha() else 32 for i in range(256))
LETTER = re.compile(r"[^\W\d_]")


def presence(text: str) -> np.ndarray:
    """1 for each hashed n-gram that occurs in the whole text, lower-cased."""
    out = np.zeros(DIM, np.float32)
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(FOLD) + b" ", np.uint8)
    last = max(GRAMS)
    for at in range(0, len(raw), BLOCK):
        part = raw[at : at + BLOCK + last - 1].astype(np.uint32)
        code = np.zeros(len(part), np.uint32)
        for n in range(1, last + 1):
            code = code[: len(part) - n + 1] << np.uint32(8) | part[n - 1 :]
            if n in GRAMS:
                out[((code * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519)) >> np.uint32(19)] = 1
    return out


class Model(NamedTuple):
    labels: list[str]
    landmarks: np.ndarray  # DIM x landmarks, 0 or 1
    weights: np.ndarray  # landmarks x labels and one more, the regression of 1 for every text; for landmarks of length 1
    usual: float  # evidence that all but a hundredth of the sample's texts that are no landmarks reach; 0 if these are fewer than JUDGES

    def scores(self, texts: list[str]) -> np.ndarray:
        """texts x labels and one more: two matrix products. The first counts shared n-grams, exactly; the result is rounded, so that a text scores alike in any batch."""
        x = np.stack([presence(t) for t in texts])
        shared = (x @ self.landmarks).astype(np.float64)
        return np.round(shared / np.sqrt(np.maximum(x.sum(1, dtype=np.float64), 1))[:, None] @ self.weights, 9)


def evidence(values: np.ndarray) -> np.ndarray:
    """Of rows of scores(): the largest regression value with 1 for the label and 0, not -1, for others. About 1 for a text like the label's, falling to 0 for one that shares nothing with the landmarks."""
    return (values[:, :-1].max(1) + values[:, -1]) / 2


def fit(bits: np.ndarray, labels: list[str], block: int = 4096) -> Model | None:
    """Ridge regression of +1 and -1, and of 1 alone, on the Nyström features of the kernel <x, y> / |x| |y|. bits: packed presence, a row a text; they are unpacked by the block."""
    names = sorted(set(labels))
    if not names:
        return None
    place = {y: k for k, y in enumerate(names)}
    which = np.array([place[y] for y in labels])
    rng = np.random.default_rng(SEED)
    each = -(-LANDMARKS // len(names))
    own = np.concatenate([rng.permutation(rows)[:each] for rows in np.split(np.argsort(which, kind="stable"), np.cumsum(np.bincount(which))[:-1])])
    vectors = lambda rows: np.unpackbits(bits[rows], axis=1).astype(np.float32)
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    landmarks = vectors(own)
    marks = unit(landmarks).T
    values, basis = np.linalg.eigh((marks.T @ marks).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = basis[:, keep] / np.sqrt(values[keep])
    features = lambda rows: (unit(vectors(rows)) @ marks).astype(np.float64) @ root
    share = 1.0 / np.bincount(which)[which]  # classes weigh the same
    a, right = RIDGE * np.eye(root.shape[1]) / len(which), np.zeros((root.shape[1], len(names) + 1))
    for i in range(0, len(which), block):
        rows = np.arange(i, min(i + block, len(which)))
        z, columns = features(rows), np.arange(len(names) + 1)
        target = np.where((which[rows, None] == columns) | (columns == len(names)), 1.0, -1.0)
        a += (z * share[rows, None]).T @ z
        right += (z * share[rows, None]).T @ target
    coefficients = np.linalg.solve(a, right)
    weights = (root @ coefficients) / np.sqrt(np.maximum(landmarks.sum(1, dtype=np.float64), 1))[:, None]
    judges = np.setdiff1d(np.arange(len(which)), own)
    shown = [evidence(features(judges[i : i + block]) @ coefficients) for i in range(0, len(judges), block)]
    usual = float(np.quantile(np.concatenate(shown), 0.01)) if len(judges) >= JUDGES else 0.0
    return Model(names, np.ascontiguousarray(landmarks.T), weights, usual)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "utf-8")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame) -> Model | None:
    """A model of the labelled rows that are not held out, fitted on about SAMPLE texts of each label, or TEXTS in all if there are more labels than that allows.

    The driver gets the labels' counts and the model; the sample's presence bits, DIM / 8 bytes a text, meet in one task.
    The sample is the rows whose hash, of doc_id and text, falls below the share that their label needs.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return None
    each = min(SAMPLE, max(1, TEXTS // len(counts)))
    share = F.element_at(F.create_map(*[F.lit(y) for r in counts for y in (r["lang"], each / r["n"])]), F.col("lang"))
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "text"), 11).cast("double") * 2.0**-53

    def bits(batches):
        for batch in batches:
            own = [(x, y) for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if LETTER.search(x)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.packbits(presence(x) > 0).tobytes() for x, _ in own], pa.binary()), pa.array([y for _, y in own], pa.string())], ["bits", "lang"]
            )

    drawn = rows.withColumn("_unit", unit).where(F.col("_unit") < share).dropDuplicates(["_unit", "lang"])  # rows that repeat are drawn once

    def learn(batches):
        taken = sorted((y, x) for batch in batches for x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        packed = np.frombuffer(b"".join(x for _, x in taken), np.uint8).reshape(-1, DIM // 8)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(packed, [y for y, _ in taken]))], pa.binary())], ["model"])

    sample = drawn.select("text", "lang").mapInArrow(lean(bits), "bits binary, lang string").repartition(1)
    made = sample.mapInArrow(lean(learn), "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else None


def predict(docs: DataFrame, model: Model | None, names_of: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """docs with lang_pred, score and, if names_of has a third name, evidence() (named as names_of says), from whole texts alone.

    lang_pred is UNKNOWN, score and evidence 0 where the text is null or has no letter, or where there is no model. The score is
    the winning regression value carried from -1..1 to 0..1. Equal values go to the label that is first by name.
    """
    schema = docs.withColumns({names_of[0]: F.lit("").cast("string"), **{n: F.lit(0.0) for n in names_of[1:]}}).schema

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                texts = part.column(at).to_pylist()
                names, scores, shown = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
                rows = [k for k, x in enumerate(texts) if model is not None and x and LETTER.search(x)]
                if rows:
                    values = model.scores([texts[k] for k in rows])
                    shown[rows] = evidence(values)
                    values = values[:, :-1]
                    for k, best, value in zip(rows, values.argmax(1).tolist(), values.max(1).tolist(), strict=True):
                        names[k], scores[k] = model.labels[best], min(max((value + 1) / 2, 0.0), 1.0)
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(names, pa.string()), pa.array(scores), pa.array(shown)][: len(names_of)]], names=[*part.schema.names, *names_of])

    return docs.mapInArrow(lean(run), schema)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; see train() and predict().

    Held out are documents whose crc32(doc_id as text) mod 4 is 2; a null doc_id is not. Repeated rows are judged alike.
    An empty table gives no row.
    """
    docs = table(spark, sf_dir, "documents")
    out = predict(docs.select("doc_id", F.col("text").cast("string").alias("text")), train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
