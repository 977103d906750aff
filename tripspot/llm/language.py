"""Language of whole texts by string-kernel ridge regression on Nystroem landmarks."""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tripspot.llm.sample import first_by_hash

SLOTS = 1 << 15
GRAMS = (2, 3, 4)
TEXTS = 64  # texts in one matrix product
CODES = 1 << 20  # characters hashed at once
UNKNOWN = "und"
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


class Model(NamedTuple):
    """Landmarks' gram presence (packed bits), their gram counts, the languages, and one weight per landmark and
    language."""

    landmarks: bytes
    sizes: np.ndarray
    languages: list
    weights: np.ndarray


def letters(texts: pa.Array) -> pa.Array:
    """Lower-case letters; whatever lies between them is one space. Null is empty."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL]+", " ")


def presence(texts: list[str]) -> np.ndarray:
    """One row per text: which hashed n-grams of 2, 3 and 4 characters occur in it anywhere."""
    out = np.zeros((len(texts), SLOTS), np.uint8)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    longest = max(GRAMS)
    flat = out.reshape(-1)
    for first in range(0, len(codes), CODES):
        c, r = codes[first : first + CODES + longest - 1], row[first : first + CODES + longest - 1]
        for n in GRAMS:
            size = len(c) - n + 1
            if size <= 0:
                continue
            total = np.full(size, n * 0x01000193 & 0xFFFFFFFF, np.uint32)
            for j in range(n):
                total = (total ^ c[j : j + size]) * FACTORS[j]
                total ^= total >> np.uint32(15)
            at = r[:size] * SLOTS + (total * FACTORS[4] >> np.uint32(17)).astype(np.int64)
            flat[at[r[:size] == r[n - 1 : n - 1 + size]]] = 1
    return out


def _gram_bits(batches):
    for batch in batches:
        texts = letters(batch.column("text")).to_pylist()
        for i in range(0, len(texts), TEXTS):
            bits = np.packbits(presence(texts[i : i + TEXTS]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").slice(i, len(bits)), batch.column("place").slice(i, len(bits)),
                 pa.array([b.tobytes() for b in bits], pa.binary())],
                ["lang", "place", "bits"],
            )


def learn(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", per_language=400, landmarks=16, ridge=1e-3) -> Model:
    """Fit on rows with a language: of each language the `per_language` ids that come first in a hashed order, of
    which `landmarks` with at least the median number of grams are landmarks.

    That sample is the only thing the driver sees, 4 KB for each of its rows whatever the length of its texts; the
    texts themselves are hashed where they are. The number of languages is taken to be small.

    The kernel counts n-grams that occur in both texts, divided by the root of the product of their numbers. Landmark
    kernel values are whitened (Nystroem), and a ridge regression for each language against the rest is solved on them.
    """
    known = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    ).filter("id is not null and lang is not null and text is not null")
    chosen, _ = first_by_hash(known, "lang", F.lit(per_language), per_language)
    sample = known.join(F.broadcast(chosen), ["id", "lang"])  # at most per_language rows for each language
    sample = sample.groupBy("lang", "place").agg(F.min("text").alias("text"))
    rows = sample.mapInArrow(_gram_bits, "lang string, place int, bits binary").orderBy("lang", "place").collect()
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return Model(b"", np.zeros(0), [], np.zeros((0, 0)))
    bits = np.stack([np.frombuffer(r["bits"], np.uint8) for r in rows])
    label = np.array([languages.index(r["lang"]) for r in rows])
    sizes = np.bitwise_count(bits).sum(axis=1).astype(np.float64)
    marks = []
    for k in range(len(languages)):
        own = np.flatnonzero(label == k)
        marks += list(own[sizes[own] >= np.median(sizes[own])][:landmarks])
    model = Model(bits[marks].tobytes(), sizes[marks], languages, np.zeros((0, 0)))
    kernel = np.concatenate(
        [_kernel(np.unpackbits(bits[i : i + TEXTS], axis=1), model) for i in range(0, len(bits), TEXTS)]
    )
    values, vectors = np.linalg.eigh(kernel[marks])
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ whiten
    wanted = (label[:, None] == np.arange(len(languages))).astype(np.float64)
    gram = features.T @ features + ridge * len(features) * np.eye(features.shape[1])
    return model._replace(weights=whiten @ np.linalg.solve(gram, features.T @ wanted))


@functools.lru_cache(maxsize=2)
def _marks(landmarks: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(landmarks, np.uint8).reshape(-1, SLOTS // 8), axis=1).T.astype(np.float32)


def _kernel(present: np.ndarray, model: Model) -> np.ndarray:
    shared = present.astype(np.float32) @ _marks(model.landmarks)
    size = present.sum(axis=1, dtype=np.int64)
    return shared / np.sqrt(np.maximum(1, size)[:, None] * np.maximum(1, model.sizes)[None, :])


def _predict(batches, model: Model, carried: bool, unlearned: str):
    for batch in batches:
        text = batch.column("text")
        lettered = pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(zero_copy_only=False)
        for i in range(0, len(text), TEXTS):
            part, has = letters(text.slice(i, TEXTS)).to_pylist(), lettered[i : i + TEXTS]
            if model.languages:
                values = _kernel(presence(part), model) @ model.weights
                best, score = values.argmax(axis=1), np.clip(values.max(axis=1), 0, 1)
            else:
                best, score = np.zeros(len(part), int), np.zeros(len(part))
            names = [(model.languages[b] if model.languages else unlearned) if h else UNKNOWN for b, h in zip(best, has)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.where(has, score, 0.0)),
                 *(c.slice(i, TEXTS) for c, name in zip(batch.columns, batch.schema.names) if carried or name != "text")],
                ["lang_pred", "score", *(name for name in batch.schema.names if carried or name != "text")],
            )


def predict(
    docs: DataFrame, model: Model, id_col="doc_id", text_col="text", carry: tuple[str, ...] | None = None, unlearned=UNKNOWN
) -> DataFrame:
    """id, lang_pred and score (0 to 1) of every whole text, in one pass without a shuffle.

    A null text or one without a letter is `und` with score 0. If no language was learned, every other text is
    `unlearned` with score 0, which is `und` as well unless the caller must tell the two apart. Of equal scores the language that sorts first wins. Repeated rows and null ids are rows like others. Extra columns
    are ignored; with `carry` (names, possibly none) the text and those columns come back too, for use as a filter.
    """
    extra = [F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry or ())]
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *extra)
    fields = [f"`{name}` {kind}" for name, kind in own.dtypes if carry is not None or name != "text"]
    out = own.mapInArrow(
        functools.partial(_predict, model=model, carried=carry is not None, unlearned=unlearned),
        ", ".join(["lang_pred string, score double", *fields])
    )
    names = [F.col("id").alias(id_col), "lang_pred", "score"]
    names += [F.col("text").alias(text_col)] if carry is not None else []
    return out.select(*names, *[F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry or ())])
