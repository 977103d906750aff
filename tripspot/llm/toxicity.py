"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tripspot.llm.sample import first_by_hash
from tripspot.llm.words import U64, blocks, hash_spans, mix, runs

TOKEN = np.zeros(256, bool)
TOKEN[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
PREFIXES = (3, 4, 5, 6, 7, 8)
BITS = 18
NONE = 1 << BITS  # the feature that is absent, of weight 0
CHUNK = 64
SPAN = 0.5
TAGGED = "id long, score double, spans array<struct<start:int,end:int,marginal:double>>"


class Tokens(NamedTuple):
    """Tokens of some rows: tokens in each row, features of each token, and byte offsets in `data`."""

    lengths: np.ndarray
    features: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


class Model(NamedTuple):
    """Emission weight of each feature for the toxic state and, last, its bias; log-potentials of the four transitions;
    the logistic weights of a document's summary."""

    emission: np.ndarray
    transition: np.ndarray
    document: np.ndarray


def tokens(texts: pa.Array):
    """For runs of rows: maximal runs of letters and digits, lower-cased, with their hashed features: the token itself
    and its beginnings of 3 to 8 bytes, which inflected forms share."""
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    for first, data, offsets in blocks(lowered):
        start, end = runs(TOKEN[data], offsets)
        features = np.full((len(start), 1 + len(PREFIXES)), NONE, np.int32)
        whole = hash_spans(data, start, end)
        features[:, 0] = (whole >> U64(64 - BITS)).astype(np.int32)
        for j, size in enumerate(PREFIXES, 1):
            long = np.flatnonzero(end - start >= size)
            part = mix(hash_spans(data, start[long], start[long] + size) + U64(size))
            features[long, j] = (part >> U64(64 - BITS)).astype(np.int32)
        yield first, Tokens(np.diff(np.searchsorted(start, offsets)), features, start, end, data, offsets)


def _scan(odds: np.ndarray, lengths: np.ndarray, a: np.ndarray) -> np.ndarray:
    """r[t] = odds[t] * (a01 + a11 r[t-1]) / (a00 + a10 r[t-1]) along each row, from the first state (r = 0).

    Rows are cut into chunks that advance together: once to compose each chunk's 2 x 2 maps, then over the chunks of a
    row to find what enters each, then to fill in. So a text of any length costs few steps, and nothing is approximated.
    """
    (a00, a01), (a10, a11) = a
    counts = -(-lengths // CHUNK)
    row = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = (np.cumsum(lengths) - lengths)[row] + CHUNK * number
    size = np.minimum(CHUNK, lengths[row] - CHUNK * number)
    order = np.argsort(-size, kind="stable")
    begin, length = start[order], size[order]
    n = len(begin)
    p00, p01, p10, p11 = np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)
    for t in range(int(length[0]) if n else 0):
        m = int(np.searchsorted(-length, -t, "left"))
        e = odds[begin[:m] + t]
        x0, x1, y0, y1 = p00[:m], p01[:m], p10[:m], p11[:m]
        p00[:m], p01[:m] = x0 * a00 + x1 * a10, (x0 * a01 + x1 * a11) * e
        p10[:m], p11[:m] = y0 * a00 + y1 * a10, (y0 * a01 + y1 * a11) * e
        if t % 8 == 7:
            top = np.maximum(np.maximum(p00[:m], p01[:m]), np.maximum(p10[:m], p11[:m]))
            for p in (p00, p01, p10, p11):
                p[:m] /= top
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    enter = np.zeros(n)
    first = np.cumsum(counts) - counts
    by_count = np.argsort(-counts, kind="stable")
    ratio = np.zeros(len(lengths))
    for k in range(int(counts.max()) if len(counts) else 0):
        rows = by_count[: int(np.searchsorted(-counts[by_count], -k, "left"))]
        at = back[first[rows] + k]
        enter[at] = r = ratio[rows]
        ratio[rows] = (p01[at] + r * p11[at]) / (p00[at] + r * p10[at])
    out = np.empty(len(odds))
    r = enter
    for t in range(int(length[0]) if n else 0):
        m = int(np.searchsorted(-length, -t, "left"))
        r = r[:m]
        at = begin[:m] + t
        r = odds[at] * (a01 + a11 * r) / (a00 + a10 * r)
        out[at] = r
    return out


def forward_backward(emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray):
    """Marginal probability of the toxic state for each token, and the two passes' odds.

    Before the first and after the last token of a row stands a clean one.
    """
    odds = np.exp(np.clip(emission, -20, 20))
    a = np.exp(transition)
    ahead = _scan(odds, lengths, a)
    behind = _scan(odds[::-1], lengths[::-1], a.T)[::-1]
    both = ahead * (behind / odds)
    return both / (1 + both), ahead, behind



def emissions(features: np.ndarray, emission: np.ndarray, bias: float) -> np.ndarray:
    return emission[features].sum(axis=1, dtype=np.float64) + bias


def summaries(marginal: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What a document's score is made of: 1, its largest log-odds, and the expected number of toxic tokens."""
    out = np.zeros((len(lengths), 3))
    out[:, 0] = 1
    out[:, 1] = -15
    some = np.flatnonzero(lengths)
    if len(some):
        at = (np.cumsum(lengths) - lengths)[some]
        top = np.clip(np.maximum.reduceat(marginal, at), 1e-7, 1 - 1e-7)
        out[some, 1] = np.log(top / (1 - top))
        out[some, 2] = np.log1p(np.add.reduceat(marginal, at))
    return out


def token_labels(row: np.ndarray, features: np.ndarray, toxic: np.ndarray, noise=0.02) -> np.ndarray:
    """Tokens that explain the toxic documents: the labels that the field learns from.

    A feature may explain if few clean documents have it. The one in most unexplained toxic documents is taken, these
    count as explained, and so on while a feature explains at least two documents and 0.3 % of them. A word that is
    merely frequent in copies of one toxic document explains nothing that the words before it left over.
    """
    width = features.shape[1]
    pair = np.unique(np.repeat(row, width) * (NONE + 1) + features.ravel())
    doc, feature = pair // (NONE + 1), pair % (NONE + 1)
    doc, feature = doc[feature != NONE], feature[feature != NONE]
    bad = toxic[doc]
    inside = np.bincount(feature[bad], minlength=NONE)
    outside = np.bincount(feature[~bad], minlength=NONE)
    allowed = outside <= noise * inside
    doc, feature = doc[bad & allowed[feature]], feature[bad & allowed[feature]]
    explains = np.zeros(NONE + 1, bool)
    least = max(2, 0.003 * toxic.sum())
    while len(doc):
        left = np.bincount(feature, minlength=NONE)
        best = int(left.argmax())
        if left[best] < least:
            break
        explains[best] = True
        keep = ~np.isin(doc, doc[feature == best])
        doc, feature = doc[keep], feature[keep]
    return explains[features].any(axis=1) & toxic[row]


def fit(texts: list[str], toxic: np.ndarray, epochs=30, rate=0.5, ridge=1e-4) -> Model:
    """Maximum likelihood of the token labels by AdaGrad, then a logistic regression of the documents' labels."""
    parts = [t for _, t in tokens(pa.array(texts, pa.string()))]
    lengths = np.concatenate([t.lengths for t in parts]) if parts else np.zeros(0, int)
    if not lengths.sum() or not toxic.any():
        return Model(np.append(np.zeros(NONE), -9.0), np.array([[0.0, -9.0], [0.0, 0.0]]), np.array([-9.0, 0.0, 0.0]))
    features = np.concatenate([t.features for t in parts])
    row = np.repeat(np.arange(len(lengths)), lengths)
    label = token_labels(row, features, toxic)
    # Transitions are counted with a clean token before and after every row.
    some = lengths > 0
    last = np.cumsum(lengths)[some] - 1
    first = last - lengths[some] + 1
    inner = np.ones(len(row), bool)
    inner[first] = False
    seen = np.zeros((2, 2))
    y = label.astype(int)
    np.add.at(seen, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
    np.add.at(seen, (0, y[first]), 1)
    np.add.at(seen, (y[last], 0), 1)
    used = np.unique(features)
    compact = np.searchsorted(used, features).astype(np.int32)
    weight, squares = np.zeros(len(used) + 1), np.full(len(used) + 1, 1e-6)  # the last is the bias
    weight[-1] = -3.0
    transition, t_squares = np.array([[0.0, -2.0], [0.0, 0.0]]), np.full((2, 2), 1e-6)
    absent = used == NONE
    for _ in range(epochs):
        e = weight[compact].sum(axis=1) + weight[-1]
        p, ahead, behind = forward_backward(e, lengths, transition)
        gap = label - p
        gradient = np.append(np.bincount(compact.ravel(), np.repeat(gap, compact.shape[1]), len(used)), gap.sum())
        gradient -= ridge * len(row) / 1000 * weight
        gradient[:-1][absent] = 0
        squares += gradient**2
        weight += rate * gradient / np.sqrt(squares)
        a = np.exp(transition)
        before = np.where(inner, np.append(0.0, ahead[:-1]), 0.0)
        parts4 = [a[0, 0] + 0 * before, a[0, 1] * behind, a[1, 0] * before, a[1, 1] * before * behind]
        total = sum(parts4)
        expected = np.array([(x / total).sum() for x in parts4]).reshape(2, 2)
        expected[1, 0] += p[last].sum()
        expected[0, 0] += (1 - p[last]).sum()
        step = (seen - expected) - ridge * len(row) / 1000 * transition
        step[0, 0] = 0  # fixed: only differences count
        t_squares += step**2
        transition += rate * step / np.sqrt(t_squares)
    emission = np.zeros(NONE)
    real = ~absent
    emission[used[real]] = weight[:-1][real]
    p, _, _ = forward_backward(weight[compact].sum(axis=1) + weight[-1], lengths, transition)
    x, beta = summaries(p, lengths), np.zeros(3)
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(3)
        beta += np.linalg.solve(hessian, x.T @ (toxic - q) - 1e-2 * beta)
    return Model(np.append(emission, weight[-1]), transition, beta)


def learn(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", toxic_col="toxic", toxic_rows=600, clean_rows=1200) -> Model:
    """Fit on whole texts of labelled rows: `toxic_rows` ids of the toxic and `clean_rows` of the clean ones, those that
    come first in a hashed order. The scores' prior is that of all labelled rows.

    That bounded sample is all that reaches the driver. Labels that are null are left out; an id labelled twice is
    toxic if one of its labels is.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(toxic_col).cast("int").alias("toxic")).dropna()
    marked = marked.groupBy("id").agg(F.max("toxic").alias("toxic"))
    limit = F.when(F.col("toxic") == 1, F.lit(toxic_rows)).otherwise(F.lit(clean_rows))
    chosen, counts = first_by_hash(marked, "toxic", limit, max(toxic_rows, clean_rows))
    counts = {r["toxic"]: r["size"] for r in counts.collect()}  # one row for each class
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    rows = own.join(F.broadcast(chosen.drop("place")), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = sorted(rows.collect())
    toxic = np.array([r["toxic"] == 1 for r in rows], bool)
    model = fit([r["text"] for r in rows], toxic)
    bad, good = counts.get(1, 0), sum(n for k, n in counts.items() if k != 1)
    if toxic.any() and not toxic.all():
        model.document[0] += np.log(bad / good) - np.log(toxic.sum() / (~toxic).sum())
    return model


def _tag(batches, model: Model):
    emission, bias = np.append(model.emission[:-1], 0.0).astype(np.float32), float(model.emission[-1])
    for batch in batches:
        for first, t in tokens(batch.column("text")):
            n = len(t.lengths)
            marginal, _, _ = forward_backward(emissions(t.features, emission, bias), t.lengths, model.transition)
            score = 1 / (1 + np.exp(-np.clip(summaries(marginal, t.lengths) @ model.document, -30, 30)))
            hits = np.flatnonzero(marginal >= SPAN)
            row = np.searchsorted(t.offsets, t.start[hits], "right") - 1
            # Offsets count code points: bytes that do not continue a character.
            place = np.zeros(len(t.data) + 1, np.int64)
            np.cumsum((t.data & 0xC0) != 0x80, out=place[1:])
            origin = place[t.offsets[row]]
            spans = pa.StructArray.from_arrays(
                [pa.array((place[t.start[hits]] - origin).astype(np.int32)),
                 pa.array((place[t.end[hits]] - origin).astype(np.int32)), pa.array(marginal[hits])],
                ["start", "end", "marginal"],
            )
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32)), spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(first, n), pa.array(score), lists], ["id", "score", "spans"]
            )


def tag(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """id, score (0 to 1) and the toxic spans (code-point offsets, marginal) of every whole text, without a shuffle.

    A null or empty text, or one without letters and digits, has no spans and the score of a text without evidence.
    Repeated rows and null ids are rows like others, extra columns are ignored.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return own.mapInArrow(functools.partial(_tag, model=model), TAGGED).withColumnRenamed("id", id_col)
