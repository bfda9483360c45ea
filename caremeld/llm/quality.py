"""A quality classifier: a byte-level convolutional network in numpy.

Chunks of bytes that overlap by half cover the whole text. Learned filters slide over each chunk; the largest response of every
filter in the chunk goes through a small dense layer, the largest outcome of every unit over all chunks, and its mean, are
combined into one probability. It is trained by gradient descent on a sample of labelled rows whose size is a parameter; of
a long training text it draws some chunks anew each epoch, while scores always come from all chunks. Few labelled texts are
short; so that shortness alone does not count against a text, a share of the accepted ones is cut to a few words.

Null and empty texts are one empty chunk and get the same score. Rows without a label, or without an id, don't train;
if no labelled row of some class exists, the score is 0.5. The sample is drawn by a hash of the id, so runs agree. Labels,
ids, languages and sources are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremeld.llm.shared import col, per_text, slices

PAD = 256


@dataclass(frozen=True)
class Network:
    """``sample``: labelled rows to train on, half of them of each class, with their whole texts; ``shortened``: the share of
    them, of both classes, that a step sees a few words of; the rest is the shape of the network and of its training."""

    sample: int = 3_000
    chunk: int = 256
    width: int = 8
    stride: int = 2
    embedding: int = 8
    filters: int = 32
    units: int = 16
    epochs: int = 12
    least_steps: int = 400
    batch: int = 32
    rate: float = 0.004
    shortened: float = 0.2


def chunks_of(text: str, network: Network) -> np.ndarray:
    """Overlapping chunks of bytes as rows, the last one padded."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    step = network.chunk // 2
    n = max(1, -(-(len(raw) - step) // step))
    padded = np.full((n + 1) * step, PAD, np.int16)
    padded[: len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, network.chunk)[::step]


class Model:
    def __init__(self, network: Network, weights: dict[str, np.ndarray]):
        self.network, self.weights = network, weights

    @staticmethod
    def new(network: Network) -> Model:
        rng = np.random.default_rng(5)
        w, e, f, u = network.width, network.embedding, network.filters, network.units
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        return Model(
            network,
            {
                "embed": rng.normal(0, 1, (PAD + 1, e)).astype(np.float32),
                "filter": draw(w * e, f),
                "filter_bias": np.zeros(f, np.float32),
                "dense": draw(f, u),
                "dense_bias": np.zeros(u, np.float32),
                "last": draw(2 * u, 1),
                "last_bias": np.zeros(1, np.float32),
            },
        )

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        n = self.network
        return np.lib.stride_tricks.sliding_window_view(chunks, n.width, axis=1)[:, :: n.stride]

    def responses(self, chunks: np.ndarray) -> np.ndarray:
        """The responses of all filters at all places: sums of a table row for each byte of a window."""
        n, w = self.network, self.weights
        places = (n.chunk - n.width) // n.stride + 1
        per_byte = w["filter"].reshape(n.width, n.embedding, n.filters)
        out = np.broadcast_to(w["filter_bias"], (len(chunks), places, n.filters)).copy()
        for k in range(n.width):
            table = w["embed"] @ per_byte[k]
            out += table[chunks[:, k : k + places * n.stride : n.stride]]
        return out

    def units(self, chunks: np.ndarray) -> np.ndarray:
        w = self.weights
        pooled = np.maximum(self.responses(chunks).max(axis=1), 0)
        return np.maximum(pooled @ w["dense"] + w["dense_bias"], 0)

    def score(self, text: str) -> float:
        chunks, w = chunks_of(text, self.network), self.weights
        most, total = np.zeros(self.network.units, np.float32), np.zeros(self.network.units, np.float64)
        for a, b in slices(len(chunks), 64):
            units = self.units(chunks[a:b])
            most = np.maximum(most, units.max(axis=0))
            total += units.sum(axis=0)
        logit = np.concatenate([most, total / len(chunks)]) @ w["last"][:, 0] + w["last_bias"][0]
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))

    def gradients(self, chunks: np.ndarray, owner: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss of texts; ``owner`` is the text of each chunk, ascending."""
        n, w = self.network, self.weights
        rows = np.arange(len(chunks))
        at, top = np.empty((len(chunks), n.filters), np.int64), np.empty((len(chunks), n.filters), np.float32)
        for a, b in slices(len(chunks), 64):
            responses = self.responses(chunks[a:b])
            at[a:b] = responses.argmax(axis=1)
            top[a:b] = np.take_along_axis(responses, at[a:b, None], 1)[:, 0]
        pooled = np.maximum(top, 0)
        units = np.maximum(pooled @ w["dense"] + w["dense_bias"], 0)
        first = np.searchsorted(owner, np.arange(len(labels)))
        most = np.maximum.reduceat(units, first)
        counts = np.bincount(owner, minlength=len(labels))[:, None]
        features = np.concatenate([most, np.add.reduceat(units, first) / counts], axis=1)
        logit = np.clip(features @ w["last"][:, 0] + w["last_bias"][0], -30, 30)
        error = ((1 / (1 + np.exp(-logit)) - labels) * weight / len(labels)).astype(np.float32)
        out = {"last": (features.T @ error)[:, None], "last_bias": error.sum(keepdims=True)}
        back = error[:, None] * w["last"].T
        u = n.units
        winner = units == most[owner]
        shared = np.add.reduceat(winner, first).astype(np.float32)
        d_units = winner * (back[:, :u] / shared)[owner] + (back[:, u:] / counts)[owner]
        d_units = (d_units * (units > 0)).astype(np.float32)
        out["dense"], out["dense_bias"] = pooled.T @ d_units, d_units.sum(axis=0)
        d_top = (d_units @ w["dense"].T) * (top > 0)
        out["filter_bias"] = d_top.sum(axis=0)
        # only the bytes under a filter's largest response are touched
        per_byte = w["filter"].reshape(n.width, n.embedding, n.filters)
        d_filter, d_embed = np.zeros_like(per_byte), np.zeros_like(w["embed"])
        flat = d_top.ravel()
        filters = np.tile(np.arange(n.filters), len(chunks))
        for k in range(n.width):
            byte = chunks[rows[:, None], at * n.stride + k].astype(np.int64).ravel()
            table = np.bincount(byte * n.filters + filters, flat, (PAD + 1) * n.filters).reshape(PAD + 1, n.filters)
            d_filter[k] = w["embed"].T @ table
            d_embed += table @ per_byte[k].T
        return out | {"filter": d_filter.reshape(-1, n.filters), "embed": d_embed}


def cut_short(chunks: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A few words out of one of the chunks, padded."""
    raw = chunks[rng.integers(len(chunks))]
    raw = raw[raw != PAD]
    n = int(rng.integers(1, 81))
    begin = int(rng.integers(max(1, len(raw) - n + 1)))
    out = np.full((1, chunks.shape[1]), PAD, chunks.dtype)
    out[0, : len(raw[begin : begin + n])] = raw[begin : begin + n]
    return out


def trained(texts: list[np.ndarray], labels: np.ndarray, network: Network = Network()) -> Model | None:
    """A model fitted to chunks of texts; None without examples of both classes."""
    if len(set(labels.tolist())) < 2:
        return None
    model, rng = Model.new(network), np.random.default_rng(6)
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.weights.items()}
    in_epoch = -(-len(texts) // network.batch)
    epochs = max(network.epochs, -(-network.least_steps // in_epoch))
    steps, step = epochs * in_epoch, 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a, b in slices(len(order), network.batch):
            picked = order[a:b]
            parts = [cut_short(texts[i], rng) if rng.random() < network.shortened else texts[i] for i in picked]
            owner = np.repeat(np.arange(len(picked)), [len(p) for p in parts])
            step += 1
            rate = network.rate * min(1, 10 * step / steps) * (1 - (step - 1) / steps)
            for k, g in model.gradients(np.concatenate(parts), owner, labels[picked], weight[picked]).items():
                m, v = state[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                corrected = m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
                model.weights[k] = (model.weights[k] - rate * corrected).astype(np.float32)
    return model


def fitted(documents: DataFrame, labelled: DataFrame, id: str = "doc_id", text: str = "text", network: Network = Network()) -> Model | None:
    """Trains on a bounded sample of ``labelled`` (``doc_id``, ``label`` 0 or 1), drawn by hash, half of it from each class.

    At most ``sample`` ids are broadcast; the whole texts of these rows, and of no others, reach the driver. Of rows that repeat
    a labelled id the first text in order counts.
    """
    usable = labelled.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    wanted = [
        usable.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(network.sample // 2)
        for label in (0, 1)
    ]
    wanted = wanted[0].union(wanted[1]).groupBy("doc_id").agg(F.min("label").alias("label"))
    found = documents.select(col(id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text")).join(F.broadcast(wanted), "doc_id")
    rows = sorted(found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect())
    texts = [chunks_of(r.text, network) for r in rows]
    return trained(texts, np.array([r.label for r in rows]), network)


def scores(text: Column, model: Model | None) -> Column:
    """The probability of label 1 for each text."""
    return per_text(lambda: model.score if model else lambda value: 0.5, "double")(text)
