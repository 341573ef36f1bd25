"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads lower-case UTF-8 in segments of ``SEGMENT`` bytes, labels every byte from the states of
both directions, and a document's probabilities are the mean over its letter bytes.  Gates are clipped lines
in place of sigmoids, which keeps the recurrence to sums, products and comparisons.  Training is plain numpy:
backpropagation through time with Adam on a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtriage.llm.common import column_of, documents, text_groups, texts_of

UNKNOWN = "und"
SEGMENT = 128
BATCH = 2048
HIDDEN = 8
LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes other than letters all read as a blank.
FOLD = np.array([b if b >= 128 or chr(b).islower() else 32 for b in range(256)], np.uint8)


@dataclass
class Direction:
    """Input tables and recurrent weights: gates (keep, reset) and candidate."""

    gate_in: np.ndarray  # 256 x 2H, biases included
    gate_re: np.ndarray  # H x 2H
    cand_in: np.ndarray  # 256 x H
    cand_re: np.ndarray  # H x H

    @staticmethod
    def random(rng: np.random.Generator) -> Direction:
        def draw(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return Direction(draw(256, 2 * HIDDEN, scale=0.1) + np.float32(0.6), draw(HIDDEN, 2 * HIDDEN, scale=0.1),
                         draw(256, HIDDEN, scale=0.3), draw(HIDDEN, HIDDEN, scale=0.3))

    def run(self, x: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """States [T, B, H] after each byte of x [T, B]; ``tape`` keeps what the gradient needs."""
        steps, width = x.shape
        states = np.empty((steps, width, HIDDEN), np.float32)
        h = np.zeros((width, HIDDEN), np.float32)
        gate, gate_h = np.empty((2, width, 2 * HIDDEN), np.float32)
        cand, cand_h = np.empty((2, width, HIDDEN), np.float32)
        if tape is not None:
            tape.update(before=np.empty_like(states), gate=np.empty((steps, width, 2 * HIDDEN), np.float32),
                        cand=np.empty_like(states), pull=np.empty_like(states))
        for t in range(steps):
            np.take(self.gate_in, x[t], axis=0, out=gate)
            np.matmul(h, self.gate_re, out=gate_h)
            gate += gate_h
            np.maximum(gate, 0, out=gate)
            np.minimum(gate, 1, out=gate)
            np.take(self.cand_in, x[t], axis=0, out=cand)
            np.matmul(h, self.cand_re, out=cand_h)
            if tape is not None:
                tape["before"][t], tape["gate"][t], tape["pull"][t] = h, gate, cand_h
            cand_h *= gate[:, HIDDEN:]
            cand += cand_h
            np.maximum(cand, -1, out=cand)
            np.minimum(cand, 1, out=cand)
            h -= cand
            h *= gate[:, :HIDDEN]
            h += cand
            states[t] = h
            if tape is not None:
                tape["cand"][t] = cand
        return states

    def gradient(self, x: np.ndarray, tape: dict, out: np.ndarray) -> list[np.ndarray]:
        """Gradients of the four weight arrays for output gradients ``out`` [T, B, H]; clipped units leak."""
        steps, width = x.shape
        gate_d = np.empty((steps, width, 2 * HIDDEN), np.float32)
        cand_d = np.empty((steps, width, HIDDEN), np.float32)
        gate_re, cand_re = np.zeros_like(self.gate_re), np.zeros_like(self.cand_re)
        dh = np.zeros((width, HIDDEN), np.float32)
        for t in reversed(range(steps)):
            dh = dh + out[t]
            before, gate, cand, pull = tape["before"][t], tape["gate"][t], tape["cand"][t], tape["pull"][t]
            keep, reset = gate[:, :HIDDEN], gate[:, HIDDEN:]
            d_cand = dh * (1 - keep) * np.where(np.abs(cand) < 1, 1, 0.05).astype(np.float32)
            d_pull = d_cand * reset
            d_gate = np.concatenate([dh * (before - cand), d_cand * pull], axis=1)
            d_gate *= np.where((gate > 0) & (gate < 1), 1, 0.05).astype(np.float32)
            gate_d[t], cand_d[t] = d_gate, d_cand
            gate_re += before.T @ d_gate
            cand_re += before.T @ d_pull
            dh = dh * keep + d_gate @ self.gate_re.T + d_pull @ self.cand_re.T
        flat = x.ravel()
        sums = [np.stack([np.bincount(flat, weights=column, minlength=256) for column in d.reshape(len(flat), -1).T], 1)
                for d in (gate_d, cand_d)]
        return [sums[0].astype(np.float32), gate_re, sums[1].astype(np.float32), cand_re]


@dataclass
class Model:
    """Two directions and the output layer; ``langs`` are the learned labels."""

    langs: list[str]
    ahead: Direction
    back: Direction
    out: np.ndarray  # 2H x L
    bias: np.ndarray

    def label(self, x: np.ndarray) -> np.ndarray:
        """Probabilities [T, B, L] of every position of x [T, B]."""
        states = np.concatenate([self.ahead.run(x), self.back.run(x[::-1])[::-1]], axis=2)
        scores = states @ self.out + self.bias
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=2, keepdims=True)
        return scores

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities [documents, L] over letter bytes; rows without letters are zero."""
        data = [FOLD[np.frombuffer(t.lower().encode("utf-8", "replace"), np.uint8)] for t in texts]
        owner = np.repeat(np.arange(len(data)), [-(-len(d) // SEGMENT) for d in data])
        total = np.zeros((len(data), len(self.langs)))
        letters = np.zeros(len(data))
        pieces = (d[i : i + SEGMENT] for d in data for i in range(0, len(d), SEGMENT))
        for start in range(0, len(owner), BATCH):
            mine = owner[start : start + BATCH]
            x = np.full((len(mine), SEGMENT), 32, np.uint8)
            for row in x:
                piece = next(pieces)
                row[: len(piece)] = piece
            x = np.ascontiguousarray(x.T)
            counted = x != 32
            chances = np.einsum("tbl,tb->bl", self.label(x.astype(np.intp)), counted.astype(np.float32))
            np.add.at(total, mine, chances)
            np.add.at(letters, mine, counted.sum(axis=0))
        return total / np.maximum(letters, 1)[:, None]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, probability); a text without letters, or no learned language, is ``UNKNOWN`` with 0."""
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        chances = self.pooled(texts)
        return [(self.langs[int(row.argmax())], float(min(1.0, row.max()))) if LETTER.search(text) else (UNKNOWN, 0.0)
                for text, row in zip(texts, chances)]


def train(langs: list[str], segments: np.ndarray, target: np.ndarray, updates: int = 320, batch: int = 256,
          rate: float = 0.02, seed: int = 11) -> Model:
    """Adam on the mean cross-entropy of all positions; each batch takes as many segments of each language."""
    rng = np.random.default_rng(seed)
    model = Model(langs, Direction.random(rng), Direction.random(rng),
                  rng.normal(0, 0.3, (2 * HIDDEN, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    if len(langs) < 2:
        return model
    by_lang = [np.flatnonzero(target == i) for i in range(len(langs))]
    weights = [getattr(d, n) for d in (model.ahead, model.back) for n in ("gate_in", "gate_re", "cand_in", "cand_re")]
    weights += [model.out, model.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    each = max(1, batch // len(langs))
    for step in range(1, updates + 1):
        rows = np.concatenate([rng.choice(own, each) for own in by_lang])
        x, y = np.ascontiguousarray(segments[rows].T).astype(np.intp), target[rows]
        tapes: tuple[dict, dict] = ({}, {})
        ahead, back = model.ahead.run(x, tapes[0]), model.back.run(x[::-1], tapes[1])
        states = np.concatenate([ahead, back[::-1]], axis=2)
        scores = states @ model.out + model.bias
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        scores /= scores.sum(axis=2, keepdims=True)
        scores[:, np.arange(len(y)), y] -= 1
        d_scores = (scores * (x != 32)[:, :, None] / max(1, (x != 32).sum())).astype(np.float32)
        d_states = d_scores @ model.out.T
        grads = model.ahead.gradient(x, tapes[0], d_states[:, :, :HIDDEN])
        grads += model.back.gradient(x[::-1], tapes[1], np.ascontiguousarray(d_states[::-1, :, HIDDEN:]))
        grads += [np.einsum("tbh,tbl->hl", states, d_scores), d_scores.sum(axis=(0, 1))]
        size = float(np.sqrt(sum((g.astype(float) ** 2).sum() for g in grads)))
        pace = rate * min(1.0, 2 * (1 - (step - 1) / updates))
        for w, g, m, v in zip(weights, grads, first, second):
            g = g * min(1.0, 1.0 / max(size, 1e-12))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def fit(docs: DataFrame, learn: Column, rows_per_lang: int = 300, segments_per_row: int = 16, train_bytes: int = 64,
        updates: int = 320, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Train on rows where ``learn`` holds, the language is not null and the text has letters.

    The sample is bounded: about ``rows_per_lang`` rows of each language, chosen by a hash of the id, and of
    each ``segments_per_row`` evenly spaced segments at most.  Without such rows the model knows no language.
    """
    rows = documents(docs.where(learn & F.col(lang_col).isNotNull()), id_col, text_col, lang=lang_col)
    rows = rows.withColumn("lang", F.col("lang").cast("string"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return train([], np.empty((0, train_bytes), np.uint8), np.empty(0, np.int64))
    share = F.create_map(*(F.lit(v) for k, n in counts.items() for v in (k, min(1_000_000, int(1e6 * rows_per_lang / n) + 1))))
    sample = rows.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(1_000_000)) < share[F.col("lang")])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches):
            kept: tuple[list, list] = ([], [])
            for lang, text in zip(column_of(batch, "lang").to_pylist(), texts_of(batch)):
                data = text.lower().encode("utf-8", "replace")
                if LETTER.search(text):
                    last = max(0, len(data) - train_bytes)
                    for at in sorted({int(a) for a in np.linspace(0, last, min(segments_per_row, 1 + last // train_bytes))}):
                        kept[0].append(lang)
                        kept[1].append(data[at : at + train_bytes].ljust(train_bytes))
            yield pa.RecordBatch.from_arrays([pa.array(kept[0], pa.string()), pa.array(kept[1], pa.binary())], ["lang", "data"])

    found = sorted((r["lang"], bytes(r["data"])) for r in
                   sample.select("lang", "text").mapInArrow(cut, "lang string, data binary").collect())
    langs = sorted({lang for lang, _ in found})
    data = FOLD[np.frombuffer(b"".join(d for _, d in found), np.uint8)].reshape(-1, train_bytes)
    return train(langs, data, np.array([langs.index(lang) for lang, _ in found], np.int64), updates)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: one row per input row, whole texts, row-local.

    Null texts, and texts without a letter, are ``und`` with score 0; so is every text if no language was
    learned.  Null ids and repeated rows are labelled like any other; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches):
            langs, scores = zip(*held.value.predict(texts_of(batch)))
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def drop_unknown(docs: DataFrame, model: Model, min_score: float = 0.5) -> DataFrame:
    """Rows of ``docs``, all columns as they are, whose language is known with ``min_score`` or more."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches):
            found = held.value.predict([t or "" for t in texts_of(batch)])
            yield batch.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
