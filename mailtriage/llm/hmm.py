"""Language-model scores by a hidden Markov model over word classes.

Word counts come from all training texts.  The most frequent words are classes of their own; the others fall
into classes by their last two bytes, inside which a word's share is its smoothed count.  Latent states are
trained by Baum-Welch: the first estimate comes from a bounded sample, every later pass adds up expected
counts over all training texts, partition by partition.  A text's likelihood is exact, by the scaled forward
recursion over the whole text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtriage.llm.common import column_of, documents, text_groups, texts_of
from mailtriage.session import staged_table

END = b""  # no word is empty
STATES = 8
OWN_CLASSES = 16_384
TAIL_CLASSES = 512
FREQUENT = 400_000
SEGMENT = 512  # tokens of a training sequence; scores take whole texts
GROUP_BYTES = 8 << 20
FLUSH_WORDS = 400_000
PRIOR = 40.0


def words(text: str) -> list[bytes]:
    """Runs of bytes other than ASCII white space, with A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split()


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


class _Lookup(dict):
    """Word -> number; -1 for a word that is not listed."""

    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass
class Classes:
    """The frequent words with their counts and classes, and the size of every tail class."""

    listed: list[bytes]
    counts: np.ndarray
    own: int  # the first ``own`` listed words are classes of their own
    tail_tokens: np.ndarray
    tail_words: np.ndarray
    tokens: int
    distinct: int

    def __post_init__(self) -> None:
        self.number = self.own + TAIL_CLASSES
        total = np.concatenate([self.counts[: self.own], self.tail_tokens]) + 1.0
        self.share = total / total.sum()
        self.tail_size = np.log10(self.tail_tokens + self.tail_words + 1.0)

    def ready(self) -> _Classifier:
        return _Classifier(self)


class _Classifier:
    """Lookup tables of ``Classes``, made once in each task."""

    def __init__(self, classes: Classes):
        self.classes = classes
        self.index = _Lookup(zip(classes.listed, range(len(classes.listed))))
        rest = [classes.own + tail_class(w) for w in classes.listed[classes.own :]]
        self.of_listed = np.concatenate([np.arange(classes.own), np.array(rest, np.int64)]).astype(np.int32)

    def sequence(self, text: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(class of each token, number of each listed token or -1, words that are not listed); the end comes last."""
        tokens = [*words(text), END]
        found = np.fromiter(map(self.index.__getitem__, tokens), np.int32, len(tokens))
        rare = np.flatnonzero(found < 0)
        out = self.of_listed[found] if len(self.of_listed) else np.zeros(len(tokens), np.int32)
        missing = [tokens[i] for i in rare.tolist()]
        if missing:
            out[rare] = [self.classes.own + tail_class(w) for w in missing]
        return out, found, missing


@dataclass
class Hmm:
    """Start, transition and emission probabilities."""

    start: np.ndarray  # K
    move: np.ndarray  # K x K
    emit: np.ndarray  # classes x K


class Packed:
    """Sequences side by side, longest first, one row of tokens per time step."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        begins = (np.cumsum(lengths) - lengths)[self.order]
        steps = np.arange(int(lengths.max(initial=0)))
        self.active = len(lengths) - np.searchsorted(np.sort(lengths), steps, side="right")
        self.rank = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(self.active) - self.active, self.active)
        self.flat = begins[self.rank] + np.repeat(steps, self.active)

    def forward(self, hmm: Hmm, seen: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """(scale of every token, filtered states if ``keep``) for emissions ``seen`` [tokens, K] in packed order."""
        scale = np.empty(len(seen), np.float32)
        states = np.empty_like(seen) if keep else None
        move, at, a = hmm.move.astype(np.float32), 0, None
        for n in self.active.tolist():
            a = np.multiply(seen[at : at + n], hmm.start.astype(np.float32) if a is None else a[:n] @ move)
            total = a.sum(axis=1)
            a /= total[:, None]
            scale[at : at + n] = total
            if keep:
                states[at : at + n] = a
            at += n
        return scale, states

    def expected(self, hmm: Hmm, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected start, transition and emission counts, and the log10 likelihood."""
        classes = classes[self.flat]
        seen = hmm.emit[classes].astype(np.float32)
        scale, states = self.forward(hmm, seen, keep=True)
        back = np.ascontiguousarray(hmm.move.T.astype(np.float32))
        moves = np.zeros((STATES, STATES))
        at, ahead = len(seen), None
        for n in reversed(self.active.tolist()):
            at -= n
            beta = np.ones((n, STATES), np.float32)
            if ahead is not None:
                m = len(ahead)
                moves += states[at : at + m].T @ ahead
                beta[:m] = ahead @ back
            ahead = seen[at : at + n] * beta / scale[at : at + n, None]
            states[at : at + n] *= beta
        emit = np.stack([np.bincount(classes, weights=states[:, k], minlength=len(hmm.emit)) for k in range(STATES)], axis=1)
        return states[: self.active[0]].sum(axis=0, dtype=float), hmm.move * moves, emit, float(np.log10(scale.astype(float)).sum())


def updated(start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Hmm:
    """Probabilities from expected counts; emissions lean on the shares of the classes with ``PRIOR`` tokens."""
    start, move = start + 1.0, move + 1.0
    emit = emit + PRIOR * share[:, None]
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0, keepdims=True))


def first_estimate(sample: list[np.ndarray], share: np.ndarray, rounds: int = 12, seed: int = 7) -> Hmm:
    """Baum-Welch on a bounded sample, from slow-moving states with random emissions."""
    rng = np.random.default_rng(seed)
    emit = share[:, None] * rng.gamma(2.0, 0.5, (len(share), STATES))
    move = np.full((STATES, STATES), 0.2 / STATES) + 0.8 * np.eye(STATES)
    hmm = Hmm(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))
    if sample:
        packed, classes = Packed(np.array([len(s) for s in sample])), np.concatenate(sample)
        for _ in range(rounds):
            hmm = updated(*packed.expected(hmm, classes)[:3], share)
    return hmm


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) over all texts, with one end for each text; counted in tasks before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in text_groups(batches):
            for text in texts_of(batch):
                counts.update(words(text))
                counts[END] += 1
                if len(counts) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    return rows.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def classes_of(counts: DataFrame) -> Classes:
    """Classes from a table of counts.  The listed words are those above the smallest count (of a geometric
    scale) that leaves ``FREQUENT`` words or fewer; the rest stays in the table."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    steps = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens"), F.min("n").alias("least")).collect()
    listed, least = 0, None
    for row in sorted(steps, key=lambda r: -r["level"]):
        if listed + row["words"] > FREQUENT:
            break
        listed, least = listed + row["words"], row["least"]
    found = counts.where(F.col("n") >= least).toArrow() if least is not None else None  # FREQUENT rows at most
    pairs = sorted(zip(found["word"].to_pylist(), found["n"].to_pylist()), key=lambda p: (-p[1], p[0])) if found is not None else []
    own = min(OWN_CLASSES, len(pairs))
    mine = {w for w, _ in pairs[:own]}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, distinct = np.zeros((2, TAIL_CLASSES), np.int64)
        for batch in batches:
            for word, n in zip(column_of(batch, "word").to_pylist(), column_of(batch, "n").to_pylist()):
                if word not in mine:
                    at = tail_class(word)
                    tokens[at] += n
                    distinct[at] += 1
        at = np.flatnonzero(distinct)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(tokens[at]), pa.array(distinct[at])], ["tail", "tokens", "words"])

    tails = counts.mapInArrow(run, "tail long, tokens long, words long").groupBy("tail").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words"))
    tokens, distinct = np.zeros((2, TAIL_CLASSES))
    for row in tails.collect():
        tokens[row["tail"]], distinct[row["tail"]] = row["tokens"], row["words"]
    return Classes([w for w, _ in pairs], np.array([n for _, n in pairs], np.int64), own, tokens, distinct,
                   sum(r["tokens"] for r in steps), sum(r["words"] for r in steps))


def _segments(found: np.ndarray) -> list[np.ndarray]:
    return [found[i : i + SEGMENT] for i in range(0, len(found), SEGMENT)]


def _sample(rows: DataFrame, classes: Classes, texts: int, each: int) -> list[np.ndarray]:
    """Class sequences of about ``texts`` texts chosen by hash, ``each`` evenly spaced segments of each at most."""
    n = int(classes.counts[classes.listed.index(END)]) if END in classes.listed else max(1, rows.count())
    held = rows.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = held.value.ready()
        for batch in text_groups(batches):
            out = []
            for text in texts_of(batch):
                parts = _segments(classifier.sequence(text)[0])
                out += [parts[i].tolist() for i in sorted({int(i) for i in np.linspace(0, len(parts) - 1, min(each, len(parts)))})]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32()))], ["classes"])

    part = min(1_000_000, int(1e6 * texts / n) + 1)
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1_000_000)) < part).select("text")
    found = chosen.mapInArrow(run, "classes array<int>").toArrow()["classes"].to_pylist()
    return [np.array(c, np.int32) for c in sorted(found)]


def baum_welch(rows: DataFrame, classes: Classes, hmm: Hmm) -> Hmm:
    """One pass over all texts: expected counts by partition, added up by key, one row a class and state table."""
    held = rows.sparkSession.sparkContext.broadcast((classes, hmm))  # bounded by FREQUENT and the classes

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, model = held.value
        classifier = own.ready()
        start, move, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((own.number, STATES))
        for batch in text_groups(batches, GROUP_BYTES):
            parts = [s for text in texts_of(batch) for s in _segments(classifier.sequence(text)[0])]
            a, b, c, _ = Packed(np.array([len(p) for p in parts])).expected(model, np.concatenate(parts))
            start += a
            move += b
            emit += c
        table = np.concatenate([emit, move, start[None]])
        at = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(table[at, k]) for k in range(STATES))], ["row", *names])

    names = [f"s{k}" for k in range(STATES)]
    parts = rows.select("text").mapInArrow(run, "row long, " + ", ".join(f"{n} double" for n in names))
    found = parts.groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
    table = np.zeros((classes.number + STATES + 1, STATES))
    table[found["row"].to_numpy()] = np.stack([found[n].to_numpy() for n in names], axis=1)
    return updated(table[-1], table[-1 - STATES : -1], table[: classes.number], classes.share)


def fit(rows: DataFrame, passes: int = 2, sample_texts: int = 2000, segments: int = 2) -> tuple[DataFrame, Classes, Hmm]:
    """(counts of all words, classes, model) from all of ``rows`` (doc_id, text)."""
    counts = staged_table(word_counts(rows), "words")
    classes = classes_of(counts)
    hmm = first_estimate(_sample(rows, classes, sample_texts, segments), classes.share)
    for _ in range(passes):
        hmm = baum_welch(rows, classes, hmm)
    return counts, classes, hmm


def score(docs: DataFrame, learn: Column, passes: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score: one row per input row, whole texts.

    ``learn`` picks the training rows.  base_score adds log10((c + 1) / (N + V + 1)) over the tokens; score is
    the model's log10 likelihood.  Null and empty texts are one end token.  Words that tasks do not hold are
    looked up by one join on the word, so a vocabulary of any size is counted in full.  Repeated rows and null
    ids are scored like any other; without training rows every word is unknown; an empty table gives no rows.
    """
    train = documents(docs.where(learn), id_col, text_col)
    counts, classes, hmm = fit(train, passes)
    held = docs.sparkSession.sparkContext.broadcast((classes, hmm))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, model = held.value
        classifier = own.ready()
        logs = np.log10(own.counts + 1.0)
        for batch in text_groups(batches, GROUP_BYTES):
            sequences, rare, sums = [], [], []
            for text in texts_of(batch):
                found, listed, missing = classifier.sequence(text)
                known, tail = listed >= 0, found >= own.own
                taken = logs[listed[known]].sum() if len(logs) else 0.0
                inside = logs[listed[known & tail]].sum() if len(logs) else 0.0
                inside -= own.tail_size[found[tail] - own.own].sum()
                sequences.append(found)
                rare.append(missing)
                sums.append((len(found), int(known.sum()), float(taken), float(inside)))
            packed = Packed(np.array([len(s) for s in sequences]))
            scale, _ = packed.forward(model, model.emit[np.concatenate(sequences)[packed.flat]].astype(np.float32), keep=False)
            total = np.zeros(len(sequences))
            total[packed.order] = np.bincount(packed.rank, weights=np.log10(scale.astype(float)), minlength=len(sequences))
            n, known, taken, inside = (np.array(x) for x in zip(*sums))
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.array(n), pa.array(known), pa.array(taken), pa.array(inside + total),
                 pa.array(rare, pa.list_(pa.binary()))], ["doc_id", "n_tokens", "known", "taken", "inside", "rare"])

    schema = "doc_id long, n_tokens long, known long, taken double, inside double, rare array<binary>"
    first = documents(docs, id_col, text_col).mapInArrow(run, schema).withColumn("rid", F.monotonically_increasing_id())
    first = staged_table(first, "scores")
    looked = first.select("rid", F.explode("rare").alias("word")).join(counts, "word")
    looked = looked.groupBy("rid").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("logs"))
    out = first.drop("rare").join(looked, "rid", "left")
    logs, more = F.coalesce("logs", F.lit(0.0)), F.coalesce("more", F.lit(0))
    size = float(np.log10(classes.tokens + classes.distinct + 1.0))
    return out.select(
        "doc_id", "n_tokens", (F.col("known") + more).alias("n_known"), F.lit(classes.tokens).cast("long").alias("train_tokens"),
        (F.col("taken") + logs - F.col("n_tokens") * F.lit(size)).alias("base_score"), (F.col("inside") + logs).alias("score"))
