"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A batch of texts becomes flat numpy arrays of symbols, cut into words where no vocabulary piece crosses.
Distinct words are merged together: each round finds the best pair of every word by segmented minima and
merges its leftmost occurrence, or all occurrences at once where no new pair can come before them; merged
symbols are compacted away, and words without a pair leave.  Words of very many symbols, such as long runs of
blanks, where each merge brings the next about, are merged one by one from a heap of their pairs instead.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtriage.llm.common import column_of, documents, text_groups, texts_of

BLANK = "▁"
GROUP_BYTES = 1 << 20
NO_RANK = np.int32(1 << 30)
CODE_POINTS = 0x110000
END_ID = 2
INSIDE_BITS = 22
KNOWN_WORDS, KNOWN_CHARS = 150_000, 4 << 20  # words, and their characters, whose ids a task keeps; past that it starts anew
LONG_WORD = 256  # symbols


@dataclass
class Vocabulary:
    """Plain tables of a piece vocabulary with byte fallback.

    Symbols are the ids of plain pieces; characters that occur inside pieces without being one get symbols
    from ``size`` on; every other character is one symbol, ``unknown``.
    """

    pieces: list[str]
    plain: np.ndarray  # whether an id is an ordinary piece
    byte_ids: np.ndarray  # id of each byte
    ranks: np.ndarray  # merge order of an id, small first

    @staticmethod
    def load(path: str) -> Vocabulary:
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = np.array([not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)])
        byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        order = sorted(np.flatnonzero(plain), key=lambda i: (-sp.get_score(int(i)), i))
        ranks = np.full(n, NO_RANK, np.int32)
        ranks[order] = np.arange(len(order))
        # pieces of equal score rank alike: the leftmost pair then comes first
        scores = [sp.get_score(int(i)) for i in order]
        for k in range(1, len(order)):
            if scores[k] == scores[k - 1]:
                ranks[order[k]] = ranks[order[k - 1]]
        return Vocabulary(pieces, plain, byte_ids, ranks)

    def tables(self) -> Tables:
        return Tables(self)


class Tables:
    """Lookup arrays of a vocabulary, made once in each task."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        ids = {p: i for i, p in enumerate(vocabulary.pieces) if vocabulary.plain[i]}
        extra = sorted({c for p in ids for c in p} - ids.keys())
        symbols = ids | {c: len(vocabulary.pieces) + k for k, c in enumerate(extra)}
        self.unknown = len(vocabulary.pieces) + len(extra)
        self.of_char = np.full(CODE_POINTS, self.unknown, np.int32)
        for c, symbol in symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = symbol
        self.width = self.unknown + 1
        pairs = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = i
        keys = np.array(sorted(pairs), np.int64)
        self._hash_pairs(keys, np.array([pairs[k] for k in keys.tolist()], np.int32))
        inner = {(self.of_char[ord(a)], self.of_char[ord(b)]) for p in ids for a, b in zip(p, p[1:])}
        self.inside = np.zeros(1 << INSIDE_BITS, bool)
        self.inside[self._bigram(*np.array(sorted((int(a), int(b)) for a, b in inner), np.int32).T)] = True
        self.spelt = [p.replace(BLANK, " ").encode() if vocabulary.plain[i] else b"" for i, p in enumerate(vocabulary.pieces)]
        for b, i in enumerate(vocabulary.byte_ids):
            self.spelt[i] = bytes([b])
        self.spelt[0] = " ⁇ ".encode()
        self.is_byte = np.zeros(len(vocabulary.pieces), bool)
        self.is_byte[vocabulary.byte_ids] = True

        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.known_chars = 0
        self.made_of: dict[tuple[int, int], tuple[int, int]] = {}  # rank and id of the pairs of long words
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    @staticmethod
    def _bigram(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of two neighbouring symbols; pairs that share a slot are merely not cut apart."""
        return (a * np.int32(7919) + b) & np.int32((1 << INSIDE_BITS) - 1)

    def _hash_pairs(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """Open hash table with linear probing, filled round by round."""
        self.bits = max(4, int(2 * len(keys)).bit_length() + 1)
        self.slot_key, self.slot_id = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        at, left = self._slots(keys), np.arange(len(keys))
        self.probes = 1
        while len(left):
            free = self.slot_key[at[left]] < 0
            first = np.unique(at[left][free], return_index=True)[1]
            placed = left[free][first]
            self.slot_key[at[placed]], self.slot_id[at[placed]] = keys[placed], merged[placed]
            left = np.setdiff1d(left, placed)
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            self.probes += bool(len(left))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the piece that each pair of symbols makes, -1 for none."""
        keys = left.astype(np.int64) * self.width + right
        out = np.full(len(keys), -1, np.int32)
        at, todo = self._slots(keys), np.arange(len(keys))
        for _ in range(self.probes):
            found = self.slot_key[at]
            hit = found == keys[todo]
            out[todo[hit]] = self.slot_id[at[hit]]
            go = ~hit & (found >= 0)
            if not go.any():
                break
            todo, at = todo[go], (at[go] + 1) & ((1 << self.bits) - 1)
        return out

    def rank(self, merged: np.ndarray) -> np.ndarray:
        return np.where(merged >= 0, self.v.ranks[merged], NO_RANK)

    def merge_words(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge flat symbols of words that begin at ``starts``; (symbols, word of each) when no pair remains."""
        word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(symbols))))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        sizes = np.bincount(word, minlength=len(starts))
        for w in np.flatnonzero(sizes > LONG_WORD).tolist():
            merged = self._merge_long(symbols[starts[w] : starts[w] + sizes[w]])
            done.append((merged, np.full(len(merged), w)))
        if done:
            short = sizes[word] <= LONG_WORD
            symbols, word = symbols[short], word[short]
        made = np.full(len(symbols), -1, np.int32)  # what a symbol makes with the next one of its word
        inner = np.flatnonzero(word[1:] == word[:-1])
        made[inner] = self.merge(symbols[inner], symbols[inner + 1])
        while len(symbols):
            ranks = self.rank(made)
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(ranks, starts)
            live = best < NO_RANK
            if not live.all():
                keep = np.repeat(live, sizes)
                done.append((symbols[~keep], word[~keep]))
                symbols, word, made, ranks = symbols[keep], word[keep], made[keep], ranks[keep]
                if not len(symbols):
                    break
                starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                sizes, best = sizes[live], best[live]
            at = np.flatnonzero(ranks == np.repeat(best, sizes))
            at = self._chosen(at, symbols, word, made, ranks)
            symbols[at] = made[at]
            gone = np.zeros(len(symbols), bool)
            gone[at + 1] = True
            kept = ~gone
            moved = np.cumsum(kept) - 1
            at = moved[at]
            symbols, word, made = symbols[kept], word[kept], made[kept]
            fresh = np.unique(np.concatenate([at, at[at > 0] - 1]))
            inner = fresh[fresh + 1 < len(symbols)]
            inner = inner[word[inner] == word[inner + 1]]
            made[fresh] = -1
            made[inner] = self.merge(symbols[inner], symbols[inner + 1])
        symbols, word = (np.concatenate(x) for x in zip(*done)) if done else (symbols, word)
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols of one word after all merges, best pair first and leftmost among equals, in n log n steps."""
        def pair(a: int, b: int) -> tuple[int, int]:
            found = self.made_of.get((a, b))
            if found is None:
                merged = self.merge(np.array([a], np.int32), np.array([b], np.int32))
                found = self.made_of[a, b] = (int(self.rank(merged)[0]), int(merged[0]))
            return found

        held: list[int] = symbols.tolist()
        n, gone = len(held), -1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, held[i], held[i + 1], merged) for i in range(n - 1) for rank, merged in [pair(held[i], held[i + 1])] if merged >= 0]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i] if held[i] == left else n
            if j >= n or held[j] != right:
                continue  # one of the two has been merged since
            held[i], held[j] = merged, gone
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    rank, new = pair(held[a], held[b])
                    if new >= 0:
                        heapq.heappush(heap, (rank, a, held[a], held[b], new))
        return np.array([s for s in held if s != gone], np.int32)

    def _chosen(self, at: np.ndarray, symbols: np.ndarray, word: np.ndarray, made: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Of the best pairs ``at``, left to right without overlap: all those of a word if no pair that they
        bring about is as good as they are, else the leftmost only."""
        if len(at) < 2:
            return at
        # a run of overlapping pairs gives every other one
        linked = np.concatenate([[False], (at[1:] == at[:-1] + 1) & (word[at[1:]] == word[at[:-1]])])
        begun = np.maximum.accumulate(np.where(~linked, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - begun) % 2 == 0]
        first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
        if first.all():
            return at
        new, own, n = made[at], ranks[at], len(symbols)
        merged_left = np.concatenate([[False], (at[1:] == at[:-1] + 2) & (word[at[1:]] == word[at[:-1]])])
        before = np.where(merged_left, np.concatenate([new[:1], new[:-1]]), symbols[np.maximum(at - 1, 0)])
        has_before = (at > 0) & (word[np.maximum(at - 1, 0)] == word[at])
        after = np.minimum(at + 2, n - 1)
        has_after = (at + 2 < n) & (word[after] == word[at])
        worse = ~has_before | (self.rank(self.merge(before, new)) > own)
        worse &= ~has_after | (self.rank(self.merge(new, symbols[after])) > own)
        bad = np.unique(word[at[~worse]])
        return at[first | ~np.isin(word[at], bad)] if len(bad) else at

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets), without an end id."""
        texts = [BLANK + t.replace(" ", BLANK) if t else "" for t in texts]
        joined = "".join(texts)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        edges = np.cumsum([0] + [len(t) for t in texts])
        if not len(chars):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        symbols = self.of_char[chars]
        cut = np.ones(len(chars), bool)
        cut[1:] = ~self.inside[self._bigram(symbols[:-1], symbols[1:])]
        cut[edges[:-1][edges[:-1] < len(chars)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(chars))
        if len(self.known) > KNOWN_WORDS or self.known_chars > KNOWN_CHARS:
            self._forget()
        known = self.known
        before = len(known)
        kind = np.array([known.setdefault(joined[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)
        if len(known) > before:
            self._learn(list(known)[before:])
        lengths = self.ends[kind + 1] - self.ends[kind]
        ends = np.cumsum(lengths)
        flat = np.arange(ends[-1]) + np.repeat(self.ends[kind] - (ends - lengths), lengths)
        words_before = np.searchsorted(starts, edges)
        return self.ids[flat], np.concatenate([[0], ends])[words_before]

    def _learn(self, words: list[str]) -> None:
        """Merge words met for the first time and keep their ids."""
        sizes = np.array([len(w) for w in words], np.int64)
        self.known_chars += int(sizes.sum())
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(sizes) - sizes
        ids, word = self.merge_words(self.of_char[chars], starts)
        ids, counts = self._bytes(ids, np.bincount(word, minlength=len(sizes)), chars, starts)
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])

    def _bytes(self, ids: np.ndarray, counts: np.ndarray, chars: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no piece as the ids of their UTF-8 bytes; they are single characters."""
        odd = np.flatnonzero(ids >= len(self.v.pieces))
        if not len(odd):
            return ids, counts
        word = np.repeat(np.arange(len(counts)), counts)
        out, at, counts = [], 0, counts.copy()
        chars_of = {}
        for i in odd.tolist():
            w = int(word[i])
            if w not in chars_of:  # the k-th odd symbol of a word is its k-th character of that sort
                end = starts[w + 1] if w + 1 < len(starts) else len(chars)
                own = chars[starts[w] : end]
                chars_of[w] = iter(own[self._left_over(own, ids[word_slice(counts, word, w)])])
            data = chr(next(chars_of[w])).encode("utf-8", "replace")
            out += [ids[at:i], self.v.byte_ids[np.frombuffer(data, np.uint8)]]
            counts[w] += len(data) - 1
            at = i + 1
        return np.concatenate([*out, ids[at:]]), counts

    def _left_over(self, chars: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Positions in a word's characters of the symbols that are no piece."""
        lengths = np.array([1 if i >= len(self.v.pieces) else len(self.v.pieces[i]) for i in ids.tolist()])
        begins = np.cumsum(lengths) - lengths
        return begins[ids >= len(self.v.pieces)]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: pieces with blanks as spaces, the leading one dropped; runs of bytes as UTF-8, where an
        invalid byte is one replacement character; control ids are silent."""
        text = "".join(
            part.decode() if not raw else decode_bytes(part) for raw, part in self._runs(ids))
        return text[1:] if text.startswith(" ") and len(ids) and self._spaced(ids) else text

    def _spaced(self, ids: np.ndarray) -> bool:
        first = next((i for i in ids.tolist() if self.spelt[i]), 0)
        return first > 0 and not self.is_byte[first]

    def _runs(self, ids: np.ndarray) -> Iterator[tuple[bool, bytes]]:
        raw = self.is_byte[ids]
        if not raw.any():
            yield False, b"".join([self.spelt[i] for i in ids.tolist()])
            return
        edges = [0, *(np.flatnonzero(raw[1:] != raw[:-1]) + 1).tolist(), len(ids)]
        for a, b in zip(edges[:-1], edges[1:]):
            yield bool(raw[a]), b"".join([self.spelt[i] for i in ids[a:b].tolist()])


def word_slice(counts: np.ndarray, word: np.ndarray, w: int) -> slice:
    return slice(*np.searchsorted(word, [w, w + 1]))


def decode_bytes(data: bytes) -> str:
    """UTF-8 with one replacement character for each byte that is not part of a valid character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as e:
            out += [data[at : at + e.start].decode(), "�"]
            at += e.start + 1
    return "".join(out)


def encode(docs: DataFrame, model_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of each whole text, closed by ``end_id``.

    A null or empty text is the end id alone.  Row-local; repeated rows and null ids are kept, an empty table
    gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))  # one vocabulary, fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = held.value.tables()
        for batch in text_groups(batches, GROUP_BYTES):
            ids, offsets = tables.encode(texts_of(batch))
            ids = np.insert(ids, offsets[1:], end_id)
            offsets = (offsets + np.arange(len(offsets))).astype("i4")
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype("i4")))], ["doc_id", "ids"])

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with the text of their ids as column ``decoded``; null ids give an empty text."""
    held = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = held.value.tables()
        for ids in batches:
            yield pd.Series([tables.decode(np.asarray([] if i is None else i, np.int64)) for i in ids])

    return rows.withColumn("decoded", decoded(F.col(ids_col)))
