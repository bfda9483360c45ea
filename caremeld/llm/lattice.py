"""Language-model scores from the lattice of all subword segmentations.

A vocabulary of pieces with scores exists. A text is its words, each begun by a mark, and an end; every way to cut the words
into pieces counts, weighted by the pieces' probabilities, and a forward recursion in log space adds them all up to the
text's marginal probability. No piece reaches over a mark in its inside, so the recursion over a text is the sum over
its words, and every distinct word of the corpus is computed once.

The vocabulary's scores are the starting probabilities (a score of -r counts as rank r of Zipf's law); expected piece
counts over the training words, by forward and backward recursion, then give the probabilities used, with the starting ones as
prior. Characters that no piece of their own covers are spelled in byte pieces.

The corpus is written once as blocks: a block is what a task reads up to a bounded number of tokens, with its distinct words
and its texts as numbers of these words. Distinct words of blocks, never tokens, are shuffled, and a block gets back its
words' counts and scores. Only the probabilities of the pieces, as many as the vocabulary has, are held whole.

Null texts count as empty and have one token, the end; a null id counts as the empty text for the choice of training
rows; repeated rows count and are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremeld.llm.shared import col, kept_in_process, slices, stored

MARK = "▁"
UPPER_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class Model:
    """``block``: tokens after which a block is closed; ``prior``: pieces that the starting probabilities weigh;
    ``cells``: lattice cells computed at a time; ``sent``: bytes of rows that a task sends on at a time."""

    path: str
    rounds: int = 1
    block: int = 3_000_000
    prior: float = 10_000.0
    cells: int = 1 << 19
    sent: int = 1 << 20


def training_row(doc_id) -> bool:
    return crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 != 0


class Pieces:
    """The vocabulary: usable pieces by text, byte pieces, and the starting log probabilities (natural) of both and the end."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.bytes = np.zeros(256, np.int64)
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or MARK in piece[1:]):
                self.ids[piece] = i
        self.end, self.size = model.eos_id(), n
        self.longest = max(map(len, self.ids), default=1)
        # every ending of a piece, with the piece if it is one itself: no longer ending is looked for after a miss
        self.endings = {p[-k:]: -1 for p in self.ids for k in range(1, len(p) + 1)} | self.ids
        self.singles = {p for p in self.ids if len(p) == 1}
        used = np.array(sorted([*self.ids.values(), *self.bytes.tolist(), self.end]))
        rank = np.zeros(n)
        rank[used] = [max(0.0, -model.get_score(int(i))) for i in used]
        weight = np.zeros(n)
        weight[used] = 1 / (rank[used] + 2.7)
        weight[self.bytes] = weight[used].min()
        weight[self.end] = weight[used].max()
        self.used, self.start = used, weight / weight.sum()


class Lattice:
    """Marginal probabilities of words, and expected counts of pieces, for many words of one length at a time."""

    def __init__(self, pieces: Pieces, probabilities: np.ndarray):
        with np.errstate(divide="ignore"):
            self.log = np.append(np.log(probabilities), -np.inf)  # the last stands for no piece
        self.pieces, self.none = pieces, len(probabilities)

    def edges(self, word: str) -> list[int]:
        """(begin * (characters + 1) + end) * (pieces + 1) + piece for every piece in the word."""
        get, steps, size, out = self.pieces.endings.get, len(word) + 1, self.none + 1, []
        add = out.append
        for end in range(1, steps):
            for begin in range(end - 1, -1, -1):
                piece = get(word[begin:end])
                if piece is None:
                    break
                if piece >= 0:
                    add((begin * steps + end) * size + piece)
        return out

    def spelled(self, word: str) -> list[tuple[int, int]]:
        """(end, character) of the characters without a piece of their own."""
        singles = self.pieces.singles
        return [] if singles.issuperset(word) else [(end, ord(c)) for end, c in enumerate(word, 1) if c not in singles]

    def run(self, words: list[str], weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities of words of equal length, and with ``weights`` the expected counts of pieces."""
        n, length = len(words), len(words[0])
        found = [self.edges(word) for word in words]
        sizes = np.fromiter(map(len, found), np.int64, n)
        place, piece = np.divmod(np.fromiter(chain.from_iterable(found), np.int64, sizes.sum()), self.none + 1)
        begin, end = np.divmod(place, length + 1)
        longest = int((end - begin).max(initial=1))
        ids = np.full((n, length, longest), self.none, np.int32)
        ids[np.repeat(np.arange(n), sizes), end - 1, end - begin - 1] = piece
        scores = self.log[ids]
        byte_use = []
        for row, word in enumerate(words):
            for end, code in self.spelled(word):
                used = self.pieces.bytes[list(chr(code).encode("utf-8"))]
                scores[row, end - 1, 0] = self.log[used].sum()
                byte_use.append((row, end, used))
        forward = np.full((n, length + 1), -np.inf)
        forward[:, 0] = 0
        for end in range(1, length + 1):
            most = min(longest, end)
            reach = forward[:, end - most : end][:, ::-1] + scores[:, end - 1, :most]
            forward[:, end] = log_sum(reach)
        total = forward[:, length].copy()
        if weights is None:
            return total, np.empty(0)
        backward = np.full((n, length + 1), -np.inf)
        backward[:, length] = 0
        for begin in range(length - 1, -1, -1):
            most = min(longest, length - begin)
            k = np.arange(most)
            backward[:, begin] = log_sum(scores[:, begin + k, k] + backward[:, begin + 1 : begin + 1 + most])
        expected = np.zeros(self.none + 1)
        for k in range(min(longest, length)):
            share = forward[:, : length - k] + scores[:, k:, k] + backward[:, k + 1 :] - total[:, None]
            share = np.exp(share) * weights[:, None]
            expected += np.bincount(ids[:, k:, k].ravel(), share.ravel(), self.none + 1)
            if k == 0:
                for row, end, used in byte_use:
                    np.add.at(expected, used, share[row, end - 1])
        return total, expected[:-1]

    def grouped(self, words: list[str], cells: int) -> Iterator[np.ndarray]:
        """Places of words of equal length, at most ``cells`` cells together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        cut = np.flatnonzero(np.diff(lengths[order])) + 1
        for same in np.split(order, cut) if len(order) else []:
            size = max(1, cells // (int(lengths[same[0]]) * self.pieces.longest))
            for a, b in slices(len(same), size):
                yield same[a:b]


def log_sum(values: np.ndarray) -> np.ndarray:
    top = values.max(axis=1)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(values - safe[:, None]).sum(axis=1)) + safe


def as_blocks(documents: DataFrame, id: str, text: str, model: Model) -> DataFrame:
    """Rows of two kinds: words of a block with their training counts (``word`` not null), and texts as numbers of words."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, block = TaskContext.get().partitionId(), 0
        numbers: dict[bytes, int] = {}
        counts, tokens = np.zeros(0, np.int64), 0

        def closed() -> Iterator[pd.DataFrame]:
            words = list(numbers)
            for a, b in slices(len(words), 10_000):
                yield pd.DataFrame(
                    {"task": task, "block": block, "doc_id": None, "n": np.arange(a, b), "count": counts[a:b],
                     "word": [w.decode("utf-8") for w in words[a:b]], "numbers": None, "times": None}
                )

        for batch in batches:
            rows, size = [], 0
            for doc_id, value in zip(batch.doc_id, batch.text):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                words = value.encode("utf-8").translate(UPPER_TO_LOWER).split() if isinstance(value, str) else []
                place = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
                distinct, times = np.unique(place, return_counts=True)
                if len(numbers) > len(counts):
                    counts = np.append(counts, np.zeros(max(len(numbers), 2 * len(counts)) - len(counts), np.int64))
                if training_row(doc_id):
                    counts[distinct] += times
                steps = np.diff(distinct, prepend=0).astype("<u4")
                rows.append((task, block, doc_id, len(words), 0, None, steps.tobytes(), times.astype("<u4").tobytes()))
                tokens, size = tokens + len(words), size + 8 * len(distinct)
                if size >= model.sent or tokens >= model.block:
                    yield named(rows)
                    rows, size = [], 0
                if tokens >= model.block:
                    yield from closed()
                    numbers, counts, tokens, block = {}, np.zeros(0, np.int64), 0, block + 1
            yield named(rows)
        yield from closed()

    named = lambda rows: pd.DataFrame(rows, columns=["task", "block", "doc_id", "n", "count", "word", "numbers", "times"])
    chosen = documents.select(col(id).cast("long").alias("doc_id"), col(text).alias("text"))
    schema = "task int, block int, doc_id long, n long, count long, word string, numbers binary, times binary"
    return stored(chosen.mapInPandas(make, schema), "word-blocks")


def learned(counts: DataFrame, n_ends: int, model: Model) -> np.ndarray:
    """Probabilities of all pieces after ``model.rounds`` rounds over the training words (word, c) and their ends."""
    pieces = Pieces(model.path)
    probabilities = pieces.start
    for _ in range(model.rounds):
        now = probabilities

        def expected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = kept_in_process(("pieces", model.path), lambda: Pieces(model.path))
            lattice, total = Lattice(own, now), np.zeros(own.size)
            for batch in batches:
                words, weights = [MARK + w for w in batch.word], batch.c.to_numpy(np.float64)
                for same in lattice.grouped(words, model.cells):
                    total += lattice.run([words[i] for i in same], weights[same])[1]
            used = np.flatnonzero(total)
            yield pd.DataFrame({"piece": used, "expected": total[used]})

        sums = counts.where("c > 0").mapInPandas(expected, "piece long, expected double")
        weight = pieces.start * model.prior
        for row in sums.groupBy("piece").agg(F.sum("expected").alias("expected")).collect():
            weight[row.piece] += row.expected
        weight[pieces.end] += n_ends
        probabilities = weight / weight.sum()
    return probabilities


def scored(documents: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    blocks = as_blocks(documents, id, text, model)
    texts, words = blocks.where("word is null"), blocks.where("word is not null")
    counts = stored(words.groupBy("word").agg(F.sum("count").alias("c")), "word-counts")
    kept = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 != 0
    ends = texts.where(kept).count()
    whole = counts.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    train_tokens, distinct = whole.n + ends, whole.v + (ends > 0)
    probabilities = learned(counts, ends, model)
    end_score = float(np.log10(probabilities[Pieces(model.path).end]))
    below = np.log10(train_tokens + 0.1 * (distinct + 1))
    end_base = float(np.log10(ends + 0.1) - below)

    def marginals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(kept_in_process(("pieces", model.path), lambda: Pieces(model.path)), probabilities)
        for batch in batches:
            marked = [MARK + w for w in batch.word]
            out = np.zeros(len(marked))
            for same in lattice.grouped(marked, model.cells):
                out[same] = lattice.run([marked[i] for i in same])[0]
            yield pd.DataFrame({"word": batch.word, "c": batch.c, "log10": out / np.log(10)})

    known = counts.mapInPandas(marginals, "word string, c long, log10 double")
    placed = words.select("word", F.col("task").alias("of_task"), F.col("block").alias("of_block"), F.col("n").alias("number"))
    back = placed.join(known, "word").select("of_task", "of_block", "number", "c", "log10")

    def of_block(texts: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        size = len(words)
        c, log10 = np.zeros(size, np.int64), np.zeros(size)
        c[words.number], log10[words.number] = words.c, words.log10
        base = np.log10(c + 0.1) - below
        rows = []
        for doc_id, n, steps, times in zip(texts.doc_id, texts.n, texts.numbers, texts.times):
            doc_id = None if pd.isna(doc_id) else int(doc_id)
            place = np.cumsum(np.frombuffer(steps, "<u4").astype(np.int64))
            times = np.frombuffer(times, "<u4").astype(np.int64)
            rows.append(
                (doc_id, not training_row(doc_id), int(n) + 1, int(times[c[place] > 0].sum()) + (ends > 0), train_tokens,
                 float(times @ base[place]) + end_base, float(times @ log10[place]) + end_score)
            )
        return pd.DataFrame(rows, columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return (
        texts.select("task", "block", "doc_id", "n", "numbers", "times")
        .groupBy("task", "block")
        .cogroup(back.groupBy("of_task", "of_block"))
        .applyInPandas(of_block, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )
