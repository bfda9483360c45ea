"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is a set of word shingles. Items are partitioned by size; for a partition of items of at most ``u`` shingles, a document
of any length is seen as windows of ``2u`` shingles that overlap by half, so an occurrence is never small against what it is
compared with, and a fixed number of hashes finds it. Window signatures are minima over aligned blocks, which the larger
partitions reuse. Items of fewer than half the smallest partition's shingles would be small against any window: they are
looked up by so many of their shingle hashes that a document that reaches the threshold holds one of them. A window that shares any minimum with an item makes the item a candidate; a candidate counts only if the
share of the item's shingles that the *whole* document holds, compared as words, reaches the threshold.

With 64 hashes an occurrence in one piece that just reaches 0.8 is missed with a probability of about 1e-6 (share of
shingles in the window 0.19 at least), a complete one with 1e-7; items that are looked up are not missed. Shingles of an item that lie scattered
over a long document may stay unseen; passages copied from a benchmark are in one piece.

Words are runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased. An item of fewer words than a shingle
is one shingle of its own length; an item without words is never found. Null and empty texts hold nothing. Repeated
documents and items give repeated rows. The items are read in passes of bounded size. With several, each is collected,
scanned with and its result written before the next is read, so the driver and a worker hold the items of one pass.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremeld.llm.shared import col, free_name, per_text, slices, stored

SEPARATORS = bytes(
    c if c >= 128 or chr(c).isalnum() and not 65 <= c <= 90 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


@dataclass(frozen=True)
class Search:
    """``items``/``item_bytes``: what one pass holds of the items; ``smallest``: shingles of the smallest partition,
    whose items have half of that at least; smaller ones are looked up."""

    words: int = 5
    threshold: float = 0.8
    hashes: int = 64
    smallest: int = 16
    items: int = 20_000
    item_bytes: int = 64 << 20


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(SEPARATORS).split()


def shingles_of(words: list[bytes], length: int) -> set[bytes]:
    return {b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)}


def shingle_hashes(words: list[bytes], length: int) -> np.ndarray:
    """A mixed 64-bit hash of every run of ``length`` words."""
    from xxhash import xxh64_intdigest

    if len(words) < length:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - length + 1
    total = np.zeros(n, np.uint64)
    for i in range(length):
        total = total * np.uint64(0x9E3779B97F4A7C15) + one[i : i + n]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ total >> np.uint64(29)


class Hashes:
    """The hash functions, the same in every task."""

    def __init__(self, count: int):
        drawn = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, (2, count, 1), dtype=np.uint64)
        self.flip, self.times = drawn[0], drawn[1] << np.uint64(1) | np.uint64(1)

    def minima(self, hashed: np.ndarray, block: int, slab: int = 4_096) -> np.ndarray:
        """The minima over blocks of ``block`` hashes, a row for each block."""
        parts = []
        for a, b in slices(len(hashed), slab - slab % block):
            values = (hashed[None, a:b] ^ self.flip) * self.times
            parts.append(np.minimum.reduceat(values, np.arange(0, b - a, block), axis=1).T)
        return np.concatenate(parts) if parts else np.empty((0, len(self.flip)), np.uint64)


def indexed(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.uint64]:
    """The values of all rows in order, the row's number for each, and a table of their leading bits with its shift."""
    values = np.concatenate([v for v, _ in rows])
    owner = np.repeat([i for _, i in rows], [len(v) for v, _ in rows])
    order = np.argsort(values, kind="stable")
    bits = max(16, int(values.size * 64).bit_length())
    seen = np.zeros(1 << bits, bool)
    seen[values >> np.uint64(64 - bits)] = True
    return values[order], owner[order], seen, np.uint64(64 - bits)


def owners(wanted: np.ndarray, values: np.ndarray, owner: np.ndarray, seen: np.ndarray, shift: np.uint64) -> set[int]:
    """The numbers of the rows that have any of the wanted values."""
    wanted = wanted[seen[wanted >> shift]]
    low, high = np.searchsorted(values, wanted, "left"), np.searchsorted(values, wanted, "right")
    found: set[int] = set()
    for a, b in {(a, b) for a, b in zip(low.tolist(), high.tolist()) if a < b}:
        found.update(owner[a:b].tolist())
    return found


class Items:
    """One pass of items: their shingles, and their minima by partition of size."""

    def __init__(self, rows: list[tuple[int, str]], search: Search):
        self.search, self.hashes = search, Hashes(search.hashes)
        self.ids, self.shingles, self.lengths = [], [], []
        parts: dict[tuple[int, int], list[tuple[np.ndarray, int]]] = defaultdict(list)
        looked_up: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for item_id, text in rows:
            words = words_of(text or "")
            if not words:
                continue
            length = min(search.words, len(words))
            shingles = shingles_of(words, length)
            hashed = shingle_hashes(words, length)
            if 2 * len(shingles) < search.smallest:
                wanted = next(m for m in range(1, len(shingles) + 1) if m / len(shingles) >= search.threshold or m == len(shingles))
                looked_up[length].append((np.unique(hashed)[: len(shingles) - wanted + 1], len(self.ids)))
            else:
                size = search.smallest
                while size < len(shingles):
                    size *= 2
                parts[length, size].append((self.hashes.minima(hashed, 1_024).min(axis=0), len(self.ids)))
            self.ids.append(item_id)
            self.shingles.append(shingles)
            self.lengths.append(length)
        self.parts: dict[int, dict[int, tuple]] = {}
        for (length, size), signed in parts.items():
            self.parts.setdefault(length, {})[size] = indexed(signed)
        self.looked_up = {length: indexed(hashed) for length, hashed in looked_up.items()}

    def candidates(self, words: list[bytes]) -> set[int]:
        found: set[int] = set()
        for length in self.parts.keys() | self.looked_up.keys():
            hashed, by_size, size = shingle_hashes(words, length), self.parts.get(length), self.search.smallest
            if length in self.looked_up:
                found |= owners(hashed, *self.looked_up[length])
            blocks = self.hashes.minima(hashed, size) if by_size else ()
            while len(blocks):
                if size in by_size:
                    found |= owners(np.minimum(blocks[:-1], blocks[1:]) if len(blocks) > 1 else blocks, *by_size[size])
                if size >= max(by_size):
                    break
                blocks = np.minimum.reduceat(blocks, np.arange(0, len(blocks), 2), axis=0)
                size *= 2
        return found

    def contained(self, text: str) -> list[tuple[int, float]]:
        """(item, share of its shingles in the text) for all that reach the threshold."""
        words = words_of(text)
        held: dict[int, set[bytes]] = {}
        out = []
        for i in sorted(self.candidates(words)):
            length = self.lengths[i]
            if length not in held:
                held[length] = shingles_of(words, length)
            share = len(self.shingles[i] & held[length]) / len(self.shingles[i])
            if share >= self.search.threshold:
                out.append((self.ids[i], share))
        return out


def passes(items: DataFrame, id: str, text: str, search: Search) -> list[DataFrame]:
    """The items (id, text) in tables of about ``search.items`` rows and ``search.item_bytes`` bytes, dealt by hash."""
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(col(text))).alias("bytes")).first()
    n = max(-(-size.n // search.items), -(-(size.bytes or 0) // search.item_bytes), 1)
    place = F.pmod(F.xxhash64(col(id), col(text)), F.lit(n))
    return [items.where(place == i).select(col(id), col(text)) for i in range(n)]


def held_by(text: str, one_pass: DataFrame, search: Search) -> Column:
    """For each text the array of (item_id, containment) that reach the threshold, of one pass of items."""
    rows = [(r[0], r[1]) for r in one_pass.collect()]
    make = lambda: Items(rows, search).contained
    return per_text(make, "array<struct<item_id:long,containment:double>>", only="items of a pass")(col(text))


def leaks(documents: DataFrame, items: DataFrame, id: str = "doc_id", search: Search = Search()) -> DataFrame:
    """A row (doc_id, item_id, containment) for every item that a document contains."""

    def of(one_pass: DataFrame) -> DataFrame:
        found = documents.select(col(id).alias("doc_id"), held_by("text", one_pass, search).alias("found"))
        return found.select("doc_id", F.explode("found").alias("one")).select("doc_id", "one.*")

    parts = passes(items, "item_id", "text", search)
    return of(parts[0]) if len(parts) == 1 else reduce(DataFrame.unionAll, [stored(of(part), "leaks-of-a-pass") for part in parts])


def without_leaks(documents: DataFrame, items: DataFrame, search: Search = Search()) -> DataFrame:
    """The documents that contain no item, with all their columns.

    With several passes the documents are written once with a mark, and each pass writes the marks of those it drops.
    """
    parts = passes(items, "item_id", "text", search)
    if len(parts) == 1:
        found = free_name(documents, "found")
        return documents.withColumn(found, held_by("text", parts[0], search)).where(F.size(F.col(found)) == 0).drop(found)
    mark = free_name(documents, "mark")
    marked = stored(documents.withColumn(mark, F.monotonically_increasing_id()), "marked-documents")
    dropped = [
        stored(marked.select(mark, held_by("text", part, search).alias("found")).where(F.size("found") > 0).select(mark), "marks-of-a-pass")
        for part in parts
    ]
    return marked.join(reduce(DataFrame.unionAll, dropped), mark, "left_anti").drop(mark)
