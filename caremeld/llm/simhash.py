"""Near copies by 64-bit SimHash, found with an index in Gray order.

Fingerprints that differ in few bits agree on at least one of a few more segments of their bits. So the distinct
fingerprints are sorted once for each segment, turned so that the segment leads, by their rank in the Gray code, where
neighbours differ in few bits, and dealt into blocks of even size. A group of neighbours is summed up by the bits all its
members share (mask and pattern); groups of groups share fewer. A search walks down this tree, adds up the differences
to the shared bits and drops a whole group once they exceed the distance or touch the leading segment. The same tree over
the blocks says which further blocks a fingerprint must visit: only those that its segment's run of neighbours goes on
in. So no link is lost, the work for a fingerprint stays the same as the table grows, and blocks stay even however
many fingerprints share a segment.

A block reports a spanning set of links (member, representative), never all pairs, and components are found over these by
alternating stars. The driver holds one node for each block, that is one for ``Index.block`` placed fingerprints.

Null texts count as empty; texts without words have fingerprint zero and link like any other; repeated rows and ties share
a component; the component of rows that have no id among them is null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremeld.llm.components import connected_components
from caremeld.llm.shared import col, free_name, per_text, slices, stored

UPPER_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class Index:
    """``block``: placed fingerprints of a block; ``fan``: children of a node; ``batch``: searches done at a time."""

    distance: int = 2
    block: int = 50_000
    fan: int = 16
    batch: int = 2_048

    def segments(self) -> list[tuple[int, int]]:
        """(first bit, number of bits), one more than bits may differ."""
        ends = [64 * i // (self.distance + 1) for i in range(self.distance + 2)]
        return [(a, b - a) for a, b in zip(ends, ends[1:])]


def leading(bits: int) -> np.uint64:
    return np.uint64(((1 << bits) - 1) << (64 - bits))


def turned(fp: Column, by: int) -> Column:
    """The bits moved up, those that leave coming back below."""
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp


def turned_back(values: np.ndarray, by: int) -> np.ndarray:
    return values >> np.uint64(by) | values << np.uint64(64 - by) if by else values


def fingerprint(text: str, words: int = 3) -> int:
    """A signed 64-bit SimHash over word shingles, repeats included; a bit is set if it is in over half of the hashes."""
    from xxhash import xxh64_intdigest

    data = text.encode("utf-8").translate(UPPER_TO_LOWER).split()
    if not data:
        return 0
    if len(data) < words:
        data, words = [b" ".join(data)], 1
    joined = b" ".join(data)
    ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    ends = ends - 1
    n = len(data) - words + 1
    counts = np.zeros(64, np.int64)
    for a, b in slices(n, 65_536):
        shingles = [joined[i:j] for i, j in zip(starts[a:b].tolist(), ends[a + words - 1 : b + words - 1].tolist())]
        hashes = np.array([xxh64_intdigest(s, 42) for s in shingles], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n)
    return int(bits.view(">i8")[0])


def fingerprints(text: Column, words: int = 3) -> Column:
    return per_text(lambda: lambda value: fingerprint(value, words), "long")(text)


def gray_rank(bits: np.ndarray) -> np.ndarray:
    """The place of each fingerprint in the Gray code."""
    rank = bits.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def gray_rank_column(bits: Column) -> Column:
    """The same as a long whose order is that of the rank."""
    rank = reduce(lambda r, shift: r.bitwiseXOR(F.shiftrightunsigned(r, shift)), (1, 2, 4, 8, 16, 32), bits)
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


class Tree:
    """Nodes over groups, given by the AND and the OR of their members in Gray order, and groups of such groups."""

    def __init__(self, ands: np.ndarray, ors: np.ndarray, fan: int):
        self.fan = fan
        levels = [(ands, ors)]
        while len(levels[-1][0]) > fan:
            a, o = levels[-1]
            cut = np.arange(0, len(a), fan)
            levels.append((np.bitwise_and.reduceat(a, cut), np.bitwise_or.reduceat(o, cut)))
        levels.reverse()
        self.levels = []
        for depth, (a, o) in enumerate(levels):
            shared = ~(a ^ o)
            above = np.repeat(levels[depth - 1][0] ^ levels[depth - 1][1], fan)[: len(a)] if depth else ~np.uint64(0)
            self.levels.append((a, shared & above))  # only the bits that the node above doesn't share

    def search(self, wanted: np.ndarray, distance: int, lead: np.uint64 = np.uint64(0)) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``wanted``, group) wherever shared bits differ in at most ``distance`` places, none of them in ``lead``."""
        a, mask = self.levels[0]
        query = np.repeat(np.arange(len(wanted)), len(a))
        node = np.tile(np.arange(len(a)), len(wanted))
        so_far = np.zeros(len(query), np.uint8)
        for depth, (a, mask) in enumerate(self.levels):
            if depth:
                node = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
                query, so_far = np.repeat(query, self.fan), np.repeat(so_far, self.fan)
                real = node < len(a)
                query, node, so_far = query[real], node[real], so_far[real]
            differ = (wanted[query] ^ a[node]) & mask[node]
            so_far = so_far + np.bitwise_count(differ)
            near = (so_far <= distance) & (differ & lead == 0)
            query, node, so_far = query[near], node[near], so_far[near]
        return query, node


def joined_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``labels`` after the groups of ``a[i]`` and ``b[i]`` became one; a label is the smallest position of its group."""
    while len(a):
        x, y = labels[a], labels[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(labels, deeper := labels[labels]):
            labels = deeper
    return labels


def block_links(members: np.ndarray, visitors: np.ndarray, index: Index, lead: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Links (value, representative) that span all within the distance and alike in ``lead``, visitors to members too."""
    members = members[np.argsort(gray_rank(members))]
    tree = Tree(members, members, index.fan)
    every = np.concatenate([members, visitors])
    labels = np.arange(len(every))
    for begin, end in slices(len(every), index.batch):
        query, found = tree.search(every[begin:end], index.distance, lead)
        labels = joined_labels(labels, query + begin, found)
    linked = np.flatnonzero(labels != np.arange(len(every)))
    return every[linked], every[labels[linked]]


class Blocks:
    """The blocks of one segment in Gray order."""

    def __init__(self, nodes: list, bits: int, index: Index):
        self.numbers = np.array([n.block for n in nodes], np.int64)
        ands, ors = (np.array([n[k] for n in nodes], np.int64).view(np.uint64) for k in ("a", "o"))
        firsts = np.array([n.least for n in nodes], np.int64).view(np.uint64) ^ leading(1)
        self.firsts, self.lead, self.index = firsts & leading(bits), leading(bits), index
        self.tree = Tree(ands, ors, index.fan)

    def visits(self, values: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``values``, number) of the later blocks in which a value's run goes on and may hold a link."""
        place = np.searchsorted(self.numbers, own)
        beyond = np.searchsorted(self.firsts, gray_rank(values) & self.lead, "right")
        some = np.flatnonzero(beyond > place + 1)
        query, node = self.tree.search(values[some], self.index.distance, self.lead)
        later = (node > place[some][query]) & (node < beyond[some][query])
        return some[query[later]], self.numbers[node[later]]


def links(distinct: DataFrame, index: Index = Index()) -> DataFrame:
    """Spanning links (a, b) between values of the long column ``fp``, whose rows are distinct."""
    spark, segments = distinct.sparkSession, index.segments()
    n_blocks = max(1, -(-distinct.count() * len(segments) // index.block))
    turns = F.array(*[F.struct(F.lit(t).alias("turn"), turned(F.col("fp"), by).alias("value")) for t, (by, _) in enumerate(segments)])
    block = F.spark_partition_id().cast("long") * len(segments) + F.col("turn")
    placed = stored(
        distinct.select(F.explode(turns).alias("t"))
        .select("t.turn", "t.value", gray_rank_column(F.col("t.value")).alias("rank"))
        .repartitionByRange(n_blocks, "turn", "rank")
        .select("turn", "value", "rank", block.alias("block")),
        "gray-blocks",
    )
    summed = placed.groupBy("turn", "block").agg(F.bit_and("value").alias("a"), F.bit_or("value").alias("o"), F.min("rank").alias("least"))
    nodes = sorted(summed.collect(), key=lambda n: n.block)

    def visiting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = {t: Blocks(own, bits, index) for t, (_, bits) in enumerate(segments) if (own := [n for n in nodes if n.turn == t])}
        for batch in batches:
            for turn, part in batch.groupby("turn"):
                for begin, end in slices(len(part), index.batch):
                    values, own = part.value.to_numpy()[begin:end], part.block.to_numpy()[begin:end]
                    at, number = blocks[turn].visits(values.view(np.uint64), own)
                    yield pd.DataFrame({"value": values[at], "block": number})

    def found(group: pd.DataFrame) -> pd.DataFrame:
        by, bits = segments[int(group.block.iloc[0]) % len(segments)]
        values, own = group.value.to_numpy().view(np.uint64), group.own.to_numpy()
        a, b = (turned_back(x, by).view(np.int64) for x in block_links(values[own], values[~own], index, leading(bits)))
        return pd.DataFrame({"a": a, "b": b})

    visitors = placed.select("turn", "value", "block").mapInPandas(visiting, "value long, block long")
    dealt = placed.select("value", "block", F.lit(True).alias("own")).union(visitors.select("value", "block", F.lit(False)))
    return dealt.groupBy("block").applyInPandas(found, "a long, b long")


def components(documents: DataFrame, id: str, text: str, words: int, index: Index) -> DataFrame:
    """(doc_id, said, fp, root, component_id) of each row: a hash of its text, its fingerprint, its component's smallest
    fingerprint and smallest id."""
    said = F.xxhash64(col(text)).alias("said")
    marked = stored(documents.select(col(id).alias("doc_id"), said, fingerprints(col(text), words).alias("fp")), "fingerprints")
    firsts = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = connected_components(links(firsts.select("fp"), index))
    whole = firsts.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    of = stored(whole.join(smallest, "root").select("fp", "root", "component_id"), "components-of-fingerprints")
    return marked.join(of, "fp").select("doc_id", "said", "fp", "root", "component_id")


def near_copies(documents: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, index: Index = Index()) -> DataFrame:
    """One row for each document: its id (``doc_id``), ``fp`` (long) and ``component_id``, the smallest id it is linked with."""
    return components(documents, id, text, words, index).select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(documents: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, index: Index = Index()) -> DataFrame:
    """One row of ``documents`` of every component, with all its columns.

    It is a row with the component's smallest id; of several, one with the smallest fingerprint, then the smallest hash of the
    text, then the smallest other values, as far as their types have an order. An id whose rows lie in several components
    keeps a row in each of them. Rows without an id can't be named by a result, so all of them stay.
    """
    known = documents.where(col(id).isNotNull())
    found = components(known, id, text, words, index).where(F.col("doc_id") == F.col("component_id"))
    chosen = found.groupBy("root").agg(F.min(F.struct("fp", "said", "doc_id")).alias("one"))
    names = [free_name(documents, n) for n in ("kept_id", "kept_text")]
    chosen = chosen.select(F.col("one.doc_id").alias(names[0]), F.col("one.said").alias(names[1]))
    rows = known.join(chosen, (col(id) == F.col(names[0])) & (F.xxhash64(col(text)) == F.col(names[1])))
    ordered = [col(f.name) for f in documents.schema if f.dataType.typeName() not in ("map", "struct", "array", "variant")]
    whole = F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(documents.columns)])
    first = rows.groupBy(*names).agg(F.min_by(whole, F.struct(*ordered)).alias("whole"))
    kept = first.select(*[F.col(f"whole.c{i}").alias(c) for i, c in enumerate(documents.columns)])
    return kept.unionByName(documents.where(col(id).isNull()))
