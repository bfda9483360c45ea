"""Packing documents into as few token sequences as local search finds.

Documents become token ids with an end id. Longer ones than a sequence are cut into full pieces, of which only the first may
be shorter; full pieces are sequences of their own. All others are packed by their lengths alone: text and ids never
leave the task that encoded them.

Pieces are dealt to groups of bounded size by hash. A group is packed by best fit, longest first, and then improved: from the
fullest underfull bin on, a bin takes a document of a less full one (a move), or gives one or two of its own for it
(one-for-one, two-for-one), always the exchange that fills it most. Each exchange moves tokens from a less full bin to a fuller
one, so the sum of squared fills grows and the search ends; the emptiest bins lose their documents until they vanish.
Full bins are finished. The underfull bins of all groups are dealt anew, as they are, to fewer groups, until one group holds
the rest or a round no longer gets rid of ``gain`` of the bins.

Null texts count as empty and have the end alone; null ids stay null; repeated rows are packed as often as they occur; ties
between equal lengths go by the written row; an empty table gives an empty result; other columns are left out. A text of
any length is encoded whole, by the task that reads it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremeld.llm.chunked_bpe import Codec
from caremeld.llm.shared import col, kept_in_process, stored


@dataclass(frozen=True)
class Packing:
    """``capacity``: tokens of a sequence; ``end``: the id after every document; ``group``: pieces packed in one task;
    ``gain``: the share of underfull bins that a round must finish or empty for another one to follow."""

    path: str
    capacity: int = 2048
    end: int = 0
    group: int = 4_000
    gain: float = 0.01


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces, the first as short as need be."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((start, capacity) for start in range(first, length, capacity))]


def pieces(documents: DataFrame, packing: Packing, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for every piece of every document, written."""
    chosen = documents.select(col(id).cast("long").alias("doc_id"), col(text).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept_in_process(("codec", packing.path), lambda: Codec(packing.path))
        end = np.array([packing.end], np.uint32)
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = value.as_py() or ""
                ids = np.concatenate([codec.plain(value.encode("utf-8")), end]).astype("<u4")
                for number, (start, length) in enumerate(cut(len(ids), packing.capacity)):
                    rows.append((doc_id, number, start, length, crc32(ids[start : start + length].tobytes())))
            if rows:
                types = [pa.int64(), pa.int32(), *[pa.int64()] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return chosen.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of places in ``lengths``: each length, from the longest, into the bin with the least room that takes it."""
    bins: list[list[int]] = []
    with_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room r
    for place in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[place]
        enough = rooms >> length
        if enough:
            room = length + (enough & -enough).bit_length() - 1
            number = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, number = capacity, len(bins)
            bins.append([])
        bins[number].append(place)
        if room > length:
            with_room.setdefault(room - length, []).append(number)
            rooms |= 1 << (room - length)
    return bins


def improved(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """``bins`` after moves and exchanges between underfull bins, until none increases the sum of squared fills."""
    bins = [list(b) for b in bins]
    while one_pass(bins, lengths, capacity):
        pass
    return [b for b in bins if b]


def one_pass(bins: list[list[int]], lengths: list[int], capacity: int) -> bool:
    """Every underfull bin, from the fullest, takes what fills it most from the less full ones; True if one changed."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    under = sorted((n for n, f in enumerate(fill) if 0 < f < capacity), key=lambda n: -fill[n])
    if len(under) < 2:
        return False
    of = {i: n for n in under for i in bins[n]}
    waiting = set(under)  # not yet served: all of them less full than the one being served
    offered: dict[int, list[int]] = {}  # documents of waiting bins by length, those of the emptiest last
    number: dict[int, int] = {}
    for n in under:
        for i in bins[n]:
            offered.setdefault(lengths[i], []).append(i)
            number[lengths[i]] = number.get(lengths[i], 0) + 1
    present = sum(1 << length for length in number)  # bit l: a waiting bin has a document of length l

    def withdraw(length: int) -> None:
        nonlocal present
        number[length] -= 1
        if not number[length]:
            present ^= 1 << length

    changed, heap = False, [(-fill[n], n) for n in under]
    heapify(heap)
    while heap:
        was, taker = heappop(heap)
        if -was != fill[taker]:  # it has given since
            if fill[taker]:
                heappush(heap, (-fill[taker], taker))
            else:
                waiting.discard(taker)
            continue
        waiting.discard(taker)
        for i in bins[taker]:
            withdraw(lengths[i])
        while fill[taker] < capacity and present:
            given, length = exchange([lengths[i] for i in bins[taker]], present, capacity - fill[taker])
            if given is None:
                break
            while of[taken := offered[length].pop()] not in waiting:
                pass
            giver = of[taken]
            bins[giver].remove(taken)
            withdraw(length)
            for one in given:
                i = next(i for i in bins[taker] if lengths[i] == one)
                bins[taker].remove(i)
                bins[giver].append(i)
                of[i] = giver
                offered.setdefault(one, []).append(i)
                number[one] = number.get(one, 0) + 1
                present |= 1 << one
            bins[taker].append(taken)
            of[taken] = taker
            more = length - sum(given)
            fill[taker] += more
            fill[giver] -= more
            changed = True
    return changed


def exchange(own: list[int], present: int, room: int) -> tuple[list[int] | None, int]:
    """What a bin gives (none, one or two lengths) and takes so that it gains as much as fits into ``room``.

    Sets of lengths are bits of a number: shifting what can be given by a gain and comparing it with what others have looks
    at all exchanges of that gain at once. Of equal gains a move goes before an exchange, one for one before two for one.
    """
    times: dict[int, int] = {}
    for length in own:
        times[length] = times.get(length, 0) + 1
    ones = sum(1 << length for length in times)
    twos = 0
    for length, n in times.items():
        twos |= (ones ^ (0 if n > 1 else 1 << length)) << length
    for gain in range(min(room, present.bit_length() - 1), 0, -1):
        if present >> gain & 1:
            return [], gain
        if found := ones << gain & present:
            length = found.bit_length() - 1
            return [length - gain], length
        if found := twos << gain & present:
            length = found.bit_length() - 1
            total = length - gain
            first = next(a for a, n in times.items() if total - a in times and (2 * a != total or n > 1))
            return [first, total - first], length
    return None, 0


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def packed(documents: DataFrame, packing: Packing, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece."""
    key = F.monotonically_increasing_id()
    rows = stored(pieces(documents, packing, id, text).withColumn("key", key), "pieces")
    rows = rows.withColumns({"sequence_id": F.col("key"), "offset": F.lit(0).cast("long")})
    columns = [f.split()[0] for f in PACKED.split(", ")]

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        lengths, keys = table["length"].to_pylist(), table["key"].to_pylist()
        bins: dict[int, list[int]] = {}
        for i, name in enumerate(table["sequence_id"].to_pylist()):
            bins.setdefault(name, []).append(i)
        start = best_fit(lengths, packing.capacity) if len(bins) == len(keys) else list(bins.values())
        sequence, offset, finished = [0] * len(keys), [0] * len(keys), [False] * len(keys)
        for bin in improved(start, lengths, packing.capacity):
            name, at, full = min(keys[i] for i in bin), 0, sum(lengths[i] for i in bin) == packing.capacity
            for i in bin:
                sequence[i], offset[i], finished[i] = name, at, full
                at += lengths[i]
        kept = table.select(columns[:-2]).append_column("sequence_id", pa.array(sequence, pa.int64()))
        kept = kept.append_column("offset", pa.array(offset, pa.int64())).append_column("key", table["key"])
        return kept.append_column("finished", pa.array(finished, pa.bool_()))

    whole = F.col("length") == packing.capacity
    done, left = [rows.where(whole)], rows.where(~whole)
    n_left, before, turn = left.count(), None, 0
    while n_left:
        groups = -(-n_left // packing.group)
        dealt = left.groupBy(F.pmod(F.xxhash64("sequence_id", F.lit(turn)), F.lit(groups)))
        searched = stored(dealt.applyInArrow(pack, f"{PACKED}, key long, finished boolean"), "packed")
        left = searched.where(~F.col("finished")).drop("finished")
        n_left, bins = left.agg(F.count("*"), F.count_distinct("sequence_id")).first()
        if groups == 1 or (before is not None and bins > before * (1 - packing.gain)):
            done.append(searched)
            break
        done.append(searched.where("finished"))
        before, turn = bins, turn + 1
    out = done[0].select(*columns)
    for part in done[1:]:
        out = out.unionByName(part.select(*columns))
    return out
