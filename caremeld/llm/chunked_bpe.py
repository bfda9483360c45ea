"""Byte-level BPE with reuse of content-defined chunks.

A rolling hash over the bytes cuts every text into chunks, so that passages which documents share are cut alike wherever
they stand. A chunk is encoded once and its ids are reused. Two encodings that are put together need not be the encoding
of the joined text, so every join is repaired: the stretch between the last boundary the left chunk and the joined text
must share and the first one the right chunk must share is encoded again, over further chunks until there is such a
boundary. Both must share a boundary where white space follows anything else, in any script, or a mark of punctuation of East
Asian writing follows a letter of it: the splitting pattern of byte-level vocabularies starts a piece there whatever
stands before or after. The result therefore equals the encoding of the whole text, with special tokens that occur in it
recognised.

Documents with a common smallest line hash are brought together first, so that copies meet in one task and its cache; a
partition that grows too large is split by adaptive execution, which costs a second encoding and nothing else.

Nulls and empty texts have no ids; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import OrderedDict
from collections.abc import Callable
from dataclasses import astuple, dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremeld.llm.shared import col, free_name, kept_in_process, per_text

# The pattern that byte-level vocabularies of this family split text with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The splitting pattern takes a run of white space as one piece, but for its last character if anything follows. Wide runs are
#: cut out there, as the pattern's engine needs stack for each of their characters.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WIDE = re.compile(f"[{SPACES}]{{256,}}")
#: Letters of East Asian scripts, and marks that are neither letters, digits nor parts of special tokens.
LETTERS, POINTS = "\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3", "\u3001\u3002\u300c-\u3011\uff01\uff08\uff09\uff0c\uff1a\uff1b\uff1f"
START = rf"(?:(?<=[^{SPACES}])[{SPACES}]|(?<=[{LETTERS}])[{POINTS}])"
FIRST, LAST = re.compile(START), re.compile(f"(?s:.*){START}")


@dataclass(frozen=True)
class Chunking:
    """``mean``: a power of two, the mean distance of cuts in bytes; ``cached_bytes``: what a task keeps of chunks."""

    mean: int = 256
    window: int = 32
    cached_bytes: int = 16 << 20
    slab: int = 1 << 20


def cut_points(data: bytes, chunking: Chunking = Chunking()) -> list[int]:
    """Where the hash of the last ``window`` bytes is zero in its low bits; never inside a character.

    The gear hash sums table values shifted by their distance, built by doubling windows; slabs bound its memory.
    """
    table = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, dtype=np.uint32)
    raw = np.frombuffer(data, np.uint8)
    found = []
    for begin in range(0, len(raw), chunking.slab):
        start = max(0, begin - chunking.window)
        part = raw[start : begin + chunking.slab]
        hashed, width = table[part], 1
        while width < chunking.window:
            shifted = hashed.copy()
            shifted[width:] += hashed[:-width] << np.uint32(width)
            hashed, width = shifted, width * 2
        high = hashed >> np.uint32(32 - chunking.mean.bit_length() + 1)
        at = np.flatnonzero(high == 0) + 1 + start
        found.append(at[(at > begin) & (at <= begin + chunking.slab)])
    cuts = np.concatenate(found) if found else np.empty(0, np.int64)
    cuts = cuts[cuts < len(raw)]
    return cuts[(raw[cuts] & 0xC0) != 0x80].tolist() if len(cuts) else []


def boundaries(data: bytes) -> tuple[int, int] | None:
    """The first and the last place in ``data`` where every splitting starts a piece, given only what is in ``data``."""
    text = data.decode("utf-8")
    first = FIRST.search(text)
    if first is None:
        return None
    last = LAST.match(text).end() - 1
    return len(text[: first.start()].encode("utf-8")), len(data) - len(text[last:].encode("utf-8"))


class Codec:
    """Encodes and decodes with one vocabulary; keeps the chunks it has seen, the latest used up to a bound."""

    def __init__(self, path: str, chunking: Chunking = Chunking()):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        moved = [b for b in range(256) if b not in set(kept)]
        byte = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(moved)}
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in described["model"]["vocab"].items() if t not in special}
        self.special = tuple(special)
        self.fast = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.chunking = chunking
        self.chunks: OrderedDict[bytes, tuple] = OrderedDict()
        self.held = 0
        self.encoded_chunks = self.reused_chunks = self.repairs = 0

    def plain(self, data: bytes) -> np.ndarray:
        """The ids of a stretch as it stands."""
        text, at, parts = data.decode("utf-8"), 0, []
        for run in WIDE.finditer(text):
            ends = run.end() == len(text) or text.startswith(self.special, run.end())
            stop = run.end() - (not ends)
            parts.append(self.fast.encode_to_numpy(text[at : run.start()], allowed_special="all"))
            parts.append(np.array(self.fast._encode_single_piece(text[run.start() : stop]), np.uint32))
            at = stop
        parts.append(self.fast.encode_to_numpy(text[at:], allowed_special="all"))
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    def chunk(self, data: bytes) -> tuple | None:
        """(first boundary, last boundary, ids between them), or None if the chunk has no boundary."""
        if data in self.chunks:
            self.chunks.move_to_end(data)
            self.reused_chunks += 1
            return self.chunks[data]
        self.encoded_chunks += 1
        ends = boundaries(data)
        entry = ends and (*ends, self.plain(data[ends[0] : ends[1]]))
        cost = len(data) + (entry[2].nbytes if entry else 0) + 400
        if cost < self.chunking.cached_bytes // 16:
            self.chunks[data] = entry
            self.held += cost
            while self.held > self.chunking.cached_bytes:
                old, gone = self.chunks.popitem(last=False)
                self.held -= len(old) + (gone[2].nbytes if gone else 0) + 400
        return entry

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text``, little-endian unsigned 32-bit."""
        data = text.encode("utf-8")
        parts: list[np.ndarray] = []
        open_from = begin = 0
        for end in [*cut_points(data, self.chunking), len(data)]:
            entry = self.chunk(data[begin:end])
            if entry:  # both encodings agree from here on: repair what lies before
                first, last, ids = entry
                parts.append(self.plain(data[open_from : begin + first]))
                parts.append(ids)
                self.repairs += open_from < begin
                open_from = begin + last
            begin = end
        parts.append(self.plain(data[open_from:]))
        return np.concatenate(parts).astype("<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``, special tokens included; bytes that are no character become U+FFFD."""
        return self.fast.decode_bytes(ids.tolist()).decode("utf-8", errors="replace")


def brought_together(df: DataFrame, text: str) -> DataFrame:
    """Rows whose texts have the same smallest line hash in one partition, however large partitions split."""
    lines = F.split(F.coalesce(col(text), F.lit("")), "\n", -1)
    key = free_name(df, "smallest_line")
    return df.withColumn(key, F.array_min(F.transform(lines, lambda x: F.xxhash64(x)))).hint("rebalance", key).drop(key)


def encoded(path: str, make: Callable[[Codec, str], tuple], schema: str, chunking: Chunking = Chunking()):
    """A function of a text column: what ``make`` takes from the codec and a text. A worker has one codec, whichever
    functions it runs one after the other; earlier ones would keep theirs with its chunks."""

    def start():
        codec = kept_in_process(("chunks", path, *astuple(chunking)), lambda: Codec(path, chunking), only="chunks")
        return lambda value: make(codec, value)

    return per_text(start, schema)


def token_ids(text: Column, path: str, chunking: Chunking = Chunking()) -> Column:
    """The ids of each text as an array."""
    return encoded(path, lambda codec, value: codec.encode(value).tolist(), "array<long>", chunking)(text)


def digests(text: Column, path: str, chunking: Chunking = Chunking()) -> Column:
    """Number and hash of the ids, and the hash of the text decoded from them."""

    def make(codec: Codec, value: str) -> tuple:
        ids = codec.encode(value)
        decoded = codec.decode(ids).encode("utf-8")
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return encoded(path, make, "n_tokens long, ids_sha256 string, decoded_sha256 string", chunking)(text)
