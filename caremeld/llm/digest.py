"""Document fingerprints as quartile bucket digests.

All hashed byte triplets of a text (three bytes out of a sliding window, in six arrangements) are counted in buckets. A
digest is a length byte, a byte with the ratios of the quartiles, and for every bucket two bits saying in which quartile its
count lies, in hexadecimal. The difference of two digests adds the distances of the bucket codes (1, 2, and 6 for opposite
quartiles), of the lengths and of the ratios; it is bounded by what unrelated texts reach on average, and the likeness is
one minus the share of that bound.

Null and empty texts have the digest of the empty text, which is like itself only; equal texts have equal digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremeld.llm.shared import col, slices, stored

BUCKETS = 256
WINDOW = 5
SLAB = 1 << 20
ARRANGEMENTS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
#: Mean distance of a bucket's codes in unrelated texts, with every quartile equally likely.
UNRELATED = 1.625


def bucket_counts(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for begin, end in slices(max(0, len(raw) - WINDOW + 1), SLAB):
        part = raw[begin : end + WINDOW - 1].astype(np.uint32)
        n = end - begin
        for kind, (i, j, k) in enumerate(ARRANGEMENTS):
            packed = part[i : i + n] | part[j : j + n] << 8 | part[k : k + n] << 16
            hashed = (packed + np.uint32(kind << 24)) * np.uint32(2654435761)
            counts += np.bincount((hashed ^ hashed >> 15) * np.uint32(2246822519) >> 24, minlength=BUCKETS)
    return counts


def digest(text: str) -> str:
    data = text.encode("utf-8")
    counts = bucket_counts(data)
    quartiles = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = np.searchsorted(quartiles, counts, side="left").astype(np.uint8)
    packed = codes[0::4] << 6 | codes[1::4] << 4 | codes[2::4] << 2 | codes[3::4]
    length = min(255, round(8 * np.log2(len(data) + 1)))
    q1, q2, q3 = quartiles.tolist()
    ratios = (q1 * 100 // q3 % 16 << 4 | q2 * 100 // q3 % 16) if q3 else 0
    return (bytes([length, ratios]) + packed.tobytes()).hex()


def likeness(one: str, other: str) -> float:
    """1 for equal digests, 0 from the bound on."""
    if one == other:
        return 1.0
    a, b = (np.frombuffer(bytes.fromhex(x), np.uint8) for x in (one, other))
    pairs = np.abs(codes_of(a).astype(np.int16) - codes_of(b))
    score = float(np.array([0, 1, 2, 6])[pairs].sum())
    apart = abs(int(a[0]) - int(b[0]))
    score += max(0, apart - 1)
    for shift in (0, 4):
        step = abs((int(a[1]) >> shift & 15) - (int(b[1]) >> shift & 15))
        score += max(0, min(step, 16 - step) - 1)
    return max(0.0, 1.0 - score / (UNRELATED * BUCKETS))


def codes_of(packed: np.ndarray) -> np.ndarray:
    return (packed[2:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3).ravel()


def mixed_with(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
EDGES = f"{RESULT}, place int, kind string, text string"
DONE, FIRST, LAST = "done", "first", "last"


def compared(doc_id, text: str, fp: str, following: str, next_fp: str) -> tuple:
    edited = mixed_with(text, following)
    edited_fp = digest(edited)
    sha = hashlib.sha256(edited.encode("utf-8")).hexdigest()
    return doc_id, len(text), sha, fp, edited_fp, likeness(fp, edited_fp), likeness(fp, next_fp)


def batches_of(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def compare_with_next(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The digest of every text, of the text edited with the next document's, and their likeness.

    The next document is the next lower id (rows without an id come last; equal ids are ordered by text), after the last
    the first. Texts are range-partitioned by id once and streamed in order, two at a time. Only the first and
    the last document of each partition, which have their neighbour elsewhere, are written with their text and matched.
    """
    names = [f.split()[0] for f in EDGES.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int32(), pa.string(), pa.string()]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out, size = [], 0
            for doc_id, value, place in zip(*(batch.column(i).to_pylist() for i in range(3))):
                value = value or ""
                now = (doc_id, value, digest(value))
                if held:
                    out.append((*compared(*held, now[1], now[2]), place, DONE, None))
                else:
                    out.append((doc_id, len(value), None, now[2], None, None, None, place, FIRST, value))
                held, last_place = now, place
            if out:
                yield batches_of(out, names, types)
        if held:
            yield batches_of([(held[0], len(held[1]), None, held[2], None, None, None, last_place, LAST, held[1])], names, types)

    spark = documents.sparkSession
    ordered = documents.select(col(id).cast("long").alias("doc_id"), col(text).alias("text"))
    ordered = (
        ordered.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("doc_id").desc_nulls_last())
        .sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "text")
        .select("doc_id", "text", F.spark_partition_id().alias("place"))
    )
    rows = stored(ordered.mapInArrow(stream, EDGES), "digests")
    places = sorted(r.place for r in rows.where(F.col("kind") == FIRST).select("place").collect())
    columns = [f.split()[0] for f in RESULT.split(", ")]
    if not places:
        return rows.select(*columns)
    follows = spark.createDataFrame(list(zip(places, places[1:] + places[:1])), "place int, next_place int")
    heads = rows.where(F.col("kind") == FIRST).select(
        F.col("place").alias("next_place"), F.col("text").alias("following"), F.col("fingerprint").alias("next_fp")
    )
    tails = rows.where(F.col("kind") == LAST).select("doc_id", "text", "fingerprint", "place")
    pairs = tails.join(follows, "place").join(heads, "next_place").select("doc_id", "text", "fingerprint", "following", "next_fp")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batches_of([compared(*row) for row in zip(*(c.to_pylist() for c in batch.columns))], columns, types[:7])

    return rows.where(F.col("kind") == DONE).select(*columns).unionByName(pairs.mapInArrow(across, RESULT))
