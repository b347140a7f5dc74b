"""Drop lines that many documents share, but for one place.

Two Bloom filters over hashes of line keys: what is seen goes into the first, and what the
first holds already goes into the second. Each task fills its own pair, and pairs are merged
block by block: a key that two tasks have seen once each has its bits in both first filters,
so their common bits belong in the second. A key that stands in two documents is thus always
in the merged second filter. Only lines that it holds are shuffled, to count their documents
exactly and to choose the one that keeps them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.base import fields, free_name, map_batches, map_rows, settled, slices, utf8

#: Bits of a filter: 32 MB, whatever the input's size. With more lines than it is made for,
#: more lines are suspected and shuffled; the result is the same.
FILTER_BITS = 28
PROBES = 2
#: Bits of a block, the unit that is sent and merged.
BLOCK_BITS = 15

_SPACE = b" \t\n\r\x0b\x0c"


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z in lower case."""
    return line.strip(_SPACE).lower()


def _long_keys(text: bytes, shortest: int) -> Iterator[tuple[int, bytes]]:
    """Numbers and keys of the lines whose key has ``shortest`` code points or more."""
    for i, line in enumerate(text.split(b"\n")):
        key = line_key(line)
        if len(key) >= shortest and (
            len(key) >= 4 * shortest or key.isascii() or len(key.decode()) >= shortest
        ):
            yield i, key


def _bits(keys: list[bytes]) -> np.ndarray:
    """The places of each key in a filter, a row per key."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
    mask = np.uint64((1 << FILTER_BITS) - 1)
    shifts = [np.uint64(64 // PROBES * i) for i in range(PROBES)]
    return np.stack([(hashes >> s) & mask for s in shifts], axis=1).astype(np.int64)


class Bits:
    """A set of places, a bit each."""

    def __init__(self, count: int):
        self.data = np.zeros(count >> 3, np.uint8)

    def add(self, places: np.ndarray) -> None:
        places = places.ravel()
        np.bitwise_or.at(self.data, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))

    def has(self, places: np.ndarray) -> np.ndarray:
        return (self.data[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


class Pair:
    """The two filters."""

    def __init__(self, count: int):
        self.once, self.twice = Bits(count), Bits(count)

    def add(self, places: np.ndarray) -> None:
        """Keys of several documents, a row of places each."""
        distinct, times = np.unique(places, axis=0, return_counts=True)
        self.twice.add(distinct[(times > 1) | self.once.has(distinct).all(axis=1)])
        self.once.add(distinct)

    def merge(self, once: np.ndarray, twice: np.ndarray) -> None:
        """The filters of another task, as bytes."""
        self.twice.data |= twice | self.once.data & once
        self.once.data |= once


def _packed(data: np.ndarray) -> bytes:
    """Few bits as their places, many as they are."""
    places = np.flatnonzero(np.unpackbits(data, bitorder="little"))
    return places.astype("<u2").tobytes() if len(places) * 2 < len(data) else data.tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    size = 1 << BLOCK_BITS - 3
    if len(packed) == size:
        return np.frombuffer(packed, np.uint8)
    bits = np.zeros(size << 3, np.uint8)
    bits[np.frombuffer(packed, "<u2")] = 1
    return np.packbits(bits, bitorder="little")


def _batch_of(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)]
    return pa.RecordBatch.from_arrays(columns, list(kinds))


def _keys_of(column: pa.Array, shortest: int) -> tuple[list[int], list[bytes]]:
    """The rows and keys of the long lines of a column, each key once per row."""
    rows, keys = [], []
    for i, content in enumerate(utf8(column)):
        own = {key for _, key in _long_keys(content, shortest)}
        rows += [i] * len(own)
        keys += own
    return rows, keys


def repeated_filter(docs: DataFrame, text: str, shortest: int) -> DataFrame:
    """The blocks of the second filter that are not empty."""
    kinds = {"block": pa.int32(), "once": pa.binary(), "twice": pa.binary()}

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(1 << FILTER_BITS)
        for batch in slices(batches):
            _, keys = _keys_of(batch.column(0), shortest)
            if keys:
                pair.add(_bits(keys))
        once = pair.once.data.reshape(-1, 1 << BLOCK_BITS - 3)
        twice = pair.twice.data.reshape(once.shape)
        numbers = np.flatnonzero(once.any(axis=1)).tolist()
        for start in range(0, len(numbers), 512):
            rows = [(n, _packed(once[n]), _packed(twice[n])) for n in numbers[start : start + 512]]
            yield _batch_of(rows, kinds)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come in the order of their blocks: one block's pair is held at a time.
        number, pair = None, None

        def result() -> Iterator[pa.RecordBatch]:
            if number is not None and pair.twice.data.any():
                row = (number, _packed(pair.twice.data))
                yield _batch_of([row], {"block": pa.int32(), "twice": pa.binary()})

        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != number:
                    yield from result()
                    number, pair = row["block"], Pair(1 << BLOCK_BITS)
                pair.merge(_unpacked(row["once"]), _unpacked(row["twice"]))
        yield from result()

    filled = map_batches(docs.select(text), fill, "block int, once binary, twice binary")
    in_order = filled.repartition("block").sortWithinPartitions("block")
    return map_batches(in_order, merge, "block int, twice binary")


def _suspects(docs: DataFrame, owner: str, text: str, shortest: int, blocks) -> DataFrame:
    """Each row's id with the digests of its keys that the second filter holds."""
    # Of bounded size: the filter has so many blocks, whatever the input.
    packed = {row["block"]: bytes(row["twice"]) for row in blocks.toLocalIterator()}
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    schema = ", ".join([*fields(docs.select(owner)), "line_key binary"])

    def make():
        size = 1 << BLOCK_BITS - 3
        twice = Bits(1 << FILTER_BITS)
        for number, data in shared.value.items():
            twice.data[number * size : (number + 1) * size] = _unpacked(data)

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            rows, keys = _keys_of(batch.column(text), shortest)
            held = np.flatnonzero(twice.has(_bits(keys)).all(axis=1)).tolist() if keys else []
            owners = batch.column(owner).take(pa.array([rows[i] for i in held], pa.int64()))
            yield {owner: owners, "line_key": [hashlib.sha256(keys[i]).digest() for i in held]}

        return work

    return map_rows(docs, schema, make)


def dedup_lines(
    docs: DataFrame,
    least_documents: int = 5,
    shortest: int = 40,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents without lines that ``least_documents`` documents or more share.

    A line's key is the line without ASCII white space at its ends, A-Z in lower case. Keys
    of ``shortest`` code points or more that stand in that many documents (distinct ids)
    lose all their lines, except in the document of the largest id that holds them. The
    other lines stay, joined by newlines, in the text column; ``n_lines`` (before) and
    ``n_dropped`` are added, and replace columns of these names. A null or empty text is one
    empty line and gives the empty text. Null ids count as one document, smaller than any;
    rows with the same id are parts of one document. Other columns and all rows stay.
    """
    added = ("n_lines", "n_dropped")
    kept = [c for c in docs.columns if c.lower() not in added]
    docs = docs.select(*kept)
    blocks = settled(repeated_filter(docs, text, shortest), "repeated-lines")
    ids = docs.select(docs[doc_id].alias("line_owner"), docs[text].alias("line_text"))
    suspects = _suspects(ids, "line_owner", "line_text", shortest, blocks)
    suspects = settled(suspects.distinct(), "suspected-lines")
    frequent = suspects.groupBy("line_key").agg(
        F.count(F.lit(1)).alias("holders"), F.max("line_owner").alias("keeper")
    )
    # Written, so that the places of a frequent line can be split in the join.
    frequent = settled(frequent.filter(F.col("holders") >= least_documents), "frequent-lines")
    drops = (
        suspects.join(frequent.hint("merge"), "line_key")
        .filter(~F.col("line_owner").eqNullSafe(F.col("keeper")))
        .groupBy("line_owner")
        .agg(F.collect_list("line_key").alias("dropped_keys"))
    )
    drops = settled(drops, "dropped-lines")
    owner, keys = free_name(docs, "line_owner"), free_name(docs, "dropped_keys")
    drops = drops.toDF(owner, keys)
    # The drops grow with the documents: they are never broadcast.
    same = docs[doc_id].eqNullSafe(drops[owner])
    joined = docs.join(drops.hint("merge"), same, "left").drop(owner)
    schema = ", ".join([*fields(docs), "n_lines bigint", "n_dropped bigint"])

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            texts, lines, dropped = [], [], []
            gone_of = batch.column(keys).to_pylist()
            for content, gone in zip(utf8(batch.column(text)), gone_of, strict=True):
                n = content.count(b"\n") + 1
                lost: set[int] = set()
                if gone:
                    gone = set(gone)
                    for i, key in _long_keys(content, shortest):
                        if hashlib.sha256(key).digest() in gone:
                            lost.add(i)
                if lost:
                    parts = content.split(b"\n")
                    content = b"\n".join(p for i, p in enumerate(parts) if i not in lost)
                texts.append(content.decode())
                lines.append(n)
                dropped.append(len(lost))
            yield {c: batch.column(c) for c in kept if c != text} | {
                text: texts,
                "n_lines": lines,
                "n_dropped": dropped,
            }

        return work

    return map_rows(joined, schema, make)
