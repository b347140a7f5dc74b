"""Fingerprints of texts by consistent weighted sampling of their words.

A word that comes ``S`` times in a text gets, for each of the samples, r and c from the gamma
distribution of shape two and b from the unit interval, all by a hash of the word. With
t = floor(ln S / r + b) and y = exp(r (t - b)) its value is a = c / (y exp(r)), and the sample
of a text is the word and t of the smallest value. Two texts get the same sample with a
probability that equals the generalised Jaccard similarity of their word counts, the sum of
the smaller counts over the sum of the larger ones, so the share of equal samples estimates it.

The values depend on the word and its count alone: a task keeps them in a table of bounded
size, as a number each whose order is that of the values and whose last bits name the sample.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.base import arrow_schema, blocks, fields, free_name, map_batches, map_rows
from nestflow.llm.base import settled, slices, text_key, utf8
from nestflow.llm.hashing import mix

SAMPLES = 64
#: Texts whose words are looked up at one time, and words that a task's table holds: 32 MB at
#: 64 samples.
BLOCK_BYTES = 256 << 10
MOST_KEPT = 1 << 16
#: Rows of values made in one go, so that numpy's steps stay in the processor's cache.
_CHUNK = 256
#: Texts whose words are numbered before their values are made.
_TOGETHER = 64

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_HALF, _LAST = np.uint32(16), np.uint32(0xFFFF)
#: More than any value is below zero: r is at most 23, and t r at most that more than ln S.
_POSITIVE = np.float32(128)


class Sampler:
    """Samples of texts; values of words are kept between calls."""

    def __init__(self, samples: int = SAMPLES, most: int = MOST_KEPT):
        if samples < 1:
            raise ValueError("a fingerprint has one sample at least")
        self.samples, self._most = samples, most
        # Numbers far from each other: a word's hash for each sample.
        self._seeds = mix(np.arange(1, samples + 1, dtype=np.uint64)).view(np.uint32).reshape(-1, 2)
        self._rows = _Rows()
        self._table = np.zeros((0, samples), np.uint64)

    def values(self, terms: list[tuple[bytes, int]]) -> np.ndarray:
        """For each word and count, a number per sample: its upper half is in the order of the
        values, its lower half names the word and t."""
        made = np.empty((len(terms), self.samples), np.uint64)
        for low in range(0, len(terms), _CHUNK):
            part = terms[low : low + _CHUNK]
            words = np.array([xxhash.xxh3_64_intdigest(w) for w, _ in part], np.uint64)
            words = words.view(np.uint32).reshape(-1, 1, 2)
            counts = np.array([n for _, n in part])
            first = _mix(words[..., 0] ^ self._seeds[:, 0])
            second = _mix((words[..., 1] ^ self._seeds[:, 1]) + first)
            # The product of two numbers of the unit interval has a gamma logarithm.
            r = -np.log(_unit(first >> _HALF) * _unit(first & _LAST))
            c = -np.log(_unit(second >> _HALF) * _unit(second & _LAST))
            name = _mix(first ^ second)
            b = name.astype(np.float32) * np.float32(2.0**-32)
            value = np.log(c) - r * (1 - b)
            often = np.flatnonzero(counts > 1)
            if len(often):
                log_count = np.log(counts[often].astype(np.float32))[:, None]
                t = np.floor(log_count / r[often] + b[often])
                value[often] -= r[often] * t
                name[often] += t.astype(np.uint32) * np.uint32(0x9E37)
            # Bits of positive floats are in their order.
            bits = (value + _POSITIVE).view(np.uint32)
            out = made[low : low + len(part)].view(np.uint32)
            out[:, ::2], out[:, 1::2] = name, bits
        return made

    def signatures(self, texts: list[bytes]) -> np.ndarray:
        """A row of 16-bit samples per text; all zero for a text without words, and for no
        other."""
        made = np.zeros((len(texts), self.samples), np.uint16)
        for low, high in blocks(texts, BLOCK_BYTES):
            counts = (Counter(t.translate(_LOWER).split()) for t in texts[low:high])
            terms = [list(own.items()) for own in counts]
            for i, own in enumerate(terms):
                if len(own) > self._most // 4:
                    made[low + i], terms[i] = self._sign_long(own), []
            for first in range(0, len(terms), _TOGETHER):
                group = terms[first : first + _TOGETHER]
                self._sign(group, made[low + first : low + first + len(group)])
        return made

    def _sign(self, terms: list[list[tuple[bytes, int]]], out: np.ndarray) -> None:
        if len(self._rows) + sum(map(len, terms)) > self._most:
            self._rows.clear()
        known, row = len(self._rows), self._rows.__getitem__
        at = [np.fromiter(map(row, own), np.intp, len(own)) for own in terms]
        new = list(islice(self._rows, known, None))
        if known + len(new) > len(self._table):
            grown = np.empty((max(self._most, known + len(new)), self.samples), np.uint64)
            grown[:known] = self._table[:known]
            self._table = grown
        self._table[known : known + len(new)] = self.values(new)
        for i, rows in enumerate(at):
            if len(rows):
                out[i] = _names(self._table.take(rows, axis=0).min(axis=0))

    def _sign_long(self, own: list[tuple[bytes, int]]) -> np.ndarray:
        """In parts: the smallest value of all is the smallest of those of the parts."""
        best = np.full(self.samples, np.iinfo(np.uint64).max, np.uint64)
        for low in range(0, len(own), 4096):
            best = np.minimum(best, self.values(own[low : low + 4096]).min(axis=0))
        return _names(best)


class _Rows(dict):
    """A row number for each new key."""

    def __missing__(self, key) -> int:
        self[key] = row = len(self)
        return row


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 32-bit values."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def _unit(bits: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1 by 16 bits."""
    return (bits.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-16)


def _names(best: np.ndarray) -> np.ndarray:
    """16 bits of what the smallest values are of; 1 at least."""
    return np.maximum(best & np.uint64(0xFFFF), np.uint64(1)).astype(np.uint16)


def hexed(signatures: np.ndarray) -> list[str]:
    """Four hex digits per sample."""
    return [row.astype(">u2").tobytes().hex() for row in signatures]


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal samples, row by row."""
    return (a == b).mean(axis=1)


def likeness(a, b, samples: int = SAMPLES):
    """The share of equal samples of two columns of fingerprints, in built-in functions."""
    places = F.sequence(F.lit(1), F.lit(4 * samples - 3), F.lit(4))
    same = F.filter(places, lambda i: F.substring(a, i, F.lit(4)) == F.substring(b, i, F.lit(4)))
    return F.size(same) / F.lit(samples)


def fingerprints(df: DataFrame, samples: int = SAMPLES, text: str = "text") -> DataFrame:
    """The rows with ``fingerprint``, in place of a column of that name.

    Words are what stands between ASCII white space, A-Z in lower case, and weigh as often as
    they come in the whole text. A fingerprint has four hex digits a sample; texts of the same
    words and counts have the same one. A null or empty text, or one of white space, has that
    of zeros only, which no other text has. Repeated rows and ids, nulls and other columns
    change nothing, and an empty table gives an empty one.
    """
    kept = [c for c in df.columns if c.lower() != "fingerprint"]
    source = free_name(df, "signed_text")
    carried = df.select(*kept, df[text].alias(source))
    schema = ", ".join([*fields(df.select(*kept)), "fingerprint string"])

    def make():
        sampler = Sampler(samples)

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            signed = hexed(sampler.signatures(utf8(batch.column(source))))
            yield {c: batch.column(c) for c in kept} | {"fingerprint": signed}

        return work

    return map_rows(carried, schema, make)


def spliced(text: str, other: str) -> str:
    """The text, the last half of its code points replaced by as many of the other's first."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


_COMPARED = (
    "n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
_ENDS = f"{_COMPARED}, part int, begins boolean, ends boolean, whole string"


def _packed(signatures: np.ndarray) -> list[bytes]:
    """What ``hexed`` shows, in half the bytes."""
    return [row.astype(">u2").tobytes() for row in signatures]


def _compared(sampler: Sampler, texts: list[bytes]) -> tuple[dict, np.ndarray]:
    """Columns for all texts but the last, each compared with the one after it."""
    plain = [t.decode() for t in texts]
    edited = [spliced(a, b).encode() for a, b in zip(plain[:-1], plain[1:], strict=True)]
    own, changed = sampler.signatures(texts), sampler.signatures(edited)
    columns = {
        "n_chars": [len(t) for t in plain[:-1]],
        "edited_sha256": [hashlib.sha256(t).digest() for t in edited],
        "fingerprint": _packed(own[:-1]),
        "edited_fingerprint": _packed(changed),
        "near_edited": alike(own[:-1], changed),
        "near_next": alike(own[:-1], own[1:]),
    }
    return columns, own


def compare_with_next(
    df: DataFrame, samples: int = SAMPLES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """For each row: its fingerprint, that of its edited text, and how near others are.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256`` (of the text whose last half is
    replaced by the start of the next text, see ``spliced``), ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next`` (shares of equal samples with the
    edited and with the next text). Next is the row after by id, nulls first, and by the text's
    hash among equal ids, so that repeated rows follow each other; after the last row comes the
    first, and a single row is its own next. A null text counts as empty, an empty table gives
    an empty one.

    Texts are shuffled once, by ranges of ids, and each range is gone through in order. The
    first and the last row of each range are written with their texts, and the last ones are
    then compared with the first ones of the ranges that follow.
    """
    id_type = df.schema[doc_id].dataType.simpleString()
    rows = df.select(
        df[doc_id].alias("doc_id"), F.coalesce(df[text], F.lit("")).alias("text")
    ).withColumn("key", text_key())
    rows = rows.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key")
    schema = f"doc_id {id_type}, {_ENDS}"
    arrow = arrow_schema(df.sparkSession, schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, part = Sampler(samples), TaskContext.get().partitionId()
        ids: list = []
        texts: list[bytes] = []
        begins = True

        def made(columns: dict, count: int, ends: bool) -> pa.RecordBatch:
            nonlocal begins
            columns = columns | {"doc_id": ids[:count], "part": [part] * count}
            columns["begins"] = [begins, *[False] * (count - 1)]
            columns["ends"] = [ends] * count
            whole = [None] * count
            if begins or ends:
                whole[0] = texts[0].decode()
            columns["whole"] = whole
            begins = False
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) for f in arrow], schema=arrow
            )

        for batch in slices(batches):
            ids += batch.column("doc_id").to_pylist()
            texts += utf8(batch.column("text"))
            if len(texts) > 1:
                columns, _ = _compared(sampler, texts)
                yield made(columns, len(texts) - 1, ends=False)
                del ids[:-1], texts[:-1]
        if texts:
            columns = dict.fromkeys([f.name for f in arrow], [None])
            columns["fingerprint"] = _packed(sampler.signatures(texts))
            columns["n_chars"] = [len(texts[0].decode())]
            yield made(columns, 1, ends=True)

    walked = settled(map_batches(rows, walk, schema), "compared")
    # As many numbers as there are ranges.
    parts = sorted(r["part"] for r in walked.filter("begins").select("part").collect())
    after = list(zip(parts, [*parts[1:], *parts[:1]], strict=True))
    after = df.sparkSession.createDataFrame(after, "part int, next_part int")
    firsts = walked.filter("begins").select(
        F.col("part").alias("next_part"), F.col("whole").alias("next_whole")
    )
    ends = walked.filter("ends").select("doc_id", "whole", "part")
    ends = ends.join(after, "part").join(firsts, "next_part").select("doc_id", "whole", "next_whole")

    def make():
        sampler = Sampler(samples)

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            texts = zip(utf8(batch.column("whole")), utf8(batch.column("next_whole")), strict=True)
            for i, pair in enumerate(texts):
                columns, _ = _compared(sampler, list(pair))
                yield {"doc_id": batch.column("doc_id").slice(i, 1)} | columns

        return work

    finished = map_rows(ends, f"doc_id {id_type}, {_COMPARED}", make)
    made = walked.filter("NOT ends").select(*finished.columns).unionAll(finished)
    shown = [c for c in made.columns if dict(made.dtypes)[c] == "binary" and c != "doc_id"]
    return made.withColumns({c: F.lower(F.hex(c)) for c in shown})
