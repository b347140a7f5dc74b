"""Byte-level BPE: encode texts to ids and ids to texts, by batched merge rounds in numpy.

A file of the ``tokenizers`` library gives the vocabulary and the merges. The symbols of
many words stand in one flat array. A round finds each word's lowest-ranked pair, by binary
search over the sorted pair keys, and merges all places of that pair at once; words without
a pair leave the array. A merge makes only pairs of higher rank than its own, as their
symbol is made by it, so a round is what single merges in order of rank give.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import pre_tokenizers

from nestflow.llm.base import blocks, fields, free_name, map_rows, utf8
from nestflow.llm.pieces import Memo, split

#: The pattern that splits text before the merges.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: From here on the classes of characters depend on the version of Unicode; there the
#: library's own splitter decides.
FIRST_DOUBTFUL = 0x558

_NONE = np.int64(1) << 40


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class ByteBPE:
    """A tokenizer read from ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        alphabet = byte_alphabet()
        byte_of = {c: b for b, c in enumerate(alphabet)}
        vocabulary = model["vocab"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocabulary.values(), *specials.values()]) + 1
        self._bytes = [b""] * size
        for token, i in vocabulary.items():
            self._bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in specials.items():
            self._bytes[i] = token.encode()
        self._specials = {t: np.uint32(i).tobytes() for t, i in specials.items()}
        # The longest first, as the library prefers them at the same place.
        names = sorted(map(regex.escape, specials), key=len, reverse=True)
        self._special = regex.compile(f"({'|'.join(names)})") if names else None
        self._of_byte = np.array([vocabulary[c] for c in alphabet], np.int64)
        self._size = np.int64(size)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocabulary[a] * size + vocabulary[b] for a, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks, self._made = keys[order], order.astype(np.int64), made
        self._pattern = regex.compile(PATTERN)
        self._doubtful = regex.compile(f"[^\\u0000-\\u{FIRST_DOUBTFUL - 1:04x}]")
        self._splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self._memo = Memo(self._encode_parts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        found, each = split(texts)
        ids = map(b"".join, self._memo.of(found))
        return [b"".join(islice(ids, count)) for count in each]

    def decode(self, ids: bytes) -> str:
        tokens = map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b"".join(tokens).decode("utf-8", "replace")

    def _encode_parts(self, texts: list[str]) -> list[bytes]:
        """Ids of distinct texts: split into words, and each distinct word merged once."""
        everything = "\n".join(texts)
        if any(special in everything for special in self._specials):
            split = [self._words_and_specials(text) for text in texts]
        else:
            split = [self._words(text) for text in texts]
        words = list(set().union(*split) - self._specials.keys())
        ids = dict(zip(words, self._merge([w.encode() for w in words]), strict=True))
        ids.update(self._specials)
        return [b"".join(map(ids.__getitem__, text)) for text in split]

    def _words_and_specials(self, text: str) -> list[str]:
        words = []
        for i, span in enumerate(self._special.split(text)):
            words += [span] if i % 2 else self._words(span)
        return words

    def _words(self, text: str) -> list[str]:
        if text.isascii() or not self._doubtful.search(text):
            return self._pattern.findall(text)
        return [text[a:b] for _, (a, b) in self._splitter.pre_tokenize_str(text)]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of symbols; ``_NONE`` where they do not merge."""
        keys = left * self._size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._ranks[at], _NONE)

    def _merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, by merge rounds over all of them together."""
        if not words:
            return []
        symbols = self._of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank = np.full(len(symbols), _NONE)
        same = np.flatnonzero(word[:-1] == word[1:])
        rank[same] = self._rank(symbols[same], symbols[same + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(starts, append=len(word))
            open_word = best < _NONE
            if not open_word.all():
                # Words that have no pair left are whole.
                leave = np.repeat(~open_word, lengths)
                done.append((word[leave], symbols[leave]))
                word, symbols, rank = word[~leave], symbols[~leave], rank[~leave]
                best, lengths = best[open_word], lengths[open_word]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, lengths))
            # Of pairs that overlap, as in "aaa", the first, third ... are merged.
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            within = np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))
            at = at[within % 2 == 0]
            symbols[at] = self._made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            word, symbols, rank = word[keep], symbols[keep], rank[keep]
            at -= np.arange(len(at))
            changed = np.concatenate([at, at[at > 0] - 1])
            changed = changed[changed + 1 < len(word)]
            rank[at] = _NONE
            inside = word[changed] == word[changed + 1]
            rank[changed[~inside]] = _NONE
            changed = changed[inside]
            rank[changed] = self._rank(symbols[changed], symbols[changed + 1])
        word = np.concatenate([w for w, _ in done])
        symbols = np.concatenate([s for _, s in done])
        order = np.argsort(word, kind="stable")
        flat = symbols[order].astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(word, minlength=len(words))) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


@functools.lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteBPE:
    """The tokenizer of a file, read once per Python worker."""
    return ByteBPE(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """The rows with the token ids of a text column, an array of integers.

    ``path`` is a byte-level BPE file of the ``tokenizers`` library that all executors can
    read. Special tokens in a text get their own id; none are added. A null text counts as
    empty and gives an empty array. Other columns stay as they are; ``ids`` replaces a
    column of that name.
    """
    return _with_codes(df, path, text, {ids: "array<int>"}, lambda ids_, _: [_int_lists(ids_)])


def digests(
    df: DataFrame, path: str, text: str = "text", ids: str | None = None
) -> DataFrame:
    """The rows with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    The digests are of the ids as little-endian unsigned 32-bit integers, and of the text
    that the ids decode to. ``ids`` names a column for the ids, if given.
    """
    added = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    if ids:
        added[ids] = "array<int>"

    def columns(coded: list[bytes], bpe: ByteBPE) -> list:
        made = [
            [len(c) // 4 for c in coded],
            [hashlib.sha256(c).hexdigest() for c in coded],
            [hashlib.sha256(bpe.decode(c).encode()).hexdigest() for c in coded],
        ]
        return made + [_int_lists(coded)] * bool(ids)

    return _with_codes(df, path, text, added, columns)


def decode(df: DataFrame, path: str, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """The rows with the text of a column of ids; null ids give null.

    ``text`` replaces a column of that name.
    """
    kept = [c for c in df.columns if c.lower() != text.lower()]
    carried = df.select(*kept)
    schema = ", ".join([*fields(carried), f"`{text}` string"])

    def make():
        bpe = tokenizer(path)

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            texts = [
                None if row is None else bpe.decode(np.array(row, "<u4").tobytes())
                for row in batch.column(ids).to_pylist()
            ]
            yield {c: batch.column(c) for c in kept} | {text: texts}

        return work

    return map_rows(carried, schema, make)


def _with_codes(df, path, text, added, columns) -> DataFrame:
    """The rows with columns made from the ids of a text column, block by block."""
    kept = [c for c in df.columns if c.lower() not in {a.lower() for a in added}]
    source = free_name(df, "coded_text")
    carried = df.select(*kept, df[text].alias(source))
    schema = ", ".join([*fields(df.select(*kept)), *(f"`{n}` {t}" for n, t in added.items())])

    def make():
        bpe = tokenizer(path)

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            texts = utf8(batch.column(source))
            for start, end in blocks(texts):
                coded = bpe.encode([t.decode() for t in texts[start:end]])
                made = dict(zip(added, columns(coded, bpe), strict=True))
                part = batch.slice(start, end - start)
                yield {c: part.column(c) for c in kept} | made

        return work

    return map_rows(carried, schema, make)



def _int_lists(coded: list[bytes]) -> pa.Array:
    """Ids of each text as an Arrow list, without a Python object per id."""
    ends = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
    flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
