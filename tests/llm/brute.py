"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import public_tokenizers
import sentencepiece
import xxhash
from tokenizers import Tokenizer

LOWER = {c: c + 32 for c in range(65, 91)}
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ids(text: str | None) -> list[int]:
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def ids_digest(tokens: list[int]) -> str:
    return hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in tokens)).hexdigest()


def fingerprint(text: str | None, shingle: int = 3) -> int:
    w = words(text)
    if not w:
        return 0
    spans = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(codes: list[int], distance: int = 3) -> dict[int, int]:
    """Each distinct code with the smallest one of its component."""
    codes = sorted(set(codes))
    parent = {c: c for c in codes}

    def root(c: int) -> int:
        while parent[c] != c:
            c = parent[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {c: root(c) for c in codes}


def line_key(line: str) -> str:
    return line.strip(" \t\n\r\x0b\x0c").translate(LOWER)


def dedup_lines(docs: list[tuple], least: int = 5, shortest: int = 40) -> list[str]:
    """The texts that are left of documents (id, text)."""
    owners: dict[str, set] = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            owners.setdefault(line_key(line), set()).add(doc_id)
    left = []
    for doc_id, text in docs:
        kept = []
        for line in (text or "").split("\n"):
            held = owners[line_key(line)]
            keeper = max((i for i in held if i is not None), default=None)
            shared = len(line_key(line)) >= shortest and len(held) >= least
            if not shared or doc_id == keeper:
                kept.append(line)
        left.append("\n".join(kept))
    return left


def item_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text: str | None, items: list[tuple], span: int = 10) -> tuple:
    """Words, words that are hit, and ids of the items that hit them."""
    own, hit, named = item_words(text), set(), set()
    for item_id, item in items:
        w = item_words(item)
        size = min(span, len(w))
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                named.add("null" if item_id is None else str(item_id))
    return len(own), len(hit), sorted(named)


def measures(text: str | None) -> dict:
    content = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", content)
    lines = [x for x in content.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows: dict[tuple, list[int]] = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i : i + 5]), []).append(i)
    again = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(5)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", content)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(again),
    }


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def piece_ids(path: str) -> dict[str, int]:
    """Places of a SentencePiece file's pieces in the lattice's vocabulary."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, n = {}, 0
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            n += 1
        elif not (model.is_control(i) or model.is_unknown(i) or "\u2581" in piece[1:]):
            ids[piece] = n
            n += 1
    return ids


def marginal(word: str, ids: dict[str, int], of_byte, log_p) -> float:
    """Log of the sum over all segmentations of a word, its first character's mark before it."""
    text = "\u2581" + word
    p = [1.0] + [0.0] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            if text[start:end] in ids:
                p[end] += p[start] * math.exp(log_p[ids[text[start:end]]])
        spelt = sum(log_p[of_byte[b]] for b in text[end - 1].encode())
        p[end] += p[end - 1] * math.exp(spelt)
    return math.log(p[-1])
