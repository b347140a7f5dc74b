"""Likelihood of documents under a subword model that sums over all segmentations.

The pieces and their scores come from an existing SentencePiece vocabulary. A word, with the
mark of a word's begin before it, is a lattice: an edge for each piece that stands in it, and
one for each character spelt in byte pieces, so that every text has a segmentation. A forward
recursion in log space sums over all paths; as words begin with the mark, a document's
probability is the product over its words, and that of the end.

The scores start from the vocabulary's own ranks and are fitted to the distinct words of the
training documents by expectation maximisation, with the vocabulary's scores as prior counts.
A word of the training documents has an edge more, over the whole word: its share of their
tokens, less a discount that all other paths together get (absolute discounting). Without it
a word that is frequent but no piece of the vocabulary would be as unlikely as its spelling.

A document's words are numbered within its chunk, some MB of documents that one task has
read. Only distinct words of chunks and their scores are shuffled, not the texts' words.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.base import arrow_schema, map_batches, map_rows, settled, slices, utf8
from nestflow.llm.hashing import spans

#: Fixed value: the mark of a word's begin in the vocabulary.
MARK = "▁"
END = b""

#: Text of the documents whose words are numbered together.
CHUNK_BYTES = 16 << 20
#: Code points whose lattices are made together.
BATCH_POINTS = 1 << 18
#: Weight of the vocabulary's own scores, as a number of pieces.
PRIOR = 1000.0
ROUNDS = 2

_SIEVE = np.uint64((1 << 22) - 1)


class Vocabulary:
    """Pieces of a SentencePiece file by the hash of their code points."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names, scores = [], []
        byte_ids = [0] * 256
        self.weights = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = len(scores)
                names.append("")
                scores.append(-math.inf)
            elif not (model.is_control(i) or model.is_unknown(i) or MARK in piece[1:]):
                names.append(piece)
                scores.append(model.get_score(i))
        self.end = len(names)
        self.size = len(names) + 1
        self.of_byte = np.array(byte_ids)
        # Scores of a BPE vocabulary are ranks: a piece's share falls with its rank. Bytes
        # and the end come after the last.
        rank = np.argsort(np.argsort(-np.array([*scores, -math.inf]), kind="stable"))
        share = 1.0 / (1.0 + rank)
        self.prior = share / share.sum()
        real = [i for i, name in enumerate(names) if name]
        points, starts, ends = _flat([names[i] for i in real])
        hashes = spans(points, starts, ends)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(real)[order]
        self.longest = int((ends - starts).max())
        self.sieve = np.zeros(int(_SIEVE) + 1, bool)
        self.sieve[self.hashes & _SIEVE] = True

    def edges(self, points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length, the starts of the pieces of that length, and their ids."""
        found = []
        for size in range(1, min(self.longest, len(points)) + 1):
            start = np.arange(len(points) - size + 1)
            hashes = spans(points, start, start + size)
            start = np.flatnonzero(self.sieve[hashes & _SIEVE])
            hashes = hashes[start]
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            same = self.hashes[at] == hashes
            found.append((start[same], self.ids[at[same]]))
        return found

    def spelt(self, points: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """Log probability of each code point, spelt in bytes."""
        distinct, of = np.unique(points, return_inverse=True)
        by_byte = log_p[self.of_byte]
        sums = [by_byte[np.frombuffer(chr(c).encode(), np.uint8)].sum() for c in distinct]
        return np.array(sums)[of]

    def bytes_of(self, points: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Weights of pieces, from the weights of code points that are spelt in bytes."""
        counts = np.zeros(self.size)
        distinct, of = np.unique(points, return_inverse=True)
        for c, w in zip(distinct, np.bincount(of, weight), strict=True):
            np.add.at(counts, self.of_byte[np.frombuffer(chr(c).encode(), np.uint8)], w)
        return counts


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once per Python worker."""
    return Vocabulary(path)


def _flat(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words in a row, and where each word starts and ends."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(w) for w in words])
    return points, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends


class Lattice:
    """The lattices of some words under the log probabilities of the pieces.

    Node ``i + word`` stands before code point ``i`` of the flat words, and each word has a
    node more, its end.
    """

    def __init__(self, words: list[bytes], own: Vocabulary, log_p: np.ndarray):
        self.own, self.log_p = own, log_p
        self.points, starts, ends = _flat([MARK + w.decode() for w in words])
        lengths = ends - starts
        word = np.repeat(np.arange(len(words)), lengths)
        self.first = starts + np.arange(len(words))
        self.last = ends + np.arange(len(words))
        self.nodes = len(self.points) + len(words)
        place = np.arange(len(self.points)) - starts[word]
        # Edges by the place in the word where they end; no piece holds the mark inside, so
        # that none runs into the next word.
        tail, head, self.piece, weight = [], [], [], []
        for size, (start, piece) in enumerate(own.edges(self.points), 1):
            tail.append(start)
            head.append(np.full(len(start), size))
            self.piece.append(piece)
            weight.append(log_p[piece])
        every = np.arange(len(self.points))
        tail.append(every)
        head.append(np.ones(len(every), np.int64))
        self.piece.append(np.full(len(every), -1))
        weight.append(own.spelt(self.points, log_p))
        tail, size = np.concatenate(tail), np.concatenate(head)
        self.point = tail
        self.piece, self.weight = np.concatenate(self.piece), np.concatenate(weight)
        self.tail = tail + word[tail]
        self.head = self.tail + size
        self.begin, self.stop = place[tail], place[tail] + size
        self.steps = int(lengths.max()) if len(words) else 0

    def _sums(self, at, frm, to, seeds) -> np.ndarray:
        """Log sums over all paths from the seeds, edge by edge in the order of ``at``."""
        total = np.full(self.nodes, -np.inf)
        total[seeds] = 0.0
        order = np.lexsort((to, at))
        frm, to, weight, at = frm[order], to[order], self.weight[order], at[order]
        bounds = np.searchsorted(at, np.arange(self.steps + 2))
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if low == high:
                continue
            values = total[frm[low:high]] + weight[low:high]
            target = to[low:high]
            new = np.flatnonzero(np.diff(target, prepend=-1))
            most = np.maximum.reduceat(values, new)
            spread = np.repeat(most, np.diff(new, append=len(target)))
            sums = np.add.reduceat(np.exp(values - spread), new)
            total[target[new]] = most + np.log(sums)
        return total

    def scores(self) -> np.ndarray:
        """Natural log of each word's probability."""
        return self._sums(self.stop, self.tail, self.head, self.first)[self.last]

    def expected(self) -> np.ndarray:
        """How often each piece is used, over all paths, in the words."""
        forward = self._sums(self.stop, self.tail, self.head, self.first)
        backward = self._sums(self.steps - self.begin, self.head, self.tail, self.last)
        lengths = self.last - self.first + 1
        whole = np.repeat(forward[self.last], lengths)
        used = forward[self.tail] + self.weight + backward[self.head] - whole[self.tail]
        used = np.exp(used)
        spelt = self.piece < 0
        counts = np.bincount(self.piece[~spelt], used[~spelt], self.own.size)
        return counts + self.own.bytes_of(self.points[self.point[spelt]], used[spelt])


def _lattices(words: list[bytes], own: Vocabulary, log_p: np.ndarray):
    """Lattices of words of like length, with the places of the words."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    part, points = [], 0
    for i in order:
        size = len(words[i]) + 1
        if part and points + size > BATCH_POINTS:
            yield part, Lattice([words[j] for j in part], own, log_p)
            part, points = [], 0
        part.append(i)
        points += size
    if part:
        yield part, Lattice([words[j] for j in part], own, log_p)


def word_scores(words: list[bytes], own: Vocabulary, log_p: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each word, and of the end."""
    scores = np.empty(len(words))
    scores[[i for i, w in enumerate(words) if w == END]] = log_p[own.end]
    real = [i for i, w in enumerate(words) if w != END]
    for part, lattice in _lattices([words[i] for i in real], own, log_p):
        scores[[real[j] for j in part]] = lattice.scores()
    return scores


# The corpus


def _chunks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row per document, its numbered words, and a row per distinct word of a chunk."""
    doc_id_type = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"chunk bigint, doc_id {doc_id_type}, held_out boolean, numbers binary, "
        "word binary, number int, times bigint"
    )
    arrow = arrow_schema(docs.sparkSession, schema)

    def batch_of(chunk: int, columns: dict) -> pa.RecordBatch:
        """Rows of a chunk; columns that are not given are null."""
        count = len(next(iter(columns.values())))
        arrays = [
            pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type)
            for f in arrow
        ]
        arrays[0] = pa.array([chunk] * count, pa.int64())
        return pa.RecordBatch.from_arrays(arrays, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        packer = zstandard.ZstdCompressor(level=1)
        for n, (ids, held_out, numbers, words, times) in enumerate(_numbered(batches)):
            for low in range(0, len(numbers), 10_000):
                part = slice(low, low + 10_000)
                packed = [packer.compress(x.tobytes()) for x in numbers[part]]
                columns = {"doc_id": ids[part], "held_out": held_out[part], "numbers": packed}
                yield batch_of(task + n, columns)
            for low in range(0, len(words), 50_000):
                part = words[low : low + 50_000]
                number = range(low, low + len(part))
                columns = {"word": part, "number": number, "times": times[low : low + len(part)]}
                yield batch_of(task + n, columns)

    carried = docs.select(docs[doc_id].alias("doc_id"), "held_out", docs[text].alias("text"))
    return map_batches(carried, run, schema)


def _numbered(batches: Iterator[pa.RecordBatch]):
    """Documents of a chunk with their words' numbers, and the chunk's words."""
    number: dict[bytes, int] = {}
    ids, held_out, numbers, size = [], [], [], 0

    def chunk():
        lengths = [0 if h else x.shape[1] for h, x in zip(held_out, numbers, strict=True)]
        times = np.zeros(len(number), np.int64)
        if sum(lengths):
            train = [x for h, x in zip(held_out, numbers, strict=True) if not h]
            seen = np.concatenate(train, axis=1)
            times += np.bincount(seen[0], seen[1], len(number)).astype(np.int64)
        # Sorted numbers, as differences, hold little.
        coded = [np.stack([np.diff(x[0], prepend=0), x[1]]).astype("<u4") for x in numbers]
        return ids, held_out, coded, list(number), times

    for batch in slices(batches):
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "held_out")]
        for doc_id, held, content in zip(*columns, utf8(batch.column("text")), strict=True):
            words = Counter(content.lower().split())
            words[END] = 1
            for word in words:
                if word not in number:
                    number[word] = len(number)
            own = np.array([list(map(number.__getitem__, words)), list(words.values())], np.int64)
            ids.append(doc_id)
            held_out.append(held)
            numbers.append(own[:, np.argsort(own[0])].astype(np.uint32))
            size += len(content)
            if size >= CHUNK_BYTES:
                yield chunk()
                number = {}
                ids, held_out, numbers, size = [], [], [], 0
    if ids:
        yield chunk()


def fit(words: DataFrame, path: str, rounds: int = ROUNDS, prior: float = PRIOR) -> np.ndarray:
    """Log probabilities of the pieces, fitted to the words with ``times`` in training.

    Each distinct word counts once: the pieces are for words that are rare or new. A round
    sums expected uses by task, then by piece: a vector as long as the vocabulary comes to the
    driver.
    """
    own = vocabulary(path)
    log_p = np.log(own.prior)
    seen = words.filter("times > 0").select("word")
    for _ in range(rounds):
        current = log_p

        def uses(batches: Iterator[pa.RecordBatch], log_p=current) -> Iterator[pa.RecordBatch]:
            own = vocabulary(path)
            total = np.zeros(own.size)
            for batch in batches:
                some = batch.column("word").to_pylist()
                real = [w for w in some if w != END]
                total[own.end] += len(some) - len(real)
                for _, lattice in _lattices(real, own, log_p):
                    total += lattice.expected()
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(total[used])], ["piece", "uses"]
            )

        by_task = map_batches(seen, uses, "piece bigint, uses double")
        summed = by_task.groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()
        counts = prior * own.prior
        counts[summed["piece"].to_numpy(np.int64)] += summed["uses"].to_numpy()
        log_p = np.log(counts / counts.sum())
    return log_p


def score_documents(
    docs: DataFrame,
    path: str,
    held_out: F.Column,
    rounds: int = ROUNDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Scores of every document, learnt from those where ``held_out`` is false.

    ``path`` is a SentencePiece file with byte pieces that all executors can read. Words are
    split at ASCII white space, with A-Z in lower case; a document's tokens are its words and
    one end. Columns: ``doc_id``, ``held_out`` (null counts as false), ``n_tokens``,
    ``n_known`` (tokens that training documents have), ``train_tokens`` (all tokens of
    training documents), ``base_score`` (log10 of the add-one unigram probability of the
    words), ``score`` (log10 of the probability under the subword model, in which a word of the
    training documents has an edge of its own beside its pieces) and ``lattice_score`` (the same
    by pieces alone: the marginal over all segmentations into them). A null or empty text has
    no words. Repeated rows and ids are documents of their own.
    """
    marked = docs.select(
        docs[doc_id].alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        docs[text].alias("text"),
    )
    chunks = settled(_chunks(marked, "doc_id", "text"), "numbered-words")
    in_chunks = chunks.filter("word IS NOT NULL").select("chunk", "word", "number", "times")
    words = in_chunks.groupBy("word").agg(F.sum("times").alias("times"))
    words = settled(words, "words")
    counts = words.agg(
        F.coalesce(F.sum("times"), F.lit(0)).alias("tokens"),
        F.count_if(F.col("times") > 0).alias("distinct"),
        F.count_if(F.col("times") == 1).alias("once"),
        F.count_if(F.col("times") == 2).alias("twice"),
    ).first()
    tokens = counts["tokens"]
    log_p = fit(words, path, rounds)
    unknown = -math.log10(tokens + counts["distinct"] + 1)
    scored = settled(_scored(words, path, log_p, counts.asDict()), "scored-words")
    # The words grow with the documents: they are never broadcast.
    numbers = in_chunks.drop("times").join(scored.hint("merge"), "word").drop("word")
    numbers = numbers.withColumnRenamed("chunk", "in_chunk")
    rows = chunks.filter("word IS NULL").select("chunk", "doc_id", "held_out", "numbers")
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, "
        "base_score double, score double, lattice_score double"
    )
    arrow = arrow_schema(docs.sparkSession, schema)

    def add_up(own: pa.Table, words: pa.Table) -> pa.Table:
        place = words.column("number").to_numpy()
        values = np.zeros((4, len(place)))
        for i, name in enumerate(("base", "score", "lattice"), 1):
            values[i, place] = words.column(name).to_numpy()
        # A word that training has is twice as likely as one that it lacks, at least.
        values[0, place] = values[1, place] > unknown + 0.1
        unpack = zstandard.ZstdDecompressor().decompress
        sums = np.empty((5, own.num_rows))
        for i, packed in enumerate(own.column("numbers").to_pylist()):
            number, times = np.frombuffer(unpack(packed), "<u4").reshape(2, -1)
            sums[1:, i] = values[:, np.cumsum(number, dtype=np.int64)] @ times
            sums[0, i] = times.sum()
        return pa.table(
            [
                own.column("doc_id").cast(arrow.field("doc_id").type),
                own.column("held_out"),
                pa.array(sums[0].astype(np.int64)),
                pa.array(sums[1].astype(np.int64)),
                *map(pa.array, sums[2:]),
            ],
            schema=arrow,
        )

    both = rows.groupBy("chunk").cogroup(numbers.groupBy("in_chunk"))
    summed = both.applyInArrow(add_up, schema)
    return summed.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        "lattice_score",
    )


def _scored(words: DataFrame, path: str, log_p: np.ndarray, counts: dict) -> DataFrame:
    """The words with their log10 terms ``base``, ``score`` and ``lattice``."""
    tokens, distinct = counts["tokens"], counts["distinct"]
    once, twice = counts["once"], counts["twice"]
    # What each word of the training documents gives up for the paths through pieces.
    discount = once / (once + 2 * twice) if once else 0.5

    def make():
        own = vocabulary(path)

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            times = batch.column("times").to_numpy().astype(float)
            spelt = scores = word_scores(batch.column("word").to_pylist(), own, log_p)
            if tokens:
                whole = np.maximum(times - discount, 0) / tokens
                with np.errstate(divide="ignore"):
                    whole = np.log(whole)
                scores = np.logaddexp(whole, spelt + math.log(discount * distinct / tokens))
            yield {
                "word": batch.column("word"),
                "base": np.log10((times + 1) / (tokens + distinct + 1)),
                "score": scores / math.log(10),
                "lattice": spelt / math.log(10),
            }

        return work

    schema = "word binary, base double, score double, lattice double"
    return map_rows(words, schema, make)
