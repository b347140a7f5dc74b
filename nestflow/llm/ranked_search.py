"""Rank documents for queries by an integer score, with exact search in ball trees.

A document's vector holds, for each term of the queries, an integer that grows with how often
the term comes; a query's vector holds the terms' weights. The score is their inner product.
First all documents are counted and written as sparse vectors of the queries' terms, which
also gives the statistics over all documents. Then each task builds ball trees over blocks of
its documents and answers all queries from each tree, best node first, with the best scores
so far as threshold; the tasks' best rows meet in one ranking.

A node keeps the mean of its vectors and, for each band of terms of like weight, the largest
distance of a vector from it. No vector below a node can score more than the mean does plus,
band by band, the query's length times that radius. Rare terms, which decide, are in bands
where few documents of a node hold anything, and have small radii there. Bounds are rounded
up by more than floating point can be off, and leaves are scored in integers, so that
nothing is lost and ties fall by id.

Queries are taken in blocks of bounded size, each of which passes over the documents.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestflow.llm.base import arrow_schema, blocks, map_batches, settled, slices, utf8
from nestflow.llm.decontamination import WORD_BYTES

#: Text of queries that goes to the tasks at one time; documents under one tree, at a leaf.
QUERY_BYTES = 128 << 10
TREE_DOCUMENTS = 4096
LEAF_DOCUMENTS = 32
#: Bands of terms, by weight. More prune more leaves but make a tree dearer: of 10,000 documents of
#: invented words, 200 queries score 87 % of the leaves with 32 bands, 66 % with 512 at the same
#: cost, and 36 % with 2,048 at 1.8 times that.
BANDS = 512


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of other than ASCII characters, A-Z lower-cased."""
    return text.translate(WORD_BYTES).split()


def weight(documents: int, holding: int) -> int:
    """The weight of a term that so many of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def bands_of(weights: np.ndarray, count: int = BANDS) -> np.ndarray:
    """The band of each term: terms of like weights share one, each as many."""
    rank = np.empty(len(weights), np.int64)
    rank[np.argsort(weights, kind="stable")] = np.arange(len(weights))
    return rank * min(count, len(weights)) // max(len(weights), 1)


class BallTree:
    """Sparse integer vectors, ordered by leaf, under nodes with a mean and radii by band."""

    def __init__(self, starts, terms, values, weights, bands, leaf: int = LEAF_DOCUMENTS):
        """``starts`` has each vector's place in ``terms`` and ``values``, and the end."""
        self._weights, self._bands = weights, bands
        self._n_bands = int(bands.max(initial=0)) + 1
        weighted = values * weights[terms].astype(np.float64)
        order, spans = self._split(starts, terms, weighted, len(weights), leaf)
        counts = np.diff(starts)[order]
        self.order = order
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        taken = np.repeat(starts[order] - self.starts[:-1], counts) + np.arange(counts.sum())
        self.terms, self.values = terms[taken], values[taken]
        self.low, self.high, self.children = spans
        self._summarise()

    @staticmethod
    def _split(starts, terms, weighted, width: int, leaf: int):
        """Halve sets of vectors between two far ones until they are small or equal."""
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        squares = np.bincount(owner, weighted**2, len(starts) - 1)

        def distances(rows: np.ndarray, pivot: int) -> np.ndarray:
            a, b = starts[pivot], starts[pivot + 1]
            dense = np.zeros(width)
            dense[terms[a:b]] = weighted[a:b]
            sizes = starts[rows + 1] - starts[rows]
            offsets = np.cumsum(sizes) - sizes
            at = np.repeat(starts[rows] - offsets, sizes) + np.arange(sizes.sum())
            own = np.repeat(np.arange(len(rows)), sizes)
            inner = np.bincount(own, weighted[at] * dense[terms[at]], len(rows))
            return np.maximum(squares[rows] + squares[pivot] - 2 * inner, 0)

        order: list[np.ndarray] = []
        low, high, children = [], [], []
        done = 0
        # Depth first, so that the vectors below any node lie together.
        todo = [(np.arange(len(starts) - 1), -1)]
        while todo:
            rows, parent = todo.pop()
            node = len(low)
            low.append(done)
            high.append(done + len(rows))
            children.append([])
            if parent >= 0:
                children[parent].append(node)
            halves = None
            if len(rows) > leaf:
                first = rows[int(distances(rows, int(rows[0])).argmax())]
                near = distances(rows, int(first))
                second = rows[int(near.argmax())]
                if near.max() > 0:
                    left = near <= distances(rows, int(second))
                    if not 0.02 < left.mean() < 0.98:
                        # A far one alone: halve by distance instead, so that trees stay low.
                        left = np.zeros(len(rows), bool)
                        left[np.argsort(near, kind="stable")[: len(rows) // 2]] = True
                    halves = rows[left], rows[~left]
            if halves is None:
                order.append(rows)
                done += len(rows)
            else:
                todo += [(halves[1], node), (halves[0], node)]
        placed = np.concatenate(order) if order else np.zeros(0, np.int64)
        return placed, (np.array(low), np.array(high), children)

    def _summarise(self) -> None:
        vectors = len(self.starts) - 1
        owner = np.repeat(np.arange(vectors), np.diff(self.starts))
        width, bands = len(self._weights), self._n_bands
        self.mean = np.zeros((len(self.low), width), np.float64)
        self.radius = np.zeros((len(self.low), bands), np.float64)
        band = self._bands[self.terms]
        value = self.values.astype(np.float64)
        squares = np.bincount(owner * bands + band, value**2, vectors * bands)
        squares = squares.reshape(vectors, bands)
        for node, (low, high) in enumerate(zip(self.low.tolist(), self.high.tolist(), strict=True)):
            a, b = self.starts[low], self.starts[high]
            mean = np.bincount(self.terms[a:b], value[a:b], width) / max(high - low, 1)
            self.mean[node] = mean
            held = np.bincount(self._bands, mean**2, bands)
            inner = np.bincount(
                (owner[a:b] - low) * bands + band[a:b], value[a:b] * mean[self.terms[a:b]],
                (high - low) * bands,
            ).reshape(-1, bands)
            far = squares[low:high] - 2 * inner + held
            # What the sums above can be off by, and much more.
            far = np.maximum(far, 0) + 1e-9 * (squares[low:high] + held)
            self.radius[node] = np.sqrt(far.max(axis=0, initial=0))

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each node, a number that no score below it is above."""
        lengths = np.sqrt(np.bincount(self._bands[terms], weights.astype(float) ** 2, self._n_bands))
        made = self.mean[:, terms] @ weights.astype(np.float64) + self.radius @ lengths
        return made * (1 + 1e-9) + 1

    def scores(self, low: int, high: int, weights: np.ndarray) -> np.ndarray:
        """Scores of the vectors at these places; ``weights`` has one for every term."""
        a, b = self.starts[low], self.starts[high]
        sums = np.zeros(b - a + 1, np.int64)
        np.cumsum(self.values[a:b] * weights[self.terms[a:b]], out=sums[1:])
        return sums[self.starts[low + 1 : high + 1] - a] - sums[self.starts[low:high] - a]

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best, ids: list) -> int:
        """Put into ``best`` what belongs there; returns how many leaves were scored."""
        dense = np.zeros(len(self._weights), np.int64)
        dense[terms] = weights
        bounds = self.bounds(terms, weights).tolist()
        heap, scored = [(-bounds[0], 0)] if bounds else [], 0
        while heap and -heap[0][0] >= best.least():
            _, node = heapq.heappop(heap)
            for child in self.children[node]:
                if bounds[child] >= best.least():
                    heapq.heappush(heap, (-bounds[child], child))
            if not self.children[node]:
                low, high = int(self.low[node]), int(self.high[node])
                found = self.scores(low, high, dense)
                for i in np.flatnonzero(found >= best.least()).tolist():
                    best.add(int(found[i]), ids[self.order[low + i]])
                scored += 1
        return scored


class Best:
    """The ``k`` highest scores above zero, those of smaller ids first among equal ones."""

    def __init__(self, k: int):
        self._k, self.rows = k, []

    def least(self) -> int:
        """No score below this belongs here."""
        return self.rows[0][0] if len(self.rows) == self._k else 1

    def add(self, score: int, doc_id: int | None) -> None:
        # A null id comes last.
        row = (score, doc_id is not None, -(doc_id or 0))
        if score < 1:
            return
        if len(self.rows) < self._k:
            heapq.heappush(self.rows, row)
        elif row > self.rows[0]:
            heapq.heapreplace(self.rows, row)

    def found(self) -> list[tuple[int, int | None]]:
        return [(score, -negative if known else None) for score, known, negative in self.rows]


def _vectors(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """Documents with a term at least: their number of terms, and those known with counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, texts = batch.column("doc_id"), utf8(batch.column("text"))
            for start, end in blocks(texts):
                split = [terms_of(t) for t in texts[start:end]]
                sizes = np.array([len(own) for own in split], np.int64)
                at = np.fromiter(
                    (known.get(w, -1) for own in split for w in own), np.int64, sizes.sum()
                )
                owner = np.repeat(np.arange(len(split)), sizes)[at >= 0]
                pairs, counts = np.unique(
                    owner * max(len(known), 1) + at[at >= 0], return_counts=True
                )
                owner, term = np.divmod(pairs, max(len(known), 1))
                offsets = np.searchsorted(owner, np.arange(len(split) + 1)).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int32)))
                    for values in (term, counts)
                ]
                made = pa.RecordBatch.from_arrays(
                    [ids.slice(start, end - start), pa.array(sizes), *lists],
                    names=["doc_id", "n_terms", "terms", "counts"],
                )
                yield made.filter(pa.array(sizes > 0))

    schema = "doc_id bigint, n_terms bigint, terms array<int>, counts array<int>"
    return settled(map_batches(docs, count, schema), "term-vectors")


def _holding(vectors: DataFrame, size: int) -> list[int]:
    """In how many documents each term is: summed in tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            flat = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
            held += np.bincount(flat, minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(held[some])], names=["term", "held"]
        )

    summed = map_batches(vectors.select("terms"), count, "term int, held bigint")
    held = [0] * size
    # As many rows as a block of queries has terms.
    for row in summed.groupBy("term").agg(F.sum("held").alias("held")).collect():
        held[row["term"]] = row["held"]
    return held


def _loads(sizes: list[int], documents: int, terms: int) -> np.ndarray:
    """The length factor of documents, by their numbers of terms; in whole numbers of any size."""
    return np.array([10 + 90 * n * documents // terms for n in sizes], np.int64)


def _answers(
    vectors: DataFrame, queries: list[np.ndarray], weights: np.ndarray, documents: int,
    terms: int, k: int,
) -> DataFrame:
    """The best rows of each task for each query, by its place in ``queries``."""
    schema = "query int, doc_id bigint, score bigint"
    arrow = arrow_schema(vectors.sparkSession, schema)
    bands = bands_of(weights)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for batch in slices(batches, TREE_DOCUMENTS):
            ids = batch.column("doc_id").to_pylist()
            loads = _loads(batch.column("n_terms").to_pylist(), documents, terms)
            listed = batch.column("terms")
            sizes = np.diff(listed.offsets.to_numpy())
            starts = np.concatenate([[0], np.cumsum(sizes)])
            at = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            often = batch.column("counts").flatten().to_numpy(zero_copy_only=False)
            often = often.astype(np.int64)
            values = 1_000_000_000 * often // (1000 * often + 8 * np.repeat(loads, sizes))
            tree = BallTree(starts, at, values, weights, bands)
            for own, found in zip(queries, best, strict=True):
                if len(own):
                    tree.search(own, weights[own], found, ids)
        rows = [(q, i, s) for q, found in enumerate(best) for s, i in found.found()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in rows], f.type) for n, f in enumerate(arrow)], schema=arrow
        )

    return map_batches(vectors, answer, schema)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    item_text: str = "text",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """For each item row its ``k`` documents of the highest score above 0, best first.

    Columns: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``. Terms are runs of ASCII
    letters, digits and other than ASCII characters, A-Z in lower case. The score sums, over
    the distinct terms of the item, weight * (10^9 f div (1000 f + 8 m)), with f the term's
    occurrences in the document, m = 10 + 90 n N div L for a document of n terms, and the
    weight floor(1000 ln((2 N + 2) / (2 d + 1))) for a term that d of the N documents with terms
    hold; L is all their terms. Equal scores go by ascending id, a null id last.

    Whole texts count; null and empty ones have no terms, give no rows and are in no statistic.
    Repeated document rows and ids are documents each, repeated item rows and ids get rows each.
    Items without terms, or whose terms no document holds, give no rows, nor does an empty
    table. Other columns are left out.
    """
    spark = docs.sparkSession
    docs = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    item_type = items.schema[item_id].dataType
    items = items.select(
        items[item_id].alias("item_id"), F.coalesce(items[item_text], F.lit("")).alias("text")
    )
    items = items.withColumn("key", F.xxhash64("item_id", "text"))
    items = settled(items.withColumn("spread", F.monotonically_increasing_id()), "items")
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n_blocks = -(-total // query_bytes)
    cell = F.pmod(F.xxhash64("key", "spread"), F.lit(max(n_blocks, 1)))
    answers = []
    for block in range(n_blocks):
        # About ``query_bytes`` of items, as many blocks as that takes.
        own = items if n_blocks == 1 else items.filter(cell == block)
        answers.append(_ranked_block(docs, own.select("item_id", "text").collect(), item_type, k))
    if not answers:
        kind = item_type.simpleString()
        none = f"item_id {kind}, rank int, doc_id bigint, score bigint"
        return spark.createDataFrame([], none)
    made = answers[0]
    for other in answers[1:]:
        made = made.unionAll(other)
    return made


def _ranked_block(docs: DataFrame, rows: list, item_type, k: int) -> DataFrame:
    spark = docs.sparkSession
    known: dict[bytes, int] = {}
    queries = []
    for row in rows:
        own = dict.fromkeys(terms_of(row["text"].encode()))
        queries.append(np.array([known.setdefault(t, len(known)) for t in own], np.int64))
    vectors = _vectors(docs, known)
    documents, terms = vectors.agg(F.count(F.lit(1)), F.sum("n_terms")).first()
    held = _holding(vectors, len(known))
    weights = np.array([weight(documents, d) for d in held], np.int64)
    some = vectors.filter(F.size("terms") > 0)
    found = _answers(some, queries, weights, documents, terms or 1, k)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = [(n, row["item_id"]) for n, row in enumerate(rows)]
    names = spark.createDataFrame(names, f"query int, item_id {item_type.simpleString()}")
    found = found.join(F.broadcast(names), "query")
    return found.select("item_id", F.col("rank").cast("int"), "doc_id", "score")
