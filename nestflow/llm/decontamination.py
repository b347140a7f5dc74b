"""Find passages of benchmark items in documents, by winnowed fingerprints.

Of every ``window`` k-grams of words in a row the one of the smallest hash is kept. A span
of ``k + window - 1`` words that a document shares with an item holds one such row, so that
both keep a fingerprint of it: no shared span of that length is missed. Documents and items
are joined by their fingerprints, each hit is checked word for word and extended on both
sides, and what is shorter than the span asked for is dropped. Items that are shorter
themselves are looked for as a whole.

A Bloom filter of the items' fingerprints, of fixed size, lets the documents' tasks leave
out nearly all fingerprints before the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.base import blocks, fields, map_rows, settled, text_key, utf8
from nestflow.llm.hashing import grams, spans, word_spans

#: Bits of the filter of the items' fingerprints: 4 MB, whatever the benchmark's size.
FILTER_BITS = 25

#: ASCII letters in lower case and digits; other ASCII separates words; bytes of other
#: characters are parts of words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

_HIT = (
    "struct<gram:bigint,whole:boolean,start:int,size:int,middle:string,"
    "before:array<string>,after:array<string>>"
)


class Winnower:
    """Fingerprints of the words of many texts at a time."""

    def __init__(self, span: int, k: int, short: tuple[int, ...] = ()):
        if not 1 <= k <= span:
            raise ValueError("a k-gram must not be longer than the span")
        self.span, self.k, self.short = span, k, short

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
        """Starts and ends of all words, the first word of each text, and the buffer."""
        buffer = b" ".join(texts).translate(WORD_BYTES)
        starts, ends = word_spans(np.frombuffer(buffer, np.uint8))
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return starts, ends, np.searchsorted(starts, offsets), buffer

    def kept(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple]:
        """Hashes, places and size of the grams kept, and whether they stand for whole items."""
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        window = self.span - self.k + 1
        made = grams(hashes, self.k)
        rows = len(hashes) - self.span + 1
        if rows > 0:
            # The smallest of each row of grams; of equal ones the last.
            best, at = made[:rows].copy(), np.arange(rows)
            for i in range(1, window):
                other = made[i : i + rows]
                smaller = other <= best
                best[smaller] = other[smaller]
                at[smaller] = np.flatnonzero(smaller) + i
            at = at[text[:rows] == text[self.span - 1 :]]
            at = at[np.diff(at, prepend=-1) != 0]
            yield made[at], at, self.k, False
        for size in self.short:
            rows = len(hashes) - size + 1
            if rows > 0:
                at = np.flatnonzero(text[:rows] == text[size - 1 :])
                yield grams(hashes, size)[at], at, size, True


def _hits(winnower: Winnower, texts: list[bytes], known) -> tuple[list[int], list[list[dict]]]:
    """Word counts, and kept grams that ``known`` holds with the words around them."""
    starts, ends, first, buffer = winnower.words(texts)
    hashes = spans(np.frombuffer(buffer, np.uint8), starts, ends)
    found: list[list[dict]] = [[] for _ in texts]
    reach = winnower.span - winnower.k

    def word(i: int) -> str:
        return buffer[starts[i] : ends[i]].decode()

    for made, at, size, whole in winnower.kept(hashes, first):
        if known is not None:
            passed = known(made)
            made, at = made[passed], at[passed]
        owner = np.searchsorted(first, at, "right") - 1
        around = 0 if whole else reach
        signed = made.view(np.int64).tolist()
        for gram, i, text in zip(signed, at.tolist(), owner.tolist(), strict=True):
            low, high = int(first[text]), int(first[text + 1])
            found[text].append(
                {
                    "gram": gram,
                    "whole": whole,
                    "start": i - low,
                    "size": size,
                    "middle": " ".join(map(word, range(i, i + size))),
                    # From the gram outwards, as far as a span around it can reach.
                    "before": [word(j) for j in range(i - 1, max(low, i - around) - 1, -1)],
                    "after": [word(j) for j in range(i + size, min(high, i + size + around))],
                }
            )
    return np.diff(first).tolist(), found


def _probes(gram, bits: int):
    mask = (1 << bits) - 1
    return gram & mask, (gram >> 32) & mask


def contamination(
    docs: DataFrame,
    items: DataFrame,
    span: int = 10,
    k: int = 5,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    item_text: str = "text",
) -> DataFrame:
    """For each document row: its words, those in passages of items, and the items.

    Columns: ``doc_id``, ``text_key`` (see ``base.text_key``), ``n_words``, ``n_hit`` (words
    inside an occurrence of ``span`` consecutive words of an item, or of a whole item of
    fewer words), ``n_items`` (items that such occurrences are of, by distinct id),
    ``items_sha256`` (hex digest of their ids, sorted as strings, joined by commas) and
    ``contaminated``. A repeated row comes once for each time. Null and empty texts have no
    words; an item without words matches nothing; a null id counts as the text "null".
    """
    bits = FILTER_BITS
    items = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
        F.col(item_text).alias("item_words"),
    )
    counted = _scan(items, "item_words", span, k, (), None, True)
    # Sizes below the span: at most span - 1 of them.
    lengths = counted.filter(F.col("n_words").between(1, span - 1))
    short = tuple(sorted(r[0] for r in lengths.select("n_words").distinct().collect()))
    prints = settled(
        _scan(items, "item_words", span, k, short, None, False)
        .select("item", "n_words", F.explode("hits").alias("hit"))
        # A short item is looked for as a whole; its parts are no windows.
        .filter(
            F.when(F.col("hit.whole"), F.col("hit.size") == F.col("n_words")).otherwise(
                F.col("n_words") >= span
            )
        )
        .select("item", "hit.*"),
        "item-prints",
    )
    row = "contamination_row"
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("doc_words"))
    scanned = _scan(docs, "doc_words", span, k, short, _filter(prints, bits), False)
    found = settled(scanned.withColumn(row, F.monotonically_increasing_id()), "document-prints")
    # Items that share a passage are met as one.
    around = ["gram", "whole", "size", "middle", "before", "after"]
    contexts = prints.select(*around).distinct().withColumn("context", F.xxhash64(*around))
    contexts = settled(contexts, "item-passages")
    of_items = prints.select("item", F.xxhash64(*around).alias("context")).distinct()
    of_items = settled(of_items, "items-of-passages")
    hits = found.select(row, F.explode("hits").alias("hit")).select(row, "hit.*")
    other = contexts.select(
        "gram", "whole", "size", "middle", "context",
        F.col("before").alias("item_before"), F.col("after").alias("item_after"),
    )
    left = _same(F.col("before"), F.col("item_before"))
    right = _same(F.col("after"), F.col("item_after"))
    met = (
        hits.join(other, ["gram", "whole", "size", "middle"])
        .select(row, "context", "whole", "start", "size", left.alias("left"), right.alias("right"))
        .filter(F.col("whole") | (F.col("left") + F.col("right") + k >= span))
        .select(
            row,
            "context",
            (F.col("start") - F.col("left")).alias("low"),
            (F.col("start") + F.col("size") + F.col("right")).alias("high"),
        )
    )
    met = settled(met, "contamination-spans")
    spans_ = F.sort_array(F.collect_set(F.struct("low", "high")))
    covered = met.groupBy(row).agg(spans_.alias("spans"))
    covered = covered.select(row, _covered("spans").alias("n_hit"))
    named = met.select(row, "context").distinct().join(of_items, "context")
    named = named.select(row, "item").distinct().groupBy(row)
    named = named.agg(F.sort_array(F.collect_list("item")).alias("items"))
    result = found.drop("hits").join(covered, row, "left").join(named, row, "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("bigint"))
    none = F.array().cast("array<string>")
    joined = F.concat_ws(",", F.coalesce(F.col("items"), none))
    return result.select(
        "doc_id",
        "text_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(F.coalesce(F.col("items"), none)).cast("bigint").alias("n_items"),
        F.sha2(joined.cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without any passage of an item, with all their columns."""
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    found = contamination(docs, items, **options).filter("contaminated")
    bad = found.select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key"))
    bad = settled(bad.distinct(), "contaminated")
    same = docs[doc_id].eqNullSafe(bad["bad_id"]) & (text_key(text) == bad["bad_key"])
    return docs.join(bad, same, "left_anti")


def _scan(df, text, span, k, short, filter_, count_only) -> DataFrame:
    """The rows with word counts and hits; texts are left out, a hash of them is kept."""
    ids = [c for c in df.columns if c != text]
    carried = df.select(*ids, text_key(text).alias("text_key"), text)
    schema = ", ".join([*fields(carried.drop(text)), "n_words bigint", f"hits array<{_HIT}>"])

    def make():
        winnower = Winnower(span, k, short)
        known = filter_() if filter_ else None
        if count_only:
            known = lambda made: np.zeros(len(made), bool)

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            texts = utf8(batch.column(text))
            for start, end in blocks(texts):
                counts, hits = _hits(winnower, texts[start:end], known)
                part = batch.slice(start, end - start)
                yield {c: part.column(c) for c in [*ids, "text_key"]} | {
                    "n_words": counts,
                    "hits": hits,
                }

        return work

    return map_rows(carried, schema, make)


def _filter(prints: DataFrame, bits: int):
    """A function that makes a test whether hashes may be among the prints.

    The bits that are set come to the driver as words of 64: 2^19 rows at most.
    """
    low, high = _probes_sql("gram", bits)
    places = prints.select(F.explode(F.array(low, high)).alias("bit"))
    words = places.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set")
    )
    table = np.zeros(1 << bits - 6, np.int64)
    for row in words.toLocalIterator():
        table[row["word"]] = row["set"]
    shared = prints.sparkSession.sparkContext.broadcast(table.tobytes())

    def load():
        flags = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little")

        def known(made: np.ndarray) -> np.ndarray:
            a, b = _probes_numpy(made, bits)
            passed = flags[a] == 1
            passed[passed] = flags[b[passed]] == 1
            return passed

        return known

    return load


def _probes_numpy(made: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (made & mask).astype(np.int64), ((made >> np.uint64(32)) & mask).astype(np.int64)


def _probes_sql(gram: str, bits: int) -> tuple[F.Column, F.Column]:
    mask = F.lit((1 << bits) - 1).cast("bigint")
    return (
        F.col(gram).bitwiseAND(mask),
        F.shiftrightunsigned(gram, 32).bitwiseAND(mask),
    )


def _same(own: F.Column, other: F.Column) -> F.Column:
    """How many words agree from the first on."""
    pairs = F.zip_with(own, other, lambda a, b: F.coalesce(a == b, F.lit(False)))
    first_off = F.array_position(pairs, F.lit(False)).cast("int")
    return F.when(first_off > 0, first_off - 1).otherwise(F.size(pairs))


def _covered(name: str) -> F.Column:
    """Words in the union of sorted spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))

    def add(state: F.Column, span: F.Column) -> F.Column:
        begin = F.greatest(span["low"], state["end"])
        fresh = F.greatest(span["high"] - begin, F.lit(0))
        return F.struct(
            (state["n"] + fresh).alias("n"), F.greatest(span["high"], state["end"]).alias("end")
        )

    return F.aggregate(F.col(name), start, add, lambda state: state["n"])
