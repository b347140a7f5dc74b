"""Near-duplicate documents: groups of SimHash fingerprints that few bits link.

Fingerprints are put in Gray order, where neighbours share most bits, and stand as the leaves
of a tree. A node keeps the bits that all leaves below it share, less those that its parent
has; a search adds up the bits in which the query differs, from the root down, and leaves a
whole group of leaves as soon as the sum is above the limit.

For a cluster, the tree's top level is cut first: two fingerprints that differ in at most
``distance`` bits are equal in one of ``distance + 1`` blocks of bits, so each goes to the
groups of its blocks, whose shared masked bits are the group's root. A group of more
fingerprints than one task should hold is cut again by blocks of its free bits. Links come
out of a group as a star around the group's smallest linked fingerprint, never as pairs; the
stars are joined to components by a few rounds of large-star and small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.base import (
    drop_settled,
    fields,
    free_name,
    map_batches,
    map_rows,
    settled,
    settled_paths,
    text_key,
    utf8,
)
from nestflow.llm.hashing import gray_rank

SHINGLE = 3
DISTANCE = 3
#: Fingerprints of a group that one task searches; larger groups are cut again.
GROUP_LIMIT = 1 << 14
#: Children of a node of the tree.
FAN_OUT = 8
#: Pairs of a query and a code of its group, at most, that go through the tree together.
PAIRS = 1 << 22
SEED = 42


# Fingerprints


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's shingles of words, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[:-shingle] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        spans = zip(starts, ends[shingle - 1 :].tolist(), strict=True)
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts)
        )
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 15):
        part = hashes[start : start + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_ = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_, bitorder="little").view("<u8")[0])


def with_fingerprint(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "fingerprint"
) -> DataFrame:
    """The rows with the fingerprint, as a signed long, in place of the text."""
    kept = [c for c in docs.columns if c != text and c.lower() != name]
    schema = ", ".join([*fields(docs.select(*kept)), f"`{name}` bigint"])

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            codes = [fingerprint(t, shingle) for t in utf8(batch.column(text))]
            codes = np.array(codes, np.uint64).view(np.int64)
            yield {c: batch.column(c) for c in kept} | {name: codes}

        return work

    return map_rows(docs.select(*kept, text), schema, make)


# The tree


class GrayTree:
    """Trees over groups of distinct codes, a root for each group.

    ``codes`` are in the order of ``group`` and, within it, of Gray rank.
    """

    def __init__(self, codes: np.ndarray, group: np.ndarray, fan_out: int = FAN_OUT):
        self.codes = codes
        first = np.flatnonzero(np.diff(group, prepend=-1))
        sizes = np.diff(first, append=len(codes))
        # Levels from the leaves up: bits that are set in all, and in any; children's range.
        all_, any_ = codes, codes
        self.levels = []
        low = high = None
        while True:
            self.levels.append((all_, ~(all_ ^ any_), low, high))
            if (sizes == 1).all():
                break
            starts = np.cumsum(sizes) - sizes
            nodes = -(-sizes // fan_out)
            of = np.repeat(np.arange(len(sizes)), nodes)
            within = np.arange(nodes.sum()) - np.repeat(np.cumsum(nodes) - nodes, nodes)
            low = starts[of] + within * fan_out
            high = np.minimum(low + fan_out, starts[of] + sizes[of])
            all_ = np.bitwise_and.reduceat(all_, low)
            any_ = np.bitwise_or.reduceat(any_, low)
            sizes = nodes
        self.root = np.repeat(np.arange(len(first)), np.diff(first, append=len(codes)))

    def components(self, distance: int, pairs: int = PAIRS) -> np.ndarray:
        """For each code, the place of the first code of its component in its group."""
        label = np.arange(len(self.codes))
        cost = np.cumsum(np.bincount(self.root)[self.root]) // pairs
        for batch in np.split(np.arange(len(label)), np.flatnonzero(np.diff(cost)) + 1):
            a, b = self._links(batch, distance, label)
            if len(a):
                label = _joined(label, a, b)
        return label

    def _links(self, query: np.ndarray, distance: int, label: np.ndarray):
        """Pairs of a query and a later code within the distance, of different components.

        Groups of leaves that all belong to the query's own component are left whole.
        """
        low_label, high_label = [label], [label]
        last = [np.arange(len(label))]
        for _, _, low, high in self.levels[1:]:
            low_label.append(np.minimum.reduceat(low_label[-1], low))
            high_label.append(np.maximum.reduceat(high_label[-1], low))
            last.append(last[-1][high - 1])
        node = self.root[query]
        spent = np.zeros(len(query), np.int64)
        known = np.zeros(len(query), np.uint64)
        for level in range(len(self.levels) - 1, -1, -1):
            pattern, shared, low, high = self.levels[level]
            fresh = shared[node] & ~known
            spent = spent + np.bitwise_count((self.codes[query] ^ pattern[node]) & fresh)
            own = label[query]
            open_ = (spent <= distance) & (last[level][node] > query)
            open_ &= (low_label[level][node] != own) | (high_label[level][node] != own)
            query, node, spent = query[open_], node[open_], spent[open_]
            known = shared[node]
            if level == 0 or not len(query):
                break
            count = (high - low)[node]
            query, spent, known = (np.repeat(x, count) for x in (query, spent, known))
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            node = np.repeat(low[node], count) + within
        return query, node


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the components of ``a`` and ``b`` are joined: the smallest place."""
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        for end in (a, b):
            np.minimum.at(label, label[end], low)
            np.minimum.at(label, end, low)
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter
        if (label == before).all():
            return label


# Groups on the cluster


def _pieces(free: int, count: int) -> list[int]:
    """Masks that cut the free bits of a 64-bit word into ``count`` blocks."""
    bits = [i for i in range(64) if free >> i & 1]
    cuts = [len(bits) * i // count for i in range(count + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _cut(groups: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """Each code once per block of its group's free bits, masked by the block as well.

    ``masks`` are those that groups at this level can have: few, as blocks are fixed.
    """
    full = (1 << 64) - 1
    choices = F.array(*[
        F.struct(
            F.lit(mask).cast("bigint").alias("mask"),
            F.array(*[
                F.lit(_signed(mask & full | piece)).cast("bigint")
                for piece in _pieces(full & ~mask, distance + 1)
            ]).alias("next"),
        )
        for mask in masks
    ])
    own = F.filter(choices, lambda c: c["mask"] == F.col("mask"))[0]["next"]
    cut = groups.select("code", F.explode(own).alias("mask"))
    return cut.select("code", "mask", F.col("code").bitwiseAND(F.col("mask")).alias("pattern"))


def links(codes: DataFrame, distance: int = DISTANCE, limit: int = GROUP_LIMIT) -> DataFrame:
    """Links between distinct codes (column ``code``): every code of a linked set with the
    set's first one, as ``a`` and ``b``; sets overlap.

    All codes within the distance are in a common set, and all sets are connected.
    """
    if limit < 1 << distance + 1:
        # Fewer free bits than blocks could not be cut on.
        raise ValueError(f"a group must be able to hold {1 << distance + 1} codes")
    groups = _cut(codes.select("code", F.lit(0).cast("bigint").alias("mask")), [0], distance)
    found = None
    while True:
        groups = settled(groups, "fingerprint-groups")
        sizes = groups.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("size"))
        large = settled(sizes.filter(F.col("size") > limit).drop("size"), "large-groups")
        if large.isEmpty():
            part = _group_links(groups, distance)
            return settled(part if found is None else found.union(part), "fingerprint-links")
        small = groups.join(large, ["mask", "pattern"], "left_anti")
        part = settled(_group_links(small, distance), "fingerprint-links")
        found = part if found is None else found.union(part)
        # Four to the power of the level at most, and there are few levels.
        masks = [row["mask"] for row in large.select("mask").distinct().collect()]
        groups = _cut(groups.join(large, ["mask", "pattern"], "left_semi"), masks, distance)
        groups = groups.distinct()


def _group_links(groups: DataFrame, distance: int) -> DataFrame:
    """Search the groups of a partition, some whole groups at a time."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []

        def found(table: np.ndarray) -> pa.RecordBatch:
            mask, pattern, code = table
            new = np.ones(len(code), bool)
            new[1:] = (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])
            group = np.cumsum(new) - 1
            several = np.bincount(group)[group] > 1
            code, group = code[several].view(np.uint64), group[several]
            if not len(code):
                return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["a", "b"])
            group = np.cumsum(np.diff(group, prepend=-1) != 0) - 1
            order = np.lexsort((gray_rank(code), group))
            code, group = code[order], group[order]
            label = GrayTree(code, group).components(distance)
            far = label != np.arange(len(code))
            ends = [code[far].view(np.int64), code[label[far]].view(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(e) for e in ends], ["a", "b"])

        for batch in batches:
            part = np.stack([batch.column(c).to_numpy() for c in ("mask", "pattern", "code")])
            rest.append(part)
            table = np.concatenate(rest, axis=1)
            # The last group may go on in the next batch.
            changes = np.flatnonzero((table[:2, 1:] != table[:2, :-1]).any(axis=0))
            end = int(changes[-1]) + 1 if len(changes) else 0
            if end:
                yield found(table[:, :end])
            rest = [table[:, end:]]
        if rest and rest[0].shape[1]:
            yield found(np.concatenate(rest, axis=1))

    # By hash, not by range: a range would put the groups of many near copies side by side.
    dealt = groups.select("mask", "pattern", "code").repartition("mask", "pattern")
    in_order = dealt.sortWithinPartitions("mask", "pattern", "code")
    return map_batches(in_order, search, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all ends of edges.

    Rounds of large-star and small-star steps; each is written, and read by the next one.
    The centres are written apart, so that the links of a frequent node can be split.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = settled(edges.filter("u <> v").distinct(), "star-edges")
    spark, state = edges.sparkSession, None
    while True:
        older = settled_paths(spark)[-1:]
        # Large star: the larger neighbours of a node are linked to its smallest one.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = settled(least.select("u", F.least("u", "m").alias("m")), "star-centres")
        large = both.join(least, "u").filter("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settled(large, "large-star")
        # Small star: the smaller neighbours, and the node, are linked to the smallest.
        least = settled(large.groupBy("u").agg(F.min("v").alias("m")), "star-centres")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.filter("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        edges = settled(small.distinct(), "star-edges")
        total = F.sum(F.xxhash64("u", "v").cast("decimal(38, 0)"))
        now = edges.agg(F.count(F.lit(1)), total).first()
        # The last round's links, and what this round has made on the way to the new ones.
        made = settled_paths(spark)
        drop_settled(spark, [*older, *made[made.index(older[0]) + 1 : -1]])
        if now == state:
            break
        state = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = stars.select("root").distinct()
    return stars.unionByName(roots.select(F.col("root").alias("node"), "root"))


def _grouped(prints: DataFrame, distance: int) -> DataFrame:
    """The rows of ``prints`` (with ``fingerprint``) with ``root``, their component's code."""
    codes = prints.select(F.col("fingerprint").alias("code")).distinct()
    roots = components(links(codes, distance)).withColumnRenamed("node", "fingerprint")
    roots = settled(roots, "fingerprint-roots")
    joined = prints.join(roots, "fingerprint", "left")
    return joined.withColumn("root", F.coalesce("root", "fingerprint"))


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of each document row.

    Documents whose fingerprints differ in ``distance`` bits or less are linked; a component
    is all that links reach, and its id the smallest document id in it. Null and empty texts,
    and texts of white space, have the fingerprint zero and are linked like others. Null ids
    count as larger than any: a component of null ids only has a null id. Repeated rows come
    once for each time.
    """
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    prints = settled(with_fingerprint(docs, "text", shingle), "fingerprints")
    grouped = settled(_grouped(prints, distance), "grouped-fingerprints")
    # Written, so that the rows of a large component can be split in the join.
    names = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    names = settled(names, "component-names")
    code = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return grouped.join(names, "root").select("doc_id", code, "component_id")


def drop_near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One document of each component, with all its columns: that of the smallest id.

    Of rows with that id the one of the smallest text hash stays, and one of equal rows.
    """
    keyed = docs.select(
        docs[doc_id].alias("doc_id"), text_key(text).alias("key"), docs[text].alias("text")
    )
    prints = settled(with_fingerprint(keyed, "text", shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    kept = _grouped(prints, distance).groupBy("root").agg(first).select("first.*")
    # Keys without nulls, so that equal rows meet in the join's own partitions.
    id_key, key = free_name(docs, "id_key"), free_name(docs, "text_key")
    kept = settled(kept.select(text_key("doc_id").alias(id_key), F.col("key").alias(key)), "kept")
    rows = docs.withColumns({id_key: text_key(doc_id), key: text_key(text)})
    rows = rows.join(kept, [id_key, key], "left_semi").dropDuplicates([id_key, key])
    return rows.select(*docs.columns)
