"""Periodic runs, weighted samples and ranked search against brute force, and odd inputs."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestflow.llm import periodic_runs, ranked_search, weighted_sampling
from nestflow.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_edge_cases import CLASHING, items, odd, pairs  # noqa: F401

TABLES = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(TABLES).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def documents(spark):
    table = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    return sorted(tuple(r) for r in table.collect())


# Runs


def brute_runs(words: list, shortest: int = 12) -> list[tuple[int, int, int]]:
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, len(words) // 2 + 1):
        i = 0
        while i + lag < len(words):
            start = i
            while i + lag < len(words) and words[i] == words[i + lag]:
                i += 1
            length = i - start + lag
            if i > start and length >= max(shortest, 2 * lag):
                found.setdefault((start, length), lag)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def found_runs(words: list, shortest: int = 12) -> list[tuple]:
    return [tuple(r) for r in periodic_runs.runs(np.array(words, np.int64), shortest).tolist()]


@pytest.mark.parametrize("seed", range(20))
def test_runs_of_random_words(seed):
    r = random.Random(seed)
    for _ in range(60):
        shortest, letters = r.choice([2, 3, 7, 12, 13]), r.randint(1, 4)
        words: list[int] = []
        while len(words) < r.randint(0, 200):
            words += [r.randrange(letters) for _ in range(r.randint(1, 15))] * r.randint(1, 5)
            if r.random() < 0.4:
                words += words[r.randrange(len(words)) :]
        words = words[:300]
        assert found_runs(words, shortest) == brute_runs(words, shortest)


def test_runs_of_words_that_repeat_in_many_ways():
    fibonacci, longer = [0], [0, 1]
    while len(longer) < 2000:
        fibonacci, longer = longer, longer + fibonacci
    thue = [i.bit_count() % 2 for i in range(2048)]
    for words in (longer, thue, ([0, 1] * 400 + [0]) * 2, [0] * 3000):
        assert found_runs(words) == brute_runs(words)


def test_seeds_grow_with_the_words():
    """A long text of one word, or of two periods side by side, is no matter of pairs."""
    assert found_runs([7] * 300_000) == [(0, 300_000, 1)]
    words = list(range(5)) * 20_000 + list(range(7)) * 20_000
    assert {r[2] for r in found_runs(words)} >= {5, 7}


def planted(doc_id, text: str) -> list[str]:
    words = brute.re.findall(r"[^\x20\x09-\x0D]+", text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


@tables
def test_periodic_runs_query(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, TABLES).collect()}
    several = 0
    for doc_id, text in documents:
        words, row = planted(doc_id, text), rows[doc_id]
        found = brute_runs(words)
        several += len(found)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        shown = (row["start"], row["length"], row["period"], row["exponent_milli"])
        assert row["n_runs"] == len(found)
        assert shown == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert row["runs_sha256"] == brute.sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        dropped = {i for s, n, q in found for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert row["collapsed_sha256"] == brute.sha(kept)
    assert several > 15


def test_runs_of_odd_rows(odd):  # noqa: F811
    found = periodic_runs.find_runs(odd)
    assert set(CLASHING) - {"n_words"} <= set(found.columns)
    rows = Counter(
        (r["doc_id"], r["n_words"], r["collapsed_text"], tuple(map(tuple, r["runs"])))
        for r in found.collect()
    )
    want = Counter()
    for doc_id, text in pairs(odd):
        words = brute.re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = brute_runs(words) if len(words) < 1000 else []
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        want[doc_id, len(words), kept, tuple(runs)] += 1
    assert rows == want
    assert periodic_runs.find_runs(odd.limit(0)).count() == 0


# Weighted samples


def jaccard(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / sum((a | b).values())


def test_collision_rate_is_the_generalised_jaccard_similarity():
    r, sampler, errors = random.Random(3), weighted_sampling.Sampler(2048), []
    for _ in range(60):
        words = [f"w{i}" for i in range(r.randint(2, 80))]
        a = Counter({w: r.randint(1, 12) for w in words if r.random() < 0.7})
        b = Counter({w: n if r.random() < 0.5 else r.randint(1, 12) for w, n in a.items()})
        b.update(r.choices(words, k=r.randint(0, 40)))
        if not a:
            continue
        texts = [" ".join(c.elements()).encode() for c in (a, b)]
        signed = sampler.signatures(texts)
        errors.append(weighted_sampling.alike(signed[:1], signed[1:])[0] - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.005
    assert np.abs(errors).max() < 0.05


def test_samples_depend_on_the_words_alone():
    texts = [b"a b c a", b"A a\tc B", b"", b" \n", b"one", b"x " * 500, b"y z"]
    one = weighted_sampling.Sampler(32)
    signed = one.signatures(texts)
    assert (signed[0] == signed[1]).all() and not signed[2:4].any() and signed[4:].all()
    # A table that is emptied again and again, and texts taken in parts.
    small = weighted_sampling.Sampler(32, most=8)
    many = [*texts, " ".join(f"w{i}" for i in range(9000)).encode()]
    assert (small.signatures(many) == one.signatures(many)).all()
    assert (one.signatures(many[::-1])[::-1] == small.signatures(many)).all()


def test_likeness_of_columns(spark):
    df = spark.createDataFrame([("a b c d", "a b c e"), ("", "")], "x string, y string")
    df = weighted_sampling.fingerprints(df, text="x").withColumnRenamed("fingerprint", "fx")
    df = weighted_sampling.fingerprints(df, text="y")
    rows = df.withColumn("near", weighted_sampling.likeness(F.col("fx"), F.col("fingerprint")))
    for row in rows.collect():
        a, b = row["fx"], row["fingerprint"]
        same = sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4))
        assert row["near"] == same / weighted_sampling.SAMPLES


def check_neighbours(rows: list, ordered: list[tuple]):
    """Each document's row against its own and the next text, by plain Python."""
    sampler = weighted_sampling.Sampler()
    for place, (doc_id, text) in enumerate(ordered):
        other, row = ordered[(place + 1) % len(ordered)][1], rows[place]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        signed = sampler.signatures([t.encode() for t in (text, edited, other)])
        near = [float((signed[0] == s).mean()) for s in signed[1:]]
        assert row["doc_id"] == doc_id and row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert [row["fingerprint"], row["edited_fingerprint"]] == weighted_sampling.hexed(signed[:2])
        assert [row["near_edited"], row["near_next"]] == near


@tables
def test_weighted_sampling_query(spark, documents):
    rows = QUERIES["op12_weighted_sampling"](spark, TABLES).orderBy("doc_id").collect()
    check_neighbours(rows, documents)
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.97 * len(rows)


@pytest.mark.parametrize("size", [0, 1, 2, 3, 40])
def test_neighbours_across_ranges(spark, size):
    """More ranges than rows, and ranges of few rows."""
    r = random.Random(size)
    docs = [(7 * i - 20, " ".join(r.choices("abcdefé漢", k=r.randint(0, 30)))) for i in range(size)]
    df = spark.createDataFrame(r.sample(docs, size), "doc_id bigint, text string")
    rows = weighted_sampling.compare_with_next(df.repartition(3)).orderBy("doc_id").collect()
    assert len(rows) == size
    check_neighbours(rows, docs)


def test_neighbours_of_odd_rows(spark, odd):  # noqa: F811
    rows = weighted_sampling.compare_with_next(odd).collect()
    content = [(i, t or "") for i, t in pairs(odd)]
    assert len(rows) == len(content)
    single = {i for i, n in Counter(i for i, _ in content).items() if n == 1}
    lengths = Counter((i, len(t)) for i, t in content)
    assert Counter((r["doc_id"], r["n_chars"]) for r in rows) == lengths
    # Ids that are there once have a text and a next one by their order alone.
    ordered = sorted({i for i, _ in content if i is not None})
    texts = dict(content)
    for row in rows:
        at = ordered.index(row["doc_id"]) if row["doc_id"] in single else -1
        if at < 0 or at + 1 == len(ordered) or ordered[at + 1] not in single:
            continue
        edited = weighted_sampling.spliced(texts[ordered[at]], texts[ordered[at + 1]])
        assert row["edited_sha256"] == brute.sha(edited)
    # Repeated rows follow each other: all but the last are their own next.
    same = weighted_sampling.compare_with_next(odd.filter("doc_id = 8").select("doc_id", "text"))
    assert [r["near_next"] for r in same.collect()] == [1.0, 1.0]


def test_fingerprints_of_odd_rows(odd):  # noqa: F811
    signed = weighted_sampling.fingerprints(odd)
    assert set(CLASHING) <= set(signed.columns)
    rows = {(r["doc_id"], r["text"]): r["fingerprint"] for r in signed.collect()}
    sampler = weighted_sampling.Sampler()
    for (_, text), code in rows.items():
        assert [code] == weighted_sampling.hexed(sampler.signatures([(text or "").encode()]))
    assert weighted_sampling.fingerprints(odd.limit(0)).count() == 0


# Ranked search


def brute_ranking(docs: list[tuple], queries: list[tuple], k: int = 10) -> Counter:
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

    def terms(text):
        return [t.translate(brute.LOWER) for t in brute.re.findall(pattern, text or "")]

    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    documents, total = len(counted), sum(sum(c.values()) for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    made = Counter()
    for item_id, text in queries:
        scored = []
        for doc_id, own in counted:
            m = 10 + 90 * sum(own.values()) * documents // total
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * held[t] + 1)))
                * (1_000_000_000 * own[t] // (1000 * own[t] + 8 * m))
                for t in set(terms(text)) & own.keys()
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scored)[:k], 1):
            made[item_id, rank, None if null else doc_id, -score] += 1
    return made


@tables
def test_ranked_search_in_small_blocks(spark, documents, monkeypatch):
    """Many trees with several levels, and items in several blocks."""
    monkeypatch.setattr(ranked_search, "TREE_DOCUMENTS", 64)
    docs = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(2)
    queries = spark.read.parquet(f"{TABLES}/benchmark.parquet").select("item_id", "text")
    found = ranked_search.ranked(docs, queries, k=3, query_bytes=1500)
    want = brute_ranking(documents, [tuple(r) for r in queries.collect()], k=3)
    assert Counter(tuple(r) for r in found.collect()) == want


def test_ranked_search_of_odd_rows(spark, odd, items):  # noqa: F811
    queries = [tuple(r) for r in items.collect()]
    for table in (odd, odd.limit(0), odd.filter("text IS NULL"), odd.unionAll(odd)):
        found = ranked_search.ranked(table, items, k=4)
        assert Counter(tuple(r) for r in found.collect()) == brute_ranking(pairs(table), queries, 4)
    assert ranked_search.ranked(odd, items.limit(0)).count() == 0


def test_trees_prune_and_lose_nothing():
    r = random.Random(1)
    width, vectors = 400, 3000
    weights = np.sort(np.array([r.randint(1, 9000) for _ in range(width)]))
    bands = np.floor(np.log(weights) / 0.5).astype(np.int64)
    rows = []
    for n in range(vectors):
        # Rare terms weigh much; every third vector is a copy.
        own = {min(int(r.expovariate(0.02)), width - 1) for _ in range(30)}
        if n % 3 == 0 and rows:
            rows.append(rows[-1])
        else:
            rows.append((sorted(own), [r.randint(1, 999_999)] * len(own)))
    starts = np.concatenate([[0], np.cumsum([len(t) for t, _ in rows])])
    terms = np.array([t for own, _ in rows for t in own])
    values = np.array([v for _, own in rows for v in own])
    tree = ranked_search.BallTree(starts, terms, values, weights, bands)
    scored = leaves = 0
    for _ in range(50):
        own = np.array(sorted(r.sample(range(width), 12)))
        best = ranked_search.Best(5)
        scored += tree.search(own, weights[own], best, list(range(vectors)))
        leaves += sum(not c for c in tree.children)
        dense = dict(zip(own.tolist(), weights[own].tolist(), strict=True))
        all_scores = [sum(v * dense.get(t, 0) for t, v in zip(*row, strict=True)) for row in rows]
        want = sorted(((s, -i) for i, s in enumerate(all_scores) if s > 0), reverse=True)[:5]
        assert sorted(((s, -i) for s, i in best.found()), reverse=True) == want
    assert scored < leaves
