"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from nestflow.llm import (
    bpe,
    decontamination,
    lattice,
    licenses,
    line_dedup,
    quality_rules,
    sharding,
    simhash,
    token_counts,
    warc,
)
from nestflow.llm.queries import BYTE_BPE, PIECES
from tests.llm import brute

#: Names that the operators use themselves, as columns of the user.
CLASHING = (
    "text_key fingerprint code mask pattern u v m line_owner line_key dropped_keys coded_text "
    "counted_text chunk word number times hits contamination_row hash_bits cell shard_text "
    "content words hashes counts plain found host host_name bundle frame id_key salt own_salt "
    "N_Tokens n_words kept lines_with_words known base score judged_host again response"
).split()
PASSAGE = "one two three four five six seven eight nine ten eleven twelve"
SHARED = "this line stands in many documents of the table, word for word"


@pytest.fixture(scope="module")
def odd(spark):
    r = random.Random(5)
    letters = "abcdefghij é漢<"
    long = " ".join("".join(r.choices(letters, k=r.randint(1, 9))) for _ in range(40_000))
    texts = [
        (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "x" * 100_000),
        (6, long), (7, f"some {PASSAGE} more"), (8, "same text " * 30), (8, "same text " * 30),
        (9, "same text " * 30), (None, "Released under the MIT License."),
        (10, "<|endoftext|> a b \x1c c\x00d"), (11, "\n" * 50), (12, f"{SHARED}\nown line"),
        (13, f"  {SHARED.upper()}\t\nother"), (14, SHARED), (15, SHARED), (16, f"{SHARED}\n{SHARED}"),
        (None, SHARED), (None, f"b\n{SHARED}"), (17, "😀 " * 100),
    ]
    rows = [(i, t, None if n % 4 == 0 else f"h{n % 3}") for n, (i, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    return df.select("*", *(F.lit(n).alias(c) for n, c in enumerate(CLASHING))).repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, PASSAGE), (2, None), (3, ""), (4, "same text"), (None, "same text"), (4, "zz")]
    rows.append((5, f"q {PASSAGE}"))
    return spark.createDataFrame(rows, "item_id bigint, text string")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_bpe(odd):
    coded = bpe.digests(odd, BYTE_BPE, ids="Own")
    assert set(CLASHING) - {"N_Tokens"} <= set(coded.columns)
    rows = Counter(
        (r["doc_id"], tuple(r["Own"]), r["n_tokens"], r["ids_sha256"]) for r in coded.collect()
    )
    want = Counter()
    for doc_id, text in pairs(odd):
        ids = brute.ids(text)
        want[doc_id, tuple(ids), len(ids), brute.ids_digest(ids)] += 1
    assert rows == want


def test_bpe_round_trip(odd):
    back = bpe.decode(bpe.encode(odd.select("doc_id", "text"), BYTE_BPE).drop("text"), BYTE_BPE)
    assert Counter(pairs(back)) == Counter((i, t or "") for i, t in pairs(odd))


def test_null_ids_give_null(spark):
    df = spark.createDataFrame([([36, 559],), (None,), ([],)], "token_ids array<int>")
    texts = [r["text"] for r in bpe.decode(df, BYTE_BPE).collect()]
    assert sorted(texts, key=str) == sorted([brute.TOKENIZER.decode([36, 559]), None, ""], key=str)


def test_token_counts(odd):
    rows = token_counts.count_tokens(odd, BYTE_BPE, limit=10).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows)
    want = Counter()
    for doc_id, text in pairs(odd):
        count = len(brute.ids(text))
        want[doc_id, len((text or "").encode()), count, count > 10] += 1
    assert got == want


def test_token_counts_of_a_model_file(odd):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    short = odd.filter("length(text) < 1000 OR text IS NULL")
    rows = token_counts.count_tokens(short, path, limit=10).collect()
    want = Counter((i, len(model.encode(t or ""))) for i, t in pairs(short))
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == want


def test_line_dedup(odd):
    left = line_dedup.dedup_lines(odd)
    assert set(CLASHING) <= set(left.columns)
    docs = pairs(odd)
    want = Counter(zip([i for i, _ in docs], brute.dedup_lines(docs), strict=True))
    assert Counter(pairs(left)) == want
    assert any(r["n_dropped"] for r in left.collect())


def test_contamination(odd, items):
    found = decontamination.contamination(odd, items).collect()
    some = [tuple(r) for r in items.collect()]
    want = Counter()
    for doc_id, text in pairs(odd):
        n_words, n_hit, named = brute.contamination(text, some)
        want[doc_id, n_words, n_hit, len(named), brute.sha(",".join(named)), n_hit > 0] += 1
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert Counter(tuple(r[n] for n in names) for r in found) == want
    clean = decontamination.drop_contaminated(odd, items)
    assert clean.columns == odd.columns
    assert Counter(pairs(clean)) == Counter(
        (i, t) for i, t in pairs(odd) if not brute.contamination(t, some)[1]
    )


def test_simhash(odd):
    rows = simhash.near_duplicates(odd).collect()
    docs = pairs(odd)
    codes = [brute.fingerprint(t) for _, t in docs]
    roots = brute.components(codes)
    want = Counter()
    for (doc_id, _), code in zip(docs, codes, strict=True):
        same = [i for (i, _), c in zip(docs, codes, strict=True) if roots[c] == roots[code]]
        ids = [i for i in same if i is not None]
        want[doc_id, f"{code:016x}", min(ids, default=None)] += 1
    assert Counter(tuple(r) for r in rows) == want
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len(set(roots.values()))


def test_quality(odd):
    rows = quality_rules.judge(odd).collect()
    got = Counter((r["doc_id"], *(r[m] for m in quality_rules.MEASURES)) for r in rows)
    measured = [(i, brute.measures(t)) for i, t in pairs(odd)]
    assert got == Counter((i, *(m[x] for x in quality_rules.MEASURES)) for i, m in measured)
    for r in rows:
        base = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == base
        assert not (base and r["kept"])
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r["kept"] for r in rows)


def test_licenses(odd):
    rows = licenses.scan_licenses(odd).collect()
    assert Counter(r["n_licenses"] for r in rows) == {0: len(rows) - 1, 1: 1}
    (match,) = [r for r in rows if r["n_licenses"]]
    assert [m["name"] for m in match["licenses"]] == ["MIT notice"]
    assert match["best_percent"] == 100


def test_language_model(odd):
    rows = lattice.score_documents(odd, PIECES, F.col("doc_id") == 4).collect()
    assert len(rows) == odd.count()
    assert sum(r["held_out"] for r in rows) == 1
    want = Counter((i, len(brute.words(t)) + 1) for i, t in pairs(odd))
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == want
    assert all(r["score"] < 0 and r["score"] > float("-inf") for r in rows)


def test_shards(odd):
    rows = sharding.assign_shards(odd, limit=2_000).collect()
    assert Counter((r["doc_id"], r["n_bytes"]) for r in rows) == Counter(
        (i, len((t or "").encode())) for i, t in pairs(odd)
    )
    check_shards(rows, 2_000)


def check_shards(rows, limit):
    sizes: dict[str, list[int]] = {}
    for r in rows:
        assert len(r["shard"]) == r["shard_depth"]
        sizes.setdefault(r["shard"], []).append(r["n_bytes"])
    for shard, own in sizes.items():
        assert sum(own) <= limit or len(own) == 1
        # A shard's parent was too large, and no shard is inside another one.
        if shard:
            parent = [n for s, ns in sizes.items() if s.startswith(shard[:-1]) for n in ns]
            assert sum(parent) > limit and len(parent) > 1
        assert not any(s != shard and s.startswith(shard) for s in sizes)


def test_warc(spark, odd):
    named = {"doc_id": "page_id", "source": "url", "text": "html"}
    pages = odd.select(*[F.col(c).alias(n) for c, n in named.items()], *CLASHING)
    rows = warc.round_trip(pages).collect()
    payloads = [(i, (t or "").encode()) for i, t in pairs(odd)]
    want = Counter()
    for page_id, payload in payloads:
        same = [i for i, p in payloads if p == payload and i is not None]
        first = min(same) if len(payload) >= 100 and same else None
        refers = first if page_id != first else None
        want[page_id, len(payload), brute.sha(payload.decode()), refers] += 1
    names = ("page_id", "payload_bytes", "payload_digest", "refers_to")
    got = Counter(tuple(r[n] for n in names) for r in rows)
    assert got == want
    assert all((r["record_type"] == "revisit") == (r["refers_to"] is not None) for r in rows)


EMPTY = {
    "bpe": lambda df, items: bpe.digests(df, BYTE_BPE),
    "counts": lambda df, items: token_counts.count_tokens(df, BYTE_BPE, 10),
    "lines": lambda df, items: line_dedup.dedup_lines(df),
    "contamination": lambda df, items: decontamination.contamination(df, items),
    "clean": lambda df, items: decontamination.drop_contaminated(df, items),
    "simhash": lambda df, items: simhash.near_duplicates(df),
    "simhash_kept": lambda df, items: simhash.drop_near_duplicates(df),
    "judge": lambda df, items: quality_rules.judge(df),
    "good": lambda df, items: quality_rules.keep_good(df),
    "licenses": lambda df, items: licenses.scan_licenses(df),
    "lattice": lambda df, items: lattice.score_documents(df, PIECES, F.lit(False)),
    "shards": lambda df, items: sharding.assign_shards(df, 100),
    "warc": lambda df, items: warc.round_trip(df, page_id="doc_id", url="source", payload="text"),
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_table(odd, items, name):
    assert EMPTY[name](odd.limit(0), items.limit(0)).collect() == []


def test_empty_benchmark(odd, items):
    found = decontamination.contamination(odd, items.limit(0))
    assert not any(r["contaminated"] for r in found.collect())


def test_only_held_out_documents(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    rows = lattice.score_documents(df, PIECES, F.lit(True)).collect()
    assert {(r["doc_id"], r["n_known"], r["train_tokens"]) for r in rows} == {(1, 0, 0), (2, 0, 0)}


def test_stages_keep_odd_documents(spark, tmp_path, odd, items):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    n_chars = F.length("text").cast("bigint").alias("n_chars")
    docs = odd.select("doc_id", "text", F.lit("en").alias("lang"), "source", n_chars)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() > 0
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
