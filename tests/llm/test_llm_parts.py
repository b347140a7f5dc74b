"""The parts that the operators are made of."""

from __future__ import annotations

import io
import math
import random
from collections import Counter
from datetime import UTC, datetime
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestflow.llm import lattice, licenses, line_dedup, quality_rules, sharding, simhash, warc
from nestflow.llm.bpe import ByteBPE, digests
from nestflow.llm.decontamination import contamination
from nestflow.llm.hashing import gray_rank
from nestflow.llm.license_templates import TEMPLATES
from nestflow.llm.pieces import parts, segments
from nestflow.llm.queries import BYTE_BPE, PIECES
from nestflow.llm.token_counts import count_tokens
from tests.llm import brute
from tests.llm.test_edge_cases import check_shards

BPE = ByteBPE(BYTE_BPE)
ALPHABET = "ab Aé漢\n\t .,'s1<|endoftext|> \x1c՘😀"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=60))
def test_bpe_equals_the_library(text):
    (coded,) = BPE.encode([text])
    assert np.frombuffer(coded, "<u4").tolist() == brute.ids(text)
    assert BPE.decode(coded) == text


@given(st.text(alphabet=ALPHABET, max_size=60))
def test_parts_give_the_text_back(text):
    assert " ".join(parts(text)) == text


def test_long_runs():
    texts = ["a" * 3_000, "ab" * 2_000, "".join(random.Random(1).choices("abcdef", k=3_000))]
    for text, coded in zip(texts, BPE.encode(texts), strict=True):
        assert np.frombuffer(coded, "<u4").tolist() == brute.ids(text)


def near_codes(seed: int, count: int) -> list[int]:
    r = random.Random(seed)
    codes = []
    for _ in range(count):
        base = r.getrandbits(64)
        for _ in range(r.randint(1, 40)):
            codes.append(base ^ sum({1 << r.randrange(64) for _ in range(r.randint(0, 4))}))
    return codes


@pytest.mark.parametrize("seed", range(5))
def test_gray_tree(seed):
    codes = np.unique(np.array(near_codes(seed, 15), np.uint64))
    codes = codes[np.argsort(gray_rank(codes))]
    label = simhash.GrayTree(codes, np.zeros(len(codes), int)).components(3, pairs=1_000)
    want = brute.components(codes.tolist())
    for i, j in zip(*np.triu_indices(len(codes)), strict=True):
        same = want[int(codes[i])] == want[int(codes[j])]
        assert (label[i] == label[j]) == same


@pytest.mark.parametrize("limit", [128, 1 << 14])
def test_links_with_a_hot_group(spark, limit):
    codes = near_codes(9, 30)
    r = random.Random(2)
    codes += [codes[0] ^ sum({1 << r.randrange(40, 64) for _ in range(5)}) for _ in range(300)]
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in set(codes)]
    links = simhash.links(spark.createDataFrame(signed, "code bigint"), 3, limit)
    got = {r["node"] % (1 << 64): r["root"] for r in simhash.components(links).collect()}
    want = brute.components(codes)
    sizes: dict[int, set] = {}
    for code, root in want.items():
        sizes.setdefault(root, set()).add(code)
    linked = {c for group in sizes.values() if len(group) > 1 for c in group}
    assert got.keys() == linked
    for group in sizes.values():
        assert len({got.get(c) for c in group}) == 1
    assert len(set(got.values())) == sum(len(g) > 1 for g in sizes.values())


def test_links_refuse_a_limit_that_cannot_be_met(spark):
    with pytest.raises(ValueError, match="able to hold 16"):
        simhash.links(spark.range(1).withColumnRenamed("id", "code"), 3, 8)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a bigint, b bigint")
    got = {(r["node"], r["root"]) for r in simhash.components(edges).collect()}
    assert got == {(i, 0) for i in range(61)}


def test_lattice_sums_all_segmentations():
    own, ids = lattice.vocabulary(PIECES), brute.piece_ids(PIECES)
    log_p = np.log(np.random.default_rng(0).dirichlet(np.ones(own.size)))

    def slow(word: str) -> float:
        return brute.marginal(word, ids, own.of_byte, log_p)

    r = random.Random(3)
    words = ["the", "retitioning", "é", "漢字", "of,"]
    words += ["".join(r.choices("abcdeé1,", k=r.randint(1, 20))) for _ in range(100)]
    got = lattice.word_scores([w.encode() for w in words] + [lattice.END], own, log_p)
    assert got[:-1] == pytest.approx([slow(w) for w in words])
    assert got[-1] == log_p[own.end]


def test_expected_uses_are_the_derivative():
    own = lattice.vocabulary(PIECES)
    log_p = np.log(np.random.default_rng(1).dirichlet(np.ones(own.size)))
    words = [b"retitioning", b"therein"]
    uses = lattice.Lattice(words, own, log_p).expected()
    for piece in np.argsort(-uses)[:5]:
        moved = log_p.copy()
        moved[piece] += 1e-5
        scores = [lattice.word_scores(words, own, p).sum() for p in (moved, log_p)]
        change = scores[0] - scores[1]
        assert change / 1e-5 == pytest.approx(uses[piece], abs=1e-4)


def test_word_probabilities_sum_to_one_at_most():
    own = lattice.vocabulary(PIECES)
    log_p = np.log(own.prior)
    words = [bytes([a, b]) for a in range(97, 123) for b in range(97, 123)]
    assert np.exp(lattice.word_scores(words, own, log_p)).sum() < 1


def test_filters_hold_all_repeats():
    r = random.Random(4)
    keys = [f"key {i}".encode() for i in range(3_000)]
    tasks = [[k for k in keys if r.random() < 0.2] for _ in range(4)]
    size = 1 << line_dedup.FILTER_BITS
    whole = line_dedup.Pair(size)
    for task in tasks:
        pair = line_dedup.Pair(size)
        for start in range(0, len(task), 100):
            pair.add(line_dedup._bits(task[start : start + 100]))
        whole.merge(pair.once.data, pair.twice.data)
    repeated = [k for k in keys if sum(k in task for task in tasks) > 1]
    assert whole.twice.has(line_dedup._bits(repeated)).all()
    alone = [k for k in keys if sum(k in task for task in tasks) < 2]
    assert whole.twice.has(line_dedup._bits(alone)).all(axis=1).mean() < 0.01


@pytest.mark.parametrize("bits", [[], [0, 5, 32767], range(0, 32768, 3)])
def test_packed_blocks(bits):
    flags = np.zeros(1 << line_dedup.BLOCK_BITS, np.uint8)
    flags[list(bits)] = 1
    data = np.packbits(flags, bitorder="little")
    assert (line_dedup._unpacked(line_dedup._packed(data)) == data).all()


def test_every_long_shared_span_is_found(spark):
    r = random.Random(6)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(3, 40)))) for i in range(20)]
    docs = []
    for i in range(60):
        words = r.choices(vocabulary, k=r.randint(0, 80))
        source = r.choice(items)[1].split()
        start = r.randrange(len(source))
        cut = source[start : start + r.randint(1, 14)]
        at = r.randrange(len(words) + 1)
        docs.append((i, " ".join(words[:at] + cut + words[at:])))
    docs.append((99, " ".join(["w1"] * 30)))
    items.append((50, " ".join(["w1"] * 12)))
    found = contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items_sha256"]) for r in found.collect()}
    for doc_id, text in docs:
        n, hit, named = brute.contamination(text, items)
        assert got[doc_id] == (n, hit, brute.sha(",".join(named)))


def test_hosts_are_judged_by_shrunk_rates(spark):
    words = "clean prose with many different words that nobody would ever object to at all here"
    marked = f"{words} # # #"
    rows = [(i, "bad", marked) for i in range(60)] + [(100 + i, "bad", words) for i in range(20)]
    rows += [(200 + 50 * h + i, f"good{h}", words) for h in range(5) for i in range(40)]
    rows += [(900, "good0", marked), (901, "one", marked), (902, None, marked)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = {r["doc_id"]: r for r in quality_rules.judge(df).collect()}
    assert not any(got[i]["kept"] for i in range(60))
    # Clean documents stay, whatever their host.
    assert all(got[100 + i]["kept"] for i in range(20))
    assert got[100]["host_rejected"] and not got[900]["host_rejected"]
    assert got[900]["kept"]


def test_a_host_of_one_document_is_not_judged_by_chance():
    alpha, beta = quality_rules.beta_prior(0.1, 0.0, 50, 1_000)
    assert (1 + alpha) / (1 + alpha + beta) < 0.2
    assert quality_rules.beta_prior(0.0, 0.0, 3, 10) == (0.0, 1000.0)


def test_a_match_holds_a_required_word():
    r = random.Random(8)
    for text in TEMPLATES.values():
        grams, words = licenses.bigrams(text), licenses.plain_words(text)
        required = licenses.required_words(text, licenses.LEAST_DICE)
        assert required <= set(words)
        for _ in range(50):
            # What is left without these words, in pieces, is too little, whatever is added.
            left = [w if w not in required else f"x{i}" for i, w in enumerate(words)]
            some = licenses.bigrams(" ".join(left[r.randrange(3) : len(left) - r.randrange(3)]))
            shared = len(set(some) & set(grams))
            assert 2 * shared < licenses.LEAST_DICE * (len(some) + len(grams))


def test_license_texts_with_changes(spark):
    mit = " ".join(TEMPLATES["MIT"].split())
    wrapped = "\n".join(TEMPLATES["MIT"].split("\n"))
    half = " ".join(mit.split()[:60])
    rows = [
        (1, f"Copyright (c) 2020 Somebody\n\n{wrapped}\n\nmain() {{}}"),
        (2, mit.replace("Software", "Program", 2)),
        (3, half),
        (4, "we met under the bridge. All rights reserved; no part of this work may be reproduced!"),
        (5, "Licensed under CC BY-SA 4.0.\nLicensed under CC BY 4.0."),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    scanned = licenses.scan_licenses(df).collect()
    got = {r["doc_id"]: [m["name"] for m in r["licenses"]] for r in scanned}
    assert got[1] == got[2] == ["MIT"] and got[3] == []
    assert got[4] == ["All rights reserved"]
    assert {"CC-BY-4.0 notice", "CC-BY-SA-4.0 notice"} <= set(got[5])


#: Templates whose usual layout has several paragraphs, by the words they begin with.
PARAGRAPHS = {
    "MIT": ["The above copyright", "THE SOFTWARE IS"],
    "ISC": ["THE SOFTWARE IS"],
    "Zlib": ["Permission is", "1. The", "2. Altered", "3. This"],
    "Apache-2.0 header": ["You may obtain", "http://", "Unless required"],
    "GPL-3.0 header": ["This program is distributed", "You should have"],
}


def test_licenses_within_longer_texts(spark):
    r = random.Random(4)

    def other(n):
        return " ".join("".join(r.choices("abcdefg", k=6)) for _ in range(n))

    texts, want = [], []
    for name, starts in PARAGRAPHS.items():
        laid_out = " ".join(TEMPLATES[name].split())
        for start in starts:
            assert f" {start}" in laid_out
            laid_out = laid_out.replace(f" {start}", f"\n\n{start}")
        texts.append(f"{other(300)}\n\n{laid_out}\n\n{other(300)}")
        wrapped = "\n".join(line.strip() for line in TEMPLATES[name].strip().split("\n"))
        texts.append(f"{other(300)}\n{wrapped}\n{other(300)}")
        want += [name, name]
    for name in [name for name in TEMPLATES if "notice" in name]:
        texts.append(f"{other(100)} {TEMPLATES[name]} {other(100)}")
        want.append(name)
    sentence = TEMPLATES["All rights reserved"]
    texts.append(f"{other(9)} {sentence} {other(9)} all rights reserved {other(9)}")
    want.append("All rights reserved notice")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = licenses.scan_licenses(df).collect()
    got = {r["doc_id"]: {m["name"]: m["dice"] for m in r["licenses"]} for r in rows}
    for i, name in enumerate(want):
        assert got[i].get(name) == 1.0


def best_runs(text, templates):
    """The best coefficient of all runs of words, for each template, in plain Python."""
    words = licenses.plain_words(text)
    pairs = [" ".join(p) for p in zip(words, words[1:], strict=False)]
    best = {}
    for name, body in templates.items():
        own = licenses.plain_words(body)
        own = Counter(" ".join(p) for p in zip(own, own[1:], strict=False))
        for i in range(len(pairs)):
            for j in range(i + 1, len(pairs) + 1):
                shared = (Counter(pairs[i:j]) & own).total()
                dice = Fraction(2 * shared, j - i + own.total())
                if dice >= licenses.LEAST_DICE and dice > best.get(name, 0):
                    best[name] = dice
    return {name: float(dice) for name, dice in best.items()}


def test_license_runs_equal_brute_force(spark):
    r = random.Random(8)
    templates = {"repeats": "a b a b a c a b d", "plain": "a c d b b b a", "short": "c d c"}
    words, weights = ["a ", "b ", "c ", "d ", "x\n"], [4, 4, 2, 2, 1]
    texts = ["".join(r.choices(words, weights, k=40)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    some = 0
    for row in licenses.scan_licenses(df, templates).collect():
        want = best_runs(texts[row["doc_id"]], templates)
        assert {m["name"]: m["dice"] for m in row["licenses"]} == pytest.approx(want)
        some += len(want)
    assert some > 20


def test_shards_split_a_hot_key(spark):
    rows = [(7 if i % 3 == 0 else i, "x" * (i % 50)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assigned = sharding.assign_shards(df, limit=800).collect()
    assert len(assigned) == 900
    check_shards(assigned, 800)
    assert len({r["shard"] for r in assigned if r["doc_id"] == 7}) > 5


def test_written_shards_fit(spark, tmp_path):
    df = spark.createDataFrame([(i, "y" * 100) for i in range(50)], "doc_id bigint, text string")
    sharding.write_shards(df, str(tmp_path / "shards"), limit=1_000)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.select("doc_id", "text").subtract(df).count() == 0 and back.count() == 50
    sizes = back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert all(r["n"] <= 1_000 for r in sizes) and len(sizes) > 4


@pytest.mark.parametrize("seed", range(6))
def test_segments_have_the_tokens_of_the_text(seed):
    """Texts without spaces, or with few, cut every dozen characters."""
    r = random.Random(seed)
    kinds = [
        "abcXYZ", "0123456789", "漢字中文", "，。！？", "\n\t", " ", "'", "|<>.,-_=/+", "é", "٣", "\u2003", "😀",
    ]
    special = ["<|endoftext|>", "don't", "a'll9", "x\n\n y", "1\n2", "\n "]
    for _ in range(150):
        text = "".join(
            r.choice(special) if r.random() < 0.1 else "".join(r.choices(r.choice(kinds), k=r.randint(1, 6)))
            for _ in range(r.randint(0, 80))
        )
        made = segments(text, limit=r.choice([4, 16, 48]))
        assert "".join(made) == text
        assert [i for s in made for i in brute.ids(s)] == brute.ids(text)
    chinese = "".join(r.choices("漢字中文，。", k=3_000))
    assert len(segments(chinese, 400)) > 20 and len(segments("a1" * 3_000, 400)) > 20


def test_long_texts_without_spaces(spark):
    texts = ["漢字，" * 60_000, "word7" * 30_000, "line\n" * 40_000, "base64+/" * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    counts = {r["doc_id"]: r["n_tokens"] for r in count_tokens(df, BYTE_BPE, 10).collect()}
    coded = {r["doc_id"]: r["ids_sha256"] for r in digests(df, BYTE_BPE).collect()}
    for number, text in enumerate(texts):
        ids = brute.ids(text)
        assert (counts[number], coded[number]) == (len(ids), brute.ids_digest(ids))


def test_bundle_is_seekable_and_plain_zstandard():
    file = io.BytesIO()
    writer = warc.BundleWriter(file, frame_bytes=500)
    records = [bytes([i]) * (i * 40) for i in range(1, 30)]
    places = [writer.add(r) for r in records]
    writer.close()
    reader = warc.BundleReader(file)
    assert len(reader) > 5
    for (frame, offset), record in zip(places, records, strict=True):
        assert reader.frame(frame)[offset : offset + len(record)] == record
    file.seek(0)
    stream = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True)
    assert stream.read() == b"".join(records)


def test_records_by_index(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://x/{i}\r\nX: y", f"<p>{i % 7}</p>" * 20) for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    folder = str(tmp_path / "archives")
    index = warc.write_archives(pages, folder)
    assert index.count() == 100
    some = index.filter("page_id % 10 = 3")
    got = {int(r["page_id"]): r for r in warc.read_records(some, folder).collect()}
    assert got.keys() == set(range(3, 100, 10))
    for page_id, row in got.items():
        assert row["url"] == rows[page_id][1]
        if row["record_type"] == "response":
            assert bytes(row["payload"]).decode() == rows[page_id][2]
        else:
            assert int(row["refers_to"]) == page_id % 7


def test_records_are_whole_and_read_in_many_tasks(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"<p>{i % 40}</p>" * 30) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    folder = str(tmp_path / "archives")
    date = datetime(2031, 2, 7, 1, 2, 3, tzinfo=UTC)
    index = warc.write_archives(pages, folder, date=date, frame_bytes=2_000)
    places = {r["record_id"]: r for r in index.collect()}
    assert len(places) == 200
    seen = {}
    for path in (tmp_path / "archives").iterdir():
        with path.open("rb") as file:
            reader = warc.BundleReader(file)
            for number in range(len(reader)):
                for headers, block, offset, length in warc.parse_records(reader.frame(number)):
                    place = places[headers["WARC-Record-ID"]]
                    assert (place["bundle"], place["frame"]) == (path.name, number)
                    assert (place["offset"], place["length"]) == (offset, length)
                    assert headers["WARC-Date"] == "2031-02-07T01:02:03Z"
                    assert headers["Content-Type"] == "application/http; msgtype=response"
                    assert int(headers["Content-Length"]) == len(block)
                    assert block.startswith(b"HTTP/1.1 200 OK\r\n")
                    seen[headers["WARC-Record-ID"]] = headers
    for record_id, headers in seen.items():
        page = places[record_id]["page_id"]
        assert headers["WARC-Type"] == ("response" if page < 40 else "revisit")
        if page >= 40:
            # The response's record, which may be in any bundle.
            response = places[headers["WARC-Refers-To"]]
            assert (response["page_id"], response["record_type"]) == (page % 40, "response")
            assert headers["WARC-Profile"].endswith("/revisit/identical-payload-digest")
    for back in (warc.read_records(index, folder), warc.read_archives(index, folder)):
        assert {r["record_id"] for r in back.collect()} == places.keys()
    tasks = warc.read_records(index, folder).select(F.spark_partition_id().alias("task"))
    assert tasks.distinct().count() > 4
    bundles = index.select("bundle").distinct().count()
    whole = warc.read_archives(index, folder).rdd.getNumPartitions()
    assert whole == bundles


def test_tokenizer_files_are_not_in_the_repository():
    from pathlib import Path

    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_BPE
    here = Path(__file__).resolve().parents[2]
    assert not [p for kind in ("*.tiktoken", "*.model") for p in here.rglob(kind)]
