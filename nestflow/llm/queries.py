"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestflow.llm import (
    bpe,
    decontamination,
    lattice,
    licenses,
    line_dedup,
    periodic_runs,
    quality_rules,
    ranked_search,
    sharding,
    simhash,
    token_counts,
    warc,
    weighted_sampling,
)
from nestflow.llm.base import WORD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function under its name, with its SQL if there is any."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query()
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(documents, BYTE_BPE).drop("text")


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(documents, BYTE_BPE, TOKEN_LIMIT).drop("text")


@query(
    """
    WITH split AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
        FROM documents
    ), keyed AS (
        SELECT doc_id, n, line,
               translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM split
    ), frequent AS (
        SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5
    ), marked AS (
        SELECT k.doc_id, n, line, f.key IS NOT NULL AND k.doc_id <> keeper AS dropped
        FROM keyed k LEFT JOIN frequent f ON k.key = f.key
    )
    SELECT doc_id, count(*) AS n_lines,
           CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT dropped), ''))
               AS kept_sha256
    FROM marked GROUP BY doc_id
    """
)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(documents, least_documents=5, shortest=40)
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


_WINDOW = 10


@query(
    rf"""
    WITH word_lists AS (
        SELECT 'd' AS kind, doc_id AS id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
        UNION ALL
        SELECT 'i', item_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
        FROM benchmark
    ), item_windows AS (
        SELECT DISTINCT id AS item_id, size, array_to_string(words[i : i + size - 1], ' ') AS span
        FROM (
            SELECT id, words, least(len(words), {_WINDOW}) AS size,
                   unnest(range(1, len(words) - least(len(words), {_WINDOW}) + 2)) AS i
            FROM word_lists WHERE kind = 'i' AND len(words) > 0
        )
    ), sizes AS (
        SELECT DISTINCT size FROM item_windows
    ), doc_windows AS (
        SELECT id AS doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') AS span
        FROM (
            SELECT id, words, size, unnest(range(1, len(words) - size + 2)) AS i
            FROM word_lists, sizes WHERE kind = 'd' AND len(words) >= size
        )
    ), met AS (
        SELECT doc_id, item_id, d.size, i FROM doc_windows d JOIN item_windows w
        ON d.size = w.size AND d.span = w.span
    ), covered AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM met) GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id
    )
    SELECT id AS doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM word_lists LEFT JOIN covered ON id = covered.doc_id LEFT JOIN named ON id = named.doc_id
    WHERE kind = 'd'
    """
)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    benchmark = table(spark, sf_dir, "benchmark")
    return decontamination.contamination(documents, benchmark, span=_WINDOW).drop("text_key")


@query()
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(documents, shingle=3, distance=3)


@query()
def op3_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return lattice.score_documents(documents, PIECES, checksum % 7 == 2)


@query(
    """
    WITH payloads AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
               sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), firsts AS (
        SELECT payload_digest, min(page_id) AS response FROM payloads
        WHERE payload_bytes >= 100 GROUP BY payload_digest
    )
    SELECT page_id, payload_bytes, p.payload_digest,
           CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN response <> page_id THEN response END AS refers_to
    FROM payloads p LEFT JOIN firsts f ON p.payload_digest = f.payload_digest
        AND payload_bytes >= 100
    """
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.round_trip(pages).drop("url")


@query(
    r"""
    WITH split AS (
        SELECT doc_id, source, coalesce(text, '') AS content,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
        FROM documents
    ), windows AS (
        SELECT doc_id, i, array_to_string(words[i : i + 4], ' ') AS span
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split
              WHERE len(words) >= 5)
    ), again AS (
        SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, span) AS n
                               FROM windows) WHERE n > 1
    ), repeated AS (
        SELECT doc_id, count(DISTINCT place) AS n_repeat_words
        FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM again) GROUP BY doc_id
    ), measured AS (
        SELECT s.doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
               CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(content, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(lines) AS BIGINT) AS n_lines,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM split s LEFT JOIN repeated r ON s.doc_id = r.doc_id
    ), failed AS (
        SELECT *, unnest([
            {'rule': 1, 'fails': n_words < 10, 'severe': n_words < 10},
            {'rule': 2, 'fails': 100 * n_repeat_words > 20 * n_words,
             'severe': 100 * n_repeat_words > 20 * n_words},
            {'rule': 3, 'fails': 100 * n_symbols > 10 * n_words,
             'severe': 100 * n_symbols > 30 * n_words},
            {'rule': 4, 'fails': 100 * n_dup_lines > 30 * n_lines,
             'severe': 100 * n_dup_lines > 60 * n_lines},
            {'rule': 5, 'fails': word_chars < 3 * n_words OR word_chars > 10 * n_words,
             'severe': word_chars < 2 * n_words OR word_chars > 20 * n_words}
        ], recursive := true)
        FROM measured
    ), hosts AS (
        SELECT source, rule, CAST(count(*) AS DOUBLE) AS n,
               CAST(count(*) FILTER (WHERE fails) AS DOUBLE) AS f
        FROM failed GROUP BY source, rule
    ), means AS (
        SELECT rule, count(*) AS k, sum(n) AS n, sum(f) / sum(n) AS m FROM hosts GROUP BY rule
    ), spreads AS (
        SELECT h.rule, k, any_value(m.n) AS n, m, sum(h.n * (f / h.n - m) ** 2) / sum(h.n)
                   - m * (1 - m) * k / any_value(m.n) AS between_hosts
        FROM hosts h JOIN means m ON h.rule = m.rule GROUP BY h.rule, k, m
    ), priors AS (
        SELECT rule, m, least(greatest(CASE WHEN between_hosts > 0
            THEN m * (1 - m) / between_hosts - 1 ELSE 1000 END, 1), 1000) AS weight
        FROM spreads
    ), verdicts AS (
        SELECT source, h.rule, (f + m * weight) / (n + weight) > 0.5 AS bad
        FROM hosts h JOIN priors p ON h.rule = p.rule
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           bool_or(fails AND f.rule <= 2) AS base_failed, bool_or(bad) AS host_rejected,
           NOT bool_or(fails AND (severe OR bad)) AS kept
    FROM failed f JOIN verdicts v
    ON f.rule = v.rule AND f.source IS NOT DISTINCT FROM v.source
    GROUP BY doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    """
)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules.judge(documents)


SHARD_BYTES = 1 << 20


@query(
    f"""
    WITH hashed AS (
        SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
               CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS bits
        FROM documents
    ), prefixes AS (
        SELECT doc_id, n_bytes, bits, depth, bits >> (32 - depth) AS prefix
        FROM hashed, range(0, 33) AS depths(depth)
    ), shards AS (
        SELECT depth, prefix FROM prefixes GROUP BY depth, prefix
        HAVING sum(n_bytes) <= {SHARD_BYTES} OR count(*) = 1
    ), found AS (
        SELECT doc_id, n_bytes, bits, CAST(min(p.depth) AS INTEGER) AS shard_depth
        FROM prefixes p JOIN shards s ON p.depth = s.depth AND p.prefix = s.prefix
        GROUP BY doc_id, n_bytes, bits
    )
    SELECT doc_id, n_bytes, shard_depth, substr(lpad(bin(bits), 32, '0'), 1, shard_depth) AS shard
    FROM found
    """
)
def op2_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.round_trip(documents, SHARD_BYTES)


@query(
    rf"""
    WITH plain AS (
        SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\n]+', ' ', 'g') AS plain
        FROM documents
    ), segments AS (
        SELECT DISTINCT doc_id, trim(regexp_replace(segment, '[ \n]+', ' ', 'g')) AS segment
        FROM (
            SELECT doc_id, unnest(string_split(plain, chr(10))) AS segment FROM plain
            UNION ALL
            SELECT doc_id, unnest(string_split_regex(plain, '\n *\n')) FROM plain
            UNION ALL
            SELECT doc_id, plain FROM plain
        )
    ), templates(name, segment) AS (
        VALUES {
            ", ".join(
                "('{}', '{}')".format(name, " ".join(licenses.plain_words(body)))
                for name, body in licenses.TEMPLATES.items()
            )
        }
    ), listed AS (
        SELECT doc_id, NULL AS name, segment, string_split(segment, ' ') AS words FROM segments
        UNION ALL
        SELECT NULL, name, segment, string_split(segment, ' ') FROM templates
    ), grams AS (
        SELECT doc_id, name, segment, words[i] || ' ' || words[i + 1] AS gram, count(*) AS n,
               any_value(len(words) - 1) AS size
        FROM (SELECT *, unnest(range(1, len(words))) AS i FROM listed)
        GROUP BY doc_id, name, segment, gram
    ), compared AS (
        SELECT d.doc_id, t.name, sum(least(d.n, t.n)) AS shared,
               any_value(d.size + t.size) AS sizes
        FROM grams d JOIN grams t ON d.gram = t.gram
        WHERE d.name IS NULL AND t.name IS NOT NULL
        GROUP BY d.doc_id, t.name, d.segment
    ), places AS (
        SELECT doc_id, i AS place, words[i] || ' ' || words[i + 1] AS gram
        FROM (
            SELECT doc_id, words, unnest(range(1, len(words))) AS i
            FROM (SELECT doc_id, list_filter(string_split(replace(plain, chr(10), ' '), ' '),
                                             lambda w: w <> '') AS words FROM plain)
        )
    ), hits AS (
        SELECT p.doc_id, t.name, place, p.gram, t.n, t.size,
               row_number() OVER (PARTITION BY p.doc_id, t.name, p.gram ORDER BY place) AS nth
        FROM places p JOIN grams t ON p.gram = t.gram WHERE t.name IS NOT NULL
    ), marked AS (
        SELECT h.doc_id, h.name, h.place, h.size, coalesce(e.place, -1) AS before
        FROM hits h LEFT JOIN hits e ON e.doc_id = h.doc_id AND e.name = h.name
            AND e.gram = h.gram AND e.nth = h.nth - h.n
    ), runs AS (
        SELECT s.doc_id, s.name, s.place AS start, h.place AS last,
               h.place - s.place + 1 + s.size AS sizes,
               row_number() OVER (PARTITION BY s.doc_id, s.name, s.place ORDER BY h.place) AS shared
        FROM marked s JOIN marked h ON h.doc_id = s.doc_id AND h.name = s.name
            AND h.place >= s.place AND h.place < s.place + s.size * 3 // 2 AND h.before < s.place
    ), best_runs AS (
        SELECT * FROM (
            SELECT *, max(last) OVER (PARTITION BY doc_id, name, start) AS furthest,
                   row_number() OVER (PARTITION BY doc_id, name, start
                       ORDER BY 2 * shared / CAST(sizes AS DOUBLE) DESC, last DESC) AS rank
            FROM runs WHERE 10 * shared >= 4 * sizes
        ) WHERE rank = 1
    ), holders AS (
        SELECT t.name, o.name AS holder FROM templates t JOIN templates o
        ON t.segment <> o.segment AND contains(' ' || o.segment || ' ', ' ' || t.segment || ' ')
    ), matches AS (
        SELECT doc_id, name, shared, sizes FROM compared WHERE 10 * shared >= 4 * sizes
        UNION ALL
        SELECT doc_id, name, shared, sizes FROM best_runs r
        WHERE NOT EXISTS (
            SELECT 1 FROM best_runs o JOIN holders h ON o.name = h.holder
            WHERE h.name = r.name AND o.doc_id = r.doc_id
                AND o.start <= r.start AND r.last <= o.furthest
        )
    ), best AS (
        SELECT doc_id, name, max(200 * shared // sizes) AS percent FROM matches
        GROUP BY doc_id, name
    )
    SELECT p.doc_id, coalesce(string_agg(name, ',' ORDER BY name), '') AS license_names,
           count(name) AS n_licenses, coalesce(CAST(max(percent) AS BIGINT), 0) AS best_percent
    FROM plain p LEFT JOIN best b ON p.doc_id = b.doc_id GROUP BY p.doc_id
    """
)
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = licenses.scan_licenses(documents)
    names = F.array_join(F.col("licenses")["name"], ",").alias("license_names")
    return scanned.select("doc_id", names, "n_licenses", "best_percent")


def planted(words: F.Column, doc_id: F.Column) -> F.Column:
    """The words, repeated in place from some word on in documents that their id picks."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / period).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(words, a + 1, period), times))
    made = F.concat(F.slice(words, F.lit(1), a), F.slice(cycle, F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), made)


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)
    text = F.array_join(planted(words, F.col("doc_id")), " ")
    documents = documents.withColumn("text", F.coalesce(text, "text"))
    found = periodic_runs.find_runs(documents, shortest=12)
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"),
                (-r["start"]).alias("start"),
                (-r["period"]).alias("period"),
            ),
        )
    )
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"),
    ))
    found = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query()
def op12_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return weighted_sampling.compare_with_next(documents)


@query(
    r"""
    WITH split AS (
        SELECT doc_id, row_number() OVER () AS row,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), items AS (
        SELECT item_id, row_number() OVER () AS item,
               list_distinct(regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS terms
        FROM benchmark
    ), sums AS (
        SELECT CAST(count(*) AS BIGINT) AS documents, CAST(sum(len(terms)) AS BIGINT) AS terms
        FROM split WHERE len(terms) > 0
    ), counted AS (
        SELECT row, doc_id, n, term, count(*) AS tf
        FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM split)
        GROUP BY row, doc_id, n, term
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM counted, sums GROUP BY term, documents
    ), wanted AS (
        SELECT item, item_id, unnest(terms) AS term FROM items
    ), scored AS (
        SELECT item, item_id, row, doc_id,
               CAST(sum(w * ((1000000000 * tf)
                   // (1000 * tf + 8 * (10 + (90 * n * documents) // s.terms)))) AS BIGINT) AS score
        FROM wanted JOIN counted USING (term) JOIN weights USING (term), sums s
        GROUP BY item, item_id, row, doc_id
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank
        FROM scored WHERE score > 0
    ) WHERE rank <= 10
    """
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return ranked_search.ranked(documents, table(spark, sf_dir, "benchmark"), k=10)
