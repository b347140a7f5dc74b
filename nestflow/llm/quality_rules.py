"""Quality rules judged by host: built-in Spark functions only.

Each document is measured and tested by some rules. Failures are summed by host and rule; a
host's rate is shrunk towards the rate of all hosts by a beta prior that is fitted to the
spread between hosts, so that a host of few documents is not judged by chance. A document
that fails a rule is rejected if its host's shrunk rate for that rule is above the limit, or
if it fails beyond the rule's severe limit whatever its host. A document that fails no rule
stays, on any host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestflow.llm.base import SPACE, free_name, settled

#: Words of a window that is looked for again in the same text.
WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Lines with a word: for the rules only, not part of the results.
LINES = "lines_with_words"
RULES = ("short", "repeats", "symbols", "dup_lines", "word_length")


@dataclass(frozen=True)
class Limits:
    """Limits of the rules, in parts of a hundred where they are shares."""

    least_words: int = 10
    repeat_percent: int = 20
    symbol_percent: int = 10
    severe_symbol_percent: int = 30
    dup_line_percent: int = 30
    severe_dup_line_percent: int = 60
    #: Mean code points of a word.
    word_length: tuple[int, int] = (3, 10)
    severe_word_length: tuple[int, int] = (2, 20)
    #: A host's shrunk rate of failures, above which its failing documents go.
    host_rate: float = 0.5


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def _repeated_words(hashes: Column) -> Column:
    """Words inside windows that the text has twice or more, from the words' hashes."""
    count = F.size(hashes)
    places = F.sequence(F.lit(0), count - WINDOW)
    grams = F.transform(
        places, lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(WINDOW)))
    )

    def covered(starts: Column) -> Column:
        # Windows overlap: each adds its words up to the next one's begin.
        steps = F.transform(
            starts,
            lambda start, i: F.coalesce(
                F.least(F.get(starts, i + 1) - start, F.lit(WINDOW)), F.lit(WINDOW)
            ),
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)

    def starts_of(ordered: Column) -> Column:
        same = F.lit(False)
        again = F.filter(
            ordered,
            lambda gram, i: F.coalesce(F.get(ordered, i - 1)["gram"] == gram["gram"], same)
            | F.coalesce(F.get(ordered, i + 1)["gram"] == gram["gram"], same),
        )
        return F.sort_array(F.transform(again, lambda gram: gram["at"]))

    def repeated(grams: Column) -> Column:
        # Few texts have a window twice: the others need no sort.
        numbered = F.transform(grams, lambda gram, i: F.struct(gram.alias("gram"), i.alias("at")))
        within = _let(_let(F.sort_array(numbered), starts_of), covered)
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(within)

    return F.when(count < WINDOW, 0).otherwise(_let(grams, repeated)).cast("bigint")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the columns of ``MEASURES``, and ``LINES``; a null text has no words.

    Words are runs of characters that are no ASCII white space; ``word_chars`` are code
    points in words, ``n_symbols`` characters of ``#*$%&|<>``, ``n_dup_lines`` lines with a
    word that equal an earlier line, ``n_repeat_words`` words inside windows of five words
    that the text has twice or more.
    """
    content, words, hashes, counts = (
        free_name(docs, n) for n in ("content", "words", "hashes", "counts")
    )
    kept = [c for c in docs.columns if c.lower() not in (*MEASURES, LINES)]
    lines = F.filter(F.split(F.col(content), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    line_counts = _let(
        lines,
        lambda some: F.struct(
            F.size(some).alias("n"), F.size(F.array_distinct(some)).alias("d")
        ),
    )
    split = F.filter(F.split(F.col(content), f"{SPACE}+"), lambda word: word != "")
    rows = docs.select(*kept, F.coalesce(docs[text], F.lit("")).alias(content))
    rows = rows.select("*", split.alias(words))
    hashed = F.transform(words, lambda word: F.xxhash64(word))
    rows = rows.select("*", hashed.alias(hashes), line_counts.alias(counts))
    measured = F.struct(
        F.size(words).cast("bigint").alias("n_words"),
        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(content, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.col(counts)["n"] - F.col(counts)["d"]).cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col(hashes)).alias("n_repeat_words"),
        F.col(counts)["n"].cast("bigint").alias(LINES),
    )
    # Exploded, as a filter on a measure would else be moved below, and the measures be made
    # again for each place that names one.
    rows = rows.select(*kept, F.explode(F.array(measured)).alias(content))
    return rows.select(*kept, f"{content}.*")


def _failures(limits: Limits) -> dict[str, tuple[Column, Column]]:
    """For each rule, whether a document fails it, and whether severely."""
    words, chars, lines = F.col("n_words"), F.col("word_chars"), F.col(LINES)
    symbols, dup_lines = 100 * F.col("n_symbols"), 100 * F.col("n_dup_lines")

    def length_outside(bounds: tuple[int, int]) -> Column:
        return (chars < bounds[0] * words) | (chars > bounds[1] * words)

    short = words < limits.least_words
    repeats = 100 * F.col("n_repeat_words") > limits.repeat_percent * words
    return {
        "short": (short, short),
        "repeats": (repeats, repeats),
        "symbols": (
            symbols > limits.symbol_percent * words,
            symbols > limits.severe_symbol_percent * words,
        ),
        "dup_lines": (
            dup_lines > limits.dup_line_percent * lines,
            dup_lines > limits.severe_dup_line_percent * lines,
        ),
        "word_length": (
            length_outside(limits.word_length),
            length_outside(limits.severe_word_length),
        ),
    }


def host_verdicts(measured: DataFrame, host: str, limits: Limits) -> DataFrame:
    """For each host, its documents, failures by rule, and whether it is rejected by rule.

    ``measured`` has the measures; documents whose host is null are a host of their own.
    Columns: ``host``, ``host_docs``, and ``failed_<rule>`` and ``bad_<rule>`` for each rule.
    """
    failures = _failures(limits)
    hosts = measured.groupBy(measured[host].alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"),
        *(F.count_if(fails).alias(f"failed_{rule}") for rule, (fails, _) in failures.items()),
    )
    hosts = settled(hosts, "host-failures")
    docs = F.sum("host_docs").cast("double")
    totals = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        docs.alias("docs"),
        *(F.sum(f"failed_{rule}").alias(rule) for rule in RULES),
    ).first()
    if not totals["hosts"]:
        return hosts.select("*", *(F.lit(False).alias(f"bad_{rule}") for rule in RULES))
    means = {rule: totals[rule] / totals["docs"] for rule in RULES}
    # The spread of the hosts' rates around the mean, each weighted by its documents.
    spreads = hosts.agg(
        *(
            (F.sum(F.pow(F.col(f"failed_{rule}") / F.col("host_docs") - means[rule], F.lit(2))
                   * F.col("host_docs")) / docs).alias(rule)
            for rule in RULES
        )
    ).first()
    bad = []
    for rule in RULES:
        alpha, beta = beta_prior(means[rule], spreads[rule], totals["hosts"], totals["docs"])
        rate = (F.col(f"failed_{rule}") + alpha) / (F.col("host_docs") + alpha + beta)
        bad.append((rate > limits.host_rate).alias(f"bad_{rule}"))
    return settled(hosts.select("*", *bad), "host-verdicts")


def beta_prior(mean: float, spread: float, hosts: int, docs: float) -> tuple[float, float]:
    """Parameters of the beta prior with the hosts' mean rate and the spread between hosts.

    What is left of the spread without chance (binomial variance) gives the prior's weight in
    documents: 1 at least, and 1000 at most, where hosts hardly differ.
    """
    chance = mean * (1 - mean) * hosts / docs
    between = spread - chance
    weight = mean * (1 - mean) / between - 1 if between > 0 else 1000.0
    weight = min(max(weight, 1.0), 1000.0)
    return mean * weight, (1 - mean) * weight


def _judged(measured: DataFrame, host: str, verdicts: DataFrame, limits: Limits) -> DataFrame:
    """The rows with ``base_failed``, ``host_rejected`` and ``kept``."""
    failures = _failures(limits)
    own = free_name(measured, "judged_host")
    joined = measured.join(
        verdicts.withColumnRenamed("host", own), measured[host].eqNullSafe(F.col(own)), "left"
    )
    rejected = F.lit(False)
    by_host = F.lit(False)
    for rule, (fails, severe) in failures.items():
        rejected |= fails & (severe | F.col(f"bad_{rule}"))
        by_host |= F.col(f"bad_{rule}")
    base_failed = failures["short"][0] | failures["repeats"][0]
    return joined.select(
        *measured.columns,
        base_failed.alias("base_failed"),
        by_host.alias("host_rejected"),
        (~rejected).alias("kept"),
    ).drop(LINES)


def judge(
    docs: DataFrame,
    limits: Limits = Limits(),  # noqa: B008
    host: str = "source",
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Measures and verdict of every row, with the columns ``keep`` in place of the text.

    Adds ``MEASURES``, ``base_failed`` (fewer words than ``least_words``, or more of them in
    repeated windows than ``repeat_percent``), ``host_rejected`` (the host is bad by a rule)
    and ``kept``. Null and empty texts have no words and fail. Repeated rows count each time.
    """
    host_name = "host_name"
    while host_name in keep:
        host_name = f"_{host_name}"
    rows = docs.select(*keep, docs[host].alias(host_name), docs[text].alias("judged_text"))
    measured = measures(rows, "judged_text").drop("judged_text")
    measured = settled(measured, "quality-measures")
    verdicts = host_verdicts(measured, host_name, limits)
    return _judged(measured, host_name, verdicts, limits).drop(host_name)


def keep_good(
    docs: DataFrame,
    limits: Limits = Limits(),  # noqa: B008
    host: str = "source",
    text: str = "text",
) -> DataFrame:
    """The documents that are kept, with all their columns.

    Texts are measured once: documents are written with their measures, and read back with the
    hosts' verdicts.
    """
    names = [f"kept_{i}" for i in range(len(docs.columns))]
    columns = dict(zip(docs.columns, names, strict=True))
    measured = settled(measures(docs.toDF(*names), columns[text]), "measured-documents")
    # Parquet reads the host and the measures only.
    verdicts = host_verdicts(measured, columns[host], limits)
    good = _judged(measured, columns[host], verdicts, limits).filter("kept")
    return good.select(*(F.col(n).alias(c) for c, n in columns.items()))
