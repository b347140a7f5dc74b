"""Find runs: stretches of words that repeat with a period, in place.

Words a lag apart that match form diagonals. A run of period q and at least ``shortest``
words, two periods at least, has at least ``max(shortest - q, q)`` such matches in a row.
Lags are taken in classes whose upper end is twice the lower; the matches that every run of a
class is sure to have give the length of the grams that serve as seeds. Grams are ranked by
doubling, and only places whose shorter gram recurs go on to the longer one, so that the
long classes see few places of an ordinary text.

A gram that comes again within half its length stands in a stretch of that short period.
Such places are one clump. Pairs inside a clump can only be of the clump's own period and
its multiples, so one pair is made for it; of two clumps each lag between them is made once.
Other places of a gram lie at least half a gram apart, so that a place has at most a few
partners within the class. The pairs grow with the words, also in a text of one word a
million times. Sorted by lag, seeds inside what an extension has covered are passed over.

Words of different documents have different numbers, so one pass serves many texts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nestflow.llm.base import blocks, fields, free_name, map_rows, utf8

_RUN = "struct<start:bigint,length:bigint,period:bigint>"


def runs(words: np.ndarray, shortest: int = 12) -> np.ndarray:
    """Rows (start, length, period) of all runs in a sequence of word numbers, by start and
    period.

    A run has the smallest period that its words have, ``shortest`` words and two periods at
    least, and no neighbour that would extend it.
    """
    if shortest < 2:
        raise ValueError("a run has two words at least")
    covered: dict[int, int] = {}
    found: list[tuple[int, int, int]] = []
    gram = (shortest + 1) // 2
    places, ranks = _recurring(np.arange(len(words)), words)
    width = 1
    while width < gram and len(places):
        step = min(width, gram - width)
        places, ranks = _longer(places, ranks, step, len(words))
        width += step
    low = 1
    while len(places):
        high = 2 * gram
        for start, lag in _seeds(places, ranks, gram, low, high):
            if covered.get(lag, 0) >= start + gram:
                continue
            begin, end = _extended(words, start, gram, lag)
            covered[lag] = end
            if end - begin >= max(shortest - lag, lag):
                found.append((begin, end - begin + lag, lag))
        places, ranks = _longer(places, ranks, gram, len(words))
        low, gram = high, 2 * gram
    # A stretch also has the multiples of its period; its smallest is the run's.
    found.sort()
    kept, last = [], None
    for start, length, lag in found:
        if (start, length) != last:
            kept.append((start, length, lag))
        last = (start, length)
    kept.sort(key=lambda run: (run[0], run[2]))
    return np.array(kept, np.int64).reshape(-1, 3)


def _recurring(places: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose value comes more than once, and the values as small numbers."""
    _, ranks, counts = np.unique(values, return_inverse=True, return_counts=True)
    again = counts[ranks] > 1
    return places[again], ranks[again]


def _longer(places, ranks, step: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams that are ``step`` longer: of a gram and the one ``step`` words on."""
    at = np.searchsorted(places, places + step)
    at[at == len(places)] = 0
    both = places[at] == places + step
    pairs = ranks[both] * np.int64(size + 1) + ranks[at[both]]
    return _recurring(places[both], pairs)


def _seeds(
    places: np.ndarray, ranks: np.ndarray, gram: int, low: int, high: int
) -> Iterator[tuple[int, int]]:
    """Places and lags in ``[low, high)`` of pairs of one gram, by lag and place."""
    order = np.argsort(ranks, kind="stable")
    at, rank = places[order], ranks[order]
    gap = np.diff(at)
    joined = (rank[1:] == rank[:-1]) & (gap <= gram // 2)
    first = np.flatnonzero(np.concatenate([[True], ~joined]))
    count = np.diff(np.append(first, len(at)))
    begin, kind = at[first], rank[first]
    last = at[first + count - 1]
    period = np.where(count > 1, gap[np.minimum(first, len(gap) - 1)] if len(gap) else 0, 0)
    own = (count > 1) & (period >= low) & (period < high)
    starts, lags = [begin[own]], [period[own]]
    ahead = 1
    near = np.arange(len(begin) - 1)
    while len(near):
        other = near + ahead
        close = (kind[near] == kind[other]) & (begin[other] - last[near] < high)
        near, other = near[close], other[close]
        step = np.maximum(np.maximum(period[near], period[other]), 1)
        base = begin[other] - begin[near]
        # Lags base + k * step, for k from -(clump's places - 1) to those of the other one.
        least = np.maximum(1 - count[near], -((base - low) // step))
        most = np.minimum(count[other] - 1, (high - 1 - base) // step)
        many = np.maximum(most - least + 1, 0)
        k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(least, many)
        starts.append(np.repeat(begin[near], many) + np.maximum(-k, 0) * np.repeat(step, many))
        lags.append(np.repeat(base, many) + k * np.repeat(step, many))
        ahead += 1
        near = near[near + ahead < len(begin)]
    start, lag = np.concatenate(starts), np.concatenate(lags)
    order = np.lexsort((start, lag))
    start, lag = start[order], lag[order]
    # Seeds that touch the one before them lie in the same row of matches.
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(lag) != 0) | (np.diff(start) > gram)
    return zip(start[new].tolist(), lag[new].tolist(), strict=True)


def _extended(words: np.ndarray, start: int, size: int, lag: int) -> tuple[int, int]:
    """Begin and end of the row of matches with the words ``lag`` on around a seed."""
    end, step = start + size, 16
    while end + lag < len(words):
        stop = min(end + step, len(words) - lag)
        differ = words[end:stop] != words[end + lag : stop + lag]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = stop, 2 * step
    begin, step = start, 16
    while begin > 0:
        stop = max(begin - step, 0)
        differ = (words[stop:begin] != words[stop + lag : begin + lag])[::-1]
        if differ.any():
            begin -= int(differ.argmax())
            break
        begin, step = stop, 2 * step
    return begin, end


def _numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All words, a number for each that differs between documents, and the words of each."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    split = [text.split() for text in texts]
    words = [word for own in split for word in own]
    counts = np.array([len(own) for own in split], np.int64)
    numbers = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    return words, np.repeat(np.arange(len(texts)), counts) * len(known) + numbers, counts


def find_runs(df: DataFrame, shortest: int = 12, text: str = "text") -> DataFrame:
    """The rows with ``n_words``, ``runs`` and ``collapsed_text``, in place of columns of
    these names.

    Words are what stands between ASCII white space, numbered from 0. ``runs`` lists start,
    length and period of each run (see ``runs``) by start, then period; ``collapsed_text`` has
    the words, joined by a space, that no run holds after its first period. Whole texts are
    read, of any length; a null or empty text, or one of white space, has no words, no runs and
    an empty collapsed text. Each row stands for itself, so that repeated rows and ids, nulls
    and other columns change nothing; an empty table gives an empty one.
    """
    made = {"n_words": "bigint", "runs": f"array<{_RUN}>", "collapsed_text": "string"}
    kept = [c for c in df.columns if c.lower() not in made]
    source = free_name(df, "searched_text")
    carried = df.select(*kept, df[text].alias(source))
    schema = ", ".join([*fields(df.select(*kept)), *(f"`{n}` {t}" for n, t in made.items())])
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            texts = utf8(batch.column(source))
            for start, end in blocks(texts):
                words, numbers, counts = _numbered(texts[start:end])
                offsets = np.concatenate([[0], np.cumsum(counts)])
                found = runs(numbers, shortest)
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, found[:, 0] + found[:, 2], 1)
                np.add.at(edges, found[:, 0] + found[:, 1], -1)
                dropped = np.cumsum(edges)[:-1] > 0
                owner = np.searchsorted(offsets, found[:, 0], "right") - 1
                listed: list[list[dict]] = [[] for _ in counts]
                for i, (at, length, period) in zip(owner.tolist(), found.tolist(), strict=True):
                    at -= int(offsets[i])
                    listed[i].append({"start": at, "length": length, "period": period})
                collapsed = []
                for i in range(len(counts)):
                    low, high = int(offsets[i]), int(offsets[i + 1])
                    own = words[low:high]
                    if listed[i]:
                        own = [own[j] for j in np.flatnonzero(~dropped[low:high])]
                    collapsed.append(b" ".join(own).decode())
                part = batch.slice(start, end - start)
                yield {c: part.column(c) for c in kept} | {
                    "n_words": counts,
                    "runs": pa.array(listed, type=run_type),
                    "collapsed_text": collapsed,
                }

        return work

    return map_rows(carried, schema, make)
