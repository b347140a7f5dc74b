"""Licence texts and notices in documents: built-in Spark functions only.

A text is put in lower case, with everything but a-z, 0-9 and line ends as one space. Its
lines, its paragraphs, the whole and all runs of its words are segments. A segment matches a
template by the Dice coefficient of their word bigrams, ``2 |A & B| / (|A| + |B|)``, where a
bigram counts as often as it occurs. That can reach the least value only if the sizes are near
each other, so the count of words chooses the candidate templates of a line or paragraph. Nor
can a segment reach it that lacks too many bigrams of a template: for each template some words
are chosen that stand in more of its bigrams than may be lacking, so that a match holds one of
them. A text without any such word is left at once, and so is a template of which the whole
text has too few bigrams. All is worked out within the document's row, without a shuffle.

Of the runs only those are looked at that begin and end with a bigram of the template: without
another one at an end, a run is closer to it. A run that lies within the match of a longer
template with the same words in it is part of that match, and is none of its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestflow.llm.base import free_name
from nestflow.llm.license_templates import TEMPLATES

LEAST_DICE = Fraction(4, 5)


def plain_words(text: str) -> list[str]:
    """Words of a text, normalised."""
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    """Word bigrams of a text; further ones of a kind are numbered."""
    words = plain_words(text)
    seen: Counter[str] = Counter()
    grams = []
    for pair in zip(words, words[1:], strict=False):
        gram = " ".join(pair)
        grams.append(f"{gram} {seen[gram]}" if seen[gram] else gram)
        seen[gram] += 1
    return sorted(grams)


#: Words that tell little, used only where others do not suffice.
COMMON = frozenset(
    "the of to and or a in is this that for by with on as be at any not it its all no from must "
    "may see shall other use used under without including you your have has will are was can "
    "if such which their do does only was were been more than out into general free an but".split()
)


def required_words(text: str, least: Fraction) -> set[str]:
    """Words of a template of which a text must hold one to match it.

    A match of the smallest size shares the fewest bigrams; the words stand in more of the
    template's bigrams than that leaves out.
    """
    grams = [gram.split(" ")[:2] for gram in bigrams(text)]
    smallest = -(-len(grams) * least // (2 - least))
    lacking = len(grams) - -(-least * (smallest + len(grams)) // 2)
    chosen: set[str] = set()
    open_ = list(grams)
    while len(grams) - len(open_) <= lacking:
        counts = Counter(word for gram in open_ for word in set(gram))
        best = min(counts, key=lambda word: (word in COMMON, -counts[word], word))
        chosen.add(best)
        open_ = [gram for gram in open_ if best not in gram]
    return chosen


def _templates(templates: Mapping[str, str], least: Fraction) -> tuple[Column, int, int]:
    """Templates with their bigrams and the sizes that may reach the least value; the least
    and the largest of these sizes."""
    rows, lows, highs = [], [], []
    texts = {name: f" {' '.join(plain_words(text))} " for name, text in templates.items()}
    for name, text in sorted(templates.items()):
        grams = bigrams(text)
        counts = Counter(" ".join(gram.split(" ")[:2]) for gram in grams)
        holders = [o for o in texts if texts[name] in texts[o] and texts[name] != texts[o]]
        if not grams:
            raise ValueError(f"the template {name!r} has less than two words")
        # With a bigrams against b, 2 min(a, b) / (a + b) bounds the coefficient.
        low = -(-len(grams) * least // (2 - least))
        high = len(grams) * (2 - least) // least
        lows.append(int(low))
        highs.append(int(high))
        rows.append(
            F.struct(
                F.lit(name).alias("name"),
                F.lit(int(low)).alias("low"),
                F.lit(int(high)).alias("high"),
                F.array(*map(F.lit, grams)).alias("grams"),
                # Of the distinct bigrams a match holds all but as many as it may lack of all.
                F.lit(int(low) - len(grams) + len(counts)).alias("fewest"),
                F.array(*map(F.lit, counts)).alias("kinds"),
                F.array(*map(F.lit, counts.values())).alias("times"),
                F.array(*map(F.lit, holders)).cast("array<string>").alias("holders"),
            )
        )
    return F.array(*rows), min(lows), max(highs)


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    least: Fraction = LEAST_DICE,
    text: str = "text",
) -> DataFrame:
    """The rows with the licences that their texts hold, as three columns more.

    ``licenses``: for each template that a segment matches with ``least`` or more, a struct of
    ``name`` and ``dice``, the best of all segments, in order of names; ``n_licenses``, their
    number; ``best_percent``, the best coefficient of all in whole per cent, rounded down, 0
    without a match. A null or empty text has none. Columns of these names are replaced;
    others stay.
    """
    added = ("licenses", "n_licenses", "best_percent")
    kept = [c for c in docs.columns if c.lower() not in added]
    candidates, smallest, largest = _templates(templates, least)
    plain, found = free_name(docs, "plain"), free_name(docs, "found")
    normal = F.regexp_replace(F.lower(F.coalesce(docs[text], F.lit(""))), "[^a-z0-9\n]+", " ")
    rows = docs.select(*kept, normal.alias(plain))
    telling = sorted(set().union(*(required_words(t, least) for t in templates.values())))
    telling = rf"(?:^|[ \n])(?:{'|'.join(telling)})(?:$|[ \n])"
    segments = _segments(plain, smallest, largest, telling)
    kinds = sorted({" ".join(g.split(" ")[:2]) for t in templates.values() for g in bigrams(t)})
    none = F.array().cast(_MATCHES)

    def in_grams(grams: Column) -> Column:
        def in_present(present: Column) -> Column:
            def in_near(near: Column) -> Column:
                whole = F.flatten(F.transform(segments, lambda s: _matches(s, near, least)))
                both = F.concat(whole, _runs(grams, present, near, least))
                return F.when(F.size(near) == 0, none).otherwise(both)

            def held(template: Column) -> Column:
                return F.size(F.array_intersect(template["kinds"], present)) >= template["fewest"]

            return _let(F.filter(candidates, held), in_near)

        return _let(F.array_intersect(grams, F.array(*map(F.lit, kinds))), in_present)

    words = F.split(F.trim(F.regexp_replace(F.col(plain), "[ \n]+", " ")), " ")
    matched = _let(_let(words, _pairs), in_grams)
    matched = F.when(F.col(plain).rlike(telling), matched).otherwise(none)
    # Exploded, so that no later expression is merged into this one and works it out again.
    rows = rows.select(*kept, F.explode(F.array(matched)).alias(found))
    names = F.array_sort(F.array_distinct(F.col(found)["name"]))

    def best(name: Column) -> Column:
        own = F.filter(F.col(found), lambda match: match["name"] == name)
        return F.struct(name.alias("name"), F.array_max(own["dice"]).alias("dice"))

    top = F.coalesce(F.array_max(F.col(found)["percent"]), F.lit(0))
    licenses = F.transform(names, best)
    return rows.select(
        *kept,
        licenses.alias("licenses"),
        F.size(names).cast("bigint").alias("n_licenses"),
        top.cast("bigint").alias("best_percent"),
    )


def _segments(plain: str, smallest: int, largest: int, telling: str) -> Column:
    """Distinct segments with a telling word, of as many bigrams as some template may match."""

    def one_line(part: Column) -> Column:
        return F.trim(F.regexp_replace(part, "[ \n]+", " "))

    lines = F.transform(F.split(plain, "\n"), lambda line: F.trim(line))
    larger = F.concat(F.split(plain, "\n *\n"), F.array(F.col(plain)))
    # Without a line end the lines are the paragraphs and the whole.
    several = F.concat(lines, F.transform(larger, one_line))
    every = F.when(F.instr(plain, "\n") > 0, several).otherwise(lines)
    near = F.filter(every, lambda p: _size(p).between(smallest, largest) & p.rlike(telling))
    return F.array_distinct(near)


def _size(segment: Column) -> Column:
    """Bigrams of a segment of single spaces: as many as spaces."""
    return F.length(segment) - F.length(F.replace(segment, F.lit(" "), F.lit("")))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def _matches(segment: Column, candidates: Column, least: Fraction) -> Column:
    """The templates that a segment matches, with the coefficient."""
    size = _size(segment)
    near = F.filter(candidates, lambda t: (size >= t["low"]) & (size <= t["high"]))

    def compared(near: Column) -> Column:
        def all_matches(grams: Column) -> Column:
            return F.filter(F.transform(near, lambda t: match(grams, t)), enough)

        none = F.array().cast(_MATCHES)
        return F.when(F.size(near) == 0, none).otherwise(_let(_grams(segment), all_matches))

    def match(grams: Column, template: Column) -> Column:
        shared = F.size(F.array_intersect(grams, template["grams"]))
        return F.struct(*_compared(shared, F.size(grams), template, least))

    def enough(match: Column) -> Column:
        return match["enough"]

    return _let(near, compared)


_MATCHES = "array<struct<name:string,dice:double,percent:int,enough:boolean>>"


def _compared(shared: Column, size: Column, template: Column, least: Fraction) -> list[Column]:
    """The fields of a match, for so many bigrams of which so many are the template's."""
    twice, both = 2 * shared, size + F.size(template["grams"])
    return [
        template["name"].alias("name"),
        (twice / both).alias("dice"),
        F.floor(100 * twice / both).cast("int").alias("percent"),
        (twice * least.denominator >= both * least.numerator).alias("enough"),
    ]


def _runs(grams: Column, present: Column, near: Column, least: Fraction) -> Column:
    """The templates that runs of words match: for each first bigram the best run."""

    def in_marked(marked: Column) -> Column:
        return F.flatten(F.transform(near, lambda t: _runs_of(marked, t, least)))

    def in_all(found: Column) -> Column:
        def alone(run: Column) -> Column:
            def holds(other: Column) -> Column:
                longer = F.array_contains(run["holders"], other["best"]["name"])
                around = (other["start"] <= run["start"]) & (run["best"]["end"] <= other["last"])
                return longer & around

            return (F.size(run["holders"]) == 0) | ~F.exists(found, holds)

        def match(run: Column) -> Column:
            fields = ("name", "dice", "percent", "enough")
            return F.struct(*(run["best"][c].alias(c) for c in fields))

        return F.transform(F.filter(found, alone), match)

    places = F.transform(grams, lambda gram, i: F.struct(i.alias("at"), gram.alias("gram")))
    marked = F.filter(places, lambda place: F.array_contains(present, place["gram"]))
    return _let(_let(marked, in_marked), in_all)


def _runs_of(marked: Column, template: Column, least: Fraction) -> Column:
    """The runs that match a template: for each first bigram the best one, with its first and
    last place, and the last place of the longest one."""
    low, high = template["low"], template["high"]

    def counted(own: Column) -> Column:
        def place(hit: Column, n: Column) -> Column:
            # As often as the template has the bigram before: from there on this one is too many.
            kind = F.array_position(template["kinds"], hit["gram"]).cast("int")
            nth = F.get(template["times"], kind - 1)
            near = F.slice(own, F.greatest(n + 1 - high, F.lit(1)), F.least(n, high))
            same = F.filter(near, lambda other: other["gram"] == hit["gram"])
            before = _let(same, lambda same: F.get(same, F.size(same) - nth)["at"])
            return F.struct(hit["at"].alias("at"), F.coalesce(before, F.lit(-1)).alias("before"))

        return F.transform(own, place)

    def from_each(hits: Column) -> Column:
        def from_one(hit: Column, n: Column) -> Column:
            end = hit["at"] + high
            ahead = F.filter(
                F.slice(hits, n + 1, high),
                lambda other: (other["at"] < end) & (other["before"] < hit["at"]),
            )

            def run(other: Column, i: Column) -> Column:
                fields = _compared(i + 1, other["at"] - hit["at"] + 1, template, least)
                # The coefficient first, for the greatest.
                return F.struct(fields[1], other["at"].alias("end"), fields[0], *fields[2:])

            def best(runs: Column) -> Column:
                found = F.struct(
                    F.array_max(runs).alias("best"),
                    hit["at"].alias("start"),
                    F.array_max(runs["end"]).alias("last"),
                    template["holders"].alias("holders"),
                )
                return F.when(F.size(runs) > 0, found)

            enough = F.filter(F.transform(ahead, run), lambda run: run["enough"])
            return F.when(F.get(hits, n + low - 1)["at"] < end, _let(enough, best))

        return F.filter(F.transform(hits, from_one), lambda found: found.isNotNull())

    own = F.filter(marked, lambda place: F.array_contains(template["kinds"], place["gram"]))
    return _let(_let(own, counted), from_each)


def _pairs(words: Column) -> Column:
    firsts = F.slice(words, 1, F.size(words) - 1)
    return F.transform(firsts, lambda word, i: F.concat_ws(" ", word, F.get(words, i + 1)))


def _grams(segment: Column) -> Column:
    """Bigrams of a segment; further ones of a kind are numbered."""

    def numbered(sorted_: Column) -> Column:
        def name(gram: Column, i: Column) -> Column:
            nth = i + 1 - F.array_position(sorted_, gram)
            return F.when(nth == 0, gram).otherwise(F.concat_ws(" ", gram, nth.cast("string")))

        return F.transform(sorted_, name)

    def distinct(grams: Column) -> Column:
        alone = F.size(F.array_distinct(grams)) == F.size(grams)
        return F.when(alone, grams).otherwise(_let(F.sort_array(grams), numbered))

    return _let(_let(F.split(segment, " "), _pairs), distinct)
