"""Cut texts where byte-level BPE never joins what stands on both sides.

The pattern of these tokenizers takes a single space together with what follows it. So a
text can be cut before every space that stands between two characters that are no white
space: the tokens of the parts are the tokens of the text. Each distinct part needs to be
encoded once only.

A long text is cut into segments first, as one without spaces would else be a single part. The
pattern ends a run of letters before a digit, white space or a mark, and a run of digits before
a letter or white space, whatever follows. Only characters are looked at on whose kind all
versions of Unicode agree; ASCII marks are not, as they may begin a special token.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

#: A space beside other white space: the run belongs together.
_RUN = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S)(?= \S)")

_LETTER, _MARK = "A-Za-z\u4e00-\u9fff", "\u3001-\u3003\uff01\uff0c\uff1a\uff1b\uff1f"
_SAFE = re.compile(
    rf"(?<=\S)(?= \S)|(?<=[{_LETTER}])(?=[0-9\n\t{_MARK}])|(?<=[0-9])(?=[{_LETTER}\n\t{_MARK}])"
)
#: Bytes after which a text is cut at the next safe place, counted as four for a character.
SEGMENT_BYTES = 256 << 10

#: Longer parts are encoded again each time, so that the memo's memory is bounded.
LONGEST_KEPT = 64
MOST_KEPT = 600_000


def parts(text: str) -> list[str]:
    """The parts of a text; all but the first lack the space that they begin with."""
    if _RUN.search(text) is None:
        return text.split(" ")
    first, *rest = _CUT.split(text)
    return [first, *(part[1:] for part in rest)]


def segments(text: str, limit: int = SEGMENT_BYTES) -> list[str]:
    """The text in pieces of about ``limit`` bytes whose tokens are the text's tokens; a stretch
    without a safe place stays whole."""
    step, start, made = max(1, limit // 4), 0, []
    while len(text) - start > step and (cut := _SAFE.search(text, start + step)):
        made.append(text[start : cut.start()])
        start = cut.start()
    return [*made, text[start:]]


def split(texts: list[str], limit: int = SEGMENT_BYTES) -> tuple[list[list[str]], list[int]]:
    """The parts of all segments of the texts, and how many segments each text has."""
    cut = [segments(text, limit) for text in texts]
    return [parts(segment) for own in cut for segment in own], [len(own) for own in cut]


class Memo:
    """Values of parts, made for many new parts at a time.

    ``make`` gets distinct texts and returns their values. The memo is emptied when it is
    full, which changes no value.
    """

    def __init__(self, make: Callable[[list[str]], Iterable], most: int = MOST_KEPT):
        self._make, self._most, self._known = make, most, {}

    def of(self, split: list[list[str]]) -> list[Iterable]:
        """For each list of parts, an iterator over their values."""
        known = self._known
        firsts = {text[0] for text in split}
        rest = set().union(*(text[1:] for text in split))
        # The first part of a text has no space before it: it is kept as a tuple.
        new = [part for part in rest if part not in known]
        new_firsts = [part for part in firsts if (part,) not in known]
        if len(known) + len(new) > self._most:
            known.clear()
            new, new_firsts = list(rest), list(firsts)
        made = self._make([" " + part for part in new] + new_firsts)
        known.update(zip(new + [(part,) for part in new_firsts], made, strict=True))
        get = known.__getitem__
        values = [[known[(text[0],)], *map(get, text[1:])] for text in split]
        for part in new:
            if len(part) > LONGEST_KEPT:
                del known[part]
        for part in new_firsts:
            del known[(part,)]
        return values
