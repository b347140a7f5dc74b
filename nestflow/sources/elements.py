"""Read XML files of any size in splits, whatever stands in them.

Text is read up to each begin of the row tag's closing tag, so Spark cuts files into splits
there. The tasks go through the pieces of a split in order and cut the outermost elements of
the row tag: they may be nested in themselves, and the tag may stand in comments, CDATA and
processing instructions. ``from_xml`` makes the rows of what was cut.

A split begins where the closing tag of an element was cut, so it is taken to begin at least one
level deep. How deep, and whether in a comment or the like, is guessed from its first pieces: where
levels close that it has not opened. Each task writes, with its rows, how each of its splits
began and ended. Where a split turns out to have begun otherwise than taken, as the ends of
those before it tell, its rows are dropped and it is read again, until all agree. Elements that
reach over splits are put together from the ends that the tasks have written; one that has no
end is cut off by the end of its file. Nothing but these ends and the splits' states is
shuffled, and no task holds more of a file than an element.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce
from itertools import count, groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.naming import decoded
from nestflow.functions.paths import quote_path, top
from nestflow.sources.fragments import decoded_text
from nestflow.sources.xml import CORRUPT, SOURCE_FILE, file_path, misfit, text_attributes, typed
from nestflow.workspace import new_folder, ship_library

CONTENT, COMMENT, CDATA, INSTRUCTION = range(4)
_ENDS = {COMMENT: "-->", CDATA: "]]>", INSTRUCTION: "?>"}
_BEGINS = {"<!--": COMMENT, "<![CDATA[": CDATA, "<?": INSTRUCTION}

# What a row of the stage is: an element, an end of one that reaches over splits, or a split.
ELEMENT, HEAD, MIDDLE, TAIL, SPLIT = range(5)

_ATTRIBUTES = r"""(?:\s(?:[^"'<>]|"[^"]*"|'[^']*')*)?"""

BLOCK, PLACE, KIND, TEXT = "element_block", "element_place", "element_kind", "element_text"
#: Splits that one round reads again: their table is broadcast.
MOST_AGAIN = 1_000_000
STATES = ("begin_state", "begin_depth", "end_state", "end_depth", "around", "lowest")
#: Text from which the begin of a split is guessed, and what its pieces are taken to be.
LOOK_AHEAD, MOST_LOOKED_AT = 1 << 20, 4_096
#: Runs of plain pieces that are as quickly cut one by one.
FEW_PLAIN = 16
#: Plain elements that Python hands over in a row: so many, or as many as hold so many bytes.
MOST_TOGETHER, BYTES_TOGETHER = 1_024, 1 << 20
TEXTS = "element_texts"
#: A file in short, while its pieces go to Python and back; of more files the paths go.
FILE, MOST_FILES = "file_number", 20_000
# More levels than any file has.
_DEEP = 1 << 30


class Cutter:
    """Cuts the pieces of one split, given in order."""

    def __init__(self, row_tag: str, ancestors: Mapping[str, tuple[str, str]]):
        name = re.escape(row_tag)
        self.begin_of_end = f"</{row_tag}"
        self._start = re.compile(rf"<{name}{_ATTRIBUTES}>")
        self._close = re.compile(r"\s*>")
        special = r"<!--|<!\[CDATA\[|<\?"
        self._inside = re.compile(rf"{special}|<{name}(?=[\s/>])")
        self._outside = re.compile(rf"{special}|</?[A-Za-z_:][^\s/>]*")
        self._row = f"<{row_tag}"
        self._ancestors = [
            (tag, re.compile(rf"""\s{re.escape(attribute)}\s*=\s*(?:"([^"]*)"|'([^']*)')"""))
            for tag, attribute in ancestors.values()
        ]
        self._any_start = re.compile(rf"{_ATTRIBUTES}>")
        # A piece that ends one element and begins the next, without any other token.
        attributes = _ATTRIBUTES.replace("<>]", "<>/]")
        self._plain_start = rf"^>[^<]*<{name}{attributes}>"

    def guessed(self, pieces: list[str]) -> tuple[int, int]:
        """State and depth that a split seems to begin with, by its first pieces, each after the
        begin of a closing row tag.

        The depth is one at least, and never more than the true one if the state is right.
        """
        text, state = self.begin_of_end.join(pieces), CONTENT
        before_tag = text.split("<", 1)[0]
        # Neither text nor markup may hold the end of CDATA.
        if "]]>" in text.split("<![CDATA[", 1)[0]:
            state = CDATA
        elif "-->" in before_tag:
            state = COMMENT
        elif "?>" in before_tag:
            state = INSTRUCTION
        self.begin(state, _DEEP)
        for piece in pieces:
            for _ in self.feed(piece, True):
                pass
            self._parts.clear()
        return state, max(1, -self.lowest)

    def begin(self, state: int, depth: int) -> None:
        """Before the first piece of a split."""
        self.state, self.depth, self.around = state, depth, 0
        # The least depth against that of the begin, also by closing tags without an element.
        self.lowest, self._level = 0, 0
        self._parts: list[str] = []
        self._open = depth > 0  # what is gathered began in an earlier split
        self.marks: list[str | None] = [None] * len(self._ancestors)
        self._own_marks = list(self.marks)

    def feed(self, piece: str, after_end: bool) -> Iterator[tuple[int, str, list]]:
        """Elements that are complete with this piece, each with the marks around it.

        ``after_end``: the begin of a closing row tag stood before the piece.
        """
        at = begin = 0
        if after_end:
            if self.depth:
                self._parts.append(self.begin_of_end)
            closed = self._close.match(piece) if self.state == CONTENT else None
            if closed:
                self._level -= 1
                if self._level < self.lowest:
                    self.lowest = self._level
            if closed and self.depth:
                at = closed.end()
                self.depth -= 1
                if not self.depth:
                    yield self._done(piece[:at])
                    begin = at
        while True:
            if self.state != CONTENT:
                end = piece.find(_ENDS[self.state], at)
                if end < 0:
                    break
                at = end + len(_ENDS[self.state])
                self.state = CONTENT
            found = (self._inside if self.depth else self._outside).search(piece, at)
            if not found:
                break
            token, at = found[0], found.end()
            if token in _BEGINS:
                self.state = _BEGINS[token]
            elif token == self._row:
                at, empty = self._end_of_start(self._start, piece, found.start())
                if not self.depth:
                    begin = found.start()
                    self._own_marks = list(self.marks)
                    if empty:
                        yield ELEMENT, piece[begin:at], self._own_marks
                if not empty:
                    self.depth += 1
                    self._level += 1
            elif token.startswith("</"):
                self.around -= 1
                self._mark(token, "")
            else:
                start, (at, empty) = at, self._end_of_start(self._any_start, piece, at)
                self.around += not empty
                if not empty:
                    self._mark(token, piece[start:at])
        if self.depth:
            self._parts.append(piece[begin:])

    def plain(self, pieces: pa.Array) -> pa.Array:
        """Which pieces end one element and begin the next, and hold nothing else to look at."""
        try:
            pieces.validate(full=True)
        except pa.ArrowInvalid:  # no UTF-8, which ``feed`` is not given
            return pa.repeat(False, len(pieces))
        one = pc.equal(pc.count_substring(pieces, self._row), 1)
        special = pc.or_(pc.match_substring(pieces, "<!"), pc.match_substring(pieces, "<?"))
        likely = pc.and_not(one, special)
        if (pc.sum(likely).as_py() or 0) < FEW_PLAIN:
            return pa.repeat(False, len(pieces))
        return pc.and_(likely, pc.match_substring_regex(pieces, self._plain_start))

    def feed_all(self, pieces: pa.Array, after_end: bool) -> Iterator[tuple]:
        """What ``feed`` gives of these pieces, with arrays of texts for runs of plain ones;
        ``after_end`` is of the first."""
        at = 0
        for low, high in _true_runs(self.plain(pieces)):
            if high - low < FEW_PLAIN:
                continue
            while at < high and (
                at < low or not after_end or self.state != CONTENT or self.depth != 1
            ):
                yield from self.feed(pieces[at].as_py(), after_end)
                at, after_end = at + 1, True
            if at < high:
                yield from self.feed_plain(pieces.slice(at, high - at))
                at = high
        for piece in pieces.slice(at).to_pylist():
            yield from self.feed(piece, after_end)
            after_end = True

    def feed_plain(self, pieces: pa.Array) -> Iterator[tuple[int, pa.Array, list]]:
        """What ``feed`` gives of plain pieces, all at once; to be called at depth one, in content."""
        yield self._ended_plain()
        bodies = pc.replace_substring_regex(pieces, "^>[^<]*", "")
        if len(bodies) > 1:
            end = pa.scalar(f"{self.begin_of_end}>", bodies.type)
            whole = pc.binary_join_element_wise(bodies[:-1], end, pa.scalar("", bodies.type))
            yield ELEMENT, whole.cast(pa.string()), list(self.marks)
        self._parts, self._own_marks = [bodies[-1].as_py()], list(self.marks)

    def _ended_plain(self) -> tuple[int, pa.Array, list]:
        self.lowest = min(self.lowest, self._level - 1)
        kind, text, marks = self._done(f"{self.begin_of_end}>")
        return kind, pa.array([text], pa.string()), marks

    def end_of_start(self, text: str, at: int) -> int:
        """Where the start tag of the row tag ends that begins there."""
        return self._end_of_start(self._start, text, at)[0]

    @staticmethod
    def _end_of_start(pattern: re.Pattern, piece: str, at: int) -> tuple[int, bool]:
        """Where a start tag ends, and whether it ends its element."""
        match = pattern.match(piece, at)
        # A tag that is no XML, or that the file's end cuts off.
        end = match.end() if match else piece.find(">", at) + 1 or len(piece)
        return end, piece[end - 2 : end] == "/>"

    def _mark(self, token: str, rest: str) -> None:
        for i, (tag, attribute) in enumerate(self._ancestors):
            if token == f"</{tag}":
                self.marks[i] = "/"
            elif token == f"<{tag}":
                value = attribute.search(rest)
                self.marks[i] = f"={(value[1] or value[2] or '') if value else ''}"

    def _done(self, last: str) -> tuple[int, str, list]:
        made = (HEAD if self._open else ELEMENT, "".join([*self._parts, last]), self._own_marks)
        self._parts, self._open = [], False
        return made

    def end(self) -> tuple[int, str, list] | None:
        """What is open after the last piece of a split."""
        if not self.depth:
            return None
        return MIDDLE if self._open else TAIL, "".join(self._parts), self._own_marks


def scan_elements(
    spark: SparkSession,
    paths: str | list[str],
    row_tag: str,
    schema: T.StructType | str,
    *,
    keep_corrupt: bool = False,
    with_file: bool = False,
    with_text: bool = False,
    ancestors: Mapping[str, tuple[str, str]] | None = None,
    ignore_namespace: bool = False,
    recursive: bool = False,
    encoding: str = "UTF-8",
    reader: DataFrameReader | None = None,
    folder: str | None = None,
    of_file: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows of ``scan_xml`` with the same tag and schema, read in splits and written once.

    The scan runs at once, and what is returned reads the rows from ``folder``, or from a new
    folder in the shared one, which is the caller's to delete. ``keep_corrupt`` adds the text of
    each element that does not fit the schema or that its file's end cuts off, ``with_text`` the
    text of every element as ``element_text``. ``ancestors`` maps
    a column name to (tag, attribute) of an element around the rows, null where none is open.
    With ``ignore_namespace`` the schema's names lack prefixes; ``row_tag`` is written as in the
    files. A file that declares another encoding than ``encoding`` stops the job. ``reader`` may
    bring options of the text reader. ``of_file`` adds columns made of ``source_file``, which are
    not computed for each row.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if encoding.upper().startswith(("UTF-16", "UTF-32")):
        raise ValueError(f"{encoding} text cannot be cut at a tag, use scan_xml")
    ancestors = dict(ancestors or {})
    folder = folder or new_folder(spark, "elements")
    of_file = dict(of_file or {})
    rows = _Rows(schema, keep_corrupt, ignore_namespace)
    kept = [*ancestors, *([SOURCE_FILE] if with_file else []), *([TEXT] if with_text else [])]
    kept += of_file
    if not paths:
        strings = ", ".join(f"`{c}` string" for c in {TEXT, SOURCE_FILE, *ancestors})
        none = spark.createDataFrame([], strings).withColumns(of_file)
        none = rows.parsed(none, F.lit(False), kept)
        return none.select(*[top(c) for c in [*rows.names, *kept]])
    with fixed_splits(spark):
        pieces, files = _numbered(_text(spark, paths, row_tag, recursive, reader), encoding)
        staged, states = _agreed(
            pieces, files, row_tag, ancestors, rows, folder, with_text, of_file
        )
    origin = [SOURCE_FILE, BLOCK, *ancestors, *([TEXT] if with_text else []), *of_file]
    whole = staged.filter(F.col(KIND) == ELEMENT).select(*map(top, [*rows.names, *origin]))
    over = _joined(staged.filter(F.col(KIND) != ELEMENT), list(ancestors)).withColumns(of_file)
    made = whole.unionAll(rows.parsed(over, F.col("cut"), origin))
    if ancestors:
        made = _with_ancestors(made, states, list(ancestors), folder)
    return made.select(*[top(c) for c in [*rows.names, *kept]])


class _Rows:
    """How rows are made of elements."""

    def __init__(self, schema: T.StructType, keep_corrupt: bool, ignore_namespace: bool):
        self._schema, self._keep = schema, keep_corrupt
        self._text_schema, self._types = text_attributes(schema)
        self._options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        if ignore_namespace:
            self._options["ignoreNamespace"] = "true"
        self.names = [*schema.names, *([CORRUPT] if keep_corrupt else [])]

    def parsed(self, df: DataFrame, cut: Column, kept: list[str]) -> DataFrame:
        """The schema's columns of the text in ``TEXT``, and the columns kept.

        What is cut off is a corrupt row, as elements are that do not fit.
        """
        text_schema = T.StructType([*self._text_schema.fields]).add(CORRUPT, T.StringType())
        parsed = F.from_xml(F.when(~cut, F.col(TEXT)), text_schema, self._options)
        others = [top(c) for c in kept if c != TEXT]
        df = df.select(parsed.alias("parsed row"), cut.alias("cut off"), TEXT, *others)
        fields = {n: F.col(f"`parsed row`.{quote_path([n])}") for n in self._schema.names}
        made = [
            (typed(c, self._types[n]) if n in self._types else c).alias(n)
            for n, c in fields.items()
        ]
        if self._keep:
            bad = [
                F.when(misfit(fields[n], t).isNotNull(), top(TEXT))
                for n, t in self._types.items()
            ]
            bad = [F.col(f"`parsed row`.{CORRUPT}"), *bad, F.when(top("cut off"), top(TEXT))]
            made.append(F.coalesce(*bad).alias(CORRUPT))
        return df.select(*made, *map(top, kept))


@contextmanager
def fixed_splits(spark: SparkSession) -> Iterator[None]:
    """Files are cut alike each time, also when executors come and go."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    if before is None:
        spark.conf.set(name, spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)


def _text(spark, paths, row_tag, recursive, reader) -> DataFrame:
    reader = (reader or spark.read).option("lineSep", f"</{row_tag}")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.text(paths)


def _pieces(spark, paths, row_tag, recursive, encoding, reader) -> DataFrame:
    """The text up to each begin of a closing tag, with its file and split."""
    text = _text(spark, paths, row_tag, recursive, reader)
    return _with_place(text, encoding, file_path().alias(SOURCE_FILE))


def _with_place(text: DataFrame, encoding: str, file: Column) -> DataFrame:
    block = F.col("_metadata.file_block_start").alias(BLOCK)
    return text.select(decoded_text(encoding).alias("value"), file, block)


def _numbered(text: DataFrame, encoding: str) -> tuple[DataFrame, DataFrame | None]:
    """The pieces with numbers for their files, as a path is longer than most of them, and the
    files of these numbers; the pieces with paths, and none, if files are too many for a broadcast.
    """
    # The files that this very table reads, whatever lands meanwhile.
    paths = text._jdf.inputFiles()
    read = text.select("_metadata.file_path").first() if len(paths) <= MOST_FILES else None
    for spelled in (str, _without_authority):
        names = {spelled(path) for path in paths} if read else {}
        # The list may spell paths otherwise than the rows do.
        if read and read[0] in names:
            files = pa.table({"path": pa.array(sorted(names), pa.string())})
            files = text.sparkSession.createDataFrame(files).select(
                F.xxhash64("path").alias(FILE), decoded(F.col("path")).alias(SOURCE_FILE)
            )
            if len({row[0] for row in files.select(FILE).collect()}) == len(names):
                number = F.xxhash64(F.col("_metadata.file_path")).alias(FILE)
                return _with_place(text, encoding, number), files
    return _with_place(text, encoding, file_path().alias(SOURCE_FILE)), None


def _without_authority(path: str) -> str:
    return re.sub(r"^([A-Za-z][\w+.-]*):///", r"\1:/", path)


def _cut(
    pieces: DataFrame,
    row_tag: str,
    ancestors: Mapping[str, tuple[str, str]],
    of_file: Mapping[str, Column] | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """The elements, ends of elements and states of the splits that the pieces are of.

    ``pieces`` may say how a split begins; else that is guessed, and the first split of a file
    is outside. Plain elements that follow each other share a row between Python and Spark, so
    that the path, and what ``of_file`` makes of it, is not handed over and made for each. With
    ``files`` the pieces have the numbers of these files instead of paths.
    """
    file, file_type = (SOURCE_FILE, pa.string()) if files is None else (FILE, pa.int64())
    if "begin_state" not in pieces.columns:
        none = F.lit(None).cast("int")
        pieces = pieces.withColumns({"begin_state": none, "begin_depth": none})
    pieces = pieces.select("value", file, BLOCK, "begin_state", "begin_depth")
    fields = [
        (TEXTS, pa.list_(pa.string()), "array<string>"),
        (file, file_type, "string" if files is None else "bigint"),
        (BLOCK, pa.int64(), "bigint"),
        (PLACE, pa.int64(), "bigint"),
        (KIND, pa.int32(), "int"),
        *((name, pa.int32(), "int") for name in STATES),
        *((name, pa.string(), "string") for name in ancestors),
    ]
    arrow = pa.schema([(name, kind) for name, kind, _ in fields])
    own_types = [pa.int32(), *(pa.string() for _ in ancestors)]

    def rows(found: list[tuple], split: tuple, place: int) -> pa.RecordBatch:
        """Rows of elements and ends; the texts of a kind may come as an array."""
        parts: list[list[pa.Array]] = []
        for many, run in groupby(found, lambda f: isinstance(f[1], pa.Array)):
            if many:
                for kind, texts, marks in run:
                    texts = _in_arrays(texts)
                    same = zip([kind, *marks], own_types, strict=True)
                    same = [pa.repeat(pa.scalar(v, t), len(texts)) for v, t in same]
                    parts.append([texts, *same])
            else:
                kinds, texts, marks = zip(*run, strict=True)
                own = zip([kinds, *zip(*marks, strict=True)], own_types, strict=True)
                own = [pa.array(v, t) for v, t in own]
                parts.append([pa.array([[text] for text in texts], arrow.types[0]), *own])
        texts, kinds, *marks = (pa.concat_arrays(c) for c in zip(*parts, strict=True))
        count = len(texts)
        at = [pa.repeat(pa.scalar(v, t), count) for v, t in zip(split, arrow.types[1:3], strict=True)]
        places = pa.array(range(place, place + count), pa.int64())
        states = [pa.nulls(count, pa.int32()) for _ in STATES]
        columns = [texts, *at, places, kinds, *states, *marks]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, split, place, began, first = Cutter(row_tag, ancestors), None, 0, (0, 0), False
        left, after = iter(batches), None

        def ended() -> Iterator[pa.RecordBatch]:
            if split is None:
                return
            at = place
            if rest := cutter.end():
                yield rows([rest], split, at)
                at += 1
            states = (*began, cutter.state, cutter.depth, cutter.around, cutter.lowest)
            row = ([None], *split, at + 1, SPLIT, *states, *cutter.marks)
            columns = [pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

        def looked_at(pieces: pa.Array) -> list[str]:
            """The first pieces of the split, from the next batch as well if it has more."""
            nonlocal after
            seen = pieces.slice(0, MOST_LOOKED_AT).to_pylist()
            if len(seen) < MOST_LOOKED_AT and last:
                after = next(left, None) if after is None else after
                if after is not None and after.num_rows:
                    low, high = _runs(after.column(1), after.column(2))[0]
                    if (after.column(1)[low].as_py(), after.column(2)[low].as_py()) == split:
                        more = after.column(0).slice(low, min(high - low, MOST_LOOKED_AT))
                        seen += more.to_pylist()
            size = 0
            for number, piece in enumerate(seen, 1):
                size += len(piece)
                if size > LOOK_AHEAD:
                    return seen[:number]
            return seen

        while (batch := next(left, None) if after is None else after) is not None:
            after = None
            columns = [batch.column(i) for i in range(5)]
            for low, high in _runs(columns[1], columns[2]):
                file, block, state, depth = (c[low].as_py() for c in columns[1:])
                pieces, last = columns[0].slice(low, high - low), high == batch.num_rows
                if (file, block) != split:
                    yield from ended()
                    split, place, first = (file, block), 0, block == 0
                    if depth is not None:
                        began = (state, depth)
                    else:
                        began = (CONTENT, 0) if first else cutter.guessed(looked_at(pieces))
                    cutter.begin(*began)
                found = list(cutter.feed_all(pieces, not first))
                first = False
                if found:
                    made = rows(found, split, place)
                    place += made.num_rows
                    yield made
        yield from ended()

    schema = ", ".join(f"`{name}` {kind}" for name, _, kind in fields)
    ship_library(pieces.sparkSession)
    made = pieces.mapInArrow(cut, schema)
    if files is None:
        made = made.withColumns(dict(of_file or {}))
    else:
        # A join by broadcast keeps the elements in order; a file that it lacks stops the scan.
        made = made.join(F.broadcast(files.withColumns(dict(of_file or {}))), FILE, "left")
        unknown = F.raise_error(F.lit("a file that was not listed")).cast("string")
        made = made.withColumn(SOURCE_FILE, F.coalesce(SOURCE_FILE, unknown))
    others = [c for c in made.columns if c not in (TEXTS, FILE)]
    return made.select(F.explode(TEXTS).alias(TEXT), *map(top, others))


def _in_arrays(texts: pa.Array) -> pa.ListArray:
    """The texts in order, as many in an array as may share a row."""
    longest = pc.max(pc.binary_length(texts)).as_py() or 1
    size = max(1, min(MOST_TOGETHER, BYTES_TOGETHER // longest))
    offsets = [*range(0, len(texts), size), len(texts)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), texts)


def _runs(files: pa.Array, blocks: pa.Array) -> list[tuple[int, int]]:
    """Ranges of rows of one split."""
    edges = [0]
    if len(files) > 1:
        changed = pc.or_(
            pc.not_equal(files[1:], files[:-1]),
            pc.not_equal(blocks[1:], blocks[:-1]),
        )
        edges += [i + 1 for i in pc.indices_nonzero(changed).to_pylist()]
    edges.append(len(files))
    return [(a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a]


def _true_runs(flags: pa.Array) -> list[tuple[int, int]]:
    """Ranges of rows that are true."""
    places = pc.indices_nonzero(flags)
    if not len(places):
        return []
    places = places.cast(pa.int64())
    gaps = pc.indices_nonzero(pc.not_equal(pc.subtract(places[1:], places[:-1]), 1)).to_pylist()
    begins = [0, *(i + 1 for i in gaps)]
    ends = [*(i + 1 for i in gaps), len(places)]
    return [(places[a].as_py(), places[b - 1].as_py() + 1) for a, b in zip(begins, ends)]


def _agreed(
    pieces: DataFrame,
    files: DataFrame | None,
    row_tag: str,
    ancestors: Mapping,
    rows: _Rows,
    folder: str,
    with_text: bool,
    of_file: Mapping[str, Column],
) -> tuple[DataFrame, DataFrame]:
    """Rows and states of all splits, each read as those before it say that it begins."""
    spark = pieces.sparkSession
    at = [SOURCE_FILE, BLOCK]
    kept = [*at, PLACE, KIND, *STATES, *ancestors, *of_file]
    read, again, staged, states = pieces, None, None, None
    for number in count():
        df = _cut(read, row_tag, ancestors, of_file, files)
        element = F.col(KIND) == ELEMENT
        # Else only ends of elements are kept as text.
        kept_text = top(TEXT) if with_text else F.when(~element, top(TEXT))
        df = df.withColumn("end text", kept_text)
        df = df.withColumn(TEXT, F.when(element, top(TEXT)))
        df = rows.parsed(df, F.lit(False), [*kept, "end text"])
        df = df.withColumnRenamed("end text", TEXT)
        df.write.option("compression", "zstd").parquet(f"{folder}/rows-{number}")
        made = spark.read.parquet(f"{folder}/rows-{number}")
        new = made.filter(F.col(KIND) == SPLIT).select(*at, *STATES, *map(top, ancestors))
        made = made.filter(F.col(KIND) != SPLIT)
        if again is None:
            staged, states = made, new
        else:
            staged = staged.join(again, at, "left_anti").select(*map(top, made.columns))
            states = states.join(again, at, "left_anti").select(*map(top, new.columns))
            staged, states = staged.unionAll(made), states.unionAll(new)
        _wrong(states).write.parquet(f"{folder}/again-{number}")
        again = spark.read.parquet(f"{folder}/again-{number}")
        if again.isEmpty():
            return staged, states
        # Of a bounded size; a join by broadcast keeps the pieces in order.
        begins = again if files is None else again.join(F.broadcast(files), SOURCE_FILE)
        key = SOURCE_FILE if files is None else FILE
        begins = begins.select(key, BLOCK, "begin_state", "begin_depth")
        read = pieces.join(F.broadcast(begins), [key, BLOCK])


def _wrong(states: DataFrame) -> DataFrame:
    """Splits that began otherwise than taken, and how, by the ends of those before them.

    At most ``MOST_AGAIN``, from the front of files, where the ends before them are right.
    """
    before = Window.partitionBy(SOURCE_FILE).orderBy(BLOCK)
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    # Closing tags outside of all elements end none, by how a split was taken to begin.
    ignored = F.greatest(F.lit(0), -(F.col("begin_depth") + F.col("lowest")))
    net = F.sum(F.col("end_depth") - F.col("begin_depth") - ignored).over(earlier)
    states = states.withColumn("net", F.coalesce(net, F.lit(0)))
    lowest = F.min(F.col("net") + F.col("lowest")).over(earlier)
    depth = F.col("net") - F.least(F.lit(0), F.coalesce(lowest, F.lit(0)))
    depth = depth.cast("int")
    state = F.coalesce(F.lag("end_state").over(before), F.lit(CONTENT))
    told = states.select(
        SOURCE_FILE, BLOCK, "begin_state", "begin_depth", state.alias("state"), depth.alias("depth")
    )
    wrong = told.filter("begin_state <> state OR begin_depth <> depth")
    wrong = wrong.select(
        SOURCE_FILE, BLOCK, F.col("state").alias("begin_state"), F.col("depth").alias("begin_depth")
    )
    return wrong.orderBy(BLOCK).limit(MOST_AGAIN)


def files_read(spark: SparkSession, folder: str) -> DataFrame:
    """The files that a scan into this folder has read something of: ``source_file``, and
    ``complete``, false where the file ends inside an element."""
    columns = ", ".join(f"{name} int" for name in (KIND, *STATES))
    schema = f"{SOURCE_FILE} string, {BLOCK} bigint, {columns}"
    # Of a split that was read again the last round counts.
    rounds = F.regexp_extract(F.col("_metadata.file_path"), r"/rows-(\d+)/", 1).cast("int")
    states = spark.read.schema(schema).parquet(f"{folder}/rows-*").filter(F.col(KIND) == SPLIT)
    states = states.select(SOURCE_FILE, BLOCK, *STATES, rounds.alias("round"))
    last = F.max_by(F.struct(*STATES), "round").alias("state")
    states = states.groupBy(SOURCE_FILE, BLOCK).agg(last).select(SOURCE_FILE, BLOCK, "state.*")
    end = F.max_by(F.struct("end_state", "end_depth"), BLOCK).alias("end")
    ends = states.groupBy(SOURCE_FILE).agg(end, F.sum("around").alias("around"))
    closed = (F.col("end.end_state") == CONTENT) & (F.col("end.end_depth") == 0)
    return ends.select(SOURCE_FILE, (closed & (F.col("around") <= 0)).alias("complete"))


def tags_named(
    spark: SparkSession,
    paths: str | list[str],
    name: str,
    *,
    recursive: bool = False,
    reader: DataFrameReader | None = None,
) -> list[str]:
    """The tags of this local name, with their prefixes, that begin elements in the files.

    It takes one more pass over the text, without parsing it. Comments count as well, which
    costs a scan for a tag that no element has.
    """
    reader = (reader or spark.read).option("lineSep", name)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    text = reader.text(paths)
    prefix = F.regexp_extract("value", r"<((?:[^\s<>/:!?&]+:)?)\z", 1)
    begins = F.substring_index("value", "<", -1) != F.col("value")
    begins &= F.substring_index("value", "<", -1).rlike(r"\A(?:[^\s<>/:!?&]+:)?\z")
    found = text.filter(begins).select(prefix.alias("prefix")).distinct()
    # Prefixes of one name are few in any one place.
    return sorted(f"{row['prefix']}{name}" for row in found.collect())


def scan_named(
    spark: SparkSession,
    paths: str | list[str],
    name: str,
    schema: T.StructType | str,
    *,
    folder: str | None = None,
    recursive: bool = False,
    reader: DataFrameReader | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """``scan_elements`` of all tags with this local name, whatever their prefix, and the files.

    The schema's names lack prefixes. Files are read once more to find the prefixes, and once
    for each of them, mostly one. The second table is that of ``files_read``.
    """
    folder = folder or new_folder(spark, "elements")
    tags = tags_named(spark, paths, name, recursive=recursive, reader=reader) if paths else []
    rows, files = [], []
    for number, tag in enumerate(tags or [name]):
        at = f"{folder}/{number}"
        options |= {"ignore_namespace": True, "recursive": recursive, "reader": reader}
        rows.append(scan_elements(spark, paths, tag, schema, folder=at, **options))
        if paths:
            files.append(files_read(spark, at))
    none = spark.createDataFrame([], f"{SOURCE_FILE} string, complete boolean")
    read = reduce(DataFrame.unionAll, files, none).groupBy(SOURCE_FILE)
    return reduce(DataFrame.unionAll, rows), read.agg(F.bool_and("complete").alias("complete"))


def _joined(ends: DataFrame, ancestors: list[str]) -> DataFrame:
    """Elements that reach over splits, and whether their file's end cuts them off."""
    order = Window.partitionBy(SOURCE_FILE).orderBy(BLOCK, PLACE)
    number = F.sum(F.when(F.col(KIND) == TAIL, 1).otherwise(0)).over(order)
    part = F.struct(BLOCK, PLACE, KIND, TEXT, *map(top, ancestors))
    parts = ends.select(SOURCE_FILE, part.alias("part"), number.alias("element number"))
    parts = parts.groupBy(SOURCE_FILE, "element number").agg(
        F.sort_array(F.collect_list("part")).alias("parts")
    )
    first = F.element_at("parts", 1)
    return parts.select(
        F.array_join(F.transform("parts", lambda p: p[TEXT]), "").alias(TEXT),
        SOURCE_FILE,
        first[BLOCK].alias(BLOCK),
        *[first.getField(c).alias(c) for c in ancestors],
        (F.element_at("parts", -1)[KIND] != HEAD).alias("cut"),
    )


def _with_ancestors(
    rows: DataFrame, states: DataFrame, columns: list[str], folder: str
) -> DataFrame:
    """The values of what is around the rows, also where it began in an earlier split.

    A row per split of a file that has several is joined to the rows. The table is written, so
    that Spark knows its size.
    """
    before = Window.partitionBy(SOURCE_FILE).orderBy(BLOCK).rowsBetween(
        Window.unboundedPreceding, -1
    )
    heads = [F.last(top(c), ignorenulls=True).over(before).alias(f"head {c}") for c in columns]
    heads = states.select(SOURCE_FILE, BLOCK, *heads)
    heads = heads.filter(F.coalesce(*[top(f"head {c}") for c in columns]).isNotNull())
    heads.write.parquet(f"{folder}/heads")
    heads = rows.sparkSession.read.parquet(f"{folder}/heads")
    made = rows.join(heads, [SOURCE_FILE, BLOCK], "left")
    for c in columns:
        mark = F.coalesce(top(c), top(f"head {c}"))
        made = made.withColumn(
            c, F.when(mark.startswith("="), F.substring(mark, F.lit(2), F.length(mark)))
        )
    return made
