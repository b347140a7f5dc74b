from __future__ import annotations

import gzip
import logging
import random
import time
from datetime import date, datetime
from functools import reduce

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.sources import (
    CORRUPT,
    Landing,
    day_folders,
    files_read,
    infer_schema,
    list_files,
    narrow_schema,
    parse_day,
    scan_elements,
    scan_fragments,
    scan_landing,
    scan_xml,
    split_corrupt,
    tags_named,
)
from nestflow.sources import elements
from nestflow.sources.elements import COMMENT, HEAD, TAIL, Cutter, _wrong
from nestflow.sources.landing import folder_day, window_glob
from tests.conftest import rows

ITEM = "_id int, label string"
ITEMS = '<root><cell id="1"><label>north</label></cell><cell id="2"><label>south</label></cell></root>'


class TestScanXml:
    def test_rows_and_attributes(self, spark, write_text):
        df = scan_xml(spark, write_text("a.xml", ITEMS), "cell", ITEM)
        assert rows(df) == [(1, "north"), (2, "south")]

    def test_default_row_tag(self, spark, write_text):
        text = '<configData><site no="7"><label>north</label></site></configData>'
        df = scan_xml(spark, write_text("a.xml", text))
        assert df.select("site._no", "site.label").collect() == [(7, "north")]

    def test_prefix_belongs_to_the_tag(self, spark, write_text):
        # The prefixes need not be declared.
        text = '<r><xn:cell id="1"><es:label>north</es:label></xn:cell></r>'
        path = write_text("a.xml", text)
        schema = "_id int, `es:label` string"
        assert rows(scan_xml(spark, path, "cell", schema)) == []
        assert rows(scan_xml(spark, path, "xn:cell", schema)) == [(1, "north")]
        assert rows(scan_xml(spark, path, "cell", ITEM, ignore_namespace=True)) == [(1, "north")]

    def test_inference_over_all_files(self, spark, write_text, tmp_path):
        # One file has the element once, the other twice: it is an array in both.
        write_text("x/a.xml", "<r><row><v>1</v></row></r>")
        write_text("x/b.xml", "<r><row><v>2</v><v>3</v></row></r>")
        df = scan_xml(spark, str(tmp_path / "x"), "row")
        assert dict(df.dtypes) == {"v": "array<bigint>"}
        assert rows(df) == [([1],), ([2, 3],)]

    def test_array_schema_reads_an_element_seen_once(self, spark, write_text):
        path = write_text("a.xml", "<r><row><v>1</v></row><row/></r>")
        assert rows(scan_xml(spark, path, "row", "v array<int>")) == [(None,), ([1],)]

    @pytest.mark.parametrize("paths", ["nowhere", "nowhere/{a,b}/*.xml", []])
    def test_no_files(self, spark, tmp_path, paths):
        paths = str(tmp_path / paths) if paths else []
        df = scan_xml(spark, paths, "cell", ITEM, with_file=True, keep_corrupt=True)
        assert df.columns == ["_id", "label", CORRUPT, "source_file"]
        assert df.count() == 0

    def test_one_of_several_paths_missing_is_an_error(self, spark, write_text, tmp_path):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            scan_xml(spark, [write_text("a.xml", ITEMS), str(tmp_path / "none")], "cell", ITEM)

    def test_recursive_and_name_glob(self, spark, write_text, tmp_path):
        write_text("in/a.xml", ITEMS)
        write_text("in/deep/er/b.xml", ITEMS.replace('"', "'"))
        write_text("in/deep/c.txt", ITEMS)
        df = scan_xml(
            spark, str(tmp_path / "in"), "cell", ITEM, recursive=True, name_glob="*.xml"
        )
        assert df.count() == 4

    def test_source_file_is_as_on_disk(self, spark, write_text):
        path = write_text("MIDDLE EAST/a+b %.xml", ITEMS)
        df = scan_xml(spark, path.replace("%", "?"), "cell", ITEM, with_file=True)
        assert {r.source_file for r in df.collect()} == {f"file:{path}"}

    def test_corrupt_records(self, spark, write_text, tmp_path):
        write_text("in/a.xml", '<cell id="1"><label>north</label></cell>')
        write_text("in/b.xml", '<cell id="2"><label>south</label><n>many</n></cell>')
        schema, path = ITEM + ", n int", str(tmp_path / "in")
        stage = str(tmp_path / "stage")
        scan_xml(spark, path, "cell", schema, keep_corrupt=True).write.parquet(stage)
        good, bad = split_corrupt(spark.read.parquet(stage))
        assert rows(good) == [(1, "north", None)]
        assert [(r._id, r.label, r.n) for r in bad.collect()] == [(2, "south", None)]
        assert "<n>many</n>" in bad.collect()[0][CORRUPT]

    @pytest.mark.parametrize(
        "dtype, good, value",
        [
            ("int", " 7 ", 7),
            ("bigint", "99999999999", 99999999999),
            ("double", "1.5e3", 1500.0),
            ("boolean", "true", True),
            ("date", "2031-02-07", date(2031, 2, 7)),
            ("timestamp_ntz", "2031-02-07T01:02:03", datetime(2031, 2, 7, 1, 2, 3)),
        ],
    )
    @pytest.mark.parametrize("scan", [scan_xml, scan_fragments])
    def test_attribute_that_does_not_fit(self, spark, write_text, scan, dtype, good, value):
        text = f'<r><i k="{good}"></i><i k="none"></i><i></i></r>'
        df = scan(spark, write_text("a.xml", text), "i", f"_k {dtype}", keep_corrupt=True)
        assert dict(df.dtypes)["_k"] == dtype
        assert df.collect()[0][0] == value
        assert [(r[0], r[1] is None) for r in df.collect()] == [
            (value, True),
            (None, False),
            (None, True),
        ]

    def test_list_files(self, spark, write_text, tmp_path):
        write_text("in/a b.xml", "12345")
        found = list_files(spark, [str(tmp_path / "in")])
        assert rows(found.drop("modified")) == [(f"file:{tmp_path}/in/a b.xml", 5)]
        assert list_files(spark, []).schema == found.schema


def test_narrow_schema(spark):
    schema = T.StructType.fromDDL(
        "a int, `x:b` struct<c int, d array<struct<e int, f string>>>, g struct<h int>"
    )
    narrow = narrow_schema(schema, ["x:b.d.e", "g"])
    assert narrow == T.StructType.fromDDL("`x:b` struct<d array<struct<e int>>>, g struct<h int>")
    for path in ("none", "a.b", "x:b.none"):
        with pytest.raises(LookupError):
            narrow_schema(schema, [path])


class TestFragments:
    def both(self, spark, path, tag, schema):
        native = scan_xml(spark, path, tag, schema)
        cut = scan_fragments(spark, path, tag, schema)
        assert cut.columns == native.columns
        return rows(native), rows(cut)

    @pytest.mark.parametrize(
        "text",
        [
            ITEMS,
            '<?xml version="1.0"?>\r\n<r>\r\n <cell id="1">\r\n<label>north</label></cell>\r\n</r>',
            '<r><cell id="1"/><cell id="2"><label>south</label></cell><cell id="3" /></r>',
            '<r><cell/><cell></cell><items><cell id="5"><label/></cell></items></r>',
            '<r><itemX id="9"><label>no</label></itemX><cell id="1"><label>north</label></cell></r>',
            "<r><cell id='1' note='a &gt; b'><label>x &lt; y</label></cell></r>",
            '<r><cell note="a > b / c" id="4"><label>north</label></cell></r>',
            '<r><cell\n  id="1"\n><label>é漢</label></cell></r>',
            "<r></r>",
        ],
    )
    def test_same_as_the_native_reader(self, spark, write_text, text):
        native, cut = self.both(spark, write_text("a.xml", text), "cell", ITEM)
        assert cut == native

    @settings(
        max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
    )
    @given(
        st.lists(
            st.tuples(
                st.integers(0, 99),
                st.text(st.characters(codec="utf-8", exclude_categories=["C", "Z"]), max_size=8),
                st.booleans(),
            ),
            max_size=12,
        )
    )
    def test_random_items(self, spark, tmp_path_factory, items):
        from xml.sax.saxutils import escape, quoteattr

        def element(number, text, closed):
            start = f"<xn:cell n={quoteattr(text)} id='{number}'"
            return f"{start}/>" if closed else f"{start}><label>{escape(text)}</label></xn:cell>"

        text = "<r>" + "\n".join(element(*item) for item in items) + "</r>"
        path = tmp_path_factory.mktemp("random") / "a.xml"
        path.write_text(text)
        native, cut = self.both(spark, str(path), "xn:cell", "_id int, _n string, label string")
        assert cut == native
        assert len(cut) == len(items)

    def test_many_tasks_for_one_file(self, spark, write_text):
        text = "".join(f'<cell id="{i}"><label>v{i}</label></cell>\n' for i in range(20_000))
        path = write_text("big.xml", f"<r>{text}</r>")
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        try:
            df = scan_fragments(spark, path, "cell", ITEM)
            assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 8
            assert rows(df) == sorted([(i, f"v{i}") for i in range(20_000)], key=repr)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)

    def test_corrupt_elements_keep_their_own_text(self, spark, write_text):
        text = (
            '<r><cell id="1"><label>north</label></cell><cell id="x"><label>south</label></cell>'
            '<cell id="3"><label>C</cell><cell id="4"><label>D</label></cell></r>'
        )
        df = scan_fragments(spark, write_text("a.xml", text), "cell", ITEM, keep_corrupt=True)
        good, bad = split_corrupt(df)
        assert rows(good) == [(1, "north"), (4, "D")]
        assert {r[CORRUPT] for r in bad.collect()} == {
            '<cell id="x"><label>south</label></cell>',
            '<cell id="3"><label>C</cell>',
        }

    def test_closing_tag_with_white_space(self, spark, write_text):
        path = write_text("a.xml", '<r><i id="1"></i ><i id="2"></i\n\t><ix></ix ><i id="3"></i></r>')
        df = scan_fragments(spark, path, "i", "_id int", keep_corrupt=True)
        assert rows(df) == [(1, None), (2, None), (3, None)]

    def test_encodings(self, spark, tmp_path):
        text = '<?xml version="1.0" encoding="ISO-8859-1"?><r><i><v>é</v></i></r>'
        path = tmp_path / "latin.xml"
        path.write_bytes(text.encode("latin-1"))
        scan = scan_fragments(spark, str(path), "i", "v string")
        with pytest.raises(Exception, match="encoding ISO-8859-1 declared in file:"):
            scan.collect()
        scan = scan_fragments(
            spark, str(path), "i", "v string", encoding="ISO-8859-1", keep_corrupt=True
        )
        assert rows(scan) == [("é", None)]
        with pytest.raises(ValueError, match="cannot be cut"):
            scan_fragments(spark, str(path), "i", "v string", encoding="utf-16")

    def test_prefixes_are_ignored(self, spark, write_text):
        path = write_text("a.xml", '<r><xn:i id="1"><es:v>a</es:v></xn:i></r>')
        df = scan_fragments(spark, path, "xn:i", "_id int, v string", ignore_namespace=True)
        assert rows(df) == [(1, "a")]

    def test_files_in_folders_below(self, spark, write_text, tmp_path):
        for place in ("a.xml", "x/b.xml", "x/y/c.xml"):
            write_text(f"in/{place}", '<r><i id="1"></i></r>')
        df = scan_fragments(spark, str(tmp_path / "in"), "i", "_id int", recursive=True)
        assert df.count() == 3


NESTED = (
    '<r><i id="1"><v>a</v><i id="2"><v>b</v><i id="3"/></i><w>q</w></i><i id="4"><v>c</v></i></r>',
    '<r><!-- <i id="9"><v>x</v></i> --><i id="1"><v>a</v><!-- </i> <i> --><w>z</w></i><i id="2"/></r>',
    '<r><t><![CDATA[<i id="9"></i>]]></t><i id="1"><v><![CDATA[</i><i>]]></v><w>z</w></i></r>',
    '<?x <i id="9"></i> ?><r><i id="1"><?y </i> ?><w>z</w></i></r>',
    '<r><items><itemX/><ix></ix><i id="1"><ix></ix ><w>b</w></i\n></items ><i id=\'2\' n="a > b"/></r>',
    '<r><i id="1"><v>a</v></i><i id="2"><v>b</v>',
    "<r><i></i><i/></r>",
    '<i id="1"><v>a</v></i>',
    "<r></r>",
)
NEST = "_id string, v string, w string, i array<struct<_id string, v string>>"


class TestElements:
    """Elements cut in splits, as Spark's reader finds them in whole files."""

    @pytest.mark.parametrize("text", [*NESTED, ITEMS])
    def test_same_as_the_native_reader(self, spark, write_text, text):
        path = write_text("a.xml", text)
        tag, schema = ("cell", ITEM) if text == ITEMS else ("i", NEST)
        assert rows(scan_elements(spark, path, tag, schema)) == rows(
            scan_xml(spark, path, tag, schema)
        )

    def test_nested_tags_over_many_splits(self, spark, write_text):
        r = random.Random(2)

        def element(number, depth=0):
            parts = [f'<i id="{number}">']
            if r.random() < 0.3:
                parts.append(f"<!-- </i> <i> {'x' * r.randint(0, 3000)} -->")
            parts.append(f"<v>a{number}</v>")
            if r.random() < 0.2:
                parts.append(f"<w><![CDATA[</i><i>{'y' * r.randint(0, 2000)}]]></w>")
            if depth < 3 and r.random() < 0.4:
                parts += [element(1000 * number + k, depth + 1) for k in range(r.randint(1, 6))]
            if r.random() < 0.1:
                parts.append("<?pi </i> ?>")
            return "".join([*parts, f"</i{r.choice(['', ' '])}>"])

        nets = (
            f'<n id="N{k}">{"".join(element(k * 100 + j) for j in range(20))}</n>' for k in range(10)
        )
        text = f"<r>{''.join(nets)}</r>"
        path = write_text("big.xml", text)
        native = rows(scan_xml(spark, path, "i", NEST))
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(text) // 30))
        try:
            found = scan_elements(spark, path, "i", NEST, ancestors={"net": ("n", "id")})
            assert rows(found.drop("net")) == native and len(native) == 200
            assert {r["net"] == f"N{int(r['_id']) // 100}" for r in found.collect()} == {True}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)

    def test_splits_that_begin_inside_of_nested_elements_are_read_once(
        self, spark, write_text, tmp_path
    ):
        def order(n):
            lines = "".join(f'<o id="{k}"><q>{k}.5</q></o>' for k in range(n % 7))
            return (
                f'<!-- an <o> --><o id="{n}"><!-- no </o> --><st>F</st>{lines}'
                f'<t><![CDATA[</o><o id="0">]]></t><?end </o> ?></o{" " * (n % 2)}>\n'
            )

        path = write_text("orders.xml", "".join(map(order, range(2_000))))
        schema = "_id bigint, st string, o array<struct<_id int, q double>>"
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16000")
        try:
            folder = tmp_path / "scan"
            found = scan_elements(spark, path, "o", schema, folder=str(folder))
            got = {r["_id"]: [tuple(o) for o in r["o"] or ()] for r in found.collect()}
            assert got == {n: [(k, k + 0.5) for k in range(n % 7)] for n in range(2_000)}
            assert found.count() == 2_000
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert [f.name for f in folder.glob("rows-*")] == ["rows-0"]

    def test_a_split_that_began_too_high_spoils_no_later_one(self, spark):
        # Each begins two levels deep, was taken to begin one level deep, and ended as it should.
        states = [("f", 0, 0, 0, 0, 2, 0, 0)]
        states += [("f", k, 0, 1, 0, 2, 0, -2) for k in range(1, 6)]
        names = "source_file string, element_block bigint, begin_state int, begin_depth int, "
        names += "end_state int, end_depth int, around int, lowest int"
        wrong = _wrong(spark.createDataFrame(states, names))
        assert rows(wrong) == [("f", k, 0, 2) for k in range(1, 6)]

    def test_plain_pieces_are_cut_at_once(self):
        pieces = pa.array([f'><i id="{k}"><v>{k}</v>' for k in range(1_000)])
        cutter = Cutter("i", {})
        cutter.begin(0, 1)
        found = list(cutter.feed_all(pieces, True))
        assert len(found) < 10
        texts = [t for _, text, _ in found for t in text.to_pylist()]
        assert texts[0] == "</i>"
        assert texts[1:] == [f'<i id="{k}"><v>{k}</v></i>' for k in range(999)]
        assert cutter.end() == (TAIL, '<i id="999"><v>999</v>', [])

    @pytest.mark.parametrize("seed", range(20))
    def test_many_pieces_are_cut_as_one_by_one(self, seed):
        r = random.Random(seed)
        odd = [
            " >", ">", "x>", ' --><i>', '><i id="1"/>', '><i a="/>"><v/>', "><n id='2'><i>", "></n><i>",
            "><i><!-- ", "-->", "><i><![CDATA[", "]]>", "><i><?p ", "?>", '><i id="3"><i>', "><ij><i x='<'>",
            "><i\n>\u00e9", "> text <i>&lt;", "><i b='1' / >", '><i c="2>', "><i\u00a0>",
        ]
        pieces = []
        for _ in range(30):
            pieces += [f'>\n<i id="{k}"><v>{k}</v>' for k in range(r.randint(0, 40))]
            pieces += r.choices(odd, k=r.randint(0, 3))
        results = []
        for at_once in (False, True):
            cutter = Cutter("i", {"net": ("n", "id")})
            cutter.begin(0, r.randint(0, 2) if not at_once else began)
            began, found = cutter.depth, []
            if at_once:
                for kind, text, marks in cutter.feed_all(pa.array(pieces), began > 0):
                    texts = text.to_pylist() if isinstance(text, pa.Array) else [text]
                    found += [(kind, t, list(marks)) for t in texts]
            else:
                for number, piece in enumerate(pieces):
                    found += [(k, t, list(m)) for k, t, m in cutter.feed(piece, number or began > 0)]
            states = cutter.state, cutter.depth, cutter.around, cutter.lowest, cutter.marks
            results.append((found, states, cutter.end()))
        assert results[0] == results[1]

    def test_what_a_file_tells_is_not_computed_for_each_row(self, spark, write_text):
        text = "".join(f'<i id="{k}"><v>{k}</v></i>' for k in range(5_000))
        write_text("in/a.xml", f"<r>{text}</r>")
        path = write_text("in/b.xml", '<r><i id="x"/><i id="9"><v>cut off')
        told = {
            "name": F.substring_index("source_file", "/", -1),
            "number": F.monotonically_increasing_id(),
        }
        df = scan_elements(
            spark, path.rsplit("/", 1)[0], "i", "_id int, v int", keep_corrupt=True, of_file=told
        )
        assert df.columns == ["_id", "v", CORRUPT, "name", "number"]
        found = [(k, k, None, "a.xml") for k in range(5_000)]
        found += [(None, None, '<i id="x"/>', "b.xml")]
        found += [(None, None, '<i id="9"><v>cut off', "b.xml")]
        assert sorted(rows(df.drop("number")), key=repr) == sorted(found, key=repr)
        assert df.select("number").distinct().count() < 50

    def test_pieces_go_to_python_without_their_paths(
        self, spark, write_text, tmp_path, monkeypatch
    ):
        names = ["in/a b%20c.xml", "in/p+q.xml", "in/deep/\u00fc=1,{x}#h.xml", "in/none.xml"]
        for number, name in enumerate(names):
            found = "".join(f'<i id="{number}"><v>{k}</v></i>\n' for k in range(number * 50))
            write_text(name, f"<r>{found}</r>")

        def scan():
            options = {"with_file": True, "recursive": True}
            options["of_file"] = {"n": F.upper(elements.SOURCE_FILE)}
            return rows(scan_elements(spark, f"{tmp_path}/in", "i", "_id int, v int", **options))

        text = elements._text(spark, f"{tmp_path}/in", "i", True, None)
        pieces, files = elements._numbered(text, "UTF-8")
        assert files.count() == 4 and elements.SOURCE_FILE not in pieces.columns
        numbered = scan()
        monkeypatch.setattr(elements, "MOST_FILES", 3)
        assert elements._numbered(text, "UTF-8")[1] is None
        assert numbered == scan()
        assert {(r[0], r[2].rsplit("/", 1)[1]) for r in numbered} == {
            (number, name.rsplit("/", 1)[1]) for number, name in enumerate(names) if number
        }

    def test_cutter_says_how_a_split_ends(self):
        cutter = Cutter("i", {})
        cutter.begin(0, 0)
        assert list(cutter.feed("<r><i><!-- ", False)) == []
        assert (cutter.state, cutter.depth, cutter.end()[0]) == (COMMENT, 1, TAIL)
        cutter.begin(COMMENT, 1)
        found = [*cutter.feed(" --><i>x", True), *cutter.feed(">", True), *cutter.feed(">", True)]
        assert found == [(HEAD, "</i --><i>x</i></i>", [])]
        assert cutter.end() is None

    @pytest.mark.parametrize("loose", ["", " "])
    def test_cut_off_element(self, spark, write_text, tmp_path, loose):
        schema = "_id int, v string"
        twin = f'<i id="3"><v>c</v></i{loose}>'
        write_text("in/whole.xml", f'<r><i id="1"><v>a</v></i{loose}><i id="9"/></r>')
        # The same text as the one that is cut off, whole and before it.
        write_text("in/cut.xml", f'<r>{twin}{twin}<i id="8"/><i id="3"><v>c</v>')
        write_text("in/no-root.xml", '<i id="4"><v>d</v></i>')
        (tmp_path / "in/zip.xml.gz").write_bytes(gzip.compress(b'<i id="5"><v>e</v></i>'))
        folder = str(tmp_path / "stage")
        df = scan_elements(
            spark, str(tmp_path / "in"), "i", schema, keep_corrupt=True, folder=folder
        )
        good, bad = split_corrupt(df)
        assert rows(good) == [(1, "a"), (3, "c"), (3, "c"), (4, "d"), (5, "e"), (8, None), (9, None)]
        assert rows(bad) == [(None, None, '<i id="3"><v>c</v>')]
        ends = {r.source_file.rsplit("/", 1)[1]: r.complete for r in files_read(spark, folder).collect()}
        assert ends == {"whole.xml": True, "cut.xml": False, "no-root.xml": True, "zip.xml.gz": True}

    def test_several_ancestors_in_a_file(self, spark, write_text):
        text = (
            '<n id="1"><i id="1"></i><i id="2"></i ></n><i id="3"></i><n id=""><i id="4"></i></n>'
            '<n id="2"><j/><i id="5"><k>1</k></i></n><names id="9"/><n id="3"></n><i id="6"></i>'
            '<n id="4"><i id="7"/></n><n id="5"><i id="8"/><!-- <n id="6"> --><i id="9"/></n><n/><i id="10"/>'
        )
        path = write_text("a.xml", f"<r>{text}</r>")
        df = scan_elements(spark, path, "i", "_id int", ancestors={"net": ("n", "id")})
        assert df.columns == ["_id", "net"]
        assert dict(rows(df)) == {
            1: "1", 2: "1", 3: None, 4: "", 5: "2", 6: None, 7: "4", 8: "5", 9: "5", 10: None,
        }

    def test_ancestors_go_on_in_the_next_split(self, spark, write_text):
        nets = "".join(
            f'<net id="N{n}">' + "".join(f'<i id="{n * 1000 + k}"></i>' for k in range(700)) + "</net>"
            for n in range(12)
        )
        path = write_text("big.xml", f"<r>{nets}</r>")
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        try:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
            found = scan_elements(spark, path, "i", "_id int", ancestors={"net": ("net", "id")})
            assert rows(found) == sorted(
                ((n * 1000 + k, f"N{n}") for n in range(12) for k in range(700)), key=repr
            )
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)

    def test_very_many_ancestors_in_one_split(self, spark, write_text):
        nets = (f'<n id="{n}"><i id="{2 * n}"/><i id="{2 * n + 1}"></i></n>' for n in range(100_000))
        path = write_text("a.xml", f"<r>{''.join(nets)}</r>")
        start = time.monotonic()
        found = scan_elements(spark, path, "i", "_id int", ancestors={"net": ("n", "id")})
        wrong = found.filter("net IS NULL OR int(net) <> _id div 2")
        assert (found.count(), wrong.count()) == (200_000, 0)
        assert time.monotonic() - start < 20

    def test_no_files(self, spark):
        none = scan_elements(spark, [], "i", ITEM, keep_corrupt=True, ancestors={"n": ("n", "id")})
        assert none.columns == ["_id", "label", CORRUPT, "n"] and none.count() == 0

    def test_other_encoding(self, spark, tmp_path):
        text = '<?xml version="1.0" encoding="ISO-8859-1"?><r><i><v>é</v></i></r>'
        path = tmp_path / "latin.xml"
        path.write_bytes(text.encode("latin-1"))
        with pytest.raises(Exception, match="encoding ISO-8859-1 declared in file:"):
            scan_elements(spark, str(path), "i", "v string")
        found = scan_elements(spark, str(path), "i", "v string", encoding="ISO-8859-1")
        assert rows(found) == [("é",)]

    def test_tags_of_a_local_name(self, spark, write_text, tmp_path):
        write_text("in/a.xml", '<r><xn:i id="1"/><it/></r>')
        write_text("in/b/b.xml", '<r xmlns:y="u"><y:i id="2"></y:i><j>i</j><z:ij/></r>')
        write_text("in/c.xml", '<r><i id="3"/> < i </r>')
        path = str(tmp_path / "in")
        tags = tags_named(spark, path, "i", recursive=True)
        assert {"i", "xn:i", "y:i"} <= set(tags)
        parts = [
            scan_elements(spark, path, tag, "_id int", ignore_namespace=True, recursive=True)
            for tag in tags
        ]
        assert rows(reduce(DataFrame.unionAll, parts)) == [(1,), (2,), (3,)]


INFERRED = (
    '<r><i id="1" d="2031-02-07"><v>1</v><v>2.5</v><t>2031-02-07T10:11:12</t><b>true</b></i>'
    '<i id="x"><b>false</b><e/><s><k>1</k></s></i></r>',
    '<r><i><s><k>1</k></s><s><k>2</k><m>a</m></s></i><i><s><k>3</k></s><n a="1">5</n><n>6</n></i></r>',
    "<r><i><v>99999999999999999999</v><w>1e5</w><x>NaN</x><y>2031-13-45</y></i>"
    "<i><y>2031-01-01</y><w>3</w><z>-0.5</z><z2>007</z2></i></r>",
    '<r><i>text</i><i a="1"/></r>',
    "<r><i><m>a<b>1</b>c</m></i><i><m>z</m></i></r>",
    "<r><i><m>a<b>1</b></m></i><i><!-- <m>x</m> --><m/></i></r>",
    "<r><i><d>2031-01-01</d><ts>2031-01-01 10:00:00</ts><z>2031-01-01T10:00:00Z</z><bo>TRUE</bo></i>"
    "<i><d>2031-01-02T00:00:00</d><bo>1</bo></i></r>",
    "<r><i><a> 5 </a><q>1,000</q><p>12%</p><big>9223372036854775808</big><l>9223372036854775807</l></i></r>",
    '<r><i><n u="m">2031-02-07</n><n u="s">2031-02-08</n><o a="1"><p>1</p></o><o>x</o></i></r>',
    '<r><xn:i xn:a="1"><es:v>a &amp; b</es:v></xn:i><i><w>1.5</w></i></r>',
)


@pytest.mark.parametrize("text", INFERRED)
def test_inference_in_splits_is_that_of_the_reader(spark, write_text, text):
    path = write_text("a.xml", text)
    schema = scan_xml(spark, path, "i").schema
    native = T.StructType([f for f in schema.fields if f.name != CORRUPT])
    assert infer_schema(spark, path, "i") == native


def test_inference_of_a_big_file_in_many_tasks(spark, write_text):
    r = random.Random(4)
    items = []
    for n in range(4_000):
        parts = [f"<v>{r.choice(['', n, n / 4 if n == 3333 else n])}</v>" * r.choice([1, 1, 1, 2 if n > 3900 else 1])]
        parts.append(f"<when>{2000 + n % 30}-0{1 + n % 9}-1{n % 10}</when>")
        parts.append(f'<place code="{n}">{"here" if n == 2000 else ""}</place>')
        r.shuffle(parts)
        items.append(f'<i id="{n}">{"".join(parts)}</i>')
    text = f"<r>{''.join(items)}</r>"
    path = write_text("a.xml", text)
    native = scan_xml(spark, path, "i").schema
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(text) // 20))
    try:
        assert infer_schema(spark, path, "i") == native
        # A split that begins in a comment, and nested tags, are left to the reader.
        odd = write_text("b.xml", f"<r><i><!-- {'</i> ' * 20_000} --><w>1</w><i><u/></i></i>{items[0]}</r>")
        native = scan_xml(spark, odd, "i").schema
        assert infer_schema(spark, odd, "i") == native
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


PREFIXES = {"2G": "im/2G/x", "4G": "im/4G/", "5G": "im/5G"}


@pytest.fixture
def landing(write_text, tmp_path):
    days = {
        "m-US/im/2G/x/year=2024/month=10/day=31": 1,
        "m-US/im/2G/x/year=2024/month=11/day=01": 2,
        "m-US/im/2G/x/year=2024/month=11/day=02": 3,
        "m-US/im/4G/year=2024/month=11/day=01": 4,
        "m-CA/im/4G/year=2025/month=01/day=01": 5,
        "m-CA/im/4G/year=2025/month=01/day=notes": 6,
    }
    for folder, number in days.items():
        write_text(f"{folder}/same.xml", f'<r><cell id="{number}"><label>v</label></cell></r>')
    return Landing(f"{tmp_path}/m-{{}}", PREFIXES)


@pytest.mark.parametrize("split", [True, False], scope="class")
class TestLanding:
    @pytest.fixture(autouse=True)
    def choose(self, split):
        self.split = split

    def scan(self, spark, landing, markets, techs, start, end):
        return scan_landing(
            spark, landing, markets, techs, start, end, "cell", ITEM, split_files=self.split
        )

    def ids(self, *args):
        return [r[0] for r in rows(self.scan(*args).select("_id"))]

    def test_both_ends_are_included(self, spark, landing):
        def between(start, end):
            return self.ids(spark, landing, ["US"], ["2G"], start, end)

        assert between(date(2024, 10, 31), date(2024, 11, 1)) == [1, 2]
        assert between(date(2024, 11, 1), date(2024, 11, 1)) == [2]
        assert between(date(2024, 11, 3), date(2024, 11, 30)) == []
        assert between(date(2024, 11, 2), date(2024, 11, 1)) == []

    def test_all_markets_and_technologies(self, spark, landing):
        args = ["US", "CA", "XX"], ["5G", "4G", "2G"], date(2024, 1, 1), date(2025, 12, 31)
        assert self.ids(spark, landing, *args) == [1, 2, 3, 4, 5]

    def test_origin(self, spark, landing):
        args = ["US", "CA"], ["4G", "2G"], date(2024, 11, 1), date(2025, 1, 1)
        df = self.scan(spark, landing, *args)
        assert rows(df.select("_id", "market", "tech", "year", "month", "day")) == [
            (2, "US", "2G", "2024", "11", "01"),
            (3, "US", "2G", "2024", "11", "02"),
            (4, "US", "4G", "2024", "11", "01"),
            (5, "CA", "4G", "2025", "01", "01"),
        ]

    def test_unknown_technology_is_warned_about(self, spark, landing, caplog):
        with caplog.at_level(logging.WARNING):
            args = ["US"], ["6G", "4G"], date(2024, 11, 1), date(2024, 11, 1)
            assert self.ids(spark, landing, *args) == [4]
        assert "'6G' has no prefix" in caplog.text

    def test_empty_window_has_the_columns(self, spark, landing):
        full = self.scan(spark, landing, ["US"], ["2G"], date(2024, 10, 31), date(2024, 10, 31))
        none = self.scan(spark, landing, ["US"], ["2G"], date(2030, 1, 1), date(2030, 1, 1))
        assert none.dtypes == full.dtypes

    def test_no_double_slash(self, landing):
        assert all("//" not in root for root in landing.roots(["US"], ["4G"]))

    def test_only_the_window_is_listed(self, spark, landing):
        args = ["US"], ["2G"], date(2024, 11, 1), date(2024, 11, 2)
        folders = day_folders(spark, landing, *args)
        assert [f[-len("month=11/day=01") :] for f in folders] == [
            "month=11/day=01",
            "month=11/day=02",
        ]

    def test_globs(self):
        assert window_glob(date(2024, 2, 28), date(2024, 4, 1)) == (
            "year={2024}/month={02,03,04}/day=*"
        )
        assert window_glob(date(2023, 12, 31), date(2024, 1, 1)) == "year={2023,2024}/month=*/day=*"
        assert folder_day("x/year=2024/month=02/day=30") is None
        assert folder_day("x/year=2024/month=02/day=29") == date(2024, 2, 29)


class TestNaming:
    def value(self, spark, column, path):
        return spark.createDataFrame([(path,)], "p string").select(column).collect()[0][0]

    def test_first_prefix_in_order_wins(self, spark):
        from nestflow.functions import tech_of

        tech = tech_of(F.col("p"), {"a": "im/x", "b": "im", "c": "im/x/y/"})
        assert self.value(spark, tech, "gs://b/im/x/y/f.xml") == "a"
        assert self.value(spark, tech, "gs://b/im/z/f.xml") == "b"
        assert self.value(spark, tech, "gs://b/none/f.xml") is None

    @pytest.mark.parametrize(
        "template, path, market",
        [
            ("gs://b-{}-landing", "gs://b-DE-landing/im/f.xml", "DE"),
            ("gs://b-{}-landing", "gs://other/im/f.xml", None),
            ("/data/market={}", "file:/data/market=MIDDLE EAST/f.xml", "MIDDLE EAST"),
            ("gs://one-bucket", "gs://one-bucket/im/f.xml", None),
        ],
    )
    def test_market(self, spark, template, path, market):
        from nestflow.functions import market_of

        assert self.value(spark, market_of(F.col("p"), template), path) == market

    @pytest.mark.parametrize(
        "path, name",
        [
            ("gs://b/a.xml.d/f.xml", "f.parquet"),
            ("gs://b/f.xml.old.xml", "f.xml.old.parquet"),
            ("gs://b/f.txt", "f.txt"),
        ],
    )
    def test_output_name(self, spark, path, name):
        from nestflow.functions import output_name

        assert self.value(spark, output_name(F.col("p")), path) == name


def test_parse_day():
    assert parse_day("20310207") == date(2031, 2, 7)
    for text in ("2031-02-07", "20311340", "2031020", ""):
        with pytest.raises(ValueError):
            parse_day(text)
