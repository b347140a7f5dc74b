from __future__ import annotations

import pytest

from nestflow import apply_steps
from nestflow.plans import INVENTORY_STEPS, inventory_schema
from nestflow.plans.inventory import (
    CONTAINER_STEPS,
    container_tree,
    deeper_containers,
    me_context_schema,
)
from nestflow.sources import scan_elements, scan_xml
from tests.conftest import rows

# The names of the result.
COLUMNS = [
    "SubNetworkId",
    "MeContextId",
    "ManagedElementId",
    "ParentVsDataContainerId",
    "ParentvsDataSystemFunctions",
    "ParentvsDataFormatVersion",
    "ParentvsDataType",
    "MiddleVsDataContainerId",
    "MiddlevsDataSwInventory",
    "MiddlevsDataFormatVersion",
    "MiddlevsDataType",
    "ChildVsDataContainerId",
    "ChildVsDataType",
    "ChildVsDataFormatVersion",
    "vsDataSwItemAdditionalInfo",
    "vsDataSwItemType",
    "vsDataSwItemDescription",
    "vsDataSwItemProductName",
    "vsDataSwItemProductNumber",
    "vsDataSwItemProductRevision",
    "vsDataSwItemProductDate",
    "vsDataSwItemConsistsOf",
    "vsDataSwItemSwItemId",
    "vsDataSwItemUserLabel",
]


def attributes(first: str, version: str, kind: str) -> str:
    return (
        f"<xn:attributes>{first}<xn:vsDataFormatVersion>{version}</xn:vsDataFormatVersion>"
        f"<xn:vsDataType>{kind}</xn:vsDataType></xn:attributes>"
    )


def container(number: int, *parts: str) -> str:
    return f'<xn:VsDataContainer id="C{number}">{"".join(parts)}</xn:VsDataContainer>'


ITEM = """<es:vsDataSwItem><es:swItemId>7</es:swItemId><es:additionalInfo>info</es:additionalInfo>
    <es:administrativeData><es:type>t</es:type><es:description>d</es:description>
    <es:productName>n</es:productName><es:productNumber>012</es:productNumber>
    <es:productRevision>1.10</es:productRevision>
    <es:productionDate>2031-02-07</es:productionDate></es:administrativeData></es:vsDataSwItem>"""


def network(name: str, *elements: str) -> str:
    return f'<xn:SubNetwork id="{name}">{"".join(elements)}</xn:SubNetwork>'


def exports_of(*networks: str) -> str:
    return f'<xn:configData xmlns:xn="urn:x">{"".join(networks)}</xn:configData>'


def export(*elements: str) -> str:
    return exports_of(network("NET", *elements))


def element(name: str, *containers: str) -> str:
    managed = f'<xn:ManagedElement id="{name}-e">{"".join(containers)}</xn:ManagedElement>'
    return f'<xn:MeContext id="{name}">{managed}</xn:MeContext>'


PARENT = attributes("<es:vsDataSystemFunctions>switch, gate</es:vsDataSystemFunctions>", "1.0", "p")
MIDDLE = attributes(f"<es:vsDataSwInventory>{ITEM}</es:vsDataSwInventory>", "1.1", "m")
FULL = export(
    element(
        "me1",
        container(
            1,
            PARENT,
            container(2, MIDDLE, container(3, attributes(ITEM, "1.2", "c"))),
            container(4, MIDDLE, container(5), container(6, attributes("", "1.3", "c"))),
        ),
    ),
    element("me2", container(7, PARENT)),
)


@pytest.fixture
def flat(spark, write_text):
    exports = scan_xml(spark, write_text("a.xml", FULL), "xn:configData", inventory_schema())
    return apply_steps(exports, INVENTORY_STEPS)


def test_columns(flat):
    assert flat.columns == COLUMNS
    types = dict(flat.dtypes)
    assert types.pop("MiddlevsDataSwInventory").startswith("struct<es:vsDataSwItem:struct<")
    assert set(types.values()) == {"string"}


def test_values(flat):
    out = {r.ChildVsDataContainerId: r.asDict(recursive=True) for r in flat.collect()}
    assert sorted(out) == ["C3", "C5", "C6"]
    inventory = out["C3"].pop("MiddlevsDataSwInventory")
    assert inventory["es:vsDataSwItem"]["es:administrativeData"]["es:productNumber"] == "012"
    assert list(out["C3"].values()) == [
        "NET", "me1", "me1-e", "C1", "switch, gate", "1.0", "p", "C2", "1.1", "m", "C3", "c", "1.2",
        "info", "t", "d", "n", "012", "1.10", "2031-02-07", None, "7", None,
    ]
    assert out["C5"]["MiddleVsDataContainerId"] == "C4"
    assert out["C5"]["ChildVsDataType"] is None
    assert out["C6"]["ChildVsDataFormatVersion"] == "1.3"
    assert out["C6"]["vsDataSwItemSwItemId"] is None


def test_outer_keeps_elements_without_children(spark, write_text):
    exports = scan_xml(spark, write_text("a.xml", FULL), "xn:configData", inventory_schema())
    outer = [s | {"outer": True} if s["operation"] == "explode" else s for s in INVENTORY_STEPS]
    ids = apply_steps(exports, outer).select("MeContextId", "ChildVsDataContainerId")
    assert rows(ids) == [("me1", "C3"), ("me1", "C5"), ("me1", "C6"), ("me2", None)]


def test_inferred_schema_where_everything_occurs_once(spark, write_text):
    # Inference gives structs instead of arrays; explode takes both.
    child = container(3, attributes("", "1", "c"))
    once = export(element("me1", container(1, PARENT, container(2, MIDDLE, child))))
    exports = scan_xml(spark, write_text("a.xml", once), "xn:configData")
    flat = apply_steps(exports, INVENTORY_STEPS)
    assert flat.columns == COLUMNS
    ids = flat.select("SubNetworkId", "MiddleVsDataContainerId", "ChildVsDataContainerId")
    assert rows(ids) == [("NET", "C2", "C3")]


def test_by_fragments(spark, write_text, flat):
    whole = scan_elements(
        spark,
        write_text("b.xml", FULL),
        "xn:MeContext",
        me_context_schema(),
        ancestors={"SubNetworkId": ("xn:SubNetwork", "id")},
    )
    whole = whole.selectExpr("SubNetworkId", "struct(_id, `xn:ManagedElement`) AS MeContext")
    assert rows(apply_steps(whole, CONTAINER_STEPS)) == rows(flat)


CHILD = attributes(ITEM, "1.2", "c")


def branch(number: int) -> str:
    """A parent container with one container on each level."""
    middle = container(number + 1, MIDDLE, container(number + 2, CHILD))
    return container(number, PARENT, middle)


def managed(name: str, *containers: str) -> str:
    return f'<xn:ManagedElement id="{name}">{"".join(containers)}</xn:ManagedElement>'


REPEATED = {
    "sub-networks": (
        exports_of(
            network("N1", element("m1", branch(1))),
            network("N2", element("m2", branch(4)), element("m3", branch(7))),
        ),
        [("N1", "m1-e", "C1", "C3"), ("N2", "m2-e", "C4", "C6"), ("N2", "m3-e", "C7", "C9")],
    ),
    "parents": (
        export(element("m1", branch(1), branch(4))),
        [("NET", "m1-e", "C1", "C3"), ("NET", "m1-e", "C4", "C6")],
    ),
    "managed elements": (
        export(f'<xn:MeContext id="m1">{managed("a", branch(1))}{managed("b", branch(4))}</xn:MeContext>'),
        [("NET", "a", "C1", "C3"), ("NET", "b", "C4", "C6")],
    ),
}
IDS = ["SubNetworkId", "ManagedElementId", "ParentVsDataContainerId", "ChildVsDataContainerId"]


@pytest.mark.parametrize("case", REPEATED)
def test_repeated_elements_stay(spark, write_text, case):
    text, expected = REPEATED[case]
    path = write_text("a.xml", text)
    exports = scan_xml(spark, path, "xn:configData", inventory_schema())
    assert rows(apply_steps(exports, INVENTORY_STEPS).select(IDS)) == expected
    whole = scan_elements(
        spark, path, "xn:MeContext", me_context_schema(),
        ancestors={"SubNetworkId": ("xn:SubNetwork", "id")},
    )
    whole = whole.selectExpr("SubNetworkId", "struct(_id, `xn:ManagedElement`) AS MeContext")
    assert rows(apply_steps(whole, CONTAINER_STEPS).select(IDS)) == expected


def test_deeper_containers_are_told(spark, write_text):
    deep = container(3, CHILD, container(4, CHILD, container(5)), container(6))
    text = export(element("m1", container(1, PARENT, container(2, MIDDLE, deep))))
    path = write_text("a.xml", text)

    def deeper(depth):
        exports = scan_xml(spark, path, "xn:configData", inventory_schema(depth=depth))
        return rows(deeper_containers(exports, depth).select("ChildVsDataContainerId", "deeper"))

    assert deeper(3) == [("C3", 2)]
    assert deeper(4) == [("C4", 1)]
    assert deeper(5) == []
    with pytest.raises(ValueError, match="3 levels"):
        inventory_schema(depth=2)


def test_containers_of_any_depth(spark, write_text, tmp_path):
    """Twelve levels, several children on each, comments between, in many splits."""

    def made(path: tuple[int, ...]) -> str:
        if len(path) == 12:
            return container("".join(map(str, path)))
        below = "".join(made((*path, i)) for i in range(2 if len(path) < 5 else 1))
        return container("".join(map(str, path)), f"<!-- {'x' * 40} </xn:VsDataContainer> -->", below)

    text = export(element("m1", made((1,)), made((2,))), element("m2", made((3,))))
    path = write_text("deep.xml", text)
    want, todo = {}, [((1,), "m1"), ((2,), "m1"), ((3,), "m2")]
    while todo:
        here, owner = todo.pop()
        ids = ["C" + "".join(map(str, here[:n])) for n in range(1, len(here) + 1)]
        want["/".join(ids)] = (owner, len(ids), ids[-2] if len(ids) > 1 else None)
        if len(here) < 12:
            todo += [((*here, i), owner) for i in range(2 if len(here) < 5 else 1)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(text) // 10))
    try:
        found = container_tree(spark, path, {"owner": ("xn:MeContext", "id")})
        assert {r.path: (r.owner, r.level, r.parent) for r in found.collect()} == want
        assert found.count() == len(want) > 250
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    none = container_tree(spark, write_text("none.xml", "<r></r>"), {"owner": ("o", "id")})
    assert none.count() == 0
