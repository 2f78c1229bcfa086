import hashlib
import json

from pyspark.sql import functions as F

from listinglake.functions import variants as V
from listinglake.functions.keys import canonical_id


def model_id(source, native):
    digest = hashlib.sha256(f"{source}:{native}".encode()).digest()
    return int.from_bytes(digest[:8], "big") % 2**63


def test_canonical_ids(frame):
    rows = [("remotive", "7"), ("jobicy", "7"), ("arbeitnow", "ünï-7"), ("", "")]
    rows += [("remotive", str(i)) for i in range(2000)]
    data = frame(rows, "source string, native string")
    found = data.select("*", canonical_id(F.col("source"), F.col("native")).alias("id")).collect()
    assert [r.id for r in found] == [model_id(r.source, r.native) for r in found]
    assert found[0].id == 4320693985432383462
    assert len({r.id for r in found[:3]}) == 3


def members(frame, *documents):
    data = frame([(json.dumps(d),) for d in documents], "v string")
    return data.select(F.parse_json("v").alias("v"))


def test_truthiness_follows_the_json_type(frame):
    given = ["", "  ", "0", 0, 0.0, False, "false", [], {}, "[]", 3, None, ["x"]]
    value = F.col("v")
    truthy = V.is_truthy(V.field(value, "a"), V.kind(value, "a"))
    found = members(frame, *[{"a": g} for g in given]).select(truthy)
    assert [r[0] for r in found.collect()] == [bool(g) for g in given]


def test_first_tag(frame):
    given = [["", " ", " php "], "  sql ", [], None, [" "], 7, [7, "a"]]
    found = members(frame, *[{"tags": g} for g in given]).select(V.first_tag(F.col("v"), "tags"))
    assert [r[0] for r in found.collect()] == ["php", "sql", "", "", "", "7", "7"]


def test_publication_tells_numbers_from_digits(frame):
    given = [1780000000, "1780000000", 1780000000000, 10000000000, " x ", None, 1780000000.9]
    data = members(frame, *[{"at": g} for g in given])
    found = data.select(V.publication(V.member(F.col("v"), "at"))).collect()
    assert [r[0] for r in found] == [
        "2026-05-28T20:26:40",
        "1780000000",
        "2026-05-28T20:26:40",
        "2286-11-20T17:46:40",
        "x",
        "",
        "2026-05-28T20:26:40",
    ]


def test_lists_of_texts_read_as_lists(frame):
    given = [["a", "b's"], "plain", ["x"], "[no list"]
    data = members(frame, *[{"c": g} for g in given])
    found = [r[0] for r in data.select(V.listed_text(F.col("v"), "c", V.field(F.col("v"), "c"))).collect()]
    assert found == [str(g) for g in given]


def test_opened_takes_all_members_at_once(frame):
    data = members(frame, {"a": 1, "b": {"x": [1]}, "c": "t"}, 5, None, [])
    found = data.select(V.opened(F.col("v"), ["a", "b", "none"], ["c"]).alias("o")).select(
        "o.a", "o.b", "o.none", F.schema_of_variant("o.c")
    )
    assert [tuple(r) for r in found.collect()] == [("1", '{"x":[1]}', None, "STRING")] + [(None,) * 4] * 3
