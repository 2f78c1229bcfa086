import sys

import pytest
from pyspark.sql import functions as F

from listinglake.functions import text


def values(frame, rows, column, kind="string"):
    data = frame([(r,) for r in rows], f"v {kind}")
    return [r[0] for r in data.select(column(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("<div>Tea <i>and</i> cake &amp; jam,<br>daily</div>", "Tea and cake & jam, daily"),
        ("&amp;lt;x", "&lt;x"),
        ("a < b > c", "a c"),
        ("<>", "<>"),
        ("&lt;b&gt;", "<b>"),
        ("&quot;q&quot; &#39;s&#39;&nbsp;&copy;", "\"q\" 's' &copy;"),
        ("<br/>\n\t", None),
        (None, None),
    ],
)
def test_strip_html(frame, given, wanted):
    assert values(frame, [given], text.strip_html) == [wanted]


def test_clean_text_squeezes_and_nulls_blanks(frame):
    given = ["  a \t\n b  ", "", " \n ", None, "a b"]
    assert values(frame, given, text.clean_text) == ["a b", None, None, None, "a b"]


def test_text_or_empty_strips_like_python(frame):
    given = [" \t x y  \n", "", None, "\x1cz"]
    wanted = ["" if g is None else g.strip() for g in given]
    assert values(frame, given, text.text_or_empty) == wanted
    assert values(frame, [7, None], text.text_or_empty, "bigint") == ["7", ""]


def test_or_else_keeps_white_space(frame):
    data = frame([("", "b"), (None, "b"), ("  ", "b"), ("a", "b")], "x string, y string")
    found = data.select(text.or_else(F.col("x"), F.col("y"))).collect()
    assert [r[0] for r in found] == ["b", "b", "  ", "a"]


def test_contains_any_is_literal_and_lower_case(frame):
    given = ["Database admin", "PYTHON", "chef", None, "d.ta"]
    found = values(frame, given, lambda c: text.contains_any(c, ("data", "python", ".")))
    assert found == [True, True, False, None, True]


def test_fold_equals_casefold_for_every_letter(frame):
    letters = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isprintable()]
    data = frame([(c, f"x{c}Y {c}") for c in letters], "c string, word string")
    found = data.select("c", text.fold(F.col("c")), "word", text.fold(F.col("word"))).collect()
    assert [(r[1], r[3]) for r in found] == [(r[0].casefold(), r[2].casefold()) for r in found]
    assert values(frame, ["ΣΑΣ Straße", None], text.fold) == ["ΣΑΣ Straße".casefold(), None]


def test_keywords_match_in_any_case(frame):
    data = frame([("A PYTHON dev",), ("cook",), (None,)], "title string")
    found = data.where(text.contains_any(F.col("title"), ("Python",))).collect()
    assert [r.title for r in found] == ["A PYTHON dev"]
