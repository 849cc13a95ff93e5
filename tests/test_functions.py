import pytest
from pyspark.sql import functions as F

from foldloom.functions.json import is_falsy, kind, truthy_string
from foldloom.functions.labels import mapped, mapped_or_kept, star_polarity
from foldloom.functions.numeric import is_bad_number, to_integer, to_number
from foldloom.functions.text import first_item, is_blank, na_to_null, order_key, strip, title_and_body


def column_of(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_strip_removes_what_python_strips(spark):
    texts = ["\t a \x85", "\xa0", "\x1c", "   ", "", "a  b", " é　", "​x", "\x1f\n\x0bç\r", None]
    assert column_of(spark, texts, strip) == [None if t is None else t.strip() for t in texts]
    assert column_of(spark, texts, is_blank) == [None if t is None else t.strip() == "" for t in texts]


def test_strip_keeps_every_other_character(spark):
    others = [chr(c) for c in range(1, 0x3100) if not chr(c).isspace()]
    assert column_of(spark, ["".join(others)], strip) == ["".join(others)]
    spaces = [chr(c) for c in range(1, 0x3100) if chr(c).isspace()]
    assert column_of(spark, spaces, strip) == [""] * len(spaces)


def test_na_tokens_are_whole_fields(spark):
    values = ["", "NA", "null", "nan", "#N/A", "none", "Null", " NA ", "NA.", None]
    assert column_of(spark, values, na_to_null) == [None] * 5 + ["none", "Null", " NA ", "NA.", None]


def test_title_and_body_keeps_the_space(spark):
    rows = spark.createDataFrame([("t", "b"), (None, "b"), ("t", None), (None, None)], "t string, b string")
    joined = [r[0] for r in rows.select(title_and_body(F.col("t"), F.col("b"))).collect()]
    assert joined == ["t b", " b", "t ", " "]


@pytest.mark.parametrize(
    "value, number, integer, bad",
    [
        ("4.7", 4.7, 4, False),
        (" 5 ", 5.0, 5, False),
        ("-0.5", -0.5, 0, False),
        ("1e0", 1.0, 1, False),
        (".5", 0.5, 0, False),
        ("3", 3.0, 3, False),
        ("5d", None, None, True),
        ("5f", None, None, True),
        ("1,5", None, None, True),
        ("x", None, None, True),
        ("", None, None, True),
        ("inf", float("inf"), None, True),
        ("-Infinity", float("-inf"), None, True),
        (None, None, None, False),
    ],
)
def test_numbers(spark, value, number, integer, bad):
    assert column_of(spark, [value], to_number) == [number]
    assert column_of(spark, [value], lambda v: to_integer(to_number(v))) == [integer]
    assert column_of(spark, [value], is_bad_number) == [bad]


def test_first_item(spark):
    assert column_of(spark, ["a, b", ",b", " a ", "a", "", "á b,c,d"], first_item) == ["a", "", "a", "a", "", "á b"]


def test_labels_are_case_and_accent_exact(spark):
    names = {"saúde": "S", "política": "P"}
    labels = ["saúde", "Saúde", "saude", "política", None]
    assert column_of(spark, labels, lambda c: mapped(c, names)) == ["S", None, None, "P", None]
    assert column_of(spark, labels, lambda c: mapped_or_kept(c, names)) == ["S", "Saúde", "saude", "P", None]


def test_star_polarity(spark):
    stars = [0, 1, 2, 3, 4, 5, 6, None]
    expected = [None, "Negativo", "Negativo", None, "Positivo", "Positivo", None, None]
    assert column_of(spark, stars, star_polarity, "int") == expected


def test_json_truth_is_that_of_python(spark):
    import json

    values = ["x", "", " ", 0, 0.0, 1, -2.5, True, False, None, [], [0], {}, {"a": 1}]
    lines = [json.dumps({"v": v}) for v in values] + ['{"w": 1}']
    get = lambda line: F.try_variant_get(F.try_parse_json(line), "$.v", "variant")
    assert column_of(spark, lines, lambda c: is_falsy(get(c))) == [not v for v in values] + [True]
    strings = column_of(spark, lines, lambda c: truthy_string(get(c)))
    assert strings[:3] == ["x", None, " "] and strings[5] == "1" and strings[-1] is None
    kinds = column_of(spark, lines, lambda c: kind(get(c)))
    assert [k == "STRING" for k in kinds] == [isinstance(v, str) for v in values] + [False]
    assert kinds[-1] == "-"


def test_order_key_is_the_digest_of_seed_and_text(spark):
    import hashlib

    texts = ["a", "ção", ""]
    keys = column_of(spark, texts, lambda c: order_key(c, 42))
    assert [bytes(k) for k in keys] == [hashlib.sha256(f"42|{t}".encode()).digest() for t in texts]
    assert column_of(spark, texts, lambda c: order_key(c, 7)) != keys
