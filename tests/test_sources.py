import json

import pytest
from pyspark.sql import functions as F

from foldloom.plans.spec import Converted, CorpusSpec, Delimited, JsonLines
from foldloom.sources.delimited import file_layouts, scan_delimited
from foldloom.sources.inputs import scan_inputs
from foldloom.sources.jsonl import scan_jsonl
from foldloom.operators.dedup import dedup_first, with_order_key

COMMA = Delimited()
ARROW = Delimited("<=>", quoted=False, multiline=False)


@pytest.fixture
def file(tmp_path):
    def write(name, content):
        path = tmp_path / name
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(path)

    return write


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("row_id").select(*columns).collect()]


def test_quoted_fields(spark, file):
    path = file("a.csv", 'id,text,label\n1,"say ""hi"", you",x\n2,"two\nlines",y\n3, padded ,z\n')
    scan = scan_delimited(spark, path, ["text", "label"], COMMA)
    assert rows(scan, "text", "label", "fault") == [
        ('say "hi", you', "x", None), ("two\nlines", "y", None), (" padded ", "z", None)
    ]


def test_short_and_over_long_rows(spark, file):
    path = file("a.csv", 'text,label,more\na,x,1\nb,y\nc\n"d,d",x,1,\n"e,e",x\nf,x,1,2,3\n')
    scan = scan_delimited(spark, path, ["text", "label"], COMMA)
    got = {text: (label, fault) for text, label, fault in rows(scan, "text", "label", "fault")}
    assert got == {
        "a": ("x", None), "b": ("y", None), "c": (None, None), "d,d": ("x", "ragged"), "e,e": ("x", None), "f": ("x", "ragged"),
    }


def test_missing_value_tokens(spark, file):
    path = file("a.csv", 'text,label\n"",1\nNA,2\n"null",3\n#N/A,4\nnone,5\n" NA ",6\nnan,7\n')
    scan = scan_delimited(spark, path, ["text", "label"], COMMA)
    assert [t for t, _ in rows(scan, "text", "label")] == [None, None, None, None, "none", " NA ", None]


def test_arrow_separator(spark, file):
    path = file("a.txt", 'id<=>ementa<=>label\n1<=>a "bare quote<=>yes\n2<=>"b"<=>no\n3<=>c\n4<=>d<=>no<=>x\n5<=>NA<=>no\n')
    scan = scan_delimited(spark, path, ["ementa", "label"], ARROW)
    assert rows(scan, "ementa", "label", "fault") == [
        ('a "bare quote', "yes", None), ('"b"', "no", None), ("c", None, None), ("d", "no", "ragged"), (None, "no", None)
    ]


def test_separator_fallback(spark, file):
    source = Delimited(fallback_sep="\t")
    tabbed = file("a.tsv", "Question\tSubject\nwhat, where\tlaw\n")
    assert [layout.sep for layout in file_layouts(spark, tabbed, ["Question", "Subject"], source)] == ["\t"]
    assert rows(scan_delimited(spark, tabbed, ["Question", "Subject"], source), "Question", "Subject") == [("what, where", "law")]
    assert file_layouts(spark, tabbed, ["Question"], COMMA) is None
    assert scan_delimited(spark, tabbed, ["Question", "Nothing"], source) is None
    assert scan_delimited(spark, tabbed + ".absent", ["Question"], source) is None


@pytest.mark.parametrize("encoding, chosen", [("utf-8", "UTF-8"), ("latin-1", "ISO-8859-1")])
def test_encoding_fallback(spark, file, encoding, chosen):
    source = Delimited(fallback_encoding="ISO-8859-1")
    path = file("a.csv", "review_text,polarity\nação boa,1\n".encode(encoding))
    assert [layout.encoding for layout in file_layouts(spark, path, ["review_text"], source)] == [chosen]
    assert rows(scan_delimited(spark, path, ["review_text"], source), "review_text") == [("ação boa",)]


LATIN = Delimited(fallback_sep="\t", fallback_encoding="ISO-8859-1")


def test_every_file_has_its_own_header_encoding_and_separator(spark, file, tmp_path):
    (tmp_path / "in [1] {a}").mkdir()
    parts = {
        "p0 á.csv": "text,label\nação,a\n".encode(), "p1.csv": "label,other,text\nb,x,mãe\nb,x,\n".encode("latin-1"),
        "p2%20.csv": '"text"\tlabel\n"a\tb, c"\tç\n'.encode(), "p[3].csv": "\ufefflabel,text,text\nc,first,second\n".encode(), "p4.csv": b"",
        "p5.csv": b'\n\n"more\nlines",text,label\nx,deep,d\nx,long,d,e\n', "p6.csv": "rótulo,label,text\nx,e,pão\n".encode("latin-1"),
        "p7.csv": b"text,label\nshort\n", "p8.csv": b"text,label\n",
    }
    for name, content in parts.items():
        (tmp_path / "in [1] {a}" / name).write_bytes(content)
    path = str(tmp_path / "in *")
    scan = scan_delimited(spark, path, ["text", "label"], LATIN)
    got = sorted(map(tuple, scan.select("text", "label", "fault").collect()), key=str)
    assert got == sorted([
        ("ação", "a", None), ("mãe", "b", None), (None, "b", None), ("a\tb, c", "ç", None), ("first", "c", None),
        ("deep", "d", None), ("long", "d", "ragged"), ("pão", "e", None), ("short", None, None),
    ], key=str)
    layouts = file_layouts(spark, path, ["text", "label"], LATIN)
    assert sorted(len(files) for files in layouts.values()) == [1, 1, 1, 1, 1, 3]
    (tmp_path / "in [1] {a}" / "p9.csv").write_text("text,other\nx,y\n")
    assert scan_delimited(spark, path, ["text", "label"], LATIN) is None


def test_files_of_other_layouts_are_not_read(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"p{i}.csv").write_bytes(("text,label\n" if i else "label,text\n").encode() + f"t{i},t{i}\n".encode())
    scan = scan_delimited(spark, str(tmp_path), ["text", "label"], COMMA)
    assert sorted(r.text for r in scan.collect()) == [f"t{i}" for i in range(6)]
    assert scan.rdd.getNumPartitions() <= 6 and len(scan.where("row_id.input_no = 0").select("text").inputFiles()) == 6
    files = scan._jdf.queryExecution().executedPlan().toString()
    assert files.count("FileScan csv") == 2


def test_headers_of_a_single_file(spark, file):
    path = file("a.csv", '"two\nlines",text,label,text\nx,a,b,c\ny,a,b,c,d\n')
    assert rows(scan_delimited(spark, path, ["text", "label"], COMMA), "text", "label", "fault") == [("a", "b", None), ("a", "b", "ragged")]
    assert scan_delimited(spark, file("b.csv", ""), ["text"], COMMA) is None
    assert scan_delimited(spark, file("c.csv", b""), ["text"], LATIN) is None


def test_long_quoted_fields(spark, file):
    """Rows of about a million characters in quotes, sound, short and over-long ones."""
    long = 'a ""b"", c\n' * 90_000
    path = file("a.csv", f'text,label\n"{long}",x\n"{long}"\n"{long}",x,y\n')
    scan = scan_delimited(spark, path, ["text", "label"], COMMA)
    text = long.replace('""', '"')
    assert [(len(t), t == text, label, fault) for t, label, fault in rows(scan, "text", "label", "fault")] == [
        (len(text), True, "x", None), (len(text), True, None, None), (len(text), True, "x", "ragged")
    ]


def test_bad_json_lines(spark, file):
    lines = ['{"t": "a", "l": "x", "z": 1}', "{bad", "", "123", '{"t": "b"}', '{"t": null, "l": "y"}', '{"t": "ção/", "l": "y"}']
    scan = scan_jsonl(spark, file("a.jsonl", "\n".join(lines)), ["t", "l"], JsonLines())
    assert rows(scan, "t", "l", "fault") == [
        ("a", "x", None), (None, None, "bad_line"), (None, None, "bad_line"), ("b", None, None), (None, "y", None), ("ção/", "y", None)
    ]


def test_truthy_json(spark, file):
    values = ["", None, 0, False, [], {}, " ", "x", 5]
    path = file("a.jsonl", "\n".join(json.dumps({"t": v, "l": "y"}) for v in values))
    truthy = [t for t, in rows(scan_jsonl(spark, path, ["t", "l"], JsonLines(truthy=True)), "t")]
    assert truthy == [None] * 6 + [" ", "x", "5"]
    plain = [t for t, in rows(scan_jsonl(spark, path, ["t", "l"], JsonLines()), "t")]
    assert plain[:2] == ["", None] and plain[-3:] == [" ", "x", "5"]


def spec(files, source=COMMA):
    return CorpusSpec("hate", "c", files, "text", "hate", source=source)


def test_inputs_are_joined_in_list_order_and_bad_ones_left_out(spark, file):
    good = [file("z.csv", "text,hate\none,0\ntwo,1\n"), file("a.csv", "hate,text\n0,two\n1,three\n")]
    no_column = file("b.csv", "text,other\nx,0\n")
    ragged = file("c.csv", "text,hate\nx,0\ny,0,0\n")
    absent = good[0] + ".absent"
    files = [absent, good[0], no_column, ragged, good[1]]
    scan = scan_inputs(spark, spec(files), files)
    assert rows(scan, "text", "hate") == [("one", "0"), ("two", "1"), ("two", "0"), ("three", "1")]
    kept = dedup_first(with_order_key(scan))
    assert {(r.text, r.hate) for r in kept.collect()} == {("one", "0"), ("two", "1"), ("three", "1")}
    assert scan_inputs(spark, spec([absent, no_column]), [absent, no_column]) is None


def test_a_single_ragged_input_is_kept_with_its_fault(spark, file):
    path = file("c.csv", "text,hate\nx,0\ny,0,0\n")
    assert rows(scan_inputs(spark, spec([path]), [path]), "text", "fault") == [("x", None), ("y", "ragged")]


def test_converted_input(spark, tmp_path):
    path = str(tmp_path / "c.parquet")
    spark.createDataFrame([("a", 5.0), ("b", None)], "text string, hate double").coalesce(1).write.parquet(path)
    assert rows(scan_inputs(spark, spec([path], Converted()), [path]), "text", "hate", "fault") == [("a", "5.0", None), ("b", None, None)]
    missing = CorpusSpec("hate", "c", [path], "text", "nothing", source=Converted())
    assert scan_inputs(spark, missing, [path]) is None


def test_file_position_orders_blocks_of_one_file(spark, tmp_path):
    path = str(tmp_path / "big.txt")
    with open(path, "w") as out:
        out.write("text\n" + "".join(f"row {i:06d}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        source = Delimited(multiline=False)
        scan = scan_delimited(spark, path, ["text"], source)
        assert scan.select(F.spark_partition_id()).distinct().count() > 4
        assert [t for t, in rows(scan, "text")] == [f"row {i:06d}" for i in range(20000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
