"""Readers and writers with real files."""

import pytest

from fitmill.sources import corpus, files, results
from pyspark.sql import functions as F


def test_csv_round_trip_and_malformed_rows(spark, tmp_path):
    text = 'a "quoted", line\nand é another; it\'s'
    df = spark.createDataFrame([("x", text), ("y", "plain")], "Category string, Resume string")
    corpus.write_csv(df, str(tmp_path / "out"))
    back = corpus.read_csv(spark, str(tmp_path / "out"), clean=True)
    assert {(r.Category, r.Resume) for r in back.collect()} == {("x", text), ("y", "plain")}
    assert "Resume_Cleaned" in back.columns
    for name, head in (("swapped", "Resume,Category"), ("padded", " Resume , Category "), ("more", "Resume,ID,Category")):
        more = "7," if name == "more" else ""
        (tmp_path / f"{name}.csv").write_text(f"{head}\nData,{more}python dev\n")
        for skip in (False, True):
            rows = corpus.read_csv(spark, str(tmp_path / f"{name}.csv"), skip_malformed=skip).collect()
            assert [(r.Category, r.Resume) for r in rows] == [("python dev", "Data")]
    (tmp_path / "both parts").mkdir()
    (tmp_path / "both parts" / "a.csv").write_text("ID,Category,Resume\n1,A,text one\n4,C\n")
    (tmp_path / "both parts" / "b.csv").write_text("Category,Resume,ID\nB,text three,3\nD,much,5,more\n")
    rows = corpus.read_csv(spark, str(tmp_path / "both parts"), skip_malformed=True).collect()
    assert {tuple(r) for r in rows} == {("A", "text one"), ("C", None), ("B", "text three")}
    (tmp_path / "none.csv").write_text("Resume,Kind\na,b\n")
    with pytest.raises(ValueError, match="Category"):
        corpus.read_csv(spark, str(tmp_path / "none.csv"))
    (tmp_path / "bad.csv").write_text("Category , Resume\na,one\nb,two,three,four\nc,five\n")
    kept = corpus.read_csv(spark, str(tmp_path / "bad.csv"), skip_malformed=True)
    assert kept.columns == ["Category", "Resume"] and {r.Resume for r in kept.collect()} == {"one", "five"}


def test_text_files(spark, tmp_path):
    (tmp_path / "a.TXT").write_bytes("café – ok".encode())
    (tmp_path / "b.text").write_bytes("café".encode("latin-1"))
    (tmp_path / "c.pdf").write_bytes(b"%PDF")
    (tmp_path / "d.tar.gz").write_bytes(b"x")
    texts, rest = files.read_texts(spark, str(tmp_path))
    assert {r.path.rsplit("/", 1)[1]: r.text for r in texts.collect()} == {"a.TXT": "café – ok", "b.text": "café"}
    assert {r.path.rsplit("/", 1)[1]: r.reason for r in rest.collect()} == {
        "c.pdf": "no reader for pdf", "d.tar.gz": "unsupported suffix .gz"}
    strict, _ = files.read_texts(spark, str(tmp_path), strict=True)
    assert {r.text for r in strict.collect()} == {"café – ok", None}


def test_suffixes(spark):
    paths = {"a/b.Doc": ".doc", "a/.txt": "", "a/b.": "", "a.txt/b": "", "x.tar.TEXT": ".text", "n": ""}
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r.p: r.s for r in df.select("p", files.suffix(F.col("p")).alias("s")).collect()} == paths


def test_results(spark, tmp_path):
    df = spark.createDataFrame([(1, None, [0.5]), (2, "é\n", [])], "id long, s string, v array<double>")
    results.write_json(df, str(tmp_path / "r"))
    assert sorted(results.read_json(spark, str(tmp_path / "r"), df.schema).collect()) == sorted(df.collect())
    assert results.as_json(df).first().json == '{"id":1,"s":null,"v":[0.5]}'
