from __future__ import annotations

import sys

import pytest

from postloom.functions.text import py_host, site_host, strip
from postloom.operators import describe as D


def test_strip_is_pythons(spark):
    blanks = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]
    rows = [(f"{b}a{b}b{b}{b}",) for b in blanks] + [("",), (None,), ("​a",), ("  ",)]
    for raw, out in spark.createDataFrame(rows, "s string").select("s", strip("s")).collect():
        assert out == (raw.strip() if raw is not None else None)


HOSTS = {"HTTPS://WWW.Foo.example:8443/x?y": "foo.example", " foo.example/": "foo.example", "//a.b": "a.b", "www.karriere.x.example": "karriere.x.example", "": None, "  ": None, None: None, "http://": None, "x.example?ref=1": "x.example"}


@pytest.mark.parametrize("url, host", HOSTS.items())
def test_host(spark, url, host):
    assert py_host(url) == host
    assert spark.createDataFrame([(url,)], "u string").select(site_host("u")).first()[0] == host


def test_line_dedup(spark):
    cases = {"": "", " \n ": None, "a\n a \r\nb b\x1cc": "a\nb\nc", " x\x1c\ny": "x\ny", None: None}
    for raw, out in cases.items():
        got = spark.createDataFrame([(raw,)], "t string").select(D.dedupe_lines("t")).first()[0]
        assert got == out
        if got:
            assert spark.createDataFrame([(got,)], "t string").select(D.dedupe_lines("t")).first()[0] == got


def test_sentences(spark):
    text = "\n".join(["s" * 18 + ".", "s" * 19 + ".", "x" * 98 + ".", "y" * 99 + ".", "z" * 199 + ".", "hos salgs holdet i dag."])
    rows = spark.createDataFrame([(text, "SALG")], "t string, c string").select(D.scored_sentences("t", "c").alias("s")).first()["s"]
    assert [(r["score"], len(r["text"])) for r in rows] == [(0, 20), (0, 99), (1, 100), (2, 200), (1, 23)]


def test_top_and_fallback(spark):
    many = "\n".join(f"sætning nummer {i:02d} er lang nok." for i in range(25))
    df = spark.createDataFrame([(many,), ("kort.",), ("a" * 1600,), ("b" * 58 + ".",), ("b" * 59 + ".",)], "t string")
    out = [r[0] for r in df.select(D.description("t", [D.top_sentences(D.scored_sentences("t", D.F.lit(None).cast("string")))])).collect()]
    lines = out[0].split("\n")
    assert len(lines) == 20 and lines == sorted(lines, reverse=True)
    assert out[1] == "kort." and len(out[2]) == 1600 and len(out[3]) == 59 and len(out[4]) == 60


def test_fallbacks(spark):
    text = "se http://www.jobindex.dk/x og https://systematic.dk https://ærø.example/a.b/c-d!"
    rows = [(None, 200), ("", 200), ("  ", 200), ("x", 200), (None, 404)]
    got = spark.createDataFrame([(v, s, text) for v, s in rows], "v string, s int, t string").select(D.fallback("v", D.first_url("t"), when=D.F.col("s") == 200)).collect()
    assert [r[0] for r in got] == ["https://ærø.example/a.b/c-d"] * 3 + ["x", None]
