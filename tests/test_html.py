"""HTML to text: what it keeps, and that time grows with the text."""

import re
import time

import pytest
from pyspark.sql import functions as F

from mailtriage.functions import text as X

MARK = "\x01"


def plain(html):
    """The rule on whole texts, by searches that start again at every opening."""
    for name in ("script", "style", "noscript", "iframe"):
        html = re.sub(rf"(?is)<{name}\b[^>]*>.*?</{name}\s*>", MARK, html)
    html = re.sub(r"(?s)<!--.*?-->", MARK, html)
    html = re.sub(r"</?[a-zA-Z][^>]*>|<[!?][^>]*>", MARK, html)
    html = re.sub(MARK + "+", "\n", html).replace("\r\n", "\n").replace("\r", "\n")
    return re.sub(r"[^\S\n]+(?=\n)", "", html).strip()


PAGES = [
    "<p>one</p><script>var a = '<b>';</script>two", "<SCRIPT type=x>a</script >b<script>c</script>d", "a <style>b {} </style\n> c <b>d</b>",
    "x<!-- a <b> -->y<!--z-->w", "a <!-- b", "a --> b", "<script>never closed <b>bold</b>", "</script>stray", "1 < 2 > 0 <3 <a href='x<y'>l</a>",
    "<noscript><iframe src=a></iframe></noscript>t", "<iframe>a</iframe><iframe>b</iframe>", "<scripted>kept</scripted>", "no markup", "", "<", ">", "<>",
    "<script", "a<!doctype html>b<?xml?>c", "l1  <br>  l2 \t\n<br/>l3", "<script>a</script>" * 3 + "<script>", "<style>s</style>text<style>", "<!--a--><!--b-->c-->d",
]


def test_text_equals_the_plain_rule(spark):
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(PAGES)], "i int, p string").select("i", X.html_to_text(F.col("p")).alias("t")).collect()
    assert {r["i"]: r["t"] for r in rows} == {i: plain(p) for i, p in enumerate(PAGES)}
    assert spark.createDataFrame([(None,)], "p string").select(X.html_to_text(F.col("p"))).first()[0] is None


@pytest.mark.parametrize("text", [
    "<script " * 125_000, "<!--" * 250_000, "<script>" * 125_000, "<a " * 330_000 + ">", "<style>x</style>" * 60_000, "<" * 1_000_000, " " * 1_000_000 + "y", "&#1" * 300_000])
def test_a_megabyte_without_an_end_takes_seconds(spark, text):
    frame = spark.createDataFrame([(text,)], "p string").select(F.length(X.html_to_text(F.col("p"))))
    start = time.time()
    frame.collect()
    assert time.time() - start < 20
