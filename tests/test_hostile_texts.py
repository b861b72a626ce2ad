"""Texts made to run a pattern into the ground: all stages stay linear in them."""

import time

import pytest
from pyspark.sql import functions as F

from pagemill.functions import classify, parse, pii, text
from pagemill.operators import detect, evaluate, redact, vectors

N = 60_000

PLAIN = {
    "one word": "a" * N, "digits": "1" * N, "ats": "@" * N, "a@": "a@" * (N // 2), "a@b.": "a@b." * (N // 4), "1-": "1-" * (N // 2),
    "1.": "1." * (N // 2), "phones": "(602) " * (N // 6), "names": "Name: " * (N // 6), "Name: A": "Name: " + "A" * N, "capitals": "A " * (N // 2),
    "houses": "12 Oak " * (N // 7), "blanks": " " * N + "x", "newlines": "\n" * N, "dashes": "-" * N + "a", "marks": "\u0001" * N,
    "account": "account " * (N // 8), "plus": "+1" * (N // 2), "hash": "#" * N + "a #" + "#" * N, "mr": "Mr. " * (N // 4), "12 A-A-": "12 " + "A-" * (N // 2),
}
HTML = {
    "open comments": "<!--" * (N // 4), "open scripts": "<script " * (N // 8), "open navs": "<nav>" * (N // 5), "open tags": "<p " * (N // 3),
    "brackets": "<" * N, "imgs": '<img alt="' * (N // 10), "cells": "</td>" * (N // 5), "blanks": "<p>" + " " * N + "x", "ends": "</nav>" + "<nav " * (N // 5),
    "dashes": "<!--" + "-" * N, "metas": "<meta " * (N // 6),
}
PDF = {
    "escapes": "stream\n" + "BT /F1 10 Tf 1 1 Td (" + "\\(" * (N // 2) + ") Tj ET\nendstream", "open text": "stream\n" + "BT /F1 10 Tf 1 1 Td (" * (N // 20) + "\nendstream",
    "streams": "stream\n" * (N // 7), "shows": "stream\n" + "BT /F1 10 Tf 1 1 Td (a b) Tj ET\n" * (N // 33) + "endstream", "long line": "stream\nBT /F1 10 Tf 1 1 Td (" + "ab " * (N // 3) + ") Tj ET\nendstream",
}


def timed(frame):
    at = time.time()
    frame.write.format("noop").mode("overwrite").save()
    return time.time() - at


def rows(spark, texts):
    return spark.createDataFrame(list(texts.items()), "name string, page_content string").repartition(8)


def test_plain_texts(spark):
    pages = rows(spark, PLAIN)
    body = F.col("page_content")
    assert timed(pages.select(pii.mask_in_text(body))) < 60
    assert timed(redact.redact(detect.with_entities(pages))) < 60
    assert timed(pages.select(text.word_count(body), text.token_key(body), classify.language(body), evaluate.not_evasive(body))) < 60
    assert timed(pages.select(vectors.embed_hashed(body))) < 60
    assert timed(pages.select(parse.plain_text(body))) < 60


@pytest.mark.parametrize("texts, parser", [(HTML, parse.html_text), (PDF, parse.pdf_text), (PDF, parse.pdf_words)])
def test_marked_up_texts(spark, texts, parser):
    assert timed(rows(spark, texts).select(parser(F.col("page_content")))) < 60
