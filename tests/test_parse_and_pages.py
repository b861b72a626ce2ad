import pytest
from pyspark.sql import functions as F

from pagemill import schemas
from pagemill.functions import classify, parse, text
from pagemill.operators import bronze, gold, silver

PDF = b"""%PDF-1.4
4 0 obj
<< /Length 9 >>
stream
BT /F2 18 Tf 72 750 Td (Offer \\(draft\\)) Tj ET
BT /F2 14 Tf 72 700 Td (1. Terms) Tj ET
BT /F1 10 Tf 82 680 Td (Name: Ann Miller) Tj ET
BT /F1 10 Tf 82 666 Td (back\\\\slash) Tj ET
BT /F1 10 Tf 82 630 Td (after a gap) Tj ET
endstream
endobj
5 0 obj
<< /Length 9 >>
stream
BT /F1 10 Tf 82 750 Td (second page) Tj ET
endstream
endobj
%%EOF
"""


def elements_of(frame, parser, column):
    return [
        tuple(r)
        for r in frame.select(F.explode(parser(F.col(column))["document"]["elements"]).alias("e"))
        .select("e.id", "e.type", "e.content", "e.description", F.col("e.bbox")[0]["page_id"])
        .collect()
    ]


def test_pdf_text_layer(spark):
    frame = spark.createDataFrame([(bytearray(PDF),)], "content binary")
    assert elements_of(frame, parse.pdf_text, "content") == [
        (0, "title", "Offer (draft)", None, 0),
        (1, "section_header", "1. Terms", None, 0),
        (2, "text", "Name: Ann Miller\nback\\slash", None, 0),
        (3, "text", "after a gap", None, 0),
        (4, "text", "second page", None, 1),
    ]


def test_pdf_words_have_boxes(spark):
    frame = spark.createDataFrame([(bytearray(PDF),)], "content binary")
    words = frame.select(F.explode(parse.pdf_words(F.col("content"))).alias("w")).select("w.*").collect()
    assert [w.text for w in words[:3]] == ["Offer", "(draft)", "1."]
    # Offer in bold 18 points: 778 + 333 + 333 + 556 + 389 thousandths
    assert words[0].x0 == 72.0 and abs(words[0].x1 - (72 + 2.389 * 18)) < 1e-9
    assert abs(words[1].x0 - words[0].x1 - 0.278 * 18) < 1e-9
    assert words[0].fontname == "Helvetica-Bold" and words[3].fontname == "Helvetica-Bold"
    assert all(w.y1 - w.y0 == pytest.approx(w.fontsize) for w in words)


def test_no_pdf_at_all(spark):
    frame = spark.createDataFrame([(bytearray(b"not a pdf"),), (bytearray(b""),)], "content binary")
    assert elements_of(frame, parse.pdf_text, "content") == []


def test_html_tables_figures_and_unclosed_tags(spark):
    html = (
        "<html><head><title>T &amp; U</title><script>var x='<p>no</p>';</script></head><body><!-- <p>no</p> -->"
        "<nav><p>no</p></nav><header>top</header><p>one <b>two<p>three<br>four &lt;5</p>"
        "<table><tr><td>a</td><td>b</td></tr><tr><th>c</th><td>d</td></tr></table>"
        '<figure><img src=x alt="A cat"><figcaption>cap</figcaption></figure><figure><img alt="Only alt"></figure>'
        "<ul><li>i1<li>i2</ul><h2>Head</h2></body></html>"
    )
    frame = spark.createDataFrame([(html,), (None,)], "html string")
    found = [(k, c, d) for _, k, c, d, _ in elements_of(frame, parse.html_text, "html")]
    assert found == [
        ("title", "T & U", None), ("page_header", "top", None), ("text", "one two", None), ("text", "three", None),
        ("text", "four <5", None), ("table", "a | b\nc | d", None), ("figure", "cap", "A cat"),
        ("figure", "", "Only alt"), ("list_item", "i1", None), ("list_item", "i2", None), ("section_header", "Head", None),
    ]


@pytest.mark.parametrize(
    "kind, content, description, expected",
    [
        ("title", None, None, "# "),
        (" Title ", "x", None, "# x"),
        ("SectionHeader", "x", None, "## x"),
        ("pageheader", "x", None, "## x"),
        ("tableheader", "x", "d", "## x"),
        ("table", "x", "d", "[TABLE]\nx\n[Description: d]"),
        ("table", "x", "  ", "[TABLE]\nx"),
        (" figure", None, None, "[FIGURE]\n"),
        ("text", "x", "d", "x"),
        (None, "x", None, "x"),
        ("text", "\n", None, "\n"),
        ("text", None, None, None),
        ("text", "   ", None, None),
    ],
)
def test_element_format(spark, kind, content, description, expected):
    frame = spark.createDataFrame(
        [(kind, content, description)], "element_type string, content string, description string"
    )
    rows = silver.formatted(frame).collect()
    assert [r.formatted_content for r in rows] == ([] if expected is None else [expected])


def parsed(spark, rows):
    """rows: (file, pages, elements)"""
    schema = f"file_name string, parsed_doc {schemas.PARSED}"
    docs = spark.createDataFrame([(n, ((p, e),)) for n, p, e in rows], schema)
    return docs.select("file_name", F.concat(F.lit("/in/"), "file_name").alias("file_path"), F.lit("hr").alias("document_type"), "parsed_doc")


def el(i, kind, content, page, description=None):
    return (i, kind, content, description, [([1, 2], page)] if page is not None else [])


DOCS = [
    (
        "a.enc",
        [(7, "img0"), (8, "img1")],
        [
            el(10, "text", "ten", 0), el(2, "text", "two", 0), el(1, "title", None, 0), el(3, "text", " ", 0),
            el(4, "table", "t", 1, "d"), el(5, "text", "far", 9), el(6, "text", "no box", None), el(None, "text", "no id", 0),
        ],
    ),
    ("none.enc", [], []),
    ("blank.enc", [(0, "i")], [el(0, "text", "  ", 0)]),
]


def test_elements_and_image_by_position(spark):
    rows = {(r.file_name, r.element_id): r for r in bronze.explode_elements(parsed(spark, DOCS)).collect()}
    assert len(rows) == 10
    assert rows["a.enc", 10].image_uri == "img0" and rows["a.enc", 4].image_uri == "img1"
    assert rows["a.enc", 5].page_id == 9 and rows["a.enc", 5].image_uri is None
    assert rows["a.enc", 6].page_id is None and rows["a.enc", 6].bbox_json == "[]"
    assert rows["none.enc", None].element_type is None


def test_pages_by_aggregation_and_by_row_agree(spark, key):
    docs = parsed(spark, DOCS).withColumns({"file_size": F.lit(1).cast("bigint"), "ingested_at": F.current_timestamp()})
    stored = bronze.unsealed_docs(bronze.sealed_docs(docs, key), key)
    elements = bronze.explode_elements(stored)
    columns = [*schemas.PAGE_KEY, "page_content", "element_count", "element_types", "image_uri"]
    grouped = {tuple(r) for r in silver.pages(elements).select(columns).collect()}
    assert grouped == {tuple(r) for r in silver.pages_of(docs).select(columns).collect()}
    by_page = {r[3]: r for r in grouped}
    assert by_page[0][4] == "no id\n\n# \n\ntwo\n\nten"
    assert by_page[0][5:] == (4, "text, title", "img0")
    assert by_page[1][4] == "[TABLE]\nt\n[Description: d]"
    assert by_page[9][7] is None and by_page[None][4] == "no box"
    assert {r[0] for r in grouped} == {"a.enc"}
    ordered = silver.in_order(silver.pages_of(docs)).select("page_id").collect()
    assert [r[0] for r in ordered] == [None, 0, 1, 9]


def test_broken_json_gives_no_parse(spark, key):
    from pagemill.functions.crypto import seal

    stored = spark.createDataFrame([("f", "p", 1, "hr", '{"document": ')], "file_name string, file_path string, file_size bigint, document_type string, j string")
    stored = stored.select("*", seal(F.col("j"), key).alias("encrypted_parsed_doc"), F.current_timestamp().alias("ingested_at"))
    row = bronze.explode_elements(bronze.unsealed_docs(stored, key)).collect()
    assert len(row) == 1 and row[0].element_id is None


@pytest.mark.parametrize(
    "name, label",
    [
        ("letter_hr.enc", "hr"), ("a_ENGINEERING.pdf", "engineering"), ("yearly_budget_notes.pdf", "finance"),
        ("staff-tax-ledger.pdf", "finance"), ("holiday.pdf", None), ("refund.request.pdf", "support"), ("", None),
    ],
)
def test_type_by_name(spark, name, label):
    frame = spark.createDataFrame([(name,)], "n string")
    assert frame.select(classify.by_name(F.col("n"), tuple(schemas.CATEGORIES))).first()[0] == label


def test_gold_routes_by_type(spark, tmp_path):
    pages = spark.createDataFrame(
        [("a", "/a", "hr", 0, "mail a@b.org"), ("b", "/b", "finance", 0, "x"), ("b", "/b", "finance", 1, "y"),
         ("c", "/c", None, 0, "z"), ("d", "/d", "legal", 0, "z")],
        "file_name string, file_path string, document_type string, page_id int, page_content string",
    ).withColumns({"element_count": F.lit(1), "element_types": F.lit("text"), "image_uri": F.lit(None).cast("string")})
    out = str(tmp_path / "gold")
    names = gold.publish_tables(gold.masked_pages(pages), out, "docs_gold")
    assert names == ["docs_gold_hr", "docs_gold_finance"]
    assert spark.table("docs_gold_hr").first().page_content_masked == "mail ***@b.org"
    assert {(r[0], r[1], r[2]) for r in gold.summary(gold.published(spark, out)).collect()} == {("hr", 1, 1), ("finance", 2, 1)}
    assert {(r[0], r[1]) for r in gold.unrouted(pages).collect()} == {(None, 1), ("legal", 1)}
    plan = gold.category_pages(spark, out, "hr")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(document_type" in plan
    # a category that has become empty leaves nothing behind
    gold.publish(gold.masked_pages(pages.filter("document_type = 'finance'")), out, compact=True)
    assert gold.category_pages(spark, out, "hr").isEmpty()


def test_words_as_python_splits_them(spark):
    texts = ["a b", " a\tb\n", "a b c", "\x1ca\x1fb", "", "\n \n", "x\u0085y　z", "zero​width"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [list(r[0]) for r in frame.select(text.words(F.col("t"))).collect()] == [t.split() for t in texts]


def test_html_left_open_swallows_what_a_browser_would_not_show(spark):
    pages = ["<p>a</p><script>var x = '<p>b</p>'", "<p>a</p><!-- b <p>c", "<p>a<nav><p>b", "<p>a --> b</p>", "<p>a</p><style>p{}"]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    found = {r.i: list(r.c) for r in frame.select("i", parse.html_text(F.col("html"))["document"]["elements"]["content"].alias("c")).collect()}
    assert found == {0: ["a"], 1: ["a"], 2: ["a", "b"], 3: ["a --> b"], 4: ["a"]}


def shown(spark, *contents):
    frame = spark.createDataFrame([(i, bytearray(c) if c is not None else None) for i, c in enumerate(contents)], "i int, content binary")
    rows = frame.select("i", F.explode(parse.textlayer.shows(F.col("content"))).alias("s")).select("i", "s.*").collect()
    return [(r.i, r.page, r.font, r.size, round(r.x, 6), round(r.y, 6), r.text) for r in rows]


def one_stream(body):
    return b"%PDF-1.4\n4 0 obj\n<< /Length 9 >>\nstream\n" + body + b"\nendstream\nendobj\n%%EOF\n"


def test_pdf_strings_by_the_running_state(spark):
    moves = one_stream(
        b"q /F1 10 Tf BT 12 TL 72 700 Td (one) Tj T* (two) Tj 0 -20 TD (three) Tj T* (four) Tj (five) ' ET Q"
        b" /F1 5 Tf BT 2 0 0 2 100 300 Tm (big) Tj 3 -4 Td (below) Tj ET BT 3 Ts 10 10 Td (up) Tj ET"
    )
    arrays = one_stream(
        b"/F1 10 Tf BT 82 700 Td [(Wa) 60 (ter) -400 (mill)] TJ T* ET BT 82 600 Td (a) Tj (b) Tj 40 0 Td (c) Tj ET"
        b" % (no) Tj\n BT 82 500 Td (caf\\351 \\(a \\\\ b\\) (in) x\\\ny) Tj <48 65 6C6C6F> Tj ET"
        b" BT 82 400 Td <004100E9> Tj 0 -20 Td <FEFF4F60597D> Tj 0 -20 Td (\x93q\x94) Tj ET BI /W 1 ID (x) Tj \x00 EI BT 82 300 Td (end) Tj ET"
    )
    assert shown(spark, moves, arrays) == [
        (0, 0, "F1", 10.0, 72.0, 700.0, "one"), (0, 0, "F1", 10.0, 72.0, 688.0, "two"), (0, 0, "F1", 10.0, 72.0, 668.0, "three"),
        (0, 0, "F1", 10.0, 72.0, 648.0, "four"), (0, 0, "F1", 10.0, 72.0, 628.0, "five"),
        (0, 0, "F1", 10.0, 100.0, 300.0, "big"), (0, 0, "F1", 10.0, 106.0, 292.0, "below"), (0, 0, "F1", 5.0, 10.0, 13.0, "up"),
        (1, 0, "F1", 10.0, 82.0, 700.0, "Water"), (1, 0, "F1", 10.0, round(82 + (944 + 556 - 60 + 278 + 556 + 333 + 400) / 100, 6), 700.0, "mill"),
        (1, 0, "F1", 10.0, 82.0, 600.0, "ab"), (1, 0, "F1", 10.0, 122.0, 600.0, "c"),
        (1, 0, "F1", 10.0, 82.0, 500.0, "café (a \\ b) (in) xyHello"),
        (1, 0, "F1", 10.0, 82.0, 400.0, "Aé"), (1, 0, "F1", 10.0, 82.0, 380.0, "你好"), (1, 0, "F1", 10.0, 82.0, 360.0, "“q”"),
        (1, 0, "F1", 10.0, 82.0, 300.0, "end"),
    ]


def test_pdf_pages_by_the_page_tree(spark):
    text = lambda word: b"stream\nBT /F1 10 Tf 1 1 Td (" + word + b") Tj ET\nendstream\nendobj\n"
    tree = (
        b"%PDF-1.4\n9 0 obj << /Type /Page /Contents [5 0 R 6 0 R] >> endobj\n3 0 obj << /Subtype /Image >> " + text(b"picture")
        + b"5 0 obj <<>> " + text(b"last") + b"6 0 obj <<>> " + text(b"more") + b"7 0 obj << /Filter /FlateDecode >> " + text(b"packed")
        + b"8 0 obj << /Type /Page /Contents 10 0 R >> endobj\n10 0 obj [11 0 R] endobj\n11 0 obj <<>> " + text(b"first")
        + b"12 0 obj << /Type /Page /Contents 7 0 R >> endobj\n13 0 obj << /Type/Page/Contents 3 0 R >> endobj\n"
        + b"2 0 obj << /Type /Pages /Kids [8 0 R 4 0 R 2 0 R] >> endobj\n4 0 obj << /Type /Pages /Kids [12 0 R 9 0 R] >> endobj\n"
        + b"1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n5 0 obj <<>> " + text(b"renewed")
    )
    # the second page is packed, the fifth object is replaced by a later one, object 13 is in no tree
    loose = b"1 0 obj << /Subtype /Image >> " + text(b"picture") + b"2 0 obj <<>> " + text(b"a") + b"3 0 obj << /Type /XRef >> " + text(b"x") + b"4 0 obj <<>> stream\nBT /F1 10 Tf 1 1 Td (b) Tj"
    assert [(i, page, word) for i, page, *_, word in shown(spark, tree, None, loose)] == [
        (0, 0, "first"), (0, 2, "renewed"), (0, 2, "more"), (2, 0, "a"), (2, 1, "b"),
    ]


def test_pdf_boxes_follow_spacing_and_kerning(spark):
    body = one_stream(b"/F1 10 Tf 2 Tc 5 Tw 50 Tz BT 10 700 Td (ab cd) Tj ET 0 Tc 0 Tw 100 Tz BT 10 600 Td [(W) 100 (a)] TJ ET")
    frame = spark.createDataFrame([(bytearray(body),)], "content binary")
    words = frame.select(F.explode(parse.pdf_words(F.col("content"))).alias("w")).select("w.*").collect()
    assert [(w.text, round(w.x0, 6), round(w.x1, 6)) for w in words] == [
        ("ab", 10.0, 10 + (5.56 * 2 + 4) / 2), ("cd", round(10 + (5.56 * 2 + 2.78 + 6 + 5) / 2, 6), round(10 + (5.56 * 3 + 5.0 + 2.78 + 10 + 5) / 2, 6)),
        ("Wa", 10.0, round(10 + 9.44 - 1 + 5.56, 6)),
    ]


def test_pdf_strings_of_one_height_are_one_line(spark):
    body = one_stream(b"/F1 10 Tf BT 82 700 Td (left) Tj 60 0 Td (right) Tj -60 -14 Td (next) Tj 200 28 Td (column) Tj ET")
    frame = spark.createDataFrame([(bytearray(body),)], "content binary")
    assert [e[2] for e in elements_of(frame, parse.pdf_text, "content")] == ["left right\nnext", "column"]


def test_lists_of_a_batch_go_out_in_pieces(spark):
    """A batch of documents gives several smaller arrays, so that a worker never holds the words of thousands of documents."""
    import pyarrow as pa

    from pagemill.functions import textlayer

    batches = [pa.array([b"x" * 3, None, b"x" * 9_000] * 40, pa.binary()), pa.array([], pa.binary()), pa.array([b"x"], pa.binary())]
    kind = "array<struct<page: int, text: string>>"
    got = list(textlayer._told(kind, iter(batches), lambda d: ((n, "w") for n in range(len(d)))))
    assert [n for a in got for n in pa.compute.list_value_length(a).to_pylist()] == [3, 0, 9_000] * 40 + [1]
    assert max(len(a.flatten()) for a in got) < textlayer.ROWS_OUT + 9_000 and len(got) > 20

    pdf = b"1 0 obj\n<< >>\nstream\nBT /F1 10 Tf 82 750 Td (" + b"w " * 9_000 + b") Tj ET\nendstream\nendobj\n%d"
    frame = spark.createDataFrame([(n, pdf % n if n % 3 else None) for n in range(30)], "i int, content binary").coalesce(1)
    sizes = frame.select("i", F.size(parse.pdf_words(F.col("content"))).alias("n")).collect()
    assert {r.i: r.n for r in sizes} == {n: 9_000 if n % 3 else 0 for n in range(30)}
