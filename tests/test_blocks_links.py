import json
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusflow.functions.links import LinkRules, route
from corpusflow.operators import blocks, fetch
from corpusflow.sources import archives, responses, samples as sources, writers

BLOCK = "document string, page int, block_id int, type string, text string, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>"
BOXES = {
    "plain": (0.1, 0.2, 0.5, 0.9),
    "inverted": (0.9, 0.8, 0.1, 0.2),
    "outside": (-0.5, 0.2, 1.7, 0.4),
    "flat": (0.3, 0.3, 0.3, 0.6),
    "thin": (0.3, 0.3, 0.3009, 0.6),
    "beyond": (1.2, 0.1, 1.5, 0.2),
    "missing": (None, None, 0.5, 0.5),
}


def record_by_hand(box, w=1536, h=2048):
    x0, y0, x1, y1 = (max(0, min(1, v or 0)) for v in box)
    x0, x1 = sorted((x0, x1))
    y0, y1 = sorted((y0, y1))
    return (x0, y0, x1, y1), (int(x0 * w), int(y0 * h), int(x1 * w), int(y1 * h)), x1 > x0 and y1 > y0


def drawn_by_hand(box, w=1536, h=2048):
    x0, y0, x1, y1 = (max(0, min(1, v or 0)) for v in box)
    wide = x1 > x0 + 0.001 and y1 > y0 + 0.001
    return wide and x1 * w > x0 * w + 1 and y1 * h > y0 * h + 1


@pytest.fixture(scope="module")
def rows(spark):
    data = [("doc", 1, i, None if i == 0 else "Text", name, BOXES[name]) for i, name in enumerate(BOXES)]
    return spark.createDataFrame(data, BLOCK)


def test_records(rows):
    for r in blocks.records(rows).collect():
        box, pixels, valid = record_by_hand(BOXES[r["text"]])
        assert (tuple(r["bbox_normalized"]), tuple(r["bbox_pixels"]), r["is_valid"]) == (box, pixels, valid)
    assert blocks.records(rows).filter("block_id = 0").first()["type"] == "DEFAULT"


def test_drawable(rows):
    found = {r["label"]: (r["x0"], r["x1"]) for r in blocks.drawable(rows).collect()}
    expected = [n for n in BOXES if drawn_by_hand(BOXES[n])]
    assert len(found) == len(expected) and found["0: DEFAULT"] == (0.1 * 1536, 0.5 * 1536)


def test_preview(spark):
    data = [("d", 1, 0, "T", "a\nb", (0.0, 0.0, 1.0, 1.0)), ("d", 1, 1, None, "x\n" * 150, None), ("d", 1, 2, "T", None, None)]
    found = blocks.preview(spark.createDataFrame(data, BLOCK)).orderBy("id").collect()
    assert [r["text"] for r in found] == ["a b", ("x " * 100) + "...", ""]
    assert json.loads(found[0]["bbox"]) == {"xmin": 0.0, "ymin": 0.0, "xmax": 1.0, "ymax": 1.0} and found[1]["bbox"] == "{}"


def test_page_and_document_results(spark, rows):
    pages = spark.createDataFrame([("doc", 1), ("doc", 2), ("full", 1)], "document string, page int")
    more = rows.unionByName(spark.createDataFrame([("full", 1, 0, "T", "t", None)], BLOCK))
    names = spark.createDataFrame([("doc",), ("full",), ("none",)], "document string")
    done = blocks.document_results(blocks.page_results(pages, more), names)
    found = {r["document"]: tuple(r)[1:] for r in done.collect()}
    assert found == {"doc": (1, 2, 7, False), "full": (1, 1, 1, True), "none": (0, 0, 0, True)}
    assert tuple(blocks.run_totals(done).first()) == (3, 2, 2, 3, 8)


def reply(arguments):
    return json.dumps({"choices": [{"message": {"tool_calls": [{"function": {"arguments": arguments}}]}}]})


FLAT = '[{"type": "Title", "text": "a", "bbox": {"xmin": 0.25, "ymax": 1}}, {"text": null, "bbox": null}]'


@pytest.mark.parametrize(
    ("response", "expected"),
    [
        (reply(FLAT), [("Title", "a", 0.25), ("DEFAULT", None, None)]),
        (reply(" [ " + FLAT + "]"), [("Title", "a", 0.25), ("DEFAULT", None, None)]),
        (reply("[]"), []),
        (reply("[[]]"), []),
        (reply('{"type": "Title"}'), []),
        (reply("[{"), []),
        (reply(FLAT + " oops"), []),
        (reply(FLAT + ", []"), []),
        (reply("[" + FLAT + "] ]"), []),
        (json.dumps({"choices": [{"message": {"tool_calls": []}}]}), []),
        (json.dumps({"choices": []}), []),
        (json.dumps({}), []),
        ("no json", []),
        (None, []),
    ],
)
def test_parser_replies(spark, response, expected):
    df = spark.createDataFrame([(1, response)], "page int, response string")
    found = responses.decode(df).orderBy("block_id").collect()
    assert [(r["type"], r["text"], r["bbox"]["xmin"] if r["bbox"] else None) for r in found] == expected


def test_archives(spark, tmp_path):
    paths = ["//Document/P", "//Document/P[2]", "//Document/Table", "//Document/STOP", None]
    found = [{"Path": p} if p else {"Text": "t"} for p in paths]
    for name, member in (("good", archives.MEMBER), ("other", "different.json")):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr(member, json.dumps({"elements": found}))
    (tmp_path / "broken.zip").write_bytes(b"no zip")
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr(archives.MEMBER, '{"elements": [')
    with zipfile.ZipFile(tmp_path / "stream.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(archives.MEMBER, json.dumps({"elements": found * 50}))
    damaged = bytearray((tmp_path / "stream.zip").read_bytes())
    start = 30 + len(archives.MEMBER)
    damaged[start : start + 20] = b"\xff" * 20
    (tmp_path / "stream.zip").write_bytes(damaged)
    content = archives.read_archives(spark, str(tmp_path))
    parsed = archives.elements(content)
    assert {r["document"]: (r["ok"], r["status"]) for r in parsed.collect()} == {
        "good": (True, "ok"),
        "other": (True, "no_member"),
        "broken": (False, "bad_zip"),
        "bad": (False, "bad_json"),
        "stream": (False, "bad_zip"),
    }
    for bytes_per_task in (1, 1 << 30):
        members = archives.parsed(archives.read_structured(spark, str(tmp_path), bytes_per_task))
        assert sorted(map(str, members.collect())) == sorted(map(str, parsed.collect()))
    counts = {r["document"]: tuple(r)[1:] for r in blocks.element_counts(parsed).collect()}
    assert counts == {"good": (5, 2, 1)} | dict.fromkeys(["other", "broken", "bad", "stream"], (0, 0, 0))
    assert tuple(blocks.extraction_totals(parsed).first()) == (2, 3)
    out = str(tmp_path / "out")
    writers.write_structured(archives.structured_json(content), out)
    lines = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    assert lines == [{"document": "good", "data": {"elements": found}}]


def blob(data):
    return f"<script>window.__PATHFACTORY__ = {data};</script>"


FRAME = '<iframe class="a"\n src="https://x.widen.net/s?a=1&amp;b=2"></iframe>'
ATTRIBUTE = "<div data-source-url='https://a.example/x.pdf'></div>"
LISTED = '{"global":{"currentContent":{"sourceUrl":""},"experienceContent":[{"title":"a datasheet"},{"title":"Data","sourceUrl":"no"},{"title":"The DataSheet","sourceUrl":"%s"}]}}'


@pytest.mark.parametrize(
    ("html", "method", "link"),
    [
        (blob('{"global":{"currentContent":{"sourceUrl":"c"}}}') + FRAME, "current", "c"),
        (blob(LISTED % "l") + FRAME, "listed", "l"),
        (blob(LISTED % "") + FRAME, None, None),
        (blob('{"global": nonsense}') + FRAME, "frame", "https://x.widen.net/s?a=1&b=2"),
        (blob('{"global":{"currentContent":{"sourceUrl":"a};b"}}}') + ATTRIBUTE, "attribute", "https://a.example/x.pdf"),
        ('<iframe src="https://other.example/"></iframe>' + ATTRIBUTE + FRAME, "frame", "https://x.widen.net/s?a=1&b=2"),
        ("<!-- <iframe src='https://x.widen.net/old'></iframe> -->" + FRAME, "frame", "https://x.widen.net/s?a=1&b=2"),
        ("<script>'<iframe src=\"https://x.widen.net/old\">'</script>" + ATTRIBUTE, "attribute", "https://a.example/x.pdf"),
        ('<iframe title="a > b" src="https://x.widen.net/q"></iframe>', "frame", "https://x.widen.net/q"),
        ("<iframe src=https://x.widen.net/u width=9></iframe>", "frame", "https://x.widen.net/u"),
        ('<iframe src="https://x.widen.net/it\'s"></iframe>', "frame", "https://x.widen.net/it's"),
        ('<iframe title="src=\'https://x.widen.net/no\'" data-src="https://x.widen.net/no"></iframe>', None, None),
        ('<iframe src="https://x.widen.net/?a&#x26;b&#38;c&amp;lt;&#8364;&copy;"></iframe>', "frame", "https://x.widen.net/?a&b&c&lt;€&copy;"),
        ('<div data-source-url=""></div>', None, None),
        ("<p>window</p>", None, None),
        (blob('{"other": 1}'), None, None),
    ],
)
def test_landing_links(spark, html, method, link):
    df = spark.createDataFrame([(1, "https://p.example/", html)], "page_id long, url string, html string")
    row = fetch.landing_links(df).first()
    assert (row["method"], row["link"]) == (method, link)
    assert row["route"] == (None if link is None else "viewer" if "widen.net" in link else "document")
    as_bytes = df.withColumn("html", F.concat(F.unhex(F.lit("FF")), F.col("html").cast("binary")))
    assert fetch.landing_links(as_bytes).first()["link"] == link


@pytest.mark.parametrize(
    ("html", "link"),
    [
        ('<a href="/content/a/x.pdf?u=1&amp;download=true">', "https://h.example:8080/content/a/x.pdf?u=1&download=true"),
        ('<a href="/content/a/x.pdf?u=1">', None),
        ('<a href="/content/a/../b/./x.pdf?u=../1&amp;download=true">', "https://h.example:8080/content/b/x.pdf?u=../1&download=true"),
        ('<a href="/content/../../x.pdf?download=true">', "https://h.example:8080/x.pdf?download=true"),
        ("viewerPdfUrl = '/v/p.pdf'", "/v/p.pdf"),
        ("viewerPdfUrl = ''", None),
    ],
)
def test_viewer_links(spark, html, link):
    df = spark.createDataFrame([("https://h.example:8080/s/1?q=2", html)], "url string, html string")
    assert fetch.viewer_links(df).first()["link"] == link


@pytest.mark.parametrize(
    ("url", "kind", "body", "first", "second"),
    [
        ("u", "application/PDF", b"%PDF-1", "direct", "accepted"),
        ("u.pdf", "text/html", b"<html>", "invalid", "wrong_type"),
        ("u", "text/html", b"%PDF-1", "landing", "wrong_type"),
        ("u", "application/octet-stream", b"%PDF", "unexpected", "accepted"),
        ("https://x.widen.net/a", "image/png", b"PNG", "unexpected", "not_pdf"),
        ("u", None, None, "unexpected", "wrong_type"),
        ("u", "pdf", None, "invalid", "not_pdf"),
    ],
)
def test_fetched_objects(spark, url, kind, body, first, second):
    df = spark.createDataFrame([(url, kind, body)], "url string, content_type string, body binary")
    row = fetch.classified(df).first()
    assert (row["first_class"], row["second_class"]) == (first, second)


def test_other_sites_have_other_rules(spark):
    rules = LinkRules(blob_variable="window.DATA", asset_host="cdn.example")
    df = spark.createDataFrame([(1, "u", '<script>window.DATA={"global":{"currentContent":{"sourceUrl":"https://cdn.example/1"}}};</script>')], "page_id long, url string, html string")
    row = fetch.landing_links(df, rules).first()
    assert (row["link"], row["route"]) == ("https://cdn.example/1", "viewer")


def test_frames_and_routes_have_a_host_each(spark):
    rules = LinkRules(frame_host="own.widen.net")
    html = '<iframe src="https://x.widen.net/1"></iframe><iframe src="https://own.widen.net/2"></iframe>'
    df = spark.createDataFrame([("https://x.widen.net/v", html)], "url string, html string")
    row = fetch.landing_links(df, rules).first()
    assert (row["link"], row["route"]) == ("https://own.widen.net/2", "viewer")
    assert df.select(route(F.col("url"), rules)).first()[0] == "viewer"


def test_unknown_classes_take_the_default(spark):
    classes = spark.createDataFrame([("DEFAULT", 0), ("Text", 1)], "type string, slot int")
    found = spark.createDataFrame([(1, "Text"), (2, "Odd"), (3, None)], "block_id int, type string")
    rows = blocks.with_class(found, classes).orderBy("block_id").collect()
    assert [tuple(r) for r in rows] == [(1, "Text", 1), (2, "Odd", 0), (3, None, 0)]


def test_fetch_summary_and_failures(spark):
    data = [("downloaded", "a", "u", 1024 * 1024), ("skipped", "b", "u", 512 * 1024), ("failed", "c", "u3", None)]
    df = spark.createDataFrame(data, "status string, name string, url string, n_bytes long")
    assert {r["status"]: (r["n"], r["mb"]) for r in fetch.fetch_summary(df).collect()} == {
        "downloaded": (1, 1.0), "skipped": (1, 0.5), "failed": (1, 0.0),
    }
    assert [tuple(r) for r in fetch.failures(df).collect()] == [("c", "u3")]


def test_block_pages_of_a_document_folder(spark, tmp_path, rows):
    records = [r.asDict(recursive=True) for r in blocks.records(rows, carry=()).orderBy("block_id").collect()]
    folder = tmp_path / "my-doc"
    folder.mkdir()
    (folder / "page_1.json").write_text(json.dumps(records, indent=2), encoding="utf-8")
    (folder / "page_2.json").write_text("[]", encoding="utf-8")
    read = sources.read_block_pages(spark, str(tmp_path)).orderBy("block_id").collect()
    assert [r.asDict(recursive=True) for r in read] == [r | {"document": "my-doc"} for r in records]


def test_written_tables_read_back(spark, tmp_path, rows):
    root = str(tmp_path)
    records = blocks.records(rows)
    for name, per_page in (("by-document", False), ("by-page", True)):
        writers.write_blocks(records, f"{root}/{name}", folder_per_page=per_page)
        stored = sources.read_block_table(spark, f"{root}/{name}")
        assert sorted(map(str, stored.select(records.columns).collect())) == sorted(map(str, records.collect()))
    writers.write_preview(rows, f"{root}/preview")
    assert spark.read.csv(f"{root}/preview", sep="\t", header=True).count() == rows.count()
    found = fetch.landing_links(spark.createDataFrame([(1, "u", ATTRIBUTE), (2, "u", "x")], "page_id long, url string, html string"))
    writers.write_quarantine(found, f"{root}/quarantine")
    assert [r["page_id"] for r in sources.read_pages(spark, f"{root}/quarantine").collect()] == [2]


def test_point_table_and_fetched_table(spark, tmp_path):
    points = spark.createDataFrame([(1.5, 2.0, "s", "d", 'a "quoted", line\ntwo')], "x double, y double, split string, dataset string, text string")
    writers.write_points(points, str(tmp_path / "p"))
    writers.write_points(points, str(tmp_path / "c"), fmt="csv")
    assert spark.read.parquet(str(tmp_path / "p")).collect() == points.collect()
    read = spark.read.csv(str(tmp_path / "c"), header=True, escape='"', multiLine=True).first()
    assert read["text"] == 'a "quoted", line\ntwo'
    fetched = spark.createDataFrame([("u", "pdf", b"%PDF")], "url string, content_type string, body binary")
    fetched.write.parquet(str(tmp_path / "f"))
    assert sources.read_fetched(spark, str(tmp_path / "f")).collect() == fetched.collect()


def test_a_document_of_the_block_store_is_in_few_files(spark, tmp_path):
    schema = "page int, block_id int, text string, document string"
    rows = spark.range(6000).selectExpr(
        "cast(id % 40 as int) AS page", "cast(id div 40 as int) AS block_id", "concat('t', id) AS text",
        "if(id % 3 = 0, 'hot', concat('doc', id % 50)) AS document",
    )
    assert rows.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    root = tmp_path / "store"
    writers.write_block_store(rows, str(root), rows_per_file=500)
    held = spark.read.parquet(str(root)).groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("n"), F.min("document").alias("low"), F.max("document").alias("high")
    ).collect()
    assert len(held) >= 12 and max(r["n"] for r in held) <= 500
    files = {d: [r["file"] for r in held if r["low"] <= d <= r["high"]] for d in ("doc1", "doc31", "hot")}
    assert len(files["doc1"]) <= 3 and len(files["doc31"]) <= 3 and 4 <= len(files["hot"]) <= 12
    one = sources.read_block_store(spark, str(root), "doc1")
    assert one.count() == rows.filter("document = 'doc1'").count()
    assert "PushedFilters: [IsNotNull(document), EqualTo(document,doc1)]" in one._jdf.queryExecution().toString()


def test_small_files_of_the_block_store_are_no_tasks_of_their_own(spark, tmp_path):
    rows = spark.range(6000).selectExpr("cast(id as int) AS page", "0 AS block_id", "'t' AS text", "concat('doc', id % 50) AS document")
    writers.write_block_store(rows, str(tmp_path / "store"), rows_per_file=500)
    files = [f.name for f in (tmp_path / "store").glob("part-*.parquet")]
    assert len(files) == 12 and len({name.split("-")[1] for name in files}) == 1


def test_many_small_archives_share_tasks(spark, tmp_path):
    for i in range(300):
        with zipfile.ZipFile(tmp_path / f"{i}.zip", "w") as archive:
            archive.writestr(archives.MEMBER, json.dumps({"elements": [{"Text": str(i)}]}))
    found = archives.read_structured(spark, str(tmp_path), bytes_per_task=100)
    assert found.rdd.getNumPartitions() <= 16 * spark.sparkContext.defaultParallelism
    assert {r["document"]: json.loads(r["json"])["elements"][0]["Text"] for r in found.collect()} == {str(i): str(i) for i in range(300)}
