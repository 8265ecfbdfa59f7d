"""Edge tables of feeds, sheets, messages, segments and writers."""

import threading
from datetime import timedelta
from urllib.parse import parse_qsl, urlencode, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from registry.common import AS_OF, views
from registry.feeds import MASTERS
from storelens.config import FeedConfig
from storelens.plans import content, ingest, segments
from storelens.plans.feeds import base, channels, run as feed_run
from storelens.sources import sinks, tables

SF = "/root/testdata/sf0.001"
CFG = FeedConfig()


def test_validation_gates(spark):
    feed = base.base_feed(views(spark, SF, *MASTERS), CFG, AS_OF)
    base.require_valid(base.validate_feed(feed))
    with pytest.raises(base.FeedValidationError, match="no rows"):
        base.require_valid(base.validate_feed(feed.limit(0)))
    broken = feed.withColumn("id", F.lit(""))
    with pytest.raises(base.FeedValidationError, match="missing_id"):
        base.require_valid(base.validate_feed(broken))
    with pytest.raises(base.FeedValidationError):
        base.require_rows(feed.limit(0), "google_merchant")


def test_discount_rounds_half_up_to_tens(spark):
    rows = spark.createDataFrame(
        [("100", "55"), ("100", "56"), ("0", "10"), ("100", "100"), ("100", None)],
        "retail_price_in_tax string, sale_price_in_tax string",
    )
    assert [r[0] for r in rows.select(base.discount_rate()).collect()] == [50, 40, 0, 0, None]


def feed_row(spark, **change):
    row = {c: None for c in base.BASE_COLUMNS}
    row |= dict(
        id="i", ec_sku_code="s", title="small shirt", description="<b>rn</b>", link="l",
        image_link="m", availability="in_stock", price_in_tax="100", sale_price_in_tax="100",
        year="24", sale_start_datetime="20240101000000", sale_end_datetime="20240201000000",
        google_product_category="a>b",
    )
    row |= change
    schema = ", ".join(f"{c} {'long' if c == 'stock_quantity' else 'string'}" for c in row)
    return spark.createDataFrame([tuple({**row, "stock_quantity": 5}.values())], schema)


def test_google_edges(spark):
    row = channels.feed_google_merchant(feed_row(spark), CFG).first()
    assert (row.description, row.google_product_category, row.size_type) == ("rn", "a > b", "petite")
    assert row.sale_price_effective_date == "2024-01-01T00:00:00+09:00/2024-02-01T00:00:00+09:00"
    assert channels.feed_google_merchant(feed_row(spark, price_in_tax="0"), CFG).count() == 0
    for category in (None, "", "\\N"):
        df = feed_row(spark, google_product_category=category)
        assert channels.feed_google_merchant(df, CFG).count() == 0
    marked = channels.feed_google_merchant(feed_row(spark, gender="\\N", description="\\N"), CFG).first()
    assert marked.gender == "unisex" and marked.description == "small shirt/\\N"
    assert len(row) == 45


def test_meta_edges(spark):
    row = channels.feed_meta_dynamic(feed_row(spark, availability="pre_order"), CFG).first()
    assert row.availability == "out of stock" and row.link is None
    assert row.sale_price is None and row.sale_price_effective_date is None
    sale = channels.feed_meta_collection(feed_row(spark, sale_price_in_tax="80", brand_abb="x"), CFG).first()
    assert sale.sale_price == "80 JPY" and sale.id == "s_ad_x_catalog"
    widths = {"criteo_catalog": 18, "rtb_house": 16, "yahoo_shopping": 16, "meta_organic": 31}
    assert {c: len(channels.CHANNELS[c](feed_row(spark), CFG).columns) for c in widths} == widths


def test_description_loses_line_breaks_only(spark):
    out = base.base_feed(views(spark, SF, *MASTERS), CFG, AS_OF)
    texts = [r.description for r in out.filter("description like '%nr%'").collect()]
    assert texts and not any("\n" in t or "\r" in t for t in texts)


def test_quoted_csv_bytes(spark, tmp_path):
    df = spark.createDataFrame([("a", 'say "hi"'), (None, "")], "x string, y string").coalesce(1)
    sinks.write_quoted_csv(df, str(tmp_path / "q"))
    text = next((tmp_path / "q").glob("part-*.csv")).read_bytes().decode()
    assert text == '"x","y"\r\n"a","say ""hi"""\r\n"",""\r\n'
    sinks.write_plain_csv(df, str(tmp_path / "p"))
    plain = next((tmp_path / "p").glob("part-*.csv")).read_bytes().decode()
    assert plain.startswith("x,y\r\na,") and "\r\nNULL," in plain
    assert sinks.dated_name("feed", AS_OF) == "feed_20240131"


def test_tables_are_made_and_replaced(spark):
    name = "storelens_test_sent"
    spark.sql(f"drop table if exists {name}")
    schema = tables.string_schema(["email", "send_type"])
    tables.ensure_table(spark, name, schema)
    tables.ensure_table(spark, name, schema)
    assert spark.table(name).count() == 0
    row = spark.createDataFrame([("e", "s")], schema)
    sinks.append_table(row, name)
    sinks.append_table(row, name)
    assert spark.table(name).count() == 2
    sinks.replace_table(row.limit(0), name)
    assert spark.table(name).count() == 0
    spark.sql(f"drop table {name}")


def test_readers_meet_whole_content_while_it_is_replaced(spark, tmp_path):
    name, home = "storelens_test_swapped", str(tmp_path)
    spark.sql(f"drop table if exists {name}")
    sinks.replace_table(spark.range(10).withColumn("x", F.lit("a")), name, home)
    opened = spark.table(name)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(spark.table(name).count())

    reader = threading.Thread(target=read)
    reader.start()
    for n in (0, 20, 30, 40):
        sinks.replace_table(spark.range(n).select(F.lit("b").alias("x"), F.col("id").cast("int")), name, home)
    stop.set()
    reader.join()
    assert seen and set(seen) <= {10, 0, 20, 30, 40}
    assert opened.count() == 10  # a query from before reads what it was made on
    assert spark.table(name).dtypes == [("id", "bigint"), ("x", "string")]
    sinks.replace_table(spark.table(name).filter("id < 5"), name, home)  # from itself
    sinks.append_table(spark.table(name).limit(2), name)
    assert spark.table(name).count() == 7
    with pytest.raises(ValueError):
        sinks.replace_table(spark.range(3), name, home)
    assert sinks.drop_former(spark, name, home) == 5 and spark.table(name).count() == 7
    spark.sql(f"drop table {name}")


def test_deliver_hands_over_whole_batches(spark, tmp_path):
    rows = spark.range(10).select(F.floor(F.col("id") / 4).alias("batch_no"), "id")
    out = str(tmp_path)

    def send(batch, payload):
        with open(f"{out}/{batch}", "w") as f:
            f.write(str(len(payload)))

    sinks.deliver(rows, send)
    assert {p.name: p.read_text() for p in tmp_path.iterdir()} == {"0": "4", "1": "4", "2": "2"}


def test_column_names():
    header = ["申込日", " Total (JPY) ", "2024-01-05", "1st", None, "★", "2024-01-05T00:00:00"]
    assert ingest.normalize_columns(header, {"申込日": "application_date"}) == [
        "application_date", "total_jpy", "date_2024_01_05", "col_1st", "column_4", "col_",
        "date_2024_01_05",
    ]


def test_two_row_header():
    got = ingest.combine_two_row_header(
        [None, "Cart", None, "Buy"], ["Day", "N", None, "N"], {"Buy": "purchase"}, {"Day": "day"}
    )
    assert got == ["day", "cart_n", "cart_col", "purchase_n"]


GRID = "file string, sheet string, row_idx int, cells array<string>"


def test_sheet_types_and_cleaning(spark):
    rows = [
        ["a", "b", "c", "d", "a", "e"],
        ["1", "1", "x", None, "9", "007"],
        ["2", "2.5", "#REF!", "NaN", "8", "8"],
        ["inf", "-1e3", "true", "#N/A", "7", "9"],
        [None] * 6,
    ]
    grid = spark.createDataFrame([("f.xlsx", "s", i, r) for i, r in enumerate(rows)], GRID)
    out = ingest.ingest_sheet(grid, ingest.SheetSpec("s", "t"), AS_OF)
    assert out.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string"), ("d", "string"),
                          ("e", "string"), ("excel_name", "string"), ("excel_sheet_name", "string"),
                          ("time", "int")]
    assert [tuple(r)[:5] for r in out.orderBy("a").collect()] == [
        (7, -1000.0, "true", None, "9"), (8, 2.5, None, None, "8"), (9, 1.0, "x", None, "007"),
    ]


def test_ingest_writes_checks_and_skips(spark):
    spark.sql("drop table if exists storelens_test_sheet")
    data = [("f", "s", 0, ["n"]), ("f", "s", 1, ["1"]), ("f", "s", 2, ["2"]), ("f", "empty", 0, ["n"])]
    grid = spark.createDataFrame(data, GRID)
    specs = [ingest.SheetSpec(s, t) for s, t in
             (("s", "storelens_test_sheet"), ("empty", "storelens_none"), ("absent", "storelens_none2"))]
    assert ingest.ingest_grid(grid, specs, AS_OF) == {"storelens_test_sheet": 2}
    assert ingest.ingest_grid(grid, specs, AS_OF, mode="append") == {"storelens_test_sheet": 2}
    assert spark.table("storelens_test_sheet").count() == 4
    done = frozenset({"storelens_test_sheet"})
    assert ingest.ingest_grid(grid, specs, AS_OF, finished=done) == {}
    spark.sql("drop table storelens_test_sheet")


def test_loads_are_committed_once(spark, tmp_path):
    home = str(tmp_path / "loads")
    data = [("f", "s", i, [c]) for i, c in enumerate(["n", "1", "2"])] + [("f", "p", i, [c, "z"]) for i, c in enumerate(["m", "x"])]
    grid = spark.createDataFrame(data, GRID)
    specs = [ingest.SheetSpec("s", "numbers"), ingest.SheetSpec("p", "letters"), ingest.SheetSpec("absent", "none")]
    assert ingest.load_sheets(grid, specs, AS_OF, home, "a") == ["numbers", "letters"]
    assert ingest.load_sheets(grid, specs, AS_OF, home, "a") == []
    assert ingest.load_sheets(grid, specs, AS_OF, home, "b", "append") == []  # the same cells
    later = AS_OF + timedelta(days=1)
    more = spark.createDataFrame([("f", "s", 0, ["n", "q"]), ("f", "s", 1, ["2.5", "w"])], GRID)
    assert ingest.load_sheets(more, specs, later, home, "c", "append") == ["numbers"]
    got = ingest.loaded(spark, home, "numbers")
    assert sorted((r.n, r.q) for r in got.collect()) == [(1.0, None), (2.0, None), (2.5, "w")]
    assert ingest.load_sheets(more, specs, later + timedelta(days=1), home, "d") == []
    assert ingest.load_sheets(grid, specs[:1], later + timedelta(days=1), home, "e") == ["numbers"]
    assert ingest.loaded(spark, home, "numbers").dtypes[0] == ("n", "bigint")
    with pytest.raises(ValueError):
        ingest.loaded(spark, home, "none")


def test_a_load_that_fails_shows_nothing(spark, tmp_path, monkeypatch):
    home = str(tmp_path / "loads")
    data = [("f", s, i, [c]) for s in "ab" for i, c in enumerate(["n", "1"])]
    grid = spark.createDataFrame(data, GRID)
    specs = [ingest.SheetSpec("a", "one"), ingest.SheetSpec("b", "two")]
    whole = ingest.ingest_sheet

    def lost(grid, spec, as_of):
        if spec.table == "two":
            raise RuntimeError("lost")
        return whole(grid, spec, as_of)

    monkeypatch.setattr(ingest, "ingest_sheet", lost)
    with pytest.raises(RuntimeError):
        ingest.load_sheets(grid, specs, AS_OF, home, "a")
    assert ingest.manifest(spark, home).count() == 0
    monkeypatch.undo()
    assert ingest.load_sheets(grid, specs, AS_OF, home, "a") == ["one", "two"]
    assert ingest.loaded(spark, home, "one").count() == 1


def test_spreadsheet_serials(spark):
    rows = spark.createDataFrame([(1.0,), (59.0,), (60.0,), (61.0,), (45292.5,)], "n double")
    assert [r[0] for r in rows.select(ingest.excel_serial_time("n")).collect()] == [
        "1900-01-01T00:00:00", "1900-02-28T00:00:00", "1900-02-28T00:00:00",
        "1900-03-01T00:00:00", "2024-01-01T12:00:00",
    ]


def utm_by_hand(url, tags, domain):
    if url.startswith("mailto:") or domain not in url or "/member/" in url:
        return url
    parts = urlparse(url)
    query = dict(parse_qsl(parts.query, keep_blank_values=True))
    query.update({k: v for k, v in tags.items() if v})
    return urlunparse(parts._replace(query=urlencode(query)))


def test_utm_equals_the_standard_library(spark):
    tags = {"utm_source": "email", "utm_campaign": "春 sale~*", "utm_term": ""}
    urls = [
        "https://a.test/p", "https://a.test/p?x=1#top", "https://a.test/?utm_source=old&y=%20a+b",
        "https://a.test/p?a&a=2&b=", "mailto:x@a.test", "https://b.test/", "https://a.test/member/1",
        "https://a.test/?q=%E6%98%A5&z=%zz", "https://a.test/p#f?x=1", "https://a.test?&&k=v=w",
    ]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: r.t for r in df.select("url", content.add_utm("url", tags, "a.test").alias("t")).collect()}
    assert got == {u: utm_by_hand(u, tags, "a.test") for u in urls}


def test_html_text(spark):
    html = ("<!DOCTYPE html><style>p{}</style><SCRIPT>var a='<p>x</p>';</SCRIPT><!-- <b>no</b> -->"
            "<p>1 &lt; 2&nbsp;&amp;amp; 3 &#12354;</p>\n　<br/>a<b>b</b> 4 < 5")  # fmt: skip
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(content.html_to_text("h")).first()[0] == "1 < 2 &amp; 3 あ a b 4 < 5"


def test_links_and_images(spark):
    html = ("<a href='/x?a=1&amp;b=2'>X <i>y</i></a><A class=c HREF=/z>Z</A><a name=n>no</a>"
            '<img src="i.png" alt="A &amp; B"><IMG SRC=j.png>')  # fmt: skip
    df = spark.createDataFrame([(1, html)], "k int, html string")
    assert [tuple(r) for r in content.extract_links(df, "k").collect()] == [
        (1, 0, "/x?a=1&b=2", "X y"), (1, 1, "/z", "Z"),
    ]
    assert [tuple(r) for r in content.extract_images(df, "k").collect()] == [
        (1, 0, "i.png", "A & B"), (1, 1, "j.png", None),
    ]


def test_consistency_statuses(spark):
    df = spark.createDataFrame(
        [(1, "VIP 6/11 10%OFF", "<p>2024/6/11 10%OFF 500円</p>", "2024/5/30 10%OFF ゴールド")],
        "template_id int, subject string, html string, plaintext string",
    )
    got = {(r.kind, r.value): r.status for r in content.content_consistency(df).collect()}
    assert got == {
        ("discount", "10%OFF"): "matched", ("date", "2024/6/11"): "missing",
        ("amount", "500円"): "missing", ("date", "2024/5/30"): "stale",
        ("stage", "ゴールド"): "stale", ("stage", "VIP"): "subject_only",
    }


@pytest.mark.parametrize(
    "compare, n, exclude, want",
    [("Less", 1, False, "c"), ("Less", 1, True, "ab"), ("Less", 2, False, "bc"),
     ("GreaterEqual", 2, False, "a"), ("Equal", 0, False, "c"), ("Equal", 1, True, "ac")],
)
def test_segment_counts_see_people_without_rows(spark, compare, n, exclude, want):
    people = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 0), (None, 1)], "k string, x int")
    out = segments.segment_count_rule(people, rows, "k", F.col("x") >= 1, compare, n, exclude)
    assert "".join(sorted(r.k for r in out.collect())) == want


def test_activation_texts(spark):
    df = spark.createDataFrame([("m", "r")], "email_raw string, rank string")
    spec = [
        {"column": "email", "source": {"column": "email_raw"}},
        {"column": "code", "source": {"string": "$1/$2", "parameters": [
            {"type": "String", "string": "A"}, {"type": "Column", "column": "rank"}]}},
    ]
    assert segments.activation_projection(df, spec).first().asDict() == {"email": "m", "code": "A/r"}
    assert segments.activation_projection(df, spec, True).columns == ["email_raw", "rank", "email", "code"]


def test_latest_version(spark):
    df = spark.createDataFrame([("n", "9"), ("n", "10"), ("m", "x")], "name string, id string")
    assert sorted(map(tuple, segments.latest_version_by_name(df).collect())) == [("m", "x"), ("n", "10")]


def test_feed_run_exports_every_channel_or_none(spark, tmp_path):
    t = views(spark, SF, *MASTERS)
    paths = feed_run.run_feeds(t, CFG, AS_OF, f"file://{tmp_path}", ("rtb_house", "yahoo_shopping"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["rtb_house_20240131", "yahoo_shopping_20240131"]
    assert spark.read.option("header", True).csv(paths["rtb_house"]).count() > 0
    empty = {**t, "feed_sku": t["feed_sku"].limit(0)}
    with pytest.raises(base.FeedValidationError):
        feed_run.run_feeds(empty, CFG, AS_OF, f"file://{tmp_path}/none")
    assert not (tmp_path / "none").exists()


def test_sheet_dates_and_odd_numbers(spark):
    grid = spark.createDataFrame(
        [("f", "s", 0, ["Joined On", "X"]), ("f", "s", 1, ["60.5", "1"]), ("f", "s", 2, ["n/a", "2"]), ("f", "s", 3, [None, "3"])],
        "file string, sheet string, row_idx int, cells array<string>",
    )
    spec = ingest.SheetSpec("s", "t", dates=("joined_on",))
    got = {r.x: r.joined_on for r in ingest.ingest_sheet(grid, spec, AS_OF).collect()}
    assert got == {1: "1900-02-28T12:00:00", 2: "n/a", 3: None}


def test_references_are_decoded_once(spark):
    text = "&#128512; &#x2764; &eacute; &amp;lt; &#xD800; &nosuch; a&b &notin; &AMP;"
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    got = [r.t for r in df.select(content.decode_entities(F.col("t")).alias("t")).collect()]
    assert got == ["😀 ❤ é &lt; \ufffd &nosuch; a&b ∉ &", None, ""]
