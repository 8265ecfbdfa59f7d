"""Message, segment, sheet, export and streaming queries, and their oracles."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import timedelta, timezone

from pyspark.sql import functions as F

from registry.common import AS_OF, LOCAL_MIDNIGHT, NOW, views, win, with_views
from registry.feeds import FEEDS
from registry.feeds import _channel as channel_query
from storelens.config import CartConfig
from storelens.functions import timewin
from storelens.operators.ranking import ntiles
from storelens.operators.staging import stage, staging_path
from storelens.plans import content, ingest, segments
from storelens.plans.cart import weblog
from storelens.sources import sinks
from storelens.sources.tables import configure, read_table
from storelens.sources.views import view
from storelens.streaming import cart_sessions

UTM = {"utm_source": "email", "utm_medium": "mail_text", "utm_campaign": "jan sale", "utm_term": ""}
DOMAIN = "example.com"
PEOPLE = ingest.SheetSpec("people", "people", header_row=1, category_row=0)
STREAM = CartConfig(session_gap_seconds=1800)


def utm(spark, sf):
    links = views(spark, sf, "links")["links"]
    return links.select("link_id", "url", content.add_utm("url", UTM, DOMAIN).alias("tagged"))


def texts(spark, sf):
    pages = views(spark, sf, "templates")["templates"]
    return pages.select("template_id", content.html_to_text("html").alias("text"))


def links(spark, sf):
    return content.extract_links(views(spark, sf, "templates")["templates"], "template_id")


def images(spark, sf):
    return content.extract_images(views(spark, sf, "templates")["templates"], "template_id")


def entities(spark, sf):
    pages = views(spark, sf, "templates")["templates"]
    return content.extract_entities(
        pages.select("template_id", content.html_to_text("html").alias("text")), "template_id", "text"
    )


def consistency(spark, sf):
    return content.content_consistency(views(spark, sf, "templates")["templates"])


def sentence_gaps(spark, sf):
    return content.sentence_differences(views(spark, sf, "templates")["templates"])


BOUGHT = "event_type = 'purchase'"


def _rule(compare, n, exclude=False):
    def query(spark, sf):
        t = views(spark, sf, "members", "clicks")
        return segments.segment_count_rule(
            t["members"], t["clicks"], "member_id", BOUGHT, compare, n, exclude
        ).select("member_id", "gender", "age_band")

    return query


def activation(spark, sf):
    spec = [
        {"column": "email", "source": {"column": "member_id"}},
        {
            "column": "coupon_code",
            "source": {
                "string": "$1-$2",
                "parameters": [
                    {"type": "String", "string": "C24"},
                    {"type": "Column", "column": "member_rank"},
                ],
            },
        },
    ]
    return segments.activation_projection(views(spark, sf, "members")["members"], spec, True)


def versions(spark, sf):
    part = read_table(configure(spark), sf, "part")
    rows = part.select(
        F.col("p_name").alias("name"), F.col("p_partkey").cast("string").alias("id"), "p_size"
    )
    return segments.latest_version_by_name(rows)


def sheet_types(spark, sf):
    rows = ingest.sheet_rows(views(spark, sf, "grid")["grid"], PEOPLE)
    return spark.createDataFrame(sorted(ingest.infer_types(rows).items()), "name string, type string")


def sheet(spark, sf):
    return ingest.ingest_sheet(views(spark, sf, "grid")["grid"], PEOPLE, AS_OF)


def serials(spark, sf):
    """Spreadsheet date numbers around the turn of the calendar and with fractions."""
    days = read_table(configure(spark), sf, "part").select(
        (F.col("p_partkey") / 8.0 + F.col("p_size")).alias("serial")
    )
    return days.distinct().select("serial", ingest.excel_serial_time("serial").alias("iso"))


def intervals(spark, sf):
    t = views(spark, sf, "clicks")["clicks"]
    parts = [
        timewin.in_window(t, spec, AS_OF).agg(
            F.lit(spec).alias("spec"), F.count("*").alias("n"), F.sum("event_id").alias("ids")
        )
        for spec in ("-1d", "-3d/now", "-30d", "0d/now")
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def absolute_range(spark, sf):
    t = views(spark, sf, "clicks")["clicks"]
    open_start = timewin.in_range(t, None, AS_OF - timedelta(days=10))
    return open_start.groupBy(
        timewin.local_format("ts", "yyyy-MM-dd").alias("day"),
        timewin.local_format("ts", "HH").alias("hour"),
    ).agg(F.count("*").alias("n"))


def tiles(spark, sf):
    """Exact tiles of very uneven and of continuous measures, with missing values and a missing key."""
    part = read_table(configure(spark), sf, "part")
    rows = part.select(
        F.when(F.col("p_partkey") != 5, F.col("p_partkey").cast("string")).alias("pk"),
        F.when(F.col("p_size") % 6 != 0, F.col("p_size")).alias("size"),
        F.when(F.col("p_partkey") % 9 != 0, F.col("p_retailprice")).alias("price"),
    )
    return ntiles(rows, "pk", {"by_size": F.col("size"), "by_price": -F.col("price")}, 7)


def _home(spark):
    return staging_path(spark, "export")


def quoted_csv(spark, sf):
    feed, path = channel_query("yahoo_shopping")(spark, sf), _home(spark)
    sinks.write_quoted_csv(feed, path)
    back = spark.read.option("header", True).option("escape", '"').option("lineSep", "\r\n")
    return back.schema(feed.schema).csv(path).fillna("")


def plain_csv(spark, sf):
    feed, path = channel_query("rtb_house")(spark, sf), _home(spark)
    sinks.write_plain_csv(feed, path)
    back = spark.read.option("header", True).option("escape", '"').option("lineSep", "\r\n")
    return back.schema(feed.schema).option("nullValue", "NULL").csv(path)


def json_lines(spark, sf):
    members, path = views(spark, sf, "members")["members"], _home(spark)
    sinks.write_json_lines(members, path, AS_OF)
    schema = "time long, " + ", ".join(f"{c} string" for c in members.columns)
    return spark.read.schema(schema).json(path)


def _stream(spark, sf):
    configure(spark)
    raw = read_table(spark, sf, "events")
    events = spark.readStream.schema(raw.schema).parquet(f"{sf}/events*.parquet")
    source = view(spark, sf, "source_web_events", {"events": events})
    return cart_sessions.due_carts(weblog.visits(source), STREAM)


def _stream_result(spark, sf):
    return cart_sessions.run_to_end(_stream(spark, sf), "cart-sessions")


def stream_sessions(spark, sf):
    out = _stream_result(spark, sf)
    return out.select(
        "session_id",
        "cookie",
        "user_id_comp",
        F.unix_seconds("session_start").alias("session_start"),
        F.unix_seconds("last_session_time").alias("last_session_time"),
        "n",
    )


def stream_items(spark, sf):
    out = cart_sessions.cart_items(_stream_result(spark, sf), STREAM)
    return out.withColumn("ts", F.unix_seconds("ts"))


#: half days after which the capped sends run: start, end
HALVES = [(LOCAL_MIDNIGHT + timedelta(hours=12 * k), LOCAL_MIDNIGHT + timedelta(hours=12 * k + 12)) for k in range(-6, 2)]


def capped_sends(spark, sf):
    """Released carts of eight half days as batches in order, each against the sends before; one batch is repeated."""
    carts = stage(stream_sessions(spark, sf).select("user_id_comp", F.timestamp_seconds("last_session_time").alias("ts")))
    browsed = view(spark, sf, "browser_history")
    path, at = _home(spark), []
    cart_sessions.open_history(spark, path)
    run = cart_sessions.send_batches(STREAM, path, browsed, lambda: at[-1])
    for no, (start, end) in enumerate(HALVES):
        at.append(end - timedelta(seconds=1))
        run(timewin.in_range(carts, start, end), no)
        if no == 2:
            run(timewin.in_range(carts, start, end), no)
    sent = spark.read.schema(cart_sessions.HISTORY).parquet(path)
    return sent.select("email", "scheduled_time", "sent_on", "batch_id")


def replaced_table(spark, sf):
    """A table that is made, filled, emptied and filled again, as seen by a reader of each content."""
    clicks = views(spark, sf, "clicks")["clicks"].select("event_id", "member_id", "event_type")
    name, home = f"storelens_swap_{uuid.uuid4().hex}", _home(spark)
    seen = []
    try:
        for kind in ("purchase", None, "signup"):
            sinks.replace_table(clicks.filter(F.col("event_type") == F.lit(kind)), name, home)
            seen.append(spark.table(name).withColumn("step", F.lit(len(seen))))
        # readers of the former contents come after the last change
        rows = seen[0].unionByName(seen[1]).unionByName(seen[2])
        return stage(rows.select("step", "event_id", "member_id", "event_type"))
    finally:
        spark.sql(f"drop table if exists {name}")


def loaded_sheets(spark, sf):
    """Two sheets loaded as one commit, a second book appended, and both calls repeated."""
    grid = views(spark, sf, "grid")["grid"]
    head = F.col("row_idx") < 2
    odd, even = (grid.filter(head | (F.col("row_idx") % 2 == n)) for n in (1, 0))
    first = stage(odd.withColumn("sheet", F.lit("odd")).unionByName(even.withColumn("sheet", F.lit("even"))))
    second = even.withColumns({"sheet": F.lit("odd"), "file": F.lit("later.xlsx")})
    specs = [replace(PEOPLE, sheet="odd", table="members"), replace(PEOPLE, sheet="even", table="others")]
    home = _home(spark)
    for _ in range(2):
        ingest.load_sheets(first, specs, AS_OF, home, "first")
        ingest.load_sheets(second, specs, AS_OF + timedelta(hours=1), home, "second", "append")
    parts = [ingest.loaded(spark, home, s.table).withColumn("target", F.lit(s.table)) for s in specs]
    # the second sheet alone has whole numbers in this column
    parts = [p.withColumn("money_col", F.col("money_col").cast("string")) for p in parts]
    return parts[0].unionByName(parts[1])


QUERIES = {
    "A09_replace_table": replaced_table,
    "I05_stream_capped_sends": capped_sends,
    "M26_load_sheets": loaded_sheets,
    "N5_add_utm": utm,
    "N6_html_to_text": texts,
    "N7_extract_links": links,
    "N7_extract_images": images,
    "N8_extract_entities": entities,
    "N9_content_consistency": consistency,
    "N9_sentence_differences": sentence_gaps,
    "M25_infer_types": sheet_types,
    "M26_ingest_grid": sheet,
    "M27_segment_never_bought": _rule("Less", 1),
    "M27_segment_fewer_than": _rule("Less", 12),
    "M27_segment_at_least": _rule("GreaterEqual", 14),
    "M27_segment_exclude": _rule("GreaterEqual", 14, True),
    "M28_activation_projection": activation,
    "M29_latest_version_by_name": versions,
    "A02_relative_interval_scan": intervals,
    "A03_absolute_range_scan": absolute_range,
    "A12_export_quoted_csv": quoted_csv,
    "A13_export_plain_csv": plain_csv,
    "A14_json_lines": json_lines,
    "E04_exact_ntile": tiles,
    "H25_spreadsheet_serial": serials,
    "I01_stream_cart_sessions": stream_sessions,
    "I04_stream_last_cart": stream_items,
}

# ---------------------------------------------------------------- oracles

BLANKS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


#: references that occur in the data, the ampersand last
REFERENCES = {
    "&quot;": '"',
    "&lt;": "<",
    "&gt;": ">",
    "&copy;": "©",
    "&#169;": "©",
    "&middot;": "·",
    "&eacute;": "é",
    "&#128512;": "😀",
    "&#x2764;": "❤",
    "&#xD800;": "\ufffd",
    "&amp;": "&",
}
#: what is compared between the parts of a message
PATTERNS = {
    "date": "[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}月[0-9]{1,2}日",
    "time": "[0-9]{1,2}:[0-9]{2}",
    "amount": "[0-9][0-9,]*円",
    "discount": "[0-9]+%OFF|[0-9]+,[0-9]+円OFF",
    "stage": "VIP|GOLD|SILVER|ゴールド|シルバー",
    "period": "開催期間|まで",
    "url": r"https?://[^\s\"<>]+",
}


def _unescape(e: str) -> str:
    for name, value in REFERENCES.items():
        quoted = value.replace("'", "''")
        e = f"replace({e}, '{name}', '{quoted}')"
    return e


def _text(e: str) -> str:
    for pattern in (
        r"(?is)<script\b[^>]*>.*?</script\s*>",
        r"(?is)<style\b[^>]*>.*?</style\s*>",
        r"(?s)<!--.*?-->",
        r"<[a-zA-Z/!][^>]*>",
    ):
        e = f"regexp_replace({e}, '{pattern}', ' ', 'g')"
    return f"trim(regexp_replace({_unescape(e)}, '{BLANKS}', ' ', 'g'))"


def _found(source: str, key: str, text: str, kinds: tuple[str, ...] = tuple(PATTERNS)) -> str:
    return " union ".join(
        f"""select {key}, '{kind}' as kind, unnest(regexp_extract_all({text}, '{pattern}')) as value
            from {source}"""
        for kind, pattern in PATTERNS.items()
        if kind in kinds
    )


CONSISTENCY = f"""
    with e as (
        select *, 'html' as side from ({_found(f"(select template_id, {_text('html')} as t from templates)", "template_id", "t")})
        union
        select *, 'html' from ({_found("templates", "template_id", "html", ("url",))})
        union all
        select *, 'text' from ({_found("templates", "template_id", "plaintext")})
        union all
        select *, 'subject' from ({_found("templates", "template_id", "subject")}))
    select template_id, kind, value, bool_or(side = 'html') as in_html,
           bool_or(side = 'text') as in_text, bool_or(side = 'subject') as in_subject,
           case when in_html and in_text then 'matched' when in_html then 'missing'
                when in_text then 'stale' else 'subject_only' end as status
    from e group by template_id, kind, value"""


def _sentences(e: str) -> str:
    return f"""(select distinct template_id, trim(unnest(regexp_split_to_array(
                    regexp_replace({e}, '{BLANKS}', ' ', 'g'), '[。．.!?！？]'))) as s from templates)"""


SENTENCES = f"""
    with h as (select * from {_sentences(_text("html"))} a where s <> ''),
    p as (select * from {_sentences("plaintext")} a where s <> '')
    select template_id, 'missing' as status, s as sentence from (select * from h except select * from p) x
    union all
    select template_id, 'stale', s from (select * from p except select * from h) y"""

UTM_SQL = r"""
    with l as (
        select link_id, url, regexp_extract(url, '^([^?#]*)', 1) as head,
               list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
                           lambda x: x <> '') as ps,
               regexp_extract(url, '#(.*)$', 1) as frag
        from links),
    k as (
        select *, list_transform(ps, lambda x: url_decode(replace(split_part(x, '=', 1), '+', ' '))) as ks,
               list_transform(ps, lambda x: url_decode(replace(
                   if(contains(x, '='), substr(x, instr(x, '=') + 1), ''), '+', ' '))) as vs
        from l),
    n as (
        select *, list_filter(ks, lambda x, i: list_position(ks, x) = i)
                  || list_filter(['utm_source', 'utm_medium', 'utm_campaign'],
                                 lambda x: not list_contains(ks, x)) as names
        from k)
    select link_id, url,
           case when url like 'mailto:%' or not contains(url, 'example.com')
                     or contains(url, '/member/') then url
                else head || '?' || array_to_string(list_transform(names, lambda x:
                         replace(url_encode(x), '%20', '+') || '=' || replace(url_encode(
                             case x when 'utm_source' then 'email' when 'utm_medium' then 'mail_text'
                                    when 'utm_campaign' then 'jan sale'
                                    else vs[len(ks) - list_position(list_reverse(ks), x) + 1] end),
                             '%20', '+')), '&')
                     || if(frag = '', '', '#' || frag) end as tagged
    from n"""
LINKS_SQL = rf"""
    with a as (
        select template_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*>.*?</a\s*>')) as a,
               generate_subscripts(regexp_extract_all(html, '(?is)<a\s[^>]*>.*?</a\s*>'), 1) - 1 as pos
        from templates)
    select template_id, cast(pos as integer) as pos,
           {_unescape("regexp_extract(a, '^<a[^>]*?href=\"([^\"]*)\"', 1)")} as href,
           {_text("a")} as anchor
    from a where regexp_extract(a, '^<a[^>]*?href="([^"]*)"', 1) <> ''"""
IMAGES_SQL = rf"""
    with a as (
        select template_id, unnest(regexp_extract_all(html, '(?i)<img\s[^>]*>')) as a,
               generate_subscripts(regexp_extract_all(html, '(?i)<img\s[^>]*>'), 1) - 1 as pos
        from templates)
    select template_id, cast(pos as integer) as pos,
           nullif(regexp_extract(a, 'src="?([^\s">]+)', 1), '') as src,
           nullif({_unescape("regexp_extract(a, 'alt=\"([^\"]*)\"', 1)")}, '') as alt
    from a"""


def _members(having: str) -> str:
    return f"""
        select member_id, gender, age_band from members left join (
            select member_id, count(*) as n from clicks where event_type = 'purchase' group by 1)
            using (member_id)
        where {having}"""


ACTIVATION = """select gender, age_band, area, member_rank, member_id, member_id as email,
                       'C24-' || coalesce(member_rank, '') as coupon_code from members"""
VERSIONS = """select p_name as name, cast(max(p_partkey) as varchar) as id,
                     arg_max(p_size, p_partkey) as p_size from part group by p_name"""
TYPES = """select * from (values ('excel_name', 'string'), ('excel_sheet_name', 'string'),
               ('member_full_name', 'string'), ('member_id', 'bigint'), ('money_balance_jpy', 'double'),
               ('money_col', 'string'), ('money_date_2024_01_05', 'double')) t(name, type)"""
SHEET = """
    select c_custkey as member_id, c_name as member_full_name,
           if(c_custkey % 7 = 0 or c_custkey % 11 = 0, null, c_acctbal) as money_balance_jpy,
           if(c_custkey % 3 = 0, 1.5, c_custkey % 9) as money_date_2024_01_05,
           case c_custkey % 4 when 0 then '7' when 1 then 'x' end as money_col,
           'book.xlsx' as excel_name, 'people' as excel_sheet_name, 1706659200 as time
    from customer where c_custkey % 20 <> 0"""
SERIALS = """
    select serial, strftime(if(serial >= 60, timestamp '1899-12-30', timestamp '1899-12-31')
                            + to_microseconds(cast(serial * 86400000000 as bigint)),
                            '%Y-%m-%dT%H:%M:%S') as iso
    from (select distinct p_partkey / 8 + p_size as serial from part) s"""
INTERVALS = " union all ".join(
    f"select '{spec}' as spec, count(*) as n, cast(sum(event_id) as bigint) as ids from clicks where {w}"
    for spec, w in (
        ("-1d", win(1)),
        ("-3d/now", win(3, now=True)),
        ("-30d", win(30)),
        ("0d/now", win(0, now=True)),
    )
)
RANGE = f"""select strftime(ts + interval 9 hours, '%Y-%m-%d') as day,
                   strftime(ts + interval 9 hours, '%H') as hour, count(*) as n
            from clicks where ts < {NOW} - interval 10 days group by all"""
TILES = """
    with rows as (
        select if(p_partkey <> 5, cast(p_partkey as varchar), null) as pk,
               if(p_size % 6 <> 0, p_size, null) as size,
               if(p_partkey % 9 <> 0, p_retailprice, null) as price
        from part)
    select pk, ntile(7) over (order by size nulls last, coalesce(md5(pk), '')) as by_size,
           ntile(7) over (order by price desc nulls last, coalesce(md5(pk), '')) as by_price
    from rows"""
STREAM_SQL = """
    with v as (
        select ts, event_id, if(coalesce(td_ssc_id, '') = '', td_client_id, td_ssc_id) as cookie,
               hashedmailaddress as user_id, td_path, items
        from source_web_events
        where coalesce(td_user_agent, '') not like '%Googlebot%'
          and coalesce(td_browser, '') not like 'Googlebot%'
          and td_client_id not in ('undefined', '00000000-0000-4000-8000-000000000000')),
    f as (
        select *, coalesce(ts - lag(ts) over w > interval 30 minutes, true) as is_new,
               coalesce(lead(ts) over w, (select max(ts) from v) - interval 1 minute) - ts > interval 20 minutes as falls_idle
        from v window w as (partition by cookie order by ts, event_id)),
    n as (select *, count(*) filter (is_new) over (partition by cookie order by ts, event_id) as no from f),
    s as (
        select cookie, no, falls_idle, ts, event_id, min(ts) over w as first_ts, max(user_id) over w as user_id_comp,
               count(*) over w as n, bool_or(td_path like '%thank-you') over w as bought
        from n window w as (partition by cookie, no order by ts, event_id)),
    seen as (
        select cookie, no, ts, event_id, item ->> '$.item_id' as item_id, item ->> '$.item_name' as item_name,
               item ->> '$.item_category' as item_category, ord
        from (select cookie, no, ts, event_id, unnest(json_extract(items, '$[*]')) as item,
                     generate_subscripts(json_extract(items, '$[*]'), 1) as ord
              from n where td_path = '/cart' and json_valid(items)) i),
    carts as (
        select s.*, i.item_id, i.item_name, i.item_category,
               row_number() over (partition by s.cookie, s.no, s.ts, s.event_id, i.item_id
                                  order by i.ts desc, i.ord, i.event_id desc) as newest,
               i.ts as item_ts, i.ord as item_ord, i.event_id as item_event
        from s join seen i on i.cookie = s.cookie and i.no = s.no and (i.ts, i.event_id) <= (s.ts, s.event_id)
        where s.falls_idle and not s.bought and i.item_id <> ''),
    listed as (
        select *, row_number() over (partition by cookie, no, ts, event_id
                                     order by item_ts desc, item_ord, item_event desc) as seq_no
        from carts where newest = 1)
    select sha256(cookie || '|' || cast(cast(floor(epoch(first_ts)) as bigint) as varchar)) as session_id, *
    from listed"""
STREAM_ITEMS = f"""
    select session_id, user_id_comp as email, cast(floor(epoch(ts)) as bigint) as ts, item_id as last_item_id,
           item_name as last_item_name, item_category as last_item_category, cast(seq_no as integer) as seq_no
    from ({STREAM_SQL}) s where seq_no <= 4"""
STREAM_SESSIONS = f"""
    select session_id, cookie, user_id_comp, cast(floor(epoch(first_ts)) as bigint) as session_start,
           cast(floor(epoch(ts)) as bigint) as last_session_time, n
    from ({STREAM_SQL}) s where seq_no = 1"""


def _empty(feed: str, columns: str) -> str:
    return f"select {', '.join(f'coalesce({c}, {chr(39)}{chr(39)}) as {c}' for c in columns.split())} from ({feed}) f"


CAPPED = f"""
    with carts as (
        select distinct user_id_comp as email, cast(floor((epoch(ts) - {int(HALVES[0][0].replace(tzinfo=timezone.utc).timestamp())}) / 43200) as bigint) as no
        from ({STREAM_SQL}) s where seq_no = 1 and coalesce(user_id_comp, '') <> ''),
    asked as (
        select email, no, strftime(timestamp '{HALVES[0][0]}' + interval 9 hours + to_days(cast(no // 2 as integer)), '%Y-%m-%d') as sent_on
        from carts where no between 0 and 7),
    allowed as (
        select email, no, sent_on from asked a
        where (select count(*) from browser_history b where b.email = a.email and b.scheduled_time >= a.sent_on || ' 00:00:00') < 2)
    select email, sent_on || if(min(no) % 2 = 0, ' 11:59:59', ' 23:59:59') as scheduled_time, sent_on, min(no) as batch_id
    from allowed group by email, sent_on"""
REPLACED = """
    select case event_type when 'purchase' then 0 else 2 end as step, event_id, member_id, event_type
    from clicks where event_type in ('purchase', 'signup')"""
LOADED = f"""
    with s as (select * from ({SHEET}) x)
    select * replace ('odd' as excel_sheet_name), 'members' as target from s where member_id % 2 = 1
    union all
    select * replace ('odd' as excel_sheet_name, 'later.xlsx' as excel_name, time + 3600 as time), 'members' from s where member_id % 2 = 0
    union all
    select * replace ('even' as excel_sheet_name), 'others' from s where member_id % 2 = 0"""
YAHOO_COLUMNS = """item_id item_name item_description item_url image_url brand category color size price
    availability condition stock_quantity sale_price gtin jan_code"""
ORACLES = {
    "A09_replace_table": REPLACED,
    "I05_stream_capped_sends": CAPPED,
    "M26_load_sheets": LOADED,
    "N5_add_utm": UTM_SQL,
    "N6_html_to_text": f"select template_id, {_text('html')} as text from templates",
    "N7_extract_links": LINKS_SQL,
    "N7_extract_images": IMAGES_SQL,
    "N8_extract_entities": _found(f"(select template_id, {_text('html')} as t from templates)", "template_id", "t"),
    "N9_content_consistency": CONSISTENCY,
    "N9_sentence_differences": SENTENCES,
    "M25_infer_types": TYPES,
    "M26_ingest_grid": SHEET,
    "M27_segment_never_bought": _members("n is null"),
    "M27_segment_fewer_than": _members("coalesce(n, 0) < 12"),
    "M27_segment_at_least": _members("n >= 14"),
    "M27_segment_exclude": _members("coalesce(n, 0) < 14"),
    "M28_activation_projection": ACTIVATION,
    "M29_latest_version_by_name": VERSIONS,
    "A02_relative_interval_scan": INTERVALS,
    "A03_absolute_range_scan": RANGE,
    "A12_export_quoted_csv": _empty(FEEDS["yahoo_shopping"], YAHOO_COLUMNS),
    "A13_export_plain_csv": FEEDS["rtb_house"],
    "A14_json_lines": "select 1706659200 as time, * from members",
    "E04_exact_ntile": TILES,
    "H25_spreadsheet_serial": SERIALS,
    "I01_stream_cart_sessions": STREAM_SESSIONS,
    "I04_stream_last_cart": STREAM_ITEMS,
}
ORACLES = {k: with_views(v) for k, v in ORACLES.items()}
