"""Cart-abandonment queries and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import AS_OF, LOCAL_MIDNIGHT, views, win, with_views
from storelens.config import CartConfig
from storelens.plans.cart import payload, run, sendlist, targets, weblog
from storelens.sources.tables import split_source

CFG = CartConfig(window="-2d/now", session_gap_seconds=43200)
ROLLING = CFG.but(rolling_cap=True)
LOG_TABLES = ("source_web_events", "ip_ranges")
TARGET_TABLES = (*LOG_TABLES, "orders_raw", "identity_map", "suppression")
SEND_TABLES = (*TARGET_TABLES, "rfm", "cart_history", "browser_history", "product_detail")
RECO_TABLES = (*SEND_TABLES, "product_stock", "popularity", "coview", "fbt", "order_history")
MAIL_TABLES = (*RECO_TABLES, "customers", "attributes")
RECIPIENTS = "qa@example.com,dev+x@example.org"
KEPT = [
    ("f3plus", "all4", "ps_all4", "pts"),
    ("f3plus", "all4", "ps_partial", "nopts"),
    ("unknown", "all4", "ps_partial", "pts"),
    ("f0", "none", "ps_none", "nopts"),
]


def _seconds(df, *cols):
    return df.withColumns({c: F.unix_seconds(c) for c in cols or ("ts",)})


PREPARED = [
    "event_id", "ts", "td_data_type", "cookie", "cookie_type", "td_client_id", "user_id",
    "utm_campaign", "utm_medium", "utm_source", "utm_term", "td_ref_host", "td_host", "td_path",
    "ua_os", "ua_vendor", "ua_os_version", "ua_browser", "ua_category",
    "ip_country", "ip_prefectures", "ip_city",
    "td_item_id", "td_item_name", "td_item_category", "td_item_price", "td_item_ord", "ecommerce",
]
LOGGED = [
    "event_id", "ts", "access_date_time", "access_date", "access_hour", "session_start_time",
    "session_end_time", "session_id", "session_num", "browsing_sec", "td_cookie", "user_id_comp",
    "td_source_medium", "td_source", "td_medium", "article_key", "ip_prefectures", "ip_city",
    "td_item_id", "td_item_ord", "ecommerce",
]


def _log(t):
    return run.sessions(t, CFG, AS_OF)


def _staged_log(t):
    return run.stage(_log(t))


def prepared(spark, sf):
    t = views(spark, sf, *LOG_TABLES)
    return _seconds(
        weblog.prepare_web_events(t["source_web_events"], t["ip_ranges"], CFG, AS_OF).select(*PREPARED)
    )


def night(spark, sf):
    """The night run's window: 20:00 of the day before to 08:00, local time."""
    from datetime import timedelta, timezone

    midnight = LOCAL_MIDNIGHT.replace(tzinfo=timezone.utc)
    bounds = (midnight - timedelta(hours=4), midnight + timedelta(hours=8))
    t = views(spark, sf, *LOG_TABLES)
    df = weblog.prepare_web_events(t["source_web_events"], t["ip_ranges"], CFG, AS_OF, bounds)
    return _seconds(df.select(*PREPARED))


def mediums(spark, sf):
    t = views(spark, sf, *LOG_TABLES)
    df = weblog.prepare_web_events(
        t["source_web_events"], t["ip_ranges"], CFG.but(window="-60d/now"), AS_OF
    )
    df = weblog.classify_source_medium(df)
    return df.groupBy("td_source_medium", "td_source", "td_medium").agg(F.count("*").alias("n"))


def logged(spark, sf):
    return _seconds(_log(views(spark, sf, *LOG_TABLES)).select(*LOGGED))


def half_hour_sessions(spark, sf):
    """Sessions with the default pause of 30 minutes over the whole log."""
    t = views(spark, sf, *LOG_TABLES)
    cfg = CartConfig(window="-60d/now")
    log = run.sessions(t, cfg, AS_OF)
    return log.groupBy("session_id", "session_start_time", "session_end_time").agg(
        F.count("*").alias("n"), F.max("session_num").alias("last_num"), F.sum("browsing_sec").alias("sec")
    )


def last_sessions(spark, sf):
    return _seconds(targets.last_session(_log(views(spark, sf, *LOG_TABLES))), "last_session_time")


def purchase_sessions(spark, sf):
    log = _log(views(spark, sf, *LOG_TABLES))
    return _seconds(targets.purchase_session(log), "last_purchase_time")


def candidate_sessions(spark, sf):
    log = _log(views(spark, sf, *LOG_TABLES))
    return _seconds(
        targets.candidate_session(targets.last_session(log), CFG, AS_OF), "last_session_time"
    )


def in_cart(spark, sf):
    return _seconds(targets.last_in_cart(_log(views(spark, sf, *LOG_TABLES)), CFG))


def purchasers(spark, sf):
    return targets.recent_purchasers(views(spark, sf, "orders_raw")["orders_raw"], CFG, AS_OF)


def target_rows(spark, sf):
    t = views(spark, sf, *TARGET_TABLES)
    return _seconds(run.cart_targets(t, _staged_log(t), CFG, AS_OF))


def identities(spark, sf):
    return targets.identity_dedup(views(spark, sf, "identity_map")["identity_map"])


def _candidates(t):
    rows = run.stage(run.cart_targets(t, _staged_log(t), CFG, AS_OF))
    return targets.candidate_send_list(rows, t["identity_map"], t["rfm"], CFG)


def send_candidates(spark, sf):
    return _seconds(_candidates(views(spark, sf, *SEND_TABLES)))


def _capped(cfg):
    def query(spark, sf):
        t = views(spark, sf, *SEND_TABLES)
        return _seconds(
            sendlist.frequency_cap(
                _candidates(t), t["cart_history"], t["browser_history"], cfg, AS_OF
            )
        )

    return query


def _carts(t):
    return run.carts(t, _staged_log(t), CFG, AS_OF)


def cart_rows(spark, sf):
    return _carts(views(spark, sf, *SEND_TABLES))


def reco_new(spark, sf):
    t = views(spark, sf, *RECO_TABLES)
    return sendlist.segment_reco_new(_carts(t), t, CFG)


def reco_f1(spark, sf):
    t = views(spark, sf, *RECO_TABLES)
    return sendlist.segment_reco_f1(run.stage(_carts(t)), t, CFG, AS_OF)


def reco_f3plus(spark, sf):
    t = views(spark, sf, *RECO_TABLES)
    return sendlist.segment_reco_f3plus(run.stage(_carts(t)), t, CFG, AS_OF)


def push(spark, sf):
    return run.push_list(views(spark, sf, *RECO_TABLES), CFG, AS_OF)


def _push(t):
    return run.stage(run.push_list(t, CFG, AS_OF))


def mails(spark, sf):
    t = views(spark, sf, *MAIL_TABLES)
    return payload.send_payload(
        _push(t), t["customers"], t["attributes"], t["product_stock"], CFG, AS_OF
    )


def low_stock_mails(spark, sf):
    t = views(spark, sf, *MAIL_TABLES)
    return payload.send_payload_low_stock(_push(t), t["customers"], t["attributes"], CFG)


def _history(t):
    return payload.send_history(_push(t), t["attributes"], t["product_stock"], CFG, AS_OF)


def history(spark, sf):
    return _history(views(spark, sf, *MAIL_TABLES))


SEGMENTS = list(sendlist.SEGMENTS)


def samples(spark, sf):
    t = views(spark, sf, *MAIL_TABLES)
    return payload.pattern_sample(run.stage(_history(t)), t["attributes"], CFG, SEGMENTS, "normal")


def kept_samples(spark, sf):
    t = views(spark, sf, *MAIL_TABLES)
    return payload.pattern_sample(
        run.stage(_history(t)),
        t["attributes"],
        CFG,
        SEGMENTS,
        "ca",
        KEPT,
        split_source(spark, RECIPIENTS, "email_address"),
    )


def assembled(spark, sf):
    t = views(spark, sf, *MAIL_TABLES)
    return payload.fixture_payloads(
        run.stage(_history(t)),
        t["product_stock"],
        split_source(spark, RECIPIENTS, "email_address"),
        CFG,
        AS_OF,
    )


def batches(spark, sf):
    """Batch sizes of the delivery of all subscribers; only the last may be short."""
    people = payload.subscribers(views(spark, sf, "customers")["customers"])
    rows = sendlist.delivery_batches(people.select("email"), 1000)
    return rows.groupBy("batch_no").agg(F.count("*").alias("n"))


QUERIES = {
    "M01_prepare_web_events": prepared,
    "M01_prepare_web_events_night": night,
    "M02_classify_source_medium": mediums,
    "M03_sessionize_weblog": logged,
    "M03_half_hour_sessions": half_hour_sessions,
    "M04_last_session": last_sessions,
    "M04_purchase_session": purchase_sessions,
    "M05_candidate_session": candidate_sessions,
    "M06_last_in_cart": in_cart,
    "M07_recent_purchasers": purchasers,
    "M08_target_sessions": target_rows,
    "M09_identity_dedup": identities,
    "M10_candidate_send_list": send_candidates,
    "M11_frequency_cap_day": _capped(CFG),
    "M12_frequency_cap_rolling": _capped(ROLLING),
    "M13_cart_pivot": cart_rows,
    "M14_segment_reco_new": reco_new,
    "M15_segment_reco_f1": reco_f1,
    "M16_segment_reco_f3plus": reco_f3plus,
    "M17_push_send_list": push,
    "M18_send_payload": mails,
    "M19_send_payload_low_stock": low_stock_mails,
    "M20_send_history": history,
    "M21_pattern_sample": samples,
    "M21_pattern_sample_kept": kept_samples,
    "M22_fixture_payloads": assembled,
    "A15_delivery_batches": batches,
}

# ---------------------------------------------------------------- oracles

HOST = r"^[a-z]+://([^/?#]+)"


def _param(name: str) -> str:
    return f"nullif(regexp_extract(td_url, '[?&]{name}=([^&#]*)', 1), '')"


def _prep(where: str) -> str:
    return f"""
    select e.event_id, cast(floor(epoch(e.ts)) as bigint) as ts, 'pageview' as td_data_type,
           if(coalesce(td_ssc_id, '') = '', td_client_id, td_ssc_id) as cookie,
           if(coalesce(td_ssc_id, '') = '', 'td_client_id', 'td_ssc_id') as cookie_type,
           td_client_id, hashedmailaddress as user_id,
           {_param("utm_campaign")} as utm_campaign, {_param("utm_medium")} as utm_medium,
           {_param("utm_source")} as utm_source, {_param("utm_term")} as utm_term,
           nullif(regexp_extract(td_referrer, '{HOST}', 1), '') as td_ref_host,
           regexp_extract(td_url, '{HOST}', 1) as td_host, td_path,
           case when agent like '%Windows NT%' then 'Windows' when agent like '%iPhone%' then 'iOS'
           end as ua_os,
           case when agent like '%Chrome/%' then 'Google' when agent like '%Safari/%' then 'Apple'
           end as ua_vendor,
           case when agent like '%Windows NT 10.0%' then '10.0'
                when agent like '%OS 17_2%' then '17.2' end as ua_os_version,
           case when agent like '%Chrome/%' then 'Chrome' when agent like '%Safari/%' then 'Safari'
           end as ua_browser,
           case when agent like '%iPhone%' then 'smartphone' when agent like '%Windows%' then 'pc'
           end as ua_category,
           country as ip_country, prefecture as ip_prefectures, city as ip_city,
           item ->> '$.item_id' as td_item_id, item ->> '$.item_name' as td_item_name,
           item ->> '$.item_category' as td_item_category, item ->> '$.price' as td_item_price,
           cast(ord as integer) as td_item_ord,
           case when td_path like '%/checkouts/%thank-you' then 'purchase_thank_you' end as ecommerce,
           td_url
    from (select *, coalesce(td_user_agent, '') as agent,
                 list_reduce([0] || cast(string_split(td_ip, '.') as bigint[]),
                             lambda a, b: a * 256 + b) as ip_n
          from source_web_events) e
         left join ip_ranges r on ip_n between lo and hi
         left join (select event_id, unnest(json_extract(items, '$[*]')) as item,
                           generate_subscripts(json_extract(items, '$[*]'), 1) as ord
                    from source_web_events where json_valid(items)) i on i.event_id = e.event_id
    where {where} and agent not like '%Googlebot%'
      and coalesce(td_browser, '') not like 'Googlebot%'
      and td_client_id not in ('undefined', '00000000-0000-4000-8000-000000000000')"""


MEDIUM = r"""
    case when utm_source is not null and utm_medium is not null then utm_source || '/' || utm_medium
         when utm_source is not null then utm_source || '/(none)'
         when utm_medium is not null then '(none)/' || utm_medium
         when td_url like '%gclid%' then 'google/cpc' when td_url like '%fbclid%' then 'facebook/ad'
         when td_url like '%yclid%' then 'yahoo/ad' when td_url like '%ttclid%' then 'tiktok/ad'
         when coalesce(td_ref_host, '') in ('', td_host) then '(direct)/(none)'
         when td_ref_host = 'mail.google.com' then 'google/mail'
         when td_ref_host = 'www.facebook.com' then 'facebook/social'
         when td_ref_host = 'search.yahoo.co.jp' then 'yahoo/organic'
         when td_ref_host = 'www.google.com' then 'google/organic'
         else td_ref_host || '/referral' end"""


def _sessions(prep: str, gap: int) -> str:
    return f"""
    with p as materialized ({prep}),
    flagged as (
        select *, {MEDIUM} as td_source_medium,
               coalesce(ts - lag(ts) over w > {gap}, true) as is_new
        from p window w as (partition by cookie order by ts, event_id, td_item_ord)),
    numbered as (
        select *, count(*) filter (is_new) over (partition by cookie order by ts, event_id, td_item_ord
                                     rows unbounded preceding) as no
        from flagged)
    select event_id, ts,
           strftime(to_timestamp(ts) at time zone 'UTC' + interval 9 hours, '%Y-%m-%d %H:%M:%S') as access_date_time,
           strftime(to_timestamp(ts) at time zone 'UTC' + interval 9 hours, '%Y-%m-%d') as access_date,
           strftime(to_timestamp(ts) at time zone 'UTC' + interval 9 hours, '%H') as access_hour,
           min(ts) over s as session_start_time, max(ts) over s as session_end_time,
           sha256(cookie || '|' || cast(min(ts) over s as varchar)) as session_id,
           row_number() over (partition by cookie, no order by ts, event_id, td_item_ord) as session_num,
           lead(ts) over (partition by cookie, no order by ts, event_id, td_item_ord) - ts as browsing_sec,
           cookie as td_cookie, coalesce(user_id, max(user_id) over s) as user_id_comp,
           td_source_medium, split_part(td_source_medium, '/', 1) as td_source,
           split_part(td_source_medium, '/', 2) as td_medium, td_host || td_path as article_key,
           translate(ip_prefectures, 'Ōō', 'Oo') as ip_prefectures,
           replace(ip_city, 'ō', 'o') as ip_city,
           td_item_id, td_item_name, td_item_category, td_item_price, td_item_ord, ecommerce, td_path
    from numbered window s as (partition by cookie, no)"""


TWO_DAYS = win(2, now=True, ts="e.ts")
WHOLE = win(60, now=True, ts="e.ts")
NIGHT = "e.ts >= timestamp '2024-01-30 11:00:00' and e.ts < timestamp '2024-01-30 23:00:00'"
SLOT = (1, 2, 3, 4)
DETAIL = """select item_id, max(item_name) as item_name, max(image_url) as image_url,
                   max(item_url) as item_url, max(brand_name) as brand_name
            from product_detail group by item_id"""

CHAIN: list[tuple[str, str]] = [
    ("log", _sessions(_prep(TWO_DAYS), 43200)),
    (
        "last_s",
        "select user_id_comp, session_id, max(ts) as last_session_time from log group by all",
    ),
    (
        "bought_s",
        """select user_id_comp, session_id, max(ts) as last_purchase_time from log
           where ecommerce <> '' group by all""",
    ),
    (
        "idle_s",
        "select * from last_s where last_session_time < epoch(timestamp '2024-01-30 23:40:00')",
    ),
    (
        "cart",
        """with one as (
               select *, row_number() over (partition by user_id_comp, session_id, td_item_id
                             order by ts desc, td_item_ord, event_id desc) as d
               from log where td_path = '/cart' and td_item_id <> '')
           select user_id_comp, session_id, td_item_id as last_item_id,
                  td_item_name as last_item_name, td_item_category as last_item_category,
                  td_item_price as last_item_price, ts,
                  row_number() over (partition by user_id_comp, session_id
                      order by ts desc, td_item_ord, event_id desc) as seq_no
           from one where d = 1 qualify seq_no <= 4""",
    ),
    (
        "buyers",
        f"""select distinct sha256(email) as hashed_email from orders_raw
            where {win(3, now=True)} and coalesce(cancelled_at, '') = ''
              and try_strptime(created_at, '%Y-%m-%d %H:%M:%S') >= timestamp '2024-01-29 00:00:00'""",
    ),
    (
        "target",
        """select * from cart
           where session_id in (select session_id from idle_s except select session_id from bought_s)
             and coalesce(user_id_comp, '') not in (select hashed_email from buyers)
             and coalesce(user_id_comp, '') not in (
                 select email from identity_map join suppression on prefecture = prefectures
                 where effective_to is null)""",
    ),
    (
        "person",
        """select email, td_llm_uid from identity_map where email <> ''
           qualify row_number() over (partition by email
               order by coalesce(epoch(try_strptime(updated_at, '%Y-%m-%d %H:%M:%S')), 0) desc,
                        td_llm_uid) = 1""",
    ),
    (
        "wanted",
        """select user_id_comp as email, ts, t.session_id, last_item_id, last_item_name,
                  last_item_category, last_item_price, seq_no,
                  case when f.td_llm_uid is null then 'unknown' when frequency_all = 1 then 'f0'
                       when frequency_all = 2 then 'f1' else 'f3plus' end as rfm_segment
           from target t
                left join person on person.email = user_id_comp
                left join rfm f on f.td_llm_uid = person.td_llm_uid and f.brand = 'main'
           where user_id_comp <> '' and (user_id_comp, t.session_id) in (
               select (user_id_comp, arg_max(session_id, (ts, session_id))) from target
               group by user_id_comp)""",
    ),
    (
        "mailed",
        """select email, count(*) filter (kind = 'c' and scheduled_time >= '2024-01-31 00:00:00') as c,
                  count(*) filter (kind = 'c' and scheduled_time >= '2024-01-30 09:00:00') as c24,
                  count(*) filter (kind = 'b' and scheduled_time >= '2024-01-31 00:00:00') as b
           from (select *, 'c' as kind from cart_history
                 union all select *, 'b' from browser_history) h group by email""",
    ),
    (
        "capped",
        """select w.* from wanted w left join mailed m using (email)
           where coalesce(c, 0) = 0 and coalesce(c, 0) + coalesce(b, 0) < 2""",
    ),
    (
        "carts",
        f"""with d as ({DETAIL}),
            j as (select c.*, image_url, item_url, brand_name from capped c
                  left join d on d.item_id = last_item_id)
            select email,
                   ['unknown', 'f0', 'f1', 'f3plus'][
                       max(list_position(['unknown', 'f0', 'f1', 'f3plus'], rfm_segment))] as rfm_segment,
                   max(last_item_category) filter (seq_no = 1) as last_item_category,
                   {", ".join(f"max({src}) filter (seq_no = {n}) as cart_item_seq{n}_{out}" for n in SLOT for src, out in (("last_item_id", "item_id"), ("last_item_name", "item_name"), ("image_url", "image_url"), ("item_url", "item_url"), ("brand_name", "item_brand")))}
            from j group by email""",
    ),
    (
        "offer",
        f"""select * from ({DETAIL}) d where image_url is not null
            and item_id in (select item_id from product_stock where is_available = '1')""",
    ),
    (
        "reco_new",
        """select email, o.image_url, o.item_name, o.item_url, o.brand_name,
                  row_number() over (partition by email order by popularity_score desc, p.item_id) as seq_no
           from carts c join popularity p
                on p.item_category = c.last_item_category and p.item_id <> c.cart_item_seq1_item_id
                join offer o on o.item_id = p.item_id
           where rfm_segment in ('unknown', 'f0') qualify seq_no <= 4""",
    ),
    (
        "past",
        f"""select c.email, rfm_segment, cart_item_seq1_item_id as own, product_id, handle, ts
            from carts c join person using (email) join order_history using (td_llm_uid)
            where {win(90, now=True)} and cancelled_at is null and handle <> ''""",
    ),
]


def _ranked(found: str) -> str:
    return f"""
        with f as ({found}),
        placed as (
            select f.email, f.item_id, o.image_url, o.item_name, o.item_url, o.brand_name,
                   row_number() over (partition by email order by pri, score desc, item_id) as seq_no
            from f join offer o using (item_id))
        select email, image_url, item_name, item_url, brand_name, seq_no from placed
        qualify row_number() over (partition by email, item_id order by seq_no) = 1 and seq_no <= 4"""


def _popular_sql(segment: str) -> str:
    return f"""
        select email, p.item_id, cast(popularity_score as double) as score, 3 as pri
        from carts c join popularity p
             on p.item_category = c.last_item_category and p.item_id <> c.cart_item_seq1_item_id
        where rfm_segment = '{segment}'"""


CHAIN += [
    (
        "reco_f1",
        _ranked(f"""
            select email, item_b as item_id, co_view_sessions as score, 1 as pri
            from lastp join coview on item_a = handle where item_b <> own
            union all
            select email, item_b_handle, co_purchase_users, 2
            from lastp join fbt on item_a = product_id
            where item_b_handle <> own and item_b_handle <> ''
            union all {_popular_sql("f1")}"""),
    ),
    (
        "reco_f3",
        _ranked(f"""
            select email, item_b_handle as item_id, co_purchase_users * 2 as score, 1 as pri
            from (select distinct email, own, product_id, handle from past where rfm_segment = 'f3plus') b
                 join fbt on item_a = product_id where item_b_handle <> own and item_b_handle <> ''
            union all
            select email, item_b, co_view_sessions, 2
            from (select distinct email, own, product_id, handle from past where rfm_segment = 'f3plus') b
                 join coview on item_a = handle where item_b <> own
            union all {_popular_sql("f3plus")}"""),
    ),
]
CHAIN.insert(
    -2,
    (
        "lastp",
        """select * from past where rfm_segment = 'f1'
           qualify row_number() over (partition by email order by ts desc, product_id) = 1""",
    ),
)
PARTS = (
    ("image_url", "image_url"),
    ("item_name", "item_name"),
    ("item_url", "item_url"),
    ("brand_name", "item_brand"),
)
CHAIN += [
    (
        "wide",
        "select email, "
        + ", ".join(
            f"max({src}) filter (seq_no = {n}) as r{n}_{out}" for n in SLOT for src, out in PARTS
        )
        + """ from (select * from reco_new union all select * from reco_f1
                    union all select * from reco_f3) r group by email""",
    ),
    (
        "push",
        """select c.email, rfm_segment as cart_abandon_rfm_segment,
                  cart_item_seq1_item_id as cart_abandon_item_id,
                  cart_item_seq1_item_name as cart_abandon_item_name,
                  last_item_category as cart_abandon_item_category,
                  cart_item_seq1_image_url as cart_abandon_image_url,
                  cart_item_seq1_item_url as cart_abandon_item_url,
                  cart_item_seq1_item_brand as cart_abandon_brand,
                  '2024-01-31 09:00:00' as cart_abandon_detected_at, """
        + ", ".join(
            f"coalesce(cart_item_seq{n}_{p}, '') as cart_item_seq{n}_{p}"
            for n in SLOT
            for _, p in PARTS
        )
        + ", "
        + ", ".join(
            f"coalesce(r{n}_{p}, '{'https://example.com/cart' if p == 'item_url' else ''}')"
            f" as cart_abandon_recommend_seq{n}_{p}"
            for n in SLOT
            for _, p in PARTS
        )
        + " from carts c left join wide using (email) where c.email <> ''",
    ),
]


def _comma(c: str) -> str:
    return f"coalesce(format('{{:,}}', try_cast({c} as bigint)), '')"


def _stock_of(alias: str, out: str, low: bool, masked: bool = True) -> str:
    on = f"coalesce({alias}.is_available, '') = '1'" if masked else "true"
    sale = f"{on} and {alias}.sale_flag = '1'"
    cols = [
        f"if({on}, {_comma(alias + '.taxin_price')}, '') as {out}_price",
        f"if({on}, {_comma(alias + '.taxin_compare_at_price')}, '') as {out}_price_org",
        f"if({sale}, '1', '') as {out}_sale_flag",
        f"if({sale}, coalesce({alias}.discount_rate, ''), '') as {out}_discount_rate",
    ]
    if low:
        cols.append(f"if({on}, coalesce({alias}.low_stock, ''), '') as {out}_low_stock")
    return ", ".join(cols)


HANDLE = "nullif(regexp_extract({}, '/products/([^/?]+)', 1), '')"
STOCK_JOINS = " ".join(
    f"left join product_stock k{n} on k{n}.item_id = "
    + HANDLE.format(f"p.cart_item_seq{n}_item_url")
    + f" left join product_stock q{n} on q{n}.item_id = "
    + HANDLE.format(f"p.cart_abandon_recommend_seq{n}_item_url")
    for n in SLOT
)
LOW_FLAG = (
    "if("
    + " or ".join(f"coalesce(k{n}.low_stock, '') = '1'" for n in SLOT)
    + ", '1', '') as has_low_stock"
)
COUPON = """
    '<COUPON_CODE_' || upper(cart_abandon_rfm_segment) || '>' as coupon_code,
    if(cart_abandon_rfm_segment = 'f0', '<COUPON_IMAGE_URL_F0>', '<COUPON_IMAGE_URL_DEFAULT>')
        as coupon_image_url,
    'オンライン限定 ' || if(cart_abandon_rfm_segment = 'f0', '11,000円(税込)以上で使える1,000円クーポン',
        '5,500円(税込)以上で使える500円クーポン') as coupon_description,
    '2026年8月31日(月) 23:59まで' as coupon_expiry"""
POINTS = "(select email, max(pointsapproved) as points from attributes group by email) a"
SUBSCRIBED = """(select distinct email as raw from customers
                 where email_marketing_consent = 'SUBSCRIBED') m"""


def _shown(alias: str, src: str, out: str) -> str:
    return ", ".join(
        f"if(coalesce({alias}.is_available, '') = '1', {src}_{p}, '') as {out}_{p}" for _, p in PARTS
    )


MAILS = f"""
    select raw as email, coalesce(cast(points as varchar), '0') as pointsapproved, {LOW_FLAG}, {COUPON},
           {", ".join(_shown(f"k{n}", f"p.cart_item_seq{n}", f"cart_item_seq{n}") + ", " + _stock_of(f"k{n}", f"cart_item_seq{n}", True) for n in SLOT)},
           {", ".join(_shown(f"q{n}", f"p.cart_abandon_recommend_seq{n}", f"recommend_seq{n}") + ", " + _stock_of(f"q{n}", f"recommend_seq{n}", False) for n in SLOT)}
    from push p join {SUBSCRIBED} on sha256(raw) = p.email
         left join {POINTS} on a.email = p.email {STOCK_JOINS}"""
NEWEST_PROFILE = """(select * from attributes
    qualify row_number() over (partition by email order by ts desc nulls last, member_name) = 1)"""
PROFILE = ", ".join(
    f"coalesce(recommend_seq{n}_{p}, '{'https://example.com/' if p == 'item_url' else ''}')"
    f" as recommend_seq{n}_{p}"
    for n in (5, 6, 7, 8)
    for _, p in PARTS
)
CART_RECO = ", ".join(
    f"cart_abandon_recommend_seq{n}_{p} as recommend_seq{n}_{p}" for n in SLOT for _, p in PARTS
)
LOW_MAILS = f"""
    select raw as email, coalesce(member_name, '') as member_name,
           coalesce(cast(pointsapproved as varchar), '0') as pointsapproved, {CART_RECO}, {PROFILE}
    from push p join {SUBSCRIBED} on sha256(raw) = p.email
         left join {NEWEST_PROFILE} a on a.email = p.email
    where cart_abandon_rfm_segment = 'f3plus'"""
HISTORY = f"""
    select p.email, 'cart_abandon' as send_type, 'cart_abandonment' as workflow_name,
           cart_abandon_rfm_segment as rfm_segment, 'cart_abandonment_email' as template_event_id,
           '<TEMPLATE_ID>' as template_id, coalesce(cast(points as varchar), '0') as pointsapproved,
           {LOW_FLAG}, {COUPON}, cart_abandon_item_id, cart_abandon_item_name,
           cart_abandon_image_url, cart_abandon_item_url, cart_abandon_brand,
           {", ".join(f"cart_item_seq{n}_{p}" for n in SLOT for _, p in PARTS)},
           {", ".join(f"cart_abandon_recommend_seq{n}_{p}" for n in SLOT for _, p in PARTS)},
           {", ".join(_stock_of(f"k{n}", f"cart_item_seq{n}", True) + ", " + _stock_of(f"q{n}", f"recommend_seq{n}", False) for n in SLOT)},
           cart_abandon_detected_at, '2024-01-31 09:00:00' as scheduled_time
    from push p left join {POINTS} on a.email = p.email {STOCK_JOINS}"""
CHAIN.append(("sent", HISTORY))
ALL4 = " and ".join(f"cart_abandon_recommend_seq{n}_image_url <> ''" for n in SLOT)
OWN4 = " and ".join(f"coalesce(recommend_seq{n}_image_url, '') <> ''" for n in (5, 6, 7, 8))
CHAIN.append(
    (
        "sampled",
        f"""select s.* exclude (pointsapproved), a.* exclude (email, ts),
                  case when {ALL4} then 'all4'
                       when cart_abandon_recommend_seq1_image_url <> ''
                            and cart_abandon_recommend_seq2_image_url <> '' then 'only2'
                       when cart_abandon_recommend_seq1_image_url <> '' then 'only1'
                       else 'none' end as reco_pattern,
                  case when {OWN4} then 'ps_all4'
                       when coalesce(recommend_seq5_image_url, '') <> '' then 'ps_partial'
                       else 'ps_none' end as ps_pattern,
                  if(coalesce(cast(a.pointsapproved as varchar), '0') <> '0', 'pts', 'nopts') as pts_pattern
           from sent s left join {NEWEST_PROFILE} a on a.email = s.email
           qualify row_number() over (partition by rfm_segment, reco_pattern, ps_pattern, pts_pattern
                       order by scheduled_time desc, s.email) = 1""",
    )
)
ASSEMBLED = f"""
    with items as (
        select distinct cart_abandon_item_id as item_id, cart_abandon_item_name as item_name,
               cart_abandon_image_url as image_url, cart_abandon_item_url as item_url,
               cart_abandon_brand as item_brand, coalesce(low_stock, '') as low
        from sent join product_stock k on k.item_id = cart_abandon_item_id
        where cart_abandon_image_url <> '' and cart_abandon_item_url <> '' and is_published = '1'),
    chosen as (
        select *, 'prod' || row_number() over (order by item_id) as src from items
        union all
        select *, 'low' || row_number() over (order by item_id) from items where low = '1'),
    usable as (select * from chosen where src like 'low%' or low <> '1'),
    spec as (
        select pattern, segment, points, n_reco, unnest(slots) as src,
               generate_subscripts(slots, 1) as n
        from (values ('cart1_reco0_lowstock', 'unknown', '0', 0, ['low1']),
                     ('cart2_reco0_normal', 'f0', '250', 0, ['prod1', 'prod2']),
                     ('cart3_reco1_mixed', 'f1', '500', 1, ['prod3', 'prod4', 'low2']),
                     ('cart4_reco2_normal', 'f3plus', '1200', 2, ['prod5', 'prod6', 'prod7', 'prod8']))
             v(pattern, segment, points, n_reco, slots)),
    w as (
        select pattern, any_value(segment) as cart_abandon_rfm_segment, any_value(points) as points,
               any_value(n_reco) as n_reco,
               {", ".join(f"coalesce(max({p}) filter (n = {n}), '') as cart_item_seq{n}_{p}" for n in SLOT for _, p in PARTS)},
               {", ".join(f"coalesce(max(low) filter (n = {n}), '') as low{n}" for n in SLOT)}
        from spec left join usable using (src) group by pattern),
    shown as (
        select {", ".join(f"cart_abandon_recommend_seq{n}_{p} as shown{n}_{p}" for n in (1, 2) for _, p in PARTS)}
        from sent where cart_abandon_recommend_seq1_image_url <> ''
             and cart_abandon_recommend_seq2_image_url <> ''
             and {HANDLE.format("cart_abandon_recommend_seq1_item_url")} in (
                 select item_id from product_stock where is_published = '1')
        order by scheduled_time desc, email limit 1),
    p as (
        select w.*, {", ".join(f"if(n_reco >= {n}, coalesce(shown{n}_{q}, ''), '') as cart_abandon_recommend_seq{n}_{q}" for n in (1, 2) for _, q in PARTS)},
               {", ".join(f"'' as cart_abandon_recommend_seq{n}_{q}" for n in (3, 4) for _, q in PARTS)}
        from w left join shown on n_reco > 0
        where n_reco = 0 or exists (select 1 from shown))
    select split_part(r, '@', 1) || '+ca_v2_' || pattern || '-'
               || sha256(pattern || '|' || r || '|42')[1:3] || '@' || split_part(r, '@', 2) as email,
           points as pointsapproved, {LOW_FLAG}, {COUPON},
           {", ".join(f"cart_item_seq{n}_{q}" for n in SLOT for _, q in PARTS)},
           {", ".join(f"low{n} as cart_item_seq{n}_low_stock" for n in SLOT)},
           {", ".join(f"cart_abandon_recommend_seq{n}_{q} as recommend_seq{n}_{q}" for n in SLOT for _, q in PARTS)},
           {", ".join(_stock_of(f"k{n}", f"cart_item_seq{n}", False, False) + ", " + _stock_of(f"q{n}", f"recommend_seq{n}", False, False) for n in SLOT)}
    from p {STOCK_JOINS}
         cross join (select unnest(string_split('{RECIPIENTS}', ',')) as r) x"""
LABEL = "rfm_segment || '_' || reco_pattern || '_' || ps_pattern || '_' || pts_pattern"
SAMPLE_COLUMNS = f"""coalesce(member_name, 'テストユーザー') as member_name,
    coalesce(cast(pointsapproved as varchar), '0') as pointsapproved, {CART_RECO}, {PROFILE}"""
KEPT_ROWS = ", ".join(f"{p}" for p in KEPT)


def _chain(last: str, final: str) -> str:
    parts = []
    for name, sql in CHAIN:
        parts.append(f"{name} as materialized ({sql})")
        if name == last:
            break
    return f"with {', '.join(parts)} {final}"


def _cols(names) -> str:
    return ", ".join(names)


ORACLES = {
    "M01_prepare_web_events": f"select {_cols(PREPARED)} from ({_prep(TWO_DAYS)}) p",
    "M01_prepare_web_events_night": f"select {_cols(PREPARED)} from ({_prep(NIGHT)}) p",
    "M02_classify_source_medium": f"""
        select m as td_source_medium, split_part(m, '/', 1) as td_source,
               split_part(m, '/', 2) as td_medium, count(*) as n
        from (select {MEDIUM} as m from ({_prep(WHOLE)}) p) q group by m""",
    "M03_sessionize_weblog": f"select {_cols(LOGGED)} from ({_sessions(_prep(TWO_DAYS), 43200)}) l",
    "M03_half_hour_sessions": f"""
        select session_id, session_start_time, session_end_time, count(*) as n,
               max(session_num) as last_num, cast(sum(browsing_sec) as bigint) as sec
        from ({_sessions(_prep(WHOLE), 1800)}) l group by 1, 2, 3""",
    "M04_last_session": _chain("last_s", "select * from last_s"),
    "M04_purchase_session": _chain("bought_s", "select * from bought_s"),
    "M05_candidate_session": _chain("idle_s", "select * from idle_s"),
    "M06_last_in_cart": _chain("cart", "select * from cart"),
    "M07_recent_purchasers": _chain("buyers", "select * from buyers"),
    "M08_target_sessions": _chain("target", "select * from target"),
    "M09_identity_dedup": _chain("person", "select * from person"),
    "M10_candidate_send_list": _chain("wanted", "select * from wanted"),
    "M11_frequency_cap_day": _chain("capped", "select * from capped"),
    "M12_frequency_cap_rolling": _chain(
        "mailed",
        """select w.* from wanted w left join mailed m using (email)
           where coalesce(c24, 0) = 0 and coalesce(b, 0) < 2""",
    ),
    "M13_cart_pivot": _chain("carts", "select * from carts"),
    "M14_segment_reco_new": _chain("reco_new", "select * from reco_new"),
    "M15_segment_reco_f1": _chain("reco_f1", "select * from reco_f1"),
    "M16_segment_reco_f3plus": _chain("reco_f3", "select * from reco_f3"),
    "M17_push_send_list": _chain("push", "select * from push"),
    "M18_send_payload": _chain("push", MAILS),
    "M19_send_payload_low_stock": _chain("push", LOW_MAILS),
    "M20_send_history": _chain("push", HISTORY),
    "M21_pattern_sample": _chain(
        "sampled",
        f"""select 'test-recipient+normal_' || {LABEL} || '@example.com' as email, {SAMPLE_COLUMNS}
            from sampled""",
    ),
    "M21_pattern_sample_kept": _chain(
        "sampled",
        f"""select split_part(r, '@', 1) || '+ca_' || {LABEL} || '@' || split_part(r, '@', 2) as email,
                   {SAMPLE_COLUMNS}
            from sampled cross join (select unnest(string_split('{RECIPIENTS}', ',')) as r) x
            where (rfm_segment, reco_pattern, ps_pattern, pts_pattern) in ({KEPT_ROWS})""",
    ),
    "M22_fixture_payloads": _chain("sent", f"select * from ({ASSEMBLED}) a"),
    "A15_delivery_batches": f"""
        select b as batch_no, least(1000, total - b * 1000) as n
        from (select count(*) as total from {SUBSCRIBED}) t,
             (select unnest(range(100000)) as b) x where b * 1000 < total""",
}
ORACLES = {k: with_views(v) for k, v in ORACLES.items()}
