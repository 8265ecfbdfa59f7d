"""Input tables of the plans, mapped from the TPC-H-like test tables.

Each view is one SQL text for Spark and for the oracle. ``@name(`` marks the
few functions whose names differ between the two. Order dates are shifted so
that orders and events end together; everything runs as of one instant.
"""

from __future__ import annotations

import re
import zlib
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from storelens.sources.tables import configure, read_table

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

SPARK_NAMES = {
    "@sha(": lambda a: f"sha2({a}, 256)",
    "@k(": lambda a: f"cast(get_json_object({a}, '$.k') as bigint)",
    "@time(": lambda a: f"date_format({a}, 'yyyy-MM-dd HH:mm:ss')",
    "@stamp(": lambda a: f"date_format({a}, 'yyyyMMddHHmmss')",
    "@day(": lambda a: f"date_format({a}, 'yyyyMMdd')",
    "@list(": lambda a: f"array({a})",
}
DUCKDB_NAMES = {
    "@sha(": lambda a: f"sha256({a})",
    "@k(": lambda a: f"cast(json_extract_string({a}, '$.k') as bigint)",
    "@time(": lambda a: f"strftime({a}, '%Y-%m-%d %H:%M:%S')",
    "@stamp(": lambda a: f"strftime({a}, '%Y%m%d%H%M%S')",
    "@day(": lambda a: f"strftime({a}, '%Y%m%d')",
    "@list(": lambda a: f"list_value({a})",
}

VIEWS: dict[str, str] = {
    # recommendation inputs
    "products": """
        select cast(p_partkey as string) as product_id, p_type as category_id,
               p_brand as brand_id, p_name as product_name, p_retailprice as price,
               p_size % 10 as stock_qty,
               case when p_size % 7 = 0 then 'ended' else 'on_sale' end as sale_status,
               cast(p_size % 3 as string) as gender_target
        from part""",
    "sales": """
        select cast(o_orderdate as timestamp) + interval 8217 days as ts,
               cast(o_orderkey as string) as order_id, cast(o_custkey as string) as member_id,
               cast(l_partkey as string) as product_id,
               cast(l_suppkey as string) as supplier_id, l_quantity as quantity,
               cast(cast(l_extendedprice as decimal(12, 2))
                    * (1 - cast(l_discount as decimal(4, 2))) as decimal(18, 4)) as amount
        from lineitem join orders on l_orderkey = o_orderkey""",
    "purchases": """
        select s.*, p_type as category_id, p_brand as brand_id
        from sales s join part on s.product_id = cast(p_partkey as string)""",
    "members": """
        select cast(c_custkey as string) as member_id, cast(c_custkey % 2 as string) as gender,
               cast(c_custkey % 5 as string) as age_band, n_name as area,
               c_mktsegment as member_rank
        from customer join nation on c_nationkey = n_nationkey""",
    "clicks": """
        select event_id, cast(ts as timestamp) as ts, cast(user_id as string) as member_id,
               'ck' || cast(user_id as string) as cookie,
               cast(@k(props) as string) as product_id,
               case event_type when 'view' then 'view' when 'click' then 'cart_add'
                    when 'signup' then 'favorite_add' else event_type end as event_type,
               value as dwell_seconds,
               's' || cast(user_id as string) || '-' || @day(ts) as session_id
        from events""",
    "weblog": """
        select c.*, p_type as category_id, p_brand as brand_id
        from clicks c join part on c.product_id = cast(p_partkey as string)""",
    "id_mapping": """
        select distinct cast(user_id as string) as member_id,
               'ck' || cast(user_id as string) as cookie
        from events""",
    "impressions": """
        select cast(ts as timestamp) as ts, cast(@k(props) as string) as product_id,
               case event_type when 'view' then 'impression' when 'signup' then 'cart'
                    else event_type end as event_type
        from events""",
    # cart inputs
    "items": """
        select p_partkey as k, 'h' || cast(p_partkey as string) as item_id, p_name as item_name,
               'cat' || cast(p_partkey % 6 as string) as item_category, p_brand as brand_name,
               p_size as size_no, cast(floor(p_retailprice) as bigint) as price
        from part""",
    "web_raw": """
        select event_id, cast(ts as timestamp) as ts,
               case when user_id % 2 = 1 then null else 'ssc' || cast(user_id as string) end
                   as td_ssc_id,
               case when event_id % 211 = 0 then 'undefined'
                    when event_id % 223 = 0 then '00000000-0000-4000-8000-000000000000'
                    when event_id % 227 = 0 then null
                    else 'cl' || cast(user_id as string) end as td_client_id,
               'gl' || cast(user_id as string) as td_global_id,
               case when event_id % 5 = 0 and event_type <> 'click' then null
                    else @sha('user' || cast(user_id as string) || '@example.com') end
                   as hashedmailaddress,
               case event_type when 'click' then '/cart'
                    when 'purchase' then '/checkouts/1/thank-you'
                    else '/products/h' || cast(@k(props) as string) end as td_path,
               case event_id % 12
                    when 0 then '?utm_source=news&utm_medium=email&utm_campaign=c'
                                || cast(event_id % 3 as string)
                    when 1 then '?utm_source=news'
                    when 2 then '?utm_medium=push'
                    when 3 then '?gclid=' || cast(event_id as string)
                    when 4 then '?fbclid=1' when 5 then '?ttclid=x' else '' end as query,
               case event_id % 11
                    when 0 then null when 1 then 'https://shop.example.com/top'
                    when 2 then 'https://mail.google.com/mail/u/0'
                    when 3 then 'https://www.facebook.com/p/1'
                    when 4 then 'https://search.yahoo.co.jp/search?p=a'
                    when 5 then 'https://www.google.com/'
                    when 6 then 'https://blog.partner.test/a/b'
                    else '' end as td_referrer,
               '10.' || cast(user_id % 4 as string) || '.' || cast(event_id % 200 as string)
                   || '.7' as td_ip,
               case when event_id % 97 = 0 then 'Googlebot-Image'
                    when event_id % 3 = 0 then null else 'Chrome' end as td_browser,
               case when event_id % 101 = 0
                        then 'Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)'
                    when event_id % 4 = 0 then null
                    when event_id % 4 = 1
                        then 'Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) Safari/604.1'
                    else 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/120.0 Safari/537.36'
               end as td_user_agent,
               @k(props) as k,
               case when event_type = 'click' then 1 + event_id % 3 else 0 end as n_items
        from events""",
    "source_web_events": """
        select event_id, ts, td_ssc_id, td_client_id, td_global_id, hashedmailaddress,
               'https://shop.example.com' || td_path || query as td_url, td_path, td_referrer,
               cast(null as string) as td_title, cast(null as string) as td_description,
               td_ip, cast(null as string) as td_os, td_user_agent, td_browser,
               cast(null as string) as td_screen, cast(null as string) as td_viewport,
               case when n_items = 0 and event_id % 7 = 0 then 'not json'
                    when n_items = 0 then null
                    else '[' || @item(k)
                         || case when n_items > 1 then ',' || @item(k + 1) else '' end
                         || case when n_items > 2 then ',' || @item(k + 2) else '' end || ']'
               end as items
        from web_raw""",
    "ip_ranges": """
        select cast(n * 65536 + 167772160 as bigint) as lo,
               cast(n * 65536 + 167772160 + 65535 as bigint) as hi, country, prefecture, city
        from (select 0 as n, 'Japan' as country, 'Ōsaka' as prefecture, 'Sakai' as city
              union all select 1, 'Japan', 'Tōkyō', 'Chōfu'
              union all select 2, 'Japan', 'Kyoto', null) r""",
    "orders_raw": """
        select cast(ts as timestamp) as ts,
               'user' || cast(user_id as string) || '@example.com' as email,
               case when event_id % 6 = 0 then '2024-01-30' when event_id % 6 = 1 then ''
                    else null end as cancelled_at,
               case when event_id % 17 = 0 then 'unknown' else @time(ts) end as created_at
        from events where event_type = 'purchase' and user_id % 3 <> 0""",
    "customers": """
        select 'user' || cast(c_custkey as string) || '@example.com' as email,
               case when c_custkey % 7 = 0 then 'UNSUBSCRIBED' else 'SUBSCRIBED' end
                   as email_marketing_consent
        from customer
        union all
        select 'user' || cast(c_custkey as string) || '@example.com', 'SUBSCRIBED'
        from customer where c_custkey % 11 = 0""",
    "identity_map": """
        select @sha('user' || cast(c_custkey as string) || '@example.com') as email,
               'uid' || cast(c_custkey as string) as td_llm_uid,
               case when c_custkey % 13 = 0 then 'bad' else '2024-01-05 10:00:00' end as updated_at,
               case when c_custkey % 3 = 0 then null else r_name end as prefectures
        from customer join nation on c_nationkey = n_nationkey
             join region on n_regionkey = r_regionkey
        union all
        select @sha('user' || cast(c_custkey as string) || '@example.com'),
               'old' || cast(c_custkey as string), '2023-06-01 00:00:00', ''
        from customer where c_custkey % 5 = 0""",
    "rfm": """
        select 'uid' || cast(user_id as string) as td_llm_uid, 'main' as brand,
               case when user_id % 19 = 0 then null else count(*) end as frequency_all
        from events where event_type = 'purchase' and ts >= timestamp '2024-01-20 00:00:00'
        group by user_id""",
    "suppression": """
        select 'ASIA' as prefecture, cast(null as string) as effective_to
        union all select 'EUROPE', '2024-01-01'""",
    "order_history": """
        select 'uid' || cast(user_id as string) as td_llm_uid,
               cast(@k(props) as string) as product_id,
               case when event_id % 23 = 0 then '' else 'h' || cast(@k(props) as string) end
                   as handle,
               cast(ts as timestamp) as ts,
               case when event_id % 9 = 0 then '2024-01-02' else null end as cancelled_at,
               event_id
        from events where event_type = 'purchase'""",
    "product_detail": """
        select item_id, item_name,
               case when size_no % 9 = 0 then null
                    else 'https://img.example.com/' || item_id || '.jpg' end as image_url,
               'https://shop.example.com/products/' || item_id as item_url, brand_name,
               price as selling_price, price + 100 as price_org,
               case when size_no % 4 = 0 then 1 else 0 end as sale_flag
        from items
        union all
        select item_id, 'a copy', null, 'https://shop.example.com/products/' || item_id,
               brand_name, price, price, 0
        from items where k % 10 = 3""",
    "product_stock": """
        select item_id, case when size_no % 10 = 0 or size_no % 7 = 3 then '0' else '1' end as is_available,
               case when size_no % 10 in (1, 2) then '1' else '' end as low_stock,
               case when k % 29 = 0 then 'n/a' else cast(price as string) end as taxin_price,
               cast(price + 1100 as string) as taxin_compare_at_price,
               case when size_no % 4 = 0 then '1' else '0' end as sale_flag,
               case when size_no % 8 = 0 then null else '10' end as discount_rate,
               case when size_no % 5 = 0 then '0' else '1' end as is_published
        from items""",
    "popularity": """
        select 'h' || cast(@k(props) as string) as item_id,
               'cat' || cast(@k(props) % 6 as string) as item_category,
               count(*) as popularity_score
        from events
        where event_type = 'view' and ts >= timestamp '2024-01-24 00:00:00'
        group by @k(props)""",
    "day_items": """
        select distinct user_id, @day(ts) as day, @k(props) as k
        from events where event_type = 'view'""",
    "coview": """
        select 'h' || cast(a.k as string) as item_a, 'h' || cast(b.k as string) as item_b,
               count(*) as co_view_sessions
        from day_items a join day_items b
             on a.user_id = b.user_id and a.day = b.day and a.k <> b.k
        group by a.k, b.k""",
    "user_items": """
        select distinct user_id, @k(props) as k
        from events where event_type = 'purchase' and ts >= timestamp '2024-01-01 00:00:00'""",
    "fbt": """
        select cast(a.k as string) as item_a,
               case when b.k % 31 = 0 then '' else 'h' || cast(b.k as string) end
                   as item_b_handle,
               count(*) as co_purchase_users
        from user_items a join user_items b on a.user_id = b.user_id and a.k <> b.k
        group by a.k, b.k""",
    "attributes": """
        select @sha('user' || cast(c_custkey as string) || '@example.com') as email,
               timestamp '2024-01-01 00:00:00' as ts, c_custkey % 4 * 250 as pointsapproved,
               c_name as member_name, 'https://img.example.com/a.jpg' as recommend_seq5_image_url,
               'five' as recommend_seq5_item_name, 'https://example.com/5' as recommend_seq5_item_url,
               'b5' as recommend_seq5_item_brand,
               case when c_custkey % 3 = 0 then null else 'https://img.example.com/b.jpg' end
                   as recommend_seq6_image_url,
               'six' as recommend_seq6_item_name, cast(null as string) as recommend_seq6_item_url,
               'b6' as recommend_seq6_item_brand,
               case when c_custkey % 2 = 0 then '' else 'https://img.example.com/c.jpg' end
                   as recommend_seq7_image_url,
               'seven' as recommend_seq7_item_name, '' as recommend_seq7_item_url,
               'b7' as recommend_seq7_item_brand, 'https://img.example.com/d.jpg'
                   as recommend_seq8_image_url,
               'eight' as recommend_seq8_item_name, 'https://example.com/8'
                   as recommend_seq8_item_url, 'b8' as recommend_seq8_item_brand
        from customer
        union all
        select @sha('user' || cast(c_custkey as string) || '@example.com'),
               timestamp '2024-01-02 00:00:00', cast(null as bigint), 'newer',
               null, null, null, null, null, null, null, null,
               null, null, null, null, null, null, null, null
        from customer where c_custkey % 6 = 0""",
    "cart_history": """
        select @sha('user' || cast(user_id as string) || '@example.com') as email,
               case when user_id % 8 = 0 then '2024-01-31 00:00:00'
                    when user_id % 8 = 1 then '2024-01-30 23:59:59'
                    when user_id % 8 = 2 then '2024-01-30 08:30:00'
                    else '2024-01-29 12:00:00' end as scheduled_time
        from (select distinct user_id from events) u where user_id % 8 < 4""",
    "browser_history": """
        select @sha('user' || cast(user_id as string) || '@example.com') as email,
               case when event_id % 2 = 0 then '2024-01-31 08:00:00'
                    else '2024-01-30 08:00:00' end as scheduled_time
        from events where event_type = 'signup' and user_id % 10 = 3""",
    # feed masters: two versions of every key
    "parts2": """
        select *, 0 as v, timestamp '2024-01-01 00:00:00' as imported_at from part
        union all select *, 1, timestamp '2024-01-15 00:00:00' from part""",
    "suppliers2": """
        select *, timestamp '2024-01-01 00:00:00' as imported_at from supplier
        union all select *, timestamp '2024-01-15 00:00:00' from supplier""",
    "feed_sku": """
        select 'sku' || cast(p_partkey as string) as item_id,
               'code' || cast(p_partkey as string) as item_code,
               'item' || cast(cast(floor(p_partkey / 3) as bigint) as string) as parent_item_id,
               cast(cast(floor(p_retailprice) as bigint) as string) as retail_price_out_tax,
               case when p_partkey % 41 = 0 then '0'
                    else cast(cast(floor(p_retailprice) as bigint) + 90 * v as string) end
                   as retail_price_in_tax,
               'color' || cast(p_size % 5 as string) as variation_name1,
               case p_size % 3 when 0 then 'S' when 1 then 'M' else null end as variation_name2,
               cast(p_size as string) as variation_id1,
               case when p_partkey % 53 = 0 then 'bad' else '20230405060708' end
                   as register_date_time,
               case when p_partkey % 6 = 0 then 'LIMITED' else 'FREE' end as allocate_div,
               case when p_partkey % 10 = 9 and v = 1 then 'STOPPED' else 'ACTIVE' end as status,
               imported_at
        from parts2""",
    "feed_product": """
        select 'item' || cast(p_partkey as string) as item_id,
               'AB-00' || cast(19 + p_partkey % 6 as string) || 'S' || cast(p_partkey as string)
                   as item_code,
               case when p_partkey % 37 = 0 then null
                    else p_name || ' v' || cast(v as string) end as item_name,
               'm' || cast(p_partkey as string) as merchant_item_code,
               'b' || cast(p_partkey % 30 as string) as brand_id,
               'pb' || cast(p_partkey % 25 as string) as public_brand_id, p_type as category_id,
               imported_at
        from parts2""",
    "feed_description": """
        select 'item' || cast(p_partkey as string) as item_id,
               case p_partkey % 5 when 0 then null when 1 then ''
                    else '<p>' || p_name || ' nr' || '\n' || '<b>' || p_brand || '</b></p>' end
                   as description,
               imported_at
        from parts2 where p_partkey % 11 <> 0""",
    "feed_sales": """
        select 'sku' || cast(p_partkey as string) as item_id,
               case when p_partkey % 59 = 0 then null else '20240101000000' end
                   as sales_start_datetime,
               case when p_partkey % 8 = 0 then '20240120235959' else '20240331235959' end
                   as sales_end_datetime,
               cast(cast(floor(p_retailprice) as bigint) - 100 as string) as sale_price_out_tax,
               case when p_partkey % 3 = 0
                        then cast(cast(floor(p_retailprice) as bigint) + 90 as string)
                    else cast(cast(floor(p_retailprice * (10 - p_size % 6) / 10) as bigint) as string)
               end as sale_price_in_tax,
               case when p_partkey % 9 = 0 then '1' else '0' end as reserve_flag,
               case when p_partkey % 18 = 0 then '20240215' else '20250215' end
                   as reserve_shipment_date,
               '20240110000000' as publish_start_datetime,
               case when p_partkey % 13 = 0 then '20240130000000' else '20991231235959' end
                   as publish_end_datetime,
               case when p_partkey % 15 = 0 then 'store-2' else 'store-1' end as store_id,
               'ACTIVE' as sales_status,
               case when p_partkey % 19 = 0 and v = 1 then '0' else '1' end as publish_flag,
               imported_at
        from parts2""",
    "feed_stock": """
        select 'sku' || cast(p_partkey as string) as item_id,
               cast(p_size % 10 + v as bigint) as allocatable_stock,
               case when p_partkey % 14 = 0 then 'loc-2' else 'loc-1' end as location_id,
               imported_at
        from parts2 where p_partkey % 12 <> 0""",
    "feed_stock_limit": """
        select 'sku' || cast(p_partkey as string) as item_id,
               cast(p_size % 4 as bigint) as sales_limit_amount, imported_at
        from parts2 where p_partkey % 6 = 0""",
    "feed_public_brand": """
        select 'pb' || cast(s_suppkey as string) as brand_id, s_name as brand_name,
               case when s_suppkey % 5 = 0 then null
                    else 'br' || cast(s_suppkey as string) end as brand_url_key,
               imported_at
        from suppliers2""",
    "feed_display_brand": """
        select 'b' || cast(s_suppkey as string) as display_brand_id,
               'Display ' || cast(s_suppkey as string) as display_brand_name, imported_at
        from suppliers2 where s_suppkey % 2 = 0""",
    "feed_category": """
        select p_type as category_id,
               case p_type when 'PROMO' then '' when 'SMALL' then null
                    else 'Apparel>Shop>' || p_type end as google_product_category,
               'type ' || p_type as product_type, timestamp '2024-01-01 00:00:00' as imported_at
        from (select distinct p_type from part) p""",
    # message and sheet inputs
    "templates": """
        select page_id as template_id,
               'VIP ' || cast(page_id % 5 * 10 + 10 as string) || '%OFF 1/'
                   || cast(page_id % 28 + 1 as string) as subject,
               html || '<p>開催期間 2024/1/' || cast(page_id % 28 + 1 as string)
                   || ' 10:00まで。1,' || cast(100 + page_id % 900 as string) || '円 '
                   || cast(page_id % 5 * 10 + 10 as string)
                   || '%OFF! <a class="b" href="https://shop.example.com/p/'
                   || cast(page_id as string) || '?a=1&amp;b=2">GOLD &amp; <b>VIP</b></a>'
                   || '<img src="https://img.example.com/' || cast(page_id as string)
                   || '.png" alt="&lt;x&gt; &amp; &#169;"><img src=/plain.gif></p>'
                   || '<i data-t="11:00" class="SILVER" title="2023/9/9">&#128512; &#x2764; &eacute;'
                   || ' &amp;lt; &#xD800; &nosuch; a&b</i>' as html,
               '開催期間 2024/1/'
                   || cast(case when page_id % 4 = 1 then 30 else page_id % 28 + 1 end as string)
                   || ' 10:00まで。1,' || cast(100 + page_id % 900 as string) || '円 '
                   || cast(page_id % 5 * 10 + 10 as string) || '%OFF! GOLD & VIP'
                   || case page_id % 4 when 2 then ''
                      when 3 then ' https://shop.example.com/old'
                      else ' https://shop.example.com/p/' || cast(page_id as string) end
                   as plaintext
        from pages""",
    "links": """
        select page_id * 10 as link_id, url from pages
        union all
        select page_id * 10 + 1, case page_id % 5
                   when 0 then 'mailto:p' || cast(page_id as string) || '@example.com'
                   when 1 then 'https://shop.example.com/member/' || cast(page_id as string)
                   when 2 then 'https://shop.example.com/p?utm_source=old&q=a%20b+c&q=%E6%98%A5&z=~*'
                   when 3 then 'https://shop.example.com/p/' || cast(page_id as string)
                               || '?x&utm_campaign=&a=1#part-' || cast(page_id as string)
                   else 'https://other.test/?utm_source=z' end
        from pages""",
    "grid": """
        select 'book.xlsx' as file, 'people' as sheet, 0 as row_idx,
               @list('Member', null, 'Money', null, null) as cells
        union all
        select 'book.xlsx', 'people', 1, @list('ID', 'Full Name', ' Balance (JPY) ', '2024-01-05', null)
        union all
        select 'book.xlsx', 'people', cast(c_custkey + 2 as int),
               case when c_custkey % 20 = 0
                    then @list(cast(null as string), null, null, null, null)
                    else @list(cast(c_custkey as string), c_name,
                               case when c_custkey % 7 = 0 then '#REF!' when c_custkey % 11 = 0 then 'NaN'
                                    else cast(cast(c_acctbal as decimal(12, 2)) as string) end,
                               case when c_custkey % 3 = 0 then '1.5'
                                    else cast(c_custkey % 9 as string) end,
                               case when c_custkey % 4 = 0 then '7' when c_custkey % 4 = 1 then 'x'
                                    else null end) end
        from customer""",
}

ITEM = re.compile(r"@item\(([^)]*)\)")


def _item(k: str) -> str:
    """JSON of one cart item."""
    text = f"cast({k} as string)"
    return (
        "'{\"item_id\":\"h' || " + text + " || '\",\"item_name\":\"item ' || " + text
        + " || '\",\"item_category\":\"cat' || cast(("
        + k
        + ") % 6 as string) || '\",\"price\":' || cast(900 + ("
        + k
        + ") % 50 as string) || '}'"
    )


def _close(text: str, start: int) -> int:
    depth = 1
    for i in range(start, len(text)):
        depth += {"(": 1, ")": -1}.get(text[i], 0)
        if depth == 0:
            return i
    raise ValueError("unbalanced parentheses")


def view_sql(name: str, names: dict) -> str:
    """SQL of a view with the function names of one engine."""
    sql = ITEM.sub(lambda m: _item(m.group(1)), VIEWS[name])
    for mark, render in names.items():
        while mark in sql:
            at = sql.index(mark)
            end = _close(sql, at + len(mark))
            sql = sql[:at] + render(sql[at + len(mark) : end]) + sql[end + 1 :]
    return sql


def _reads(sql: str, name: str) -> bool:
    return re.search(rf"\b(from|join) {name}\b", sql) is not None


def view(spark: SparkSession, directory: str, name: str, built: dict | None = None) -> DataFrame:
    """A view, or a raw table, as a DataFrame."""
    built = {} if built is None else built
    if name not in built:
        if name in VIEWS:
            sql = view_sql(name, SPARK_NAMES)
            tag = f"sl{zlib.crc32(directory.encode()):08x}"
            for part in [*VIEWS, *TABLES]:
                if part != name and _reads(sql, part):
                    source = view(spark, directory, part, built)
                    source.createOrReplaceTempView(f"{tag}_{part}")
                    sql = re.sub(rf"\b(from|join) {part}\b", rf"\1 {tag}_{part}", sql)
            built[name] = spark.sql(sql)
        else:
            built[name] = read_table(spark, directory, name)
    return built[name]


def views(spark: SparkSession, directory: str, *names: str) -> dict[str, DataFrame]:
    configure(spark)
    built: dict[str, DataFrame] = {}
    return {n: view(spark, directory, n, built) for n in names}


def with_views(body: str) -> str:
    """Oracle SQL: the views that ``body`` needs as CTEs, then ``body`` itself."""
    needed: list[str] = []

    def need(sql: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                need(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    need(body)
    ctes = [f"{n} as ({view_sql(n, DUCKDB_NAMES)})" for n in needed]
    return (f"with {', '.join(ctes)} " if ctes else "") + f"select * from ({body}) q"
