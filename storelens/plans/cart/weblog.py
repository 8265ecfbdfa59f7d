"""Raw web events to classified, sessionised rows, one per cart item."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from storelens.functions.text import extract, not_blank, plain_vowels, url_part
from storelens.functions.timewin import in_range, in_window, local_format
from storelens.operators.joins import salted_join
from storelens.operators.sessions import sessionize

# Ids and names that mark traffic to leave out.
DUMMY_CLIENT = "00000000-0000-4000-8000-000000000000"
UNDEFINED = "undefined"
BOT_BROWSERS = "^(?:Googlebot(?:-.*)?|BingPreview|bingbot|YandexBot|PingdomBot)$"
THANK_YOU_PATH = "%/checkouts/%thank-you"
PURCHASE_MARK = "purchase_thank_you"

# Click parameter in the address and the source / medium it means.
CLICK_IDS = [
    ("gclid", "google/cpc"),
    ("fbclid", "facebook/ad"),
    ("yclid", "yahoo/ad"),
    ("ldtag_cl", "line/ad"),
    ("twclid", "x/ad"),
    ("ttclid", "tiktok/ad"),
]
# Referrer host pattern, group with the source name, medium.
REFERRERS = [
    (r"(mail)\.(google|yahoo|nifty|excite|ocn)\.", 2, "mail"),
    (r"\.*(facebook|instagram|line|ameblo)\.", 1, "social"),
    (r"(search)*\.*(google|yahoo|biglobe|goo|rakuten|docomo|naver)\.", 2, "organic"),
]

# Rules for the user agent: (pattern, value), first match wins.
AGENT_CATEGORY = [
    (r"(?i)bot\b|crawler|spider|slurp|bingpreview", "crawler"),
    (r"iPhone|iPod|Android.*Mobile|Windows Phone", "smartphone"),
    (r"iPad|Android", "tablet"),
    (r"Windows NT|Macintosh|X11|CrOS", "pc"),
]
AGENT_OS = [
    (r"Windows NT", "Windows"),
    (r"iPhone OS|iPad|iPod", "iOS"),
    (r"Android", "Android"),
    (r"Mac OS X", "Mac OSX"),
    (r"CrOS", "ChromeOS"),
    (r"Linux", "Linux"),
]
AGENT_BROWSER = [
    (r"Edg(?:e|A|iOS)?/", "Edge"),
    (r"OPR/|Opera", "Opera"),
    (r"Chrome/|CriOS/", "Chrome"),
    (r"Firefox/|FxiOS/", "Firefox"),
    (r"Safari/", "Safari"),
]
AGENT_VENDOR = [
    (r"Edg(?:e|A|iOS)?/|Windows Phone", "Microsoft"),
    (r"OPR/|Opera", "Opera"),
    (r"Chrome/|CriOS/", "Google"),
    (r"Firefox/|FxiOS/", "Mozilla"),
    (r"Safari/", "Apple"),
]
OS_VERSION = r"(?:Windows NT|iPhone OS|CPU OS|Android|Mac OS X) ([0-9]+(?:[._][0-9]+)*)"


def _first_rule(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    return F.coalesce(*[F.when(text.rlike(p), F.lit(v)) for p, v in rules])


def agent_fields(agent: Column) -> dict[str, Column]:
    """User-agent fields by rules; NULL where no rule matches."""
    agent = F.coalesce(agent, F.lit(""))
    return {
        "ua_os": _first_rule(agent, AGENT_OS),
        "ua_vendor": _first_rule(agent, AGENT_VENDOR),
        "ua_os_version": F.replace(extract(agent, OS_VERSION), F.lit("_"), F.lit(".")),
        "ua_browser": _first_rule(agent, AGENT_BROWSER),
        "ua_category": _first_rule(agent, AGENT_CATEGORY),
    }


def ip_number(ip: Column | str) -> Column:
    """IPv4 text as a number, NULL when malformed."""
    parts = F.split(ip, r"\.")
    nums = [F.get(parts, F.lit(i)).try_cast("bigint") for i in range(4)]
    value = ((nums[0] * 256 + nums[1]) * 256 + nums[2]) * 256 + nums[3]
    return F.when(F.size(parts) == 4, value)


def add_geography(df: DataFrame, ranges: DataFrame, ip: str = "td_ip") -> DataFrame:
    """Country, prefecture and city of an address by range lookup.

    Ranges (lo, hi) do not overlap. Each is cut at /16 blocks, so the lookup is
    an equi-join on the block plus a comparison. Only the distinct addresses are
    looked up, and the events of one very common address are spread over salts.
    """
    block = 65536
    cut = ranges.withColumn(
        "_block", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor(F.col("hi") / block)))
    )
    known = (
        df.select(ip)
        .distinct()
        .withColumn("_n", ip_number(ip))
        .filter(F.col("_n").isNotNull())
        .withColumn("_block", F.floor(F.col("_n") / block))
        .join(cut, "_block")
        .filter(F.col("_n").between(F.col("lo"), F.col("hi")))
        .select(
            ip,
            F.col("country").alias("ip_country"),
            F.col("prefecture").alias("ip_prefectures"),
            F.col("city").alias("ip_city"),
        )
    )
    return salted_join(df, known, ip, "ts", how="left")


def is_human(df: DataFrame) -> Column:
    """NULL-safe filter of bots and of events without a usable client id."""
    return (
        (F.coalesce("ua_category", F.lit("")) != "crawler")
        & ~F.coalesce(F.col("td_browser").rlike(BOT_BROWSERS), F.lit(False))
        & F.col("td_client_id").isNotNull()
        & ~F.col("td_client_id").isin([DUMMY_CLIENT, UNDEFINED])
    )


def visit_columns() -> dict[str, Column]:
    """Who visited, which page, and whether it is the page after a purchase."""
    own_id = not_blank("td_ssc_id")
    path = url_part("td_url", "PATH")
    bought = F.coalesce(F.col("td_path").like(THANK_YOU_PATH), F.lit(False)) | F.coalesce(
        path.like(THANK_YOU_PATH), F.lit(False)
    )
    return {
        "cookie": F.when(own_id, F.col("td_ssc_id")).otherwise(F.col("td_client_id")),
        "user_id": F.col("hashedmailaddress"),
        "ecommerce": F.when(bought, PURCHASE_MARK),
        "td_path": path,
    }


def visits(events: DataFrame) -> DataFrame:
    """Human page views with visit columns only; works on a stream."""
    rows = events.withColumn("ua_category", agent_fields(F.col("td_user_agent"))["ua_category"])
    return (
        rows.filter(is_human(rows))
        .withColumns(visit_columns())
        .select("ts", "event_id", "cookie", "user_id", "td_path", "items", "ecommerce")
    )


def prepare_web_events(
    events: DataFrame,
    ranges: DataFrame,
    cfg,
    as_of: datetime,
    bounds: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Needed columns of the window's human traffic, one row per item of the page."""
    rows = in_range(events, *bounds) if bounds else in_window(events, cfg.window, as_of, cfg.tz)
    rows = rows.withColumns(agent_fields(F.col("td_user_agent")))
    rows = add_geography(rows.filter(is_human(rows)), ranges)
    rows = rows.withColumns(
        {
            "td_data_type": F.lit("pageview"),
            **visit_columns(),
            "cookie_type": F.when(not_blank("td_ssc_id"), "td_ssc_id").otherwise("td_client_id"),
            "td_email": F.col("hashedmailaddress"),
            **{
                p: url_part("td_url", "QUERY", p)
                for p in ("utm_campaign", "utm_medium", "utm_source", "utm_term")
            },
            "td_ref_host": url_part("td_referrer", "HOST"),
            "td_host": url_part("td_url", "HOST"),
        }
    )
    listed = F.from_json("items", "array<string>")
    return (
        rows.select("*", F.posexplode_outer(listed).alias("_pos", "_item"))
        .withColumns(
            {
                "td_item_id": F.get_json_object("_item", "$.item_id"),
                "td_item_name": F.get_json_object("_item", "$.item_name"),
                "td_item_category": F.get_json_object("_item", "$.item_category"),
                "td_item_price": F.get_json_object("_item", "$.price"),
                "td_item_ord": F.col("_pos") + 1,
            }
        )
        .drop("_pos", "_item", "items", "hashedmailaddress")
    )


def source_medium() -> Column:
    """Traffic source: UTM pair, click id, direct, mail, social, organic, referral."""
    source, medium = F.col("utm_source"), F.col("utm_medium")
    none = F.lit("(none)")
    host = F.col("td_ref_host")
    rules = F.when(
        source.isNotNull() | medium.isNotNull(),
        F.concat(F.coalesce(source, none), F.lit("/"), F.coalesce(medium, none)),
    )
    for param, value in CLICK_IDS:
        rules = rules.when(F.col("td_url").contains(param), value)
    rules = rules.when(
        host.isNull() | (host == "") | (host == F.col("td_host")), "(direct)/(none)"
    )
    for pattern, group, name in REFERRERS:
        rules = rules.when(
            host.rlike(pattern),
            F.concat(F.regexp_extract(host, pattern, group), F.lit("/" + name)),
        )
    return rules.otherwise(F.concat(host, F.lit("/referral")))


def classify_source_medium(df: DataFrame) -> DataFrame:
    return df.withColumn("td_source_medium", source_medium()).withColumns(
        {
            "td_source": F.split_part("td_source_medium", F.lit("/"), F.lit(1)),
            "td_medium": F.split_part("td_source_medium", F.lit("/"), F.lit(2)),
        }
    )


def sessionize_weblog(
    prepared: DataFrame, cfg, as_of: datetime, extra: Sequence[str] = ()
) -> DataFrame:
    """Session columns, local times, traffic source and page key for every row."""
    rows = sessionize(
        classify_source_medium(prepared),
        "cookie",
        cfg.session_gap_seconds,
        ["event_id", "td_item_ord"],
        fill="user_id",
    )
    return rows.select(
        "ts",
        "event_id",
        F.lit(cfg.media_name).alias("media_name"),
        "td_data_type",
        local_format("ts", "yyyy-MM-dd HH:mm:ss", cfg.tz).alias("access_date_time"),
        local_format("ts", "yyyy-MM-dd", cfg.tz).alias("access_date"),
        local_format("ts", "HH", cfg.tz).alias("access_hour"),
        F.col("session_start").alias("session_start_time"),
        F.col("session_end").alias("session_end_time"),
        "session_id",
        "session_num",
        "browsing_sec",
        F.col("cookie").alias("td_cookie"),
        F.col("cookie_type").alias("td_cookie_type"),
        "td_client_id",
        "td_global_id",
        "td_ssc_id",
        "user_id",
        "user_id_comp",
        "utm_campaign",
        "utm_medium",
        "utm_source",
        "utm_term",
        "td_source_medium",
        "td_source",
        "td_medium",
        "td_referrer",
        "td_ref_host",
        "td_url",
        F.concat("td_host", "td_path").alias("article_key"),
        "td_host",
        "td_path",
        "td_title",
        "td_description",
        "td_ip",
        "td_os",
        "td_user_agent",
        "td_browser",
        "td_screen",
        "td_viewport",
        "ua_os",
        "ua_vendor",
        "ua_os_version",
        "ua_browser",
        "ua_category",
        "ip_country",
        plain_vowels("ip_prefectures").alias("ip_prefectures"),
        plain_vowels("ip_city").alias("ip_city"),
        F.lit(int(as_of.timestamp())).alias("td_proc_date"),
        "td_item_id",
        "td_item_name",
        "td_item_category",
        "td_item_price",
        "td_item_ord",
        "td_email",
        "ecommerce",
        *extra,
    )
