"""Message content: text, links, entities, consistency of HTML and plain text, UTM tags."""

from __future__ import annotations

import json
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

from storelens.functions.text import extract

#: named character references that end in a semicolon, from the standard library's table
NAMES = {name[:-1]: value for name, value in html5.items() if name.endswith(";")}

# What is compared between the parts of a message, by kind.
ENTITY_PATTERNS = {
    "date": r"[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}月[0-9]{1,2}日",
    "time": r"[0-9]{1,2}:[0-9]{2}",
    "amount": r"[0-9][0-9,]*円",
    "discount": r"[0-9]+%OFF|[0-9]+,[0-9]+円OFF",
    "stage": r"VIP|GOLD|SILVER|ゴールド|シルバー",
    "period": r"開催期間|まで",
    "url": r"https?://[^\s\"<>]+",
}

SPACE = r"(?U)\s+"


REFERENCE = r"^&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def _reference(part: Column) -> Column:
    """A stretch that starts with ``&``, its character reference replaced by what it stands for.

    Numbers that are no character give U+FFFD; unknown names stay as they are.
    """
    name = F.regexp_extract(part, REFERENCE, 1)
    digits = F.when(
        F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10)
    ).otherwise(F.substring(name, F.lit(2), F.length(name)))
    code = F.coalesce(digits.try_cast("bigint"), F.lit(0))
    is_character = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.when(is_character, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")
    named = F.try_element_at(F.from_json(F.lit(json.dumps(NAMES)), "map<string,string>"), name)
    value = F.when(name.startswith("#"), char).otherwise(named)
    rest = F.substring(part, F.length(name) + 3, F.length(part))
    return F.when((name == "") | value.isNull(), part).otherwise(F.concat(value, rest))


def decode_entities(text: Column) -> Column:
    """Named, decimal and hexadecimal character references, each decoded once."""

    def decoded(t: Column) -> Column:
        parts = F.transform(F.split(t, "(?=&)"), _reference)
        return F.when(t.contains("&"), F.array_join(parts, "")).otherwise(t)

    # the lambda variable holds the text, so it is computed once however often it is used
    return F.get(F.transform(F.array(text), decoded), F.lit(0))


def html_to_text(html: Column | str) -> Column:
    """Text of a page: scripts, styles, comments and tags dropped, blanks collapsed."""
    text = F.col(html) if isinstance(html, str) else html
    for tag in ("script", "style"):
        text = F.regexp_replace(text, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"<[a-zA-Z/!][^>]*>", " ")
    return F.trim(F.regexp_replace(decode_entities(text), SPACE, " "))


def _attribute(tag: Column | str, name: str) -> Column:
    """Value of a tag's attribute in any quoting."""
    head = rf"(?i)\s{name}\s*=\s*"
    value = F.coalesce(
        extract(tag, head + r'"([^"]*)"'),
        extract(tag, head + r"'([^']*)'"),
        extract(tag, head + r"([^\s\"'>]+)"),
    )
    return decode_entities(value)


def extract_links(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, href, anchor) of every link, in page order."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<a\s[^>]*>.*?</a\s*>"), F.lit(0))
    rows = pages.select(key, F.posexplode(found).alias("pos", "_a"))
    return rows.select(
        key,
        "pos",
        _attribute(F.regexp_extract("_a", r"(?is)^<a\s[^>]*>", 0), "href").alias("href"),
        html_to_text("_a").alias("anchor"),
    ).filter(F.col("href").isNotNull())


def extract_images(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, src, alt) of every image; ``alt`` is NULL without that attribute."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"(?i)<img\s[^>]*>"), F.lit(0))
    rows = pages.select(key, F.posexplode(found).alias("pos", "_i"))
    return rows.select(
        key, "pos", _attribute("_i", "src").alias("src"), _attribute("_i", "alt").alias("alt")
    )


def _entities(text: Column, kinds: Sequence[str] = tuple(ENTITY_PATTERNS)) -> Column:
    """Array of (kind, value) of the distinct entities of a text."""

    def of_kind(kind: str, pattern: str) -> Column:
        values = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    return F.concat(*[of_kind(k, ENTITY_PATTERNS[k]) for k in kinds])


def extract_entities(df: DataFrame, key: str, text: str) -> DataFrame:
    """Distinct (key, kind, value) of the entities in a text column; ``key`` is unique."""
    rows = df.filter(F.col(text).isNotNull()).select(
        key, F.explode(_entities(F.col(text))).alias("e")
    )
    return rows.select(key, "e.kind", "e.value")


SIDES = ("html", "text", "subject")


def content_consistency(templates: DataFrame, key: str = "template_id") -> DataFrame:
    """Per template and entity: on which sides it occurs, and what that means.

    ``missing`` is in the HTML but not in the plain text, ``stale`` the other way
    round, ``subject_only`` in the subject but in neither body.
    """
    empty = F.lit("")
    # addresses are attributes, so for them, and them alone, the markup itself is searched too
    kinds = [k for k in ENTITY_PATTERNS if k != "url"]
    texts = {
        "html": [(html_to_text("html"), tuple(ENTITY_PATTERNS)), (F.coalesce("html", empty), ("url",))],
        "text": [(F.coalesce("plaintext", empty), (*kinds, "url"))],
        "subject": [(F.coalesce("subject", empty), (*kinds, "url"))],
    }

    def on_side(side: str, text: Column, found: Sequence[str]) -> Column:
        def row(e: Column) -> Column:
            return F.struct(F.lit(side).alias("side"), e["kind"].alias("kind"), e["value"].alias("value"))

        return F.transform(_entities(text, found), row)

    sides = F.concat(*[on_side(side, text, found) for side, sources in texts.items() for text, found in sources])
    parts = templates.select(key, F.explode(sides).alias("p")).select(key, "p.*")
    flags = parts.groupBy(key, "kind", "value").agg(
        *[F.max(F.col("side") == s).alias(f"in_{s}") for s in SIDES]
    )
    status = (
        F.when(F.col("in_html") & F.col("in_text"), "matched")
        .when(F.col("in_html"), "missing")
        .when(F.col("in_text"), "stale")
        .otherwise("subject_only")
    )
    return flags.withColumn("status", status)


def sentences(text: Column) -> Column:
    """Distinct sentences of a text, blanks collapsed."""
    clean = F.regexp_replace(text, SPACE, " ")
    parts = F.transform(F.split(clean, r"[。．.!?！？]"), lambda s: F.trim(s))
    return F.array_distinct(F.filter(parts, lambda s: s != ""))


def sentence_differences(templates: DataFrame, key: str = "template_id") -> DataFrame:
    """Sentences that only the HTML (missing) or only the plain text (stale) has."""
    rows = templates.select(
        key,
        sentences(html_to_text("html")).alias("h"),
        sentences(F.coalesce("plaintext", F.lit(""))).alias("p"),
    )

    def only(a: str, b: str, status: str) -> Column:
        return F.transform(
            F.array_except(a, b),
            lambda s: F.struct(F.lit(status).alias("status"), s.alias("sentence")),
        )

    found = F.concat(only("h", "p", "missing"), only("p", "h", "stale"))
    return rows.select(key, F.explode(found).alias("d")).select(key, "d.status", "d.sentence")


def _quote(text: Column) -> Column:
    """Form encoding; unlike Java's, ``~`` stays and ``*`` is encoded."""
    out = F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A"))
    return F.replace(out, F.lit("%7E"), F.lit("~"))


def _unquote(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def add_utm(url: Column | str, utm: dict[str, str], domain: str, opt_out: str = "/member/") -> Column:
    """URL with UTM parameters; foreign, mail and opt-out addresses stay as they are.

    A parameter that is there already is replaced where it stands; empty settings
    are skipped; the fragment stays last.
    """
    url = F.col(url) if isinstance(url, str) else url
    tags = {k: v for k, v in utm.items() if v}
    head = F.regexp_extract(url, r"^([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"#(.*)$", 1)
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            _unquote(F.substring_index(p, "=", 1)).alias("k"),
            _unquote(F.when(F.instr(p, "=") > 0, F.substring(p, F.instr(p, "=") + 1, F.length(p))).otherwise("")).alias("v"),
        ),
    )
    names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    new = F.array(*[F.lit(k) for k in tags]).cast("array<string>")
    every = F.concat(names, F.array_except(new, names))

    def value(name: Column) -> Column:
        old = F.element_at(F.filter(pairs, lambda p: p["k"] == name), -1)["v"]
        chain = old
        for k, v in tags.items():
            chain = F.when(name == k, F.lit(v)).otherwise(chain)
        return chain

    joined = F.array_join(
        F.transform(every, lambda n: F.concat(_quote(n), F.lit("="), _quote(value(n)))), "&"
    )
    tagged = F.concat(
        head,
        F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )
    untouched = url.startswith("mailto:") | ~url.contains(domain) | url.contains(opt_out)
    return F.when(untouched, url).otherwise(tagged)
