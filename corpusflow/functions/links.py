"""Column expressions that find document links in HTML."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from corpusflow.functions.once import once

# First bytes of a PDF, and the named entities that attribute values may carry.
PDF_MAGIC = b"%PDF"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))

_ENTRY = "map<string,string>"
_BLOB = f"struct<global:struct<currentContent:{_ENTRY},experienceContent:array<{_ENTRY}>>>"
# Accept what a strict JSON reader accepts.
_STRICT = {"allowSingleQuotes": "false", "allowUnquotedFieldNames": "false"}


@dataclass(frozen=True)
class LinkRules:
    """What the landing pages and viewer pages of a site look like.

    Fixed values: the defaults are what the pages hold. A frame must lead to ``frame_host``, the
    site's own viewer; a route or a second fetch only to ``asset_host``, which may be wider.
    """

    blob_variable: str = "window.__PATHFACTORY__"
    title_word: str = "datasheet"
    asset_host: str = "widen.net"
    frame_host: str = "widen.net"
    source_attribute: str = "data-source-url"
    download_link: str = r'href="(/content/[^"]+\.pdf[^"]*download=true[^"]*)"'
    viewer_link: str = r"viewerPdfUrl\s*=\s*'([^']*)'"


def _found(html: Column, pattern: str, mark: str | None = None) -> Column:
    """First group of the first match, NULL when there is none or it is empty.

    ``mark`` is a plain word every match holds, in any case; pages without it are spared the
    pattern.
    """
    match = once(F.regexp_extract(html, pattern, 1), lambda found: F.nullif(found, F.lit("")))
    return F.when(F.lower(html).contains(mark.lower()), match) if mark else match


def _unescaped(value: Column) -> Column:
    """Named and numeric character references decoded, each once."""
    names = "|".join(entity[1:-1] for entity, _ in ENTITIES if "#" not in entity)
    entities = rf"&(?:{names}|#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}});"

    def decoded(hit: Column) -> Column:
        digits = F.regexp_extract(hit, r"^&#[xX]?([0-9a-fA-F]+);", 1)
        point = F.when(hit.rlike("^&#[xX]"), F.conv(digits, 16, 16)).otherwise(F.conv(digits, 10, 16))
        known = point.rlike("^(?!0$|D[89A-F]..$)(?:[0-9A-F]{1,5}|10[0-9A-F]{4})$")
        numeric = F.when(known, F.decode(F.unhex(F.lpad(point, 8, "0")), "UTF-32")).otherwise(hit)
        named = F.when(F.lit(False), hit)
        for entity, char in ENTITIES:
            named = named.when(hit == entity, F.lit(char))
        return named.otherwise(F.when(hit.startswith("&#"), numeric).otherwise(hit))

    hits = F.transform(F.regexp_extract_all(value, F.lit(entities), F.lit(0)), decoded)
    joined = F.zip_with(F.split(value, entities), hits, lambda piece, hit: F.concat(piece, F.coalesce(hit, F.lit(""))))
    return F.when(value.contains("&"), F.array_join(joined, "")).otherwise(value)


def _visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")


def _attribute(tag: str, name: str, inside: str = "") -> str:
    """Pattern for an attribute value of a tag, quoted or not; group 1 is the value with its quotes."""
    value = "|".join(rf"{q}{c}*(?-i:{inside}){c}*{q}" for q, c in (('"', '[^"]'), ("'", "[^']"), ("", r"[^\s\"'>]")))
    other = rf"""[\s/]*+(?!{re.escape(name)}\s*=)[^\s=>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+"""
    return rf"(?is)<{tag}(?=[\s/])(?:{other})*+[\s/]*+{re.escape(name)}\s*+=\s*+({value})"


def _value(html: Column, tag: str, name: str, mark: str, inside: str = "") -> Column:
    found = _found(F.when(F.lower(html).contains(mark.lower()), _visible(html)), _attribute(tag, name, inside))
    bare = once(found, lambda v: F.when(v.rlike("^[\"']"), v.substr(F.lit(2), F.char_length(v) - 2)).otherwise(v))
    return once(bare, lambda v: F.nullif(_unescaped(v), F.lit("")))


def embedded_items(html: Column, rules: LinkRules = LinkRules()) -> Column:
    """Struct with the current item and the list of the embedded JSON, NULL if unreadable."""
    pattern = rf"(?s){re.escape(rules.blob_variable)}\s*=\s*(\{{.*?\}});"
    return F.from_json(_found(html, pattern, rules.blob_variable), _BLOB, _STRICT)["global"]


def current_item_link(items: Column) -> Column:
    return once(
        F.try_element_at(items["currentContent"], F.lit("sourceUrl")), lambda link: F.nullif(link, F.lit(""))
    )


def titled_item(items: Column, rules: LinkRules = LinkRules()) -> Column:
    """First list item that has the link key and the wanted word in its title."""

    def wanted(item: Column) -> Column:
        title = F.lower(F.try_element_at(item, F.lit("title")))
        return F.map_contains_key(item, "sourceUrl") & title.contains(rules.title_word)

    return F.get(F.filter(items["experienceContent"], wanted), F.lit(0))


def item_link(item: Column) -> Column:
    return F.try_element_at(item, F.lit("sourceUrl"))


def frame_link(html: Column, rules: LinkRules = LinkRules()) -> Column:
    """Address of the first frame on the viewer's host."""
    return _value(html, "iframe", "src", rules.frame_host, re.escape(rules.frame_host))


def attribute_link(html: Column, rules: LinkRules = LinkRules()) -> Column:
    return _value(html, r"[a-z][\w:-]*", rules.source_attribute, rules.source_attribute)


def _resolved(path: Column) -> Column:
    """An absolute path without its ``.`` and ``..`` parts, the query as it stands."""
    place = F.regexp_extract(path, r"^[^?#]*", 0)
    rest = path.substr(F.char_length(place) + 1, F.char_length(path))

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    parts = F.split(place, "/")
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), step)
    folder = F.when(place.rlike(r"/\.\.?$"), "/").otherwise("")
    resolved = F.concat(F.array_join(kept, "/"), folder, rest)
    return F.when(place.rlike(r"/\.\.?(?:/|$)"), resolved).otherwise(path)


def viewer_link(html: Column, url: Column, rules: LinkRules = LinkRules()) -> Column:
    """Download link of a viewer page resolved against its address, else the viewer's own link as it stands."""
    path = F.replace(_found(html, rules.download_link), F.lit("&amp;"), F.lit("&"))
    protocol = F.try_parse_url(url, F.lit("PROTOCOL"))
    origin = F.concat(protocol, F.lit("://"), F.try_parse_url(url, F.lit("AUTHORITY")))
    absolute = F.when(path.startswith("//"), F.concat(protocol, F.lit(":"), path)).otherwise(F.concat(origin, _resolved(path)))
    return F.coalesce(absolute, _found(html, rules.viewer_link))


def is_pdf(body: Column) -> Column:
    return F.coalesce(F.substring(body, 1, 4) == F.lit(PDF_MAGIC), F.lit(False))


def first_fetch(url: Column, content_type: Column, body: Column) -> Column:
    """``direct``, ``invalid``, ``landing`` or ``unexpected``."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return (
        F.when(kind.contains("pdf") | url.endswith(".pdf"), F.when(is_pdf(body), "direct").otherwise("invalid"))
        .when(kind.contains("html"), "landing")
        .otherwise("unexpected")
    )


def second_fetch(url: Column, content_type: Column, body: Column, rules: LinkRules = LinkRules()) -> Column:
    """``accepted``, ``not_pdf`` or ``wrong_type``."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    plausible = kind.contains("pdf") | kind.contains("application/octet-stream") | url.contains(rules.asset_host)
    return F.when(plausible, F.when(is_pdf(body), "accepted").otherwise("not_pdf")).otherwise("wrong_type")


def route(link: Column, rules: LinkRules = LinkRules()) -> Column:
    """Where a found link leads: to the asset host's viewer or straight to the document."""
    return F.when(link.contains(rules.asset_host), "viewer").when(link.isNotNull(), "document")
