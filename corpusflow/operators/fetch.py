"""Classification of fetched objects and the summary of a fetch run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusflow.functions import links
from corpusflow.functions.links import LinkRules
from corpusflow.functions.once import computed
from corpusflow.functions.text import decoded, megabytes


def landing_links(pages: DataFrame, rules: LinkRules = LinkRules(), html: str = "html") -> DataFrame:
    """Pages with the document link found in them, how it was found and where it leads.

    In this order: current item of the embedded JSON, first titled list item that has the
    key (its value decides, even when empty), frame on the asset host, source attribute.
    JSON that cannot be read falls through to the frame. Each step is its own projection and
    the result comes from a generator, so that no pattern runs twice on a page, whatever is
    filtered later.
    """
    text = F.col("_html")
    staged = (
        pages.withColumn("_html", decoded(pages, html))
        .withColumn("_items", links.embedded_items(text, rules))
        .withColumn("_current", links.current_item_link(F.col("_items")))
        .withColumn("_titled", links.titled_item(F.col("_items"), rules))
    )
    in_json = F.coalesce(F.col("_current").isNotNull() | F.col("_titled").isNotNull(), F.lit(False))
    staged = staged.withColumn("_frame", F.when(~in_json, links.frame_link(text, rules)))
    open_still = ~in_json & F.col("_frame").isNull()
    staged = staged.withColumn("_attribute", F.when(open_still, links.attribute_link(text, rules)))
    method = (
        F.when(F.col("_current").isNotNull(), "current")
        .when(F.col("_titled").isNotNull(), "listed")
        .when(F.col("_frame").isNotNull(), "frame")
        .when(F.col("_attribute").isNotNull(), "attribute")
    )
    listed = F.nullif(links.item_link(F.col("_titled")), F.lit(""))
    link = F.coalesce("_current", listed, "_frame", "_attribute")
    found = staged.select(*pages.columns, computed(_method=method, link=link))
    return found.select(
        *pages.columns,
        F.when(F.col("link").isNotNull(), F.col("_method")).alias("method"),
        "link",
        links.route(F.col("link"), rules).alias("route"),
    )


def viewer_links(pages: DataFrame, rules: LinkRules = LinkRules(), html: str = "html") -> DataFrame:
    return pages.withColumn("link", links.viewer_link(decoded(pages, html), F.col("url"), rules))


def classified(fetched: DataFrame, rules: LinkRules = LinkRules()) -> DataFrame:
    """Fetched objects judged by the rules for a first and for a second request."""
    given = F.col("url"), F.col("content_type"), F.col("body")
    return fetched.withColumns(
        {
            "first_class": links.first_fetch(*given),
            "second_class": links.second_fetch(*given, rules),
            "route": links.route(F.col("url"), rules),
        }
    )


def quarantine(pages: DataFrame) -> DataFrame:
    """Pages without a link, kept for inspection."""
    return pages.filter(F.col("link").isNull())


def fetch_summary(outcomes: DataFrame) -> DataFrame:
    """Objects and megabytes per outcome; failed fetches have no size."""
    return outcomes.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(megabytes(F.sum("n_bytes")), F.lit(0.0)).alias("mb")
    )


def failures(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("status") == "failed").select("name", "url")
