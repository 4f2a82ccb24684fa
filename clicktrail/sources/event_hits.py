"""Hits derived from a generic ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` becomes the
12-column hit layout; ``props`` is a JSON object whose ``k`` picks the page,
the product and - for clicks - the referrer.  Every event becomes one hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHOP = "http://shop.example/p/"


def _search_url(k: int) -> str:
    if k == 15:
        return "http://www.msn.com/results?q=%20&p=Compass"
    return (
        f"http://www.google.com/search?lang=da&q=Oak+Desk+{k}&start=0",
        f"http://WWW.BING.COM/search?q=Tent%20{k}&count=20",
        "http://search.yahoo.com/search?p=rain+jacket&page=2",
        "http://search.aol.com/aol/search?query=wool%20scarf",
        "http://www.google.com/",
        "http://duckduckgo.com/?q=kayak",
        "http://www.google.co.uk/search?q=lamp",
        "http://www.ask.com/web?q=&q=Lantern",
    )[k % 8]


def _referrer(k: Column) -> Column:
    # A lookup instead of a chain of cases: pushed-down filters repeat this
    # expression, and long methods are not compiled to machine code.
    searches = F.array(*[F.lit(_search_url(i)) for i in range(16)])
    searched = (F.col("event_type") == "click") & (k < 16)
    return F.when(searched, F.get(searches, k)).otherwise(F.concat(F.lit(SHOP), k))


def _product_list(k: Column) -> Column:
    price = F.col("value").cast("decimal(18,2)").cast("string")
    sold = F.concat(
        F.lit("Outdoor;Model "),
        k,
        F.lit(";1;"),
        F.when(k % 10 == 9, F.lit("N/A")).otherwise(price),
        F.lit(";"),
        F.when(k % 4 == 0, F.lit(",Repair;Patch;1;;")).otherwise(F.lit("")),
        F.when(k % 6 == 0, F.lit(",Repair;Rope;2; 18.75 ;event1;evar1")).otherwise(F.lit("")),
    )
    seen = F.concat(F.lit("Outdoor;Model "), k, F.lit(";1;;"))
    return (
        F.when(F.col("event_type") == "purchase", sold)
        .when(F.col("event_type") == "view", seen)
        .otherwise(F.lit(""))
    )


def _event_list(k: Column) -> Column:
    kind = F.col("event_type")
    return (
        F.when((kind == "purchase") & (k % 3 == 0), F.lit("2, 1"))
        .when(kind == "purchase", F.lit("1"))
        .when(kind == "view", F.lit("2"))
        .when(kind == "signup", F.lit("11"))
        .when(kind == "error", F.lit("12"))
        .otherwise(F.lit(""))
    )


def _epoch_seconds(local: Column) -> Column:
    """Seconds since 1970 of a timestamp without zone, whatever the session's zone."""
    days = F.unix_date(local.cast("date")).cast("bigint")
    return days * 86400 + F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)


def hits_from_events(events: DataFrame) -> DataFrame:
    local = F.col("ts").cast("timestamp_ntz")
    user = F.col("user_id")
    # The generator keeps the JSON parse from being copied into every expression
    # and pushed-down filter that mentions k.
    parsed_once = F.explode(F.array(F.get_json_object("props", "$.k").cast("int"))).alias("k")
    k = F.col("k")
    return events.select("*", parsed_once).select(
        _epoch_seconds(local).cast("string").alias("hit_time_gmt"),
        F.substring(local.cast("string"), 1, 19).alias("date_time"),
        F.concat(F.lit("Mozilla/5.0 (agent "), k % 5, F.lit(")")).alias("user_agent"),
        F.concat(F.lit("10.0."), F.expr("user_id div 256"), F.lit("."), user % 256).alias("ip"),
        _event_list(k).alias("event_list"),
        F.lit("Aarhus").alias("geo_city"),
        F.lit("MJ").alias("geo_region"),
        F.lit("DK").alias("geo_country"),
        F.col("event_type").alias("pagename"),
        F.concat(F.lit(SHOP), k).alias("page_url"),
        _product_list(k).alias("product_list"),
        _referrer(k).alias("referrer"),
        F.struct(F.col("event_id"), F.lit(0).alias("copy")).alias("pos"),
    )


def with_dirt(hits: DataFrame) -> DataFrame:
    """All hits, some of them spoiled and some delivered twice, for the quality operators."""
    n = F.col("pos.event_id")
    copies = F.when(n % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    spoiled = hits.select("*", F.explode(copies).alias("_copy"))
    return spoiled.withColumns(
        {
            "ip": F.when(n % 89 == 0, F.lit("  ")).otherwise(F.col("ip")),
            "referrer": F.when(n % 89 <= 1, F.lit("")).otherwise(F.col("referrer")),
            "hit_time_gmt": F.when(n % 83 == 0, F.lit("abc"))
            .when(n % 79 == 0, F.lit("\t"))
            .otherwise(F.col("hit_time_gmt")),
            "user_agent": F.when(n % 10 < 6, F.lit("")).otherwise(F.col("user_agent")),
            "pagename": F.when(F.col("_copy") == 1, F.lit("again")).otherwise(F.col("pagename")),
            "pos": F.struct(n.alias("event_id"), F.col("_copy").alias("copy")),
        }
    ).drop("_copy")
