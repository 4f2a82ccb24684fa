"""Hand-built hits with known results."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from clicktrail.rules import HIT_COLUMNS

SITE = "http://www.shop.example/"

GOOGLE_UPPER = "http://www.google.com/search?source=web&q=Garden+Hose&start=0"
GOOGLE_LOWER = "http://www.google.com/search?q=garden%20hose"
BING = "http://www.bing.com/search?q=Spade&scope=web"
YAHOO = "http://search.yahoo.com/search?p=bird+bath&fr=top"

# (visitor, events, products, referrer), 45 seconds apart
ANCHOR_ROWS = [
    ("10.7.0.4", "", "", YAHOO),
    ("10.7.0.1", "2", "Tools;Spade;1;;", BING),
    ("10.7.0.2", "", "", GOOGLE_LOWER),
    ("10.7.0.1", "11", "", SITE),
    ("10.7.0.3", "2", "Water;Hose 10 m;1;;", GOOGLE_UPPER),
    ("10.7.0.1", "1", "Tools;Spade;1;35;", SITE),
    ("10.7.0.4", "", "", SITE),
    ("10.7.0.2", "2", "Water;Hose 5 m;1;;", SITE),
    ("10.7.0.3", "12", "", SITE),
    ("10.7.0.2", "1", "Water;Hose 5 m;1;18.5;", SITE),
    ("10.7.0.3", "1", "Water;Hose 10 m;1;27;,Water;Tap;1;5;", SITE),
    ("10.7.0.2", "", "", SITE),
]
ANCHOR_REPORT = [("google.com", "garden hose", 50.5), ("bing.com", "spade", 35.0)]


def hit(time, ip, events="", products="", referrer=SITE, page="/p", agent="agent", name="page"):
    return {
        "hit_time_gmt": str(time),
        "date_time": "2021-05-03 08:10:00",
        "user_agent": agent,
        "ip": ip,
        "event_list": events,
        "geo_city": "Bonn",
        "geo_region": "NW",
        "geo_country": "DE",
        "pagename": name,
        "page_url": SITE + page,
        "product_list": products,
        "referrer": referrer,
    }


def anchor_hits():
    return [
        hit(1620029400 + 45 * i, ip, events, products, referrer, page=f"p{i}")
        for i, (ip, events, products, referrer) in enumerate(ANCHOR_ROWS)
    ]


def sale(time, ip, price):
    return hit(time, ip, "1", f"Any;Thing;1;{price};", page=f"done{time}")


def search(time, ip, keyword, domain="www.google.com"):
    return hit(time, ip, referrer=f"http://{domain}/search?q={keyword}", page=f"land{time}")


def frame(spark, rows, partitions=None):
    """Hits with arrival order as given."""
    numbered = [tuple(r.get(c) for c in HIT_COLUMNS) + (i,) for i, r in enumerate(rows)]
    schema = ", ".join(f"{c} string" for c in HIT_COLUMNS) + ", n long"
    df = spark.createDataFrame(numbered, schema)
    df = df.repartition(partitions) if partitions else df
    return df.withColumn("pos", F.struct("n")).drop("n")


def tab_text(rows, line_end="\n", columns=HIT_COLUMNS):
    def cell(value):
        if value is None:
            return ""
        return '"' + value.replace('"', '""') + '"' if '"' in value or "\t" in value else value

    lines = ["\t".join(columns)] + ["\t".join(cell(r.get(c)) for c in columns) for r in rows]
    return line_end.join(lines) + line_end


def rows_of(df):
    def plain(v):
        return float(v) if isinstance(v, Decimal) else v

    return [tuple(plain(v) for v in r) for r in df.collect()]
