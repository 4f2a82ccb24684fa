import hashlib

import pytest
from pyspark.sql import functions as F

from clicktrail.functions import commerce, paths, text, urls
from clicktrail.rules import Rules

RULES = Rules()


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").select("out").collect()]


TOUCHES = [
    ("http://www.google.com/search?source=web&q=Oak+Table&start=10", ("google.com", "oak table")),
    ("http://WWW.BING.COM/search?scope=web&q=LAMP", ("bing.com", "lamp")),
    ("http://search.yahoo.com/search?p=red+chair", ("yahoo.com", "red chair")),
    ("http://search.aol.com/find?query=wool%20rug", ("aol.com", "wool rug")),
    ("http://www.google.com/maps", None),
    ("http://search.elsewhere.example/?q=lamp", None),
    ("http://www.google.com.au/search?q=rug", None),
    ("http://www.ask.com/find?q=&q=sofa", ("ask.com", "sofa")),
    ("http://www.ask.com/find?q=&p=desk", ("ask.com", "desk")),
    ("https://me:pw@www.google.com:8443/search?q=one%7Ctwo#top", ("google.com", "one|two")),
    ("http://www.google.com/search?q=one|two", ("google.com", "one|two")),
    ("http://www.google.com/search?q=50%xy", ("google.com", "50%xy")),
    ("http://www.google.com/search?q=50%xy%20cut", ("google.com", "50%xy cut")),
    ("http://www.google.com/search?q=%09&p=bed", ("google.com", "")),
    ("//www.msn.com/?s=mirror", ("msn.com", "mirror")),
    ("www.google.com/?q=bare", None),
    ("http://www.google.com?q=short", ("google.com", "short")),
    ("http://www.google.com/search?seq=3&q=4", ("google.com", "4")),
    ("http://www.google.com/search?q=up;down", ("google.com", "up;down")),
    ("http://www.google.com/search?q=x=y", ("google.com", "x=y")),
    ("]] no address [[", None),
    ("", None),
    (None, None),
    ("nan", None),
    ("\t http://www.google.com/search?q=spaces \t", ("google.com", "spaces")),
    ("http://www.google.com/search?q=b%C3%BCro", ("google.com", "büro")),
    ("http://www.google.com/#q=hash", None),
    ("http://www.google.com/?z=1#?q=hash", None),
    ("http://other.example/?to=http://www.google.com/search?q=inner", None),
    ("http://mygoogle.com/?q=rug", None),
    ("http://www.google.com/search?qs=second&text=winner", ("google.com", "winner")),
    ("http://www.google.com/search?p=second&n=7&q=winner", ("google.com", "winner")),
]


def test_search_touch(spark):
    got = apply(spark, [r for r, _ in TOUCHES], lambda c: urls.search_touch(c, RULES))
    assert [tuple(t) if t else None for t in got] == [want for _, want in TOUCHES]


@pytest.mark.parametrize(
    "query, keyword",
    [
        ("q=%20&p=z", "z"),
        ("q=+%09%0a&text=z", "z"),
        ("q=%C2%A0&s=nbsp", "nbsp"),
        ("q=%20&q=x", None),  # only the first value of a name is looked at
        ("q=&q=x", "x"),
        ("q=%20", None),
        ("q=%20a", "a"),
    ],
)
def test_blank_keywords_can_be_skipped(spark, query, keyword):
    (touch,) = apply(spark, [f"http://www.google.com/?{query}"], lambda c: urls.search_touch(c, RULES, "skip"))
    assert (touch["keyword"] if touch else None) == keyword


def test_keyword_case_is_optional(spark):
    keep = RULES.but(keyword_normalize_case=False)
    (touch,) = apply(spark, ["http://www.google.com/?q=OakTable"], lambda c: urls.search_touch(c, keep))
    assert touch["keyword"] == "OakTable"


def test_registrable_domain(spark):
    hosts = ["a.b.shop.example", "find.msn.com", "ask.com", "maps.google.co.jp", "intranet"]
    assert apply(spark, hosts, urls.registrable_domain) == ["shop.example", "msn.com", "ask.com", "co.jp", "intranet"]


def test_purchase_event(spark):
    lists = ["1", "7,8,1", "5 , 1", "10,100", "", "101", None, "\t1 ", "1,9", "31", "1a"]
    got = apply(spark, lists, lambda c: commerce.has_purchase(c, RULES))
    assert got == [True, True, True, False, False, False, False, True, True, False, False]


def test_purchase_event_with_pattern_characters(spark):
    got = apply(spark, ["a|1.0|b", "a|1x0|b", "1.0"], lambda c: commerce.has_event(c, "1.0", "|"))
    assert got == [True, False, True]


@pytest.mark.parametrize(
    "products, revenue",
    [
        ("Garden;Rake;2;18.5;", 18.5),
        ("Garden;Rake;1;40;,Garden;Gloves;3;2.25;", 42.25),
        ("", 0),
        (None, 0),
        ("nan", 0),
        ("Garden;Bench - oak;1;;", 0),
        ("Garden;Seeds;1;free;", 0),
        ("Garden;Rake;1;77;,Garden;Gloves;1;;", 77),
        ("Garden;Pond;1;64.10;event9;evar3,Water;Pump;1;35.90", 100),
        ("G;R;1;\t8 ;", 8),
        ("G;R;1;2e2;", 200),
        ("G;R;1;-12;", -12),
        ("G;R;1;NaN;", 0),
        ("G;R;1;-inf;", 0),
        ("G;R", 0),
    ],
)
def test_product_revenue(spark, products, revenue):
    (got,) = apply(spark, [products], lambda c: commerce.product_revenue(c, RULES))
    assert float(got) == revenue


def test_product_revenue_with_other_delimiters(spark):
    rules = RULES.but(product_delimiter="||", product_attr_delimiter="|", revenue_col_index=1)
    (got,) = apply(spark, ["x|0.25||y|3"], lambda c: commerce.product_revenue(c, rules))
    assert float(got) == 3.25


def test_revenue_text_has_no_thousands_separator(spark):
    df = spark.sql("SELECT CAST('20350' AS DECIMAL(38,6)) AS a, CAST('7.125' AS DECIMAL(38,6)) AS b")
    row = df.select(commerce.revenue_text(F.col("a")), commerce.revenue_text(F.col("b"))).first()
    assert tuple(row) == ("20350.00", "7.13")


def test_mask(spark):
    got = apply(spark, ["192.0.2.9", " 192.0.2.9\t", "", None], text.masked)
    digest = hashlib.sha256(b"192.0.2.9").hexdigest()[:16] + "..."
    assert got == [digest, digest, "EMPTY", "EMPTY"]


def test_blank(spark):
    assert apply(spark, [None, "", " ", "\t　", " x "], text.is_blank) == [True, True, True, True, False]


def test_filename_contract(spark):
    names = ["clicks_20230714_235959.tab", "clicks_20230714.tab", "clicks_today.tab", "clicks_20230714_2359.tab"]
    assert apply(spark, names, paths.has_name_timestamp) == [True, False, False, False]


def test_phase_label(spark):
    keys = ["in/phase4/a.tab", "in/a_jog.tab", "in/a.tab", "in/PHASE2/a.tab", "in/phases/crawl.tab", "phase10/b"]
    assert apply(spark, keys, paths.phase_label) == ["phase4", "phase3", "other", "phase2", "phase1", "phase10"]
