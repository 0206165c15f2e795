import pytest
from pyspark.sql import functions as F

from shelfwise.functions import casts, identity, text, urls
from shelfwise.operators.classify import disc_type


def run(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("function", "given", "want"),
    [
        (casts.to_int, [None, "", "12", " 12 ", "12.5", "abc"], [None, None, 12, 12, None, None]),
        (casts.to_int_cut, ["12.5", "-3.9", "abc", "NaN", "Infinity", None], [12, -3, None, None, None, None]),
        (casts.to_float, ["1.5", "", None, "x", " 2 "], [1.5, None, None, None, 2.0]),
        (casts.safe_int, [None, "", "7.9", "x"], [0, 0, 7, 0]),
        (casts.safe_float, [None, "", "7.5", "x"], [0.0, 0.0, 7.5, 0.0]),
        (casts.safe_bool, [None, "true", "TRUE ", "1", "yes", "y", "0"], [False, True, True, True, True, False, False]),
        (casts.money_text, ["12345678.5", "1", None], ["12345678.50", "1.00", None]),
        (text.strip_html, [None, "", "a<br>b", "&lt;b&gt;", "a&nbsp;b", "\ta\n b ", "x < y"], ["", "", "a b", "<b>", "a\xa0b", "a b", "x < y"]),
        (text.available_stock, ["Out of Stock", "Sold out", "3 in stock", "In stock", None, ""], [0, 0, 3, None, None, None]),
        (text.grams, ["173-175g", "170+ g", "180G", "none"], ["173-175", "170+", "180", None]),
        (text.slug_title, ["big-bAD--disc", "-", "", None], ["Big Bad Disc", None, None, None]),
        (text.numeric_token, ["a -1.5 b", "none", None], ["-1.5", None, None]),
        (lambda c: text.first_group(c, "a(.*?)b"), ["xab", "a1b", "c", None], ["", "1", None, None]),
        (lambda c: text.shortened(c, 3), ["abcdef", "ab"], ["abc", "ab"]),
        (
            urls.store_key,
            [None, " ", "Shop.example", "HTTP://Shop.example:80/A//?q=1#f", "https://x.example/a/b/"],
            [None, None, "https://shop.example/", "http://shop.example:80/A/", "https://x.example/a/b/"],
        ),
        (urls.store_base, ["x.example", "http://x.example//", None], ["https://x.example/", "http://x.example/", None]),
        (urls.reference_of_file, ["/a/my__shop_1_2024.json", "shop.json"], ["my__shop", "shop"]),
        (urls.store_of_reference, ["a__example", "throwshop", "unknown"], ["https://a.example/", "https://throwshop.us/", None]),
        (lambda c: urls.absolute(c, "https://b.example"), ["/x", "http://c", "", None], ["https://b.example/x", "http://c", None, None]),
        (urls.is_web_address, ["ftp://x", "HTTPS://x", "https://", " http://x ", None], [False, True, False, True, False]),
        (urls.quoted, ["a b/c?"], ["a%20b%2Fc%3F"]),
        (lambda c: urls.crawl_link(c, F.lit("https://h.example/p/q")), ["#a", "mailto:x", "/a/?q", "b", "//o.example/x/", "HTTPS://z/", "../c", "../../../d", "./e/../f", "", "?x", " g"],
         [None, None, "https://h.example/a", "https://h.example/p/b", "https://o.example/x", "https://z", "https://h.example/c", "https://h.example/d", "https://h.example/p/f", None, "https://h.example/p/q", "https://h.example/p/g"]),
        (urls.is_asset, ["http://a/b.PNG?x", "http://a/b", "http://a.css/"], [True, False, False]),
        (lambda c: urls.in_section(c, "a", "/all/"), ["http://a/all/x", "http://a/x", "http://b/all/x"], [True, False, False]),
        (urls.sitemap_products, ["<loc>h/product/a</loc><loc>h/about</loc>"], [["h/product/a"]]),
        (urls.sitemap_locations, ["<loc> a </loc><LOC>b</LOC><loc>a</loc><loc></loc>"], [["a", "b"]]),
        (identity.parse_tags, [None, "[]", '["a","b"]', '["a",null]', "null", "a, ,b", "[a,b]", " "], [[], [], ["a", "b"], ["a"], ["null"], ["a", "b"], ["[a", "b]"], []]),
        (disc_type, ["Long Range Driver", "FAIRWAY driver", "approach", "midrange putter", "x", None],
         ["DistanceDriver", "FairwayDriver", "Putter", "Putter", "Unknown", "Unknown"]),
    ],
)
def test_column_functions(spark, function, given, want):
    assert run(spark, function, given) == want


def test_hash_keeps_nulls_apart_from_blanks(spark):
    a, b, c = run(spark, lambda v: identity.json_hash({"v": v}), [None, "", "null"])
    assert len({a, b, c}) == 3


def test_shop_id(spark):
    df = spark.createDataFrame(
        [(" Shop ", "u", None, " ", "7"), (None, "U/", "1", None, None), (None, None, "1", None, None), ("", "u", "1", None, None), ("s", "u", None, None, " ")],
        "store string, store_url string, variant_id string, id string, product_id string",
    )
    got = [r[0] for r in df.select(identity.shop_variant_id(*[F.col(c) for c in df.columns])).collect()]
    assert got == ["shopify:shop:7", "shopify:u/:1", "shopify:unknown-store:1", "shopify::1", None]


def test_tags_json_and_batch_id(spark):
    df = spark.sql("select cast(null as array<string>) t, timestamp'2024-01-02 03:04:05' ts")
    assert tuple(df.select(identity.tags_json(F.col("t")), identity.batch_id(F.col("ts"))).first()) == ("[]", "2024-01-02T03:04:05Z")


def test_html_unescaped(spark, tmp_path):
    import html
    import re

    import __spark_entry__

    pages = [(1, "<h1>A &amp; B</h1><p>&copy; &#233; &eacute;&nbsp;x &lt;b&gt; &bogus; &amp;lt;</p><p>after</p>"), (2, "no tags &quot;q&quot; &#x1F600;"), (3, None), (4, "")]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"file://{tmp_path}/pages.parquet")
    got = __spark_entry__.queries()["html_unescaped"](spark, f"file://{tmp_path}")
    assert {r.page_id: r.text for r in got.collect()} == {i: html.unescape(" ".join(re.sub("<[^>]+>", " ", t or "").split())) for i, t in pages}
