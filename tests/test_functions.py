from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import python as P
from corpusloom.functions import text as T


def one(spark, column, **values):
    """The value of a column expression over one row."""
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("<p>a<b>b</b></p>", "a b"), ("x<script>var a='<p>';</script>y", "xy"), ("<STYLE>p{}</STYLE>z", "z"), ("a&nbsp;&amp;lt;b", "a <b"), ("&#169;c", "c"),
        ("  many \n\n spaces ", "many spaces"),
    ],
)
def test_strip_html(spark, given, wanted):
    assert one(spark, T.strip_html(F.col("t")), t=given) == wanted


@pytest.mark.parametrize(("given", "wanted"), [("a b  c", 3), ("", 0), ("   ", 0), (None, 0), ("a b", 2)])
def test_word_count(spark, given, wanted):
    assert one(spark, T.word_count(F.col("t")), t=given) == wanted


def test_urls(spark):
    assert one(spark, T.normalise_url(F.col("u")), u="https://a.b/c/?x=1#frag") == "https://a.b/c/?x=1"
    assert one(spark, T.normalise_url(F.col("u")), u="https://a.b/c//") == "https://a.b/c"
    forum = one(spark, T.forum_address(F.col("u")), u="https://x.y/r/Cars/top/?t=all")
    assert tuple(forum) == ("Cars", "top", "all")
    assert tuple(one(spark, T.forum_address(F.col("u")), u="https://x.y/r/Cars/")) == ("Cars", "hot", None)
    assert tuple(one(spark, T.forum_address(F.col("u")), u="https://x.y/")) == ("", "hot", None)


@pytest.mark.parametrize(("given", "wanted"), [('a<b>:"c', "a_b___c"), (" .x. ", "x"), ("...", "unnamed"), ("abcdef", "abcdef")])
def test_sanitise_filename(spark, given, wanted):
    assert one(spark, T.sanitise_filename(F.col("t")), t=given) == wanted


def test_strip_noise(spark):
    text = "[bob | score 12]\nsee u/alice and /r/Cars but not menu/r/x [deleted]  end\n\n\n\nlast"
    assert one(spark, T.strip_noise(F.col("t")), t=text) == "see and but not menu/ end\n\nlast"


def test_truncate(spark):
    text = "First part. Second part! " + "x" * 30
    assert one(spark, T.truncate(F.col("t"), 30), t=text) == "First part. Second part!"
    assert one(spark, T.truncate(F.col("t"), 100), t=text) == text
    assert one(spark, T.truncate(F.col("t"), 10), t="y" * 20) == "y" * 10


@pytest.mark.parametrize(
    ("given", "wanted"),
    [("", 0.0), ("word " * 19, 0.1), ("word " * 20, 0.2), ("word " * 50, 0.4), ("word " * 200, 0.6), ("word " * 500, 0.8), ("brake pad " * 250, 0.84), ("engine brake turbo diesel torque fuel mph clutch radiator coolant filter " * 50, 1.0)],
)
def test_content_quality(spark, given, wanted):
    assert one(spark, T.content_quality(F.col("t")), t=given) == pytest.approx(wanted)


@pytest.mark.parametrize(("given", "wanted"), [("My 2015 toyota rav4 rattles", ("Toyota", "RAV4", "2015")), ("the frame of it", ("Ram", "", "")), ("nothing 1959", ("", "", ""))])
def test_vehicle(spark, given, wanted):
    brand = T.vehicle_brand(F.col("t"))
    assert tuple(one(spark, F.struct(brand, T.vehicle_model(F.col("t"), brand), T.vehicle_year(F.col("t"))), t=given)) == wanted


def test_questions(spark):
    good = "How often should the timing belt of a 2012 sedan be replaced in dry climates?"
    assert one(spark, T.acceptable_question(F.col("t")), t=good)
    assert not one(spark, T.acceptable_question(F.col("t")), t="Too short?")
    assert not one(spark, T.acceptable_question(F.col("t")), t=good + " As the author says.")


@pytest.mark.parametrize(
    ("status", "html", "title", "wanted"),
    [(403, "<p>real</p>", "Page", 200), (403, "x", "Just a moment...", 403), (503, "cf-challenge", "", 503), (404, "x", "", 404), (200, "just a moment", "", 200)],
)
def test_page_status(spark, status, html, title, wanted):
    df = spark.createDataFrame([(status, html, title)], "s int, h string, t string")
    assert df.select(T.page_status(F.col("s"), F.col("h"), F.col("t"))).first()[0] == wanted


def test_listing_links(spark):
    df = spark.createDataFrame([(["https://a/1", "https://b/2", "https://a/1", "https://a/tag/x", "https://a/p"],)], "l array<string>")
    got = df.select(T.listing_links(F.col("l"), F.lit("https://a"), F.lit("https://a/p"), T.LIST_PAGES)).first()[0]
    assert got == ["https://a/1"]


def brute_print(text):
    import hashlib

    w = text.lower().split()
    grams = w if len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    hashes = [int(hashlib.md5(g.encode()).hexdigest(), 16) for g in grams]
    return sum(1 << b for b in range(128) if sum(1 if h >> b & 1 else -1 for h in hashes) > 0)


@pytest.mark.parametrize("text", ["a", "a b", "The quick brown fox", "a b c a b c a b c d", "é ü ñ ß"])
def test_fingerprint(text):
    hi, lo = P.fingerprint(text)
    assert ((hi & (1 << 64) - 1) << 64 | lo & (1 << 64) - 1) == brute_print(text)
    assert P.fingerprint("") == P.fingerprint(None) == (0, 0)


def test_fingerprints_of_a_batch(monkeypatch):
    """A batch gives what each text gives; slices of 55 bytes are the longest that fit one block of MD5."""
    edges = ["w" * 20 + " " + "v" * 17 + " " + "u" * n for n in (15, 16, 17)] + ["x" * n for n in (54, 55, 56, 200)]
    long = " ".join(f"{'ab'[i % 2] * (i % 23)}{i % 7}" for i in range(900))
    texts = [*edges, None, "", " ", "a", "a b", "é ü ñ ß", long, long]
    wanted = [brute_print(t) if t and t.strip() else 0 for t in texts]
    many = []
    monkeypatch.setattr(P, "_md5_short", lambda line, s, e, f=P._md5_short: many.append(len(s)) or f(line, s, e))
    for grams, at_once in ((P._GRAMS, P._AT_ONCE), (64, 10), (1, 1)):
        monkeypatch.setattr(P, "_GRAMS", grams)
        monkeypatch.setattr(P, "_AT_ONCE", at_once)
        assert [(hi & (1 << 64) - 1) << 64 | lo & (1 << 64) - 1 for hi, lo in P.fingerprints(texts)] == wanted
    assert max(many) > 900 and P.fingerprints([]) == []  # slices of many texts at once


@pytest.mark.parametrize(
    ("reply", "wanted"),
    [
        ('[{"question": "q", "answer": "a"}]', [("q", "a")]), ('```json\n[{"question": "q", "answer": "a"}]\n```', [("q", "a")]),
        ('{"qa_pairs": [{"question": "q", "answer": "a"}]}', [("q", "a")]), ('{"question": "q", "answer": "a"}', [("q", "a")]),
        ('[{"question": "q", "answer": "a\\"b"}, {"question": "cut', [("q", 'a"b')]), ("no json", []), ("", []), (None, []), ('[1, {"question": "x"}]', []),
    ],
)
def test_parse_pairs(reply, wanted):
    assert P.parse_pairs(reply) == wanted


def test_parse_page():
    html = '<html><nav><a href="/x">x</a></nav><article><h1>T</h1><p>Body<div class="ad">no</div> text<br>more<script>s()</script></p></article><div class="content">later</div></html>'
    title, content, _, links = P.parse_page(html)
    assert (title, links) == ("T", ["/x"])
    assert "Body" in content and "more" in content and "no<" not in content and "s()" not in content and "later" not in content


def test_clean_text(spark):
    df = spark.createDataFrame([("ﬁx  it\n",), (None,)], "t string")
    assert [r[0] for r in df.select(P.clean_text("t")).collect()] == ["fix it", ""]


def test_language(spark):
    assert P.language_of("short") == "en"
    assert P.language_of("der Hund und die Katze sind nicht in dem Haus, das für sich steht und ruht") == "de"
    assert P.language_of("zzz " * 30) == "en"


def test_file_name(spark):
    from corpusloom.sources import sinks

    df = spark.createDataFrame([(datetime.datetime(2024, 1, 2, 3, 4, 5), "f" * 64, "a/b")], "d timestamp, h string, t string")
    assert df.select(sinks.file_name(F.col("d"), F.col("h"), F.col("t"))).first()[0] == "20240102_030405_ffffffffffff_a_b"


def test_grams_of_many_texts_at_once():
    from collections import Counter

    from corpusloom.functions import language

    texts = ["Ein Übermaß, ein  Maß!", None, "", "12 ... 34", "İstanbul ΟΔΟΣ x²y ½", "\ud800a\x00b 中文字", "a", " b ", "word " * 900]
    assert language.counted_grams(texts) == sum(map(language.grams, texts), Counter())
    assert language.counted_grams([]) == {} and language.counted_grams([None, "1"]) == {}
    many = "".join(chr(c) for c in range(0x3400, 0x1F000) if chr(c).isalpha())
    many = [many[i : i + 2000] for i in range(0, len(many), 2000)]
    assert language.counted_grams(many) == sum(map(language.grams, many), Counter())
    detector = object.__new__(language.Detector)
    detector.languages = ["en", "de", "fr"]
    detector.weights = {g: [-(i * 37 % 900), -(i * 53 % 900), -(i * 71 % 900)] for i, g in enumerate(sorted(language.counted_grams(texts))[::3])}
    asked = [*texts, *(f"{t} " * 40 for t in texts if t), "zzzz" * 30, "Ein Übermaß " * 9]
    assert detector.of_all(asked) == [detector.of(t) for t in asked]
