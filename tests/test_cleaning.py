import html
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions.text import clean_description, synopsis_preview


def expected(raw):
    """The rule in plain Python, as the oracle."""
    if not raw:
        return ""
    text = re.sub(r"<br\s*/?>", " ", raw, flags=re.IGNORECASE)
    text = re.sub(r"<[^>]+>", "", text)
    return re.sub(r"\s+", " ", html.unescape(text)).strip()


def cleaned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n long, raw string")
    rows = clean_description(df, "raw", "clean").collect()
    return [r["clean"] for r in sorted(rows, key=lambda r: r["n"])]


EXAMPLES = [
    ("<br>Hola<br/>Mundo<i>!</i>", "Hola Mundo!"),
    ("a&nbsp;&nbsp;b", "a b"),
    ("&amp;lt;b&amp;gt; &lt;b&gt; x", "&lt;b&gt; <b> x"),
    ("&#39;q&#x27; &copy &copyright &bogus; &ampx", "'q' © ©right &bogus; &x"),
    ("a　b\u0085c​d", "a b c​d"),
    ("x<i\nclass='y'>z", "xz"),
    ("&#128512;&#0;&#150;", "😀�–"),
    (None, ""),
    ("", ""),
]


def test_examples(spark):
    raws, wanted = zip(*EXAMPLES)
    assert [expected(raw) for raw in raws] == list(wanted)
    assert cleaned(spark, raws) == list(wanted)


def test_every_space_python_knows(spark):
    points = [c for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{chr(c)}b<br{chr(c)}/>c" for c in points]
    wrong = [hex(c) for c, got, raw in zip(points, cleaned(spark, texts), texts) if got != expected(raw)]
    assert wrong == []


FRAGMENTS = ["<br>", "<BR />", "<br />", "<i>", "</i>", "<", ">", "&amp;", "&amp", "&lt;", "&#38;", "&#x3C;",
             "&nbsp;", "&notit;", "&", ";", " ", "\n", "\t", " ", "\x1c", "é", "word", "😀"]


def test_random_mixtures(spark):
    seen = []

    @settings(max_examples=400, deadline=None, database=None)
    @given(st.lists(st.sampled_from(FRAGMENTS), max_size=12))
    def gather(parts):
        seen.append("".join(parts))

    gather()
    assert cleaned(spark, seen) == [expected(t) for t in seen]


def test_preview(spark):
    long = "a|b\nc " + "word " * 60
    df = spark.createDataFrame([(0, None), (1, ""), (2, " a|b\nc "), (3, long), (4, "y" * 160)], "n long, t string")
    rows = {r["n"]: (r["p"], r["q"]) for r in df.select(
        "n", synopsis_preview(F.col("t")).alias("p"),
        synopsis_preview(F.col("t"), table_safe=False).alias("q")).collect()}
    flat = long.replace("|", "/").replace("\n", " ").strip()
    assert rows[0] == ("", "") and rows[1] == ("", "")
    assert rows[2] == ("a/b c", " a|b c ")
    assert rows[3][0] == flat[:160].rstrip() + "…"
    assert rows[3][1] == long.replace("\n", " ")[:160].rstrip() + "…"
    assert rows[4] == ("y" * 160, "y" * 160)
