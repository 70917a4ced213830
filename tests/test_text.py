import html
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.packs import MOJIBAKE
from corpusflow.session import ship


def values(spark, column, *texts):
    ship(spark)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


ALPHABET = "aZ09 .-_\t\n  –ﬁß&lt;amp#39<b>[]()Éé"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=20, max_size=40))
def test_clean_text_same_as_python(spark, texts):
    def plain(t):
        t = html.unescape(t)
        for a, b in MOJIBAKE.items():
            t = t.replace(a, b)
        t = unicodedata.normalize("NFKC", re.sub("<[^>]+>", " ", t))
        return re.sub(r"\s+", " ", re.sub("[‐-―−]", "-", t)).strip()

    assert values(spark, X.clean_text("t"), *texts) == [plain(t) for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=20, max_size=40))
def test_squash_and_lines_same_as_python(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert values(spark, X.squash("t"), *texts) == [re.sub(r"\s+", " ", t).strip() for t in texts]


@pytest.mark.parametrize(
    ("title", "key"),
    [
        ("Text-to-SQL", "texttosql"), ("text 2 sql", "texttosql"), ("Text to SQL.", "texttosql"), ("NL 2 SQL!", "nl2sql"), ("Natural Language to SQL", "naturallanguagetosql"),
        ("深度学习", ""), ("&lt;b&gt;x&lt;/b&gt; y", "x y"), ("Straße ﬁne", "strasse fine"), ("A study [Experiment, Analysis]", "a study"), (None, ""), ("  ", ""),
    ],
)
def test_title_key(spark, title, key):
    assert values(spark, X.title_key("t"), title) == [key]


def test_orders_of_cleaning_differ(spark):
    assert values(spark, X.references_then_tags("t"), "&lt;b&gt;x") == ["x"]
    assert values(spark, X.tags_then_references("t"), "&lt;b&gt;x") == ["<b>x"]
    assert values(spark, X.clean_html("t"), "<script>a</script>b<p>c &amp; d") == ["b c & d"]
    assert values(spark, X.simple_key("t"), "Text-to-SQL &amp; more") == ["text to sql more"]


def test_lists_of_pages(spark):
    assert values(spark, X.listed_title("t"), "12 | A long title", "3. Another one [Vision]", "short", "X", None) == ["A long title", "Another one", "", "", ""]
    assert values(spark, X.listed_authors("t"), "A B (Uni), C* and D; E DOI: 10.1/x", "", None) == ["A B and C and D and E", "", ""]
    assert values(spark, X.listed_authors("t", commas=False), "B, A and C") == ["B, A and C"]


def test_doi(spark):
    assert values(spark, X.doi("t"), "doi: 10.1234/ab.c).", "https://dx.doi.org/10.1234/x;", "none", None) == ["10.1234/ab.c", "10.1234/x", "", ""]
    assert values(spark, X.doi("t", decode=True), "https://doi.org/10.1234%2Fa+b", "10.1234/100%") == ["10.1234/a+b", "10.1234/100%"]


def test_small_functions(spark):
    assert values(spark, X.slug("t", 9), "A b-C!! dd", None) == ["a-b-c-dd", ""]
    assert values(spark, X.path_year("t"), "/raw/2024/x2021.json", "/raw/x2021.json", "C:\\raw\\2020\\y", "z", None) == ["2024", "2021", "2020", "", ""]
    assert values(spark, X.escape_html("t"), """<a href="x">'&'""") == ["&lt;a href=&quot;x&quot;&gt;&#39;&amp;&#39;"]
    assert values(spark, X.lines("t"), "<p>a &amp; b</p><li>c<br/>d</li>\n\n e  f", None) == [["a & b", "c", "d", "e f"], []]
    index = spark.createDataFrame([({"b": [1, 3], "a": [0], "c": [2]},), (None,)], "m map<string,array<int>>")
    assert [r[0] for r in index.select(X.inverted_text("m")).collect()] == ["a b c b", ""]
    assert values(spark, X.let(F.length("t"), lambda n: n * n), "abc") == [9]
