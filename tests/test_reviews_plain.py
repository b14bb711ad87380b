"""Review lists taken apart by column expressions against the whole grammar."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiffin.operators import reviews
from tiffin.sources import fixtures as fx

PLAIN = [
    "", "[]", "[ \n]", "[('a','b')]", "[ ( 'a' ,\t\"b\" , ) ,\n('c', 'd'), ]", r"[('Rated 4.0', 'RATED\n  don\'t')]",
    r"""[("it's", 'say "x"')]""", r"[('\\', '\\n')]", r"[('\\\n', '\\\\x41')]", r"[('\x83\x41x', '\x00\\x41')]", r"[('\"\t\r', '')]",
    "[('), (', '[]')]", "[('é\U0001f600', '\u2028')]", "[('', '')" + ", ('a', 'b\\\\')" * 500 + "]", "[('x', '" + "long \\'text\\' " * 50_000 + "')]",
]
REST = [
    " []", "[]\n", "()", "(('a','b'),)", "[['a','b']]", "[('a','b','c')]", "[('a',)]", "[('a' 'b','c')]", "[(u'a','b')]", "[(b'a','b')]",
    "[(None, 'b')]", "[(4.0, 'b')]", r"[('\u0041','b')]", r"[('\101','b')]", r"[('\d','b')]", "[('a\nb','c')]", "[('a','b'),,]", "[,]", "[('a','b')",
    "[('a','b') ('c','d')]", "[('a\\','b')]", "['ab']", "x", "[('a','b')] + []", "[('''a''','b')]", "[('a','b')]#", "[('a\x00','b')]", "\n[]",
    r"[('\x4','b')]", "[('a\\\nb','c')]", "[('a',\r'b')]", "[(r'\\n','b')]",
]


def expected(field):
    return [] if not field else reviews.literal_pairs(field)


def taken_apart(spark, fields):
    df = spark.createDataFrame(list(enumerate(fields)), "restaurant_id long, reviews_list string")
    got = df.select("restaurant_id", reviews.is_plain(F.col("reviews_list")).alias("plain"),
                    reviews.plain_pairs(F.col("reviews_list")).alias("pairs"))
    return [(r.plain, r.pairs and [tuple(p) for p in r.pairs] or []) for r in got.orderBy("restaurant_id").collect()]


def test_plain_fields_need_no_python(spark):
    for field, (plain, pairs) in zip(PLAIN, taken_apart(spark, PLAIN)):
        assert plain and pairs == expected(field), field[:80]
    assert not any(plain for plain, _ in taken_apart(spark, REST))


def test_both_ways_in_one_column(spark):
    fields = [*PLAIN, *REST, None]
    df = spark.createDataFrame(list(enumerate(fields)), "restaurant_id long, reviews_list string")
    got = reviews.with_parsed(df).orderBy("restaurant_id").collect()
    assert [r.parsed if r.parsed is None else [tuple(p) for p in r.parsed] for r in got] == [expected(f) for f in fields]
    bad = [r.restaurant_id for r in reviews.rejected_reviews(reviews.with_parsed(df)).orderBy("restaurant_id").collect()]
    assert bad == [i for i, f in enumerate(fields) if expected(f) is None] != []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="[(',\") \\nx4]tu\n\ta", max_size=24), min_size=200, max_size=400))
def test_any_text(spark, bodies):
    fields = [f"[('{b}', \"{b}\")]" for b in bodies] + bodies + [repr([(b, b), (b, "")]) for b in bodies]
    for field, (plain, pairs) in zip(fields, taken_apart(spark, fields)):
        assert not plain or pairs == expected(field), field


def test_share_left_to_python(spark, t01):
    """Of the fixture's lists, Python gets only those that are no literal."""
    raw = fx.reviews_raw(t01)
    field = F.coalesce("reviews_list", F.lit(""))
    left = raw.where(~reviews.is_plain(field)).select("restaurant_id")
    bad = reviews.rejected_reviews(reviews.with_parsed(raw)).select("restaurant_id")
    assert left.exceptAll(bad).count() == 0 < bad.count()
