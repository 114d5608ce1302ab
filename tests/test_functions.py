"""Column expressions on literal cases."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placemill import normalise_text, page_count, page_of, rewrite_scheme, url_flags, url_flags_struct
from placemill.functions.paging import record_seq

FLAGS = {
    (False, False): [None, "-", "", "ftp://a.b", "www.a.com", "http://localhost", "http:///a.b", "http://a/b.c"],
    (True, False): ["http://a.com"],
    (True, True): ["https://a.com", "HTTPS://A.com/x", "https://a?x=1.2"],
    (False, True): ["https://"],
}


def one(spark, values, expression):
    """Values in, results out, in the same order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def test_url_flags(spark):
    urls = [url for group in FLAGS.values() for url in group]
    wanted = [flags for flags, group in FLAGS.items() for _ in group]
    assert [tuple(r) for r in one(spark, urls, F.struct(*url_flags("v")))] == wanted
    structs = one(spark, urls, url_flags_struct("v"))
    assert [(r.valida_forma, r.indicador_seguranca_site) for r in structs] == wanted


def test_url_flags_are_never_null_in_schema(spark):
    df = spark.createDataFrame([(None,)], "v string").select(url_flags_struct("v").alias("s"))
    assert not any(field.nullable for field in df.schema["s"].dataType.fields)


@pytest.mark.parametrize(
    ("url", "wanted"),
    [
        ("http://localhost", "https://localhost"),
        ("http:///a.b", "https:///a.b"),
        ("https://localhost", "https://localhost"),
        ("https://", "https://"),
        ("http://", "https://"),
        ("HTTP://x", "HTTP://x"),
        ("-", "-"),
        ("ftp://a.b", "ftp://a.b"),
        ("xhttp://a", "xhttp://a"),
        ("http://a.com", "http://a.com"),
        (None, None),
    ],
)
def test_rewrite_scheme(spark, url, wanted):
    assert one(spark, [url], rewrite_scheme("v", url_flags("v")[0])) == [wanted]


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("\tFoo\n", "\tfoo\n"),
        ("- Foo", " foo"),
        ("São Paulo", "so paulo"),
        ("a b", "ab"),
        ("  A & B, Co. #1!  ", "a & b, co. 1"),
        ("***", ""),
        (None, None),
    ],
)
def test_normalise_strip(spark, text, wanted):
    assert one(spark, [text], normalise_text("v", strip_chars=True)) == [wanted]


@pytest.mark.parametrize(
    ("text", "wanted"), [("\tFoo\n", "foo"), ("a b", "a b"), (" - São　", " so"), (None, None)]
)
def test_normalise_unicode_strip(spark, text, wanted):
    assert one(spark, [text], normalise_text("v", strip_chars=True, unicode=True)) == [wanted]


def test_normalise_trim_only(spark):
    assert one(spark, ["  São! ", "\tX "], normalise_text("v")) == ["são!", "\tx"]


texts = st.text(
    alphabet=st.one_of(
        st.sampled_from("aZ09.,& -#éÃ\t\n\x0b\x0c\r\x1c\x1f\x85\xa0    　"), st.characters(codec="utf-8")
    ),
    max_size=12,
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=200, max_size=200))
def test_unicode_normalising_equals_python(spark, values):
    lowered = one(spark, values, F.lower("v"))
    wanted = [re.sub(r"[^a-zA-Z0-9.,&\s]+", "", low.strip()) for low in lowered]
    assert one(spark, values, normalise_text("v", strip_chars=True, unicode=True)) == wanted


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=200, max_size=200))
def test_ascii_normalising_equals_python(spark, values):
    lowered = one(spark, values, F.lower("v"))
    wanted = [re.sub(r"(?a)[^a-zA-Z0-9.,&\s]+", "", low.strip(" ")) for low in lowered]
    assert one(spark, values, normalise_text("v", strip_chars=True)) == wanted


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=200, max_size=200))
def test_normalising_again_only_trims(spark, values):
    # The deletion can lay bare a leading or trailing blank; nothing else is left to do.
    once = one(spark, values, normalise_text("v", strip_chars=True))
    assert one(spark, once, normalise_text("v", strip_chars=True)) == [text.strip(" ") for text in once]


def test_page_arithmetic(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 49, 50, 51, 2**60 + 1)], "n bigint")
    counts = [r[0] for r in df.select(page_count(F.col("n"), 50)).collect()]
    assert counts == [-(-n // 50) for n in (0, 1, 49, 50, 51, 2**60 + 1)]
    pages = [r[0] for r in df.select(page_of(F.col("n"), 50)).collect()]
    assert pages == [n // 50 + 1 for n in (0, 1, 49, 50, 51, 2**60 + 1)]


def test_record_seq_fits_largest_page_and_position(spark):
    largest = 2**31 - 1
    df = spark.createDataFrame([(largest, largest)], "page int, pos int")
    assert df.select(record_seq(F.col("page"), F.col("pos"))).first()[0] == largest * 2**32 + largest
