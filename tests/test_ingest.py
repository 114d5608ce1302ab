"""Paged ingestion: which pages are read, and which are never decoded."""

import json

import pytest

import placemill as pm
from placemill import schema as S

PAGES = "page int, status int, body string"


def body(*ids):
    return json.dumps([{"id": i, "name": f"n{i}"} for i in ids])


def ids(df):
    return [r.id for r in df.orderBy(S.LOAD_SEQ).collect()]


CASES = {
    "no stop": ([(1, 200, body("a", "b")), (2, 200, body("c"))], ["a", "b", "c"]),
    "empty page, then a bad one": ([(1, 200, body("a")), (2, 200, "[]"), (3, 500, "oops")], ["a"]),
    "records after an empty page": ([(1, 200, body("a")), (2, 200, " [ ] "), (3, 200, body("b"))], ["a"]),
    "other empty values": ([(1, 200, body("a")), (2, 200, "null"), (3, 200, body("b"))], ["a"]),
    "empty object": ([(1, 200, body("a")), (2, 200, "{}"), (3, 200, body("b"))], ["a"]),
    "failing first page": ([(1, 503, body("a")), (2, 200, body("b"))], []),
    "failing later page": ([(1, 200, body("a")), (2, 404, body("b")), (3, 200, body("c"))], ["a"]),
    "no body, failed": ([(1, 200, body("a")), (2, 500, None)], ["a"]),
    "no status": ([(1, 200, body("a")), (2, None, body("b"))], ["a"]),
    "malformed after the stop": ([(1, 200, body("a")), (2, 200, "[]"), (3, 200, "{oops")], ["a"]),
    "missing page": ([(1, 200, body("a")), (3, 200, body("b"))], ["a"]),
    "missing first page": ([(2, 200, body("b"))], []),
    "out of order": ([(3, 200, body("c")), (1, 200, body("a")), (2, 200, body("b"))], ["a", "b", "c"]),
    "page zero is no page": ([(0, 200, body("z")), (1, 200, body("a"))], ["a"]),
    "no pages": ([], []),
    "a record that is null": ([(1, 200, '[null, {"id": "a"}]')], [None, "a"]),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("layout", ["one partition", "parquet"])
def test_pages_read(spark, tmp_path, case, layout):
    pages, wanted = CASES[case]
    df = spark.createDataFrame(pages, PAGES)
    if layout == "parquet":  # a scan with pushdown, unlike a local relation
        df.repartition(3).write.parquet(str(tmp_path / "log"))
        df = spark.read.parquet(str(tmp_path / "log"))
    assert ids(pm.ingest_pages(df)) == wanted


@pytest.mark.parametrize("text", ["{oops", "", "  ", None, '[{"id": "a"', '{"message": "busy"}', "oops", "[1]"])
def test_malformed_before_stop_fails(spark, text):
    df = spark.createDataFrame([(1, 200, body("a")), (2, 200, text), (3, 200, body("b"))], PAGES)
    with pytest.raises(Exception, match="MALFORMED|Malformed|no JSON list in page 2"):
        pm.ingest_pages(df).collect()


def test_limits(spark):
    df = spark.createDataFrame([(p, 200, body(f"{p}a", f"{p}b")) for p in range(1, 6)], PAGES)
    everything = ids(pm.ingest_pages(df))
    assert len(everything) == 10
    assert ids(pm.ingest_pages(df, max_pages=2)) == everything[:4]
    assert ids(pm.ingest_pages(df, total_count=3, per_page=2)) == everything[:4]
    assert ids(pm.ingest_pages(df, total_count=4, per_page=2)) == everything[:4]
    assert ids(pm.ingest_pages(df, total_count=9, per_page=2, max_pages=1)) == everything[:2]
    assert ids(pm.ingest_pages(df, total_count=0)) == everything
    assert ids(pm.ingest_pages(df, max_pages=9)) == everything
    assert ids(pm.ingest_pages(df, stop=3)) == everything[:4]
    assert ids(pm.ingest_pages(df, stop=3, max_pages=1)) == everything[:2]


def test_fields(spark):
    text = json.dumps([{"id": "a", "longitude": -9.5, "postal_code": "01234", "extra": 1}, {"id": "b", "name": None}])
    df = spark.createDataFrame([(4, 200, text)], PAGES)
    got = pm.ingest_pages(df, stop=5, keep_position=True).orderBy("pos").collect()
    assert got[0].longitude == "-9.5"
    assert got[0].postal_code == "01234"
    assert got[0].phone is None
    assert [(r.page, r.pos, r.load_seq) for r in got] == [(4, 0, 4 * 2**32), (4, 1, 4 * 2**32 + 1)]
    assert pm.ingest_pages(df).columns == S.LANDING_SCHEMA.names


def test_stop_page(spark):
    df = spark.createDataFrame([(1, 200, body("a")), (2, 200, body("b"))], PAGES)
    assert pm.first_bad_page(df).first().stop == 3
    assert pm.first_bad_page(df, max_pages=1).first().stop == 2
    assert pm.first_bad_page(df.limit(0)).first().stop == 1


def test_a_page_landed_twice_fails(spark):
    rows = [(1, 200, body("a")), (1, 200, body("a")), (2, 200, body("b"))]
    with pytest.raises(Exception, match="landed twice: page 1"):
        pm.ingest_pages(spark.createDataFrame(rows, PAGES)).collect()
    # A failed attempt beside a good one, and a second copy behind the stop, do no harm.
    rows = [(1, 500, None), (1, 200, body("a")), (2, 200, "[]"), (3, 200, body("c")), (3, 200, body("c"))]
    assert ids(pm.ingest_pages(spark.createDataFrame(rows, PAGES))) == ["a"]


def test_rest(spark):
    text = json.dumps([{"id": "a", "extra": 1, "deep": {"x": [1]}}, None, {"id": "b", "extra": None}, {"id": "c"}])
    df = spark.createDataFrame([(1, 200, text)], PAGES)
    got = pm.ingest_pages(df, rest="others").orderBy(S.LOAD_SEQ).collect()
    assert [row.id for row in got] == ["a", None, "b", "c"]
    assert [row.others and json.loads(row.others) for row in got] == [
        {"extra": "1", "deep": '{"x":[1]}'}, None, {"extra": None}, None]
    plain = pm.ingest_pages(df, extra=False).orderBy(S.LOAD_SEQ).collect()
    assert [tuple(row) for row in plain] == [tuple(row)[:-1] for row in got]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        pm.ingest_pages(spark.createDataFrame([(1, 200, "[1]")], PAGES), rest="others").collect()


def test_page_number_at_the_end_of_its_type(spark):
    df = spark.createDataFrame([(2**31 - 1, 200, body("a")), (1, 200, body("b"))], PAGES)
    assert ids(pm.ingest_pages(df)) == ["b"]


def test_page_files(spark, tmp_path):
    for name, text in {
        "page-1.json": body("a"), "page-2.json": body("b", "c"), "page-3.500.json": "oops", "page-4.json": body("d")
    }.items():
        (tmp_path / name).write_text(text)
    pages = pm.read_page_files(spark, str(tmp_path))
    assert sorted((r.page, r.status) for r in pages.collect()) == [(1, 200), (2, 200), (3, 500), (4, 200)]
    assert ids(pm.ingest_pages(pages)) == ["a", "b", "c"]
    (tmp_path / "page-3.500.json").unlink()
    (tmp_path / "page-3.json").write_text("[]")
    assert ids(pm.ingest_pages(pm.read_page_files(spark, str(tmp_path)))) == ["a", "b", "c"]
    (tmp_path / "notes.json").write_text("[]")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        pm.read_page_files(spark, str(tmp_path)).collect()


def test_unknown_keys_become_columns(spark):
    """A key that is text here, a number there, and null or missing elsewhere is one column of text."""
    first = json.dumps([{"id": "a", "rating": "good", "tags": ["x", 1]}, None, {"id": "b", "rating": 4.5}])
    second = json.dumps([{"id": "c", "rating": None, "open hours": {"mon": True}}, {"id": "d"}])
    behind = json.dumps([{"id": "e", "late": 1}])
    df = spark.createDataFrame([(1, 200, first), (2, 200, second), (3, 200, "[]"), (4, 200, behind), (5, 200, "{oops")], PAGES)
    got = pm.ingest_pages(df, keep_position=True)
    assert got.columns == [*S.SOURCE_COLUMNS, "open hours", "rating", "tags", "page", "pos", S.LOAD_SEQ]
    found = {row.id: (row.rating, row.tags, row["open hours"]) for row in got.collect()}
    assert found == {
        "a": ("good", '["x",1]', None), None: (None, None, None), "b": ("4.5", None, None), "c": (None, None, '{"mon":true}'),
        "d": (None, None, None)}
    assert pm.ingest_pages(df, stop=2).columns == [*S.SOURCE_COLUMNS, "rating", "tags", S.LOAD_SEQ]
    assert pm.ingest_pages(df.filter("page > 1")).columns == S.LANDING_SCHEMA.names


@pytest.mark.parametrize("key", ["ID", "Load_Seq", "page"])
def test_keys_that_cannot_be_columns(spark, key):
    df = spark.createDataFrame([(1, 200, json.dumps([{"id": "a", key: "x"}]))], PAGES)
    with pytest.raises(ValueError, match="rest="):
        pm.ingest_pages(df)
    assert json.loads(pm.ingest_pages(df, rest="others").first().others) == {key: "x"}


def test_keys_that_are_data(spark):
    df = spark.createDataFrame([(1, 200, json.dumps([{f"k{n}": 1} for n in range(1001)]))], PAGES)
    with pytest.raises(ValueError, match="more than 1000"):
        pm.ingest_pages(df)
