"""One VARIANT decode for messages that producers spell differently."""

import pytest
from pyspark.sql import functions as F

from txflow.sources import messages, schemas

ROWS = [
    '{"id": 1, "user": "u", "amount": 12.5, "timestamp": 1700000000, "category": "a"}',
    '{"id": "2", "user": "u", "amount": "12,5", "timestamp": "2023-11-14 22:13:20", "category": "b", "class": "vip"}',
    '{"id": 3.0, "user_id": 77, "amount": 12, "timestamp": "1700000000", "category": null, "extra": {"a": [1, "x"]}}',
    '{"id": "x", "amount": "none", "timestamp": "soon", "category": 5}',
    '{oops', None, '', '[1, 2]', '"text"', '{}', '{"id": 9, "id": 10}',
]


@pytest.fixture(scope="module")
def decoded(spark):
    rows = [(b"k", None if v is None else v.encode(), "t", 0, i, None) for i, v in enumerate(ROWS)]
    return messages.decode_any(spark.createDataFrame(rows, schemas.ENVELOPE), ["offset"])


def test_all_spellings_decode_to_the_same_types(decoded):
    got = {r.offset: r for r in decoded.collect()}
    fields = lambda r: (r.id, r.user, r.amount, r.timestamp, r.category)
    assert fields(got[0]) == (1, "u", 12.5, 1700000000, "a")
    assert fields(got[1]) == (2, "u", 12.5, 1700000000, "b")
    assert fields(got[2]) == (3, "77", 12.0, 1700000000, None)
    assert fields(got[3]) == (None, None, None, None, "5")
    assert [i for i in got if got[i].broken] == [4, 5, 6, 7, 8, 10]
    assert not got[9].broken and got[9].extra == {}


def test_unknown_fields_are_kept_and_counted(decoded):
    kept = {r.offset: r.x for r in decoded.select("offset", F.to_json("extra").alias("x")).collect()}
    assert kept[1] == '{"class":"vip"}' and kept[2] == '{"extra":{"a":[1,"x"]}}' and kept[0] == "{}" and kept[4] is None
    assert sorted(tuple(r) for r in messages.unknown_fields(decoded).collect()) == [
        ("class", "STRING", 1), ("extra", "OBJECT<a: ARRAY<VARIANT>>", 1)]


def test_the_plan_has_no_python(decoded):
    assert "Python" not in decoded._jdf.queryExecution().executedPlan().toString()
