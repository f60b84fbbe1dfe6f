import json

from hypothesis import given, settings
from hypothesis import strategies as st

from leadloom.functions.loose_json import mend, parse

VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=8), lambda v: st.lists(v, max_size=3) | st.dictionaries(st.text(max_size=4), v, max_size=3), max_leaves=8)


@settings(max_examples=150, deadline=None)
@given(st.lists(VALUES, max_size=3) | st.dictionaries(st.text(max_size=4), VALUES, max_size=3))
def test_sound_json_stays(value):
    assert json.loads(mend("Sure:\n```json\n" + json.dumps(value) + "\n```")) == value


def test_repairs():
    assert json.loads(mend('{"a": [1, 2,], "b": "x')) == {"a": [1, 2], "b": "x"}
    assert json.loads(mend('text {"a": 1, } more')) == {"a": 1}
    assert mend("no json") is None
    assert mend(None) is None


def test_parse_handles_all_rows(spark):
    df = spark.createDataFrame([(1, '{"k": 1}'), (2, '```{"k": 2,}```'), (3, None), (4, "none"), (5, '{"k": 5')], "i int, raw string")
    assert {r.i: r.k for r in parse(df, "raw", "k int").select("i", "parsed.k").collect()} == {1: 1, 2: 2, 3: None, 4: None, 5: 5}
