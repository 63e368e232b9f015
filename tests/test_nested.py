import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.functions.nested import compact, split_json, split_object, split_yaml

keys = st.text(alphabet="abé\"", max_size=3)
trees = st.dictionaries(
    keys,
    st.recursive(
        st.integers(0, 9999) | st.text(alphabet="xyü", max_size=9) | st.lists(st.integers(0, 9), max_size=3) | st.none(),
        lambda t: st.dictionaries(keys, t, max_size=4),
        max_leaves=12,
    ),
    max_size=6,
)


def flat(tree, path=()):
    for key, value in tree.items():
        if isinstance(value, dict) and value:
            yield from flat(value, (*path, key))
        else:
            yield (*path, key), value


def put(tree, path, value):
    for key in path[:-1]:
        tree = tree.setdefault(key, {})
    tree[path[-1]] = value


def brute(tree, limit):
    """Serialise the chunk again for every leaf."""
    chunks = []
    for path, value in flat(tree):
        if chunks:
            grown = json.loads(json.dumps(chunks[-1]))
            put(grown, path, value)
            if len(compact(grown)) <= limit:
                chunks[-1] = grown
                continue
        chunks.append({})
        put(chunks[-1], path, value)
    return [(compact(c), len(compact(c)) > limit) for c in chunks]


@settings(max_examples=300, deadline=None)
@given(trees, st.integers(5, 60))
def test_same_as_brute_force(tree, limit):
    found = split_object(tree, limit)
    assert found == brute(tree, limit)
    leaves = [leaf for text, _ in found for leaf in flat(json.loads(text))]
    assert leaves == list(flat(tree))


def test_flat_object_has_a_closed_form():
    tree = {f"k{n:07d}": f"{n:09d}" for n in range(200)}
    found = split_object(tree)
    width = len(compact(tree)[1:-1].split(",")[0])
    per_chunk = (1792 - 1) // (width + 1)
    assert [len(json.loads(t)) for t, _ in found] == [per_chunk, per_chunk, 200 - 2 * per_chunk][: len(found)]


def test_json_edges():
    assert split_json("{}") == ([], None)
    assert split_json('{"a":{}}') == ([('{"a":{}}', False)], None)
    assert split_json('{"a":1,"a":2}') == ([('{"a":2}', False)], None)
    assert split_json('{"a":NaN}') == ([('{"a":NaN}', False)], None)
    assert split_json('{"é":"ü"}') == ([('{"é":"ü"}', False)], None)
    assert split_json('{"a":"\\ud800"}') == ([('{"a":"\\ud800"}', False)], None)
    long = split_json(json.dumps({"s": 1, "a": "x" * 3000, "b": 1}))[0]
    assert [over for _, over in long] == [False, True, False]
    assert "items" in split_json('{"title": "Example", "items": [1, 2, 3]}')[0][0][0]


@pytest.mark.parametrize("text", ["{not: json", "", "[1]", "3", "[" * 100_000])
def test_bad_json_is_named(text):
    pieces, error = split_json(text)
    assert pieces is None and error.startswith("Invalid JSON input: ")


@pytest.mark.parametrize("text", [": bad", "a: 1\n---\nb: 2", "d: 2020-01-01", "s: !!set {a}", "b: !!binary aGk=", "- 1", "a: [x", ""])
def test_bad_yaml_is_named(text):
    pieces, error = split_yaml(text)
    assert pieces is None and error.startswith("Invalid YAML input: ")


def test_yaml_values():
    assert split_yaml("    title: Example\n    list:\n      - a\n      - b\n")[0] == [('{"title":"Example","list":["a","b"]}', False)]
    assert split_yaml("on: yes\n2: 012\nt: 12:30:00")[0] == [('{"true":true,"2":10,"t":45000}', False)]
    assert split_yaml("a: &x {k: 1}\nb: *x")[0] == [('{"a":{"k":1},"b":{"k":1}}', False)]
