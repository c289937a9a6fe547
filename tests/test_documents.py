"""JSON documents cut into elements by many tasks, against the json module."""

import json
import random

import pytest

from sitewarden.sources.documents import json_elements
from sitewarden.sources.hazards import read_quakes


def odd_text(rng):
    return "".join(rng.choices(['"', "\\", "{", "}", "[", "]", "a", "\n", "é", "日", ",", ":", "\\u", "😀"], k=rng.randint(0, 12)))


def odd_object(rng, depth=0):
    out = {}
    for i in range(rng.randint(0, 4)):
        kind = rng.randint(0, 4)
        out[f"k{i}{odd_text(rng)}"] = odd_text(rng) if kind < 2 or depth > 2 else odd_object(rng, depth + 1) if kind == 2 else [odd_object(rng, depth + 1), odd_text(rng)] if kind == 3 else rng.random()
    return out


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_elements_of_lists_and_collections(small_splits, tmp_path, indent, ascii_only):
    rng = random.Random(8)
    listed = [[odd_object(rng) for _ in range(rng.randint(0, 40))] for _ in range(4)]
    listed[0].append({"long": "x}{" * 500})  # longer than several splits
    for i, objects in enumerate(listed):
        (tmp_path / f"list{i}.json").write_text(json.dumps(objects, indent=indent, ensure_ascii=ascii_only))
    found = json_elements(small_splits, [str(tmp_path / f"list{i}.json") for i in range(4)], level=1)
    assert found.rdd.getNumPartitions() > 4
    expected = [json.dumps(o, sort_keys=True) for objects in listed for o in objects]
    assert sorted(json.dumps(json.loads(r.text), sort_keys=True) for r in found.collect()) == sorted(expected)
    inside = {"type": "FeatureCollection", "note": odd_text(rng), "features": listed[1], "end": "]}"}
    (tmp_path / "collection.json").write_text(json.dumps(inside, indent=indent, ensure_ascii=ascii_only))
    rows = json_elements(small_splits, str(tmp_path / "collection.json"), level=2).collect()
    assert sorted(json.dumps(json.loads(r.text), sort_keys=True) for r in rows) == sorted(json.dumps(o, sort_keys=True) for o in listed[1])


def test_empty_and_open_documents(small_splits, tmp_path):
    for name, text in (("a", ""), ("b", "[]"), ("c", "[ {} ]"), ("d", '[{"a": 1}, {"b": ')):
        (tmp_path / f"{name}.json").write_text(text)
    texts = sorted(r.text for r in json_elements(small_splits, str(tmp_path), level=1).collect() if r.text.endswith("}") and _parses(r.text))
    assert texts == ['{"a": 1}', "{}"]


def _parses(text):
    try:
        return isinstance(json.loads(text), dict)
    except ValueError:
        return False


def test_a_quake_collection_is_read_by_many_tasks(small_splits, tmp_path):
    features = [
        {"type": "Feature", "id": f"us{i}", "properties": {"mag": 3 + i / 100, "time": 1_700_000_000_000 + i, "place": f"{i} km \"off\" }}"}, "geometry": {"type": "Point", "coordinates": [i / 10, 1.0, 5.0]}}
        for i in range(200)
    ]
    (tmp_path / "q.json").write_text(json.dumps({"type": "FeatureCollection", "metadata": {"count": 200}, "features": features, "bbox": [[0, 1], [2, 3]]}))
    quakes = read_quakes(small_splits, str(tmp_path / "q.json"))
    rows = {r.usgs_id: r for r in quakes.collect()}
    assert len(rows) == 200 and rows["us7"].place_desc == '7 km "off" }' and rows["us7"].lon == 0.7
