import json

from gridloom.sources.geojson import read_geojson
from gridloom.sources.layers_dir import load_geojson_layers

SHAPES = {
    "Point": [1, 2], "MultiPoint": [[1, 2], [3, 4]], "LineString": [[1, 2], [3, 4, 9]], "MultiLineString": [[[1, 2], [3, 4]], [[5, 6], [7, 8]]],
    "Polygon": [[[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]], "MultiPolygon": [[[[0, 0], [4, 0], [4, 4], [0, 0]]], [[[9, 9], [9, 8], [8, 8], [9, 9]]]]}
WANT = {
    "Point": [[[(1, 2)]]], "MultiPoint": [[[(1, 2)]], [[(3, 4)]]], "LineString": [[[(1, 2), (3, 4)]]], "MultiLineString": [[[(1, 2), (3, 4)]], [[(5, 6), (7, 8)]]],
    "Polygon": [[[(0, 0), (4, 0), (4, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]]], "MultiPolygon": [[[(0, 0), (4, 0), (4, 4), (0, 0)]], [[(9, 9), (9, 8), (8, 8), (9, 9)]]]}


def shapes(df):
    return {r.geom["type"]: [[[tuple(v) for v in ring] for ring in part] for part in r.geom["parts"]] for r in df.collect()}


def test_every_type_in_lines_collections_and_whole_files(spark, tmp_path):
    features = [{"type": "Feature", "geometry": {"type": k, "coordinates": v}, "properties": {"n": 1, "name": k}} for k, v in SHAPES.items()]
    none = {"type": "Feature", "geometry": None, "properties": {}}
    whole = {"type": "FeatureCollection", "features": [*features, none]}
    for name, text, multi in (("a", "\n".join(map(json.dumps, [*features, none])), False), ("b", json.dumps(whole), False), ("c", json.dumps(whole, indent=2), True)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.geojson").write_text(text)
        df = read_geojson(spark, str(tmp_path / name), multi)
        assert df.count() == 6 and shapes(df) == WANT
        assert {r.properties["name"] for r in df.collect()} == set(SHAPES)


def test_layer_folders_keep_lines(spark, tmp_path):
    for layer, kind, at in (("p", "Point", [10, 89]), ("q", "Point", [10, 20]), ("l", "LineString", [[0, 0], [10, 89]])):
        (tmp_path / layer).mkdir()
        (tmp_path / layer / "x.json").write_text(json.dumps({"type": "Feature", "geometry": {"type": kind, "coordinates": at}, "properties": {}}))
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "x.json").write_text("")
    got = {r.layer: r for r in load_geojson_layers(spark, str(tmp_path)).collect()}
    assert set(got) == {"q", "l"} and got["l"].x is None and len(got["l"].geom.parts[0][0]) == 2
    assert abs(got["q"].x - 1113194.9079) < 0.001 and got["l"].geom.parts[0][0][1].y < 20_100_000
