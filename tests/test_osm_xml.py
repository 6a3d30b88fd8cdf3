from gridloom.operators.mapping import match_rules
from gridloom.sources.osm import read_osm, tagged_elements, way_geometries

XML = """<?xml version="1.0"?>
<osm version="0.6">
 <node id="7" lat="1.0" lon="2.0"><tag k="highway" v="bus_stop"/><tag k="name" v="stop"/></node>
 <node id="1" lat="0.0" lon="0.0"/><node id="2" lat="0.0" lon="1.0"/><node id="3" lat="1.0" lon="1.0"/>
 <way id="7"><nd ref="1"/><nd ref="2"/><nd ref="99"/><nd ref="3"/><tag k="highway" v="primary"/></way>
 <way id="8"><nd ref="1"/><nd ref="2"/><nd ref="3"/><nd ref="1"/><tag k="building" v="yes"/></way>
 <way id="9"><nd ref="1"/><nd ref="2"/><nd ref="3"/><nd ref="1"/><tag k="highway" v="track"/><tag k="area" v="no"/></way>
 <relation id="5"><member type="way" ref="7" role=""/><member type="node" ref="7" role="x"/><tag k="type" v="route"/><tag k="route" v="bicycle"/></relation>
</osm>"""


def test_plain_file(spark, tmp_path):
    (tmp_path / "x.osm").write_text(XML)
    nodes, ways, relations = read_osm(spark, str(tmp_path / "x.osm"))
    assert (nodes.count(), ways.count(), relations.count()) == (4, 3, 1)
    geoms = {r.fid: (r.geom["type"], r.nv) for r in way_geometries(nodes, ways).collect()}
    assert geoms == {7: ("LineString", 3), 8: ("Polygon", 4), 9: ("Polygon", 4)}
    kinds = sorted((r.id, r.geom_type) for r in tagged_elements(nodes, ways, relations).collect())
    assert kinds == [(7, "linestring"), (7, "point"), (7, "relation_member"), (8, "linestring"), (8, "polygon"), (9, "linestring")]
    hits = sorted((r.table, r.id, r.subclass) for r in match_rules(tagged_elements(nodes, ways, relations)).collect())
    # the node and the way share an id: only the way is a road
    assert [h for h in hits if h[0] == "roads_temp"] == [("roads_temp", 7, "primary"), ("roads_temp", 9, "track")]
    assert ("buildings_temp", 8, "yes") in hits and ("cycleroute", 7, "bicycle") in hits
