"""Tag rules, enumerations and typed columns of the mapping: plain data, read by the routing operator."""

from __future__ import annotations


ANY = None  # "__any__": every value of the key matches

# ------------------------------------------------------------------ FIXED VALUES
# table: (geometry type, [(submapping, key, [values])...]) in mapping order.
FEATURE_TABLES: dict[str, tuple[str, list[tuple[str, str, list | None]]]] = {
    "poi_points": ("point", [
        ("", "natural", ["peak"]),
        ("", "highway", ["bus_stop"]),
        ("", "amenity", ["pub", "fast_food", "restaurant", "bar", "biergarten", "hospital", "parking", "shelter",
                         "place_of_worship"]),
        ("", "tourism", ["alpine_hut", "hotel", "viewpoint", "information", "zoo", "aquarium", "attraction",
                         "theme_park", "camp_site", "caravan_site"]),
        ("", "leisure", ["playground", "water_park"]),
        ("", "sport", ["climbing"]),
        ("", "geological", ["palaeontological_site"]),
        ("", "shop", ["bicycle", "supermarket"]),
        ("", "railway", ["station", "halt", "tram_stop"]),
        ("", "man_made", ["mast", "tower", "communications_tower", "antenna"]),
    ]),
    "label_points": ("point", [("", "place", ["city", "town", "village", "hamlet", "suburb"])]),
    "housenumbers_temp": ("point", [("", "entrance", ANY)]),
    "buildings_temp": ("polygon", [("", "building", ANY)]),
    "roads_temp": ("linestring", [
        ("", "highway", ["motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary",
                         "secondary_link", "tertiary", "tertiary_link", "road", "unclassified", "residential",
                         "pedestrian", "living_street", "service", "track", "path", "footway", "steps", "bridleway",
                         "cycleway"]),
        ("", "bicycle", ["designated"]),
    ]),
    "waterarea": ("polygon", [
        ("", "natural", ["water", "pond"]),
        ("", "landuse", ["reservoir", "basin"]),
        ("", "waterway", ["riverbank", "pond"]),
        ("", "amenity", ["swimming_pool"]),
        ("", "leisure", ["swimming_pool"]),
    ]),
    "waterway": ("linestring", [("", "waterway", ["river", "canal", "stream", "ditch"])]),
    "landuse_import": ("polygon", [
        ("landuse", "landuse", ["residential", "commercial", "retail", "industrial"]),
        ("landuse", "aeroway", ["aerodrome"]),
        ("military", "landuse", ["military"]),
        ("military", "military", ["danger_area"]),
        ("leisure", "leisure", ["nature_reserve"]),
    ]),
    "landcover_import": ("polygon", [
        ("landuse", "landuse", ["forest", "recreation_ground", "grass", "cemetery"]),
        ("landuse", "leisure", ["park", "playground", "pitch", "golf_course"]),
        ("landuse", "natural", ["wood", "scrub", "beach", "wetland", "glacier", "heath"]),
    ]),
    "transportation": ("linestring", [
        ("", "route", ["ferry"]),
        ("", "aerialway", ["cable_car", "chairlift", "gondola", "chair_lift", "mixed_lift", "goods", "drag_lift"]),
        ("", "railway", ["funicular"]),
        ("", "attraction", ["summer_toboggan"]),
    ]),
    "manmade_points": ("point", [("", "power", ["tower", "station", "sub_station"])]),
    "manmade_lines": ("linestring", [
        ("", "waterway", ["weir"]),
        ("", "man_made", ["pier"]),
        ("", "barrier", ["fence"]),
        ("", "aeroway", ["taxiway", "runway"]),
        ("", "power", ["line", "minor_line"]),
    ]),
    "manmade_polygons": ("polygon", [("", "man_made", ["pier"])]),
    "piste": ("linestring", [("", "piste:type", ["downhill"])]),
    "cycleroute": ("relation_member", [("", "route", ["bicycle"])]),
    "admin": ("linestring", [("", "boundary", ["administrative"])]),
    "railway": ("linestring", [
        ("", "railway", ["rail", "light_rail", "miniature", "monorail", "narrow_gauge", "preserved", "subway",
                         "tram"]),
    ]),
}
# poi_polygon / label_polygon use the same rules as their point twins.
FEATURE_TABLES["poi_polygon"] = ("polygon", FEATURE_TABLES["poi_points"][1])
FEATURE_TABLES["label_polygon"] = ("polygon", FEATURE_TABLES["label_points"][1])

# Enumerations: 1-based position in the list, 0 for anything else.
ENUMS: dict[str, list[str]] = {
    "rank": ["motorway", "trunk", "primary", "secondary", "tertiary", "motorway_link", "trunk_link", "primary_link",
             "secondary_link", "tertiary_link", "road", "unclassified", "residential", "pedestrian", "living_street",
             "cycleway", "track", "path", "service", "footway", "steps", "bridleway"],
    "tracktype": ["grade1", "grade2", "grade3", "grade4", "grade5"],
    "service": ["parking_aisle", "driveway"],
    "bicycle": ["no", "yes", "designated"],
    "access": ["private"],
    "parking": ["multi-storey", "underground"],
    "subway": ["yes"],
    "religion": ["christian"],
    "difficulty": ["novice", "easy", "intermediate", "advanced", "expert", "freeride", "extreme"],
    "usage": ["main", "branch", "tourism"],
}

# Values the bool column type reads as true.
TRUE_WORDS = ["yes", "true", "1"]

# roads_temp rejects elements whose mtb:scale matches this pattern.
MTB_SCALE_REJECT = r"^\D+.*$"

# Minimal variant mapping (second rule set, same operator).
MINIMAL_TABLES: dict[str, tuple[str, list[tuple[str, str, list | None]]]] = {
    "roads": ("linestring", [("", "highway", ANY)]),
    "buildings": ("polygon", [("", "building", ANY)]),
    "admin": ("polygon", [("", "boundary", ["administrative"])]),
    "amenities": ("point", [("", "amenity", ANY)]),
}
# ------------------------------------------------------------------ end of fixed values

# ------------------------------------------------------------------ FIXED VALUES (column extractors)
# (column, type, tag key). Types: string, integer, bool, enumerate (enum name in ENUMS).
NAME_COLUMNS = [("name_de", "string", "name:de"), ("name_en", "string", "name:en"), ("name", "string", "name")]
TABLE_COLUMNS: dict[str, list[tuple[str, str, str]]] = {
    "poi_points": NAME_COLUMNS + [
        ("ele", "integer", "ele"), ("fee", "string", "fee"), ("access", "enumerate:access", "access"),
        ("parking", "enumerate:parking", "parking"), ("subway", "enumerate:subway", "subway"),
        ("religion", "enumerate:religion", "religion"),
    ],
    "label_points": NAME_COLUMNS + [("ele", "integer", "ele"), ("pop", "integer", "population")],
    "housenumbers_temp": [("number", "string", "addr:housenumber")] + NAME_COLUMNS,
    "buildings_temp": [("number", "string", "addr:housenumber")] + NAME_COLUMNS,
    "roads_temp": NAME_COLUMNS + [
        ("ref", "string", "ref"), ("oneway", "bool", "oneway"), ("tracktype", "enumerate:tracktype", "tracktype"),
        ("service", "enumerate:service", "service"), ("bicycle", "enumerate:bicycle", "bicycle"),
        ("scale", "integer", "mtb:scale"), ("tunnel", "bool", "tunnel"), ("bridge", "bool", "bridge"),
        ("layer", "integer", "layer"), ("rank", "enumerate:rank", "highway"),
    ],
    "waterarea": [("area", "area", "")] + NAME_COLUMNS + [("ele", "integer", "ele")],
    "waterway": [("tunnel", "bool", "tunnel"), ("layer", "integer", "layer")] + NAME_COLUMNS,
    "landuse_import": [("area", "area", "")] + NAME_COLUMNS,
    "landcover_import": [("area", "area", ""), ("surface", "string", "surface")] + NAME_COLUMNS,
    "transportation": NAME_COLUMNS,
    "manmade_points": [],
    "manmade_lines": [],
    "manmade_polygons": [],
    "piste": [("ref", "string", "ref"), ("difficulty", "enumerate:difficulty", "piste:difficulty")],
    "cycleroute": [("ref", "string", "ref"), ("name", "string", "name")],
    "admin": [("ref", "string", "ref"), ("level", "integer", "admin_level")],
    "railway": [("zorder", "wayzorder", ""), ("tunnel", "bool", "tunnel"), ("bridge", "bool", "bridge"),
                ("service", "string", "service"), ("usage", "enumerate:usage", "usage"),
                ("attraction", "string", "attraction"), ("layer", "integer", "layer")],
}
TABLE_COLUMNS["poi_polygon"] = TABLE_COLUMNS["poi_points"]
TABLE_COLUMNS["label_polygon"] = TABLE_COLUMNS["label_points"]
# Tables with a reject filter: tag key -> regex.
REJECT_REGEXP = {"roads_temp": {"mtb:scale": MTB_SCALE_REJECT}}


# ------------------------------------------------------------------ FIXED VALUES (wayzorder) [ext]
# The mapping only names the column type; the score follows the importer's
# documented behaviour: a rank per highway class, a bonus for railways, ten
# per layer, plus ten on bridges, minus ten in tunnels.
WAYZORDER_HIGHWAY_RANK = {
    "minor": 3, "road": 3, "unclassified": 3, "residential": 3, "tertiary_link": 3, "tertiary": 4,
    "secondary_link": 3, "secondary": 5, "primary_link": 3, "primary": 6, "trunk_link": 3, "trunk": 8,
    "motorway_link": 3, "motorway": 9,
}
WAYZORDER_RAILWAY = 7
