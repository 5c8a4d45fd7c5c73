"""Placemarks by the XML source: several parts, inner rings, parts by state, and what must fail."""

import pytest

from tallygrid.sources import readers

SQUARE = "{x},{y},0 {x1},{y},0 {x1},{y1},0 {x},{y1},0 {x},{y},0"


def square(x, y, side=1.0):
    return SQUARE.format(x=x, y=y, x1=x + side, y1=y + side)


def polygon(*rings):
    side = lambda tag, r: f"<{tag}><LinearRing><coordinates>\n {r}\n </coordinates></LinearRing></{tag}>"
    return "<Polygon><extrude>0</extrude>" + side("outerBoundaryIs", rings[0]) + "".join(side("innerBoundaryIs", r) for r in rings[1:]) + "</Polygon>"


def mark(state, county, shape, gone=(), geoid=None):
    data = {"STATEFP": state, "COUNTYFP": county, "GEOID": geoid or state + county, "NAME": f"N&amp;{county}", "NAMELSAD": "x County", "STUSPS": "CA", "STATE_NAME": "C"}
    fields = "".join(f'<SimpleData name="{k}">{v}</SimpleData>' for k, v in data.items() if k not in gone)
    return f'<Placemark id="p"><name>{state}{county}</name><ExtendedData><SchemaData schemaUrl="#s">{fields}</SchemaData></ExtendedData>{shape}</Placemark>'


def write(path, *marks):
    path.write_text('<?xml version="1.0" encoding="utf-8" ?>\n<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Folder>' + "\n".join(marks) + "</Folder></Document></kml>")
    return str(path)


def test_counties_in_parts_by_state(spark, tmp_path):
    one, two = polygon(square(-120.1234567, 38.0), square(-120.0, 38.25, 0.5)), f"<MultiGeometry>{polygon(square(1, 2))}{polygon(square(5, 6))}</MultiGeometry>"
    path = write(tmp_path / "c.kml", mark("06", "003", one), mark("06", "001", two), mark("32", "510", polygon(square(3, 4))))
    rows = {r.geoid: r for r in readers.county_boundaries(spark, path).collect()}
    assert sorted(rows) == ["06001", "06003", "32510"]
    assert (rows["06003"].kind, rows["06003"].points, rows["06003"].name, len(rows["06003"].polygons[0])) == ("Polygon", 10, "N&003", 2)
    assert rows["06003"].polygons[0][0][0] == [-120.123457, 38.0] and (rows["06001"].kind, len(rows["06001"].polygons)) == ("MultiPolygon", 2)
    assert [r.geoid for r in readers.county_boundaries(spark, path, ("32",)).collect()] == ["32510"]
    told = readers.write_county_shards(readers.county_boundaries(spark, path), str(tmp_path / "out")).orderBy("state_fips").collect()
    assert [tuple(r) for r in told] == [("06", 2, 1, 1, 20), ("32", 1, 1, 0, 5)]
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["state_fips=06", "state_fips=32"]
    with pytest.raises(ValueError, match="not what"):
        readers.write_county_shards(readers.county_boundaries(spark, write(tmp_path / "d.kml", mark("06", "003", one), mark("06", "003", one))), str(tmp_path / "twice"))


@pytest.mark.parametrize(
    "bad, message",
    [
        (mark("06", "001", polygon(square(1, 2)), gone=["NAMELSAD"]), "missing fields: NAMELSAD"), (mark("06", "001", polygon(square(1, 2)), geoid="06002"), "geoid"), (mark("06", "001", ""), "no polygon"),
        (mark("06", "001", polygon("0,0 1,0 1,1 0,1")), "not closed"), (mark("06", "001", polygon("0,0 1,0 2,0 0,0")), "no area"), (mark("06", "001", polygon("0,0 1,x 1,1 0,0")), "not valid"),
        (mark("06", "001", polygon(square(180, 2))), "not valid"),
    ],
)
def test_bad_placemarks_fail(spark, tmp_path, bad, message):
    with pytest.raises(Exception, match=message):
        readers.county_boundaries(spark, write(tmp_path / "c.kml", bad)).collect()


def test_all_states(spark, tmp_path):
    codes = [f"{i:02d}" for i in range(1, 57) if i not in (3, 7, 14, 43, 52)]
    marks = [mark(c, "001", polygon(square(i / 10, i / 10))) for i, c in enumerate([*codes, "72"])]
    assert readers.state_boundaries(spark, write(tmp_path / "s.kml", *marks)).count() == 51
    with pytest.raises(ValueError, match="50 boundaries"):
        readers.state_boundaries(spark, write(tmp_path / "t.kml", *marks[1:]))
