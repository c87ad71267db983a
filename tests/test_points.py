import json

from fadeclust.functions import (PALETTE, label_color, label_points, parse_labelled,
                                 parse_points, points_to_json, rejected_points,
                                 valid_points)

# the bad-record fixture (FIXTURES.md)
LINES = [('{"x":1,"y":2.5}', "valid"), ("junk", "rejected"), ('{"x":1}', "rejected"),
         ('{"x":"1.5","y":2}', "rejected"), ('{"x":"NaN","y":2,"z":9}', "valid"),
         (None, "rejected")]


def test_parse_and_split(spark):
    df = spark.createDataFrame([(i, l) for i, (l, _) in enumerate(LINES)], "id int, value string")
    parsed = parse_points(df, "value")
    good = {r.id: r for r in valid_points(parsed).collect()}
    bad = {r.id: r.reason for r in rejected_points(parsed, "value").collect()}
    assert sorted(good) == [0, 4]
    assert good[0].x == 1.0 and good[0].y == 2.5
    assert good[4].x != good[4].x            # NaN kept; handleInvalid decides
    assert bad == {1: "no_point", 2: "bad_field", 3: "bad_field", 5: "null_line"}


def test_labelled_json_format_and_roundtrip(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.5, 2.5, 0)],
                               "x double, y double, cx double, cy double, prediction int")
    line = df.select(points_to_json(label_points()).alias("value")).first().value
    assert line == '{"point":{"x":1.0,"y":2.0},"center":{"x":1.5,"y":2.5},"label":0}'
    assert json.loads(line)["center"]["y"] == 2.5
    back = parse_labelled(df.sparkSession.createDataFrame([(line,)], "value string")).first()
    assert back.point.x == 1.0 and back.center.x == 1.5 and back.label == 0


def test_label_color(spark):
    df = spark.createDataFrame([(0,), (2,), (3,)], "label int")
    out = [r.c for r in df.select(label_color("label").alias("c")).collect()]
    assert out == [PALETTE[0], PALETTE[2], None]
