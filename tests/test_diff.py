"""Diff: last-wins index, added/removed/changed, params deep compare, first deploy."""
import json

from regloom.operators import diff as D

SCHEMA = "rule_ord bigint, rule_id string, payer_type string, code string, source_key string, params_json string"


def rules(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_added_removed_changed(spark):
    live = rules(spark, [
        (0, "R-A", "Medicare", "G2067", "s1", json.dumps({"window_days": 7, "codes": ["G2067", "G2068"]})),
        (1, "R-B", "Medicare", "G0137", "s1", None),
        (2, "R-C", "X", "H0020", "s1", json.dumps({"n": 1})),
    ])
    cand = rules(spark, [
        (0, "R-A", "Medicare", "G2067", "other-source", json.dumps({"codes": ["G2068", "G2067", "G2067"], "window_days": 7})),
        (1, "R-C", "X", "H0020", "s1", json.dumps({"n": "1", "m": 2})),
        (2, "R-D", "Y", "99213", "s1", None),
    ])
    ch = D.diff_rules(live, cand, ["payer_type", "code"], params_col="params_json")
    got = sorted((r.rule_id, r.change_type, r.path) for r in ch.collect())
    assert got == [
        ("R-B", "rule_removed", "root"),
        ("R-C", "dictionary_item_added", "root['params']['m']"),
        ("R-C", "type_changes", "root['params']['n']"),
        ("R-D", "rule_added", "root"),
    ]
    s = D.summary(ch).first()
    assert (s.added_count, s.removed_count, s.changed_count, s.is_material) == (1, 1, 1, True)


def test_last_duplicate_wins(spark):
    live = rules(spark, [(0, "R-A", "P", "old", "s", None), (1, "R-A", "P", "new", "s", None)])
    cand = rules(spark, [(0, "R-A", "P", "new", "s", None)])
    assert D.diff_rules(live, cand, ["payer_type", "code"]).count() == 0


def test_params_absent_vs_present_and_null_fields(spark):
    live = rules(spark, [(0, "R-A", "P", None, "s", None)])
    cand = rules(spark, [(0, "R-A", "P", "G1", "s", json.dumps({"a": 1}))])
    got = sorted((r.change_type, r.path) for r in D.diff_rules(live, cand, ["payer_type", "code"], params_col="params_json").collect())
    assert got == [("dictionary_item_added", "root['params']"), ("type_changes", "root['code']")]


def test_nested_object_key_order_ignored(spark):
    live = rules(spark, [(0, "R-A", "P", "c", "s", '{"cap":{"0-14":7,"15-31":14}}')])
    cand = rules(spark, [(0, "R-A", "P", "c", "s", '{"cap":{"15-31":14,"0-14":7}}')])
    assert D.diff_rules(live, cand, ["payer_type"], params_col="params_json").count() == 0


def nested(depth, leaf):
    return json.dumps(leaf) if depth == 0 else '{"k%d":%s}' % (depth, nested(depth - 1, leaf))


def test_changes_at_any_depth(spark):
    cases = {
        "leaf": (nested(8, 1), nested(8, 2), [("values_changed", 8, "1", "2")]),
        "type": (nested(8, 1), nested(8, "1"), [("type_changes", 8, "1", '"1"')]),
        "none": (nested(8, None), nested(8, False), [("type_changes", 8, "null", "false")]),
        "order": (nested(8, [1, [2, [3, [4, [5, [6, {"x": [7, 8]}]]]]]]), nested(8, [[[[[[{"x": [8, 7, 8]}, 6], 5], 4], 3], 2], 1]), []),
        "deep list": (nested(8, [1, [2, [3, [4, [5, [6, 7]]]]]]), nested(8, [1, [2, [3, [4, [5, [6, 8]]]]]]), [("values_changed", 8, "[1,[2,[3,[4,[5,[6,7]]]]]]", "[1,[2,[3,[4,[5,[6,8]]]]]]")]),
        "numbers": (nested(8, 1.50), nested(8, 1.5), []),
        "far down": (nested(300, "a"), nested(300, "b"), [("values_changed", 300, '"a"', '"b"')]),
    }
    live = rules(spark, [(0, k, "P", "c", "s", old) for k, (old, _, _) in cases.items()])
    cand = rules(spark, [(0, k, "P", "c", "s", new) for k, (_, new, _) in cases.items()])
    got = {}
    for r in D.diff_rules(live, cand, ["payer_type"], params_col="params_json").collect():
        got.setdefault(r.rule_id, []).append((r.change_type, r.path.count("['k"), r.old_value, r.new_value))
    assert got == {k: want for k, (_, _, want) in cases.items() if want}


def test_keys_at_depth_and_texts_that_are_no_json(spark):
    live = rules(spark, [(0, "A", "P", "c", "s", '{"a":{"b":{"gone":1,"same":[1]},"x":{}}}'), (1, "B", "P", "c", "s", "{no json"), (2, "C", "P", "c", "s", "{no json")])
    cand = rules(spark, [(0, "A", "P", "c", "s", '{"a":{"x":{"new":{"z":0,"y":[]}},"b":{"same":[1,1]}}}'), (1, "B", "P", "c", "s", "{}"), (2, "C", "P", "c", "s", "{no json")])
    got = sorted((r.rule_id, r.change_type, r.path, r.old_value, r.new_value) for r in D.diff_rules(live, cand, ["payer_type"], params_col="params_json").collect())
    assert got == [
        ("A", "dictionary_item_added", "root['params']['a']['x']['new']", None, '{"y":[],"z":0}'),
        ("A", "dictionary_item_removed", "root['params']['a']['b']['gone']", "1", None),
        ("B", "values_changed", "root['params']", "{no json", "{}"),
    ]


def test_no_change_is_not_material(spark):
    r = rules(spark, [(0, "R-A", "P", "c", "s", None)])
    assert D.summary(D.diff_rules(r, r, ["payer_type", "code"])).first().is_material is False


def test_first_deploy_keeps_order_and_duplicates(spark):
    cand = rules(spark, [(0, "R-A", "P", "c", "s", None), (1, "R-A", "P", "c", "s", None), (2, "R-B", "P", "c", "s", None)])
    ch = D.first_deploy(cand)
    assert [r.rule_id for r in ch.orderBy("rule_ord").collect()] == ["R-A", "R-A", "R-B"]
    assert D.summary(ch.drop("rule_ord"), first_deploy=True).first().is_material is True
    empty = cand.limit(0)
    assert D.summary(D.first_deploy(empty).drop("rule_ord"), first_deploy=True).first().is_material is True
