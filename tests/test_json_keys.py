"""Profiles of JSON whose keys are not known."""

import json

from trackloom.operators.json_keys import json_key_profile

RECORDS = [
    '{"file": "a.wav", "tags": {"bpm": 120, "key": null}, "parts": [1, "two", [3], {"x": true}]}',
    '{"file": 7, "tags": ["rock", "pop"], "parts": []}',
    '{"file": null, "extra": 1.5, "a.b": false}',
    '["top", {"file": "inside"}]', '"only text"', "12", "null", "{}", "not json", '{"cut": ', "", None, '{"twice": 1, "twice": 2}',
    '{"é": "日本", "deep": {"deeper": {"deepest": 1}}}',
]


def kind(v):
    for t, name in ((bool, "boolean"), (str, "string"), (dict, "object"), (list, "array"), ((int, float), "number")):
        if isinstance(v, t):
            return name
    return "null"


def walk(v, path, levels, out):
    row = out.setdefault(path, {"values": 0})
    row["values"] += 1
    row[kind(v)] = row.get(kind(v), 0) + 1
    if isinstance(v, (str, dict, list)):
        row["lo"] = min(row.get("lo", len(v)), len(v))
        row["hi"] = max(row.get("hi", len(v)), len(v))
    if levels:
        for k, x in v.items() if isinstance(v, dict) else [("[]", x) for x in v] if isinstance(v, list) else ():
            walk(x, f"{path}[]" if k == "[]" else f"{path}.{k}" if path else k, levels - 1, out)


def brute(records, levels):
    out = {}
    for text in records:
        try:
            pairs = json.loads(text, object_pairs_hook=lambda p: dict(p) if len(dict(p)) == len(p) else 1 / 0) if text is not None else None
        except (ValueError, ZeroDivisionError):
            row = out.setdefault("", {"values": 0})
            row["values"] += 1
            row["invalid"] = row.get("invalid", 0) + 1
            continue
        if text is None:
            row = out.setdefault("", {"values": 0})
            row["values"] += 1
            row["missing"] = row.get("missing", 0) + 1
        else:
            walk(pairs, "", levels, out)
    return out


def test_profile_against_a_walk(spark):
    texts = spark.createDataFrame([(t,) for t in RECORDS * 3], "doc string").repartition(4)
    for levels in (0, 1, 2, 3):
        want = brute(RECORDS * 3, levels)
        got = {r.path: r.asDict() for r in json_key_profile(texts, "doc", levels).collect()}
        assert got.keys() == want.keys()
        for path, row in want.items():
            g = got[path]
            assert g["values"] == row["values"], path
            for k in ("object", "array", "string", "number", "boolean", "null", "invalid", "missing"):
                assert g[f"n_{k}"] == row.get(k, 0), (path, k)
            assert (g["min_length"], g["max_length"]) == (row.get("lo"), row.get("hi")), path


def test_no_records(spark):
    assert json_key_profile(spark.createDataFrame([], "doc string"), "doc").count() == 0


def test_one_exchange_and_no_python(spark):
    from conftest import plan_of

    plan = plan_of(json_key_profile(spark.createDataFrame([(t,) for t in RECORDS], "doc string"), "doc"))
    assert plan.count("+- Exchange") == 1 and plan.count("Generate") <= 2 and "Union" not in plan and "EvalPython" not in plan
