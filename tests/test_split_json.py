import json
import random

import pytest

from trackloom.sources import manifests
from trackloom.sources.split_json import Document, Structure, backslashes_before

NASTY = ['"', "\\", '\\"', "\\\\", "]", "[", "{", "}", ",", "},{", '","', "ü", "日本", "\n", "tracks", '"tracks":[', " "]


def element(r, depth=0):
    kind = r.randrange(7 if depth < 3 else 4)
    if kind < 2:
        return "".join(r.choice(NASTY) for _ in range(r.randrange(12)))
    if kind < 4:
        return r.choice([None, True, 1.5, -3, 10**12])
    if kind < 6:
        return {f"{k}" + r.choice(NASTY): element(r, depth + 1) for k in range(r.randrange(4))}
    return [element(r, depth + 1) for _ in range(r.randrange(4))]


def test_structure_agrees_with_a_plain_scan():
    r = random.Random(1)
    for _ in range(200):
        data = json.dumps([element(r) for _ in range(6)], ensure_ascii=r.random() < 0.5).encode()
        inside, escaped, depth, want = False, False, 0, []
        for byte in data:
            c = chr(byte)
            if inside:
                inside, escaped = (inside if escaped or c != '"' else False), (c == "\\" and not escaped)
            elif c == '"':
                inside = True
            else:
                depth += (c in "[{") - (c in "]}")
            want.append(depth)
        cut = r.randrange(len(data))
        first = Structure(data[:cut], 0, False)
        run = len(data[:cut]) - len(data[:cut].rstrip(b"\\"))
        second = Structure(data[cut:], run, bool(first.parity), first.total())
        assert [*first.after.tolist(), *second.after.tolist()] == want


@pytest.mark.parametrize("split", [11, 64, 1000, 10**6])
def test_elements_of_an_array(spark, tmp_path, split):
    r = random.Random(split)
    rows = [element(r) for _ in range(25)]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(rows, indent=r.choice([None, 3]), ensure_ascii=False))
    got = Document(spark, str(path), split).elements().orderBy("place").collect()
    assert [json.loads(g.text) for g in got] == rows


@pytest.mark.parametrize("split", [37, 500])
def test_a_split_manifest_has_the_same_entries(spark, tmp_path, split):
    r = random.Random(7)
    tracks = [{"path": f"A/{i} {r.choice(NASTY)}.mp3", "tags": element(r), "x": element(r)} for i in range(30)]
    document = {"note": [1, [2], {"tracks": [3]}], "globals": {"model_id": "m\\", "tags": {"tracks": "[,"}}, "tracks": tracks, 'x"tracks': [4]}
    path = tmp_path / "m.json"
    path.write_text(json.dumps(document, indent=2, ensure_ascii=False))
    whole, settings = manifests.read_manifest_entries(spark, str(path))
    parts, same = manifests.read_manifest_entries(spark, str(path), split)
    assert same == settings
    read = lambda df: [(e.path, e.entry) for e in df.orderBy("place").collect()]
    assert read(parts) == read(whole) and len(read(parts)) == 30
    assert parts.rdd.getNumPartitions() >= path.stat().st_size // split


def test_small_and_broken_documents(spark, tmp_path):
    path = tmp_path / "d.json"
    for text, want in (("[]", []), ("[ ]", []), ("[1]", ["1"]), ('{"tracks": []}', []), ('{"tracks": [ {} , 2 ]}', ["{}", "2"]), ("{}", [])):
        path.write_text(text)
        document = Document(spark, str(path), 3)
        assert [g.text for g in document.elements("tracks" if text[0] == "{" else "").orderBy("place").collect()] == want
    for text in ('{"tracks": [1, 2}', '["open', '{"a": [1]'):
        path.write_text(text)
        with pytest.raises(ValueError, match="not a whole JSON document"):
            Document(spark, str(path), 4)
    path.write_bytes(b"a" + b"\\" * 1000 + b'"')
    assert backslashes_before(str(path), 1001) == 1000 and backslashes_before(str(path), 1) == 0 and backslashes_before(str(path), 500) == 499
