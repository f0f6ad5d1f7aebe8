"""JSON values of any layout: the automaton against a walk over characters, and ranges against whole files."""

import gzip
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.sources import json_values as jv, landing as land


def walk(text, depth=0):
    """Depth after each character by the plain rules: quotes end with their line, depth stops at 0."""
    out, quoted, escaped = [], False, False
    for c in text:
        if c == "\n":
            quoted = escaped = False
        elif quoted:
            quoted, escaped = escaped or c != '"', c == "\\" and not escaped
        elif c == '"':
            quoted = True
        elif c in "{[":
            depth += 1
        elif c in "]}":
            depth = max(0, depth - 1)
        out.append((depth, not quoted and c in "]}"))
    return out


def plain_values(text):
    """Lines are grouped where no later depth is lower; groups are cut where they are back at their start."""
    text = text if text.endswith("\n") else text + "\n"
    seen = [d for d, _ in walk(text)]
    groups, start = [], 0
    for i, c in enumerate(text):
        if c == "\n" and seen[i] <= min(seen[i:]):
            groups.append(text[start:i])
            start = i + 1
    assert start == len(text)
    out = []
    for group in groups:
        piece = ""
        for c, (d, closes) in zip(group, walk(group)):
            piece += c
            if closes and d == 0:
                out.append(piece)
                piece = ""
        out.append(piece)
    return [v.strip() for v in out if v.strip()]


def value(rng, deep=0):
    kind = rng.randrange(6 if deep < 3 else 3)
    if kind == 0:
        return rng.randrange(1000)
    if kind < 3:
        return rng.choice(["plain", 'quo"te', "back\\slash\\", "} ] {", "[{", "line\nfeed", "é☃", "\\\"", ""])
    if kind == 3:
        return [value(rng, deep + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}{rng.choice(['', '{', '\"'])}": value(rng, deep + 1) for i in range(rng.randrange(4))}


def mixed_text(rng, n, odd):
    out = []
    for _ in range(n):
        whole = {"v": value(rng)} if rng.random() < 0.7 else [value(rng) for _ in range(rng.randrange(4))]
        text = json.dumps(whole, indent=rng.choice([None, None, 2, 0]), ensure_ascii=rng.random() < 0.5)
        out.append(text + rng.choice(["\n", "\n", "\n\n", " ", "\r\n", "  \n"]))
        if rng.random() < odd:
            out.append(rng.choice(["not json\n", '{"cut": "off\n', "}\n", "] ]\n", '{"a": {"b": 1}\n', "{ {\n", '"\n', "17\n", "{} x\n"]))
    return "".join(out)


def all_ranges(path, size, split):
    """The values of a file read in ranges, with depths by the definition."""
    text = open(path, "rb").read().decode()
    seen = [d for d, _ in walk(text if text.endswith("\n") else text + "\n")]
    offsets = np.cumsum([0] + [len(c.encode()) for c in text])
    out = []
    for start in range(0, max(size, 1), split):
        end = start + split if start + split < size else None
        breaks = [0] + [i + 1 for i, c in enumerate(text) if c == "\n"]
        first = next((b for b in breaks if offsets[b] >= start), len(text))
        after = next((b for b in breaks if end is not None and offsets[b] >= end), len(text))
        depth = seen[first - 1] if first else 0
        base = min([depth, *seen[first:]])
        later = min([seen[after - 1] if after else 0, *seen[after:]]) if end is not None and after < len(text) else None
        out += jv.range_values(path, start, end, depth, base, later)
    return [v.decode() for v in out]


@pytest.mark.parametrize("seed, odd", [(s, o) for s in range(12) for o in (0, 0.25)])
def test_ranges_give_the_values_of_the_whole_file(tmp_path, seed, odd, monkeypatch):
    rng = random.Random(seed)
    text = mixed_text(rng, 25, odd)
    path = str(tmp_path / "a.json")
    data = text.encode()
    open(path, "wb").write(data)
    want = plain_values(text)
    monkeypatch.setattr(jv, "READ_BYTES", rng.choice([7, 64, 4096]))
    for split in (1 << 30, 400, 97, 13):
        assert all_ranges(path, len(data), split) == want, split


@pytest.mark.parametrize("odd", [0, 0.3])
def test_spark_composes_the_ranges(spark, tmp_path, odd, monkeypatch):
    rng = random.Random(3)
    want = []
    for k in range(4):
        text = mixed_text(rng, 60, odd)
        (tmp_path / f"f{k}.json").write_bytes(text.encode())
        want += plain_values(text)
    text = mixed_text(rng, 30, odd)
    (tmp_path / "z.json.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "empty.json").write_bytes(b"")
    want += plain_values(text)
    files = land.list_files(spark, str(tmp_path))
    for split in (200, 1 << 20):
        got = [bytes(r["value"]).decode() for r in jv.read_values(spark, files, split_bytes=split).collect()]
        assert sorted(got) == sorted(want)


def test_lines_indented_objects_and_arrays_in_one_load(spark, tmp_path):
    folder = tmp_path / "year=2024"
    folder.mkdir()
    (folder / "lines.json").write_text('{"event_id": "a"}\n\n{"event_id": "b"}\nbroken {\n{"event_id": "c"}\n')
    (folder / "one.json").write_text(json.dumps({"event_id": "d", "nested": {"x": [1, {"y": 2}]}}, indent=2))
    (folder / "array.json").write_text(json.dumps([{"event_id": "e"}, {"event_id": "f"}], indent=2))
    (folder / "bytes.json").write_bytes(b'{"event_id": "\xff"}\n')
    (folder / "other.txt").write_text('{"event_id": "no"}')
    rows = land.read_mixed(spark, str(tmp_path))
    assert rows.columns == ["raw_payload", "ingested_at"]
    ids = rows.select(F.try_variant_get("raw_payload", "$.event_id", "string").alias("id"),
                      F.try_variant_get("raw_payload", "$[1].event_id", "string").alias("second"),
                      F.col("raw_payload").isNull().alias("odd")).collect()
    assert sorted(r["id"] for r in ids if r["id"]) == ["a", "b", "c", "d", "�"]
    assert [r["second"] for r in ids if r["second"]] == ["f"] and sum(r["odd"] for r in ids) == 1 and len(ids) == 7


def test_values_too_long_are_rows_without_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jv, "READ_BYTES", 128)
    long = json.dumps({"x": ["y" * 50] * 40}, indent=1)
    (tmp_path / "a.json").write_text('{"a": 1}\n' + long + '\n{"b": 2}\n')
    path, size = str(tmp_path / "a.json"), len(long) + 18
    assert list(jv.range_values(path, 0, None, 0, 0, None, 1000)) == [b'{"a": 1}', None, b'{"b": 2}']
    first = list(jv.range_values(path, 0, 300, 0, 0, 0, 1000))
    rest = list(jv.range_values(path, 300, None, 2, 0, None, 1000))
    assert (first, rest) == ([b'{"a": 1}', None], [b'{"b": 2}']) and size > 2000
    monkeypatch.setattr(jv, "LARGEST", 500)
    (tmp_path / "b.json").write_text('{"a": 1}\n{"x": "' + "y" * 3000 + '"}\n{"b": 2}\n')
    assert list(jv.range_values(str(tmp_path / "b.json"), 0, None, 0, 0, None)) == [b'{"a": 1}', b"\x00", b'{"b": 2}']
    assert list(jv.range_values(str(tmp_path / "b.json"), 8, 10, 0, 0, 0)) == [b"\x00"]
    assert list(jv.range_values(str(tmp_path / "b.json"), 10, None, 0, 0, None)) == [b'{"b": 2}']


def test_effects_compose():
    rng = random.Random(5)
    for _ in range(50):
        steps = [(rng.randrange(4), rng.randrange(4)) for _ in range(rng.randrange(8))]
        closes, opens = jv.composed(*np.array(steps, dtype=np.int64).reshape(-1, 2).T)
        for start in range(6):
            depth = start
            for c, o in steps:
                depth = max(0, depth - c) + o
            assert depth == max(0, start - closes) + opens
