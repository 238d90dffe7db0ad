import json
from datetime import datetime

import pytest

from bartide.operators import drift

LINE = "line_id long, file_id long, line_no int, payload string"
FILE = "file_id long, feed string, file_seq int, file_name string, received_at timestamp_ntz, n_lines int"


def tables(spark, files):
    """files: per feed a list of lists of payloads."""
    lines, heads, fid = [], [], 0
    for feed, fs in files.items():
        for seq, payloads in enumerate(fs, 1):
            fid += 1
            heads.append((fid, feed, seq, f"{feed}/{seq}", datetime(2025, 1, 1), len(payloads)))
            for k, p in enumerate(payloads):
                lines.append((len(lines) + 1, fid, k + 1, p if isinstance(p, str) or p is None else json.dumps(p)))
    return spark.createDataFrame(lines, LINE), spark.createDataFrame(heads, FILE)


def found(spark, files):
    return sorted(tuple(r)[:3] for r in drift.changes(*tables(spark, files)).collect())


def rows(n=6, **fields):
    return [{k: (v(i) if callable(v) else v) for k, v in fields.items()} for i in range(n)]


def test_changes(spark):
    one = rows(symbol="A", spread_bps=lambda i: 1.5 + i, bid_depth=lambda i: 10.0 + i, q_bid_depth=lambda i: 1e5 + i)
    two = rows(q_bid_depth=lambda i: 1e5 + i, symbol="A", sprdBp=lambda i: {"value": 2.5 + i, "unit": "bps"})
    three = rows(symbol="B", sprdBp=lambda i: f"{i + 1}.5 bps", note="x", q_bid_depth=lambda i: 1e5 + i)
    files = {"f": [one, two, three, three + ['{"symbol": "C", "sprd', "[1]", "null", None]], "g": [one]}
    assert found(spark, files) == [(2, "removed", "bid_depth"), (2, "renamed", "sprdBp"), (2, "retyped", "sprdBp"), (3, "added", "note"), (3, "retyped", "sprdBp")]


def test_nulls_stray_values_and_files_without_lines(spark):
    a = rows(x=lambda i: 1.0 + i, y="t")
    b = rows(x=lambda i: None, y="t") + rows(1, x="stray", y=None)
    c = rows(x=lambda i: 2 if i else "stray", y="t")
    assert found(spark, {"f": [a, c]}) == []
    assert found(spark, {"f": [a, b[:-1], a]}) == []
    assert found(spark, {"f": [a, []]}) == [(2, "removed", "x"), (2, "removed", "y")]
    assert found(spark, {"f": []}) == []


def test_consistent_table(spark):
    one = rows(symbol="A", spread_bps=lambda i: 1.5, snapshot_time="2025-01-01T00:00:01", **{"select": True})
    two = rows(symbol="A", sprd_bp=lambda i: {"value": 2.5}, snap_ts=1735689601000, **{"select": "no"}) + [{"symbol": "Z" * 100_000, "sprd_bp": "odd one"}]
    t = drift.consistent(*tables(spark, {"f": [one, two, one]})).orderBy("line_id").collect()
    assert len(t) == 19 and t[0].spread_bps == 1.5 and t[6].spread_bps == 2.5 and t[0].snapshot_time == t[6].snapshot_time == 1735689601000000
    assert t[0]["select"] is True and t[6]["select"] is False and t[12].spread_bps is None and t[12].other_types == {"sprd_bp": '"odd one"'} and len(t[12].symbol) == 100_000


def test_consistent_table_keeps_whole_values(spark):
    plain = rows(depth=lambda i: 1.5 + i, spread=lambda i: 2.5 + i, seen="2025-01-01T00:00:01", seq=5)
    odd = [
        {"depth": [11.006, 16.508], "spread": {"value": 3.5, "unit": "bps"}, "seen": "2025-01-01T00:00:01+07:00", "seq": 12345678901234567890},
        {"depth": [11.006], "spread": {"value": 3.5}, "seen": [1735689601000, 5], "seq": "7"},
        {"depth": [11.006, None], "spread": "3.5 bps", "seen": 1735689601000, "seq": 0.1},
        {"depth": [], "spread": " 3.50 ", "seen": None, "seq": 1e300},
    ]
    t = drift.consistent(*tables(spark, {"f": [plain, odd]})).orderBy("line_id").collect()[6:]
    assert [r.depth for r in t] == [11.006, 11.006, 11.006, None] and [r.spread for r in t] == [3.5] * 4
    assert [{k: json.loads(v) for k, v in r.other_types.items()} for r in t] == [odd[0], {"seen": odd[1]["seen"]}, {"depth": [11.006, None], "spread": "3.5 bps"}, {"depth": []}]


def test_two_fields_of_a_class_in_one_line(spark):
    a, b, c = (rows(x="t", **{k: lambda i: 1.5 + i}) for k in ("spread_bps", "sprd_bp", "spread_basis_points"))
    both = rows(x="t", spread_bps=lambda i: 1.5 + i, spread_basis_points=lambda i: 2.5 + i)
    t = drift.consistent(*tables(spark, {"f": [a, b], "g": [b, c], "h": [both + [{"spread_bps": 9.5, "spread_basis_points": None}]]})).orderBy("line_id").collect()
    name = next(n for n in t[0].asDict() if n.startswith("sp"))
    assert t[24][name] == 2.5 and t[24].other_types == {"spread_bps": "1.5"} and t[30][name] == 9.5 and not any(r.other_types for r in [*t[:24], t[30]])


def test_too_many_rename_pairs_raise(spark, monkeypatch):
    pairs = [(1, "renamed", f"n{i}", f"o{i}") for i in range(13)]
    monkeypatch.setattr(drift, "changes", lambda *_: spark.createDataFrame(pairs, "file_id long, change_kind string, field_name string, old_name string"))
    with pytest.raises(ValueError, match="pairs"):
        drift.consistent(*tables(spark, {"f": [rows(x=1.5)]}), max_fields=3)


def test_union_keeps_alternatives(spark):
    lines, _ = tables(spark, {"f": [rows(x=1, y=[1.5]), rows(x="a", y=[1.5])]})
    got = {(r.field_name, r.json_type): (r.n_values, r.first_file_id, r.last_file_id) for r in drift.union_schema(drift.alternatives(lines)).collect()}
    assert got == {("x", "number"): (6, 1, 1), ("x", "string"): (6, 2, 2), ("y", "array"): (12, 1, 2), ("y[]", "number"): (12, 1, 2)}


def test_likeness():
    assert drift.name_likeness("spread_bps", "Spread (basis points)") == 1 and drift.name_likeness("imb", "imbalance") == 1 and drift.name_likeness("checksum", "latency_ms") == 0


def test_alternatives_by_path(spark):
    rows = [
        (1, 1, '{"a": 1, "b": {"c": [1, 2], "d e": null}}'), (2, 1, '{"a": 2.5, "b": {"c": ["x"]}}'), (3, 2, '{"a": "1", "b": {"c": [], "d e": true}}'), (4, 2, '{"b": 7, "z": [{"k": 1}, {"k": "x"}]}'),
        (5, 3, '{"a": 1, "n": null}'), (6, 3, "{cut"), (7, None, '{"a": 1}'), (8, 4, None),
    ]
    found = drift.alternatives(spark.createDataFrame(rows, "line_id long, file_id long, payload string")).cache()
    got = {(r.field_name, r.json_type): (r.n_values, r.n_files, r.first_file_id, r.last_file_id) for r in drift.union_schema(found).collect()}
    mixed = got.pop(("z[].k", "mixed"), None) or got.pop(("z[]", "mixed"))
    got.pop(("z[]", "object"), None)
    assert mixed == (1, 1, 2, 2) and got == {
        ("a", "number"): (3, 2, 1, 3), ("a", "string"): (1, 1, 2, 2), ("b", "object"): (3, 2, 1, 2), ("b", "number"): (1, 1, 2, 2), ("b.c", "array"): (3, 2, 1, 2),
        ("b.c[]", "number"): (1, 1, 1, 1), ("b.c[]", "string"): (1, 1, 1, 1), ("b.d e", "boolean"): (1, 1, 2, 2), ("z", "array"): (1, 1, 2, 2),
    }
    files = spark.createDataFrame([(1, "f", 1), (2, "f", 2), (3, "g", 1), (4, "g", 2)], "file_id long, feed string, file_seq int")
    new = {(r.file_id, r.field_name, r.json_type): r.other_types for r in drift.appearing(found, files).collect()}
    assert new[(2, "a", "string")] == "number" and new[(2, "b", "number")] == "object" and new[(2, "b.d e", "boolean")] == "" and not any(f in (1, 3, 4) for f, _, _ in new)
    assert drift._shape_paths("OBJECT<`a, b: c`: ARRAY<OBJECT<x: STRING, y: VOID>>, d: DECIMAL(3,1)>", "r") == [("r", "object"), ("r.a, b: c", "array"), ("r.a, b: c[]", "object"), ("r.a, b: c[].x", "string"), ("r.d", "number")]
