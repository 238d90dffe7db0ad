"""Schemas that drift between files of JSON lines.

Method: tagged-union inference. Each file's schema is fused from its lines in
parallel and keeps, for every path, how many values it has of each type (the
alternatives of a tagged union); file schemas are compared along each feed, alternatives
that appear are reported, and all are fused into one. Values whose type conflicts go to
typed branches and are converted to one canonical value.

Renames are inferred from evidence: a field that goes and one that comes in the same
file are one quantity if no file ever has both, their values are of one kind with like
distributions, and their names are akin; the best pairs win, one to one.

Defined results: lines that aren't a JSON object are skipped (they count in no
schema); a field that is only ever null in a file has no type there; equally frequent
types are all a file's type, and only a change to none of them is a retyping; a file
without readable lines has no fields; null file_id rows and empty tables give nothing;
files without a feed are one feed, repeated rows of a file count once; very long
payloads are parsed whole.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bartide.operators.chunks import placed, ranked
from bartide.session import cut

JSON_TYPES = ("string", "number", "boolean", "array", "object")

#: Words that name the same thing in field names.
ALIKE = [
    {"time", "ts", "at", "timestamp", "date", "dt"}, {"price", "px"}, {"bps", "bp"}, {"limit", "max", "cap"},
    {"qty", "quantity", "size", "amount"}, {"levels", "depth"}, {"best", "1", "top", "price", "px"}, {"latency", "lag", "delay"},
    {"symbol", "ticker", "instrument"}, {"ingested", "received"}, {"id", "key"}, {"volume", "vol"},
]
LEAST_NAME, LEAST_SCORE = 0.2, 0.7


def exploded(lines: DataFrame) -> DataFrame:
    """One row per (line, top-level field): line_id, file_id, key, v (variant), json_type (null for null), shape."""
    parsed = lines.select("line_id", "file_id", F.try_parse_json("payload").alias("_j")).where(F.col("file_id").isNotNull() & F.schema_of_variant("_j").startswith("OBJECT"))
    rows = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("_j").outer()))
    shape = F.schema_of_variant("value")
    kind = (
        F.when(shape == "VOID", None).when(shape == "STRING", "string").when(shape == "BOOLEAN", "boolean")
        .when(shape.startswith("ARRAY"), "array").when(shape.startswith("OBJECT"), "object").otherwise("number")
    )
    return rows.select("line_id", "file_id", "key", F.col("value").alias("v"), kind.alias("json_type"), shape.alias("shape"))


def canonical(rows: DataFrame) -> DataFrame:
    """Add the typed branches: c_text, c_number (plain, with a unit, ``{value: ...}`` or first of a list), c_time (microseconds), c_bool.

    Each pattern is tried only on values of the types and lengths that it can fit."""
    kind = F.col("json_type")
    rows = rows.withColumn("c_text", F.when(kind.isin("string", "number", "boolean"), F.try_variant_get("v", "$", "string")))
    number = (
        F.when(kind == "number", F.try_variant_get("v", "$", "double"))
        .when(kind == "string", F.regexp_extract("c_text", r"^\s*([+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)\s*[A-Za-z%]*\s*$", 1).try_cast("double"))
        .when(kind == "object", F.try_variant_get("v", "$.value", "double"))
        .when(kind == "array", F.try_variant_get("v", "$[0]", "double"))
    )
    rows = rows.withColumn("c_number", number)
    n = F.col("c_number")
    since = F.when(n.between(1e9, 4e9), n * 1e6).when(n.between(1e12, 4e12), n * 1e3).when(n.between(1e15, 4e15), n)
    dated = (kind == "string") & (F.length("c_text") >= 16) & (F.substring("c_text", 5, 1) == "-") & F.col("c_text").rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}")
    rows = rows.withColumn("_iso", F.when(dated, F.col("c_text").try_cast("timestamp_ntz")))
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', _iso)")
    low = F.lower("c_text")
    said = F.when(low.isin("true", "yes", "1"), True).when(low.isin("false", "no", "0"), False)
    could = (kind == "boolean") | ((kind == "string") & (F.length("c_text") <= 5)) | ((kind == "number") & n.isin(0.0, 1.0))
    return rows.withColumns({"c_time": F.coalesce(since.cast("long"), micros), "c_bool": F.when(could, said)}).drop("_iso")


def lossless() -> Column:
    """Whether c_number, or c_time, is all that the value of ``canonical(...)`` says: no unit, no zone, no further elements or members, no digits beyond a double's."""
    kind = F.col("json_type")
    inner = F.when(kind == "object", F.try_variant_get("v", "$.value", "string")).when(kind == "array", F.try_variant_get("v", "$[0]", "string")).otherwise(F.col("c_text"))
    alone = F.when(kind == "object", F.size(F.json_object_keys(F.to_json("v"))) == 1).when(kind == "array", F.json_array_length(F.to_json("v")) == 1).otherwise(True)
    text = F.trim(inner)
    plain = text.rlike(r"^[+-]?\d+(\.\d+)?([eE][+-]?\d+)?$")
    digits = F.length(F.regexp_replace(F.regexp_replace(text, r"[eE].*$", ""), r"^[+-]?[0.]*|\.", ""))
    exact = (digits <= 15) | F.coalesce(text.try_cast("decimal(38,18)") == F.col("c_number").try_cast("decimal(38,18)"), F.lit(False))
    local = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$")
    return F.coalesce(alone & ((plain & exact) | local), F.lit(False))


def file_schemas(lines: DataFrame) -> DataFrame:
    """One row per (file_id, key): the tagged union of its types, and the evidence on its values."""
    rows = canonical(exploded(lines))
    ln = F.when(F.col("c_number") != 0, F.ln(F.abs("c_number")))
    return rows.groupBy("file_id", "key").agg(
        *[F.count_if(F.col("json_type") == t).alias(f"n_{t}") for t in JSON_TYPES],
        F.count("json_type").alias("n"), F.count("c_time").alias("n_time"), F.count("c_bool").alias("n_bool"), F.count("c_number").alias("n_num"),
        F.percentile_approx(ln, [0.1, 0.5, 0.9], 1000).alias("q"), F.avg((F.col("c_number") < 0).cast("int")).alias("neg"),
    )


def _words(name: str) -> list[str]:
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", name)
    name = re.sub(r"(?<=[A-Za-z])(?=\d)", " ", name).lower()
    name = re.sub(r"basis[\s_-]*points?", "bps", name)
    return re.findall(r"[a-z]+|\d+", name)


def _word_like(a: str, b: str) -> bool:
    if a == b or any(a in s and b in s for s in ALIKE):
        return True
    short, long = sorted((a, b), key=len)
    if len(short) >= 3 and long.startswith(short):
        return True
    letters = iter(long)  # consonants in order: sprd, spread
    return len(short) >= 3 and short[0] == long[0] and all(x in letters for x in short)


def name_likeness(a: str, b: str) -> float:
    x, y = _words(a), _words(b)
    rest, hits = list(y), 0
    for w in x:
        hit = next((v for v in rest if w == v), None) or next((v for v in rest if _word_like(w, v)), None)
        if hit is not None:
            rest.remove(hit)
            hits += 1
    return hits / max(len(x) + len(y) - hits, 1)


def _kind(f: dict) -> str:
    n = max(f["n"], 1)
    if f["n"] == 0:
        return "none"
    if f["n_time"] > n / 2:
        return "time"
    if f["n_bool"] > 0.9 * n:
        return "bool"
    return "number" if f["n_num"] > n / 2 else "text" if f["n_string"] > n / 2 else "other"


def value_likeness(a: dict, b: dict) -> float:
    """0 to 1; 0 for different kinds."""
    ka, kb = _kind(a), _kind(b)
    if ka != kb:
        return 0.4 if "none" in (ka, kb) else 0.0
    if ka != "number" or a["q"] is None or b["q"] is None:
        return 0.6
    (p, m, r), (s, k, u) = a["q"], b["q"]
    w, x = max(r - p, 0) + 0.3, max(u - s, 0) + 0.3
    return (1 / (1 + abs(m - k) / (w + x))) * min(w, x, 3) / min(max(w, x), 3) * (1 - abs((a["neg"] or 0) - (b["neg"] or 0)))


def _types(f: dict) -> set:
    top = max(f[f"n_{t}"] for t in JSON_TYPES)
    return {t for t in JSON_TYPES if f[f"n_{t}"] == top} if top else set()


def compare(before: dict, now: dict, apart: set) -> list[tuple[str, str, str]]:
    """(kind, name, name before) of the changes between two file schemas; ``apart``: pairs that some file has both of."""
    gone, come = sorted(set(before) - set(now)), sorted(set(now) - set(before))
    scored = []
    for r in gone:
        for a in come:
            name, value = name_likeness(r, a), value_likeness(before[r], now[a])
            if (r, a) not in apart and value > 0 and name >= LEAST_NAME and name + value >= LEAST_SCORE:
                scored.append((-(name + value), r, a))
    pairs: dict[str, str] = {}
    for _, r, a in sorted(scored):
        if r not in pairs and a not in pairs.values():
            pairs[r] = a
    out = [("renamed", a, r) for r, a in pairs.items()]
    out += [("removed", r, r) for r in gone if r not in pairs] + [("added", a, a) for a in come if a not in pairs.values()]
    same = [(k, k) for k in before if k in now] + list(pairs.items())
    for r, a in same:
        x, y = _types(before[r]), _types(now[a])
        if x and y and not x & y:
            out.append(("retyped", a, r))
    return out


def _compare_rows(batches):
    for pdf in batches:
        rows = []
        for fid, before, now, apart in zip(pdf["file_id"], pdf["before"], pdf["now"], pdf["apart"]):
            fields = lambda xs: {x["key"]: x for x in ([] if xs is None else xs)}
            seen = {(p["r"], p["a"]) for p in ([] if apart is None else apart)}
            rows += [(int(fid), *c) for c in compare(fields(before), fields(now), seen)]
        yield pd.DataFrame(rows, columns=["file_id", "change_kind", "field_name", "old_name"])


def changes(lines: DataFrame, files: DataFrame, schemas: DataFrame | None = None) -> DataFrame:
    """All changes: file_id, change_kind, field_name, old_name."""
    schemas = cut(file_schemas(lines), "file-schemas") if schemas is None else schemas  # read three times
    fields = F.collect_list(F.struct("key", *[f"n_{t}" for t in JSON_TYPES], "n", "n_time", "n_bool", "n_num", "q", "neg"))
    names = lambda c: F.coalesce(F.transform(F.col(c), lambda x: x["key"]), F.array().cast("array<string>"))
    per_file = cut(schemas.groupBy("file_id").agg(F.array_sort(fields).alias("now")).withColumn("_names", names("now")), "schemas-by-file")
    # Neighbours meet by their places, so that a feed with most of the files is many tasks; schemas come to them by file.
    listed = files.where("file_id is not null").select("file_id", F.coalesce("feed", F.lit("")).alias("feed"), "file_seq").distinct()
    order = placed(*ranked(listed, "feed", ["file_seq", "file_id"]), "feed").select("feed", "_pos", "file_id")
    pairs_of_files = order.join(order.select(F.col("feed"), (F.col("_pos") + 1).alias("_pos"), F.col("file_id").alias("_before_id")), ["feed", "_pos"])
    before = per_file.select(F.col("file_id").alias("_before_id"), F.col("now").alias("before"), F.col("_names").alias("_old"))
    none = F.array().cast("array<string>")
    steps = pairs_of_files.join(per_file.withColumnRenamed("_names", "_new"), "file_id", "left").join(before, "_before_id", "left")
    steps = steps.withColumns({"_old": F.coalesce("_old", none), "_new": F.coalesce("_new", none)})
    steps = cut(steps.withColumns({"_gone": F.array_except("_old", "_new"), "_come": F.array_except("_new", "_old")}).select("file_id", "before", "now", "_gone", "_come"), "steps")
    # Pairs of names that are candidates anywhere, and of those the ones that one file has both of: files count by their set of names.
    pairs = steps.select(F.explode("_gone").alias("r"), "_come").select("r", F.explode("_come").alias("a")).distinct()
    sets = per_file.select("_names").distinct()
    both = sets.select("_names", F.explode("_names").alias("r")).join(pairs, "r").where(F.array_contains("_names", F.col("a"))).select("r", "a").distinct()
    asked = steps.select("file_id", F.explode("_gone").alias("r"), "_come").select("file_id", "r", F.explode("_come").alias("a"))
    apart = asked.join(both, ["r", "a"]).groupBy("file_id").agg(F.collect_set(F.struct("r", "a")).alias("apart"))
    found = steps.select("file_id", "before", "now").join(apart, "file_id", "left")
    return found.mapInPandas(_compare_rows, "file_id long, change_kind string, field_name string, old_name string")


def _shape_paths(shape: str, path: str) -> list[tuple[str, str]]:
    """(path, JSON type) of all values within one of ``shape``; [] stands for the elements of a list."""
    head = shape.split("<", 1)[0]
    if head == "VOID":
        return []
    if head == "ARRAY":
        return [(path, "array"), *_shape_paths(shape[6:-1], path + "[]")]
    if head == "OBJECT":
        out, depth, begin, quoted = [(path, "object")], 0, 7, False
        for i, c in enumerate(shape):
            if c == "`":
                quoted = not quoted
            elif not quoted:
                depth += (c in "<(") - (c in ">)")
            if i >= 7 and not quoted and ((c == "," and depth == 1) or (i == len(shape) - 1)):
                part = shape[begin:i].strip()
                begin = i + 1
                if part:
                    name, kind = re.match(r"(`(?:[^`]|``)*`|[^:]+): (.*)$", part, re.S).groups()
                    name = name[1:-1].replace("``", "`") if name.startswith("`") else name
                    out += _shape_paths(kind, f"{path}.{name}")
        return out
    return [(path, {"STRING": "string", "BOOLEAN": "boolean", "VARIANT": "mixed"}.get(head, "number"))]


def _path_rows(batches):
    for pdf in batches:
        known: dict[str, list] = {}
        rows = []
        for fid, key, shape, n in zip(pdf["file_id"], pdf["key"], pdf["shape"], pdf["n"]):
            if shape not in known:
                known[shape] = _shape_paths(shape, "")
            rows += [(fid, key + path, kind, n) for path, kind in known[shape]]
        yield pd.DataFrame(rows, columns=["file_id", "field_name", "json_type", "n"])


def alternatives(lines: DataFrame) -> DataFrame:
    """The tagged union of each file by path, not only of top-level fields: file_id, field_name (``a.b``, ``a[]`` for elements), json_type,
    n: values that have it. Values are counted by shape before Python sees a shape; elements of several types are ``mixed``."""
    shapes = exploded(lines).where(F.col("json_type").isNotNull()).groupBy("file_id", "key", "shape").agg(F.count("*").alias("n"))
    return shapes.mapInPandas(_path_rows, "file_id long, field_name string, json_type string, n long").groupBy("file_id", "field_name", "json_type").agg(F.sum("n").alias("n"))


def union_schema(found: DataFrame) -> DataFrame:
    """All file schemas (``alternatives``) fused: every alternative of every path with its values, files, and the first and last of them."""
    return found.groupBy("field_name", "json_type").agg(
        F.sum("n").alias("n_values"), F.count("*").alias("n_files"), F.min("file_id").alias("first_file_id"), F.max("file_id").alias("last_file_id"),
    )


def appearing(found: DataFrame, files: DataFrame) -> DataFrame:
    """Alternatives that a feed's files haven't had before: file_id, feed, field_name, json_type, other_types (what the path had in
    earlier files of the feed; empty if it is new). A feed's first file with readable lines only sets out."""
    at = found.join(files.select("file_id", "feed", F.struct("file_seq", "file_id").alias("at")), "file_id")
    first = at.groupBy("feed", "field_name", "json_type").agg(F.min("at").alias("at"))
    begun = at.groupBy("feed").agg(F.min("at").alias("_begun"))
    of_path = first.groupBy("feed", "field_name").agg(F.array_sort(F.collect_list(F.struct("at", "json_type"))).alias("_all"))
    new = first.join(begun, "feed").where("at > _begun").join(of_path, ["feed", "field_name"])
    before = F.transform(F.filter("_all", lambda x: x["at"] < F.col("at")), lambda x: x["json_type"])
    return new.select("at.file_id", "feed", "field_name", "json_type", F.array_join(F.array_sort(before), ",").alias("other_types"))


def _classes(pairs: list[tuple[str, str]], names: list[tuple[str, int]]) -> dict[str, str]:
    """Each field name to its class's name: the name that most files have (ties: first in order)."""
    root = {n: n for n, _ in names}

    def find(x: str) -> str:
        while root[x] != x:
            x = root[x]
        return x

    for r, a in pairs:
        if r in root and a in root:
            root[find(r)] = find(a)
    best: dict[str, tuple[int, str]] = {}
    for n, files in names:
        best[find(n)] = min(best.get(find(n), (0, "~")), (-files, n))
    return {n: best[find(n)][1] for n, _ in names}


def consistent(lines: DataFrame, files: DataFrame, max_fields: int = 2000) -> DataFrame:
    """All readable lines in one table of steady schema: line_id, file_id, one canonical column per field, and
    ``other_types``: the whole JSON of values that have no canonical form, or of which it keeps only a part (the first
    of a list, a number without its unit). Where a line has two fields of one class, the first of them in order that has a
    canonical form is in the column, and the others are in ``other_types`` too.

    Field names and rename pairs are schema metadata; ``max_fields`` bounds the names, four times that the pairs (beyond
    it this raises)."""
    schemas = cut(file_schemas(lines), "file-schemas")
    pairs = changes(lines, files, schemas).where("change_kind = 'renamed'").groupBy("old_name", "field_name").count()
    stats = schemas.groupBy("key").agg(F.count("*").alias("files"), *[F.sum(c).alias(c) for c in ("n", "n_time", "n_bool", "n_num", "n_string")])
    known = stats.limit(max_fields + 1).collect()
    if len(known) > max_fields:
        raise ValueError(f"more than {max_fields} field names")
    sure = [(r.old_name, r.field_name) for r in pairs.limit(max_fields * 4 + 1).collect()]
    if len(sure) > max_fields * 4:
        raise ValueError(f"more than {max_fields * 4} pairs of renamed fields")
    to = _classes(sure, [(r.key, r.files) for r in sorted(known, key=lambda r: r.key)])
    totals: dict[str, dict] = {}
    for r in known:
        t = totals.setdefault(to[r.key], dict.fromkeys(("n", "n_time", "n_bool", "n_num", "n_string"), 0))
        for c in t:
            t[c] += r[c] or 0
    kinds = {c: _kind(t) for c, t in totals.items()}
    if not kinds:
        return lines.select("line_id", "file_id", F.lit(None).cast("map<string,string>").alias("other_types")).where(F.lit(False))
    rows = canonical(exploded(lines))
    mapping = F.create_map(*[F.lit(x) for kv in to.items() for x in kv])
    rows = rows.withColumns({"_c": mapping[F.col("key")], "_lossless": lossless()})
    # Classes of which some file has two fields: pairs of them needn't have been renamed into each other.
    crowded = schemas.select("file_id", mapping[F.col("key")].alias("_c")).groupBy("file_id", "_c").count().where("count > 1").select("_c").distinct()
    crowded = [r["_c"] for r in crowded.collect()]
    branch = {"time": "c_time", "bool": "c_bool", "number": "c_number", "text": "c_text", "none": "c_text"}
    as_json = F.when(F.col("json_type").isNotNull(), F.to_json("v"))

    def column(name: str, kind: str) -> Column:
        value = F.when(F.col("_c") == name, F.col(branch[kind]) if kind in branch else as_json)
        return (F.min_by(value, F.when(value.isNotNull(), F.col("key"))) if name in crowded else F.max(value)).alias(name)

    has, fits = F.lit(False), F.lit(False)
    for kind, c in branch.items():
        names = [n for n, k in kinds.items() if k == kind]
        if names:
            whole = F.col("_lossless") if kind in ("number", "time") else F.lit(True)
            here = F.col("_c").isin(*names) & F.col(c).isNotNull()
            has, fits = has | here, fits | (here & whole)
    other = [n for n, k in kinds.items() if k not in branch]
    if other:
        has, fits = has | F.col("_c").isin(*other), fits | F.col("_c").isin(*other)
    kept = F.struct("key", as_json.alias("json"), "_c", has.alias("has"), fits.alias("fits"))
    left = F.collect_list(F.when(F.col("json_type").isNotNull() & (~fits | F.col("_c").isin(*crowded)), kept))
    lines_of = rows.groupBy("line_id", "file_id").agg(*[column(n, kinds[n]) for n in sorted(kinds)], left.alias("other_types"))
    taken = lambda x: F.exists("other_types", lambda y: (y["_c"] == x["_c"]) & y["has"] & (y["key"] < x["key"]))
    odd = F.filter("other_types", lambda x: ~x["fits"] | taken(x)) if crowded else F.col("other_types")
    return lines_of.withColumn("other_types", F.map_from_entries(F.transform(odd, lambda x: F.struct(x["key"], x["json"]))))
