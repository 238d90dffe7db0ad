"""Sentence boundaries of messages in many languages and scripts.

Method: marks that end nothing (decimals, addresses, initials, abbreviations, marks
within quotes and brackets) are masked by private-use placeholders of the same length,
units (first line, paragraphs, list items) are cut, sentences are split by
script-specific terminator patterns, and the text is restored by offsets, which masking
doesn't move. Everything is SQL expressions; there is no shuffle.

Defined results: null, empty and blank texts, and texts without a message (headers or a
diff alone), give no rows; both line endings are blanks; private-use characters of the
text itself stand for nothing; offsets are code points; repeated rows give their rows
again; very long messages are split whole, in time linear in their length but for the
offsets (a running sum in blocks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Placeholders: a unit begins; a mark that ends nothing; a mark before a closing sign (Latin, CJK); a sentence ends
#: (the only one that adds to the length; splitting takes it out).
UNIT, MASK, SHUT, SHUT_CJK, BREAK = "", "", "", "", ""

#: Abbreviations that never end a sentence, ...
ABBREVIATIONS = [
    "e.g", "i.e", "vs", "cf", "incl", "viz", "resp", "Prof", "Dr", "Mr", "Mrs", "Ms", "St", "Gen", "Sra", "Sr", "Srta", "Dra", "Lic", "Ing",
    "bzw", "vgl", "evtl", "ggf", "sog", "Mme", "Mlle", "MM", "TS", "ThS", "PGS", "Tp", "BS", "см", "См", "напр", "Напр", "им", "डॉ", "श्री", "د", "أ",
]
#: ... ones that don't before a number, ...
BEFORE_NUMBER = [
    "approx", "no", "No", "nos", "sec", "Sec", "fig", "Fig", "figs", "p", "pp", "S", "Abs", "Nr", "env", "aprox", "ca", "tr", "Q", "стр", "рис", "п", "гл", "с",
    "pág", "págs", "art", "Art", "vol", "Vol", "ch", "eq", "v", "V", "n", "núm", "num", "Bd", "Kap", "chap", "cap", "ver", "khoảng",
    "Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sep", "Sept", "Oct", "Nov", "Dec",
]
#: ... and ones of several parts, of which the last ends nothing either.
PARTS = [("z", "B"), ("d", "h"), ("u", "a"), ("o", "ä"), ("i", "d"), ("p", "ex"), ("p", "ej"), ("par", "ex"), ("v", "pág"), ("т", "к"), ("т", "е"), ("s", "S"), ("s", "o"), ("см", "рис")]
#: First parts of ones that may end a sentence.
OPEN_PARTS = [("т", "д"), ("т", "п"), ("и", "др"), ("EE", "UU")]
GERMAN_MONTHS = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"
GERMAN_BEFORE_ORDINAL = "[Ii]m|[Bb]eim|[Zz]um|[Vv]om|[Aa]m|[Dd]em|[Dd]en|[Dd]er|[Aa]b"
#: Common endings of file names; a point before one of them is within a name.
EXTENSIONS = [
    "avro", "bak", "bat", "bin", "c", "cc", "cfg", "clj", "conf", "cpp", "cs", "css", "csv", "cxx", "dart", "db", "diff", "dll", "env", "erl", "ex", "go", "gradle", "graphql", "gz", "h", "hpp", "hs", "html",
    "ini", "ipynb", "jar", "java", "jpg", "js", "json", "jsonl", "jsx", "kt", "lock", "log", "lua", "md", "mdx", "mm", "orc", "parquet", "patch", "pdf", "php", "pl", "png", "properties", "proto", "ps1", "py",
    "rb", "rs", "rst", "scala", "scss", "sh", "so", "sql", "svg", "swift", "tar", "tex", "tf", "toml", "ts", "tsx", "txt", "vue", "wasm", "xml", "yaml", "yml", "zip",
]
#: Chinese and Japanese conjunctions that go on with a sentence after an ellipsis.
GOING_ON = "但|却|而|可是|不过|然而|并且|所以|因此|可见|でも|だが|けれど|しかし"

_CJK = r"\x{3005}-\x{3007}\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{2ffff}"
_LATIN_MARKS, _CJK_MARKS, _OTHER_MARKS = r".!?…", r"。！？｡．", r"؟।॥۔"
_MARKS = _LATIN_MARKS + _CJK_MARKS + _OTHER_MARKS
_LATIN_SHUT = r"(?:[\"”“’'\)\]]|[ \n]?»)"
_CJK_SHUT = r"[」』”）】》\"\)]"
_PAIRS = [("„", "“”"), ("“", "”"), ("«", "»"), ("「", "」"), ("『", "』"), (r"\(", r"\)"), ("（", "）"), (r"\[", r"\]"), ("【", "】")]
#: Blanks other than space, tab and newline; they become spaces.
_BLANKS = "\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_LIST = r"(?:[-*+•‣–]|\d{1,3}[.)])[ \t]"

_HEADED = r"(?s)^((?:commit [0-9a-f]{7,}|From [0-9a-f]{7,} |# HG changeset patch|r[0-9]+ \|).*?\n[ \t]*\n)"
_HEADER = r"^(?:commit [0-9a-f]{7,}|From [0-9a-f]{7,} |# HG changeset patch|r[0-9]+ \|)"
_DIFF = r"(?md)^(?:diff --git |Index: |--- *$)"
_TRAILERS = r"(?:(?:^|\n)[ \t]*\n(?:[ \t]*[A-Z][A-Za-z]*+(?:-[A-Za-z]+)*+:[ \t][^\n]*+(?:\n|\z))++)+\s*\z"


def _alternatives(words: list[str]) -> str:
    return "|".join(w.replace(".", r"\.") for w in sorted(words, key=lambda w: (-len(w), w)))


def _subbed(m: Column, pattern: str, to: str, only: str | None = None) -> Column:
    """``pattern`` replaced; where ``only`` is given, in messages that contain it."""
    if only is None:
        return F.regexp_replace(m, pattern, to)
    return F.get(F.transform(F.array(m), lambda x: F.when(F.contains(x, F.lit(only)), F.regexp_replace(x, pattern, to)).otherwise(x)), F.lit(0))


def masked(m: Column) -> Column:
    """The message with placeholders, of the same length. Patterns begin at the mark, so that other characters cost one test."""

    def sub(pattern: str, to: str = MASK, only: str | None = None) -> None:
        nonlocal m
        m = _subbed(m, pattern, to, only)

    start = r"(?<![\p{L}\p{M}\p{N}_])"
    # Units.
    sub(r"\A(\s*+[^\n]++)\n", f"$1{UNIT}")
    sub(r"\n(?=[ \t]*\n)", UNIT)
    sub(rf"((?:\G(?!\A)|(?<=\x{{e000}})|\A)[ \t\n]*+{_LIST}[^\x{{e000}}\n]*+(?:\n(?![ \t]*+{_LIST})[^\x{{e000}}\n]*+)*+)\n(?=[ \t]*+{_LIST})", f"$1{UNIT}")
    sub(r"((?:\A|\x{e000})[ \t\n]*+\d{1,3})\.(?=[ \t])", f"$1{MASK}")
    # Addresses, decimals, versions.
    sub(r"((?:\G(?!\A)|(?<![\w/])(?:https?|ftp)://)[^\s.!?<>\"]*+)[.!?](?=[^\s<>\"])", f"$1{MASK}", "://")
    sub(r"\.(?=\d)(?<=\d\.)")
    # Abbreviations and initials.
    sub(r"\.(?:" + "|".join(rf"(?=\s*{b}\.)(?<={start}{a}\.)" for a, b in PARTS + OPEN_PARTS) + ")")
    sub(r"\.(?:" + "|".join(rf"(?<={start}{a}\x{{e001}}\s{{0,40}}{b}\.)" for a, b in PARTS) + ")", MASK, MASK)
    sub(rf"\.(?:(?=g\.)(?<={start}e\.)|(?=e\.)(?<={start}i\.)|(?<={start}e\x{{e001}}g\.)|(?<={start}i\x{{e001}}e\.))")
    sub(rf"\.(?:(?<={start}e\x{{e001}}g\.)|(?<={start}i\x{{e001}}e\.))", MASK, MASK)
    sub(rf"\.(?=\s)(?<={start}(?:{_alternatives(ABBREVIATIONS)})\.)")
    sub(rf"\.(?=\s*\p{{N}})(?<={start}(?:{_alternatives(BEFORE_NUMBER)})\.)")
    sub(rf"\.(?=\s*+\p{{Lu}})(?<={start}\p{{Lu}}\.)")
    sub(rf"\.(?=\s+(?:{GERMAN_MONTHS}))(?<=(?<![\p{{L}}\p{{N}}_.])\d{{1,2}}\.)")
    sub(rf"\.(?=\s+\p{{Lu}})(?<={start}(?:{GERMAN_BEFORE_ORDINAL})\s{{1,40}}\d{{1,3}}\.)")
    # Marks before a closing sign, then the other marks within pairs.
    sub(rf"[{_LATIN_MARKS}{_OTHER_MARKS}](?:(?={_LATIN_SHUT})(?!\"[\w(])|(?=\"[{_CJK}A-Za-z0-9_/.]*[{_CJK}]))", SHUT)
    sub(rf"[{_CJK_MARKS}](?={_CJK_SHUT})", SHUT_CJK)
    for opening, closing in _PAIRS:
        sub(rf"((?:\G(?!\A)|{opening})[^{closing}\x{{e000}}{_MARKS}]*+)[{_MARKS}](?=[^{closing}\x{{e000}}]*+[{closing}])", f"$1{MASK}", opening[-1])
    sub(rf"((?:\G(?!\A)|(?<![\p{{L}}\p{{N}}\x{{e002}}\x{{e003}}])\"(?=\S))[^\"\x{{e000}}{_MARKS}]*+)[{_MARKS}](?=[^\"\x{{e000}}]*+\")", f"$1{MASK}", '"')
    return m


def broken(m: Column) -> Column:
    """The masked message with a BREAK put in wherever one sentence ends and another begins, by script."""

    def sub(pattern: str, only: str | None = None) -> None:
        nonlocal m
        m = _subbed(m, pattern, f"$1{BREAK}", only)

    plain = rf"\p{{Ll}}[\p{{Ll}}\p{{M}}'’]*+(?![\p{{L}}\p{{N}}_/]|[.\-][\p{{L}}&&[^{_CJK}]])"  # a word in lower case that isn't a name in code
    name = rf"(?!(?:{"|".join(EXTENSIONS)})(?![A-Za-z0-9_]))[A-Za-z_][A-Za-z0-9_/.\-]*+(?=[{_CJK}])"
    more = rf"[{_MARKS}」』”）】》\"\)\]»\x{{e002}}\x{{e003}}]"
    thai = r"\x{e00}-\x{e7f}"
    shut = rf"(?:{_LATIN_SHUT}){{0,3}}"
    closed = rf"\x{{e002}}(?:{_LATIN_SHUT}){{1,3}}"
    # Latin, Cyrillic, Devanagari, Arabic: a mark, closing signs, blanks. After a full stop or an ellipsis no plain word in lower case begins a sentence.
    sub(rf"([.…]{shut}|{closed})(?=\s++(?!{plain})(?!(?<=…\s{{1,40}})(?:{GOING_ON}))[^\s{_MARKS}])")
    sub(rf"([!?{_OTHER_MARKS}]{shut})(?=\s++[^\s{_MARKS}»])")
    # Chinese and Japanese: a mark, closing signs.
    sub(rf"([{_CJK_MARKS}]{_CJK_SHUT}{{0,3}})(?!{more}|[0-9０-９])(?=\s*+\S)")
    sub(rf"(…)(?=[{_CJK}“「（]|{name})(?!{GOING_ON})")
    # Latin marks with a Chinese or Japanese sentence right after them.
    sub(rf"([.!?…]{shut}|{closed})(?=[{_CJK}「『（]|“[{_CJK}]|{name})(?!(?<=…)(?:{GOING_ON}))")
    # Closed quotes and brackets that end a sentence: speech after a colon; a bracket that no particle precedes.
    sub(rf"([：:]\s?“[^“”]*+(?<=\x{{e003}})”)(?!\s*+{more})(?=\s*+\S)", "“")
    sub(rf"((?:\A|[^をはがにでのともへや、])（[^（）]*+(?<=\x{{e003}})）)(?!\s*+{more})(?=\s*+\S)", "（")
    # Thai writes without blanks but between sentences.
    sub(rf"([{thai}][^\s\x{{e000}}{thai}]*+)(?=\s++[^\s\x{{e000}}])")
    return m


_BLOCK = 32


def _offsets(lengths: str) -> tuple[str, str]:
    """SQL: the sums of the blocks of array column ``lengths``, and with those (as _base) the running sum before each element."""
    n = f"size({lengths})"
    block = f"transform(sequence(0, ({n} - 1) div {_BLOCK}), k -> aggregate(slice({lengths}, k * {_BLOCK} + 1, {_BLOCK}), 0, (a, x) -> a + x))"
    return block, (
        f"transform(sequence(0, {n} - 1), i -> _base[i div {_BLOCK}] + aggregate(slice({lengths}, (i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK}), 0, (a, x) -> a + x))"
    )


def _computed(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """``columns`` computed once: the optimizer doesn't merge expressions across a generator, which would evaluate them again at every use."""
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(made)))


def message(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, _at (code points before the message), _m (the message, line ends as blanks, without trailers)."""
    t = F.translate(F.col(text), _BLANKS + UNIT + MASK + SHUT + SHUT_CJK + BREAK, " " * len(_BLANKS) + "\ufffd" * 5)
    d = _computed(df, key, _t=t)
    d = _computed(d, key, "_t", _headed=F.col("_t").rlike(_HEADER), _head=F.regexp_extract("_t", _HEADED, 1))
    body = F.when(F.col("_headed") & (F.col("_head") == ""), F.lit("")).otherwise(F.substr(F.col("_t"), F.length("_head") + 1))
    cut = F.get(F.split(body, _DIFF, 2), F.lit(0))
    return _computed(d, key, _at=F.length("_head"), _m=F.regexp_replace(cut, _TRAILERS, ""))


def split(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, start_char, end_char: one row per sentence."""
    d = message(df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(F.col("_text").isNotNull()), "_key", "_text")
    d = d.where(F.col("_m").rlike(r"[\p{L}\p{N}]"))
    d = _computed(d, "_key", "_at", _x=masked(F.col("_m")))
    d = _computed(d, "_key", "_at", _p=F.split(broken(F.col("_x")), rf"{BREAK}|(?={UNIT})"))
    block, each = _offsets("_len")
    d = _computed(d, "_key", "_at", "_p", _len=F.transform("_p", F.length))
    d = _computed(d, "_key", "_at", "_p", "_len", _block=F.expr(block))
    d = _computed(d, "_key", "_at", "_p", "_len", _base=F.expr("transform(sequence(0, size(_block) - 1), k -> aggregate(slice(_block, 1, k), 0, (a, x) -> a + x))"))
    d = d.select("_key", "_at", F.inline(F.arrays_zip("_p", F.expr(each).alias("_off"))))
    d = d.select("_key", (F.col("_at") + F.col("_off")).alias("_o"), "_p")
    lead = F.length(F.regexp_extract("_p", r"\A(?:\x{e000}\s*+(?:(?:[-*+•‣–]|\d{1,3}(?:\x{e001}|\)))(?=[ \t]|\z))?+)?+[\x{e000}\s]*+", 0))
    kept = F.length(F.regexp_replace("_p", r"\s+\z", ""))
    d = d.where(F.col("_p").rlike(r"[\p{L}\p{N}]")).select(F.col("_key").alias(key), (F.col("_o") + lead).cast("int").alias("start_char"), (F.col("_o") + kept).cast("int").alias("end_char"))
    return d.where(F.col("end_char") > F.col("start_char"))
