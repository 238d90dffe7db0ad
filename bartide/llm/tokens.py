"""Encoding a corpus with a public byte-level tokenizer.

Method: the corpus' frequent words are compiled with their ids into a minimal acyclic
transducer (an automaton with shared prefixes and suffixes whose arc outputs add up to
the word's number, which leads to its ids). It is written once, on whichever file system
the shared folder is, memory-mapped by every worker, and walked for all distinct words of a batch at once; words that it lacks are
merged exactly, pair by pair in order of rank. Ids are the tokenizer's own: the lexicon
only saves work.

The text is cut into words by classes of code points, in numpy over the UTF-8 bytes of
a whole batch, by the rules of the tokenizer's splitting pattern (letters, digits,
other marks, each with at most one space before; blanks; English contractions).

Defined results: null and empty texts give an empty list; strings of special tokens in
a text are ordinary text; very long texts are encoded whole; an empty corpus gives an
empty lexicon and no rows.
"""

from __future__ import annotations

import base64
import os
import sys
import tempfile
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bartide.session import work_path
from bartide.sources import files

#: Parameters: words in the lexicon; where the vocabulary files lie.
LEXICON_WORDS = 65_536
VOCABULARY = "byte_bpe_50k.tiktoken"
LETTER, DIGIT, BLANK, OTHER = 1, 2, 3, 0
BYTES_AT_ONCE = 16 << 20
SHIPPED = "shipped:"


def vocabulary_path(name: str = VOCABULARY, folder: str = "/opt/tokenizers") -> str:
    return os.path.join(folder, name)


def _held(kind: str, name: str, make):
    """``make()`` once per worker process and kind; functions travel by value, so their globals can't keep it."""
    keeper = sys.modules.setdefault("_bartide_held", types.ModuleType("_bartide_held")).__dict__
    if keeper.get(kind, (None,))[0] != name:
        keeper[kind] = (name, make())
    return keeper[kind][1]


def _make_classes() -> np.ndarray:
    import regex

    table = np.zeros(0x110000, np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    where = np.r_[0:0xD800, 0xE000:0x110000]
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (BLANK, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, text):
            table[where[m.start() : m.end()]] = kind
    return table


def _classes() -> np.ndarray:
    """The class of every code point."""
    return _held("classes", "", _make_classes)


def words(data: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Starts of the words in UTF-8 ``data``; ``docs``: offsets of the documents, one more than there are."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    table = _classes()
    kind = table[:256].copy()
    kind[128:] = OTHER
    kind = kind[data]
    wide = np.flatnonzero(data >= 0xC0)
    lead_of_wide = None
    if len(wide):
        b = [data[np.minimum(wide + k, n - 1)].astype(np.int64) & 0x3F for k in range(4)]
        two, three = data[wide] < 0xE0, data[wide] < 0xF0
        code = np.where(two, (data[wide] & 0x1F).astype(np.int64) << 6 | b[1], np.where(three, (data[wide] & 0x0F).astype(np.int64) << 12 | b[1] << 6 | b[2], (data[wide] & 0x07).astype(np.int64) << 18 | b[1] << 12 | b[2] << 6 | b[3]))
        of = table[np.minimum(code, 0x10FFFF)]
        kind[wide] = of
        for k, more in ((1, None), (2, ~two), (3, ~three)):
            at = wide + k if more is None else wide[more] + k
            kind[at[at < n]] = (of if more is None else of[more])[at < n]
        lead_of_wide = wide
    start = np.empty(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start[0] = start[n] = True
    first = np.zeros(n + 1, bool)
    first[docs] = True
    start |= first
    # Blanks before a word: all but the last are one word; the last, if a space, belongs to the next word.
    ends = np.flatnonzero(start[1:] & (kind == BLANK)) + 1  # one past a run of blanks
    ends = ends[~first[ends]]
    last = ends - 1
    if lead_of_wide is not None and len(last):
        cont = (data[last] & 0xC0) == 0x80
        at = np.searchsorted(lead_of_wide, last[cont], side="right") - 1
        last[cont] = lead_of_wide[at]
    start[last] = True
    start[ends[data[last] == 0x20]] = False
    # Contractions.
    mark = np.flatnonzero((data == 0x27) & start[:n])
    mark = mark[mark + 1 < n]
    mark = mark[(kind[mark + 1] == LETTER) & ~first[mark + 1]]
    if len(mark):
        a, z = data[mark + 1], data[np.minimum(mark + 2, n - 1)]
        z = np.where((mark + 2 < n) & ~first[np.minimum(mark + 2, n)], z, 0)
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        both = ((a == 0x72) | (a == 0x76)) & (z == 0x65) | (a == 0x6C) & (z == 0x6C)
        for hit, length in ((mark[one], 2), (mark[both], 3)):
            start[hit + 1] = False
            start[hit + length] = True
    return np.flatnonzero(start[:n])


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of pieces of a text column, whole documents of about BYTES_AT_ONCE bytes."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BYTES_AT_ONCE, side="right")) - 1)
        yield i, j - i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def _encoded(data: np.ndarray, starts: np.ndarray) -> pa.DictionaryArray:
    """The words as codes into their distinct values."""
    bounds = np.append(starts, len(data)).astype(np.int64)
    array = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
    return array.dictionary_encode()


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """word (bytes), n: over the whole corpus; counted in each task before the shuffle."""

    def run(batches):
        seen: list[pa.Table] = []

        def merged() -> pa.Table:
            t = pa.concat_tables(seen).group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": t["word"], "n": t["n_sum"]})

        for batch in batches:
            for _, _, data, docs in _texts(batch.column(0)):
                d = _encoded(data, words(data, docs))
                n = np.bincount(d.indices.to_numpy(), minlength=len(d.dictionary)).astype(np.int64)
                seen.append(pa.table({"word": d.dictionary.cast(pa.binary()), "n": n}))
            if len(seen) > 8:
                seen[:] = [merged()]
        if seen:
            yield from merged().combine_chunks().to_batches(max_chunksize=50_000)

    return df.select(text).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Transducer:
    """A minimal acyclic transducer over bytes: word to its number in order, by added arc outputs."""

    def __init__(self, keys, targets, outputs, final, root):
        self.keys, self.targets, self.outputs, self.final, self.root = keys, targets, outputs, final, root

    @classmethod
    def build(cls, ordered: list[bytes]) -> "Transducer":
        """``ordered``: distinct non-empty words in byte order."""
        register: dict[tuple, int] = {}
        arcs: list[tuple] = []  # by state: (final, ((byte, target), ...))

        def fixed(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in register:
                register[key] = len(arcs)
                arcs.append(key)
            return register[key]

        path: list[list] = [[False, []]]
        before = b""

        def fold(depth: int) -> None:
            while len(path) - 1 > depth:
                node = path.pop()
                path[-1][1].append((before[len(path) - 1], fixed(node)))

        for word in ordered:
            common = len(os.path.commonprefix((before, word)))
            fold(common)
            before = word
            path += [[False, []] for _ in range(len(word) - common)]
            path[-1][0] = True
        fold(0)
        root = fixed(path[0])
        below = [0] * len(arcs)  # words that end at or after a state; targets come before their sources
        for s, (final, out) in enumerate(arcs):
            below[s] = int(final) + sum(below[t] for _, t in out)
        keys, targets, outputs = [], [], []
        for s, (final, out) in enumerate(arcs):
            passed = int(final)
            for b, t in out:
                keys.append(s * 256 + b)
                targets.append(t)
                outputs.append(passed)
                passed += below[t]
        return cls(np.array(keys, np.int64), np.array(targets, np.int64), np.array(outputs, np.int64), np.array([f for f, _ in arcs], bool), root)

    def numbers(self, array: pa.Array) -> np.ndarray:
        """The number of each word of a large_binary array, or -1."""
        offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
        data = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] is not None else np.zeros(0, np.uint8)
        number = np.full(len(array), -1, np.int64)
        if not len(self.keys):
            return number
        live, state, total, step = np.arange(len(array)), np.full(len(array), self.root), np.zeros(len(array), np.int64), 0
        length = np.diff(offsets)
        while len(live):
            done = length[live] == step
            ended = done & self.final[state]
            number[live[ended]] = total[ended]
            live, state, total = live[~done], state[~done], total[~done]
            key = state * 256 + data[offsets[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            live, at = live[hit], at[hit]
            state, total = self.targets[at], total[hit] + self.outputs[at]
            step += 1
        return number


class Merger:
    """Exact merges of one word: the pair of least rank first, as the vocabulary defines."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.core = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def __call__(self, word: bytes) -> list[int]:
        return self.core.encode_single_piece(word)


def _merger(path: str) -> Merger:
    return _held("merger", path, lambda: Merger(path))


class Lexicon:
    """A transducer with the ids of its words, as memory-mapped arrays in one folder."""

    PARTS = ("keys", "targets", "outputs", "final", "root", "starts", "ids")

    def __init__(self, folder: str):
        at = (lambda p: SparkFiles.get(f"{folder[len(SHIPPED):]}-{p}.npy")) if folder.startswith(SHIPPED) else (lambda p: os.path.join(folder, f"{p}.npy"))
        part = {p: np.load(at(p), mmap_mode="r") for p in self.PARTS}
        self.transducer = Transducer(part["keys"], part["targets"], part["outputs"], part["final"], int(part["root"][0]))
        self.starts, self.ids = part["starts"], part["ids"]

    @staticmethod
    def write(folder: str, ordered: list[bytes], vocabulary: str) -> None:
        os.makedirs(folder, exist_ok=True)
        t, merge = Transducer.build(ordered), _merger(vocabulary)
        ids = [merge(w) for w in ordered]
        arrays = {
            "keys": t.keys, "targets": t.targets, "outputs": t.outputs, "final": t.final, "root": np.array([t.root]),
            "starts": np.cumsum([0, *map(len, ids)]), "ids": np.array([i for x in ids for i in x], np.int32),
        }
        for name, a in arrays.items():
            np.save(os.path.join(folder, f"{name}.npy"), a)

    @staticmethod
    def opened(folder: str) -> "Lexicon":
        return _held("lexicon", folder, lambda: Lexicon(folder))


def compile_lexicon(df: DataFrame, text: str, vocabulary: str | None = None, size: int = LEXICON_WORDS, mounted: bool | None = None) -> str:
    """Count the words of the whole corpus, compile the ``size`` most frequent (ties by bytes), return the lexicon's name.

    Where the shared folder is ``mounted`` (by default if it is no URL but of files), workers map it there. Else (object stores,
    HDFS) it is copied to the shared folder and Spark ships it from there to each executor once, which maps its own copy."""
    frequent = word_counts(df, text).orderBy(F.desc("n"), "word").limit(size).select("word").toArrow()["word"].to_pylist()
    spark, path = df.sparkSession, work_path(df.sparkSession, "lexicon")
    local = "/" + path.removeprefix("file:").lstrip("/") if path.startswith(("file:", "/")) else None
    if mounted is None:
        mounted = local is not None
    if mounted:
        Lexicon.write(local, sorted(frequent), vocabulary or vocabulary_path())
        return local
    name = path.rsplit("/", 1)[1]
    with tempfile.TemporaryDirectory() as made:  # on the driver only, until it is copied
        Lexicon.write(made, sorted(frequent), vocabulary or vocabulary_path())
        for part in Lexicon.PARTS:
            at = f"{path}/{name}-{part}.npy"
            files.upload(spark, os.path.join(made, f"{part}.npy"), at)
            spark.sparkContext.addFile(at)
    return SHIPPED + name


def _ids(unique: pa.Array, lexicon: Lexicon | None, merge: Merger) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each distinct word, one after another, and their starts."""
    number = lexicon.transducer.numbers(unique) if lexicon else np.full(len(unique), -1, np.int64)
    unseen = np.flatnonzero(number < 0)
    merged = [merge(w) for w in unique.take(pa.array(unseen)).to_pylist()]
    length = np.zeros(len(unique), np.int64)
    length[unseen] = list(map(len, merged))
    seen = number >= 0
    known = number[seen]
    begin = np.zeros(len(unique), np.int64)
    if lexicon:
        length[seen] = lexicon.starts[known + 1] - lexicon.starts[known]
        begin[seen] = lexicon.starts[known]
    starts = np.append(0, np.cumsum(length))
    ids = np.empty(starts[-1], np.int32)
    if seen.any():
        at = np.flatnonzero(seen)
        ids[_ranges(starts[at], length[at])] = lexicon.ids[_ranges(begin[at], length[at])]
    if len(unseen):
        ids[_ranges(starts[unseen], length[unseen])] = [i for x in merged for i in x]
    return ids, starts


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, ... length[0] of them, then those of the next."""
    total = int(length.sum())
    return np.repeat(begin - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(total)


def _encode_batches(vocabulary: str, lexicon: str | None, counts_only: bool):
    def run(batches):
        merge = _merger(vocabulary)
        lex = Lexicon.opened(lexicon) if lexicon else None
        for batch in batches:
            for first, rows, data, docs in _texts(batch.column(1)):
                starts = words(data, docs)
                coded = _encoded(data, starts)
                code = coded.indices.to_numpy()
                ids, at = _ids(coded.dictionary, lex, merge)
                length = np.diff(at)
                per_word = length[code]
                ends = np.append(0, np.cumsum(per_word))[np.searchsorted(starts, docs)]
                key = batch.column(0).slice(first, rows)
                if counts_only:
                    yield pa.record_batch([key, pa.array(np.diff(ends))], names=["key", "n"])
                else:
                    values = ids[_ranges(at[:-1][code], per_word)]
                    yield pa.record_batch([key, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))], names=["key", "ids"])

    return run


def encode(df: DataFrame, key: str, text: str, vocabulary: str | None = None, lexicon: str | None = None) -> DataFrame:
    """``key`` and ids, one row for each row of ``df``."""
    lexicon = lexicon or compile_lexicon(df, text, vocabulary)
    kind = dict(df.dtypes)[key]
    out = df.select(key, text).mapInArrow(_encode_batches(vocabulary or vocabulary_path(), lexicon, False), f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", key)


def sizes(df: DataFrame, key: str, text: str, out: str = "n_tokens", vocabulary: str | None = None, lexicon: str | None = None) -> DataFrame:
    """``key`` and the number of tokens; without a lexicon every distinct word of a batch is merged."""
    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(_encode_batches(vocabulary or vocabulary_path(), lexicon, True), f"key {kind}, n long").toDF(key, out)
