"""Byte-level BPE encoding and decoding with Spark higher-order functions.

Encoding folds ranked merges over the byte array of a word: the state of the
fold is the list of pieces and the list of ranks of neighbouring pairs; each
step joins the leftmost pair of lowest rank. Ranks come from a literal map
(hash buckets, so a lookup costs the same for any vocabulary).

Plan. One pass counts the distinct words of the whole corpus, with the
partitions they occur in (partial counts per task, then one exchange of distinct
words, sorted and added up), and the fold encodes each of at most 64 bytes once. The most frequent, at
most ``dictionary_words`` (a fixed bound), are written in one folder that all tasks
read, so that the driver never holds them; the others in one folder a partition of the
documents. A second pass looks up each word of a
document in the shared folder and in its partition's; words in neither (longer
ones, or all if the second scan is partitioned in another way) are encoded by the
same fold inside their own row. So no text and no word occurrence is ever shuffled,
a task holds the words of its own partition, and the result depends neither on the
bound nor on the partitions. The ids of looked up words stay packed beside the fold
and are put together with its ids afterwards.

Defined results: a null text is an empty text; an empty text has no tokens,
the hash of no bytes, and decodes to no bytes. Repeated rows are encoded row by
row; null ids stay null. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs, parquet
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import written
from tickweave.llm.warc import _opened
from tickweave.session import scratch_path

BUCKETS = 16_384
DICTIONARY_WORDS = 300_000  # read by every task
# Bytes of the longest word of the dictionary: words and ids (one a byte at most,
# 4 bytes each) are bounded by 300,000 x 64 x 5 bytes, 96 MB, whatever the texts.
DICTIONARY_WORD_BYTES = 64
LONG_WORD = 64  # bytes; longer words are merged rank by rank, all places at once


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _no_pieces() -> Column:
    return F.array().cast("array<binary>")


class Bpe:
    """Column expressions for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for {len(missing)} of the 256 bytes")
        self.ranks, self.pattern = ranks, pattern
        self.none = max(ranks.values()) + 1  # more than any rank
        self.width, self.bits = len(str(self.none)), self.none.bit_length()
        if 2 * self.bits + 14 > 62:
            raise ValueError("the ranks are too large: the fold packs a rank, an id and a place into one number")
        # A bucket is one string: the answer for "not found", then ",BASE64=rank" a token.
        buckets = [f"{self.none}"] * BUCKETS
        for token, rank in ranks.items():
            buckets[zlib.crc32(token) % BUCKETS] += f",{base64.b64encode(token).decode()}={rank:0{self.width}d}"
        # from_json of a literal is folded to a literal array by the optimiser; of
        # bytes, since plans print them short
        packed = [base64.b64encode(b.encode()).decode() for b in buckets]
        self._map = F.from_json(F.lit(json.dumps(packed)), "array<binary>")

    def rank_of(self, key: Column) -> Column:
        """The rank of a byte string; ``none`` if there is none."""
        return F.substring(F.call_function(
            "substring_index", F.get(self._map, (F.crc32(key) % BUCKETS).cast("int")).cast("string"), F.concat(F.lit(","), F.base64(key), F.lit("=")),
            F.lit(-1)), 1, self.width).cast("int")

    def rank(self, keys: Column) -> Column:
        """Ranks of an array of byte strings; ``none`` where there is none."""
        return F.transform(keys, self.rank_of)

    def _state(self, pieces: Column, ranks: Column) -> Column:
        """Pieces, ranks of neighbouring pairs, and the place (from 1) of the
        leftmost pair of lowest rank, 0 if no pair can be joined."""
        return _let(ranks, lambda r: F.struct(pieces.alias("p"), r.alias("r"), F.array_position(
            r, F.least(F.array_min(r), F.lit(self.none - 1))).cast("int").alias("i")))

    def _start(self, word: Column) -> Column:
        n = F.octet_length(word)
        pieces = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(word, i, F.lit(1)))
        pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(word, i, F.lit(2)))
        return self._state(pieces, self.rank(F.when(n > 1, pairs).otherwise(_no_pieces())))

    def _packed_start(self, word: Column) -> Column:
        """The bytes of a word of at most LONG_WORD, each as one number: the rank of the
        pair that the piece begins, its place from 1, its length, and its id + 1 if it
        was joined (0 for a byte). The least number is the leftmost pair of lowest rank."""
        n, one, two = F.octet_length(word), F.lit(1 << self.bits), F.lit(1 << 7 + self.bits).cast("long")
        pairs = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(word, i, F.lit(2)))
        return F.transform(pairs, lambda pair, i: self._number(F.when(i + 1 < n, self.rank_of(pair)).otherwise(self.none), two * (i + 1) + one))

    def _number(self, rank: Column, place: Column) -> Column:
        return F.shiftleft(rank.cast("long"), 14 + self.bits) + place

    def _place(self, number: Column) -> tuple[Column, Column]:
        return (F.shiftright(number, 7 + self.bits).bitwiseAND(F.lit(127)).cast("int"),
                F.shiftright(number, self.bits).bitwiseAND(F.lit(127)).cast("int"))

    def _merge_one(self, a: Column, word: Column) -> Column:
        """The numbers after joining the leftmost pair of lowest rank; the same
        if no pair can be joined."""
        ranks = 14 + self.bits

        def start(x: Column) -> Column:
            return self._place(x)[0]

        def length(x: Column) -> Column:
            return self._place(x)[1]

        def joined(m: Column, i: Column) -> Column:
            n, before, after = length(m) + length(F.get(a, i)), F.get(a, i - 2), F.get(a, i + 1)
            left, new = F.substring(word, start(before), length(before) + n), F.substring(word, start(m), n + length(after))
            # the rank of a pair is the id of what it makes
            own = m.bitwiseAND(F.lit(127 << 7 + self.bits)) + F.shiftleft(n.cast("long"), self.bits) + F.shiftright(m, ranks) + 1
            places = [before.bitwiseAND(F.lit((1 << ranks) - 1)), own]
            changed = F.zip_with(
                F.when(i > 1, F.array(left, new)).otherwise(F.array(new)), F.when(i > 1, F.array(*places)).otherwise(F.array(places[1])),
                lambda key, place: self._number(F.coalesce(self.rank_of(key), F.lit(self.none)), place))
            return F.concat(F.slice(a, F.lit(1), F.greatest(i - 2, F.lit(0))), changed, F.slice(a, i + 2, F.size(a)))

        return _let(F.array_min(a), lambda m: F.when(m >= F.lit(self.none << ranks), a).otherwise(
            _let(F.array_position(a, m).cast("int"), lambda i: joined(m, i))))

    def _merge_all(self, s: Column) -> Column:
        """The state after joining every pair of the lowest rank, left to right
        without overlap (in a run of such pairs, every second one)."""
        p, r = s["p"], s["r"]
        text = F.array_join(F.transform(r, lambda x: F.when(x == F.get(r, s["i"] - 1), F.lit("1")).otherwise(F.lit("0"))), "")
        flags = F.split(F.regexp_replace(text, "11", "10"), "")  # '1' where a pair begins

        def joined(f: Column) -> Column:
            pieces = F.transform(p, lambda x, k: F.when(F.get(f, k) == "1", F.concat(x, F.get(p, k + 1)))
                                 .when(F.coalesce(F.get(f, k - 1), F.lit("0")) == "1", F.lit(None)).otherwise(x))
            return _let(F.filter(pieces, lambda x: x.isNotNull()), lambda q: self._state(q, self.rank(
                F.transform(F.slice(q, F.lit(1), F.size(q) - 1), lambda x, k: F.concat(x, F.get(q, k + 1))))))

        return _let(flags, joined)

    def _steps(self, word: Column) -> Column:
        return F.sequence(F.lit(1), F.greatest(F.octet_length(word) - 1, F.lit(1)))

    def encode_short(self, word: Column) -> Column:
        """``encode_word`` of a word of 1 to LONG_WORD bytes."""
        packed = F.aggregate(self._steps(word), self._packed_start(word), lambda a, _: self._merge_one(a, word))
        mask = F.lit((1 << self.bits) - 1)
        return F.transform(packed, lambda x: F.when(x.bitwiseAND(mask) > 0, (x.bitwiseAND(mask) - 1).cast("int")).otherwise(
            self.rank_of(F.substring(word, self._place(x)[0], F.lit(1)))))

    def encode_word(self, word: Column) -> Column:
        """Token ids (array<int>) of one pre-token given as bytes. A pre-token that
        is a token itself is for the caller to look up."""
        n = F.octet_length(word)
        state = F.aggregate(self._steps(word), self._start(word), lambda s, _: F.when(s["i"] == 0, s).otherwise(self._merge_all(s)))
        return F.when(n == 0, F.array().cast("array<int>")).when(n <= LONG_WORD, self.encode_short(word)).otherwise(self.rank(state["p"]))

    # ------------------------------------------------------------- documents
    def words(self, docs: DataFrame, text: str) -> DataFrame:
        """(word, n, parts, ids) of all pre-tokens of at most DICTIONARY_WORD_BYTES of
        all texts, written: how often they occur, in which partitions of ``docs``, and
        what the fold makes of them."""
        pattern = self.pattern

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find, part = finder(pattern), TaskContext.get().partitionId()

            def out(seen: Counter) -> Iterator[pa.RecordBatch]:
                held = ((w, n) for w, n in ((w.encode(), n) for w, n in seen.items()) if len(w) <= DICTIONARY_WORD_BYTES)
                while some := list(islice(held, DICTIONARY_ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64()),
                                                      pa.array([part] * len(some), pa.int32())], ["word", "n", "part"])

            seen = Counter()
            for texts in held_texts(batches):
                for space, run, n in run_counts(texts, pattern):
                    if space and run.isalpha():
                        seen[f" {run}"] += n
                    elif space and run[-1:] in TAILS and run[:-1].isalpha():
                        seen[f" {run[:-1]}"] += n
                        seen[run[-1]] += n
                    else:
                        for w in find(space + run):
                            seen[w] += n
                if len(seen) > HELD_WORDS:  # partial counts; Spark adds them up
                    yield from out(seen)
                    seen = Counter()
            yield from out(seen)
            pa.default_memory_pool().release_unused()  # the process lives on

        counts = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(count, "word binary, n long, part int")
        sorted_counts = counts.repartition("word").sortWithinPartitions("word", "part")
        words = sorted_counts.mapInArrow(added_up, "word binary, n long, parts array<int>")
        return written(words.withColumn("ids", self.encode_short(F.col("word"))), "bpe-words")

    def dictionary(self, docs: DataFrame, text: str, size: int) -> bytes:
        """The most frequent words, at most ``size``, of at most DICTIONARY_WORD_BYTES
        with their ids, encoded by the fold, and the tokens that are text with their
        own id, as one Arrow file."""
        words = self.words(docs, text)
        return self._packed(words.filter(F.col("n") > rare_count(words, size)))

    def _packed(self, words: DataFrame) -> bytes:
        return _arrow_file(words.select("word", "ids").toArrow(), self._own())  # a token is never cut further

    def _own(self) -> pa.Table:
        """The tokens that are text, and found whole, with their own id."""
        find = finder(self.pattern)
        whole = sorted((t, r) for t, r in self.ranks.items() if _is_text(t) and find(t.decode()) == [t.decode()])
        return pa.table([pa.array([t for t, _ in whole], pa.binary()), pa.array([[r] for _, r in whole], pa.list_(pa.int32()))], ["word", "ids"])

    def _folded(self, docs: DataFrame, text: str, dictionary_words: int) -> DataFrame:
        """``docs`` with ``__bpe_known`` and ``__bpe_rare``, of which ``put_together``
        makes the ids."""
        spark, pattern = docs.sparkSession, self.pattern
        words = self.words(docs, text)
        rare_n, folder, shared = rare_count(words, dictionary_words), scratch_path(spark, "bpe-rare"), scratch_path(spark, "bpe-shared")
        # the most frequent first: they lie together in the tasks' memory, and are found faster
        often = words.filter(F.col("n") > rare_n).repartition(1).sortWithinPartitions(F.desc("n"))
        often.select("word", "ids").write.parquet(shared)
        others = words.filter(F.col("n") <= rare_n).select("word", "ids", F.explode("parts").alias("part"))
        others.repartition("part").write.partitionBy("part").parquet(folder)
        own = spark.sparkContext.broadcast(_arrow_file(self._own()))
        place = docs.columns.index(text)

        def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find, cut, (bare, spaced) = finder(pattern), cutter(pattern), known_words([f"{folder}/part={TaskContext.get().partitionId()}", shared], own.value)
            most = len(spaced) + KEPT_RUNS
            for b in batches:
                for i in range(0, b.num_rows, PIECE_ROWS):
                    part = b.slice(i, PIECE_ROWS)
                    found = split_words(part.column(place), bare, spaced, find, cut, most)
                    yield pa.RecordBatch.from_arrays([*part.columns, *found], [*part.schema.names, KNOWN, "__bpe_words"])

        fields = T.StructType().add("ids", T.BinaryType()).add("cuts", T.ArrayType(T.IntegerType()))
        both = docs.withColumn(text, F.col(text).cast("string"))
        both = both.mapInArrow(pieces, T.StructType([*both.schema.fields]).add(KNOWN, fields).add("__bpe_words", T.ArrayType(T.BinaryType())))
        each = F.transform("__bpe_words", self.encode_word)
        rare = _let(each, lambda x: F.struct(F.flatten(x).alias("ids"), F.transform(x, lambda i: F.size(i)).alias("sizes")))
        return both.withColumn(RARE, rare).drop("__bpe_words")

    def encode(self, docs: DataFrame, text: str = "text", out: str = "ids", dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
        """``docs`` with a column ``out``: the token ids (array<int>) of the whole
        text, as the public tokenizer library gives them without special tokens."""

        rows = self._folded(docs, text, dictionary_words)
        kept = [c for c in rows.columns if c not in (KNOWN, RARE)]

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = pa.array(list(put_together(b)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], found], [*kept, out])

        schema = T.StructType(rows.select(*kept).schema.fields).add(out, T.ArrayType(T.IntegerType()))
        return rows.mapInArrow(whole, schema)

    def pieces_by_id(self) -> list[bytes]:
        by_rank = {r: t for t, r in self.ranks.items()}
        return [by_rank.get(i, b"") for i in range(max(by_rank) + 1)]

    def decode(self, ids: Column) -> Column:
        """Bytes of an array of token ids: the pieces, put one after another.
        Null for a null array; an id that is no token is an error."""
        pieces = self.pieces_by_id()

        @F.pandas_udf("binary")
        def join(arrays: pd.Series) -> pd.Series:
            return pd.Series([None if x is None else decoded(x, pieces) for x in arrays], dtype=object)

        return join(ids)


def decoded(ids: np.ndarray, pieces: list[bytes]) -> bytes:
    if len(ids) and ids.min() < 0:
        raise ValueError("an id that is no token")
    return b"".join(map(pieces.__getitem__, ids.tolist()))


def joined(pieces: pa.BinaryArray) -> memoryview:
    """All bytes of an array, in its order."""
    ends = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset:pieces.offset + len(pieces) + 1]
    return memoryview(pieces.buffers()[2] or b"")[ends[0]:ends[-1]]


def _is_text(token: bytes) -> bool:
    try:
        return bool(token.decode())
    except UnicodeDecodeError:
        return False


PIECE_ROWS = 64  # documents whose pieces a task holds at once
DICTIONARY_ROWS = 32_768  # words that are read or given to Spark at once


# What a counting task holds: bytes of texts whose runs are counted at once (their
# runs take several times that), and words with a count, of which the texts at hand
# may add more. Two tasks share an executor's memory with its heap.
HELD_BYTES, HELD_WORDS = 10 << 20, 400_000
KEPT_RUNS, RUN_CHARS = 100_000, 64  # runs of more than a word whose ids a task keeps, and their length


def rare_count(words: DataFrame, size: int) -> int:
    """The least number such that at most ``size`` words occur more often. The driver
    gets one row a number: as many as there are different ones."""
    table, held = words.groupBy("n").count().toArrow(), 0
    for n, count in sorted(zip(*table.to_pydict().values()), reverse=True):
        held += count
        if held > size:
            return n
    return 0


def _strings(x: pa.Array) -> list[str]:
    return x.to_numpy(zero_copy_only=False).tolist()


def _ids_of(table: pa.Table) -> dict[str, bytes]:
    """Word -> its ids as little-endian 32-bit integers."""
    if not table.num_rows:
        return {}
    table = table.combine_chunks()
    words, ids = table.column("word").chunk(0), table.column("ids").chunk(0)
    raw, offsets = np.asarray(ids.flatten(), "<i4").tobytes(), ids.offsets.to_numpy()
    at = (4 * (offsets - offsets[0])).tolist()
    return {w: raw[a:b] for w, a, b in zip(_strings(words.cast(pa.string())), at, at[1:])}


def _arrow_file(*tables: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, tables[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as f:
        for table in tables:
            f.write_table(table.cast(tables[0].schema))
    return sink.getvalue().to_pybytes()


def read_dictionary(file: bytes) -> dict[str, bytes]:
    """The words of a file of ``Bpe.dictionary``."""
    return _ids_of(pa.ipc.open_file(pa.BufferReader(file)).read_all())


def stored_words(folder: str) -> Iterator[dict[str, bytes]]:
    """The words of one folder, if there is one, some at a time."""
    system, root = _opened(folder)
    for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if f.base_name.endswith(".parquet"):
            with system.open_input_file(f.path) as source:
                for rows in parquet.ParquetFile(source).iter_batches(DICTIONARY_ROWS, columns=["word", "ids"]):
                    yield _ids_of(pa.table(rows))


def known_words(folders: Sequence[str], own: bytes) -> tuple[dict[str, bytes], dict[str, bytes]]:
    """``by_space`` of the words of all folders and of the file of tokens, which go last."""
    bare, spaced = {}, {}
    for words in (*map(stored_words, folders), [read_dictionary(own)]):
        for some in words:
            for mine, found in zip((bare, spaced), by_space(some)):
                mine.update(found)
    return bare, spaced


# The pattern of which it is known that no match goes over a space before a
# character that is none: words take a space only in front, white space leaves its
# last character to them, and looking ahead ends at a space as at the end.
CUT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def cutter(pattern: str) -> Callable[[str], list[str]]:
    """Cuts a text into runs whose words can be found one by one: every run but the
    first has lost the space before it."""
    if pattern != CUT_PATTERN:
        return lambda text: [text]
    doubtful, cut = re.compile(r" (?!\S)").search, re.compile(r" (?=\S)").split
    return lambda text: cut(text) if doubtful(text) else text.split(" ")


TAILS = frozenset(".,;:!?")  # after letters, a word of their own if they end a run

# A space before white space (all that ``re`` takes for it) or the end
DOUBTFUL = r" (?:[\s\x0b\x1c-\x1f\x{85}\pZ]|$)"


def held_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.ChunkedArray]:
    """The texts, none null, in groups of about HELD_BYTES."""
    texts, size = [], 0
    for b in batches:
        for i in range(0, b.num_rows, PIECE_ROWS):
            texts.append(b.column(0).slice(i, PIECE_ROWS).drop_null())
            size += texts[-1].nbytes
            if size > HELD_BYTES:
                yield pa.chunked_array(texts)
                texts, size = [], 0
    if texts:
        yield pa.chunked_array(texts)


def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, parts) of rows (word, n, part) that are sorted by word and part. An
    aggregate with a set would sort them as well, twice, and keep an object a word."""
    def out(rows: pa.Table, end: int) -> pa.RecordBatch:
        word, n, part = (c.combine_chunks() for c in rows.slice(0, end).columns)
        part, first, fresh = part.to_numpy(), np.ones(end, bool), np.ones(end, bool)
        first[1:] = pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
        fresh[1:] = first[1:] | (part[1:] != part[:-1])
        starts, parts = np.flatnonzero(first), np.flatnonzero(fresh)
        offsets = np.append(np.searchsorted(parts, starts), len(parts)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(part[parts]))
        return pa.RecordBatch.from_arrays([word.take(pa.array(starts)), pa.array(np.add.reduceat(n.to_numpy(), starts)), lists], ["word", "n", "parts"])

    held, rows = [], 0
    for b in batches:
        held, rows = [*held, b], rows + b.num_rows
        if rows >= DICTIONARY_ROWS:
            table = pa.Table.from_batches(held)
            # the last word may go on in the next batch
            word, end = table["word"], rows - 1
            while end and word[end - 1] == word[rows - 1]:
                end -= 1
            if end:
                yield out(table, end)
            held, rows = table.slice(end).to_batches(), rows - end
    if rows:
        yield out(pa.Table.from_batches(held), rows)


def run_counts(texts: pa.ChunkedArray, pattern: str) -> Iterator[tuple[str, str, int]]:
    """(the space before it or nothing, run, n) of the runs of all texts, none null."""
    cut, first, runs = cutter(pattern), Counter(), Counter()
    plain = pc.invert(pc.match_substring_regex(texts, DOUBTFUL)) if pattern == CUT_PATTERN else pc.is_null(texts)
    split = pc.split_pattern(texts.filter(plain), " ")
    first.update(pc.list_element(split, 0).to_pylist())
    counts = pc.list_slice(split, 1).combine_chunks().flatten().value_counts()
    runs.update(dict(zip(_strings(counts.field(0)), counts.field(1).to_numpy().tolist())))
    for t in texts.filter(pc.invert(plain)):
        found = cut(t.as_py())
        first[found[0]] += 1
        runs.update(found[1:])
    yield from (("", run, n) for run, n in first.items())
    yield from ((" ", run, n) for run, n in runs.items())


def by_space(words: dict[str, bytes]) -> tuple[dict[str, bytes], dict[str, bytes]]:
    """The words without a space before them, and the others without that space."""
    bare, spaced = {}, {}
    for w, ids in words.items():
        if w[0] == " ":
            spaced[w[1:]] = ids
        else:
            bare[w] = ids
    return bare, spaced


def finder(pattern: str) -> Callable[[str], list[str]]:
    """``regex.findall`` of the pattern. Texts without characters beyond U+FFFF go
    through ``re``, about twice as fast, with the pattern's classes (``\\p{L}``,
    ``\\p{N}``, ``\\s``) spelled out as ``regex`` knows them."""
    slow = regex.compile(pattern).findall
    chars, classes = "".join(map(chr, range(0x10000))), {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        runs = (m.group() for m in regex.finditer(name + "+", chars))
        classes[name] = "".join(f"\\u{ord(r[0]):04x}-\\u{ord(r[-1]):04x}" for r in runs)
    spelled, inside = [], False
    for part in re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, re.DOTALL):
        if part in classes:
            spelled.append(classes[part] if inside else f"[{classes[part]}]")
        elif part == r"\S" and not inside:
            spelled.append(f"[^{classes[chr(92) + 's']}]")
        elif len(part) > 1 and part[1].isalnum():
            return slow  # another class
        else:
            inside = part == "[" or (inside and part != "]")
            spelled.append(part)
    fast = re.compile("".join(spelled)).findall

    def find(text: str) -> list[str]:
        return fast(text) if text.isascii() or max(text) <= "\uffff" else slow(text)

    return find


KNOWN, RARE = "__bpe_known", "__bpe_rare"


def split_words(texts: pa.Array, bare: dict[str, bytes], spaced: dict[str, bytes], find, cut, most: int) -> tuple[pa.Array, pa.Array]:
    """Per text the ids of its known words, packed, with the places among them of
    the words that are not known, and these words. A word in ``spaced`` is a run, as
    it is found when alone; other runs are added there, up to ``most``."""
    ids, cuts, words, ends = [], [], [], [0]
    for t in texts:
        runs = cut(t.as_py() or "")
        packed = list(map(spaced.get, runs))
        packed[0] = None  # has no space before it
        packed.append(None)
        i, done, n = 0, 0, 0
        while i < len(runs):
            run = runs[i]
            if i and run[-1:] in TAILS and run[:-1].isalpha():
                own = [spaced.get(run[:-1]), bare.get(run[-1])]
                found = (f" {run[:-1]}", run[-1]) if None in own else ()
            else:
                found = find(f" {run}" if i else run)
                own = [spaced.get(w[1:]) if w[0] == " " else bare.get(w) for w in found]
            if None in own:
                n += sum(map(len, packed[done:i])) // 4
                done, m = i + 1, n
                for w, x in zip(found, own):
                    if x is None:
                        cuts.append(m)
                        words.append(w.encode())
                    else:
                        m += len(x) // 4
                n, packed[i] = m, b"".join(x for x in own if x is not None)
            else:
                packed[i] = b"".join(own)
                if i and len(spaced) < most and len(run) <= RUN_CHARS:
                    spaced[run] = packed[i]
            i = packed.index(None, i)
        ids.append(b"".join(packed[:-1]))
        ends.append(len(words))
    offsets = pa.array(ends, pa.int32())
    places = pa.ListArray.from_arrays(offsets, pa.array(cuts, pa.int32()))
    return (pa.StructArray.from_arrays([pa.array(ids, pa.binary()), places], ["ids", "cuts"]),
            pa.ListArray.from_arrays(offsets, pa.array(words, pa.binary())))


def put_together(rows: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The ids of each text: those of the known words, with those of the others at
    their places."""
    known, rare = rows.column(KNOWN), rows.column(RARE)
    lists = [known.field("cuts"), rare.field("sizes"), rare.field("ids")]
    (cuts, cut_ends), (sizes, _), (ids, id_ends) = [(x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()) for x in lists]
    first = lists[1].offsets.to_numpy()[0] - cut_ends[0]
    for packed, a, b, c, d in zip(known.field("ids"), cut_ends, cut_ends[1:], id_ends, id_ends[1:]):
        x = np.frombuffer(packed.as_buffer(), "<i4")
        yield np.insert(x, np.repeat(cuts[a:b], sizes[first + a:first + b]), ids[c:d]) if b > a else x


def public_bpe() -> Bpe:
    """The public 50k byte-level vocabulary (op10's parameter)."""
    import public_tokenizers

    return Bpe(load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def digests(docs: DataFrame, bpe: Bpe, text: str = "text", doc_id: str = "doc_id", dictionary_words: int = DICTIONARY_WORDS,
            keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit
    integers) and decoded_sha256 of every row, and its columns ``keep``."""
    rows = bpe._folded(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *keep), "text", dictionary_words)
    pieces = pa.array(bpe.pieces_by_id(), pa.binary())

    kept = ["doc_id", *keep]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, own, back = [], [], []
            for x in put_together(b):
                n.append(len(x))
                own.append(hashlib.sha256(np.ascontiguousarray(x, "<u4")).hexdigest())
                back.append(hashlib.sha256(joined(pieces.take(pa.array(x, pa.int32())))).hexdigest())
            found = [pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *found], schema.fieldNames())

    schema = T.StructType(rows.select(*kept).schema.fields)
    schema = schema.add("n_tokens", T.LongType()).add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType())
    return rows.select(*kept, KNOWN, RARE).mapInArrow(hashed, schema).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *keep)
