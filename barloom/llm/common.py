"""Shared pieces of the training-data operators: table access, Arrow batching, exact unit-wise tokenising."""

from __future__ import annotations

import functools
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage_cut import freeing_shuffles, materialize, release  # noqa: F401

#: Rows of one Arrow batch sent to a Python worker, and rows handled at a time inside it. Both bound memory only.
ARROW_ROWS = 512
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: a batch of long documents must fit a worker beside its results.

    A session setting, read when a plan runs; it stays set, since the plans are lazy.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_of(name: str = "text"):
    """A text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias("text")


#: Letters whose lower case is one composed letter; besides them, simple text holds the rest of ASCII but apostrophes
#: (contractions are one piece) and opening angle brackets (special strings begin so): it falls into pieces by kind of
#: character alone, and a letter, digit or sign of it can't change what stands beside it.
_LETTERS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_BLANK = " \t\n\r"
_PLAIN = "!-&(-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
SIMPLE = re.compile(f"[{_PLAIN}{_BLANK}]*+")
#: A word that holds any other character.
_ODD = re.compile(f"(?<![^{_BLANK}])[{_PLAIN}]*+[^{_PLAIN}{_BLANK}][^{_BLANK}]*+")
#: Pieces of simple text for a word BPE.
_PIECE = re.compile(f"[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9{_BLANK}]+")
#: The same, each with the blank after it; other white space is a piece, too. Joined they are the text.
_PIECE_BLANK = re.compile(f"[{_LETTERS}]+ ?|[0-9] ?|[^{_LETTERS}0-9{_BLANK}]+ ?|[{_BLANK}]+")
#: The same for a byte-level BPE, which takes the blank before a piece along.
_BYTE_PIECE = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[^{_LETTERS}0-9{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_ODD_SPACE = re.compile(r" \s|\s ")
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")


class Cache(dict):
    """A dict of two generations that makes what it lacks: entries unused while `most` others came are forgotten.

    Keys of over `longest` characters are made anew each time, so the size is bounded in bytes, too.
    """

    def __init__(self, make: Callable, most: int, longest: int = 256):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(key) > self.longest:
            return
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def lacks(self, key) -> bool:
        return key not in self and key not in self.old


class UnitEncoder:
    """Token ids of whole texts through the tokenizers library, piece by piece with a bounded cache.

    Both supported kinds cut a text into pieces before any merge, so the ids of a text are the ids of its pieces in
    order, and each distinct piece is merged once, by the library's model. Words of other than simple characters go
    through the whole library, normalisation included. `lossless` False: word BPE, white space dropped, any case.
    True: byte-level BPE, in which a piece takes along the single space before it.
    """

    def __init__(self, path: str, lossless: bool = False, most: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.lossless, self.most = lossless, most
        #: A special token, found before any other step: texts joined by its string are encoded apart from each other.
        self.mark_id, self.mark = max((i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items())
        self.caches: dict[str, Cache] = {}
        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.byte_letters = {i: split(chr(i))[0][0] for i in range(256)}

    def merged(self, piece: str) -> list:
        """The tokens of one piece of simple text, in lower case for a word BPE."""
        return self.model.tokenize(piece if piece.isalpha() and piece.isascii() else piece.translate(self.byte_letters))

    def pieces(self, text: str, blanks: bool = False) -> tuple[list[str], list[str]]:
        """The text's pieces in order, and those of them that need the whole library. A piece is simple or odd by itself.

        blanks: with the white space that a word BPE drops.
        """
        if self.lossless:
            if SIMPLE.fullmatch(text):
                return _BYTE_PIECE.findall(text), []
            if "<|" in text:  # a special string may hold or touch anything
                return [text], [text]
            cut, odd = [], []
            for unit in _SAFE_CUT.split(text) if _ODD_SPACE.search(text) or text[:1] == " " or text[-1:] == " " else _single(text):
                if SIMPLE.fullmatch(unit):
                    cut += _BYTE_PIECE.findall(unit)
                else:
                    cut.append(unit)
                    odd.append(unit)
            return cut, odd
        find = (_PIECE_BLANK if blanks else _PIECE).findall
        if SIMPLE.fullmatch(text):
            return find(text.lower()), []
        cut, odd, at = [], [], 0
        for m in _ODD.finditer(text):
            if at < m.start():
                cut += find(text[at : m.start()].lower())
            cut.append(m[0])
            odd.append(m[0])
            at = m.end()
        cut += find(text[at:].lower())
        return cut, odd

    def ids(self, units: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Each unit with its ids by the whole library; many short units share one call, parted by the mark."""
        alone = [u for u in units if "<|" in u]
        rest = [u for u in units if "<|" not in u]
        for u in alone:
            yield u, self.tokenizer.encode(u, add_special_tokens=False).ids
        for at in range(0, len(rest), 256):
            own = rest[at : at + 256]
            found = self.tokenizer.encode_batch_fast([self.mark.join(own)], add_special_tokens=False)[0].ids
            begin = 0
            for u in own[:-1]:
                end = found.index(self.mark_id, begin)
                yield u, found[begin:end]
                begin = end + 1
            yield own[-1], found[begin:]

    def _make(self, code: str) -> Callable[[str], bytes]:
        def make(piece: str) -> bytes:
            if SIMPLE.fullmatch(piece):
                return array(code, [t.id for t in self.merged(piece)]).tobytes()
            return array(code, self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

        return make

    def encode(self, texts: list[str], code: str = "I") -> list[bytes]:
        """The little-endian ids of each text, as unsigned integers of 32 bits ("I") or 16 ("H")."""
        if code not in self.caches:
            self.caches[code] = Cache(self._make(code), self.most)
        cache = self.caches[code]
        cut = [self.pieces(x) for x in texts]
        new = {u for _, odd in cut for u in odd if len(u) <= cache.longest and cache.lacks(u)}
        for u, ids in self.ids(list(new)):
            cache.put(u, array(code, ids).tobytes())
        return [b"".join(map(cache.__getitem__, own)) for own, _ in cut]


def _single(text: str) -> list[str]:
    """Units of a text in which single spaces alone part words."""
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]]


@functools.lru_cache(maxsize=4)
def shared_encoder(path: str, lossless: bool = False) -> UnitEncoder:
    """One encoder a worker process: its caches stay warm from task to task."""
    return UnitEncoder(path, lossless)
