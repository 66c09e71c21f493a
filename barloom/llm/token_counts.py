"""Token counts: exact counts at every prefix of a text, by dynamic programming over prefixes.

F(p), the number of tokens of the first p code points, is F(b) + W(text[b:p]), where b is the beginning of the piece
that holds p (a run of letters or signs, or a digit) and W counts the tokens of a piece's beginning. W is tabulated once
per distinct beginning (pieces share beginnings, as in a trie). A long run is tabulated by the recurrence over last
tokens, in time linear in its length. With the table, truncation and budget questions are array look-ups: nothing is
encoded again.

Edge cases: null text counts as empty; an empty text has an empty table and no tokens; an empty table gives no rows;
repeated rows give repeated results, null and repeated ids stay as they are; columns besides the id and the text are
ignored, whatever their names. The table holds one integer a code point, so a very long text takes four bytes a code
point of a worker's memory; words without a blank of any length are tabulated in linear time.
"""

from __future__ import annotations

import functools
import json
import re
import string
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SIMPLE, Cache, UnitEncoder, map_arrow, slices, text_of

SIGNS = frozenset(string.punctuation)
#: Words of more code points are tabulated by the recurrence instead of by their beginnings.
LONG_WORD = 48


class LastTokenTable:
    """Counts of every beginning of one run of letters: the last token of each beginning is the one that the token
    before it leaves alone (their joined string encodes as exactly these two), so counts follow by a recurrence."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.open = Tokenizer(models.BPE(vocab=self.vocab, merges=merges))
        self.closed = Tokenizer(models.BPE(vocab=self.vocab, merges=merges, end_of_word_suffix=self.end)) if self.end else self.open
        self.longest = max(len(t.removesuffix(self.end)) for t in self.vocab)
        self.pairs: dict[tuple[str, str, bool], bool] = {}
        self.letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def fits(self, a: str, b: str, last: bool) -> bool:
        if (a, b, last) not in self.pairs:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            got = (self.closed if last else self.open).encode(a + b, add_special_tokens=False).tokens
            self.pairs[a, b, last] = got == [a, b + self.end if last else b]
        return self.pairs[a, b, last]

    def counts(self, run: str) -> list[int]:
        """run: lower-case letters, composed, or ASCII signs. The count of each beginning."""
        ends = np.cumsum([len(c.encode()) for c in run]).tolist()
        s = self.letters.pre_tokenize_str(run)[0][0]
        n = [0] * (len(s) + 1)
        last = [""] * (len(s) + 1)
        closed, at = [], set(ends)
        for i in range(1, len(s) + 1):
            for is_last in (False, True) if i in at else (False,):
                for j in range(max(0, i - self.longest), i):
                    t = s[j:i]
                    if (t + self.end if is_last else t) in self.vocab and (j == 0 or self.fits(last[j], t, is_last)):
                        if is_last:
                            closed.append(n[j] + 1)
                        else:
                            last[i], n[i] = t, n[j] + 1
                        break
        return closed


class PrefixCounter:
    """Prefix tables of texts for a tokenizer that drops white space (word BPE).

    A piece's table is kept as steps: by how much the count changes with each of its code points. A text's table is the
    running sum of its pieces' steps; white space has steps of zero.
    """

    def __init__(self, path: str, most: int = 600_000):
        self.path = path
        self.encoder = UnitEncoder(path)
        self.of_start = Cache(lambda start: len(self.encoder.merged(start)), 2 * most)
        self.steps = Cache(self._steps, most)
        self.runs: LastTokenTable | None = None

    def _count(self, texts: list[str]) -> list[int]:
        found = {t: len(ids) for t, ids in self.encoder.ids(list(dict.fromkeys(texts)))}
        return [found[t] for t in texts]

    def _steps(self, piece: str) -> bytes:
        own = piece.rstrip(" \t\n\r")
        if len(own) < len(piece):
            return (self.steps[own] if own else b"") + bytes(2 * (len(piece) - len(own)))
        if not SIMPLE.fullmatch(own):
            return _as_steps(self._odd(own))
        if len(own) > LONG_WORD:
            return _as_steps(self._run(own))
        return _as_steps([*map(self.of_start.__getitem__, accumulate(own))])

    def _run(self, run: str) -> list[int]:
        self.runs = self.runs or LastTokenTable(self.path)
        return self.runs.counts(run)

    def _odd(self, word: str) -> list[int]:
        """Counts of every beginning of any word: special strings are one token once whole, and reset what is before."""
        out: list[int] = []
        base = 0
        for part in self.specials.split(word):
            if part in self.special_strings:
                # Until its last character a special string is text like any other.
                begun = self._plain(before + part[:-1])
                out += [base + x for x in begun[len(before) :]]
                base += (begun[len(before) - 1] if before else 0) + 1
                out.append(base)
                before = ""
            else:
                out += [base + x for x in self._plain(part)]
                before = part
        return out

    @functools.cached_property
    def special_strings(self) -> frozenset[str]:
        return frozenset(t.content for t in self.encoder.tokenizer.get_added_tokens_decoder().values())

    @functools.cached_property
    def specials(self) -> re.Pattern:
        return re.compile("(" + "|".join(map(re.escape, sorted(self.special_strings, key=len, reverse=True))) + ")")

    def _plain(self, word: str) -> list[int]:
        """Counts of every beginning, restarting where no token and no normalisation can reach across."""
        out: list[int] = []
        at = 0
        while at < len(word):
            signs = word[at] in SIGNS
            end = at + 1
            # Signs that a sign comes before are no contraction's beginning: letters after them are apart, too.
            while end < len(word) and not (_apart(word[end - 1], word[end]) or signs and end - at > 1 and word[end].isascii() and word[end].isalnum()):
                signs = signs and word[end] in SIGNS
                end += 1
            piece, base = word[at:end], out[-1] if out else 0
            if len(piece) > LONG_WORD and (signs or all(map(_simple_letter, piece))):
                out += [base + x for x in self._run(piece.lower())]
            else:
                out += [base + x for x in self._count([piece[:k] for k in range(1, len(piece) + 1)])]
            at = end
        return out

    def _learn_odd(self, words: list[str]) -> None:
        """Tables of short odd words, all their beginnings in few calls of the library."""
        starts = list({w[:k] for w in words for k in range(1, len(w) + 1)})
        found = {t: len(ids) for t, ids in self.encoder.ids(starts)}
        for w in words:
            self.steps.put(w, _as_steps([found[w[:k]] for k in range(1, len(w) + 1)]))

    def tables(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.encoder.pieces(t, blanks=True) for t in texts]
        steps = self.steps
        if new := [w for w in {w for _, odd in cut for w in odd} if len(w) <= LONG_WORD and steps.lacks(w)]:
            self._learn_odd(new)
        return [np.cumsum(np.frombuffer(b"".join(map(steps.__getitem__, own)), np.int16), dtype=np.int32) for own, _ in cut]


def _as_steps(counts: list[int]) -> bytes:
    return array("h", map(sub, counts, [0, *counts])).tobytes()


@functools.lru_cache(maxsize=4)
def shared_counter(path: str) -> PrefixCounter:
    """One counter a worker process: its tables stay from task to task."""
    return PrefixCounter(path)


def _simple_letter(c: str) -> bool:
    low = c.lower()
    return c.isalpha() and len(low) == 1 and not unicodedata.combining(c) and unicodedata.category(c)[0] == "L" and unicodedata.normalize("NFC", low) == low and unicodedata.normalize("NFC", c) == c


@functools.lru_cache(maxsize=100_000)
def _kind(c: str) -> str:
    """L, N or S (signs and punctuation); empty if normalisation might tie the character to its neighbours."""
    kind = {"L": "L", "N": "N", "P": "S", "S": "S"}.get(unicodedata.category(c)[0], "")
    low = c.lower()
    stable = len(low) == 1 and unicodedata.category(low)[0] == unicodedata.category(c)[0] and unicodedata.is_normalized("NFC", c) and not unicodedata.combining(c)
    return kind if stable else ""


def _apart(a: str, b: str) -> bool:
    """Whether a word may be cut between these: kinds differ, or digits. An apostrophe may begin a contraction."""
    left, right = _kind(a), _kind(b)
    return bool(left and right and a != "'" and (left != right or left == "N") and unicodedata.is_normalized("NFC", a + b))


def prefix_token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, prefix_tokens): prefix_tokens[k] is the exact token count of the first k+1 code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared_counter(path)
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            tables = counter.tables(texts)
            ends = np.zeros(len(tables) + 1, dtype=np.int32)
            np.cumsum([len(t) for t in tables], out=ends[1:])
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(tables)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), lists], ["id", "n_bytes", "prefix_tokens"])

    out = map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col)), run, "id long, n_bytes long, prefix_tokens array<int>")
    return out.withColumnRenamed("id", id_col)


def total(prefix_tokens: Column) -> Column:
    return F.coalesce(F.try_element_at(prefix_tokens, F.lit(-1)), F.lit(0)).cast("long")


def truncation(prefix_tokens: Column, budget: int) -> Column:
    """Code points of the longest beginning that takes at most `budget` tokens (counts may fall again as a word ends)."""
    last = F.size(prefix_tokens) - F.array_position(F.reverse(F.transform(prefix_tokens, lambda n: n <= budget)), F.lit(True)) + 1
    return F.when(F.size(prefix_tokens) == 0, 0).when(F.try_element_at(prefix_tokens, F.lit(-1)) <= budget, F.size(prefix_tokens)).when(F.exists(prefix_tokens, lambda n: n <= budget), last).otherwise(0).cast("long")


def fits(prefix_tokens: Column, chars: int, budget: int) -> Column:
    """Whether the first `chars` code points keep to the budget."""
    return F.coalesce(F.get(prefix_tokens, F.least(F.lit(chars), F.size(prefix_tokens)) - 1), F.lit(0)) <= budget


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id") -> DataFrame:
    """Totals read off the prefix tables: (id, n_bytes, n_tokens, over_limit)."""
    n = total(F.col("prefix_tokens"))
    return prefix_token_counts(docs, path, id_col).select(id_col, "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
