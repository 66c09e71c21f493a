"""Token ids, prefix tables and packed output against the library on hostile strings."""

import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm import binary_out, packing, token_counts
from barloom.llm.common import Cache, UnitEncoder

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the", "Don't", "'", "''", "'s", "'S", "it's", " ", "  ", "\n", "\r\n", "\t ", "\x0b", "\x1c", "\x85", "\xa0", "é", "é", "́", "ß", "İ", "Σ", "ΑΣ", "ǅ", "ﬁ", "한", "ᄒ", "ᅡ", "日本", "、", "ª", "½", "²", "٣", "7", "42", "1,234", "<", ">", "|", "<|", "|>", "<|endoftext|>", "<|startoftext|>", "<|endoftex", "!", "?!", "...", "--", "_", "\U0001f600", "‍", "﻿", "\x00", "\x7f", "ÀÉ", "naïve", "x" * 60, "=" * 60]


def hostile(n, seed):
    r = random.Random(seed)
    return ["".join(r.choices(PARTS, k=r.randint(1, 12))) for _ in range(n)] + ["", " ", "x" * 500, "=" * 300, "'" * 70 + "s", "don't" * 40, "日本語、" * 30, "<|" * 40, "a<|endoftext|>" * 20, "!<|endoftext|>'s" * 9]


@pytest.mark.parametrize(("path", "lossless", "code", "kind"), [(WORD, False, "I", "<u4"), (BYTE, True, "H", "<u2")])
def test_ids_are_the_librarys(path, lossless, code, kind):
    own, lib, texts = UnitEncoder(path, lossless, most=500), Tokenizer.from_file(path), hostile(4000, 1)
    for at in range(0, len(texts), 300):
        for text, ids in zip(texts[at : at + 300], own.encode(texts[at : at + 300], code)):
            assert np.frombuffer(ids, kind).tolist() == lib.encode(text, add_special_tokens=False).ids, text


def test_every_prefix_count_is_the_librarys():
    counter, lib, texts = token_counts.PrefixCounter(WORD, most=300), Tokenizer.from_file(WORD), hostile(500, 2)
    for at in range(0, len(texts), 100):
        for text, table in zip(texts[at : at + 100], counter.tables(texts[at : at + 100])):
            assert table.tolist() == [len(x.ids) for x in lib.encode_batch([text[: k + 1] for k in range(len(text))], add_special_tokens=False)], text


@pytest.mark.parametrize("part", ["x", "=", "'", "don't", "日本語、", "語", "<|", "<|endoftext|>", "ab1", "!a"])
def test_very_long_words_take_linear_time(part):
    counter, text = token_counts.PrefixCounter(WORD), part * (20_000 // len(part))
    start = time.process_time()
    table = counter.tables([text])[0]
    assert time.process_time() - start < 15
    assert len(table) == len(text) and table[-1] == len(Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids)


def test_cache_forgets_and_makes_again():
    made = []
    c = Cache(lambda k: made.append(k) or len(k), most=3, longest=4)
    assert [c[k] for k in ("a", "bb", "ccc", "a", "dddd", "a", "eeeee", "eeeee")] == [1, 2, 3, 1, 4, 1, 5, 5]
    assert made.count("a") == 1 and made.count("eeeee") == 2 and len(c) + len(c.old) <= 6


TEXTS = [(1, "Some words, don't they? 12"), (1, "Some words, don't they? 12"), (2, None), (3, ""), (None, "x" * 30_000), (4, "日本語、" * 50)]


def test_counts_truncation_and_budgets(spark):
    lib = Tokenizer.from_file(WORD)
    docs = spark.createDataFrame([(i, t, 7, 8) for i, t in TEXTS], "doc_id long, text string, n_tokens int, prefix_tokens int")
    got = token_counts.count_tokens(docs, WORD, 30).collect()
    want = [(i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS]
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got), key=str) == sorted(((*w, w[2] > 30) for w in want), key=str)
    tables = token_counts.prefix_token_counts(docs.where("doc_id IN (1, 3, 4)"), WORD)
    p = F.col("prefix_tokens")
    for r in tables.select("doc_id", p, *[token_counts.truncation(p, b).alias(f"t{b}") for b in (0, 1, 5, 1000)], *[token_counts.fits(p, n, 5).alias(f"f{n}") for n in (1, 10, 500)]).collect():
        t = r["prefix_tokens"]
        assert [r[f"t{b}"] for b in (0, 1, 5, 1000)] == [max((k + 1 for k, n in enumerate(t) if n <= b), default=0) for b in (0, 1, 5, 1000)]
        assert [r[f"f{n}"] for n in (1, 10, 500)] == [not t or t[min(n, len(t)) - 1] <= 5 for n in (1, 10, 500)]


def test_empty_tables_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, id int, ids int, start int")
    assert token_counts.count_tokens(empty, WORD, 5).count() == packing.pack_documents(empty, WORD).count() == binary_out.packed_matrix(empty, BYTE).count() == 0
    docs = spark.createDataFrame([(i, t, 7, 8, 9) for i, t in TEXTS], "doc_id long, text string, id int, ids int, start int")
    lib = Tokenizer.from_file(BYTE)
    rows = binary_out.packed_matrix(docs, BYTE, width=64).collect()
    assert sum(r["n_tokens"] for r in rows) == sum(len(lib.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in TEXTS)
    assert all(r["position_resets"] == r["cumulative_lengths"][:-1] and r["cumulative_lengths"][-1] == r["n_tokens"] <= 64 for r in rows)
    pieces = packing.pack_documents(docs, WORD, capacity=64, max_piece=16).collect()
    word = Tokenizer.from_file(WORD)
    assert sum(r["length"] for r in pieces) == sum(len(word.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in TEXTS)
    assert {r["doc_id"] for r in pieces} == {None, 1, 2, 3, 4}


def test_ties_pack_near_equally():
    windows = packing.pack_sizes([500] * 41, 2048)
    loads = [sum(500 for _ in w) for w in windows]
    assert sorted(i for w in windows for i in w) == list(range(41)) and max(loads) <= 2048 and max(loads) - min(loads) <= 500
    assert [len(r) for r in binary_out.best_fit_decreasing([50] * 7, 100)] == [2, 2, 2, 1]
