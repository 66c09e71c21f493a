"""The corpus pipeline as a whole against the stages by brute force."""

import random
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline

from .test_brute import brute_found, brute_spans, sentence
from .test_operators import brute_groups, brute_quality


def documents(r):
    passage = " ".join(sentence(r, 14) for _ in range(4))
    question = "Tom has 12 apples and buys 5 kg more; how many apples does Tom have after 12 days?"
    texts = []
    for i in range(30):
        own = [sentence(r, r.randint(5, 15)) for _ in range(r.randint(6, 12))]
        if i % 4 == 0:
            own.insert(r.randint(0, len(own)), passage)
        if i % 7 == 0:
            own.insert(r.randint(0, len(own)), question.replace("Tom", "Ann").replace("12", "31").replace("5", "8"))
        texts.append(" ".join(own))
    for base in texts[:8]:
        words = base.split(" ")
        words[r.randrange(len(words))] = "edited"
        texts.append(" ".join(words))
    texts += [texts[2], "too few words", "again and again " * 40, "", None, passage]
    return texts, [(1, question), (2, None)]


def test_run_equals_the_stages_by_brute_force(spark, tmp_path):
    texts, items = documents(random.Random(12))
    rows = list(enumerate(texts))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    def passes(t):
        n, repeated = brute_quality(t)
        return n >= 50 and 100 * repeated <= 50 * n

    kept = [(i, t) for i, t in rows if t and passes(t)]
    kept = [kept[k] for k in brute_groups([t for _, t in kept])]
    cut = brute_spans(kept)
    kept = [(i, cut[i, t]) for i, t in kept if cut[i, t].strip()]
    clean = [(i, t) for i, t in kept if not any(q and brute_found(t, q) for _, q in items)]
    assert len(texts) > len(kept) > len(clean) > 10
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(lib.encode(t, add_special_tokens=False).ids) + 1 for i, t in clean}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    lengths = {}
    for x in got:
        lengths[x["doc_id"]] = lengths.get(x["doc_id"], 0) + x["length"]
        assert x["doc_tokens"] == want[x["doc_id"]]
    assert lengths == want


def test_intermediate_results_are_removed(spark, tmp_path):
    docs = spark.createDataFrame([(1, documents(random.Random(1))[0][1], "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    shared = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    before = set(shared.glob("corpus_pipeline-*"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1
    (new,) = set(shared.glob("corpus_pipeline-*")) - before
    assert [p.name for p in new.iterdir()] == ["4-packing"]
