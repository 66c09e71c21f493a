import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from barloom.llm import binary_out, decontam, html, licenses, packing, quality, simhash, spans, token_counts, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
R = random.Random(5)


def prose(n, seed=0):
    r = random.Random(seed)
    w = ["".join(r.choice(["ka", "lo", "mi", "ren", "tas", "vo"]) for _ in range(r.randint(1, 4))) for _ in range(n)]
    return " ".join(x + ("." if i % 9 == 8 else "") for i, x in enumerate(w))


BASE = prose(200, 1)
TEXTS = [(1, BASE), (2, BASE), (3, BASE.replace("ka", "ko", 1)), (4, None), (5, ""), (5, ""), (None, prose(60, 2)), (6, "<|endoftext|>don't  stop\n\nit's 1,234 ÄÖ " + "x" * 90), (7, prose(5000, 3)), (8, "a b c " * 40)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in TEXTS], SCHEMA).withColumn("h", F.lit(1)).withColumn("n", F.lit("clash")).withColumn("id", F.lit(0))


def library(path, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_prefix_counts_are_exact(docs):
    for r in token_counts.prefix_token_counts(docs.where("doc_id in (4, 5, 6, 8)"), WORD).collect():
        text = dict(TEXTS)[r["doc_id"]] or ""
        assert r["prefix_tokens"] == [len(library(WORD, text[: k + 1])) for k in range(len(text))]


def test_packing_round_trip(docs):
    rows = packing.pack_documents(docs, WORD, capacity=256, max_piece=64, with_ids=True).collect()
    windows = {}
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    whole = [i for r in sorted((r for r in rows if r["doc_id"] == 7), key=lambda r: r["start"]) for i in r["ids"]]
    assert whole == [*library(WORD, dict(TEXTS)[7]), 1]
    assert sum(r["length"] for r in rows) == sum(len(library(WORD, t)) + 1 for _, t in TEXTS)


def test_differencing_is_near_equal():
    sizes = [R.randint(1, 500) for _ in range(400)]
    loads = [sum(sizes[i] for i in w) for w in packing.difference(sizes, 50)]
    assert sum(loads) == sum(sizes) and max(loads) - min(loads) < 30


def test_best_fit_decreasing():
    sizes = [R.randint(1, 100) for _ in range(500)]
    rows = binary_out.best_fit_decreasing(sizes, 100)
    assert sorted(i for r in rows for i in r) == list(range(500)) and all(sum(sizes[i] for i in r) <= 100 for r in rows)
    brute = []
    for s in sorted(sizes, reverse=True):
        fit = [b for b in range(len(brute)) if brute[b] >= s]
        if fit:
            brute[min(fit, key=lambda b: brute[b])] -= s
        else:
            brute.append(100 - s)
    assert len(rows) == len(brute)


def test_binary_round_trip(docs):
    m = binary_out.packed_matrix(docs, BYTE, width=128)
    assert all(len(r["ids"]) == 256 for r in m.select("ids").collect())
    seg = binary_out.documents_again(m).where("doc_id = 7").orderBy("doc_start").collect()
    assert np.frombuffer(b"".join(bytes(r["ids"]) for r in seg), "<u2").tolist() == [*library(BYTE, dict(TEXTS)[7]), 50256]
    assert binary_out.position_ids([0, 2, 5]).tolist() == [0, 1, 0, 1, 2]


def brute_quality(text):
    w = [x for x in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    return len(w), len({i + o for i, g in enumerate(grams) if grams.count(g) > 1 for o in range(3)})


def test_quality_ledger(docs):
    for r in quality.ledger(docs.where("doc_id <> 7")).collect():
        assert (r["n_words"], r["n_repeat_words"]) == brute_quality(dict(TEXTS)[r["doc_id"]])
    kept = {r["doc_id"] for r in quality.keep_documents(docs).collect()}
    assert {1, 2, 3, 7} <= kept and not kept & {4, 5, 8}
    a = {r["rule"]: r for r in quality.ablation(quality.ledger(docs), quality.BASE).collect()}
    assert a["repeated_windows"]["only_this"] == 1


def brute_fp(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_brute_force(spark):
    texts = []
    for g in range(12):
        base = prose(120, 100 + g).split(" ")
        for k in range(70 if g == 0 else 4):
            w = list(base)
            for _ in range(k % 4):
                w[R.randrange(120)] = "zz"
            texts.append(" ".join(w))
    texts += ["", None, "one", "one two"]
    fps = [brute_fp(t) for t in texts]
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        new = [min(root[j] for j in range(len(texts)) if (fps[i] ^ fps[j]).bit_count() <= 2) for i in range(len(texts))]
        if new == root:
            break
        root = new
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(df).collect()}
    assert all(got[i]["fingerprint"] == f"{fps[i]:016x}" and got[i]["component_id"] == root[i] for i in range(len(texts)))


def test_simhash_hot_buckets_are_exact(spark):
    base = R.getrandbits(64)
    points = sorted({base ^ (1 << a) ^ (1 << b) for a in range(0, 40, 2) for b in range(1, 40, 3)} | {R.getrandbits(64) for _ in range(50)})
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    df = spark.createDataFrame([(0, s) for s in signed], "space int, fp long")

    def classes(edges):
        root = {s: s for s in signed}
        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in edges:
            root[find(b)] = find(a)
        return {s: min(t for t in signed if find(t) == find(s)) for s in signed}

    want = classes([(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2])
    for cap in (4, 1000):
        assert classes([(r["a"], r["b"]) for r in simhash.links(df, bucket_cap=cap).collect()]) == want


def test_near_duplicates_go(docs):
    kept = sorted(r["doc_id"] or 0 for r in simhash.drop_near_duplicates(docs).select("doc_id").collect())
    assert kept == [0, 1, 4, 6, 7, 8] or kept == [0, 1, 5, 6, 7, 8]


def test_spans(spark):
    passage = "The first long sentence of the passage is here. A second sentence of it follows at once. The third one ends it."
    df = spark.createDataFrame([(1, "Own words of one. " + passage + " Tail of one."), (2, "Own words of two. " + passage + " Tail of two."), (3, None), (4, ""), (2, "Own words of two. " + passage + " Tail of two.")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in spans.dedup_substrings(df).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_removed"] == 3
    assert got[2]["text"] == "Own words of two. Tail of two." and got[3]["text"] is None


def test_sentences_partition():
    for _, t in TEXTS:
        assert "".join(spans.sentences(t or "")) == (t or "")


def test_reparameterised_questions(spark):
    b = spark.createDataFrame([(1, "Tom has 12 apples and buys 5 kg more; how many apples does Tom Smith have after 12 days?"), (2, None)], "item_id long, text string")
    d = spark.createDataFrame([(1, "x. Ann has 30 apples and buys 7 kg more; how many apples does Ann Smith have after 30 days?"), (2, "Ann has 30 apples and buys 7 kg more; how many apples does Ann Smith have after 31 days?"), (3, None), (4, ""), (5, BASE)], "doc_id long, text string")
    assert [r["doc_id"] for r in decontam.contaminated(d, b).collect()] == [1]
    assert sorted(r["doc_id"] for r in decontam.keep_uncontaminated(d, b).collect()) == [2, 3, 4, 5]


def test_long_numbers_are_one_token(spark):
    texts = ["9" * 200_000 + " km", "1." * 50_000 + "2 kg", "One two three", "x 5 5 m"]
    got = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", decontam.canonical(F.col("t")).alias("c")).collect()
    assert [r["c"] for r in sorted(got)] == [["#num", "#unit"], ["#num", "#unit"], ["#num"] * 3, ["x", "#num", "#num", "#unit"]]


def test_licences(spark):
    rows = [(1, "Intro.\nReleased under the MIT License.\nEnd"), (2, "The plumber is licensed under the city rules."), (3, None), (4, BASE)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["family"], r["paragraph"]) for r in got] == [(1, "mit", 1)]
    assert licenses.trained().accuracy > 0.95


def test_html_held_out():
    model, right, total = html.trained(), 0, 0
    for page in html.labelled_pages(60, seed=77):
        tree = html.parse(page)
        want = html.labels_of(tree)
        html.measure(tree)
        got = model.marginals([tree])[0]
        for i, tag in enumerate(tree.tag):
            if tag == "#text":
                total += 1
                right += (got[i] > 0.5) == (want[i] == html.CONTENT)
    assert right / total > 0.95
    assert html.extract(["", "<p>"], model) == ["", ""]


def test_sum_product_equals_enumeration():
    from itertools import product

    model = html.trained()
    tree = html.parse("<div><p>Some text, here.</p><a>x</a></div>")
    html.measure(tree)
    u = [model.potential(f) for f in html.features(tree)]
    total, content = 0.0, np.zeros(len(u))
    for s in product(range(3), repeat=len(u)):
        p = model.prior[s[0]] + sum(u[i][s[i]] for i in range(len(u))) + sum(model.log_edge[html.GROUP.get(tree.tag[i], 5), s[tree.parent[i]], s[i]] for i in range(1, len(u)))
        total += np.exp(p)
        content += np.exp(p) * (np.array(s) == html.CONTENT)
    assert np.allclose(model.marginals([tree])[0], content / total)


def test_urls(spark):
    pages = spark.createDataFrame([(1, "https://A.example.com/en/7?x"), (2, "http://example.com/en/8"), (3, "http://notcom/en/8"), (4, None), (5, "nothing"), (6, "http://b.example.net/de/81#t"), (7, "http://b.example.net/de/9")] + [(100 + i, f"http://bad.example.org/spam/{i}") for i in range(40)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0, 0) for i in range(40)] + [(1000 + i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r for r in urls.judge(pages, labels).collect()}
    assert (got[1]["rule"], got[1]["verdict"], got[1]["host"], got[1]["path"]) == ("example.com/en/7", "allow", "a.example.com", "/en/7")
    assert (got[2]["rule"], got[2]["verdict"]) == ("com/en/", "block") and got[3]["rule"] is None
    assert (got[4]["host"], got[4]["path"], got[5]["host"]) == ("", "", "")
    assert got[6]["rule"] == "example.net/de/8" and got[6]["verdict"] == "block" and got[7]["rule"] == "net/de/" and got[7]["verdict"] == "allow"
    assert got[101]["template"] == "/spam/{n}" and got[101]["verdict"] == "block"


def brute_shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def brute_groups(texts):
    sets = [brute_shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return sorted({find(i) for i in range(len(texts))})


def edited_copies():
    """Copies between a similarity of 0.75 and 0.95, most pairs near 0.8, and texts of one hot passage and own words."""
    r, texts = random.Random(11), []
    for g in range(14):
        base = prose(150, 300 + g).split(" ")
        for _ in range(60 if g == 0 else 4):
            w = list(base)
            for at in r.sample(range(150), r.randint(1, 4)):
                w[at] = "".join(r.choices("abcdefgh", k=6))
            texts.append(" ".join(w))
    hot = prose(80, 400)
    return texts + [hot + " " + prose(n, 500 + n) for n in range(6, 46)]


@pytest.mark.parametrize("cap", [8, 512])
def test_near_duplicates_against_brute_force(spark, monkeypatch, cap):
    monkeypatch.setattr(simhash, "LIST_CAP", cap, raising=False)
    texts = edited_copies()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.drop_near_duplicates(df).select("doc_id").collect()) == brute_groups(texts)


def test_large_group_around_the_threshold(spark):
    r, w = random.Random(3), prose(300, 77).split(" ")
    texts = []
    for _ in range(150):
        own = list(w)
        for at in r.sample(range(300), r.randint(3, 5)):
            own[at] = "".join(r.choices("abcdefgh", k=6))
        texts.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.drop_near_duplicates(df).select("doc_id").collect()) == brute_groups(texts)


def test_templates_align_with_raw_tokens(spark):
    texts = ["token = 24be64439e3e", "On the 19th Tom's 5%ers had #tags and #num 3", "5kg 5 % x2y Tom5 $7a"]
    got = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", decontam.canonical(F.col("t")).alias("c"), decontam.raw_tokens(F.col("t")).alias("r")).collect()
    for r in got:
        assert len(r["c"]) == len(r["r"]) and all(c == x or c in ("#num", "#unit", "#name") for c, x in zip(r["c"], r["r"]))
    b = spark.createDataFrame([(1, "Tom has 12 apples and buys 5 kg more; how many apples does Tom Smith have after 12 days?")], "item_id long, text string")
    d = spark.createDataFrame([(1, "The 19th and token 24be64439e3e. Ann has 30 apples and buys 7 kg more; how many apples does Ann Smith have after 30 days?")], "doc_id long, text string")
    assert [r["doc_id"] for r in decontam.contaminated(d, b).collect()] == [1]


def test_two_variants_of_a_question_in_one_text(spark):
    q = "Tom has {} apples and buys {} kg more; how many apples does Tom Smith have after {} days?"
    b = spark.createDataFrame([(1, q.format(12, 5, 12))], "item_id long, text string")
    own = prose(30, 8)
    d = spark.createDataFrame([(1, f"{q.format(30, 7, 30)} {own} {q.format(44, 9, 44)}"), (2, f"{q.format(30, 7, 30)} {q.format(44, 9, 44)}"), (3, f"{q.format(30, 7, 31)} {own} {q.format(44, 9, 45)}")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in decontam.contaminated(d, b).collect()) == [1, 2]
