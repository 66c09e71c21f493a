"""Operators against brute force, and their edge cases: empty tables, clashing names, repeated rows, ties, long texts."""

import random
import re
import time
from pathlib import Path

import duckdb
import numpy as np
import pytest

from barloom.llm import decontam, licenses, quality, simhash, spans, urls

from .test_operators import brute_groups

R = random.Random(7)
WORDS = ["".join(R.choices(["ka", "lo", "mi", "ren", "tas", "vo"], k=R.randint(1, 4))) for _ in range(400)]


def sentence(r, n):
    return " ".join(r.choices(WORDS, k=n)).capitalize() + "."


def brute_canonical(text):
    """The same templates by a plain walk over the text's tokens (texts without signs, names beside numbers or odd letters)."""
    out, raw, inside, number = [], [], False, False
    for m in re.finditer(r"[0-9]+(?:[.,:][0-9]+)*|[^\W\d_]+|[%$]", text):
        t, gap = m[0], text[m.start() - 1 : m.start()]
        before = text[m.start() - 2 : m.start() - 1]
        if t[0].isdigit():
            kind = "#num"
        elif number and gap in (" ", *"0123456789") and t.lower() in decontam.UNITS:
            kind = "#unit"
        elif len(t) > 1 and t[0].isupper() and gap == " " and re.match(r"[\w,;:]", before):
            kind = "#name"
        elif t.lower() in decontam.NUMBER_WORDS:
            kind = "#num"
        else:
            kind = t.lower()
        out.append(kind)
        raw.append(t.lower())
        number = t[0].isdigit()
    return out, raw


def brute_found(doc, item, share=0.4, w=8):
    c, r = brute_canonical(item)
    d, dr = brute_canonical(doc)
    n = min(w, len(c))
    places = [(k, c[k : k + n], r[k : k + n]) for k in range(len(c) - n + 1)]
    loose = [p for p in places if sum(x[0] != "#" for x in p[1]) >= decontam.MIN_LITERALS]
    hits = []
    for k, canon, raw in loose or [p for p in places if n == w]:
        for at in range(len(d) - n + 1):
            if loose and d[at : at + n] == canon or not loose and dr[at : at + n] == raw:
                pairs = {(a, b) for x, a, b in zip(canon, raw, dr[at : at + n]) if x[0] == "#" and loose}
                hits.append((k, at, pairs, all(a == b for a, b in pairs)))
    total = len(loose or [p for p in places if n == w])
    best = 0
    offsets = sorted({at - k for k, at, *_ in hits})
    runs, run = [], []
    for o in offsets:
        if run and o - run[-1] >= w:
            runs.append(run)
            run = []
        run.append(o)
    for group in [offsets, *runs, *([run] if run else []), *[[o] for o in offsets]]:
        own = [h for h in hits if h[1] - h[0] in group]
        pairs = set().union(*[h[2] for h in own if not h[3]])
        good = own if len({a for a, _ in pairs}) == len(pairs) else [h for h in own if h[3]]
        best = max(best, len({h[0] for h in good}))
    return total > 0 and best >= share * total


TEMPLATES = ["{n} has {a} apples and buys {b} kg more; how many apples does {n} have after {a} days?", "A train leaves at {a} and runs {b} km; when does {n} see it at the station of the town?", "{a} {b} {a} {b} {a} {b} {a} {b} {a} {b}", "short item of {a} words", "the plain words of an item that holds no slot at all but is long"]


def fill(r, t):
    return t.format(n=r.choice(["Tom", "Ann", "Bo"]), a=r.randint(1, 60), b=r.randint(1, 60))


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_decontamination_against_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", broadcast)
    r = random.Random(3)
    items = [(i, "So it is. " * (i % 2) + fill(r, t)) for i, t in enumerate(TEMPLATES * 2)] + [(90, None), (91, ""), (92, "42"), (93, "two words")]
    docs = []
    for _ in range(60):
        parts = [sentence(r, r.randint(3, 12)) for _ in range(r.randint(0, 3))]
        for _ in range(r.randint(0, 2)):
            text = r.choice([r.choice(items[:10])[1], fill(r, r.choice(TEMPLATES))])
            words = text.split(" ")
            if r.random() < 0.4:
                words = words[: r.randint(1, len(words))]
            parts.insert(r.randint(0, len(parts)), " ".join(words))
        docs.append(" ".join(parts))
    want = {(i, k) for i, d in enumerate(docs) for k, t in items if t and brute_found(d, t)}
    d = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in enumerate(docs)] + [(1, docs[1], 1, 2, "x"), (100, None, 1, 2, "x"), (None, items[0][1], 1, 2, "x")], "doc_id long, text string, __id int, __key int, ROW string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contaminated(d, b).collect()
    assert {(x["doc_id"], x["item_id"]) for x in got if x["doc_id"] is not None} == want
    assert (None, 0) in {(x["doc_id"], x["item_id"]) for x in got} and len(want) > 20
    kept = decontam.keep_uncontaminated(d, b)
    assert kept.columns == d.columns
    assert {x["doc_id"] for x in kept.collect()} == {i for i in [*range(60), 100] if i not in {k for k, _ in want}}


def brute_spans(rows):
    """(id, text) rows: the texts without sentences that a non-first repeated span covers."""
    found, first = [], {}
    for i, text in sorted({x for x in rows if x[1] is not None}, key=lambda x: (x[0] is None, x[0] or 0)):
        own = spans.sentences(text)
        for k in range(len(own)):
            n = len(own[k].split())
            end = k + 1 if n >= spans.LONE_WORDS else next((e for e in range(k + 2, len(own) + 1) if sum(len(s.split()) for s in own[k:e]) >= spans.MIN_WORDS), 0)
            if end:
                h = tuple(tuple(s.split()) for s in own[k:end])
                found.append((h, i, text, k, end))
                first.setdefault(h, (i, text, k))
    gone = {}
    for h, i, text, k, end in found:
        if first[h] != (i, text, k):
            gone.setdefault((i, text), set()).update(range(k, end))
    return {(i, t): "".join(s for k, s in enumerate(spans.sentences(t)) if k not in gone.get((i, t), ())) for i, t in rows if t is not None}


def test_spans_against_brute_force(spark):
    r = random.Random(5)
    pool = [sentence(r, r.choice([2, 4, 7, 11, 25, 60])) for _ in range(30)]
    rows = [(i, " ".join(r.choices(pool, k=r.randint(0, 8)) + [sentence(r, 6)] * r.randint(0, 2)) + "\n" * r.randint(0, 2)) for i in range(40)]
    rows += [rows[3], rows[3], (500, None), (501, ""), (502, "word " * 60_000)]
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in rows], "doc_id long, text string, __n_removed int, __n_sentences int, row int, cover int, at int")
    want = brute_spans(rows)
    for x in spans.dedup_substrings(df).collect():
        assert x["text"] is None if x["doc_id"] == 500 else x["text"] == want[x["doc_id"], next(t for i, t in rows if i == x["doc_id"])]
    kept = spans.keep_unrepeated(df)
    assert kept.columns == df.columns and {x["doc_id"] for x in kept.collect()} == {i for i, t in rows if t is None or want[i, t] == t or want[i, t].strip()}
    upper = spans.keep_unrepeated(df.withColumnRenamed("text", "Text").select("doc_id", "Text"))
    assert {(x["doc_id"], x["Text"]) for x in upper.collect()} == {(x["doc_id"], x["text"]) for x in kept.collect()}


def test_rows_without_ids_keep_their_own_cuts(spark):
    r = random.Random(9)
    shared = sentence(r, 30)
    rows = [(None, f"{sentence(r, 9)} {shared} {sentence(r, 9)}") for _ in range(300)]
    got = [x["text"] for x in spans.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sum(shared in t for t in got) == 1 and sorted(t.replace(" " + shared, "") for t in got) == sorted(t.replace(" " + shared, "") for _, t in rows)


def url_rows(n):
    r = random.Random(2)
    pages = []
    for i in range(n):
        host = r.choice(["a.com", "b.example.org", "Shop.net", "example.com"])
        kind = r.choice(["news", "spam", "en", "x" + str(r.randint(1, 9)), "deep/er/and/deeper/still", f"tag{r.randint(1, 300)}"])
        pages.append((i, f"https://{host}/{kind}/{i}.html?q=1", 1))
    pages += [(n, None, 1), (n + 1, "no url", 1), (n + 1, "no url", 1), (None, "http://x", 1), (n + 2, "http:///" + "p" * 100_000, 1)]
    labels = [(i, int("spam" not in u or r.random() < 0.1), 0) for i, u, _ in pages if i is not None and u and r.random() < 0.5] + [(1, None, 0), (None, 1, 0), (2, 1, 1), (2, 1, None)]
    return pages, labels


def test_url_templates_against_sql(spark):
    pages, labels = url_rows(1500)
    p = spark.createDataFrame(pages, "page_id long, url string, host int").withColumnRenamed("host", "template")
    q = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    con = duckdb.connect()
    con.register("pages", p.toArrow())
    con.register("labels", q.toArrow())
    key = lambda x: str(x)
    names = ["page_id", "host", "path", "rule", "template", "verdict"]
    got = sorted((tuple(x[c] for c in names) for x in urls.judge(p, q).collect()), key=key)
    want = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({urls.oracle_sql()})").fetchall(), key=key)
    assert got == want and len(got) == len(pages)
    assert {x[4] for x in got if x[5] == "block" and x[3] is None} >= {"/spam/{n}.html"} and any("{*}" in x[4] for x in got)


def test_licences_against_a_search_for_notices(spark):
    """Every notice that was put in is found with its family; paragraphs without one are left alone."""
    r, rows, want = random.Random(4), [], set()
    for i in range(120):
        lines = [sentence(r, r.randint(3, 30)) for _ in range(r.randint(1, 4))] + r.sample(licenses.NEAR_MISSES, 1)
        if i % 2:
            family = r.choice(licenses.FAMILIES)
            at = r.randint(0, len(lines))
            lines.insert(at, r.choice(licenses.TEMPLATES[family]))
            want.add((i, at, family))
        rows.append((i, "\n".join(lines), 1, "x"))
    rows += [(200, None, 1, "x"), (201, "", 1, "x"), (202, "word " * 50_000, 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int, family string")
    got = {(x["doc_id"], x["paragraph"], x["family"]) for x in licenses.scan(df).collect()}
    assert len(got & want) >= 0.95 * len(want) and not {x[:2] for x in got} - {x[:2] for x in want}
    assert licenses.scan(df.union(df)).count() == 2 * len(got)
    assert 2.0**-6 < licenses.trained().temperature < 16


CLASH = "doc_id long, text string, lang string, row int, id int, key int, n int, h int, root int, d int, k int, __row int, own_key int, me int"


def test_stages_with_empty_tables_and_clashing_names(spark):
    r = random.Random(6)
    text = " ".join(sentence(r, 9) for _ in range(12))
    rows = [(i, t, "en", *range(11)) for i, t in [(1, text), (1, text), (2, text), (3, None), (4, ""), (None, text + " More."), (5, " ".join(sentence(r, 9) for _ in range(20)))]]
    docs = spark.createDataFrame(rows, CLASH)
    bench = spark.createDataFrame([(1, "Tom has 12 apples and buys 5 more; how many apples does Tom have now?")], "item_id long, text string")
    for stage in (quality.keep_documents, simhash.drop_near_duplicates, spans.keep_unrepeated, lambda d: decontam.keep_uncontaminated(d, bench)):
        out = stage(docs)
        assert out.columns == docs.columns and out.count() <= len(rows)
        assert stage(docs.limit(0)).count() == 0
    assert sorted(x["doc_id"] for x in simhash.drop_near_duplicates(docs).collect() if x["text"]) == [1, 5]
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).count() == spans.dedup_substrings(empty).count() == licenses.scan(empty).count() == quality.judge(empty).count() == 0
    assert decontam.contaminated(empty, bench).count() == decontam.contaminated(docs, bench.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, "http://a/b", "x")], "page_id long, url string, segs string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert urls.judge(pages.limit(0), labels).count() == 0 and [x["verdict"] for x in urls.judge(pages, labels).collect()] == ["allow"]


def test_sketches_never_discard_similar_sets():
    r, discarded = np.random.default_rng(1), 0
    for _ in range(600):
        n = int(r.choice([0, 1, 5, 60, 64, 65, 900, 3000]))
        base = r.integers(0, 2**64, n, dtype=np.uint64)
        a, b = np.unique(base), np.unique(np.concatenate([base[: int(n * r.uniform(0.5, 1))], r.integers(0, 2**64, int(n * r.uniform(0, 0.4)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        allowed = simhash.sketches_allow(simhash.odd_sketch(a), simhash.odd_sketch(b), 0.8)
        assert allowed or both < 0.8 * (len(a) + len(b) - both)
        discarded += not allowed
    assert discarded > 200


def test_near_dedup_links_by_simhash_first(spark, monkeypatch):
    r, texts = random.Random(8), []
    for k in range(40):
        words = [w for _ in range(10 + 2 * k) for w in sentence(r, 10).split(" ")]
        texts.append(" ".join(words))
        words[r.randrange(len(words))] = "edited"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    fps = {x["doc_id"]: x["fp"] for x in simhash.fingerprints(docs, 5).collect()}
    near = {i for i in range(0, 80, 2) if ((fps[i] ^ fps[i + 1]) & (2**64 - 1)).bit_count() <= 2}
    assert 5 < len(near) < 40
    # The exact search finds nothing here, so that what SimHash links is seen by itself.
    none = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(simhash, "_hub_pairs", lambda *a: none)
    monkeypatch.setattr(simhash, "_unconnected", lambda *a: none)
    assert {x["doc_id"] for x in simhash.drop_near_duplicates(docs).collect()} == {*range(80)} - {i + 1 for i in near}


def test_pairs_of_a_large_group_are_discarded_inside_its_lists(spark, monkeypatch):
    r = random.Random(4)
    base = [w for _ in range(20) for w in sentence(r, 10).split(" ")]
    cuts = r.sample(range(5, 195), 30)
    texts = [" ".join(w for k, w in enumerate(base) if k not in gone) for gone in [set(r.sample(cuts, 9)) for _ in range(120)]]
    seen, alike = [], simhash._alike

    def counted(pairs, *rest):
        seen.append({(x["a"], x["b"]) for x in pairs.collect()})
        return alike(pairs, *rest)

    monkeypatch.setattr(simhash, "_alike", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for bits in (64, 512):  # 64 bits discard none of sets this large
        monkeypatch.setattr(simhash, "LIST_BITS", bits)
        kept = simhash.drop_near_duplicates(docs)
        assert sorted(x["doc_id"] for x in kept.collect()) == brute_groups(texts)
    every, few = len(seen[3]), len(seen[7])
    assert every > 1000 and few < every / 4, (every, few)


def test_finished_steps_leave_no_shuffle_files(spark):
    def files():
        dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {p.name for d in dirs for p in Path(d.getPath()).rglob("shuffle_*.data")}

    before = files()
    pairs = spark.range(200).where("id % 100 < 80").selectExpr("id AS a", "id + 10 AS b")
    roots = simhash.components(pairs)
    end = time.time() + 10
    while files() - before and time.time() < end:  # executors delete them on their own time
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert {x["node"]: x["root"] for x in roots.collect()} == {i: i // 100 * 100 + i % 10 for i in range(200) if i % 100 < 90}
