"""Benchmark leaks, ranked search and collocations against plain versions, on odd rows and on the given tables."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from siltworks.llm import collocations, leaks, ranked_search
from tests.agree import database, differences
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
ITEM = "One of the long benchmark items, which has some 20 words; it is here to be found in texts again."
OTHER = "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth"
DOCS = [(1, "en", "nothing of interest"), (2, None, None), (3, "en", ""), (4, "de", " \t\n.,"), (5, "en", "before. " + ITEM.upper() + " after"),
        (6, "en", "in the text: " + " -- ".join(ITEM.split()[3:14]) + " and more"), (6, "en", "one id, another text"), (None, "en", ITEM),
        (None, "en", ITEM), (7, "fr", "x " * 5000 + OTHER + " y" * 5000), (8, "fr", "\x00É\x7fé \U0001F642 short item é"), (9, None, "a b. " * 40),
        (10, "und", "A\tB c a b c\x0ba b " * 20), (11, "en", " ".join(OTHER.split()[:9])), (12, "en", "the cat sat. " * 35 + "the cat ran " * 33),
        (13, "en", OTHER + " " + OTHER), (13, "en", OTHER + " " + OTHER)]
ITEMS = [(1, ITEM), (2, OTHER), (3, None), (4, ""), (None, "short item"), (5, "É"), (20, " ".join(OTHER.split()[1:])), (2, "nothing of interest")]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """Extra columns bear names that the operators use themselves."""
    df = spark.createDataFrame(DOCS, "doc_id long, lang string, text string").withColumn("row", F.lit("x")).withColumn("bucket", F.lit(None).cast("int"))
    path = str(tmp_path_factory.mktemp("docs") / "docs.parquet")
    df.withColumn("hits", F.lit(1)).withColumn("w", F.lit("w")).withColumn("id", F.lit(9)).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("window", F.lit(0)).withColumn("item", F.lit("z"))


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")


def sort(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


def pairs(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


@pytest.mark.parametrize("name", ["op11_benchmark_leaks", "op12_ranked_search", "op13_collocations"])
def test_against_sql(spark, name):
    assert differences(spark, database(SMALL), name, entry.queries()[name], entry.oracle_sql()[name], SMALL) == []


@pytest.mark.parametrize("window, most", [(10, 1 << 20), (10, 500), (4, 1 << 20), (1, 1 << 20)])
def test_leaks(docs, items, window, most):
    """One slice of windows, many slices, short windows."""
    want = brute.leaks(pairs(docs, "doc_id", "text"), ITEMS, window)
    assert sort(leaks.find_leaks(docs, items, window=window, broadcast_bytes=most).collect()) == sort(want)


def test_leaks_removed(docs, items):
    rows = pairs(docs, "doc_id", "text")
    hits = [bool(r[2]) for r in brute.leaks(rows, ITEMS)]
    assert any(hits) and not all(hits)
    out = leaks.remove_leaks(docs, items, "documents")
    assert out.columns == docs.columns
    assert sort(pairs(out, "doc_id", "text")) == sort(r for r, hit in zip(rows, hits) if not hit)
    cut = leaks.remove_leaks(docs, items)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    kept = dict(pairs(cut.where("doc_id in (1, 2, 5, 6, 7, 8)"), "doc_id", "text"))
    assert kept[5] == "before. after" and kept[2] is None and kept[1] == "" and kept[8] == "\x00é \U0001F642 é"
    assert kept[7] == "x " * 5000 + "y" + " y" * 4999
    assert all(not r[2] for r in brute.leaks(pairs(cut, "doc_id", "text"), ITEMS[:2]))
    with pytest.raises(ValueError):
        leaks.remove_leaks(docs, items, "lines")


def test_leaks_of_hot_windows(spark):
    """A passage in every item and in half of the texts."""
    items = [(i, OTHER + f" own{i}") for i in range(300)]
    rows = [(i, OTHER if i % 2 else f"clean text {i}") for i in range(400)]
    out = leaks.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sort(out.collect()) == sort(brute.leaks(rows, items))


@pytest.mark.parametrize("block, slice_", [(1 << 20, 1 << 20), (100, 60)])
def test_ranked(docs, items, small, block, slice_):
    got = ranked_search.search(docs, items, k=3, block_bytes=block, query_bytes=slice_)
    assert sort(got.collect()) == sort(brute.ranked(pairs(docs, "doc_id", "text"), ITEMS, 3))
    if block > 100:
        texts, asked = small
        got = ranked_search.search(texts, asked, block_bytes=20000)
        assert sort(got.collect()) == sort(brute.ranked(pairs(texts, "doc_id", "text"), pairs(asked, "item_id", "text")))


def test_limited_accumulators():
    """Random postings: the limit never changes the result, and does take hold."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        ids = rng.permutation(60)
        lists = [(np.sort(rng.choice(60, rng.integers(1, 60), replace=False)), int(rng.integers(1, 30))) for _ in range(rng.integers(1, 7))]
        lists = [(t, rng.integers(1, 4, len(t)) * w) for t, w in sorted(lists, key=lambda x: len(x[0]))]
        bounds = np.cumsum([int(g.max()) for _, g in lists][::-1])[::-1]
        total = np.zeros(60, np.int64)
        for t, g in lists:
            total[t] += g
        want = np.lexsort((ids, -total))[:4]
        found, scores = ranked_search.best_texts(lists, bounds, ids, 4)
        assert scores.tolist() == [x for x in total[want].tolist() if x > 0] and found.tolist() == want[:len(found)].tolist()


@pytest.mark.parametrize("bucket, mass", [(1 << 20, 1 << 20), (700, 50)])
def test_collocations(docs, small, bucket, mass):
    got = collocations.collocations(docs, bucket_bytes=bucket, range_mass=mass)
    assert sort(got.collect()) == sort(brute.collocations(pairs(docs, "lang", "text"), 30))
    got = collocations.collocations(small[0], least=8, top=100, bucket_bytes=50000, range_mass=20000)
    assert sort(got.collect()) == sort(brute.collocations(pairs(small[0], "lang", "text"), 8, top=100))


def test_summary_keeps_every_frequent_key():
    rng = np.random.default_rng(1)
    for room in (1, 4):
        keys = rng.zipf(1.3, 20000).astype(np.uint64) % np.uint64(5000)
        summary = collocations.Summary(room * (len(keys) // 30) + 1)
        for part in np.array_split(keys, 50):
            summary.merge(*np.unique(part, return_counts=True))
            assert len(summary.keys) <= summary.capacity
        every, counts = np.unique(keys, return_counts=True)
        assert set(every[counts >= 30].tolist()) <= set(summary.at_least(30).tolist())
        assert summary.sunk < 30


def test_empty_tables(docs, items):
    none, no_items = docs.limit(0), items.limit(0)
    for df in (leaks.find_leaks(none, items), leaks.remove_leaks(none, items), ranked_search.search(none, items),
               ranked_search.search(docs, no_items), collocations.collocations(none)):
        assert df.collect() == []
    assert leaks.find_leaks(docs, no_items).where("size(hit_words) > 0").isEmpty()
    assert leaks.remove_leaks(docs, no_items).count() == len(DOCS)


def test_licence_spans(spark):
    """A notice that stands twice gives two spans; odd rows; scores are the best cover."""
    from siltworks.llm import licences

    notice = [f"n{i}" for i in range(20)]
    templates = {"one": " ".join(notice), "two": " ".join(f"m{i}" for i in range(10))}
    half = " ".join(notice[:12])
    rows = [(1, f"start {templates['one']} between {templates['one']} end"), (2, templates["two"]), (2, None), (None, half),
            (None, "mit license"), (3, f"{templates['one']} x {templates['two']} y {templates['one']}"), (4, "")]
    out = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)), templates=templates)
    got = sort((r.id, r.labels, round(r.score, 3), tuple((s.label, s.first, s.last) for s in r.spans)) for r in out.collect())
    assert got == sort([
        (1, "one", 1.0, (("one", 1, 20), ("one", 22, 41))), (2, "two", 1.0, (("two", 0, 9),)), (2, "", 0.0, ()),
        (None, "one" if 0.6 >= licences.LEAST_COVER else "", 0.6, (("one", 0, 11),)), (None, "mit", licences.PHRASE_SCORE, ()),
        (3, "one,two", 1.0, (("one", 0, 19), ("one", 32, 51), ("two", 21, 30))), (4, "", 0.0, ())])


def test_licence_bodies(spark):
    """A body without its opening sentence gets its label; texts that share sentences with it do not; scores by hand."""
    from siltworks.llm import licences

    templates = licences.read_templates()
    words = {name: licences.Words(pa.array([t]), licences.LETTERS, licences.LOWER).hashes.tolist() for name, t in templates.items()}
    rows = [(i, f"first words here {templates[name]} and last words") for i, name in enumerate(templates)]
    out = {r.id: r for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, name in enumerate(templates):
        base = {"gpl"} if name.startswith("gpl-") else {"apache"} if name == "apache-notice" else set()
        assert set(out[i].labels.split(",")) == base | {name}
        assert out[i].score == 1.0
        assert [(s.first, s.last) for s in out[i].spans if s.label == name] == [(3, 2 + len(words[name]))]
    third = templates["mit-body"].split("\n")[1]  # one sentence of three
    r, = licences.scan_licences(spark.createDataFrame([(1, third)], "doc_id long, text string")).collect()
    assert r.labels == "" and r.score == pytest.approx(len(third.split()) / len(words["mit-body"]))


def test_licences_against_plain_cover(spark):
    """Labels and scores of texts that hold one cut of a template, against the words counted one by one."""
    from siltworks.llm import licences

    rng = random.Random(5)
    templates = {f"t{k}": [f"w{k}x{i}" for i in range(12 + 7 * k)] for k in range(5)}
    rows, want = [], []
    for i in range(200):
        name = rng.choice(sorted(templates))
        size = rng.randrange(len(templates[name]) + 1)
        at = rng.randrange(len(templates[name]) - size + 1)
        rows.append((i, " ".join(["some", "words", *templates[name][at:at + size], "more"])))
        cover = size / len(templates[name]) if size >= licences.LEAST_MATCH else 0.0
        want.append((i, name if cover >= licences.LEAST_COVER else "", pytest.approx(cover)))
    out = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), templates={n: " ".join(t) for n, t in templates.items()})
    assert sorted((r.id, r.labels, r.score) for r in out.collect()) == want


def test_spared_hits():
    """Many exceptions in one text take linear time; nested and repeated ones spare what they cover."""
    import time

    from siltworks.llm import toxicity

    model = toxicity.Model({"idio": 3.0, "clown ": 2.0, "trash ": 1.0}, (-4.0, 8.0, 0.0), ("trash can", "class clown", "big trash can idiot"))
    auto = model.automaton()
    weigh = lambda t: round(model.features(t, auto)[1] * len(t.split()), 6)
    assert [weigh(t) for t in ("trash", "trash can", "big trash can idiot", "trash can idiot", "class clown clown", "clown class")] == [1, 0, 0, 3, 2, 2]
    took = []
    for n in (4000, 32000):
        start = time.time()
        assert weigh("trash can idiot " * n) == 3 * n
        took.append(time.time() - start)
    assert took[1] < 24 * took[0] + 0.5  # eight times as many


def test_labelled_texts_come_once_per_id(spark):
    from siltworks.llm import toxicity

    docs = spark.createDataFrame([(1, f"text {i % 3}") for i in range(3000)] + [(2, None), (None, "x"), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (2, 0), (None, 1), (3, None), (4, 1)], "doc_id long, toxic int")
    texts, y = toxicity.sampled(docs, labels, "doc_id", "text", 100)
    assert len(texts) <= 2 and set(texts) <= {"text 0", "text 1", "text 2", ""}
    assert toxicity.score_toxicity(docs, labels).count() == 3003
