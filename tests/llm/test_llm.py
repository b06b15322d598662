"""The training-data operators against plain versions, round trips and held-out labels."""

import zlib

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
import public_tokenizers
from siltworks.llm import (bpe, cap_filters, dealing, jaccard_join, katz, licences, packing, preferences, substring_dedup,
                           top_products, toxicity)
from tests.agree import database, differences
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"p{i}" for i in range(60))
ROWS = [(1, "a b " * 15, "x"), (2, None, "x"), (3, "", None), (4, " \t\n", "y"), (5, "One two three four five six", "y"),
        (6, "one TWO three four five six", "y"), (7, "x " * 3000, "z"), (8, f"start {PASSAGE} end", "z"),
        (9, f"other beginning {PASSAGE} and another end of it all", "z"), (10, f"start {PASSAGE} end", "z"),
        (11, "mit license and the Apache  License, GNU general public license", "z"), (12, "é " * 30 + "\x85 \U0001F642", "z")]


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns have names that the operators use themselves."""
    return spark.createDataFrame(ROWS, "doc_id long, text string, bucket string").repartition(3)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def got(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


@pytest.mark.parametrize("table", ["docs", "small"])
def test_against_plain_versions(request, table):
    df = request.getfixturevalue(table)
    rows = pairs(df)
    assert got(substring_dedup.remove_repeated(df), "id", "n_words", "n_removed", F.sha2("kept", 256)) == brute.substring_dedup(rows)
    for block in (3, 1000):
        assert got(jaccard_join.shingle_groups(df, block=block)) == brute.shingle_groups(rows)
    assert [r[:6] for r in got(licences.scan_licences(df))] == brute.licences(rows)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("table", ["docs", "small"])
def test_katz_orders(request, table, order):
    df = request.getfixturevalue(table)
    want, p, after, words, _ = brute.katz(pairs(df), order)
    for a, b in zip(got(katz.score_texts(df, bucket_bytes=5000 if table == "docs" else 200_000, order=order)), want, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])
    for size in range(1, order):  # probabilities after a context sum to one
        for before in [h for h in after if len(h) == size][:5]:
            assert sum(p(w, before) for w in words) + p("never seen", before) == pytest.approx(1)


@pytest.mark.parametrize("table", ["docs", "small"])
def test_bpe_and_packing(request, table):
    df = request.getfixturevalue(table)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {i: t or "" for i, t in pairs(df)}
    for r in bpe.encode_texts(df).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == plain.encode_ordinary(texts[r.id])
        assert bytes(r.decoded) == texts[r.id].encode()
    out = sorted(packing.pack(df, window=64, open_windows=3).collect(), key=lambda r: (r.id, r.start))
    back, sequences = {}, {}
    for r in out:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == len(back.setdefault(r.id, []))
        back[r.id] += ids
        sequences.setdefault(r.sequence_id, []).append((r.offset, len(ids)))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert back == {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    sizes = []
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        sizes.append(sum(n for _, n in pieces))
    assert sum(s != 64 for s in sizes) <= 1 and max(sizes) <= 64


def test_long_pieces():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(1)
    for text in ("a" * 3001, "ab" * 999, "".join(rng.choice(list("theanding"), 20000)), "é" * 500, " " * 700, "<|endoftext|>"):
        assert np.frombuffer(bpe.Encoder(ranks, public_tokenizers.PATTERN).encode(text), "<u4").tolist() == plain.encode_ordinary(text)


@pytest.mark.parametrize("name", ["op2_embedding_near_dedup", "op3_chat_format", "op4_top_products"])
def test_against_sql(spark, name):
    assert differences(spark, database(SMALL), name, entry.queries()[name], entry.oracle_sql()[name], SMALL) == []


def vectors(spark):
    nan, rows = float("nan"), []
    rng = np.random.default_rng(5)
    base = rng.standard_normal((4, 8))
    for i in range(120):
        rows.append((i, [float(v) for v in base[i % 4] + rng.standard_normal(8) * 0.05], i % 2))
    rows += [(200, None, 0), (201, [], 0), (202, [0.0] * 8, 0), (203, [None, *[1.0] * 7], 0), (204, [nan, *[1.0] * 7], 0),
             (205, rows[0][1], None), (206, rows[0][1], 0), (207, rows[0][1], 0), (208, [1.0, 2.0], 0), (250, [2.0, 4.0], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), rows


def test_vectors_with_odd_values(spark):
    df, rows = vectors(spark)
    good = [(i, np.array(x), y) for i, x, y in rows if x and y is not None and None not in x and np.isfinite(x).all() and any(x)]
    near = [(a, b) for a in range(len(good)) for b in range(a)
            if good[a][2] == good[b][2] and len(good[a][1]) == len(good[b][1])
            and good[a][1] @ good[b][1] / np.linalg.norm(good[a][1]) / np.linalg.norm(good[b][1]) >= 0.98]
    label = brute.roots(len(good), near)
    want = {i: (0, i) for i, _, _ in rows}
    want.update({g[0]: (sum(k in p for p in near), good[label[k]][0]) for k, g in enumerate(good)})
    for tile in (7, 1000):
        assert {r[0]: (r[1], r[2]) for r in cap_filters.near_vectors(df, tile=tile).collect()} == want


def test_top_products_with_odd_values(spark):
    df, rows = vectors(spark)
    rows = [(i, [int(np.floor(256 * v)) for v in x]) for i, x, _ in rows if x is not None and None not in x and np.isfinite(x).all()]
    want = []
    for i, q in rows:
        if i % 50 == 0:
            found = sorted(((-sum(a * b for a, b in zip(q, x)), j) for j, x in rows if j != i and len(x) == len(q)))[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(found)]
    for options in ({}, {"bucket": 16, "block": 1, "seeds": 8, "coordinate_from": 0.1}):
        assert got(top_products.top_products(df, **options)) == sorted(want)


def test_top_products_of_repeated_ids(spark):
    """Every row is a query and a candidate of its own, as in the SQL."""
    rng = np.random.default_rng(8)
    rows = [(0, [1.0, 2.0])] + [(9, [5.0, 5.0])] * 6 + [(i, [1.0, float(i)]) for i in range(10, 16)]
    rows += [(int(i), [float(v) for v in rng.integers(-4, 5, 3)]) for i in rng.choice([50, 100, 7, 8], 150)]
    want = []
    for k, (i, q) in enumerate(rows):
        if i % 50 == 0:
            found = sorted((-sum(int(256 * a) * int(256 * b) for a, b in zip(q, x)), j) for m, (j, x) in enumerate(rows) if m != k and len(x) == len(q))
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("no", F.lit("x"))
    for options in ({}, {"bucket": 16, "block": 1, "seeds": 8, "coordinate_from": 0.1}):
        out = got(top_products.top_products(df, **options))
        assert out == sorted(want) and len([r for r in out if r[0] == 0]) == 5


def test_chat_pairs(spark):
    rows = [(0, 0, "system", "s"), (0, 1, "user", "q"), (0, 2, "assistant", "yes"), (1, 0, "system", "s"), (1, 1, "user", "q"),
            (1, 2, "assistant", "no"), (1, 3, "user", None), (4, 0, None, "alone"), (None, 0, "user", "lost"),
            (6, 0, "user", "same"), (7, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.pair_id: r for r in preferences.format_pairs(preferences.adjacent_pairs(df)).collect()}
    assert set(out) == {0, 2, 3}
    r = out[0]
    assert r.n_shared == 2 and r.prompt == "<|system|>\ns<|end|>\n<|user|>\nq<|end|>\n"
    assert r.chosen[slice(*r.chosen_learned[0])] == "yes<|end|>" and r.rejected[slice(*r.rejected_learned[0])] == "no<|end|>"
    assert out[2].prompt == "" and out[2].rejected is None and out[2].chosen_learned == []
    assert (out[3].n_shared, out[3].chosen, out[3].rejected) == (1, "", "")


def test_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = toxicity.score_toxicity(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    rows = out.join(labels.withColumnRenamed("doc_id", "id"), "id").where("held_out").collect()
    assert all(zlib.crc32(str(r.id).encode()) % 4 == 2 for r in rows)
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95  # measured 0.97
    model = toxicity.Model({"idio": 3.0, "moron ": 2.0}, (-4.0, 8.0, 0.0), ("idiot proof",))
    auto = model.automaton()
    hits = [model.features(t, auto)[0] > 0 for t in ("an 1dіot", "ＩＤＩＯT", "idiot proof", "vidiot", "moronic", "moron.", "")]
    assert hits == [True, True, False, False, False, True, False]


def test_toxicity_by_language(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id", "toxic"), "doc_id")
    out = toxicity.score_toxicity(docs, labels).where("held_out").join(docs.select(F.col("doc_id").alias("id"), "lang", "toxic"), "id")
    rows = out.select("lang", "toxic", "predicted").collect()
    for lang in ("en", "de", "fr", "es"):
        found = [r.predicted for r in rows if r.lang == lang and r.toxic]
        cleared = [r.predicted for r in rows if r.lang == lang and not r.toxic]
        assert np.mean(found) > 0.7 and np.mean(cleared) < 0.05, lang


def test_small_group_of_toxic_texts():
    """Five of 400 toxic texts are in a language of their own, with a word of their own."""
    texts = [(f"plain words number{i} badword", 1) for i in range(395)] + [(f"otras frases numero{i} maldad", 1) for i in range(5)]
    texts += [(f"plain words number{i}", 0) for i in range(1000, 3000)] + [(f"otras frases numero{i}", 0) for i in range(3000, 3100)]
    model = toxicity.fit(*zip(*texts))
    auto = model.automaton()
    score = {t: model.score(np.array([model.features(t, auto)]))[0] for t in ("otras frases nuevas maldad", "otras frases nuevas")}
    assert score["otras frases nuevas maldad"] >= toxicity.THRESHOLD > score["otras frases nuevas"]
    model = toxicity.Model({"moron ": 2.0}, (-4.0, 8.0, 0.0))
    hits = [model.features(t, model.automaton())[0] > 0 for t in ("moron!", "moron!!! so", "m!ron", "moron\uFF01", "moron!c")]
    assert hits == [True, True, False, True, False]
    assert toxicity.fold("!d!ot sh!t! a$$") == "idiot shit. ass"


def test_empty_tables(spark, docs):
    none = docs.where("doc_id < 0")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (substring_dedup.remove_repeated(none), jaccard_join.shingle_groups(none), licences.scan_licences(none),
                katz.score_texts(none), bpe.encode_texts(none), packing.pack(none), toxicity.score_toxicity(none, labels)):
        assert out.count() == 0
    assert toxicity.score_toxicity(docs, labels).where("predicted = 1").count() == 0
    v = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert cap_filters.near_vectors(v).count() == top_products.top_products(v).count() == 0


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, PASSAGE), (1, PASSAGE), (1, PASSAGE)], "doc_id long, text string")
    out = sorted(((r.id or 0, r.n_removed) for r in substring_dedup.remove_repeated(df).collect()))
    assert out == [(0, 0), (1, 60), (1, 60)]
    assert {r.component for r in jaccard_join.shingle_groups(df).collect()} == {None}
    assert katz.score_texts(df).count() == packing.pack(df).select("id").count() == 3


def test_groups_of_rows_that_share_an_id(spark):
    """Rows with a null or repeated id and different texts are different sets, each with links of its own."""
    def near(name, end=""):
        return " ".join(f"{name}{i}" for i in range(60)) + end

    rows = [(None, near("a")), (8, near("a", " x")), (None, near("b")), (7, near("b", " x")), (5, near("c")), (9, near("c", " x")),
            (5, near("d")), (6, near("d", " x")), (None, "alone"), (5, "also alone"), (4, near("d", " y"))]
    rows += [(i, near(f"w{k}", f" {i}")) for k in range(6) for i in (None, 20, 30 + k)]
    texts = [(i, t) for i, (_, t) in enumerate(rows)]
    label = {i: g for i, _, g in brute.shingle_groups(texts)}
    least = {}
    for i, (k, _) in enumerate(rows):
        g = label[i]
        least[g] = min(least.get(g, (True, 99)), (k is not None, k or 0))
    sizes = {i: n for i, n, _ in brute.shingle_groups(texts)}
    want = sorted((k is not None, k or 0, sizes[i], least[label[i]]) for i, (k, _) in enumerate(rows))
    for order, block in ((rows, 3), (rows[::-1], 1000)):
        out = jaccard_join.shingle_groups(spark.createDataFrame(order, "doc_id long, text string"), block=block).collect()
        assert sorted((r.id is not None, r.id or 0, r.n_shingles, (r.component is not None, r.component or 0)) for r in out) == want


def test_pipeline(spark):
    folder = SMALL
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bad = {r.id for r in toxicity.score_toxicity(docs, labels).where("predicted = 1").collect()}
    rows = [x for x in pairs(docs) if x[0] not in bad]
    groups = brute.shingle_groups(rows)
    rows = [(i, t) for i, t in rows if i in {g[0] for g in groups if g[0] == g[2]}]
    left = {i for i, n, gone, _ in brute.substring_dedup(rows) if gone == 0 or gone < n}
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out} == left
    total = {r.doc_id: r.doc_tokens for r in out}
    assert sum(r.length for r in out) == sum(total.values())


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Columns with names of the stages' own, null ids, and tables without rows."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("_row", F.lit("x")).withColumn("component", F.lit(1)).withColumn("row", F.lit(0))
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    blank = docs.withColumn("doc_id", F.lit(None).cast("long")).limit(20)
    docs.unionAll(blank).write.parquet(f"{tmp_path}/a/documents.parquet")
    labels.write.parquet(f"{tmp_path}/a/labels.parquet")
    rows, want = (spark.read.parquet(f"{tmp_path}/a/documents.parquet"), docs.columns)
    for i, (_, apply) in enumerate(corpus_pipeline.STAGES[:-1]):
        apply(spark, rows, f"{tmp_path}/a").write.parquet(f"{tmp_path}/a/{i}")
        rows = spark.read.parquet(f"{tmp_path}/a/{i}")
        assert rows.columns == want
    assert corpus_pipeline.pack_sequences(spark, rows, f"{tmp_path}/a").count() >= rows.count() > 0
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    labels.write.parquet(f"{tmp_path}/b/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").collect() == []


def test_equal_rows_are_dealt_apart(spark, tmp_path):
    """20,000 rows equal in id and text lie in many buckets; results are those of the plain versions."""
    rows = [(None, "one boilerplate text of seven words here")] * 20000 + [(i, f"text {i} of {i % 7} and more words than five") for i in range(1000)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    dealt = dealing.deal(docs, "doc_id", "text", per_partition=64)
    assert max(r["count"] for r in dealt.groupBy("bucket").count().collect()) < 1000
    out = jaccard_join.shingle_groups(docs).groupBy("id", "n_shingles", "component").count().where("count > 1").collect()
    assert [tuple(r) for r in out] == [(None, 3, None, 20000)]


def test_pipeline_decides_per_row(spark, tmp_path):
    def text(name, end=""):
        return " ".join(f"{name}{'abcdefgh'[i % 8]}{'xyzuvw'[i // 8]}" for i in range(40)) + end

    rows = [(i, f"some words here {'maldad' if i % 2 else 'bondad'}") for i in range(200)]
    spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(i, f"{t} {text('t' + chr(97 + i % 26) + chr(97 + i // 26))}") for i, t in rows]
    clean = [(None, text("p")), (None, text("q")), (None, text("q", " end")), (900, text("r")), (901, text("s")), (901, text("q", " fin")),
             (902, text("s", " end")), (None, None)]
    odd = [(None, text("u", " maldad")), (900, text("v", " maldad"))]
    docs = spark.createDataFrame(rows + clean + odd, "doc_id long, text string")
    corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/kept")
    kept = spark.read.parquet(f"{tmp_path}/kept")
    left = [(r.doc_id, r.text) for r in kept.collect() if r.doc_id is None or r.doc_id >= 900]
    assert sorted(left, key=str) == sorted(clean, key=str)
    out = corpus_pipeline.keep_one_of_a_group(spark, kept, str(tmp_path))
    assert out.columns == docs.columns
    left = [(r.doc_id, r.text) for r in out.collect() if r.doc_id is None or r.doc_id >= 900]
    assert len(left) == 5 and {(None, text("p")), (900, text("r")), (901, text("s")), (None, None)} <= set(left)
    assert sum(i is None and (t or "").startswith("qax") for i, t in left) == 1
