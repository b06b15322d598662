"""Benchmark passages in training texts (hash set of normalised n-grams), with columns only.

A window is ``window`` consecutive words of an item; an item of fewer words is one window.  Any window of
n words holds a chunk of c = (n + 1) // 2 words that starts at a multiple of c in the text where it
occurs, so texts look up their disjoint chunks only, and the windows around a chunk that is known.
Both look-ups are hash joins with a broadcast table whose size is measured; a larger set of windows is
cut into slices below ``broadcast_bytes`` and the texts are scanned once a slice.  Keys are the words
themselves, so a hit is an occurrence and not a collision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.config import keep, shared_dir

WINDOW = 10
BROADCAST_BYTES = 32 << 20
#: Bytes of a table row beside its text, as counted for the bound.
ROW_BYTES = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters between words: ASCII but for digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same, before letters are made small.
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words(text: Column) -> Column:
    """Normalised words of a text; a null text has none."""
    small = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(small, BETWEEN), "")


def _run(source: str, begin: Column, length: Column) -> Column:
    return F.array_join(F.slice(source, begin + 1, length), " ")


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Columns ``item``, ``length`` and ``words`` (joined by a space), each window of an item once."""
    rows = items.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("item"), words(F.col(f"`{text}`")).alias("w"))
    rows = rows.withColumn("n", F.size("w")).withColumn("length", F.least("n", F.lit(window))).where("n > 0")
    rows = rows.withColumn("begin", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("length"))))
    return rows.select("item", "length", _run("w", F.col("begin"), F.col("length")).alias("words")).distinct()


def _numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("id"),
                       F.col(f"`{text}`").alias("text"))


def _chunks(size: int) -> Column:
    """Disjoint chunks of a text of ``n`` words."""
    every = F.transform(F.sequence(F.lit(0), F.col("n") - size, F.lit(size)), lambda q: F.struct(q.alias("at"), F.lit(size).alias("size")))
    return F.when(F.col("n") >= size, every).otherwise(F.expr("array()").cast("array<struct<at:int,size:int>>"))


def _around(length: int, size: int) -> Column:
    """Windows of ``length`` words that hold the chunk."""
    first = F.greatest(F.lit(0), F.col("chunk.at") - (length - size))
    every = F.transform(F.sequence(first, F.col("chunk.at")), lambda p: F.struct(p.alias("begin"), F.lit(length).alias("length")))
    return F.when(F.col("chunk.size") == size, every).otherwise(F.expr("array()").cast("array<struct<begin:int,length:int>>"))


def _scan(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per text and known window in it (``hit``: begin, length, window), and one at least per text with a null hit."""
    half = lambda n: (n + 1) // 2
    cut = F.expr("(length + 1) div 2").cast("int")
    grams = windows.withColumn("w", F.split("words", " ")).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("length") - cut)))
    grams = grams.select(_run("w", F.col("at"), cut).alias("gram"), F.lit(True).alias("known")).distinct()

    texts = docs.select("row", "id", words(F.col("text")).alias("w")).withColumn("n", F.size("w"))
    chunks = [_chunks(c) for c in sorted({half(n) for n in lengths})]
    texts = texts.select("row", "id", "w", "n", F.explode_outer(F.concat(*chunks)).alias("chunk"))
    texts = texts.withColumn("gram", _run("w", F.col("chunk.at"), F.col("chunk.size")))
    # a text without any known chunk goes on as its first chunk
    near = texts.join(F.broadcast(grams), "gram", "left").where("known or coalesce(chunk.at, 0) = 0")
    around = F.filter(F.concat(*[_around(n, half(n)) for n in lengths]), lambda s: s["begin"] + s["length"] <= F.col("n"))
    near = near.select("row", "id", "w", "n", F.explode_outer(F.when(F.col("known"), around)).alias("at"))
    near = near.withColumn("words", _run("w", F.col("at.begin"), F.col("at.length")))
    found = near.join(F.broadcast(windows.select("words", "window")), "words", "left")
    hit = F.when(F.col("window").isNotNull(), F.struct("at.begin", "at.length", "window"))
    return found.select("row", "id", F.col("n").cast("long").alias("n_words"), hit.alias("hit"))


def _leaks(numbered: DataFrame, items: DataFrame, item_key: str, item_text: str, window: int, broadcast_bytes: int, folder: str) -> DataFrame:
    spark = numbered.sparkSession
    of_item = keep(item_windows(items, item_key, item_text, window), f"{folder}/item-windows")
    windows = of_item.select("length", "words").distinct().withColumn("window", F.monotonically_increasing_id())
    windows = keep(windows, f"{folder}/windows")  # the number is fixed by the write
    # a window of n words brings n - (n + 1) // 2 + 1 chunks, which half of its words fill
    size = (F.octet_length("words") + ROW_BYTES) * (F.col("length") / 2 + 2)
    of_length = windows.groupBy("length").agg(F.sum(size).alias("bytes")).collect()  # at most `window` rows
    lengths = sorted(r["length"] for r in of_length) or [window]
    slices = max(1, int(-(-sum(r["bytes"] for r in of_length) // broadcast_bytes)))
    if slices > 1:
        numbered = keep(numbered, f"{folder}/numbered")  # read once a slice, with the same numbers
    slice_of = F.pmod(F.xxhash64("words"), F.lit(slices))
    scans = [_scan(numbered, windows.where(slice_of == s) if slices > 1 else windows, lengths) for s in range(slices)]
    hits = scans[0]
    for more in scans[1:]:
        hits = hits.unionAll(more.where("hit is not null"))

    found = hits.groupBy("row").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.collect_set("hit").alias("hits"))
    places = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["begin"], h["begin"] + h["length"] - 1))))
    found = found.select("row", "id", "n_words", F.array_sort(places).alias("hit_words"),
                         F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["window"]))).alias("windows"))
    found = keep(found, f"{folder}/found")

    # texts that hold the same windows have the same items: each set of windows is resolved once
    sets = found.where("size(windows) > 0").select("windows").distinct().withColumn("set_no", F.monotonically_increasing_id())
    sets = keep(sets, f"{folder}/sets")
    named = windows.join(of_item, ["length", "words"]).select("window", "item")
    in_set = sets.select("set_no", F.explode("windows").alias("window")).join(named, "window").groupBy("set_no")
    in_set = in_set.agg(F.array_sort(F.collect_set("item")).alias("items"))
    digests = keep(sets.join(in_set, "set_no").select("windows", "items"), f"{folder}/digests")
    clean = found.where("size(windows) = 0").withColumn("items", F.expr("array()").cast("array<string>"))
    return found.where("size(windows) > 0").join(digests, "windows").select(*clean.columns).unionAll(clean).drop("windows")


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
               item_text: str = "text", window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_words``, ``hit_words`` (places of words inside a window, rising) and
    ``items`` (ids, as strings, of items with a window in the text, sorted).

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case.  Null and empty texts
    have no words and no hits; items without words have no window.  Items that share an id are one
    item; a null id is named by the empty string.  Rows equal in id and text each have their own result.
    ``docs`` has to be read from files, or written: a row's number is its place there.
    """
    found = _leaks(_numbered(docs, key, text), items, item_key, item_text, window, broadcast_bytes, shared_dir(docs.sparkSession))
    return found.drop("row")


def remove_leaks(docs: DataFrame, items: DataFrame, how: str = "spans", key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", window: int = WINDOW,
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without benchmark passages, all columns kept as they are.

    ``how="documents"``: rows with a hit go.  ``how="spans"``: words inside a hit go, each with what stands
    between it and the next word; texts without a hit stay byte for byte.  Null texts stay null.
    """
    if how not in ("spans", "documents"):
        raise ValueError(f"how must be 'spans' or 'documents', not {how!r}")
    folder = shared_dir(docs.sparkSession)
    named = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    numbered = keep(docs.select(F.monotonically_increasing_id().alias("row"), named), f"{folder}/rows")
    source = numbered.select("row", F.col(f"whole.`{key}`").cast("long").alias("id"), F.col(f"whole.`{text}`").alias("text"))
    found = _leaks(source, items, item_key, item_text, window, broadcast_bytes, folder).where("size(hit_words) > 0")
    if how == "documents":
        return numbered.join(found.select("row"), "row", "left_anti").select("whole.*")
    joined = numbered.join(found.select("row", "hit_words"), "row", "left")
    body = F.col(f"whole.`{text}`")
    pieces = F.regexp_extract_all(body, F.lit(f"([^{BETWEEN_ANY_CASE[1:-1]}]+{BETWEEN_ANY_CASE}*)"))
    head = F.regexp_extract(body, f"^{BETWEEN_ANY_CASE}*", 0)
    # words between two neighbouring hits; the ends stand for hits before and behind the text
    edges = F.concat(F.array(F.lit(-1)), F.col("hit_words"), F.array(F.size("pieces")))
    gaps = F.zip_with(F.slice("edges", 1, F.size("edges") - 1), F.slice("edges", 2, F.size("edges")),
                      lambda a, b: F.array_join(F.slice("pieces", a + 2, b - a - 1), ""))
    cut = joined.withColumn("pieces", F.when(F.col("hit_words").isNotNull(), pieces)).withColumn("edges", edges)
    kept = F.when(F.col("hit_words").isNull(), body).otherwise(F.concat(head, F.array_join(gaps, "")))
    cut = cut.withColumn("kept", kept)
    return cut.select(*[F.col("kept").alias(c) if c == text else F.col(f"whole.`{c}`").alias(c) for c in docs.columns])
