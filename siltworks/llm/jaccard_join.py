"""Documents whose word-shingle sets are similar, and their groups (signature trees).

A set's tokens have one order everywhere (by hash).  Two sets with Jaccard similarity of t or more
share at least l tokens among the first ``n - ceil(t n) + l`` of each, whatever l; so, losing no link:

1. Buckets of documents name those leading tokens with l = (1 - t) n; a document goes on only if
   enough of its leading tokens are named by another document too.  Shared boilerplate is not enough.
2. Equal sets become one, with a number of its own (ids may be null or repeat) and the smallest id.  Buckets of sets learn how many sets have each token;
   now rarer tokens come first, so passages that many documents share come last.  Sets with a common
   token among the first ``n - ceil(t n) + 1`` fall into one coarse group, by stars and contraction.
3. Each coarse group is cut into blocks.  In a block a signature tree over the sets (OR-combined token
   bitmaps, size ranges) is traversed against itself, pruned by the greatest possible overlap and by
   groups joined already; leaves are verified exactly.  Each block also holds its group's first set;
   only sets that are not joined with it visit the group's other blocks.
4. The smallest id of each group's sets is its component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.config import keep, remove, shared_dir
from siltworks.llm import dealing
from siltworks.llm.components import components
from siltworks.llm.signature_tree import Labels, link
from siltworks.llm.words import LOWER, U64, Words, grams, mix

SHINGLE = 5
SHARE = (80, 100)
BLOCK = 1000


def least_common(n, share: tuple[int, int]):
    """Least overlap of a set of n with a similar one: ceil(t n)."""
    return -(-n * share[0] // share[1])


def wanted(n, share: tuple[int, int]):
    """Tokens that two leading parts must share, l: at least one, growing with n."""
    return np.maximum(1, n - least_common(n, share))


def shingle_sets(texts, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct shingles."""
    words = Words(texts, fold=LOWER)
    hashes = grams(words.hashes, shingle)
    out = []
    for i, (lo, n) in enumerate(zip(words.first[:-1], words.counts)):
        if n >= shingle:
            out.append(np.unique(hashes[lo:lo + n - shingle + 1]))
        elif n:
            out.append(grams(words.hashes[lo:lo + n], int(n)) ^ U64(int(n)))
        else:
            out.append(np.zeros(0, U64))
    return out


def _leading(s: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    n = len(s)
    return s[:n - least_common(n, share) + int(wanted(n, share))] if n else s


def shingle_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                   share: tuple[int, int] = SHARE, block: int = BLOCK) -> DataFrame:
    """One row per document: ``id``, ``n_shingles`` and ``component`` (smallest id reachable by links).

    Words are runs without ASCII white space, A-Z in lower case; a text with fewer words than a
    shingle is one shingle; a null or empty text has none and links with nothing (its component is its
    own id).  A null id sorts before all others and stays null where it is the component.  Rows that
    repeat an id are one class if their texts are similar.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark)
    ranges = dealing.key_ranges(docs)
    dealt = dealing.deal(docs, key, text)

    def name_tokens(table: pa.Table) -> pa.Table:
        lead = [_leading(s, share) for s in shingle_sets(table["text"], shingle)]
        keys, counts = np.unique(mix(np.concatenate(lead)) if lead else np.zeros(0, U64), return_counts=True)
        parts = list(dealing.cut(keys, ranges))
        return pa.table({
            "part": pa.array([p for p, _ in parts], pa.int32()),
            "bucket": pa.array([table["bucket"][0].as_py()] * len(parts), pa.int32()),
            "keys": dealing.lists([keys[s] for _, s in parts], pa.int64()),
            "again": dealing.lists([(counts[s] > 1).astype(np.int8) for _, s in parts], pa.int8())})

    named = dealt.groupBy("bucket").applyInArrow(name_tokens, "part int, bucket int, keys array<bigint>, again array<tinyint>")
    repeated = dealing.shared_keys(named)

    def describe(left: pa.Table, right: pa.Table) -> pa.Table:
        known = np.sort(dealing.flat(right["keys"])[0].view(U64)) if len(right) else np.zeros(0, U64)
        sets = shingle_sets(left["text"], shingle) if len(left) else []
        first, second, kept = [], [], []
        for s in sets:
            first.append(int(mix(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64).view(np.int64)))
            second.append(int(mix(s ^ U64(0x14057B7EF767814F)).sum(dtype=U64).view(np.int64)))
            n = len(s)
            enough = n and int(dealing.member(mix(_leading(s, share)), known).sum()) >= wanted(least_common(n, share), share)
            kept.append(s.view(np.int64) if enough else None)
        return pa.table({"id": left["id"] if len(left) else pa.array([], pa.int64()), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                         "first": pa.array(first, pa.int64()), "second": pa.array(second, pa.int64()),
                         "tokens": pa.array(kept, pa.list_(pa.int64()))})

    described = dealt.groupBy("bucket").cogroup(repeated.groupBy("bucket")).applyInArrow(
        describe, "id bigint, n_shingles bigint, first bigint, second bigint, tokens array<bigint>")
    with_tokens = keep(described, f"{folder}/described-tokens")
    mine = F.coalesce("id", F.lit(dealing.NO_ID))
    sets = (with_tokens.where("tokens is not null").groupBy("first", "second")
            .agg(F.min(mine).alias("least"), F.first("tokens").alias("tokens")))
    sets = keep(sets.withColumn("set_id", F.monotonically_increasing_id()), f"{folder}/sets")  # fixed by the write
    described = with_tokens.select("id", "n_shingles", "first", "second", F.col("tokens").isNotNull().alias("listed"))
    described = keep(described, f"{folder}/described")
    remove(spark, f"{folder}/described-tokens")  # the tokens are in `sets`, once
    found = _labels(sets, folder, share, block, ranges).join(sets.select("set_id", "least"), "set_id")
    found = keep(found, f"{folder}/labels")
    # written, so that the join is over two plain shuffles and a large group's rows can be split
    leasts = keep(found.groupBy("label").agg(F.min("least").alias("group_least")), f"{folder}/leasts")
    found = found.join(leasts, "label").select("set_id", "group_least")

    named_sets = sets.select(F.col("first").alias("d1"), F.col("second").alias("d2"), "set_id", "least").join(found, "set_id", "left")
    named_sets = named_sets.select("d1", "d2", F.coalesce("group_least", "least").alias("label"))
    linked = described.where("listed").drop("listed")
    linked = linked.join(named_sets, (linked["first"] == named_sets["d1"]) & (linked["second"] == named_sets["d2"]), "left")
    alone = described.where("not listed").select("id", "n_shingles", mine.alias("label"))
    out = linked.select("id", "n_shingles", "label").unionAll(alone)
    return out.select("id", "n_shingles", F.nullif("label", F.lit(dealing.NO_ID)).alias("component"))


def _rarest(sets: DataFrame, share: tuple[int, int], ranges: int) -> DataFrame:
    """Each set's leading tokens in the order of (number of sets that have it, hash), but for those that
    it alone has: ``set_id``, ``lead``."""
    n = dealing.BUCKETS_PER_PARTITION * max(1, sets.rdd.getNumPartitions())
    dealt = sets.select(F.pmod(F.xxhash64("set_id"), F.lit(n)).cast("int").alias("bucket"), "set_id", "tokens")

    def name(table: pa.Table) -> pa.Table:
        keys, counts = np.unique(mix(dealing.flat(table["tokens"])[0].view(U64)), return_counts=True)
        parts = list(dealing.cut(keys, ranges))
        return pa.table({"part": pa.array([p for p, _ in parts], pa.int32()),
                         "bucket": pa.array([table["bucket"][0].as_py()] * len(parts), pa.int32()),
                         "keys": pa.array([dealing.squeeze(keys[s]) for _, s in parts], pa.binary()),
                         "counts": dealing.lists([counts[s] for _, s in parts], pa.int64())})

    def add_up(table: pa.Table) -> pa.Table:
        rows = [dealing.unsqueeze(k) for k in table["keys"].to_pylist()]
        _, back = np.unique(np.concatenate(rows), return_inverse=True)
        total = np.bincount(back, dealing.flat(table["counts"])[0]).astype(np.int64)[back]
        return pa.table({"part": table["part"], "bucket": table["bucket"],
                         "totals": dealing.lists(np.split(total, np.cumsum([len(r) for r in rows])[:-1]), pa.int64())})

    def lead(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left):
            tokens, sizes = dealing.flat(left["tokens"])
            keys, back = np.unique(mix(tokens.view(U64)), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            where = dict(dealing.cut(keys, ranges))
            for part, answer in zip(right["part"].to_pylist(), right["totals"]):
                total[where[part]] = answer.values.to_numpy()
            total = total[back]
            at = np.concatenate([[0], np.cumsum(sizes)])
            for lo, hi in zip(at[:-1], at[1:]):
                first = np.lexsort((tokens[lo:hi].view(U64), total[lo:hi]))[:hi - lo - least_common(int(hi - lo), share) + 1]
                out.append(tokens[lo:hi][first[total[lo:hi][first] > 1]])
        return pa.table({"set_id": left["set_id"] if len(left) else pa.array([], pa.int64()), "lead": dealing.lists(out, pa.int64())})

    named = dealt.groupBy("bucket").applyInArrow(name, "part int, bucket int, keys binary, counts array<bigint>")
    totals = named.groupBy("part").applyInArrow(add_up, "part int, bucket int, totals array<bigint>")
    return dealt.groupBy("bucket").cogroup(totals.groupBy("bucket")).applyInArrow(lead, "set_id bigint, lead array<bigint>")


def _labels(sets: DataFrame, folder: str, share: tuple[int, int], block: int, ranges: int) -> DataFrame:
    """Columns ``set_id``, ``label``: the smallest set linked with each set that may have links."""
    def leading(batches):
        """Per task: tokens with the least set that has them here (a null ``to``), and stars of the others."""
        ids, tokens = [], []
        for batch in batches:
            lead, sizes = dealing.flat(pa.chunked_array([batch["lead"]]))
            ids.append(np.repeat(batch["set_id"].to_numpy(), sizes))
            tokens.append(lead.view(U64))
        yield from _stars(np.concatenate(tokens) if tokens else np.zeros(0, U64), np.concatenate(ids) if ids else np.zeros(0, np.int64), True)

    def meet(batches):
        batches = list(batches)
        if batches:
            table = pa.Table.from_batches(batches)
            yield from _stars(table["token"].to_numpy().view(U64), table["a"].to_numpy(), False)

    shape = "token bigint, a bigint, b bigint"
    rarest = _rarest(sets, share, ranges)
    local = keep(rarest.mapInArrow(leading, shape), f"{folder}/leading")
    across = local.where("b is null").repartition("token").mapInArrow(meet, shape)
    edges = local.where("b is not null").unionAll(across).select("a", "b")
    coarse = keep(components(edges), f"{folder}/coarse")

    sizes = coarse.groupBy("component").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    placed = coarse.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = keep(placed, f"{folder}/placed")
    tokens_of = sets.select(F.col("set_id").alias("node"), "tokens")
    # the group's first set comes into every block, and only once into its own
    home = F.array("block")
    every = F.when((F.col("blocks") > 1) & (F.col("node") == F.col("component")), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(home)
    inside = placed.join(tokens_of, "node").withColumn("block", F.explode(every))

    def in_block(table: pa.Table) -> pa.Table:
        nodes, arrays = _sets_of(table)
        labels = Labels(len(nodes))
        link(arrays, share, labels)
        return pa.table({"node": nodes, "label": nodes[labels.all()],
                         "component": np.full(len(nodes), table["component"][0].as_py()),
                         "block": pa.array(np.full(len(nodes), table["block"][0].as_py()), pa.int32()),
                         "blocks": pa.array(np.full(len(nodes), table["blocks"][0].as_py()), pa.int32())})

    first = inside.groupBy("component", "block").applyInArrow(
        in_block, "node bigint, label bigint, component bigint, block int, blocks int")
    first = keep(first, f"{folder}/in-block")

    # Groups of several blocks: sets apart from the group's first set visit every later or other block.
    wide = first.where("blocks > 1")
    native = wide.select("node", "label", "component", "block", "blocks").where("node <> component or block = 0")
    with_tokens = native.join(tokens_of, "node")
    apart = with_tokens.where("label <> component")
    homes = apart.groupBy("component", F.col("block").alias("guest")).agg(F.lit(1).alias("one"))
    visits = apart.withColumn("guest", F.col("block")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    visits = visits.where("guest <> block").select("component", "block", "guest", "node", "tokens", F.lit(True).alias("visiting"))
    hosts = with_tokens.join(homes, "component").where("guest <> block")
    hosts = hosts.select("component", "block", "guest", "node", "tokens", F.lit(False).alias("visiting"))

    def between(table: pa.Table) -> pa.Table:
        visiting = table["visiting"].to_numpy()
        nodes, arrays, = table["node"].to_numpy(), [s.values.to_numpy().view(U64) for s in table["tokens"]]
        labels = Labels(len(nodes))
        if visiting.any() and not visiting.all():
            link(arrays, share, labels, visiting)
        to = nodes[labels.all()]
        other = to != nodes
        return pa.table({"a": nodes[other], "b": to[other]})

    crossing = visits.unionAll(hosts).groupBy("component", "block", "guest").applyInArrow(between, "a bigint, b bigint")
    edges = wide.select(F.col("node").alias("a"), F.col("label").alias("b")).unionAll(crossing)
    over = components(edges).select(F.col("node").alias("set_id"), F.col("component").alias("label"))
    return first.where("blocks = 1").select(F.col("node").alias("set_id"), "label").unionAll(over)


def _sets_of(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct sets of a block, smallest number first."""
    ids = table["node"].to_numpy()
    order = np.unique(ids, return_index=True)[1]
    tokens = table["tokens"].combine_chunks()
    return ids[order], [tokens[int(i)].values.to_numpy().view(U64) for i in order]


def _stars(tokens: np.ndarray, ids: np.ndarray, emit: bool):
    order = np.lexsort((ids, tokens))
    tokens, ids = tokens[order], ids[order]
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    lead = np.flatnonzero(new)
    hub = np.repeat(ids[lead], np.diff(np.append(lead, len(ids))))
    pairs = np.unique(np.stack([hub, ids])[:, hub != ids], axis=1)
    if emit:
        yield pa.RecordBatch.from_pydict({"token": tokens[lead].view(np.int64), "a": ids[lead], "b": pa.nulls(len(lead), pa.int64())})
    yield pa.RecordBatch.from_pydict({"token": pa.nulls(pairs.shape[1], pa.int64()), "a": pairs[0], "b": pairs[1]})
