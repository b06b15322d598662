"""The operators as queries over the given tables, with production parameters and whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.llm import (bpe, cap_filters, collocations, jaccard_join, katz, leaks, licences, packing, preferences,
                           ranked_search, substring_dedup, top_products, toxicity)
from siltworks.llm.base import query, table


@query("op1_license_scan")
def op1(spark, folder):
    out = licences.scan_licences(table(spark, folder, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op2_embedding_near_dedup", """
with recursive v as (
    select vec_id, label, list_transform(embedding, lambda x: x::double) as x from embeddings
), links as (
    select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.x, b.x) >= 0.98
), reach as (
    select vec_id, vec_id as other from embeddings
    union
    select reach.vec_id, links.b from reach join links on reach.other = links.a
), least as (
    select vec_id, min(other) as component_id from reach group by vec_id
)
select least.vec_id, (select count(*) from links where links.a = least.vec_id) as n_links, component_id,
    least.vec_id = component_id as kept
from least
""")
def op2(spark, folder):
    out = cap_filters.near_vectors(table(spark, folder, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                      (F.col("id") == F.col("component")).alias("kept"))


@query("op3_chat_format", """
with turns as (
    select conv_id, turn, role, text, '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) as shown,
        row_number() over (partition by conv_id order by turn, role, text) as place
    from conversations where conv_id is not null
), sides as (
    select conv_id // 2 as pair_id, conv_id % 2 as side, place, shown, role, text from turns
), differ as (
    select a.pair_id, min(a.place) as place from sides a left join sides b
        on a.pair_id = b.pair_id and a.place = b.place and a.side = 1 - b.side
        and a.role is not distinct from b.role and a.text is not distinct from b.text
    where b.pair_id is null group by a.pair_id
), sizes as (
    select pair_id, count(distinct side) as n_sides, max(place) as longest from sides group by pair_id
), shared as (
    select s.pair_id, n_sides, case when n_sides = 2 then coalesce(d.place - 1, longest) else 0 end as n_shared
    from sizes s left join differ d on s.pair_id = d.pair_id
), both_sides as (
    select h.pair_id, h.n_shared, t.side, t.place, t.shown, t.role, t.place > h.n_shared as free,
        sum(case when t.place > h.n_shared then length(t.shown) else 0 end) over
            (partition by t.pair_id, t.side order by t.place) - length(t.shown) as begun
    from shared h join sides t on h.pair_id = t.pair_id
), done as (
    select pair_id, side, any_value(n_shared)::int as n_shared, count(*) as n,
        coalesce(string_agg(shown, '' order by place) filter (where not free), '') as prompt,
        coalesce(string_agg(shown, '' order by place) filter (where free), '') as completion,
        coalesce(string_agg((begun + length(role) + 5)::bigint || '-' || (begun + length(shown) - 1)::bigint, ',' order by place)
            filter (where free and role = 'assistant'), '') as learned
    from both_sides group by pair_id, side
)
select coalesce(c.pair_id, r.pair_id) as pair_id, coalesce(c.n_shared, r.n_shared) as n_shared,
    coalesce(c.prompt, r.prompt) as prompt, c.completion as chosen, c.learned as chosen_learned,
    r.completion as rejected, r.learned as rejected_learned
from (select * from done where side = 0) c full join (select * from done where side = 1) r on c.pair_id = r.pair_id
""")
def op3(spark, folder):
    out = preferences.format_pairs(preferences.adjacent_pairs(table(spark, folder, "conversations")))

    def spans(name):
        shown = F.transform(name, lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string")))
        return F.array_join(shown, ",").alias(name)

    return out.select("pair_id", "n_shared", "prompt", "chosen", spans("chosen_learned"), "rejected", spans("rejected_learned"))


@query("op4_top_products", """
with v as (
    select row_number() over () as no, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
), scored as (
    select a.no, a.vec_id as query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint as score
    from v a join v b on a.no <> b.no where a.vec_id % 50 = 0
)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by no order by score desc, vec_id) as rank from scored) where rank <= 5
""")
def op4(spark, folder):
    return top_products.top_products(table(spark, folder, "embeddings"))


@query("op5_pack")
def op5(spark, folder):
    out = packing.pack(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "start", F.expr("octet_length(ids) div 4").cast("bigint").alias("length"),
                      F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op6_katz_backoff")
def op6(spark, folder):
    return katz.score_texts(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query("op7_substring_dedup")
def op7(spark, folder):
    out = substring_dedup.remove_repeated(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_bpe")
def op8(spark, folder):
    out = bpe.encode_texts(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op9_toxicity")
def op9(spark, folder):
    out = toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return out.withColumnRenamed("id", "doc_id")


@query("op10_jaccard_join")
def op10(spark, folder):
    out = jaccard_join.shingle_groups(table(spark, folder, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query("op11_benchmark_leaks", r"""
with d as (
    select row_number() over () as no, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from documents
), b as (
    select coalesce(item_id::varchar, '') as item, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from benchmark
), items as (
    select distinct item, least(len(w), 10) as n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') as words
    from (select item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as p from b where len(w) > 0)
), runs as (
    select no, n, p, array_to_string(w[p:p + n - 1], ' ') as words
    from (select no, w, n, unnest(range(1, len(w) - n + 2)) as p from d, (select distinct n from items) where len(w) >= n)
), hits as (
    select no, runs.n, p, item from runs join items using (words)
), places as (
    select no, count(distinct place) as n_hit from (select no, unnest(range(p, p + n)) as place from hits) group by no
), named as (
    select no, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
    from (select distinct no, item from hits) group by no
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join places using (no) left join named using (no)
""")
def op11(spark, folder):
    out = leaks.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_words", F.size("hit_words").cast("long").alias("n_hit"),
                      F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      (F.size("hit_words") > 0).alias("contaminated"))


@query("op12_ranked_search", r"""
with d as (
    select row_number() over () as no, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from documents
), b as (
    select row_number() over () as ask, item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from benchmark
), asked as (
    select ask, item_id, term, count(*) as repeats from (select ask, item_id, unnest(w) as term from b) group by all
), total as (
    select count(*) filter (where len(w) > 0) as big_n, sum(len(w))::bigint as big_l from d
), held as (
    select no, doc_id, n, term, count(*) as tf from (select no, doc_id, len(w) as n, unnest(w) as term from d) group by all
), weights as (
    select term, floor(1000 * ln((2 * big_n + 2) / (2 * df + 1)))::bigint as weight
    from (select term, count(*) as df from held group by term), total
), scored as (
    select ask, item_id, no, doc_id,
        sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * big_n) // big_l)))))::bigint as score
    from asked join weights using (term) join held using (term), total group by all
)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by ask order by score desc, doc_id) as rank from scored where score > 0) where rank <= 10
""")
def op12(spark, folder):
    out = ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.select(F.col("query").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


@query("op13_collocations", r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), worded as (
    select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces
), counted as materialized (
    select lang, k, phrase, count(*) as a from (
        select lang, k, array_to_string(w[p:p + k - 1], ' ') as phrase
        from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as p from worded, range(1, 5) t(k) where len(w) >= k))
    group by all
), sizes as (
    select lang, sum(a)::bigint as n from counted where k = 1 group by lang
), chosen as (
    select lang, k, phrase, a, string_split(phrase, ' ') as w from counted where k > 1 and a >= 30
), parts as materialized (
    select lang || chr(1) || phrase as part, a from counted where a >= 30
), cuts as (
    select c.lang, c.phrase, c.a, cut, l.a as l, r.a as r, ((2000000::hugeint * c.a) // (l.a::hugeint + r.a))::bigint as score
    from (select lang, phrase, a, cut, lang || chr(1) || array_to_string(w[1:cut], ' ') as head,
            lang || chr(1) || array_to_string(w[cut + 1:k], ' ') as tail
        from (select *, unnest(range(1, k)) as cut from chosen)) c
    join parts l on l.part = head join parts r on r.part = tail
), least_cut as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), inside as (
    select lang, phrase, max(a) as a from (
        select lang, a, array_to_string(w[p:p + m - 1], ' ') as phrase
        from (select *, unnest(range(1, k - m + 2)) as p from chosen, range(2, 4) t(m) where m < k))
    group by all
)
select c.lang, row_number() over (partition by c.lang order by score desc, c.a desc, c.phrase) as rank, c.phrase, c.a, l, r, n, score
from least_cut c join sizes using (lang) left join inside i on i.lang = c.lang and i.phrase = c.phrase
where i.a is null or 100 * i.a::hugeint < 80 * c.a::hugeint
qualify rank <= 2000
""")
def op13(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))
