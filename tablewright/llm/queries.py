"""One query for each operator, with its production parameters, over whole tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fuzzy, hmm, lexical, lines, mixing, nearest, packing, passages, pii, quality, sharding, simhash, tries
from .common import documents, labels, table
from .registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


def token_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def held_out() -> Column:
    """Rows whose labels no model may learn from; a null key is none of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs.select("doc_id", "text"), labels(spark, sf_dir).filter(~held_out()))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op2_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = sharding.shard(documents(spark, sf_dir), shards=8)
    return done.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), token_file())


@query("op4_document_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy.edit_trial(documents(spark, sf_dir)).withColumnRenamed("edited", "edited_sha256")


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


@query("op6_approximate_nearest_neighbours")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


MIX_SQL = r"""
with d as (
    select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
        cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), md5(text), '')), 1, 13) as bigint)
            / cast(4503599627370496 as double) as draw
    from documents
), s as (
    select source, cast(sum(size) as bigint) as source_size,
        case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
    from d group by source
), c as (
    select *, 3 * source_size as cap,
        sum(source_size) over () as whole, sum(weight) over () as weights,
        coalesce(sum(3 * source_size) over before, 0) as capped, coalesce(sum(weight) over before, 0) as shut
    from s window before as (order by 3.0 * source_size / weight, source nulls last
        rows between unbounded preceding and 1 preceding)
), l as (
    select cast(whole - capped as double) / cast(weights - shut as double) as level from c
    where weight * (cast(whole - capped as double) / cast(weights - shut as double)) <= cap
    order by 3.0 * source_size / weight, source nulls last limit 1
), t as (
    select source, source_size, least(cast(cap as double), weight * level) as target,
        case when source_size > 0 then least(cast(cap as double), weight * level) / source_size else 0 end as rate
    from c, l
), j as (
    select d.doc_id, d.size, d.draw, t.* from d join t on d.source is not distinct from t.source
), k as (
    select j.*, turn, floor(rate) + case when draw + turn / cast(32 as double) - floor(draw + turn / cast(32 as double)) < rate - floor(rate)
        then 1 else 0 end as copies
    from j, (select cast(unnest(range(32)) as double) as turn)
), b as (
    select source, arg_min(turn, off) as turn from (
        select source, turn, row(abs(cast(sum(size * copies) as double) - any_value(target)), turn) as off
        from k group by source, turn) group by source
)
select k.doc_id, k.size, k.source_size, k.target, cast(k.size * k.copies as bigint) as taken
from k join b on k.source is not distinct from b.source and k.turn = b.turn
"""


@query("op7_source_mixing", MIX_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = mixing.taken(documents(spark, sf_dir))
    return done.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op8_personal_data")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(documents(spark, sf_dir))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans")
    )


LINES_SQL = r"""
with d as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as found, row_number() over () as n from documents
), p as (
    select n, doc_id, unnest(found) as line, unnest(range(len(found))) as place from d
), k as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from p
), h as (
    select key from k where key <> '' group by key having count(distinct n) >= 10
)
select any_value(k.doc_id) as doc_id, count(*) as n_lines, count(h.key) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by place) filter (where h.key is null), '')) as kept_sha256
from k left join h on k.key = h.key group by n
"""


@query("op9_line_dedup", LINES_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(documents(spark, sf_dir), least=10)
    return done.select(
        "doc_id",
        F.col("__lines").alias("n_lines"),
        F.col("__dropped").alias("n_dropped"),
        F.sha2("__kept", 256).alias("kept_sha256"),
    )


def hex_digest(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).hexdigest().encode()


@query("op10_substring_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = passages.dedup_passages(documents(spark, sf_dir), window=20, render=hex_digest)
    return done.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("kept_sha256"))


@query("op11_language_model")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    done = hmm.score_texts(documents(spark, sf_dir), held)
    return done.select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known",
        F.col("tokens").alias("train_tokens"), F.col("base").alias("base_score"), "score",
    )


# CRC-32 by its polynomial: a byte is added, then eight bits are shifted out.
TRIE_SQL = r"""
with ids as (
    select distinct conv_id from conversations where conv_id is not null
), h as (
    select conv_id, conv_id - conv_id % 5 as base, cast(xor(4294967295, list_reduce(
        list_prepend(cast(4294967295 as bigint), flatten(list_transform(string_split(cast(conv_id as varchar), ''),
            lambda c: list_concat([cast(ord(c) as bigint)], list_transform(range(8), lambda i: cast(-1 as bigint)))))),
        lambda s, b: case when b >= 0 then xor(s, b) when s % 2 = 1 then xor(s // 2, 3988292384) else s // 2 end)) % 9 as bigint) as h
    from ids
), t as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, body) - 1 as place, body, size
    from (select conv_id, turn, coalesce(role, '') as role, cast(octet_length(encode(coalesce(text, ''))) as bigint) as size,
        md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as body
        from conversations where conv_id is not null)
), r as (
    select h.conv_id, t.place, t.body, t.size from h join t on t.conv_id = h.base and t.place < h.h
    union all
    select h.conv_id, t.place, t.body, t.size from h join t on t.conv_id = h.conv_id and t.place >= h.h
), p as (
    select conv_id, row_number() over w as depth, md5(string_agg(body, '') over w) as path, size
    from r window w as (partition by conv_id order by place rows between unbounded preceding and current row)
    union all
    select conv_id, 0, '', 0 from ids
), n as (
    select depth, path, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size from p group by depth, path
), u as (
    select n.*, up.path as up, upper.conv_id as parent_conv_id from n
    left join p as up on up.conv_id = n.conv_id and up.depth = n.depth - 1
    left join n as upper on upper.depth = n.depth - 1 and upper.path = up.path
), c as (
    select depth - 1 as depth, up as path, count(*) as n_children from u where depth > 0 group by depth, up
), f as (
    select u.*, coalesce(c.n_children, 0) as n_children from u left join c on u.depth = c.depth and u.path = c.path
), s as (
    select a.depth, a.path, sum(case when f.n_children = 0 then 1 else 0 end) as n_leaves, sum((f.n_convs - 1) * f.size) as saved_tokens
    from f join p as a on a.conv_id = f.conv_id and a.depth <= f.depth group by a.depth, a.path
), e as (
    select depth, path, sha256(string_agg(cast(conv_id as varchar), ',' order by conv_id)) as ends
    from p where (conv_id, depth) in (select (conv_id, max(depth)) from p group by conv_id) group by depth, path
)
select f.conv_id, f.depth, f.parent_conv_id, f.n_convs, f.n_children, cast(s.n_leaves as bigint) as n_leaves,
    cast(s.saved_tokens as bigint) as saved_tokens, coalesce(e.ends, sha256('')) as ends_sha256
from f join s on f.depth = s.depth and f.path = s.path left join e on f.depth = e.depth and f.path = e.path
"""


@query("op12_conversation_trie", TRIE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = tries.paths(table(spark, sf_dir, "conversations"))
    return tries.prefix_trie(tries.rethreaded(held, block=5, most=9)).withColumnRenamed("ends", "ends_sha256")


SEARCH_SQL = r"""
with d as (
    select row_number() over () as row, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents
), s as (
    select row, count(*) as n from d group by row
), w as (
    select cast(count(*) as bigint) as documents, cast(sum(n) as bigint) as terms from s
), q as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
), p as (
    select row, any_value(doc_id) as doc_id, term, count(*) as tf from d where term in (select term from q) group by row, term
), f as (
    select term, cast(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) as bigint) as weight from p, w group by term, documents
), m as (
    select row, 50 + (50 * n * documents) // terms as m from s, w
), c as (
    select item_id, p.row, any_value(p.doc_id) as doc_id,
        cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
    from q join p on q.term = p.term join f on f.term = p.term join m on m.row = p.row group by item_id, p.row
), k as (
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as integer) as rank, doc_id, score
    from c where score > 0
)
select * from k where rank <= 50
"""


@query("op13_lexical_search", SEARCH_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), k=50)
