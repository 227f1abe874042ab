"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.llm import (
    decontaminate,
    license_scan,
    line_dedup,
    packing,
    prefix_trie,
    quality_embed,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    tokenizer_align,
    toxicity,
    url_rules,
)
from tablesync.llm.common import shared_folder, table

TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
SHARDS = 24
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judged(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "mined")


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.withColumnRenamed("toxic", "label"))
    return toxicity.severities(docs, model)


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), with_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sharding.sized(table(spark, sf_dir, "documents"))
    path = f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"
    sharding.store_map(spark, sharding.new_map(sharding.measured(records), SHARDS), path, version=0)
    _, entries = sharding.load_map(spark, path)
    return sharding.assigned(records, entries).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def license_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents"))


def leaked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = quality_embed.fold() == 2
    learned = labels.where(~held_out).withColumnRenamed("quality", "label")
    return quality_embed.scored(docs, quality_embed.train(docs, learned)).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality_embed.THRESHOLD).cast("int").alias("predicted"),
    )


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduped(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", "kept_sha256"
    )


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def tokenizer_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokenizer_align.scored(tokenizer_align.alignments(docs, *map(public_tokenizers.path, ALIGNED)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": substrings,
    "op2_url_filter": urls,
    "op3_toxicity": toxic,
    "op4_packing": packed,
    "op5_sharding": shards,
    "op6_license_scan": license_hits,
    "op7_decontamination": leaked,
    "op8_simhash_near_dedup": near_duplicates,
    "op9_quality_classifier": quality,
    "op10_quality_rules": rules,
    "op11_line_dedup": lines,
    "op12_prefix_trie": conversation_trie,
    "op13_tokenizer_align": tokenizer_links,
}

ORACLE = {
    "op1_substring_dedup": r"""
        with texts as (
            select row_number() over () as row, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
            from documents
        ),
        starts as (
            select row, words, unnest(range(1, len(words) - 33)) as i from texts where len(words) >= 35
        ),
        windows as (select row, i, array_to_string(words[i : i + 34], ' ') as window_text from starts),
        repeated as (select window_text from windows group by window_text having count(*) > 1),
        hits as (select row, i from windows semi join repeated using (window_text)),
        gone as (select distinct row, unnest(range(i, i + 35)) as j from hits),
        placed as (select row, unnest(words) as word, generate_subscripts(words, 1) as j from texts),
        kept as (
            select row, string_agg(word, ' ' order by j) as kept_text, count(*) as n
            from placed anti join gone using (row, j)
            group by row
        )
        select doc_id, cast(len(words) as bigint) as n_words,
               cast(len(words) - coalesce(n, 0) as bigint) as n_removed,
               sha256(coalesce(kept_text, '')) as kept_sha256
        from texts left join kept using (row)
    """,
    "op11_line_dedup": r"""
        with texts as (
            select row_number() over () as row, doc_id, string_split(coalesce(text, ''), chr(10)) as lines
            from documents
        ),
        placed as (select row, unnest(lines) as line, generate_subscripts(lines, 1) as i from texts),
        keyed as (
            select row, i, line, translate(
                trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from placed
        ),
        common as (select key from keyed where length(key) >= 1 group by key having count(distinct row) >= 10),
        kept as (
            select row, count(*) as n, string_agg(line, chr(10) order by i) as kept_text
            from keyed anti join common using (key)
            group by row
        )
        select doc_id, cast(len(lines) as bigint) as n_lines,
               cast(len(lines) - coalesce(n, 0) as bigint) as n_dropped,
               sha256(coalesce(kept_text, '')) as kept_sha256
        from texts left join kept using (row)
    """,
    "op12_prefix_trie": r"""
        with turns as (
            select conv_id as conv, role, text,
                   row_number() over (partition by conv_id order by turn nulls first, role, text) as pos
            from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
                  from conversations where conv_id is not null)
        ),
        sizes as (select conv, count(*) as n from turns group by conv),
        crcs as (
            select conv, conv - conv % 100 as base,
                   xor(list_reduce(
                       list_transform(string_split(cast(conv as varchar), ''), lambda c: cast(ascii(c) as bigint)),
                       lambda crc, b: list_reduce(
                           [0, 1, 2, 3, 4, 5, 6, 7]::bigint[],
                           lambda x, k: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end,
                           xor(crc, b)),
                       4294967295), 4294967295) % 6 as head
            from sizes
        ),
        convs as (
            select crcs.conv, base, head, least(head, coalesce(b.n, 0)) as taken
            from crcs left join sizes as b on b.conv = base
        ),
        paths as (
            select c.conv, pos as depth, role, text from convs as c join turns as t on t.conv = c.base and pos <= head
            union all
            select c.conv, taken + pos - head, role, text from convs as c join turns as t on t.conv = c.conv and pos > head
        ),
        prefixes as (
            select conv, depth, length(text) as chars,
                   list([role, text]) over (partition by conv order by depth) as prefix
            from paths
            union all
            select conv, 0, 0, [] from convs
        ),
        placed as (
            select conv, depth, chars, min(conv) over (partition by depth, prefix) as node,
                   max(depth) over (partition by conv) = depth as is_end
            from prefixes
        ),
        nodes as (
            select node, depth, count(*) as n_convs, any_value(chars) as chars,
                   sha256(coalesce(string_agg(cast(conv as varchar), ',' order by conv) filter (is_end), '')) as ends_sha256
            from placed group by node, depth
        ),
        linked as (
            select n.*, p.node as parent from nodes as n left join placed as p on p.conv = n.node and p.depth = n.depth - 1
        ),
        children as (select parent as node, depth - 1 as depth, count(*) as n from linked where depth > 0 group by all),
        totals as (
            select a.node, a.depth, count(*) filter (c.n is null) as n_leaves,
                   sum((n.n_convs - 1) * n.chars) as saved_tokens
            from nodes as n
            join placed as a on a.conv = n.node and a.depth <= n.depth
            left join children as c on c.node = n.node and c.depth = n.depth
            group by a.node, a.depth
        )
        select l.node as conv_id, cast(depth as bigint) as depth, parent as parent_conv_id, n_convs,
               coalesce(c.n, 0) as n_children, n_leaves, cast(saved_tokens as bigint) as saved_tokens, ends_sha256
        from linked as l join totals using (node, depth) left join children as c using (node, depth)
    """,
}
