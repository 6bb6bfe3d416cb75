"""The registered queries of the corpus operators, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetgauge.llm.batches import table
from fleetgauge.llm.bpe_stream import round_trip
from fleetgauge.llm.conversation_trie import conversation_trie
from fleetgauge.llm.fingerprints import fingerprint_documents
from fleetgauge.llm.jaccard_join import near_duplicates
from fleetgauge.llm.language_codes import fit_languages, predict_languages
from fleetgauge.llm.lattice import score_documents
from fleetgauge.llm.lexical_search import rank_documents
from fleetgauge.llm.packing import pack
from fleetgauge.llm.quality_trees import fit_quality, score_quality
from fleetgauge.llm.token_counts import count_tokens
from fleetgauge.llm.token_files import read_token_files, write_token_files
from fleetgauge.llm.toxicity import fit_toxicity, score_toxicity
from fleetgauge.llm.warc import read_archives, write_archives
from fleetgauge.session import new_scratch_path

END_ID = 2
SEQUENCE_TOKENS = 2048


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"), END_ID)
    return read_token_files(spark, folder)


def op5_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op6_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op8_prefix_hash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 0, SEQUENCE_TOKENS)


def op10_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict_languages(docs, fit_languages(docs))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_pipelined_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_warc_archives": op3_warc_archives,
    "op4_token_files": op4_token_files,
    "op5_lattice_scores": op5_lattice_scores,
    "op6_grouped_prefix_join": op6_grouped_prefix_join,
    "op7_quality_trees": op7_quality_trees,
    "op8_prefix_hash_fingerprints": op8_prefix_hash_fingerprints,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_trie_token_counts": op10_trie_token_counts,
    "op11_language_codes": op11_language_codes,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_pipelined_search": op13_pipelined_search,
}

_SHINGLES = """
    words as (
        select doc_id, row_number() over () as row_id,
            list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[ \\t-\\r]+'), lambda x: x <> '') as w
        from documents
    ),
    sets as (
        select doc_id, row_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
            else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
        from words
    )"""

_NEAR_DUPLICATES = f"""
with recursive {_SHINGLES},
    shingles as (select row_id, unnest(s) as shingle from sets),
    common as (
        select x.row_id as a, y.row_id as b, count(*) as n
        from shingles x join shingles y on x.shingle = y.shingle and x.row_id <> y.row_id group by 1, 2
    ),
    links as (
        select a, b from common join sets x on x.row_id = a join sets y on y.row_id = b
        where 100 * n >= 75 * (len(x.s) + len(y.s) - n)
    ),
    reached as (
        select row_id as a, row_id as b from sets
        union
        select reached.a, links.b from reached join links on links.a = reached.b
    )
select doc_id, len(s)::bigint as n_shingles,
    (select count(*) from links where links.a = row_id) as n_links,
    (select min(d.doc_id) from reached join sets d on d.row_id = reached.b where reached.a = sets.row_id) as component_id
from sets
"""

#: Groups of five bits, from the hexadecimal digest's 40 digits, as letters and digits of base 32.
_ARCHIVES = """
with hashed as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex from pages
),
lettered as (
    select page_id, payload_bytes, hex, (
        select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
            ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint) // (1 << (5 * (3 - i % 4)))) % 32)::int, 1), '' order by i)
        from range(32) t(i)
    ) as payload_digest
    from hashed
),
firsts as (
    select *, min(page_id) over (partition by hex, payload_bytes) as first from lettered
)
select page_id, payload_bytes, payload_digest,
    case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to
from firsts
"""

#: The checksum goes bit by bit: after each byte come eight steps, marked by -1.
_TRIE = """
with turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
            left(coalesce(text, ''), 16), sha1(coalesce(text, ''))) as position
    from conversations where conv_id is not null
),
heads as (
    select conv_id, xor(list_reduce(
        list_concat([4294967295::bigint], flatten(list_transform(string_split(conv_id::varchar, ''),
            lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, b: case when b >= 0 then xor(a, b) else xor(a >> 1, 3988292384 * (a & 1)) end
    ), 4294967295) % 6 as h
    from (select distinct conv_id from turns)
),
rebuilt as (
    select heads.conv_id, 0 as part, position, role, text
    from heads join turns on turns.conv_id = heads.conv_id - heads.conv_id % 100 and position <= h
    union all
    select heads.conv_id, 1, position, role, text from heads join turns on turns.conv_id = heads.conv_id and position > h
),
numbered as (
    select *, row_number() over (partition by conv_id order by part, position) as depth from rebuilt
),
prefixes as (
    select conv_id, 0 as depth, '' as node, null as above, 0 as chars from heads
    union all
    select conv_id, depth, array_to_string(own[:depth], ''), array_to_string(own[:depth - 1], ''), length(text)
    from numbered join (
        select conv_id, list(sha256(sha256(role) || sha256(text)) order by depth) as own from numbered group by conv_id
    ) using (conv_id)
),
nodes as (
    select depth, node, any_value(above) as above, min(conv_id) as conv_id, count(*) as n_convs, any_value(chars) as chars
    from prefixes group by depth, node
),
children as (select above as node, depth - 1 as depth, count(*) as n from nodes where depth > 0 group by 1, 2),
lengths as (select conv_id, max(depth) as whole from prefixes group by conv_id),
ends as (
    select depth, node, string_agg(conv_id::varchar, ',' order by conv_id) as ids
    from prefixes join lengths using (conv_id) where depth = whole group by 1, 2
),
below as (
    select up.depth, up.node, count(*) filter (where children.n is null) as n_leaves,
        sum((nodes.n_convs - 1) * nodes.chars)::bigint as saved
    from nodes left join children using (depth, node)
    join prefixes up on up.conv_id = nodes.conv_id and up.depth <= nodes.depth group by 1, 2
)
select nodes.conv_id, nodes.depth::bigint as depth, parents.conv_id as parent_conv_id, nodes.n_convs,
    coalesce(children.n, 0) as n_children, n_leaves, saved as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from nodes join below using (depth, node) left join children using (depth, node) left join ends using (depth, node)
left join nodes parents on parents.depth = nodes.depth - 1 and parents.node = nodes.above
"""

_SEARCH = """
with terms as (
    select d, doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from (select row_number() over () as d, * from documents)
),
asked as (
    select item_id, term, count(*) as repeats from (
        select item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from benchmark
    ) group by 1, 2
),
lengths as (select d, count(*) as n from terms group by 1),
totals as (select count(*) as n_docs, sum(n)::bigint as n_terms from lengths),
factors as (select d, 75 + (25 * n * n_docs) // n_terms as m from lengths, totals),
postings as (select d, doc_id, term, count(*) as tf from terms group by 1, 2, 3),
weights as (
    select term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)::double))::bigint as w
    from (select term, count(*) as df from postings group by 1), totals
),
scores as (
    select item_id, d, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
    from asked join postings using (term) join weights using (term) join factors using (d)
    group by 1, 2, 3
)
select item_id, rank, doc_id, score from (
    select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scores where score > 0
) where rank <= 20
"""

ORACLES: dict[str, str] = {
    "op12_conversation_trie": _TRIE,
    "op13_pipelined_search": _SEARCH,
    "op3_warc_archives": _ARCHIVES,
    "op6_grouped_prefix_join": _NEAR_DUPLICATES,
}
