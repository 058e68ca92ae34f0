"""The queries of the operators, each over its whole table, with production parameters."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (
    bpe,
    decontaminate,
    embedding_dedup,
    html_extract,
    line_dedup,
    near_dedup,
    pii,
    prefix_trie,
    quality_classifier,
    quality_rules,
    query,
    shards,
    source_divergence,
    token_counts,
)
from lakeloom.llm.common import given, written

SURROGATE_KEY = "documents-1"
HOLD_OUT = 5
LIKELY = 0.3


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_pii_surrogates")
def op1_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = given(spark, folder, "documents").select("doc_id", "text")
    return pii.replace(docs, SURROGATE_KEY, counter="n_entities")


@query("op2_near_dedup")
def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.label(given(spark, folder, "documents"))


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % HOLD_OUT == 0
    vectors = written(quality_classifier.measured(given(spark, folder, "documents")), "statistics")
    labels = given(spark, folder, "labels").select("doc_id", "quality").where(~held_out)
    scored = quality_classifier.scored(vectors, quality_classifier.fit(vectors.join(labels, "doc_id")))
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= LIKELY).cast("int").alias("predicted"),
    )


def digests(docs: DataFrame) -> DataFrame:
    """The contract of byte-pair encoding: counts and digests of ids and of the text decoded from them."""
    encoded = bpe.encode(docs, vocabulary_path(), decoded="decoded", keep=["doc_id"])
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_bpe")
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(given(spark, folder, "documents").select("doc_id", "text"))


@query("op5_html_text")
def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_extract.extract(given(spark, folder, "pages"), keep=["page_id", "url"])
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


@query(
    "op6_line_dedup",
    f"""
    with docs as (select row_number() over () as r, doc_id, source, text, string_split(text, chr(10)) as parts from documents),
    lines as (
        select distinct r, source, trim(unnest(parts), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line from docs
        where source is not null and text is not null
    ),
    pages as (select source, count(*) as pages from docs group by source),
    dropped as (
        select source, list(line) as found from (
            select source, line, count(*) as n from lines where line <> '' group by source, line
        ) join pages using (source)
        where n >= {line_dedup.MIN_PAGES} and n > {line_dedup.MAX_RATIO} * pages group by source
    ),
    cleaned as (
        select doc_id, parts, list_filter(parts, lambda x: found is null or not list_contains(
            found, trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))) as rest
        from docs left join dropped using (source)
    )
    select doc_id, coalesce(len(parts), 0) as n_lines, coalesce(len(parts), 0) - coalesce(len(rest), 0) as n_dropped,
        case when parts is null then null else coalesce(array_to_string(rest, chr(10)), '') end as text
    from cleaned
    """,
)
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = given(spark, folder, "documents").select("doc_id", "source", "text")
    cleaned = line_dedup.drop_boilerplate(docs, counters=("n_lines", "n_dropped"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", "text")


@query("op7_shards")
def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.assign(given(spark, folder, "documents"))
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


# Edits that a cleaning step would make: personal data to place holders, runs of symbols away.
_EDITS = re.compile(
    r"(?P<mail>(?<![\w.+-])[\w.+-]{1,64}@[\w-]+(?:\.[\w-]+)+)|(?P<address>\b\d{1,3}(?:\.\d{1,3}){3}\b)|(?P<number>\d{9,})|(?P<symbols>[%&*$#!]{2,})"
)
_PLACE_HOLDERS = {"mail": "[mail]", "address": "[address]", "number": "[number]", "symbols": ""}


def cleaning_edits(text: str | None) -> list[dict]:
    found = _EDITS.finditer(text or "")
    return [{"start": m.start(), "end": m.end(), "new": _PLACE_HOLDERS[m.lastgroup]} for m in found]


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = given(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_through_edits(docs, vocabulary_path(), cleaning_edits, keep=["doc_id"])
    return counted.withColumnsRenamed({"tokens_before": "n_tokens_before", "edits": "n_edits", "tokens": "n_tokens"})


@query("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(given(spark, folder, "documents"), given(spark, folder, "benchmark"))


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = given(spark, folder, "documents").select("doc_id", "text")
    trusted = given(spark, folder, "labels").where("quality = 1")
    judged = quality_rules.judge(docs, quality_rules.fit(docs, trusted))
    return judged.select("doc_id", *(F.col("quality")[k].alias(k) for k in (*quality_rules.BASE, "ratio", "kept")))


@query(
    "op11_embedding_dedup",
    f"""
    with recursive doubles as (
        select vec_id, label, embedding, list_transform(embedding, lambda x: x::double) as v from embeddings
    ),
    usable as (
        select vec_id, label, v from doubles
        where label is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or isnan(x) or isinf(x))) = 0
            and len(list_filter(v, lambda x: x <> 0)) > 0
    ),
    links as (
        select a.vec_id as a, b.vec_id as b from usable a join usable b
            on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
        where list_cosine_similarity(a.v, b.v) >= {embedding_dedup.SIMILARITY}
    ),
    reached(a, b) as (select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a),
    least as (select a, min(b) as b from reached group by a),
    degree as (select a, count(*) as n from links group by a)
    select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(least.b, vec_id)) as component_id,
        vec_id = least(vec_id, coalesce(least.b, vec_id)) as kept
    from embeddings left join least on vec_id = least.a left join degree on vec_id = degree.a
    """,
)
def op11_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.label(given(spark, folder, "embeddings"))


@query(
    "op12_source_divergence",
    f"""
    with docs as (
        select row_number() over () as r, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source
        from documents
    ),
    tokens as (
        select r, lang, source, translate(
            unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
        ) as term from docs
    ),
    counted as (select lang, source, term, count(*) as c, count(distinct r) as d from tokens group by all),
    kept as (select lang, term, sum(c) as total from counted group by all having sum(d) >= {source_divergence.MIN_DOCUMENTS}),
    sizes as (select lang, count(*) as v, sum(total) as n_lang from kept group by lang),
    seen as (select lang, source, sum(c) as n from counted join kept using (lang, term) group by all),
    members as (
        select lang, source, coalesce(n, 0) as n, coalesce(v, 0) as v, coalesce(n_lang, 0) as n_lang
        from (select distinct lang, source from docs) left join seen using (lang, source) left join sizes using (lang)
    ),
    shares as (
        select m.lang, m.source, k.term, coalesce(c, 0) as c,
            1 + ({source_divergence.SCALE}::hugeint * (coalesce(c, 0) + 1)) // (m.n + m.v) as p,
            1 + ({source_divergence.SCALE}::hugeint * (k.total + 1)) // (m.n_lang + m.v) as q
        from members m join kept k using (lang) left join counted using (lang, source, term)
    ),
    pairs as (
        select a.lang, a.source, 'pair' as part, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
        from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
    ),
    every as (
        select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0) as value
        from members a join members b on a.lang = b.lang and a.source <> b.source
        left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
    ),
    used as (select lang, source, 'term' as part, term as item, (p - q) * (p - q) // q as value from shares where c > 0 and p > q),
    ranked as (
        select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
        from (select * from every union all select * from used)
    )
    select lang, source, part, item, value::bigint as value, rank::int as rank from ranked
    where part = 'pair' or rank <= {source_divergence.TOP_TERMS}
    """,
)
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.audit(given(spark, folder, "documents"))


@query(
    "op13_prefix_trie",
    f"""
    with said as (
        select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
            row_number() over (partition by conv_id order by turn nulls first) as j
        from conversations where conv_id is not null
    ),
    own as (select c, list({{'role': role, 'text': text}} order by j) as turns from said group by c),
    -- The checksum of the decimal digits, bit by bit: -1 stands for a shift.
    heads as (
        select c, turns, xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(c::varchar, ''),
            lambda d: [ord(d)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, (a & 1) * 3988292384) end), 4294967295) % {prefix_trie.HEADS} as h
        from own
    ),
    rebuilt as (
        select a.c, list_concat(coalesce(list_slice(b.turns, 1, a.h), []), coalesce(list_slice(a.turns, a.h + 1, len(a.turns)), [])) as turns
        from heads a left join own b on b.c = a.c - a.c % {prefix_trie.BASES}
    ),
    rows as (
        select c, len(turns) as n, d, list_slice(turns, 1, d) as prefix, list_slice(turns, 1, d - 1) as parent
        from (select c, turns, unnest(range(len(turns) + 1)) as d from rebuilt)
    ),
    nodes as (
        select d, prefix, any_value(parent) as parent, min(c) as conv_id, count(*) as n_convs,
            sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where n = d), '')) as ends_sha256,
            (count(*) - 1) * coalesce(length(prefix[d].text), 0) as saved
        from rows group by d, prefix
    ),
    children as (select p.d, p.prefix, count(*) as n_children from nodes p join nodes x on x.d = p.d + 1 and x.parent = p.prefix group by all),
    below as (
        select p.d, p.prefix, sum(x.saved) as saved_tokens, count(*) filter (where k.n_children is null) as n_leaves
        from nodes p join nodes x on x.d >= p.d and list_slice(x.prefix, 1, p.d) = p.prefix
        left join children k on k.d = x.d and k.prefix = x.prefix group by all
    )
    select x.conv_id, x.d as depth, p.conv_id as parent_conv_id, x.n_convs, coalesce(k.n_children, 0) as n_children,
        b.n_leaves, b.saved_tokens::bigint as saved_tokens, x.ends_sha256
    from nodes x join below b on b.d = x.d and b.prefix = x.prefix
    left join children k on k.d = x.d and k.prefix = x.prefix
    left join nodes p on x.d > 0 and p.d = x.d - 1 and p.prefix = x.parent
    """,
)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(given(spark, folder, "conversations"))
