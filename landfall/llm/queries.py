"""The operators of this subpackage bound to the shared tables.

``QUERIES`` and ``ORACLES`` are added to those of the library where this
subpackage is present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.bindings.registry import Query, table
from landfall.llm import bpe, chat, token_files, warc
from landfall.llm.centroids import clustered
from landfall.llm.decontaminate import contamination
from landfall.llm.embedding_dedup import vector_links
from landfall.llm.hard_negatives import hard_negatives
from landfall.llm.jaccard_join import near_duplicates
from landfall.llm.personal_data import personal_digests
from landfall.llm.quality_classifier import quality_scores
from landfall.llm.quality_rules import judged
from landfall.llm.secrets import secret_digests
from landfall.session import scratch_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


@query()
def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets, and parts of credentials that belong together."""
    return secret_digests(table(spark, sf_dir, "documents"))


# All pairs that share a shingle are counted, and links are followed row by row.
@query(f"""
    with recursive words as (
        select doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') as w from documents
    ), sets as (
        select doc_id, list_distinct(
            case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
                 else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) end) as s
        from words
    ), entries as (
        select doc_id, len(s) as n, unnest(s) as shingle from sets
    ), links as (
        select a.doc_id as a, b.doc_id as b from entries a join entries b on a.shingle = b.shingle and a.doc_id <> b.doc_id
        group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))
    ), reached(a, b) as (
        select doc_id, doc_id from sets union select reached.a, links.b from reached join links on reached.b = links.a
    )
    select doc_id, cast(len(s) as bigint) as n_shingles, min(b) as component_id
    from sets join reached on doc_id = a group by all
""")
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates by 3-word shingles at a similarity of 0.9."""
    return near_duplicates(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


@query()
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules with limits from the quantiles of each language and source."""
    return judged(table(spark, sf_dir, "documents"))


_ESCAPED = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&lsqb;')"


@query(f"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
    )
    select conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
           cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
           sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
           cast(sum(length({_ESCAPED.format("text")}) + 1 + case role when 'system' then 15 when 'user' then 13
                    when 'assistant' then 7 else 14 + length({_ESCAPED.format("role")}) end) as bigint) as formatted_chars
    from turns group by conv_id
""")
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as formatted texts, and one that is full of control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(control).alias("text"),
    )
    return chat.chat_digests(rows.unionByName(odd))


@query("""
    with payloads as (
        select page_id, cast(octet_length(encode(coalesce(html, ''))) as bigint) as payload_bytes,
               sha256(coalesce(html, '')) as payload_digest
        from pages
    ), firsts as (
        select payload_digest, min(page_id) as first from payloads where payload_bytes >= 100 group by 1
    )
    select page_id, payload_bytes, payload_digest,
           case when first <> page_id then 'revisit' else 'response' end as record_type,
           case when first <> page_id then first end as refers_to
    from payloads left join firsts using (payload_digest)
""")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


@query()
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality scores of all documents."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of byte-pair ids and of the text decoded from them."""
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query()
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written to ORC files in the order of documents, and read back."""
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_files.read_digests(spark, path)


@query()
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data by strict patterns and a weakly supervised classifier."""
    return personal_digests(table(spark, sf_dir, "documents"))


_PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


@query(f"""
    with docs as (
        select doc_id, regexp_extract_all({_LOWER.format("text")}, {_PLAIN}) as w from documents
    ), items as (
        select item_id, regexp_extract_all({_LOWER.format("text")}, {_PLAIN}) as w from benchmark
    ), sized as (
        select *, least(len(w), 10) as size from items where len(w) > 0
    ), windows as (
        select distinct item_id, size,
               unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) as run
        from sized
    ), places as (
        select doc_id, size, w, unnest(range(1, len(w) - size + 2)) as i
        from docs cross join (select distinct size from sized) where len(w) >= size
    ), found as (
        select doc_id, size, i, item_id
        from (select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as run from places) join windows using (size, run)
    ), hit as (
        select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(i, i + size)) as p from (select distinct doc_id, size, i from found)) group by 1
    ), listed as (
        select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
        from (select distinct doc_id, cast(item_id as varchar) as item from found) group by 1
    )
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
    from docs left join hit using (doc_id) left join listed using (doc_id)
""")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in documents."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# All pairs are compared, and links are followed row by row.
@query("""
    with recursive vectors as (
        select vec_id, cast(embedding as double[]) as v from embeddings
    ), usable as (
        select vec_id, v, list_dot_product(v, v) as square from vectors
        where len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and list_dot_product(v, v) > 0
    ), links as (
        select a.vec_id as a, b.vec_id as b from usable a join usable b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
        where list_dot_product(a.v, b.v) / (sqrt(a.square) * sqrt(b.square)) >= 0.9
    ), reached(a, b) as (
        select vec_id, vec_id from embeddings
        union select reached.a, links.b from reached join links on reached.b = links.a
    ), components as (
        select a as vec_id, min(b) as component_id from reached group by 1
    ), counted as (
        select a as vec_id, count(*) as n_links from links group by 1
    )
    select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
    from components left join counted using (vec_id)
""")
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked at a cosine of 0.9."""
    return vector_links(table(spark, sf_dir, "embeddings"))


@query("""
    with rows as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
               list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
        from embeddings
        where label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
        select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
               cast(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) as bigint) as score
        from rows a join rows b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
    ), positives as (
        select anchor_id, other_id as positive_id, score as positive_score from scored where same
        qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
    )
    select anchor_id, positive_id, other_id as negative_id, positive_score, score as negative_score,
           cast(row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as integer) as rank
    from positives join scored using (anchor_id)
    where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
    qualify rank <= 3
""")
def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; every seventh first gets the next label."""
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    )
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


def _rounds(count: int) -> str:
    """SQL of the rounds of centroid clustering, one after the other."""
    distance = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    steps = []
    for number in range(count + 1):
        steps.append(f"""
            near{number} as (
                select row, arg_min(cluster, (distance, cluster)) as cluster, min(distance) as distance
                from (select row, cluster, {distance} as distance from kept cross join centres{number}) group by row
            )""")
        if number < count:
            steps.append(f"""
            centres{number + 1} as (
                select cluster, coalesce(m, c) as c from centres{number} left join (
                    select cluster, list(cast(floor(x / n) as bigint) order by i) as m from (
                        select cluster, i, sum(v[i]) as x, count(*) as n
                        from near{number} join kept using (row) cross join range(1, 65) t(i) group by cluster, i
                    ) group by cluster
                ) using (cluster)
            )""")
    return ",".join(steps)


@query(f"""
    with kept as (
        select vec_id, row_number() over (order by vec_id) as row,
               list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
        from embeddings
        where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), centres0 as (
        select cast(row_number() over (order by sha256('1:' || vec_id), v) - 1 as integer) as cluster, v as c
        from kept order by sha256('1:' || vec_id), v limit 16
    ), {_rounds(3)}
    select vec_id, cluster, cast(distance as bigint) as distance,
           cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
           cast(sum(distance) over () as bigint) as inertia,
           sha256(array_to_string(c, ',')) as centroid_sha256
    from near3 join kept using (row) join centres3 using (cluster)
""")
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen centroids after three rounds, and each vector's distance to its own."""
    return clustered(table(spark, sf_dir, "embeddings"))
