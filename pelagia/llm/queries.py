"""The registered queries of this subpackage, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.llm.chunk_dedup import dedup_chunks
from pelagia.llm.jaccard_join import jaccard_components
from pelagia.llm.storage import short_batches
from pelagia.llm import (
    bin_packing,
    context_mixing,
    infill,
    itq_dedup,
    minhash,
    multiprobe,
    order_packing,
    reversed_search,
    source_mix,
    toxicity,
    warc,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return short_batches(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_itq_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return itq_dedup.near_duplicates(_table(spark, folder, "embeddings"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return context_mixing.lm_scores(_table(spark, folder, "documents"))


def op4_multiprobe(spark: SparkSession, folder: str) -> DataFrame:
    return multiprobe.nearest(_table(spark, folder, "embeddings"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(_table(spark, folder, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op6_bin_packing(spark: SparkSession, folder: str) -> DataFrame:
    out = bin_packing.sharded(_table(spark, folder, "documents"))
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_chunks(_table(spark, folder, "documents"))


def op9_order_packing(spark: SparkSession, folder: str) -> DataFrame:
    from public_tokenizers import path

    return order_packing.packed(_table(spark, folder, "documents"), path("word_bpe_49k.json"))


def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.sampled(_table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def op11_reversed_search(spark: SparkSession, folder: str) -> DataFrame:
    return reversed_search.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_infill(spark: SparkSession, folder: str) -> DataFrame:
    rows = infill.infilled(_table(spark, folder, "documents").select("doc_id", "text"))
    back = infill.restored(rows.drop("text"))
    return back.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_minhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    own = minhash.with_fingerprint(rows, "text", "fingerprint")
    both = minhash.with_next(own, "doc_id", {"text": "next_text", "fingerprint": "next_fingerprint"})
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - quarter), F.substr("next_text", F.lit(1), quarter))
    changed = minhash.with_fingerprint(both.withColumn("edited", edited), "edited", "edited_fingerprint")
    return changed.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        minhash.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        minhash.likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


QUERIES = {
    "op1_itq_dedup": op1_itq_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_context_mixing": op3_context_mixing,
    "op4_multiprobe": op4_multiprobe,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_bin_packing": op6_bin_packing,
    "op7_warc": op7_warc,
    "op8_chunk_dedup": op8_chunk_dedup,
    "op9_order_packing": op9_order_packing,
    "op10_source_mix": op10_source_mix,
    "op11_reversed_search": op11_reversed_search,
    "op12_infill": op12_infill,
    "op13_minhash": op13_minhash,
}

# Components of the graph with the columns a and b, both ways, of the table links.
_REACH = """
        reach as (select id, id other from nodes
            union select r.id, l.b from reach r join links l on l.a = r.other),
        least as (select id, min(other) component_id from reach group by id)"""

# Terms of op11 and units of op12.
_TERMS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
_UNITS = "[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+"

ORACLE_SQL: dict[str, str] = {
    "op1_itq_dedup": f"""
        with recursive fine as (
            select vec_id, label, cast(embedding as double[]) v from embeddings
            where label is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
              and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links as (
            select p.vec_id a, q.vec_id b from fine p join fine q
            on p.label = q.label and p.vec_id <> q.vec_id and len(p.v) = len(q.v)
            and list_cosine_similarity(p.v, q.v) >= 98e-2),
        nodes as (select vec_id id from embeddings),{_REACH}
        select vec_id, cast(coalesce(n, 0) as bigint) n_links, component_id, vec_id = component_id kept
        from embeddings join least on vec_id = id left join (select a, count(*) n from links group by a) on vec_id = a""",
    "op5_jaccard_join": f"""
        with recursive texts as (
            select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') w from documents),
        shingles as (
            select distinct doc_id, unnest(case when len(w) >= 5
                then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                when len(w) > 0 then [array_to_string(w, ' ')] else [] end) s from texts),
        sizes as (select doc_id, count(*) n from shingles group by doc_id),
        common as (
            select p.doc_id a, q.doc_id b, count(*) c from shingles p join shingles q
            on p.s = q.s and p.doc_id <> q.doc_id group by all),
        links as (
            select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * c >= 80 * (x.n + y.n - c)),
        nodes as (select doc_id id from documents),{_REACH}
        select d.doc_id, cast(coalesce(n, 0) as bigint) n_shingles, component_id,
               d.doc_id = component_id kept
        from documents d join least on d.doc_id = id left join sizes z on z.doc_id = d.doc_id""",
    "op7_warc": """
        with p as (
            select page_id, coalesce(html, '') html,
                   min(page_id) over (partition by coalesce(html, '')) first_id
            from pages)
        select page_id, cast(strlen(html) as bigint) payload_bytes, sha256(html) payload_digest,
               case when strlen(html) >= 100 and page_id > first_id then 'revisit' else 'response' end record_type,
               case when strlen(html) >= 100 and page_id > first_id then first_id end refers_to
        from p""",
    "op11_reversed_search": f"""
        with docs as (
            select row_number() over () r, doc_id, {_TERMS} t from documents),
        sized as (select r, doc_id, t, len(t) n from docs where len(t) > 0),
        total as (select count(*) docs, cast(sum(n) as bigint) terms from sized),
        items as (select distinct item_id, text from benchmark),
        asked as (
            select i, item_id, term, count(*) times
            from (select row_number() over () i, item_id, unnest({_TERMS}) term from items) group by all),
        counts as (
            select r, term, count(*) tf from (select r, unnest(t) term from sized)
            where term in (select term from asked) group by all),
        weights as (
            select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) w
            from counts, total group by term, docs),
        scores as (
            select i, item_id, r, doc_id, cast(sum(times * w *
                ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) as bigint) score
            from asked join counts using (term) join weights using (term) join sized using (r), total
            group by all),
        placed as (
            select *, row_number() over (partition by i order by score desc, doc_id nulls last) rank
            from scores where score > 0)
        select item_id, cast(rank as integer) rank, doc_id, score from placed where rank <= 20""",
    "op12_infill": f"""
        with h as (
            select doc_id, coalesce(text, '') text, sha256('42:' || coalesce(cast(doc_id as varchar), '')) h
            from documents),
        t as (
            select doc_id, text, regexp_extract_all(text, '{_UNITS}') t,
                {', '.join(f"cast('0x' || substr(h, {1 + 8 * k}, 8) as bigint) h{k + 1}" for k in range(4))}
            from h),
        c as (
            select *, len(t) n, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
                case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                    or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end form
            from t),
        p as (
            select *, array_to_string(t[1:a], '') x, array_to_string(t[a + 1:b], '') y,
                array_to_string(t[b + 1:], '') z from c)
        select doc_id, cast(n as bigint) n, form,
               cast(case when form <> 'plain' then length(x) end as bigint) prefix_chars,
               cast(case when form <> 'plain' then length(y) end as bigint) middle_chars,
               sha256(case form when 'plain' then text when 'psm' then '<P>' || x || '<S>' || z || '<M>' || y
                   else '<S>' || z || '<P>' || x || '<M>' || y end) output_sha256,
               sha256(text) restored_sha256
        from p""",
}
