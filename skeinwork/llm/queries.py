"""The registered queries of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.llm import jaccard, licenses, lines, neighbours, packing, pieces, repeats, secrets, topk, toxicity
from skeinwork.llm.common import read


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"), k=3, percent=90)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_report(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "removed_lines", F.sha2("text", 256).alias("kept_sha256"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.largest_products(read(spark, sf_dir, "embeddings"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed(read(spark, sf_dir, "documents"), null_ids=True).drop("spans")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_best_fit_packing, op2_secret_scan, op3_ngram_jaccard, op4_line_dedup, op5_nearest_neighbours, op6_license_scan, op7_sentencepiece, op8_exact_top_k, op9_suffix_array_dedup, op10_toxicity)}

ORACLE: dict[str, str] = {
    "op4_line_dedup": f"""
        with l as (
          select doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) - 1 i
          from documents where text is not null and doc_id is not null
        ), h as (select *, ('0x' || substr(md5(line), 1, 8))::bigint h from l),
        b as (
          select *, coalesce((lag(h) over w * 1000003 + h) % {lines._MODULUS} % {lines.MEAN_LINES} = 0, false) ends
          from h window w as (partition by doc_id order by i)
        ), c as (
          select *, coalesce(sum(ends::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) chunk from b
        ), k as (
          select doc_id, chunk, min(i) first, count(*) n, string_agg(line, chr(10) order by i) t from c group by all having count(*) > 1
        ), r as (select *, row_number() over (partition by t order by doc_id, first) k from k),
        kept as (
          select doc_id, count(*) n_lines, count(*) filter (coalesce(k, 1) > 1) removed_lines,
            string_agg(line, chr(10) order by i) filter (coalesce(k, 1) = 1) text
          from c left join r using (doc_id, chunk) group by doc_id
        ) select d.doc_id, coalesce(n_lines, 0)::bigint n_lines, coalesce(removed_lines, 0)::bigint removed_lines,
          case when d.text is not null then sha256(coalesce(kept.text, '')) end kept_sha256
        from documents d left join kept using (doc_id)""",
    "op6_license_scan": licenses.oracle_sql(),
    "op8_exact_top_k": """
        with v as (
          select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) e from embeddings
          where embedding is not null and len(embedding) > 0
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
          select q.vec_id query_id, c.vec_id, list_dot_product(q.e::double[], c.e::double[])::bigint score
          from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
        ), r as (
          select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int rank, vec_id, score from s
        ) select query_id, rank, vec_id, score from r where rank <= 5""",
}
