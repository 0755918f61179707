"""One query per operator, over its whole table, and the SQL they are compared with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm.bpe_transducer import bpe_digests
from sievemark.llm.chat_prefix import conversation_digests, prefix_examples
from sievemark.llm.common import fold, hashed_sample, table
from sievemark.llm.decontamination import find_leaks
from sievemark.llm.html_consensus import extract_main_text
from sievemark.llm.language_zstd import fit_dictionaries, predict_language
from sievemark.llm.merkle_veb import document_proofs
from sievemark.llm.ngram_join import similar_documents
from sievemark.llm.periodic_runs import run_digests
from sievemark.llm.quality_ordinal import SAMPLE_TEXTS as SAMPLE_QUALITY
from sievemark.llm.quality_ordinal import OrdinalModel, fit_quality, score_quality
from sievemark.llm.secret_grammar import secret_digests
from sievemark.llm.simhash_ball import near_duplicates
from sievemark.llm.toxicity_kernel import SAMPLE_TEXTS as SAMPLE_TOXIC
from sievemark.llm.toxicity_kernel import fit_toxicity, score_toxicity
from sievemark.llm.winnowing import edited_fingerprints

Query = Callable[[SparkSession, str], DataFrame]


def simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


def bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def secret_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_digests(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def chat_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return conversation_digests(prefix_examples(talks.unionByName(own)))


def html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def language_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    model = fit_dictionaries(docs.filter(~held_out).select("lang", "text"))
    return predict_language(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


def labelled(spark: SparkSession, sf_dir: str, label: str, most: int, keep: Column | None = None) -> tuple[DataFrame, dict]:
    """Texts of about ``most`` labelled documents per label, chosen by hash, and how many there are of each label.

    The chosen ids are bounded by ``most`` per label, so they are broadcast and no text is shuffled.
    """
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_id"), label)
    labels = labels if keep is None else labels.filter(keep)
    chosen = hashed_sample(labels, label, "_id", most)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prior = {r[0]: r[1] for r in labels.filter(F.col(label).isNotNull()).groupBy(label).count().collect()}
    return docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).drop("_id"), prior


def quality_model(spark: SparkSession, sf_dir: str) -> OrdinalModel:
    rated, prior = labelled(spark, sf_dir, "quality", SAMPLE_QUALITY)
    return fit_quality(rated, grade="quality", prior=prior)


def quality_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, quality_model(spark, sf_dir)).drop("text")


def toxicity_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 5) == 0
    rated, prior = labelled(spark, sf_dir, "toxic", SAMPLE_TOXIC, fold("_id", 5) != 0)
    model = fit_toxicity(rated, prior=prior)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return score_toxicity(docs, model).drop("text")


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


def simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def merkle_veb(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return document_proofs(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)


# CRC-32 of a decimal number, bit by bit.
_CRC32 = """xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(cast({0} as varchar), ''), lambda ch: ascii(ch)::bigint)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)) + i)), 4294967295::bigint)"""


def _leaf_sql(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + "||".join(f"coalesce(strlen(cast({c} as varchar))||':'||cast({c} as varchar), '-')" for c in fields) + ")"


# Levels of all trees, then the way of each leaf through the levels of its language and those over the languages.
MERKLE_SQL = f"""with recursive leaves as (
    select doc_id, coalesce('='||lang, '') as tree, {_leaf_sql("n_chars")} as leaf,
      case when {_CRC32.format("doc_id")} % 7 = 0 and n_chars is not null then {_leaf_sql("n_chars+1")} end as tampered from documents),
  placed as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as n from leaves),
  levels as (select tree, 0 as lvl, pos, n, leaf as d from placed
    union all select tree, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(d, '' order by pos)) from levels where n > 1 group by tree, lvl, pos // 2, n),
  subroots as (select tree, d, row_number() over (order by encode(tree)) - 1 as pos, count(*) over () as n from levels where n = 1),
  tops as (select 0 as lvl, pos, n, d from subroots
    union all select lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(d, '' order by pos)) from tops where n > 1 group by lvl, pos // 2, n),
  ways as (select doc_id, leaf, tree, 0 as lvl, pos, n, coalesce(tampered, leaf) as cur, '' as proof, 0 as up from placed
    union all
    select w.doc_id, w.leaf, w.tree, case when w.n = 1 then 0 else w.lvl + 1 end, case when w.n = 1 then r.pos else w.pos // 2 end, case when w.n = 1 then r.n else (w.n + 1) // 2 end,
      case when w.n = 1 then w.cur when s.d is null then sha256(w.cur) when w.pos % 2 = 0 then sha256(w.cur||s.d) else sha256(s.d||w.cur) end,
      w.proof||case when w.n = 1 then '' else coalesce(s.d, '') end, case when w.n = 1 then w.up + 1 else w.up end
    from ways w join subroots r on r.tree = w.tree
      left join (select 0 as up, tree, lvl, pos, d from levels union all select 1, t.tree, tops.lvl, tops.pos, tops.d from tops, (select distinct tree from subroots) t) s
        on s.up = w.up and s.tree = w.tree and s.lvl = w.lvl and s.pos = w.pos + 1 - 2 * (w.pos % 2)
    where w.n > 1 or w.up = 0)
select w.doc_id, w.leaf, r.d as subroot, t.d as root, sha256(w.proof) as proof_sha256, w.cur as folded_root, w.cur = t.d as verified
from ways w join subroots r on r.tree = w.tree, (select d from tops where n = 1) t where w.up = 1 and w.n = 1"""


QUERIES: dict[str, Query] = {
    "op1_simhash_decontamination": simhash_decontamination,
    "op2_ngram_rtree_join": ngram_join,
    "op3_secret_grammar": secret_grammar,
    "op4_bpe_transducer": bpe_transducer,
    "op5_chat_prefix": chat_prefix,
    "op6_html_consensus": html_consensus,
    "op7_language_zstd": language_zstd,
    "op8_quality_ordinal": quality_ordinal,
    "op9_winnowing": winnowing,
    "op10_toxicity_kernel": toxicity_kernel,
    "op11_periodic_runs": periodic_runs,
    "op12_simhash_ball": simhash_ball,
    "op13_merkle_veb": merkle_veb,
}

ORACLE_SQL: dict[str, str] = {"op13_merkle_veb": MERKLE_SQL}
