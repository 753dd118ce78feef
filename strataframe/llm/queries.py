"""Queries of this subpackage: one for each operator, over the whole of its table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, license_scan, ngram_join, packing, pu_quality, quality_rules, sharding, sstable, substring_dedup, weighted_fingerprint
from .common import new_folder, table

BYTE_RANKS, BYTE_BPE, WORD_BPE = (public_tokenizers.path(f) for f in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json"))
SHARD_NAMES = [f"shard-{i:03d}" for i in range(sharding.SHARDS)]


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = BYTE_RANKS
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(documents, ranks, keep_text=False), ranks)
    return coded.select("doc_id", F.octet_length("ids").cast("long").__truediv__(4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, _ = pu_quality.train(documents, table(spark, sf_dir, "labels"))
    scored = pu_quality.score(documents, model)
    return scored.select("doc_id", pu_quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= pu_quality.THRESHOLD).cast("int").alias("predicted"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(documents)


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fingerprint.with_edits(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.shard(documents, SHARD_NAMES).select("doc_id", "shard")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(documents)
    return found.select("doc_id", "license", F.round("license_score", 6).alias("license_score"), F.col("license_matches").cast("long").alias("license_matches"), F.transform("license_all", lambda x: F.struct(x["license"].alias("license"), F.round(x["score"], 6).alias("score"))).alias("license_all"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge(documents, keep_text=False)
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "votes", F.round("posterior", 6).alias("posterior"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return packing.pack(documents, WORD_BPE, end_id=1, with_ids=False)


def op10_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    shards = sstable.write(documents, new_folder(spark, "op10"), BYTE_BPE, end_id=2)
    return sstable.read(spark, shards, with_ids=False)


QUERIES = {f.__name__: f for f in (op1_bpe, op2_pu_quality, op3_substring_dedup, op4_fingerprint, op5_sharding, op6_ngram_join, op7_license_scan, op8_quality_rules, op9_packing, op10_sstable)}
#: Learned weights, tokenizers, sampled fingerprints and byte windows are beyond SQL; their tests have brute force instead.
ORACLE: dict[str, str] = {
    "op5_sharding": f"select doc_id, ([{','.join(map(str, sharding.lookup_table(SHARD_NAMES)))}])[(('0x' || md5(coalesce(doc_id::varchar, '\\N'))[1:15])::bigint % {sharding.SIZE})::int + 1]::int as shard from documents",
    "op6_ngram_join": r"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
c as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)),
e as (select x, y from l union select y, x from l),
r(x, y) as (select x, y from e union select r.x, e.y from r join e on r.y = e.x)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least(w.doc_id, coalesce((select min(r.y) from r where r.x = w.doc_id), w.doc_id)) as component_id from w left join n on n.doc_id = w.doc_id""".replace("\\\\", "\\"),
}
