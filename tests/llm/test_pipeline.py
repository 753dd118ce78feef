"""Each stage of the pipeline against what it should keep, on small tables."""

import collections
import random
import re

import numpy as np
from pyspark.sql import functions as F
from test_operators import brute_components, plain_dedup

import corpus_pipeline
from strataframe.llm import pu_quality, quality_rules, substring_dedup
from strataframe.llm.queries import WORD_BPE

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def prose(rnd, n):
    return " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_rules_stage_keeps_what_the_operator_keeps(spark):
    rnd = random.Random(1)
    rows = [(i, prose(rnd, 80)) for i in range(30)] + [(40, "x"), (41, None), (42, ""), (43, "w### " * 90), (1, prose(rnd, 90)), (None, prose(rnd, 70))]
    docs = docs_of(spark, rows).withColumn("kept", F.lit("mine"))
    out = stage("quality_rules")(spark, docs, "")
    assert out.columns == corpus_pipeline.COLUMNS
    judged = quality_rules.judge(docs.select("doc_id", "text")).where("kept")
    assert kept(out) == kept(judged) and len(kept(out)) >= 30
    assert not {40, 41, 42, 43} & {i for i, _ in kept(out)}


def test_rules_stage_does_not_count_for_its_filter_too(spark):
    rnd = random.Random(4)
    out = stage("quality_rules")(spark, docs_of(spark, [(i, prose(rnd, 80)) for i in range(40)]), "")
    assert "regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 40


def test_classifier_stage_keeps_what_scores_enough(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i, prose(rnd, 80) if i % 3 else "### " * 60 + prose(rnd, 9)) for i in range(120)] + [(None, prose(rnd, 80)), (5, prose(rnd, 50))]
    docs = docs_of(spark, rows)
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = stage("quality_classifier")(spark, docs, str(tmp_path))
    model, _ = pu_quality.train(docs.select("doc_id", "text"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = [(i, t, model.score(np.array([pu_quality.measures(t, pu_quality.WordHashes())]))[0]) for i, t in rows]
    assert kept(out) == sorted([(i, t) for i, t, s in scores if s >= pu_quality.THRESHOLD], key=repr)


def test_near_duplicates_stage_keeps_one_row_of_each_group(spark):
    rnd = random.Random(3)
    base = [prose(rnd, 60) for _ in range(6)]
    rows = [(i, base[i % 6] + (f" end{i}" if i % 2 else "")) for i in range(24)] + [(30, None), (31, ""), (32, "one"), (33, "one")]
    rnd.shuffle(rows)
    out = kept(stage("near_duplicates")(spark, docs_of(spark, rows), ""))
    rows.sort()
    roots = brute_components([t for _, t in rows])
    assert out == sorted([rows[k] for k, (_, root) in enumerate(roots) if root == k], key=repr)


def test_near_duplicates_stage_tells_rows_of_one_identifier_apart(spark):
    long = " ".join(f"b{i}" for i in range(40))
    rows = [(0, "a a a"), (1, "a a a"), (1, long), (2, "zz " + long), (0, "a a a"), (None, "q q"), (None, "q q"), (None, "r r")]
    out = kept(stage("near_duplicates")(spark, docs_of(spark, rows), ""))
    assert out == sorted([(0, "a a a"), (1, long), (None, "q q"), (None, "r r")], key=repr)


def test_passages_stage_removes_repeats_and_emptied_documents(spark):
    rnd = random.Random(4)
    passage = prose(rnd, 60)
    rows = [(1, passage), (2, passage), (3, "own words\n" + passage), (4, None), (5, ""), (6, "a\nb")]
    out = kept(stage("passages")(spark, docs_of(spark, rows), ""))
    plain = plain_dedup(rows, substring_dedup.MIN_WORDS, substring_dedup.MIN_LINE)
    assert out == sorted([(i, t) for (i, _), (t, spans) in zip(rows, plain, strict=True) if not spans or t.strip()], key=repr)
    assert 2 not in [i for i, _ in out] and (4, None) in out
    lengths = {r.doc_id: r.n_chars for r in stage("passages")(spark, docs_of(spark, rows), "").collect()}
    assert lengths[3] == len(dict(out)[3])


def test_packing_stage_holds_each_id_once(spark):
    from tokenizers import Tokenizer

    rnd = random.Random(5)
    rows = [(i, prose(rnd, rnd.randint(1, 900))) for i in range(20)] + [(30, None), (3, "again")]
    pieces = stage("packing")(spark, docs_of(spark, rows), "").collect()
    known = Tokenizer.from_file(WORD_BPE)
    want = collections.Counter((i, len(known.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows)
    got = collections.defaultdict(int)
    for r in pieces:
        got[r.doc_id] += r.length
    assert got == {i: sum(n for (j, n), times in want.items() if j == i for _ in range(times)) for i, _ in rows}
    filled = collections.defaultdict(list)
    for r in pieces:
        filled[r.sequence_id].append((r.offset, r.length))
    for cells in filled.values():
        at = 0
        for offset, length in sorted(cells):
            assert offset == at
            at += length
        assert at <= 2048


def test_all_stages_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, docs_of(spark, []), str(tmp_path))
        assert out.count() == 0
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS


def test_run_chains_the_stages(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(i, prose(rnd, 80)) for i in range(40)]
    rows += [(50, rows[3][1]), (51, "### " * 90)]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(51, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    ids = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert 50 not in ids and 51 not in ids and len(ids) > 30
    assert re.fullmatch("[a-z_,]+", ",".join(n for n, _ in corpus_pipeline.STAGES))


def test_near_duplicates_stage_of_copies_below_the_threshold_takes_one_round(spark, monkeypatch):
    from strataframe.llm import ngram_join

    rnd = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(x if rnd.random() > 0.03 else f"v{rnd.randrange(10**6)}" for x in base if rnd.random() > 0.02) for _ in range(110)]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate([" ".join(base), *texts])]
    searches, search, firsts = [], ngram_join._search, ngram_join.firsts
    monkeypatch.setattr(ngram_join, "_search", lambda *a: searches.append(1) or search(*a))
    monkeypatch.setattr(ngram_join, "firsts", lambda df: firsts(df, block=16))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates_stage(spark, docs, "").collect()}
    assert kept == {r.doc_id for r in ngram_join.groups(docs).where("doc_id = component_id").collect()}
    assert len(searches) == 2  # one for the stage, one for the groups that it is compared with
