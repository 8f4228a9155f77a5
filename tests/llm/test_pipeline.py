"""The pipeline against brute-force versions of its stages."""

import random
import re

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from quire.llm import exact_dedup, mixing, simhash, toxicity
from quire.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(tmp_path, spark):
    rng = random.Random(8)
    word = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    docs = []
    for i in range(150):
        ws = [rng.choice(word) for _ in range(60)]
        if i % 10 == 0:
            ws[5], ws[20] = "idiot", "moron"
        docs.append(" ".join(ws))
    docs += [docs[1], docs[1] + " \n", docs[2].replace(docs[2].split()[7], "swapped"), "", None]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(docs)]
    labels = [(i, int(i % 7 != 3), int(i % 10 == 0)) for i in range(150)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return rows


def test_pipeline_matches_brute_force(spark, tmp_path):
    rows = fixture(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    grammar = toxicity.learn(docs, labels)
    rows = [r for r in rows if grammar.score(grammar.clauses(r[1] or "")) < 0.5]
    assert all(r[0] % 10 for r in rows if r[0] < 150) and len(rows) == 150 - 15 + 5
    best = {}
    for r in rows:
        key = re.sub("[ \t-\r]", "", r[1] or "")
        best[key] = min(best.get(key, r), r, key=lambda x: (-len(x[1] or ""), x[0]))
    rows = sorted(best.values())
    fps = [simhash.fingerprint_of(r[1]) & (1 << 64) - 1 for r in rows]
    root = list(range(len(rows)))
    for _ in rows:  # labels spread until nothing changes
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
        if all(root[root[i]] == root[i] for i in range(len(rows))):
            break
    rows = [r for i, r in enumerate(rows) if root[i] == i]
    left = spark.createDataFrame(rows, SCHEMA)
    copies = {r.id: r.copies for r in mixing.mix(
        left, mixing.domains_of(labels, domains=tuple(corpus_pipeline.TARGETS)), corpus_pipeline.TARGETS)[0].collect()}
    library = Tokenizer.from_file(tokenizer_file())
    want = sorted((r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows for _ in range(copies[r[0]]))
    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want


def test_stages_keep_the_columns(spark, tmp_path):
    fixture(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def test_stages_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert exact_dedup.SPLIT_CHARS > 0
