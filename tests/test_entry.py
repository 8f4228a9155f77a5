"""Driver contract: entry runs, and every oracle has a query."""

import importlib.util

import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.columns == ["rouge_1", "rouge_2", "rouge_l", "bleu_4", "n_pairs"]
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["n_pairs"] > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 70
    # the numbered training-data queries are there exactly when their subpackage is
    spec = importlib.util.find_spec("quire.llm")
    numbered = {n.split("_")[0] for n in q if n.startswith("op") and n[2:3].isdigit()}
    assert numbered == ({f"op{k}" for k in range(1, 14)} if spec is not None and spec.origin else set())
