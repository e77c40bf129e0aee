"""Shredding of JSON texts of mixed kinds."""

import pytest

from ledgerscreen.sources.json_events import bad_rows, kinds, shredded


def test_mixed_kinds_nulls_and_bad_texts(spark):
    texts = ['{"k": 7}', '{"k": "8"}', '{"k": "x"}', '{"k": null}', '{"j": 1}', "[1, 2]", "3", "null", "{bad", "", None, '{"k": {"k": 1}}']
    df = spark.createDataFrame(list(enumerate(texts)), "id long, props string")
    got = {r.id: (r.k, r.json_kind) for r in shredded(df, {"k": "bigint"}).collect()}
    assert [got[i][0] for i in range(len(texts))] == [7, 8, *[None] * 10]
    assert got[0][1] == "OBJECT<k: BIGINT>" and got[1][1] == "OBJECT<k: STRING>"
    assert [i for i, v in got.items() if v[1] == "BAD"] == [8, 9] and got[10][1] is None
    assert sorted(r.id for r in bad_rows(df).collect()) == [8, 9]
    assert sum(r.n_rows for r in kinds(shredded(df, {"k": "bigint"})).collect()) == len(texts)
    with pytest.raises(ValueError, match="id"):
        shredded(df, {"id": "bigint"})
