import numpy as np

import corpus_pipeline as P
import __spark_entry__ as E
from surveyspark.llm.tables import Shared, source

from .data import SF, jaccard_components, table
from .test_near_duplicates import _repeated
from .test_text_operators import check_packing, plain_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_after_the_other(spark):
    shared, docs, seen = Shared(spark, "t"), source(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        docs = shared.put(stage(spark, docs, SF), name)
        seen.append(docs.toPandas())
    start = {r["doc_id"]: r["text"] for r in table("documents")}
    toxic, joined, dedup, clean, packed = seen
    assert [list(x.columns) for x in seen[:4]] == [COLUMNS] * 4
    assert all(start[i] == t for i, t in zip(toxic.doc_id, toxic.text)) and len(toxic) >= 0.7 * len(start)
    want = jaccard_components(list(zip(toxic.doc_id, toxic.text)))
    assert set(joined.doc_id) == {i for i, (_, c) in want.items() if c == i}
    assert not _repeated(list(zip(dedup.doc_id, dedup.text))) and set(dedup.doc_id) <= set(joined.doc_id)
    assert not any(plain_spans(t) for t in clean.text) and set(clean.doc_id) == set(dedup.doc_id)
    before = dict(zip(dedup.doc_id, dedup.text))
    assert all(t == before[i] for i, t in zip(clean.doc_id, clean.text) if not plain_spans(before[i]) and "[" not in t)
    made, least = check_packing([*packed.itertuples()], list(zip(clean.doc_id, clean.text)), 4096)
    assert made <= least + 1
    assert (clean.n_chars == clean.text.str.len()).all() and np.all(packed.length > 0)


def test_stages_take_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(1, None, None, None, None), (1, None, None, None, None), (None, "a b", "en", "s", 3), (2, "", "en", "s", 0)]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in P.STAGES[:4]:
            docs = Shared(spark, "t").put(stage(spark, docs, SF), name)
            assert docs.columns == COLUMNS
        assert docs.count() == (3 if rows else 0)
        assert P.STAGES[4][1](spark, docs, SF).count() == (3 if rows else 0)


def test_all_eleven_are_registered():
    names = E.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
