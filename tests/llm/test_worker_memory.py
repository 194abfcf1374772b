"""Python workers outlive their tasks, so what one stage keeps in them adds to the memory of all later stages."""

import weakref
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import packing, registry, toxicity


def _network() -> toxicity.Network:
    return toxicity._start({}, np.zeros(1, np.float32), 7, -1.0)


def test_words_of_many_texts_take_little_memory():
    texts = [" ".join(f"w{doc}x{at}" for at in range(250) for _ in range(4)) for doc in range(610)]
    scorer = toxicity.Scorer(_network())
    found = scorer.score(pa.array([*texts, None]))
    assert scorer.gates.nbytes + 200 * len(scorer.known) < 45e6
    few = [0, 300, 609]
    assert found[few].tolist() == pytest.approx(toxicity.Scorer(_network()).score([texts[at] for at in few]).tolist(), rel=1e-5)
    assert len(found) == 611 and found[-1] == pytest.approx(1 / (1 + np.e))


@pytest.mark.parametrize("operator", ["packing", "toxicity"])
def test_no_batch_is_held_when_arrow_gives_memory_back(spark, monkeypatch, operator):
    whole = SimpleNamespace(mapInArrow=lambda run, layout: run)
    whole.select = lambda *columns: whole
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    run = packing.cut_pieces(whole, registry.tokenizer_path()) if operator == "packing" else toxicity.score_documents(whole, _network())
    texts = pa.array(["some words", None])
    columns = [pa.array([1, 2]), texts] if operator == "packing" else [pa.array([1, 2]), pa.array([True, False]), texts]
    given, held = [], []

    def batches():
        batch = pa.RecordBatch.from_arrays(columns, ["a", "b", "c"][: len(columns)])
        given.append(weakref.ref(batch))
        yield batch

    pool = SimpleNamespace(release_unused=lambda: held.append(given[0]() is not None))
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    assert [len(batch) for batch in run(batches())] == [2]
    assert held and not held[-1]


def test_only_texts_of_rows_go_through_python(spark):
    docs = spark.createDataFrame([(1, "some words", "en"), (2, None, None)], "doc_id long, text string, `a.b` string")
    kept = toxicity.drop_toxic(docs, _network(), 1.1)
    assert "MapInArrow" not in kept._jdf.queryExecution().toString()
    assert kept.schema == docs.schema and sorted(kept.collect()) == sorted(docs.collect())
