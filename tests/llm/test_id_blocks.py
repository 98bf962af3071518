"""Blocks of ids, made of whole batches."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from joinwright.llm import idfiles

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_ids_of_part_of_a_batch(kind):
    documents = [[1, 2, 3], [7], [5, 6], [9]]
    values = pa.array([np.array(d, kind).tobytes() for d in documents], pa.binary())
    assert idfiles.ids_of(values.slice(1, 2), 3).tolist() == [7, 5, 6]
    assert idfiles.ids_of(values.slice(4), 0).tolist() == []


def test_blocks_end_with_the_document_that_fills_them(spark, tmp_path, monkeypatch):
    texts = ["one two three", None, "", "four " * 30, "five", "six seven", "two " * 9, "x"]
    rows = [(i // 2 if i else None, t) for i, t in enumerate(texts)]
    monkeypatch.setattr(idfiles, "BLOCK_IDS", 10)
    monkeypatch.setattr(idfiles, "spread", lambda *_: 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        idfiles.write_ids(df, folder := str(tmp_path / "ids"), WORDS)
        found = idfiles.read_ids(spark, folder).orderBy("start").collect()
        blocks = spark.read.parquet(f"{folder}/blocks").orderBy("part", "number").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    encode = Tokenizer.from_file(WORDS).encode
    want = [[*encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in found] == [
        (i, ids) for (i, _), ids in zip(rows, want)
    ]
    assert [r.start for r in found] == np.cumsum([0, *map(len, want)])[:-1].tolist()
    sizes, held = [], 0
    for ids in want:
        held += len(ids)
        if held >= 10:
            sizes, held = [*sizes, held], 0
    assert [b.n_ids for b in blocks] == [*sizes, *([held] if held else [])]
    assert [sum(b.lengths) for b in blocks] == [b.n_ids for b in blocks]
