"""What a worker holds while it goes through texts, and what it keeps of them."""

import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from joinwright.llm import common, idfiles, language, pretokens

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def peak_mb(function, *args):
    tracemalloc.start()
    try:
        function(*args)
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_table_of_letters_is_made_piece_by_piece():
    assert peak_mb(language.letters.__wrapped__) < 40
    low, is_letter, _ = language.letters()
    for code in [*range(0x3000), *range(0x10000, 0x10480), 0x1F600, 0x10FFFF]:
        c = chr(code)
        assert is_letter[code] == c.isalpha()
        assert low[code] == (0 if not c.isalpha() else ord(c.lower()) if len(c.lower()) == 1 else code)


def test_cut_of_a_slice_of_text():
    cutter = pretokens.Pretokens(
        Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).pre_tokenizer, False
    )
    text = "it's more \u00e9t\u00e9 'n the 'll " * 40_000
    texts = pa.array([text])
    cutter.cut(texts)
    assert peak_mb(cutter.cut, texts) < 22 * len(text) / 1e6


def test_what_arrow_keeps_is_given_back_after_every_batch(monkeypatch):
    given = []

    class Pool:
        release_unused = staticmethod(lambda: given.append(len(seen)))

    seen: list[int] = []
    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    batches = [pa.RecordBatch.from_pydict({"n": [n]}) for n in range(3)]

    def twice(batch):
        seen.append(batch.column(0)[0].as_py())
        yield batch
        yield batch

    found = [b.column(0)[0].as_py() for b in common.batch_by_batch(twice, iter(batches))]
    assert found == [0, 0, 1, 1, 2, 2]
    assert given == [1, 2, 3, 3]


@pytest.fixture
def session(spark):
    spark.conf.unset(SETTING)
    yield spark
    spark.conf.unset(SETTING)


def sizes(spark):
    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    rows = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('x', 5000) text")
    return rows.mapInArrow(size, "rows long, bytes long").collect()


def test_stages_bound_the_bytes_of_batches(session, tmp_path):
    df = session.createDataFrame([(1, "so it is", "en", "a")], "doc_id long, text string, lang string, source string")
    corpus_pipeline.packed(session, df, str(tmp_path))
    found = sizes(session)
    assert sum(r.rows for r in found) == 4000
    assert max(r.bytes for r in found) <= 5 << 20


def test_own_bound_of_a_session_stays(session, tmp_path):
    session.conf.set(SETTING, "1m")
    corpus_pipeline.in_small_batches(session)
    assert session.conf.get(SETTING) == "1m"
    assert max(r.bytes for r in sizes(session)) <= 2 << 20


def test_files_of_ids_bound_the_bytes_of_batches(session, tmp_path):
    file, folder = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "ids")
    idfiles.write_ids(session.createDataFrame([(1, "so it is")], "doc_id long, text string"), folder, file)
    found = sizes(session)
    assert sum(r.rows for r in found) == 4000
    assert max(r.bytes for r in found) <= 5 << 20
    session.conf.unset(SETTING)
    assert [r.n_tokens for r in idfiles.read_ids(session, folder).collect()] == [4]
    assert max(r.bytes for r in sizes(session)) <= 5 << 20
    session.conf.set(SETTING, "1m")
    idfiles.read_ids(session, folder)
    assert session.conf.get(SETTING) == "1m"


def test_files_of_ids_give_back_what_arrow_keeps(spark, tmp_path, monkeypatch):
    taken = []

    def tasks(frame, function, schema):
        taken.append(function)
        return real(frame, function, schema)

    file, folder = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "ids")
    docs = spark.createDataFrame([(1, "so it is"), (2, None)], "doc_id long, text string")
    real = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", tasks)
    idfiles.write_ids(docs, folder, file)
    idfiles.read_ids(spark, folder)
    given = []

    class Pool:
        release_unused = staticmethod(lambda: given.append(1))

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    texts = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["so it is", ""]})
    blocks = pa.Table.from_batches(spark.read.parquet(f"{folder}/blocks").toArrow().to_batches())
    coded = list(taken[0](iter([texts, texts])))
    assert [b["n_ids"].to_pylist() for b in coded] == [[4, 1]] * 2
    assert len(given) == 3
    found = [n for b in taken[-1](iter(blocks.to_batches())) for n in b["n_tokens"].to_pylist()]
    assert sorted(found) == [1, 4]
    assert len(given) == 3 + len(blocks.to_batches()) + 1
