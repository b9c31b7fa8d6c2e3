import pyarrow as pa

from millrace.llm.packing import packed, unpacked


def test_texts_come_back_whole_in_bounded_parts(make):
    texts = {1: "one two", 2: "", 3: "日本語 ☃", 4: "zero " * 50_000, 5: "x" * 30_000}
    df = packed(make([(i, t, "en", "a") for i, t in texts.items()]).select("doc_id", "text"))
    assert df.columns == ["doc_id", "packed", "size"]
    rows = df.orderBy("doc_id").toArrow().combine_chunks().to_batches()
    parts = [part for batch in rows for part in unpacked(batch, 1000)]
    assert {i: t for part in parts for i, t in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True)} == texts
    assert all(part.num_rows == 1 or sum(map(len, part["text"].to_pylist())) <= 1000 for part in parts)


def test_no_rows_give_no_parts(empty):
    df = packed(empty.select("doc_id", "text"))
    assert df.count() == 0
    nothing = pa.record_batch({"packed": pa.array([], pa.binary()), "size": pa.array([], pa.int64())})
    assert [*unpacked(nothing)] == []
