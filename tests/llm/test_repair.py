import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import repair
from millrace.llm.catalogue import tokenizer_file

PATH = tokenizer_file("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=300), st.integers(2, 5))
def test_blocks_decode_to_what_was_encoded(ids, frequent):
    stream = np.array(ids, np.uint32)
    block = repair.Block.from_bytes(repair.compressed(stream, np.array([len(ids)]), 8, frequent).to_bytes())
    assert block.expand(block.sequence).tolist() == ids and block.widths().sum() == len(ids)
    for rule in range(len(block.left)):
        assert len(block.expand(np.array([8 + rule]))) == block.lengths[rule]
    for start in range(0, len(ids), 37):
        assert block.part(start, min(start + 50, len(ids))).tolist() == ids[start : start + 50]


def test_no_frequent_pair_is_left_and_repetition_shrinks():
    ids = np.array([1, 2, 3, 4, 5] * 400 + [9] * 777)
    block = repair.compressed(ids, np.array([len(ids)]), 16, 4)
    assert len(block.sequence) < 60
    pairs = list(zip(block.sequence[:-1].tolist(), block.sequence[1:].tolist(), strict=True))
    assert max(pairs.count(p) for p in set(pairs) if p[0] != p[1]) < 4


def test_ids_equal_the_tokenizers(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    rng, encoder = random.Random(4), repair.Encoder(PATH, named=True)
    texts = ["", " a", "a ", "  a  b", "it's 'll x", "日本 語", "x'  's y", "a　 b  c", "<|endoftext|> a", "word. word, word!!"]
    texts += ["".join(rng.choice(" \n\taB1'!.é日s—") for _ in range(rng.randrange(25))) for _ in range(4000)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_written_blocks_read_back_whole(spark, odd, empty, make, monkeypatch):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "") for r in odd.collect()))
    start, expected = 0, []
    for known, doc_id, _, text in rows:
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [0], "<u4")
        expected.append((doc_id if known else None, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = repair.digests(spark, repair.written(odd, PATH)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected
    assert repair.digests(spark, repair.written(empty, PATH)).count() == 0


def test_a_document_is_decoded_from_its_own_symbols(spark, make):
    docs = make([(i, f"the same words again and again, number {i} " * 9, None, None) for i in range(50)])
    folder = repair.written(docs, PATH)
    ids = {r.doc_id: r for r in repair.read_back(spark, folder).collect()}
    for row in spark.read.parquet(folder).collect():
        block, owners = repair.opened(row.asDict())
        cuts = np.concatenate([[0], np.cumsum(block.documents.astype(np.int64))])
        for k, doc in enumerate(owners.to_pylist()):
            assert block.part(cuts[k], cuts[k + 1]).tobytes() == ids[doc].ids


def test_names_of_added_tokens_are_these_tokens(spark, make):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    name = "<|endoftext|>"
    texts = [name, f"a {name} b", f"a{name}", f"{name}{name} \n a", f"word, {name}. word", "word, word.", f"  a  {name}  b", "<|endof text|>", ""]
    ids = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert plain.token_to_id(name) in ids[1]
    assert [np.frombuffer(x, "<u4").tolist() for x in repair.encoder_of(PATH).encode(texts)] == ids
    start, expected = 0, []
    for i, found in enumerate(ids):
        data = np.array([*found, 0], "<u4")
        expected.append((i, start, len(data), zlib.crc32(data.tobytes())))
        start += len(data)
    got = repair.digests(spark, repair.written(make([(i, text, None, None) for i, text in enumerate(texts)]), PATH))
    assert sorted(map(tuple, got.collect())) == expected
