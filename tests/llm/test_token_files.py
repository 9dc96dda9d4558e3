import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgermill.llm.elias_fano import EliasFano
from ledgermill.llm.packing import pack
from ledgermill.llm.token_files import TokenFile, read_token_files, write_token_files
from ledgermill.llm.tokenise import WordStore, WordwiseEncoder, columns_of, default_vocabulary, encoder
from ledgermill.shared import fresh_path


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=700).map(sorted))
def test_elias_fano(values):
    found = EliasFano.from_bytes(EliasFano.encode(np.array(values, np.uint64)).to_bytes())
    assert found.values().tolist() == values
    cuts = [0, 1, len(values) // 3, len(values) // 2, len(values)]
    assert all(found.values(a, b).tolist() == values[a:b] for a in cuts for b in cuts)
    assert [found.select(i) for i in range(len(values))] == values


def test_elias_fano_space():
    values = np.cumsum(np.random.default_rng(1).integers(1, 1000, 100_000)).astype(np.uint64)
    assert len(EliasFano.encode(values).to_bytes()) * 8 / len(values) < 2 + np.log2(values[-1] / len(values)) + 1
    with pytest.raises(ValueError):
        EliasFano.encode(np.array([2, 1], np.uint64))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list(" \n\t'abcE1²é.,-# 　日s\x1c\x85") + ["  ", "<|endoftext|>", "'ll"]), max_size=40).map("".join))
def test_wordwise_is_the_tokenizer(text):
    assert ENCODER.as_uint32(ENCODER.encode([text])[0]).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


ENCODER = WordwiseEncoder(default_vocabulary(), young=5, old=5, pieces=5)
WHOLE = Tokenizer.from_file(default_vocabulary())
WHOLE.encode_special_tokens = True


def test_files(spark, docs):
    texts = ["b c", None, "", "a " * 5000, "b c", "x"]
    frame = docs(*texts, ids=[5, 3, -2, 9, 5, None])
    listed = write_token_files(frame, fresh_path(spark, "tokens"))
    rows = sorted(read_token_files(listed).collect(), key=lambda x: x.start)
    assert [x.doc_id for x in rows] == [None, -2, 3, 5, 5, 9]
    at = 0
    for x, text in zip(rows, ["x", "", "", "b c", "b c", "a " * 5000]):
        ids = np.array([*WHOLE.encode(text).ids, 0], "<u4")
        assert (x.start, x.n_tokens, x.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    held = [TokenFile(x.file) for x in listed.orderBy("task", "number").collect()]
    assert sum(map(len, held)) == 6
    last = held[-1]
    assert last.doc_id_block(len(last) - 1, len(last)).tolist() == [9] and held[0].doc_id_block(0, 1).tolist() == [None] and last.ids(len(last) - 1).tolist() == [*WHOLE.encode("a " * 5000).ids, 0]
    for step, run in ((1, 1), (3, 2), (1 << 22, 4096)):
        assert [x.tolist() for f in held for _, _, ends, ids in f.scan(step, run) for x in np.split(ids, ends[:-1])] == [f.ids(i).tolist() for f in held for i in range(len(f))]
    assert read_token_files(write_token_files(frame.where("false"), fresh_path(spark, "tokens"))).count() == 0


def test_one_id_for_many_rows_is_split(spark, docs):
    """A repeated doc_id is dealt over many files, and starts stay gapless."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        listed = write_token_files(docs(*(f"text {i % 7}" for i in range(400)), ids=[3] * 400), fresh_path(spark, "tokens"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = sorted(read_token_files(listed).collect(), key=lambda x: x.start)
    assert len(rows) == 400 and {x.doc_id for x in rows} == {3} and listed.count() > 1
    assert [x.start for x in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(400)]


PLAIN = Tokenizer.from_file(default_vocabulary())
AS_USED = encoder(default_vocabulary())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(list(" \n'abE1é.-<|> 日") + ["  ", "<|endoftext|>", "'ll"]), max_size=20).map("".join), max_size=5))
def test_operators_encode_as_the_unchanged_tokenizer(texts):
    assert [AS_USED.as_uint32(x).tolist() for x in AS_USED.encode(texts)] == [PLAIN.encode(x, add_special_tokens=False).ids for x in texts]


def test_literal_of_an_added_token(spark, docs):
    text = "one <|endoftext|> two"
    assert AS_USED.as_uint32(AS_USED.encode([text])[0]).tolist() == [505, 220, 50256, 734]
    ids = [np.array([*PLAIN.encode(x, add_special_tokens=False).ids, 0], "<u4") for x in (text, "three")]
    rows = sorted(read_token_files(write_token_files(docs(text, "three"), fresh_path(spark, "tokens"))).collect(), key=lambda x: x.start)
    assert [(x.start, x.n_tokens, x.ids_crc32) for x in rows] == [(0, len(ids[0]), zlib.crc32(ids[0].tobytes())), (len(ids[0]), len(ids[1]), zlib.crc32(ids[1].tobytes()))]
    assert {x.doc_id: x.doc_tokens for x in pack(docs(text, "three")).collect()} == {0: len(ids[0]), 1: len(ids[1])}


class Counted:
    """Hands calls on to the model and counts what it is asked for."""

    def __init__(self, model) -> None:
        self.model, self.asked = model, Counter()

    def tokenize(self, piece):
        self.asked[piece] += 1
        return self.model.tokenize(piece)


def test_words_and_pieces_are_encoded_once():
    """A block looks each different word up once, and the model gets each different pre-token once, whatever marks follow it."""
    texts = ["Start walking, walking. walking walking; (walking) naïve naïve, naïve\nwalking " + "walking " * 50 + "12", "Begin walking", ""]
    own = WordwiseEncoder(default_vocabulary(), added=True)
    own.model, looked = Counted(own.model), Counter()

    class Looked(WordStore):
        def __getitem__(self, word):
            looked[word] += 1
            return super().__getitem__(word)

    own.words = Looked(own._word, 5, 5)
    assert [own.as_uint32(x).tolist() for x in own.encode(texts)] == [PLAIN.encode(x, add_special_tokens=False).ids for x in texts]
    assert looked and max(looked.values()) == 1 and max(own.model.asked.values()) == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(list(" .,;:!?'\n"))), max_size=25), max_size=4))
def test_latin_pretokens(texts):
    assert [AS_USED.as_uint32(x).tolist() for x in AS_USED.encode(texts)] == [PLAIN.encode(x, add_special_tokens=False).ids for x in texts]


def test_texts_are_taken_by_size():
    """Small texts together, a long one alone, nothing left out; a long text's ids are placed a few words at a time."""
    texts = ["ab"] * 5 + ["long " * 30_000] + ["é", "", "x  y "]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    parts = list(columns_of([batch], limit=10))
    assert [x for ids, _ in parts for x in ids] == list(range(len(texts))) and [x for _, part in parts for x in part] == texts
    assert [len(ids) for ids, _ in parts] == [5, 1, 3]
    assert [AS_USED.as_uint32(x).tolist() for x in AS_USED.encode(texts)] == [PLAIN.encode(x, add_special_tokens=False).ids for x in texts]
