import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ridemart.llm import packing

PATH = packing.default_tokenizer()
WHOLE, WORDS = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)


def whole(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def mine(text):
    return np.frombuffer(WORDS.encode([text.encode()])[0], WORDS.dtype).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t.,'!%ABcdeéÉß̱̇İΣ")), max_size=40))
def test_word_ids_equal_whole_ids(text):
    assert mine(text) == whole(text)


def test_special_words():
    for t in ["don't stop'll it's", "H̱x", "a\xa0b", "<|endoftext|> hi", "x\x00 \x01y\x1cz", "it's,it's", "word'. x-'s", "THE, The. the,."]:
        assert mine(t) == whole(t)


def check(rows, pieces, length):
    todo = {}
    for i, t in rows:
        todo.setdefault(i, []).append(np.array(whole(t) + [1], "<u4"))
    by_seq, seen = {}, 0
    for p in pieces:
        assert any(zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32 and len(x) == p.doc_tokens for x in todo[p.doc_id])
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
        seen += p.length
    assert seen == sum(len(x) for v in todo.values() for x in v)
    sizes = []
    for s in sorted(by_seq):
        at = 0
        for off, n in sorted(by_seq[s]):
            assert off == at
            at += n
        sizes.append(at)
    assert list(sorted(by_seq)) == list(range(len(by_seq))) and all(x == length for x in sizes[:-1])


def test_query_packs_every_id_once(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, packing.op4_concat_packing(spark, "/root/testdata/sf0.001").collect(), 2048)


def test_odd_rows_and_sequences(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    pieces = packing.pack(odd.repartition(3), length=16, with_ids=True).cache()
    check(rows, pieces.collect(), 16)
    seqs = packing.sequences(pieces, 16, pad_id=9).collect()
    assert all(len(s.ids) == 16 for s in seqs)
    assert packing.pack(empty).count() == 0
