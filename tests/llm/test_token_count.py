import pytest
from awkward import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, normalizers

from carelens.llm import token_count
from carelens.llm.queries import op8_token_count

PIECES = token_count.vocabulary(token_count.vocabulary_path())


def tokenizer(pieces, byte_fallback):
    own = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=byte_fallback))
    mark = token_count.MARK
    own.normalizer = normalizers.Sequence([normalizers.Prepend(mark), normalizers.Replace(" ", mark)])
    return own


def exact(own, text):
    return len(own.encode(text or "", add_special_tokens=False).ids)


PUBLIC = tokenizer(PIECES, True)


def test_awkward(docs):
    texts = [(d, t if t is None or len(t) < 5000 else t[:5000]) for d, t in AWKWARD]
    got = sorted((tuple(r) for r in token_count.token_counts(docs(texts)).collect()), key=repr)
    assert got == sorted(((d, exact(PUBLIC, t)) for d, t in texts), key=repr)


def test_empty_table(docs):
    assert token_count.token_counts(docs([])).collect() == []


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in op8_token_count(spark, sf_dir).collect()}
    assert got == {d: exact(PUBLIC, t) for d, t in texts.items()}


@settings(max_examples=1000, deadline=None)
@given(st.text(st.sampled_from("abeit the  \n\t▁éİ日本\U0001f600\x00<s>0x"), max_size=40))
def test_public_vocabulary(text):
    assert token_count.counter(token_count.vocabulary_path()).count(text) == exact(PUBLIC, text)


TIES = [("<unk>", 0.0), ("▁", -1.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("aba", -6.0), ("bab", -6.0), ("▁a", -3.0), ("ba", -4.0)]
UNEVEN = [("<unk>", 0.0), ("▁", -1.3), ("a", -2.7), ("b▁a", -4.1), ("ab", -2.7), ("b", -0.1), ("aa", -5.4)]


@pytest.mark.parametrize("pieces", [TIES, UNEVEN])
def test_ties_and_joined_words(pieces):
    counter, own = token_count.Counter(pieces, byte_fallback=False), tokenizer(pieces, False)
    assert counter.by_word == (pieces is TIES)

    @settings(max_examples=500, deadline=None)
    @given(st.text(st.sampled_from("ab c"), max_size=20))
    def run(text):
        assert counter.count(text) == exact(own, text)

    run()
