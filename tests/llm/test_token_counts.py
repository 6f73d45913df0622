import random

from sparkmart.llm import token_counts
from sparkmart.llm.queries import QUERIES, tokenizer_file


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=tokenizer_file("piece_bpe_32k.model"))


def test_sums_of_pre_tokens_equal_the_librarys_counts():
    rnd, sp = random.Random(1), library()
    lengths = token_counts._Lengths({"b": len(sp.encode("b"))}, tokenizer_file("piece_bpe_32k.model"))
    alphabet = " ab▁éß\n\t<s>/0#\x00\U0001f600日"
    for _ in range(8000):
        t = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12)))
        assert sum(map(lengths.__getitem__, token_counts.pre_tokens(t))) == len(sp.encode(t)), repr(t)


def test_odd_rows_and_bounded_tables(spark, make, odd, monkeypatch):
    monkeypatch.setattr(token_counts, "HELD", 5)  # the cache is full at once
    sp, model = library(), tokenizer_file("piece_bpe_32k.model")
    got = token_counts.with_token_counts(make(odd), model).collect()
    key = lambda x: str(x)
    assert sorted([(r.doc_id, r.n_tokens) for r in got], key=key) == sorted([(i, len(sp.encode(t or ""))) for i, t in odd], key=key)
    assert token_counts.with_token_counts(make([]), model).count() == 0
    assert token_counts.frequent_pre_tokens(make(odd), size=3).first().pre_token in ("word", "one", "")


def test_long_pre_tokens_are_neither_sent_nor_kept(spark, make, monkeypatch):
    sp, model = library(), tokenizer_file("piece_bpe_32k.model")
    rnd = random.Random(9)
    docs = [(i, "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(5000))) for i in range(40)] + [(99, "a b " + "é" * 33 + " c")]
    table = token_counts.frequent_pre_tokens(make(docs)).collect()
    assert {r.pre_token for r in table} == {"a", "b", "c"}
    got = {r.doc_id: r.n_tokens for r in token_counts.with_token_counts(make(docs), model).collect()}
    assert got == {i: len(sp.encode(t)) for i, t in docs}
    lengths = token_counts._Lengths({}, model)
    before = len(lengths)
    for _, t in docs[:5]:
        assert lengths[t] == len(sp.encode(t))
    assert lengths["b" * 64] and lengths["b" * 65] and len(lengths) == before + 1


def test_query(spark, sf, documents):
    sp = library()
    got = {r.doc_id: r for r in QUERIES["op7_token_counts"](spark, sf).collect()}
    for i, t in documents:
        n = len(sp.encode(t))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), n, n > 4096)
