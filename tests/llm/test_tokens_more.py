"""The byte automaton, its table and the splicing, on texts that are hard for them."""

import random

import pytest

from tesserae.llm import bpe_automaton as ba
from tesserae.llm import token_counts as tc

JSON = tc.default_tokenizer()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoder():
    return ba.Encoder(open(JSON, encoding="utf-8").read())


def strange(n, seed):
    rng = random.Random(seed)
    alphabets = ["ab", "aeinrst hTE'", "0123 456.,", "éüñçß ", "中文字 かな", "\t\n\r \x85\xa0　 ", "<|endoftext|> x", "!?#$%&*()_-", "🙂👍 a", "".join(map(chr, range(32, 127)))]
    for _ in range(n):
        yield "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 120)))


def test_fuzzed_texts_equal_the_library(encoder, library):
    for t in strange(3000, 11):
        ids = library.encode(t, add_special_tokens=False).ids
        assert encoder.encode(t) == ids and encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_words_go_through_the_table(encoder):
    """Also those that are tokens themselves; a table that is begun anew at every word gives the same."""
    a = encoder.automaton
    small = ba.Automaton({b: i for i, b in a.label.items() if i != 50256}, MERGES(), 2)
    for w in (b" the", b"the", b"thethe", b"internationalization", bytes(range(128, 256)), b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", b"\xf0\x9f\x99\x82"):
        assert small.encode_word(w) == a.encode_word(w) and small.decode(small.encode_word(w)) == w
    a._begin()
    assert len(a.rows) == 1
    a.encode_word(b" the")
    assert len(a.rows) == 5 and a.rows[0][0x20] == 1  # a state for each byte


def MERGES():
    import json

    to_byte = ba.byte_characters()
    return [tuple(bytes(to_byte[c] for c in x) for x in (m.split(" ") if isinstance(m, str) else m)) for m in json.load(open(JSON, encoding="utf-8"))["model"]["merges"]]


def test_gadgets_by_hand():
    """a b -> ab, ab a -> aba, b a -> ba in this order, against merging by rank."""
    vocab = {bytes([x]): x for x in range(256)} | {b"ab": 256, b"aba": 257, b"ba": 258}
    merges = [(b"a", b"b"), (b"ab", b"a"), (b"b", b"a")]
    auto = ba.Automaton(vocab, merges)

    def by_rank(word):
        parts = [word[i : i + 1] for i in range(len(word))]
        while pairs := [(merges.index(p), -i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in merges]:
            rank = min(r for r, _ in pairs)
            i = min(-i for r, i in pairs if r == rank)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [vocab[p] for p in parts]

    for n in range(1, 11):
        for k in range(2**n):
            word = bytes(97 + (k >> i & 1) for i in range(n))
            assert auto.encode_word(word) == by_rank(word)


def test_other_files_raise_or_are_encoded_whole(spark):
    import public_tokenizers as pt
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    with pytest.raises(ValueError):
        ba.Encoder(open(pt.path("word_bpe_49k.json"), encoding="utf-8").read())
    with pytest.raises(ValueError):
        tc.token_counts(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "x.tiktoken")
    rows = [(k, t) for k, t in enumerate(strange(30, 5))] + [(77, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    word = Tokenizer.from_file(pt.path("word_bpe_49k.json"))
    piece = SentencePieceProcessor(model_file=pt.path("piece_bpe_32k.model"))
    for name, count in (("word_bpe_49k.json", lambda t: len(word.encode(t, add_special_tokens=False).ids)), ("piece_bpe_32k.model", lambda t: len(piece.encode(t)))):
        assert {r.doc_id: r.n_tokens for r in tc.token_counts(df, pt.path(name)).collect()} == {d: count(t or "") for d, t in rows}


def test_splicing_random_texts(library):
    encode = lambda x: library.encode(x, add_special_tokens=False).offsets
    for t in strange(300, 8):
        t = t * 5
        assert tc.count_spliced(t, encode, 37, 5) == len(encode(t))


def test_empty_tables_repeated_rows_and_other_columns(spark):
    rows = [(1, "a b", "x", 3), (1, "a b", "x", 3), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes int")
    assert sorted((str(r.doc_id), r.n_tokens) for r in tc.token_counts(df, JSON).collect()) == [("1", 2), ("1", 2), ("None", 0)]
    assert sorted((str(r.doc_id), r.n_tokens) for r in ba.round_trip(df, JSON).collect()) == [("1", 2), ("1", 2), ("None", 0)]
    assert tc.token_counts(df.limit(0), JSON).collect() == [] == ba.round_trip(df.limit(0), JSON).collect()


def test_a_very_long_word(spark, library):
    t = "ab" * 60_000 + " end"
    df = spark.createDataFrame([(1, t)], "doc_id long, text string")
    n = len(library.encode(t, add_special_tokens=False).ids)
    assert tc.token_counts(df, JSON).first().n_tokens == n == ba.round_trip(df, JSON).first().n_tokens
