import zlib

import numpy as np
import pytest

from ratewatch.llm import rans
from ratewatch.llm.queries import tokenizer_path


def tables(ids, size):
    return rans.Tables(rans.frequencies(np.bincount(ids, minlength=size)))


@pytest.mark.parametrize("n", [1, 2, 63, 64, 200, 5000, 70_000, 300_000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n) - 1, 49_000)
    table = tables(ids, 49_408)
    block = rans.encode(ids, table)
    assert (rans.decode(block, table) == ids).all()
    whole = [rans.decode_segment(block, k, table) for k in range(rans.segments(block))]
    assert (np.concatenate(whole[::-1]) == np.concatenate(whole[::-1])).all()
    assert (rans.decode_segment(block, len(whole) - 1, table) == ids[-len(whole[-1]) :]).all()


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.4, 200_000) - 1, 5000)
    share = np.bincount(ids) / len(ids)
    share = share[share > 0]
    bits = -(share * np.log2(share)).sum() * len(ids)
    assert len(rans.encode(ids, tables(ids, 6000))) * 8 < 1.1 * bits + 8 * 1024 * 64 * 8


def test_frequencies_and_edges():
    assert rans.frequencies(np.zeros(5)).sum() == 0
    for counts in ([5, 0, 1], [1], [10**12, 1, 1, 0], np.ones(49_408), np.r_[10**9, np.ones(49_000)]):
        scaled = rans.frequencies(np.array(counts))
        assert scaled.sum() == 1 << rans.SCALE_BITS and ((scaled > 0) == (np.array(counts) > 0)).all()
    table = tables(np.array([3, 3, 3]), 5)
    assert (rans.decode(rans.encode(np.full(1000, 3), table), table) == 3).all()
    assert len(rans.decode(rans.encode(np.array([], int), table), table)) == 0
    with pytest.raises(ValueError):
        rans.encode(np.array([4]), table)


def test_damage_is_found():
    ids = np.random.default_rng(2).integers(0, 500, 9000)
    table = tables(ids, 500)
    block = bytearray(rans.encode(ids, table))
    block[-5] ^= 1
    with pytest.raises(ValueError):
        rans.decode(bytes(block), table)
    with pytest.raises(ValueError):
        for k in range(rans.segments(bytes(block))):
            rans.decode_segment(bytes(block), k, table)
    with pytest.raises(ValueError):
        rans.decode(rans.encode(ids, table), tables(ids[:100], 500))


ODD = [
    "The the, THE. don't. it's! x1y2 3.14, a.b.c ...",
    "É é É. ö, ß? ﬁ İ Σας ΣΑΣ. á. é, ́x",
    "a b c d\x85e\x1cf 　",
    "😀😀. 漢字かな交じり文。 ‘quoted’, “text”. a’s",
    "we'll. 's 't. 're! o'clock? 'S, 'VE.",
    "a.,;:!?. !?b .c d-e_f=g #tag @me http://x.y/z?q=1&r=2.",
]


CASES = [
    "<|ENDOFTEXT|> <|endoftext|> a<|EndOfText|>B <|startoftext|>The <|STARTOFTEXT|>.",
    "T\u0308 t\u0308 H\u0331x J\u030c j\u030c W\u030a Y\u030aA T\u0591\u0308 T\u0323\u0308.",
    "USA\u2019s CAF\u00c9 cafe\u0301 CAFE\u0301 THE The < | <| |>",
]


def test_case_is_kept_where_it_matters():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    encoder = rans.Words(tokenizer_path())
    words = sorted({w for t in CASES for w in t.split()})
    texts = [*words, *(w.lower() for w in words), *CASES, *(t.lower() for t in CASES)]
    for text, got in zip(texts, encoder.ids(texts), strict=True):
        ids = whole.encode(text, add_special_tokens=False).ids + [rans.END_ID]
        assert np.frombuffer(got, "<u2").tolist() == ids


def test_words_give_the_ids_of_whole_texts(prose):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    texts = [*ODD, None, "", " \n\t", "\u3000 \x85 a \x85", prose(1, 500), "\n".join(ODD)]
    encoder = rans.Words(tokenizer_path())
    for text, got in zip(texts, encoder.ids(texts), strict=True):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [rans.END_ID]
        assert np.frombuffer(got, "<u2").tolist() == ids


def test_words_are_forgotten_and_learned_again(prose, monkeypatch):
    monkeypatch.setattr(rans, "REMEMBERED", 50)
    encoder = rans.Words(tokenizer_path())
    texts = [prose(k, 60) for k in range(12)]
    first = [encoder.ids([t])[0] for t in texts]
    assert len(encoder.known) <= 60 + 50
    assert [encoder.ids([t])[0] for t in texts] == first == rans.Words(tokenizer_path()).ids(texts)


def test_documents(make_docs, prose, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(rans, "BLOCK_IDS", 700)
    whole = Tokenizer.from_file(tokenizer_path())
    rows = [(9 - k, prose(k, 30 * k + 1)) for k in range(30)] + [(100, None), (101, ""), (102, prose(1, 8000))]
    rows += [(2**60 + 1, ODD[0]), (None, "lost"), (None, "found")]
    docs = make_docs(*rows).withColumnRenamed("lang", "start")
    got = rans.round_trip(docs, tokenizer_path()).collect()
    at = 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for r, (number, text) in zip(sorted(got, key=lambda r: r.start), ordered, strict=True):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (number, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert rans.round_trip(make_docs(), tokenizer_path()).count() == 0


def test_words_of_letters_and_marks():
    """Letters are the model's alone; marks, contractions, marks that compose and added tokens are not parted wrongly."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    letters = ["the", "THE", "Élan", "éÉ", "straße", "ÿØ", "naïve", "é", "İ", "Σας", "µ", "×a", "ǅ", "x1", "don't", "a's"]
    marks = ["", ".", ",", "...", ".,;", "$$$", "'", "'s", "'S.", "''", "̸", "≠", "<|", "|>", "<|endoftext|>", "_", "^~`"]
    texts = [x + y for x in letters for y in marks] + [y + x for x in letters for y in marks]
    for encoder in (rans.Words(tokenizer_path()), rans.Words(tokenizer_path())):
        for text, got in zip(texts, encoder.ids(texts), strict=True):
            assert np.frombuffer(got, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids + [rans.END_ID]
        texts.reverse()


def test_most_words_do_not_take_the_whole_tokenizer(prose, monkeypatch):
    """A word of letters, with or without marks, is encoded by the model, and once."""
    encoder = rans.Words(tokenizer_path())
    asked = []
    encode, seen = encoder.tokenizer.encode, encoder.known.encoded

    class Whole:
        def encode(self, text, **options):
            asked.append(text)
            return encode(text, **options)

    encoder.tokenizer = Whole()
    words = []
    encoder.known.encoded = lambda word: words.append(word) or seen(word)
    texts = ["The house, the House. the house", "a1 der Äther; the a1 house."] * 3
    first = rans.Words(tokenizer_path()).ids(texts)
    assert encoder.ids(texts) == first
    assert sorted(asked) == [",", ".", ";", "a1"] and len(words) == len(set(words))
