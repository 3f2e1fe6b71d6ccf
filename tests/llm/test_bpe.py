import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from telemetra.llm import bpe
from telemetra.llm.queries import bpe_digest

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


PIECES = ["Hello", "it's", " ", "\n", "\t\r ", "é", "́", "<|endoftext|>", "<|startof", "text|>", "ΑΣ", "İ", "日本", "\xa0", "\x1c", "\x85", " ", "123", "4.5", "…", "'s", "ﬁ", "가", "𝒜", "a" * 40, "!", "\x00", "Å", "<|ENDOFTEXT|>", "ÀÉ.", "ß,", "Straße!", "a.'s", "÷", "×.", "ª.", "x.,", "Ünï;", "µ."]
LATIN = ["Hello", "it's", " ", "\n", "é", "ÀÉ.", "ß,", "a.'s", "÷", "×.", "ª.", "x.,", "Ünï;", "µ.", "Ŋ!", "ŉ", "1.", "\xa0", "ÿ?", ". ", "¿Qué"]

def odd_texts():
    draw, pieces = random.Random(2), PIECES
    texts = ["".join(draw.choices(pieces, k=draw.choice([0, 1, 3, 20, 200, 3000]))) for _ in range(150)]
    texts += ["".join(draw.choices(LATIN, k=draw.choice([3, 20, 400]))) for _ in range(150)]
    shared = "".join(draw.choices(pieces, k=2000))
    return texts + [draw.choice(pieces) * 3 + shared + draw.choice(pieces) for _ in range(20)] + [None, "", "   ", "x" * 100_000]


def test_equals_the_library(spark, library):
    texts = odd_texts()
    rows = [(i if i % 7 else None, text, -1, "clash") for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, tokens_ string")
    tokenizer = Tokenizer.from_file(PATH)
    for bound in (0, 1000):
        found = bpe.encoded(docs, PATH, bound=bound).collect()
        for (_, text, _, _), row in zip(rows, found):
            ids = library(text)
            assert row.tokens.ids == ids and row.tokens.n_tokens == len(ids)
            assert row.tokens.decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_words_are_encoded_in_one_text_without_marks(library):
    encoder, marked = bpe.Encoder(PATH), []
    joined = encoder._joined
    encoder._joined = lambda words, between: marked.extend(words * (between != " ")) or joined(words, between)
    text = "Wörter, die nie (so) stehen: ÀÉa. b2 c.d it's, straße! \tx\ry\n\nz., ŉ?"
    assert encoder.encode(text).ids.split() == [str(i) for i in library(text)]
    assert {"(so)", "b2", "c.d", "it's"} <= set(marked) and not {"wörter", "die", "straße", "x", "y"} & set(marked)
    # A vocabulary that parts such words, or has no tokens that end them, gets marks for all of them.
    for names in ([f"{i} " for i in range(len(encoder.ids))], [f"{i}\n" for i in range(len(encoder.ids))]):
        other = bpe.Encoder(PATH)
        other.ids = [name if own != "\r" else own for own, name in zip(other.ids, names)]
        assert other.encode(text).ids.split() == [str(i) for i in library(text)]


def test_words_of_many_texts_are_encoded_once(library, monkeypatch):
    encoder, asked, marked = bpe.Encoder(PATH, remember=6), [], []
    encode, joined = encoder._encode_words, encoder._joined
    encoder._encode_words = lambda words: asked.append(words) or encode(words)
    encoder._joined = lambda words, between: marked.extend(words * (between != " ")) or joined(words, between)
    texts = ["One two ***\t|", None, " ", "two  one!!! thrée.*** four", "<|endoftext|> one. two|>", "Ǆ Ā*** \u0394 one"]
    found = list(encoder.encode_all(texts))
    assert [t.ids for t in found] == [" ".join(map(str, library(text))) for text in texts]
    # One call for all texts, each word once; signs that end words need no marks, and no more words stay than allowed.
    assert len(asked) == 1 and len(asked[0]) == len(set(asked[0])) and len(encoder.known) + len(encoder.older) <= 6
    assert {"***", "!!!", ".***", "one", "thrée"} <= set(asked[0]) and not any("one" in word for word in marked)
    # Texts that are encoded together may be few.
    monkeypatch.setattr(bpe, "TOGETHER", 2)
    assert list(encoder.encode_all(texts * 3)) == found * 3 and len(encoder.known) + len(encoder.older) <= 6
    monkeypatch.setattr(bpe, "TOGETHER_CHARS", 1)
    assert list(encoder.encode_all(texts * 3)) == found * 3
    assert list(encoder.encode_all([])) == [] and encoder.chunks([]) == []


def test_words_of_letters_skip_steps_of_known_vocabularies_only(library, tmp_path):
    text = "Ünïcode WÖRTER, ǅ ȺĀ stand'ng \u0141ódź..."
    assert bpe.Encoder(PATH).simple is not None
    other = Tokenizer.from_file(PATH)
    other.normalizer = None
    other.save(str(tmp_path / "other.json"))
    assert bpe.Encoder(str(tmp_path / "other.json")).simple is None
    assert bpe.Encoder(PATH).encode(text).ids.split() == [str(i) for i in library(text)]


def test_shared_chunks_start_no_python_for_a_list_of_ids(spark, monkeypatch):
    made = []
    create = type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: made.append(type(data)) or create(self, data, *a, **b))
    passage = "".join(random.Random(3).choices("abcdefgh   ", k=5000))
    docs = spark.createDataFrame([(i, f"{i} " + passage) for i in range(5)], "doc_id long, text string")
    made.clear()
    assert bpe.shared_chunks(docs, PATH) and list not in made


def test_digest_and_decoding(spark, library):
    docs = spark.createDataFrame([(1, "Hello  world it's"), (1, "Hello  world it's"), (2, None)], "doc_id long, text string")
    rows = sorted(bpe_digest(docs, PATH).collect(), key=lambda r: r.doc_id)
    ids = library("Hello  world it's")
    assert rows[0].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and rows[0] == rows[1]
    assert rows[0].decoded_sha256 == hashlib.sha256(b"hello</w> world</w> it</w> 's</w>").hexdigest()
    assert rows[2].n_tokens == 0 and rows[2].ids_sha256 == hashlib.sha256(b"").hexdigest()
    ids_only = bpe.encoded(docs, PATH).select("tokens.ids")
    assert bpe.decoded(ids_only, PATH).first().decoded == "hello</w> world</w> it</w> 's</w>"
    assert bpe_digest(docs.limit(0), PATH).collect() == []


def test_chunks_are_shared_and_exact():
    draw = random.Random(1)
    passage = "".join(draw.choices("abcdefgh   ", k=5000))
    a, b = "begin one " + passage, "quite another start " * 30 + passage
    assert "".join(bpe.chunks(a)) == a and "".join(bpe.chunks(b)) == b
    assert len(set(bpe.chunks(a)) & set(bpe.chunks(b))) > 8
    long = passage * 300
    assert "".join(bpe.chunks(long)) == long and len(set(bpe.chunks(long))) < 200
