"""Byte-pair encoding and decoding with content-defined chunk reuse.

A rolling hash cuts texts into chunks whose borders depend only on the characters just before them, so texts
that share a passage share its chunks. Chunks that documents share are counted over the whole corpus; the ones that
save most work are encoded once, and their tokens go to all tasks as a table of bounded size. Any other
chunk is encoded where it stands. Tokens never reach across white space, so a chunk's tokens hold between its first
and its last white space; where chunks join, the words around the border are encoded again as one, over as many chunks
as it takes, until the result is that of the whole text. Texts are split into words and put together again many at a
time, as Arrow columns, so each word is looked up once for all of them; a table of bounded size remembers words within a task.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import batched
from operator import itemgetter
from typing import TYPE_CHECKING, NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from tokenizers import Tokenizer

# The hash looks at this many characters; a chunk ends where its top bits are zero, on average after 256.
WINDOW, TOP_BITS = 32, 8
# Shared chunks that are encoded once for all tasks: at most so many, of at most so many characters.
MAX_SHARED, MAX_SHARED_CHARS = 16_384, 2_048
# Words that a task remembers, half of them at least being the ones used last.
MAX_WORDS = 300_000
# Texts that are encoded together: at most so many, and no further one after so many characters.
TOGETHER, TOGETHER_CHARS = 512, 1 << 18
# Words of Latin letters that go to the tokenizer as one text.
JOINED = 64
# Characters that are hashed at a time.
SEGMENT = 1 << 20
# White space at which texts can be cut: the tokenizer takes it as white space and keeps no part of it.
SPACE = re.compile(r"[ \t\n\r]")
# Signs behind a Latin letter at the end of a word are a word of their own. Apostrophes and what special tokens are made of stay.
SIGN = re.compile(r"[.,;:!?\"#$%&*+\-/=@^~](?<=[a-zß-öø-įı-ɏ].)[.,;:!?\"#$%&*+\-/=@^~]*(?=[ \t\n\r]|\Z)")
# Words that the tokenizer leaves whole.
LETTERS = re.compile(r"[a-zß-öø-įı-ɏ]+")
# Texts with a character beyond these, or with what may begin a special token, are not put into lower case beforehand.
ODD = re.compile(r"[^\x00-\u012f\u0131-\u024f]|<\|")
_GEAR = np.random.default_rng(20240607).integers(0, 2**32, 65_536, dtype=np.uint32)


class Tokens(NamedTuple):
    """Tokens of a piece of text: their ids joined by spaces, and their decoded text."""

    ids: str
    text: str

    @property
    def n(self) -> int:
        return self.ids.count(" ") + 1 if self.ids else 0


class Chunk(NamedTuple):
    """A chunk's tokens between its white spaces, and the word parts before and after. Without white space all is head."""

    head: str
    inner: Tokens | None
    tail: str


NO_TOKENS = Tokens("", "")
IDS, TEXT = itemgetter(0), itemgetter(1)
# The words of vocabularies that part text in the usual way.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def plain(text: str) -> str:
    """Lower case, as the tokenizer makes it, where that is certain to give the same tokens; else the text itself."""
    try:
        # Most texts are of these characters, and this is the faster way to tell.
        text.encode("latin-1")
        odd = "<|" in text
    except UnicodeEncodeError:
        odd = ODD.search(text)
    return text if odd else text.lower()


def spaced(text: str) -> str:
    """The text with spaces for white space, and before signs that end a word."""
    return SIGN.sub(r" \g<0>", text).replace("\n", " ").replace("\t", " ").replace("\r", " ")


def cuts(text: str) -> list[int]:
    """Where chunks end; the last one ends with the text."""
    found = []
    for begin in range(0, len(text), SEGMENT):
        first = max(0, begin - WINDOW + 1)
        codes = np.frombuffer(text[first : begin + SEGMENT].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        rolled = _GEAR[(codes ^ (codes >> 16)) & 0xFFFF]
        reach = 1
        while reach < WINDOW:
            rolled[reach:] += rolled[:-reach] << np.uint32(reach)
            reach *= 2
        found.append(np.flatnonzero(rolled >> np.uint32(32 - TOP_BITS) == 0) + first + 1)
        found[-1] = found[-1][found[-1] > begin]
    ends = np.concatenate(found).tolist() if found else []
    return ends if ends and ends[-1] == len(text) else [*ends, len(text)]


def chunks(text: str) -> list[str]:
    ends = cuts(text)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _key(chunk: str) -> int:
    return xxhash.xxh3_64_intdigest(chunk.encode("utf-8", "surrogatepass")) - 2**63


class Encoder:
    """Encodes texts by chunks and words, with the library's tokenizer for words not seen before."""

    def __init__(self, path: str, shared: dict[str, Chunk] | None = None, remember: int = MAX_WORDS) -> None:
        # A task has one core; threads of the library would only get into each other's way.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.decoder is not None:
            raise ValueError("tokens of this vocabulary can't be decoded word by word")
        special = [(i, token.content) for i, token in self.tokenizer.get_added_tokens_decoder().items() if token.special and not token.normalized]
        self.mark, self.parting = special[0] if special else (None, None)
        # Every token's id and text, with a line feed behind those that end a word. Texts of tokens have no such characters.
        ending, numbers = getattr(self.tokenizer.model, "end_of_word_suffix", None), range(self.tokenizer.get_vocab_size())
        behind = ["\n" if ending and (self.tokenizer.id_to_token(i) or "").endswith(ending) else " " for i in numbers]
        self.ids = [f"{i}{sign}" for i, sign in zip(numbers, behind)]
        self.texts = [self.tokenizer.decode([i], skip_special_tokens=False) + sign for i, sign in zip(numbers, behind)]
        if self.mark is not None:
            self.ids[self.mark] = self.texts[self.mark] = "\r"
        self.shared, self.remember = shared or {}, remember
        # What ``Tokens`` has, for each word; the words used last, and those before them.
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.simple = _simple(self.tokenizer)

    def look_up(self, words: list[str]) -> list[tuple[str, str]]:
        """Ids and text of distinct words; those that are not remembered are encoded in one call."""
        found = list(map(self.known.get, words))
        fresh = [word for word, pair in zip(words, found) if pair is None]
        if fresh:
            pairs = {word: pair for word in fresh if (pair := self.older.get(word)) is not None}
            pairs |= self._encode_words([word for word in fresh if word not in pairs])
            found = [pair or pairs[word] for word, pair in zip(words, found)]
            most = self.remember // 2
            if len(self.known) + len(pairs) > most:
                self.older, self.known, pairs = self.known, {}, dict(zip(words[:most], found))
            self.known.update(pairs)
        return found

    def _encode_words(self, words: list[str]) -> dict[str, tuple[str, str]]:
        """Most words are encoded in one text, which is faster than one by one: those of Latin letters with spaces between them."""
        known: dict[str, tuple[str, str]] = {}
        whole = list(filter(LETTERS.fullmatch, words))
        if whole:
            found = [part.split("\n") for part in self._joined(whole, " ")]
            # There is one ending token for each word, unless the vocabulary parts words or has no such tokens.
            if all(len(parts) == len(whole) + 1 and not parts[-1] for parts in found):
                known.update(zip(whole, zip(*found)))
                words = [word for word in words if word not in known]
        apart = [word for word in words if self.mark is None or "<|" in word]
        for word, encoding in zip(apart, self.tokenizer.encode_batch_fast(apart, add_special_tokens=False) if apart else ()):
            known[word] = " ".join(map(str, encoding.ids)), self.tokenizer.decode(encoding.ids, skip_special_tokens=False)
        rest = [word for word in words if self.mark is not None and "<|" not in word] if apart else words
        if rest:
            # The others are parted by a special token.
            found = [part.replace("\n", " ").split("\r") for part in self._joined(rest, self.parting)]
            known.update(zip(rest, zip(*([part.strip(" ") for part in parts] for parts in found), strict=True), strict=True))
        return known

    def _joined(self, words: list[str], between: str) -> tuple[str, str]:
        """The ids and the texts of words encoded as one."""
        if between == " " and self.simple is not None:
            texts = [between.join(words[i : i + JOINED]).lower() for i in range(0, len(words), JOINED)]
            parts = self.simple.encode_batch_fast(texts, add_special_tokens=False)
            ids = [i for part in parts for i in part.ids]
        else:
            ids = self.tokenizer.encode_batch_fast([between.join(words)], add_special_tokens=False)[0].ids
        return "".join(map(self.ids.__getitem__, ids)), "".join(map(self.texts.__getitem__, ids))

    def _tokens(self, rows: list[list[str | Tokens]]) -> list[Tokens]:
        """The tokens of rows of pieces, each a string with spaces between words or tokens already known; a row begins with a string."""
        if not rows:
            return []
        strings = [piece for row in rows for piece in row if isinstance(piece, str)]
        split = pc.split_pattern(pa.array(strings, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        pairs = self.look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        # Behind the words come the tokens already known, each at its place between the pieces.
        ends, place, at, bounds, given = split.offsets.to_numpy(), 0, [], [0], []
        for row in rows:
            for piece in row:
                if isinstance(piece, str):
                    place += 1
                else:
                    at.append(ends[place])
                    given.append(piece)
            bounds.append(ends[place] + len(given))
        index = np.insert(coded.indices.to_numpy(), at, np.arange(len(pairs), len(pairs) + len(given)))
        columns = [[*map(part, pairs), *map(part, given)] for part in (IDS, TEXT)]
        # What has no tokens leaves no space.
        kept = np.fromiter(map(bool, columns[0]), dtype=bool, count=len(columns[0]))[index]
        offsets = pa.array(np.concatenate([[0], np.cumsum(kept)])[bounds], pa.int64())
        index = pa.array(index[kept])
        lists = (pa.LargeListArray.from_arrays(offsets, pa.array(column, pa.large_string()).take(index)) for column in columns)
        return list(map(Tokens, *(pc.binary_join(list_, pa.scalar(" ", pa.large_string())).to_pylist() for list_ in lists)))

    def chunks(self, found: list[str]) -> list[Chunk]:
        """The tokens of chunks that stand alone."""
        parted = list(map(_parted, found))
        tokens = iter(self._tokens([[parts[1]] for parts in parted if parts]))
        return [Chunk(parts[0], next(tokens), parts[2]) if parts else Chunk(chunk, None, "") for chunk, parts in zip(found, parted)]

    def _pieces(self, text: str | None) -> list[str | Tokens]:
        """Tokens of shared chunks, and the strings before, between and behind them."""
        text = plain(text) if text else ""
        # Between two shared chunks everything is split into words as one, from the tail of the one to the head of the other.
        pieces: list[str | Tokens] = []
        between: list[str] = []
        for piece in chunks(text) if self.shared else [text]:
            known = self.shared.get(piece)
            if known is None or known.inner is None:
                between.append(piece)
                continue
            between.append(known.head)
            pieces += [spaced("".join(between)), known.inner]
            between = [known.tail]
        return [*pieces, spaced("".join(between))]

    def encode(self, text: str | None) -> Tokens:
        """Tokens of a whole text; a null text counts as empty."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[Tokens]:
        """Tokens of whole texts, in order."""
        rows: list[list[str | Tokens]] = []
        size = 0
        for text in texts:
            rows.append(self._pieces(text))
            size += len(text or "")
            if len(rows) >= TOGETHER or size >= TOGETHER_CHARS:
                yield from self._tokens(rows)
                rows, size = [], 0
        if rows:
            yield from self._tokens(rows)


def _simple(tokenizer: Tokenizer) -> Tokenizer | None:
    """The same model for words of Latin letters in lower case, without the steps that leave them as they are; none if others are there."""
    from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

    to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    usual = [
        (tokenizer.normalizer, normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()])),
        (tokenizer.pre_tokenizer, pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(PARTS), "removed", invert=True), to_bytes])),
    ]
    if any(step is None or json.loads(step.__getstate__()) != json.loads(known.__getstate__()) for step, known in usual):
        return None
    simple = Tokenizer(tokenizer.model)
    simple.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), to_bytes])
    return simple


def _parted(chunk: str) -> tuple[str, str, str] | None:
    """The part before a chunk's first white space, the words after it, and the part behind its last; none without any."""
    first = SPACE.search(chunk)
    if first is None:
        return None
    last = max(chunk.rfind(" "), chunk.rfind("\n"), chunk.rfind("\t"), chunk.rfind("\r"))
    return chunk[: first.start()], spaced(chunk[first.start() : last]), chunk[last + 1 :]


def shared_chunks(docs: DataFrame, path: str, bound: int = MAX_SHARED, text_column: str = "text") -> dict[str, Chunk]:
    """The chunks whose reuse saves most characters, encoded once each.

    All chunks of all texts are counted; of those that occur more than once, the ``bound`` with the most characters saved
    are taken, which keeps the table's size below a fixed one. Each is then cut again out of one text that holds it.
    """
    texts = docs.select(F.col(text_column).alias("text"), F.xxhash64(text_column).alias("holder"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys: list[int] = []
            sizes, holders = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
            for text, holder in zip(batch["text"], batch["holder"].tolist()):
                if text:
                    found = chunks(plain(text))
                    keys += map(_key, found)
                    sizes.append(np.fromiter(map(len, found), dtype=np.int32, count=len(found)))
                    holders.append(np.full(len(found), holder))
            frame = pd.DataFrame({"key": np.array(keys, dtype=np.int64), "chars": np.concatenate(sizes), "holder": np.concatenate(holders)})
            yield frame[frame["chars"] <= MAX_SHARED_CHARS]

    counted = texts.mapInPandas(count, "key long, chars int, holder long").groupBy("key")
    counted = counted.agg(F.count(F.lit(1)).alias("n"), F.max("chars").alias("chars"), F.min("holder").alias("holder"))
    saved = (F.col("n") - 1) * F.col("chars")
    best = counted.filter("n > 1").orderBy(saved.desc(), "key").limit(bound).select("key", "holder").toArrow()
    if not len(best):
        return {}
    wanted = docs.sparkSession.sparkContext.broadcast(frozenset(best["key"].to_pylist()))
    # The texts that hold a wanted chunk: at most as many as chunks. An Arrow table needs no Python process on the executors.
    holders = docs.sparkSession.createDataFrame(best.select(["holder"]))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(key, chunk) for text in batch["text"] for chunk in chunks(plain(text)) if (key := _key(chunk)) in wanted.value]
            yield pd.DataFrame(rows, columns=["key", "chunk"])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for batch in batches:
            found = encoder.chunks(batch["chunk"].tolist())
            rows = [(text, *_flat(chunk)) for text, chunk in zip(batch["chunk"], found)]
            yield pd.DataFrame(rows, columns=["chunk", "head", "tail", "ids", "decoded"])

    held = texts.join(F.broadcast(holders), "holder", "left_semi").select("text")
    distinct = held.mapInPandas(fetch, "key long, chunk string").groupBy("key").agg(F.min("chunk").alias("chunk"))
    encoded = distinct.mapInPandas(encode, "chunk string, head string, tail string, ids string, decoded string")
    return {r["chunk"]: Chunk(r["head"], None if r["ids"] is None else Tokens(r["ids"], r["decoded"]), r["tail"]) for r in encoded.collect()}


def _flat(chunk: Chunk) -> tuple[str, str, str | None, str | None]:
    return chunk.head, chunk.tail, *(chunk.inner or (None, None))


def encoded(
    docs: DataFrame,
    path: str,
    columns: str = "n_tokens long, ids array<int>, decoded string",
    finish: Callable[[Tokens], tuple] | None = None,
    text_column: str = "text",
    bound: int = MAX_SHARED,
    to: str = "tokens",
    remember: int = MAX_WORDS,
) -> DataFrame:
    """Add a struct ``to`` to every row: number, ids and decoded text, or what ``finish`` makes of them as ``columns``.

    ``path`` is the vocabulary's file, which every executor must have. A task remembers the tokens of at most ``remember`` words; fewer take
    less memory and more time. Null and empty texts have no tokens. No
    row is lost or repeated, and every other column stays as it is.
    """
    shared = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, path, bound, text_column))
    names = [column.split()[0] for column in columns.split(", ")]
    last = finish or whole

    @F.pandas_udf(columns)
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path, shared.value, remember)
        for texts in batches:
            for part in batched(map(last, encoder.encode_all(texts)), TOGETHER):
                yield pd.DataFrame(list(part), columns=names)

    return docs.withColumn(to, tokens(F.col(text_column)))


def whole(tokens: Tokens) -> tuple:
    return tokens.n, np.fromstring(tokens.ids, dtype=np.int32, sep=" "), tokens.text


def decoded(tokens: DataFrame, path: str, ids_column: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of a column of token ids; null ids count as none."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = Encoder(path).tokenizer
        for batch in batches:
            yield pd.Series([tokenizer.decode([] if ids is None else list(ids), skip_special_tokens=False) for ids in batch], dtype=object)

    return tokens.withColumn("decoded", decode(F.col(ids_column)))
