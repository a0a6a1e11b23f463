"""Operator 11: word BPE by a trie of the distinct words.

The vocabulary is one of the public ``tokenizers`` files: lower-cased text, white
space dropped, byte symbols, and an own form of the last symbol of a word. Each
task collects the distinct words of its texts and inserts them, sorted, into a
trie; a depth-first walk keeps, for every prefix on the path, the last token of
the prefix's encoding. All tokens that end at a node are met by following the
vocabulary's own trie from every open start; a token is the last one exactly if
it may stand behind the last token of the prefix before it (``Merges.apart``: no
merge of lower rank would join pieces across their border). So a shared prefix
is encoded once, a word's encoding is the chain of last tokens back from its
end, and the cost is linear in the length of a word. Nothing is shuffled.

Unicode versions differ between modules, so the library is asked once for each
character that occurs; texts with a character that it lower-cases or classes
otherwise are normalised and cut into words by the library itself.

Cases: a null or empty text has no ids and decodes to the empty text; repeated
rows give a row each; an id may be null; an empty table gives an empty result;
other columns are ignored. The vocabulary's special strings in a text give their
ids. Texts of any length are cut between words, so memory follows the ids of one
text and the distinct words held (at most ``KEPT`` and those of one block).
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.pretokens import pieces, spread_ids
from tablewright.llm.shared import prepare

#: The contractions of the vocabulary's pattern.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
ASCII_WORDS = re.compile(CONTRACTIONS + r"|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
WORDS = CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
#: The end of a word is the symbol of its last byte plus this.
END = 256
#: Distinct words whose ids a task keeps from block to block.
KEPT = 400_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself
    where it prints, else the next free letter from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Merges:
    """Tokens as symbols, their ranks, the two parts each is made of, and a trie
    of all that are their own encoding."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        letters, n = byte_letters(), max(vocabulary.values()) + 1
        if n >= 1 << 20:
            raise ValueError("ids need at most 20 bits")
        self.rank, self.first, self.final = [0] * n, [0] * n, [0] * n
        self.pair: dict[int, int] = {}          # two neighbours -> rank of their merge
        for k, (a, b) in enumerate(merges):
            x, y, made = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if self.rank[made]:
                raise ValueError(f"two merges make {a + b}")
            self.rank[made], self.first[made], self.final[made], self.pair[x << 20 | y] = k + 1, x, y, k + 1
        if any(max(self.rank[x], self.rank[y]) >= r for r, x, y in zip(self.rank, self.first, self.final) if r):
            raise ValueError("a merge comes before one of its parts")
        self.memo: dict[int, bool] = {}
        self.size = [0] * n
        self.step: dict[int, int] = {}          # node * 512 + symbol -> node
        self.token = [-1]
        for text, number in vocabulary.items():
            plain = text[:-len(suffix)] if text.endswith(suffix) and text != suffix else text
            symbols = [letters[c] for c in plain]
            if plain != text:
                symbols[-1] += END
            self.size[number] = len(symbols)
            if not self._whole(number):
                continue
            node = 0
            for s in symbols:
                key = node * 512 + s
                node = self.step.setdefault(key, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
            self.token[node] = number

    def apart(self, x: int, y: int, limit: int | None = None) -> bool:
        """Whether the tokens stay apart where x is followed by y: the merges of
        both are undone, latest first, and none of the pairs across the border
        may have a rank under that of the merge that ended it. Of equal merges
        the left one comes first. ``limit``: the rank that ends x and y."""
        rank, first, final, pair = self.rank, self.first, self.final, self.pair
        under = limit if limit is not None else len(rank) + 1
        while True:
            if pair.get(x << 20 | y, under) < under:
                return False
            a, b = rank[x], rank[y]
            if a > b:
                under, x = a, final[x]
            elif b:
                under, y = b + 1, first[y]
            else:
                return True

    def _whole(self, token: int) -> bool:
        """Whether a token is the encoding of its own symbols."""
        held = [token]
        while held:
            t = held.pop()
            if self.rank[t]:
                if not self.apart(self.first[t], self.final[t], self.rank[t]):
                    return False
                held += self.first[t], self.final[t]
        return True

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of sorted words (none empty), one word after the other, and how
        many each has. ``last[d]`` is the last token of the path's first d symbols
        and ``open_at[d]`` the vocabulary nodes of all starts still open there."""
        step, token, size, memo = self.step, self.token, self.size, self.memo
        if len(memo) > 2_000_000:
            memo.clear()
        last, open_at, before = [-1], [[(0, 0)]], b""
        flat: list[int] = []
        many = np.zeros(len(words), np.int64)
        for k, word in enumerate(words):
            inner = len(word) - 1
            depth, shared = 0, min(inner, len(last) - 1)
            while depth < shared and word[depth] == before[depth]:
                depth += 1
            del last[depth + 1:], open_at[depth + 1:]
            before = word
            while depth <= inner:
                symbol = word[depth] if depth < inner else word[depth] + END
                found, still = -1, []
                for start, node in open_at[depth]:
                    node = step.get(node * 512 + symbol)
                    if node is None:
                        continue
                    still.append((start, node))
                    t = token[node]
                    if t >= 0 and found < 0:
                        if start:
                            pair = last[start] << 20 | t
                            fits = memo.get(pair)
                            if fits is None:
                                fits = memo[pair] = self.apart(last[start], t)
                            if not fits:
                                continue
                        found = t
                depth += 1
                if depth <= inner:
                    still.append((depth, 0))
                    last.append(found)
                    open_at.append(still)
            begin, at = len(flat), len(word)
            while at:
                flat.append(found)
                at -= size[found]
                found = last[at]
            flat[begin:] = flat[begin:][::-1]
            many[k] = len(flat) - begin
        return np.array(flat, np.int32), many


class Codes(dict):
    """Numbers of words, in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class WordEncoder:
    """Ids of whole texts by a ``tokenizers`` file."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Regex, Tokenizer, normalizers

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.merges = Merges(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.pattern = regex.compile(WORDS)
        self.lower = normalizers.Lowercase()
        self.classes = [(normalizers.Replace(Regex(p), ""), regex.compile(p)) for p in (r"\p{L}", r"\p{N}")]
        self.bytes_of = byte_letters()
        self.known_characters: set[str] = set()
        self.odd: set[str] = set()
        self.forget()

    def forget(self) -> None:
        self.code = Codes()
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def words(self, text: str) -> list[str]:
        """The words of a text, or of a part that ends between words."""
        if text.isascii():
            return ASCII_WORDS.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        own = set(text)
        new = own - self.known_characters
        if new:
            self.known_characters |= new
            self.odd |= {c for c in new if not self._same(c)}
        if own.isdisjoint(self.odd):
            return self.pattern.findall(text.lower())
        bytes_of = self.bytes_of
        text = self.normalizer.normalize_str(text)
        return [bytes(bytes_of[c] for c in w).decode("utf-8") for w, _ in self.splitter.pre_tokenize_str(text)]

    def _same(self, c: str) -> bool:
        """Whether this module treats a character as the library does: its small
        letter (the capital sigma's depends on its place here), and the classes
        of that."""
        small = c.lower()
        return c != "\u03a3" and self.lower.normalize_str(c) == small and all(
            theirs.normalize_str(small) == mine.sub("", small) for theirs, mine in self.classes)

    def _codes(self, text: str) -> np.ndarray:
        """Numbers of the text's words; new words get the next ones."""
        return np.array(list(map(self.code.__getitem__, self.words(text))), np.int64)

    def _learn(self) -> None:
        known = len(self.sizes)
        if known == len(self.code):
            return
        raw = [w.encode("utf-8") for w in list(self.code)[known:]]
        order = sorted(range(len(raw)), key=raw.__getitem__)
        flat, many = self.merges.encode([raw[k] for k in order])
        place = np.argsort(np.array(order))
        self.flat = np.concatenate([self.flat, spread_ids(place, flat, many)])
        self.sizes = np.concatenate([self.sizes, many[place]])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (int32) of each text. The words of all texts that are new are
        inserted together, so that they share their prefixes."""
        if len(self.code) > KEPT:
            self.forget()
        held: list[list[np.ndarray | int]] = []
        for text in texts:
            parts: list[np.ndarray | int] = []
            for _, part in pieces([text]):
                for k, x in enumerate(self.cut.split(part)):
                    parts.append(self.special[x] if k % 2 else self._codes(x))
            held.append(parts)
        self._learn()
        out = []
        for parts in held:
            found = [np.array([x], np.int32) if isinstance(x, int) else spread_ids(x, self.flat, self.sizes) for x in parts]
            out.append(np.concatenate(found) if found else np.zeros(0, np.int32))
        return out


def _type_of(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_tokens`` and ``ids`` (array<int>) of every whole text by the
    ``tokenizers`` file at ``path``, which every executor can read."""
    prepare(df.sparkSession)
    schema = pa.schema([(id_col, _type_of(df, id_col)), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for batch in batches:
            found = encoder.ids([t or "" for t in batch.column(1).to_pylist()])
            sizes = np.array([len(x) for x in found], np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *found])
            yield pa.record_batch([batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                  schema=schema)

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, T.StructType([
        df.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the strings of the tokens, special ones too, joined
    by one space (the file has no decoder). Null ids decode to null; a column
    ``decoded`` that is there is replaced."""
    prepare(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        strings = {i: t for t, i in file["model"]["vocab"].items()} | {t["id"]: t["content"] for t in file["added_tokens"]}
        string = strings.__getitem__
        for batch in batches:
            texts = []
            for row in batch.column(batch.schema.get_field_index(ids_col)):
                texts.append(" ".join(map(string, row.values.to_numpy(zero_copy_only=False).tolist())) if row.is_valid else None)
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return df.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(
        run, T.StructType([*kept, T.StructField("decoded", T.StringType())]))
