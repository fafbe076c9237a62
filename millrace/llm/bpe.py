"""BPE encoding and decoding with forced boundaries.

A merge makes a token of two neighbours, so a pair of bytes that stands inside no token of the vocabulary is never merged across: the text
can be cut there, its fragments encoded each on its own, and the ids put together. Such pairs are found when the vocabulary is
loaded. White space stands in no token at all, so texts are cut there first; the fragments between are looked up by hash, and only
those that a worker has not seen are normalised, split into words, cut further at forced boundaries inside words, and encoded. A very
long text goes through in parts, whose ids are hashed one after the other.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, slices, tidy
from .hashing import Slots, byte_words

TOKENIZER = "word_bpe_49k.json"
#: Fragments whose ids a worker keeps; beyond that it begins anew.
KEPT = 800_000
#: Fragments that are normalised and split in one call.
TOGETHER = 20_000
#: Bytes that go through together.
RUN = 4_000_000
# ASCII white space: these bytes stand in no token and in no other character.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Boundaries:
    """Which letters of the byte alphabet follow one another inside some token. Byte-level vocabularies write a byte as one letter."""

    def __init__(self, tokens: list[str], suffix: str):
        # With the suffix read as an ending and as letters: where it is not clear, a pair counts as one that occurs.
        read = [*tokens, *(t.removesuffix(suffix) for t in tokens if suffix)]
        self.inside = {t[i : i + 2] for t in read for i in range(len(t) - 1)}

    def cut(self, word: str) -> list[str]:
        """The fragments of a word between forced boundaries."""
        at = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.inside]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)], strict=True)] if at else [word]


class Encoder:
    """Ids as the tokenizers library gives them for a file without added special tokens, truncation or padding, by fragments.

    For files whose normalizer, splitter and decoder treat what white space parts each on its own (`parted`); others are refused."""

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not self.parted(spec):
            raise ValueError("texts of this tokenizer cannot be encoded by fragments")
        whole = Tokenizer.from_file(path)
        model = spec["model"]
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.normalizer, self.splitter, self.last = whole.normalizer, whole.pre_tokenizer, whole.model
        # The same merges for a fragment that does not end its word.
        self.inner = models.BPE(vocab, merges) if suffix else whole.model
        self.bounds = Boundaries(list(vocab), suffix)
        self.name = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.number = {i: str(i) for i in self.name}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.forget()

    def forget(self) -> None:
        """Begin anew with what is kept."""
        self.slots, self.ids, self.words, self.lengths = Slots(), [], [], np.zeros(0, np.int64)
        self.known: dict[str, list[int]] = {}

    @staticmethod
    def parted(spec: dict) -> bool:
        """Whether white space has no part in the ids or the decoded text: it is made one space, words are found by a pattern that
        removes what lies between, and tokens are joined by a space (no decoder)."""
        n, p, m = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}, spec["model"]
        kinds = [x["type"] for x in n.get("normalizers", ())]
        steps = p.get("pretokenizers", ())
        return (
            m["type"] == "BPE" and not (m.get("dropout") or m.get("unk_token") or m.get("continuing_subword_prefix") or m.get("ignore_merges") or m.get("byte_fallback"))
            and kinds == ["NFC", "Replace", "Lowercase"] and n["normalizers"][1]["pattern"] == {"Regex": r"\s+"} and n["normalizers"][1]["content"] == " "
            and [x["type"] for x in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and r"[^\s" in steps[0]["pattern"].get("Regex", "")
            and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"] and spec["decoder"] is None
            and not any(t["single_word"] or t["normalized"] for t in spec["added_tokens"])
        )

    def word(self, word: str) -> list[int]:
        """The ids of a word as the splitter gives it."""
        ids = self.known.get(word)
        if ids is None:
            *inner, last = self.bounds.cut(word)
            ids = [t.id for fragment in inner for t in self.inner.tokenize(fragment)] + [t.id for t in self.last.tokenize(last)]
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """The ids of any text that is not cut at white space first."""
        out: list[int] = []
        for k, part in enumerate(self.split_added.split(text) if self.split_added else [text]):
            if k % 2:
                out.append(self.added[part])
            elif part:
                for word, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part)):
                    out += self.word(word)
        return out

    def encode_all(self, fragments: list[str]) -> list[list[int]]:
        """The ids of each fragment. Those without white space of any kind and added tokens are normalised and split together."""
        plain = [k for k, f in enumerate(fragments) if f.split() == [f] and not (self.split_added and self.split_added.search(f))]
        together = self.normalizer.normalize_str(" ".join([fragments[k] for k in plain]))
        ends = np.cumsum([len(f) + 1 for f in together.split(" ")]).tolist()
        if len(ends) != len(plain):
            return [self.encode(f) for f in fragments]
        out: list[list[int]] = [[] for _ in fragments]
        at = 0
        for word, (start, _) in self.splitter.pre_tokenize_str(together):
            while start >= ends[at]:
                at += 1
            out[plain[at]] += self.word(word)
        there = set(plain)
        for k, f in enumerate(fragments):
            if k not in there:
                out[k] = self.encode(f)
        return out

    def numbers(self, x: np.ndarray) -> np.ndarray:
        """A number for each fragment of bytes between white space; the last byte is a space."""
        inside = ~_SPACE[x]
        start, h = byte_words(x, inside)
        keys, first, at = np.unique(h, return_index=True, return_inverse=True)
        if len(self.slots) > KEPT:
            self.forget()
        found = self.slots.find(keys)
        new = np.nonzero(found < 0)[0]
        if len(new):
            turn = np.nonzero(np.diff(inside, prepend=False))[0]
            end = turn[1::2][first[new]]
            raw, lengths = x.tobytes(), []
            fragments = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[first[new]].tolist(), end.tolist(), strict=True)]
            for k in range(0, len(fragments), TOGETHER):
                for ids in self.encode_all(fragments[k : k + TOGETHER]):
                    lengths.append(len(ids))
                    self.ids.append(" ".join([self.number[i] for i in ids]).encode())
                    self.words.append(" ".join([self.name[i] for i in ids]).encode())
            self.slots.add(keys[new])
            self.lengths = np.append(self.lengths, np.array(lengths, np.int64))
            found = self.slots.find(keys)
        return found[at]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text) of each text, all texts at once."""
        raw = [t.encode("utf-8", "replace") for t in texts]
        x = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
        which = self.numbers(x)
        which = which[self.lengths[which] > 0] if len(which) else which, self.lengths[which] > 0 if len(which) else np.zeros(0, bool)
        start = byte_starts(x)
        ends = np.searchsorted(start, np.cumsum([len(r) + 1 for r in raw]))
        kept = np.append(0, np.cumsum(which[1]))[ends]
        count = np.append(0, np.cumsum(self.lengths[which[0]]))[kept]
        out, a, before = [], 0, 0
        numbers = which[0].tolist()
        for b, total in zip(kept.tolist(), count.tolist(), strict=True):
            own = numbers[a:b]
            out.append((total - before, _sha(b" ".join([self.ids[k] for k in own])), _sha(b" ".join([self.words[k] for k in own]))))
            a, before = b, total
        return out

    def long_digest(self, text: str) -> tuple[int, str, str]:
        """The same of one text of any length, in parts that end at white space."""
        n, hashes = 0, (hashlib.sha256(), hashlib.sha256())
        for part in parts(text):
            which = self.numbers(np.frombuffer(part + b" ", np.uint8))
            which = which[self.lengths[which] > 0]
            if len(which):
                for h, table in zip(hashes, (self.ids, self.words), strict=True):
                    h.update((b" " if n else b"") + b" ".join([table[k] for k in which.tolist()]))
                n += int(self.lengths[which].sum())
        return n, hashes[0].hexdigest(), hashes[1].hexdigest()


def byte_starts(x: np.ndarray) -> np.ndarray:
    """Where the fragments between white space begin."""
    return np.nonzero(np.diff(~_SPACE[x], prepend=False))[0][::2]


def parts(text: str, size: int = RUN) -> Iterator[bytes]:
    """The bytes of a text in parts of about `size` characters that end at white space."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            m = re.compile(r"[\t-\r ]").search(text, end)
            end = m.start() if m else len(text)
        yield text[at:end].encode("utf-8", "replace")
        at = end


def _sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


@lru_cache
def encoder(path: str) -> Encoder:
    """A worker loads a file once."""
    return Encoder(path)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of docs.

    A null text is empty: no tokens, and the digests of nothing. Repeated rows each get a row; a table without rows gives none; texts of
    any length go through whole; columns other than the two named are not read."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        own = encoder(tokenizer_path or public_tokenizers.path(TOKENIZER))
        for f in frames:
            texts, out = f["text"].fillna("").tolist(), []
            for a, b in slices(texts, RUN):
                out += own.digests(texts[a:b]) if len(texts[a]) <= RUN else [own.long_digest(texts[a])]
            done = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            done.insert(0, "doc_id", f["doc_id"].to_numpy())
            yield done

    return rows.mapInPandas(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, ids (array of ints), tokens (the decoded text) for every row of docs, by the same fragments; null is empty."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        own = encoder(tokenizer_path or public_tokenizers.path(TOKENIZER))
        for f in frames:
            for doc, text in zip(f["doc_id"], f["text"].fillna(""), strict=True):
                ids, words = [], []
                for part in parts(text):
                    which = own.numbers(np.frombuffer(part + b" ", np.uint8))
                    for k in which[own.lengths[which] > 0].tolist():
                        ids += map(int, own.ids[k].split())
                        words.append(own.words[k])
                yield pd.DataFrame({"doc_id": pd.Series([doc], dtype=f["doc_id"].dtype), "ids": [ids], "decoded": [b" ".join(words).decode()]})

    return rows.mapInPandas(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def op13_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))
