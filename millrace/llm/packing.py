"""Best-fit packing with certified bin counts.

Documents become token pieces of at most `capacity`; pieces are packed by best-fit decreasing within partitions of bounded
size. Dual-feasible functions give a lower bound on the sequences that a partition's pieces need. A partition that meets its
bound is certified and done. A partition with a gap keeps its full sequences and gives the pieces of all others to an
exchange, where they meet the pieces of other partitions with gaps and are packed again, until they fit into one partition or a
round takes less than a tenth of them away; what is left then is packed as it lies.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, materialize, tidy

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
#: Pieces that one task packs at most, on average: about 40 bytes each.
PARTITION_ROWS = 50_000
#: Share of the pieces in the exchange that a round has to leave at most for another one to follow.
SHRINK = 0.9
# Fixed value: the pattern of byte-level pre-tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PIECES = "piece int, start long, length long, ids_crc32 long"


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write the 256 bytes: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def same_as_ranks(path: str) -> bool:
    """Whether tiktoken, by the order of the vocabulary, gives the ids that the tokenizers library gives for this file.

    Both split by the same pattern and then merge neighbours, the one of the lowest rank first, the leftmost of equals. The library
    merges a pair that is listed; tiktoken merges any pair whose join is in the vocabulary. Let the first difference be tiktoken's merge of
    x and y to a token t, with the pair not listed. Up to there both did the same, and x and y were made of their own bytes alone, so the
    library, given the bytes of t alone, comes to x and y as well, and stops there. So if the library makes every token of its own bytes
    one token, there is no such merge; that is tried here for every token. Ranks agree because the merges stand in the order of the ids.

    That is a proof of the merges alone. The splitters are two programs for one pattern: they find the same parts, but tiktoken's gives up
    on some texts (a run of about a million white-space characters is too deep for it), which `encoder` then gives to the library."""
    import json

    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec["pre_tokenizer"] or {}, spec["model"]
    added = {t["content"] for t in spec["added_tokens"]}
    plain = [t for t, _ in sorted(model["vocab"].items(), key=lambda x: x[1]) if t not in added]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges", ())]
    if not (
        model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        and not spec["normalizer"] and not model.get("ignore_merges") and not model.get("dropout") and plain[256:] == merged and set(plain[:256]) == set(_byte_letters())
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    ):
        return False
    bpe = Tokenizer.from_file(path).model
    return all(len(bpe.tokenize(t)) == 1 for t in plain)


@lru_cache
def encoder(path: str):
    """A function from a text to its ids as little-endian unsigned 32-bit bytes, as the tokenizers library gives them for this
    file without added special tokens.

    Where that is proved to be the same when the file is loaded (see same_as_ranks), tiktoken encodes by the file's ranks, several times
    as fast, but for texts that its splitter refuses. Those, and any other file, are left to tokenizers. A worker loads a file once."""
    import json
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()

    def whole(text: str) -> bytes:
        return np.asarray(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    if not same_as_ranks(path):
        return whole
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def encode(text: str) -> bytes:
        try:
            return fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        except ValueError:  # too deep for its splitter
            return whole(text)

    return encode


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids; of a longer document the first piece takes what does not fill a sequence."""
    n = len(ids) // 4
    first = n if n <= capacity else (n % capacity or capacity)
    edges = [0, *range(first, n + 1, capacity)]
    return [(k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: a row per piece. A null text is empty and has the end id alone."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def tokenize(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        encode = encoder(tokenizer_path or public_tokenizers.path(TOKENIZER))
        for f in frames:
            texts, out = f["text"].fillna("").tolist(), []
            for doc, text in zip(f["doc_id"], texts, strict=True):
                out += [(doc, *p) for p in cut(encode(text) + end, capacity)]
            done = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield done.astype({"doc_id": f["doc_id"].dtype})

    return rows.mapInPandas(tidy(tokenize), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {_PIECES}")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest bound on the bins that `lengths` need that two families of dual-feasible functions give."""
    return lower_bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity) if len(lengths) else 0


def lower_bound_of_counts(n: np.ndarray, capacity: int) -> int:
    """The same from the number of pieces of each length, 0 to capacity.

    Each function maps a length to a share of a bin such that no full bin holds more than 1 in all: with x in units of the capacity,
    u(x) = 1 above 1 - t, 0 below t, else x; and v(x) = x where (k + 1) x is whole, else floor((k + 1) x) / k."""
    x = np.arange(capacity + 1)
    from_, mass = np.cumsum(n[::-1])[::-1], np.append(0, np.cumsum(n * x))
    best = -(-int((n * x).sum()) // capacity)
    for t in range(1, capacity // 2 + 1):
        high = int(from_[capacity - t + 1])
        best = max(best, high - (-int(mass[capacity - t + 1] - mass[t]) // capacity))
    for k in range(1, 101):
        whole = (k + 1) * x % capacity == 0
        # in units of 1 / (k * capacity), so that sums are exact
        v = np.where(whole, x * k, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((n * v).sum()) // (k * capacity)))
    return best


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """(sequences used, lower bound on those that the pieces need) of a packed table: equal if no packing has fewer."""
    used = packed.select("sequence_id").distinct().count()
    n = np.zeros(capacity + 1, np.int64)
    for r in packed.groupBy("length").count().collect():  # a row for each length, capacity at most
        n[r["length"]] = r["count"]
    return used, lower_bound_of_counts(n, capacity)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item, and the room left in each bin. Open bins lie by room, with a bit set for each room there is."""
    order = np.argsort(-lengths, kind="stable")
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bits = [], 0
    for i in order.tolist():
        size = int(lengths[i])
        fit = bits >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                bits ^= 1 << room
        else:
            room, b = capacity, len(rooms)
            rooms.append(capacity)
        bin_of[i], offset[i] = b, capacity - room
        room -= size
        rooms[b] = room
        if room:
            stacks[room].append(b)
            bits |= 1 << room
    return bin_of, offset, np.array(rooms, np.int64)


def _pack(capacity: int, turn: int, last: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if not held:
            return
        f = pd.concat(held, ignore_index=True)
        lengths = f["length"].to_numpy(np.int64)
        bin_of, offset, rooms = best_fit_decreasing(lengths, capacity)
        certified = len(rooms) <= lower_bound(lengths, capacity)
        done = np.full(len(rooms), last or certified)
        if not last:
            # Also a certified partition has one sequence that its pieces could not fill; it may meet another's.
            done[rooms == 0] = True
            done[int(rooms.argmax())] = rooms.max() == 0
        f["sequence_id"] = (np.int64(turn) << 56) + (np.int64(TaskContext.get().partitionId()) << 32) + bin_of
        f["offset"], f["placed"] = offset, done[bin_of]
        yield f

    return run


def pack(rows: DataFrame, capacity: int = CAPACITY, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """rows (as from pieces(), written) with sequence_id, any number, and offset, the place in its sequence.

    Every row is placed once and sequences have no gaps before their end. Pieces that fill a sequence take no part in the
    packing. Rows are dealt by a hash of their place in the written table, so repeated rows and hot sources spread evenly; a task
    holds partition_rows rows on average in every round, the last one included."""
    columns = [*rows.columns, "sequence_id", "offset"]
    full = rows.where(F.col("length") >= capacity)
    full = full.withColumn("sequence_id", (F.lit(1).cast("long") * -1) - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    out, pool = [full.select(*columns)], rows.where(F.col("length") < capacity)
    names = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{k}` {v}" for k, v in names.items()) + ", sequence_id long, offset long, placed boolean"
    left, before, turn, last = pool.count(), None, 0, False
    while left and not last or not turn:
        parts = max(1, -(-left // partition_rows))
        last = turn > 0 and (parts == 1 or left > SHRINK * before)
        dealt = pool.withColumn("__deal", F.xxhash64(F.lit(turn), F.monotonically_increasing_id())).repartition(parts, "__deal").drop("__deal")
        got = materialize(dealt.mapInPandas(tidy(_pack(capacity, turn, last)), schema), "packed")
        out.append(got.where("placed").select(*columns))
        pool = got.where(~F.col("placed")).select(*rows.columns)
        before, left, turn = left, pool.count(), turn + 1
    done = out[0]
    for o in out[1:]:
        done = done.unionByName(o)
    return done


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every row of docs.

    Empty and null texts are the end id alone; a table without rows gives none; repeated rows are packed each on their own."""
    return pack(materialize(pieces(docs, id_col, text_col, tokenizer_path, capacity), "pieces"), capacity)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
