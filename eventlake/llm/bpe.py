"""Byte-level BPE: text to token ids and back, merging many words at once in NumPy.

Texts are cut as the tokenizer's own pre-tokenizer cuts them. The symbols of all words that a worker
has not met before stand in one flat array. Each round looks up all neighbouring pairs by binary
search in the sorted keys of the merge table, takes the lowest rank of every word, merges all its
occurrences from the left, and sets aside the words that have no pair left.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.arrays import Memo, add_columns, ragged, ragged_sums, worker_cache

#: Fixed value: how byte-level BPE cuts text before the merges.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: All that may count as white space, in the syntax of Arrow's expressions.
SPACE = r"\s\pZ\x0b\x1c-\x1f\x{85}"
#: Spaces that have white space, or an end of the text, on either side.
ODD_SPACE = rf"^[{SPACE}]* |[{SPACE}] | [{SPACE}]| $"
NO_RANK = np.iinfo(np.int64).max
#: In longer words, rounds that each pass over the whole word would not pay.
LONG = 2000


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files.

    Printable bytes of Latin-1 stand for themselves, the others for characters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {
        chr(0x100 + place): byte for place, byte in enumerate(rest)
    }


@dataclass(frozen=True)
class Vocabulary:
    byte_ids: np.ndarray  # id of each single byte
    keys: np.ndarray  # sorted: left id * size + right id
    ranks: np.ndarray  # of each key
    merged: np.ndarray  # id that each key's pair becomes
    size: int
    token_bytes: np.ndarray  # all tokens' bytes, by id
    token_starts: np.ndarray
    special: dict[str, int]  # strings that are one token wherever they stand


def load(path: str) -> Vocabulary:
    """Read a byte-level BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    model, cut = parsed["model"], parsed["pre_tokenizer"]
    plain = (
        model["type"] == "BPE" and cut["type"] == "ByteLevel" and parsed["normalizer"] is None
        and not cut["add_prefix_space"] and cut["use_regex"] and not model["dropout"]
        and not model["continuing_subword_prefix"] and not model["end_of_word_suffix"]
        and not model["ignore_merges"]
    )
    added = parsed["added_tokens"]
    if not plain or any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    special = {token["content"]: token["id"] for token in added}
    ids, stands_for = model["vocab"], printable_bytes()
    size = max([*ids.values(), *special.values()]) + 1
    tokens = [b""] * size
    for token, number in ids.items():
        if token not in special:
            tokens[number] = bytes(stands_for[character] for character in token)
    for token, number in special.items():
        tokens[number] = token.encode()
    by_byte = {token: number for number, token in enumerate(tokens) if len(token) == 1}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    keys = np.array([ids[left] * size + ids[right] for left, right in pairs], np.int64)
    merged = np.array([ids[left + right] for left, right in pairs], np.int64)
    order = np.argsort(keys)
    return Vocabulary(
        byte_ids=np.array([by_byte[bytes([byte])] for byte in range(256)], np.int64),
        keys=keys[order],
        ranks=order.astype(np.int64),
        merged=merged[order],
        size=size,
        token_bytes=np.frombuffer(b"".join(tokens), np.uint8),
        token_starts=np.concatenate(([0], np.cumsum([len(token) for token in tokens]))),
        special=special,
    )


def look_up(vocabulary: Vocabulary, left: np.ndarray, right: np.ndarray):
    """Rank of each pair, or `NO_RANK`, and its place in the merge table."""
    pair = left * vocabulary.size + right
    place = np.minimum(np.searchsorted(vocabulary.keys, pair), len(vocabulary.keys) - 1)
    known = vocabulary.keys[place] == pair
    return np.where(known, vocabulary.ranks[place], NO_RANK), place


def merge_long(vocabulary: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """The same merges in one long word: a heap of pairs over a linked list of symbols."""
    rank, place = look_up(vocabulary, symbols[:-1], symbols[1:])
    heap = [
        (r, i, vocabulary.merged[p])
        for i, (r, p) in enumerate(zip(rank.tolist(), place.tolist(), strict=True))
        if r != NO_RANK
    ]
    heapq.heapify(heap)
    now, size = symbols.tolist(), len(symbols)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    # The pair that a symbol starts is still the one in the heap if its rank is.
    ranks = [*rank.tolist(), NO_RANK]

    def renew(at: int) -> None:
        ranks[at] = NO_RANK
        if at >= 0 and after[at] < size:
            r, p = look_up(vocabulary, np.array([now[at]]), np.array([now[after[at]]]))
            if r[0] != NO_RANK:
                ranks[at] = int(r[0])
                heapq.heappush(heap, (ranks[at], at, vocabulary.merged[p[0]]))

    while heap:
        r, at, made = heapq.heappop(heap)
        if now[at] < 0 or ranks[at] != r:
            continue
        gone = after[at]
        now[at], now[gone], ranks[gone] = int(made), -1, NO_RANK
        after[at] = after[gone]
        if after[at] < size:
            before[after[at]] = at
        renew(at)
        if before[at] >= 0:
            renew(before[at])
    return np.array([symbol for symbol in now if symbol >= 0], np.int64)


def merge_words(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and how many each has."""
    lengths = np.array([len(word) for word in words], np.int64)
    symbols = vocabulary.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), lengths)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for word in np.flatnonzero(lengths > LONG).tolist():
        ids = merge_long(vocabulary, symbols[owner == word])
        done.append((np.full(len(ids), word), ids))
    short = lengths[owner] <= LONG
    symbols, owner = symbols[short], owner[short]
    while len(symbols):
        rank, place = look_up(vocabulary, symbols[:-1], symbols[1:])
        rank = np.append(np.where(owner[1:] == owner[:-1], rank, NO_RANK), NO_RANK)
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        least = np.minimum.reduceat(rank, first)
        size = np.diff(np.append(first, len(symbols)))
        least = np.repeat(least, size)
        over = least == NO_RANK
        done.append((owner[over], symbols[over]))
        # Equal pairs may overlap, as in a run of one symbol: every other one merges.
        at = np.flatnonzero((rank == least) & ~over)
        run = np.append(True, at[1:] != at[:-1] + 1)[: len(at)]
        offset = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        at = at[offset % 2 == 0]
        symbols = symbols.copy()
        symbols[at] = vocabulary.merged[place[at]]
        left = ~over
        left[at + 1] = False
        symbols, owner = symbols[left], owner[left]
    owners = np.concatenate([owner for owner, _ in done] or [np.zeros(0, np.int64)])
    ids = np.concatenate([ids for _, ids in done] or [np.zeros(0, np.int64)])
    order = np.argsort(owners, kind="stable")
    return ids[order], np.bincount(owners, minlength=len(words))


def encode_pieces(vocabulary: Vocabulary, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces of text, one after the other, and how many each has."""
    import regex

    cut = regex.compile(PATTERN).findall
    apart = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")").split
    known: dict[str, int] = {}
    special: dict[int, int] = {}  # word to id
    words: list[int] = []
    counts = []
    for piece in pieces:
        before = len(words)
        if vocabulary.special and any(token in piece for token in vocabulary.special):
            for place, part in enumerate(apart(piece)):
                if place % 2:
                    number = known.setdefault(f"\0special {part}", len(known))
                    special[number] = vocabulary.special[part]
                    words.append(number)
                else:
                    words += [known.setdefault(word, len(known)) for word in cut(part)]
        else:
            words += [known.setdefault(word, len(known)) for word in cut(piece)]
        counts.append(len(words) - before)
    spelled = [b"" if i in special else word.encode() for i, word in enumerate(known)]
    ids, lengths = merge_words(vocabulary, spelled)
    starts = np.cumsum(lengths) - lengths
    if special:
        starts = np.append(starts, 0)[: len(lengths)]
        for number, token in special.items():
            starts[number], lengths[number] = len(ids), 1
            ids = np.append(ids, token)
    index = np.array(words, np.int64)
    flat = ids[ragged(starts[index], lengths[index])]
    bounds = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    return flat, ragged_sums(lengths[index], bounds)


def memo_of(vocabulary: Vocabulary) -> Memo:
    memos = worker_cache("bpe")
    name = (vocabulary.size, hash(vocabulary.keys.tobytes()), tuple(vocabulary.special))
    if name not in memos:
        memos.clear()
        memos[name] = Memo(lambda pieces: encode_pieces(vocabulary, pieces))
    return memos[name]


def encode_texts(vocabulary: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a `text_array`, one after the other, and how many each has.

    A space between two characters that are no white space always starts a new word, so texts are
    cut there and each distinct piece is encoded once. A text with other spaces is one piece, and
    so is one that may hold a special token.
    """
    memo = memo_of(vocabulary)
    odd = pc.match_substring_regex(texts, ODD_SPACE)
    for token in vocabulary.special:
        odd = pc.or_(odd, pc.match_substring(texts, token))
    odd = odd.to_numpy(zero_copy_only=False)
    parts = pc.split_pattern(texts, " ")
    bounds = parts.offsets.to_numpy().astype(np.int64)
    values = parts.values.slice(bounds[0], bounds[-1] - bounds[0])
    bounds = bounds - bounds[0]
    first = np.zeros(len(values), bool)
    first[bounds[:-1]] = True
    whole = np.repeat(odd, np.diff(bounds))
    inner = ~first & ~whole
    coded = values.filter(pa.array(inner)).dictionary_encode()
    spaced = pc.binary_join_element_wise("", coded.dictionary, " ").to_pylist()
    starts = values.take(pa.array(np.flatnonzero(first))).to_pylist()
    for row in np.flatnonzero(odd).tolist():
        starts[row] = texts[row].as_py()
    alone = list(dict.fromkeys(starts))
    spaced_set = set(spaced)
    at = {piece: place for place, piece in enumerate(spaced)}
    pieces = spaced + [piece for piece in alone if piece not in spaced_set]
    for place in range(len(spaced), len(pieces)):
        at[pieces[place]] = place
    index = np.zeros(len(values), np.int64)
    index[inner] = coded.indices.to_numpy(zero_copy_only=False)
    index[first] = [at[piece] for piece in starts]
    used = first | inner
    index = index[used]
    counts = ragged_sums(used, bounds)
    start, length = memo.find(pieces)
    flat = memo.flat[ragged(start[index], length[index])]
    return flat, ragged_sums(length[index], np.concatenate(([0], np.cumsum(counts))))


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The texts of `counts` ids each. Bytes that are no UTF-8 become replacement characters."""
    lengths = vocabulary.token_starts[ids + 1] - vocabulary.token_starts[ids]
    flat = vocabulary.token_bytes[ragged(vocabulary.token_starts[ids], lengths)].tobytes()
    ends = np.cumsum(ragged_sums(lengths, np.concatenate(([0], np.cumsum(counts))))).tolist()
    return [
        flat[start:end].decode("utf-8", "replace")
        for start, end in zip([0, *ends], ends, strict=False)
    ]


def packed(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Each text's ids as little-endian unsigned 32-bit integers."""
    ends = np.concatenate(([0], np.cumsum(counts * 4))).astype(np.int32)
    data = np.ascontiguousarray(ids, "<u4")
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(data)]
    )


def encode(documents: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """Add `ids binary`, little-endian unsigned 32-bit token ids, replacing such a column.

    NULL text is encoded as empty text, which has no ids. Equal texts get equal ids.
    """
    return add_columns(
        documents, "ids binary", lambda t: [packed(*encode_texts(vocabulary, t))], text
    )


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """Add `decoded string`, the text of packed ids, replacing such a column. NULL gives NULL.

    A value whose length is no multiple of four, or an id that is not in the vocabulary, is an
    error.
    """

    @F.arrow_udf("string")
    def text_of(values: pa.Array) -> pa.Array:
        out = []
        for value in values:
            raw = value.as_buffer()
            if raw is None:
                out.append(None)
                continue
            found = np.frombuffer(raw, "<u4").astype(np.int64)
            out += decode_ids(vocabulary, found, np.array([len(found)]))
        return pa.array(out, pa.string())

    return rows.withColumn("decoded", text_of(F.col(ids)))


def round_trip(documents: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """Add `ids binary` and `decoded string`, the text that those ids stand for, in one pass."""

    def both(texts: pa.Array) -> list[pa.Array]:
        ids, counts = encode_texts(vocabulary, texts)
        return [packed(ids, counts), pa.array(decode_ids(vocabulary, ids, counts), pa.string())]

    return add_columns(documents, "ids binary, decoded string", both, text)


def bpe_report(documents: DataFrame, path: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    found = round_trip(documents.select("doc_id", "text"), load(path))
    return found.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
