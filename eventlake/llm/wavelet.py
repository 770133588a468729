"""Token ids in files of wavelet matrices.

A shard file holds one wavelet matrix: a plane of bits per bit of the largest id, most significant
first, where every plane orders the ids by the planes above it, zeros before ones. With the count of
ones before each block of a plane, the file answers, reading only the blocks it needs, which id
stands at a position, how often an id occurs before a position, and where its n-th occurrence is.
Blocks are compressed each by itself. `ids_at`, `count_ids` and `find_id` ask all files so. Beside the
planes the file keeps the ids and starts of its
documents.

Layout, all integers little-endian: magic, version, tokens, documents, planes (five u64), then per
plane the number of zeros, then per plane and block the ones before it and the place of its bytes
(u64, one more than blocks), then the compressed document table, then the compressed blocks.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlake.llm.arrays import (
    Memo,
    ragged,
    ragged_sums,
    slices,
    text_array,
    words_of,
    worker_cache,
)
from eventlake.llm.tables import committed, new_folder
from eventlake.session import make_folder

MAGIC, VERSION = int.from_bytes(b"WAVELETM", "little"), 1
#: Bits in a block: what one look-up decompresses.
BLOCK = 1 << 15
#: A file is closed once it holds so many tokens, at the end of a document.
SHARD_TOKENS = 1 << 22
SEPARATOR = "<|endoftext|>"


def pack(raw: bytes) -> bytes:
    """Zstandard, unless that does not help."""
    small = pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)
    return small if len(small) < len(raw) else raw


def unpack(stored: bytes, size: int) -> bytes:
    if len(stored) == size:
        return stored
    return pa.Codec("zstd").decompress(stored, size, asbytes=True)


def build(tokens: np.ndarray, documents: np.ndarray, lengths: np.ndarray) -> bytes:
    """A shard file: ids of all tokens, document ids (-1 << 63 for NULL) and their token counts."""
    width = max(1, int(tokens.max(initial=0)).bit_length())
    kind = np.uint16 if width <= 16 else np.uint32
    row = tokens.astype(kind)
    zeros, ones, sizes, blocks = [], [], [], []
    for plane in range(width - 1, -1, -1):
        bits = (row & kind(1 << plane)) != 0
        padded = np.packbits(bits, bitorder="little")
        per_byte = BLOCK // 8
        before = 0
        for start in range(0, len(padded), per_byte):
            raw = padded[start : start + per_byte]
            ones.append(before)
            before += int(np.bitwise_count(raw).sum())
            blocks.append(pack(raw.tobytes()))
            sizes.append(len(blocks[-1]))
        ones.append(before)
        zeros.append(len(row) - before)
        row = np.concatenate((np.compress(~bits, row), np.compress(bits, row)))
    table = pack(
        documents.astype("<i8").tobytes() + np.asarray(lengths).astype("<u8").tobytes()
    )
    head = np.array([MAGIC, VERSION, len(tokens), len(documents), width], "<u8")
    places = np.concatenate(([0], np.cumsum(sizes, dtype=np.uint64))).astype("<u8")
    return b"".join(
        [
            head.tobytes(),
            np.array(zeros, "<u8").tobytes(),
            np.array(ones, "<u8").tobytes(),
            places.tobytes(),
            len(table).to_bytes(8, "little"),
            table,
            *blocks,
        ]
    )


class WaveletMatrix:
    """Look-ups in a shard file, given as its bytes or as an open file that is read from any place.

    The file's head is read at once, the document table and each block when they are first needed.
    """

    def __init__(self, stored: bytes | pa.NativeFile):
        if isinstance(stored, pa.NativeFile):
            self.read = lambda start, end: stored.read_at(end - start, start)
        else:
            view = memoryview(stored)
            self.read = lambda start, end: bytes(view[start:end])
        magic, version, self.size, self.n_documents, self.width = self._numbers(0, 5).tolist()
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a wavelet matrix file of this version")
        self.blocks = -(-self.size // BLOCK)
        at = 40
        self.zeros = self._numbers(at, self.width).tolist()
        at += 8 * self.width
        self.ones = self._numbers(at, self.width * (self.blocks + 1)).reshape(self.width, -1)
        at += self.ones.size * 8
        places = self._numbers(at, self.width * self.blocks + 1)
        at += places.size * 8
        self.table_at, table_size = at + 8, int(self._numbers(at, 1)[0])
        self.places = places.astype(np.int64) + self.table_at + table_size
        self.cache: dict[tuple[int, int], np.ndarray] = {}

    def _numbers(self, at: int, count: int) -> np.ndarray:
        return np.frombuffer(self.read(at, at + 8 * count), "<u8")

    @cached_property
    def _table(self) -> bytes:
        return unpack(self.read(self.table_at, int(self.places[0])), self.n_documents * 16)

    @property
    def documents(self) -> np.ndarray:
        return np.frombuffer(self._table, "<i8", self.n_documents)

    @cached_property
    def lengths(self) -> np.ndarray:
        half = self.n_documents * 8
        return np.frombuffer(self._table, "<u8", self.n_documents, half).astype(np.int64)

    def _stored(self, place: int) -> bytes:
        return self.read(int(self.places[place]), int(self.places[place + 1]))

    def _block(self, plane: int, block: int) -> np.ndarray:
        """The bits of one block as an array of 0 and 1."""
        if (plane, block) not in self.cache:
            bits = min(BLOCK, self.size - block * BLOCK)
            place = plane * self.blocks + block
            raw = unpack(self._stored(place), -(-bits // 8))
            self.cache[plane, block] = np.unpackbits(
                np.frombuffer(raw, np.uint8), count=bits, bitorder="little"
            )
        return self.cache[plane, block]

    def _ones_before(self, plane: int, position: int) -> int:
        block, offset = divmod(position, BLOCK)
        count = int(self.ones[plane, block])
        return count + int(self._block(plane, block)[:offset].sum()) if offset else count

    def _find(self, plane: int, bit: int, nth: int) -> int:
        """The position of the nth `bit` of a plane, from 0: binary search, then within a block."""
        starts = np.arange(self.blocks + 1) * BLOCK
        before = self.ones[plane].astype(np.int64)
        if not bit:
            before = np.minimum(starts, self.size) - before
        block = int(np.searchsorted(before, nth, side="right")) - 1
        inside = np.flatnonzero(self._block(plane, block) == bit)
        return block * BLOCK + int(inside[nth - int(before[block])])

    def access(self, position: int) -> int:
        """The id at a position."""
        if not 0 <= position < self.size:
            raise IndexError(position)
        token = 0
        for plane in range(self.width):
            block, offset = divmod(position, BLOCK)
            bit = int(self._block(plane, block)[offset])
            ones = self._ones_before(plane, position)
            position = self.zeros[plane] + ones if bit else position - ones
            token = token << 1 | bit
        return token

    def _descend(self, token: int, position: int) -> tuple[int, int]:
        """Where the token's run starts in the last order, and its end for those before position."""
        start, end = 0, position
        for plane in range(self.width):
            ones = self._ones_before(plane, start), self._ones_before(plane, end)
            if token >> (self.width - 1 - plane) & 1:
                start, end = (self.zeros[plane] + one for one in ones)
            else:
                start, end = start - ones[0], end - ones[1]
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often an id occurs from `start` to before `end`."""
        end = self.size if end is None else min(end, self.size)
        if token >> self.width or token < 0 or start >= end:
            return 0
        low, high = self._descend(token, end)
        return high - low - (self._descend(token, start)[1] - low if start else 0)

    def occurrence(self, token: int, nth: int) -> int:
        """The position of an id's nth occurrence, from 0; IndexError if there is none."""
        if not 0 <= nth < self.count(token):
            raise IndexError(nth)
        position = self._descend(token, self.size)[0] + nth
        for plane in range(self.width - 1, -1, -1):
            if token >> (self.width - 1 - plane) & 1:
                position = self._find(plane, 1, position - self.zeros[plane])
            else:
                position = self._find(plane, 0, position)
        return position

    def tokens(self) -> np.ndarray:
        """All ids: the stable partition of every plane undone, from the last one upward."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        row = np.zeros(self.size, kind)
        for plane in range(self.width - 1, -1, -1):
            raw = b"".join(
                unpack(self._stored(place), -(-min(BLOCK, self.size - block * BLOCK) // 8))
                for block, place in enumerate(
                    range(plane * self.blocks, (plane + 1) * self.blocks)
                )
            )
            bits = np.unpackbits(
                np.frombuffer(raw, np.uint8), count=self.size, bitorder="little"
            ).view(bool)
            zeros = self.zeros[plane]
            row[zeros:] |= kind(1 << (self.width - 1 - plane))
            above = np.empty_like(row)
            above[np.flatnonzero(~bits)] = row[:zeros]
            above[np.flatnonzero(bits)] = row[zeros:]
            row = above
        return row


def library_ids(tokenizer) -> Memo:
    """Ids of pieces of text by the tokenizers library.

    Pieces of plain letters are words to the library's model as they are. Others go through all of
    the library, many a call: letters with spaces between them, cut where a word ends, and the rest
    joined by a special token, where the library cuts before anything else. What may hold a special
    token, or more than one word against expectation, goes alone.
    """
    separator = tokenizer.token_to_id(SEPARATOR)
    word_ids = tokenizer.model.tokenize
    suffix = tokenizer.model.end_of_word_suffix
    ends_word = {number for token, number in tokenizer.get_vocab().items() if token.endswith(suffix)}

    def together(pieces: list[str], places: list[int], joint: str, cut, ids: list) -> list[int]:
        """Encode the pieces at these places; returns the places where that did not work."""
        groups = [places[at : at + 64] for at in range(0, len(places), 64)]
        joined = [joint.join([pieces[place] for place in group]) for group in groups]
        left = []
        for group, found in zip(
            groups, tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True
        ):
            flat = found.ids
            parts = cut(flat)
            if len(parts) != len(group):
                left += group
                continue
            for place, (low, high) in zip(group, parts, strict=True):
                ids[place] = flat[low:high]
        return left

    def at_ends(flat: list[int]) -> list[tuple[int, int]]:
        ends = [at for at, number in enumerate(flat, 1) if number in ends_word]
        return list(zip([0, *ends], ends, strict=False))

    def at_separators(flat: list[int]) -> list[tuple[int, int]]:
        cuts = [at for at, number in enumerate(flat) if number == separator]
        return list(zip([0, *(at + 1 for at in cuts)], [*cuts, len(flat)], strict=True))

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids: list[list[int]] = [[]] * len(pieces)
        letters, others, alone = [], [], []
        for place, piece in enumerate(pieces):
            if piece.isalpha():
                if piece.isascii() and piece.islower():
                    ids[place] = [token.id for token in word_ids(piece)]
                else:
                    letters.append(place)
            elif separator is None or "<" in piece:
                alone.append(place)
            else:
                others.append(place)
        alone += together(pieces, letters, " ", at_ends, ids)
        alone += together(pieces, others, SEPARATOR, at_separators, ids)
        for place in alone:
            ids[place] = tokenizer.encode(pieces[place], add_special_tokens=False).ids
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum())), lengths

    return Memo(encode, most=500_000)


def memo_of(tokenizer_json: str) -> Memo:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    memos = worker_cache("library")
    if tokenizer_json not in memos:
        memos.clear()
        memos[tokenizer_json] = library_ids(Tokenizer.from_str(tokenizer_json))
    return memos[tokenizer_json]


#: Letters that stay letters in lower case and composed form, and marks but apostrophe and "<".
LETTER = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}]"
MARK = r"[!-&(-/:;=-@\[-`{-~]"


def pieces_of(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pieces of words, the index of each word's pieces, and how many each word has.

    Words of ASCII go to lower case, as the tokenizer takes them. A run of letters with marks behind
    it is two pieces, as the tokenizer cuts there.
    """
    special = pc.match_substring(words, "<")
    plain = pc.and_(pc.string_is_ascii(words), pc.invert(special))
    folded = pc.if_else(plain, pc.ascii_lower(words), words)
    cut = pc.extract_regex(folded, f"^(?P<letters>{LETTER}+)(?P<marks>{MARK}+)$")
    is_cut = pc.is_valid(cut)
    heads = pc.if_else(is_cut, pc.struct_field(cut, "letters"), folded)
    tails = pc.struct_field(cut, "marks").filter(is_cut)
    coded = pa.concat_arrays([heads, tails]).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    counts = 1 + is_cut.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(counts)
    index = np.zeros(len(codes), np.int64)
    index[ends - counts] = codes[: len(words)]
    index[ends[counts == 2] - 1] = codes[len(words) :]
    return coded.dictionary, index, counts


def encode_texts(tokenizer_json: str, texts: pa.Array, end_id: int):
    """Ids of all texts of a `text_array`, each followed by `end_id`, and how many each has.

    The tokenizer drops white space and never joins what stands on both sides of it, so each
    distinct word is encoded once.
    """
    memo = memo_of(tokenizer_json)
    vocabulary, index, bounds = words_of(texts)
    pieces, piece_index, counts = pieces_of(vocabulary)
    starts, lengths = memo.find(pieces.to_pylist())
    # The ids of all distinct words, and of the end.
    starts, lengths = starts[piece_index], lengths[piece_index]
    flat = np.append(memo.flat[ragged(starts, lengths)], end_id).astype(np.uint32)
    piece_ends = np.concatenate(([0], np.cumsum(counts)))
    length = np.append(ragged_sums(lengths, piece_ends), 1)
    start = np.cumsum(length) - length
    index = np.insert(index, bounds[1:], len(vocabulary))
    bounds = bounds + np.arange(len(bounds))
    taken = length[index]
    return flat[ragged(start[index], taken)], ragged_sums(taken, bounds)


#: Fixed value: how the tokenizer cuts text; what is between the matches is dropped.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_words(tokenizer_json: str) -> bool:
    """Whether a tokenizer lowers its text, cuts it by `PATTERN`, and then works word by word."""
    parsed = json.loads(tokenizer_json)
    cut = parsed["pre_tokenizer"] or {}
    steps = cut.get("pretokenizers", [cut])
    lowers = [step["type"] for step in (parsed["normalizer"] or {}).get("normalizers", [])]
    return (
        steps[0].get("type") == "Split" and steps[0]["pattern"] == {"Regex": PATTERN}
        and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        and [step["type"] for step in steps[1:]] == ["ByteLevel"]
        and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        and lowers == ["NFC", "Replace", "Lowercase"]
        and not any(t["lstrip"] or t["rstrip"] or "<" not in t["content"] or " " in t["content"]
                    for t in parsed["added_tokens"])
    )


def write_shards(
    documents: DataFrame,
    tokenizer_json: str,
    folder: str,
    end_id: int,
    text: str = "text",
    doc_id: str = "doc_id",
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encode all documents in ascending id order into shard files below `folder`.

    Returns the manifest, which is committed: part, piece (files in order), path, tokens and
    documents of each file. A file of a task that did not end well is in no manifest. NULL ids come
    first; rows of one id are ordered by a hash of their text, by which a frequent id is also dealt
    to several tasks. NULL text is empty text.
    """
    if not cuts_words(tokenizer_json):
        raise ValueError("the tokenizer must lower and cut its text as `PATTERN` does")
    make_folder(documents.sparkSession, folder)
    ordered = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    ).orderBy("doc_id", F.xxhash64("text"))
    null_id = np.int64(-(1 << 63))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        files, root = pa.fs.FileSystem.from_uri(folder)
        ids, counts, tokens, held, piece = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal ids, counts, tokens, held, piece
            path = f"{root}/{part:06}-{piece:06}-{uuid.uuid4().hex}.wm"
            lengths = np.concatenate(counts)
            with files.open_output_stream(path) as out:
                out.write(build(np.concatenate(tokens), np.concatenate(ids), lengths))
            row = [[part], [piece], [path], [held], [len(lengths)]]
            ids, counts, tokens, held = [], [], [], 0
            piece += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(value, kind)
                    for value, kind in zip(
                        row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()),
                        strict=True,
                    )
                ],
                ["part", "piece", "path", "tokens", "documents"],
            )

        for batch in batches:
            whole = text_array(batch.column("text"))
            for start, end in slices(whole, 1 << 22):
                flat, count = encode_texts(
                    tokenizer_json, whole.slice(start, end - start), end_id
                )
                names = batch.column("doc_id").slice(start, end - start)
                names, through = names.fill_null(null_id).to_numpy(), np.cumsum(count)
                done = 0
                while done < len(count):
                    before = int(through[done] - count[done])
                    upto = int(np.searchsorted(through, before + shard_tokens - held)) + 1
                    upto = min(upto, len(count))
                    ids.append(names[done:upto])
                    counts.append(count[done:upto])
                    tokens.append(flat[before : through[upto - 1]])
                    held += len(tokens[-1])
                    done = upto
                    if held >= shard_tokens:
                        yield close()
        if ids:
            yield close()

    return committed(
        ordered.mapInArrow(
            write, "part int, piece int, path string, tokens long, documents long"
        )
    )


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents of the shard files: doc_id, start, n_tokens, and `ids binary` (packed u32).

    `start` counts the ids of all documents before it. The running sum is over one row per file.
    """
    placed = with_starts(manifest)
    # One file a task, as far as hashing deals them evenly.
    files = max(1, manifest.count())
    null_id = -(1 << 63)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(row["path"]) as source:
                    matrix = WaveletMatrix(source.read())
                flat = matrix.tokens().astype("<u4")
                ends = np.cumsum(matrix.lengths)
                # A few documents at a time bound what one Arrow batch holds.
                step = 1024
                for low in range(0, len(ends), step):
                    high = min(low + step, len(ends))
                    first = int(ends[low] - matrix.lengths[low])
                    offsets = np.append(first, ends[low:high]) - first
                    packed = pa.Array.from_buffers(
                        pa.binary(),
                        high - low,
                        [
                            None,
                            pa.py_buffer((offsets * 4).astype(np.int32)),
                            pa.py_buffer(np.ascontiguousarray(flat[first : ends[high - 1]])),
                        ],
                    )
                    names = matrix.documents[low:high]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names, mask=names == null_id),
                            pa.array(row["first"] + first + offsets[:-1]),
                            pa.array(matrix.lengths[low:high]),
                            packed,
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    return (
        placed.select("path", "first")
        .repartition(files, "path")
        .mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
    )


def with_starts(manifest: DataFrame) -> DataFrame:
    """The files and `first`, the number of ids in all files before."""
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def looked_up(
    files: DataFrame,
    folder: str,
    fields: str,
    look: Callable[[WaveletMatrix, dict], list[tuple]],
) -> DataFrame:
    """What `look` finds in each file, given its row; it reads from the file only what it needs."""
    names = files.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["path"]) as source:
                    found = look(WaveletMatrix(source), row)
                columns = [name.split()[0] for name in fields.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([values[place] for values in found], pa.int64())
                        for place in range(len(columns))
                    ],
                    columns,
                )

    return files.repartition("path").select(*names).mapInArrow(run, fields)


def ids_at(manifest: DataFrame, folder: str, positions: list[int]) -> DataFrame:
    """position, id: the ids at these positions of all documents' ids, one after the other.

    Positions beyond the last one have no row. Only files that hold a position are opened, and of
    each plane of theirs the blocks on the way.
    """
    asked = F.array(*map(F.lit, positions)).cast("array<bigint>")
    here = F.filter(
        asked, lambda p: (p >= F.col("first")) & (p < F.col("first") + F.col("tokens"))
    )
    files = with_starts(manifest).withColumn("here", here).where(F.size("here") > 0)
    return looked_up(
        files.select("path", "first", "here"),
        folder,
        "position long, id long",
        lambda matrix, row: [(p, matrix.access(p - row["first"])) for p in set(row["here"])],
    )


def counts_by_file(manifest: DataFrame, folder: str, ids: list[int]) -> DataFrame:
    """part, piece, id, n of the files that hold some of these ids, by two ranks a plane."""

    def look(matrix: WaveletMatrix, row: dict) -> list[tuple]:
        counts = ((number, matrix.count(number)) for number in dict.fromkeys(ids))
        return [(row["part"], row["piece"], number, n) for number, n in counts if n]

    return looked_up(
        manifest.select("part", "piece", "path"),
        folder,
        "part long, piece long, id long, n long",
        look,
    )


def count_ids(manifest: DataFrame, folder: str, ids: list[int]) -> DataFrame:
    """id, n: how often these ids occur in all files; ids that do not occur have no row."""
    return counts_by_file(manifest, folder, ids).groupBy("id").agg(F.sum("n").alias("n"))


def find_id(manifest: DataFrame, folder: str, number: int, nths: list[int]) -> DataFrame:
    """nth, position of an id's nth occurrences (from 0) in all files; none beyond the last one.

    The files' counts of the id say which files hold these occurrences; only those are opened again.
    """
    counts = committed(counts_by_file(manifest, folder, [number]))
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    asked = F.array(*map(F.lit, nths)).cast("array<bigint>")
    here = F.filter(asked, lambda n: (n >= F.col("earlier")) & (n < F.col("earlier") + F.col("n")))
    holding = counts.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
    files = (
        with_starts(manifest)
        .join(holding, ["part", "piece"])
        .withColumn("here", here)
        .where(F.size("here") > 0)
    )
    return looked_up(
        files.select("path", "first", "earlier", "here"),
        folder,
        "nth long, position long",
        lambda matrix, row: [
            (n, row["first"] + matrix.occurrence(number, n - row["earlier"]))
            for n in set(row["here"])
        ],
    )


def wavelet_report(documents: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write all documents' ids to shard files, read the files back, and digest what they hold."""
    with open(path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    folder = new_folder(documents.sparkSession)
    manifest = write_shards(documents, tokenizer_json, folder, end_id)
    return read_shards(manifest, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
