"""Token-id files: independent zstandard frames, a checksum in each, and a trailing seek table.

A file holds the ids of consecutive documents, in ascending order of doc_id, as little-endian unsigned
32-bit integers. Its frames are ordinary zstandard frames with a content checksum; after them a
skippable frame holds the seek table: for each frame its compressed size, its size and the crc32 of
its ids, then the number of frames, a byte of flags and a magic number; the layout is that of the public
seekable format. A second skippable frame before it holds the documents: doc_id and number of ids.
A reader that wants some documents reads the tail, and then those frames alone.

Null and empty texts have the end id alone. Null ids sort first. Rows with the same id are documents
of their own, in the order of their texts. No rows, no files. Other columns are left out.

The range partitioning deals rows by doc_id, so its tasks are of even size whatever the sources are;
the tasks write under names that follow from the partition, and rename, so that retries do no harm.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import kept, map_arrow, open_fs, shared_folder, stored, write_atomically
from quadrille.llm.words import FOLD, PIECE, groups, pieces, range_hashes, separators

#: Fixed values of the public seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DOCUMENTS = 0x184D2A50
#: Ids in a frame, about; a document is never split, so a longer one has a frame of its own.
FRAME_IDS = 1 << 16
#: Units of text that a worker remembers with their ids, about, and places for their hashes: for twice as many and more,
#: as a piece of PIECE bytes, which has at most half as many units, is learned whole.
CACHE_CHUNKS = 600_000
PLACES = 1 << 21


# How the tokenizers that Encoder knows to work chunk by chunk normalise and split a text.
_CHUNK_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_CHUNK_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}


def works_by_chunk(path: str) -> bool:
    """Whether a text's ids are those of its chunks between spaces and line ends: judged by the tokenizer's own file."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    splits = (told.get("pre_tokenizer") or {}).get("pretokenizers") or [None]
    return (
        (told.get("normalizer") or {}).get("normalizers") == _CHUNK_NORMALIZERS
        and splits[0] == _CHUNK_SPLIT
        and [(s["type"], s.get("add_prefix_space"), s.get("use_regex")) for s in splits[1:]] == [("ByteLevel", False, False)]
        and told["model"].get("end_of_word_suffix") == "</w>"
    )


SPACES = separators((0x20, 0x20), (0x0A, 0x0A))
_LETTER, _MARK, _OTHER = 1, 2, 3
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[SPACES] = 0
_KIND[np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)] = _LETTER
_KIND[np.frombuffer(b".,;:!?#$%&*|", np.uint8)] = _MARK
#: Second bytes of the letters from U+00C0 to U+00FF, which the first byte 0xC3 begins.
_LATIN = separators((0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF))


def _units(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and kinds of the units between spaces and line ends, in UTF-8: of a chunk of plain letters and then marks, either
    perhaps missing, the letters and the marks; any other chunk is a unit of its own."""
    kind = _KIND[raw]
    first = np.flatnonzero(raw[:-1] == 0xC3)
    first = first[_LATIN[raw[first + 1]]]
    kind[first] = kind[first + 1] = _LETTER
    edges = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts = np.concatenate(([0], edges)) if len(raw) else edges
    ends, kinds = np.append(starts[1:], len(raw)) if len(raw) else starts, kind[starts]
    opens = np.concatenate(([True], kinds[:-1] == 0))[: len(kinds)]
    odd = (kinds == _OTHER) | ((kinds == _LETTER) & ~opens)
    inside = kinds != 0
    starts, ends, kinds, opens, odd = starts[inside], ends[inside], kinds[inside], opens[inside], odd[inside]
    if odd.any():
        heads = np.flatnonzero(opens)
        whole = np.logical_or.reduceat(odd, heads)
        ends[heads[whole]] = ends[np.append(heads[1:], len(ends))[whole] - 1]
        kinds[heads[whole]] = _OTHER
        kept = opens | ~np.repeat(whole, np.diff(np.append(heads, len(opens))))
        starts, ends, kinds = starts[kept], ends[kept], kinds[kept]
    return starts, ends, kinds


class _Lists:
    """Short lists of numbers, one behind another, that grow."""

    def __init__(self, kind: type):
        self.flat, self.starts, self.n = np.empty(1 << 12, kind), np.zeros(1 << 10, np.int64), 0

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        at = int(self.starts[self.n])
        for name, n in (("flat", at + len(flat)), ("starts", self.n + len(sizes) + 1)):
            if n > len(have := getattr(self, name)):
                setattr(self, name, np.concatenate((have, np.empty(max(n, len(have) * 3 // 2) - len(have), have.dtype))))
        self.flat[at : at + len(flat)] = flat
        np.cumsum(sizes, out=self.starts[self.n + 1 : self.n + len(sizes) + 1])
        self.starts[self.n + 1 : self.n + len(sizes) + 1] += at
        self.n += len(sizes)

    def sizes(self, which: np.ndarray) -> np.ndarray:
        return self.starts[which + 1] - self.starts[which]

    def take(self, which: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[which] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """The tokenizers library, called with whole texts, or once for each new unit of chunks between spaces or line ends.

    If the tokenizer drops white space, never joins across it and folds case, a text's ids are those of its
    chunks, and a plain word's, with marks after it, those of the word and of the marks. The tokenizer's file
    tells; without that, or if `whole` says so, whole texts are encoded.
    Units are found by their hashes, many at once, and compared byte by byte with the known ones; where two have
    one hash, those texts are encoded whole. New ones are encoded many at once: words with spaces between them, others
    with a special token between them, at which the library cuts."""

    def __init__(self, path: str, whole: bool | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.whole = Tokenizer.from_file(path), not works_by_chunk(path) if whole is None else whole
        special = [(i, t.content) for i, t in sorted(self.tokenizer.get_added_tokens_decoder().items()) if t.special]
        self.cut_id, self.cut = special[-1] if special else (None, "")
        # ids that end a word, in vocabularies that mark them
        self.last = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.numbers = np.zeros(PLACES, np.uint64), np.zeros(PLACES, np.int32)
        self.spelled, self.ids = _Lists(np.uint8), _Lists(np.uint32)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of known units, -1 for others."""
        found = np.full(len(keys), -1, np.int64)
        left, at = np.arange(len(keys)), (keys & np.uint64(PLACES - 1)).astype(np.int64)
        while len(left):
            there = self.hashes[at]
            same = there == keys[left]
            found[left[same]] = self.numbers[at[same]]
            on = ~same & (there != 0)
            left, at = left[on], (at[on] + 1) & (PLACES - 1)
        return found

    def _place(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        at = (keys & np.uint64(PLACES - 1)).astype(np.int64)
        while len(keys):
            free = self.hashes[at] == 0
            self.hashes[at[free]] = keys[free]
            mine = self.hashes[at] == keys
            self.numbers[at[mine]] = numbers[mine]
            keys, numbers, at = keys[~mine], numbers[~mine], (at[~mine] + 1) & (PLACES - 1)

    def _texts(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _library(self, chunks: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for i in range(0, len(chunks), 256):
            part = [c.decode() for c in chunks[i : i + 256]]
            if self.cut_id is None or any(self.cut[:2] in c for c in part):
                out += self._texts(part)
                continue
            ids = np.array(self.tokenizer.encode(self.cut.join(part), add_special_tokens=False).ids, np.uint32)
            edges = np.flatnonzero(ids == self.cut_id).tolist()
            out += [ids[a:b] for a, b in zip([0, *[e + 1 for e in edges]], [*edges, len(ids)], strict=True)]
        return out

    def _words(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of words that the tokenizer never divides before it looks for pieces: cut where an id ends a word."""
        for i in range(0, len(words), 512):
            part = words[i : i + 512]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                each = self._library(part)
                yield np.concatenate(each), np.array([len(x) for x in each])
            else:
                yield ids, np.diff(ends, prepend=0)

    def _learn(self, text: bytes, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray) -> None:
        _, new = np.unique(keys, return_index=True)
        plain = kinds[new] == _LETTER
        for some, by in ((new[plain], True), (new[~plain], False)):
            if not len(some):
                continue
            spelled = [text[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)]
            n = self.spelled.n
            self.spelled.add(np.frombuffer(b"".join(spelled), np.uint8), ends[some] - starts[some])
            if by:
                for ids, sizes in self._words(spelled):
                    self.ids.add(ids, sizes)
            else:
                each = self._library(spelled)
                self.ids.add(np.concatenate(each), np.array([len(x) for x in each]))
            self._place(keys[some], np.arange(n, n + len(some)))

    def _piece(self, texts: list[bytes]) -> list[np.ndarray]:
        if self.spelled.n > CACHE_CHUNKS:
            self._forget()
        raw = np.frombuffer(b"\n".join(texts), np.uint8)
        starts, ends, kinds = _units(raw)
        size = ends - starts
        # the bytes of the units, one behind another; words and marks in lower case
        low, chars = FOLD[raw], ~SPACES[raw]
        if (other := kinds == _OTHER).any():
            own = np.zeros(len(raw), bool)
            own[chars] = np.repeat(other, size)
            low[own] = raw[own]
        keys = np.maximum(range_hashes(low, starts, ends), np.uint64(1))
        which = self._find(keys)
        if len(new := np.flatnonzero(which < 0)):
            self._learn(low.tobytes(), keys[new], starts[new], ends[new], kinds[new])
            which[new] = self._find(keys[new])
        if not (np.array_equal(self.spelled.sizes(which), size) and np.array_equal(self.spelled.take(which, size), low[chars])):
            return self._texts([t.decode() for t in texts])
        sizes = self.ids.sizes(which)
        ids = self.ids.take(which, sizes)
        offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])
        edges = np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(starts, offsets)].tolist()
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        if self.whole:
            return self._texts([t or "" for t in texts])
        raw = [(t or "").encode() for t in texts]
        out: list[np.ndarray] = []
        for a, b in groups(raw):
            if b - a == 1 and len(raw[a]) > PIECE:
                # a piece that has nowhere to be cut is not worth remembering
                out.append(np.concatenate([self._piece([x])[0] if len(x) <= 2 * PIECE else self._texts([x.decode()])[0] for x in pieces(raw[a], SPACES)]))
            else:
                out += self._piece(raw[a:b])
        return out


def encoder(path: str, whole: bool | None = None) -> Encoder:
    """One in each Python worker, which goes from task to task."""
    return kept(("encoder", path, whole), lambda: Encoder(path, whole))


def file_bytes(docs: Iterator[tuple[int | None, np.ndarray]], level: int = 3) -> tuple[list[bytes], int, int]:
    """The file's chunks, number of documents, number of ids."""
    import zstandard

    press = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
    out: list[bytes] = []
    frames: list[bytes] = []
    table: list[bytes] = []
    part: list[np.ndarray] = []
    size = total = 0

    def close() -> None:
        nonlocal size
        if part:
            raw = np.concatenate(part).astype("<u4").tobytes()
            out.append(press.compress(raw))
            frames.append(struct.pack("<III", len(out[-1]), len(raw), zlib.crc32(raw)))
            part.clear()
            size = 0

    for key, ids in docs:
        if part and size + len(ids) > FRAME_IDS:
            close()
        table.append(struct.pack("<?qI", key is not None, key or 0, len(ids)))
        part.append(ids)
        size += len(ids)
        total += len(ids)
    close()
    listed = press.compress(b"".join(table))
    out.append(struct.pack("<II", DOCUMENTS, len(listed)) + listed)
    entries = b"".join(frames)
    out.append(struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(frames), 0x80, SEEKABLE))
    return out, len(table), total


class Reader:
    """Opens a file by its tail; ids(i) decompresses the frame of document i alone."""

    def __init__(self, uri: str):
        import zstandard

        fs, path = open_fs(uri)
        self.press = zstandard.ZstdDecompressor()
        self.file = fs.open_input_file(path)
        end = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError(f"{uri}: not a token file")
        at = end - 9 - 12 * n
        entries = np.frombuffer(self.file.read_at(12 * n, at), "<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.crcs = entries[:, 1], entries[:, 2]
        self.offsets = np.concatenate(([0], np.cumsum(entries[:, 0])))
        head = int(self.offsets[-1])
        kind, size = struct.unpack("<II", self.file.read_at(8, head))
        if kind != DOCUMENTS or head + 8 + size + 8 != at:
            raise ValueError(f"{uri}: no table of documents")
        raw = self.press.decompress(self.file.read_at(size, head + 8))
        rows = np.frombuffer(raw, np.dtype([("has", "?"), ("id", "<i8"), ("n", "<u4")]))
        self.keys = [int(r["id"]) if r["has"] else None for r in rows]
        self.lengths = rows["n"].astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.frame_starts = np.concatenate(([0], np.cumsum(self.sizes // 4)))
        self._held: tuple[int, np.ndarray] = (-1, np.empty(0, np.uint32))

    def frame(self, k: int) -> np.ndarray:
        if self._held[0] != k:
            raw = self.press.decompress(self.file.read_at(int(self.offsets[k + 1] - self.offsets[k]), int(self.offsets[k])))
            if len(raw) != self.sizes[k] or zlib.crc32(raw) != self.crcs[k]:
                raise ValueError(f"frame {k}: checksum differs")
            self._held = (k, np.frombuffer(raw, "<u4"))
        return self._held[1]

    def ids(self, i: int) -> np.ndarray:
        at = int(self.starts[i])
        k = int(np.searchsorted(self.frame_starts, at, "right")) - 1 if self.lengths[i] else 0
        if not self.lengths[i]:
            return np.empty(0, np.uint32)
        inner = at - int(self.frame_starts[k])
        return self.frame(k)[inner : inner + int(self.lengths[i])]

    def __len__(self) -> int:
        return len(self.keys)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 2, id: str = "doc_id", text: str = "text", whole: bool | None = None) -> DataFrame:
    """Writes the files; returns (part, file, n_docs, n_ids, base), a row for each file; base counts the ids in earlier files."""
    spark = docs.sparkSession
    parts = max(docs.rdd.getNumPartitions() if not docs.isStreaming else 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the beginning of the text parts rows that share an id, or have none; the order of beginnings is that of the texts
    dealt = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).repartitionByRange(parts, F.col("id"), F.substring("text", 1, 48)).sortWithinPartitions("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer, whole).encode
        end = np.array([] if end_id is None else [end_id], np.uint32)

        def each() -> Iterator[tuple[int | None, np.ndarray]]:
            for b in batches:
                texts = b.column("text").to_pylist()
                for key, ids in zip(b.column("id").to_pylist(), encode(texts), strict=True):
                    yield key, np.concatenate((ids, end))

        chunks, n, total = file_bytes(each())
        if n:
            name = f"{folder}/part-{part:06d}.tok"
            write_atomically(name, chunks)
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [n], "n_ids": [total]}, pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    files = stored(map_arrow(dealt, write, "part int, file string, n_docs long, n_ids long"), "token-files")
    # one number for each file reaches the driver
    counts = sorted((r["part"], r["n_ids"]) for r in files.select("part", "n_ids").toLocalIterator())
    bases, at = [], 0
    for part, n in counts:
        bases.append((part, at))
        at += n
    return files.join(F.broadcast(spark.createDataFrame(bases, "part int, base long")), "part")


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files; files has columns file and base."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, base in zip(b.column("file").to_pylist(), b.column("base").to_pylist(), strict=True):
                r = Reader(name)
                for a in range(0, len(r), 4096):
                    rows = range(a, min(len(r), a + 4096))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(r.keys[a : rows.stop], pa.int64()),
                            "start": pa.array(r.starts[a : rows.stop] + base, pa.int64()),
                            "n_tokens": pa.array(r.lengths[a : rows.stop], pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(r.ids(i).astype("<u4").tobytes()) for i in rows], pa.int64()),
                        }
                    )

    n = max(1, min(files.count(), 100_000))
    return map_arrow(files.select("file", "base").repartition(n), read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_output(docs, public_tokenizers.path("word_bpe_49k.json"))
