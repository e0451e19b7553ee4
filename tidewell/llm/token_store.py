"""Operator 1: token ids as raw binary shards with a minimal perfect hash index.

Layout of a store (one folder in the shared file system):

- ``shard-NNNNN.bin``: magic, then the ids of the shard's rows one after another, little-endian unsigned,
  2 bytes each where the vocabulary allows it, else 4;
- ``shard-NNNNN.idx``: the rows' keys and token offsets, and a minimal perfect hash of the distinct keys (its bits
  and their running counts) whose slots hold (fingerprint, first row, number of rows);
- ``manifest.json``: per shard its key range, rows and tokens, and the tokens before it.

Shards are key ranges, so ids lie in ascending key order over the whole store. A lookup bisects the key ranges in
the manifest and reads a few fixed-size entries of the index (about two words of the hash, one slot, one key, two
offsets), then the row's own ids, whatever the size of the shard; absent keys are refused by the fingerprint
(1 in 2**32 pass) and then by the stored key.

Texts are cut before single spaces. The pre-tokenizer of byte-level BPE never looks across such a border, so
distinct chunks are encoded once by the library and their ids are joined; texts with other white space than
single spaces and line ends, and those that hold an added token of the tokenizer, go to the library whole.

Defined results: a null text is an empty one (end id only); the string of an added token in a text becomes that
token, as the library has it unless told otherwise; a null key sorts first and is not indexed; repeated keys keep
all their rows (a lookup returns each of them); equal keys with different texts follow the text's hash, and a key of
very many rows, alike or not, spreads over several shards; an empty table gives an empty store; other columns of the
input are ignored.
"""

from __future__ import annotations

import gc
import json
import re
import uuid
import zlib
from array import array
from bisect import bisect_left
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import read, shared_files, ship, trim

MAGIC = b"TWTOK002"
SLOT = np.dtype([("print", "<u4"), ("first", "<u4"), ("count", "<u4")])
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
BORDER = "\r"  # set between chunks, so texts with it go to the library whole
# texts that go to the library whole: with other white space than single spaces inside and line ends
ODD_TEXT = r"^\s| $|  |[\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
CACHE_ENTRIES = 550_000  # chunks remembered by a task; beyond it the memory starts anew
PORTION_BYTES = 12 << 20  # text encoded together
SHARD_BYTES = 48 << 20  # text a shard aims at


class ChunkEncoder:
    """Encodes whole texts to id arrays with a byte-level BPE of the tokenizers library."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.path, self.plain = path, Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True  # for texts without added tokens: it doesn't look for them, so it is faster
        self.type = np.dtype("<u2") if self.plain.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.added = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        self.marks = dict(zip(".,", self.library([".", ","]), strict=True))
        (self.line,) = self.library(["\n"])
        (self.border,) = self.plain.encode(BORDER, add_special_tokens=False).ids

    @cached_property
    def lib(self):
        """The library as it is, for texts that hold an added token."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def library(self, texts: list[str]) -> list[bytes]:
        """The library's own ids of each text."""
        coded = self.plain.encode_batch_fast(texts, add_special_tokens=False)
        for i in [i for i, t in enumerate(texts) if any(a in t for a in self.added)]:
            coded[i] = self.lib.encode(texts[i], add_special_tokens=False)
        return [array(self.type.char, e.ids).tobytes() for e in coded]

    def chunks(self, texts: list[str]) -> list[bytes]:
        """Many short texts that neither begin nor end with white space (but for one space before) nor hold BORDER or an added token.

        They go to the library as one text, between BORDER characters, which stay tokens of their own.
        """
        out = []
        for at in range(0, len(texts), 8192):
            some = texts[at : at + 8192]
            ids = np.array(self.plain.encode_batch_fast([BORDER.join(some)], add_special_tokens=False)[0].ids, self.type)
            cuts = np.flatnonzero(ids == self.border)
            if len(cuts) != len(some) - 1:
                raise AssertionError("a chunk border was not kept")
            raw, n = ids.tobytes(), self.type.itemsize
            out += [raw[a * n : b * n] for a, b in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)], strict=True)]
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each word with a space before it.

        The pre-tokenizer parts letters from a full stop or comma after them in any case, and lines from each other,
        so these are taken apart before the library sees them; only the parts are remembered.
        """
        known, heads, marks = self.known, self.heads, self.marks
        found = list(map(known.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = [words[i] for i in missing]
        lines, marked, parts = {}, {}, {}
        for w in new:
            if "\n" in w and "\t" not in w:
                p = w.split("\n")
                if all(p):
                    lines[w] = p
                    w = p[0]
                    if w in known:
                        continue
            if w[-1:] in marks and LETTERS.fullmatch(w, 0, len(w) - 1):
                marked[w] = base = w[:-1]
                if base not in known:
                    parts[base] = None
            else:
                parts[w] = None
        if len(known) + len(parts) > CACHE_ENTRIES:  # start anew with what this batch uses
            used = {*words, *marked.values(), *(p[0] for p in lines.values())}
            self.known = known = {w: known[w] for w in used if w in known}
        inner = [w for w in parts if w and w[0] not in "\n\t" and w[-1] not in "\n\t"]
        known.update(zip(inner, self.chunks([f" {w}" for w in inner]), strict=True))
        outer = [w for w in parts if w not in known]
        known.update(zip(outer, self.library([f" {w}" for w in outer]), strict=True))
        if len(heads) > CACHE_ENTRIES // 4:
            heads.clear()
        starts = list({x for p in lines.values() for x in p[1:] if x not in heads})
        heads.update(zip(starts, self.chunks(starts), strict=True))
        own = {w: known[base] + marks[w[-1]] for w, base in marked.items()}
        for w, p in lines.items():
            own[w] = self.line.join([own.get(p[0]) or known[p[0]], *(heads[x] for x in p[1:])])
        for i, w in zip(missing, new, strict=True):
            found[i] = own.get(w) or known[w]
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column after one another, and how many each has. Null texts have none.

        The many small objects of a call hold no cycles, so the collector need not look through them meanwhile.
        """
        was = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if was:
                gc.enable()

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, ODD_TEXT)
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        odd = odd.to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        coded = parts.values.dictionary_encode()
        pieces = self._words(coded.dictionary.to_pylist())
        at = parts.offsets.to_numpy().astype(np.int64)
        order = coded.indices.to_numpy().astype(np.int64)
        # what a text begins with has no space before it; odd texts are such a beginning as a whole
        firsts = [w for w in parts.values.take(pa.array(at[:-1])).to_pylist()] if len(parts) else []
        whole = texts.filter(pa.array(odd)).to_pylist()
        for i, t in zip(np.flatnonzero(odd), whole, strict=True):
            firsts[i] = t
        distinct = {t: i for i, t in enumerate(dict.fromkeys(firsts))}
        order[at[:-1]] = [len(pieces) + distinct[t] for t in firsts]
        pieces += self.library(list(distinct))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // self.type.itemsize
        ids, starts = np.frombuffer(b"".join(pieces), self.type), np.cumsum(sizes) - sizes
        each = sizes[order]
        before = np.cumsum(each) - each
        small = np.int32 if max(len(ids), int(each.sum())) < 1 << 31 else np.int64
        out = ids[np.repeat((starts[order] - before).astype(small), each) + np.arange(each.sum(), dtype=small)]
        return out, np.add.reduceat(each, at[:-1]) if len(parts) else np.zeros(0, np.int64)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys.

    In each level the keys that are alone on their bit claim it; the others go on to a level of their own size.
    A key's value is the number of claimed bits before its bit. About 3 bits a key.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        per = np.unpackbits(bits).reshape(-1, 64).sum(1) if len(bits) else np.zeros(0, np.int64)
        self.before = np.concatenate([[0], np.cumsum(per)]).astype("<i8")

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, taken, left = [], [], np.unique(keys)
        while len(left):
            size = -(-max(len(left), 1) // 64) * 64
            at = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            taken.append(alone)
            left = left[~alone[at]]
        return cls(sizes, np.packbits(np.concatenate(taken)) if taken else np.zeros(0, np.uint8))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some keys that were not built in, any slot for the others."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            at = (mixed(keys[todo], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            hit = (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            got = at[hit]
            word = got >> 6
            rows = np.unpackbits(self.bits.reshape(-1, 8)[word], axis=1)
            inside = (rows * (np.arange(64) < (got & 63)[:, None])).sum(1)
            out[todo[hit]] = self.before[word] + inside
            todo = todo[~hit]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 977) >> np.uint64(32)).astype(np.uint32)


def pack_index(keys: np.ndarray, nulls: int, lengths: np.ndarray, width: int) -> bytes:
    """The index file of rows sorted by key, of which the first `nulls` have no key."""
    own = keys[nulls:]
    distinct, first, count = np.unique(own, return_index=True, return_counts=True)
    mph = PerfectHash.build(distinct)
    slots = mph.slots(distinct)
    table = np.zeros(len(distinct), SLOT)
    table["print"][slots], table["first"][slots], table["count"][slots] = fingerprint(distinct), first + nulls, count
    head = json.dumps({"rows": len(keys), "nulls": int(nulls), "width": width, "sizes": mph.sizes}).encode()
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
    return b"".join([MAGIC, np.uint32(len(head)).tobytes(), head, keys.astype("<i8").tobytes(), offsets.tobytes(), mph.bits.tobytes(), mph.before.tobytes(), table.tobytes()])


class Shard:
    """One shard as a whole, for a scan of its rows."""

    def __init__(self, index: bytes, payload: bytes | memoryview):
        if index[:8] != MAGIC or bytes(payload[:8]) != MAGIC:
            raise ValueError("not a token store shard")
        n = int(np.frombuffer(index, "<u4", 1, 8)[0])
        head = json.loads(index[12 : 12 + n])
        at, self.nulls, rows = 12 + n, head["nulls"], head["rows"]
        self.keys = np.frombuffer(index, "<i8", rows, at)
        self.offsets = np.frombuffer(index, "<i8", rows + 1, at + 8 * rows)
        at += 8 * (2 * rows + 1)
        bits = np.frombuffer(index, np.uint8, sum(head["sizes"]) // 8, at)
        self.mph = PerfectHash(head["sizes"], bits)
        self.table = np.frombuffer(index, SLOT, -1, at + len(bits) + 8 * (len(bits) // 8 + 1))
        self.ids = np.frombuffer(payload, f"<u{head['width']}", -1, 8)

    def locate(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each key; 0 rows where it is absent."""
        slots = self.mph.slots(keys)
        first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        ok = slots >= 0
        entry = self.table[slots[ok]]
        same = (entry["print"] == fingerprint(keys[ok])) & (self.keys[np.minimum(entry["first"], max(len(self.keys) - 1, 0))] == keys[ok])
        first[ok], count[ok] = entry["first"], np.where(same, entry["count"], 0)
        return first, count

    def row(self, i: int) -> np.ndarray:
        return self.ids[self.offsets[i] : self.offsets[i + 1]]


class KeyedShard:
    """One shard opened for lookups, which read fixed-size entries by their places and never a whole file."""

    def __init__(self, fs, path: str):
        self.index, self.payload, self.bytes_read = fs.open_input_file(f"{path}.idx"), fs.open_input_file(f"{path}.bin"), 0
        start = self._read(self.index, 0, 12)
        if start[:8] != MAGIC or self._read(self.payload, 0, 8) != MAGIC:
            raise ValueError("not a token store shard")
        n = int.from_bytes(start[8:], "little")
        head = json.loads(self._read(self.index, 12, n))
        self.sizes, self.width = head["sizes"], head["width"]
        self.keys = 12 + n
        self.offsets = self.keys + 8 * head["rows"]
        self.bits = self.offsets + 8 * (head["rows"] + 1)
        words = sum(self.sizes) // 64
        self.before = self.bits + 8 * words
        self.table = self.before + 8 * (words + 1)

    def _read(self, file, at: int, n: int) -> bytes:
        file.seek(at)
        self.bytes_read += n
        return file.read(n)

    def _numbers(self, file, at: int, n: int, kind: str) -> np.ndarray:
        return np.frombuffer(self._read(file, at, n * np.dtype(kind).itemsize), kind)

    def _slot(self, key: np.ndarray) -> int | None:
        start = 0
        for level, size in enumerate(self.sizes):
            at = start + int(mixed(key, level)[0] % np.uint64(size))
            bits = np.unpackbits(self._numbers(self.index, self.bits + 8 * (at // 64), 8, "u1"))
            if bits[at % 64]:
                return int(self._numbers(self.index, self.before + 8 * (at // 64), 1, "<i8")[0]) + int(bits[: at % 64].sum())
            start += size
        return None

    def get(self, key: int) -> list[np.ndarray]:
        own = np.array([key], np.int64)
        slot = self._slot(own)
        if slot is None:
            return []
        entry = np.frombuffer(self._read(self.index, self.table + SLOT.itemsize * slot, SLOT.itemsize), SLOT)[0]
        first, count = int(entry["first"]), int(entry["count"])
        if entry["print"] != fingerprint(own)[0] or self._numbers(self.index, self.keys + 8 * first, 1, "<i8")[0] != key:
            return []
        at = self._numbers(self.index, self.offsets + 8 * first, count + 1, "<i8")
        ids = self._numbers(self.payload, 8 + self.width * int(at[0]), int(at[-1] - at[0]), f"<u{self.width}")
        return np.split(ids, (at[1:-1] - at[0]).tolist())

    def close(self) -> None:
        self.index.close()
        self.payload.close()


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _put(fs, path: str, data: list[bytes]) -> None:
    """Write beside and rename, so that a lost or doubled task leaves whole files only."""
    from pyarrow.fs import FileType

    own = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(own) as f:
        for x in data:
            f.write(x)
    try:
        fs.move(own, path)
    except OSError:
        if fs.get_file_info(path).type != FileType.File:
            raise
        fs.delete_file(own)


class TokenStore:
    """A written store; opens on the driver or in a task."""

    def __init__(self, uri: str, manifest: dict | None = None):
        self.uri, (self.fs, self.path) = uri, _fs(uri)
        if manifest is None:
            with self.fs.open_input_stream(f"{self.path}/manifest.json") as f:
                manifest = json.loads(f.read())
        self.shards = manifest["shards"]
        keyed = [s for s in self.shards if s["low"] is not None]
        self.numbers, self.lows, self.highs = ([s[k] for s in keyed] for k in ("shard", "low", "high"))
        self.bytes_read = 0

    def shard(self, number: int) -> Shard:
        read = []
        for kind in ("idx", "bin"):
            with self.fs.open_input_file(f"{self.path}/shard-{number:05d}.{kind}") as f:
                read.append(f.read())
        return Shard(*read)

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of every row with this key, in store order."""
        found, at = [], bisect_left(self.highs, key)
        while at < len(self.lows) and self.lows[at] <= key:  # several shards only for a key that was spread
            shard = KeyedShard(self.fs, f"{self.path}/shard-{self.numbers[at]:05d}")
            found += shard.get(key)
            self.bytes_read += shard.bytes_read
            shard.close()
            at += 1
        return found


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    """One encoder for all tasks of a worker, so that later tasks find its parts known."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def write_store(docs: DataFrame, uri: str, tokenizer: str, end_id: int = 0, shards: int | None = None) -> TokenStore:
    """Encode docs(doc_id, text) to a new store at uri; each text is followed by end_id."""
    spark = docs.sparkSession
    ship(spark)
    fs, path = _fs(uri)
    fs.create_dir(path, recursive=True)
    # equal rows differ by their place only, so that a key of very many can be spread
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(F.monotonically_increasing_id(), F.lit(4096)).alias("tie"))
    if shards is None:
        from tidewell.llm.common import row_bytes

        shards = max(spark.sparkContext.defaultParallelism, min(400_000, row_bytes(docs, "text") // SHARD_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("tie")]
    placed = docs.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches):
        encoder = _encoder(tokenizer)
        number, (out, where) = TaskContext.get().partitionId(), _fs(uri)
        keys, lengths, nulls, body = [], [], 0, None
        own = f"{where}/shard-{number:05d}.bin.{uuid.uuid4().hex}.tmp"
        for batch in batches:
            if body is None:
                body = out.open_output_stream(own)
                body.write(MAGIC)
            ids, texts = batch.column(0), batch.column(1)
            nulls += ids.null_count
            keys.append(ids.fill_null(0).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(texts):
                part = texts.slice(at, 2560)
                while len(part) > 1 and part.nbytes > PORTION_BYTES:
                    part = part.slice(0, len(part) // 2)
                coded, each = encoder.encode(part)
                lengths += (each + 1).tolist()
                body.write(np.insert(coded, np.cumsum(each), end_id).tobytes())
                at += len(part)
        if body is None:
            return
        body.close()
        keys = np.concatenate(keys)
        try:
            out.move(own, f"{where}/shard-{number:05d}.bin")
        except OSError:  # another attempt was first
            out.delete_file(own)
        _put(out, f"{where}/shard-{number:05d}.idx", [pack_index(keys, nulls, np.array(lengths, np.int64), encoder.type.itemsize)])
        real = keys[nulls:]
        trim()
        yield pa.RecordBatch.from_pydict({"shard": [number], "rows": [len(keys)], "tokens": [sum(lengths)], "low": pa.array([int(real[0]) if len(real) else None], pa.int64()), "high": pa.array([int(real[-1]) if len(real) else None], pa.int64())})

    # one row per shard comes to the driver
    found = sorted(placed.mapInArrow(write, "shard long, rows long, tokens long, low long, high long").collect())
    before, entries = 0, []
    for r in found:
        entries.append(r.asDict() | {"start": before})
        before += r.tokens
    manifest = {"shards": entries, "tokens": before}
    _put(fs, f"{path}/manifest.json", [json.dumps(manifest).encode()])
    return TokenStore(uri, manifest)


def read_store(spark: SparkSession, store: TokenStore) -> DataFrame:
    """One row per stored row, fetched by key: doc_id, start, n_tokens, ids_crc32, shard, slot_print."""
    ship(spark)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, shard long"
    entries, uri = store.shards, store.uri
    if not entries:
        return spark.createDataFrame([], schema)

    def fetch(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                entry = entries[i]
                shard = TokenStore(uri, {"shards": entries}).shard(entry["shard"])
                n = len(shard.keys)
                own = np.unique(shard.keys[shard.nulls :])
                first, count = shard.locate(own)
                if count.sum() + shard.nulls != n:
                    raise ValueError(f"shard {entry['shard']}: the index misses rows")
                rows = np.concatenate([np.arange(shard.nulls), np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())]).astype(np.int64)
                crc = [zlib.crc32(shard.row(r).astype("<u4").tobytes()) for r in rows]
                keys = pa.array(np.concatenate([np.zeros(shard.nulls, np.int64), np.repeat(own, count)]), mask=rows < shard.nulls)
                yield pa.RecordBatch.from_pydict({"doc_id": keys, "start": entry["start"] + shard.offsets[rows], "n_tokens": (shard.offsets[rows + 1] - shard.offsets[rows]), "ids_crc32": np.array(crc, np.int64), "shard": np.full(n, entry["shard"], np.int64)})

    return spark.range(0, len(entries), 1, len(entries)).mapInArrow(fetch, schema)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    store = write_store(read(spark, sf_dir, "documents"), shared_files(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_store(spark, store)
