"""Operator 10: SentencePiece BPE encoding by a prefix table, and decoding.

For a run of text the table holds, for each prefix, the one token that ends the encoding of that prefix. An
Aho-Corasick automaton of the vocabulary gives the tokens that end at a position; of these, exactly one goes with
the last token of the prefix before it, which a pair test decides: two tokens may stand side by side if merging
the characters of both gives just these two again. The ids are then read off backwards from the last prefix. Work
per character is bounded by the tokens that end there, whatever the length of the run.

No piece of the vocabulary has a word mark after another character, so a text is cut before each run of word
marks; distinct runs are encoded once in a task. A vocabulary without this property is encoded as one run.

Defined results: a null text is an empty one; an empty text has no ids but the end id, and decodes to an empty
text; unknown characters become their bytes; rows with null or repeated keys are kept; other columns of the input
stay, but those named like an output column are replaced.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import read, ship, trim, widened

MARK = "▁"
KNOWN_RUNS = 200_000  # runs remembered by a task; beyond it the memory starts anew
UNKNOWN = 1 << 24  # characters without a piece have numbers from here on
KNOWN_PAIRS = 500_000
LONG_RUN = 80  # runs of more characters are not remembered


class PieceCodec:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.lib = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        normal = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {lib.id_to_piece(i): i for i in normal}
        self.rank = {lib.id_to_piece(i): lib.get_score(i) for i in normal}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(lib.is_unused(i) for i in range(n)) or not all(map(lib.is_byte, self.bytes)):
            raise ValueError("only BPE models with byte fallback and no unused pieces are handled")
        if lib.normalize("ﬁ  x ") != f"{MARK}ﬁ{MARK}{MARK}x{MARK}":
            raise ValueError("only models that leave texts as they are, with a word mark before, are handled")
        self.end = lib.eos_id()
        self.piece = {i: p for p, i in self.ids.items()}  # unknown characters join it with ids from n on
        self.extra: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.cut = re.compile(f"{MARK}+[^{MARK}]*") if all(MARK not in p.lstrip(MARK) for p in self.ids) else re.compile(r".+", re.S)
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The encoding by its definition: merge the best pair, the leftmost of equals, until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.rank.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fit(self, key: int) -> bool:
        """Whether the token in the key's low half may stand after that in its high half (0: at the start of a run)."""
        left, right = self.piece.get(key >> 32, ""), self.piece[key & 0xFFFFFFFF]
        ok = self.fits[key] = self.merged(left + right) == ([left, right] if left else [right])
        return ok

    def unknown(self, char: str) -> int:
        token = self.extra.setdefault(char, len(self.extra) + UNKNOWN)
        self.piece[token] = char
        return token

    def runs(self, texts: list[str]) -> list[bytes]:
        """The ids of each of several runs, in sorted order, as little-endian 32-bit integers.

        The table of a run begins with that of the prefix it shares with the run before.
        """
        fits, piece, iterate, out = self.fits, self.piece, self.automaton.iter, []
        last, before = [0], ""  # last[i]: the token that ends the encoding of the first i characters
        for text in texts:
            at = 0
            for x, y in zip(before, text, strict=False):
                if x != y:
                    break
                at += 1
            del last[at + 1 :]
            before = text
            for end, (length, token) in iterate(text):
                if end < at:
                    continue  # found already: of the tokens that end here only one fits
                while end > at:
                    last.append(self.unknown(text[at]))
                    at += 1
                key = last[end + 1 - length] << 32 | token
                ok = fits.get(key)
                if ok or ok is None and self.fit(key):
                    last.append(token)
                    at += 1
            while at < len(text):
                last.append(self.unknown(text[at]))
                at += 1
            ids = []
            while at:
                token = last[at]
                if token < UNKNOWN:
                    ids.append(token)
                    at -= len(piece[token])
                else:
                    ids += [self.bytes[b] for b in reversed(piece[token].encode("utf-8", "surrogatepass"))]
                    at -= 1
            out.append(array("i", ids[::-1]).tobytes())
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts, the end id last."""
        if len(self.known) > KNOWN_RUNS:
            self.known.clear()
        if len(self.fits) > KNOWN_PAIRS:
            self.fits.clear()
        known, cut, end = self.known, self.cut.findall, array("i", [self.end]).tobytes()
        parts = [cut(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = sorted({r for p in parts for r in p if r not in known})
        found = dict(zip(new, self.runs(new), strict=True))
        known.update((r, ids) for r, ids in found.items() if len(r) <= LONG_RUN)
        long = {r: ids for r, ids in found.items() if len(r) > LONG_RUN}
        get = (lambda r: long.get(r) or known[r]) if long else known.__getitem__
        return [b"".join(map(get, p)) + end for p in parts]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        return self.lib.decode(ids)


_CODECS: dict[str, PieceCodec] = {}


def _codec(model: str) -> PieceCodec:
    """One codec for all tasks of a worker."""
    if model not in _CODECS:
        _CODECS[model] = PieceCodec(model)
    return _CODECS[model]


def encode_documents(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """docs with ids (array<int>, the end id last) and decoded (string) for each row's whole text."""
    ship(docs.sparkSession)
    docs = docs.drop("ids", "decoded")
    at = docs.columns.index(text)
    schema = widened(docs, ids="array<int>", decoded="string")

    def code(batches):
        codec = _codec(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                coded = codec.encode_all([t or "" for t in part.column(at).to_pylist()])
                ids = np.frombuffer(b"".join(coded), "<i4")
                offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
                decoded = [codec.decode(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                more = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, "ids", "decoded"])
        trim()

    return docs.mapInArrow(code, schema)


def digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(encode_documents(read(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")))




def encoded_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: doc_id, the ids and the digests of each document that is left."""
    import public_tokenizers

    coded = encode_documents(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
