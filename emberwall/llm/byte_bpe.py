"""Byte-level BPE encoding and decoding with the tokenizers library.

The rank file becomes a BPE model: every pair of tokens whose bytes join to a
third one is a merge, in the order of the third one's rank. Bytes stand in the
model as characters, one per byte value. The texts of each Arrow batch are split by the
pattern, and their different pieces are merged by the library's model; the lengths
of a piece's tokens place them in the text. Decoding maps ids to their
characters and those back to bytes, so a character whose bytes are split over
tokens comes back whole once all its bytes are there.

Null and empty texts have no tokens; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from emberwall.llm.common import column_texts, with_result, worker_memory
from emberwall.llm.heap_bpe import byte_symbols

DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
TOKENS = "ids array<int>, starts array<int>, ends array<int>, decoded string"

#: Pieces a worker remembers before it starts anew.
REMEMBERED = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def model_of(ranks: dict[bytes, int]) -> str:
    """The definition of a tokenizer that merges by these ranks."""
    symbols = byte_symbols()

    def shown(token: bytes) -> str:
        return "".join(symbols[b] for b in token)

    merges = []
    for token, _ in sorted(ranks.items(), key=lambda item: item[1]):
        for cut in range(1, len(token)):
            first, second = token[:cut], token[cut:]
            if first in ranks and second in ranks:
                merges.append([shown(first), shown(second)])
    return json.dumps(
        {
            "version": "1.0",
            "truncation": None,
            "padding": None,
            "added_tokens": [],
            "normalizer": None,
            "pre_tokenizer": {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False,
                "use_regex": False,
            },
            "post_processor": None,
            "decoder": {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False,
                "use_regex": False,
            },
            "model": {
                "type": "BPE", "dropout": None, "unk_token": None,
                "continuing_subword_prefix": None, "end_of_word_suffix": None,
                "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
                "vocab": {shown(token): rank for token, rank in ranks.items()},
                "merges": merges,
            },
        }
    )


class Codec:
    """Encodes and decodes texts; the pieces met are remembered, by ``form`` of what
    is wanted of them."""

    def __init__(self, definition: str, pattern: str, form: str = "tokens"):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.pieces = regex.compile(pattern).findall
        symbols = byte_symbols()
        self.symbol_of = dict(enumerate(symbols))
        to_byte = {symbol: byte for byte, symbol in enumerate(symbols)}
        size = self.tokenizer.get_vocab_size()
        tokens = map(self.tokenizer.id_to_token, range(size))
        self.bytes_of = [bytes(map(to_byte.__getitem__, t)) if t else b"" for t in tokens]
        self.learn = self._digests_of if form == "digests" else self._tokens_of
        key = f"{form} {zlib.crc32((definition + pattern).encode())}"
        self.known: dict[str, tuple] = worker_memory(f"byte BPE {key}")

    def _merged(self, piece: str) -> list:
        """The library's tokens of a piece, its bytes shown as characters."""
        shown = piece.encode().decode("latin-1").translate(self.symbol_of)
        return self.model.tokenize(shown)

    def _digests_of(self, piece: str) -> tuple[int, str, bytes]:
        """Number of ids, ids as text, decoded bytes."""
        ids = [token.id for token in self._merged(piece)]
        return len(ids), ",".join(map(str, ids)), self.decode(ids)

    def _tokens_of(self, piece: str) -> tuple[list[int], list[int], list[int], int]:
        """Ids, the first and the last character of each, and all characters."""
        tokens = self._merged(piece)
        character = [i for i, c in enumerate(piece) for _ in c.encode()]
        ids, starts, ends, at = [], [], [], 0
        for token in tokens:
            ids.append(token.id)
            starts.append(character[at])
            at += len(token.value)
            ends.append(character[at - 1] + 1)
        return ids, starts, ends, len(piece)

    def encode(self, text: str) -> list[tuple]:
        """What is wanted of each piece of a text, in order."""
        pieces = self.pieces(text)
        found = list(map(self.known.get, pieces))
        if None in found:
            for i, (piece, value) in enumerate(zip(pieces, found)):
                if value is None:
                    value = self.known.get(piece)
                    if value is None:
                        value = self.learn(piece)
                        if len(self.known) >= REMEMBERED:
                            self.known.clear()
                        if len(piece) < 64:
                            self.known[piece] = value
                    found[i] = value
        return found

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    out: str = "bpe",
    keep: Sequence[str] | None = None,
    digests: bool = False,
) -> DataFrame:
    """``docs`` with a struct column ``out``: the ids, where each token starts and
    ends in the text (in characters; tokens that share a split character have
    the same place), and the text decoded from the ids.

    With ``digests`` it has instead the number of tokens, SHA-256 of the ids
    joined by commas, and SHA-256 of the decoded bytes.

    The model is made on the driver and sent along; its size is that of a
    vocabulary, whatever the data.
    """
    at = docs.columns.index(text)
    definition = docs.sparkSession.sparkContext.broadcast(model_of(read_ranks(ranks_path)))

    def prepare():
        codec = Codec(definition.value, pattern, "digests" if digests else "tokens")

        def digest(batch: pa.RecordBatch):
            counts, ids, decoded = [], [], []
            for text in column_texts(batch.column(at)):
                pieces = codec.encode(text)
                sizes, shown, raw = zip(*pieces) if pieces else ((), (), ())
                counts.append(sum(sizes))
                ids.append(hashlib.sha256(",".join(shown).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join(raw)).hexdigest())
            return [
                ("n_tokens", pa.array(counts, pa.int64())),
                ("ids_sha256", pa.array(ids, pa.string())),
                ("decoded_sha256", pa.array(decoded, pa.string())),
            ]

        def tokens(batch: pa.RecordBatch):
            ids, starts, ends, decoded = [], [], [], []
            for text in column_texts(batch.column(at)):
                place, own, first, last = 0, [], [], []
                for piece_ids, piece_starts, piece_ends, size in codec.encode(text):
                    own += piece_ids
                    first += [place + a for a in piece_starts]
                    last += [place + b for b in piece_ends]
                    place += size
                ids.append(own)
                starts.append(first)
                ends.append(last)
                decoded.append(codec.decode(own).decode("utf-8", "replace"))
            kind = pa.list_(pa.int32())
            return [
                ("ids", pa.array(ids, kind)),
                ("starts", pa.array(starts, kind)),
                ("ends", pa.array(ends, kind)),
                ("decoded", pa.array(decoded, pa.string())),
            ]

        return digest if digests else tokens

    return with_result(docs, out, DIGESTS if digests else TOKENS, prepare, keep, True)
