"""Token ids of whole texts with a public tokenizer file."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence

import numpy as np

# How a byte-level BPE file cuts a text before it merges, written for
# texts of ASCII and Latin letters. Others are left to the tokenizer as a whole, since
# regular expression engines differ on rarer letters, numbers and white space.
_OTHER_SCRIPT = re.compile("[^\n\r\t\x20-\x7e¡-¬®-ɏ]")
_PIECES = re.compile(
    r"'(?:[st]|re|ve|m|ll|d)"
    r"| ?[^\W\d_²³¹¼½¾]+"
    r"| ?[0-9²³¹¼½¾]+"
    r"| ?(?:[^\w\s]|_)+"
    r"|\s+(?!\S)"
    r"|\s+"
)
CACHED_PIECES = 400_000
CACHED_LETTERS = 64

_encoders: dict[str, "PieceEncoder"] = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level file: itself if printable."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class _Known(dict):
    """Ids of pieces; unknown ones are merged by the tokenizer's model, and kept up to a bound."""

    def __init__(self, model, bound: int):
        super().__init__()
        self.merge, self.bound, self.letters = model.tokenize, bound, _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        mapped = "".join(map(self.letters.__getitem__, piece.encode()))
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.merge(mapped)])
        if len(self) < self.bound and len(piece) <= CACHED_LETTERS:
            self[piece] = ids
        return ids


class PieceEncoder:
    """Encodes whole texts; pieces that come again are looked up.

    A byte-level BPE file merges inside pieces only, so the ids of a text are
    those of its pieces in turn. Files of another kind, texts with other scripts
    and texts that spell out an added token are encoded by the tokenizer as a whole.
    """

    def __init__(self, path: str, cached_pieces: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut = spec.get("pre_tokenizer") or {}
        self.by_piece = (
            cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True)
            and spec.get("normalizer") is None
        )
        added = [token["content"] for token in spec.get("added_tokens") or []]
        self.added = re.compile("|".join(map(re.escape, filter(None, added))) or "(?!)")
        self.known = _Known(self.tokenizer.model, cached_pieces)

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(item.ids, dtype="<u4").tobytes() for item in found]

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a null text is empty."""
        texts = [text or "" for text in texts]
        out: list[bytes] = [b""] * len(texts)
        whole = []
        look_up, pieces = self.known.__getitem__, _PIECES.findall
        for place, text in enumerate(texts):
            if self.by_piece and not (_OTHER_SCRIPT.search(text) or self.added.search(text)):
                out[place] = b"".join(map(look_up, pieces(text)))
            elif text:
                whole.append(place)
        for place, ids in zip(whole, self._whole([texts[i] for i in whole]), strict=True):
            out[place] = ids
        return out


def encoder(path: str) -> PieceEncoder:
    """The encoder of this worker process, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
