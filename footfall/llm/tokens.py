"""Token ids of whole texts by the tokenizers library, word by word where the tokenizer allows it.

A tokenizer whose pre-tokenizer drops white space gives each word the same ids in every text, so a text's ids are the
joined ids of its words, and words repeat. A bounded dictionary per task keeps the ids of words seen; the tokenizer
itself encodes the others.
"""

from __future__ import annotations

import json
import os
import re

#: Words that a task remembers; beyond that, those not seen lately are forgotten.
REMEMBERED = 500_000
#: White space that Python's split() and the tokenizers may see differently; a text with it is split at ASCII space only.
_UNSURE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_ASCII_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
#: A run of letters that are one code point in NFC and have a plain lower case, then marks that form one more token run.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as one printable letter: printable bytes as themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class _Remembered(dict):
    """Ids by word; a word that is not there yet is looked up among older ones or encoded."""

    def __init__(self, older: dict[str, bytes], encode):
        super().__init__()
        self.older, self.encode = older, encode

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        self[word] = ids
        return ids


_READY: dict[str, "Encoder"] = {}


def encoder(path: str | None = None) -> "Encoder":
    """The worker process's encoder for that file; tasks that follow each other there share its dictionaries."""
    path = path or default_path()
    if path not in _READY:
        _READY[path] = Encoder(path)
    return _READY[path]


class Encoder:
    """`ids(text)`: the text's ids, without special tokens added, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = path or default_path()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        steps = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = steps[0] if steps else {}
        normal = [step["type"] for step in (config.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = (
            split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
            and "[^\\s\\p{L}\\p{N}]+" in (split.get("pattern") or {}).get("Regex", "") and normal == ["NFC", "Replace", "Lowercase"]
            and not config["post_processor"] and config["model"]["type"] == "BPE"
        )
        self.letters = _byte_letters()
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.words = _Remembered({}, self._word)
        self.stems: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}

    def _whole(self, text: str) -> bytes:
        import numpy as np

        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            stem, tail = word.lower(), ""
        else:
            plain = _PLAIN.fullmatch(word)
            if not plain:
                return self._whole(word)
            stem, tail = plain.groups()
            if tail not in self.tails:
                self.tails[tail] = self._whole(tail)
            stem = stem.lower()
        ids = self.stems.get(stem)
        if ids is None:
            found = self.tokenizer.model.tokenize(stem if stem.isascii() else stem.translate(self.letters))
            ids = self.stems[stem] = b"".join([self.bytes_of[token.id] for token in found])
        return ids + self.tails[tail] if tail else ids

    def _forget(self) -> None:
        """Words unseen since the last time go; the dictionaries never hold more than twice what may be remembered."""
        if len(self.words) > REMEMBERED:
            self.words = _Remembered(dict(self.words), self._word)
        if len(self.stems) > REMEMBERED:
            self.stems = {}
        if len(self.tails) > REMEMBERED:
            self.tails = {"": b""}

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_word:
            return self._whole(text)
        words = _ASCII_SPACE.split(text) if _UNSURE.search(text) else text.split()
        if len(words) > REMEMBERED:  # more words than may be remembered: in portions
            size = REMEMBERED // 2
            return b"".join(self.ids(" ".join(words[i : i + size])) for i in range(0, len(words), size))
        self._forget()
        return b"".join(map(self.words.__getitem__, words))
