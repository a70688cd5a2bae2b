"""Public tokenizers inside tasks. Their files are read by the driver and broadcast (a few MB each, checked)."""

from __future__ import annotations

import base64
import json
import os
import re

from pyspark import Broadcast
from pyspark.sql import SparkSession

MAX_FILE_BYTES = 32 << 20
#: Fixed value: the public byte-level BPE's pattern for splitting text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts in which no two white space characters meet: without look-ahead, so it runs on the faster matcher.
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
_MEETING = ("  ", " \n", "\n ", "\n\n", "\t", "\v", "\f", "\r", "\x85", "\xa0")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def shipped(spark: SparkSession, path: str) -> Broadcast:
    size = os.path.getsize(path)
    if size > MAX_FILE_BYTES:
        raise ValueError(f"{path} has {size} bytes; a tokenizer file of at most {MAX_FILE_BYTES} is broadcast")
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def ranked(content: bytes) -> dict[bytes, int]:
    """Byte strings and ids of a vocabulary in the ranks format or in the JSON format of byte-level BPE."""
    if content.lstrip()[:1] == b"{":
        letters = _byte_letters()
        model = json.loads(content)
        special = {x["content"] for x in model.get("added_tokens", [])}
        return {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


class ByteBpe:
    """Ids of texts by a byte-level BPE, by its vocabulary in either format."""

    def __init__(self, content: bytes):
        import tiktoken

        ranks = ranked(content)
        self.general, self.plain = (tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
                                    for name, pattern in (("general", PATTERN), ("plain", PLAIN_PATTERN)))

    def ids(self, text: str) -> list[int]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.rare(text)
        if any(x in text for x in _MEETING):
            return self.general.encode_ordinary(text)
        return self.plain.encode_ordinary(text)

    def rare(self, text: str) -> list[int]:
        return self.general.encode_ordinary(text)


class JsonTokenizer(ByteBpe):
    """The ids of `tokenizers` for a byte-level BPE in its JSON file.

    Texts of letters up to U+024F without special tokens go through the same vocabulary and merges on a faster matcher; all
    others go through `tokenizers` itself. Tests compare the two.
    """

    def __init__(self, content: bytes):
        super().__init__(content)
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.special = [x["content"] for x in json.loads(content).get("added_tokens", [])]
        self.unusual = re.compile("[^\x00-\u024f]")

    def ids(self, text: str) -> list[int]:
        if any(x in text for x in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return super().ids(text)

    def rare(self, text: str) -> list[int]:
        if self.unusual.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return super().rare(text)
