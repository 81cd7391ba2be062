"""Token ids of whole texts, in Python workers, by a public tokenizer file."""

from __future__ import annotations

import re
import sys
import types

#: Most bytes, about, of one table of remembered chunks in a worker.
BYTES_KEPT = 32 << 20
#: About what an entry costs beside its key's and value's characters.
ENTRY_BYTES = 220


class Memo(dict):
    """Values made once per key, in two generations of half of ``BYTES_KEPT``:
    when the young one is full it becomes the old one, so that keys in use stay
    and the rest goes."""

    def __init__(self, make, most: int = BYTES_KEPT):
        self.make, self.half, self.old, self.held = make, most // 2, {}, 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        cost = len(key) + len(value) + ENTRY_BYTES
        if self.held + cost > self.half:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self.held += cost
        self[key] = value
        return value


def worker_store(name: str, make):
    """An object kept for the life of a Python worker, across its tasks."""
    store = sys.modules.setdefault("_statflow_worker_store", types.ModuleType("_statflow_worker_store"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def forget_encoders() -> None:
    """Drops the encoders of tasks before, with the chunks they remember, from
    a worker whose task needs the memory for something else."""
    store = vars(sys.modules.get("_statflow_worker_store", types.ModuleType("")))
    for name in [x for x in store if x.startswith(("encoder_", "word_encoder_"))]:
        del store[name]


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: visible
    Latin-1 characters are themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level(path: str):
    """The ranks of a byte-level vocabulary by tokens' bytes, and the file's
    special tokens."""
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = [t["content"] for t in spec["added_tokens"]]
    byte_of = byte_symbols()
    return {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items()
            if token not in special}, special


class Encoder:
    """ids(text): the tokenizer's ids (no special tokens added) as
    little-endian unsigned 32-bit bytes.

    The tokenizer's first step always cuts before a space that follows a
    character other than white space, and encodes what lies between two such
    cuts on its own. Texts are cut there, and each different piece is encoded
    once and remembered. Texts with other white space before a space are
    encoded as a whole, those with a special token's string by the tokenizers
    library, which gives it its id. The others go by the same file's vocabulary
    and cutting pattern through tiktoken, with the same ids in a quarter of the
    time.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import numpy as np
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        ranks, special = byte_level(path)
        fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})

        def encode(text: str) -> bytes:
            return np.array(fast.encode_ordinary(text), "<u4").tobytes()

        def exact(text: str) -> bytes:
            return np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

        first = Memo(encode, BYTES_KEPT // 4).__getitem__
        later = Memo(lambda t: encode(" " + t), 6 * BYTES_KEPT).__getitem__
        has_special = re.compile("|".join(map(re.escape, special)) or r"(?!)").search
        has_more_space = re.compile(r"\s ").search

        def ids(text: str) -> bytes:
            if not text:
                return b""
            if has_special(text):
                return exact(text)
            if has_more_space(text):
                return encode(text)
            head, *rest = text.split(" ")
            return first(head) + b"".join(map(later, rest))

        self.ids = ids


def encoder(path: str) -> Encoder:
    """The worker's encoder for ``path``."""
    return worker_store("encoder_" + path, lambda: Encoder(path))


class WordEncoder:
    """ids(text): the ids of a vocabulary with word ends (lower case, white
    space dropped; no special tokens added) as little-endian unsigned 16-bit
    integers.

    White space separates in the tokenizer's every step, so what lies between
    spaces and line feeds is encoded on its own and remembered; of that, a run
    of ASCII letters and the signs after it are remembered apart. After lower
    case no capital A is left; here it stands for a word's end, and the file's
    vocabulary goes through tiktoken. What has other characters than ASCII and
    Latin letters, or a special token's string, goes through the tokenizers
    library itself.
    """

    def __init__(self, path: str):
        import json
        import os
        import re
        from array import array

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        special = [t.content for t in tok.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of, end = byte_symbols(), model["end_of_word_suffix"]
        if max(model["vocab"].values()) >= 1 << 16:
            raise ValueError(f"{path}: ids of more than 16 bits")
        ranks = {}
        for token, i in model["vocab"].items():
            if token not in special:
                body = token[:-len(end)] if token.endswith(end) and token != end else token
                ranks[bytes(byte_of[c] for c in body) + b"A" * (body != token)] = i
        fast = tiktoken.Encoding("words", pat_str="[^A]+A", mergeable_ranks=ranks,
                                 special_tokens={}).encode_ordinary
        letters, digits = "a-zªµºß-öø-ɏ", "0-9²³¹¼-¾"
        # the file's own pattern, spelled for ASCII and Latin characters
        pieces = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^\s{letters}{digits}]+").findall
        simple = re.compile(r"([A-Za-z]+)([^\sA-Za-z0-9'\x00-\x20\x7f-\U0010ffff]*)", re.ASCII).fullmatch
        other = re.compile("[^\x00-\x1b\x20-\x7f\xa1-\u024f]").search
        has_special = re.compile("|".join(map(re.escape, special)) or r"(?!)").search

        def exact(text: str) -> bytes:
            return array("H", tok.encode(text, add_special_tokens=False).ids).tobytes()

        part = Memo(lambda piece: array("H", fast(piece + "A")).tobytes(), 2 * BYTES_KEPT).__getitem__

        def encode(chunk: str) -> bytes:
            plain = simple(chunk)
            if plain:
                word, signs = plain.groups()
                return part(word.lower()) + part(signs) if signs else part(word.lower())
            if other(chunk):
                return exact(chunk)
            return b"".join(map(part, pieces(chunk.lower())))

        kept = Memo(encode, 4 * BYTES_KEPT).__getitem__

        def ids(text: str) -> bytes:
            if has_special(text):
                return exact(text)
            return b"".join(map(kept, text.replace("\n", " ").split(" ")))

        self.ids = ids


def word_encoder(path: str) -> WordEncoder:
    """The worker's word encoder for ``path``."""
    return worker_store("word_encoder_" + path, lambda: WordEncoder(path))
