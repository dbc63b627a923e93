"""Byte-level BPE, and the positions in a text that no pre-token crosses.

The split pattern of the public byte-level vocabularies matches a space only as the first
character of a token or inside a run of white space. A space that follows a character
other than white space therefore always starts a new pre-token, whatever comes after it.
Such a position is a *safe boundary*: the ids of a text are the ids of its parts, joined.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np

#: Split pattern of the vocabulary (a fixed value of the file format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SAFE = re.compile(r"(?<=\S)(?= )")
PLAIN = 131_072  # characters that the split pattern takes whatever they are
#: White space as the split pattern knows it (Python's own class has four characters more).
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level files use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def load(path: str):
    """A tiktoken Encoding with the vocabulary and special tokens of a byte-level .json file.

    Raises ValueError if the file isn't a plain byte-level BPE whose merge order equals its
    id order, the case in which ranks and merges give the same ids.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError(f"{path}: not a plain byte-level BPE")
    back = _byte_of_char()
    if any(t.get(flag) for t in spec["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path}: added tokens that change the text around them")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    made = [vocab[a + b] for a, b in merges]
    if made != sorted(made):
        raise ValueError(f"{path}: merges are not in id order")
    ranks = {bytes(back[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def slices(text: str, size: int = 65_536):
    """Parts of at most about ``size`` characters, cut at safe boundaries; a longer part only where there is none."""
    at = 0
    while len(text) - at > size:
        m = SAFE.search(text, at + size)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


@functools.lru_cache(maxsize=4)
def _whole(enc):
    """The same vocabulary for texts that are one pre-token."""
    import tiktoken

    return tiktoken.Encoding(f"{enc.name} whole", pat_str=r"(?s:.+)", mergeable_ranks=enc._mergeable_ranks, special_tokens={})


def encode_part(enc, text: str) -> np.ndarray:
    """Ids of a text whose ends are ends of the document or safe boundaries.

    The split pattern runs out of stack inside white space of some hundred thousand
    characters. In longer texts each long run is therefore taken out: it is one pre-token, but
    for its last character if more text follows, which stays with that text.
    """
    if len(text) <= PLAIN:
        return enc.encode_to_numpy(text, allowed_special="all")
    out, at = [], 0
    for m in LONG_SPACE.finditer(text):
        last = m.end() == len(text) or any(text.startswith(t, m.end()) for t in enc.special_tokens_set)
        end = m.end() if last else m.end() - 1
        out += [enc.encode_to_numpy(text[at : m.start()], allowed_special="all"), np.asarray(_whole(enc).encode_ordinary(text[m.start() : end]), np.uint32)]
        at = end
    return np.concatenate([*out, enc.encode_to_numpy(text[at:], allowed_special="all")])


def encode(enc, text: str) -> np.ndarray:
    """Ids of a whole text; strings of special tokens in it become their ids, as the file's library does by default."""
    return np.concatenate([encode_part(enc, p) for p in slices(text)])
