"""Token ids of whole texts with a byte-level BPE file of the `tokenizers` library, for use inside tasks."""

from __future__ import annotations

import functools
import json

import numpy as np

CACHED_WORDS = 400_000  # words remembered by a worker; it starts afresh beyond, which costs time only


@functools.lru_cache(maxsize=2)
def _loaded(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def _fast(path: str):
    """The same vocabulary for `tiktoken`, which merges by id: only for byte-level files whose merges are in the order of their ids."""
    import tiktoken
    from tokenizers.pre_tokenizers import ByteLevel

    spec = json.load(open(path, encoding="utf-8"))
    pre, model = spec["pre_tokenizer"] or {}, spec["model"]
    if (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex"), spec["normalizer"], model.get("type")) != \
            ("ByteLevel", False, True, None, "BPE") or model.get("ignore_merges"):
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [model["vocab"]["".join(p)] for p in pairs]
    if ids != list(range(ids[0], ids[0] + len(ids))) or min(ids) < 256:
        return None
    # Each byte as ByteLevel writes it: printable ones as themselves, the others from 256 on, by rule.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    if set(shown.values()) != set(ByteLevel.alphabet()):
        return None
    back = {c: b for b, c in shown.items()}
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(back[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value of ByteLevel
    return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), special


class _Words(dict):
    """Number of each word met; ids of word i are flat[start[i]:start[i + 1]]."""

    def __init__(self, encode):
        self.encode, self.flat, self.start = encode, [], [0]

    def __missing__(self, word):
        i = self[word] = len(self.start) - 1
        self.flat += self.encode(word)
        self.start.append(len(self.flat))
        return i


def _words(text: str) -> list[str]:
    """`text` cut before each space that a visible character follows: no token crosses such a place, as a space joins what follows
    it and white space before it ends there."""
    words = text.split(" ")
    if all(w and ("!" <= w[0] <= "~" or w[0].isalpha()) for w in words[1:]):
        return [words[0], *[" " + w for w in words[1:]]]
    out = [words[0]]
    for w in words[1:]:
        if w and ("!" <= w[0] <= "~" or w[0].isalpha()):
            out.append(" " + w)
        else:
            out[-1] += " " + w
    return out


class Ids:
    """Ids as tokenizers gives them with add_special_tokens=False. Words are merged once and remembered."""

    def __init__(self, path: str):
        self.path, self.words = path, None

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        fast = _fast(self.path)
        if fast is None:
            return [np.array(e.ids, "<u4") for e in _loaded(self.path).encode_batch(texts, add_special_tokens=False)]
        encoding, special = fast
        if self.words is None or len(self.words) > CACHED_WORDS:
            self.words = _Words(encoding.encode_ordinary)
        slow = {i for i, t in enumerate(texts) if any(s in t for s in special)}
        numbers, counts = [], []
        for i, t in enumerate(texts):
            cut = [] if i in slow else _words(t)
            numbers += map(self.words.__getitem__, cut)
            counts.append(len(cut))
        which = np.array(numbers, np.int64)
        start, flat = np.array(self.words.start, np.int64), np.array(self.words.flat, "<u4")
        n = start[which + 1] - start[which]
        ends = np.cumsum(n)
        ids = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[which] - (ends - n), n)]
        at = np.r_[0, ends][np.cumsum([0, *counts])]
        return [np.array(_loaded(self.path).encode(t, add_special_tokens=False).ids, "<u4") if i in slow else ids[at[i]:at[i + 1]]
                for i, t in enumerate(texts)]
