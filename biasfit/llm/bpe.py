"""Byte-level BPE encoding inside tasks.

The encoder is built from the ``tokenizers`` file itself.  A file whose
vocabulary is in merge order (rank = id) and whose pre-tokeniser is the plain
byte-level split is encoded by tiktoken's core, which gives the same ids about
four times faster; any other file is encoded by ``tokenizers``, and so is any
text with a white-space run so long that the core's pattern has no stack for it.
"""

from __future__ import annotations

import functools
import json
import re

#: The byte-level split pattern, and the printable bytes that
#: stand for themselves in a byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [(33, 126), (161, 172), (174, 255)]
#: Characters of a white-space run that the core is not given (its limit is about
#: a million); looked for at a run's start only, which is linear.
LONG_RUN = 100_000
_LONG = re.compile(r"(?<!\s)\s{%d}" % LONG_RUN)


def _byte_of() -> dict[str, int]:
    own = [b for lo, hi in PRINTABLE for b in range(lo, hi + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def has_long_run(text: str) -> bool:
    return len(text) >= LONG_RUN and _LONG.search(text) is not None


class Encoder:
    """``ids(texts)``: token ids as the library gives them, special strings
    inside texts being special tokens, nothing added, cut or padded."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.fast = path, self._core(spec)

    @functools.cached_property
    def slow(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    @staticmethod
    def _core(spec: dict):
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
                 and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                 and not spec.get("normalizer") and not model.get("end_of_word_suffix")
                 and not model.get("continuing_subword_prefix"))
        added = spec.get("added_tokens") or []
        if not plain or any(not a["special"] or a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            return None
        special = {a["content"]: a["id"] for a in added}
        to_byte = _byte_of()
        vocab = {bytes(to_byte[c] for c in tok): i for tok, i in model["vocab"].items() if tok not in special}
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
        ranks = [model["vocab"][m] for m in joined]
        if any(a >= b for a, b in zip(ranks, ranks[1:])) or any(bytes([b]) not in vocab for b in range(256)):
            return None
        import tiktoken
        return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=vocab, special_tokens=special)

    def ids(self, texts: list[str]) -> list[list[int]]:
        if self.fast is not None:
            return [self.slow.encode(t, add_special_tokens=False).ids if has_long_run(t)
                    else self.fast.encode(t, allowed_special="all") for t in texts]
        return [e.ids for e in self.slow.encode_batch(texts, add_special_tokens=False)]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
