"""Token ids of texts by a public byte-level tokenizer.

Where the same vocabulary is also given as merge ranks, the faster public encoder of ranks does the work and yields the
same ids. Where a text holds a special token's name or a character whose class differs between Unicode versions, the
text goes to the tokenizer itself.
"""

from __future__ import annotations

import base64
import os
import re
import unicodedata

import numpy as np


def _stable_characters() -> str:
    """Character class of code points assigned in Unicode 3.2 whose letter/number/space kind has not changed since."""
    old, runs = unicodedata.ucd_3_2_0, []
    for code in range(0x10000):
        c = chr(code)
        was, now = old.category(c), unicodedata.category(c)
        odd = was == "Cn" or was[0] in "LNZ" and was[0] != now[0] or now[0] in "LNZ" and was[0] != now[0]
        if odd or 0x1C <= code <= 0x1F or code in (0x85, 0x180E) or 0xD800 <= code < 0xF900:
            continue
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


class TokenIds:
    """ids(text) -> numpy uint32 ids without special tokens added."""

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._special = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        self._part = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._part = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self._odd = re.compile(f"[^{_stable_characters()}]")

    def ids(self, text: str) -> np.ndarray:
        if self._part is None or self._odd.search(text) or any(s in text for s in self._special):
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self._part(text), np.uint32)
