"""Token ids of a byte-level BPE vocabulary, as its tokenizer file defines them."""

from __future__ import annotations

import base64
import hashlib
import json
from functools import cached_property
from pathlib import Path

import numpy as np
import public_tokenizers
import tiktoken
import tokenizers

TOKENIZER = "byte_bpe_50k.json"
_RANKS = "byte_bpe_50k.tiktoken"
# Below this character the classes of letters, numbers and spaces are the same in all Unicode versions of use.
_SETTLED = "Ԁ"


class Encoder:
    """Ids without added special tokens; a special token's string inside a text is that token.

    The library of the tokenizer file is right for every text but slow. The same vocabulary is published as ranks
    for a faster library, which splits with the same pattern; it is used where both must agree: for
    texts of settled characters only.
    """

    def __init__(self, name: str = TOKENIZER):
        self.path = public_tokenizers.path(name)
        self._fast = None
        if name == TOKENIZER:
            lines = map(bytes.split, Path(public_tokenizers.path(_RANKS)).read_bytes().splitlines())
            added = json.loads(Path(self.path).read_bytes())["added_tokens"]
            self._fast = tiktoken.Encoding(
                name,
                pat_str=public_tokenizers.PATTERN,
                mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in lines},
                special_tokens={t["content"]: t["id"] for t in added if t["special"]},
            )

    @cached_property
    def _slow(self) -> tokenizers.Tokenizer:
        """Read where it is first needed: most tasks hold one library's vocabulary only."""
        slow = tokenizers.Tokenizer.from_file(self.path)
        slow.no_truncation()
        slow.no_padding()
        return slow

    def ids(self, text: str) -> np.ndarray:
        if self._fast is not None and (text.isascii() or max(text) < _SETTLED):
            return self._fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)


def version(name: str = TOKENIZER) -> str:
    """Digest of the tokenizer file and the library's version: counts of another version are other counts."""
    content = Path(public_tokenizers.path(name)).read_bytes()
    return hashlib.sha256(content + tokenizers.__version__.encode()).hexdigest()
