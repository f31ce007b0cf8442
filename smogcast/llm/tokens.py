"""Token ids of whole texts by a public byte-level BPE vocabulary.

Texts are split into pieces by array operations and every distinct piece of a
chunk is merged once, so the cost follows the distinct pieces. The split knows
Latin letters, digits, ASCII marks and white space; a text with an apostrophe
(contractions), with one of the vocabulary's added tokens (their strings are one
id) or with any other character goes to the ``tokenizers`` library whole. Both ways
give the same ids (tests hold them against the library itself).
"""

from __future__ import annotations

import base64
import json
import unicodedata
from functools import cache

import numpy as np

from smogcast.llm import text

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
KEEP_PIECES = 200_000
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_PLAIN = 0x250


@cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of every plain character, and whether it is left to the library."""
    kind, odd = np.zeros(_PLAIN, np.uint8), np.zeros(_PLAIN, bool)
    for c in range(_PLAIN):
        cat = unicodedata.category(chr(c))
        kind[c] = _LETTER if cat[0] == "L" else _NUMBER if cat[0] == "N" else _OTHER
        odd[c] = cat in ("Cc", "Cn", "Zs", "Cf") or c == 0x27
    kind[list(text.SPACES)] = _SPACE
    odd[list(text.SPACES)] = False
    return kind, odd


class Ids:
    """Encoder held by a Python worker. ``vocabulary`` and ``ranks`` are file paths or public names."""

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str = RANKS):
        import public_tokenizers
        import tiktoken
        self.vocabulary = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        path = ranks if "/" in ranks else public_tokenizers.path(ranks)
        with open(path, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(self.vocabulary, encoding="utf-8") as f:
            self.added = [t["content"].encode() for t in json.load(f).get("added_tokens") or [] if t["content"]]
        self.merge = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                       special_tokens={}).encode_ordinary
        self.whole = None
        self.known: dict[int, list[int]] = {}

    def by_library(self, value: str) -> np.ndarray:
        if self.whole is None:
            from tokenizers import Tokenizer
            self.whole = Tokenizer.from_file(self.vocabulary)
        return np.array(self.whole.encode(value, add_special_tokens=False).ids, np.uint32)

    def split(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of pieces in plain rows, and which rows are not plain."""
        kinds, odd = _classes()
        n = len(raw)
        kind = kinds[raw]
        strange = odd[raw]
        lead = np.flatnonzero(raw >= 0xC0)
        if len(lead):
            low = np.minimum(lead + 1, n - 1)
            point = ((raw[lead].astype(np.int64) & 0x1F) << 6) | (raw[low] & 0x3F)
            ok = (raw[lead] < 0xE0) & (point < _PLAIN)
            point[~ok] = 0
            kind[lead] = kind[low] = kinds[point]
            strange[low] = False
            strange[lead] = ~ok | odd[point]
        tail = raw >= 0x80
        tail &= raw < 0xC0
        strange[tail] = False
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        start = edge[:-1].copy()
        start[1:] |= kind[1:] != kind[:-1]
        after = np.flatnonzero(start[1:] & ~edge[1:-1] & (kind[:-1] == _SPACE) & (kind[1:] != _SPACE)) + 1
        start[after - 1] = True
        start[after[raw[after - 1] == 32]] = False
        rows = np.unique(np.searchsorted(at, np.flatnonzero(strange), "right") - 1)
        not_plain = np.zeros(len(at) - 1, bool)
        not_plain[rows] = True
        return np.flatnonzero(start), not_plain

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in turn, and the rows' offsets in them."""
        n = len(at) - 1
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        data = raw.tobytes()
        starts, not_plain = self.split(raw, at)
        for mark in self.added:
            found = data.find(mark)
            while found >= 0:
                row = int(np.searchsorted(at, found, "right")) - 1
                not_plain[row] = True
                found = data.find(mark, int(at[row + 1]))
        ends = np.append(starts[1:], len(raw))
        rows = np.searchsorted(at, starts, "right") - 1
        if not_plain.any():
            keep = ~not_plain[rows]
            starts, ends, rows = starts[keep], ends[keep], rows[keep]
        found, first, inverse = np.unique(text.span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > KEEP_PIECES:
            self.known.clear()
        known, merge = self.known, self.merge
        pieces = []
        for h, a, z in zip(found.tolist(), starts[first].tolist(), ends[first].tolist()):
            ids = known.get(h)
            if ids is None:
                ids = known[h] = merge(data[a:z].decode())
            pieces.append(ids)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.fromiter((i for p in pieces for i in p), np.uint32, int(length.sum()))
        where = np.cumsum(length) - length
        each = length[inverse]
        total = np.cumsum(each)
        out = flat[np.repeat(where[inverse] - (total - each), each) + np.arange(int(total[-1]) if len(total) else 0)]
        per_row = np.bincount(rows, weights=each, minlength=n).astype(np.int64)
        if not_plain.any():
            plain_at = np.concatenate([[0], np.cumsum(per_row)])
            parts = [self.by_library(data[at[i]:at[i + 1]].decode()) if not_plain[i]
                     else out[plain_at[i]:plain_at[i + 1]] for i in range(n)]
            per_row = np.array([len(p) for p in parts])
            out = np.concatenate(parts)
        return out, np.concatenate([[0], np.cumsum(per_row)])
