"""Token ids of many texts by a byte-level BPE file: each distinct unit of a batch is encoded once.

A unit is a stretch of text whose ends are always token boundaries for the tokenizer's split pattern, whatever stands
around it: before a single space or line break between two visible characters, and between an ASCII letter and ASCII
punctuation other than an apostrophe.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import pyarrow.compute as pc

from chuvisco.llm.shared import strings

#: Units in a store of a Python worker. Two are kept: when the newer one is full, it takes the place of the older one, so
#: units that keep coming stay known.
KEPT = 120_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VISIBLE = np.zeros(256, bool)  # ASCII, not white space and no control character that a pattern could take for it
_VISIBLE[33:127] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = _VISIBLE & ~_LETTER
_PUNCT[[39, *range(48, 58)]] = False
_LEAD = np.zeros(256, bool)  # first bytes of characters none of which is white space
_LEAD[0xC3:0xE1] = _LEAD[0xE4:0xF5] = True


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    special = tuple(t.content.encode() for t in made.get_added_tokens_decoder().values())
    return made, special, [{}, {}]


def unit_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where units start in ``data``, which holds texts that start at ``starts``; the last entry is the end."""
    n = len(data)
    if n < 3:
        return np.unique(np.r_[starts, n])
    # the character that ends at a byte is visible: ASCII, or two bytes after C3..DF (no white space there)
    ended = _VISIBLE[data]
    ended[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    begun = _VISIBLE[data] | _LEAD[data]
    gap = np.zeros(n, bool)
    gap[1:-1] = ((data[1:-1] == 32) | (data[1:-1] == 10)) & ended[:-2] & begun[2:]
    cut = gap.copy()
    cut[1:] |= gap[:-1] & (data[:-1] == 10)
    cut[1:] |= _LETTER[data[:-1]] & _PUNCT[data[1:]]
    cut[starts[starts < n]] = True
    return np.r_[np.flatnonzero(cut), n]


def encode(path: str, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and where each text's ids start (and the last ones end)."""
    made, special, stores = _tokenizer(path)
    texts = len(starts) - 1
    if any(data.tobytes().find(s) >= 0 for s in special):
        whole = [bytes(data[a:b]).decode("utf-8", "replace") for a, b in zip(starts[:-1], starts[1:], strict=True)]
        found = [np.array(e.ids, np.uint32) for e in made.encode_batch_fast(whole, add_special_tokens=False)]
        return np.concatenate(found), np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int64)
    cuts = unit_starts(data, starts)
    if len(cuts) < 2:
        return np.zeros(0, np.uint32), np.zeros(texts + 1, np.int64)
    coded = pc.dictionary_encode(strings(data, cuts))
    units = coded.dictionary.to_pylist()
    older, newer = stores
    if len(newer) > KEPT:
        older, newer = stores[:] = newer, {}
    known = [newer.get(u) or older.get(u) for u in units]
    lacking = [i for i, k in enumerate(known) if k is None]
    newer.update(zip(units, known, strict=True))
    if lacking:
        fresh = made.encode_batch_fast([units[i].decode("utf-8", "replace") for i in lacking], add_special_tokens=False)
        for i, e in zip(lacking, fresh, strict=True):
            newer[units[i]] = known[i] = np.array(e.ids, np.uint32).tobytes()
    held = np.frombuffer(b"".join(known), np.uint32)
    length = np.fromiter(map(len, known), np.int64, len(known)) // 4
    first = np.r_[0, np.cumsum(length)[:-1]]
    codes = coded.indices.to_numpy(zero_copy_only=False)
    lengths = length[codes]
    ends = np.cumsum(lengths)
    # place of each id in the store: its unit's first place, plus how far it stands behind its unit's start
    places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[codes] - (ends - lengths), lengths)
    bounds = np.r_[0, ends][np.searchsorted(cuts, starts)]
    return held[places], bounds.astype(np.int64)
