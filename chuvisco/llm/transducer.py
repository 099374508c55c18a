"""A finite-state transducer that counts the tokens of a word-end BPE tokenizer, compiled while it runs.

The states of a word are what a byte-pair encoder must still know of what it has read: which stretches at its end can
begin or continue a token, and for each the token before it. The encoding of a text read so far is known through its
last token alone, since token sequences are right exactly if all neighbours in them are: a token may end a text if it
and the last token of the text before it stay apart when they are encoded together. So every transition gives the change
in the number of tokens, and a state the number that closing the word adds. States and transitions are made when they
are first met and kept in tables; full tables are emptied and made anew from the states in use.
"""

from __future__ import annotations

import json
import unicodedata
from functools import cache

import numpy as np

#: Symbols: ASCII as it is, bytes of longer characters, then a mark before those bytes for letters, numbers and others,
#: and the end of a stretch of text.
LETTER, NUMBER, OTHER, STOP, SYMBOLS = 256, 257, 258, 259, 260
_SPACES = (9, 10, 11, 12, 13, 32)
_WIDE_SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Endings that are words of their own after an apostrophe.
SHORT = ("s", "t", "re", "ve", "m", "ll", "d")
#: States in the tables before they are emptied, and symbols of a chunk.
STATES, CHUNK = 1 << 17, 1024


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: itself if it is visible, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordMachine:
    """Numbers of tokens of one word, letter by letter. A state is a tuple of ``(stretch, token before it, tokens up to
    there less tokens up to here)``, the empty stretch first; the token before a word's start is empty."""

    def __init__(self, vocabulary: dict[str, int], merges: list, end: str):
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(merges)}
        self.tokens, self.end, self.apart = set(vocabulary), end, {}
        self.begun = {t[:i] for w in vocabulary for t in (w.removesuffix(end),) for i in range(1, len(t) + 1)}

    start = (("", "", 0),)

    def encode(self, letters: list[str]) -> list[str]:
        while len(letters) > 1:
            rank, i = min((self.ranks.get(p, 1 << 30), i) for i, p in enumerate(zip(letters, letters[1:], strict=False)))
            if rank == 1 << 30:
                break
            letters = [*letters[:i], letters[i] + letters[i + 1], *letters[i + 2 :]]
        return letters

    def stay(self, one: str, other: str) -> bool:
        """Whether two tokens stay apart."""
        if not one:
            return True
        mark = (one, other)
        if mark not in self.apart:
            if len(self.apart) > 1 << 18:
                self.apart.clear()
            closed = other.endswith(self.end) and other != self.end
            letters = [*one, *(other.removesuffix(self.end) if closed else other)]
            if closed:
                letters[-1] += self.end
            self.apart[mark] = self.encode(letters) == [one, other]
        return self.apart[mark]

    def read(self, state: tuple, letter: str) -> tuple[tuple, int]:
        for stretch, before, less in state:
            token = stretch + letter
            if token in self.tokens and self.stay(before, token):
                added = less + 1
                break
        else:
            raise ValueError(f"no token ends at {letter!r}")
        going = [(s + letter, before, less - added) for s, before, less in state if s + letter in self.begun]
        return (("", token, 0), *going), added

    def close(self, state: tuple) -> int:
        for stretch, before, less in state:
            if stretch and stretch + self.end in self.tokens and self.stay(before, stretch + self.end):
                return less + 1
        raise ValueError("no token closes the word")


class Transducer:
    """Tables of transitions over symbols; -1 where one has not been made. State 0 stands between words."""

    def __init__(self, path: str, states: int = STATES):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        self.special = tuple(t["content"] for t in held["added_tokens"])
        self.word = WordMachine(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.letters, self.most = byte_letters(), states
        self._empty()

    def _empty(self) -> None:
        self.column = np.full(SYMBOLS, -1)
        self.symbol: list[int] = []
        self.table = np.full((1024, 64), -1, np.int32)  # the state after, and in the last eight bits what is given, plus 128
        self.known, self.states = {}, []
        self.columns([STOP])
        self.number(("", None))

    def columns(self, symbols) -> None:
        """Gives columns to symbols that have none; few ever occur."""
        for c in symbols:
            if self.column[c] < 0:
                self.column[c] = len(self.symbol)
                self.symbol.append(int(c))
        while len(self.symbol) > self.table.shape[1]:
            self.table = np.concatenate([self.table, np.full_like(self.table, -1)], axis=1)

    def number(self, state: tuple) -> int:
        if state not in self.known:
            self.known[state] = len(self.states)
            self.states.append(state)
            if len(self.states) > len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        return self.known[state]

    def _closing(self, state: tuple) -> int:
        kind, word = state
        if kind == "":
            return 0
        if kind == "'":  # an apostrophe and what follows of a short ending: the apostrophe, then a word
            return self._whole("'") + (self._whole(word) if word else 0)
        return self.word.close(word)

    def _whole(self, text: str) -> int:
        state, added = WordMachine.start, 0
        for letter in text:
            state, n = self.word.read(state, letter)
            added += n
        return added + self.word.close(state)

    def _step(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        kind, word = state
        if 128 <= symbol < 256:
            word, added = self.word.read(word, self.letters[symbol])
            return (kind, word), added
        letter = chr(symbol) if symbol < 128 else ""
        if kind == "'":
            ending = word + letter
            if letter and ending in SHORT:
                return ("", None), self._whole("'" + ending)
            if letter and any(s.startswith(ending) for s in SHORT):
                return ("'", ending), 0
            # no short ending: the apostrophe is other text, what came after it the start of a word
            other, added = self.word.read(WordMachine.start, "'")
            if not word:
                after, more = self._step(("o", other), symbol)
                return after, added + more
            added += self.word.close(other)
            inner, n = WordMachine.start, 0
            for c in word:
                inner, m = self.word.read(inner, c)
                n += m
            after, more = self._step(("l", inner), symbol)
            return after, added + n + more
        if symbol == STOP or symbol in _SPACES:
            return ("", None), self._closing(state)
        if symbol < 128:
            into = "l" if letter.isalpha() else "n" if letter.isdigit() else "o"
        else:
            into = {LETTER: "l", NUMBER: "n", OTHER: "o"}[symbol]
        added = 0
        if into != kind or into == "n":
            added, word = self._closing(state), WordMachine.start
            if letter == "'":
                return ("'", ""), added
        if letter:
            word, more = self.word.read(word, self.letters[symbol])
            added += more
        return (into, word), added

    def _make(self, state: int, column: int) -> None:
        after, given = self._step(self.states[state], self.symbol[column])
        n = self.number(after)
        self.table[state, column] = n << 8 | given + 128

    def run(self, chunks: np.ndarray, lengths: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every chunk (a row of columns) from its entry state on, all at the same pace: states at the ends, and what
        each symbol gave out."""
        state = entry.copy()
        given = np.zeros(chunks.T.shape, np.int8)
        across = np.ascontiguousarray(chunks.T)
        for i in range(int(lengths.max(initial=0))):
            live = lengths > i
            lanes = slice(None) if live.all() else np.flatnonzero(live)
            column, now = across[i][lanes], state[lanes]
            after = self.table.reshape(-1).take(now * self.table.shape[1] + column)
            lacking = after < 0
            if lacking.any():
                if len(self.states) >= self.most:
                    held, symbols = [self.states[s] for s in state], self.symbol
                    self._empty()
                    self.columns(symbols)
                    state = np.array([self.number(s) for s in held])
                    now = state[lanes]
                    lacking = np.ones(len(now), bool)
                for mark in np.unique(now[lacking] << 9 | column[lacking]).tolist():
                    if self.table[mark >> 9, mark & 511] < 0:
                        self._make(mark >> 9, mark & 511)
                after = self.table.reshape(-1).take(now * self.table.shape[1] + column)
            given[i][lanes] = (after & 255) - 128
            state[lanes] = after >> 8
        return state, given.T

    def counts(self, symbols: np.ndarray) -> np.ndarray:
        """What each symbol of a stream gives out.

        The stream is cut into chunks. A chunk's exit state is the same for all entries once it has read white space or a
        stop: all chunks run from there side by side, and the exit of a chunk is the entry of the next one's head. No maps
        from entry to exit states are made or composed: chunks without such a symbol run one after another, each when its
        entry is known.
        """
        n = len(symbols)
        rows = max(1, -(-n // CHUNK))
        self.columns(np.flatnonzero(np.bincount(symbols, minlength=SYMBOLS)))
        chunks = np.full(rows * CHUNK, self.column[STOP])
        chunks[:n] = self.column[symbols]
        chunks = chunks.reshape(rows, CHUNK)
        resets = _RESETS[self.symbol][chunks]
        first = np.where(resets.any(axis=1), resets.argmax(axis=1), CHUNK)
        tails = np.where(np.arange(CHUNK) >= first[:, None], chunks, self.column[STOP])
        # heads run later; until then each tail starts between words and has stops before it, which give nothing
        exits, given = self._kept(tails, np.full(rows, CHUNK), [("", None)] * rows)
        resolved = first < CHUNK
        entries: list = [None] * rows
        entries[0] = ("", None)
        waiting = np.ones(rows, bool)
        while waiting.any():
            for i in np.flatnonzero(waiting & np.r_[True, resolved[:-1]]):
                if i:
                    entries[i] = exits[i - 1]
            ready = np.flatnonzero(waiting & np.r_[True, resolved[:-1]])
            ends, head = self._kept(chunks[ready], np.minimum(first[ready] + 1, CHUNK), [entries[i] for i in ready])
            for j, i in enumerate(ready.tolist()):
                stop = min(first[i] + 1, CHUNK)
                given[i, :stop] = head[j, :stop]
                if not resolved[i]:
                    exits[i] = ends[j]
            resolved[ready] = True
            waiting[ready] = False
        return given.reshape(-1)[:n]

    def _kept(self, chunks: np.ndarray, lengths: np.ndarray, entries: list) -> tuple[list, np.ndarray]:
        ids = np.array([self.number(e) for e in entries], np.int64)
        state, given = self.run(chunks, lengths, ids)
        return [self.states[s] for s in state], given


_RESETS = np.zeros(SYMBOLS, bool)
_RESETS[[*_SPACES, STOP]] = True


#: Letters and numbers that the tokenizer knows from Unicode 16, which Python's own table (15.1) has no category for.
_LATER = {
    LETTER: (
        (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
        (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
        (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
        (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
    ),
    NUMBER: (
        (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
        (0x1E5F1, 0x1E5FA),
    ),
}


@cache
def _kinds() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.int64)
    for code in range(128, 0x110000):
        major = unicodedata.category(chr(code))[0]
        if major in "LN":
            kinds[code] = LETTER if major == "L" else NUMBER
    for kind, ranges in _LATER.items():
        for first, last in ranges:
            kinds[first : last + 1] = kind
    kinds[list(_WIDE_SPACES)] = 32
    return kinds


def normal(text: str) -> str:
    """Composed and in lower case, character by character."""
    if text.isascii():
        return text.lower()
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


def symbols_of(data: np.ndarray) -> np.ndarray:
    """Symbols of UTF-8 bytes, in which a byte 255 is a stop."""
    lead = np.flatnonzero((data >= 0xC2) & (data < 0xF5))
    symbols = data.astype(np.int64)
    symbols[data == 255] = STOP
    if not len(lead):
        return symbols
    padded = np.r_[data, 0, 0, 0].astype(np.int64)
    b0, b1, b2, b3 = (padded[lead + i] for i in range(4))
    code = np.where(
        b0 < 0xE0,
        (b0 & 31) << 6 | b1 & 63,
        np.where(b0 < 0xF0, (b0 & 15) << 12 | (b1 & 63) << 6 | b2 & 63, (b0 & 7) << 18 | (b1 & 63) << 12 | (b2 & 63) << 6 | b3 & 63),
    )
    kind = _kinds()[np.minimum(code, 0x10FFFF)]
    space = kind == 32
    keep = np.ones(len(data), bool)
    size = np.where(b0 < 0xE0, 2, np.where(b0 < 0xF0, 3, 4))
    for i in range(1, 4):
        keep[(lead + i)[space & (size > i)]] = False
    symbols[lead[space]] = 32
    marks = np.zeros(len(data), np.int64)
    marks[lead[~space]] = 1
    place = np.cumsum(marks + keep) - 1
    out = np.zeros(int(place[-1]) + 1, np.int64)
    out[place[keep]] = symbols[keep]
    out[place[lead[~space]] - 1] = kind[~space]
    return out
