"""The tokenizers library over many texts, word by word: each distinct word is encoded once per worker."""

from __future__ import annotations

import itertools
import os
import re

import numpy as np

REMEMBERED = 500_000  # words a worker process keeps; this only saves time
LONGEST = 64  # letters of a word that is kept
# White space other than the space and the line end, by any reading of the pattern's \\s.
OTHER_WHITE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_mixed_run = re.compile(f" [{OTHER_WHITE}]|[{OTHER_WHITE}] ").search


def load(described: str, from_file: bool = True):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(described) if from_file else Tokenizer.from_str(described)


class _Numbered(dict):
    """Numbers each new key in the order of first use; a number isn't used again."""

    given = 0

    def __missing__(self, key: str) -> int:
        n = self[key] = self.given
        self.given += 1
        return n


def _white(c: str) -> bool:
    return c.isspace() or c in OTHER_WHITE


def _segments(text: str) -> list[str]:
    """The text cut before every line end that stands between two characters that aren't white space."""
    first, *lines = text.split("\n")
    out, own = [], first
    for line in lines:
        if line and own and not (_white(line[0]) or _white(own[-1])):
            out.append(own)
            own = "\n" + line
        else:
            own += "\n" + line
    out.append(own)
    return out


class ChunkEncoder:
    """Encodes texts word by word, remembering words.

    A byte-level pre-token never holds a non-space followed by white space, so a
    text may be cut before every single space or line end and its parts encoded
    alone.  Longer runs of white space, of any characters, are matched together, so a
    line that holds one next to a space goes in whole.  Words are remembered, whole lines and very long words aren't.
    New words are encoded as one joined text, tokens are told apart by their byte
    lengths; a known word before a comma or full stop isn't encoded again.
    ``special_as_text``: the strings of special tokens in a text are ordinary text;
    without it they are those tokens, as the library does by itself.  A text that holds
    an added token's string goes to the library as a whole.
    """

    def __init__(self, tokenizer, remembered: int = REMEMBERED, special_as_text: bool = True):
        self.tok, self.remembered = tokenizer, remembered
        self.tok.encode_special_tokens = special_as_text
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values() if t.content and not (special_as_text and t.special)]
        vocab = self.tok.get_vocab()
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)  # one printable character stands for one byte
        # a comma or full stop after a letter is a pre-token of its own
        self.marks = {m: ids[0] for m, ids in zip(".,", map(np.ndarray.tolist, self._whole([".", ","]))) if len(ids) == 1}
        self.clear()

    def clear(self) -> None:
        self.at = _Numbered()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)  # by number of a word: its ids' place and number
        self.size = np.zeros(1 << 14, np.int64)
        self.known = self.used = 0

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _keep(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.begin[numbers] = self.used + np.cumsum(sizes) - sizes
        self.size[numbers] = sizes
        self.used += len(ids)

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered words in a row, and how many each has."""
        each = self.size[numbers]
        ends = np.cumsum(each)
        at = np.repeat(self.begin[numbers] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[at], each

    def _learn(self, words: list[str]) -> None:
        """Encode new words: plain ones in joined texts, words before a mark by what is known, the others alone."""
        first = self.known
        self.known += len(words)
        while self.known > len(self.begin):
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        plain, lines, alone, marked, stems, marks = [], [], [], [], [], []
        for n, w in enumerate(words, first):
            if not w or w[0] == " " or w[-1].isspace():
                alone.append(n)
            elif w[-1] in self.marks and w[-2:-1].isalpha() and (stem := self.at.get(w[:-1])) is not None:
                marked.append(n)
                stems.append(stem)
                marks.append(self.marks[w[-1]])
            else:
                (lines if w[0] == "\n" else plain).append(n)
        for space, own in ((" ", plain), ("", lines)):
            for i in range(0, len(own), 500):
                part = [space + words[n - first] for n in own[i : i + 500]]
                ids = self._whole(["".join(part)])[0]
                ends = np.cumsum(np.fromiter((len(w.encode()) for w in part), np.int64, len(part)))
                cuts = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
                self._keep(np.array(own[i : i + 500]), ids, np.diff(cuts, prepend=0))
        if alone:
            shown = {" ": lambda w: w[1:], "\n": lambda w: w}
            got = self._whole([shown.get(w[:1], " ".__add__)(w) for w in (words[n - first] for n in alone)])
            self._keep(np.array(alone), np.concatenate(got), np.array([len(g) for g in got]))
        if marked:
            ids, each = self._gather(np.array(stems))
            self._keep(np.array(marked), np.insert(ids, np.cumsum(each), marks), each + 1)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        if len(self.at) > self.remembered or self.used > 16 * self.remembered:
            self.clear()
        # What stands before a text's first space has no leading space, nor have whole lines; their key
        # is marked by a space, which no word holds.  A line's first word keeps its line end.
        flat: list[str] = []
        passing: list[str] = []
        n = np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            if any(a in t for a in self.added):
                passing.append(" " + t)
                flat.append(passing[-1])
                n[k] = 1
                continue
            before = len(flat)
            mixed = any(c in t for c in OTHER_WHITE)
            for i, line in enumerate(_segments(t)):
                if "  " in line or line.find("\n", i > 0) >= 0 or mixed and _mixed_run(line):
                    passing.append(line if i else " " + line)
                    flat.append(passing[-1])
                    continue
                words = line.split(" ")
                if not i:
                    if words[0]:
                        words[0] = " " + words[0]
                    else:
                        del words[0]
                flat += words
            n[k] = len(flat) - before
        word = np.fromiter(map(self.at.__getitem__, flat), np.int64, len(flat))
        new = [w for w, _ in itertools.takewhile(lambda x, known=self.known: x[1] >= known, zip(reversed(self.at), reversed(self.at.values())))][::-1]
        self._learn(new)
        for w in passing + [w for w in new if len(w) > LONGEST]:
            self.at.pop(w, None)
        ids, each = self._gather(word)
        total = np.concatenate([[0], np.cumsum(each)])
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(n)])])
